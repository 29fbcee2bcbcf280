import time
from datetime import date

from perkwell.llm import url_lists as ul


def keys(spark, url):
    return spark.createDataFrame([(url,)], "u string").select(ul.list_keys(ul.F.col("u"))).first()[0]


def test_keys_of_a_url(spark):
    assert keys(spark, "HTTP://me:pw@A.b.Example.com.:80/x//y?q#f") == [
        "a.b.example.com", "b.example.com", "example.com", "com", "a.b.example.com/x", "a.b.example.com/x/y",
    ]
    assert keys(spark, None) == keys(spark, "") == keys(spark, "mailto:x") == []


def decide(urls, entries):
    """Row by row, over the log itself."""
    rank = {"allow": 2, "block": 1, "remove": 0}
    out = {}
    for page, url, day, listed in urls:
        best = None
        for key in {k for k, *_ in entries if k in listed}:
            log = [(since, rank[a]) for k, a, since in entries if k == key and day is not None and since is not None and since <= day]
            if log and max(log)[1] and (best is None or len(key) > len(best[0])):
                best = (key, max(log)[1])
        out[page] = {None: "unlisted", 1: "blocked", 2: "allowed"}[best and best[1]], best and best[0]
    return out


def test_equal_to_reading_the_log(spark):
    days = [date(2024, 1, d) for d in range(1, 13)]
    keys_ = ["ex.com", "a.ex.com", "a.ex.com/p", "com", "b.ex.com", "other.org"]
    entries = [(k, ("block", "remove", "allow")[(3 * i + j * j) % 3], days[(5 * i + 7 * j) % 12]) for i, k in enumerate(keys_) for j in range(5)]
    entries += [(None, "block", days[0]), ("ex.com", "block", None), ("ex.com", "odd", days[1])]
    urls = [(n, f"http://{h}/{p}", days[n % 12]) for n, (h, p) in enumerate(
        (h, p) for h in ("a.ex.com", "b.ex.com", "ex.com", "other.org", "none.net") for p in ("", "p", "p/q", "z") for _ in range(6)
    )]
    urls += [(900, None, days[3]), (901, "", days[3]), (902, "http://ex.com/", None), (903, "http://ex.com/", days[5]), (903, "http://ex.com/", days[5])]
    captures = spark.createDataFrame([(*u, "extra") for u in urls], "page_id long, url string, fetched date, key string")
    log = spark.createDataFrame([(*e, 1) for e in entries], "key string, action string, since date, page_id int")
    rows = ul.evaluate(captures, log, salts=3).collect()
    wanted = [e for e in entries if None not in e and e[1] != "odd"]
    expected = decide([(p, u, d, keys(spark, u)) for p, u, d in urls], wanted)
    assert {r.page_id: (r.decision, r.entry) for r in rows} == expected
    assert {r.page_id: r.n_captures for r in rows} == {p: 2 if p == 903 else 1 for p in expected}
    assert ul.evaluate(captures.limit(0), log).count() == 0
    assert {r.decision for r in ul.evaluate(captures, log.limit(0)).collect()} == {"unlisted"}


def test_very_long_urls(spark):
    day = date(2024, 1, 2)
    deep = "http://h.ex.com/" + "/".join(f"s{k}" for k in range(32_000))
    listed = "h.ex.com/" + "/".join(f"s{k}" for k in range(900))
    urls = [(1, deep, day), (2, "http://" + "a." * 30_000 + "ex.com/s0/s1", day), (10**17, "http://h.ex.com/s0", day)]
    entries = [("ex.com", "block", day), (listed, "allow", day), ("h.ex.com/s0/s1", "block", day)]
    started = time.time()
    rows = ul.evaluate(spark.createDataFrame(urls, "page_id long, url string, fetched date"), spark.createDataFrame(entries, "key string, action string, since date")).collect()
    assert {r.page_id: (r.decision, r.entry) for r in rows} == {1: ("allowed", listed), 2: ("blocked", "ex.com"), 10**17: ("blocked", "ex.com")}
    assert time.time() - started < 30
