import random

from perkwell.llm import decontamination as dc


def runs(words):
    if not words:
        return set()
    n = min(5, len(words))
    return {" ".join(words[k:k + n]) for k in range(len(words) - n + 1)}


def every_run(words):
    return {" ".join(words[k:k + n]) for n in range(1, 6) for k in range(len(words) - n + 1)}


def test_equal_to_all_pairs(spark, documents):
    rng = random.Random(11)
    vocabulary = [f"v{k}" for k in range(300)]
    items = [rng.choices(vocabulary, k=rng.choice([3, 6, 12, 40, 90, 300])) for _ in range(30)] + [[], ["v1"]]
    items.append(items[4])
    texts = []
    for n in range(80):
        body = rng.choices(vocabulary, k=rng.choice([20, 200, 5000]))
        if n % 2:
            piece = list(rng.choice(items[:30]))
            for i in rng.sample(range(len(piece)), len(piece) * (n % 5) // 60):
                piece[i] = "changed"
            at = rng.randrange(len(body))
            body[at:at] = piece
        texts.append("  ".join(body).upper() + ".")
    texts += [None, "", "v1", "!!"]
    docs = documents(texts)
    benchmark = spark.createDataFrame([(k, ", ".join(i), "x") for k, i in enumerate(items)] + [(99, None, "x")], "item_id long, text string, doc_id string")
    expected = set()
    for d, text in enumerate(texts):
        held = every_run([w for w in (text or "").lower().replace(".", " ").replace("!", " ").split()])
        for k, item in enumerate(items):
            wanted = runs(item)
            if wanted and len(wanted & held) >= 0.8 * len(wanted):
                expected.add((d, k, len(wanted), len(wanted & held)))
    got = dc.contained_items(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id, r.n_shingles, r.n_shared) for r in got} == expected and len(got) == len(expected)
    clean = dc.without_contaminated(docs, benchmark)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == set(range(len(texts))) - {d for d, *_ in expected}


def test_beyond_what_is_sent_to_every_task(spark, documents, monkeypatch):
    docs = documents(["one two three four five six seven", "nothing here", None], ids=[4, 4, None])
    items = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    expected = [(4, 1, 2, 2)]
    assert [tuple(r)[:4] for r in dc.contained_items(docs, items).collect()] == expected
    monkeypatch.setattr(dc, "SENT_ROWS", 0)
    assert [tuple(r)[:4] for r in dc.contained_items(docs, items).collect()] == expected
    assert dc.contained_items(docs.limit(0), items).count() == dc.contained_items(docs, items.limit(0)).count() == 0
    assert dc.without_contaminated(docs, items.limit(0)).count() == 3
