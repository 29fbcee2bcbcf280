import random

import pytest
from pyspark.sql import functions as F

from perkwell.llm.quotations import lines_of, link_quotations, runs_of

MESSAGES = [
    (1, 0, "Hello there,\n\nhow is  it?"), (1, 1, "> hello THERE,\n\nfine"), (1, 2, ">> Hello there,\n> fine\nme too"),
    (1, 3, "> nobody wrote this\nok"), (1, 4, "> how is it?\n> \n> me too\nlast"), (2, 0, "> Hello there,\nother conversation"),
    (1, 5, None), (1, 6, ""), (None, 1, "> x"), (3, 0, "same"), (3, 1, "same"), (3, 2, "> same\nend"), (3, 2, "> same\nend"),
]


def test_lines_and_passages(spark):
    texts = ["> > a\n>>b\nc", "> a\n> b\n>  \n> c\n>> d\ne", None, "", "\n\n> x\n\n"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string")
    lines = {r.k: [(x.level, x.line, x.filled) for x in r.v] for r in df.select("k", lines_of(F.col("text")).alias("v")).collect()}
    assert lines[0] == [(2, "a", True), (2, "b", True), (0, "c", True)] and lines[2] == lines[3] == [(0, "", False)]
    runs = {r.k: [(x.level, x.lines) for x in r.v] for r in df.select("k", runs_of(lines_of(F.col("text"))).alias("v")).collect()}
    assert runs == {0: [(2, ["a", "b"]), (0, ["c"])], 1: [(1, ["a", "b"]), (1, ["c"]), (2, ["d"]), (0, ["e"])], 2: [], 3: [], 4: [(1, ["x"])]}


def test_keys_of_any_type_and_long_texts(spark):
    long = "\n".join(f"line {k} of many" for k in range(20_000))
    rows = [("c-1", 0, "a", long), ("c-1", 1, "b", "\n".join("> " + x for x in long.split("\n")) + "\nseen"), ("c-2", 0, "a", "> line 7 of many")]
    got = {(r.conv_id, r.turn): r for r in link_quotations(spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")).collect()}
    assert (got["c-1", 1].reply_to, got["c-1", 1].n_quotes, got["c-1", 1].text) == (0, 1, "seen")
    assert got["c-2", 0].reply_to is None and got["c-1", 0].text == long


def plain_way(messages):
    """Own texts, replies and threads by loops over lines."""
    def norm(lines):
        return " ".join(" ".join(lines).lower().split())

    parsed = {}
    for conv, turn, text in messages:
        runs, last = [], None
        for line in text.split("\n"):
            bare = line.lstrip()
            level = 0
            while bare.startswith(">"):
                bare, level = bare[1:], level + 1
                if bare[:1] == " ":
                    bare = bare[1:]
            content = bare if level else line
            if not content.strip():
                last = None
            elif last == level:
                runs[-1][1].append(content)
            else:
                runs.append((level, [content]))
                last = level
        parsed[conv, turn] = runs
    first = {}
    for (conv, turn), runs in parsed.items():
        own = [ls for level, ls in runs if level == 0]
        flat = [x for ls in own for x in ls]
        for part in [flat, *own, *([x] for x in flat)]:
            if part:
                key = (conv, norm(part))
                first[key] = min(first.get(key, turn), turn)
    out = {}
    for (conv, turn), runs in sorted(parsed.items()):
        found = []
        for level, ls in runs:
            if level:
                options = [(0, first.get((conv, norm(ls)), turn)), *((1, first.get((conv, norm([x])), turn)) for x in ls)]
                options = [o for o in options if o[1] < turn]
                if options:
                    found.append((-level, min(options)[1]))
        reply = max(found)[1] if found else None
        thread, depth = (turn, 0) if reply is None else (out[conv, reply][1], out[conv, reply][2] + 1)
        out[conv, turn] = (reply, thread, depth, sum(level > 0 for level, _ in runs), len(found))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_equal_to_the_plain_way(spark, seed):
    rng = random.Random(seed)
    messages = []
    for conv in range(6):
        said = []
        for turn in range(12):
            lines = []
            for _ in range(rng.randrange(1, 5)):
                old = rng.choice(said) if said and rng.random() < 0.7 else None
                if old is None:
                    lines += [rng.choice(["yes", "No  way", "see you", f"fact {rng.randrange(5)}", ""])]
                else:
                    mark = rng.choice(["> ", ">", ">> ", "> > "])
                    lines += [mark + x.upper() for x in old.split("\n")] + [rng.choice(["", "so"])]
            said.append("\n".join(lines))
            messages.append((conv, turn, said[-1]))
    df = spark.createDataFrame([(c, t, "user", x) for c, t, x in messages], "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.turn): (r.reply_to, r.thread, r.depth, r.n_quotes, r.n_linked) for r in link_quotations(df).collect()}
    assert got == plain_way(messages)


def test_replies_threads_and_own_texts(spark):
    rows = spark.createDataFrame([(c, t, "user", x, 1) for c, t, x in MESSAGES], "conv_id long, turn long, role string, text string, thread int")
    got = {(r.conv_id, r.turn): r for r in link_quotations(rows).collect()}
    assert link_quotations(rows).count() == len(MESSAGES)
    view = {k: (r.reply_to, r.thread, r.depth, r.n_quotes, r.n_linked, r.text) for k, r in got.items()}
    assert view[1, 0] == (None, 0, 0, 0, 0, "Hello there,\n\nhow is  it?")
    assert view[1, 1] == (0, 0, 1, 1, 1, "fine")
    assert view[1, 2] == (1, 0, 2, 2, 2, "me too")
    assert view[1, 3] == (None, 3, 0, 1, 0, "ok")
    assert view[1, 4] == (2, 0, 3, 2, 2, "last")
    assert view[2, 0] == (None, 0, 0, 1, 0, "other conversation")
    assert view[1, 5][5] == view[1, 6][5] == "" and view[None, 1][4] == 0
    assert view[3, 2] == (0, 0, 1, 1, 1, "end")
    assert link_quotations(rows.limit(0)).count() == 0


def test_long_chain_of_replies(spark):
    rows = spark.createDataFrame([(1, k, "user", f"> line {k - 1}\nline {k}") for k in range(200)], "conv_id long, turn long, role string, text string")
    got = {r.turn: (r.thread, r.depth) for r in link_quotations(rows).collect()}
    assert got == {k: (0, k) for k in range(200)}
