import hashlib
import random
import re

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from perkwell.llm import fill_in_middle as fim


def plain_way(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    h = [int(hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()[k:k + 8], 16) for k in (0, 8, 16, 24)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, len(units), "plain", None, None, text
    if h[3] % 100 < 20:
        return doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_equal_to_the_plain_way(spark, documents):
    rng = random.Random(3)
    letters = "abzAZ@[`{ 09é日😀\n<>PSM\0\x7f"
    texts = [None, "", "a", "é", "😀", "abcdefgh", "abcdefg😀", "<P>", "a <S> b", "x <M> y", "<<P", "word " * 3000, "é" * 5000, "z" * 9000]
    texts += ["".join(rng.choices(letters, k=rng.randrange(1, 60))) for _ in range(300)]
    texts += [texts[20], texts[21]]
    ids = [*range(len(texts) - 2), 20, None]
    out = fim.fill_in_middle(documents(texts, ids)).withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    assert sorted(map(repr, (tuple(r)[:6] for r in out))) == sorted(repr(plain_way(i, t)) for i, t in zip(ids, texts, strict=True))
    assert sorted(r.back for r in out) == sorted(t or "" for t in texts)
    assert {r.form for r in out} == {"plain", "psm", "spm"}


def test_no_documents(documents):
    assert fim.fill_in_middle(documents([None]).limit(0)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("aZ@[`{ é日😀\0\x80"), max_size=40), min_size=1, max_size=6), st.integers(0, 50))
def test_every_unit_end_is_found(texts, wanted):
    raw = [t.encode() for t in texts]
    units = [re.findall(r"[A-Za-z]+|[^A-Za-z]", t) for t in texts]
    n, first, second = fim.unit_cuts(raw, lambda found: (np.minimum(wanted, found), found))
    assert n.tolist() == [len(u) for u in units]
    assert first.tolist() == [len("".join(u[:wanted]).encode()) for u in units]
    assert second.tolist() == [len(r) for r in raw]
