import hashlib
import random

from perkwell.llm import spotsigs
from perkwell.llm.spotsigs import ANCHORS, edit_report, fingerprints, similar_documents


def plain(text):
    words, word = [], ""
    for c in (text or "").lower() + " ":
        if c.isalnum():
            word += c
        elif word:
            words, word = [*words, word], ""
    content = [k for k, w in enumerate(words) if w not in ANCHORS]
    out = set()
    for k, w in enumerate(words):
        if w in ANCHORS:
            ahead = [words[c] for c in content if c > k][:spotsigs.CHAIN]
            out.add(":".join([w, *ahead, *[""] * (spotsigs.CHAIN - len(ahead))]))
    def digest(x):
        return hashlib.md5(x.encode()).hexdigest()[:spotsigs.HASH_DIGITS]
    return sorted(map(digest, out)) or [digest(" ".join(words))]


TEXTS = [None, "", "the cat sat on the mat of doom", "the the of", "no anchors here ...", "cat the", "Der Hund und die Katze", "x" * 50_000, "the fox " * 4000, "😀 to be"]


def test_report_equals_plain_walk(documents):
    ids = [5, 3, 9, 1, 40, 22, 7, 100, 2, None]
    rows = {r.doc_id: r for r in edit_report(documents(TEXTS, ids)).collect()}
    order = sorted(range(len(ids)), key=lambda k: (ids[k] is None, -(ids[k] or 0)))
    for place, k in enumerate(order):
        text, after = TEXTS[k] or "", TEXTS[order[(place + 1) % len(order)]] or ""
        third = len(text) // 3
        edited = text[:len(text) - third] + after[:third]
        a, e, n = set(plain(text)), set(plain(edited)), set(plain(after))
        r = rows[ids[k]]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == ("".join(plain(text)), "".join(plain(edited)))
        assert (r.near_edited, r.near_next) == (len(a & e) / len(a | e), len(a & n) / len(a | n))


def test_next_document_across_blocks(documents):
    ids = [*range(0, 3000, 7), 10_000, 10_001, 90_000]
    docs = documents([f"t{i}" for i in ids], ids)
    rows = spotsigs.with_next(docs, rows_per_block=5).collect()
    follow = dict(zip(sorted(ids, reverse=True), sorted(ids, reverse=True)[1:] + [max(ids)], strict=True))
    assert {r.doc_id: r.next_text for r in rows} == {i: f"t{j}" for i, j in follow.items()}
    assert edit_report(docs.limit(0)).count() == 0
    assert edit_report(documents(["the a b", "the a b"], [1, 1])).count() == 2


def test_similar_documents_equal_all_pairs(documents):
    rng = random.Random(2)
    texts = []
    for _ in range(15):
        base = [w for _ in range(60) for w in ("the", f"n{rng.randrange(500)}", f"m{rng.randrange(500)}")]
        for k in (0, 0, 1, 3, 10):
            copy = list(base)
            for i in rng.sample(range(len(copy)), k):
                copy[i] = "zz"
            texts.append(" ".join(copy))
    prints = fingerprints(documents(texts))
    sets = {}
    for k, t in enumerate(texts):
        sets.setdefault(tuple(plain(t)), k)
    reps = [(k, set(s)) for s, k in sets.items()]
    expected = {(a, b) for a, x in reps for b, y in reps if a < b and len(x & y) / len(x | y) >= 0.8}
    assert {(r.a, r.b) for r in similar_documents(prints).collect()} == expected
