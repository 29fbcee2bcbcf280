import random
import time

import numpy as np
import pyarrow as pa
import pytest

from perkwell.llm import repeated_bytes as rb


def brute_force(rows):
    first = {}
    for i, b in rows:
        for k in range(len(b) - rb.LENGTH + 1):
            key = b[k:k + rb.LENGTH]
            first[key] = min(first.get(key, rb.NO_ID), i)
    out = []
    for i, b in rows:
        gone = bytearray(len(b))
        for k in range(len(b) - rb.LENGTH + 1):
            if first[b[k:k + rb.LENGTH]] < i:
                gone[k:k + rb.LENGTH] = b"\1" * rb.LENGTH
        out.append((i, len(b), bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return sorted(out)


@pytest.mark.parametrize(("part_bytes", "hot"), [(2_000, 1 << 12), (1 << 23, 1 << 12), (2_000, 1), (1 << 23, 3)])
def test_equal_to_brute_force(documents, monkeypatch, part_bytes, hot):
    monkeypatch.setattr(rb, "PART_BYTES", part_bytes)
    monkeypatch.setattr(rb, "HOT_SEGMENTS", hot)
    rng = random.Random(7)
    passage = "".join(rng.choices("abcdé ", k=120))
    texts = [None, "", "short", "x" * 5000, "x" * 49, "ab" * 600, passage, passage * 2]
    texts += ["".join(rng.choices("abc ", k=rng.randrange(300))) + passage[rng.randrange(50):rng.randrange(60, 120)] + "".join(rng.choices("ab", k=40)) for _ in range(60)]
    texts += [texts[20], texts[30], texts[30], texts[40][10:]]
    texts += ["x" * 400 + passage[:70], None]
    ids = [*range(len(texts) - 2), 5, None]
    rows = [(rb.NO_ID if i is None else i, (t or "").encode()) for i, t in zip(ids, texts, strict=True)]
    got = rb.remove_repeated(documents(texts, ids)).collect()
    assert sorted((rb.NO_ID if r.doc_id is None else r.doc_id, r.n_bytes, bytes(r.kept)) for r in got) == brute_force(rows)
    for r in got:
        assert sum(s.stop - s.start for s in r.spans) == r.n_bytes - len(r.kept)
        assert all(a.stop < b.start for a, b in zip(r.spans, r.spans[1:], strict=False))


def test_no_documents(documents):
    assert rb.remove_repeated(documents([None]).limit(0)).count() == 0


@pytest.mark.parametrize("with_heads", [False, True])
@pytest.mark.parametrize("size", [40, 3000])
def test_marks_are_the_short_common_prefixes(size, with_heads):
    rng = np.random.default_rng(1)
    data = np.concatenate([rng.integers(97, 99, size), np.tile(rng.integers(97, 99, 70), 3), [rb.SEPARATOR]]).astype(np.uint8)
    order = rb.suffix_order(data)
    raw = data.tobytes()
    marks = rb.apart(data[order - 1], rb.LENGTH, rb.heads_of(data)[order] if with_heads else None)
    for k in range(1, len(data)):
        a, b = raw[order[k - 1]:][:rb.LENGTH], raw[order[k]:][:rb.LENGTH]
        assert bool(marks[k]) == (a != b)
        assert a <= b


@pytest.mark.parametrize("portion", [1, 3_000])
def test_few_buckets_in_portions(documents, monkeypatch, portion):
    for name, value in {"PART_BYTES": 1_000, "LEAST_BUCKETS": 2, "BUCKETS_TOGETHER": 50, "PORTION_BYTES": portion, "SLICE_BYTES": 500}.items():
        monkeypatch.setattr(rb, name, value, raising=False)
    rng = random.Random(3)
    passages = ["".join(rng.choices("abcdé ", k=90)) for _ in range(12)]
    texts = ["".join(rng.choices("ab ", k=rng.randrange(80))) + "".join(rng.sample(passages, 2)) + "y" * rng.randrange(130) for _ in range(90)]
    assert 2 <= rb.buckets_of(len(texts)) < len(texts)
    got = rb.remove_repeated(documents(texts, list(range(len(texts))))).collect()
    rows = [(i, t.encode()) for i, t in enumerate(texts)]
    assert sorted((r.doc_id, r.n_bytes, bytes(r.kept)) for r in got) == brute_force(rows)


def test_many_parts_cost_a_bucket_no_more_than_their_minimizers():
    values = np.sort(np.random.default_rng(5).integers(0, 1 << 63, 200_000).astype(np.uint64))

    def seconds(parts):
        payload = [x.tobytes() for x in np.array_split(values, parts)]
        table = rb._rows(list(range(parts)), 0, [0] * parts, payload)
        began = time.process_time()
        out = rb._shared(1 << 12)(table)
        assert isinstance(out, pa.Table)
        return time.process_time() - began

    seconds(10)
    assert seconds(4_000) < 8 * max(seconds(10), 0.02)


def test_rows_between_parts_and_buckets():
    # Each part writes a row to each bucket: four times the parts were 5.8 million rows for 1,200 parts (10 GB of text).
    assert 1_200 * rb.buckets_of(1_200) < 1_000_000
    assert [rb.buckets_of(n) for n in (1, 3, 64)] == [4, 12, 256]
