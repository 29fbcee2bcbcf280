import hashlib
import math
import random

import numpy as np
import pytest

from perkwell.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int, code string, `_salt` int"


def plain_way(rows, plan):
    kept = [(i, [math.floor(plan.scale * float(np.float32(x))) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = len(kept[0][1]) // plan.parts
    cutup = [[v[p * w:(p + 1) * w] for p in range(plan.parts)] for _, v, _ in kept]
    books = [[cutup[e][p][:] for e in range(min(plan.entries, len(kept)))] for p in range(plan.parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(book))

    for _ in range(plan.rounds):
        for p in range(plan.parts):
            held = [near(v[p], books[p])[1] for v in cutup]
            for e in range(len(books[p])):
                mine = [v[p] for v, h in zip(cutup, held, strict=True) if h == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    last = [[near(v[p], books[p]) for p in range(plan.parts)] for v in cutup]
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    errors = [sum(d for d, _ in n) for n in last]
    labels = {}
    for (_, _, lab), e in zip(kept, errors, strict=True):
        labels[lab] = labels.get(lab, 0) + e
    return sorted(repr((r[0], "".join(f"{e:02x}" for _, e in n), x, labels[r[2]], digest)) for r, n, x in zip(kept, last, errors, strict=True))


@pytest.mark.parametrize("kind", ["spread", "ties", "few"])
def test_equal_to_the_plain_way(spark, kind):
    rng = random.Random(5)
    plan = vc.Plan(parts=4, entries=6, rounds=4, scale=4 if kind == "ties" else 4096)
    values = (lambda: rng.choice([-1.0, -0.3, 0.0, 0.5, 1.0])) if kind == "ties" else (lambda: rng.gauss(0, 3))
    rows = [(k * 3, [values() for _ in range(8)], rng.choice([None, 1, 2, -5])) for k in range(4 if kind == "few" else 150)]
    rows += [(3, rows[1][1], 1), (None, rows[2][1], None), (1000, None, 1), (1001, [None] * 8, 1), (1002, [float("nan")] * 8, 2), (1003, [float("inf")] * 8, 2)]
    got = vc.vector_codes(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3), plan).collect()
    assert sorted(repr(tuple(r)) for r in got) == plain_way(rows, plan)


def test_vectors_that_cannot_be_coded_come_back_without_code(spark):
    rows = [(1, [0.5] * 16, 1, "x", 1), (2, [0.5] * 8, 1, "x", 1), (3, [1e9] * 16, 2, "x", 1), (4, [], None, "x", 1), (5, [0.25] * 16, None, "x", 1), (0, [0.1] * 15, None, "x", 1)]
    got = {r.vec_id: r for r in vc.vector_codes(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {i: r.code for i, r in got.items()} == {0: None, 1: "00" * 8, 2: None, 3: None, 4: None, 5: "01" * 8}
    assert vc.vector_codes(spark.createDataFrame(rows[3:4], SCHEMA)).collect()[0].code is None
    assert vc.vector_codes(spark.createDataFrame([], SCHEMA)).count() == 0


def test_any_start_leads_to_the_nearest_entry():
    rng = np.random.default_rng(2)
    for spread in (2, 50, 10_000):
        x, entries = rng.integers(-spread, spread, (400, 3)), rng.integers(-spread, spread, (16, 3))
        entries[5] = entries[9]
        distance = ((x[:, None] - entries[None]) ** 2).sum(2)
        held, least = vc.nearest(x, entries, rng.integers(0, 16, 400))
        assert held.tolist() == distance.argmin(1).tolist() and least.tolist() == distance.min(1).tolist()


def test_far_entries_are_not_compared(monkeypatch):
    rng = np.random.default_rng(3)
    entries = rng.integers(-10**6, 10**6, (16, 4))
    held = rng.integers(0, 16, 2000)
    x = entries[held] + rng.integers(-50, 50, (2000, 4))
    compared = []
    monkeypatch.setattr(vc, "squared", lambda a, b, was=vc.squared: compared.append(np.broadcast(a, b).shape[0] if a.ndim == 2 else 0) or was(a, b))
    vc.nearest(x, entries, held)
    assert sum(compared) == 2000
