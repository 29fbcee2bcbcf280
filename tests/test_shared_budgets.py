"""Requests on several shared budgets against a plain loop."""

import random

import pytest

from perkwell.operators import shared_budgets
from perkwell.operators.shared_budgets import Budget, serve_in_order

BUDGETS = [Budget("a", "x", "la", "A"), Budget("b", "y", "lb", "B"), Budget("c", "z", "lc", "C")]
SCHEMA = "n long, a long, x long, la long, b long, y long, lb long, c string, z int, lc int, late string"


def loop(rows):
    left, out = {}, {}
    for n, a, x, la, b, y, lb, c, z, lc, late in sorted(rows, key=lambda r: r[0]):
        asked = [(k, key, amount, left.setdefault((k, key), limit)) for k, key, amount, limit in (("A", a, x, la), ("B", b, y, lb), ("C", c, z, lc)) if key is not None]
        short = [k for k, _, amount, rest in asked if rest < amount]
        out[n] = short[0] if short else late
        if out[n] is None:
            for k, key, amount, rest in asked:
                left[k, key] = rest - amount
    return out


@pytest.mark.parametrize("seed", range(4))
def test_matches_a_plain_loop(spark, seed, monkeypatch):
    monkeypatch.setattr(shared_budgets, "WAVES_TOGETHER", 3)
    rng = random.Random(seed)
    limit = {("a", k): rng.randrange(0, 200) for k in range(8)} | {("b", k): rng.randrange(0, 80) for k in range(10)}
    rows = []
    for n in rng.sample(range(1000), 240):
        # One customer holds half of all requests.
        a, b = 0 if rng.random() < 0.5 else rng.randrange(8), rng.choice([None, None, *range(10)])
        rows.append((n, a, rng.choice([0, 3, 7, 30]), limit["a", a], b, rng.randrange(0, 25), None if b is None else limit["b", b],
                     rng.choice([None, f"{a}:{rng.randrange(9)}"]), 1, 1, "LATE" if rng.random() < 0.1 else None))
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = serve_in_order(df, ["n"], BUDGETS, late="late").collect()
    assert {r.n: r.reason for r in got} == loop(rows) and len(got) == len(rows)


def test_no_requests(spark):
    assert serve_in_order(spark.createDataFrame([], SCHEMA), ["n"], BUDGETS).count() == 0


def test_a_hot_budget_takes_few_waves(spark, monkeypatch):
    waves = []
    monkeypatch.setattr(shared_budgets, "_wave", lambda *a, was=shared_budgets._wave: waves.append(1) or was(*a))
    rows = spark.range(200_000).selectExpr("id AS n", "0L AS a", "CAST(100 * (1 + id % 3) AS LONG) AS x", "5000000L AS la")
    got = serve_in_order(rows, ["n"], [BUDGETS[0]])
    assert got.where("reason IS NULL").selectExpr("sum(x)").first()[0] <= 5_000_000 and len(waves) < 10


def test_only_tight_budgets_go_through_the_waves(spark, monkeypatch):
    met = []
    monkeypatch.setattr(shared_budgets, "_wave", lambda live, *a, was=shared_budgets._wave: met.append(live.count()) or was(live, *a))
    # Customer 0 asks for more than there is, and meets customer 1 in an order with room for both.
    rows = [(n, n % 50, 10, 35 if n % 50 == 0 else 40, n % 50 // 2, 5, 1000, None, 0, 0, "LATE" if n == 7 else None) for n in range(200)]
    got = serve_in_order(spark.createDataFrame(rows, SCHEMA), ["n"], BUDGETS, late="late").collect()
    assert {r.n: r.reason for r in got} == loop(rows) and len(got) == len(rows)
    assert max(met) == 4
