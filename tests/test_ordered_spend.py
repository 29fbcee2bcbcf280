"""The distributed greedy against a plain loop, on both of its ways."""

import random

import pytest

from perkwell.operators.ordered_spend import spend_in_order


def brute_force(rows):
    left, accepted = {}, set()
    for key, place, amount, budget in sorted(rows):
        rest = left.setdefault(key, budget)
        if rest >= amount:
            left[key] = rest - amount
            accepted.add((key, place))
    return accepted


def check(spark, rows, max_group):
    df = spark.createDataFrame(rows, "k long, place long, amount long, budget long").repartition(3)
    out = spend_in_order(df, "k", ["place"], "amount", "budget", max_group=max_group)
    got = out.collect()
    assert len(got) == len(rows)
    assert {(r.k, r.place) for r in got if r.accepted} == brute_force(rows)


@pytest.mark.parametrize("max_group", [1, 40, 1000])
def test_matches_a_plain_loop(spark, max_group):
    rng = random.Random(7)
    rows = []
    for key in range(12):
        budget = rng.choice([0, 1, 5, 64, 100, 1023])
        top = rng.choice([3, 40, 150])
        rows += [(key, place, rng.randrange(0, top), budget) for place in range(rng.choice([1, 30, 90]))]
    check(spark, rows, max_group)


def test_alternating_small_and_too_large_entries(spark):
    rows = []
    for i in range(40):
        rows += [(1, 2 * i, 1, 100), (1, 2 * i + 1, 100 - i, 100)]
    check(spark, rows, 10)


def test_one_key_holds_most_rows(spark):
    rng = random.Random(3)
    rows = [(0, place, rng.randrange(1, 5000), 40000) for place in range(3000)]
    rows += [(1 + place % 50, place, rng.randrange(1, 90), 200) for place in range(1000)]
    check(spark, rows, 100)
