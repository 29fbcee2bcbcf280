"""Offers not held, by chunked bitmaps, against plain sets."""

import random
from datetime import datetime

from pyspark.sql import functions as F

from perkwell.operators import maintenance, vouchers
from perkwell.operators.vouchers import offers_not_held


def test_equal_to_plain_sets(spark):
    rng = random.Random(4)
    people = [(c, rng.choice([None, 1, 2, 3, 9]), "x") for c in range(60)]
    offers = [(rng.choice([None, 1, 2, 9]), p) for p in range(300)]
    held = [(c, rng.randrange(320)) for c in range(60) for _ in range(40)]
    got = offers_not_held(
        spark.createDataFrame(people, "customer_id long, tier_id long, tag string"), spark.createDataFrame([(1,), (2,), (3,)], "tier_id long"),
        spark.createDataFrame(offers + offers[:5], "tier_id long, promotion_id long"), spark.createDataFrame(held, "customer_id long, promotion_id long"),
    ).collect()
    want = {
        (c, p) for c, tier, _ in people for open_to, p in offers
        if ((open_to is None and tier in (1, 2, 3)) or (open_to is not None and open_to == tier)) and (c, p) not in set(held)
    }
    assert len(got) == len(want) and {(r.customer_id, r.promotion_id) for r in got} == want


def test_a_hundred_thousand_offers(spark):
    people = spark.range(40).selectExpr("id AS customer_id", "id % 2 AS tier_id")
    offers = spark.range(100_000).selectExpr("CASE WHEN id % 4 = 0 THEN NULL ELSE id % 2 END AS tier_id", "id AS promotion_id")
    held = spark.range(40).selectExpr("id AS customer_id", "explode(sequence(0L, 99950L, 50L)) AS promotion_id")
    fresh = offers_not_held(people, spark.range(2).withColumnRenamed("id", "tier_id"), offers, held)
    # Of each tier: 25,000 open offers and its own, without every 50th.
    assert {r.tier_id: r.n for r in fresh.groupBy("tier_id").agg({"*": "count"}).toDF("tier_id", "n").collect()} == {
        0: 20 * (50_000 - 2_000), 1: 20 * (75_000 - 1_000)}
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_tasks_follow_the_pairs_given(spark, monkeypatch):
    monkeypatch.setattr(vouchers, "PAIRS_TOGETHER", 100_000, raising=False)
    people = spark.range(2_000).selectExpr("id AS customer_id", "id % 2 AS tier_id")
    offers = spark.range(3_000).selectExpr("CASE WHEN id % 3 = 0 THEN NULL ELSE id % 2 END AS tier_id", "id AS promotion_id")
    held = spark.range(2_000).selectExpr("id AS customer_id", "2 * id AS promotion_id")
    fresh = vouchers.offers_not_held(people, spark.range(2).withColumnRenamed("id", "tier_id"), offers, held)
    tasks = [r["n"] for r in fresh.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n")).collect()]
    want = {(c, p) for c in range(2_000) for p in range(3_000) if (p % 3 == 0 or p % 2 == c % 2) and p != 2 * c}
    assert sum(tasks) == len(want) and len(tasks) > 20 and max(tasks) < 1_000_000


def test_copies_of_offers_stay_in_proportion(spark, monkeypatch):
    monkeypatch.setattr(vouchers, "PAIRS_TOGETHER", 1_000, raising=False)
    told, join = [], vouchers.dealt_join

    def spied(*args):
        told.append({r["_for"]: r["_parts"] for r in args[-1].collect()})
        return join(*args)

    monkeypatch.setattr(vouchers, "dealt_join", spied)
    people = spark.range(100).selectExpr("id AS customer_id", "1L AS tier_id")
    offers = spark.range(20_000).selectExpr("1L AS tier_id", "id AS promotion_id")
    held = spark.createDataFrame([(5, 7)], "customer_id long, promotion_id long")
    fresh = offers_not_held(people, spark.range(3).withColumnRenamed("id", "tier_id"), offers, held)
    # 2 million pairs would be 2,000 tasks with all 20,000 offers each.
    assert told[0]["1"] <= 100 and fresh.count() == 100 * 20_000 - 1


def test_people_meet_a_chunk_together(spark):
    people = spark.range(200).selectExpr("id AS customer_id", "1L AS tier_id")
    offers = spark.range(1_280).selectExpr("1L AS tier_id", "id AS promotion_id")
    held = spark.createDataFrame([], "customer_id long, promotion_id long")
    got = offers_not_held(people, spark.range(3).withColumnRenamed("id", "tier_id"), offers, held).collect()
    assert len({(r.customer_id, r.promotion_id) for r in got}) == len(got) == 200 * 1_280
    # Neighbouring rows seldom go over to other chunks: people by people they would do so 4,000 times.
    changes = sum(a.promotion_id // 64 != b.promotion_id // 64 for a, b in zip(got, got[1:], strict=False))
    assert changes < 200


def test_people_without_id_or_alike_are_dealt_too(spark, monkeypatch):
    monkeypatch.setattr(vouchers, "PAIRS_TOGETHER", 2_000, raising=False)
    people = spark.range(400).selectExpr("CASE WHEN id % 2 = 0 THEN 7L END AS customer_id", "1L AS tier_id")
    offers = spark.range(100).selectExpr("CASE WHEN id % 2 = 0 THEN 1L END AS tier_id", "id AS promotion_id")
    held = spark.createDataFrame([(7, 3), (None, 4)], "customer_id long, promotion_id long")
    fresh = offers_not_held(people, spark.range(3).withColumnRenamed("id", "tier_id"), offers, held)
    tasks = [r["n"] for r in fresh.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n")).collect()]
    assert sum(tasks) == 200 * 100 + 200 * 99 and len(tasks) > 4


def test_tier_changes_bring_chunks_together_too(spark):
    updates = spark.range(150).selectExpr("id AS customer_id", "CASE WHEN id % 3 > 0 THEN 2L END AS old_tier_id", "1L AS new_tier_id")
    promotions = spark.range(960).selectExpr(
        "id AS promotion_id", "'Y' AS is_auto_assign", "CASE WHEN id % 2 = 0 THEN 1L END AS applicable_tier_id",
        "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS valid_from", "TIMESTAMP_NTZ '2024-02-01 00:00:00' AS valid_to",
    )
    held = spark.createDataFrame([(3, 10)], "customer_id long, promotion_id long")
    tiers = spark.range(1, 3).withColumnRenamed("id", "tier_id")
    got = maintenance.assign_on_tier_change(updates, promotions, tiers, held, datetime(2024, 1, 20)).collect()
    want = {(c, p, "TIER_UPGRADE" if c % 3 else "AUTO_TIER") for c in range(150) for p in range(960)} - {(3, 10, "AUTO_TIER")}
    assert len(got) == len(want) and {(r.customer_id, r.promotion_id, r.acquisition_method) for r in got} == want
    # Open offers, the odd ones, stand before those of the tier; people by people there would be over 2,000 changes.
    chunk = [(r.promotion_id // 2 + (480 if r.promotion_id % 2 == 0 else 0)) // 64 for r in got]
    assert sum(a != b for a, b in zip(chunk, chunk[1:], strict=False)) < 300
