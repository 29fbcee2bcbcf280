"""Tier lookup by points, for any number of tiers.

Thresholds and points are merged in one order: the different points that occur and the thresholds of all tiers are
range-partitioned together, and each block carries the last threshold of the blocks before it forward. Tiers are
never gathered, and of the rows only their different points are put in order, so many customers with the same points
cost one entry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from perkwell.operators.ordering import BLOCK, PLACE, place_in_order

_POINTS, _VALUE = "_at_points", "_reached"


def with_tier_by_points(rows: DataFrame, points: str, tiers: DataFrame, name: str) -> DataFrame:
    """Add the reached tier with the most required points; NULL if none is reached."""
    return _with_reached(rows, points, tiers, F.struct("points_required", "tier_id"), name, F.col(_VALUE)["tier_id"])


def with_highest_reached_tier(rows: DataFrame, points: str, tiers: DataFrame, name: str) -> DataFrame:
    """Add the largest tier id among the reached tiers; NULL if none is reached."""
    return _with_reached(rows, points, tiers, F.col("tier_id"), name, F.col(_VALUE))


def _with_reached(rows: DataFrame, points: str, tiers: DataFrame, value: Column, name: str, found: Column) -> DataFrame:
    known = tiers.where(F.col("points_required").isNotNull() & F.col("tier_id").isNotNull())
    steps = known.select(F.col("points_required").cast("long").alias(_POINTS), F.lit(0).alias("_kind"), value.alias(_VALUE))
    asked = rows.select(F.col(points).cast("long").alias(_POINTS)).where(F.col(_POINTS).isNotNull()).distinct()
    merged = steps.unionByName(asked.withColumn("_kind", F.lit(1)), allowMissingColumns=True)
    # A threshold stands before the points that just reach it.
    placed = place_in_order(merged, [_POINTS, "_kind"])
    # One row per block.
    earlier = Window.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    carried = placed.groupBy(BLOCK).agg(F.max(_VALUE).alias("_own")).select(BLOCK, F.max("_own").over(earlier).alias("_before"))
    upto = Window.partitionBy(BLOCK).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, 0)
    reached = placed.join(carried, BLOCK).select(
        _POINTS, "_kind", _later(F.max(_VALUE).over(upto), F.col("_before")).alias(_VALUE),
    ).where(F.col("_kind") == 1).select(F.col(_POINTS).alias("_level"), found.alias(name))
    return rows.join(reached, F.col(points).cast("long") == F.col("_level"), "left").drop("_level")


def _later(own: Column, before: Column) -> Column:
    """The larger of two values, either of which may be NULL."""
    return F.when(own.isNull() | (before > own), F.coalesce(before, own)).otherwise(own)
