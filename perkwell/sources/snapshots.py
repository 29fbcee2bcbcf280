"""Reading and writing loyalty tables as parquet snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from perkwell.schemas import SCHEMAS

# Tables that only grow, with the column that dates a row.
EVENT_DATES = {
    "orders": "order_date", "point_transactions": "transaction_date", "membership_history": "change_date",
    "redemptions": "redemption_date", "customer_activity": "activity_date",
}


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table of the snapshot ``root`` with its declared columns; no schema is inferred."""
    return spark.read.schema(SCHEMAS[table]).parquet(f"{root}/{table}").select(SCHEMAS[table].names)


def write_snapshot(rows: DataFrame, root: str, table: str) -> None:
    """Write a table into a new snapshot; an existing one is never overwritten.

    Tables with an event date are laid out by day so that date filters skip files.
    """
    date = EVENT_DATES.get(table)
    if date is None:
        rows.write.mode("errorifexists").parquet(f"{root}/{table}")
    else:
        _by_day(rows, date).mode("errorifexists").parquet(f"{root}/{table}")


def append_events(rows: DataFrame, root: str, table: str) -> None:
    """Add event rows to a table that only grows."""
    _by_day(rows, EVENT_DATES[table]).mode("append").parquet(f"{root}/{table}")


def _by_day(rows: DataFrame, date: str):
    return rows.withColumn("day", F.to_date(date)).write.partitionBy("day")


def with_updates(rows: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The next state of ``rows``: columns of ``updates`` replace those of the row with the same keys.

    ``updates`` has at most one row per key. A NULL in an update is written as NULL.
    """
    changed = [c for c in updates.columns if c not in keys and c in rows.columns]
    fresh = updates.select(*keys, F.struct(*changed).alias("_new"), F.lit(True).alias("_hit"))
    return rows.join(fresh, list(keys), "left").select([
        F.when(F.col("_hit"), F.col("_new")[c]).otherwise(F.col(c)).alias(c) if c in changed else F.col(c)
        for c in rows.columns
    ])
