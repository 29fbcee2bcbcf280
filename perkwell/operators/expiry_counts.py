"""Next expiry dates kept from a small table of counts, under inserts, updates and deletes.

The table has one row per customer and expiry date, with the number of earned entries that expire then. A
change set only adds to and takes from some of these numbers. The next expiry date is the first one ahead whose
number is positive: the minimum survives deletions without another look at the ledger.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from perkwell.functions.columns import moment
from perkwell.operators.maintenance import changed_customer, earns_with_expiry, touches_expiry

COUNTS = ("customer_id", "expiry_date", "entries")


def expiry_counts(ledger: DataFrame) -> DataFrame:
    """customer_id, expiry_date and number of earned entries of a whole ledger."""
    earned = ledger.where((F.col("points_amount") > 0) & F.col("transaction_type").isin("PURCHASE", "BONUS") & F.col("expiry_date").isNotNull())
    return earned.groupBy("customer_id", "expiry_date").agg(F.count("*").alias("entries"))


def count_changes(changes: DataFrame) -> DataFrame:
    """What a change set adds to the counts (negative where it takes away); rows whose sum is 0 are left out."""
    sides = F.array(_entry("new", 1, ("I", "U")), _entry("old", -1, ("U", "D")))
    return (
        changes.select(F.explode(F.array_compact(sides)).alias("_e")).select("_e.*")
        .groupBy("customer_id", "expiry_date").agg(F.sum("entries").alias("entries")).where("entries <> 0")
    )


def _entry(side: str, count: int, ops: tuple[str, ...]) -> Column:
    counted = F.col("op").isin(*ops) & F.coalesce(earns_with_expiry(side), F.lit(False))
    return F.when(counted, F.struct(
        F.col(f"{side}_customer_id").alias("customer_id"), F.col(f"{side}_expiry_date").alias("expiry_date"), F.lit(count).cast("long").alias("entries"),
    ))


def with_count_changes(counts: DataFrame, delta: DataFrame) -> DataFrame:
    """The table after the changes; numbers that are 0 are dropped."""
    return counts.select(*COUNTS).unionByName(delta.select(*COUNTS)).groupBy("customer_id", "expiry_date").agg(
        F.sum("entries").alias("entries")
    ).where("entries <> 0")


def next_expiry(counts: DataFrame, touched: DataFrame, as_of: datetime) -> DataFrame:
    """customer_id and the next date after ``as_of``, NULL where none is ahead, of the ``touched`` customers."""
    ahead = counts.where((F.col("expiry_date") > moment(as_of)) & (F.col("entries") > 0)).join(touched, "customer_id", "left_semi")
    return touched.select("customer_id").join(
        ahead.groupBy("customer_id").agg(F.min("expiry_date").alias("points_expiry_date")), "customer_id", "left"
    )


def recalc_points_expiry(changes: DataFrame, counts: DataFrame, customers: DataFrame, as_of: datetime) -> DataFrame:
    """Next expiry date of customers whose earned points changed; ``counts`` is the table after the changes.

    The same rows as ``maintenance.recalc_points_expiry`` gives from the whole ledger.
    """
    touched = changes.where(touches_expiry()).select(changed_customer().alias("customer_id")).distinct()
    return next_expiry(counts, customers.select("customer_id").join(touched, "customer_id", "left_semi"), as_of)
