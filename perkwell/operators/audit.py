"""Audit rows: how jobs report what they did, and how those rows are read back."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, functions as F

from perkwell.functions.columns import moment


def activity_rows(
    rows: DataFrame, activity_type: str, as_of: datetime, customer: str | None = None
) -> DataFrame:
    """Turn a DataFrame with a ``details`` text into audit rows; batch reports have no customer."""
    customer_id = F.col(customer) if customer else F.lit(None).cast("long")
    ip = F.col("ip_address") if "ip_address" in rows.columns else F.lit(None).cast("string")
    return rows.select(
        customer_id.alias("customer_id"), F.lit(activity_type).alias("activity_type"),
        moment(as_of).alias("activity_date"), ip.alias("ip_address"), "details",
    )


def activity_by_type(
    activity: DataFrame, activity_type: str, as_of: datetime | None = None, minutes: int | None = None
) -> DataFrame:
    """Audit rows of one type, newest first, optionally of the last ``minutes`` before ``as_of``."""
    rows = activity.where(F.col("activity_type") == activity_type)
    if minutes is not None:
        rows = rows.where(F.col("activity_date") >= moment(as_of - timedelta(minutes=minutes)))
    return rows.select("activity_id", "customer_id", "activity_type", "activity_date", "details").orderBy(
        F.desc("activity_date"), "activity_id"
    )
