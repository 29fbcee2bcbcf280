"""What new ledger entries set off: balances, expiry dates, tiers, history and vouchers."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from perkwell.operators.maintenance import (
    assign_on_tier_change, log_tier_changes, recalc_points_expiry, recalc_tier, sync_points_balance,
)
from perkwell.sources.checkpoints import cut


def points_cascade(
    changes: DataFrame, ledger: DataFrame, customers: DataFrame, tiers: DataFrame, promotions: DataFrame,
    holdings: DataFrame, as_of: datetime,
) -> dict[str, DataFrame]:
    """All deltas that follow from a set of ledger changes.

    ``ledger`` is the ledger after the changes. The changed customers feed four
    results, so they are written once.
    """
    expiry = recalc_points_expiry(changes, ledger, customers, as_of)
    return cascade_effects(sync_points_balance(changes, customers), expiry, customers, tiers, promotions, holdings, as_of)


def cascade_effects(
    balances: DataFrame, expiry: DataFrame, customers: DataFrame, tiers: DataFrame, promotions: DataFrame,
    holdings: DataFrame, as_of: datetime,
) -> dict[str, DataFrame]:
    """What follows from changed balances (customer_id, old_balance, points_balance) and expiry dates."""
    balances = cut(balances.join(customers.select("customer_id", "tier_id", "points_expiry_date"), "customer_id"))
    updates = cut(recalc_tier(balances, tiers))
    changed = (
        balances.join(
            expiry.select("customer_id", F.col("points_expiry_date").alias("_next"), F.lit(True).alias("_redated")),
            "customer_id", "left",
        )
        .join(updates.select("customer_id", "new_tier_id"), "customer_id", "left")
        .select(
            "customer_id", "old_balance", "points_balance",
            F.when(F.col("_redated"), F.col("_next")).otherwise(F.col("points_expiry_date"))
            .alias("points_expiry_date"),
            F.coalesce("new_tier_id", "tier_id").alias("tier_id"),
        )
    )
    return {
        "customers": changed,
        "membership_history": log_tier_changes(updates, as_of),
        "customer_promotions": assign_on_tier_change(updates, promotions, tiers, holdings, as_of),
    }


def inserts_as_changes(entries: DataFrame) -> DataFrame:
    """New ledger entries in the shape of a change set."""
    def new(name: str, kind: str):
        col = F.col(name) if name in entries.columns else F.lit(None)
        return col.cast(kind).alias(f"new_{name}")

    kinds = {"customer_id": "long", "points_amount": "long", "transaction_type": "string",
             "expiry_date": "timestamp_ntz"}
    return entries.select(
        F.lit("I").alias("op"), *[new(n, k) for n, k in kinds.items()],
        *[F.lit(None).cast(k).alias(f"old_{n}") for n, k in kinds.items()],
    )
