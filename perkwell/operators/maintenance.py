"""Upkeep of derived columns after changes, as batch functions of a change set.

A change set has one row per inserted (I), updated (U) or deleted (D) row with
its ``new_`` and ``old_`` values. The streaming jobs call the same functions.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from perkwell.functions.columns import MONEY, TOTAL, joined_text, moment, plus_months
from perkwell.functions.tiers import with_tier_by_points
from perkwell.operators.audit import activity_rows
from perkwell.operators.vouchers import live_offers, offers_not_held

BIRTHDAY_TEXT = "Birthday reward points"
BIRTHDAY_MONTHS = 12


def changed_customer() -> Column:
    """The customer a change counts for: the new one, or the old one of a deleted row."""
    return F.when(F.col("op") == "D", F.col("old_customer_id")).otherwise(F.col("new_customer_id"))


def changed_points() -> Column:
    """The points a change adds; an update counts the difference for the new customer."""
    new, old = F.col("new_points_amount"), F.col("old_points_amount")
    return (
        F.when(F.col("op") == "I", new)
        .when(F.col("op") == "U", new - F.coalesce(old, F.lit(0)))
        .otherwise(-old)
    )


def points_change(changes: DataFrame) -> DataFrame:
    """Net points per customer."""
    return changes.groupBy(changed_customer().alias("customer_id")).agg(F.sum(changed_points()).alias("points_change"))


def sync_points_balance(changes: DataFrame, customers: DataFrame) -> DataFrame:
    """Old and new balance of every customer the changes touch."""
    return (
        customers.select("customer_id", F.col("points_balance").alias("old_balance"))
        .join(points_change(changes), "customer_id")
        .select(
            "customer_id", "old_balance", (F.col("old_balance") + F.col("points_change")).alias("points_balance")
        )
    )


def earns_with_expiry(side: str) -> Column:
    return (
        (F.col(f"{side}_points_amount") > 0)
        & F.col(f"{side}_transaction_type").isin("PURCHASE", "BONUS")
        & F.col(f"{side}_expiry_date").isNotNull()
    )


def touches_expiry() -> Column:
    """Whether a change may move the customer's next expiry date."""
    return (
        F.when(F.col("op") == "I", earns_with_expiry("new"))
        .when(F.col("op") == "U", F.coalesce(earns_with_expiry("new"), F.lit(False)) | earns_with_expiry("old"))
        .otherwise(earns_with_expiry("old"))
    )


def recalc_points_expiry(changes: DataFrame, ledger: DataFrame, customers: DataFrame, as_of: datetime) -> DataFrame:
    """Next expiry date of customers whose earned points changed; NULL when none is ahead.

    ``ledger`` is the whole ledger after the changes.
    """
    touched = changes.where(touches_expiry()).select(changed_customer().alias("customer_id")).distinct()
    ahead = (
        ledger.where(
            (F.col("expiry_date") > moment(as_of)) & F.col("transaction_type").isin("PURCHASE", "BONUS")
            & (F.col("points_amount") > 0)
        )
        # Only the ledger of touched customers is aggregated.
        .join(touched, "customer_id", "left_semi")
        .groupBy("customer_id").agg(F.min("expiry_date").alias("points_expiry_date"))
    )
    return (
        customers.select("customer_id").join(touched, "customer_id", "left_semi")
        .join(ahead, "customer_id", "left")
    )


def recalc_tier(customers: DataFrame, tiers: DataFrame) -> DataFrame:
    """Tier changes after a balance change: the reached tier with the most required points.

    A customer who reaches no tier keeps the present one.
    """
    return (
        with_tier_by_points(
            customers.select("customer_id", F.col("tier_id").alias("old_tier_id"), "points_balance"), "points_balance", tiers, "new_tier_id"
        )
        .where(F.col("new_tier_id") != F.col("old_tier_id"))
        .select("customer_id", "old_tier_id", "new_tier_id")
    )


def log_tier_changes(updates: DataFrame, as_of: datetime, changed_by: str = "SYSTEM") -> DataFrame:
    """A history row per tier update of (customer_id, old_tier_id, new_tier_id)."""
    old, new = F.col("old_tier_id"), F.col("new_tier_id")
    reason = (
        F.when(old.isNull(), "SIGNUP").when(new > old, "UPGRADE").when(new < old, "DOWNGRADE").otherwise("ADMIN")
    )
    return updates.select(
        "customer_id", "old_tier_id", "new_tier_id", moment(as_of).alias("change_date"),
        reason.alias("change_reason"), F.lit(changed_by).alias("changed_by"),
    )


def assign_on_tier_change(
    updates: DataFrame, promotions: DataFrame, tiers: DataFrame, holdings: DataFrame, as_of: datetime
) -> DataFrame:
    """Vouchers that a tier update brings and the customer does not hold yet."""
    moved = updates.select(
        "customer_id", F.col("new_tier_id").alias("tier_id"),
        F.when(F.col("old_tier_id").isNull(), "AUTO_TIER").otherwise("TIER_UPGRADE").alias("acquisition_method"),
    )
    fresh = offers_not_held(moved, tiers, live_offers(promotions, as_of), holdings)
    return fresh.select(
        "customer_id", "promotion_id", moment(as_of).alias("date_acquired"), F.lit("N").alias("is_used"),
        "acquisition_method",
    )


def touched_orders(changes: DataFrame) -> DataFrame:
    """Orders whose lines changed; an update counts for the order the line is now in."""
    order = F.when(F.col("op") == "D", F.col("old_order_id")).otherwise(F.col("new_order_id"))
    return changes.select(order.alias("order_id")).where(F.col("order_id").isNotNull()).distinct()


def line_totals(order_items: DataFrame) -> DataFrame:
    """Total, discount and final amount per order from its lines."""
    quantity = F.col("quantity")
    return order_items.groupBy("order_id").agg(
        F.sum(F.col("price") * quantity).cast(TOTAL).alias("total_amount"),
        F.sum(F.col("discount_applied") * quantity).cast(TOTAL).alias("discount_amount"),
        F.sum((F.col("price") - F.col("discount_applied")) * quantity).cast(TOTAL).alias("final_amount"),
    )


def sync_order_totals(changes: DataFrame, order_items: DataFrame, orders: DataFrame) -> DataFrame:
    """New header amounts of the orders whose lines changed, 0 when no line is left.

    ``order_items`` is the table after the changes. Lines are summed before the touched
    orders are picked, so an order with very many lines is reduced where its lines
    are read; Spark moves the pick below the sum when the touched set is small.
    """
    touched = touched_orders(changes)
    totals = line_totals(order_items).join(touched, "order_id", "left_semi")
    zero = F.lit(0).cast(MONEY)
    return (
        orders.select("order_id").join(touched, "order_id", "left_semi").join(totals, "order_id", "left")
        .select("order_id", *[
            F.coalesce(c, zero).cast(TOTAL).alias(c) for c in ("total_amount", "discount_amount", "final_amount")
        ])
    )


def mark_promo_used(new_redemptions: DataFrame, holdings: DataFrame, as_of: datetime) -> DataFrame:
    """Holdings that the new redemptions turn into used ones."""
    pair = ["customer_id", "promotion_id"]
    return (
        holdings.join(new_redemptions.select(pair).distinct(), pair, "left_semi")
        .withColumns({"is_used": F.lit("Y"), "used_date": moment(as_of)})
        .select(holdings.columns)
    )


def birthday_bonus(customers: DataFrame, tiers: DataFrame, ledger: DataFrame, as_of: datetime) -> dict[str, DataFrame]:
    """Bonus points for customers whose birthday is the day of ``as_of``, once a year."""
    given = ledger.where(
        (F.col("description") == BIRTHDAY_TEXT)
        & (F.col("transaction_date") >= moment(datetime(as_of.year, 1, 1)))
        & (F.col("transaction_date") < moment(datetime(as_of.year + 1, 1, 1)))
    ).select("customer_id").distinct()
    now = moment(as_of)
    bonus = (
        customers.where(
            (F.month("birth_date") == as_of.month) & (F.dayofmonth("birth_date") == as_of.day)
        )
        .select("customer_id", "tier_id")
        .join(tiers.select("tier_id", "birthday_bonus_points").where("birthday_bonus_points > 0"), "tier_id")
        .join(given, "customer_id", "left_anti")
    )
    entries = bonus.select(
        "customer_id", F.col("birthday_bonus_points").alias("points_amount"),
        F.lit("BONUS").alias("transaction_type"), F.lit(BIRTHDAY_TEXT).alias("description"),
        now.alias("transaction_date"), plus_months(now, BIRTHDAY_MONTHS).alias("expiry_date"),
    )
    text = joined_text("Received ", F.col("birthday_bonus_points"), " birthday points")
    audit = activity_rows(bonus.select("customer_id", text.alias("details")), "BIRTHDAY", as_of, "customer_id")
    return {"point_transactions": entries, "activity": audit}
