"""Membership reports, scores and jobs.

Every function takes DataFrames and an ``as_of`` time and returns DataFrames.
Joins carry no broadcast hints: Spark broadcasts a side when its measured size
allows and shuffles both sides otherwise.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from perkwell.functions.columns import (
    day_start, floor_days, joined_text, moment, number_text, plus_days, plus_months, strict_greatest,
)
from perkwell.functions.tiers import with_highest_reached_tier
from perkwell.operators.audit import activity_rows
from perkwell.operators.ordered_spend import spend_in_order

RENEWAL_TYPES = ("EXPIRED_ONLY", "URGENT", "ALL_DUE")


def _next_tier(tiers: DataFrame) -> DataFrame:
    """Tiers keyed by the tier below them; the next tier is the next id, not the next threshold."""
    return tiers.select((F.col("tier_id") - 1).alias("tier_id"), *[
        F.col(name).alias(f"next_{name}")
        for name in ("tier_id", "tier_name", "points_required", "discount_percentage", "renewal_fee")
    ])


def upcoming_renewals(customers: DataFrame, tiers: DataFrame, as_of: datetime) -> DataFrame:
    """Members with days to expiry, fee and renewal status, soonest expiry first."""
    now = moment(as_of)
    expiry = F.col("membership_expiry_date")
    status = (
        F.when(expiry <= now, "EXPIRED")
        .when(expiry <= plus_days(now, 7), "URGENT")
        .when(expiry <= plus_days(now, 30), "UPCOMING")
        .otherwise("ACTIVE")
    )
    return (
        customers.where(F.col("is_member") == "Y")
        .join(tiers.select("tier_id", "tier_name", "renewal_fee"), "tier_id")
        .select(
            "customer_id", "name", "email", "tier_name", "membership_expiry_date",
            floor_days(expiry, now).alias("days_until_expiry"), "renewal_fee", status.alias("renewal_status"),
        )
        .orderBy(F.asc_nulls_last("membership_expiry_date"), "customer_id")
    )


def tier_comparison(customers: DataFrame, tiers: DataFrame) -> DataFrame:
    """Each customer's tier beside the next one: points, discount and fee differences."""
    balance = F.col("points_balance")
    status = (
        F.when(F.col("next_tier_id").isNull(), "MAX_TIER")
        .when(balance >= F.col("next_points_required"), "ELIGIBLE_NOW")
        .otherwise("NEEDS_MORE_POINTS")
    )
    return (
        customers.select("customer_id", "name", "tier_id", "points_balance")
        .join(tiers.select("tier_id", "tier_name", "discount_percentage", "renewal_fee"), "tier_id")
        .join(_next_tier(tiers), "tier_id", "left")
        .select(
            "customer_id", "name", F.col("tier_name").alias("current_tier"), "points_balance",
            F.col("next_tier_name").alias("next_tier"),
            (F.col("next_points_required") - balance).alias("points_needed"),
            (F.col("next_discount_percentage") - F.col("discount_percentage")).alias("additional_discount"),
            (F.col("next_renewal_fee") - F.col("renewal_fee")).alias("fee_change"),
            status.alias("upgrade_status"),
        )
    )


def customer_status(customers: DataFrame, tiers: DataFrame) -> DataFrame:
    """Balance, current and next tier requirements and the points still needed."""
    return (
        customers.select("customer_id", "name", "tier_id", "points_balance")
        .join(tiers.select("tier_id", "tier_name", "points_required"), "tier_id")
        .join(_next_tier(tiers), "tier_id", "left")
        .select(
            "customer_id", "name", "points_balance", F.col("tier_name").alias("current_tier"),
            F.col("points_required").alias("current_tier_requirement"),
            F.col("next_tier_name").alias("next_tier"),
            F.col("next_points_required").alias("next_tier_requirement"),
            (F.col("next_points_required") - F.col("points_balance")).alias("points_needed"),
        )
    )


def customer_tiers(customers: DataFrame, tiers: DataFrame) -> DataFrame:
    """Balance and current tier, without a look at the next one."""
    return customers.join(tiers.select("tier_id", F.col("tier_name").alias("current_tier")), "tier_id").select(
        "customer_id", "name", "points_balance", "current_tier"
    )


def tier_requirements(tiers: DataFrame) -> DataFrame:
    return tiers.select("tier_id", "tier_name", "points_required").orderBy("tier_id")


def points_ledger_reconciliation(customers: DataFrame, ledger: DataFrame) -> DataFrame:
    """Stored balance beside the ledger total, NULL for customers without entries."""
    totals = ledger.groupBy("customer_id").agg(F.sum("points_amount").alias("ledger_points"))
    return customers.select("customer_id", "points_balance").join(totals, "customer_id", "left")


def tier_change_history(
    history: DataFrame, customers: DataFrame, tiers: DataFrame, changed_since: datetime | None = None
) -> DataFrame:
    """Tier changes with both tier names, newest first; sign-ups have no old tier and drop out.

    ``changed_since`` keeps changes from the start of that day on.
    """
    if changed_since is not None:
        history = history.where(F.col("change_date") >= day_start(changed_since))
    old = tiers.select(F.col("tier_id").alias("old_tier_id"), F.col("tier_name").alias("old_tier"))
    new = tiers.select(F.col("tier_id").alias("new_tier_id"), F.col("tier_name").alias("new_tier"))
    return (
        history.join(old, "old_tier_id").join(new, "new_tier_id")
        .join(customers.select("customer_id", "name"), "customer_id")
        .select("history_id", "customer_id", "name", "old_tier", "new_tier", "change_date", "change_reason")
        .orderBy(F.desc("change_date"), "history_id")
    )


def ledger_by_type(ledger: DataFrame, transaction_type: str, customer_id: int | None = None) -> DataFrame:
    """Ledger entries of one type, newest first, optionally of one customer."""
    rows = ledger.where(F.col("transaction_type") == transaction_type)
    if customer_id is not None:
        rows = rows.where(F.col("customer_id") == customer_id)
    return rows.select(
        "transaction_id", "customer_id", "points_amount", "transaction_type", "transaction_date", "description"
    ).orderBy(F.desc("transaction_date"), "transaction_id")


def ledger_description_search(ledger: DataFrame, text: str) -> DataFrame:
    """Ledger entries whose description holds ``text``."""
    return ledger.where(F.col("description").contains(text)).select(
        "transaction_id", "customer_id", "points_amount", "description", "expiry_date"
    )


def upgrade_value(requests: DataFrame, customers: DataFrame, tiers: DataFrame) -> DataFrame:
    """One sentence per asked customer on what the next tier would bring."""
    fee, next_fee = F.col("renewal_fee"), F.col("next_renewal_fee")
    fee_text = (
        F.when(next_fee > fee, joined_text("+$", number_text(next_fee - fee)))
        .when(next_fee < fee, joined_text("-$", number_text(fee - next_fee)))
        .otherwise("No change")
    )
    gain = number_text(F.col("next_discount_percentage") - F.col("discount_percentage"))
    needed = number_text(F.col("next_points_required") - F.col("points_balance"))
    sentence = joined_text(
        "Upgrade to ", F.col("next_tier_name"), " | Discount Increase: +", gain, "% | Points Needed: ", needed,
        " | Renewal Fee Change: ", fee_text,
    )
    texts = (
        customers.select("customer_id", "tier_id", "points_balance")
        .join(tiers.select("tier_id", "discount_percentage", "renewal_fee"), "tier_id")
        .join(_next_tier(tiers), "tier_id")
        .select("customer_id", sentence.alias("upgrade_value"))
    )
    return (
        requests.select("customer_id").join(texts, "customer_id", "left")
        .fillna("At highest tier or invalid customer", "upgrade_value")
    )


def upgrade_value_log(values: DataFrame, as_of: datetime) -> DataFrame:
    """Audit rows for the sentences of ``upgrade_value``; none where there is no next tier."""
    found = values.where(F.col("upgrade_value").startswith("Upgrade to "))
    text = joined_text("Calculated upgrade for customer ", F.col("customer_id"), ": ", F.col("upgrade_value"))
    return activity_rows(found.select("customer_id", text.alias("details")), "TIER_CHANGE", as_of, "customer_id")


def membership_health(requests: DataFrame, customers: DataFrame, tiers: DataFrame, as_of: datetime) -> DataFrame:
    """One sentence per asked customer on the state of the membership."""
    days = floor_days(F.col("membership_expiry_date"), moment(as_of))
    days_text = number_text(days)
    renewed = F.upper(F.date_format("last_renewal_date", "dd-MMM-yyyy"))
    state = (
        F.when(
            F.col("membership_status") != "ACTIVE",
            joined_text(F.col("membership_status"), " (last renewed: ", renewed, ")"),
        )
        .when(days <= 0, joined_text("EXPIRED ", number_text(F.abs(days)), " days ago"))
        .when(days <= 7, joined_text("CRITICAL - renew in ", days_text, " days"))
        .when(days <= 30, joined_text("Renewal due in ", days_text, " days"))
        .otherwise(joined_text("Active (expires in ", days_text, " days)"))
    )
    texts = (
        customers.join(tiers.select("tier_id", "tier_name"), "tier_id")
        .select("customer_id", joined_text(F.col("tier_name"), " membership: ", state).alias("membership_health"))
    )
    return (
        requests.select("customer_id").join(texts, "customer_id", "left")
        .fillna("Customer not found", "membership_health")
    )


def renew_memberships(
    customers: DataFrame, tiers: DataFrame, as_of: datetime,
    renewal_type: str = "EXPIRED_ONLY", extension_months: int = 12,
) -> dict[str, DataFrame]:
    """Extend the memberships in scope; returns the changed customers and the audit row."""
    if renewal_type not in RENEWAL_TYPES:
        raise ValueError(f"-20001: renewal type must be one of {', '.join(RENEWAL_TYPES)}")
    if extension_months <= 0:
        raise ValueError("-20002: extension months must be positive")
    now = moment(as_of)
    expiry = F.col("membership_expiry_date")
    scope = {
        "EXPIRED_ONLY": expiry <= now,
        "URGENT": expiry.between(now, plus_days(now, 7)),
        "ALL_DUE": expiry <= plus_days(now, 30),
    }[renewal_type]
    renewed = (
        customers.where((F.col("is_member") == "Y") & scope)
        .join(tiers.select("tier_id"), "tier_id", "left_semi")
        .withColumns({
            "membership_expiry_date": plus_months(strict_greatest(expiry, now), extension_months),
            "membership_status": F.lit("ACTIVE"),
            "last_renewal_date": now,
            "renewal_count": F.col("renewal_count") + 1,
        })
        .select(customers.columns)
    )
    report = renewed.agg(joined_text("Renewed ", F.count("*"), " memberships, failed 0").alias("details"))
    return {"customers": renewed, "activity": activity_rows(report, "RENEWAL", as_of)}


def _expired_ids(ledger: DataFrame, prefix_compat: bool) -> DataFrame:
    """Ids of entries that an EXPIRY text already names.

    ``prefix_compat`` also counts every leading part of a named id, as a plain
    text search for the id would.
    """
    named = (
        ledger.where(F.col("transaction_type") == "EXPIRY")
        .select(F.explode(F.regexp_extract_all("description", F.lit(r"from transaction (\d+)"), 1)).alias("digits"))
    )
    if prefix_compat:
        lengths = F.sequence(F.lit(1), F.length("digits"))
        named = named.select(
            F.explode(F.transform(lengths, lambda n: F.col("digits").substr(F.lit(1), n))).alias("digits")
        )
    return named.select(F.col("digits").cast("long").alias("transaction_id")).distinct()


def expiry_candidates(
    ledger: DataFrame, customers: DataFrame, as_of: datetime, prefix_compat: bool = False
) -> DataFrame:
    """Earned points past their date, not expired before, within the starting balance."""
    due = ledger.where(
        (F.col("expiry_date") <= day_start(as_of)) & (F.col("points_amount") > 0)
        & F.col("transaction_type").isin("PURCHASE", "BONUS")
    ).select("transaction_id", "customer_id", "points_amount", "expiry_date", "transaction_date", "description")
    return (
        due.join(_expired_ids(ledger, prefix_compat), "transaction_id", "left_anti")
        .join(customers.select("customer_id", "points_balance"), "customer_id")
        .where(F.col("points_balance") >= F.col("points_amount"))
    )


def expire_points(
    ledger: DataFrame, customers: DataFrame, as_of: datetime, prefix_compat: bool = False,
    max_group: int | None = None,
) -> dict[str, DataFrame]:
    """Expire due points per customer in date order as long as the balance lasts.

    An entry larger than what is left is skipped and the next one tried. Returns
    the EXPIRY entries, the marked originals, the lowered balances and totals.
    """
    decided = spend_in_order(
        expiry_candidates(ledger, customers, as_of, prefix_compat),
        key="customer_id", order=("expiry_date", "transaction_date", "transaction_id"),
        amount="points_amount", budget="points_balance", max_group=max_group,
    )
    expired = decided.where("accepted")
    now = moment(as_of)
    entries = expired.select(
        "customer_id", (-F.col("points_amount")).alias("points_amount"), F.lit("EXPIRY").alias("transaction_type"),
        joined_text("Points expired from transaction ", F.col("transaction_id")).alias("description"),
        now.alias("transaction_date"),
    )
    marked = expired.select(
        "transaction_id", "customer_id", F.lit(None).cast("timestamp_ntz").alias("expiry_date"),
        joined_text(F.col("description"), " - EXPIRED").alias("description"),
    )
    balances = expired.groupBy("customer_id").agg(
        (F.max("points_balance") - F.sum("points_amount")).alias("points_balance"),
        F.sum("points_amount").alias("points_expired"), F.count("*").alias("entries_expired"),
    )
    totals = balances.agg(
        F.coalesce(F.sum("points_expired"), F.lit(0)).alias("points_expired"),
        F.coalesce(F.sum("entries_expired"), F.lit(0)).alias("entries_expired"),
        F.count("*").alias("customers_affected"),
    )
    return {"point_transactions": entries, "marked": marked, "balances": balances, "totals": totals}


def downgrade_tiers(ledger: DataFrame, customers: DataFrame, tiers: DataFrame, as_of: datetime) -> DataFrame:
    """Lower the tier of customers with an EXPIRY entry on the day of ``as_of``; never raises it."""
    today = day_start(as_of)
    touched = ledger.where(
        (F.col("transaction_type") == "EXPIRY")
        & (F.col("transaction_date") >= today) & (F.col("transaction_date") < plus_days(today, 1))
    )
    rows = (
        customers.select("customer_id", "tier_id", "points_balance")
        .join(touched.select("customer_id").distinct(), "customer_id", "left_semi")
        .join(tiers.select("tier_id"), "tier_id", "left_semi")
    )
    return (
        with_highest_reached_tier(rows, "points_balance", tiers, "qualified")
        .where(F.col("qualified") < F.col("tier_id"))
        .select("customer_id", F.col("tier_id").alias("old_tier_id"), F.col("qualified").alias("new_tier_id"))
    )


def expiry_run(
    ledger: DataFrame, customers: DataFrame, tiers: DataFrame, as_of: datetime,
) -> dict[str, DataFrame]:
    """The whole expiry job: expire points, then downgrade tiers on the lowered balances."""
    deltas = expire_points(ledger, customers, as_of)
    lowered = deltas["balances"].select("customer_id", F.col("points_balance").alias("lowered"))
    after = (
        customers.join(lowered, "customer_id", "left")
        .withColumn("points_balance", F.coalesce("lowered", "points_balance")).drop("lowered")
    )
    day_entries = ledger.select("customer_id", "transaction_type", "transaction_date").unionByName(
        deltas["point_transactions"].select("customer_id", "transaction_type", "transaction_date")
    )
    deltas["downgrades"] = downgrade_tiers(day_entries, after, tiers, as_of)
    counts = deltas["downgrades"].agg(F.count("*").alias("downgrades")).scalar()
    report = deltas["totals"].select(joined_text(
        "Expired ", F.col("points_expired"), " points in ", F.col("entries_expired"), " entries of ",
        F.col("customers_affected"), " customers, ", counts, " downgrades",
    ).alias("details"))
    deltas["activity"] = activity_rows(report, "EXPIRATION", as_of)
    return deltas


def realign_tiers(customers: DataFrame, tiers: DataFrame, as_of: datetime) -> dict[str, DataFrame]:
    """Move every customer to the highest reached tier, up or down, with a history row."""
    changed = (
        with_highest_reached_tier(customers.select("customer_id", "tier_id", "points_balance"), "points_balance", tiers, "new_tier_id")
        .where(F.col("new_tier_id") != F.col("tier_id"))
    )
    history = changed.select(
        "customer_id", F.col("tier_id").alias("old_tier_id"), "new_tier_id",
        moment(as_of).alias("change_date"), F.lit("ADMIN").alias("change_reason"),
    )
    moved = changed.select("customer_id", F.col("new_tier_id").alias("tier_id"))
    return {"customers": moved, "membership_history": history}
