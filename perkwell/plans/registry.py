"""Every operator as a named query over one directory of retail tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DecimalType

from perkwell.functions.columns import moment, plus_days
from perkwell.operators import (
    audit, expiry_counts, integrity, maintenance, meals, membership, seasonal, snapshots, vouchers,
)
from perkwell.plans import order_flow, points_cascade
from perkwell.schemas import TABLES
from perkwell.sources.retail_mapping import AS_OF, RetailLoyalty
from perkwell.streaming import upkeep

Query = Callable[[RetailLoyalty], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def plain_numbers(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the form in which the checks compare them."""
    return df.select([
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f.name)
        for f in df.schema
    ])


def runnable(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, directory: str) -> DataFrame:
        return plain_numbers(QUERIES[name](RetailLoyalty(spark, directory)))

    run.__name__ = name
    return run


def _all_tables(t: RetailLoyalty) -> dict[str, DataFrame]:
    return {name: getattr(t, name) for name in TABLES}


# ---- reports -------------------------------------------------------------


@query
def seasonal_item_performance(t):
    return seasonal.seasonal_item_performance(t.menu_items, t.order_items, t.orders, t.redemptions, t.promotions)


@query
def seasonal_inventory_status(t):
    return seasonal.seasonal_inventory_status(t.menu_items, t.promotions, AS_OF)


@query
def upcoming_renewals(t):
    return membership.upcoming_renewals(t.customers, t.membership_tiers, AS_OF)


@query
def tier_comparison(t):
    return membership.tier_comparison(t.customers, t.membership_tiers)


@query
def assignable_vouchers(t):
    return vouchers.assignable_vouchers(t.promotions, t.membership_tiers, AS_OF)


@query
def voucher_assignment_status(t):
    return vouchers.voucher_assignment_status(t.promotions, t.customer_promotions)


@query
def setmeal_profitability(t):
    return meals.setmeal_profitability(t.menu_items, t.set_meal_components, t.order_items, t.orders, AS_OF)


@query
def order_type_comparison(t):
    return meals.order_type_comparison(t.order_items, t.menu_items, t.orders, t.customers, t.membership_tiers)


@query
def order_totals_reconciliation(t):
    return meals.order_totals_reconciliation(t.orders, t.order_items)


@query
def points_ledger_reconciliation(t):
    return membership.points_ledger_reconciliation(t.customers, t.point_transactions)


@query
def tier_change_history(t):
    return membership.tier_change_history(t.membership_history, t.customers, t.membership_tiers)


@query
def tier_changes_today(t):
    return membership.tier_change_history(t.membership_history, t.customers, t.membership_tiers, AS_OF)


@query
def customer_status(t):
    return membership.customer_status(t.customers, t.membership_tiers)


@query
def customer_tiers(t):
    return membership.customer_tiers(t.customers, t.membership_tiers)


@query
def ledger_by_type(t):
    return membership.ledger_by_type(t.point_transactions, "REDEMPTION")


@query
def ledger_description_search(t):
    return membership.ledger_description_search(t.point_transactions, "expired from")


@query
def active_promo_assigned_count(t):
    return vouchers.active_promo_assigned_count(t.promotions, t.customer_promotions, AS_OF)


@query
def activity_by_type(t):
    return audit.activity_by_type(t.customer_activity, "VOUCHER_REDEMPTION")


@query
def recent_activity_by_type(t):
    return audit.activity_by_type(t.customer_activity, "LOGIN", AS_OF, minutes=5)


@query
def promotions_of_named_item(t):
    names = t.menu_items.where("item_type = 'SEASONAL' AND is_active = 'N'").select("name").distinct()
    return seasonal.promotions_of_named_item(t.promotions, t.menu_items, names)


@query
def tier_requirements(t):
    return membership.tier_requirements(t.membership_tiers)


@query
def used_promotions(t):
    return vouchers.used_promotions(t.customer_promotions)


@query
def expired_item_status(t):
    names = t.menu_items.where((F.col("item_type") == "SEASONAL") & (F.col("valid_to") < moment(AS_OF)))
    return seasonal.expired_item_status(t.menu_items, names.select("name").distinct())


@query
def holdings_by_tier_count(t):
    return vouchers.holdings_by_tier_count(t.customer_promotions, t.customers)


# ---- scores ----------------------------------------------------------------


@query
def seasonal_redemption_eligibility(t):
    return seasonal.seasonal_redemption_eligibility(t.seasonal_checks, t.customers, t.promotions, AS_OF)


@query
def predict_seasonal_demand(t):
    return seasonal.predict_seasonal_demand(t.demand_requests, t.order_items, t.orders, AS_OF)


@query
def upgrade_value(t):
    return membership.upgrade_value(t.voucher_checks.select("customer_id").distinct(), t.customers, t.membership_tiers)


@query
def membership_health(t):
    asked = t.voucher_checks.select("customer_id").distinct()
    return membership.membership_health(asked, t.customers, t.membership_tiers, AS_OF)


@query
def voucher_codes(t):
    return vouchers.voucher_codes(
        t.customers.select(F.col("customer_id").alias("id")), t.promotions, "prm", 14, "spring"
    )


@query
def voucher_value(t):
    return vouchers.voucher_value(t.voucher_checks, t.promotions, t.customers, AS_OF)


@query
def validate_setmeal(t):
    return meals.validate_setmeal(t.menu_items.select("item_id"), t.menu_items, t.set_meal_components)


@query
def setmeal_price(t):
    return meals.setmeal_price(
        t.meal_price_requests, t.menu_items, t.set_meal_components, t.customers, t.membership_tiers
    ).drop("apply_tier_discount")


# ---- batch jobs: each returns its main delta -------------------------------


@query
def redeem_seasonal(t):
    return seasonal.redeem_seasonal(
        t.seasonal_redeem_requests, t.customers, t.menu_items, t.orders, t.order_items, t.promotions, AS_OF
    )["outcomes"]


@query
def redeem_seasonal_lines(t):
    return seasonal.redeem_seasonal(
        t.seasonal_redeem_requests, t.customers, t.menu_items, t.orders, t.order_items, t.promotions, AS_OF
    )["order_items"]


def _seasonal_redemption(t):
    return seasonal.redeem_seasonal(
        t.seasonal_redeem_requests, t.customers, t.menu_items, t.orders, t.order_items, t.promotions, AS_OF
    )


@query
def redeem_seasonal_redemptions(t):
    return _seasonal_redemption(t)["redemptions"]


@query
def redeem_seasonal_ledger(t):
    return _seasonal_redemption(t)["point_transactions"]


@query
def expire_seasonal_items(t):
    return seasonal.expire_seasonal_items(t.menu_items, t.promotions, AS_OF)["menu_items"]


@query
def expired_item_promotions(t):
    return seasonal.expire_seasonal_items(t.menu_items, t.promotions, AS_OF)["removed_promotions"]


@query
def renew_memberships(t):
    renewed = membership.renew_memberships(t.customers, t.membership_tiers, AS_OF, "ALL_DUE", 12)["customers"]
    return renewed.select(
        "customer_id", "membership_expiry_date", "membership_status", "last_renewal_date", "renewal_count"
    )


@query
def expire_points(t):
    return membership.expire_points(t.point_transactions, t.customers, AS_OF)["point_transactions"]


@query
def expire_points_balances(t):
    return membership.expire_points(t.point_transactions, t.customers, AS_OF)["balances"]


@query
def expire_points_marked(t):
    return membership.expire_points(t.point_transactions, t.customers, AS_OF)["marked"]


@query
def expire_points_totals(t):
    return membership.expire_points(t.point_transactions, t.customers, AS_OF)["totals"]


@query
def downgrade_tiers(t):
    return membership.downgrade_tiers(t.point_transactions, t.customers, t.membership_tiers, AS_OF)


@query
def expiry_run_downgrades(t):
    return membership.expiry_run(t.point_transactions, t.customers, t.membership_tiers, AS_OF)["downgrades"]


@query
def bulk_assign_vouchers(t):
    return vouchers.bulk_assign_vouchers(
        t.customers, t.membership_tiers, t.promotions, t.customer_promotions, AS_OF
    )["customer_promotions"]


@query
def redeem_vouchers(t):
    return vouchers.redeem_vouchers(
        t.voucher_redeem_requests, t.promotions, t.customers, t.orders, AS_OF, owned_only=True
    )["outcomes"]


@query
def redeem_vouchers_orders(t):
    return vouchers.redeem_vouchers(
        t.voucher_redeem_requests, t.promotions, t.customers, t.orders, AS_OF, owned_only=True
    )["orders"]


def _shared_redemption(t):
    return vouchers.redeem_vouchers(t.shared_redeem_requests, t.promotions, t.customers, t.orders, AS_OF)


@query
def redeem_vouchers_shared(t):
    return _shared_redemption(t)["outcomes"]


@query
def redeem_vouchers_shared_orders(t):
    return _shared_redemption(t)["orders"]


@query
def redeem_vouchers_shared_ledger(t):
    return _shared_redemption(t)["point_transactions"]


@query
def create_alacarte_orders(t):
    return meals.create_alacarte_orders(
        t.alacarte_requests, t.customers, t.menu_items, t.promotions, AS_OF
    )["orders"].drop("promotion_id")


@query
def create_alacarte_lines(t):
    return meals.create_alacarte_orders(
        t.alacarte_requests, t.customers, t.menu_items, t.promotions, AS_OF
    )["order_items"].drop("line_no")


@query
def create_alacarte_rejects(t):
    return meals.create_alacarte_orders(
        t.alacarte_requests, t.customers, t.menu_items, t.promotions, AS_OF
    )["rejects"]


@query
def create_alacarte_skipped(t):
    return meals.create_alacarte_orders(
        t.alacarte_requests, t.customers, t.menu_items, t.promotions, AS_OF
    )["skipped"].drop("line_no")


@query
def create_setmeal_lines(t):
    return meals.create_setmeal_orders(
        t.setmeal_requests, t.customers, t.menu_items, t.promotions, AS_OF
    )["order_items"]


@query
def create_setmeal_rejects(t):
    return meals.create_setmeal_orders(
        t.setmeal_requests, t.customers, t.menu_items, t.promotions, AS_OF
    )["rejects"]


@query
def create_setmeal_orders(t):
    return meals.create_setmeal_orders(t.setmeal_requests, t.customers, t.menu_items, t.promotions, AS_OF)["orders"]


@query
def create_setmeal_promotions(t):
    return meals.create_setmeal_orders(
        t.setmeal_requests, t.customers, t.menu_items, t.promotions, AS_OF
    )["promotions"]


@query
def audit_activity(t):
    deltas = [
        seasonal.expire_seasonal_items(t.menu_items, t.promotions, AS_OF),
        membership.renew_memberships(t.customers, t.membership_tiers, AS_OF, "EXPIRED_ONLY", 12),
        seasonal.redeem_seasonal(
            t.seasonal_redeem_requests, t.customers, t.menu_items, t.orders, t.order_items, t.promotions, AS_OF
        ),
    ]
    rows = deltas[0]["activity"]
    for delta in deltas[1:]:
        rows = rows.unionByName(delta["activity"])
    return rows


@query
def audit_trail(t):
    trails = {
        "seasonal": seasonal.redeem_seasonal(
            t.seasonal_redeem_requests, t.customers, t.menu_items, t.orders, t.order_items, t.promotions, AS_OF
        )["trail"],
        "value": vouchers.voucher_value_trail(t.voucher_checks, t.promotions, t.customers, AS_OF),
        "redemption": vouchers.redemption_trail(t.shared_redeem_requests, t.promotions, t.customers, t.orders, AS_OF),
        "set meal": meals.create_setmeal_orders(t.setmeal_requests, t.customers, t.menu_items, t.promotions, AS_OF)["trail"],
    }
    rows = None
    for job, part in trails.items():
        part = part.withColumn("job", F.lit(job))
        rows = part if rows is None else rows.unionByName(part)
    return rows


@query
def realign_tiers(t):
    return membership.realign_tiers(t.customers, t.membership_tiers, AS_OF)["membership_history"]


@query
def realign_tiers_customers(t):
    return membership.realign_tiers(t.customers, t.membership_tiers, AS_OF)["customers"]


@query
def append_from_select(t):
    rows = t.customers.where("membership_status = 'PENDING'").select(
        "customer_id", F.lit(100).alias("points_amount"), F.lit("PURCHASE").alias("transaction_type"),
        plus_days(moment(AS_OF), -60).alias("transaction_date"), F.lit("Added purchase").alias("description"),
        plus_days(moment(AS_OF), -1).alias("expiry_date"),
    )
    return snapshots.append_from_select(t.point_transactions, rows)


@query
def bulk_update(t):
    return snapshots.bulk_update(
        t.promotions, F.col("promotion_type") == "VOUCHER",
        {"applicable_tier_id": F.lit(None), "valid_to": plus_days(F.col("valid_to"), 30),
         "is_auto_assign": F.lit("Y")},
    )


@query
def bulk_delete(t):
    automatic = t.promotions.where("is_auto_assign = 'Y'").select("promotion_id")
    return snapshots.bulk_delete(
        t.customer_promotions, F.col("acquisition_method") == "MANUAL", automatic, "promotion_id"
    )


# ---- upkeep ------------------------------------------------------------------


@query
def sync_points_balance(t):
    return maintenance.sync_points_balance(t.ledger_changes, t.customers)


@query
def recalc_points_expiry(t):
    return maintenance.recalc_points_expiry(t.ledger_changes, t.point_transactions, t.customers, AS_OF)


@query
def recalc_tier(t):
    return maintenance.recalc_tier(t.customers, t.membership_tiers)


@query
def log_tier_changes(t):
    return maintenance.log_tier_changes(maintenance.recalc_tier(t.customers, t.membership_tiers), AS_OF)


@query
def assign_on_tier_change(t):
    updates = maintenance.recalc_tier(t.customers, t.membership_tiers)
    return maintenance.assign_on_tier_change(
        updates, t.promotions, t.membership_tiers, t.customer_promotions, AS_OF
    )


@query
def sync_order_totals(t):
    return maintenance.sync_order_totals(t.order_item_changes, t.order_items, t.orders)


@query
def mark_promo_used(t):
    return maintenance.mark_promo_used(t.redemptions, t.customer_promotions, AS_OF)


@query
def birthday_bonus(t):
    return maintenance.birthday_bonus(t.customers, t.membership_tiers, t.point_transactions, AS_OF)[
        "point_transactions"
    ]


@query
def birthday_bonus_audit(t):
    return maintenance.birthday_bonus(t.customers, t.membership_tiers, t.point_transactions, AS_OF)["activity"]


@query
def points_cascade_customers(t):
    return points_cascade.points_cascade(
        t.ledger_changes, t.point_transactions, t.customers, t.membership_tiers, t.promotions,
        t.customer_promotions, AS_OF,
    )["customers"]


@query
def points_cascade_history(t):
    return points_cascade.points_cascade(
        t.ledger_changes, t.point_transactions, t.customers, t.membership_tiers, t.promotions,
        t.customer_promotions, AS_OF,
    )["membership_history"]


@query
def points_cascade_vouchers(t):
    return points_cascade.points_cascade(
        t.ledger_changes, t.point_transactions, t.customers, t.membership_tiers, t.promotions,
        t.customer_promotions, AS_OF,
    )["customer_promotions"]


@query
def alacarte_order_flow(t):
    return order_flow.place_alacarte_orders(
        t.alacarte_requests, t.customers, t.menu_items, t.promotions, t.customer_promotions, AS_OF
    )["orders"].drop("promotion_id")


def _settled(t):
    return order_flow.place_and_settle(
        t.alacarte_requests, t.customers, t.menu_items, t.promotions, t.customer_promotions, t.point_transactions,
        t.membership_tiers, AS_OF,
    )


@query
def alacarte_flow_ledger(t):
    return _settled(t)["point_transactions"]


@query
def alacarte_flow_customers(t):
    return _settled(t)["customers"]


@query
def alacarte_flow_history(t):
    return _settled(t)["membership_history"]


@query
def alacarte_flow_holdings(t):
    return _settled(t)["customer_promotions"]


@query
def ledger_stream(t):
    folder = upkeep.run_folder(t.spark, "ledger")
    upkeep.keep_balances(t.stream("point_transactions", "events"), folder).awaitTermination()
    return upkeep.kept_balances(t.spark, folder, t.customers)


@query
def order_totals_stream(t):
    folder = upkeep.run_folder(t.spark, "lines")
    upkeep.keep_order_totals(t.stream("order_items", "lineitem"), folder).awaitTermination()
    return upkeep.kept_order_totals(t.spark, folder, t.orders)


def _counts_before(t):
    """Entries per customer and expiry date before the ledger changes, of which the ledger is the outcome."""
    added = expiry_counts.count_changes(t.ledger_changes).withColumn("entries", -F.col("entries"))
    return expiry_counts.with_count_changes(expiry_counts.expiry_counts(t.point_transactions), added)


@query
def expiry_from_counts(t):
    counts = expiry_counts.with_count_changes(_counts_before(t), expiry_counts.count_changes(t.ledger_changes))
    return expiry_counts.recalc_points_expiry(t.ledger_changes, counts, t.customers, AS_OF)


def _streamed_cascade(t):
    folder = upkeep.run_folder(t.spark, "changes")
    upkeep.keep_ledger_changes(t.stream("ledger_changes", "events"), folder).awaitTermination()
    return upkeep.kept_cascade(
        t.spark, folder, _counts_before(t), t.customers, t.membership_tiers, t.promotions, t.customer_promotions, AS_OF
    )


@query
def ledger_change_stream(t):
    return _streamed_cascade(t)["customers"]


@query
def ledger_change_stream_history(t):
    return _streamed_cascade(t)["membership_history"]


@query
def line_change_stream(t):
    folder = upkeep.run_folder(t.spark, "line-changes")
    upkeep.keep_line_changes(t.stream("line_changes", "lineitem"), folder).awaitTermination()
    return upkeep.kept_line_totals(t.spark, folder, t.orders)


# ---- data checks ---------------------------------------------------------------


@query
def check_violations(t):
    tables = _all_tables(t)
    tables["customers"] = t.raw_customers
    tables["point_transactions"] = t.raw_point_transactions
    return integrity.check_violations(tables)


@query
def fk_violations(t):
    return integrity.fk_violations(_all_tables(t))


@query
def unique_violations(t):
    return integrity.unique_violations(_all_tables(t))


def _expired_items(t):
    return t.menu_items.where((F.col("item_type") == "SEASONAL") & (F.col("valid_to") < moment(AS_OF)))


def _listed(tables: dict[str, DataFrame]) -> DataFrame:
    return integrity.union_all([
        rows.select(F.lit(name).alias("table_name"), integrity.row_key(name).alias("row_key"))
        for name, rows in tables.items()
    ])


@query
def cascade_delete(t):
    gone, _ = integrity.cascade_delete(_all_tables(t), "menu_items", _expired_items(t))
    return _listed(gone)


@query
def cascade_kept_redemptions(t):
    _, kept = integrity.cascade_delete(_all_tables(t), "menu_items", _expired_items(t))
    return kept["redemptions"]


@query
def apply_defaults(t):
    rows = t.customers.select("customer_id", "name", "email", "phone", "tier_id", "renewal_count")
    return integrity.apply_defaults(rows, "customers", AS_OF).select(
        "customer_id", "tier_id", "points_balance", "is_member", "membership_status", "join_date", "renewal_count",
        "last_visit_date",
    )


@query
def assign_keys(t):
    rows = t.customer_promotions.select("customer_id", "promotion_id", "date_acquired")
    return integrity.assign_keys(
        rows, ["date_acquired", "customer_id", "promotion_id"], "holding_id", integrity.first_id("customers")
    )


@query
def evolve_redemptions(t):
    early = t.redemptions.drop("discount_value")
    late = t.redemptions.withColumn("discount_value", F.col("points_used").cast("decimal(10,2)") / 100)
    return integrity.evolve_redemptions(early).unionByName(integrity.evolve_redemptions(
        late.withColumn("discount_value", F.col("discount_value").cast("decimal(10,2)"))
    ))
