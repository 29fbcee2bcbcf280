"""Seasonal item reports, eligibility, demand, redemption and expiry."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from perkwell.functions.columns import (
    MONEY, ceil_days, half_up_ratio, joined_text, live_at, moment, plus_days, plus_months, strict_greatest,
)
from perkwell.operators.audit import activity_rows
from perkwell.operators.audit_trail import Rung, event, ladder_events, trail
from perkwell.operators.ordered_spend import spend_in_order

# Sales outlook window and the added safety margin of 20 percent (12 tenths).
OUTLOOK_DAYS = 30
MARGIN_TENTHS = 12
# Error codes of the redemption job.
REDEEM_ERRORS = {
    "INVALID_CUSTOMER": -20053, "INVALID_ITEM": -20054, "INVALID_ORDER": -20055, "ITEM_NOT_IN_ORDER": -20051,
    "NO_PROMOTION": -20050, "INSUFFICIENT_POINTS": -20052,
}


def _is_seasonal() -> Column:
    return F.col("item_type") == "SEASONAL"


def _one_live_promotion(promotions: DataFrame, as_of: datetime) -> DataFrame:
    """The live SEASONAL promotion with the lowest id, per item."""
    facts = F.struct("promotion_id", "points_required", "min_spend", "applicable_tier_id")
    return (
        promotions.where((F.col("promotion_type") == "SEASONAL") & live_at(as_of) & F.col("set_meal_id").isNotNull())
        .groupBy(F.col("set_meal_id").alias("item_id"))
        .agg(F.min_by(facts, "promotion_id").alias("promo"))
    )


def seasonal_item_performance(
    items: DataFrame, order_items: DataFrame, orders: DataFrame, redemptions: DataFrame, promotions: DataFrame
) -> DataFrame:
    """Sales and redemption figures per seasonal item.

    A line counts once per redemption of its order, whichever item that was for.
    Lines and redemptions are counted per order first and the counts multiplied,
    so the pairs within an order are never produced.
    """
    seasonal = items.where(_is_seasonal()).select("item_id", "name", "description", "initial_stock")
    lines = (
        order_items.join(seasonal.select("item_id"), "item_id", "left_semi")
        .groupBy("order_id", "item_id").agg(
            F.count("order_item_id").alias("lines"), F.sum("price").alias("price"),
            F.sum("quantity").alias("quantity"), F.count("quantity").alias("sized_lines"),
        )
    )
    # Both uses below need these keys; filtering here lets them share one shuffle.
    redeemed = redemptions.dropna(subset=["order_id", "promotion_id"]).groupBy("order_id", "promotion_id").agg(
        F.count("redemption_id").alias("times")
    )
    per_order = redeemed.groupBy("order_id").agg(F.sum("times").alias("redeemed"))
    heads = orders.select("order_id", "total_amount", "discount_amount")
    spent_enough = (
        redeemed
        .join(promotions.select("promotion_id", F.col("set_meal_id").alias("item_id"), "min_spend"), "promotion_id")
        .join(heads, "order_id").where(F.col("total_amount") >= F.col("min_spend"))
        .groupBy("order_id", "item_id").agg(F.sum("times").alias("enough"))
    )
    times = F.greatest(F.lit(1), F.coalesce("redeemed", F.lit(0)))
    sums = (
        lines.join(heads, "order_id").join(per_order, "order_id", "left")
        .join(spent_enough, ["order_id", "item_id"], "left")
        .groupBy("item_id").agg(
            F.sum(F.col("lines") * times).alias("total_sold"),
            F.sum(F.when(F.col("discount_amount") == 0, F.col("price") * times).otherwise(0))
            .cast("decimal(20,2)").alias("revenue"),
            F.sum(F.col("lines") * F.coalesce("redeemed", F.lit(0))).alias("points_redemptions"),
            F.sum(F.col("quantity") * times).alias("_quantity"), F.sum(F.col("sized_lines") * times).alias("_sized"),
            F.sum(F.col("lines") * F.coalesce("enough", F.lit(0))).alias("_enough"),
        )
    )
    stock = strict_greatest(F.lit(1), F.col("initial_stock"))
    return sums.join(seasonal, "item_id").select(
        "item_id", "name", F.col("description").alias("season"), "total_sold", "revenue", "points_redemptions",
        half_up_ratio(F.col("total_sold") * 100, stock, 2).alias("sell_through_rate"),
        half_up_ratio(F.col("_quantity"), F.nullif(F.col("_sized"), F.lit(0)), 1).alias("avg_order_size"),
        half_up_ratio(F.col("_enough") * 100, F.greatest(F.lit(1), "points_redemptions"), 2).alias("min_spend_met"),
    )


def seasonal_inventory_status(items: DataFrame, promotions: DataFrame, as_of: datetime) -> DataFrame:
    """Stock and days left per seasonal item, one row per live promotion on it."""
    live = promotions.where(live_at(as_of)).select(
        F.col("set_meal_id").alias("item_id"), "promotion_id", "min_spend", "points_required"
    )
    return (
        items.where(_is_seasonal()).join(live, "item_id", "left")
        .select(
            "item_id", "name", "current_stock", "valid_to",
            ceil_days(F.col("valid_to"), moment(as_of)).alias("days_left_in_season"),
            F.when(F.col("promotion_id").isNotNull(), "Y").otherwise("N").alias("redemption_allowed"),
            F.coalesce("min_spend", F.lit(0).cast(MONEY)).alias("min_spend_required"),
            F.coalesce("points_required", F.lit(0)).alias("points_cost"),
        )
        .orderBy(F.asc_nulls_last("valid_to"), "item_id")
        .drop("valid_to")
    )


def promotions_of_named_item(
    promotions: DataFrame, items: DataFrame, names: DataFrame, item_type: str = "SEASONAL"
) -> DataFrame:
    """Promotions on the items of one type that carry one of the given names."""
    wanted = items.where(F.col("item_type") == item_type).join(names.select("name"), "name", "left_semi")
    return (
        promotions.join(wanted.select(F.col("item_id").alias("set_meal_id")), "set_meal_id", "left_semi")
        .select("promotion_id", "promotion_type", "name", "valid_from", "valid_to", "discount_value", "set_meal_id")
    )


def expired_item_status(items: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """State of seasonal items, all of them or those with the given names."""
    rows = items.where(_is_seasonal())
    if names is not None:
        rows = rows.join(names.select("name"), "name", "left_semi")
    return rows.select("item_id", "item_type", "name", "base_price", "valid_to", "is_active")


def seasonal_redemption_eligibility(
    requests: DataFrame, customers: DataFrame, promotions: DataFrame, as_of: datetime
) -> DataFrame:
    """Add ``eligibility`` to requests of (customer_id, item_id, item_price); the first failing check names it."""
    person = customers.select(
        "customer_id", F.col("points_balance").alias("_balance"), F.col("tier_id").alias("_tier"),
        F.lit(True).alias("_known"),
    )
    promo = F.col("promo")
    status = (
        F.when(promo.isNull(), "NO_PROMOTION")
        .when(F.col("_known").isNull(), "INVALID CUSTOMER")
        .when(F.col("_balance") < F.coalesce(promo["points_required"], F.lit(0)), "INSUFFICIENT_POINTS")
        .when(F.col("item_price") < promo["min_spend"], "MIN_SPEND_NOT_MET")
        .when(F.col("_tier") < promo["applicable_tier_id"], "TIER_RESTRICTED")
        .otherwise("ELIGIBLE")
    )
    return (
        requests.join(_one_live_promotion(promotions, as_of), "item_id", "left")
        .join(person, "customer_id", "left")
        .select(*requests.columns, status.alias("eligibility"))
    )


def predict_seasonal_demand(
    requests: DataFrame, order_items: DataFrame, orders: DataFrame, as_of: datetime
) -> DataFrame:
    """Expected sales for (item_id, days_remaining): recent mean line quantity, days and a margin, rounded up."""
    now = moment(as_of)
    recent = orders.where(F.col("order_date").between(plus_days(now, -OUTLOOK_DAYS), now)).select("order_id")
    sold = (
        order_items.join(recent, "order_id", "left_semi")
        .groupBy("item_id").agg(F.sum("quantity").alias("_sum"), F.count("quantity").alias("_lines"))
    )
    top = F.col("_sum") * F.col("days_remaining") * MARGIN_TENTHS
    bottom = F.nullif(F.col("_lines"), F.lit(0)) * 10
    # ceil(a / b) for whole numbers without leaving integers: -((-a) floor-divided by b).
    rest = F.pmod(-top, bottom)
    return (
        requests.join(sold, "item_id", "left")
        .select(
            *requests.columns,
            F.when(F.col("_sum").isNull(), F.lit(0).cast("long"))
            .otherwise(F.call_function("div", top + rest, bottom)).alias("predicted_demand"),
        )
    )


def redeem_seasonal(
    requests: DataFrame, customers: DataFrame, items: DataFrame, orders: DataFrame, order_items: DataFrame,
    promotions: DataFrame, as_of: datetime, deduct: bool = False, max_group: int | None = None,
) -> dict[str, DataFrame]:
    """Redeem seasonal items with points, for requests of (request_id, customer_id, item_id, order_id).

    The first failing check decides. Minimum spend, tier and stock are not checked,
    and the balance is not lowered. With ``deduct`` each success lowers the balance
    the later requests of the customer see.
    """
    person = customers.select("customer_id", F.col("points_balance").alias("_balance"), F.lit(True).alias("_known"))
    item = items.where(_is_seasonal()).select("item_id", F.col("base_price").alias("_price"))
    head = orders.select("order_id", F.col("customer_id").alias("_owner"))
    asked = requests.select("order_id", "item_id").distinct()
    contained = (
        order_items.select("order_id", "item_id").distinct()
        .join(asked, ["order_id", "item_id"], "left_semi").withColumn("_contained", F.lit(True))
    )
    promo = F.col("promo")
    failure = (
        F.when(F.col("_known").isNull(), "INVALID_CUSTOMER")
        .when(F.col("_price").isNull(), "INVALID_ITEM")
        .when(F.col("_owner").isNull() | (F.col("_owner") != F.col("customer_id")), "INVALID_ORDER")
        .when(F.col("_contained").isNull(), "ITEM_NOT_IN_ORDER")
        .when(promo.isNull(), "NO_PROMOTION")
        .when(F.col("_balance") < promo["points_required"], "INSUFFICIENT_POINTS")
    )
    checked = (
        requests.join(item, "item_id", "left")
        .join(_one_live_promotion(promotions, as_of), "item_id", "left")
        .join(head, "order_id", "left")
        .join(contained, ["order_id", "item_id"], "left")
        .join(person, "customer_id", "left")
        .select(
            "request_id", "customer_id", "item_id", "order_id", failure.alias("_failure"),
            promo["promotion_id"].alias("promotion_id"), promo["points_required"].alias("points_used"),
            F.col("_price"), F.col("_balance"), F.col("_known"),
        )
    )
    if deduct:
        passed = spend_in_order(
            checked.where(F.col("_failure").isNull()), "customer_id", ["request_id"], "points_used", "_balance",
            max_group,
        )
        passed = passed.withColumn("_failure", F.when(~F.col("accepted"), "INSUFFICIENT_POINTS")).drop("accepted")
        checked = passed.unionByName(checked.where(F.col("_failure").isNotNull()))
    done = checked.where(F.col("_failure").isNull())
    now = moment(as_of)
    codes = F.create_map(*[F.lit(x) for pair in REDEEM_ERRORS.items() for x in pair])
    outcomes = checked.select(
        "request_id", "customer_id", "item_id", "order_id",
        F.coalesce("_failure", F.lit("REDEEMED")).alias("status"), codes[F.col("_failure")].alias("error_code"),
        F.when(F.col("_failure").isNull(), F.col("promotion_id")).alias("promotion_id"),
        F.when(F.col("_failure").isNull(), F.col("points_used")).alias("points_used"),
        F.when(F.col("_failure").isNull(), F.col("_price")).alias("discount_value"),
    )
    redemptions = done.select(
        "customer_id", "promotion_id", "order_id", "points_used", now.alias("redemption_date"),
        F.lit("COMPLETED").alias("redemption_status"), "item_id", F.col("_price").alias("discount_value"),
    )
    ledger = done.select(
        "customer_id", "order_id", "promotion_id", (-F.col("points_used")).alias("points_amount"),
        F.lit("REDEMPTION").alias("transaction_type"),
        joined_text("Seasonal item redemption for setmeal ", F.col("item_id")).alias("description"),
        now.alias("transaction_date"), plus_months(now, 12).alias("expiry_date"),
    )
    lines = order_items.drop("discount_applied").join(
        done.select("order_id", "item_id", F.col("_price").alias("discount_applied")).distinct(),
        ["order_id", "item_id"],
    ).select(order_items.columns)
    text = F.when(
        F.col("_failure").isNull(),
        joined_text("Successfully redeemed seasonal item ", F.col("item_id"), " using ", F.col("points_used"),
                    " points"),
    ).otherwise(joined_text("Failed redemption attempt - ", F.col("_failure"), " for item ", F.col("item_id")))
    audit = activity_rows(
        checked.where(~F.col("_failure").eqNullSafe("INVALID_CUSTOMER"))
        .select("customer_id", text.alias("details")),
        "SEASONAL_REDEMPTION", as_of, customer="customer_id",
    )
    return {
        "outcomes": outcomes, "redemptions": redemptions, "point_transactions": ledger, "order_items": lines,
        "activity": audit, "trail": _redemption_trail(checked, as_of),
    }


def _redemption_trail(checked: DataFrame, as_of: datetime) -> DataFrame:
    """Every step of every request, as it is written to the audit."""
    def step(template: str) -> list[Column]:
        return [event("SEASONAL_REDEMPTION", template)]

    def failed(template: str) -> list[Column]:
        return step("Failed redemption attempt - " + template)

    rungs = [
        Rung(["INVALID_CUSTOMER"], step("Customer {customer_id} validated for seasonal item redemption")),
        Rung(["INVALID_ITEM"], step("Seasonal menu item {item_id} validated for customer {customer_id}"),
             failed("Invalid seasonal menu item ID: {item_id}")),
        Rung(["INVALID_ORDER"], step("Order {order_id} validated for seasonal item redemption"),
             failed("Invalid order ID for customer: {order_id}")),
        Rung(["ITEM_NOT_IN_ORDER"], step("Setmeal {item_id} confirmed in order {order_id}"),
             failed("Order does not contain specified setmeal: {item_id}")),
        Rung(["NO_PROMOTION"], step("Valid seasonal promotion found for setmeal {item_id}"),
             failed("No valid seasonal promotion found for setmeal: {item_id}")),
        Rung(["INSUFFICIENT_POINTS"], step("Customer {customer_id} has sufficient points for redemption (Points balance: {_balance})"),
             failed("Insufficient points (Balance: {_balance}, Required: {points_used})")),
    ]
    # What the caller is told.
    told = {
        "INVALID_ITEM": "Invalid seasonal menu item ID", "INVALID_ORDER": "Invalid order ID for customer",
        "ITEM_NOT_IN_ORDER": "Order does not contain the specified setmeal",
        "NO_PROMOTION": "No valid seasonal promotion found for this setmeal", "INSUFFICIENT_POINTS": "Insufficient points balance",
    }
    texts = F.create_map(*[F.lit(x) for status, line in told.items() for x in (status, f"ORA{REDEEM_ERRORS[status]}: {line}")])
    rows = checked.where(F.col("_known")).withColumn("_error", texts[F.col("_failure")])
    events = ladder_events(
        rungs, F.coalesce("_failure", F.lit("")), step("Successfully redeemed seasonal item {item_id} using {points_used} points"),
        event("SEASONAL_REDEMPTION", "Error redeeming seasonal item: {_error}"),
    )
    return trail(rows, events, as_of)


def expire_seasonal_items(items: DataFrame, promotions: DataFrame, as_of: datetime) -> dict[str, DataFrame]:
    """Switch off seasonal items past their date and remove every promotion on such items.

    Items already inactive lose their promotions as well. Rows that hang on the
    removed promotions are found by ``cascade_delete``.
    """
    over = items.where(_is_seasonal() & (F.col("valid_to") < moment(as_of)))
    switched = over.where(F.col("is_active") == "Y").withColumn("is_active", F.lit("N")).select(items.columns)
    removed = promotions.join(over.select(F.col("item_id").alias("set_meal_id")), "set_meal_id", "left_semi")
    reports = (
        switched.agg(joined_text("Deactivated ", F.count("*"), " expired seasonal items").alias("details"))
        .unionByName(
            removed.agg(joined_text("Removed ", F.count("*"), " associated seasonal promotions").alias("details"))
        )
    )
    return {
        "menu_items": switched, "removed_promotions": removed.select(promotions.columns),
        "activity": activity_rows(reports, "SEASONAL_EXPIRATION", as_of),
    }
