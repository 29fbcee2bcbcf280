"""Set-meal and à la carte reports, prices and orders."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from perkwell.functions.columns import (
    MONEY, TOTAL, cents, half_up_ratio, joined_text, live_at, moment, plus_days, plus_months, strict_greatest,
)
from perkwell.operators.audit import activity_rows
from perkwell.operators.audit_trail import CHECK_VIOLATED, NO_PARENT, Rung, event, ladder_events, trail
from perkwell.operators.vouchers import value_events, voucher_value, with_value_events
from perkwell.schemas import RULES

# Set-meal pricing in percent, and the terms of an automatic promotion.
STANDARD_DISCOUNT = 15
DISCOUNT_CAP = 50
PRICE_FLOOR = "0.7"
AUTO_PROMOTION_DAYS = 30
AUTO_PROMOTION_VALUE = 5
SALES_MONTHS = 3
# Fixed value: the error code of a broken check rule.
CHECK_FAILED = -2290
# Report order of the tiers, best first.
TIER_RANK = ("Diamond", "Platinum", "Gold", "Silver", "Bronze")


def _component_facts(components: DataFrame, items: DataFrame) -> DataFrame:
    """Cost and counts per set meal; a component without a menu row has no cost and is not active."""
    item = items.select(F.col("item_id").alias("component_id"), "base_price", "is_active", F.lit(True).alias("_found"))
    return (
        components.join(item, "component_id", "left")
        .groupBy(F.col("set_meal_id").alias("item_id")).agg(
            F.sum(F.col("base_price") * F.col("quantity")).cast(TOTAL).alias("component_cost"),
            F.count("*").alias("components"),
            F.count("_found").alias("found_components"),
            F.count(F.when(F.col("is_active") == "Y", 1)).alias("active_components"),
        )
    )


def _validity() -> Column:
    return (
        F.when(~(F.col("item_type").eqNullSafe("SET_MEAL") & F.col("is_active").eqNullSafe("Y")), "INVALID_SETMEAL")
        .when(F.coalesce("components", F.lit(0)) == 0, "NO_COMPONENTS")
        .when(F.col("active_components") < F.col("components"), "INACTIVE_COMPONENTS")
        .otherwise("VALID")
    )


def setmeal_profitability(
    items: DataFrame, components: DataFrame, order_items: DataFrame, orders: DataFrame, as_of: datetime
) -> DataFrame:
    """Cost, margins, validity and recent sales per set meal that has components."""
    meals = items.where(F.col("item_type") == "SET_MEAL").select(
        "item_id", "name", "base_price", "item_type", "is_active"
    )
    recent = orders.where(F.col("order_date") > plus_months(moment(as_of), -SALES_MONTHS)).select("order_id")
    sales = (
        order_items.select("order_id", "item_id")
        .join(meals.select("item_id"), "item_id", "left_semi")
        .join(recent, "order_id", "left_semi")
        .groupBy("item_id").agg(F.count("*").alias("sales_last_3_months"))
    )
    price, cost = cents(F.col("base_price")), cents(F.col("component_cost"))
    return (
        meals.join(_component_facts(components, items).where("found_components > 0"), "item_id")
        .join(sales, "item_id", "left")
        .select(
            "item_id", "name", F.col("base_price").alias("selling_price"), "component_cost",
            (F.col("base_price") - F.col("component_cost")).cast(TOTAL).alias("gross_profit"),
            half_up_ratio((price - cost) * 100, price, 2).alias("base_margin_pct"),
            half_up_ratio((price * 85 - cost * 100) * 100, price * 85, 2).alias("discounted_margin_pct"),
            _validity().alias("validation_status"),
            F.coalesce("sales_last_3_months", F.lit(0)).alias("sales_last_3_months"),
        )
        .orderBy(F.desc("base_margin_pct"), "item_id")
    )


def order_type_comparison(
    order_items: DataFrame, items: DataFrame, orders: DataFrame, customers: DataFrame, tiers: DataFrame
) -> DataFrame:
    """Orders, revenue and customers by order type and customer tier.

    Lines are summed per order and type, then per customer and type, so distinct
    orders and customers become plain counts on small keys and no row is copied.
    """
    kind = F.when(F.col("item_type") == "SET_MEAL", "Setmeal").otherwise("À La Carte")
    per_order = (
        order_items.join(items.select("item_id", kind.alias("order_type")), "item_id")
        .groupBy("order_id", "order_type").agg(
            F.sum(F.col("price") * F.col("quantity")).alias("revenue"),
            F.count(F.col("price") * F.col("quantity")).alias("lines"),
        )
    )
    per_customer = (
        per_order.join(orders.select("order_id", "customer_id"), "order_id")
        .groupBy("customer_id", "order_type").agg(
            F.sum("revenue").alias("revenue"), F.sum("lines").alias("lines"), F.count("*").alias("orders")
        )
    )
    sums = (
        per_customer.join(customers.select("customer_id", "tier_id"), "customer_id")
        .groupBy("tier_id", "order_type").agg(
            F.sum("orders").alias("order_count"), F.sum("revenue").cast("decimal(28,2)").alias("total_revenue"),
            F.sum("lines").alias("_lines"), F.count("*").alias("_customers"),
        )
        .join(tiers.select("tier_id", F.col("tier_name").alias("customer_tier")), "tier_id")
    )
    revenue = cents(F.col("total_revenue"))
    people = F.nullif(F.col("_customers"), F.lit(0))
    rank = F.coalesce(*[F.when(F.col("customer_tier") == name, F.lit(i)) for i, name in enumerate(TIER_RANK)])
    return (
        sums.select(
            "order_type", "customer_tier", "order_count", "total_revenue",
            half_up_ratio(revenue, F.nullif(F.col("_lines"), F.lit(0)) * 100, 2).alias("avg_order_value"),
            half_up_ratio(revenue, people * 100, 2).alias("revenue_per_customer"),
            half_up_ratio(F.col("order_count"), people, 2).alias("orders_per_customer"),
        )
        .orderBy("order_type", rank.asc_nulls_last())
    )


def order_totals_reconciliation(
    orders: DataFrame, order_items: DataFrame, customers: DataFrame | None = None
) -> DataFrame:
    """Newest order of each customer, header totals beside the sums of its lines.

    ``customers`` limits the report to some customers.
    """
    wanted = orders if customers is None else orders.join(customers.select("customer_id"), "customer_id", "left_semi")
    newest = wanted.groupBy("customer_id").agg(F.max("order_id").alias("order_id")).select("order_id")
    # Summed before the join: an order with very many lines shrinks where it is read.
    lines = order_items.groupBy("order_id").agg(
        F.sum(F.col("price") * F.col("quantity")).cast(TOTAL).alias("calc_total"),
        F.sum(F.col("discount_applied") * F.col("quantity")).cast(TOTAL).alias("calc_discount"),
    ).join(newest, "order_id", "left_semi")
    return (
        orders.join(newest, "order_id", "left_semi")
        .select("order_id", "total_amount", "discount_amount", "final_amount")
        .join(lines, "order_id", "left")
    )


def validate_setmeal(requests: DataFrame, items: DataFrame, components: DataFrame) -> DataFrame:
    """Add ``validation_status`` to the asked item ids."""
    return (
        requests.join(items.select("item_id", "item_type", "is_active"), "item_id", "left")
        .join(_component_facts(components, items), "item_id", "left")
        .select(*requests.columns, _validity().alias("validation_status"))
    )


def setmeal_price(
    requests: DataFrame, items: DataFrame, components: DataFrame, customers: DataFrame, tiers: DataFrame
) -> DataFrame:
    """Add ``setmeal_price`` to requests of (item_id, customer_id, apply_tier_discount).

    The price is the component cost less the standard and the tier discount, at
    least the price floor; NULL for a meal without components.
    """
    tier_discount = (
        customers.select("customer_id", "tier_id").join(tiers.select("tier_id", "discount_percentage"), "tier_id")
        .select("customer_id", F.col("discount_percentage").alias("_tier_discount"))
    )
    cost = F.col("component_cost")
    tier_part = F.when(F.col("apply_tier_discount"), F.coalesce("_tier_discount", F.lit(0))).otherwise(F.lit(0))
    percent = F.least(
        (F.lit(STANDARD_DISCOUNT) + tier_part).cast("decimal(6,2)"), F.lit(DISCOUNT_CAP).cast("decimal(6,2)")
    )
    discounted = (cost * (F.lit(100) - percent) * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(28,6)")
    floor = (cost * F.lit(PRICE_FLOOR).cast("decimal(2,1)")).cast("decimal(28,6)")
    return (
        requests.join(_component_facts(components, items).select("item_id", "component_cost"), "item_id", "left")
        .join(tier_discount, "customer_id", "left")
        .select(*requests.columns, F.round(strict_greatest(discounted, floor), 2).cast(TOTAL).alias("setmeal_price"))
    )


def _order_totals(value: Column) -> list[Column]:
    total, zero = F.col("total_amount"), F.lit(0).cast(MONEY)
    return [
        total, value.alias("discount_amount"),
        F.greatest((total - value).cast(MONEY), zero).alias("final_amount"),
    ]


def _voucher_part(rows: DataFrame, promotions: DataFrame, customers: DataFrame, as_of: datetime) -> DataFrame:
    """Add what the named voucher is worth on ``total_amount``; 0 without a voucher."""
    priced = voucher_value(
        rows.drop("_known", "is_member").withColumn("order_amount", F.col("total_amount")), promotions, customers, as_of
    ).drop("order_amount")
    return priced.withColumn("voucher_value", F.when(F.col("promotion_id").isNull(), F.lit(0).cast(MONEY))
                             .otherwise(F.col("voucher_value")))


def _payable() -> Column:
    """Whether an order may be stored with the payment method: the check rule of orders, which lets NULL pass."""
    return F.coalesce(F.expr(RULES["orders"]["payment_method"]), F.lit(True))


def create_alacarte_orders(
    requests: DataFrame, customers: DataFrame, items: DataFrame, promotions: DataFrame, as_of: datetime
) -> dict[str, DataFrame]:
    """Create orders from requests of (request_id, customer_id, item_ids text, payment_method, promotion_id).

    The payment method must be one an order may have. Each id in the text must be an active à la carte item, else it is skipped;
    repeated ids give repeated lines. Orders are keyed by ``request_id`` until
    ``assign_keys`` numbers them.
    """
    members = customers.where(F.col("is_member") == "Y").select("customer_id", F.lit(True).alias("_member"))
    parts = F.filter(F.transform(F.split("item_ids", ","), lambda part: F.trim(part)), lambda part: part != "")
    known = (
        requests.join(members, "customer_id", "left")
        .withColumn("_payable", _payable())
        .withColumn("_parts", F.when(F.col("_member") & F.col("_payable"), parts))
        .withColumn("_unreadable", F.exists("_parts", lambda part: part.try_cast("decimal(38,9)").isNull()))
    )
    for_sale = items.where((F.col("item_type") == "A_LA_CARTE") & (F.col("is_active") == "Y")).select(
        "item_id", F.col("base_price").alias("price")
    )
    number = F.col("_text").try_cast("decimal(38,9)")
    facts = ["request_id", "customer_id", "promotion_id", "payment_method", "_member", "_payable", "_unreadable"]
    asked = (
        known.select(*facts, F.posexplode_outer(F.when(~F.col("_unreadable"), F.col("_parts")))
                     .alias("line_no", "_text"))
        .withColumn("item_id", F.when(number == F.floor(number), number.cast("long")))
        .join(for_sale, "item_id", "left")
    )
    lines = asked.where(F.col("price").isNotNull()).select(
        "request_id", "line_no", "item_id", F.lit(1).cast("long").alias("quantity"), "price",
        F.lit(0).cast(MONEY).alias("discount_applied"),
    )
    skipped = asked.where(F.col("_text").isNotNull() & F.col("price").isNull()).select(
        "request_id", "line_no", F.col("_text").alias("item_text")
    )
    # One sum over the exploded lines judges every request; rejected ones left a single empty line.
    judged = (
        asked.groupBy(*facts).agg(F.sum("price").cast(MONEY).alias("total_amount"), F.count("price").alias("items"))
        .withColumn(
            "status",
            F.when(F.col("_member").isNull(), "NOT_A_MEMBER")
            .when(~F.col("_payable"), "PAYMENT_METHOD_REFUSED")
            .when(F.col("_unreadable"), "BAD_ITEM_LIST")
            .when(F.col("items") == 0, "NO_VALID_ITEMS")
            .otherwise("CREATED"),
        )
    )
    created = judged.where(F.col("status") == "CREATED").select(
        "request_id", "customer_id", "promotion_id", "payment_method", "total_amount", "items"
    )
    orders = _voucher_part(created, promotions, customers, as_of).select(
        "request_id", "customer_id", "promotion_id", moment(as_of).alias("order_date"),
        *_order_totals(F.col("voucher_value")), "payment_method", F.lit("COMPLETED").alias("status"), "items",
    )
    codes = F.create_map(
        F.lit("NOT_A_MEMBER"), F.lit(-20010), F.lit("NO_VALID_ITEMS"), F.lit(-20011),
        F.lit("PAYMENT_METHOD_REFUSED"), F.lit(CHECK_FAILED),
    )
    rejects = judged.where(F.col("status") != "CREATED").select(
        "request_id", "customer_id", "status", codes[F.col("status")].alias("error_code")
    )
    made = orders.select("customer_id", joined_text(
        "Created order #", F.col("request_id"), " (A_LA_CARTE) items=", F.col("items"), ", total=",
        F.col("total_amount"), ", discount=", F.col("discount_amount"),
    ).alias("details"))
    failed = rejects.select("customer_id", joined_text("Error creating order: ", F.col("status")).alias("details"))
    return {
        "orders": orders, "order_items": lines, "skipped": skipped, "rejects": rejects,
        "activity": activity_rows(made.unionByName(failed), "ORDER", as_of, customer="customer_id"),
    }


def create_setmeal_orders(
    requests: DataFrame, customers: DataFrame, items: DataFrame, promotions: DataFrame, as_of: datetime
) -> dict[str, DataFrame]:
    """Create one-line orders from requests of (request_id, customer_id, item_id, payment_method, promotion_id).

    A menu item asked for by a member that has no live set-meal promotion gets one,
    even when the order itself is refused. Neither promotion nor tier lowers the
    price; only the voucher does.
    """
    person = customers.select("customer_id", "is_member", F.lit(True).alias("_known"))
    meal = items.select(
        "item_id", F.lit(True).alias("_on_menu"),
        F.when((F.col("item_type") == "SET_MEAL") & (F.col("is_active") == "Y"), F.col("base_price"))
        .alias("total_amount"),
    )
    judged = (
        requests.join(person, "customer_id", "left").join(meal, "item_id", "left")
        .withColumn(
            "status",
            F.when(F.col("_known").isNull(), "CUSTOMER_NOT_FOUND")
            .when(F.col("is_member") != "Y", "NOT_A_MEMBER")
            .when(F.col("total_amount").isNull(), "SET_MEAL_NOT_AVAILABLE")
            .when(~_payable(), "PAYMENT_METHOD_REFUSED")
            .otherwise("CREATED"),
        )
    )
    live = promotions.where((F.col("promotion_type") == "SET_MEAL") & live_at(as_of)).select(
        F.col("set_meal_id").alias("item_id")
    )
    now = moment(as_of)
    new_promotions = (
        judged.where(F.col("status").isin("CREATED", "SET_MEAL_NOT_AVAILABLE", "PAYMENT_METHOD_REFUSED") & F.col("_on_menu"))
        .select("item_id").distinct().join(live, "item_id", "left_anti")
        .select(
            F.lit("SET_MEAL").alias("promotion_type"),
            joined_text("Auto Promo for Set Meal ", F.col("item_id")).alias("name"),
            now.alias("valid_from"), plus_days(now, AUTO_PROMOTION_DAYS).alias("valid_to"),
            F.lit(AUTO_PROMOTION_VALUE).cast(MONEY).alias("discount_value"), F.col("item_id").alias("set_meal_id"),
        )
    )
    created = judged.where(F.col("status") == "CREATED").select(
        "request_id", "customer_id", "item_id", "promotion_id", "payment_method", "total_amount"
    )
    discount = F.least("voucher_value", "total_amount")
    orders = _voucher_part(created, promotions, customers, as_of).select(
        "request_id", "customer_id", "item_id", now.alias("order_date"), *_order_totals(discount),
        "payment_method", F.lit("COMPLETED").alias("status"),
    )
    lines = created.select(
        "request_id", "item_id", F.lit(1).cast("long").alias("quantity"), F.col("total_amount").alias("price"),
        F.lit(0).cast(MONEY).alias("discount_applied"),
    )
    codes = F.create_map(*[F.lit(x) for x in (
        "CUSTOMER_NOT_FOUND", -20011, "NOT_A_MEMBER", -20010, "SET_MEAL_NOT_AVAILABLE", -20020,
        "PAYMENT_METHOD_REFUSED", CHECK_FAILED,
    )])
    rejects = judged.where(F.col("status") != "CREATED").select(
        "request_id", "customer_id", "item_id", "status", codes[F.col("status")].alias("error_code")
    )
    made = orders.select("customer_id", joined_text(
        "Created SET_MEAL order #", F.col("request_id"), " with item ", F.col("item_id"), " base price=",
        F.col("total_amount"), " final price=", F.col("final_amount"),
    ).alias("details"))
    failed = rejects.select(
        "customer_id", joined_text("Failed to create set meal order: ", F.col("status")).alias("details")
    )
    return {
        "orders": orders, "order_items": lines, "promotions": new_promotions, "rejects": rejects,
        "activity": activity_rows(made.unionByName(failed), "ORDER", as_of, customer="customer_id"),
        "trail": _setmeal_trail(judged, new_promotions, promotions, customers, live, as_of),
    }


def _setmeal_trail(
    judged: DataFrame, new_promotions: DataFrame, promotions: DataFrame, customers: DataFrame, live: DataFrame, as_of: datetime
) -> DataFrame:
    """Every step of every request, as it is written to the audit."""
    # The first request that asks for a meal without a live promotion makes one.
    makers = (
        judged.where(F.col("_known") & (F.col("status") != "NOT_A_MEMBER"))
        .join(new_promotions.select(F.col("set_meal_id").alias("item_id")), "item_id", "left_semi").groupBy("item_id").agg(F.min("request_id").alias("_maker"))
    )
    offered = live.distinct().withColumn("_offered", F.lit(True))
    rows = (
        judged.where(F.col("_known")).join(makers, "item_id", "left").join(offered, "item_id", "left")
        .withColumn("_refused", F.when(
            (F.col("status") == "SET_MEAL_NOT_AVAILABLE") & F.col("_on_menu").isNull() & F.col("_offered").isNull(), "NOT_ON_MENU"
        ).otherwise(F.col("status")))
    )
    priced = with_value_events(
        rows.drop("_known", "is_member").withColumn("order_amount", F.col("total_amount")), promotions, customers, as_of
    ).withColumns({
        "_discount": F.when(F.col("promotion_id").isNull(), F.lit(0).cast(MONEY)).otherwise(F.least("voucher_value", "total_amount")),
    }).withColumn("_final", F.greatest(F.col("total_amount") - F.col("_discount"), F.lit(0).cast(MONEY)))
    # What the caller is told.
    told = {
        "NOT_A_MEMBER": "ORA-20010: Customer is not a member", "NOT_ON_MENU": NO_PARENT,
        "SET_MEAL_NOT_AVAILABLE": "ORA-20020: Set meal not available", "PAYMENT_METHOD_REFUSED": CHECK_VIOLATED,
    }
    texts = F.create_map(*[F.lit(x) for pair in told.items() for x in pair])
    with_voucher = F.col("promotion_id").isNotNull()
    rungs = [
        Rung(["NOT_A_MEMBER"], [event("ORDER", "Customer {customer_id} validated for set meal order")]),
        Rung(["NOT_ON_MENU"], [event(
            "VOUCHER_ASSIGNMENT", "Auto-created promotion for set meal {item_id}", F.col("request_id") == F.col("_maker"))]),
        Rung(["SET_MEAL_NOT_AVAILABLE"], [event("ORDER", "Set meal {item_id} validated for customer {customer_id}"), *[
            F.when(with_voucher, F.get("_value_events", F.lit(k))) for k in range(len(value_events()))]]),
        Rung(["PAYMENT_METHOD_REFUSED"]),
    ]
    events = ladder_events(
        rungs, F.col("_refused"), [event("ORDER", "Created SET_MEAL order #{request_id} with item {item_id} base price={total_amount}"
                                         " promo discount=0 final price={_final}")],
        event("ORDER", "Failed to create set meal order: {_error}"),
    )
    return trail(priced.withColumn("_error", texts[F.col("_refused")]), events, as_of)
