"""Small loyalty tables: the known example rows and a helper to build more."""

from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DecimalType, StructField, StructType

from perkwell.schemas import SCHEMAS

LOADED = datetime(2025, 4, 28, 19, 36)


def frame(spark: SparkSession, schema: StructType, rows: list[dict]) -> DataFrame:
    nullable = StructType([StructField(f.name, f.dataType, True) for f in schema])
    decimals = {f.name for f in schema if isinstance(f.dataType, DecimalType)}
    data = []
    for row in rows:
        unknown = set(row) - set(nullable.names)
        assert not unknown, unknown
        data.append(tuple(
            Decimal(str(row[c])) if c in decimals and row.get(c) is not None else row.get(c) for c in nullable.names
        ))
    return spark.createDataFrame(data, nullable)


def table(spark: SparkSession, name: str, rows: list[dict]) -> DataFrame:
    return frame(spark, SCHEMAS[name], rows)


def rows_of(names: str, *values: tuple) -> list[dict]:
    return [dict(zip(names.split(), v, strict=True)) for v in values]


def day(text: str) -> datetime:
    return datetime.fromisoformat(text)


TIERS = rows_of(
    "tier_id tier_name points_required discount_percentage renewal_fee birthday_bonus_points points_expiry_months"
    " base_earn_rate",
    (1, "Bronze", 0, 5, 10, 50, 12, 1), (2, "Silver", 500, 10, 15, 100, 12, 1.2),
    (3, "Gold", 1500, 15, 20, 150, 12, 1.5), (4, "Platinum", 3000, 20, 25, 200, 12, 2),
    (5, "Diamond", 5000, 25, 30, 250, 12, 2.5),
)

_SPANS = {
    9: ("2025-10-15", "2025-11-30", 1000), 10: ("2025-09-15", "2025-11-15", 200),
    11: ("2025-09-01", "2025-09-30", 500), 12: ("2025-06-01", "2025-08-31", 800),
    13: ("2025-12-01", "2026-02-28", 300),
}
ITEMS = [
    {
        "item_id": i, "item_type": kind, "name": name, "base_price": price, "is_active": "Y",
        **({"valid_from": day(_SPANS[i][0]), "valid_to": day(_SPANS[i][1]), "current_stock": _SPANS[i][2],
            "initial_stock": _SPANS[i][2]} if i in _SPANS else {}),
    }
    for i, kind, name, price in (
        (1, "A_LA_CARTE", "Cheeseburger", 8.90), (2, "A_LA_CARTE", "Chicken Nuggets", 7.00),
        (3, "A_LA_CARTE", "Garden Salad", 5.50), (4, "A_LA_CARTE", "Chocolate Shake", 4.50),
        (5, "SET_MEAL", "Family Combo", 24.90), (6, "SET_MEAL", "Value Meal", 12.50),
        (7, "INGREDIENT", "Fries", 3.50), (8, "INGREDIENT", "Soft Drink", 2.50),
        (9, "SEASONAL", "Hello Kitty Happy Meal", 12.99), (10, "SEASONAL", "Pumpkin Spice Latte", 5.90),
        (11, "SEASONAL", "Festival Mooncake Set", 18.50), (12, "SEASONAL", "Summer BBQ Burger", 9.99),
        (13, "SEASONAL", "Winter Hot Chocolate", 4.99),
    )
]
COMPONENTS = rows_of(
    "set_meal_id component_id quantity", (5, 1, 2), (5, 7, 2), (5, 8, 2), (6, 1, 1), (6, 7, 1), (6, 8, 1)
)
CUSTOMERS = [
    {
        "customer_id": i, "name": f"Member {i}", "email": f"m{i}@example.com", "phone": f"555-{i}", "tier_id": tier,
        "points_balance": points, "points_expiry_date": day(points_end), "membership_expiry_date": day(end),
        "birth_date": day(born), "is_member": "Y", "membership_status": "ACTIVE", "renewal_count": 0,
    }
    for i, tier, points, points_end, end, born in (
        (1001, 1, 300, "2025-12-01", "2025-12-01", "1990-04-07"),
        (1002, 2, 750, "2026-03-21", "2026-03-21", "1988-07-12"),
        (1003, 3, 1000, "2026-01-10", "2026-01-10", "1995-11-30"),
        (1004, 4, 2000, "2026-02-28", "2026-02-28", "1992-03-18"),
        (1005, 5, 3200, "2026-03-05", "2026-03-05", "1985-05-25"),
        (1006, 1, 500, "2025-12-31", "2025-03-01", "1990-01-01"),
    )
]


def promotions(loaded: datetime = LOADED) -> list[dict]:
    def live(days: int) -> dict:
        return {"valid_from": loaded, "valid_to": loaded + timedelta(days=days)}

    return [
        {"promotion_id": 1, "promotion_type": "VOUCHER", "name": "10% Off", **live(30), "discount_value": 10,
         "voucher_code": "DISC10", "is_auto_assign": "Y", "applicable_tier_id": 1},
        {"promotion_id": 2, "promotion_type": "VOUCHER", "name": "20% Off", **live(30), "discount_value": 20,
         "voucher_code": "DISC20", "is_auto_assign": "N", "applicable_tier_id": 3},
        {"promotion_id": 3, "promotion_type": "VOUCHER", "name": "5% Off", **live(15), "discount_value": 5,
         "voucher_code": "DISC5", "is_auto_assign": "Y", "applicable_tier_id": 1},
        {"promotion_id": 4, "promotion_type": "SEASONAL", "name": "Hello Kitty Redemption",
         "valid_from": day("2025-10-15"), "valid_to": day("2025-11-30"), "is_auto_assign": "N",
         "points_required": 500, "min_spend": 20, "set_meal_id": 9},
        {"promotion_id": 5, "promotion_type": "SEASONAL", "name": "Pumpkin Spice Latte Redemption",
         "valid_from": day("2025-09-01"), "valid_to": day("2025-09-30"), "is_auto_assign": "Y",
         "points_required": 300, "min_spend": 30, "set_meal_id": 10, "applicable_tier_id": 3},
        {"promotion_id": 6, "promotion_type": "SET_MEAL", "name": "Family Combo Discount", **live(60),
         "discount_value": 15, "is_auto_assign": "N", "min_spend": 50, "set_meal_id": 5},
    ]


ORDERS = [
    {"order_id": i, "customer_id": c, "order_date": LOADED, "total_amount": t, "discount_amount": d,
     "final_amount": f, "payment_method": p, "status": "COMPLETED"}
    for i, c, t, d, f, p in (
        (5001, 1001, 50, 5, 45, "CARD"), (5002, 1002, 35, 0, 35, "CASH"), (5003, 1003, 60, 10, 50, "ONLINE"),
        (5004, 1004, 80, 15, 65, "CARD"), (5005, 1005, 25, 0, 25, "CASH"), (5006, 1003, 32.99, 0, 32.99, "CARD"),
        (5007, 1004, 55.50, 18.50, 37, "ONLINE"),
    )
]
ORDER_ITEMS = [
    {"order_item_id": n, **row} for n, row in enumerate(rows_of(
        "order_id item_id quantity price discount_applied",
        (5001, 1, 1, 8.90, 0), (5002, 3, 2, 7.00, 0), (5003, 2, 1, 24.90, 5), (5004, 5, 1, 7.00, 1),
        (5005, 4, 1, 6.90, 0), (5006, 9, 1, 12.99, 0), (5006, 1, 2, 8.90, 0), (5007, 10, 1, 18.50, 18.50),
        (5007, 2, 1, 24.90, 0),
    ), 1)
]
REDEMPTIONS = [
    {"redemption_id": n, "redemption_status": "COMPLETED", **row} for n, row in enumerate(rows_of(
        "customer_id promotion_id order_id points_used item_id",
        (1001, 1, 5001, 100, None), (1002, 2, 5002, 300, None), (1003, 3, 5003, 500, None),
        (1004, 6, 5007, 300, 10), (1005, 4, None, 200, 9),
    ), 1)
]
LEDGER = [
    {"transaction_id": n, "customer_id": 1006, "transaction_date": LOADED - timedelta(days=200), **row}
    for n, row in enumerate(rows_of(
        "points_amount transaction_type expiry_date description",
        (100, "BONUS", day("2024-12-31"), "Welcome"), (200, "PURCHASE", LOADED + timedelta(days=15), "Purchase"),
        (300, "BONUS", day("2025-07-28"), "Bonus"), (400, "PURCHASE", day("2026-04-28"), "Purchase"),
        (-150, "REDEMPTION", None, "Reward"),
    ), 1)
]
HISTORY = [
    {"history_id": n, "change_date": LOADED - timedelta(days=n), **row} for n, row in enumerate(rows_of(
        "customer_id old_tier_id new_tier_id change_reason",
        (1001, None, 1, "SIGNUP"), (1002, None, 1, "SIGNUP"), (1003, 1, 2, "ADMIN"), (1004, None, 1, "SIGNUP"),
        (1005, 1, 3, "ADMIN"),
    ), 6)
]
HOLDINGS = [
    {"date_acquired": LOADED, "used_date": LOADED if row["is_used"] == "Y" else None, **row} for row in rows_of(
        "customer_id promotion_id is_used acquisition_method",
        (1001, 1, "N", "AUTO_TIER"), (1002, 2, "Y", "POINT_REDEEM"), (1003, 3, "N", "MANUAL"),
        (1004, 6, "N", "BIRTHDAY"), (1005, 4, "Y", "AUTO_TIER"),
    )
]
ACTIVITY = [
    {"activity_id": n, "customer_id": 1000 + n, "activity_type": kind, "activity_date": LOADED}
    for n, kind in enumerate((
        "LOGIN", "LOGIN", "ORDER", "VOUCHER_REDEMPTION", "TIER_CHANGE", "SEASONAL_REDEMPTION",
    ), 1)
]


def seed_tables(spark: SparkSession) -> dict[str, DataFrame]:
    rows = {
        "membership_tiers": TIERS, "customers": CUSTOMERS, "menu_items": ITEMS, "promotions": promotions(),
        "orders": ORDERS, "point_transactions": LEDGER, "membership_history": HISTORY,
        "customer_promotions": HOLDINGS, "redemptions": REDEMPTIONS, "set_meal_components": COMPONENTS,
        "order_items": ORDER_ITEMS, "customer_activity": ACTIVITY,
    }
    return {name: table(spark, name, r) for name, r in rows.items()}


def tuples(df: DataFrame, *columns: str) -> list[tuple]:
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


def changed(rows: list[dict], key: str, updates: dict[int, dict]) -> list[dict]:
    """Copies of ``rows`` with some columns replaced, by key value."""
    return [{**r, **updates.get(r[key], {})} for r in rows]
