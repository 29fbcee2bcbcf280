from datetime import timedelta
from decimal import Decimal

import pytest

from perkwell.operators import meals, membership, seasonal, vouchers
from seed import (
    COMPONENTS, CUSTOMERS, ITEMS, LOADED, ORDERS, changed, day, promotions, rows_of, seed_tables, table, tuples,
)


@pytest.fixture(scope="module")
def t(spark):
    return seed_tables(spark)


def asked(spark, ddl, *rows):
    df = spark.createDataFrame(list(rows), ddl)
    for name, kind in df.dtypes:
        if kind == "double":
            df = df.withColumn(name, df[name].cast("decimal(10,2)"))
    return df


def test_seasonal_redemption_eligibility(spark, t):
    live = {"promotion_type": "SEASONAL", "valid_from": LOADED, "valid_to": LOADED + timedelta(days=30)}
    more = table(spark, "promotions", promotions() + [
        {**live, "promotion_id": 7, "name": "Mooncake", "points_required": 400, "min_spend": 15, "set_meal_id": 11,
         "applicable_tier_id": 2},
        {**live, "promotion_id": 8, "name": "Mooncake again", "points_required": 0, "set_meal_id": 11},
    ])
    requests = asked(
        spark, "request_id long, customer_id long, item_id long, item_price double",
        (1, 1003, 11, 18.5), (2, 1003, 12, 18.5), (3, 1001, 11, 18.5), (4, 1003, 11, 12.0), (5, 1006, 11, 18.5),
        (6, 1010, 11, 18.5), (7, 1003, 11, None), (8, 1003, 11, 15.0), (9, 1010, 12, 1.0),
    )
    got = dict(tuples(seasonal.seasonal_redemption_eligibility(requests, t["customers"], more, LOADED),
                      "request_id", "eligibility"))
    assert got == {
        1: "ELIGIBLE", 2: "NO_PROMOTION", 3: "INSUFFICIENT_POINTS", 4: "MIN_SPEND_NOT_MET", 5: "TIER_RESTRICTED",
        6: "INVALID CUSTOMER", 7: "ELIGIBLE", 8: "ELIGIBLE", 9: "NO_PROMOTION",
    }


def test_predict_seasonal_demand(spark, t):
    requests = asked(spark, "item_id long, days_remaining long", (9, 15), (999, 15), (1, 15), (9, 0))
    got = sorted(tuples(seasonal.predict_seasonal_demand(requests, t["order_items"], t["orders"], LOADED)))
    # Item 1 sold 1 and 2: mean 1.5, 15 days, 1.2 -> 27.
    assert got == [(1, 15, 27), (9, 0, 0), (9, 15, 18), (999, 15, 0)]
    old = table(spark, "orders", changed(ORDERS, "order_id", {5006: {"order_date": LOADED - timedelta(days=31)}}))
    got = dict(tuples(seasonal.predict_seasonal_demand(requests, t["order_items"], old, LOADED).where(
        "days_remaining = 15"), "item_id", "predicted_demand"))
    assert got == {9: 0, 999: 0, 1: 18}


def test_upgrade_value(spark, t):
    requests = asked(spark, "customer_id long", (1001,), (1005,), (9999,), (1006,))
    got = dict(tuples(membership.upgrade_value(requests, t["customers"], t["membership_tiers"])))
    assert got[1001] == "Upgrade to Silver | Discount Increase: +5% | Points Needed: 200 | Renewal Fee Change: +$5"
    assert got[1005] == got[9999] == "At highest tier or invalid customer"
    assert "Points Needed: 0 |" in got[1006]


def test_membership_health(spark, t):
    now = LOADED
    people = table(spark, "customers", changed(CUSTOMERS, "customer_id", {
        1001: {"membership_status": "CANCELLED", "last_renewal_date": day("2025-02-03")},
        1002: {"membership_status": "PENDING"},
        1003: {"membership_expiry_date": now + timedelta(hours=12)},
        1004: {"membership_expiry_date": now + timedelta(days=7)},
        1005: {"membership_expiry_date": now + timedelta(days=30, hours=23)},
        1006: {"membership_expiry_date": None},
    }))
    requests = asked(spark, "customer_id long", *[(i,) for i in range(1001, 1008)])
    got = dict(tuples(membership.membership_health(requests, people, t["membership_tiers"], now)))
    assert got == {
        1001: "Bronze membership: CANCELLED (last renewed: 03-FEB-2025)",
        1002: "Silver membership: PENDING (last renewed: )",
        1003: "Gold membership: EXPIRED 0 days ago",
        1004: "Platinum membership: CRITICAL - renew in 7 days",
        1005: "Diamond membership: Renewal due in 30 days",
        1006: "Bronze membership: Active (expires in  days)",
        1007: "Customer not found",
    }


def test_voucher_codes(spark, t):
    ids = spark.range(50)
    codes = dict(tuples(vouchers.voucher_codes(ids, t["promotions"], "sum", 12, "s")))
    assert len(set(codes.values())) == 50
    assert all(len(c) == 12 and c.startswith("SUM") and c[3:].isalpha() for c in codes.values())
    assert codes == dict(tuples(vouchers.voucher_codes(ids, t["promotions"], "sum", 12, "s")))
    longer = tuples(vouchers.voucher_codes(spark.range(3), t["promotions"], None, 70, "s"))
    assert all(len(c) == 70 for _, c in longer)
    short = tuples(vouchers.voucher_codes(spark.range(3), t["promotions"], "prefix", 3, "s"))
    assert all(len(c) == 7 for _, c in short)
    assert vouchers.voucher_generation_log(ids.selectExpr("'AB' AS voucher_code"), None, 12, LOADED).first().details \
        == 'Generated voucher code "AB" with prefix "" and length 12'


def test_voucher_codes_draw_again_on_collisions(spark, t):
    # One letter leaves 16 codes, two of them used: 14 ids must share out the rest.
    used = spark.createDataFrame([("A",), ("B",), (None,)], "voucher_code string")
    codes = tuples(vouchers.voucher_codes(spark.range(14), used, None, 1, "x"))
    assert sorted(c for _, c in codes) == sorted(set("CDEFGHJKLMNPQR"))
    with pytest.raises(ValueError):
        vouchers.voucher_codes(spark.range(15), used, None, 1, "x")


def test_voucher_value(spark, t):
    more = table(spark, "promotions", promotions() + [
        {"promotion_id": 7, "promotion_type": "VOUCHER", "name": "Fixed", "valid_from": LOADED, "valid_to": LOADED,
         "discount_value": 150, "min_spend": 100},
        {"promotion_id": 8, "promotion_type": "VOUCHER", "name": "Gone", "valid_from": LOADED - timedelta(days=2),
         "valid_to": LOADED - timedelta(days=1), "discount_value": 5},
        {"promotion_id": 9, "promotion_type": "VOUCHER", "name": "Whole", "valid_from": LOADED, "valid_to": LOADED,
         "discount_value": 100},
    ])
    cases = [
        (1, 24.9, 1001, "2.49"), (1, 24.9, 1002, "0"), (1, 24.9, 9999, "0"), (7, 99.99, 1001, "0"),
        (7, 100.0, 9999, "100"), (7, 200.0, 1001, "150"), (8, 50.0, 1001, "0"), (4, 50.0, 1001, "0"),
        (99, 50.0, 1001, "0"), (1, 0.05, 1001, "0.01"), (9, 7.77, 1001, "7.77"), (1, None, 1001, None),
    ]
    requests = asked(spark, "request_id long, promotion_id long, order_amount double, customer_id long",
                     *[(n, *c[:3]) for n, c in enumerate(cases)])
    got = dict(tuples(vouchers.voucher_value(requests, more, t["customers"], LOADED), "request_id", "voucher_value"))
    assert got == {n: None if c[3] is None else Decimal(c[3]) for n, c in enumerate(cases)}


def test_validate_setmeal(spark, t):
    items = table(spark, "menu_items", changed(ITEMS, "item_id", {
        7: {"item_type": "SET_MEAL"}, 1: {"is_active": "N"}, 9: {"item_type": "SET_MEAL", "is_active": "N"},
    }))
    parts = table(spark, "set_meal_components", [r for r in COMPONENTS if r["set_meal_id"] == 6] + rows_of(
        "set_meal_id component_id quantity", (5, 7, 2), (5, 8, 2)))
    requests = asked(spark, "item_id long", (5,), (999,), (7,), (6,), (9,), (2,))
    got = dict(tuples(meals.validate_setmeal(requests, items, parts)))
    assert got == {5: "VALID", 999: "INVALID_SETMEAL", 7: "NO_COMPONENTS", 6: "INACTIVE_COMPONENTS",
                   9: "INVALID_SETMEAL", 2: "INVALID_SETMEAL"}


def test_setmeal_price(spark, t):
    requests = asked(
        spark, "request_id long, item_id long, customer_id long, apply_tier_discount boolean",
        (1, 5, 1001, True), (2, 5, 1001, False), (3, 5, 1005, True), (4, 5, 9999, True), (5, 999, 1001, True),
    )
    got = dict(tuples(meals.setmeal_price(
        requests, t["menu_items"], t["set_meal_components"], t["customers"], t["membership_tiers"]),
        "request_id", "setmeal_price"))
    assert got == {1: Decimal("23.84"), 2: Decimal("25.33"), 3: Decimal("20.86"), 4: Decimal("25.33"), 5: None}


def test_the_last_free_code_is_found(spark):
    used = spark.createDataFrame([(c,) for c in "ABCDEFGHJKLMNPQ"] + [("R2",), (None,), ("PA",)], "voucher_code string")
    for seed in range(3):
        assert tuples(vouchers.voucher_codes(spark.range(1), used, None, 1, str(seed))) == [(0, "R")]
    with pytest.raises(ValueError):
        vouchers.voucher_codes(spark.range(2), used, None, 1, "x")
