import random
from datetime import timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from perkwell.operators import meals, membership, seasonal, snapshots, vouchers
from perkwell.plans.order_flow import place_alacarte_orders
from seed import (
    CUSTOMERS, HOLDINGS, ITEMS, LEDGER, LOADED, ORDER_ITEMS, ORDERS, changed, day, promotions, rows_of, seed_tables,
    table, tuples,
)


@pytest.fixture(scope="module")
def t(spark):
    return seed_tables(spark)


def requests(spark, ddl, *rows):
    return spark.createDataFrame(list(rows), ddl)


# ---- seasonal redemption -------------------------------------------------

REDEEM = "request_id long, customer_id long, item_id long, order_id long"


@pytest.fixture(scope="module")
def redeem_setup(spark, t):
    live = {"valid_from": LOADED - timedelta(days=1), "valid_to": LOADED + timedelta(days=30)}
    return {
        "customers": table(spark, "customers", changed(CUSTOMERS, "customer_id", {1001: {"points_balance": 600}})),
        "promotions": table(spark, "promotions", changed(promotions(), "promotion_id", {4: live})),
        "orders": table(spark, "orders", ORDERS + [
            {**ORDERS[0], "order_id": 6000, "total_amount": 25, "discount_amount": 0, "final_amount": 25},
        ]),
        "order_items": table(spark, "order_items", ORDER_ITEMS + rows_of(
            "order_item_id order_id item_id quantity price discount_applied",
            (100, 6000, 9, 1, 12.99, 0), (101, 6000, 10, 1, 5.90, 0))),
        "items": t["menu_items"],
    }


def test_redeem_seasonal_cases(spark, redeem_setup):
    asked = requests(
        spark, REDEEM, (1, 1001, 9, 6000), (2, 9999, 9, 6000), (3, 1001, 1, 6000), (4, 1001, 9, 5002),
        (5, 1001, 9, 5001), (6, 1001, 10, 6000), (7, 1003, 9, 5006), (8, 1001, 9, 77),
    )
    broke = redeem_setup["customers"].withColumn(
        "points_balance", F.when(F.col("customer_id") == 1003, 499).otherwise(F.col("points_balance")).cast("long"))
    out = seasonal.redeem_seasonal(asked, **{**redeem_setup, "customers": broke}, as_of=LOADED)
    codes = dict(tuples(out["outcomes"], "request_id", "error_code"))
    assert codes == {1: None, 2: -20053, 3: -20054, 4: -20055, 5: -20051, 6: -20050, 7: -20052, 8: -20055}
    assert tuples(out["redemptions"], "customer_id", "promotion_id", "order_id", "points_used", "item_id",
                  "discount_value") == [(1001, 4, 6000, 500, 9, Decimal("12.99"))]
    ledger = out["point_transactions"].first()
    assert (ledger.points_amount, ledger.transaction_type, ledger.expiry_date) == (
        -500, "REDEMPTION", day("2026-04-28 19:36:00"))
    assert tuples(out["order_items"], "order_item_id", "discount_applied") == [(100, Decimal("12.99"))]
    assert out["activity"].count() == 7


def test_redeem_seasonal_deduct_makes_requests_sequential(spark, redeem_setup):
    asked = requests(spark, REDEEM, (1, 1001, 9, 6000), (2, 1001, 9, 6000))
    plain = seasonal.redeem_seasonal(asked, **redeem_setup, as_of=LOADED)["outcomes"]
    assert [s for _, s in sorted(tuples(plain, "request_id", "status"))] == ["REDEEMED", "REDEEMED"]
    strict = seasonal.redeem_seasonal(asked, **redeem_setup, as_of=LOADED, deduct=True)["outcomes"]
    assert [s for _, s in sorted(tuples(strict, "request_id", "status"))] == ["REDEEMED", "INSUFFICIENT_POINTS"]


def test_expire_seasonal_items(spark, t):
    items = table(spark, "menu_items", ITEMS + [
        {"item_id": 20, "item_type": "SEASONAL", "name": "Test Seasonal Item", "base_price": 25, "is_active": "Y",
         "valid_from": LOADED - timedelta(days=10), "valid_to": LOADED - timedelta(days=1)},
        {"item_id": 21, "item_type": "SEASONAL", "name": "Off already", "base_price": 25, "is_active": "N",
         "valid_from": LOADED - timedelta(days=10), "valid_to": LOADED - timedelta(days=1)},
    ])
    more = table(spark, "promotions", promotions() + [
        {"promotion_id": 30 + i, "promotion_type": "SET_MEAL", "name": "x", "valid_from": LOADED, "valid_to": LOADED,
         "set_meal_id": i} for i in (20, 21)
    ])
    out = seasonal.expire_seasonal_items(items, more, LOADED)
    assert tuples(out["menu_items"], "item_id", "is_active") == [(20, "N")]
    assert sorted(tuples(out["removed_promotions"], "promotion_id")) == [(50,), (51,)]
    assert sorted(tuples(out["activity"], "details")) == [
        ("Deactivated 1 expired seasonal items",), ("Removed 2 associated seasonal promotions",)]


# ---- renewal, expiry, tiers ------------------------------------------------


def test_renewal_arguments_and_scopes(spark, t):
    with pytest.raises(ValueError, match="-20001"):
        membership.renew_memberships(t["customers"], t["membership_tiers"], LOADED, "SOON")
    with pytest.raises(ValueError, match="-20002"):
        membership.renew_memberships(t["customers"], t["membership_tiers"], LOADED, "ALL_DUE", 0)
    people = table(spark, "customers", changed(CUSTOMERS, "customer_id", {
        1001: {"membership_expiry_date": LOADED}, 1002: {"membership_expiry_date": LOADED + timedelta(days=7)},
        1003: {"membership_expiry_date": LOADED + timedelta(days=30)}, 1006: {"is_member": "N"},
        1004: {"membership_expiry_date": None},
    }))

    def scope(kind):
        out = membership.renew_memberships(people, t["membership_tiers"], LOADED, kind, 1)["customers"]
        return {r.customer_id: r.membership_expiry_date for r in out.collect()}

    assert set(scope("EXPIRED_ONLY")) == {1001}
    assert set(scope("URGENT")) == {1001, 1002}
    due = scope("ALL_DUE")
    assert set(due) == {1001, 1002, 1003}
    assert due[1001] == day("2025-05-28 19:36:00") and due[1003] == day("2025-06-28 19:36:00")


def expiring(spark):
    added = [
        {"transaction_id": 90 + n, "customer_id": c, "points_amount": 100, "transaction_type": "PURCHASE",
         "transaction_date": LOADED - timedelta(days=60), "expiry_date": LOADED - timedelta(days=1),
         "description": "Added"} for n, c in enumerate((1001, 1002, 1003))
    ]
    people = changed(CUSTOMERS, "customer_id", {
        1001: {"points_balance": 400}, 1002: {"points_balance": 850}, 1003: {"points_balance": 1100}})
    return table(spark, "point_transactions", LEDGER + added), table(spark, "customers", people)


def test_expire_points(spark, t):
    ledger, people = expiring(spark)
    out = membership.expire_points(ledger, people, LOADED)
    assert dict(tuples(out["balances"], "customer_id", "points_balance")) == {
        1001: 300, 1002: 750, 1003: 1000, 1006: 400}
    assert out["totals"].first().asDict() == {
        "points_expired": 400, "entries_expired": 4, "customers_affected": 4}
    marked = {r.transaction_id: r for r in out["marked"].collect()}
    assert marked[1].description == "Welcome - EXPIRED" and marked[1].expiry_date is None
    after = snapshots.append_from_select(ledger, out["point_transactions"])
    assert membership.expire_points(after, people, LOADED)["point_transactions"].count() == 0


def test_expire_points_named_ids_are_exact_unless_asked(spark, t):
    ledger, people = expiring(spark)
    named = snapshots.append_from_select(ledger, spark.createDataFrame(
        [(1001, -1, "EXPIRY", "Points expired from transaction 901")],
        "customer_id long, points_amount long, transaction_type string, description string"))
    ids = lambda **kw: {r.transaction_id for r in
                        membership.expiry_candidates(named, people, LOADED, **kw).collect()}
    assert ids() == {1, 90, 91, 92}
    assert ids(prefix_compat=True) == {1, 91, 92}


@pytest.mark.parametrize("max_group", [None, 3])
def test_expire_points_skips_what_no_longer_fits(spark, max_group):
    rng = random.Random(5)
    rows, balances = [], {c: rng.randrange(50, 600) for c in range(1, 8)}
    for n in range(120):
        rows.append({
            "transaction_id": n, "customer_id": rng.randrange(1, 8), "points_amount": rng.randrange(1, 300),
            "transaction_type": rng.choice(["PURCHASE", "BONUS"]), "description": "x",
            "transaction_date": LOADED - timedelta(days=rng.randrange(40, 44)),
            "expiry_date": LOADED - timedelta(days=rng.randrange(1, 6)),
        })
    expected, left = set(), dict(balances)
    for r in sorted(rows, key=lambda r: (r["expiry_date"], r["transaction_date"], r["transaction_id"])):
        c = r["customer_id"]
        if r["points_amount"] <= balances[c] and r["points_amount"] <= left[c]:
            left[c] -= r["points_amount"]
            expected.add(r["transaction_id"])
    people = table(spark, "customers", [
        {"customer_id": c, "points_balance": b, "tier_id": 1} for c, b in balances.items()])
    out = membership.expire_points(table(spark, "point_transactions", rows), people, LOADED, max_group=max_group)
    assert {r.transaction_id for r in out["marked"].collect()} == expected
    assert all(r.points_balance == left[r.customer_id] >= 0 for r in out["balances"].collect())


def test_expiry_run_downgrades_on_lowered_balances(spark, t):
    ledger, people = expiring(spark)
    out = membership.expiry_run(ledger, people, t["membership_tiers"], LOADED)
    # 1003 keeps 1000 points: enough for Silver only. 1006 has 400 and is Bronze already.
    assert tuples(out["downgrades"]) == [(1003, 3, 2)]
    assert out["activity"].first().details == \
        "Expired 400 points in 4 entries of 4 customers, 1 downgrades"


def test_downgrade_never_raises_a_tier(spark, t):
    entries = table(spark, "point_transactions", [
        {"transaction_id": n, "customer_id": c, "points_amount": -1, "transaction_type": "EXPIRY",
         "transaction_date": LOADED.replace(hour=0, minute=0)} for n, c in enumerate((1005, 1006, 1002))
    ] + [{"transaction_id": 9, "customer_id": 1004, "points_amount": -1, "transaction_type": "EXPIRY",
          "transaction_date": LOADED - timedelta(days=1)}])
    got = membership.downgrade_tiers(entries, t["customers"], t["membership_tiers"], LOADED)
    assert tuples(got) == [(1005, 5, 4)]


def test_realign_tiers(t):
    out = membership.realign_tiers(t["customers"], t["membership_tiers"], LOADED)
    assert sorted(tuples(out["membership_history"], "customer_id", "old_tier_id", "new_tier_id", "change_reason")) == [
        (1003, 3, 2, "ADMIN"), (1004, 4, 3, "ADMIN"), (1005, 5, 4, "ADMIN"), (1006, 1, 2, "ADMIN")]
    assert out["customers"].count() == 4


# ---- vouchers -----------------------------------------------------------------


def test_bulk_assign(spark, t):
    open_to_all = table(spark, "promotions", changed(promotions(), "promotion_id", {
        1: {"applicable_tier_id": None}, 3: {"applicable_tier_id": None}}))
    held = snapshots.bulk_delete(
        t["customer_promotions"],
        (F.col("promotion_id").isin(1, 3)) & (F.col("acquisition_method") == "AUTO_TIER"))
    def run(holdings, **kw):
        return vouchers.bulk_assign_vouchers(
            t["customers"], t["membership_tiers"], open_to_all, holdings, LOADED, **kw)

    out = run(held)
    pairs = set(tuples(out["customer_promotions"], "customer_id", "promotion_id"))
    assert pairs == {(c, p) for c in range(1001, 1007) for p in (1, 3)} - {(1003, 3)}
    assert out["activity"].first().details == "Total new assignments: 11"
    again = snapshots.append_from_select(held, out["customer_promotions"])
    assert run(again)["customer_promotions"].count() == 0
    assert run(held, voucher_type="BIRTHDAY")["customer_promotions"].count() == 0
    bronze = run(held, voucher_type="AUTO", tier_id=1)["customer_promotions"]
    assert set(tuples(bronze, "customer_id")) == {(1001,), (1006,)}
    own = vouchers.bulk_assign_vouchers(t["customers"], t["membership_tiers"], t["promotions"], held, LOADED)
    assert set(tuples(own["customer_promotions"], "customer_id", "promotion_id")) == {
        (1001, 1), (1001, 3), (1006, 1), (1006, 3)}


VOUCHER = "request_id long, customer_id long, promotion_id long, order_id long"


def test_redeem_vouchers(spark, t):
    people = table(spark, "customers", changed(CUSTOMERS, "customer_id", {1001: {"points_balance": 250}}))
    offers = table(spark, "promotions", changed(promotions(), "promotion_id", {2: {"points_required": 100}}))
    asked = requests(
        spark, VOUCHER, (1, 1001, 2, 5001), (2, 1001, 2, None), (3, 1001, 2, None), (4, 1001, 5, 5001),
        (5, 1001, 99, None), (6, 1001, 1, 5002), (7, 1001, 1, 99), (8, 9999, 1, None), (9, 1002, 5, 5002),
        (10, 1001, 1, None),
    )
    cheap = table(spark, "orders", changed(ORDERS, "order_id", {5002: {"total_amount": 10, "final_amount": 10}}))
    shared = vouchers.redeem_vouchers(asked, offers, people, cheap, LOADED)
    assert dict(tuples(shared["outcomes"], "request_id", "status"))[6] == "REDEEMED"
    out = vouchers.redeem_vouchers(asked, offers, people, cheap, LOADED, owned_only=True)
    status = dict(tuples(out["outcomes"], "request_id", "status"))
    assert status == {
        1: "REDEEMED", 2: "REDEEMED", 3: "INSUFFICIENT_POINTS", 4: "INSUFFICIENT_POINTS", 5: "VOUCHER_NOT_FOUND",
        6: "ORDER_NOT_OWNED", 7: "ORDER_NOT_FOUND", 8: "CUSTOMER_NOT_FOUND", 9: "MIN_SPEND_NOT_MET", 10: "REDEEMED",
    }
    assert tuples(out["orders"]) == [(5001, Decimal("25.00"), Decimal("25.00"))]
    assert sorted(tuples(out["point_transactions"], "customer_id", "points_amount")) == [(1001, -100), (1001, -100)]
    assert sorted(tuples(out["redemptions"], "promotion_id", "points_used")) == [(1, 0), (2, 100), (2, 100)]
    assert out["activity"].count() == 10


def loop_redeem(rows, balances, room):
    """Brute force: requests in order; each needs points and room on its order."""
    result = {}
    for request, customer, promo, order in sorted(rows):
        points, value = promo * 7 % 60, promo * 5 % 40 + 1
        if balances[customer] < points:
            result[request] = "INSUFFICIENT_POINTS"
        elif order is not None and room[order] < value:
            result[request] = "DISCOUNT_ABOVE_TOTAL"
        else:
            result[request] = "REDEEMED"
            balances[customer] -= points
            if order is not None:
                room[order] -= value
    return result


@pytest.mark.parametrize(("seed", "shared"), [(11, False), (12, False), (11, True), (12, True), (13, True)])
def test_redeem_vouchers_many_per_customer_and_order(spark, t, seed, shared):
    rng = random.Random(seed)
    balances = {c: rng.randrange(0, 260) for c in range(1, 5)}
    heads = {o: (1 + o % 4, rng.randrange(20, 90)) for o in range(12)}
    rows = []
    for n in range(90):
        order = rng.choice([None, *heads])
        customer = heads[order][0] if order is not None and not shared else rng.randrange(1, 5)
        rows.append((n, customer, rng.randrange(1, 30), order))
    people = table(spark, "customers", [
        {"customer_id": c, "points_balance": b, "tier_id": 1} for c, b in balances.items()])
    offers = table(spark, "promotions", [
        {"promotion_id": p, "promotion_type": "VOUCHER", "discount_value": p * 5 % 40 + 1,
         "points_required": p * 7 % 60, "valid_from": LOADED, "valid_to": LOADED} for p in range(1, 30)])
    orders = table(spark, "orders", [
        {"order_id": o, "customer_id": c, "total_amount": total, "discount_amount": 0, "final_amount": total}
        for o, (c, total) in heads.items()])
    out = vouchers.redeem_vouchers(
        spark.createDataFrame(rows, VOUCHER), offers, people, orders, LOADED)
    expected = loop_redeem(rows, dict(balances), {o: total for o, (_, total) in heads.items()})
    got = dict(tuples(out["outcomes"], "request_id", "status"))
    assert got == expected
    assert all(r.final_amount >= 0 for r in out["orders"].collect())


def test_redeem_vouchers_strict_and_percent(spark, t):
    asked = requests(spark, VOUCHER, (1, 1001, 1, 5001), (2, 1002, 2, None), (3, 1006, 3, None), (4, 1001, 5, None))
    with pytest.raises(ValueError):
        vouchers.redeem_vouchers(asked, t["promotions"], t["customers"], t["orders"], LOADED, strict=True)
    out = vouchers.redeem_vouchers(
        asked, t["promotions"], t["customers"], t["orders"], LOADED, t["customer_promotions"],
        value_mode="percent", strict=True)
    assert dict(tuples(out["outcomes"], "request_id", "status")) == {
        1: "REDEEMED", 2: "TIER_MISMATCH", 3: "NOT_HELD", 4: "NOT_LIVE"}
    assert tuples(out["orders"], "discount_amount") == [(Decimal("10.00"),)]


# ---- orders ---------------------------------------------------------------------

ALACARTE = "request_id long, customer_id long, item_ids string, payment_method string, promotion_id long"
SETMEAL = "request_id long, customer_id long, item_id long, payment_method string, promotion_id long"


def test_alacarte_orders(spark, t):
    people = table(spark, "customers", changed(CUSTOMERS, "customer_id", {1002: {"is_member": "N"}}))
    asked = requests(
        spark, ALACARTE, (1, 1001, "1,2,3", "CARD", None), (2, 1001, " 1 ,3,,1, 5,77", "CARD", 1),
        (3, 1002, "1", "CARD", None), (4, 9999, "1", "CARD", None), (5, 1001, "5,7", "CARD", None),
        (6, 1001, "1,x", "CARD", None), (7, 1001, None, "CARD", None), (8, 1001, "1.5,1", "CASH", None),
    )
    out = meals.create_alacarte_orders(asked, people, t["menu_items"], t["promotions"], LOADED)
    orders = {r.request_id: r for r in out["orders"].collect()}
    assert {k: (r.total_amount, r.discount_amount, r.final_amount, r["items"]) for k, r in orders.items()} == {
        1: (Decimal("21.40"), 0, Decimal("21.40"), 3),
        2: (Decimal("23.30"), Decimal("2.33"), Decimal("20.97"), 3),
        8: (Decimal("8.90"), 0, Decimal("8.90"), 1),
    }
    assert dict(tuples(out["rejects"], "request_id", "error_code")) == {
        3: -20010, 4: -20010, 5: -20011, 6: None, 7: -20011}
    assert sorted(tuples(out["skipped"], "request_id", "item_text")) == [
        (2, "5"), (2, "77"), (5, "5"), (5, "7"), (8, "1.5")]
    assert out["order_items"].where("request_id = 2 AND item_id = 1").count() == 2
    assert out["activity"].count() == 8


def test_setmeal_orders(spark, t):
    items = table(spark, "menu_items", changed(ITEMS, "item_id", {6: {"is_active": "N"}}))
    people = table(spark, "customers", changed(CUSTOMERS, "customer_id", {1003: {"is_member": "N"}}))
    asked = requests(
        spark, SETMEAL, (1, 1001, 5, "CARD", 1), (2, 1002, 5, "ONLINE", None), (3, 9999, 5, "CARD", None),
        (4, 1003, 5, "CARD", None), (5, 1001, 6, "CARD", None), (6, 1001, 404, "CARD", None),
    )
    out = meals.create_setmeal_orders(asked, people, items, t["promotions"], LOADED)
    assert sorted(tuples(out["orders"], "request_id", "total_amount", "discount_amount", "final_amount")) == [
        (1, Decimal("24.90"), Decimal("2.49"), Decimal("22.41")), (2, Decimal("24.90"), 0, Decimal("24.90"))]
    assert dict(tuples(out["rejects"], "request_id", "error_code")) == {3: -20011, 4: -20010, 5: -20020, 6: -20020}
    # Item 5 has a live promotion; item 6 gets one although its order fails; item 404 is on no menu.
    made = out["promotions"].collect()
    assert [(r.set_meal_id, r.name, r.discount_value, r.valid_to) for r in made] == [
        (6, "Auto Promo for Set Meal 6", Decimal("5.00"), LOADED + timedelta(days=30))]


def test_order_flow_drops_the_discount_when_redemption_fails(spark, t):
    offers = table(spark, "promotions", changed(promotions(), "promotion_id", {1: {"points_required": 200}}))
    held = table(spark, "customer_promotions", HOLDINGS)
    asked = requests(
        spark, ALACARTE, (1, 1001, "1", "CARD", 1), (2, 1001, "1,2", "CARD", 1), (3, 1001, "1,2", "CARD", 1),
        (4, 1001, "2", "CARD", None))
    out = place_alacarte_orders(asked, t["customers"], t["menu_items"], offers, held, LOADED)
    # The voucher is taken off as 10 in money, more than order 1 is worth; order 3 finds too few points left.
    assert dict(tuples(out["voucher_outcomes"], "request_id", "status")) == {
        1: "DISCOUNT_ABOVE_TOTAL", 2: "REDEEMED", 3: "INSUFFICIENT_POINTS"}
    assert dict(tuples(out["orders"], "request_id", "discount_amount")) == {1: 0, 2: Decimal("1.59"), 3: 0, 4: 0}
    assert dict(tuples(out["orders"], "request_id", "final_amount"))[3] == Decimal("15.90")
    assert tuples(out["customer_promotions"], "customer_id", "promotion_id", "is_used") == [(1001, 1, "Y")]
    assert tuples(out["point_transactions"], "points_amount") == [(-200,)]


# ---- set-based changes -------------------------------------------------------------


def test_append_update_delete(spark, t):
    added = snapshots.append_from_select(
        t["point_transactions"],
        t["customers"].where("customer_id < 1004").select("customer_id", F.lit(100).alias("points_amount")))
    assert added.count() == 8 and added.where("transaction_id IS NULL").count() == 3
    moved = snapshots.bulk_update(t["promotions"], F.col("points_required") > 400, {
        "applicable_tier_id": F.lit(None), "valid_to": F.col("valid_to") + F.expr("INTERVAL 1 DAY")})
    rows = {r.promotion_id: r for r in moved.collect()}
    assert rows[4].valid_to == day("2025-12-01") and rows[5].applicable_tier_id == 3 and rows[1].applicable_tier_id == 1
    left = snapshots.bulk_delete(t["promotions"], F.col("points_required") > 400)
    assert sorted(tuples(left, "promotion_id")) == [(1,), (2,), (3,), (5,), (6,)]
    kept = snapshots.bulk_delete(t["customer_promotions"], keys=left.select("promotion_id"), on="promotion_id")
    assert tuples(kept, "customer_id") == [(1005,)]


def test_a_held_voucher_is_used_once_per_batch(spark, t):
    asked = requests(spark, VOUCHER, (1, 1001, 1, 5001), (2, 1001, 1, None), (3, 1001, 1, 5001))
    out = vouchers.redeem_vouchers(
        asked, t["promotions"], t["customers"], t["orders"], LOADED, t["customer_promotions"], strict=True)
    assert dict(tuples(out["outcomes"], "request_id", "status")) == {
        1: "REDEEMED", 2: "ALREADY_USED", 3: "ALREADY_USED"}
    assert out["redemptions"].count() == 1


@pytest.mark.parametrize(("method", "made"), [("CARD", True), (None, True), ("BITCOIN", False)])
def test_payment_methods_of_orders(spark, t, method, made):
    out = meals.create_alacarte_orders(
        requests(spark, ALACARTE, (1, 1001, "1,3", method, None)), t["customers"], t["menu_items"], t["promotions"], LOADED)
    assert out["orders"].count() == int(made) and out["order_items"].count() == 2 * int(made)
    assert tuples(out["rejects"], "status", "error_code") == ([] if made else [("PAYMENT_METHOD_REFUSED", -2290)])
