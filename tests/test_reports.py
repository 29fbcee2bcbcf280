from datetime import timedelta
from decimal import Decimal

import pytest

from perkwell.operators import audit, meals, membership, seasonal, vouchers
from seed import (
    CUSTOMERS, LOADED, changed, day, promotions, seed_tables, table, tuples,
)


@pytest.fixture(scope="module")
def t(spark):
    return seed_tables(spark)


def test_seasonal_item_performance(t):
    got = {r.item_id: r for r in seasonal.seasonal_item_performance(
        t["menu_items"], t["order_items"], t["orders"], t["redemptions"], t["promotions"]).collect()}
    assert set(got) == {9, 10}
    assert tuple(got[10])[3:] == (1, Decimal("0.00"), 1, Decimal("0.50"), Decimal("1.0"), Decimal("0.00"))
    assert tuple(got[9])[3:] == (1, Decimal("12.99"), 0, Decimal("0.10"), Decimal("1.0"), Decimal("0.00"))


def test_seasonal_performance_counts_every_redemption_of_the_order(spark, t):
    extra = table(spark, "redemptions", [
        {"redemption_id": 100 + n, "customer_id": 1003, "promotion_id": p, "order_id": 5006, "points_used": 0}
        for n, p in enumerate((4, 4, 1))
    ])
    row = seasonal.seasonal_item_performance(
        t["menu_items"], t["order_items"], t["orders"], t["redemptions"].unionByName(extra), t["promotions"]
    ).where("item_id = 9").first()
    assert (row.total_sold, row.points_redemptions, row.revenue) == (3, 3, Decimal("38.97"))
    assert row.min_spend_met == Decimal("66.67")


def test_seasonal_inventory_status(t):
    got = tuples(seasonal.seasonal_inventory_status(t["menu_items"], t["promotions"], day("2025-04-27 09:15:00")))
    assert [(r[0], r[3], r[4], r[5], r[6]) for r in got] == [
        (i, d, "N", 0, 0) for i, d in ((12, 126), (11, 156), (10, 202), (9, 217), (13, 307))
    ]


def test_inventory_status_has_a_row_per_live_promotion(spark, t):
    more = table(spark, "promotions", changed(promotions(), "promotion_id", {
        4: {"valid_from": LOADED, "set_meal_id": 9}, 6: {"set_meal_id": 9},
    }))
    got = tuples(
        seasonal.seasonal_inventory_status(t["menu_items"], more, LOADED).where("item_id = 9"),
        "redemption_allowed", "points_cost",
    )
    assert sorted(got) == [("Y", 0), ("Y", 500)]


def test_upcoming_renewals_after_renewal(spark, t):
    late = LOADED - timedelta(days=10)
    people = table(spark, "customers", changed(CUSTOMERS, "customer_id", {
        1001: {"membership_expiry_date": late}, 1002: {"membership_expiry_date": late},
    }))
    before = tuples(membership.upcoming_renewals(people, t["membership_tiers"], LOADED), "customer_id",
                    "renewal_status")
    assert {c for c, s in before if s == "EXPIRED"} == {1001, 1002, 1006}
    renewed = membership.renew_memberships(people, t["membership_tiers"], LOADED, "EXPIRED_ONLY", 12)
    assert {r.customer_id for r in renewed["customers"].collect()} == {1001, 1002, 1006}
    assert renewed["activity"].first().details == "Renewed 3 memberships, failed 0"
    after = people.join(renewed["customers"].select("customer_id"), "customer_id", "left_anti").unionByName(
        renewed["customers"])
    got = tuples(membership.upcoming_renewals(after, t["membership_tiers"], LOADED), "customer_id",
                 "days_until_expiry", "renewal_status")
    assert got[:3] == [(1003, 256, "ACTIVE"), (1004, 305, "ACTIVE"), (1005, 310, "ACTIVE")]
    # 365 days lie between; the listed figure was printed a few hours after the job ran.
    assert {(c, s) for c, _, s in got[3:]} == {(1001, "ACTIVE"), (1002, "ACTIVE"), (1006, "ACTIVE")}
    later = LOADED + timedelta(minutes=1)
    assert {r[1] for r in tuples(membership.upcoming_renewals(after, t["membership_tiers"], later), "customer_id",
                                 "days_until_expiry")[3:]} == {364}


def test_renewal_status_bounds_and_null_expiry(spark, t):
    spans = {1001: timedelta(0), 1002: timedelta(days=7), 1003: timedelta(days=30), 1004: timedelta(days=30, seconds=1)}
    people = table(spark, "customers", changed(CUSTOMERS, "customer_id", {
        **{c: {"membership_expiry_date": LOADED + s} for c, s in spans.items()},
        1005: {"membership_expiry_date": None},
        1006: {"is_member": "N"},
    }))
    got = dict(tuples(membership.upcoming_renewals(people, t["membership_tiers"], LOADED), "customer_id",
                      "renewal_status"))
    assert got == {1001: "EXPIRED", 1002: "URGENT", 1003: "UPCOMING", 1004: "ACTIVE", 1005: "ACTIVE"}


def test_tier_comparison_and_status(t):
    rows = {r.customer_id: r for r in membership.tier_comparison(t["customers"], t["membership_tiers"]).collect()}
    assert tuple(rows[1001])[2:] == ("Bronze", 300, "Silver", 200, Decimal("5.00"), Decimal("5.00"),
                                     "NEEDS_MORE_POINTS")
    assert rows[1005].upgrade_status == "MAX_TIER" and rows[1005].next_tier is None
    assert rows[1006].upgrade_status == "ELIGIBLE_NOW" and rows[1006].points_needed == 0
    status = {r.customer_id: r for r in membership.customer_status(t["customers"], t["membership_tiers"]).collect()}
    assert (status[1001].current_tier_requirement, status[1001].next_tier_requirement,
            status[1001].points_needed) == (0, 500, 200)
    assert tuples(membership.tier_requirements(t["membership_tiers"]), "points_required") == [
        (0,), (500,), (1500,), (3000,), (5000,)]


def test_assignable_vouchers_and_assignment_status(spark, t):
    more = table(spark, "promotions", promotions() + [{
        "promotion_id": 7, "promotion_type": "VOUCHER", "name": "BDAY treat", "valid_from": LOADED,
        "valid_to": LOADED + timedelta(days=1), "discount_value": 5, "is_auto_assign": "Y",
    }])
    got = tuples(vouchers.assignable_vouchers(more, t["membership_tiers"], LOADED), "promotion_id",
                 "assignment_type", "applicable_tier")
    assert got == [(1, "AUTO_ASSIGN", "Bronze"), (3, "AUTO_ASSIGN", "Bronze"), (7, "BIRTHDAY", None)]
    status = {r.promotion_id: r for r in vouchers.voucher_assignment_status(more, t["customer_promotions"]).collect()}
    assert {p: (r.assigned_count, r.redeemed_count) for p, r in status.items()} == {
        1: (1, 0), 3: (1, 0), 5: (0, 0), 7: (0, 0)}
    assert status[5].first_assignment is None
    live = dict(tuples(vouchers.active_promo_assigned_count(more, t["customer_promotions"], LOADED), "promotion_id",
                       "assigned_count"))
    assert live == {1: 1, 3: 1, 7: 0}


def test_setmeal_profitability(t):
    got = tuples(meals.setmeal_profitability(
        t["menu_items"], t["set_meal_components"], t["order_items"], t["orders"], LOADED),
        "item_id", "component_cost", "base_margin_pct", "discounted_margin_pct", "validation_status",
        "sales_last_3_months")
    assert got == [
        (6, Decimal("14.90"), Decimal("-19.20"), Decimal("-40.24"), "VALID", 0),
        (5, Decimal("29.80"), Decimal("-19.68"), Decimal("-40.80"), "VALID", 1),
    ]


def test_order_type_comparison(t):
    got = tuples(meals.order_type_comparison(
        t["order_items"], t["menu_items"], t["orders"], t["customers"], t["membership_tiers"]))
    plain = "À La Carte"
    assert [(r[0], r[1]) for r in got] == [
        ("Setmeal", "Platinum"), (plain, "Diamond"), (plain, "Platinum"), (plain, "Gold"), (plain, "Silver"),
        (plain, "Bronze"),
    ]
    gold = got[3]
    assert gold[2:] == (2, Decimal("55.69"), Decimal("18.56"), Decimal("55.69"), Decimal("2.00"))


def test_reconciliations(spark, t):
    got = {r.order_id: r for r in meals.order_totals_reconciliation(t["orders"], t["order_items"]).collect()}
    assert set(got) == {5001, 5002, 5005, 5006, 5007}
    assert (got[5007].calc_total, got[5007].calc_discount) == (Decimal("43.40"), Decimal("18.50"))
    two = t["customers"].where("customer_id IN (1001, 1002)")
    some = meals.order_totals_reconciliation(t["orders"], t["order_items"].where("order_id <> 5001"), two)
    assert {(r.order_id, r.calc_total) for r in some.collect()} == {(5001, None), (5002, Decimal("14.00"))}
    points = dict(tuples(membership.points_ledger_reconciliation(t["customers"], t["point_transactions"]),
                         "customer_id", "ledger_points"))
    assert points[1006] == 850 and points[1001] is None


def test_history_ledger_and_audit_listings(t):
    history = membership.tier_change_history(t["membership_history"], t["customers"], t["membership_tiers"])
    assert tuples(history, "customer_id", "old_tier", "new_tier") == [
        (1003, "Bronze", "Silver"), (1005, "Bronze", "Gold")]
    today = membership.tier_change_history(
        t["membership_history"], t["customers"], t["membership_tiers"], LOADED - timedelta(days=9))
    assert tuples(today, "customer_id") == [(1003,)]
    assert membership.ledger_by_type(t["point_transactions"], "BONUS", 1006).count() == 2
    assert membership.ledger_by_type(t["point_transactions"], "BONUS", 1).count() == 0
    assert tuples(membership.ledger_description_search(t["point_transactions"], "elco"), "transaction_id") == [(1,)]
    assert audit.activity_by_type(t["customer_activity"], "LOGIN", LOADED, minutes=5).count() == 2
    late = LOADED + timedelta(minutes=6)
    assert audit.activity_by_type(t["customer_activity"], "LOGIN", late, minutes=5).count() == 0
    assert vouchers.used_promotions(t["customer_promotions"]).count() == 2
    assert dict(tuples(vouchers.holdings_by_tier_count(t["customer_promotions"], t["customers"]))) == {
        1: 1, 2: 1, 3: 1, 4: 1, 5: 1}


def test_named_items(spark, t):
    names = spark.createDataFrame([("Hello Kitty Happy Meal",), ("Cheeseburger",)], "name string")
    found = seasonal.promotions_of_named_item(t["promotions"], t["menu_items"], names)
    assert tuples(found, "promotion_id") == [(4,)]
    assert tuples(seasonal.expired_item_status(t["menu_items"], names), "item_id", "is_active") == [(9, "Y")]
    assert seasonal.expired_item_status(t["menu_items"]).count() == 5
