import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from perkwell.functions.tiers import with_highest_reached_tier, with_tier_by_points
from perkwell.operators import integrity, maintenance
from perkwell.schemas import TABLES, Reference
from perkwell.sources import snapshots as files
from seed import (
    CUSTOMERS, HOLDINGS, ITEMS, LEDGER, LOADED, ORDERS, TIERS, changed, promotions, seed_tables, table, tuples,
)


@pytest.fixture(scope="module")
def t(spark):
    return seed_tables(spark)


def test_seed_is_clean(t):
    assert integrity.check_violations(t).count() == 0
    assert integrity.fk_violations(t).count() == 0
    assert integrity.unique_violations(t).count() == 0


def test_check_violations(spark, t):
    bad = {
        "customers": table(spark, "customers", changed(CUSTOMERS, "customer_id", {
            1001: {"points_balance": -1}, 1002: {"is_member": "X", "membership_status": "GONE"},
            1003: {"is_member": None}})),
        "point_transactions": table(spark, "point_transactions", changed(LEDGER, "transaction_id", {
            1: {"transaction_type": "GIFT"}, 2: {"points_amount": -5}, 5: {"points_amount": 5}})),
        "orders": table(spark, "orders", changed(ORDERS, "order_id", {
            5001: {"final_amount": 44}, 5002: {"payment_method": "BARTER"}, 5003: {"payment_method": None}})),
        "promotions": table(spark, "promotions", changed(promotions(), "promotion_id", {
            1: {"discount_value": None}, 4: {"points_required": None}, 6: {"set_meal_id": None},
            3: {"valid_to": LOADED - timedelta(days=1)}})),
        "customer_promotions": table(spark, "customer_promotions", changed(HOLDINGS, "customer_id", {
            1002: {"used_date": None}, 1003: {"acquisition_method": "GIFT"}})),
    }
    got = set(tuples(integrity.check_violations(bad)))
    assert got == {
        ("customers", "points_balance", "1001"), ("customers", "is_member", "1002"),
        ("customers", "membership_status", "1002"), ("point_transactions", "transaction_type", "1"),
        ("point_transactions", "points_sign", "2"), ("point_transactions", "points_sign", "5"),
        ("orders", "order_amounts", "5001"), ("orders", "payment_method", "5002"),
        ("promotions", "subtype_attributes", "1"), ("promotions", "subtype_attributes", "4"),
        ("promotions", "subtype_attributes", "6"), ("promotions", "valid_dates", "3"),
        ("customer_promotions", "used_date", "1002|2"), ("customer_promotions", "acquisition_method", "1003|3"),
    }


def test_rejected_example_entries(spark, t):
    entries = table(spark, "point_transactions", [
        {"transaction_id": 1, "customer_id": 1001, "points_amount": -100, "transaction_type": "PURCHASE"},
        {"transaction_id": 2, "customer_id": 1001, "points_amount": 1, "transaction_type": "OTHER"},
        {"transaction_id": 3, "customer_id": 9999, "points_amount": 1, "transaction_type": "BONUS"},
    ])
    tables = {**t, "point_transactions": entries}
    assert set(tuples(integrity.check_violations(tables), "row_key")) == {("1",), ("2",)}
    assert tuples(integrity.fk_violations(tables), "column_name", "row_key", "missing_key") == [
        ("customer_id", "3", 9999)]


def test_unique_violations(spark, t):
    doubled = {
        "customers": table(spark, "customers", changed(CUSTOMERS, "customer_id", {1002: {"email": "m1001@example.com"},
                                                                                 1003: {"phone": None}})),
        "customer_promotions": table(spark, "customer_promotions", HOLDINGS + HOLDINGS[:1]),
        "promotions": table(spark, "promotions", promotions()),
    }
    assert set(tuples(integrity.unique_violations(doubled))) == {
        ("customers", "email", "m1001@example.com", 2), ("customers", "phone", "NULL", 1),
        ("customer_promotions", "customer_id,promotion_id", "1001|1", 2),
    }


def test_cascade_from_a_customer_counts_rows_on_two_paths_once(spark, t):
    gone, kept = integrity.cascade_delete(t, "customers", t["customers"].where("customer_id = 1004"))
    counts = {name: rows.count() for name, rows in gone.items()}
    assert counts["orders"] == 2 and counts["order_items"] == 3 and counts["redemptions"] == 1
    assert counts["membership_history"] == counts["customer_promotions"] == 1
    assert "promotions" not in gone and "menu_items" not in gone
    for name in TABLES:
        assert kept[name].count() + counts.get(name, 0) == t[name].count()
    assert integrity.fk_violations(kept).count() == 0


def test_cascade_from_a_tier_reaches_everything_below(t):
    gone, kept = integrity.cascade_delete(t, "membership_tiers", t["membership_tiers"].where("tier_id = 1"))
    assert sorted(tuples(gone["customers"], "customer_id")) == [(1001,), (1006,)]
    assert sorted(tuples(gone["promotions"], "promotion_id")) == [(1,), (3,)]
    assert gone["point_transactions"].count() == 5
    assert integrity.fk_violations(kept).count() == 0


def test_cascade_over_a_diamond_and_a_cycle(spark):
    links = [("b", "a_id", "a"), ("c", "a_id", "a"), ("d", "b_id", "b"), ("d", "c_id", "c"), ("b", "d_id", "d"), ("leaf", "d_id", "d"), ("leaf", "b_id", "b")]
    references = [Reference(*link) for link in links]
    keys = {name: (f"{name}_id",) for name in ("a", "b", "c", "d", "leaf")}
    rng = random.Random(2)
    rows = {
        "a": [{"a_id": k} for k in range(6)],
        "b": [{"b_id": k, "a_id": rng.choice([None, *range(6)]), "d_id": rng.choice([None, *range(30)])} for k in range(30)],
        "c": [{"c_id": k, "a_id": rng.choice([None, *range(6)])} for k in range(20)],
        "d": [{"d_id": k, "b_id": rng.choice([None, *range(30)]), "c_id": rng.choice([None, *range(20)])} for k in range(30)],
        "leaf": [{"leaf_id": k, "d_id": rng.choice([None, *range(30)]), "b_id": rng.choice([None, *range(30)])} for k in range(60)],
    }
    gone = {"a": {0}, "b": set(), "c": set(), "d": set(), "leaf": set()}
    before = None
    while before != sum(map(len, gone.values())):
        before = sum(map(len, gone.values()))
        for child, column, parent in links:
            gone[child] |= {r[f"{child}_id"] for r in rows[child] if r[column] in gone[parent]}
    tables = {n: spark.createDataFrame([tuple(r.values()) for r in rs], ", ".join(f"{c} long" for c in rs[0])) for n, rs in rows.items()}
    deleted, kept = integrity.cascade_delete(tables, "a", tables["a"].where("a_id = 0"), references, keys)
    for name in rows:
        assert {r[0] for r in deleted[name].select(f"{name}_id").collect()} == gone[name]
        assert deleted[name].count() + kept[name].count() == len(rows[name]) and kept[name].columns == tables[name].columns


def test_apply_defaults(spark):
    rows = spark.createDataFrame([(1, "A", None)], "customer_id long, name string, points_balance long")
    got = integrity.apply_defaults(rows, "customers", LOADED).first()
    assert (got.points_balance, got.is_member, got.membership_status, got.join_date, got.renewal_count) == (
        None, "N", "ACTIVE", LOADED, 0)


def test_assign_keys_is_dense_and_ordered(spark):
    rows = spark.range(500).selectExpr("id * 37 % 101 AS a", "id AS b").repartition(7)
    got = sorted(tuples(integrity.assign_keys(rows, ["a", "b"], "k", integrity.first_id("orders"))))
    assert [k for k, _, _ in got] == list(range(5001, 5501))
    assert [(a, b) for _, a, b in got] == sorted((a, b) for _, a, b in got)


def test_shared_sequence(spark, t):
    first = integrity.assign_keys(t["point_transactions"].drop("transaction_id"), ["points_amount"], "id", 1)
    second = integrity.assign_keys(
        t["membership_history"].drop("history_id"), ["customer_id"], "id",
        first.agg(F.max("id") + 1).scalar())
    assert sorted(r.id for r in first.collect()) + sorted(r.id for r in second.collect()) == list(range(1, 11))


def test_evolve_redemptions(t):
    early = t["redemptions"].drop("discount_value", "points_used")
    got = integrity.evolve_redemptions(early).first()
    assert got.discount_value is None and got.points_used == 0
    assert integrity.evolve_redemptions(t["redemptions"]).columns == t["redemptions"].columns


def test_snapshots_round_trip_and_updates(spark, t, tmp_path):
    for name in ("customers", "point_transactions"):
        files.write_snapshot(t[name], str(tmp_path), name)
    files.append_events(t["point_transactions"].limit(1), str(tmp_path), "point_transactions")
    assert files.read_table(spark, str(tmp_path), "point_transactions").count() == 6
    assert files.read_table(spark, str(tmp_path), "customers").columns == t["customers"].columns
    with pytest.raises(Exception):
        files.write_snapshot(t["customers"], str(tmp_path), "customers")
    updates = maintenance.recalc_tier(t["customers"], t["membership_tiers"]).selectExpr(
        "customer_id", "new_tier_id AS tier_id")
    after = files.with_updates(files.read_table(spark, str(tmp_path), "customers"), updates, ["customer_id"])
    assert dict(tuples(after, "customer_id", "tier_id")) == {1001: 1, 1002: 2, 1003: 2, 1004: 3, 1005: 4, 1006: 2}


@pytest.mark.parametrize("number", [5, 5_000, 1_000_000])
def test_any_number_of_tiers(spark, t, number):
    tiers = spark.range(1, number + 1).selectExpr("id AS tier_id", "(id * 7919) % 1000003 * 3 AS points_required")
    balances = [None, -1, 0, 1, 3, 299, 300, 301, 2_999_999, 3_000_005, *range(0, 3_000_000, 70_001)]
    people = spark.createDataFrame([(k, 1, p) for k, p in enumerate(balances)], "customer_id long, tier_id long, points_balance long")
    steps = sorted((n * 7919 % 1000003 * 3, n) for n in range(1, number + 1))
    most, highest, at = {}, {}, 0
    last = best = None
    for p in sorted(b for b in balances if b is not None):
        while at < number and steps[at][0] <= p:
            last, best = steps[at][1], max(best or 0, steps[at][1])
            at += 1
        most[p], highest[p] = last, best
    got = with_tier_by_points(people, "points_balance", tiers, "tier").collect()
    assert {r.customer_id: r.tier for r in got} == {k: most.get(p) for k, p in enumerate(balances)}
    got = with_highest_reached_tier(people, "points_balance", tiers, "tier").collect()
    assert {r.customer_id: r.tier for r in got} == {k: highest.get(p) for k, p in enumerate(balances)}
    assert len(ITEMS) == 13


def test_a_rule_needs_its_columns(spark, t):
    with pytest.raises(ValueError, match="membership_status"):
        integrity.check_violations({"customers": t["customers"].drop("membership_status")})


def test_lengths_and_who_changed(spark, t):
    long = table(spark, "menu_items", [{"item_id": 1, "item_type": "SEASONAL", "name": "x" * 101, "base_price": 1, "is_active": "Y"}])
    assert tuples(integrity.check_violations({"menu_items": long}), "rule_name") == [("name_length",)]
    rows = spark.createDataFrame([(1, 2)], "customer_id long, new_tier_id long")
    assert integrity.apply_defaults(rows, "membership_history", LOADED, user="ann").first()["changed_by"] == "ann"
