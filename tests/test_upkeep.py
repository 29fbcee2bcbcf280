import random
from datetime import timedelta
from decimal import Decimal

import pytest

from perkwell.operators import maintenance
from perkwell.plans.points_cascade import inserts_as_changes, points_cascade
from perkwell.streaming import upkeep
from seed import (
    CUSTOMERS, LEDGER, LOADED, ORDER_ITEMS, changed, day, promotions, seed_tables, table, tuples,
)

CHANGES = (
    "op string, new_customer_id long, new_points_amount long, new_transaction_type string,"
    " new_expiry_date timestamp_ntz, old_customer_id long, old_points_amount long, old_transaction_type string,"
    " old_expiry_date timestamp_ntz"
)
SOON = LOADED + timedelta(days=5)


@pytest.fixture(scope="module")
def t(spark):
    return seed_tables(spark)


def changes(spark, *rows):
    return spark.createDataFrame(list(rows), CHANGES)


def test_sync_points_balance(spark, t):
    none = (None,) * 4
    batch = changes(
        spark, ("I", 1001, 50, "BONUS", None, *none), ("I", 1001, -20, "REDEMPTION", None, *none),
        ("U", 1002, 80, "BONUS", None, 1002, 30, "BONUS", None), ("D", *none, 1003, 40, "BONUS", None),
        ("U", 1004, 100, "BONUS", None, 1005, 60, "BONUS", None), ("I", 77, 5, "BONUS", None, *none),
    )
    got = {r[0]: r[1:] for r in tuples(maintenance.sync_points_balance(batch, t["customers"]))}
    # An entry moved to another customer credits the new one with the difference only.
    assert got == {1001: (300, 330), 1002: (750, 800), 1003: (1000, 960), 1004: (2000, 2040)}
    assert maintenance.sync_points_balance(batch.limit(0), t["customers"]).count() == 0


def test_any_split_of_a_batch_gives_the_same_balances(spark, t):
    rng = random.Random(2)
    rows = [("I", rng.randrange(1001, 1007), rng.randrange(-50, 90), "BONUS", None, *(None,) * 4) for _ in range(60)]
    whole = dict(tuples(maintenance.points_change(changes(spark, *rows))))
    parts: dict[int, int] = {}
    for part in (rows[:7], rows[7:31], rows[31:]):
        for customer, change in tuples(maintenance.points_change(changes(spark, *part))):
            parts[customer] = parts.get(customer, 0) + change
    assert parts == whole


def test_recalc_points_expiry(spark, t):
    none = (None,) * 4
    batch = changes(
        spark, ("I", 1006, 200, "PURCHASE", SOON, *none), ("I", 1001, 10, "BONUS", None, *none),
        ("D", *none, 1002, 10, "BONUS", SOON), ("U", 1003, -5, "ADJUSTMENT", None, 1003, 10, "BONUS", SOON),
        ("I", 1004, 10, "ADJUSTMENT", SOON, *none),
    )
    got = dict(tuples(maintenance.recalc_points_expiry(batch, t["point_transactions"], t["customers"], LOADED)))
    assert got == {1006: LOADED + timedelta(days=15), 1002: None, 1003: None}


def test_recalc_tier_log_and_assign(spark, t):
    people = table(spark, "customers", changed(CUSTOMERS, "customer_id", {
        1001: {"points_balance": 800}, 1002: {"points_balance": -1}, 1006: {"points_balance": 499}}))
    updates = maintenance.recalc_tier(people, t["membership_tiers"])
    assert sorted(tuples(updates)) == [(1001, 1, 2), (1003, 3, 2), (1004, 4, 3), (1005, 5, 4)]
    log = dict(tuples(maintenance.log_tier_changes(updates, LOADED), "customer_id", "change_reason"))
    assert log == {1001: "UPGRADE", 1003: "DOWNGRADE", 1004: "DOWNGRADE", 1005: "DOWNGRADE"}
    odd = spark.createDataFrame([(1, None, 1), (2, 2, 2)], "customer_id long, old_tier_id long, new_tier_id long")
    assert dict(tuples(maintenance.log_tier_changes(odd, LOADED), "customer_id", "change_reason")) == {
        1: "SIGNUP", 2: "ADMIN"}
    offers = table(spark, "promotions", changed(promotions(), "promotion_id", {
        1: {"applicable_tier_id": 2}, 3: {"applicable_tier_id": None}}))
    moves = updates.unionByName(odd)
    given = maintenance.assign_on_tier_change(moves, offers, t["membership_tiers"], t["customer_promotions"], LOADED)
    assert set(tuples(given, "customer_id", "promotion_id", "acquisition_method")) == {
        (1001, 3, "TIER_UPGRADE"), (1003, 1, "TIER_UPGRADE"), (1004, 3, "TIER_UPGRADE"), (1005, 3, "TIER_UPGRADE"),
        (1, 3, "AUTO_TIER"), (2, 1, "TIER_UPGRADE"), (2, 3, "TIER_UPGRADE"),
    }


def test_sync_order_totals(spark, t):
    batch = spark.createDataFrame(
        [("I", 5007, None), ("I", 5007, None), ("D", None, 5003), ("U", 5002, 5001)],
        "op string, new_order_id long, old_order_id long")
    lines = table(spark, "order_items", [r for r in ORDER_ITEMS if r["order_id"] != 5003])
    got = {r[0]: r[1:] for r in tuples(maintenance.sync_order_totals(batch, lines, t["orders"]))}
    assert got == {
        5007: (Decimal("43.40"), Decimal("18.50"), Decimal("24.90")), 5003: (0, 0, 0),
        5002: (Decimal("14.00"), 0, Decimal("14.00")),
    }


def test_mark_promo_used(t):
    got = tuples(maintenance.mark_promo_used(t["redemptions"], t["customer_promotions"], LOADED), "customer_id",
                 "is_used", "used_date")
    assert sorted(got) == [(c, "Y", LOADED) for c in range(1001, 1006)]


def test_birthday_bonus_once_a_year(spark, t):
    on = day("2025-04-07 08:00:00")
    out = maintenance.birthday_bonus(t["customers"], t["membership_tiers"], t["point_transactions"], on)
    entry = out["point_transactions"].first()
    assert (entry.customer_id, entry.points_amount, entry.expiry_date) == (1001, 50, day("2026-04-07 08:00:00"))
    assert out["activity"].first().details == "Received 50 birthday points"
    paid = table(spark, "point_transactions", LEDGER + [
        {"transaction_id": 50, "customer_id": 1001, "points_amount": 50, "transaction_type": "BONUS",
         "transaction_date": on, "description": "Birthday reward points"}])
    again = maintenance.birthday_bonus(t["customers"], t["membership_tiers"], paid, on)
    assert again["point_transactions"].count() == 0
    next_year = maintenance.birthday_bonus(t["customers"], t["membership_tiers"], paid, on.replace(year=2026))
    assert next_year["point_transactions"].count() == 1


def test_points_cascade(spark, t):
    entries = spark.createDataFrame(
        [(1003, 100, "PURCHASE", SOON), (1001, 500, "PURCHASE", None)],
        "customer_id long, points_amount long, transaction_type string, expiry_date timestamp_ntz")
    ledger = t["point_transactions"].unionByName(entries, allowMissingColumns=True)
    out = points_cascade(
        inserts_as_changes(entries), ledger, t["customers"], t["membership_tiers"], t["promotions"],
        t["customer_promotions"], LOADED)
    got = {r[0]: r[1:] for r in tuples(out["customers"])}
    assert got == {1001: (300, 800, day("2025-12-01"), 2), 1003: (1000, 1100, SOON, 2)}
    assert sorted(tuples(out["membership_history"], "customer_id", "old_tier_id", "new_tier_id", "change_reason")) == [
        (1001, 1, 2, "UPGRADE"), (1003, 3, 2, "DOWNGRADE")]
    assert out["customer_promotions"].count() == 0


# ---- streams --------------------------------------------------------------------


def test_balance_stream_equals_batch_over_several_batches(spark, t, tmp_path):
    rng = random.Random(4)
    rows = [
        {"transaction_id": n, "customer_id": rng.randrange(1001, 1007), "points_amount": rng.randrange(-40, 90),
         "transaction_type": "BONUS", "transaction_date": LOADED} for n in range(90)
    ]
    whole = table(spark, "point_transactions", rows)
    for n in range(3):
        table(spark, "point_transactions", rows[n::3]).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def stream():
        return spark.readStream.schema(whole.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")

    folder = str(tmp_path / "run")
    upkeep.keep_balances(stream(), folder).awaitTermination()
    kept = sorted(tuples(upkeep.kept_balances(spark, folder, t["customers"])))
    assert kept == sorted(tuples(maintenance.sync_points_balance(inserts_as_changes(whole), t["customers"])))

    # A restart without new files adds nothing; one more file adds its own points.
    upkeep.keep_balances(stream(), folder).awaitTermination()
    assert sorted(tuples(upkeep.kept_balances(spark, folder, t["customers"]))) == kept
    table(spark, "point_transactions", [{**rows[0], "customer_id": 1001, "points_amount": 7}]).coalesce(1) \
        .write.mode("append").parquet(f"{tmp_path}/in")
    upkeep.keep_balances(stream(), folder).awaitTermination()
    more = {r[0]: r[2] for r in tuples(upkeep.kept_balances(spark, folder, t["customers"]))}
    assert more[1001] == {r[0]: r[2] for r in kept}[1001] + 7


def test_order_total_stream_equals_batch(spark, t, tmp_path):
    for part in (ORDER_ITEMS[::2], ORDER_ITEMS[1::2]):
        table(spark, "order_items", part).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    lines = spark.readStream.schema(t["order_items"].schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    upkeep.keep_order_totals(lines, str(tmp_path / "run")).awaitTermination()
    kept = sorted(tuples(upkeep.kept_order_totals(spark, str(tmp_path / "run"), t["orders"])))
    assert kept == sorted(tuples(maintenance.line_totals(t["order_items"])))


def test_running_points_in_complete_mode(spark, t, tmp_path):
    t["point_transactions"].coalesce(1).write.parquet(f"{tmp_path}/in")
    entries = spark.readStream.schema(t["point_transactions"].schema).parquet(f"{tmp_path}/in")
    job = (
        upkeep.running_points(entries).writeStream.outputMode("complete").format("memory").queryName("running")
        .option("checkpointLocation", f"{tmp_path}/progress").trigger(availableNow=True).start()
    )
    job.awaitTermination()
    assert tuples(spark.table("running")) == [(1006, 850, 5)]
