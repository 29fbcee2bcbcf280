"""Expiry counts and streams of changes against full recomputation and the batch cascade."""

import random
from datetime import timedelta

from perkwell.operators import expiry_counts, maintenance
from perkwell.plans.points_cascade import points_cascade
from perkwell.streaming import upkeep
from seed import LOADED, seed_tables, table, tuples

CHANGE = (
    "op string, new_customer_id long, new_points_amount long, new_transaction_type string, new_expiry_date timestamp_ntz,"
    " old_customer_id long, old_points_amount long, old_transaction_type string, old_expiry_date timestamp_ntz"
)


def random_changes(rng, ledger, n):
    """Changes of a ledger {id: (customer, points, type, expiry)}, applied to it in place."""
    rows = []
    for _ in range(n):
        op = rng.choice("IIUD") if ledger else "I"
        new = (rng.randrange(1001, 1007), rng.choice([-20, 0, 30, 500]), rng.choice(["PURCHASE", "BONUS", "REDEMPTION"]),
               rng.choice([None, *[LOADED + timedelta(days=d) for d in (-3, 0, 5, 9, 40)]]))
        if op == "I":
            ledger[max(ledger, default=0) + 1] = new
            rows.append((op, *new, None, None, None, None))
        else:
            k = rng.choice(list(ledger))
            old = ledger.pop(k)
            if op == "U":
                # The customer of an entry stays; only its values change.
                new = (old[0], *new[1:])
                ledger[k] = new
            rows.append((op, *(new if op == "U" else (None,) * 4), *old))
    return rows


def ledger_table(spark, ledger):
    return table(spark, "point_transactions", [
        {"transaction_id": k, "customer_id": c, "points_amount": p, "transaction_type": kind, "expiry_date": day, "transaction_date": LOADED}
        for k, (c, p, kind, day) in ledger.items()])


def test_counts_equal_the_full_recomputation(spark):
    rng, t = random.Random(8), seed_tables(spark)
    ledger = {}
    random_changes(rng, ledger, 60)
    counts = expiry_counts.expiry_counts(ledger_table(spark, ledger))
    for step in range(50):
        changes = spark.createDataFrame(random_changes(rng, ledger, 12), CHANGE)
        counts = expiry_counts.with_count_changes(counts, expiry_counts.count_changes(changes))
        # Start the next round from rows, not from a plan that grows.
        counts = spark.createDataFrame(counts.collect(), "customer_id long, expiry_date timestamp_ntz, entries long")
        kept = expiry_counts.recalc_points_expiry(changes, counts, t["customers"], LOADED)
        full = maintenance.recalc_points_expiry(changes, ledger_table(spark, ledger), t["customers"], LOADED)
        if step % 5 == 0:
            whole = expiry_counts.expiry_counts(ledger_table(spark, ledger))
            assert sorted(map(repr, tuples(counts))) == sorted(map(repr, tuples(whole)))
        assert sorted(map(repr, tuples(kept))) == sorted(map(repr, tuples(full)))


def test_stream_of_changes_equals_the_batch_cascade(spark, tmp_path):
    rng, t = random.Random(9), seed_tables(spark)
    ledger = {}
    random_changes(rng, ledger, 40)
    before = expiry_counts.expiry_counts(ledger_table(spark, ledger))
    before = spark.createDataFrame(before.collect(), before.schema)
    files, folder, rows = str(tmp_path / "in"), str(tmp_path / "run"), []
    for _ in range(4):
        more = random_changes(rng, ledger, 25)
        rows += more
        spark.createDataFrame(more, CHANGE).coalesce(1).write.mode("append").parquet(files)

    def run():
        source = spark.readStream.schema(CHANGE).option("maxFilesPerTrigger", 1).parquet(files)
        upkeep.keep_ledger_changes(source, folder).awaitTermination()

    def outputs(where):
        out = upkeep.kept_cascade(spark, where, before, t["customers"], t["membership_tiers"], t["promotions"], t["customer_promotions"], LOADED)
        return {k: sorted(map(repr, tuples(v))) for k, v in out.items()}

    run()
    batch = points_cascade(
        spark.createDataFrame(rows, CHANGE), ledger_table(spark, ledger), t["customers"], t["membership_tiers"], t["promotions"],
        t["customer_promotions"], LOADED)
    want = {k: sorted(map(repr, tuples(v))) for k, v in batch.items()}
    assert outputs(folder) == want and any(want.values())
    assert len(list((tmp_path / "run" / "totals").glob("batch=*"))) >= 4
    # Nothing new: nothing changes. A batch written again changes nothing either.
    run()
    last = max((tmp_path / "run" / "totals").glob("batch=*"))
    again = spark.read.parquet(str(last)).collect()
    spark.createDataFrame(again, spark.read.parquet(str(last)).schema).write.mode("overwrite").parquet(str(last))
    assert outputs(folder) == want
    upkeep.compact_ledger_changes(spark, folder, str(tmp_path / "compact"))
    assert outputs(str(tmp_path / "compact")) == want
    assert len(list((tmp_path / "compact" / "totals").glob("batch=*"))) == 1
