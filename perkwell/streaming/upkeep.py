"""Balances, expiry dates, tiers and order totals kept from streams of new and of changed rows.

Each micro-batch is reduced to sums per key with the same function the batch job
uses and written under its batch id. A batch that runs again replaces its own
folder, so a restart counts nothing twice. Sums have no end date, so there is no
watermark; reading them back is one aggregation over the small per-batch sums.

Streams of inserts, updates and deletes are kept as keyed state: a streaming aggregation adds up what the
changes add and take back, and each batch writes the new totals of the keys it touched. A total replaces the
earlier one of its key, so a batch that is written again changes nothing. ``compact`` folds the
batches up to one of them into a single folder with one row per key.
"""

from __future__ import annotations

import uuid

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from perkwell.functions.columns import TOTAL
from perkwell.operators.expiry_counts import next_expiry, with_count_changes
from perkwell.operators.maintenance import changed_customer, changed_points, earns_with_expiry, line_totals, points_change, touches_expiry
from perkwell.plans.points_cascade import cascade_effects, inserts_as_changes
from perkwell.sources.checkpoints import ensure_checkpoint_dir

_POINT_SUMS = "customer_id BIGINT, points_change BIGINT, batch BIGINT"
_LINE_SUMS = (
    "order_id BIGINT, total_amount DECIMAL(20,2), discount_amount DECIMAL(20,2), final_amount DECIMAL(20,2),"
    " batch BIGINT"
)


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder for one run, in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _keep_sums(stream: DataFrame, reduce, folder: str, trigger: dict) -> StreamingQuery:
    def write(batch: DataFrame, batch_id: int) -> None:
        reduce(batch).write.mode("overwrite").parquet(f"{folder}/sums/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{folder}/progress").trigger(**trigger).start()
    )


def keep_balances(entries: DataFrame, folder: str, **trigger) -> StreamingQuery:
    """Reduce a stream of new ledger entries to point changes per customer."""
    return _keep_sums(
        entries, lambda batch: points_change(inserts_as_changes(batch)), folder, trigger or {"availableNow": True}
    )


def kept_balances(spark: SparkSession, folder: str, customers: DataFrame) -> DataFrame:
    """Balances of all customers the stream has touched so far."""
    sums = spark.read.schema(_POINT_SUMS).parquet(f"{folder}/sums")
    change = sums.groupBy("customer_id").agg(F.sum("points_change").alias("points_change"))
    return (
        customers.select("customer_id", F.col("points_balance").alias("old_balance"))
        .join(change, "customer_id")
        .select("customer_id", "old_balance",
                (F.col("old_balance") + F.col("points_change")).alias("points_balance"))
    )


def keep_order_totals(lines: DataFrame, folder: str, **trigger) -> StreamingQuery:
    """Reduce a stream of new order lines to amounts per order."""
    return _keep_sums(lines, line_totals, folder, trigger or {"availableNow": True})


def kept_order_totals(spark: SparkSession, folder: str, orders: DataFrame) -> DataFrame:
    """Header amounts of all orders the stream has touched so far."""
    names = ("total_amount", "discount_amount", "final_amount")
    sums = spark.read.schema(_LINE_SUMS).parquet(f"{folder}/sums")
    totals = sums.groupBy("order_id").agg(*[F.sum(n).cast(TOTAL).alias(n) for n in names])
    return orders.select("order_id").join(totals, "order_id")


# ---- streams of changes ----------------------------------------------------------

_LEDGER_STATE = "customer_id BIGINT, slot TIMESTAMP_NTZ, points BIGINT, touches BIGINT, entries BIGINT, batch BIGINT"
_LINE_STATE = (
    "order_id BIGINT, lines BIGINT, total_amount DECIMAL(20,2), discount_amount DECIMAL(20,2), batch BIGINT"
)
_LEDGER_KEYS, _LINE_KEYS = ("customer_id", "slot"), ("order_id",)


def _keep_totals(totals: DataFrame, folder: str, trigger: dict) -> StreamingQuery:
    """Write the new totals of the keys that each batch touched."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/totals/batch={batch_id}")

    return (
        totals.writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", f"{folder}/progress").trigger(**(trigger or {"availableNow": True})).start()
    )


def _latest(spark: SparkSession, folder: str, schema: str, keys: tuple[str, ...]) -> DataFrame:
    """The newest total of each key."""
    rows = spark.read.schema(schema).parquet(f"{folder}/totals")
    values = [c for c in rows.columns if c not in (*keys, "batch")]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("_v"), F.max("batch").alias("batch"))
    return newest.select(*keys, "_v.*", "batch")


def _compact(spark: SparkSession, folder: str, schema: str, keys: tuple[str, ...], into: str) -> None:
    """Copy the newest totals to the folder ``into``, one row per key; the stream may go on from there."""
    newest = _latest(spark, folder, schema, keys)
    # Under the number of the last batch, so that later batches still win.
    last = newest.agg(F.max("batch")).first()[0]
    if last is not None:
        newest.drop("batch").write.mode("overwrite").parquet(f"{into}/totals/batch={last}")


def _changes_per_key() -> Column:
    """What a ledger change adds, as (customer, slot, points, touches, entries).

    Slot NULL holds the points of a customer and how many changes touched the expiry date, every other slot the
    number of earned entries that expire then.
    """
    no_slot = F.lit(None).cast("timestamp_ntz")

    def row(customer: Column, slot: Column, points: Column, touches: Column, entries: Column) -> Column:
        return F.struct(
            customer.cast("long").alias("customer_id"), slot.alias("slot"), points.cast("long").alias("points"),
            touches.cast("long").alias("touches"), entries.cast("long").alias("entries"),
        )

    zero = F.lit(0)
    balance = row(changed_customer(), no_slot, changed_points(), F.coalesce(touches_expiry(), F.lit(False)).cast("int"), zero)

    def entry(side: str, ops: tuple[str, ...], count: int) -> Column:
        counted = F.col("op").isin(*ops) & F.coalesce(earns_with_expiry(side), F.lit(False))
        return F.when(counted, row(F.col(f"{side}_customer_id"), F.col(f"{side}_expiry_date"), zero, zero, F.lit(count)))

    return F.array_compact(F.array(balance, entry("new", ("I", "U"), 1), entry("old", ("U", "D"), -1)))


def keep_ledger_changes(changes: DataFrame, folder: str, **trigger) -> StreamingQuery:
    """Keep points and a count per expiry date of every customer from a stream of ledger changes."""
    rows = changes.select(F.explode(_changes_per_key()).alias("_c")).select("_c.*")
    totals = rows.groupBy(*_LEDGER_KEYS).agg(*[F.sum(c).alias(c) for c in ("points", "touches", "entries")])
    return _keep_totals(totals, folder, trigger)


def compact_ledger_changes(spark: SparkSession, folder: str, into: str) -> None:
    _compact(spark, folder, _LEDGER_STATE, _LEDGER_KEYS, into)


def kept_cascade(
    spark: SparkSession, folder: str, counts: DataFrame, customers: DataFrame, tiers: DataFrame, promotions: DataFrame,
    holdings: DataFrame, as_of: datetime,
) -> dict[str, DataFrame]:
    """What ``points_cascade`` gives for all changes streamed so far, without the ledger.

    ``counts`` are the entries per customer and expiry date before the stream began (``expiry_counts``);
    ``customers`` are those of that time, too.
    """
    state = _latest(spark, folder, _LEDGER_STATE, _LEDGER_KEYS)
    whole = state.where("slot IS NULL")
    balances = customers.select("customer_id", F.col("points_balance").alias("old_balance")).join(
        whole.select("customer_id", "points"), "customer_id"
    ).select("customer_id", "old_balance", (F.col("old_balance") + F.col("points")).alias("points_balance"))
    delta = state.where("slot IS NOT NULL").select("customer_id", F.col("slot").alias("expiry_date"), "entries")
    touched = customers.select("customer_id").join(whole.where("touches > 0"), "customer_id", "left_semi")
    expiry = next_expiry(with_count_changes(counts, delta), touched, as_of)
    return cascade_effects(balances, expiry, customers, tiers, promotions, holdings, as_of)


def keep_line_changes(changes: DataFrame, folder: str, **trigger) -> StreamingQuery:
    """Keep amounts per order from a stream of changed lines.

    ``changes`` has ``op`` and new and old ``order_id``, ``price``, ``quantity`` and ``discount_applied``.
    """
    def side(name: str, ops: tuple[str, ...], sign: int) -> Column:
        def amount(column: str) -> Column:
            return (F.col(f"{name}_{column}") * F.col(f"{name}_quantity") * sign).cast(TOTAL)

        return F.when(F.col("op").isin(*ops) & F.col(f"{name}_order_id").isNotNull(), F.struct(
            F.col(f"{name}_order_id").cast("long").alias("order_id"), F.lit(sign).cast("long").alias("lines"),
            amount("price").alias("total_amount"), amount("discount_applied").alias("discount_amount"),
        ))

    rows = changes.select(F.explode(F.array_compact(F.array(side("new", ("I", "U"), 1), side("old", ("U", "D"), -1)))).alias("_c")).select("_c.*")
    totals = rows.groupBy(*_LINE_KEYS).agg(
        F.sum("lines").alias("lines"), *[F.sum(c).cast(TOTAL).alias(c) for c in ("total_amount", "discount_amount")]
    )
    return _keep_totals(totals, folder, trigger)


def kept_line_totals(spark: SparkSession, folder: str, orders: DataFrame) -> DataFrame:
    """Header amounts of all orders the stream has touched so far, 0 where no line is left."""
    totals = _latest(spark, folder, _LINE_STATE, _LINE_KEYS)
    return orders.select("order_id").join(totals, "order_id").select(
        "order_id", "total_amount", "discount_amount", (F.col("total_amount") - F.col("discount_amount")).cast(TOTAL).alias("final_amount")
    )


def running_points(entries: DataFrame) -> DataFrame:
    """Points and entries per customer as a streaming aggregation, for update or complete mode sinks."""
    return entries.groupBy("customer_id").agg(
        F.sum("points_amount").alias("points"), F.count("*").alias("entries")
    )
