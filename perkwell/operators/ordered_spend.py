"""Greedy spending in order: take each entry the remaining budget still covers.

Per key, entries come in a fixed order; an entry is accepted when the budget left
covers it, otherwise it is skipped and the next one is tried. Skipping makes this
more than a running sum. Two exact ways are used, chosen per key by its size:

* a usual key has few entries: they are folded as one sorted array, in one pass;
* a key with more than ``max_group`` entries never becomes one group. Its entries
  stay spread over ordered blocks, and the decision is made in phases. Take a power
  of two T not above the budget. While the budget stays at T or more, every entry
  below T fits, and the first fitting entry of at least T ends the phase. So a
  phase is a prefix sum over blocks plus a minimum. T starts just above the largest
  entry and at least halves from phase to phase: there are at most two more phases
  than the largest entry has binary digits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from perkwell.functions.joins import sent_if_few
from perkwell.operators.ordering import BLOCK, PLACE, block_offsets, place_in_order
from perkwell.sources.checkpoints import cut

MAX_GROUP = 1000


def spend_in_order(
    entries: DataFrame, key: str, order: Sequence[str], amount: str, budget: str, max_group: int | None = None,
    written: bool = False,
) -> DataFrame:
    """Return ``entries`` with a boolean ``accepted`` column.

    ``order`` must be total within a key. Amounts are whole and not negative, and
    ``budget`` is the starting budget, repeated on each row of the key. ``written``
    says that ``entries`` already reads from a checkpoint and need not be cut again.
    """
    max_group = MAX_GROUP if max_group is None else max_group
    entries = entries if written else cut(entries)
    sizes = entries.groupBy(key).agg(F.count("*").alias("_n"))
    large = sizes.where(F.col("_n") > max_group).select(key)
    keys = large.count()
    if keys == 0:
        return _fold(entries, key, order, amount, budget)
    large = cut(large)
    sent = sent_if_few(large, keys)
    small = _fold(entries.join(sent, key, "left_anti"), key, order, amount, budget)
    spread = _phases(entries.join(sent, key, "left_semi"), key, order, amount, budget, keys)
    return small.unionByName(spread)


def _fold(entries: DataFrame, key: str, order: Sequence[str], amount: str, budget: str) -> DataFrame:
    rest = [c for c in entries.columns if c not in (key, budget, *order)]
    row = F.struct(*order, *rest)
    start = F.struct(
        F.col(budget).cast("long").alias("left"),
        F.array().cast("array<boolean>").alias("flags"),
    )

    def step(state, entry):
        fits = state["left"] >= entry[amount]
        left = F.when(fits, state["left"] - entry[amount]).otherwise(state["left"])
        return F.struct(left.alias("left"), F.concat(state["flags"], F.array(fits)).alias("flags"))

    return (
        entries.groupBy(key).agg(F.sort_array(F.collect_list(row)).alias("_rows"), F.first(budget).alias(budget))
        .withColumn("_flags", F.aggregate("_rows", start, step)["flags"])
        .select(key, budget, F.explode(F.arrays_zip("_rows", "_flags")).alias("_pair"))
        .select(key, budget, "_pair._rows.*", F.col("_pair._flags").alias("accepted"))
        .select(*entries.columns, "accepted")
    )


def _power_below(value: Column) -> Column:
    """The largest power of two not above ``value`` (1 for 0), read off its binary digits."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.length(F.bin(value)) - 1)


def _phases(
    entries: DataFrame, key: str, order: Sequence[str], amount: str, budget: str, keys: int
) -> DataFrame:
    placed = place_in_order(entries, [key, *order])
    state = cut(
        entries.groupBy(key).agg(
            F.first(budget).cast("long").alias("_left"),
            (_power_below(F.max(amount).cast("long")) * 2).alias("_top"),
        )
        .withColumns({
            "_after": F.lit(-1).cast("long"),
            "_open": F.lit(True),
            "_spans": F.array().cast("array<struct<after:bigint,upto:bigint,below:bigint>>"),
        })
    )
    items = placed.select(key, BLOCK, PLACE, F.col(amount).cast("long").alias("_amount"))
    while not state.where("_open").isEmpty():
        state = cut(_next_phase(items, state, key, keys))
    in_span = F.exists(
        "_spans",
        lambda span: (F.col(PLACE) > span["after"]) & (F.col(PLACE) <= span["upto"])
        & ((F.col(amount) < span["below"]) | (F.col(PLACE) == span["upto"])),
    )
    return (
        placed.join(sent_if_few(state.select(key, "_spans"), keys), key)
        .withColumn("accepted", in_span)
        .select(*entries.columns, "accepted")
    )


def _next_phase(items: DataFrame, state: DataFrame, key: str, keys: int) -> DataFrame:
    """Advance every open key by one phase; a key without a stop is done."""
    left, size = F.col("_left"), F.col("_amount")
    below = F.least(_power_below(left), "_top")
    active = (
        items.join(sent_if_few(state.where("_open").select(key, "_left", "_top", "_after"), keys), key)
        .where((F.col(PLACE) > F.col("_after")) & (size <= left))
        .withColumn("_small", F.when(size < below, size).otherwise(0))
    )
    sums = active.groupBy(key, BLOCK).agg(F.sum("_small").alias("_sum"))
    offsets = block_offsets(sums, "_sum", "_before", [key])
    within = Window.partitionBy(key, BLOCK).orderBy(PLACE)
    left_here = left - F.col("_before") - F.sum("_small").over(within)
    is_big = size >= below
    running = (
        active.join(offsets, [key, BLOCK])
        .withColumn("_here", left_here)
        .withColumn("_stop", F.when(is_big, size <= F.col("_here")).otherwise((F.col("_here") < below) & (left > 0)))
        .withColumn("_rest", F.when(is_big, F.col("_here") - size).otherwise(F.col("_here")))
    )
    stops = running.where("_stop").groupBy(key).agg(F.min(F.struct(PLACE, "_rest")).alias("_first"))
    first = F.col("_first")
    span = F.struct(
        F.col("_after").alias("after"),
        F.coalesce(first[PLACE], F.lit(2**63 - 1)).alias("upto"),
        below.alias("below"),
    )
    return (
        state.join(stops, key, "left")
        .withColumn("_spans", F.when(F.col("_open"), F.concat("_spans", F.array(span))).otherwise(F.col("_spans")))
        .withColumns({
            "_open": F.col("_open") & first.isNotNull(),
            "_after": F.coalesce(first[PLACE], F.col("_after")),
            "_left": F.coalesce(first["_rest"], F.col("_left")),
        })
        .drop("_first")
    )
