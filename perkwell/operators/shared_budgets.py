"""Requests served in order where each may draw on several budgets shared with other requests.

A request takes an amount from each of its budgets (the customer's points, the room of an order, the one
use of a held voucher), and is refused when one of them no longer covers it. Requests that share no key may
still depend on each other through a third. So they form a graph, linked along each key in the order of service.

The graph is worked off in waves. For every request not yet decided, each of its budgets has two bounds: what
is left if none of the earlier undecided requests is served, and what is left if all are. A request that the
lower bounds cover is served, one that an upper bound does not cover is refused. The first undecided request on
all its keys has equal bounds, so a wave decides at least all those and usually far more: of one key, all up
to the first that might not fit. Waves go on over the undecided requests only, until there are none.

Budgets that cover all that is ever asked of them refuse nobody, whatever the order. They are found first, by one sum per
key, and only requests with another budget go through the waves.

Bounds are sums over earlier requests of a key. Each key's requests are range-partitioned into ordered blocks once, and
a wave adds up per block and then within blocks, so a key that most requests share is never one group.

The reason of a refusal is the first budget, in the order given, that does not cover the request at its
turn. A request sure to be refused for a later budget draws nothing, but is kept until the earlier ones are known.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from perkwell.operators.ordering import BLOCK, PLACE, place_in_order
from perkwell.sources.checkpoints import cut, written

OPEN, BARRED, SERVED, SETTLED = "open", "barred", "served", "settled"
UNKNOWN = "?"
# Unions of so many waves are written together, which keeps plans short.
WAVES_TOGETHER = 12


@dataclass(frozen=True)
class Budget:
    """Requests with one value of ``key`` share ``limit`` (repeated on each) and take ``amount`` each; a NULL key sets no limit."""

    key: str
    amount: str
    limit: str
    reason: str


def serve_in_order(requests: DataFrame, order: Sequence[str], budgets: Sequence[Budget], late: str | None = None) -> DataFrame:
    """``requests`` with ``reason``: NULL where served, else the reason of the first budget that does not cover it.

    ``order`` is the order of service and must be total. Amounts are whole and not negative. ``late`` names a
    column with a reason to refuse that is looked at after all budgets; such a request draws nothing.
    """
    asked = requests
    for k, budget in enumerate(budgets):
        asked = _with_tight_key(asked, k, budget)
    covered = reduce(and_, [F.col(_tight(k)).isNull() for k in range(len(budgets))])
    reason = F.lit(None).cast("string") if late is None else F.col(late)
    settled = asked.where(covered).select(*requests.columns, reason.alias("reason"))
    rows = cut(asked.where(~covered))
    if rows.isEmpty():
        return settled
    budgets = [replace(budget, key=_tight(k)) for k, budget in enumerate(budgets)]
    for k, budget in enumerate(budgets):
        rows = _placed(rows, k, budget, order)
    state = F.lit(OPEN) if late is None else F.when(F.col(late).isNull(), OPEN).otherwise(BARRED)
    live = rows.withColumns({"_state": state, "reason": F.lit(None).cast("string"), **{
        _left(k): F.col(b.limit).cast("long") for k, b in enumerate(budgets)
    }})
    decided = [settled]
    while True:
        wave = cut(_wave(live, budgets, late))
        decided.append(wave.where(F.col("_state").isin(SERVED, SETTLED)).select(*requests.columns, "reason"))
        if len(decided) == WAVES_TOGETHER:
            decided = [settled, cut(_union(decided[1:]))]
        # What was served in this wave is still to be taken off what later requests find.
        live = wave.where(F.col("_state") != SETTLED)
        if live.where(F.col("_state") != SERVED).isEmpty():
            return _union(decided)


def found_at_turn(decided: DataFrame, order: Sequence[str], budget: Budget, served: Column, name: str) -> DataFrame:
    """Add what was left of a budget when a request's turn came, ``served`` telling which requests drew on it."""
    placed = _placed(decided, 0, budget, order).withColumns({
        "_state": F.when(served, SERVED).otherwise(SETTLED), _left(0): F.col(budget.limit).cast("long"),
    })
    return _with_bounds(placed, 0, budget).select(*decided.columns, F.col(_left(0)).alias(name))


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _tight(k: int) -> str:
    return f"_tight{k}"


def _with_tight_key(rows: DataFrame, k: int, budget: Budget) -> DataFrame:
    """Add the key of a budget where its requests together ask for more than there is, else NULL."""
    sums = rows.where(F.col(budget.key).isNotNull()).groupBy(F.col(budget.key).alias(_tight(k))).agg(
        F.sum(F.col(budget.amount).cast("decimal(38,0)")).alias("_asked"), F.min(F.col(budget.limit).cast("long")).alias("_least")
    )
    tight = written(sums.where(~F.coalesce(F.col("_asked") <= F.col("_least"), F.lit(False))).select(_tight(k)))
    return rows.join(tight, F.col(budget.key) == F.col(_tight(k)), "left")


def _left(k: int) -> str:
    return f"_left{k}"


def _columns(k: int) -> tuple[str, str, str]:
    return f"_key{k}", f"_block{k}", f"_place{k}"


def _placed(rows: DataFrame, k: int, budget: Budget, order: Sequence[str]) -> DataFrame:
    """Blocks and places along one key; a request without it stands alone."""
    key, block, place = _columns(k)
    alone = F.concat(F.lit("#"), F.col(place).cast("string"))
    return place_in_order(rows, [budget.key, *order]).withColumnsRenamed({BLOCK: block, PLACE: place}).withColumn(
        key, F.coalesce(F.col(budget.key).cast("string"), alone)
    )


def _wave(live: DataFrame, budgets: Sequence[Budget], late: str | None) -> DataFrame:
    rows = live
    for k, budget in enumerate(budgets):
        rows = _with_bounds(rows, k, budget)
    rows = rows.where(F.col("_state") != SERVED)
    fails, passes = [], []
    for k, budget in enumerate(budgets):
        free, amount = F.col(budget.key).isNull(), F.col(budget.amount)
        fails.append(~free & (F.col(_left(k)) < amount))
        passes.append(free | (F.col(_left(k)) - F.col(f"_ahead{k}") >= amount))
    # Along the budgets in their order: known to fail, not known, known to pass and so on to the next.
    verdict = F.lit("") if late is None else F.coalesce(F.col(late), F.lit(""))
    for budget, fail, passed in reversed(list(zip(budgets, fails, passes, strict=True))):
        verdict = F.when(fail, budget.reason).when(~passed, UNKNOWN).otherwise(verdict)
    sure = F.lit(False) if late is None else F.col(late).isNotNull()
    for fail in fails:
        sure = sure | fail
    return rows.withColumn("_verdict", verdict).withColumns({
        "_state": F.when(F.col("_verdict") == "", SERVED).when(F.col("_verdict") != UNKNOWN, SETTLED).when(sure, BARRED).otherwise(OPEN),
        "reason": F.when(~F.col("_verdict").isin("", UNKNOWN), F.col("_verdict")),
    }).drop("_verdict", *[f"_ahead{k}" for k in range(len(budgets))])


def _drawn(amount: str, state: str) -> Column:
    return F.when(F.col("_state") == state, F.col(amount)).otherwise(0).cast("long")


def _with_bounds(rows: DataFrame, k: int, budget: Budget) -> DataFrame:
    """Take what the last wave served earlier off what is left, and add up what earlier undecided requests ask for."""
    key, block, place = _columns(k)
    took, asks = f"_took{k}", f"_ahead{k}"
    marked = rows.withColumns({took: _drawn(budget.amount, SERVED), asks: _drawn(budget.amount, OPEN)})
    earlier = Window.partitionBy(key).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    # One row per key and block: a window holds no more than there are blocks.
    blocks = marked.groupBy(key, block).agg(F.sum(took).alias("_t"), F.sum(asks).alias("_a")).select(
        key, block, F.coalesce(F.sum("_t").over(earlier), F.lit(0)).alias("_took_before"),
        F.coalesce(F.sum("_a").over(earlier), F.lit(0)).alias("_asked_before"),
    )
    within = Window.partitionBy(key, block).orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    return marked.join(blocks, [key, block]).withColumns({
        _left(k): F.col(_left(k)) - F.col("_took_before") - F.coalesce(F.sum(took).over(within), F.lit(0)),
        asks: F.col("_asked_before") + F.coalesce(F.sum(asks).over(within), F.lit(0)),
    }).drop(took, "_took_before", "_asked_before")
