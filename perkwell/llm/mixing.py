"""Temperature mixing of sources.

The share ``p`` of each source in all tokens is raised to an exponent ``a`` and
normalised to the weight ``w``. ``a = 1`` keeps the shares, ``a = 0`` makes all
sources equal. The exponent is bisected: the largest one that still reaches the
wanted entropy, then no smaller than what the repetition limit needs. Each source
gets ``w`` of the token budget and deals its documents in a fresh pseudo-random
order per epoch, so the budget may end inside an epoch or run over several.
Blocks of ``block_tokens`` tokens take from every source in proportion to its
weight, and the rows of a block are permuted.

Edge cases: NULL and empty texts cost one token, so every document can be dealt;
a NULL source is a source of its own; a document that occurs several times is
dealt as often; an empty table gives an empty plan; columns other than doc_id,
text and source are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from perkwell.llm.common import salted_join, whole_text
from perkwell.sources.checkpoints import cut

TOKEN = "[^ \\t\\r\\n]+"
SLICE_DIGITS = 3
BISECTIONS = 30
STEPS_PER_PASS = 5
WEIGHT_DIGITS = 9


@dataclass(frozen=True)
class Mix:
    """Targets of a mixture.

    ``entropy`` is the least entropy as a part of its maximum (all sources equal);
    ``max_epochs`` is how often a source may be repeated at most, and goes before
    the entropy; ``budget_tokens`` defaults to all tokens there are. ``salts``
    parts hold the rows of each source while weights are attached.
    """

    entropy: float | None = 0.95
    max_epochs: float | None = 4.0
    budget_tokens: int | None = None
    block_tokens: int = 1 << 20
    seed: str = "mix"
    salts: int = 64


def costed(docs: DataFrame) -> DataFrame:
    """doc_id, source, a key for the source that is never NULL, and the tokens of each document."""
    return docs.select(
        "doc_id", "source", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("_source"),
        F.greatest(F.regexp_count(whole_text(), F.lit(TOKEN)), F.lit(1)).cast("long").alias("n_tokens"),
    )


def source_shares(rows: DataFrame) -> DataFrame:
    """Tokens and share of each source."""
    totals = cut(rows.groupBy("_source").agg(F.sum("n_tokens").alias("_tokens")))
    total = totals.agg(F.sum("_tokens").alias("t")).first()["t"]
    return totals.withColumn("_share", F.col("_tokens") / F.lit(float(total or 1)))


def _bisect(measure: Callable[[list[float]], list[bool]]) -> tuple[float, float]:
    """The bracket in [0, 1] around the point where ``measure`` turns from True to False.

    One pass over the sources answers all midpoints of several bisections.
    """
    low, high = 0.0, 1.0
    for _ in range(BISECTIONS // STEPS_PER_PASS):
        parts = 1 << STEPS_PER_PASS
        points = [low + (high - low) * k / parts for k in range(1, parts)]
        holds = [True, *measure(points), False]
        left, right = 0, parts
        while right - left > 1:
            middle = (left + right) // 2
            left, right = (middle, right) if holds[middle] else (left, middle)
        low, high = low + (high - low) * left / parts, low + (high - low) * right / parts
    return low, high


def _powers(shares: DataFrame, exponents: list[float], per_power: Callable[[Column], list[Column]]) -> list[list[float]]:
    """Sums over the sources for each exponent, in one aggregation."""
    columns = [c for a in exponents for c in per_power(F.pow(F.col("_share"), F.lit(a)))]
    row = shares.agg(*[c.alias(f"c{k}") for k, c in enumerate(columns)]).first()
    width = len(columns) // len(exponents)
    return [[float(row[k * width + j]) for j in range(width)] for k in range(len(exponents))]


def exponent(shares: DataFrame, budget: int, total: int, mix: Mix) -> float:
    """The exponent that meets the entropy wanted and the repetition limit."""
    sources = shares.count()
    if sources <= 1:
        return 1.0
    chosen = 1.0 if mix.entropy is None and mix.max_epochs is None else 0.0
    if mix.entropy is not None:
        wanted = mix.entropy * math.log(sources)

        def flat_enough(exponents: list[float]) -> list[bool]:
            sums = _powers(shares, exponents, lambda x: [F.sum(x), F.sum(x * F.log("_share"))])
            return [math.log(s0) - a * s1 / s0 >= wanted for a, (s0, s1) in zip(exponents, sums, strict=True)]

        chosen = 1.0 if flat_enough([1.0])[0] else _bisect(flat_enough)[0]
    if mix.max_epochs is not None:
        if budget > mix.max_epochs * total:
            raise ValueError("the budget needs more repetitions than allowed, whatever the weights")

        def repeats_too_often(exponents: list[float]) -> list[bool]:
            sums = _powers(shares, exponents, lambda x: [F.sum(x), F.max(x / F.col("_tokens"))])
            return [most * budget / s0 > mix.max_epochs for s0, most in sums]

        if repeats_too_often([chosen])[0]:
            chosen = _bisect(repeats_too_often)[1]
    return chosen


def weights(shares: DataFrame, a: float, budget: int) -> DataFrame:
    """Weight and token budget of each source for exponent ``a``."""
    power = F.pow(F.col("_share"), F.lit(a))
    total = shares.agg(F.sum(power).alias("t")).first()["t"]
    weight = F.round(power / F.lit(float(total or 1)), WEIGHT_DIGITS)
    return shares.withColumn("_weight", weight).withColumn("_budget", F.floor(weight * F.lit(float(budget))))


def mix_plan(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Which documents to read in which order: doc_id, source, n_tokens, epoch, block, position.

    Order the rows by block, then position. A source's documents of one epoch are
    placed by the sum of tokens before them, added up first per slice of the
    permutation and then inside the slice, so no task sees a whole source.
    """
    rows = costed(docs)
    shares = source_shares(rows)
    total = int(shares.agg(F.sum("_tokens").alias("t")).first()["t"] or 0)
    budget = total if mix.budget_tokens is None else mix.budget_tokens
    weighted = cut(weights(shares, exponent(shares, budget, total, mix), budget)).drop("_share")

    dealt = salted_join(rows, weighted, ["_source"], "doc_id", mix.salts)
    epochs = F.ceil(F.col("_budget") / F.col("_tokens"))
    dealt = dealt.filter(epochs > 0).withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), epochs - 1)))
    key = F.md5(F.concat_ws(":", F.lit(mix.seed), F.col("epoch"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    dealt = dealt.withColumn("_key", key).withColumn("_slice", F.substring("_key", 1, SLICE_DIGITS))

    group = ["_source", "epoch", "_slice"]
    before = Window.partitionBy("_source", "epoch").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy(*group).agg(F.sum("n_tokens").alias("_sum")).select(
        *group, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset")
    )
    inside = Window.partitionBy(*group).orderBy("_key", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("_inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(offsets, group)
    start = F.col("epoch") * F.col("_tokens") + F.col("_offset") + F.col("_inside")
    kept = placed.withColumn("_start", start).filter(F.col("_start") < F.col("_budget"))
    kept = kept.withColumn("block", F.floor(F.col("_start") / (F.col("_weight") * F.lit(float(mix.block_tokens)))))
    order = Window.partitionBy("block").orderBy(F.md5(F.concat(F.col("_key"), F.lit("#"))), "doc_id", "source", "n_tokens")
    return kept.select(
        "doc_id", "source", "n_tokens", "epoch", "block", F.row_number().over(order).cast("long").alias("position")
    )


def mixed_documents(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The documents of the plan with their texts, and where they stand in it.

    doc_id must name one row here: rows that share one are repeated for each other's
    places. Columns of the same names as those added give way to them.
    """
    added = ["n_tokens", "epoch", "block", "position"]
    plan = mix_plan(docs, mix)
    texts = docs.drop(*added).alias("t")
    same = F.col("t.doc_id").eqNullSafe(F.col("p.doc_id"))
    return texts.join(plan.alias("p"), same).select("t.*", *[f"p.{c}" for c in added])
