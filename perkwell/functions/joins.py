"""Joins on keys with few or very uneven values."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

SENT_ROWS = 100_000


def sent_if_few(side: DataFrame, rows: int) -> DataFrame:
    """A join side of a counted size: sent to every task while small, else left to a shuffle."""
    return F.broadcast(side) if rows <= SENT_ROWS else side


def dealt_join(many: DataFrame, few: DataFrame, key: str, shares: DataFrame) -> DataFrame:
    """Inner join on ``key`` whose result is far larger than its sides: a row per batch of ``many`` and row of ``few``.

    ``shares`` (key, ``_parts``, ``_batches``) says over how many parts the rows of a key are dealt and how many batches a part
    makes of its own; ``few`` is repeated once per part. A batch is an array ``_rows``. There are as many tasks as parts, whichever
    side adaptive execution sends around: it sees the size of the sides alone and would put them into a few tasks. Rows are dealt
    by their place, so equal ones do not meet; ``many`` must have them in the same place when it is read again.
    """
    parts = max(1, shares.agg(F.sum("_parts")).first()[0] or 0)
    place = many.select(key, F.struct(*[c for c in many.columns if c != key]).alias("_row"), F.xxhash64(F.monotonically_increasing_id()).alias("_place"))
    dealt = place.join(shares, key).select(
        key, "_row", F.pmod("_place", "_parts").alias("_part"), F.pmod(F.shiftright("_place", 32), F.col("_batches")).alias("_batch")
    )
    batches = dealt.repartition(parts, key, "_part").groupBy(key, "_part", "_batch").agg(F.collect_list("_row").alias("_rows"))
    repeated = few.join(shares, key).withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)))
    return batches.drop("_batch").join(repeated.drop("_parts", "_batches").repartition(parts, key, "_part"), [key, "_part"]).drop("_part")
