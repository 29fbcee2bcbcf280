"""Positions in a total order, without sorting a whole table into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from perkwell.sources.checkpoints import cut

BLOCK = "_block"
PLACE = "_place"

# A monotonically increasing id holds the partition above these bits and the row below.
_ROW_BITS = 33


def place_in_order(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Add a ``_place`` that rises along the order ``by`` and the ``_block`` it lies in.

    Rows are range-partitioned on the full order, so even one value of the first
    column spreads over many blocks, and sorted within each block. The result is
    written once, because a range partitioning computed twice need not fall on the
    same bounds.
    """
    order = [F.col(c).asc_nulls_first() for c in by]
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = cut(ranged.withColumn(PLACE, F.monotonically_increasing_id()))
    return placed.withColumn(BLOCK, F.shiftright(PLACE, _ROW_BITS))


def row_in_block() -> Column:
    """The row number within the block, counted from 1."""
    return F.col(PLACE) - F.shiftleft(F.col(BLOCK), _ROW_BITS) + 1


def block_offsets(blocks: DataFrame, value: str, name: str, keys: Sequence[str] = ()) -> DataFrame:
    """The sum of ``value`` over the earlier blocks, within each combination of ``keys``.

    ``blocks`` has one row per block (and keys), so a window holds at most as many
    rows as there are partitions.
    """
    earlier = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    return blocks.withColumn(name, F.coalesce(F.sum(value).over(earlier), F.lit(0))).drop(value)
