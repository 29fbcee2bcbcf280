"""Set-based inserts, updates and deletes: each returns the rows of the next snapshot."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F


def append_from_select(target: DataFrame, rows: DataFrame) -> DataFrame:
    """``target`` with ``rows`` added; columns ``rows`` omits are NULL."""
    typed = rows.select([
        F.col(f.name).cast(f.dataType).alias(f.name) for f in target.schema if f.name in rows.columns
    ])
    return target.unionByName(typed, allowMissingColumns=True)


def bulk_update(rows: DataFrame, condition: Column, changes: Mapping[str, Column]) -> DataFrame:
    """``rows`` with ``changes`` made where ``condition`` holds (not where it is NULL)."""
    return rows.select([
        F.when(condition, changes[f.name].cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name)
        if f.name in changes else F.col(f.name)
        for f in rows.schema
    ])


def bulk_delete(
    rows: DataFrame, condition: Column | None = None, keys: DataFrame | None = None, on: str | list[str] | None = None
) -> DataFrame:
    """``rows`` without those where ``condition`` holds or whose ``on`` columns are in ``keys``."""
    if condition is not None:
        rows = rows.where(~F.coalesce(condition, F.lit(False)))
    if keys is not None:
        rows = rows.join(keys.select(on).distinct(), on, "left_anti")
    return rows
