"""Data checks and table upkeep that a database would do through constraints."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F

from perkwell.functions.columns import MONEY, moment
from perkwell.operators.ordering import BLOCK, block_offsets, place_in_order, row_in_block
from perkwell.schemas import (
    DEFAULTS, FIRST_IDS, NOW, PRIMARY_KEYS, REFERENCES, RULES, SCHEMAS, UNIQUE_COLUMNS, USER, Reference,
)
from perkwell.sources.checkpoints import cut


def row_key(table: str) -> Column:
    return F.concat_ws("|", *[F.col(c).cast("string") for c in PRIMARY_KEYS[table]])


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def check_violations(
    tables: Mapping[str, DataFrame], rules: Mapping[str, Mapping[str, str]] = RULES
) -> DataFrame:
    """Rows that break a check rule, as (table_name, rule_name, row_key).

    One pass per table tests all its rules. A rule that comes out NULL is kept.
    A rule on a column that its table does not have is an error, as the check would be incomplete.
    """
    parts = []
    for name, rows in tables.items():
        for rule, test in rules.get(name, {}).items():
            if absent := sorted(_columns_of(test) - set(rows.columns)):
                raise ValueError(f"rule {rule} of {name} needs the columns {', '.join(absent)}")
        broken = {rule: ~F.coalesce(F.expr(test), F.lit(True)) for rule, test in rules.get(name, {}).items()}
        if broken:
            parts.append(_flagged(rows, broken, "rule_name").select(
                F.lit(name).alias("table_name"), "rule_name", row_key(name).alias("row_key")
            ))
    return union_all(parts)


def _flagged(rows: DataFrame, flags: Mapping[str, Column], name: str) -> DataFrame:
    """A row per raised flag; rows without one are filtered out before anything is unfolded."""
    raised = F.array_compact(F.array(*[F.when(test, F.lit(flag)) for flag, test in flags.items()]))
    return rows.where(reduce(or_, flags.values())).withColumn(name, F.explode(raised))


def _columns_of(test: str) -> set[str]:
    """Column names of a rule: its lower-case words (keywords and values are upper case)."""
    words = "".join(c if c.isalnum() or c == "_" else " " for c in test).split()
    return {w for w in words if w.islower()}


def fk_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Child rows whose key has no parent, as (table_name, column_name, row_key, missing_key).

    Keys are made distinct where the rows are read, so a key that many rows share meets
    the parents once; only rows of the few missing keys are then looked up.
    """
    parts = []
    for ref in REFERENCES:
        if ref.child in tables and ref.parent in tables:
            missing = F.col(ref.column)
            parents = tables[ref.parent].select(F.col(ref.parent_key).alias(ref.column))
            children = tables[ref.child].where(missing.isNotNull())
            orphans = children.select(ref.column).distinct().join(parents, ref.column, "left_anti")
            parts.append(
                children.join(orphans, ref.column, "left_semi")
                .select(
                    F.lit(ref.child).alias("table_name"), F.lit(ref.column).alias("column_name"),
                    row_key(ref.child).alias("row_key"), missing.alias("missing_key"),
                )
            )
    return union_all(parts)


def unique_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Repeated key values and NULLs in required columns, as (table_name, key_name, key_value, row_count).

    Every table is read once: a row gives one narrow entry (key, hash of its value) per key and one per required
    column that is NULL, and all entries of all tables are counted together. A hash that occurs once cannot be a
    repeated value. Only tables with other hashes are read again, and only rows with those are counted by value.
    """
    names = [(table, key) for table in tables for key in _unique_keys(table)]
    numbers = {pair: k for k, pair in enumerate(names)}
    needed = [(t, f.name) for t, rows in tables.items() for f in SCHEMAS[t] if not f.nullable and f.name in rows.columns]
    absent = {pair: len(names) + k for k, pair in enumerate(needed)}

    def entries(table: str, rows: DataFrame) -> DataFrame:
        keys = [
            F.when(_all_there(key), F.struct(F.lit(numbers[table, key]).alias("key_no"), F.xxhash64(*key).alias("hash")))
            for key in _unique_keys(table)
        ]
        nulls = [
            F.when(F.col(c).isNull(), F.struct(F.lit(k).alias("key_no"), F.lit(None).cast("long").alias("hash")))
            for (t, c), k in absent.items() if t == table
        ]
        return rows.select(F.explode(F.array_compact(F.array(*keys, *nulls))).alias("_e")).select("_e.*")

    counted = union_all([entries(t, rows) for t, rows in tables.items()]).groupBy("key_no", "hash").agg(F.count("*").alias("row_count"))
    found = cut(counted.where("hash IS NULL OR row_count > 1"))
    suspects = found.where("hash IS NOT NULL").select("key_no", "hash")
    # At most one row per key of a table.
    doubtful = {names[r["key_no"]][0] for r in suspects.select("key_no").distinct().collect()}

    def values(table: str, rows: DataFrame) -> DataFrame:
        keys = [
            F.when(_all_there(key), F.struct(
                F.lit(numbers[table, key]).alias("key_no"), F.xxhash64(*key).alias("hash"),
                F.concat_ws("|", *[F.col(c).cast("string") for c in key]).alias("key_value"),
            )) for key in _unique_keys(table)
        ]
        return rows.select(F.explode(F.array_compact(F.array(*keys))).alias("_e")).select("_e.*")

    empty = found.select("key_no", "hash", F.lit("").alias("key_value")).limit(0)
    rows = union_all([empty, *[values(t, tables[t]) for t in tables if t in doubtful]])
    repeated = (
        rows.join(suspects, ["key_no", "hash"], "left_semi").groupBy("key_no", "key_value").agg(F.count("*").alias("row_count"))
        .where("row_count > 1")
    )
    missing = found.where("hash IS NULL").select("key_no", F.lit("NULL").alias("key_value"), "row_count")
    table_of = F.array(*[F.lit(t) for t, _ in names + needed])
    key_of = F.array(*[F.lit(",".join(key)) for _, key in names], *[F.lit(c) for _, c in needed])
    return repeated.unionByName(missing).select(
        F.get(table_of, F.col("key_no")).alias("table_name"), F.get(key_of, F.col("key_no")).alias("key_name"), "key_value", "row_count"
    )


def _unique_keys(table: str) -> list[tuple[str, ...]]:
    return [PRIMARY_KEYS[table], *[(c,) for c in UNIQUE_COLUMNS.get(table, ())]]


def _all_there(key: Sequence[str]) -> Column:
    return reduce(and_, [F.col(c).isNotNull() for c in key])


def cascade_delete(
    tables: Mapping[str, DataFrame], root: str, doomed: DataFrame, references: Sequence[Reference] = REFERENCES,
    keys: Mapping[str, Sequence[str]] = PRIMARY_KEYS,
) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Delete rows of ``root`` by key and everything that hangs on them. Returns (deleted, kept) per table.

    First only keys are followed: the keys found in a round lead to the keys of their children, of which
    those not found before make the next round. So a key is followed once, whatever paths or cycles lead to it, and the
    rounds end with the longest chain. Then every table is joined once: one that has children with its own
    doomed keys, any other with those of its parents.
    """
    parents = {ref.parent for ref in references} | {root}
    gone = _doomed_keys(tables, root, doomed, references, keys, parents)
    deleted, kept = {}, {}
    for name, rows in tables.items():
        links = [ref for ref in references if ref.child == name and ref.parent in gone]
        if name in gone:
            key = list(keys[name])
            deleted[name], kept[name] = rows.join(gone[name], key, "left_semi"), rows.join(gone[name], key, "left_anti")
        elif name in parents or not links:
            kept[name] = rows
        else:
            marked = rows
            for i, ref in enumerate(links):
                mark = gone[ref.parent].select(F.col(keys[ref.parent][0]).alias(ref.column), F.lit(True).alias(f"_gone{i}"))
                marked = marked.join(mark, ref.column, "left")
            hit = F.coalesce(*[F.col(f"_gone{i}") for i in range(len(links))], F.lit(False))
            deleted[name], kept[name] = marked.where(hit).select(rows.columns), marked.where(~hit).select(rows.columns)
    return deleted, kept


def _doomed_keys(
    tables: Mapping[str, DataFrame], root: str, doomed: DataFrame, references: Sequence[Reference],
    keys: Mapping[str, Sequence[str]], parents: set[str],
) -> dict[str, DataFrame]:
    """The keys to delete of every table that has children, each written once."""
    key = list(keys[root])
    fresh = {root: cut(tables[root].select(*key).join(doomed.select(*key).distinct(), key, "left_semi"))}
    gone = dict(fresh)
    while fresh:
        found: dict[str, list[DataFrame]] = {}
        for ref in references:
            if ref.parent in fresh and ref.child in tables and ref.child in parents:
                # The column may be the child's own key.
                rows = tables[ref.child].select(*[F.col(c).alias(f"_key{k}") for k, c in enumerate(keys[ref.child])], F.col(ref.column).alias("_ref"))
                hit = rows.join(fresh[ref.parent].select(F.col(keys[ref.parent][0]).alias("_ref")), "_ref", "left_semi")
                found.setdefault(ref.child, []).append(hit.select(*[F.col(f"_key{k}").alias(c) for k, c in enumerate(keys[ref.child])]))
        fresh = {}
        for name, parts in found.items():
            new = union_all(parts).distinct()
            if name in gone:
                new = new.join(gone[name], list(keys[name]), "left_anti")
            new = cut(new)
            if not new.isEmpty():
                fresh[name] = new
                gone[name] = gone[name].unionByName(new) if name in gone else new
    return gone


def apply_defaults(rows: DataFrame, table: str, as_of: datetime, user: str | None = None) -> DataFrame:
    """Add the columns ``rows`` omits with their declared default, else NULL; given NULLs stay.

    ``user`` is whoever makes the change, the default of ``changed_by``.
    """
    out = []
    for field in SCHEMAS[table]:
        if field.name in rows.columns:
            value = F.col(field.name)
        else:
            default = DEFAULTS.get(table, {}).get(field.name)
            value = moment(as_of) if default is NOW else F.lit(user if default is USER else default)
        out.append(value.cast(field.dataType).alias(field.name))
    return rows.select(out)


def assign_keys(rows: DataFrame, order_by: Sequence[str], key: str, start: int | Column) -> DataFrame:
    """Number rows from ``start`` without gaps along ``order_by``.

    Rows are counted per ordered block and numbered within it, so no task sees
    the whole table. Ties are broken by a hash of the row, which also spreads a
    value that very many rows share over several blocks.
    """
    placed = place_in_order(rows.withColumn("_tie", F.xxhash64(*rows.columns)), [*order_by, "_tie"])
    sizes = placed.groupBy(BLOCK).agg(F.count("*").alias("_size"))
    offsets = block_offsets(sizes, "_size", "_before")
    start = F.lit(start) if isinstance(start, int) else start
    number = start + F.col("_before") + row_in_block() - 1
    return placed.join(offsets, BLOCK).select(number.cast("long").alias(key), *rows.columns)


def first_id(table: str) -> int:
    return FIRST_IDS.get(table, 1)


def evolve_redemptions(redemptions: DataFrame) -> DataFrame:
    """Bring redemptions without a discount to the later layout; a missing ``points_used`` is 0."""
    out = redemptions
    if "discount_value" not in out.columns:
        out = out.withColumn("discount_value", F.lit(None).cast(MONEY))
    if "points_used" not in out.columns:
        out = out.withColumn("points_used", F.lit(0).cast("long"))
    return out
