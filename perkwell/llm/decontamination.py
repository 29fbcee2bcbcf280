"""Benchmark items inside documents: MinHash containment search, partitioned by item size.

An item of ``n`` shingles is kept as its ``SKETCH`` smallest shingle hashes
(bottom-k MinHash). Items are partitioned by size, ``[2^c, 2^(c+1))`` shingles,
because a short item needs a larger part of a document's hashes than a long one:
each partition has as its threshold the largest hash in its sketches, and a
document offers to it only the hashes up to there, however long the document is.
A document that shares any sketch hash with an item is a candidate: one that
holds 0.8 of an item misses all of 16 sketch hashes with probability 0.2^16.
Candidates are verified by exact containment: the part of the item's distinct
shingles, compared as strings, that the whole document holds.

Items with fewer words than a shingle are a single shingle of their own length.

Edge cases: NULL or wordless items match nothing; NULL or empty documents hold
nothing; rows sharing a doc_id count as one document with its best row; equal
items are searched once and reported under each of their ids; other columns are
not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from perkwell.llm.common import SHINGLE_WORDS, SIMILAR, let, shingles, whole_text, words
from perkwell.sources.checkpoints import cut

SKETCH = 16
# Above this many sketch rows (about 40 MB) the item side is no longer sent to every task.
SENT_ROWS = 1_000_000


def item_shingles(items: DataFrame) -> DataFrame:
    """Distinct items: ``_item`` (an id of equal shingle sets), ``_runs`` and how many words a shingle has."""
    listed = items.select("item_id", words(whole_text()).alias("_words"))
    length = F.least(F.size("_words"), F.lit(SHINGLE_WORDS))
    short = F.array(F.array_join("_words", " "))
    runs = F.when(length == SHINGLE_WORDS, shingles(F.col("_words"))).otherwise(short)
    return listed.filter(F.size("_words") > 0).select(
        "item_id", length.alias("_length"), F.array_sort(runs).alias("_runs")
    ).withColumn("_item", F.xxhash64("_runs", "_length"))


def sketches(items: DataFrame) -> DataFrame:
    """Sketch hashes of each distinct item, with its size class."""
    distinct = items.dropDuplicates(["_item"])
    hashed = F.array_sort(F.transform("_runs", lambda r: F.xxhash64(r)))
    size_class = F.floor(F.log2(F.size("_runs").cast("double"))).cast("int")
    return distinct.select("_item", size_class.alias("_class"), F.explode(F.slice(hashed, 1, SKETCH)).alias("_hash"))


def _hashes(word_list: Column, lengths: list[int]) -> Column:
    return let(word_list, lambda w: F.array_distinct(F.concat(*[
        F.transform(shingles(w, n), lambda r: F.xxhash64(r)) for n in lengths
    ])))


def contained_items(docs: DataFrame, items: DataFrame, least: float = SIMILAR) -> DataFrame:
    """doc_id, item_id, n_shingles of the item, n_shared and containment, where that is at least ``least``."""
    known = cut(item_shingles(items))
    sketch = cut(sketches(known))
    lengths = sorted(r["_length"] for r in known.select("_length").distinct().collect()) or [SHINGLE_WORDS]
    bounds = {r["_class"]: r["t"] for r in sketch.groupBy("_class").agg(F.max("_hash").alias("t")).collect()}
    widest = max(bounds.values(), default=-(2**63))
    few = sketch.count() <= SENT_ROWS
    sent = F.broadcast if few else (lambda side: side)

    offered = docs.select("doc_id", F.filter(_hashes(words(whole_text()), lengths), lambda h: h <= F.lit(widest)).alias("_h"))
    offered = offered.select("doc_id", F.explode("_h").alias("_hash"))
    in_class = reduce(lambda a, b: a | b, [
        (F.col("_class") == c) & (F.col("_hash") <= F.lit(t)) for c, t in sorted(bounds.items())
    ], F.lit(False))
    pairs = cut(offered.join(sent(sketch), "_hash").filter(in_class).select("doc_id", "_item").distinct())

    wanted = pairs.select("doc_id").distinct()
    texts = docs.select("doc_id", whole_text().alias("_text")).join(wanted, "doc_id", "left_semi")
    held = texts.select("doc_id", let(words(F.col("_text")), lambda w: F.concat(*[shingles(w, n) for n in lengths])).alias("_held"))
    distinct_items = known.dropDuplicates(["_item"]).select("_item", "_runs")
    shared = F.size(F.array_intersect("_held", "_runs")).cast("long")
    checked = (
        pairs.join(sent(distinct_items), "_item").join(held, "doc_id")
        .withColumn("n_shared", shared).withColumn("n_shingles", F.size("_runs").cast("long"))
        .filter(F.col("n_shared") >= F.col("n_shingles") * F.lit(least))
        .groupBy("doc_id", "_item").agg(F.max("n_shared").alias("n_shared"), F.max("n_shingles").alias("n_shingles"))
    )
    return checked.join(sent(known.select("_item", "item_id").distinct()), "_item").select(
        "doc_id", "item_id", "n_shingles", "n_shared", (F.col("n_shared") / F.col("n_shingles")).alias("containment")
    )


def without_contaminated(docs: DataFrame, items: DataFrame, least: float = SIMILAR) -> DataFrame:
    """The documents that hold no item."""
    found = contained_items(docs, items, least).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)
