"""Spot signatures: chains of content words after common-word anchors.

Every occurrence of an anchor (a common word of English, German, French or
Spanish) gives a signature of the anchor and the next ``CHAIN`` content words.
The set of signatures is the fingerprint, written as sorted 48-bit hashes; text
around the running prose, which has few common words, adds little to it.

Two fingerprints are compared by Jaccard similarity. Sets can only reach a
similarity ``t`` if the smaller has at least ``t`` times the size of the larger,
so ``similar_documents`` partitions them by size and compares neighbours only,
and within a partition only sets that share one of their first (rarest)
signatures.

Edge cases: NULL counts as empty; a text without signatures gets the hash of its
words in order as its only signature, so equal texts always have equal
fingerprints and unequal junk does not coincide; extra columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from perkwell.llm.common import SIMILAR, let, whole_text, words
from perkwell.sources.checkpoints import cut

# Common words of the four languages.
ANCHORS = (
    "the of and to in is that for it was on are as with be by at this from or an not have had his they which but "
    "der die das und ist von mit sich des auf für im dem nicht ein eine als auch es den zu "
    "le la les et est un une du que qui dans pour par sur pas au avec ce il ne "
    "el los las y en una por con para no se su al lo como más del"
).split()
CHAIN = 2
HASH_DIGITS = 12
ROWS_PER_BLOCK = 1024


def signatures(text: Column) -> Column:
    """The sorted set of hashed signatures of a text."""
    return let(words(text), lambda w: let(_parts(w), lambda parts: _chains(w, parts)))


def _parts(word_list: Column) -> Column:
    """Each content word with the anchors that stand right before it, as ``anchor^anchor^word``."""
    marked = F.transform(word_list, lambda w: F.concat(w, F.when(w.isin(ANCHORS), F.lit("^")).otherwise(F.lit(" "))))
    return F.split(F.rtrim(F.array_join(marked, "")), " ")


def _chains(word_list: Column, parts: Column) -> Column:
    def content(part: Column) -> Column:
        return F.substring_index(F.coalesce(part, F.lit("")), "^", -1)

    def spots(part: Column, i: Column) -> Column:
        chain = F.concat_ws(":", *[content(F.get(parts, i + k)) for k in range(CHAIN)])
        return let(F.split(part, r"\^"), lambda pieces: let(chain, lambda c: F.transform(
            F.slice(pieces, F.lit(1), F.size(pieces) - 1), lambda a: _hashed(F.concat(a, F.lit(":"), c))
        )))

    found = F.transform(parts, lambda p, i: F.when(F.contains(p, F.lit("^")), spots(p, i)))
    anchored = F.array_sort(F.array_distinct(F.flatten(F.filter(found, lambda c: c.isNotNull()))))
    whole = F.array(_hashed(F.array_join(word_list, " ")))
    return let(anchored, lambda a: F.when(F.size(a) > 0, a).otherwise(whole))


def _hashed(value: Column) -> Column:
    return F.substring(F.md5(value), 1, HASH_DIGITS)


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets."""
    shared = F.size(F.array_intersect(a, b))
    return (shared / (F.size(a) + F.size(b) - shared)).cast("double")


def with_next(docs: DataFrame, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """doc_id, text, signatures and those of the next document in descending doc_id, the first one after the last.

    Documents are dealt into blocks of neighbouring ids (NULL ids come last, in a block of
    their own), so each block finds its followers alone and texts are shuffled once.
    Only the first document of each block is also handed to the block before it.
    """
    span = docs.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n")).first()
    low, high = span["low"] or 0, span["high"] or 0
    width = max(1, math.ceil((high - low + 1) * rows_per_block / max(span["n"], 1)))
    block = F.coalesce(F.floor((F.col("doc_id") - F.lit(low)) / F.lit(width)), F.lit(-1))
    blocked = docs.select(block.alias("_block"), "doc_id", whole_text().alias("text"))
    firsts = cut(blocked.groupBy("_block").agg(F.max(F.struct("doc_id", "text")).alias("_first")))
    among = Window.orderBy(F.col("_block").desc())
    chain = firsts.select("_block", F.coalesce(F.lead("_block").over(among), F.first("_block").over(among)).alias("_from"))
    handed = chain.join(firsts.withColumnRenamed("_block", "_from"), "_from").select("_block", "_first")

    inside = Window.partitionBy("_block").orderBy(F.col("doc_id").desc_nulls_last(), F.col("text").desc())
    rows = blocked.withColumn("_next", F.lead("text").over(inside)).withColumn("signatures", signatures(F.col("text")))
    rows = rows.withColumn("_next_signatures", F.lead("signatures").over(inside)).join(handed, "_block")
    return rows.select(
        "doc_id", "text", "signatures", F.coalesce("_next", "_first.text").alias("next_text"),
        F.coalesce("_next_signatures", signatures(F.col("_first.text"))).alias("next_signatures"),
    )


def edited(text: Column, following: Column) -> Column:
    """The text with its last third replaced by as many first code points of the following text."""
    third = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.left(text, F.length(text) - third), F.left(following, third))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text (never NULL) and ``signatures`` of each document."""
    return docs.select("doc_id", whole_text().alias("text")).withColumn("signatures", signatures(F.col("text")))


def size_class(size: Column, similar: float = SIMILAR) -> Column:
    """Partition of a set by its size: similar sets lie in the same or in neighbouring ones."""
    return F.floor(F.log(size.cast("double")) / F.lit(-math.log(similar)) + F.lit(1e-9)).cast("int")


def similar_documents(prints: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """Pairs of fingerprints at least ``similar``, with one document each and how many share it.

    ``prints`` has doc_id and signatures. Equal fingerprints are brought down to their
    smallest doc_id first, so a group of copies takes part once.
    """
    sets = cut(prints.groupBy("signatures").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n_docs")))
    spread = sets.select("doc_id", F.explode("signatures").alias("sig"))
    frequency = spread.groupBy("sig").agg(F.count("*").alias("df"))
    ranked = spread.join(frequency, "sig").groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("df", "sig"))).alias("ranked"))
    size = F.size("ranked")
    first = F.slice("ranked", F.lit(1), (size - F.ceil(size * F.lit(similar) - F.lit(1e-9)) + 1).cast("int"))
    rows = ranked.withColumn("_class", size_class(size, similar))
    probe = rows.select("doc_id", "_class", F.explode(first["sig"]).alias("sig"))
    neighbours = probe.withColumn("_class", F.explode(F.array(F.col("_class"), F.col("_class") + 1)))
    pairs = (
        probe.withColumnRenamed("doc_id", "b").join(neighbours.withColumnRenamed("doc_id", "a"), ["_class", "sig"])
        .filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )
    left = sets.select(F.col("doc_id").alias("a"), F.col("signatures").alias("_sa"), F.col("n_docs").alias("n_a"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("signatures").alias("_sb"), F.col("n_docs").alias("n_b"))
    smaller, larger = F.least(F.size("_sa"), F.size("_sb")), F.greatest(F.size("_sa"), F.size("_sb"))
    return (
        pairs.join(left, "a").join(right, "b").filter(smaller >= larger * F.lit(similar))
        .withColumn("likeness", likeness(F.col("_sa"), F.col("_sb"))).filter(F.col("likeness") >= similar)
        .select("a", "b", "likeness", "n_a", "n_b")
    )


def edit_report(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form, and how alike they are."""
    rows = with_next(docs).withColumn("edited_text", edited(F.col("text"), F.col("next_text")))
    rows = rows.withColumn("edited_signatures", signatures(F.col("edited_text")))
    return rows.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited_text", 256).alias("edited_sha256"),
        F.array_join("signatures", "").alias("fingerprint"), F.array_join("edited_signatures", "").alias("edited_fingerprint"),
        likeness(F.col("signatures"), F.col("edited_signatures")).alias("near_edited"),
        likeness(F.col("signatures"), F.col("next_signatures")).alias("near_next"),
        size_class(F.size("signatures")).alias("size_class"),
    )
