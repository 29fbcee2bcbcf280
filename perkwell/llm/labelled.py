"""Held-out rows and bounded training samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SAMPLE_ROWS = 20_000


def held_out(doc_id: str, parts: int, part: int) -> Column:
    """Whether the row is kept from training: crc32 of the id as text leaves ``part`` modulo ``parts``."""
    rest = F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts
    return F.coalesce(rest == part, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, parts: int, part: int, rows: int = SAMPLE_ROWS) -> DataFrame:
    """text and label of at most ``rows`` labelled documents that are not held out.

    The sample is drawn by a hash of the id, so its labels are bounded in size and can
    be sent to every task; the texts of the other documents are not shuffled.
    """
    usable = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id", parts, part))
    drawn = usable.groupBy("doc_id").agg(F.max(label).alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").select("text", "label")
