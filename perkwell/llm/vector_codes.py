"""Product codes of vectors by ball k-means.

Every vector is cut into equal parts; each part position has a codebook of its own, fitted by Lloyd rounds
on whole numbers. A round does not compare every part with every entry. The parts that an entry held after
the round before are its ball, and their largest distance to the moved entry is the radius. Only entries whose
half distance to the centre is within the radius are neighbours. A part nearer to its entry than half
the way to the nearest neighbour lies in the stable core and keeps its entry unseen. The others lie in rings: in
ring ``l`` only the ``l`` nearest neighbours can be nearer, and only those are compared. All comparisons are
exact in whole numbers, ties included, so the result is that of the plain method. Balls are taken within
a block of rows, whose radii are at most those of all rows, so nothing has to be gathered for them.

Each round reads the rows with their entries once; they are kept in memory or on the executors' disks, and a lost
part is computed again from the table. A task adds up its parts per entry, so entries * dimension sums per task are
shuffled and as many numbers in all reach the driver.

Edge cases: rows whose vector is NULL or holds NULL, NaN or infinite components are dropped. The length is that of the
first vector (by vec_id, NULLs last) that can be cut into equal parts; rows of another length, and rows with a
component too large for exact 64-bit sums (``largest``), come back with NULL code and error and shape nothing. Rows
sharing a vec_id stay apart. With fewer rows than entries there are as many entries as rows. A NULL label is a
label. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, StorageLevel
from pyspark.sql import DataFrame, functions as F

from perkwell.llm.common import salted_join
from perkwell.sources.checkpoints import cut

SALTS = 32
_STATE = "vec_id long, label string, x array<int>, entry binary, sums array<long>"


@dataclass(frozen=True)
class Plan:
    """Parts of a vector, entries of a codebook (256 at most), rounds, and steps per unit of a component."""

    parts: int = 8
    entries: int = 16
    rounds: int = 6
    scale: int = 4096


def largest(dimension: int) -> int:
    """Components below this keep four times a squared distance, and its sum over all parts, below 2^63."""
    return min(isqrt((1 << 59) // dimension), 1 << 30)


def whole_vectors(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id, label and components as whole numbers, without the rows that are not finite."""
    infinite = float("inf")
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == infinite))
    return vectors.filter(F.col("embedding").isNotNull()).filter(~bad).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("x"),
    )


# ---- balls -----------------------------------------------------------------------------


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    d = x - y
    return np.einsum("...i,...i->...", d, d)


def nearest(x: np.ndarray, entries: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each part and its squared distance, ties to the lower entry; ``held`` is where each part was before."""
    chosen = held.copy()
    least = squared(x, entries[held])
    apart = squared(entries[:, None], entries[None])
    order = np.argsort(held, kind="stable")
    bounds = np.searchsorted(held[order], np.arange(len(entries) + 1))
    for e in range(len(entries)):
        ball = order[bounds[e]:bounds[e + 1]]
        if not len(ball):
            continue
        # Four times a squared distance to the entry against the squared distance between entries: halves without fractions.
        reach = 4 * least[ball]
        radius = reach.max()
        near = [j for j in np.argsort(apart[e], kind="stable").tolist() if j != e and apart[e, j] <= radius]
        best, entry = least[ball], np.full(len(ball), e)
        for j in near:
            # Ring by ring: what remains lies beyond half the way to neighbour j. The first ring's inside is the stable core.
            beyond = np.flatnonzero(reach >= apart[e, j])
            if not len(beyond):
                break
            distance = squared(x[ball[beyond]], entries[j])
            better = (distance < best[beyond]) | ((distance == best[beyond]) & (j < entry[beyond]))
            best[beyond[better]] = distance[better]
            entry[beyond[better]] = j
        chosen[ball], least[ball] = entry, best
    return chosen, least


def _parts(column: pa.Array, dimension: int, parts: int) -> np.ndarray:
    """Components as (part, row, place)."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return np.ascontiguousarray(flat.reshape(-1, parts, dimension // parts).transpose(1, 0, 2))


def _entries(column: pa.Array, rows: int, parts: int) -> np.ndarray:
    """Entries of the round before as (part, row); all in the first entry where there was none."""
    if column.null_count:
        return np.zeros((parts, rows), np.int64)
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(rows, parts).T.astype(np.int64)


def _assigned(rows: DataFrame, sent: Broadcast) -> DataFrame:
    """The rows at their nearest entries, and one row per task with ``sums``: per entry and part the count, then the sums of its parts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = sent.value
        parts, entries, width = books.shape
        counts, sums = np.zeros((parts, entries), np.int64), np.zeros(books.shape, np.int64)
        for batch in batches:
            n = len(batch)
            x = _parts(batch.column(2), parts * width, parts)
            held = _entries(batch.column(3), n, parts)
            for p in range(parts):
                held[p], _ = nearest(x[p], books[p], held[p])
                counts[p] += np.bincount(held[p], minlength=entries)
                for w in range(width):
                    np.add.at(sums[p, :, w], held[p], x[p, :, w])
            codes = np.ascontiguousarray(held.T.astype(np.uint8))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), batch.column(2), pa.array([c.tobytes() for c in codes], pa.binary()), pa.nulls(n, pa.list_(pa.int64())),
            ], names)
        total = pa.array([np.concatenate([counts.ravel(), sums.ravel()]).tolist()], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.string()), pa.nulls(1, pa.list_(pa.int32())), pa.nulls(1, pa.binary()), total], names)

    names = ["vec_id", "label", "x", "entry", "sums"]
    return rows.filter("sums is null").mapInArrow(run, _STATE)


def _moved(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """Each entry at the floor of the mean of its parts; unused ones stay."""
    summed = state.filter("sums is not null").select(F.posexplode("sums").alias("place", "part_sum")).groupBy("place").agg(F.sum("part_sum").alias("total")).collect()
    flat = np.zeros(books.shape[0] * books.shape[1] * (1 + books.shape[2]), np.int64)
    for row in summed:
        flat[row["place"]] = row["total"]
    counts, sums = np.split(flat, [books.shape[0] * books.shape[1]])
    counts, sums = counts.reshape(books.shape[:2])[..., None], sums.reshape(books.shape)
    return np.where(counts > 0, sums // np.maximum(counts, 1), books)


def _coded(state: DataFrame, sent: Broadcast) -> DataFrame:
    """vec_id, label, code and error against the final entries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = sent.value
        parts, _, width = books.shape
        for batch in batches:
            n = len(batch)
            x, held = _parts(batch.column(2), parts * width, parts), _entries(batch.column(3), n, parts)
            error = np.zeros(n, np.int64)
            for p in range(parts):
                held[p], least = nearest(x[p], books[p], held[p])
                error += least
            digits = np.ascontiguousarray(held.T.astype(np.uint8)).tobytes().hex()
            codes = [digits[k:k + 2 * parts] for k in range(0, len(digits), 2 * parts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(codes, pa.string()), pa.array(error)], ["vec_id", "label", "code", "error"])

    return state.filter("sums is null").mapInArrow(run, "vec_id long, label string, code string, error long")


def codebooks_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def vector_codes(vectors: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """vec_id, code (two hex digits per part), error, error of all rows of the label, and a digest of the codebooks."""
    assert 0 < plan.entries <= 256
    spark = vectors.sparkSession
    rows = whole_vectors(vectors, plan.scale)
    by_id = [F.col("vec_id").asc_nulls_last(), "x"]
    # One vector is fetched, then those that begin the codebooks.
    first = rows.filter((F.size("x") > 0) & (F.size("x") % plan.parts == 0)).orderBy(*by_id).limit(1).collect()
    if not first:
        return rows.select("vec_id", *[F.lit(None).cast(t).alias(c) for c, t in (("code", "string"), ("error", "long"), ("label_error", "long"))], F.lit(codebooks_digest(np.zeros(0, int))).alias("codebooks_sha256"))
    dimension = len(first[0]["x"])
    fits = (F.size("x") == dimension) & ~F.exists("x", lambda v: F.abs(v) >= largest(dimension))
    starting = rows.filter(fits).orderBy(*by_id).limit(plan.entries).collect()
    state = rows.filter(fits).select("vec_id", "label", F.col("x").cast("array<int>").alias("x"), F.lit(None).cast("binary").alias("entry"), F.lit(None).cast("array<long>").alias("sums"))
    books = np.array([r["x"] for r in starting], np.int64).reshape(len(starting), plan.parts, dimension // plan.parts).transpose(1, 0, 2).copy()
    kept = []
    for _ in range(plan.rounds if starting else 0):
        state = _assigned(state, spark.sparkContext.broadcast(books)).persist(StorageLevel.MEMORY_AND_DISK)
        books = _moved(state, books)
        kept.append(state)
        if len(kept) > 1:
            kept[-2].unpersist()
    coded = _coded(state, spark.sparkContext.broadcast(books)) if starting else state.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    coded = cut(coded.union(rows.filter(~fits).select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))))
    for state in kept[-1:]:
        state.unpersist()
    named = coded.withColumn("_label", F.coalesce(F.concat(F.lit("="), "label"), F.lit("")))
    summed = named.groupBy("_label").agg(F.sum("error").alias("label_error"))
    return salted_join(named, summed, ["_label"], "vec_id", SALTS).select(
        "vec_id", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256")
    )
