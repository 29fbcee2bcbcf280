"""Near-duplicate documents by consistent weighted sampling.

A document is the weighted set of its five-word shingles. The weight of a shingle is
how often it occurs (tf) times the mean inverse document frequency of its words
(idf). Frequencies are those of words and not of whole shingles because the
shingles of a group of copies are frequent only through the copies, which would
weigh the few words that differ above all that is shared. The idf of a word in a share f of all
documents is log(1 + 1 / f), and that of a share of 1 / ``RAREST`` for all rarer words. So only words that
frequent are listed, exactly; documents of w different words have at most w * ``RAREST`` of them, however many
documents there are.

Improved consistent weighted sampling draws ``BANDS * ROWS`` samples per document;
two documents agree in a sample with the probability of their weighted Jaccard
similarity. Documents that agree in a whole band share a bucket. First every document
is compared with one anchor per bucket, by exact weighted Jaccard of the whole texts,
then what is left with a second anchor from outside the first one's class. That connects
most classes with one comparison per document and bucket. A member leaves its bucket
where the distances to the anchor rule out a link to another class. Of the
others all pairs of different classes are compared, block by block inside the
tasks, so no pair that shares a bucket is given up.

Anchors are the members of the largest buckets: the text that the others were
edited from agrees with more of them than they do with each other.

A text is known by its digest, and all is decided between different texts. They are numbered once; rows
take the class of their text, whatever their doc_id.

Edge cases: a NULL text counts as empty; equal texts are one class, empty ones too;
a text of fewer than five words is a single shingle of its own. A class is named by its smallest
doc_id, NULL if all its rows lack one; rows sharing a doc_id and rows without one are classed
row by row. Of each class the row with the smallest doc_id stays (rows without one come last), of several such rows
the one with the smallest digest, and of rows that agree in both, any one. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from perkwell.llm.common import SHINGLE_WORDS, SIMILAR, salted_join, whole_text
from perkwell.llm.components import components, near_roots
from perkwell.llm.textbytes import mixed, packed, shingle_hashes, slices, text_batches, word_hashes
from perkwell.sources.checkpoints import written

# Words in fewer than one of so many documents all weigh the same.
RAREST = 4096
BANDS = 12
ROWS = 4
SAMPLES = BANDS * ROWS
TABLE_BITS = 16
# Words counted together before their counts leave the task.
WORDS_TOGETHER = 1 << 18
CHUNK = 1 << 14
SALTS = 8
# Pairs of one anchor that meet in a part of their own.
PAIRS_TOGETHER = 512
# Steps of similarity to an anchor; texts and characters of a block; a shingle of so many texts is heavy and multiplied so many at a time.
STEP = 0.05
BLOCK, BLOCK_CHARS = 256, 1 << 21
HEAVY, WIDE = 8, 2048


# ---- document frequencies ------------------------------------------------------------


class WordWeights:
    """1000 log(1 + documents / df), rounded, of the listed words; all others weigh like the rarest."""

    def __init__(self, hashes: np.ndarray, df: np.ndarray, documents: int) -> None:
        order = np.argsort(hashes)
        self.hashes, self.weights = hashes[order], np.rint(1000 * np.log1p(documents / np.maximum(df[order], 1))).astype(np.int32)
        self.rarest = np.int32(np.rint(1000 * np.log1p(RAREST)))

    def of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.full(len(hashes), self.rarest)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.weights[at], self.rarest)


def word_frequencies(docs: DataFrame) -> WordWeights:
    """Exact document counts of all words, of which those in at least one of ``RAREST`` documents are listed."""
    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        word, place = np.unique(np.concatenate([w for w, _ in parts]), return_inverse=True)
        return word, np.bincount(place, np.concatenate([d for _, d in parts]), minlength=len(word)).astype(np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray]] = []

        def told() -> pa.RecordBatch:
            word, df = merged(parts)
            parts.clear()
            return pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(df)], ["word", "df"])

        for batch in batches:
            for _, _, texts in text_batches(batch.column(0)):
                hashes, bounds = word_hashes(*packed(texts))
                doc = np.repeat(np.arange(len(texts)), np.diff(bounds))
                order = np.lexsort((doc, hashes))
                hashes, doc = hashes[order], doc[order]
                new = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])]) if len(hashes) else np.zeros(0, bool)
                parts.append(np.unique(hashes[new], return_counts=True))
                if sum(len(w) for w, _ in parts) >= WORDS_TOGETHER:
                    yield told()
        if parts:
            yield told()

    n = docs.count()
    counted = docs.select("text").mapInArrow(count, "word long, df long").groupBy("word").agg(F.sum("df").alias("df"))
    listed = counted.filter(F.col("df") * RAREST >= n).toArrow()
    return WordWeights(listed["word"].to_numpy().astype(np.int64).view(np.uint64), listed["df"].to_numpy().astype(np.int64), n)


# ---- weighted shingles ---------------------------------------------------------------


def weighted_shingles(texts: list[str | None], idf: WordWeights) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row number, shingle hash (48 bits) and weight of the distinct shingles, sorted by row and hash."""
    hashes, bounds = word_hashes(*packed(texts))
    counts = np.diff(bounds)
    doc = np.repeat(np.arange(len(texts)), counts)
    word_idf = idf.of(hashes)
    runs = shingle_hashes(hashes, SHINGLE_WORDS)
    n = len(runs)
    whole = np.zeros(n, bool) if not n else doc[:n] == doc[SHINGLE_WORDS - 1:]
    # Whole numbers, so that a sum does not depend on what stands before it.
    total = np.concatenate([[0], np.cumsum(word_idf, dtype=np.int64)])
    mean = (total[SHINGLE_WORDS:] - total[:-SHINGLE_WORDS]) / SHINGLE_WORDS if n else np.zeros(0)
    rows, keys, weights = doc[:n][whole], runs[whole], mean[whole]
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE_WORDS))
    if len(short):
        alone = [mixed(np.add.reduce(hashes[bounds[k]:bounds[k + 1]] * np.arange(1, counts[k] + 1, dtype=np.uint64))[None])[0] for k in short]
        rows, keys = np.concatenate([rows, short]), np.concatenate([keys, np.array(alone, np.uint64)])
        weights = np.concatenate([weights, [(total[bounds[k + 1]] - total[bounds[k]]) / counts[k] for k in short]])
    key = rows.astype(np.uint64) << np.uint64(48) | keys >> np.uint64(16)
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    weight = np.add.reduceat(weights[order], first) / 1000 if len(key) else np.zeros(0)
    key = key[first]
    return (key >> np.uint64(48)).astype(np.int64), key & np.uint64((1 << 48) - 1), weight


# ---- sampling ------------------------------------------------------------------------


def _random_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gamma(2,1) r, log of Gamma(2,1) c and uniform b for each table row and sample."""
    rng = np.random.Generator(np.random.PCG64(20240517))
    shape = (1 << TABLE_BITS, SAMPLES)
    r = rng.standard_gamma(2.0, shape).astype(np.float32)
    log_c = np.log(rng.standard_gamma(2.0, shape)).astype(np.float32)
    return r, log_c, rng.random(shape).astype(np.float32)


def samples(row: np.ndarray, key: np.ndarray, weight: np.ndarray, n: int, tables: tuple) -> np.ndarray:
    """One 64-bit value per row and sample: the chosen shingle and its quantised weight.

    Shingles that fall on the same table row compete with the same random numbers; the
    smaller hash wins a tie, so the choice depends on the set alone.
    """
    r_table, log_c_table, b_table = tables
    best = np.full((n, SAMPLES), np.inf, np.float32)
    chosen = np.zeros((n, SAMPLES), np.uint64)
    log_w = np.log(np.maximum(weight, 1e-3)).astype(np.float32)
    for begin in range(0, len(row), CHUNK):
        part = slice(begin, begin + CHUNK)
        slot = (key[part] & np.uint64((1 << TABLE_BITS) - 1)).astype(np.int64)
        r, b = r_table[slot], b_table[slot]
        t = np.floor(log_w[part, None] / r + b)
        a = log_c_table[slot] - r * (t - b + 1)
        edges = np.flatnonzero(np.concatenate([[True], row[part][1:] != row[part][:-1]]))
        least = np.minimum.reduceat(a, edges, axis=0)
        length = np.diff(np.concatenate([edges, [len(slot)]]))
        position = np.where(a == np.repeat(least, length, axis=0), np.arange(len(slot), dtype=np.int32)[:, None], np.int32(len(slot)))
        at = np.minimum.reduceat(position, edges, axis=0)
        value = mixed(key[part][at] * np.uint64(0x9E3779B97F4A7C15) + np.take_along_axis(t, at, axis=0).astype(np.int64).astype(np.uint64))
        docs = row[part][edges]
        better = least < best[docs]
        best[docs] = np.where(better, least, best[docs])
        chosen[docs] = np.where(better, value, chosen[docs])
    return chosen


def band_keys(chosen: np.ndarray) -> np.ndarray:
    keys = np.zeros((len(chosen), BANDS), np.uint64)
    for k in range(ROWS):
        keys = mixed(keys * np.uint64(0xD1342543DE82EF95) + chosen[:, k::ROWS] + np.arange(1, BANDS + 1, dtype=np.uint64))
    return keys.view(np.int64)


def sampled(docs: DataFrame, sent: Broadcast) -> DataFrame:
    """doc_id, digest of the text, band keys (NULL for a text without words) and length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _random_tables()
        for batch in batches:
            for begin, end, texts in text_batches(batch.column(2)):
                row, key, weight = weighted_shingles(texts, sent.value)
                chosen = samples(row, key, weight, len(texts), tables)
                keys = band_keys(chosen)
                filled = np.bincount(row, minlength=len(texts)) > 0
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(begin, end - begin), batch.column(1).slice(begin, end - begin),
                    pa.array([k.tolist() if f else None for k, f in zip(keys, filled, strict=True)], pa.list_(pa.int64())),
                    pa.array([len(t or "") for t in texts], pa.int64()),
                ], ["doc_id", "digest", "bands", "chars"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest_of_text(), "text").mapInArrow(
        run, "doc_id long, digest binary, bands array<long>, chars long"
    )


def digest_of_text() -> Column:
    return F.unhex(F.md5(whole_text())).alias("digest")


# ---- comparison ----------------------------------------------------------------------


def _similarity(left: list[str | None], right: list[str | None], idf: WordWeights) -> np.ndarray:
    """Exact weighted Jaccard of the texts that stand at the same place."""
    n = len(left)
    # The two texts of a pair are rows k and n + k; equal shingles of both meet after sorting.
    row, key, weight = weighted_shingles(left + right, idf)
    pair = row % n
    order = np.argsort(pair.astype(np.uint64) << np.uint64(48) | key, kind="stable")
    pair_, key_, weight_ = pair[order], key[order], weight[order]
    same = np.flatnonzero((pair_[1:] == pair_[:-1]) & (key_[1:] == key_[:-1]))
    shared = np.bincount(pair_[same], np.minimum(weight_[same], weight_[same + 1]), minlength=n)
    every = np.bincount(pair, weight, minlength=n) - shared
    return np.where(every > 0, shared / np.maximum(every, 1e-9), 0.0)


def similarities(pairs: DataFrame, texts: DataFrame, sent: Broadcast) -> DataFrame:
    """a, b, similarity: exact weighted Jaccard of whole texts for each pair (a, b) of which ``anchor`` is one.

    Very many pairs may name one anchor: its text is repeated once per ``PAIRS_TOGETHER`` of its pairs, and no other text is.
    """
    other = F.when(F.col("anchor") == F.col("a"), F.col("b")).otherwise(F.col("a"))
    parts = written(pairs.groupBy("anchor").agg(F.ceil(F.count("*") / PAIRS_TOGETHER).alias("_parts")))
    dealt = pairs.withColumn("other", other).join(parts, "anchor").withColumn("_part", F.pmod(F.xxhash64("other"), F.col("_parts")))
    anchors = parts.join(texts.select(F.col("text_id").alias("anchor"), F.col("text").alias("text_a")), "anchor").select(
        "anchor", "text_a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)).alias("_part")
    )
    both = dealt.join(texts.select(F.col("text_id").alias("other"), F.col("text").alias("text_b")), "other").join(
        anchors, ["anchor", "_part"]
    ).select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for begin, end in slices([len(x) + len(y) for x, y in zip(left, right, strict=True)]):
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(begin, end - begin), batch.column(1).slice(begin, end - begin),
                    pa.array(_similarity(left[begin:end], right[begin:end], sent.value)),
                ], ["a", "b", "similarity"])

    return both.mapInArrow(run, "a long, b long, similarity double")


def _star(members: DataFrame, anchors: DataFrame, texts: DataFrame, sent: Broadcast) -> DataFrame:
    """Compare the members (key, text_id, class_id) of each bucket with its anchor (key, anchor, anchor_class), if of another class."""
    met = salted_join(members, anchors, ["key"], "text_id", SALTS).filter("class_id <> anchor_class")
    pairs = met.select(F.least("text_id", "anchor").alias("a"), F.greatest("text_id", "anchor").alias("b"), "anchor").dropDuplicates(["a", "b"])
    return written(similarities(pairs, texts, sent))


def _most_popular(members: DataFrame) -> DataFrame:
    """The anchor of each bucket: its member with the most company in all its buckets, then the smallest text_id."""
    best = members.groupBy("key").agg(F.max(F.struct("popularity", -F.col("text_id"), "class_id")).alias("top"))
    return best.select("key", (-F.col("top.col2")).alias("anchor"), F.col("top.class_id").alias("anchor_class"))


def _classes(members: DataFrame, roots: DataFrame) -> DataFrame:
    """``members`` with the classes known so far; ``roots`` names some texts of one class alike."""
    roots = roots.withColumnRenamed("node", "text_id")
    return written(members.drop("class_id").join(roots, "text_id", "left").withColumn(
        "class_id", F.coalesce("root", "text_id")
    ).drop("root"))


def _open(rows: DataFrame, least: float) -> DataFrame:
    """The rows (key, text_id, class_id, step) that may still have a link to another class of their bucket.

    ``step`` is the similarity to the anchor of the bucket in steps of ``STEP``. Distances (1 - similarity) obey the
    triangle inequality, so two texts whose similarities to a third differ by more than 1 - ``least`` have no link.
    """
    reach = int((1 - least) / STEP + 1e-6) + 1
    steps = rows.groupBy("key", "step").agg(F.min("class_id").alias("low"), F.max("class_id").alias("high"))
    # At most 1 / STEP + 1 entries per bucket.
    listed = steps.groupBy("key").agg(
        F.collect_list(F.struct("step", "low", "high")).alias("_steps"), F.min("low").alias("_low"), F.max("high").alias("_high")
    ).filter("_low < _high")
    near = F.filter("_steps", lambda s: F.exists("_steps", lambda t: (F.abs(t["step"] - s["step"]) <= reach) & (
        (t["low"] != s["low"]) | (t["high"] != s["low"])
    )))
    reached = listed.select("key", F.explode(near).alias("_s")).select("key", F.col("_s.step").alias("step"))
    return salted_join(rows, reached, ["key", "step"], "text_id", SALTS)


def _shared_weight(row: np.ndarray, key: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """Summed smaller weights of the shingles that two of n texts share, for all pairs."""
    order = np.lexsort((weight, key))
    row, key, weight = row[order], key[order], weight[order]
    # The smaller of two weights is the sum of the steps between a shingle's weights that both reach.
    fresh = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
    higher = fresh | np.concatenate([[True], weight[1:] != weight[:-1]])[:len(key)]
    level = np.cumsum(higher)
    rise = np.where(fresh, weight, weight - np.concatenate([[0.0], weight[:-1]])[:len(key)])[higher]
    lowest = level[fresh][np.cumsum(fresh) - 1] if len(key) else level
    depth = level - lowest + 1
    entry = np.repeat(np.arange(len(key)), depth)
    column = np.repeat(lowest, depth) + np.arange(len(entry)) - np.repeat(np.cumsum(depth) - depth, depth) - 1
    holders = np.bincount(column, minlength=len(rise))
    order = np.argsort(column, kind="stable")
    column, member = column[order], row[entry[order]]
    shared = np.zeros((n, n))
    light = holders[column] < HEAVY
    few, who = column[light], member[light]
    for shift in range(1, HEAVY - 1):
        same = np.flatnonzero(few[shift:] == few[:-shift])
        if not len(same):
            break
        shared += np.bincount(who[same] * n + who[same + shift], rise[few[same]], minlength=n * n).reshape(n, n)
    shared += shared.T
    many, who = column[~light], member[~light]
    heavy, place = np.unique(many, return_inverse=True)
    for begin in range(0, len(heavy), WIDE):
        part = slice(*np.searchsorted(place, [begin, begin + WIDE]))
        dense = np.zeros((n, min(WIDE, len(heavy) - begin)))
        dense[who[part], place[part] - begin] = 1
        shared += dense * rise[heavy[begin:begin + WIDE]] @ dense.T
    return shared


def connecting_links(ids: list[int], classes: list[int], blocks: list[int], texts: list[str], idf: WordWeights, least: float) -> list[tuple[int, int]]:
    """Links that connect what all links between different classes connect; where there are two blocks, between these only."""
    n = len(ids)
    row, key, weight = weighted_shingles(texts, idf)
    total = np.bincount(row, weight, minlength=n)
    shared = _shared_weight(row, key, weight, n)
    class_, block = np.array(classes), np.array(blocks)
    wanted = np.triu(class_[:, None] != class_[None], 1)
    if block.min() != block.max():
        wanted &= block[:, None] != block[None]
    # Rounding differs from that of a single pair, so pairs beside the limit are compared again by themselves.
    excess = shared - least * (total[:, None] + total[None] - shared)
    margin = 1e-9 * (total[:, None] + total[None])
    left, right = np.nonzero(wanted & (excess >= -margin))
    sure = excess[left, right] > margin[left, right]
    root = {c: c for c in classes}

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    links = []
    for x, y, known in zip(left.tolist(), right.tolist(), sure.tolist(), strict=True):
        p, q = find(classes[x]), find(classes[y])
        if p != q and (known or _similarity([texts[x]], [texts[y]], idf)[0] >= least):
            root[p] = q
            links.append((ids[x], ids[y]))
    return links


def _every_pair(rows: DataFrame, texts: DataFrame, sent: Broadcast, least: float) -> DataFrame:
    """Links a, b that connect all that similar pairs of different classes in the buckets of ``rows`` connect.

    A large bucket is dealt into blocks of about ``BLOCK`` texts or ``BLOCK_CHARS`` characters, and each two blocks meet
    in a task of their own. Pairs are compared there and do not become rows.
    """
    counted = rows.groupBy("key").agg(F.greatest(
        F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("chars") / BLOCK_CHARS), F.lit(1)
    ).alias("_parts"))
    placed = salted_join(rows, counted, ["key"], "text_id", SALTS).withColumn("block", F.pmod(F.xxhash64("text_id", "key"), "_parts"))
    met = placed.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1))).select(
        "key", "text_id", "class_id", "block", F.least("block", "_other").alias("one"), F.greatest("block", "_other").alias("two")
    )

    def run(group: pa.Table) -> pa.Table:
        columns = (group[c].to_pylist() for c in ("text_id", "class_id", "block", "text"))
        links = connecting_links(*columns, sent.value, least)
        return pa.table({"a": pa.array([min(p) for p in links], pa.int64()), "b": pa.array([max(p) for p in links], pa.int64())})

    return met.join(texts, "text_id").groupBy("key", "one", "two").applyInArrow(run, "a long, b long")


def near_duplicate_links(docs: DataFrame, least: float = SIMILAR) -> tuple[DataFrame, DataFrame]:
    """Which text each row has, and verified links that connect every class of different texts.

    The first result has one row (doc_id, digest, text_id) per document, the second a and b.
    """
    sent = docs.sparkSession.sparkContext.broadcast(word_frequencies(docs))
    signed = written(sampled(docs, sent))
    # Numbered as they are written, once.
    kinds = written(signed.groupBy("digest").agg(
        F.min("doc_id").alias("first_id"), F.first("bands").alias("bands"), F.first("chars").alias("chars")
    ).withColumn("text_id", F.monotonically_increasing_id()))
    texts_of = salted_join(signed.select("doc_id", "digest"), kinds.select("digest", "text_id"), ["digest"], "doc_id", SALTS)

    banded = kinds.filter("bands is not null").select("text_id", "chars", F.explode("bands").alias("key"))
    full = banded.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    shared = salted_join(banded, full, ["key"], "text_id", SALTS)
    popular = written(shared.groupBy("text_id").agg(F.sum("size").alias("popularity")))
    members = written(shared.join(popular, "text_id").select("key", "text_id", "chars", "popularity", F.col("text_id").alias("class_id")))
    # One row of the table for each text that is compared.
    wanted = kinds.join(popular.select("text_id"), "text_id", "left_semi").select("digest", "text_id", F.col("first_id").alias("_first"))
    own = docs.select(digest_of_text(), F.col("doc_id").cast("long").alias("_id"), "text")
    texts = written(own.join(wanted, "digest").filter(F.col("_id").eqNullSafe(F.col("_first"))).select("text_id", "text").dropDuplicates(["text_id"]))

    anchors = written(_most_popular(members))
    first = _star(members, anchors, texts, sent)
    links = first.filter(F.col("similarity") >= least).select("a", "b")
    # The anchor itself has met all others and leaves its bucket.
    beside = salted_join(members, anchors.select("key", "anchor"), ["key"], "text_id", SALTS).filter("text_id <> anchor").select(
        "*", F.least("text_id", "anchor").alias("a"), F.greatest("text_id", "anchor").alias("b")
    ).join(first, ["a", "b"]).withColumn("step", F.floor(F.col("similarity") / STEP)).drop("a", "b", "similarity")
    # A second anchor from outside the class of the first meets all that is left of its bucket and leaves, too.
    near = written(near_roots(links))
    left = written(_open(_classes(beside.drop("anchor"), near), least))
    main = anchors.select("key", "anchor").join(near.withColumnRenamed("node", "anchor"), "anchor", "left").select("key", F.coalesce("root", "anchor").alias("_main"))
    second = written(_most_popular(salted_join(left, main, ["key"], "text_id", SALTS).filter("class_id <> _main")))
    links = written(links.union(_star(left, second, texts, sent).filter(F.col("similarity") >= least).select("a", "b")))
    met = second.select("key", F.col("anchor").alias("text_id"))
    left = written(_open(_classes(left.join(met, ["key", "text_id"], "left_anti"), written(near_roots(links))), least))
    return texts_of.select("doc_id", "digest", "text_id"), links.union(written(_every_pair(left, texts, sent, least)))


def classed_rows(docs: DataFrame, least: float = SIMILAR) -> DataFrame:
    """doc_id, digest and ``group``, the same number for all rows of a class."""
    texts_of, links = near_duplicate_links(docs, least)
    roots = components(links)
    named = salted_join(texts_of, roots.withColumnRenamed("node", "text_id"), ["text_id"], "doc_id", SALTS, "left")
    return written(named.select("doc_id", "digest", F.coalesce("root", "text_id").alias("group")))


def near_duplicate_classes(docs: DataFrame, least: float = SIMILAR) -> DataFrame:
    """One row per document: doc_id and class_id, the smallest doc_id among all documents linked to it, also by way of others."""
    rows = classed_rows(docs, least)
    names = rows.groupBy("group").agg(F.min("doc_id").alias("class_id"))
    return salted_join(rows, names, ["group"], "doc_id", SALTS).select("doc_id", "class_id")


def without_near_duplicates(docs: DataFrame, least: float = SIMILAR) -> DataFrame:
    """One row of each class: the one with the smallest doc_id."""
    different = classed_rows(docs, least).groupBy("group", "doc_id", "digest").agg(F.count("*").alias("n"))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest")
    best = different.groupBy("group").agg(F.min(place).alias("best"))
    judged = written(salted_join(different, best, ["group"], "doc_id", SALTS).withColumn("stays", F.col("best") == place))

    def met(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        same = rows["doc_id"].cast("long").eqNullSafe(keys["doc_id"]) & (F.md5(F.coalesce(rows["text"], F.lit(""))) == keys["hex_digest"])
        return rows.join(keys, same, how)

    def named(rows: DataFrame) -> DataFrame:
        return rows.select("doc_id", F.lower(F.hex("digest")).alias("hex_digest"))

    kept = met(docs, named(judged.filter("not stays")), "left_anti")
    repeated = named(judged.filter("stays and n > 1"))
    if not repeated.isEmpty():
        digest = next(name for k in range(len(docs.columns) + 1) if (name := f"_digest{k}") not in docs.columns)
        once = met(kept, repeated, "left_semi").withColumn(digest, F.md5(whole_text())).dropDuplicates(["doc_id", digest])
        kept = met(kept, repeated, "left_anti").unionByName(once.drop(digest))
    return kept.select(*docs.columns)
