"""Tokens per document, huge documents in overlapping chunks that are spliced where they agree for certain.

Texts up to a chunk and an overlap long are encoded whole. A longer one is cut into chunks of ``chunk``
characters, each with the first ``overlap`` characters of the next, which are encoded with offsets in tasks of
their own. A chunk begins anywhere, so its first tokens may be wrong, and its last ones may be cut short.

What makes a boundary safe: a byte-level tokenizer first splits a text from left to right by a pattern and by
its special strings, and merges within the pieces only. Where a piece begins, all that follows depends on the
text from there on. So if a piece begins at the same place in two neighbouring chunks, and the left chunk is
right up to there, the right one is right from there on. The left chunk's pieces are those of the whole text up
to a margin before its end, in which a special string or a contraction could be cut. The first chunk begins
with the text, and so on from chunk to chunk. A token boundary alone is no such place, as merges within a
piece depend on all of it.

Where two neighbours have no such place in their overlap (a piece longer than the overlap), the overlap is widened
to the whole next chunk: both are encoded again as one, together with all neighbours for which the same
holds, until every seam is spliced or the text is whole. Counts are then added up over the seams; no task sees
more than one run of joined chunks.

The proof needs a byte-level pattern tokenizer. With any other one (``cuts_safely``) every text is encoded whole.

Edge cases: a NULL or empty text has no tokens; special strings inside texts are what the library makes of
them by default; rows sharing a doc_id and rows without one are counted one by one; a huge text that
occurs often is counted once; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from perkwell.llm.common import salted_join, whole_text
from perkwell.llm.textbytes import slices
from perkwell.sources.checkpoints import cut

CHUNK = 1 << 16
OVERLAP = 1 << 9
LIMIT = 512
SALTS = 32
# Characters encoded in one call.
CALL_CHARS = 1 << 18
# Characters of the longest contraction in the pattern; more than a run of blanks looks ahead.
PATTERN_CHARS = 3


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer, processors

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    if cuts_safely(path):
        # Offsets with the blank in front of a word; the tokens stay the same.
        tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)
    return tokenizer


@lru_cache(maxsize=4)
def _pieces(path: str):
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=path)


def counts(texts: list[str], path: str) -> list[int]:
    """Tokens of each text, equal texts encoded once."""
    different = list(dict.fromkeys(texts))
    if path.endswith(".model"):
        sizes = [len(ids) for ids in _pieces(path).encode(different, num_threads=1)]
    else:
        sizes = [len(e) for e in _tokenizer(path).encode_batch_fast(different, add_special_tokens=False)]
    size = dict(zip(different, sizes, strict=True))
    return [size[t] for t in texts]


@lru_cache(maxsize=4)
def _settings(path: str) -> dict:
    if path.endswith(".model"):
        return {}
    with open(path, encoding="utf-8") as file:
        read = json.load(file)
    return {k: v for k, v in read.items() if k != "model"} | {"model": {k: v for k, v in read["model"].items() if k not in ("vocab", "merges")}}


def cuts_safely(path: str) -> bool:
    """Whether what follows the beginning of a piece depends on nothing before it."""
    s = _settings(path)
    split = s.get("pre_tokenizer") or {}
    return (
        split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space", True)
        and s.get("normalizer") is None and s["model"].get("type") == "BPE" and not s["model"].get("dropout")
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in s.get("added_tokens", []))
    )


def margin(path: str) -> int:
    """Characters before the end of a chunk in which pieces may be cut."""
    return max([len(t["content"]) for t in _settings(path).get("added_tokens", [])], default=0) + PATTERN_CHARS


# ---- chunks ----------------------------------------------------------------------------


def n_chunks(chars: int, chunk: int, overlap: int) -> int:
    """The last chunk is longer than the overlap and takes what remains."""
    return max(1, -((overlap - chars) // chunk))


def chunks(huge: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """digest, chunk number, whether it is the last, its text and the beginning of the next one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for digest, text in zip(batch.column(0), batch.column(1), strict=True):
                digest, text = digest.as_py(), text.as_py()
                n = n_chunks(len(text), chunk, overlap)
                for k in range(n):
                    last = k == n - 1
                    begin, end = k * chunk, len(text) if last else (k + 1) * chunk
                    yield pa.RecordBatch.from_pydict({
                        "digest": [digest], "k": pa.array([k], pa.int32()), "is_last": [last], "own": [text[begin:end]], "over": [text[end:end + overlap]],
                    })

    # Brings equal chunks of equal texts together and deals those of one text over all tasks.
    return huge.mapInArrow(run, "digest binary, k int, is_last boolean, own string, over string").dropDuplicates(["digest", "k"])


_ENDS = "array<struct<at:long,before:long>>"


def starts_of_pieces(text: str, path: str) -> tuple[list[tuple[int, int]], int]:
    """Where each piece begins with the tokens before it, and the number of tokens."""
    encoded = _tokenizer(path).encode(text, add_special_tokens=False)
    out, piece = [], None
    for k, (word, (begin, _)) in enumerate(zip(encoded.word_ids, encoded.offsets, strict=True)):
        if word != piece:
            out.append((begin, k))
            piece = word
    return out, len(encoded)


def encoded_runs(runs: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """Tokens of each run of chunks, and its safe beginnings of pieces in the overlaps with its neighbours."""
    spare = margin(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                begin = row["first"] * chunk
                places, n = starts_of_pieces(row["text"], path)
                end, seam = begin + len(row["text"]), (row["last"] + 1) * chunk
                head = [(begin + p, k) for p, k in places if p < overlap]
                tail = [] if row["is_last"] else [(begin + p, k) for p, k in places if seam <= begin + p <= end - spare]
                yield pa.RecordBatch.from_pylist([{
                    "digest": row["digest"], "first": row["first"], "last": row["last"], "is_last": row["is_last"], "tokens": n,
                    "head": [{"at": p, "before": k} for p, k in head], "tail": [{"at": p, "before": k} for p, k in tail],
                }], schema=schema)

    ends = pa.list_(pa.struct([("at", pa.int64()), ("before", pa.int64())]))
    schema = pa.schema([("digest", pa.binary()), ("first", pa.int32()), ("last", pa.int32()), ("is_last", pa.bool_()), ("tokens", pa.int64()), ("head", ends), ("tail", ends)])
    return runs.select("digest", "first", "last", "is_last", "text").mapInArrow(
        run, f"digest binary, first int, last int, is_last boolean, tokens long, head {_ENDS}, tail {_ENDS}"
    )


def seams(results: DataFrame) -> DataFrame:
    """digest, ``first`` of the right run, and how many tokens the left one counts beyond what the right one does up to their splice.

    ``surplus`` is NULL where no piece begins at the same place in both.
    """
    left = results.filter(~F.col("is_last")).select("digest", (F.col("last") + 1).alias("first"), "tail")
    both = left.join(results.select("digest", "first", "head"), ["digest", "first"])
    at = F.array_min(F.array_intersect(F.transform("tail", lambda x: x["at"]), F.transform("head", lambda x: x["at"])))

    def before(side: str):
        return F.get(F.filter(side, lambda x: x["at"] == F.col("_at")), F.lit(0))["before"]

    return both.withColumn("_at", at).select("digest", "first", (before("tail") - before("head")).alias("surplus"))


def joined_runs(results: DataFrame, found: DataFrame) -> DataFrame:
    """Which results to replace: digest, first and last chunk of each new run, and ``was``, the first chunk of each run in it.

    A text has at most 2^31 bytes, so the window holds at most 2^31 / CHUNK narrow rows.
    """
    broken = found.filter("surplus is null").select("digest", "first", F.lit(True).alias("_open"))
    order = Window.partitionBy("digest").orderBy("first")
    marked = results.select("digest", "first", "last").join(broken.select("digest").distinct(), "digest", "left_semi").join(
        broken, ["digest", "first"], "left"
    ).withColumn("_run", F.sum(F.when(F.col("_open"), 0).otherwise(1)).over(order))
    return marked.groupBy("digest", "_run").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.collect_list("first").alias("was")
    ).filter(F.size("was") > 1).drop("_run")


def huge_counts(huge: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """digest and tokens of the texts in ``huge`` (digest, text)."""
    parts = cut(chunks(huge, chunk, overlap))
    whole = F.concat("own", "over")
    results = cut(encoded_runs(parts.select("digest", F.col("k").alias("first"), F.col("k").alias("last"), "is_last", whole.alias("text")), path, chunk, overlap))
    while True:
        found = cut(seams(results))
        if found.filter("surplus is null").isEmpty():
            break
        joined = cut(joined_runs(results, found))
        wanted = joined.select("digest", "first", "last", F.explode(F.sequence("first", "last")).alias("k"))
        texts = wanted.join(parts, ["digest", "k"]).groupBy("digest", "first", "last").agg(
            F.array_sort(F.collect_list(F.struct("k", "own"))).alias("_own"), F.max_by("over", "k").alias("_over"), F.max("is_last").alias("is_last")
        ).withColumn("text", F.concat(F.concat_ws("", F.transform("_own", lambda x: x["own"])), "_over"))
        replaced = joined.select("digest", F.explode("was").alias("first"))
        results = cut(results.join(replaced, ["digest", "first"], "left_anti").union(encoded_runs(texts, path, chunk, overlap)))
    ends = results.filter("is_last").select("digest", "tokens")
    return ends.union(found.select("digest", F.col("surplus").alias("tokens"))).groupBy("digest").agg(F.sum("tokens").alias("n_tokens"))


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, bytes, tokens, and whether these are more than ``limit``. All executors must be able to read ``path``."""
    assert 0 < overlap <= chunk
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    is_huge = (F.char_length("text") > chunk + overlap) if cuts_safely(path) else F.lit(False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(2).to_pylist()
            for begin, end in slices([len(t) for t in rows], CALL_CHARS):
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(begin, end - begin), batch.column(1).slice(begin, end - begin), pa.array(counts(rows[begin:end], path), pa.int64()),
                ], ["doc_id", "n_bytes", "n_tokens"])

    size = F.octet_length("text").cast("long").alias("n_bytes")
    short = texts.filter(~is_huge).select("doc_id", size, "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    if cuts_safely(path):
        digest = F.unhex(F.sha2("text", 256)).alias("digest")
        huge = texts.filter(is_huge)
        told = huge_counts(huge.select(digest, "text"), path, chunk, overlap)
        short = short.union(salted_join(huge.select("doc_id", size, digest), told, ["digest"], "doc_id", SALTS, "left").select("doc_id", "n_bytes", "n_tokens"))
    return short.withColumn("over_limit", F.col("n_tokens") > limit)
