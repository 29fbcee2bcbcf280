"""Fill-in-the-middle examples, cut at unit ends that are found eight bytes at a time.

A unit is a run of ASCII letters or any other single character. The UTF-8 bytes of a text are viewed as
64-bit words. Plain arithmetic on a word marks those of its eight bytes that end a unit, ``bitwise_count``
says how many there are, and the running sum over the words is searched for the word in which the unit
with a wanted number ends. Which of its bytes that is follows from the running counts within the word, a
multiplication. No text is split into units.

Where a text is cut depends on its doc_id alone: the SHA-256 of ``seed:doc_id`` gives both cuts and the form.
The prefix ends after the smaller and the middle after the larger cut. The form is ``plain`` (the text as it
is) for an empty text, one that holds a mark, and a share of the rest; otherwise suffix, prefix, middle
(``spm``) or prefix, suffix, middle (``psm``), each part behind its mark.

Edge cases: a NULL text counts as empty and gives ``plain``; a row without doc_id is cut as if its id were the
empty string; rows sharing a doc_id are cut alike where their texts are equal; a text of any length is cut
in one piece and needs a few times its own size; bytes that are no valid UTF-8 are carried through unchanged; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from perkwell.llm.textbytes import slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"

_ONES = np.uint64(0x0101010101010101)
_HIGH = np.uint64(0x8080808080808080)
_LOW = ~_HIGH
_BLANK = np.uint64(0x2020202020202020)
_FROM_A = np.uint64(0x80 - ord("a")) * _ONES
_PAST_Z = np.uint64(0x80 - ord("z") - 1) * _ONES
_BYTE = np.uint64(8)


@dataclass(frozen=True)
class Share:
    """Which hash decides, and how many of a hundred texts stay plain or take the suffix first."""

    seed: str = "1"
    plain_from: int = 90
    suffix_first_below: int = 20


# ---- words of eight bytes -------------------------------------------------------------


def as_words(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts as little-endian words, each padded with zeros, and the first word of each text with the end of the last."""
    bounds = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([(len(r) + 7) // 8 for r in raw], out=bounds[1:])
    return np.frombuffer(b"".join(r + bytes(-len(r) % 8) for r in raw), "<u8"), bounds


def _following(marks: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The marks of the byte behind each byte; nothing stands behind the last word of a text."""
    carried = np.zeros_like(marks)
    carried[:-1] = marks[1:] << np.uint64(56)
    carried[last] = 0
    return marks >> _BYTE | carried


def continuations(words: np.ndarray) -> np.ndarray:
    """The top bit of every byte that goes on with a character."""
    return words & ~(words << np.uint64(1)) & _HIGH


def letters(words: np.ndarray) -> np.ndarray:
    """The top bit of every byte that is an ASCII letter."""
    # Adding to seven bits cannot reach the next byte.
    folded = (words | _BLANK) & _LOW
    return (folded + _FROM_A) & ~(folded + _PAST_Z) & ~words & _HIGH


def unit_ends(words: np.ndarray, bounds: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The top bit of every byte that ends a unit."""
    filled = bounds[1:] > bounds[:-1]
    last = bounds[1:][filled] - 1
    letter = letters(words)
    ends = ~_following(continuations(words), last) & ~(letter & _following(letter, last)) & _HIGH
    # Padding ends nothing.
    spare = (-sizes[filled] % 8).astype(np.uint64) * _BYTE
    ends[last] &= ~np.uint64(0) >> spare
    return ends


def nth_mark(marks: np.ndarray, running: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The byte at which mark number ``wanted`` (from 1, over all words) stands; ``running`` counts marks up to each word."""
    word = np.searchsorted(running, wanted, side="left")
    rank = wanted - np.where(word > 0, running[word - 1], 0)
    # Byte j of the product holds the marks in bytes 0 to j.
    inside = (marks[word] >> np.uint64(7)) * _ONES
    reached = ((inside | _HIGH) - rank.astype(np.uint64) * _ONES) & _HIGH
    return word * 8 + 8 - np.bitwise_count(reached)


def unit_cuts(raw: list[bytes], choose) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of units of each text, and the byte offsets of its two cuts.

    ``choose`` takes the numbers of units and gives the units before the first and before the second cut.
    """
    words, bounds = as_words(raw)
    sizes = np.array([len(r) for r in raw], np.int64)
    ends = unit_ends(words, bounds, sizes)
    running = np.cumsum(np.bitwise_count(ends), dtype=np.int64)
    before = np.concatenate([[0], running])[bounds]
    units = np.diff(before)
    cuts = []
    for chosen in choose(units):
        at = np.zeros(len(raw), np.int64)
        some = np.flatnonzero(chosen > 0)
        at[some] = nth_mark(ends, running, before[some] + chosen[some]) + 1 - bounds[some] * 8
        cuts.append(at)
    return units, cuts[0], cuts[1]


# ---- texts ----------------------------------------------------------------------------


def _draws(ids: list[int | None], seed: str) -> np.ndarray:
    """Four 32-bit numbers per row."""
    hashed = b"".join(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16] for i in ids)
    return np.frombuffer(hashed, ">u4").astype(np.int64).reshape(-1, 4)


def _characters(raw: bytes) -> int:
    words, _ = as_words([raw])
    return len(raw) - int(np.bitwise_count(continuations(words)).sum())


def _bytes_of(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def _examples(ids: list[int | None], raw: list[bytes], share: Share) -> pa.RecordBatch:
    draws = _draws(ids, share.seed)

    def choose(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first, second = draws[:, 0] % (units + 1), draws[:, 1] % (units + 1)
        return np.minimum(first, second), np.maximum(first, second)

    units, one, two = unit_cuts(raw, choose)
    p, s, m = (mark.encode() for mark in (PREFIX, SUFFIX, MIDDLE))
    forms, before, between, outputs = [], [], [], []
    for text, a, b, (_, _, stay, order) in zip(raw, one.tolist(), two.tolist(), draws.tolist(), strict=True):
        prefix, middle, suffix = text[:a], text[a:b], text[b:]
        if not text or p in text or s in text or m in text or stay % 100 >= share.plain_from:
            forms.append("plain")
            outputs.append(text)
            before.append(None)
            between.append(None)
            continue
        first = order % 100 < share.suffix_first_below
        forms.append("spm" if first else "psm")
        outputs.append(b"".join([s, suffix, p, prefix, m, middle] if first else [p, prefix, s, suffix, m, middle]))
        before.append(_characters(prefix))
        between.append(_characters(middle))
    ends = np.zeros(len(outputs) + 1, np.int64)
    np.cumsum([len(o) for o in outputs], out=ends[1:])
    # Built from its parts, which copies bytes as they are.
    output = pa.LargeStringArray.from_buffers(len(outputs), pa.py_buffer(ends), pa.py_buffer(b"".join(outputs)))
    return pa.RecordBatch.from_arrays([
        pa.array(ids, pa.int64()), pa.array(units), pa.array(forms), pa.array(before, pa.int64()), pa.array(between, pa.int64()), output.cast(pa.string(), safe=False),
    ], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def fill_in_middle(docs: DataFrame, share: Share = Share()) -> DataFrame:
    """doc_id, units, form, characters of prefix and middle (NULL if plain) and the example's text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, raw = batch.column(0).to_pylist(), _bytes_of(batch.column(1))
            for begin, end in slices([len(r) for r in raw]):
                yield _examples(ids[begin:end], raw[begin:end], share)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCHEMA)


def restored(output: Column, form: Column) -> Column:
    """The text that an example was made of.

    The text holds no mark, and none can arise where a part meets a mark, so the first of each is the mark.
    """
    def behind(text: Column, mark: str) -> Column:
        return F.substr(text, F.instr(text, F.lit(mark)) + len(mark))

    def ahead(text: Column, mark: str) -> Column:
        return F.substr(text, F.lit(1), F.instr(text, F.lit(mark)) - 1)

    psm = F.concat(ahead(behind(output, PREFIX), SUFFIX), behind(output, MIDDLE), ahead(behind(output, SUFFIX), MIDDLE))
    spm = F.concat(ahead(behind(output, PREFIX), MIDDLE), behind(output, MIDDLE), ahead(behind(output, SUFFIX), PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
