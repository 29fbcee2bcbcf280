"""Word and byte hashing over whole batches of texts with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BATCH_BYTES = 1 << 21
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_WORD_BASE = np.uint64(0x100000001B3)

# 1 for bytes that belong to a word: letters, digits and all bytes of non-ASCII characters.
WORD_BYTE = np.zeros(256, dtype=bool)
WORD_BYTE[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(128, 256)]] = True


def slices(sizes: list[int], most: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``most`` bytes, so that memory does not depend on the batch."""
    begin, total = 0, 0
    for k, size in enumerate(sizes):
        total += size
        if total >= most:
            yield begin, k + 1
            begin, total = k + 1, 0
    if begin < len(sizes):
        yield begin, len(sizes)


def text_batches(column: pa.Array) -> Iterator[tuple[int, int, list[str | None]]]:
    """First row, end and texts of each run of rows."""
    texts = column.to_pylist()
    for begin, end in slices([len(t or "") for t in texts]):
        yield begin, end, texts[begin:end]


def mixed(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that all bits depend on all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of a batch, and the number of words before each text.

    ``data`` holds the UTF-8 bytes of lower-cased texts one after the other, and
    ``starts`` where each begins, with the end of the last. The second array has the
    length of ``starts``, so text ``k`` has the words from its k-th to its (k+1)-th entry.
    """
    inside = WORD_BYTE[data]
    # A word also ends where its text does.
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = starts[:-1][starts[:-1] < len(data)]
    begins[edges] = inside[edges]
    at = np.flatnonzero(begins)
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(len(starts), np.int64)
    # A polynomial in the bytes, evaluated for all words at once, one byte position after the other.
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    last = starts[1:] - 1
    last = last[(last >= 0) & (starts[1:] > starts[:-1])]
    ends[last] = inside[last]
    length = np.flatnonzero(ends) + 1 - at
    longest = length.max()
    order = np.argsort((longest - length).astype(np.uint16 if longest < 1 << 16 else np.int64), kind="stable")
    at_, length_ = at[order], length[order]
    value = np.zeros(len(at), np.uint64)
    alive = np.searchsorted(-length_, -np.arange(longest), side="left")
    for k in range(int(longest)):
        n = int(alive[k])
        value[:n] = (value[:n] + data[at_[:n] + k] + np.uint64(1)) * _WORD_BASE
    hashes = np.empty(len(at), np.uint64)
    hashes[order] = mixed(value)
    return hashes, np.searchsorted(at, starts, side="left")


def packed(texts: list[str | None], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in one array, and where each begins, with the end of the last."""
    raw = [(t or "").lower().encode("utf-8", "surrogatepass") if lower else (t or "").encode("utf-8", "surrogatepass") for t in texts]
    starts = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(r) for r in raw], out=starts[1:])
    return np.frombuffer(b"".join(raw), np.uint8), starts


def shingle_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` words; entry ``i`` is the run that begins at word ``i``."""
    count = max(len(hashes) - n + 1, 0)
    value = np.zeros(count, np.uint64)
    for k in range(n):
        value = value * _MULTIPLIER + hashes[k:k + count]
    return mixed(value)
