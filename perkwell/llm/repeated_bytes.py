"""Byte strings of a least length that an earlier document also has, removed exactly.

Every ``LENGTH``-byte string falls to the smallest hash of its ``SEED``-byte pieces
(its minimizer), wherever it occurs. Neighbouring strings with one minimizer make a
segment. Only segments whose minimizer occurs in several documents can share a
string, and all segments of one minimizer meet in one bucket. There the
Burrows-Wheeler transform of the different segments is extended backwards breadth
first: the intervals of all words of length 0, 1, 2, ... mark where neighbouring
suffixes agree in no more than that many bytes, and the expansion stops at
``LENGTH``. What is left unmarked between two suffixes agrees in at least ``LENGTH``
bytes, so unmarked runs are the classes of equal strings, exactly, and each class
knows its smallest document.

Documents are packed into parts of about ``PART_BYTES``; a part names each
minimizer and each segment once, however many of its documents hold it, so a passage
that a third of all documents share costs a bucket one entry per part. Numbers of
parts and buckets follow the amount of text; from ``LEAST_BUCKETS`` on there are fewer of them, larger ones, as
each part writes to each bucket and what a row costs besides its bytes grows with parts times buckets. A bucket
is therefore transformed in portions of whole minimizers. A minimizer with very many segments is
divided by a second minimizer of each string, taken in another order of the hashes, so the
many surroundings of a frequent piece spread over buckets. Where a minimizer has a single different segment, all
its strings are that segment's, and no transform is needed.

Edge cases: NULL counts as empty; texts shorter than ``LENGTH`` lose nothing; bytes
are those of UTF-8, so a character may be cut; rows without doc_id (and those with the largest long) are later than
all others and never compared with each other, nor are rows with one doc_id;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import itertools
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from perkwell.llm.textbytes import mixed, slices

LENGTH = 50
SEED = 16
PART_BYTES = 1 << 23
# Texts that are hashed at a time: what is made of them stays in the processor's cache.
SLICE_BYTES = 1 << 18
# With few parts, so that there are buckets for all tasks; of more than LEAST_BUCKETS so many make one.
BUCKETS_PER_PART = 4
LEAST_BUCKETS = 256
BUCKETS_TOGETHER = 8
# Bytes of different segments that are transformed at a time, about.
PORTION_BYTES = 1 << 18
# A minimizer with more segments than about this is divided; a power of two.
HOT_SEGMENTS = 1 << 12
# Where a part has a minimizer so often, its different segments are counted.
FREQUENT = 64
# Low bits of a minimizer that tell, in a note, how often a part has it (a power of two) and whether several documents do.
COUNT_BITS = 6
NO_ID = np.iinfo(np.int64).max
SEPARATOR = 0xFF  # no byte of UTF-8
_FACTOR = 0x9E3779B97F4A7C15
_SECOND = np.uint64(0xD6E8FEB86659FD93)
_NOTES = "part long, kind int, bucket long, payload binary"


# ---- segments ------------------------------------------------------------------------


def _seed_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``SEED`` bytes from each position, by doubling the hashed length."""
    value, width, factor = data.astype(np.uint64), 1, _FACTOR
    while width < SEED:
        doubled = value[:-width] * np.uint64(factor)
        doubled += value[width:]
        value, width, factor = doubled, width * 2, factor * factor & 0xFFFFFFFFFFFFFFFF
    # The low bits stay free for notes.
    return mixed(value) | np.uint64((1 << COUNT_BITS) - 1)


def _least_of(value: np.ndarray, window: int) -> np.ndarray:
    """Minimum of each ``window`` neighbouring entries."""
    width = 1
    while width * 2 <= window:
        value, width = np.minimum(value[:-width], value[width:]), width * 2
    return np.minimum(value[:len(value) - (window - width)], value[window - width:]) if width < window else value


def segments(texts: list[bytes]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of texts: their joined bytes, document, start, end and minimizer of each segment, and the hashes of all seeds.

    Documents are numbered from 0 over all texts; start and end count within the joined bytes.
    """
    for first, last in slices([len(t) for t in texts], SLICE_BYTES):
        joined = b"".join(texts[first:last])
        if len(joined) < LENGTH:
            continue
        seeds = _seed_hashes(np.frombuffer(joined, np.uint8))
        least = _least_of(seeds, LENGTH - SEED + 1)
        sizes = np.array([len(t) for t in texts[first:last]])
        ends = np.cumsum(sizes)
        counts = np.maximum(sizes - LENGTH + 1, 0)
        # The strings that lie within one document.
        doc = np.repeat(np.arange(len(sizes)), counts)
        at = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(ends - sizes, counts)
        value = least[at]
        begins = np.flatnonzero(np.concatenate([[True], (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])])) if len(at) else at
        if len(begins):
            stop = np.concatenate([begins[1:], [len(at)]]) - 1
            start, end = at[begins], at[stop] + LENGTH
            yield joined, doc[begins] + first, start, end, value[begins], seeds


def buckets_of(parts: int) -> int:
    buckets = parts * BUCKETS_PER_PART
    return max(min(buckets, LEAST_BUCKETS), buckets // BUCKETS_TOGETHER)


def _bucket(group: np.ndarray, buckets: int) -> np.ndarray:
    return (mixed(group) % np.uint64(buckets)).astype(np.int64)


def _divided(joined: bytes, doc: np.ndarray, start: np.ndarray, end: np.ndarray, group: np.ndarray):
    """Segments cut where the second minimizer of their strings changes, which becomes part of their group."""
    sizes = end - start
    begin = np.cumsum(sizes) - sizes
    # Only the bytes of these segments are hashed again; what lies across two of them is not looked at.
    own = np.frombuffer(joined, np.uint8)[np.arange(sizes.sum()) - np.repeat(begin - start, sizes)]
    second = _least_of(mixed(_seed_hashes(own) ^ _SECOND), LENGTH - SEED + 1)
    strings = sizes - LENGTH + 1
    owner = np.repeat(np.arange(len(start)), strings)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(strings) - strings, strings)
    value = second[begin[owner] + offset]
    first = np.flatnonzero(np.concatenate([[True], (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])]))
    last = np.concatenate([first[1:], [len(owner)]]) - 1
    whose = owner[first]
    return doc[whose], start[whose] + offset[first], start[whose] + offset[last] + LENGTH, mixed(group[whose] ^ value[first])


def _rows(part: list[int], kind: int, bucket: list[int], payload: list[bytes]) -> pa.Table:
    return pa.table({
        "part": pa.array(part, pa.int64()), "kind": pa.array([kind] * len(part), pa.int32()),
        "bucket": pa.array(bucket, pa.int64()), "payload": pa.array(payload, pa.binary()),
    })


def _texts(table: pa.Table) -> tuple[list[bytes], np.ndarray]:
    """Bytes and ids of the documents of a part, in an order that does not depend on how they arrived."""
    ids = table.column("doc_id").fill_null(NO_ID).to_numpy()
    texts = table.column("text").fill_null(b"").to_pylist()
    nameless = table.column("doc_id").is_null().to_pylist()
    order = sorted(range(len(texts)), key=lambda k: (ids[k], nameless[k], texts[k]))
    return [texts[k] for k in order], ids[order]


# ---- which minimizers occur in several documents -------------------------------------


def _minimizers(buckets: int):
    def run(table: pa.Table) -> pa.Table:
        texts, ids = _texts(table)
        values, docs, outer = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for _, doc, start, end, value, seeds in segments(texts):
            values.append(value)
            docs.append(ids[doc])
            # Segments that begin and end alike are counted as one; the count only decides what is divided.
            outer.append(seeds[start] * np.uint64(_FACTOR) + seeds[end - SEED])
        value, doc, ends = np.concatenate(values), np.concatenate(docs), np.concatenate(outer)
        order = np.argsort(value, kind="stable")
        value, doc, ends = value[order], doc[order], ends[order]
        first = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]])) if len(value) else np.zeros(0, np.int64)
        several = np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first) if len(first) else np.zeros(0, bool)
        # The low bits tell how many segments the part has of it, as a power of two, and whether more than one document does.
        often = np.diff(np.concatenate([first, [len(value)]]))
        for k in np.flatnonzero(often >= FREQUENT):
            often[k] = len(np.unique(ends[first[k]:first[k] + often[k]]))
        power = np.minimum(np.log2(np.maximum(often, 1)).astype(np.uint64), np.uint64((1 << COUNT_BITS - 1) - 1))
        once = value[first] >> np.uint64(COUNT_BITS) << np.uint64(COUNT_BITS) | power << np.uint64(1) | several.astype(np.uint64)
        bucket = _bucket(value[first], buckets)
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
        filled = [b for b in range(buckets) if edges[b] < edges[b + 1]]
        part = table.column("part")[0].as_py()
        return _rows([part] * len(filled), 0, filled, [np.sort(once[order[edges[b]:edges[b + 1]]]).tobytes() for b in filled])

    return run


def _shared(hot_segments: int):
    def run(table: pa.Table) -> pa.Table:
        """Tell each part which of its minimizers some other document has too; the lowest bit marks those to divide."""
        parts = table.column("part").to_pylist()
        lists = [np.frombuffer(p, np.uint64) for p in table.column("payload").to_pylist()]
        value = np.concatenate(lists)
        owner = np.repeat(np.arange(len(parts)), [len(x) for x in lists])
        order = np.argsort(value, kind="stable")
        plain = value[order] >> np.uint64(COUNT_BITS)
        same = plain[1:] == plain[:-1]
        shared = (value[order] & np.uint64(1)).astype(bool)
        shared[1:] |= same
        shared[:-1] |= same
        first = np.flatnonzero(np.concatenate([[True], ~same]))
        often = np.add.reduceat(np.uint64(1) << (value[order] >> np.uint64(1) & np.uint64((1 << COUNT_BITS - 1) - 1)), first)
        hot = np.repeat(often > hot_segments, np.diff(np.concatenate([first, [len(value)]])))
        mine, told = np.zeros(len(value), bool), np.zeros(len(value), np.uint64)
        mine[order], told[order] = shared, plain << np.uint64(COUNT_BITS) | hot.astype(np.uint64)
        edges = np.cumsum([0, *map(len, lists)])
        found = [told[a:b][mine[a:b]] for a, b in itertools.pairwise(edges.tolist())]
        keep = [k for k, x in enumerate(found) if len(x)]
        bucket = table.column("bucket")[0].as_py()
        return _rows([parts[k] for k in keep], 0, [bucket] * len(keep), [found[k].tobytes() for k in keep])

    return run


# ---- equal strings of a bucket -------------------------------------------------------


def _numbered(pieces: list[bytes], known: dict[bytes, int], seen: int) -> np.ndarray:
    """For each piece the number of its first occurrence; ``seen`` pieces were numbered before."""
    return np.fromiter(map(known.setdefault, pieces, itertools.count(seen)), np.int64, len(pieces))


def _dense(known: dict[bytes, int], numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the first occurrence of each different piece, and which of them each piece is."""
    firsts = np.fromiter(known.values(), np.int64, len(known))
    which = np.empty(len(numbers), np.int64)
    which[firsts] = np.arange(len(firsts))
    return firsts, which[numbers]


def _joint(arrays: list[np.ndarray], kind: type) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *arrays])


def _known_segments(texts: list[bytes], ids: np.ndarray, notes: pa.Table, buckets: int):
    """The different shared segments of a part by bucket, and where they occur.

    Gives the segments, and the bucket, the smallest document and the tag of the group of each,
    and per run of texts the document, start and number arrays of its segments.
    """
    lists = [np.frombuffer(p, np.uint64) for k, p in zip(notes.column("kind").to_pylist(), notes.column("payload").to_pylist(), strict=True) if k == 0]
    told = np.sort(np.concatenate(lists)) if lists else np.zeros(0, np.uint64)
    shared, hot = told >> np.uint64(COUNT_BITS), (told & np.uint64(1)).astype(bool)
    # Equal segments have one group, so they can be told apart over all buckets at once.
    known: dict[bytes, int] = {}
    places, groups, numbers, seen = [], [], [], 0
    for joined, doc, start, end, value, _ in segments(texts) if len(shared) else ():
        plain = value >> np.uint64(COUNT_BITS)
        at = np.minimum(np.searchsorted(shared, plain), len(shared) - 1)
        hit = shared[at] == plain
        divide = hit & hot[at]
        usual = hit & ~divide
        cut = _divided(joined, *(x[divide] for x in (doc, start, end, plain))) if divide.any() else None
        doc, start, end, group = (x[usual] for x in (doc, start, end, plain))
        if cut:
            doc, start, end, group = (np.concatenate(x) for x in zip((doc, start, end, group), cut, strict=True))
        pieces = [joined[s:e] for s, e in zip(start.tolist(), end.tolist(), strict=True)]
        numbers.append(_numbered(pieces, known, seen))
        groups.append(group)
        places.append((doc, start))
        seen += len(pieces)
    firsts, number = _dense(known, _joint(numbers, np.int64))
    group = _joint(groups, np.uint64)[firsts]
    least = np.full(len(firsts), NO_ID)
    np.minimum.at(least, number, ids[_joint([doc for doc, _ in places], np.int64)])
    bucket = _bucket(group, buckets)
    order = np.argsort(bucket, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    tag = (mixed(group) >> np.uint64(32)).astype(np.uint32)
    segment = list(known)
    ends = np.cumsum([0, *map(len, numbers)]).tolist()
    number = rank[number]
    return [segment[k] for k in order.tolist()], bucket[order], least[order], tag[order], [
        (doc, start, number[a:b]) for (doc, start), (a, b) in zip(places, itertools.pairwise(ends), strict=True)
    ]


def _segment_rows(buckets: int):
    def run(docs: pa.Table, notes: pa.Table) -> pa.Table:
        if not docs.num_rows or not notes.num_rows:
            return _rows([], 1, [], [])
        strings, bucket, least, tags, _ = _known_segments(*_texts(docs), notes, buckets)
        pack = zstandard.ZstdCompressor(level=3).compress
        filled, edges = np.unique(bucket, return_index=True)
        payload = []
        for a, b in itertools.pairwise([*edges.tolist(), len(strings)]):
            sizes = np.array([len(s) for s in strings[a:b]], np.uint32)
            head = struct.pack("<q", b - a) + least[a:b].tobytes() + sizes.tobytes() + tags[a:b].tobytes()
            payload.append(pack(head + b"".join(strings[a:b])))
        return _rows([docs.column("part")[0].as_py()] * len(filled), 1, filled.tolist(), payload)

    return run


def suffix_order(data: np.ndarray) -> np.ndarray:
    """Suffixes sorted by at least their first ``LENGTH`` bytes, by doubling the compared length.

    Where they fit, the two ranks of a suffix and its place share one number, as sorting
    numbers is much faster than sorting places by them.
    """
    n = len(data)
    bits = max(int(n).bit_length(), 1)
    narrow = 3 * bits <= 64
    first = min((64 - bits) // 8, 8) if narrow else 8
    padded = np.concatenate([data, np.zeros(first, np.uint8)])
    key = np.zeros(n, np.uint64)
    for k in range(first):
        key = key << np.uint64(8) | padded[k:k + n]
    width, shift = first, np.uint64(bits)
    places = np.arange(n, dtype=np.uint64)
    while True:
        if narrow:
            both = np.sort(key << shift | places)
            order, sorted_key = (both & np.uint64((1 << bits) - 1)).astype(np.int64), both >> shift
        else:
            order = np.argsort(key)
            sorted_key = key[order]
        if width >= LENGTH:
            return order
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(np.concatenate([[False], sorted_key[1:] != sorted_key[:-1]])).astype(np.uint64) + np.uint64(1)
        behind = np.zeros(n, np.uint64)
        behind[:max(n - width, 0)] = rank[width:]
        key, width = rank << (shift if narrow else np.uint64(32)) | behind, width * 2


def heads_of(data: np.ndarray) -> np.ndarray:
    """The first eight bytes of each suffix as a number."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    key = np.zeros(len(data), np.uint64)
    for k in range(8):
        key = key << np.uint64(8) | padded[k:k + len(data)]
    return key


def apart(bwt: np.ndarray, length: int, heads: np.ndarray | None = None) -> np.ndarray:
    """For each suffix in order, whether it agrees with the one before in fewer than ``length`` bytes.

    Breadth-first backward extension: from the interval of a word w, each byte c in front of
    its suffixes gives the interval of cw; where the latter ends, suffixes agree in |w| bytes
    at most. An interval is extended further only if its end was not marked before. ``heads`` are
    the first eight bytes of the suffixes in order; with them the expansion begins with the words of eight bytes.
    """
    n = len(bwt)
    order = np.argsort(bwt, kind="stable")
    back = np.empty(n, np.int64)
    back[order] = np.arange(n)
    same = bwt[order[1:]] == bwt[order[:-1]]
    following, previous = np.full(n, n), np.full(n, -1)
    following[order[:-1][same]] = order[1:][same]
    previous[order[1:][same]] = order[:-1][same]
    # The last place of the run of equal bytes that each place is in.
    run_ends = np.concatenate([np.flatnonzero(bwt[1:] != bwt[:-1]), [n - 1]])
    run_end = np.repeat(run_ends, np.diff(np.concatenate([[-1], run_ends])))
    marked = np.zeros(n + 1, bool)
    marked[0] = marked[n] = True
    low, high, done = np.array([0]), np.array([n - 1]), 0
    if heads is not None and length > 8:
        edges = np.flatnonzero(heads[1:] != heads[:-1])
        marked[edges + 1] = True
        low, high, done = np.concatenate([[0], edges + 1]), np.concatenate([edges, [n - 1]]), 8
        # Those whose end differs within seven bytes were marked by a shorter word.
        last = np.flatnonzero(heads[edges] >> np.uint64(8) == heads[edges + 1] >> np.uint64(8))
        low, high = low[last], high[last]
    for _ in range(done, length):
        if not len(low):
            break
        # With one byte in front of all its suffixes an interval has one extension, of as many.
        single = run_end[low] >= high
        new_low, new_high = back[low[single]], back[high[single]]
        wide_low, wide_high = low[~single], high[~single]
        if len(wide_low):
            wide = _extended(wide_low, wide_high, bwt, back, following, previous)
            new_low, new_high = np.concatenate([new_low, wide[0]]), np.concatenate([new_high, wide[1]])
        fresh = ~marked[new_high + 1]
        low, high = new_low[fresh], new_high[fresh]
        marked[high + 1] = True
    return marked[:n]


def _extended(low: np.ndarray, high: np.ndarray, bwt: np.ndarray, back: np.ndarray, following: np.ndarray, previous: np.ndarray):
    """The intervals of all one-byte extensions: first and last place of each byte in each interval, paired."""
    width = high - low + 1
    owner = np.repeat(np.arange(len(low)), width)
    at = np.arange(len(owner)) + np.repeat(low - np.cumsum(width) + width, width)
    ends, starts = following[at] > high[owner], previous[at] < low[owner]
    last, first = at[ends], at[starts]
    by_end = np.argsort(owner[ends] << 8 | bwt[last])
    by_start = np.argsort(owner[starts] << 8 | bwt[first])
    return back[first[by_start]], back[last[by_end]]


def earliest(strings: list[bytes], docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every position of the joined strings, the smallest document with the ``LENGTH`` bytes from there.

    ``docs`` has the smallest document of each string. The second array tells where each string begins.
    """
    sizes = np.array([len(s) + 1 for s in strings])
    begin = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(s + bytes([SEPARATOR]) for s in strings), np.uint8)
    order = suffix_order(data)
    group = np.flatnonzero(apart(data[order - 1], LENGTH, heads_of(data)[order]))
    owner = np.repeat(docs, sizes)
    # Suffixes that end before LENGTH bytes stand for no string.
    whole = np.repeat(begin + sizes - 1, sizes) - np.arange(len(data)) >= LENGTH
    least = np.minimum.reduceat(np.where(whole, owner, NO_ID)[order], group)
    out = np.empty(len(data), np.int64)
    out[order] = np.repeat(least, np.diff(np.concatenate([group, [len(data)]])))
    return out, begin


def _portions(several: np.ndarray, lengths: np.ndarray, groups: np.ndarray) -> list[np.ndarray]:
    """Segments in the order of their groups, cut between groups into portions of about ``PORTION_BYTES``."""
    if not len(several):
        return []
    group = groups[several]
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    before = (np.cumsum(lengths[several]) - lengths[several])[first] // PORTION_BYTES
    return np.split(several, first[1:][before[1:] != before[:-1]])


def _runs(strings: list[bytes], docs: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of ``LENGTH``-byte strings with one smallest document: segment, first byte, last byte behind, document.

    A segment that is alone in its group shares no string with another one.
    """
    _, group, size = np.unique(groups, return_inverse=True, return_counts=True)
    alone = size[group] == 1
    lonely, several = np.flatnonzero(alone), np.flatnonzero(~alone)
    lengths = np.array([len(s) for s in strings])
    runs = [(lonely, np.zeros(len(lonely), np.int64), lengths[lonely], docs[lonely])]
    for own in _portions(several[np.argsort(groups[several], kind="stable")], lengths, groups):
        first, begin = earliest([strings[k] for k in own.tolist()], docs[own])
        counts = lengths[own] - LENGTH + 1
        inside = np.repeat(np.arange(len(own)), counts)
        offset = np.arange(len(inside)) - np.repeat(np.cumsum(counts) - counts, counts)
        value = first[begin[inside] + offset]
        starts = np.flatnonzero(np.concatenate([[True], (value[1:] != value[:-1]) | (inside[1:] != inside[:-1])]))
        stops = np.concatenate([starts[1:], [len(inside)]]) - 1
        runs.append((own[inside[starts]], offset[starts], offset[stops] + LENGTH, value[starts]))
    run_of, run_from, run_to, run_doc = (np.concatenate(x) for x in zip(*runs, strict=True))
    order = np.argsort(run_of, kind="stable")
    return run_of[order], run_from[order], run_to[order], run_doc[order]


def _meet(table: pa.Table) -> pa.Table:
    """Tell each part, for its segments of this bucket, the smallest document of every string in runs."""
    unpack = zstandard.ZstdDecompressor().decompress
    parts = table.column("part").to_pylist()
    known: dict[bytes, int] = {}
    held, owners, marks, seen = [], [], [], 0
    for packed in table.column("payload").to_pylist():
        raw = unpack(packed)
        (n,) = struct.unpack_from("<q", raw)
        owners.append(np.frombuffer(raw, np.int64, n, 8))
        ends = (np.cumsum(np.frombuffer(raw, np.uint32, n, 8 + 8 * n), dtype=np.int64) + 8 + 16 * n).tolist()
        marks.append(np.frombuffer(raw, np.uint32, n, 8 + 12 * n))
        pieces = [raw[a:b] for a, b in itertools.pairwise([8 + 16 * n, *ends])]
        held.append(_numbered(pieces, known, seen))
        seen += n
    firsts, number = _dense(known, np.concatenate(held))
    least = np.full(len(firsts), NO_ID)
    np.minimum.at(least, number, np.concatenate(owners))
    strings = list(known)
    del known
    run_of, run_from, run_to, run_doc = _runs(strings, least, np.concatenate(marks)[firsts])
    edges = np.searchsorted(run_of, np.arange(len(strings) + 1))
    pack = zstandard.ZstdCompressor(level=1).compress
    payload = []
    n_runs = edges[number + 1] - edges[number]
    last_run = np.cumsum(n_runs)
    at = np.arange(n_runs.sum()) + np.repeat(edges[number] - last_run + n_runs, n_runs)
    run_from, run_to, run_doc = run_from[at], run_to[at], run_doc[at]
    # Of each part: its segments, and their runs.
    stops = np.cumsum([len(x) for x in held])
    run_stops = np.concatenate([[0], last_run])[stops]
    begin = run_begin = 0
    for end, run_end in zip(stops.tolist(), run_stops.tolist(), strict=True):
        payload.append(pack(
            struct.pack("<qq", end - begin, run_end - run_begin) + n_runs[begin:end].tobytes()
            + b"".join(x[run_begin:run_end].tobytes() for x in (run_from, run_to, run_doc))
        ))
        begin, run_begin = end, run_end
    return _rows(parts, 1, [table.column("bucket")[0].as_py()] * len(parts), payload)


# ---- removal -------------------------------------------------------------------------


def _answers(notes: pa.Table) -> tuple[np.ndarray, ...]:
    """First run and number of runs of each segment of a part, and start, end and document of each run, over all buckets in order."""
    unpack = zstandard.ZstdDecompressor().decompress
    told = [x for x in zip(*(notes.column(c).to_pylist() for c in ("bucket", "kind", "payload")), strict=True) if x[1] == 1]
    counts, runs = [], []
    for _, _, packed in sorted(told):
        raw = unpack(packed)
        n, m = struct.unpack_from("<qq", raw)
        counts.append(np.frombuffer(raw, np.int64, n, 16))
        runs.append([np.frombuffer(raw, np.int64, m, 16 + 8 * (n + k * m)) for k in range(3)])
    n_runs = _joint(counts, np.int64)
    return np.cumsum(n_runs) - n_runs, n_runs, *(_joint([x[k] for x in runs], np.int64) for k in range(3))


def _remove(buckets: int):
    def run(docs: pa.Table, notes: pa.Table) -> pa.Table:
        texts, ids = _texts(docs) if docs.num_rows else ([], np.zeros(0, np.int64))
        removed = [np.zeros((0, 2), np.int64)] * len(texts)
        if len(texts) and notes.num_rows:
            *_, places = _known_segments(texts, ids, notes, buckets)
            _mark(removed, texts, ids, places, _answers(notes))
        kept, spans = [], []
        for text, cut in zip(texts, removed, strict=True):
            ends = [0, *cut[:, 1].tolist()]
            kept.append(b"".join(text[a:b] for a, b in zip(ends, [*cut[:, 0].tolist(), len(text)], strict=True)))
            spans.append([{"start": a, "stop": b} for a, b in cut.tolist()])
        return pa.table({
            "doc_id": docs.column("doc_id").sort() if len(texts) else pa.array([], pa.int64()),
            "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
            "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
            "kept": pa.array(kept, pa.binary()),
        })

    return run


def _mark(removed: list, texts: list[bytes], ids: np.ndarray, places: list, answers: tuple[np.ndarray, ...]) -> None:
    """Merge what each segment loses in each document to the spans of that document."""
    sizes = np.array([len(t) for t in texts])
    first_of = np.cumsum(sizes) - sizes
    base, n_runs, run_from, run_to, run_doc = answers
    for (first, last), (doc, start, number) in zip(_joined(texts), places, strict=True):
        change = np.zeros(int(sizes[first:last].sum()) + 1, np.int32)
        count = n_runs[number]
        at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(base[number], count)
        whose = np.repeat(np.arange(len(number)), count)
        later = run_doc[at] < ids[doc[whose]]
        np.add.at(change, start[whose][later] + run_from[at][later], 1)
        np.add.at(change, start[whose][later] + run_to[at][later], -1)
        covered = np.concatenate([[False], np.cumsum(change[:-1]) > 0, [False]])
        for k in range(first, last):
            a = int(first_of[k] - first_of[first])
            b = a + int(sizes[k])
            mask = covered[a:b + 2].copy()
            mask[0] = mask[-1] = False
            edge = np.flatnonzero(mask[1:] != mask[:-1])
            if len(edge):
                removed[k] = edge.reshape(-1, 2).astype(np.int64)


def _joined(texts: list[bytes]) -> list[tuple[int, int]]:
    """The runs of texts for which ``segments`` gives anything."""
    sizes = [len(t) for t in texts]
    return [(a, b) for a, b in slices(sizes, SLICE_BYTES) if max(sizes[a:b]) >= LENGTH]


def remove_repeated(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, ``spans`` (removed bytes, start and stop) and ``kept`` (the other bytes) of each document."""
    size = docs.agg(F.sum(F.octet_length("text")).alias("bytes")).first()["bytes"] or 0
    parts = max(1, -(-size // PART_BYTES))
    buckets = buckets_of(parts)
    dealt = docs.select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)).alias("part"), F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("binary").alias("text"),
    )
    named = dealt.groupBy("part").applyInArrow(_minimizers(buckets), _NOTES)
    shared = named.groupBy("bucket").applyInArrow(_shared(HOT_SEGMENTS), _NOTES)
    found = dealt.groupBy("part").cogroup(shared.groupBy("part")).applyInArrow(_segment_rows(buckets), _NOTES)
    answers = found.groupBy("bucket").applyInArrow(_meet, _NOTES)
    return dealt.groupBy("part").cogroup(shared.union(answers).groupBy("part")).applyInArrow(
        _remove(buckets), "doc_id long, n_bytes long, spans array<struct<start:long,stop:long>>, kept binary"
    )
