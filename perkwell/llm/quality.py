"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics are lengths, shares of character classes, repetition of words, word
triples and lines, and the share of common words. Their values in a bounded training
sample are cut into at most ``BINS`` bins at quantiles; trees are grown on histograms of
gradients, and flattened into arrays (feature, threshold, children, value) that
numpy walks for all rows of a batch at once.

Edge cases: NULL and empty texts have all-zero statistics and are scored like any
other; without usable labels of both kinds every score is the share of label 1, or
0.5 without labels; repeated rows are scored as often; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from perkwell.llm.labelled import SAMPLE_ROWS, held_out, training_rows
from perkwell.llm.spotsigs import ANCHORS
from perkwell.llm.textbytes import text_batches

HOLD_PARTS, HOLD_PART = 5, 0
BINS, TREES, DEPTH, RATE, LEAST_LEAF, RIDGE = 64, 80, 4, 0.1, 20, 1.0
THRESHOLD = 0.3
_COMMON = frozenset(ANCHORS)
STATISTICS = (
    "words", "word_length", "longest_word", "distinct_words", "top_word", "distinct_triples", "lines", "distinct_lines",
    "line_length", "upper", "digit", "blank", "punctuation", "symbol", "non_ascii", "sentence_end", "common", "symbol_words",
    "capital_words", "short_words",
)
_BYTE_CLASS = np.full(256, 6)
for _class, _members in enumerate((
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\n", b".,;:'\"()-?", b"!#$%&*+/<=>@[]^_`{|}~\\",
)):
    _BYTE_CLASS[list(_members)] = _class
_BYTE_CLASS[128:] = 5


def statistics(text: str | None) -> list[float]:
    """The values of ``STATISTICS`` for one text."""
    if not text:
        return [0.0] * len(STATISTICS)
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    shares = np.bincount(_BYTE_CLASS[data], minlength=7) / len(data)
    words = text.split()
    n = len(words) or 1
    lengths = [len(w) for w in words] or [0]
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    triples = set(zip(words, words[1:], words[2:], strict=False))
    lines = text.split("\n")
    return [
        np.log1p(len(words)), sum(lengths) / n, np.log1p(max(lengths)), len(counts) / n, max(counts.values(), default=0) / n,
        len(triples) / max(len(words) - 2, 1), np.log1p(len(lines)), len(set(lines)) / len(lines), np.log1p(len(text) / len(lines)),
        *shares[:6], text.count(".") / n, sum(c for w, c in counts.items() if w.lower() in _COMMON) / n,
        sum(c for w, c in counts.items() if not w[-1].isalnum() and w[-1] not in ".,;:?)\"'") / n,
        sum(c for w, c in counts.items() if w.isupper()) / n, sum(c for w, c in counts.items() if len(w) <= 2) / n,
    ]


@dataclass(frozen=True)
class Forest:
    """Trees laid out one after the other; a leaf is its own child, so walking on stays in it."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(DEPTH):
                low = x[rows, self.feature[node]] <= self.threshold[node]
                node = np.where(low, self.left[node], self.right[node])
            total += self.value[node]
        return 1 / (1 + np.exp(-total))


def grow(x: np.ndarray, y: np.ndarray) -> Forest:
    """Boost ``TREES`` trees on the logistic loss."""
    share = float(y.mean()) if len(y) else 0.5
    base = float(np.log(share / (1 - share))) if 0 < share < 1 else (0.0 if not len(y) else float(np.copysign(5.0, share - 0.5)))
    nodes: list[tuple[int, float, int, int, float]] = []
    roots: list[int] = []
    if len(y) and 0 < share < 1:
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
        binned = np.column_stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)])
        total = np.full(len(y), base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-total))
            roots.append(len(nodes))
            _grow_node(nodes, binned, cuts, y - p, p * (1 - p), np.arange(len(y)), 0, total)
    table = list(zip(*nodes, strict=True)) if nodes else [[], [], [], [], []]
    return Forest(
        np.array(table[0], int), np.array(table[1], float), np.array(table[2], int), np.array(table[3], int),
        np.array(table[4], float), np.array(roots, int), base,
    )


def _grow_node(nodes: list, binned: np.ndarray, cuts: list, g: np.ndarray, h: np.ndarray, rows: np.ndarray, depth: int, total: np.ndarray) -> int:
    at = len(nodes)
    value = RATE * g[rows].sum() / (h[rows].sum() + RIDGE)
    nodes.append((0, np.inf, at, at, value))
    best = _best_split(binned[rows], g[rows], h[rows]) if depth < DEPTH and len(rows) >= 2 * LEAST_LEAF else None
    if best is None:
        total[rows] += value
        return at
    feature, cut = best
    low = binned[rows, feature] <= cut
    left = _grow_node(nodes, binned, cuts, g, h, rows[low], depth + 1, total)
    right = _grow_node(nodes, binned, cuts, g, h, rows[~low], depth + 1, total)
    nodes[at] = (feature, cuts[feature][cut], left, right, 0.0)
    return at


def _best_split(binned: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[int, int] | None:
    """Feature and bin after which to cut, by the gain in the histograms of gradients."""
    features = binned.shape[1]
    flat = (binned + np.arange(features) * BINS).ravel()
    size = features * BINS
    hist = [np.bincount(flat, np.repeat(v, features), size).reshape(features, BINS).cumsum(axis=1) for v in (g, h, np.ones(len(g)))]
    (gl, hl, nl), (gt, ht, nt) = hist, [v[:, -1:] for v in hist]
    gain = gl**2 / (hl + RIDGE) + (gt - gl) ** 2 / (ht - hl + RIDGE) - gt**2 / (ht + RIDGE)
    gain[(nl < LEAST_LEAF) | (nt - nl < LEAST_LEAF)] = -np.inf
    best = int(gain.argmax())
    return divmod(best, BINS) if gain.flat[best] > 1e-6 else None


def fit(rows: DataFrame) -> Forest:
    """A forest from a bounded training sample (text, label); the statistics are taken in the tasks."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [statistics(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.list_(pa.float64())), batch.column(1)], ["x", "label"])

    measured = rows.select("text", F.col("label").cast("int").alias("label")).mapInArrow(measure, "x array<double>, label int").toArrow()
    x = np.array(measured["x"].to_pylist(), float).reshape(-1, len(STATISTICS))
    y = measured["label"].to_numpy().astype(float)
    order = np.lexsort([*x.T, y])  # the forest does not depend on how rows were dealt
    return grow(x[order], y[order])


def scored(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted for every document, by a forest fitted on the labels not held out."""
    forest = fit(training_rows(docs, labels, "quality", HOLD_PARTS, HOLD_PART, sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, texts in text_batches(batch.column(1)):
                p = forest.score(np.array([statistics(t) for t in texts]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, end - begin), pa.array(p)], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double").select(
        "doc_id", held_out("doc_id", HOLD_PARTS, HOLD_PART).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
