"""Toxicity by a weighted lexicon.

Texts are folded first: lower case, look-alike letters of other scripts and digits or
signs that stand for letters become plain letters. The lexicon holds word beginnings
and whole words; its weights are the log-odds of labelled toxic against other
documents. All entries are found in one Aho-Corasick pass; those inside an exception
phrase ("trash can") do not count. A word of the short starting list that was not found this way joins with its own
log-odds where most labelled documents that hold it are toxic. The summed weight, per length and as such,
goes through a logistic function fitted on the training sample.

Edge cases: NULL and empty texts have no hits and get the lowest score; without usable
labels the lexicon is that starting list with equal weights; repeated rows are scored
as often; other columns are not read.
"""

from __future__ import annotations

import bisect
import itertools
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from perkwell.llm.labelled import SAMPLE_ROWS, held_out, training_rows
from perkwell.llm.textbytes import text_batches

# Letters of other scripts that look like Latin ones, and signs used for letters.
HOMOGLYPHS = dict(zip("аеорсухіјѕԁһкмтвнгαεορτυνικβ", "aeopcyxijsdhkmtbhraeoptuvikb", strict=True))
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "|": "l", "€": "e"}
LOOKALIKES, SPELLINGS = str.maketrans(HOMOGLYPHS), str.maketrans(SIGNS)
STARTERS = ("idiot", "moron", "loser", "scum", "worthless", "pathetic", "stupid", "trash", "disgusting", "clown")
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "clown nose", "stupid mistake")
HOLD_PARTS, HOLD_PART = 4, 2
SHORTEST, LONGEST = 4, 10
# An entry is listed if its share of toxic documents is surely (so many standard deviations) above the least precision.
DEVIATIONS, LEAST_PRECISION, KEPT_HITS = 1.64, 0.5, 0.9
THRESHOLD = 0.3
_WORD = re.compile(r"[^\W\d_]+")
_RUN = re.compile(r"(?<=[^\W\d_])[013457@$|€]+(?=[^\W\d_])|(?<![^\W_])[013457@$|€](?=[^\W\d_])")


def folded(text: str | None) -> str:
    """Words of the text, folded and separated by single blanks, with a blank at both ends.

    Digits and signs count as letters only where a letter follows, inside or at the beginning of a word.
    """
    plain = (text or "").lower()
    if not plain.isascii():
        plain = unicodedata.normalize("NFKC", plain).lower()
    plain = _RUN.sub(lambda m: m.group().translate(SPELLINGS), plain)
    if not plain.isascii():
        plain = plain.translate(LOOKALIKES)
    return f" {' '.join(_WORD.findall(plain))} "


def entries_of(words: str) -> set[str]:
    """All lexicon entries a folded text supports: word beginnings, and whole words with a blank at the end."""
    found = set()
    for word in set(words.split()):
        found.add(f" {word} ")
        found.update(f" {word[:n]}" for n in range(SHORTEST, min(len(word), LONGEST) + 1))
    return found


def mined(rows: DataFrame) -> dict[str, float]:
    """Weights of the entries that tell toxic texts, from rows (text, label), whose number bounds theirs."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column(1).to_pylist()
            for begin, end, texts in text_batches(batch.column(0)):
                toxic, every = Counter(), Counter()
                for text, label in zip(texts, labels[begin:end], strict=True):
                    entries = entries_of(folded(text))
                    every.update(entries)
                    if label:
                        toxic.update(entries)
                names = list(every)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names), pa.array([toxic[e] for e in names], pa.int64()), pa.array([every[e] for e in names], pa.int64())],
                    ["entry", "toxic", "seen"],
                )

    sums = rows.agg(F.count("*").alias("n"), F.sum("label").alias("t")).first()
    n, t = sums["n"], sums["t"] or 0
    if not t or t == n:
        return {f" {word}": 1.0 for word in STARTERS}
    counted = rows.select("text", "label").mapInArrow(count, "entry string, toxic long, seen long").groupBy("entry").agg(
        F.sum("toxic").alias("toxic"), F.sum("seen").alias("seen")
    )
    weight = F.log((F.col("toxic") + 0.5) / (t + 1)) - F.log((F.col("seen") - F.col("toxic") + 0.5) / (n - t + 1))
    share = F.col("toxic") / F.col("seen")
    z2 = DEVIATIONS**2 / F.col("seen")
    surely = (share + z2 / 2 - F.sqrt(z2 * (share * (1 - share) + z2 / 4))) / (1 + z2)
    rated = counted.select("entry", weight.alias("weight"), "toxic", share.alias("share"), surely.alias("surely"))
    kept = rated.filter((F.col("surely") >= LEAST_PRECISION) | F.col("entry").isin([f" {word}" for word in STARTERS])).collect()
    best = sorted((r for r in kept if r["surely"] >= LEAST_PRECISION), key=lambda r: (-r["toxic"], len(r["entry"]), r["entry"]))
    found = _pruned({r["entry"]: (r["weight"], r["toxic"], r["surely"]) for r in best})
    starters = {r["entry"]: r["weight"] for r in kept if r["surely"] < LEAST_PRECISION and r["share"] >= LEAST_PRECISION and r["weight"] > 0}
    return found | {e: w for e, w in starters.items() if not any(e.startswith(f) for f in found)}


def _pruned(found: dict[str, tuple[float, int, float]]) -> dict[str, float]:
    """Of a beginning and its extensions keep the surer one, unless the extension loses hits."""
    dropped = set()
    for entry, (_, toxic, surely) in found.items():
        for size in range(SHORTEST + 1, len(entry)):
            shorter = found.get(entry[:size])
            if shorter and shorter[2] < surely and toxic >= KEPT_HITS * shorter[1]:
                dropped.add(entry[:size])
            elif shorter and entry[:size] not in dropped:
                dropped.add(entry)
    return {e: w for e, (w, *_) in found.items() if e not in dropped}


@dataclass(frozen=True)
class ToxicityModel:
    lexicon: dict[str, float]
    coefficients: tuple[float, ...]
    exceptions: tuple[str, ...] = EXCEPTIONS

    def automaton(self) -> ahocorasick.Automaton:
        machine = ahocorasick.Automaton()
        for entry, weight in self.lexicon.items():
            machine.add_word(entry, (entry, weight))
        for phrase in self.exceptions:
            machine.add_word(f" {phrase}", (f" {phrase}", None))
        if len(machine):
            machine.make_automaton()
        return machine


def features(machine: ahocorasick.Automaton, text: str | None) -> tuple[float, float, float]:
    """Hit or not, summed weight and weight per length, the last two on a log scale."""
    words = folded(text)
    hits, spared = [], []
    if len(machine):
        for end, (entry, weight) in machine.iter(words):
            (spared if weight is None else hits).append((end - len(entry) + 1, end, weight))
    # The furthest end of all exceptions that begin at or before each of them, in order of their beginnings.
    spared.sort()
    begins = [start for start, _, _ in spared]
    reach = list(itertools.accumulate((end for _, end, _ in spared), max))
    total = 0.0
    for start, end, weight in hits:
        before = bisect.bisect_right(begins, start)
        if not before or reach[before - 1] + 1 < end:
            total += weight
    return float(total > 0), float(np.log1p(total)), float(np.log1p(100 * total / (words.count(" ") + 20)))


def fit(rows: DataFrame) -> ToxicityModel:
    """Lexicon and logistic coefficients from a bounded training sample (text, label)."""
    lexicon = mined(rows)
    start = ToxicityModel(lexicon, (-4.0, 4.0, 0.0, 0.0))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = start.automaton()
        for batch in batches:
            values = np.array([features(machine, t) for t in batch.column(0).to_pylist()]).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([*map(pa.array, values.T), batch.column(1)], ["hit", "total", "density", "label"])

    measured = rows.select("text", F.col("label").cast("int").alias("label")).mapInArrow(
        measure, "hit double, total double, density double, label int"
    ).toArrow()
    y = measured["label"].to_numpy().astype(float)
    if len(y) == 0 or y.min() == y.max():
        return start
    x = np.column_stack([np.ones(len(y)), *(measured[c].to_numpy() for c in ("hit", "total", "density"))])
    beta, ridge = np.zeros(4), np.diag([1e-3, 1.0, 1.0, 1.0])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        beta += np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge, x.T @ (y - p) - ridge @ beta)
    return ToxicityModel(lexicon, tuple(beta.tolist()))


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, score (0 to 1, higher: more likely toxic)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, beta = model.automaton(), np.array(model.coefficients)
        for batch in batches:
            for begin, end, texts in text_batches(batch.column(1)):
                x = np.column_stack([np.ones(len(texts)), [features(machine, t) for t in texts]])
                p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, end - begin), pa.array(p)], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def scored(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted for every document, by a model fitted on the labels not held out."""
    model = fit(training_rows(docs, labels, "toxic", HOLD_PARTS, HOLD_PART, sample))
    return score(docs, model).select(
        "doc_id", held_out("doc_id", HOLD_PARTS, HOLD_PART).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that are not predicted toxic, scored and filtered in the same pass."""
    model = fit(training_rows(docs, labels, "toxic", HOLD_PARTS, HOLD_PART, sample))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, beta = model.automaton(), np.array(model.coefficients)
        for batch in batches:
            at = batch.schema.get_field_index("text")
            x = [beta @ (1.0, *features(machine, t)) for t in batch.column(at).to_pylist()]
            fine = 1 / (1 + np.exp(-np.clip(np.array(x), -30, 30))) < THRESHOLD
            yield batch.filter(pa.array(fine))

    return docs.mapInArrow(keep, docs.schema)
