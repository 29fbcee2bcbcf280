import random
import re
import time
import zlib

import numpy as np
import pytest

from perkwell.llm import quality, toxicity
from perkwell.llm.queries import QUERIES
from perkwell.llm.toxicity import ToxicityModel, features, folded


def test_folding():
    assert folded("Yоu 1D1OT, m0r0n! $cum 2024 price 5$") == " you idiot moron scum price "
    assert folded(None) == "  " and folded("") == "  "


def test_exceptions_and_word_beginnings():
    machine = ToxicityModel({" trash": 2.0, " lowei": 1.0}, (0, 0, 0, 0)).automaton()
    assert features(machine, "put it in the trash can")[0] == 0
    assert features(machine, "you trash, in a trash can")[1] == pytest.approx(np.log1p(2.0))
    assert features(machine, "loweichen")[0] == 1 and features(machine, "slowei")[0] == 0


def test_starting_words_need_support_by_the_labels(spark):
    rows = [("the grobian came", 1)] * 40 + [("the clown came with a stupid hat", 0)] * 60 + [("stupid trash", 1)] * 2 + [("trash day", 0), ("a fine day", 0)]
    lexicon = toxicity.mined(spark.createDataFrame(rows, "text string, label int"))
    assert any(e.startswith(" grob") for e in lexicon)
    assert " clown" not in lexicon and " stupid" not in lexicon and " moron" not in lexicon
    assert lexicon[" trash"] == pytest.approx(np.log(2.5 / 43) - np.log(1.5 / 63))


@pytest.fixture(scope="module")
def labelled(spark, documents):
    texts = [None, "", "z" * 50_000]
    for k in range(300):
        plain = " ".join(f"word{(k * j) % 97} the" for j in range(30))
        texts.append(f"{plain} gr0bi{k} {plain}" if k % 3 == 0 else plain if k % 3 == 1 else "$$ %% !! " * 40)
    docs = documents(texts)
    labels = spark.createDataFrame(
        [(k, None if k == 5 else int((k - 3) % 3 != 2), int(k >= 3 and (k - 3) % 3 == 0), "x") for k in range(len(texts))] + [(None, 1, 1, "x"), (9999, 0, 1, "x")],
        "doc_id long, quality int, toxic int, text string",
    )
    return docs, labels


def test_exceptions_equal_testing_every_pair():
    rng = random.Random(1)
    model = ToxicityModel({" trash": 1.0, " clown": 2.0, " loser ": 0.5}, (0, 0, 0, 0))
    machine = model.automaton()
    for _ in range(200):
        text = " ".join(rng.choices(["trash", "can", "clown", "fish", "loser", "trash can", "trashcan", "nose", "x"], k=rng.randrange(12)))
        words, hits, spared = folded(text), [], []
        for entry, weight in model.lexicon.items():
            hits += [(m.start(), m.end() - 1, weight) for m in re.finditer(f"(?={entry})", words) for m in [re.compile(entry).match(words, m.start())]]
        for phrase in model.exceptions:
            spared += [(m.start(), m.start() + len(phrase)) for m in re.finditer(f"(?= {phrase})", words)]
        total = sum(w for a, b, w in hits if not any(p <= a and b <= q + 1 for p, q in spared))
        assert features(machine, text)[1] == pytest.approx(np.log1p(total))


def test_a_long_text_full_of_exceptions_is_quick():
    machine = ToxicityModel({" trash": 1.0}, (0, 0, 0, 0)).automaton()
    started = time.process_time()
    assert features(machine, "trash can " * 100_000)[0] == 0
    assert time.process_time() - started < 2


def held(parts, part, n):
    return {k: zlib.crc32(str(k).encode()) % parts == part for k in range(n)}


def test_toxicity_is_learnt_and_kept_apart(labelled):
    docs, labels = labelled
    rows = {r.doc_id: r for r in toxicity.scored(docs, labels).collect()}
    assert len(rows) == 303 and {k: r.held_out for k, r in rows.items()} == held(4, 2, 303)
    assert all(rows[k].predicted == int((k - 3) % 3 == 0) for k in range(3, 303))
    assert rows[0].predicted == rows[1].predicted == 0 and all(0 <= r.score <= 1 for r in rows.values())
    clean = toxicity.without_toxic(docs, labels)
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {k for k, r in rows.items() if not r.predicted}


def test_quality_is_learnt_and_kept_apart(labelled):
    docs, labels = labelled
    rows = {r.doc_id: r for r in quality.scored(docs, labels).collect()}
    assert {k: r.held_out for k, r in rows.items()} == held(5, 0, 303)
    assert all(rows[k].predicted == int((k - 3) % 3 != 2) for k in range(3, 303))
    assert all(0 <= r.score <= 1 for r in rows.values())


def test_no_labels_no_documents(labelled):
    docs, labels = labelled
    none = labels.limit(0)
    assert {r.score for r in quality.scored(docs, none).collect()} == {0.5}
    assert toxicity.scored(docs, none).filter("predicted = 1").count() == 0
    assert quality.scored(docs.limit(0), labels).count() == toxicity.scored(docs.limit(0), labels).count() == 0
    only = labels.filter("quality = 1").withColumn("toxic", labels.quality)
    assert quality.scored(docs, only).filter("predicted = 1").count() == 303
    toxicity.scored(docs, only).count()


def test_flat_forest_equals_walking_the_trees():
    rng = np.random.default_rng(0)
    x = rng.random((600, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.3)).astype(float)
    forest = quality.grow(x, y)

    def walk(row):
        total = forest.base
        for node in forest.roots:
            while forest.left[node] != node:
                node = forest.left[node] if row[forest.feature[node]] <= forest.threshold[node] else forest.right[node]
            total += forest.value[node]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(forest.score(x), [walk(row) for row in x])
    assert ((forest.score(x) > 0.5) == (y == 1)).mean() > 0.95


@pytest.mark.parametrize(("name", "label"), [("op7_quality", "quality"), ("op8_toxicity", "toxic")])
def test_held_out_accuracy_on_the_tables(spark, name, label):
    directory = "/root/testdata/sf0.01"
    scores = QUERIES[name](spark, directory)
    joined = scores.join(spark.read.parquet(f"{directory}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r[label] for r in joined) / len(joined) > 0.9
