"""Every stage of the pipeline against plain Python on what the stage before it kept."""

import os
import re

import corpus_pipeline
from perkwell.llm import near_duplicates as nd
from perkwell.llm import toxicity
from test_near_duplicates import similarity
from test_personal_data import plain

DIRECTORY = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def words(text):
    return [w for w in re.split(r"[^\w]|_", (text or "").lower()) if w]


def shingles(text, n=5):
    ws = words(text)
    return {" ".join(ws[k:k + n]) for k in range(len(ws) - n + 1)}


def classes(rows, weights):
    """Smallest id of each class, over all pairs."""
    vectors = []
    for r in rows:
        _, key, weight = nd.weighted_shingles([r.text], weights)
        vectors.append(dict(zip(key.tolist(), weight.tolist(), strict=True)))
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i].text or "") == (rows[j].text or "") or vectors[i] and vectors[j] and similarity(vectors[i], vectors[j]) >= 0.8:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {rows[k].doc_id: rows[find(k)].doc_id for k in range(len(rows))}


def contained(text, items):
    """Whether the text holds four fifths of the shingles of an item, as many words long as the item allows."""
    for item in items:
        ws = words(item)
        own = shingles(item) if len(ws) >= 5 else {" ".join(ws)}
        if ws and len(own & shingles(text, min(len(ws), 5))) >= 0.8 * len(own):
            return True
    return False


def test_stages_equal_plain_python(spark, tmp_path):
    source = {n: spark.read.parquet(f"{DIRECTORY}/{n}.parquet") for n in ("documents", "labels", "benchmark")}
    items = [r.text for r in source["benchmark"].collect()]
    docs, kept = source["documents"], {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = sorted(docs.collect(), key=lambda r: r.doc_id)
        out = stage(spark, docs, DIRECTORY)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = kept[name] = sorted(docs.collect(), key=lambda r: r.doc_id)
        if name != "mixing":
            assert docs.columns == columns
        texts = {r.doc_id: r.text for r in before}
        if name == "toxicity":
            judged = toxicity.scored(source["documents"], source["labels"]).filter("predicted = 0").collect()
            assert [r.doc_id for r in after] == sorted(r.doc_id for r in judged) and len(after) > 100
        elif name == "near_duplicates":
            same = classes(before, nd.word_frequencies(spark.createDataFrame(before, source["documents"].schema)))
            assert [r.doc_id for r in after] == sorted(set(same.values()))
        elif name == "decontamination":
            assert [r.doc_id for r in after] == [i for i, t in sorted(texts.items()) if not contained(t, items)]
        elif name == "personal_data":
            assert [r.doc_id for r in after] == [r.doc_id for r in before]
            assert all(plain(r.text) == "" for r in after)
            found = {i for i, t in texts.items() if plain(t)}
            changed = {r.doc_id for r in after if r.text != texts[r.doc_id]}
            assert found and found <= changed and len(changed) < len(after) / 2
            assert all(r.n_chars == len(r.text) for r in after if r.doc_id in changed)
        else:
            assert {r.doc_id for r in after} <= set(texts) and all(r.text == texts[r.doc_id] for r in after)
            assert len(after) == len({(r.block, r.position) for r in after})
    whole = corpus_pipeline.run(spark, DIRECTORY).collect()
    assert sorted((r.doc_id, r.epoch, r.block, r.position) for r in whole) == sorted((r.doc_id, r.epoch, r.block, r.position) for r in kept["mixing"])
