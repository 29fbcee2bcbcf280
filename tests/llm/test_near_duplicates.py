import collections
import math
import random

import pytest

from perkwell.llm import near_duplicates as nd
from perkwell.llm.textbytes import packed, word_hashes
from perkwell.llm.components import components


def edited(words, k, rng):
    out = list(words)
    for i in rng.sample(range(len(out)), k):
        out[i] = f"new{rng.randrange(10**6)}"
    return out


def brute_force(spark, docs):
    idf = nd.word_frequencies(docs)
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda r: r[0])
    vectors = []
    for _, text in rows:
        _, key, weight = nd.weighted_shingles([text], idf)
        vectors.append(dict(zip(key.tolist(), weight.tolist(), strict=True)))
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            a, b = vectors[i], vectors[j]
            shared = sum(min(w, b[k]) for k, w in a.items() if k in b)
            every = sum(a.values()) + sum(b.values()) - shared
            if rows[i][1] == rows[j][1] or every and shared / every >= 0.8:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {rows[k][0]: rows[find(k)][0] for k in range(len(rows))}


def test_classes_equal_those_of_all_pairs(spark, documents):
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = rng.choices(vocabulary, k=60)
    texts = [None, "", "", "one two", "one two", "one three", "word " * 3000, "word " * 3000, "!!", "x" * 100_000]
    for _ in range(12):
        base = rng.choices(vocabulary, k=rng.choice([40, 150, 400]))
        texts += [" ".join(base)] * 2 + [" ".join(edited(base, n, rng)) for n in (1, 1, 2, 6)]
    for _ in range(60):  # share a passage, but are not alike
        texts.append(" ".join(passage + rng.choices(vocabulary, k=rng.choice([40, 60, 90]))))
    base = rng.choices(vocabulary, k=200)
    texts += [" ".join(edited(base, 3, rng)) for _ in range(80)]  # alike through what they were edited from
    texts.append(" ".join(base))
    rng.shuffle(texts)
    docs = documents(texts)
    classes = {r.doc_id: r.class_id for r in nd.near_duplicate_classes(docs).collect()}
    assert classes == brute_force(spark, docs)
    kept = nd.without_near_duplicates(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(classes.values())


def test_no_documents_no_ids_and_repeated_rows(documents):
    docs = documents(["a b c d e f", "a b c d e f", None], ids=[7, 7, None])
    assert nd.near_duplicate_classes(docs.limit(0)).count() == 0
    assert sorted(map(repr, (tuple(r) for r in nd.near_duplicate_classes(docs).collect()))) == ["(7, 7)", "(7, 7)", "(None, None)"]
    kept = nd.without_near_duplicates(docs)
    assert sorted(map(repr, ((r.doc_id, r.text) for r in kept.collect()))) == ["(7, 'a b c d e f')", "(None, None)"]
    assert kept.columns == docs.columns


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0)])
def test_one_doc_id_with_two_texts(documents, order):
    one, other = " ".join(f"w{k}" for k in range(60)), " ".join(f"v{k}" for k in range(60))
    rows = [(7, one), (7, other), (9, other + " end")]
    docs = documents([rows[k][1] for k in order], ids=[rows[k][0] for k in order]).coalesce(1)
    assert sorted(tuple(r) for r in nd.near_duplicate_classes(docs).collect()) == [(7, 7), (7, 7), (9, 7)]
    assert {(r.doc_id, r.text) for r in nd.without_near_duplicates(docs).collect()} == {(7, one), (7, other)}


def test_weights_are_those_of_exact_counts(documents):
    rng = random.Random(6)
    texts = [" ".join(rng.choices([f"w{k * k}" for k in range(80)], k=rng.randrange(1, 30))) for _ in range(200)] + [None]
    df = collections.Counter(w for t in texts if t for w in set(t.split()))
    weights = nd.word_frequencies(documents(texts))
    words = [*df, "unseen"]
    hashes, _ = word_hashes(*packed(words))
    want = [round(1000 * math.log1p(len(texts) / df[w])) for w in df] + [round(1000 * math.log1p(nd.RAREST))]
    assert weights.of(hashes).tolist() == want


def test_components_of_random_graphs(spark):
    rng = random.Random(5)
    edges = [(k, k + 1) for k in range(50)] + [(100, 100 + k) for k in range(1, 60)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(150)]
    rng.shuffle(edges)
    root = {n: n for e in edges for n in e}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    touched = {n for a, b in edges if a != b for n in (a, b)}
    assert got == {n: find(n) for n in touched}


def family(pairs, rng, apart=4):
    """Two texts for each of ``pairs`` heads: about 0.85 to each other (less if more words are changed), 0.65 to the rest, the text all come from left out."""
    base = [f"w{k}" for k in range(300)]

    def changed(words, k):
        out = list(words)
        for i in rng.sample(range(len(out)), k):
            out[i] = f"v{rng.randrange(60)}"
        return out

    heads = [changed(base, 4) for _ in range(pairs)]
    return [" ".join(text) for head in heads for text in (head, changed(head, apart))]


def vectors_and_bands(texts, idf):
    row, key, weight = nd.weighted_shingles(texts, idf)
    vectors = [{} for _ in texts]
    for r, k, w in zip(row.tolist(), key.tolist(), weight.tolist(), strict=True):
        vectors[r][k] = w
    return vectors, nd.band_keys(nd.samples(row, key, weight, len(texts), nd._random_tables())).tolist()


def similarity(a, b):
    shared = sum(min(w, b[k]) for k, w in a.items() if k in b)
    return shared / (sum(a.values()) + sum(b.values()) - shared)


def test_no_pair_inside_a_family_that_is_less_alike_is_lost(spark, documents):
    texts = family(700, random.Random(11))
    docs = documents(texts)
    vectors, bands = vectors_and_bands(texts, nd.word_frequencies(docs))
    heads = range(0, len(texts), 2)
    assert 0.6 < sum(similarity(vectors[k], vectors[k - 2]) for k in heads[1:]) / len(heads) < 0.75
    linked = [k for k in heads if similarity(vectors[k], vectors[k + 1]) >= 0.8 and set(bands[k]) & set(bands[k + 1])]
    assert len(linked) > 600
    classes = {r.doc_id: r.class_id for r in nd.near_duplicate_classes(docs).collect()}
    assert [k for k in linked if classes[k] != classes[k + 1]] == []
    assert len(set(classes.values())) > 300


def test_no_pair_that_shares_a_single_band_is_lost(documents):
    texts = family(1000, random.Random(12), 6)
    docs = documents(texts)
    vectors, bands = vectors_and_bands(texts, nd.word_frequencies(docs))
    single = [k for k in range(0, len(texts), 2) if len(set(bands[k]) & set(bands[k + 1])) == 1 and similarity(vectors[k], vectors[k + 1]) >= 0.8]
    assert len(single) >= 2
    classes = {r.doc_id: r.class_id for r in nd.near_duplicate_classes(docs).collect()}
    assert [k for k in single if classes[k] != classes[k + 1]] == []
