import math
from collections import defaultdict

import pytest

from perkwell.llm import mixing
from perkwell.llm.mixing import Mix, mix_plan, mixed_documents


def shares(rows):
    tokens = defaultdict(int)
    for r in rows:
        tokens[r.source] += r.n_tokens
    total = sum(tokens.values())
    return {s: t / total for s, t in tokens.items()}


@pytest.fixture(scope="module")
def corpus(documents):
    texts = ["w " * (1 + k % 7) for k in range(3000)]
    return documents(texts, sources=["big" if k % 10 else f"s{k % 40}" if k % 30 else None for k in range(3000)])


def test_entropy_is_met_and_blocks_have_the_weights(corpus):
    mix = Mix(entropy=0.9, max_epochs=None, budget_tokens=30_000, block_tokens=3000)
    rows = mix_plan(corpus, mix).collect()
    p = shares(rows)
    entropy = -sum(x * math.log(x) for x in p.values()) / math.log(len(p))
    assert abs(entropy - 0.9) < 0.005
    assert abs(sum(r.n_tokens for r in rows) - 30_000) < 100
    whole = {b: [r for r in rows if r.block == b] for b in range(9)}
    for b in whole.values():
        assert all(abs(shares(b).get(s, 0) - x) < 0.02 for s, x in p.items())
        assert sorted(r.position for r in b) == list(range(1, len(b) + 1))
        assert [r.source for r in sorted(b, key=lambda r: r.position)] != sorted((r.source for r in b), key=str)


def test_no_epoch_repeats_a_document_and_the_limit_holds(corpus):
    rows = mix_plan(corpus, Mix(entropy=1.0, max_epochs=1.5)).collect()
    assert len({(r.doc_id, r.epoch) for r in rows}) == len(rows)
    used, there = defaultdict(int), defaultdict(int)
    for r in rows:
        used[r.source] += r.n_tokens
    for r in mixing.costed(corpus).collect():
        there[r.source] += r.n_tokens
    assert max(used[s] / there[s] for s in used) == pytest.approx(1.5, abs=0.1)
    with pytest.raises(ValueError):
        mix_plan(corpus, Mix(max_epochs=1.0, budget_tokens=10**7))


def test_odd_tables(documents, corpus):
    assert mix_plan(corpus.limit(0)).count() == 0
    docs = documents([None, "", "a b", "a b"], ids=[1, 2, 3, 3], sources=[None, "", "s", "s"])
    rows = mix_plan(docs, Mix(entropy=None, max_epochs=None)).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in rows) == [(1, 1), (2, 1), (3, 2), (3, 2)]
    texts = mixed_documents(docs.filter("doc_id < 3"), Mix(entropy=None, max_epochs=None))
    assert texts.count() == 2 and texts.columns.count("block") == 1
