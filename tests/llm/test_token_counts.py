import random

import pytest

from perkwell.llm import token_counts as tc
from perkwell.llm.queries import tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")


def library(texts, path=PATH):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return [len(tokenizer.encode(t or "", add_special_tokens=False)) for t in texts]


def awkward(rng, n):
    bits = ["'re", "'", "'ll 've", " ", "  ", "\n\n", "\t", "é", "日本語", "😀", "<|endoftext|>", "<|endof", "text|>", "12345", "word", " word", "!!", "x" * 70, " " * 40, "don't", " "]
    return "".join(rng.choices(bits, k=n))


@pytest.mark.parametrize("chunk, overlap", [(16, 16), (50, 20), (200, 40)])
def test_chunks_give_what_whole_texts_give(documents, chunk, overlap):
    rng = random.Random(chunk)
    texts = [None, "", "short", "a" * 3000, " " * 900, "ab " * 400 + "q" * 1500 + " end of it " * 30, "'" * 500, "'s" * 300, "<|endoftext|>" * 60]
    texts += [awkward(rng, rng.randrange(10, 400)) for _ in range(40)]
    texts += [texts[5], texts[5]]
    ids = [*range(len(texts) - 2), 5, None]
    got = tc.token_counts(documents(texts, ids), PATH, chunk=chunk, overlap=overlap).collect()
    want = [(i, len((t or "").encode()), n, n > 512) for i, t, n in zip(ids, texts, library(texts), strict=True)]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_overlaps_are_widened_where_chunks_do_not_meet(documents, monkeypatch):
    calls = []
    monkeypatch.setattr(tc, "joined_runs", lambda *a, was=tc.joined_runs: calls.append(1) or was(*a))
    texts = ["one two three " * 100, "one " * 50 + "y" * 1000 + " two" * 50]
    got = tc.token_counts(documents(texts[:1]), PATH, chunk=100, overlap=30).collect()
    assert not calls and got[0].n_tokens == library(texts)[0]
    got = tc.token_counts(documents(texts[1:]), PATH, chunk=100, overlap=30).collect()
    assert calls and got[0].n_tokens == library(texts)[1]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_tokenizers_encode_whole_texts(documents, name):
    path = tokenizer_path(name)
    assert not tc.cuts_safely(path) and tc.cuts_safely(PATH)
    texts = ["Some words, more words " * 40, None, "é"]
    got = {r.doc_id: r.n_tokens for r in tc.token_counts(documents(texts), path, chunk=50, overlap=20).collect()}
    if name.endswith(".json"):
        want = library(texts, path)
    else:
        from sentencepiece import SentencePieceProcessor

        want = [len(x) for x in SentencePieceProcessor(model_file=path).encode([t or "" for t in texts])]
    assert [got[k] for k in range(3)] == want


def test_no_documents(documents):
    assert tc.token_counts(documents([None]).limit(0), PATH).count() == 0


def test_number_of_chunks():
    for chars in range(1, 300):
        n = tc.n_chunks(chars, 50, 20)
        assert n == 1 and chars <= 70 or 20 < chars - (n - 1) * 50 <= 70
