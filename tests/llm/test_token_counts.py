"""Token counts against the sentencepiece library."""

from __future__ import annotations

import random

import pytest

from tidemark.llm import piece_codec, token_counts

public_tokenizers = pytest.importorskip("public_tokenizers")
MODEL = "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(MODEL))


def test_whole_tokens_are_those_of_the_library(library):
    m = piece_codec.model(public_tokenizers.path(MODEL))
    whole = token_counts.whole_tokens(m)
    # the library puts a mark before each text; a piece of the shape of a pre-token is a text after it
    shaped = [p for p in m.id_of if token_counts._WHOLE.fullmatch(p) and len(p) > 1]
    alone = {p for p in shaped if len(library.encode(p[1:].replace(piece_codec.MARK, " "))) == 1}
    assert {p for p in whole if len(p) > 1} == alone and len(alone) > 10_000


def hard_texts():
    rng = random.Random(8)
    odd = [None, "", " ", "  ", "\n", " \t x", "a", "▁", "▁▁a ▁", "<s>", "</s> <unk> <0x41>", "é́ ﬁ ½", "\u0000", "日本語 テキスト", "🙂🙃 👩‍👩‍👧", " ", "ﷺ", "a" * 9000, " " * 5000, "the " * 4096, "the " * 4097, "𐀀" * 300]
    letters = "etaoin shrdlu  \n\t.,-ÀÉéß0123456789<>/▁日🙂"
    some = ["".join(rng.choices(letters, k=rng.randrange(1, 400))) for _ in range(300)]
    long = " ".join("".join(rng.choices(letters[:12], k=rng.randrange(1, 14))) for _ in range(60_000))
    return [*odd, *some, long, long]


def test_counts_match_the_library(spark, library):
    texts = hard_texts()
    ids = [None, 7, 7, *range(len(texts) - 3)]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in zip(ids, texts)], "doc_id long, text string, id string, n_bytes string").repartition(3)
    got = token_counts.count_tokens(df, public_tokenizers.path(MODEL))
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    n = [len(library.encode(t or "")) for t in texts]
    want = [(i, len((t or "").encode()), k, k > 4096) for i, t, k in zip(ids, texts, n)]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert n[0] == n[1] == 0 and {k > 4096 for k in n} == {True, False}


def test_what_is_remembered_is_bounded(monkeypatch, library):
    monkeypatch.setattr(token_counts, "REMEMBERED", 3)
    c = token_counts.TokenCounter(piece_codec.model(public_tokenizers.path(MODEL)))
    text = " ".join(f"xq{i}zzv" for i in range(200)) + " " + "q" * 200
    assert c.count(text) == len(library.encode(text)) and len(c.merged) <= 3 and all(len(s) <= token_counts.LONGEST for s in c.merged)


def test_no_texts(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.count_tokens(df, public_tokenizers.path(MODEL)).collect() == []
