"""Texts beyond the pieces in which they are worked off, and the pipeline as a whole."""

from __future__ import annotations

import random

import corpus_pipeline
from pyspark.sql import functions as F

from tidemark.llm import jaccard, lm_scoring, mixing, token_counts
from tidemark.llm.queries import _piece_model


def test_texts_over_four_mebibytes(spark):
    rng = random.Random(4)
    long = " ".join(f"w{rng.randrange(1 << 20)}" for _ in range(650_000))
    assert len(long) > 4 << 20
    near = long + " one more end"
    docs = spark.createDataFrame([(1, long, "a"), (2, near, "a"), (3, "short text", "b"), (None, None, None), (3, "short text", "b")], "doc_id long, text string, source string").repartition(2)
    words = [long.split(), near.split()]
    shingles = [len(set(zip(*(w[k:] for k in range(5))))) for w in words]
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.n_links) for r in jaccard.jaccard_join(docs).collect()}
    assert got[1, shingles[0]] == (1, 1) and got[2, shingles[1]] == (1, 1)
    n = {r.doc_id: r.n_tokens for r in lm_scoring.score(docs, F.lit(False)).collect()}
    assert (n[1], n[2], n[3], n[None]) == (len(words[0]) + 1, len(words[1]) + 1, 3, 1)
    assert {r.doc_id: r.size for r in mixing.mix(docs).collect()} == {1: len(words[0]), 2: len(words[1]), 3: 2, None: 0}
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=_piece_model())
    counted = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(docs, _piece_model()).collect()}
    assert counted[1] == (len(long), len(library.encode(long)), True) and counted[None] == (0, 0, False)


def test_pipeline_from_table_to_table(spark, tmp_path):
    """``run`` writes and rereads each stage; the same stages one by one give the same rows."""
    rng = random.Random(9)
    say = lambda n: " ".join("".join(rng.choices(["the", "and", "tion", "ing", "wh", "er"], k=2)) for _ in range(n))
    texts = [say(rng.randrange(20, 80)) for _ in range(40)]
    texts += [*texts[:6], None, "", "12 34", texts[9] + " token = abcdefghijklmnop1"]
    rows = [(i if i % 13 else None, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.ids_sha256)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(key, got.collect())) == sorted(map(key, docs.collect())) and got.count() > 30
