"""The pipeline's stages in order, on a small table."""

from __future__ import annotations

import random

import corpus_pipeline


def test_pipeline_matches_its_parts(spark):
    rng = random.Random(3)
    words = ["the", "and", "of", "tion", "ing", "wh", "er", "st"]
    say = lambda n: " ".join("".join(rng.choices(words, k=2)) for _ in range(n))
    texts = [say(rng.randrange(20, 80)) for _ in range(60)]
    texts += texts[:10] + [None, "", "12 34", texts[11] + " token = abcdefghijklmnop1"]
    rows = [(i, t, "en", f"s{i % 4}", len(t or "")) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    counts = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        rows = docs.collect()
        counts.append(len(rows))
        if name != "piece_codec":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if name == "language_id":
            assert {r.doc_id for r in rows} == set(range(70)) | {73}
        if name == "jaccard_join":
            assert not {r.doc_id for r in rows} & set(range(60, 70)) and {r.doc_id for r in rows} >= set(range(60))
        if name == "secret_scan":
            assert not any("abcdefghijklmnop1" in r.text for r in rows)
        docs = spark.createDataFrame(rows, docs.schema)
    assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert counts[1] == counts[2] and counts[3] == counts[4]


def test_pipeline_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.collect() == []
        docs = spark.createDataFrame([], docs.schema)
