"""The corpus pipeline: documents in, encoded training mix out.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the
last return the columns of ``documents``. :func:`run` writes each stage's result
as Parquet in the shared folder and reads it back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import jaccard, language_id, mixing, piece_codec, secret_scan
from tidemark.llm.common import compacted, stash, unused
from tidemark.llm.queries import _piece_model

#: Lowest share of the scores that the best language must have.
MIN_LANGUAGE_SCORE = 0.4


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter and those whose language is unclear."""
    found = language_id.identify(docs, language_id.train(docs))
    clear = found.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE))
    return compacted(clear.select(*docs.columns), like=docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    return compacted(jaccard.keep_one(docs), like=docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts; n_chars follows where a text changed."""
    before = unused("_before", docs)
    masked = secret_scan.redact(docs.withColumn(before, F.length("text")))
    changed = masked.withColumn("n_chars", F.when(F.length("text") != F.col(before), F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return compacted(changed.select(*docs.columns), like=docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources; a document comes as often as the mix takes it."""
    return compacted(mixing.mixed_rows(docs), like=docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and of the decoded texts."""
    return compacted(piece_codec.digests(docs, _piece_model()), like=docs)


STAGES = [
    ("language_id", identify_language),
    ("jaccard_join", drop_near_copies),
    ("secret_scan", mask_secrets),
    ("mixing", mix_sources),
    ("piece_codec", encode_pieces),
]

#: SQL can express neither trained models nor the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
