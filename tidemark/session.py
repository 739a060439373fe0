"""Session helpers."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession


def make_importable(spark: SparkSession) -> None:
    """Let Python workers of a local session import this package.

    On a cluster the package is deployed with the job (``--py-files`` or the
    executors' environment); a local session's workers may start elsewhere.
    """
    sc = spark.sparkContext
    root = str(Path(__file__).resolve().parent.parent)
    paths = sc.environment.get("PYTHONPATH", "").split(":")
    if sc.master.startswith("local[") and root not in paths:
        sc.environment["PYTHONPATH"] = ":".join([root, *filter(None, paths)])
