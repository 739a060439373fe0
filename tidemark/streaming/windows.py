"""Event-time windows over streams: tumbling, sliding and session, with late rows bounded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TIME = "__time"


def _timed(df: DataFrame, late: str) -> DataFrame:
    return df.withWatermark(TIME, late) if df.isStreaming else df


def tumbling(df: DataFrame, size: str, *aggregates: Column, by: tuple[str, ...] = (), late: str = "10 minutes") -> DataFrame:
    """``bucket`` and aggregates per window of ``size``; rows later than ``late`` may be left out of a stream."""
    return _timed(df, late).groupBy(F.window(TIME, size).alias("w"), *by).agg(*aggregates).select(F.col("w.start").alias("bucket"), "*").drop("w")


def sliding(df: DataFrame, size: str, step: str, *aggregates: Column, by: tuple[str, ...] = (), late: str = "10 minutes") -> DataFrame:
    return _timed(df, late).groupBy(F.window(TIME, size, step).alias("w"), *by).agg(*aggregates).select(F.col("w.start").alias("bucket"), "*").drop("w")


def sessions(df: DataFrame, gap: str, *aggregates: Column, by: tuple[str, ...], late: str = "10 minutes") -> DataFrame:
    """``start`` and ``end`` of runs of rows less than ``gap`` apart, per key."""
    return _timed(df, late).groupBy(F.session_window(TIME, gap).alias("w"), *by).agg(*aggregates).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "*").drop("w")


def first_seen(df: DataFrame, *keys: str, late: str = "10 minutes") -> DataFrame:
    """Rows without repeats of their keys; of a stream, within the watermark."""
    return _timed(df, late).dropDuplicatesWithinWatermark(list(keys)) if df.isStreaming else df.dropDuplicates(list(keys))
