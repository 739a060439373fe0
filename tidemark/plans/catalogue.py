"""All registered queries of the analytics engine, with their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..engine import Engine
from .dialect_queries import AS_OF, SQL

_TIME_COLUMNS = {"events": "ts", "orders": "o_orderdate", "lineitem": "l_shipdate"}
_engines: dict[tuple[int, str], tuple[SparkSession, Engine]] = {}


def engine_for(spark: SparkSession, sf_dir: str) -> Engine:
    """An engine with the driver's tables, one for each session and folder."""
    key = (id(spark), sf_dir)
    known = _engines.get(key)
    if known and known[0] is spark:
        return known[1]
    engine = Engine(spark, as_of=AS_OF)
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        engine.register(name, f"{sf_dir}/{name}.parquet", _TIME_COLUMNS.get(name))
    s = engine.spark
    words = F.when(F.col("p_partkey") % 10 == 0, F.array().cast("array<string>")).otherwise(F.split("p_name", " "))
    engine.register("tagged", s.read.parquet(f"{sf_dir}/part.parquet").withColumn("tags", words))
    t = F.col("o_orderdate").cast("timestamp")
    encoded = s.read.parquet(f"{sf_dir}/orders.parquet").select(
        "*", F.unix_millis(t).alias("e_ms"), F.unix_seconds(t).alias("e_s"), F.date_format(t, "yyyy-MM-dd HH:mm:ss").alias("s_space"),
        F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("s_iso"), F.date_format(t, "yyyy-MM-dd").alias("s_date"), F.date_format(t, "dd/MM/yyyy").alias("s_dmy"),
        F.when(F.col("o_orderkey") % 7 != 0, F.unix_millis(t) + F.col("o_orderkey") % 100 * 60000).alias("s_end"))
    engine.register("encoded", encoded, "o_orderdate", {"e_s": {"encoding": "epoch_s"}, "e_ms": {"encoding": "epoch_ms"}, "s_iso": {"encoding": "str_iso"}})
    flag = F.when(F.col("event_id") % 2 == 0, '{"flag": true}').otherwise('{"flag": false}')
    dirty = s.read.parquet(f"{sf_dir}/events.parquet").select("ts", F.when(F.col("event_id") % 25 == 0, '{"flag": tr').otherwise(flag).alias("j"))
    engine.register("dirty", dirty, "ts")
    engine.register_lookup("kinds", {"click": "Click", "error": "Error"})
    engine.register_lookup("customers", s.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("v")))
    _engines[key] = spark, engine
    return engine


def without_zone(df: DataFrame) -> DataFrame:
    """Timestamps as UTC without a zone, decimals as doubles: what other engines compare."""
    return df.select(*[F.col(f"`{n}`").cast("timestamp_ntz" if t == "timestamp" else "double" if t.startswith("decimal") else t).alias(n) for n, t in df.dtypes])


def _runner(sql: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: without_zone(engine_for(spark, sf_dir).sql(sql))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {name: _runner(pair[0]) for name, pair in SQL.items()}
ORACLES: dict[str, str] = {name: pair[1] for name, pair in SQL.items()}

from . import check_queries, curation_queries  # noqa: E402

QUERIES |= curation_queries.QUERIES | check_queries.QUERIES
ORACLES |= curation_queries.ORACLES | check_queries.ORACLES
