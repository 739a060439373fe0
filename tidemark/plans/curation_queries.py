"""Harness and curation operators over the driver's tables, with oracles where SQL can tell."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import canonical, curation, harness

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _registered(oracle: str | None):
    def keep(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return keep


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _batch(spark: SparkSession, sf_dir: str, records: list[dict]) -> DataFrame:
    from .catalogue import engine_for

    engine = engine_for(spark, sf_dir)
    return harness.as_frame(engine, harness.run_batch(engine, records))


_RECORDS = [
    {"id": "ok", "query": "SELECT COUNT(*) AS n FROM events"},
    {"id": "scan", "query": "SELECT * FROM events ORDER BY user_id", "expected_status": "INVALID", "expected_error_substring": "non-time column [[user_id]]"},
    {"id": "word", "query": "SELECT COUNT(*) AS count FROM events", "expected_status": "INVALID", "expected_error_pattern": "quoted"},
    {"id": "wrong", "query": "SELECT 1 AS x", "expected_status": "INVALID", "expected_error_substring": "x"},
]


@_registered("SELECT * FROM (VALUES ('ok', 'VALID', 'none', 1::BIGINT), ('scan', 'INVALID', 'true', -1), ('word', 'INVALID', 'true', -1), ('wrong', 'VALID', 'false', 1)) t(id, status, passed, row_count)")
def harness_batch(spark, sf_dir):
    return _batch(spark, sf_dir, _RECORDS).select("id", "status", F.coalesce(F.col("assertion_passed").cast("string"), F.lit("none")).alias("passed"), F.coalesce("row_count", F.lit(-1)).alias("row_count"))


@_registered("SELECT 4::BIGINT AS total, 2::BIGINT AS valid, 2::BIGINT AS invalid, 0::BIGINT AS timeout, 3::BIGINT AS assertions, 1::BIGINT AS failures")
def harness_summary(spark, sf_dir):
    s = harness.summarize(_batch(spark, sf_dir, _RECORDS))
    return spark.createDataFrame([(s["total"], s["valid"], s["invalid"], s["timeout"], s["assertions"], s["assertion_failures"])], "total long, valid long, invalid long, timeout long, assertions long, failures long")


@_registered("SELECT * FROM (VALUES ('id:ok', 'VALID', '(missing)'), ('id:wrong', 'VALID', 'INVALID')) t(key, status_a, status_b)")
def harness_diff(spark, sf_dir):
    a = _batch(spark, sf_dir, _RECORDS)
    b = _batch(spark, sf_dir, [*_RECORDS[1:3], {"id": "wrong", "query": "SELECT nope FROM events"}])
    return harness.diff_runs(a, b).select("key", "status_a", "status_b")


@_registered("SELECT true AS agree, false AS differ, true AS equal_prints")
def canonical_agreement(spark, sf_dir):
    from .catalogue import engine_for

    run = engine_for(spark, sf_dir).sql
    a = run("SELECT TIME_EXTRACT(__time, 'HOUR') AS h, COUNT(*) AS n FROM events GROUP BY 1")
    b = run("SELECT COUNT(*) AS c, TIME_FORMAT(__time, 'HH') AS hh, MAX(user_id) AS m FROM events GROUP BY 2")
    c = run("SELECT TIME_EXTRACT(__time, 'HOUR') AS h, COUNT(DISTINCT user_id) AS n FROM events GROUP BY 1")
    prints = canonical.fingerprint(a) == canonical.fingerprint(b.select("hh", "c"))
    return spark.createDataFrame([(canonical.results_agree(a, b), canonical.results_agree(a, c), prints)], "agree boolean, differ boolean, equal_prints boolean")


#: Change of a customer's balance -> the second result: within the tolerance, equal, beyond it; some rows are missing or there twice.
_CHANGED = "c_acctbal * 1e8 * CASE c_custkey % 5 WHEN 0 THEN 1 + 9e-7 WHEN 2 THEN 1 + 1.1e-6 ELSE 1 END"


@_registered(f"""WITH a AS (SELECT c_name, c_acctbal * 1e8 AS v FROM customer),
 b AS (SELECT c_name, {_CHANGED} AS v FROM customer, range(2) r(k) WHERE k < CASE WHEN c_custkey % 15 = 3 THEN 0 WHEN c_custkey % 20 = 4 THEN 2 ELSE 1 END),
 m AS (SELECT c_name, count(b.v) AS n, coalesce(bool_or(abs(a.v - b.v) > 1e-6 * greatest(1, abs(a.v), abs(b.v))), false) AS far FROM a LEFT JOIN b USING (c_name) GROUP BY 1)
SELECT c_name, 1::BIGINT AS n_a, n AS n_b FROM m WHERE far OR n <> 1""")
def agreement_mismatches(spark, sf_dir):
    """Balances of up to 1e12 against changed ones: the rows of either that have no partner."""
    customers = _table(spark, sf_dir, "customer")
    a = customers.select("c_name", (F.col("c_acctbal") * 1e8).alias("v"))
    copies = F.when(F.expr("c_custkey % 15 = 3"), 0).when(F.expr("c_custkey % 20 = 4"), 2).otherwise(1)
    b = customers.select("c_name", F.expr(_CHANGED).alias("v"), F.explode(F.array_repeat(F.lit(1), copies))).select("v", "c_name")
    found = canonical.mismatches(a, b)
    return found.groupBy(F.substr(F.col("exact")[0], F.lit(2)).alias("c_name")).agg(F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b"))


#: case -> two expressions over the sum of a customer's orders, and whether results of them agree
_SUMS = {
    "equal": ("v", "v"), "sums_of_1e12": ("v * 1e6", "v * 1e6 * (1 + 5e-7)"), "beyond": ("v * 1e6", "v * 1e6 * (1 + 2e-6)"),
    "rounding_edge": ("round(v / 1e6, 3) + 0.4999e-6", "round(v / 1e6, 3) + 0.5001e-6"), "near_nothing": ("0 * v", "0 * v + 2e-6"),
}


@_registered(" UNION ALL ".join(f"SELECT '{k}' AS name, bool_and(abs(x - y) <= 1e-6 * greatest(1, abs(x), abs(y))) AS agree FROM (SELECT {a} AS x, {b} AS y FROM (SELECT o_custkey, sum(o_totalprice)::DOUBLE AS v FROM orders GROUP BY 1))" for k, (a, b) in _SUMS.items()))
def agreement_of_sums(spark, sf_dir):
    """Pairs of results without any exact column but the key, compared as bags."""
    sums = _table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.sum("o_totalprice").cast("double").alias("v"))
    text = sums.select(F.concat(F.lit("c"), "o_custkey").alias("c"), "v")
    pick = lambda e: text.select("c", F.expr(e).alias("v"))
    return spark.createDataFrame([(k, canonical.results_agree(pick(a), pick(b))) for k, (a, b) in _SUMS.items()], "name string, agree boolean")


@_registered("SELECT event_id, user_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1")
def curation_first_of_each(spark, sf_dir):
    return curation.first_of_each(_table(spark, sf_dir, "events"), F.concat_ws(":", "user_id", "event_type"), "event_id").select("event_id", "user_id", "event_type")


@_registered("""WITH RECURSIVE c AS (SELECT count(*) AS n, 0 AS k FROM orders
  UNION ALL SELECT (SELECT count(*) FROM (SELECT row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r FROM orders) WHERE r <= greatest(2, ceil(0.0005 * c.n))), k + 1 FROM c WHERE k < 6)
SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r FROM orders) WHERE r <= (SELECT greatest(2, ceil(0.0005 * n)) FROM c WHERE k = 5)""")
def curation_cap(spark, sf_dir):
    return curation.cap_skeletons(_table(spark, sf_dir, "orders"), "o_custkey", "o_orderkey", share=0.0005).select("o_orderkey")


@_registered("SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def curation_held_out(spark, sf_dir):
    known = _table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return curation.without_known(_table(spark, sf_dir, "orders"), known, "o_custkey").select("o_orderkey")


@_registered("SELECT user_id AS family, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS splits FROM events GROUP BY 1 HAVING count(DISTINCT event_type) > 1")
def curation_split_leaks(spark, sf_dir):
    found = curation.split_leaks(_table(spark, sf_dir, "events").withColumnRenamed("user_id", "family"), "family", "event_type")
    return found.select("family", F.array_join("splits", ",").alias("splits"))


@_registered("SELECT event_id, 'v2_' || event_type || '_' || lpad((row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1)::VARCHAR, 5, '0') AS id FROM events")
def curation_numbered(spark, sf_dir):
    return curation.numbered(_table(spark, sf_dir, "events"), "event_type", "event_id").select("event_id", "id")


@_registered("SELECT event_id FROM events WHERE ((event_id * 2654435761) % 1000) / 1000.0 < 0.25")
def curation_hashed_subset(spark, sf_dir):
    return curation.hashed_subset(_table(spark, sf_dir, "events"), "event_id", 0.25).select("event_id")


@_registered("SELECT event_type AS family, round(CASE WHEN avg((user_id % 3 = 0)::INT) > 0 THEN (SELECT avg((user_id % 3 = 0)::INT) FROM events) / avg((user_id % 3 = 0)::INT) ELSE 1 END, 6) AS multiplier FROM events GROUP BY 1")
def curation_reweighted(spark, sf_dir):
    rows = _table(spark, sf_dir, "events").select(F.col("event_type").alias("family"), (F.col("user_id") % 3 == 0).alias("kept"))
    return curation.reweighted(rows, "family", "kept").select("family", F.round("multiplier", 6).alias("multiplier"))


@_registered("SELECT event_type AS kind, round(100.0 * count(*) / (SELECT count(*) FROM events), 6) AS percent, CASE WHEN abs(100.0 * count(*) / (SELECT count(*) FROM events) - 20) <= 5 THEN 'ok' ELSE 'off' END AS verdict FROM events GROUP BY 1")
def curation_distribution(spark, sf_dir):
    rows = _table(spark, sf_dir, "events").select(F.col("event_type").alias("kind"))
    kinds = [r[0] for r in rows.distinct().collect()]
    return curation.distribution(rows, "kind", dict.fromkeys(kinds, 20.0)).select("kind", F.round("percent", 6).alias("percent"), "verdict")


@_registered("SELECT conv_id, turn FROM conversations WHERE len(regexp_extract_all(text, '\\S+')) <= 20")
def curation_word_cap(spark, sf_dir):
    return curation.word_cap(_table(spark, sf_dir, "conversations"), "text", F.lit(20)).select("conv_id", "turn")


#: A judged prediction for each event.
_JUDGED = {"declined": "event_id % 11 = 0", "unanswerable": "event_id % 7 = 0", "valid": "event_id % 11 <> 0 AND event_id % 5 <> 0", "grounded": "event_id % 11 <> 0 AND event_id % 3 <> 0",
           "unscorable": "event_id % 13 = 0", "result_match": "event_id % 11 <> 0 AND event_id % 2 = 0", "instructed": "CASE WHEN event_id % 4 = 0 THEN event_id % 8 = 0 END"}
_PCT = "round(100.0 * count(*) FILTER ({ok}) / count(*) FILTER ({of}), 1)"
_SCORED = {"valid_pct": ("valid AND NOT declined AND NOT unanswerable", "NOT unanswerable"), "grounded_pct": ("grounded AND NOT declined AND NOT unanswerable", "NOT unanswerable"),
           "result_match_pct": ("result_match AND NOT declined AND NOT unanswerable AND NOT unscorable", "NOT unanswerable AND (declined OR NOT unscorable)"),
           "decline_ok_pct": ("declined AND unanswerable", "unanswerable"), "over_decline_pct": ("declined AND NOT unanswerable", "NOT unanswerable"),
           "instruction_pct": ("instructed AND NOT declined AND NOT unanswerable", "instructed IS NOT NULL AND NOT declined AND NOT unanswerable")}


@_registered("SELECT " + ", ".join(f"{_PCT.format(ok=a, of=b)} AS {n}" for n, (a, b) in _SCORED.items()) + ", count(*) AS scored_rows FROM (SELECT " + ", ".join(f"{e} AS {n}" for n, e in _JUDGED.items()) + " FROM events)")
def curation_scores(spark, sf_dir):
    s = curation.score_predictions(_table(spark, sf_dir, "events").select(*[F.expr(e).alias(n) for n, e in _JUDGED.items()]))
    return spark.createDataFrame([(*[float(s[n]) for n in _SCORED], s["scored_rows"])], ", ".join(f"{n} double" for n in _SCORED) + ", scored_rows long")


@_registered("""SELECT event_type, count(*) AS n, 'SELECT ID(DAY, ID), COUNT(*) FROM ID WHERE ID = ID AND ID > ID GROUP BY ID' AS skeleton, 'time_bucket' || CASE WHEN event_type IN ('click', 'error') THEN ',window' ELSE '' END AS features
FROM events GROUP BY 1""")
def curation_skeletons(spark, sf_dir):
    """Skeletons and features of a query made of each event: texts, numbers and names differ, the skeleton does not."""
    over = F.when(F.col("event_type").isin("click", "error"), ", RANK() OVER (ORDER BY 1)").otherwise("")
    sql = F.concat(F.lit("select  Trunc_"), F.col("user_id"), F.lit("(day, 'P1D'),  count(*) FROM t_"), F.col("event_id"), F.lit(" WHERE kind = '"), F.col("event_type"), F.lit("' and v > "), F.col("value"), F.lit("\n GROUP BY 1"))
    featured = F.concat(F.lit("SELECT TIME_FLOOR(__time, 'P1D')"), over, F.lit(" FROM events"))
    events = _table(spark, sf_dir, "events").where("value >= 0")
    return events.groupBy("event_type", curation.skeleton(sql).alias("skeleton"), F.array_join(curation.features(featured), ",").alias("features")).agg(F.count("*").alias("n"))


@_registered(None)
def curation_near_duplicates(spark, sf_dir):
    """Greedy removal of alike turns within a role; no SQL, tested by brute force."""
    rows = _table(spark, sf_dir, "conversations").withColumn("o", F.col("conv_id") * 100_000 + F.col("turn"))
    return curation.drop_near_duplicates(rows, "text", "role", "o").select("conv_id", "turn")
