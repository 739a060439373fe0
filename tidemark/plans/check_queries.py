"""Checks, gates, suites and sources over the driver's tables, with oracles that compute from the same tables."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import time_window
from ..operators import curation, gates, harness, plans, suite
from ..sources.store import Store, require_unique, verified
from .dialect_queries import AS_OF

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _registered(oracle: str):
    def keep(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, oracle
        return f

    return keep


def _engine(spark: SparkSession, sf_dir: str):
    from .catalogue import engine_for

    return engine_for(spark, sf_dir)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# checks: a query that is rejected with its message, and its accepted twin, whose rows the oracle counts
#: check -> (rejected, part of the message, accepted, rows of the accepted one in SQL)
CHECKS = {
    "c1": ("SELECT * FROM events ORDER BY user_id", "non-time column [[user_id]]", "SELECT user_id FROM events ORDER BY __time", "SELECT count(*) FROM events"),
    "c2": ("SELECT TIME_FLOOR(__time, 'P1D') AS d, COUNT(*) AS n FROM events GROUP BY d", "Column 'd' not found", "SELECT TIME_FLOOR(__time, 'P1D') AS d, COUNT(*) AS n FROM events GROUP BY 1",
           "SELECT count(DISTINCT ts::DATE) FROM events"),
    "c3": ("SELECT user_id, COUNT(*) AS n FROM events GROUP BY 1 ORDER BY event_type", "Expression 'event_type' is not being grouped", "SELECT user_id, COUNT(*) AS n FROM events GROUP BY 1 ORDER BY user_id",
           "SELECT count(DISTINCT user_id) FROM events"),
    "c4": ("SELECT event_type, COUNT(*) AS count FROM events GROUP BY 1", "must be quoted", 'SELECT event_type, COUNT(*) AS "count" FROM events GROUP BY 1', "SELECT count(DISTINCT event_type) FROM events"),
    "c5": ("SELECT event_id FROM events WHERE __time > TIMESTAMP '2024-01-10T00:00:00Z'", "yyyy-MM-dd HH:mm:ss", "SELECT event_id FROM events WHERE __time > TIMESTAMP '2024-01-10 00:00:00'",
           "SELECT count(*) FROM events WHERE ts > TIMESTAMP '2024-01-10'"),
    "c6": ("SELECT event_id FROM events WHERE __time > NOW()", "NOW", "SELECT event_id FROM events WHERE __time < CURRENT_TIMESTAMP", f"SELECT count(*) FROM events WHERE ts < TIMESTAMP '{AS_OF}'"),
    "c7": ("SELECT t.x AS x FROM tagged, UNNEST(tags) AS t(x)", "UNNEST", "SELECT t.x AS x FROM tagged, UNNEST(MV_TO_ARRAY(tags)) AS t(x)",
           "SELECT sum(len(string_split(p_name, ' ')))::BIGINT FROM part WHERE p_partkey % 10 <> 0"),
    "c8": ("SELECT MV_TO_ARRAY(STRING_TO_MV(p_name, ' ')) AS x FROM part", "bare column", "SELECT MV_TO_ARRAY(tags) AS x FROM tagged", "SELECT count(*) FROM part"),
    "c9": ("SELECT user_id, MAX(LOWER(event_type)) AS m FROM events GROUP BY 1", "does not support type [STRING]", "SELECT user_id, MAX(event_id) AS m FROM events GROUP BY 1", "SELECT count(DISTINCT user_id) FROM events"),
    "c10": ("SELECT LOOKUP(event_type, 'nope') AS x FROM events", "Lookup [nope] not found", "SELECT LOOKUP(event_type, 'kinds') AS x, COUNT(*) AS n FROM events GROUP BY 1",
            "SELECT count(DISTINCT coalesce(CASE event_type WHEN 'click' THEN 'Click' WHEN 'error' THEN 'Error' END, '')) FROM events"),
    "c11": ("SELECT TIME_FLOOR(event_id, 'P1D') AS x FROM events", "Cannot apply 'TIME_FLOOR'", "SELECT TIME_FLOOR(MILLIS_TO_TIMESTAMP(e_ms), 'P1D') AS x, COUNT(*) AS n FROM encoded GROUP BY 1",
            "SELECT count(DISTINCT o_orderdate::DATE) FROM orders"),
    "c7_text": ("SELECT t.x AS x FROM part, UNNEST(p_name) AS t(x)", "UNNEST", "SELECT t.x AS x FROM (SELECT STRING_TO_ARRAY(p_name, ' ') AS words FROM part) p, UNNEST(p.words) AS t(x)", "SELECT sum(len(string_split(p_name, ' ')))::BIGINT FROM part"),
    "c7_subquery": ("SELECT t.x AS x FROM (SELECT UPPER(tags) AS words FROM tagged) p, UNNEST(p.words) AS t(x)", "UNNEST", "SELECT t.x AS x FROM (SELECT MV_TO_ARRAY(tags) AS words FROM tagged) p CROSS JOIN UNNEST(p.words) AS t(x)",
                    "SELECT sum(len(string_split(p_name, ' ')))::BIGINT FROM part WHERE p_partkey % 10 <> 0"),
    "c11_expression": ("SELECT TIME_FLOOR(CONCAT(event_type, '!'), 'P1D') AS x FROM events", "Cannot apply 'TIME_FLOOR' to arguments of type 'TIME_FLOOR(<VARCHAR>", "SELECT TIME_FLOOR(COALESCE(__time, CURRENT_TIMESTAMP), 'P1D') AS x FROM events", "SELECT count(*) FROM events"),
    "c11_subquery": ("SELECT TIME_EXTRACT(q.s, 'HOUR') AS x FROM (SELECT s_iso AS s FROM encoded) q", "Cannot apply 'TIME_EXTRACT'", "SELECT TIME_EXTRACT(q.s, 'HOUR') AS x FROM (SELECT TIME_PARSE(s_iso) AS s FROM encoded) q", "SELECT count(*) FROM orders"),
    "c11_cte": ("WITH a AS (SELECT e_ms + 1 AS ms FROM encoded) SELECT TIME_SHIFT(ms, 'P1D', 1) AS x FROM a", "Cannot apply 'TIME_SHIFT' to arguments of type 'TIME_SHIFT(<BIGINT>", "WITH a AS (SELECT e_ms + 1 AS ms FROM encoded) SELECT TIME_SHIFT(MILLIS_TO_TIMESTAMP(ms), 'P1D', 1) AS x FROM a",
                "SELECT count(*) FROM orders"),
    "c12": ("SELECT DISTINCT ON (user_id) user_id FROM events", "ON", "SELECT DISTINCT user_id FROM events", "SELECT count(DISTINCT user_id) FROM events"),
    "nested_aggregate": ("SELECT MAX(SUM(user_id)) AS m FROM events GROUP BY event_type", "nested", "SELECT MAX(s) AS m FROM (SELECT SUM(user_id) AS s FROM events GROUP BY event_type) q", "SELECT 1"),
}


def _check(rejected: str, part: str, accepted: str):
    def run(spark, sf_dir):
        engine = _engine(spark, sf_dir)
        result = harness.validate_query(engine, rejected, 300)
        refused = result.status == harness.INVALID and part in (result.error_message or "")
        return spark.createDataFrame([(refused, engine.sql(accepted).count())], "rejected boolean, accepted_rows long")

    return run


for _name, (_bad, _part, _good, _rows) in CHECKS.items():
    QUERIES[f"check_{_name}"] = _check(_bad, _part, _good)
    ORACLES[f"check_{_name}"] = f"SELECT true AS rejected, ({_rows})::BIGINT AS accepted_rows"

#: Queries that a too strict dialect would reject, and their rows.
MUST_ACCEPT = {
    "full_join": ("SELECT c.c_custkey, n.n_name FROM customer c FULL JOIN nation n ON c.c_nationkey = n.n_nationkey", "SELECT count(*) FROM customer FULL JOIN nation ON c_nationkey = n_nationkey"),
    "union": ("SELECT user_id AS k FROM events UNION SELECT c_custkey AS k FROM customer", "SELECT count(*) FROM (SELECT user_id FROM events UNION SELECT c_custkey FROM customer)"),
    "ordered_union": ("SELECT user_id AS k FROM events UNION ALL SELECT c_custkey AS k FROM customer ORDER BY k", "SELECT (SELECT count(*) FROM events) + (SELECT count(*) FROM customer)"),
    "correlated": ("SELECT c_custkey FROM customer c WHERE c_acctbal > (SELECT AVG(x.c_acctbal) FROM customer x WHERE x.c_nationkey = c.c_nationkey)",
                   "SELECT count(*) FROM customer c WHERE c_acctbal > (SELECT avg(x.c_acctbal) FROM customer x WHERE x.c_nationkey = c.c_nationkey)"),
    "having_alias": ('SELECT user_id, COUNT(*) AS "n" FROM events GROUP BY 1 HAVING "n" > 1 ORDER BY "n";', "SELECT count(*) FROM (SELECT user_id FROM events GROUP BY 1 HAVING count(*) > 1)"),
}


@_registered(" UNION ALL ".join(f"SELECT '{n}' AS name, ({p[1]})::BIGINT AS accepted_rows" for n, p in MUST_ACCEPT.items()))
def check_c13(spark, sf_dir):
    engine = _engine(spark, sf_dir)
    return spark.createDataFrame([(n, engine.sql(p[0]).count()) for n, p in MUST_ACCEPT.items()], "name string, accepted_rows long")


#: lint -> (query it flags, query it doesn't, rows of the latter)
LINTS = {
    "l1": ("SELECT JSON_VALUE(props, '$.k') AS k FROM events", "SELECT JSON_VALUE(PARSE_JSON(props), '$.k') AS k FROM events", "SELECT count(*) FROM events"),
    "l1_subquery": ("SELECT JSON_VALUE(q.p, '$.k') AS k FROM (SELECT LOWER(props) AS p FROM events) q", "SELECT JSON_VALUE(q.p, '$.k') AS k FROM (SELECT PARSE_JSON(props) AS p FROM events) q", "SELECT count(*) FROM events"),
    "l2": ("SELECT MILLIS_TO_TIMESTAMP(e_s) AS t FROM encoded", "SELECT MILLIS_TO_TIMESTAMP(e_s * 1000) AS t FROM encoded", "SELECT count(*) FROM orders"),
    "l3": ("SELECT e_s FROM encoded WHERE s_iso BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1996-01-01'", "SELECT e_s FROM encoded WHERE __time BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1996-01-01'",
           "SELECT count(*) FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1996-01-01'"),
}


def _lint(rule: str, flagged: str, clean: str):
    def run(spark, sf_dir):
        engine = _engine(spark, sf_dir)
        rules = lambda q: [x.rule for x in engine.translate(q)[1]]
        return spark.createDataFrame([(rules(flagged) == [rule], not rules(clean), engine.sql(clean).count())], "flagged boolean, clean boolean, clean_rows long")

    return run


for _name, (_bad, _good, _rows) in LINTS.items():
    QUERIES[f"lint_{_name}"] = _lint(_name.upper().partition("_")[0], _bad, _good)
    ORACLES[f"lint_{_name}"] = f"SELECT true AS flagged, true AS clean, ({_rows})::BIGINT AS clean_rows"


# calendar windows
_DAY = "INTERVAL 1 DAY"
_NOW = f"TIMESTAMP '{AS_OF}'"
_BOUNDS = {"yesterday": (f"date_trunc('day', {_NOW}) - {_DAY}", f"date_trunc('day', {_NOW})"), "today": (f"date_trunc('day', {_NOW})", f"date_trunc('day', {_NOW}) + {_DAY}"),
           "last 7 days": (f"{_NOW} - INTERVAL 7 DAY", _NOW), "last 2 weeks": (f"{_NOW} - INTERVAL 14 DAY", _NOW), "past 12 hours": (f"{_NOW} - INTERVAL 12 HOUR", _NOW),
           "2024-01-05 to 2024-01-12": ("TIMESTAMP '2024-01-05'", "TIMESTAMP '2024-01-13'")}
for _unit in ("week", "month", "quarter", "year"):
    _start, _step = f"date_trunc('{_unit}', {_NOW})", "INTERVAL 3 MONTH" if _unit == "quarter" else f"INTERVAL 1 {_unit.upper()}"
    _BOUNDS |= {f"this {_unit}": (_start, f"{_start} + {_step}"), f"last {_unit}": (f"{_start} - {_step}", _start)}


@_registered(" UNION ALL ".join(f"SELECT '{p}' AS phrase, count(*) AS n FROM events WHERE ts >= {a} AND ts < {b}" for p, (a, b) in _BOUNDS.items()))
def calendar_windows(spark, sf_dir):
    parts = [f"SELECT '{p}' AS phrase, COUNT(*) AS n FROM events WHERE {time_window(p)}" for p in _BOUNDS]
    return _engine(spark, sf_dir).sql(" UNION ALL ".join(parts))


# gates over records made of events: each defect comes with its own numbers
_PARTS = [gates.Table("events", {"value": gates.NONADDITIVE, "user_id": gates.IDENTIFIER, "at": gates.EPOCH}, [("exclude_flag", "is_test")])]
_DEFECTS = {"output_style_violation": 5, "literal_mismatch": 7, "role_violation": 11, "instruction_violation": 13, "style_truth_violation": 17, "phrase_violation": 19, "hidden_epoch_unit": 23}


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = lambda gate: F.col("event_id") % _DEFECTS[gate] == 0
    pick = lambda gate, bad, good: F.when(every(gate), bad).otherwise(good)
    literal = F.concat(F.lit("'"), pick("literal_mismatch", "refund", F.col("event_type")), F.lit("'"))
    unit = pick("hidden_epoch_unit", ", MAX(MILLIS_TO_TIMESTAMP(at * 1000))", "")
    sql = F.concat(F.lit("SELECT "), pick("role_violation", "SUM(value)", "AVG(value)"), unit, F.lit(" FROM events WHERE event_type = "), literal,
                   pick("instruction_violation", "", " AND is_test = 0"), pick("output_style_violation", ";", ""))
    question = F.concat(F.lit("What is the typical "), pick("style_truth_violation", "value", "amount"), F.lit(" of "), F.col("event_type"), pick("phrase_violation", " events yesterday", " events"))
    return _table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("split"), question.alias("question"), sql.alias("sql"), F.lit("columns: value, at BIGINT").alias("prompt"),
                                                  F.lit("business").alias("style"), F.array(F.lit("value")).alias("answer_columns"), (F.col("event_id") % 29 == 0).alias("unanswerable"))


@_registered("SELECT event_type AS split, " + ", ".join(f"count(*) FILTER (event_id % {k} = 0 AND event_id % 29 <> 0) AS {c}" for c, k in _DEFECTS.items()) + " FROM events GROUP BY 1")
def suite_must_be_zero(spark, sf_dir):
    return suite.must_be_zero(_records(spark, sf_dir), _PARTS)


def _gate(counter: str):
    return lambda spark, sf_dir: suite.judged(_records(spark, sf_dir), _PARTS, [counter]).where(counter).select("event_id")


for _name, _counter in (("g0", "output_style_violation"), ("g3", "literal_mismatch"), ("g5", "role_violation"), ("g6", "instruction_violation"), ("g7", "style_truth_violation"), ("g8", "phrase_violation"),
                        ("g10", "hidden_epoch_unit")):
    QUERIES[f"gate_{_name}"] = _gate(_counter)
    ORACLES[f"gate_{_name}"] = f"SELECT event_id FROM events WHERE event_id % {_DEFECTS[_counter]} = 0 AND event_id % 29 <> 0"


@_registered("SELECT event_type AS kind, event_type <> 'click' AS executes, event_type NOT IN ('click', 'error') AS grounded FROM (SELECT DISTINCT event_type FROM events)")
def gate_g1_g2(spark, sf_dir):
    """A query per type of events: that of clicks has an unknown column, that of errors reads a table not given."""
    engine = _engine(spark, sf_dir)
    rows = []
    for kind in sorted(r[0] for r in engine.sql("SELECT DISTINCT event_type FROM events").collect()):
        sql = f"SELECT COUNT(*) AS n FROM {'orders' if kind == 'error' else 'events'}" + (" WHERE nope = 1" if kind == "click" else "")
        rows.append((kind, not gates.g1_executes(engine, sql), not gates.g2_grounded(engine, sql, {"events"})))
    return spark.createDataFrame(rows, "kind string, executes boolean, grounded boolean")


#: query -> epoch columns whose unit it relies on, and tables it reads
_UNITS = {
    "bracketed": ("SELECT AVG((s_end) - (e_ms)) AS x FROM encoded WHERE s_end IS NOT NULL", "e_ms,s_end", "encoded"),
    "cast": ("SELECT CAST(s_end AS BIGINT) - CAST(e_ms AS BIGINT) AS x FROM encoded", "e_ms,s_end", "encoded"),
    "aliased": ("SELECT q.a - q.b AS x FROM (SELECT s_end AS a, e_ms AS b FROM encoded) q", "e_ms,s_end", "encoded"),
    "scaled": ("WITH w AS (SELECT (e_s + 1) AS moment FROM encoded) SELECT MILLIS_TO_TIMESTAMP(moment * 1000) AS x FROM w", "e_s", "encoded"),
    "moment": ("SELECT COUNT(*) AS n FROM encoded WHERE e_s BETWEEN 800000000 AND 900000000", "e_s", "encoded"),
    "one_column": ("SELECT e_ms - 5 AS x, e_s + o_custkey AS y FROM encoded", "", "encoded"),
    "named_like_a_table": ("SELECT o.o_custkey AS part, COUNT(*) AS nation FROM orders o GROUP BY 1", "", "orders"),
    "nested": ("SELECT c_custkey FROM customer part WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE EXISTS (SELECT 1 FROM region WHERE r_regionkey = n_regionkey))", "", "customer,nation,region"),
}


@_registered(" UNION ALL ".join(f"SELECT '{k}' AS name, '{u}' AS units, '{t}' AS tables" for k, (_, u, t) in _UNITS.items()))
def gate_plan_walks(spark, sf_dir):
    engine = _engine(spark, sf_dir)
    parts = [gates.Table("encoded", dict.fromkeys(("e_ms", "e_s", "s_end"), gates.EPOCH))]
    rows = [(k, ",".join(sorted(gates.epoch_arithmetic(engine, q, parts))), ",".join(sorted(plans.tables_read(engine, q)))) for k, (q, _, _) in _UNITS.items()]
    return spark.createDataFrame(rows, "name string, units string, tables string")


#: window -> a query that has it
_SCOPED = {"none": "SELECT COUNT(*) AS n FROM events", "explicit_range": f"SELECT COUNT(*) AS n FROM events WHERE {time_window('2024-01-05 to 2024-01-12')}"}
_SCOPED |= {k: f"SELECT COUNT(*) AS n FROM events WHERE {time_window(p)}" for k, p in (("rolling", "last 7 days"), ("day", "yesterday"), ("this_period", "this week"), ("last_period", "last week"))}
_PHRASES = {"explicit_range": "2024-01-05 to 2024-01-12", "rolling": "last 7 days", "day": "yesterday", "this_period": "this week", "last_period": "last week"}


@_registered(" UNION ALL ".join(f"SELECT '{k}' AS scope, true AS honoured, count(*) AS n FROM events" + (f" WHERE ts >= {_BOUNDS[_PHRASES[k]][0]} AND ts < {_BOUNDS[_PHRASES[k]][1]}" if k in _PHRASES else "") for k in _SCOPED))
def gate_spec(spark, sf_dir):
    engine = _engine(spark, sf_dir)
    others = lambda k: [s for s, q in _SCOPED.items() if s != k and not suite.spec_scope(k, q)]
    # a last period also begins like a period of its own
    alike = {"this_period": ["last_period"]}
    rows = [(k, not suite.spec_scope(k, q) and set(others(k)) <= set(alike.get(k, [])), engine.sql(q).first().n) for k, q in _SCOPED.items()]
    return spark.createDataFrame(rows, "scope string, honoured boolean, n long")


@_registered("SELECT true AS plain_ok, true AS applied_found, true AS column_ok, true AS column_missing, count(*) AS n FROM events WHERE event_type = 'click' AND value > 50")
def gate_decoy(spark, sf_dir):
    engine, glossary = _engine(spark, sf_dir), [{"term": "heavy use", "column": "value", "numbers": [50], "shape": "threshold"}]
    plain, applied = "SELECT COUNT(*) AS n FROM events", """SELECT COUNT(*) AS n FROM events WHERE event_type = 'click' AND "value" > 50"""
    found = any(p.startswith("DECOY") for p in suite.decoy("active", "how active are people", applied, glossary))
    column = suite.decoy("click", "how many click events", "SELECT COUNT(*) AS n FROM events WHERE event_type = 'click'", glossary, "event_type", "click")
    missing = suite.decoy("click", "how many click events", plain, glossary, "event_type", "click")
    return spark.createDataFrame([(not suite.decoy("active", "how active are people", plain, glossary), found, not column, bool(missing), engine.sql(applied).first().n)],
                                 "plain_ok boolean, applied_found boolean, column_ok boolean, column_missing boolean, n long")


@_registered("SELECT event_type AS id, event_type = 'click' AS exec_found, event_type = 'error' AS trap_found, event_type = 'signup' AS rows_found FROM (SELECT DISTINCT event_type FROM events)")
def suite_runner(spark, sf_dir):
    """A record per type of events; three types carry a defect each."""
    engine, out = _engine(spark, sf_dir), []
    for kind in sorted(r[0] for r in engine.sql("SELECT DISTINCT event_type FROM events").collect()):
        sql = f"SELECT COUNT(*) AS n FROM events WHERE event_type = '{kind}'" + (" AND nope = 1" if kind == "click" else "")
        sql = f"SELECT event_id FROM events WHERE event_type = '{kind}' AND 1 = 0" if kind == "signup" else sql
        naive = sql if kind == "error" else "SELECT COUNT(*) AS n FROM events"
        problems = suite.run_expectations(engine, {"sql": sql, "expect_rows": True, "must_contain": [kind], "trap": {"naive_sql": naive, "expect": "DIFFERENT"}}, 300)
        out.append((kind, *[any(p.startswith(w) for p in problems) for w in ("EXEC", "TRAP", "ROWS")]))
    return spark.createDataFrame(out, "id string, exec_found boolean, trap_found boolean, rows_found boolean")


def _seeds(spark: SparkSession, sf_dir: str) -> list:
    """Three engines, each with every third event under the same name."""
    from ..engine import Engine

    events, out = _table(spark, sf_dir, "events"), []
    for k in range(3):
        engine = Engine(spark, AS_OF)
        engine.register("events", events.where(F.col("event_id") % 3 == k), "ts")
        out.append(engine)
    return out


@_registered("""SELECT event_type AS id, event_type <> 'click' AS valid, event_type <> 'click' AS grounded, event_type NOT IN ('click', 'error') AS result_match,
  (SELECT count(DISTINCT event_id % 3) FROM events x WHERE x.event_type = e.event_type) < 2 AS unscorable FROM (SELECT DISTINCT event_type FROM events) e""")
def suite_predictions(spark, sf_dir):
    """A question per type of events; the prediction for clicks doesn't run, that for errors counts something else."""
    seeds = _seeds(spark, sf_dir)
    kinds = sorted(r[0] for r in seeds[0].sql("SELECT DISTINCT event_type FROM events").collect())
    gold = [{"id": k, "sql": f"SELECT user_id, COUNT(*) AS n FROM events WHERE event_type = '{k}' GROUP BY 1", "tables": ["events"]} for k in kinds]
    wrong = {"click": "SELECT nope FROM events", "error": "SELECT user_id, COUNT(*) + 1 AS n FROM events WHERE event_type = 'error' GROUP BY 1"}
    predictions = {k: f"```sql\n{wrong.get(k, f'''SELECT COUNT(event_id) AS c, user_id AS u FROM events WHERE LOWER(event_type) = '{k}' GROUP BY user_id''')}\n```" for k in kinds}
    return suite.judge_predictions(seeds, gold, predictions).select("id", "valid", "grounded", "result_match", "unscorable")


@_registered("""SELECT DISTINCT event_id % 3 AS residue, 'rows on 1 of 3 seeds' AS problem FROM events""")
def suite_revalidation(spark, sf_dir):
    """A record per seed that has rows on that seed alone, and one that has rows on all, which passes."""
    seeds = _seeds(spark, sf_dir)
    records = [{"id": str(k), "sql": f"SELECT event_id FROM events WHERE event_id - (event_id / 3) * 3 = {k}"} for k in range(3)] + [{"id": "9", "sql": "SELECT COUNT(*) AS n FROM events"}]
    return spark.createDataFrame([(int(i), p) for i, p in suite.revalidate(seeds, records)], "residue long, problem string")


@_registered("""SELECT event_type AS id, event_type NOT IN ('click', 'error') AND count(DISTINCT event_id % 3) >= 2 AS agree FROM events GROUP BY 1""")
def gate_g4(spark, sf_dir):
    """A question per type of events on three seeds of one catalog: the second query of clicks adds a millionth and a half, that of errors fails, those of the others rounding errors."""
    engine, out = _engine(spark, sf_dir), []
    for k in range(3):
        engine.register(f"events_{k}", _table(spark, sf_dir, "events").where(F.col("event_id") % 3 == k), "ts")
    seeds = [{"events": f"events_{k}"} for k in range(3)]
    for kind in sorted(r[0] for r in engine.sql("SELECT DISTINCT event_type FROM events").collect()):
        first = f"SELECT user_id, COUNT(*) * 1e12 AS n FROM events WHERE event_type = '{kind}' GROUP BY 1"
        factor = "1000000000000 * 1.0000015" if kind == "click" else "1000000000000 * 1.0000000003"
        second = f"SELECT COUNT({'nope' if kind == 'error' else 'event_id'}) * {factor} AS c, user_id AS u FROM events WHERE event_type = '{kind}' GROUP BY user_id"
        out.append((kind, not suite.g4_agreement(engine, first, second, seeds, timeout_seconds=300)))
    return spark.createDataFrame(out, "id string, agree boolean")


@_registered(f"SELECT event_id, floor((epoch({_NOW}) - floor(epoch(ts))) / 86400)::BIGINT AS age, floor((epoch({_NOW}) - floor(epoch(ts))) / 86400) > 14 AS stale FROM events")
def suite_stale_anchor(spark, sf_dir):
    ts, now = F.col("ts").cast("timestamp"), F.lit(AS_OF).cast("timestamp")
    return _table(spark, sf_dir, "events").select("event_id", suite.anchor_age(ts, now).alias("age"), suite.is_stale(ts, now).alias("stale"))


@_registered("""SELECT event_type, min(CASE WHEN r = n // 2 THEN k END) AS p50, min(CASE WHEN r = floor(n * 95 / 100.0)::BIGINT THEN k END) AS p95, max(k) AS maximum FROM (
  SELECT event_type, user_id AS k, row_number() OVER (PARTITION BY event_type ORDER BY user_id) - 1 AS r, count(*) OVER (PARTITION BY event_type) AS n FROM events) GROUP BY 1""")
def curation_order_statistics(spark, sf_dir):
    return curation.order_statistics(_table(spark, sf_dir, "events"), "user_id", "event_type")


_TARGET, _CAP = 200, 6


def _draw_step(c: int, before: str) -> str:
    """SQL of one cluster's draw, ``before`` being all rows drawn so far: within the schemas' room, then any."""
    return f"""
 w{c} AS (SELECT least((SELECT quota FROM s WHERE nth = {c}) + {f"(SELECT short FROM e{c - 1})" if c > 1 else "0"}, {_TARGET} - (SELECT count(*) FROM {before})) AS want),
 r{c} AS (SELECT o, schema FROM f WHERE role = (SELECT role FROM s WHERE nth = {c}) AND o NOT IN (SELECT o FROM {before})),
 p{c} AS (SELECT o, schema FROM (SELECT *, row_number() OVER (PARTITION BY schema ORDER BY o) AS k FROM r{c}) x
   WHERE k <= {_CAP} - (SELECT count(*) FROM {before} d WHERE d.schema = x.schema) QUALIFY row_number() OVER (ORDER BY o) <= (SELECT want FROM w{c})),
 q{c} AS (SELECT o, schema FROM r{c} WHERE o NOT IN (SELECT o FROM p{c}) QUALIFY row_number() OVER (ORDER BY o) <= (SELECT want FROM w{c}) - (SELECT count(*) FROM p{c})),
 d{c} AS (SELECT * FROM {before} UNION ALL SELECT * FROM p{c} UNION ALL SELECT * FROM q{c}),
 e{c} AS (SELECT greatest(0, (SELECT quota FROM s WHERE nth = {c}) + {f"(SELECT short FROM e{c - 1})" if c > 1 else "0"} - (SELECT count(*) FROM p{c}) - (SELECT count(*) FROM q{c})) AS short)"""


@_registered(f"""WITH f AS (SELECT *, conv_id * 100000 + turn AS o, conv_id % 40 AS schema FROM conversations WHERE role IN ('user', 'assistant') QUALIFY row_number() OVER (PARTITION BY text ORDER BY conv_id * 100000 + turn) = 1),
 s AS (SELECT role, greatest(1, round({_TARGET} * w / sum(w) OVER ()))::BIGINT AS quota, row_number() OVER (ORDER BY n, role) AS nth FROM (SELECT role, count(*) AS n, CASE role WHEN 'user' THEN 3 ELSE 1 END AS w FROM f GROUP BY 1)),
 d0 AS (SELECT o, schema FROM f WHERE false),{_draw_step(1, "d0")},{_draw_step(2, "d1")},
 h AS (SELECT role, quota, (SELECT count(*) FROM d2 JOIN f USING (o) WHERE f.role = s.role) AS have FROM s),
 top AS (SELECT f.o FROM f JOIN h ON f.role = h.role WHERE f.o NOT IN (SELECT o FROM d2) QUALIFY row_number() OVER (ORDER BY have / quota, f.role, f.o) <= {_TARGET} - (SELECT count(*) FROM d2))
 SELECT conv_id, turn, role FROM f WHERE o IN (SELECT o FROM d2 UNION ALL SELECT o FROM top)""")
def curation_quota_draw(spark, sf_dir):
    rows = _table(spark, sf_dir, "conversations").withColumn("o", F.col("conv_id") * 100_000 + F.col("turn")).withColumn("s", F.col("conv_id") % 40)
    return curation.quota_draw(rows, {"user": 3.0, "assistant": 1.0}, _TARGET, "role", "s", "text", "o").select("conv_id", "turn", "role")


@_registered("""SELECT event_id, event_type FROM events WHERE value > 0
  QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY -ln((('0x' || substr(md5('7:' || event_id), 1, 13))::BIGINT + 1) / 4503599627370496.0::DOUBLE) / value, event_id) <= 50""")
def curation_weighted_draw(spark, sf_dir):
    events = _table(spark, sf_dir, "events")
    return curation.draw_weighted(events, F.col("value"), "event_id", 50, by="event_type", seed=7).select("event_id", "event_type")


#: type of events -> the gate that its record fails
_FAILING = {"click": "G0", "error": "G4", "purchase": "SPEC", "signup": "G10"}


@_registered("SELECT event_type AS id, CASE event_type " + " ".join(f"WHEN '{k}' THEN '{g}'" for k, g in _FAILING.items()) + " ELSE '' END AS gates FROM (SELECT DISTINCT event_type FROM events)")
def gate_runner(spark, sf_dir):
    """A record per type of events through all gates; all but one type carry a defect."""
    engine, out = _engine(spark, sf_dir), []
    for k in range(3):
        engine.register(f"events_{k}", _table(spark, sf_dir, "events").where(F.col("event_id") % 3 == k), "ts")
    tables = [gates.Table("events", {"event_id": gates.EPOCH})]
    for kind in sorted(r[0] for r in engine.sql("SELECT DISTINCT event_type FROM events").collect()):
        measure = "MAX(event_id * 1000)" if kind == "signup" else "COUNT(*)"
        sql = f"""SELECT user_id AS "who", {measure} AS "n" FROM events WHERE event_type = '{kind}' GROUP BY 1"""
        record = {"question": f"How many events of type '{kind}' has each user", "sql": sql + (";" if kind == "click" else ""), "scope": "rolling" if kind == "purchase" else "none", "features": [], "max_words": 12,
                  "other_sql": sql.replace("COUNT(*)", "COUNT(*) + 1" if kind == "error" else "COUNT(user_id)")}
        out.append((kind, ",".join(suite.through_gates(engine, record, tables, [{"events": f"events_{k}"} for k in range(3)], 300))))
    return spark.createDataFrame(out, "id string, gates string")


# sources and sinks
@_registered("SELECT count(*) AS rows, count(*) - count(value) AS null_values, min(ts) AS first_time, max(ts) AS last_time, 0::BIGINT AS malformed FROM events")
def source_verify(spark, sf_dir):
    df = verified(_engine(spark, sf_dir).tables["events"], AS_OF)
    return df.select("rows", F.col("`nulls:value`").alias("null_values"), F.col("first_time").cast("timestamp_ntz").alias("first_time"), F.col("last_time").cast("timestamp_ntz").alias("last_time"), F.col("`malformed:props`").alias("malformed"))


@_registered("SELECT count(*) FILTER (event_id % 25 = 0) AS malformed, count(*) AS rows FROM events")
def source_malformed_json(spark, sf_dir):
    return verified(_engine(spark, sf_dir).tables["dirty"], AS_OF).select(F.col("`malformed:j`").alias("malformed"), "rows")


@_registered("SELECT date_trunc('day', ts) AS day, event_type, count(*) AS n FROM events WHERE event_type <> 'error' GROUP BY 1, 2")
def source_insert_replace(spark, sf_dir):
    """A table written by INSERT, then replaced from itself; it stays in the shared folder, under a name of its own."""
    engine = _engine(spark, sf_dir)
    shared = spark.conf.get("spark.checkpoint.dir", None) or (tempfile.mkdtemp() if spark.sparkContext.master.startswith("local") else None)
    if shared is None:
        raise ValueError("spark.checkpoint.dir is not set")
    name = f"daily_{uuid.uuid4().hex}"
    store = Store(engine, f"{shared}/{name}")
    store.execute(f"INSERT INTO {name} SELECT TIME_FLOOR(__time, 'P1D') AS __time, event_type, COUNT(*) AS n FROM events GROUP BY 1, 2 PARTITIONED BY MONTH CLUSTERED BY event_type")
    store.execute(f"REPLACE INTO {name} OVERWRITE ALL SELECT * FROM {name} WHERE event_type <> 'error' PARTITIONED BY ALL TIME")
    return engine.sql(f"SELECT __time, event_type, n FROM {name}").select(F.col("__time").cast("timestamp_ntz").alias("day"), "event_type", "n")


@_registered("SELECT n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def source_unique_keys(spark, sf_dir):
    nations = require_unique(_table(spark, sf_dir, "nation"), "n_nationkey", "nation")
    return _table(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name").agg(F.count("*").alias("customers"))


_INLINE = "\n".join(json.dumps({"kind": k, "weight": w}) for k, w in (("click", 1), ("error", 5), ("signup", 3)))


@_registered("SELECT event_type, sum(w)::BIGINT AS weight FROM events JOIN (VALUES ('click', 1), ('error', 5), ('signup', 3)) x(kind, w) ON kind = event_type GROUP BY 1")
def source_extern(spark, sf_dir):
    table = f"""TABLE(EXTERN('{json.dumps({"type": "inline", "data": _INLINE})}', '{{"type": "json"}}', '[{{"name": "kind", "type": "string"}}, {{"name": "weight", "type": "long"}}]'))"""
    return _engine(spark, sf_dir).sql(f"SELECT e.event_type, SUM(x.weight) AS weight FROM events e JOIN {table} x ON x.kind = e.event_type GROUP BY 1")
