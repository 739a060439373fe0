"""What the dialect accepts, rejects and flags."""

import pytest

from tidemark.dialect.errors import QueryError
from tidemark.plans.catalogue import engine_for

DATA = "/root/testdata/sf0.001"

REJECTED = [
    ("C1", 'SELECT * FROM events ORDER BY "value" DESC', "requires ordering a table by non-time column [[value]]"),
    ("C1", 'SELECT event_id FROM events ORDER BY 1 LIMIT 10', "which is not supported"),
    ("C1", 'SELECT * FROM (SELECT __time, event_id FROM events) ORDER BY event_id', "non-time column"),
    ("C4", "SELECT COUNT(*) AS count FROM events", "must be quoted"),
    ("C4", "SELECT TIME_FLOOR(__time, 'P1D') AS day FROM events", "must be quoted"),
    ("C4", "SELECT AVG(value) AS a FROM events", "must be quoted"),
    ("C5", "SELECT COUNT(*) AS n FROM events WHERE __time > TIMESTAMP '2024-01-01T00:00:00Z'", "yyyy-MM-dd HH:mm:ss"),
    ("C6", "SELECT NOW() AS t FROM events", "NOW"),
    ("C6", "SELECT IF(user_id > 1, 1, 0) AS x FROM events", "IF"),
    ("C6", "SELECT STDDEV(user_id) AS x FROM events", "STDDEV"),
    ("C6", "SELECT COUNT(*) AS n FROM events WHERE event_type ILIKE 'c%'", "ILIKE"),
    ("C7", "SELECT t.x AS x FROM part, UNNEST(STRING_TO_MV(p_name, ' ')) AS t(x)", "UNNEST"),
    ("C7", "SELECT t.x AS x FROM tagged, UNNEST(tags) AS t(x)", "UNNEST"),
    ("C8", "SELECT MV_TO_ARRAY(STRING_TO_MV(p_name, ' ')) AS x FROM part", "bare column"),
    ("C9", "SELECT MAX(event_type) AS m FROM events", "does not support type [STRING]"),
    ("C9", "SELECT MAX(LOWER(event_type)) AS m FROM events", "does not support type [STRING]"),
    ("C9", "SELECT MIN(x) AS m FROM (SELECT event_type AS x FROM events) q", "does not support type [STRING]"),
    ("TYPE", "SELECT TIME_EXTRACT(__time, 'FORTNIGHT') AS x FROM events", "FORTNIGHT"),
    ("C10", "SELECT LOOKUP(event_type, 'nope') AS x FROM events", "Lookup [nope] not found"),
    ("C11", "SELECT TIME_FLOOR(event_id, 'P1D') AS x FROM events", "Cannot apply 'TIME_FLOOR'"),
    ("C11", "SELECT TIME_FORMAT(s_iso, 'yyyy') AS x FROM encoded", "Cannot apply 'TIME_FORMAT'"),
    ("C12", "SELECT TOP 5 event_id FROM events", "TOP"),
    ("C12", "SELECT DISTINCT ON (user_id) user_id FROM events", "ON"),
    (None, "SELECT TIME_FLOOR(__time, 'P1D') AS d, COUNT(*) AS n FROM events GROUP BY d", "Column 'd' not found"),
    (None, "SELECT user_id, COUNT(*) AS n FROM events GROUP BY 1 ORDER BY event_type", "Expression 'event_type' is not being grouped"),
    (None, "SELECT MAX(SUM(user_id)) AS m FROM events GROUP BY event_type", "nested"),
    (None, "SELECT nope FROM events", "Column 'nope' not found"),
    (None, "SELECT 1 AS x FROM missing", "Object 'missing' not found"),
    (None, "SELECT 1; SELECT 2", "one statement"),
    (None, "SELECT FROB(user_id) AS x FROM events", "FROB"),
]

ACCEPTED = [
    "SELECT __time, event_id FROM events ORDER BY __time DESC LIMIT 5;",
    'SELECT __time AS "t", event_id FROM events ORDER BY 1 LIMIT 5',
    "SELECT c.c_custkey FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey ORDER BY c.c_custkey LIMIT 3",
    'SELECT user_id, COUNT(*) AS "count" FROM events GROUP BY 1 HAVING "count" > 1 ORDER BY "count"',
    "SELECT DISTINCT event_type FROM events ORDER BY event_type",
    "SELECT user_id, event_type FROM events GROUP BY user_id, event_type ORDER BY event_type LIMIT 2",
    "SELECT CAST(__time AS DATE) AS d, CAST(user_id AS VARCHAR) AS u FROM events LIMIT 1",
    "SELECT TABLE_NAME FROM INFORMATION_SCHEMA.TABLES",
    "SELECT event_type, SUM(CASE WHEN user_id IN (SELECT c_custkey FROM customer) THEN 1 ELSE 0 END) AS n FROM events GROUP BY 1",
    "-- a comment\nSELECT COUNT(*) AS n /* all */ FROM events",
]


@pytest.fixture(scope="module")
def engine(spark):
    return engine_for(spark, DATA)


@pytest.mark.parametrize(("rule", "query", "part"), REJECTED)
def test_rejected(engine, rule, query, part):
    with pytest.raises(QueryError) as e:
        engine.sql(query)
    assert part in str(e.value) and rule in (None, e.value.rule)


@pytest.mark.parametrize("query", ACCEPTED)
def test_accepted(engine, query):
    engine.sql(query).collect()


def test_lints(engine):
    lints = lambda q: [x.rule for x in engine.translate(q)[1]]
    assert lints("SELECT JSON_VALUE(props, '$.k') AS k FROM events") == ["L1"]
    assert lints("SELECT JSON_VALUE(p.j, '$.k') AS k FROM (SELECT PARSE_JSON(props) AS j FROM events) p") == []
    assert lints("SELECT MILLIS_TO_TIMESTAMP(e_s) AS t FROM encoded") == ["L2"]
    assert lints("SELECT MILLIS_TO_TIMESTAMP(e_s * 1000) AS t FROM encoded") == []
    assert lints("SELECT COUNT(*) AS n FROM encoded WHERE s_iso BETWEEN TIMESTAMP '2000-01-01' AND TIMESTAMP '2001-01-01'") == ["L3"]


def test_session_is_left_alone(spark, engine):
    assert spark.conf.get("spark.sql.groupByAliases") == "true"
    assert "events" not in [t.name for t in spark.catalog.listTables()]


def test_time_functions_fold_to_built_ins(engine):
    plan = engine.sql("SELECT TIME_FLOOR(__time, 'P1D') AS d, COUNT(*) AS n FROM events WHERE __time >= TIMESTAMP '2024-01-20' GROUP BY 1")._jdf.queryExecution().toString()
    assert "date_trunc(DAY" in plan and "GreaterThanOrEqual(ts" in plan and "ReadSchema: struct<ts:timestamp_ntz>" in plan


def test_periods(engine):
    one = lambda e: engine.sql(f"SELECT {e} AS x").first()[0]
    text = lambda e: one(f"TIME_FORMAT({e}, 'yyyy-MM-dd HH:mm:ss')")
    t = "TIMESTAMP '2024-03-31 13:47:09'"
    assert text(f"TIME_FLOOR({t}, 'P3M')") == "2024-01-01 00:00:00"
    assert text(f"TIME_FLOOR({t}, 'P2M')") == "2024-03-01 00:00:00"
    assert text(f"TIME_FLOOR({t}, 'PT30M')") == "2024-03-31 13:30:00"
    assert text(f"TIME_FLOOR({t}, 'P1W')") == "2024-03-25 00:00:00"
    assert text(f"TIME_CEIL({t}, 'PT6H')") == "2024-03-31 18:00:00"
    assert text(f"TIME_SHIFT({t}, 'P1M', -1)") == "2024-02-29 13:47:09"
    assert text(f"TIME_SHIFT({t}, 'PT15M', 2)") == "2024-03-31 14:17:09"
    assert one(f"TIME_EXTRACT({t}, 'DOW')") == 7 and one("7 / 2") == 3 and one("7 / 2.0") == 3.5
    assert text("TIME_PARSE('2024-01-01T09:00:00Z')") == "2024-01-01 09:00:00" and one("TIME_PARSE('nope')") is None
    assert text("TIME_PARSE('2024-01-01 09:00', 'yyyy-MM-dd HH:mm', 'Asia/Tokyo')") == "2024-01-01 00:00:00"


def test_lookups_of_many_keys_are_one_join(engine):
    text, _ = engine.translate("SELECT LOOKUP(CAST(o_custkey AS VARCHAR), 'customers', 'none') AS s, COUNT(*) AS n FROM orders WHERE LOOKUP(CAST(o_custkey AS VARCHAR), 'customers') = 'BUILDING' GROUP BY 1")
    assert text.count("LEFT JOIN") == 1 and "max ( v )" not in text
    two, _ = engine.translate("SELECT LOOKUP(CAST(o_custkey AS VARCHAR), 'customers') AS a, LOOKUP(o_orderstatus, 'customers') AS b FROM orders")
    assert two.count("LEFT JOIN") == 2
    plan = engine.spark.sql(text)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1
    with pytest.raises(QueryError, match="subquery"):
        engine.sql("SELECT LOOKUP(CAST(MAX(o_custkey) AS VARCHAR), 'customers') AS s FROM orders")


@pytest.mark.parametrize("query, rule", [
    ("SELECT TIME_FLOOR(q.a, 'P1D') AS x FROM (SELECT CONCAT(event_type, 'x') AS a FROM events) q", "C11"),
    ("SELECT x FROM (SELECT TIME_FORMAT(CAST(__time AS VARCHAR), 'yyyy') AS x FROM events) q", "C11"),
    ("SELECT TIME_EXTRACT(event_id * 2, 'HOUR') AS x FROM events", "C11"),
    ("WITH w AS (SELECT p_name AS n FROM part) SELECT t.x AS x FROM w, UNNEST(w.n) AS t(x)", "C7"),
    ("SELECT t.x AS x FROM tagged, UNNEST(MV_FILTER_ONLY(tags, ARRAY['red'])) AS t(x)", "C7"),
])
def test_types_are_judged_before_execution(engine, query, rule):
    with pytest.raises(QueryError) as e:
        engine.translate(query)
    assert e.value.rule == rule


def test_null_values_of_lookups_stay_null(engine):
    engine.register_lookup("gaps", {"click": None, "error": "E"})
    assert {r.v for r in engine.sql("SELECT LOOKUP(event_type, 'gaps') AS v FROM events GROUP BY 1").collect()} == {None, "E"}
