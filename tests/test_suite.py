"""Suites, scopes, decoys, calendar windows, quotas, and statements that write."""

import itertools
import json
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.dialect.errors import QueryError
from tidemark.engine import Engine
from tidemark.functions.calendar import time_window
from tidemark.operators import curation, gates, suite
from tidemark.sources.store import Store, require_unique, verified


def test_swapped_tables():
    assert suite.swap_tables("SELECT a FROM t JOIN tt ON t.a = tt.a WHERE b = 't'", {"t": "t_1"}) == "SELECT a FROM t_1 JOIN tt ON t_1 . a = tt . a WHERE b = 't'"


def test_scopes():
    day = "SELECT 1 FROM t WHERE " + time_window("yesterday")
    assert not suite.spec_scope("day", day) and suite.spec_scope("none", day) and suite.spec_scope("rolling", day)
    assert not suite.spec_scope("none", "SELECT 1 FROM t") and not suite.spec_scope(None, day)
    assert not suite.spec_scope("last_period", "SELECT 1 FROM t WHERE " + time_window("last quarter"))
    assert suite.spec_scope("explicit_range", day) and not suite.spec_scope("explicit_range", "SELECT 1 FROM t WHERE " + time_window("2024-01-01 to 2024-01-02"))
    assert suite.spec_features({"join", "case"}, {"join"}) == ["SPEC feature 'case' is missing"]
    assert not suite.spec_term("big user", ["big user", "vip"], "how many big users") and len(suite.spec_term("big user", ["vip"], "how many vips")) == 2
    with pytest.raises(ValueError):
        time_window("last fortnight")


def test_decoys():
    terms = [{"term": "vip", "column": "tier", "values": ["gold"], "shape": "equals"}]
    assert not suite.decoy("active", "active people", "SELECT 1 FROM t", terms)
    assert suite.decoy("active", "people", "SELECT 1 AS \"active\" FROM t", terms) == ["SPEC the question lacks the decoy 'active'", "SPEC the plain word 'active' occurs in the query"]
    assert any("DECOY" in p for p in suite.decoy("active", "active people", "SELECT 1 FROM t WHERE tier = 'gold'", terms))
    assert any("term 'vip'" in p for p in suite.decoy("active", "active vips", "SELECT 1 FROM t", terms))
    assert not suite.decoy("gold", "gold people", "SELECT 1 FROM t WHERE metal = 'gold'", [], "metal", "gold")


def test_runner_and_revalidation(spark):
    engines = []
    for k in range(2):
        e = Engine(spark)
        e.register("t", spark.createDataFrame([(k, "x"), (9, "y")], "a int, b string"))
        engines.append(e)
    run = lambda sql, **r: suite.run_expectations(engines[0], {"sql": sql, **r})
    assert run("SELECT a FROM t", expect_rows=True, must_contain=["a"], trap={"naive_sql": "SELECT c FROM t", "expect": "INVALID"}) == []
    assert run("SELECT c FROM t")[0].startswith("EXEC") and run("SELECT a FROM t WHERE a > 99", expect_rows=True)[0].startswith("ROWS")
    assert run("SELECT a FROM t", must_contain=["MAX"])[0].startswith("LINT") and run("SELECT a FROM t", trap={"naive_sql": "SELECT a FROM t", "expect": "DIFFERENT"})[0].startswith("TRAP")
    records = [{"id": "ok", "sql": "SELECT a FROM t"}, {"id": "half", "sql": "SELECT a FROM t WHERE a = 1"}, {"id": "bad", "sql": "SELECT c FROM t"}, {"id": "none", "sql": "", "unanswerable": True}]
    found = dict(suite.revalidate(engines, records))
    assert found["half"] == "rows on 1 of 2 seeds" and found["bad"].startswith("seed 0: INVALID") and set(found) == {"half", "bad"}
    gold = [{"id": "a", "sql": "SELECT a FROM t", "tables": ["t"]}, {"id": "d", "sql": "SELECT a FROM t", "tables": ["t"]}, {"id": "u", "sql": None, "tables": ["t"], "unanswerable": True}, {"id": "absent", "sql": "SELECT 1"}]
    scored = suite.judge_predictions(engines, gold, {"a": "SELECT a AS q FROM t;", "d": "-- CANNOT_ANSWER no column", "u": "-- CANNOT_ANSWER", "other": "x"})
    s = curation.score_predictions(scored)
    assert s["instruction_pct"] is None
    rules = [gates.Table("t", rules=[("exclude_flag", "is_test")])]
    told = [{"id": k, "sql": "SELECT a FROM t", "tables": ["t"], "shown": rules, "question": "which a"} for k in "xy"]
    kept = suite.judge_predictions(engines, told, {"x": "SELECT a FROM t WHERE is_test = 0", "y": "SELECT a FROM t"})
    assert {r.id: r.instructed for r in kept.collect()} == {"x": True, "y": False} and float(curation.score_predictions(kept)["instruction_pct"]) == 50
    assert s["scored_rows"] == 3 and float(s["decline_ok_pct"]) == 100 and float(s["over_decline_pct"]) == 50 and float(s["result_match_pct"]) == 50


def test_counts_that_must_be_zero(spark):
    rows = [("a", "about x", "SELECT COUNT(*) FROM t;", None, None, None, None), ("a", None, "SELECT 1;", None, None, None, None), ("b", "about x", "SELECT 1;", None, None, None, True)]
    df = spark.createDataFrame(rows, "split string, question string, sql string, prompt string, style string, answer_columns array<string>, unanswerable boolean")
    got = {r["split"]: r["output_style_violation"] for r in suite.must_be_zero(df, [gates.Table("t")]).collect()}
    assert got == {"a": 1, "b": 0} and suite.must_be_zero(df.limit(0), []).count() == 0
    engine = Engine(spark)
    engine.register("t", spark.range(1))
    queries = spark.createDataFrame([("a", "SELECT id FROM t", ["t"], None), ("a", "SELECT nope FROM t", ["t"], None), ("a", "SELECT id FROM t", [], None)], "split string, sql string, tables array<string>, unanswerable boolean")
    assert suite.ungrounded(engine, queries) == {"a": 2}


def test_quotas(spark):
    df = spark.range(60).select("id", F.when(F.col("id") < 50, "a").otherwise("b").alias("c"), (F.col("id") % 2).alias("s"), (F.col("id") % 55).alias("q"))
    drawn = curation.quota_draw(df, {"a": 1, "b": 1}, 20, "c", "s", "q", "id").collect()
    assert len(drawn) == 20 and len({r.q for r in drawn}) == 20 and sum(r.c == "b" for r in drawn) == 5
    assert curation.quota_draw(df.limit(0), {"a": 1}, 20, "c", "s", "q", "id").count() == 0


def test_order_statistics(spark):
    df = spark.createDataFrame([("a", v) for v in (5, 1, 1, None, 9)] + [("b", 4)], "g string, v long")
    assert sorted(map(tuple, curation.order_statistics(df, "v", "g").collect())) == [("a", 5, 9, 9), ("b", 4, 4, 4)]


def test_statements(spark, tmp_path):
    engine = Engine(spark, "2024-02-01 00:00:00")
    engine.register("seed", spark.sql("SELECT timestamp '2024-01-01' + make_interval(0, 0, 0, id) AS t, id, if(id % 2 = 0, '{\"a\": 1}', '{\"a\"') AS j FROM range(40)"), "t")
    store = Store(engine, str(tmp_path))
    store.execute("INSERT INTO d SELECT __time, id FROM seed PARTITIONED BY MONTH CLUSTERED BY id")
    assert store.execute("SELECT COUNT(*) AS n FROM d").first().n == 40 and engine.tables["d"].columns == ["__time", "id"]
    with pytest.raises(QueryError, match="exists already"):
        store.execute("INSERT INTO d SELECT id FROM seed PARTITIONED BY ALL")
    with pytest.raises(QueryError):
        store.execute("REPLACE INTO d OVERWRITE ALL SELECT nope FROM d PARTITIONED BY ALL TIME")
    store.execute("REPLACE INTO d OVERWRITE ALL SELECT * FROM d WHERE id < 10 PARTITIONED BY ALL TIME")
    again = Store(Engine(spark), str(tmp_path))
    assert again.execute("SELECT COUNT(*) AS n FROM d").first().n == 10
    again.execute("DROP TABLE d")
    again.execute("DROP TABLE IF EXISTS d")
    assert not Store(Engine(spark), str(tmp_path)).manifest
    for bad in ("DROP TABLE d", "INSERT INTO e SELECT 1 AS x", "REPLACE INTO e SELECT 1 AS x PARTITIONED BY ALL", "INSERT INTO e SELECT 1 AS x PARTITIONED BY DAY", "INSERT INTO e SELECT 1 AS x PARTITIONED BY ALL CLUSTERED BY y"):
        with pytest.raises(QueryError):
            again.execute(bad)
    v = verified(engine.tables["seed"], engine.as_of).first().asDict()
    assert v["rows"] == 40 and v["malformed:j"] == 20 and v["recent"] and not verified(engine.tables["seed"], "2025-01-01").first()["recent"]
    assert require_unique(spark.range(3), "id").count() == 3
    with pytest.raises(ValueError, match="occurs 2 times"):
        require_unique(spark.createDataFrame([(1,), (1,), (None,), (None,)], "k int"), "k")


def test_extern(spark):
    engine = Engine(spark)
    signature = json.dumps([{"name": "a", "type": "long"}])
    table = lambda source, fmt='{"type": "json"}': f"SELECT SUM(x.a) AS s FROM TABLE(EXTERN('{json.dumps(source)}', '{fmt}', '{signature}')) x"
    assert engine.sql(table({"type": "inline", "data": '{"a": 1}\n\n{"a": 2}\n{}'})).first().s == 3
    assert engine.sql(table({"type": "inline", "data": "1\n2"}, '{"type": "csv"}')).first().s == 3
    for bad in (table({"type": "http"}), table({"nothing": 1}), "SELECT 1 AS x FROM TABLE(EXTERN('a', 'b')) x"):
        with pytest.raises(QueryError):
            engine.sql(bad)
    with pytest.raises(Exception):  # noqa: B017
        engine.sql(table({"type": "inline", "data": "no json"})).collect()


def test_quota_draw_matches_a_walk(spark):
    rng = random.Random(3)
    for target, weights in ((30, {"a": 3, "b": 1, "c": 1}), (60, {"a": 1, "b": 9, "x": 2}), (500, {"a": 1, "c": 1})):
        rows = [(i, rng.choice("aaaabcc"), rng.choice("stuv") if rng.random() < 0.9 else None, f"q{rng.randrange(150)}", "k") for i in range(200)]
        df = spark.createDataFrame(rows, "o long, c string, s string, q string, nth string").repartition(3)
        first = {}
        for r in rows:
            if r[1] in weights and r[3] not in first:
                first[r[3]] = r
        rows, cap = list(first.values()), max(4, round(target * 0.03))
        sizes = Counter(r[1] for r in rows)
        quota = {c: max(1, round(target * weights[c] / sum(weights[x] for x in sizes))) for c in sizes}
        out, had, have, short = [], Counter(), Counter(), 0
        for c in sorted(sizes, key=lambda c: (sizes[c], c)):
            want, got = min(quota[c] + short, target - len(out)), 0
            for relaxed in (False, True):
                for r in rows:
                    if r[1] == c and r not in out and got < want and (relaxed or had[r[2]] < cap):
                        out.append(r)
                        had[r[2]] += 1
                        got += 1
            have[c], short = got, max(0, quota[c] + short - got)
        rest = sorted((r for r in rows if r not in out), key=lambda r: (have[r[1]] / quota[r[1]], r[1], r[0]))
        want = sorted(out + rest[: target - len(out)])
        assert sorted(map(tuple, curation.quota_draw(df, weights, target, "c", "s", "q", "o").collect())) == want


def test_pair_caps_match_a_walk(spark):
    rng = random.Random(4)
    rows = [(i * 3, rng.sample("abcdef", rng.randrange(0, 4)) if rng.random() < 0.9 else None, "x") for i in range(150)]
    for share in (0.03, 0.1):
        limit, had, want = max(3, math.ceil(share * len(rows))), Counter(), []
        for r in rows:
            pairs = list(itertools.combinations(sorted(set(r[1] or [])), 2))
            if not any(had[p] >= limit for p in pairs):
                had.update(pairs)
                want.append(r[0])
        df = spark.createDataFrame(rows, "o long, f array<string>, slice string").repartition(4)
        assert sorted(r.o for r in curation.cap_pairs(df, "f", "o", share, slices=5).collect()) == want


def test_weighted_draws(spark):
    df = spark.createDataFrame([(i, 1.0 + 9 * (i % 2), i % 3) for i in range(3000)] + [(5000, 0.0, 0), (5001, None, 0), (5002, float("inf"), 0), (None, 1.0, 0)], "id long, w double, g int")
    draw = curation.draw_weighted(df, F.col("w"), "id", 300)
    ids = {r.id for r in draw.collect()}
    assert len(ids) == 300 and {r.id for r in curation.draw_weighted(df.repartition(5), F.col("w"), "id", 100).collect()} < ids
    assert 0.8 < sum(i % 2 for i in ids) / 300 < 0.98  # ten times the weight
    assert {r["g"]: r["count"] for r in curation.draw_weighted(df, F.col("w"), "id", 7, by="g").groupBy("g").count().collect()} == {0: 7, 1: 7, 2: 7}
    assert {r.id for r in curation.draw_weighted(df, F.col("w"), "id", 300, seed=1).collect()} != ids


def test_working_names_do_not_clash(spark):
    df = spark.createDataFrame([(k, k % 3, "n", "e") for k in range(12)], "o long, key int, nth string, exempted string")
    assert curation.first_of_each(df, F.col("key"), "o").columns == df.columns and curation.first_of_each(df, F.col("key"), "o").count() == 3
    capped = curation.cap_skeletons(df, "key", "o", share=0.1)
    assert capped.columns == df.columns and capped.count() == 6


def test_stores_keep_each_others_tables(spark, tmp_path):
    a, b = Store(Engine(spark), f"{tmp_path}/s"), Store(Engine(spark), f"{tmp_path}/s")
    a.insert("x", spark.range(3))
    b.insert("y", spark.range(4))
    a.insert("z", spark.range(5))
    assert set(Store(Engine(spark), f"{tmp_path}/s").manifest) == {"x", "y", "z"}
    b.drop("y")
    assert set(Store(Engine(spark), f"{tmp_path}/s").manifest) == {"x", "z"}
