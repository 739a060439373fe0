"""Harness, sources, canonical results and curation."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.dialect.errors import QueryError
from tidemark.engine import Engine, join_lookup
from tidemark.operators import canonical, curation, harness
from tidemark.plans.catalogue import engine_for
from tidemark.sources.spec import SpecError, parse_spec, read_seed
from tidemark.sources.store import Store, extern_table

DATA = "/root/testdata/sf0.001"
COLUMNS = [{"name": "at", "type": "string", "is_time": True}, {"name": "n", "type": "long"}, {"name": "s", "type": "string", "nullable": True}]


@pytest.fixture(scope="module")
def engine(spark):
    return engine_for(spark, DATA)


def test_batch_summary_and_diff(engine):
    records = [
        {"id": "a", "query": "SELECT COUNT(*) AS n FROM events"},
        {"id": "b", "query": "SELECT NOW() AS t FROM events", "expected_status": "INVALID", "expected_error_substring": "NOW"},
        {"id": "c", "query": "SELECT nope FROM events", "expected_status": "INVALID", "expected_error_pattern": "^Other"},
        {"id": "d", "query": "SELECT 1 AS x", "expected_status": "INVALID", "expected_error_substring": "x"},
        {"id": "e", "query": "SELECT 1 AS x", "expected_status": "VALID"},
    ]
    results = harness.run_batch(engine, records)
    assert [r["id"] for r in results] == list("abcde")
    assert [r["status"] for r in results] == ["VALID", "INVALID", "INVALID", "VALID", "VALID"]
    assert [r.get("assertion_passed") for r in results] == [None, True, False, False, False]
    frame = harness.as_frame(engine, results)
    s = harness.summarize(frame)
    assert (s["total"], s["valid"], s["invalid"], s["assertions"], s["assertion_failures"]) == (5, 3, 2, 4, 3) and len(s["error_patterns"]) == 2
    assert [r.id for r in harness.report(frame).collect()][:2] in (["b", "c"], ["c", "b"])
    other = [dict(r) for r in results if r["id"] != "e"]
    other[0]["status"] = "INVALID"
    got = {r.id: (r.status_a, r.status_b) for r in harness.diff_runs(frame, harness.as_frame(engine, other)).collect()}
    assert got == {"a": ("VALID", "INVALID"), "e": ("VALID", "(missing)")}


def test_timeout(engine):
    slow = "SELECT COUNT(*) AS n FROM lineitem a JOIN lineitem b ON a.l_quantity < b.l_quantity JOIN lineitem c ON b.l_quantity < c.l_quantity JOIN lineitem d ON c.l_quantity < d.l_quantity"
    assert harness.validate_query(engine, slow, timeout_seconds=2).status == "TIMEOUT"


def test_sample_is_bounded(engine):
    r = harness.validate_query(engine, "SELECT event_id FROM events", max_rows=7)
    assert len(r.sample) == 7 and r.row_count == 1000


@pytest.mark.parametrize("raw", [{}, {"name": "x"}, {"name": "x", "columns": []}, {"name": "x", "columns": COLUMNS[1:], "seed": {"mode": "generate", "row_count": 1}},
                                 {"name": "x", "columns": COLUMNS, "seed": {"mode": "generate", "row_count": 0}}, {"name": "x", "columns": COLUMNS, "seed": {"mode": "file", "path": "p", "format": "avro"}}])
def test_bad_specs(raw):
    with pytest.raises(SpecError):
        parse_spec(raw)


def test_generated_rows_repeat(spark):
    spec = parse_spec({"name": "g", "columns": COLUMNS, "seed": {"mode": "generate", "row_count": 50, "random_seed": 1}})
    a, b = read_seed(spark, spec).collect(), read_seed(spark, spec).collect()
    assert a == b and len(a) == 50 and a[1]["__time"].minute == 1 and all(0 <= r.n <= 1000 and r.s.startswith("s_") for r in a)


@pytest.mark.parametrize(("fmt", "text"), [("csv", "at,n,s\n2024-01-01 00:00:00,1,x\n2024-01-02T00:00:00Z,2,\n"), ("json", '[{"at": "2024-01-01", "n": 1, "s": "x"}, {"at": "2024-01-02", "n": "2", "s": ""}]'), ("json", '{"at": "2024-01-01", "n": 1, "s": "x"}\n{"at": "2024-01-02", "n": 2}\n')])
def test_seed_files(spark, tmp_path, fmt, text):
    (tmp_path / "f").write_text(text)
    spec = parse_spec({"name": "f", "columns": COLUMNS, "seed": {"mode": "file", "path": "f", "format": fmt}}, str(tmp_path))
    rows = read_seed(spark, spec).collect()
    assert [(r["__time"].day, r.n, r.s) for r in rows] == [(1, 1, "x"), (2, 2, None)]


def test_bad_values_are_errors(spark, tmp_path):
    for bad in ("2024-01-01,x,y", "2024-01-01,,y"):
        (tmp_path / "f").write_text(f"at,n,s\n{bad}\n")
        spec = parse_spec({"name": "f", "columns": COLUMNS, "seed": {"mode": "file", "path": "f", "format": "csv"}}, str(tmp_path))
        with pytest.raises(Exception, match="column n"):
            read_seed(spark, spec).collect()


def test_store(spark, tmp_path):
    engine = Engine(spark)
    store = Store(engine, str(tmp_path / "store"))
    spec = parse_spec({"name": "g", "columns": COLUMNS, "seed": {"mode": "generate", "row_count": 20}})
    assert store.load(spec) and not store.load(spec) and store.load(spec, force=True)
    assert engine.sql("SELECT COUNT(*) AS n FROM g").first().n == 20 and store.verify("g")["rows"] == 20
    with pytest.raises(QueryError):
        store.insert("g", engine.tables["g"])
    extern_table(engine, "x", json.dumps({"type": "inline", "data": '{"a": 1, "t": ["p", "q"]}\n{"a": 2}'}), json.dumps({"type": "json"}), json.dumps([{"name": "a", "type": "long"}, {"name": "t", "type": "array<string>"}]))
    assert [tuple(r) for r in engine.sql("SELECT t, SUM(a) AS s FROM x GROUP BY 1 ORDER BY 1").collect()] == [(None, 2), ("p", 1), ("q", 1)]
    assert engine.drop("g") and not engine.drop("g")


def test_join_lookup(spark):
    df, table = spark.createDataFrame([("a",), ("b",), (None,)], "c string"), spark.createDataFrame([("a", "1"), ("a", "0")], "k string, v string")
    assert sorted((r.c or "", r.value) for r in join_lookup(df, "c", table).collect()) == [("", None), ("a", "0"), ("b", None)]


def test_canonical_results(spark):
    a = spark.sql("SELECT * FROM VALUES (1, '05', true, TIMESTAMP '2024-01-01'), (2, 'x', false, null) AS t(a, b, c, d)")
    b = spark.sql("SELECT * FROM VALUES ('x', 0, CAST(null AS STRING), 2.0000001D), ('5.0', 1, '2024-01', 1.0D) AS t(p, q, r, s)")
    assert canonical.results_agree(a, b) and canonical.fingerprint(a) == canonical.fingerprint(b.select("s", "r", "q", "p"))
    assert canonical.results_agree(a, b.withColumn("extra", F.lit(9))) and not canonical.results_agree(a, b.limit(1))
    assert not canonical.results_agree(a, b.withColumn("q", F.lit(1)))


def test_agreement_on_seeds(spark):
    run = lambda q, seed: spark.range(seed).selectExpr(q)
    assert canonical.agree_on_seeds(run, "id + 1 AS x", "1 + id AS y", [3, 5, 0])[0]
    assert not canonical.agree_on_seeds(run, "id + 1 AS x", "id AS y", [3, 5, 0])[0]
    assert not canonical.agree_on_seeds(run, "id AS x", "id AS x", [3, 0, 0])[0]
    assert not canonical.agree_on_seeds(run, "id AS x", "id AS x", [30, 30, 30], max_rows=10)[0]


def test_skeleton_features_unwrap(spark):
    sql = "select  a, COUNT(*) FROM t WHERE x = 'lit' AND n > 3.5 -- c"
    q = spark.createDataFrame([(sql,)], "q string").select(curation.skeleton(F.col("q")).alias("s"))
    assert q.first().s == "SELECT ID, COUNT(*) FROM ID WHERE ID = ID AND ID > ID -- ID"
    f = lambda s: spark.createDataFrame([(s,)], "q string").select(curation.features(F.col("q"))).first()[0]
    assert f("SELECT TIME_FLOOR(__time, 'P1D') FROM t WHERE x IS NULL") == ["null_handling", "time_bucket"]
    assert "time_shift" not in f("SELECT 1 FROM t WHERE __time >= TIME_SHIFT(TIME_FLOOR(CURRENT_TIMESTAMP, 'P1W'), 'P1W', -1)")
    assert "subquery" in f("SELECT MAX(n) FROM (SELECT COUNT(*) AS n FROM t)")
    texts = ["```sql\nSELECT 1\n```", "<sql> SELECT 1 </sql>", '{"sql": "SELECT 1"}', '{"query": "SELECT 1"}', "SELECT 1;", "SELECT 1"]
    assert {r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(curation.unwrap(F.col("t"))).collect()} == {"SELECT 1"}
    p = spark.createDataFrame([("how many yesterday", "SELECT TIME_FLOOR(x) - INTERVAL '1' DAY"), ("sales last month", "SELECT TIME_FLOOR(x)")], "q string, s string")
    assert [len(r[0]) for r in p.select(curation.phrase_problems(F.col("q"), F.col("s"))).collect()] == [0, 1]


def brute_near(rows, threshold=0.88):
    import math
    import re
    from collections import Counter

    kept, out = {}, []
    for o, g, q in sorted(rows):
        t = re.findall(r"[a-z0-9_]+", q.lower())
        v = Counter(t) + Counter(zip(t, t[1:]))
        norm = lambda c: math.sqrt(sum(x * x for x in c.values()))
        cos = lambda a, b: sum(n * b[k] for k, n in a.items()) / (norm(a) * norm(b)) if a and b else 0
        if not any(cos(v, w) > threshold for w in kept.get(g, [])):
            kept.setdefault(g, []).append(v)
            out.append(o)
    return out


def test_near_duplicates(spark):
    import random

    rng = random.Random(2)
    words = [f"w{k}" for k in range(12)]
    base = [" ".join(rng.choices(words, k=10)) for _ in range(12)]
    rows = [(k, f"g{k % 2}", " ".join(w if rng.random() > 0.06 else rng.choice(words) for w in rng.choice(base).split())) for k in range(90)] + [(90, "g0", ""), (91, "g0", "")]
    got = curation.drop_near_duplicates(spark.createDataFrame(rows, "o long, g string, q string"), "q", "g", "o")
    assert sorted(r.o for r in got.collect()) == brute_near(rows)


def test_near_duplicates_of_many_copies(spark):
    """100,000 copies of two texts, one of them like the other: no pairs of copies are made."""
    text = F.when(F.col("id") % 2 == 0, "a b c d e f g h i j k l m n o p").otherwise("a b c d e f g h i j k l m n o p p")
    rows = spark.range(100_000).select((F.col("id") + 5).alias("o"), F.lit("g").alias("g"), text.alias("q"), F.lit(1).alias("w"))
    more = spark.createDataFrame([(1, "g", "", 1), (2, "g", None, 1), (3, None, "a b", 1), (None, "g", "a b", 1), (4, None, "a b", 1)], "o long, g string, q string, w int")
    got = curation.drop_near_duplicates(rows.union(more), "q", "g", "o")
    assert sorted((r.o is None, r.o or 0) for r in got.collect()) == [(False, k) for k in (1, 2, 3, 4, 5)] + [(True, 0)]


def test_caps_and_splits(spark):
    df = spark.createDataFrame([(k, f"h{k % 3 if k < 60 else k}", k % 10 == 0, ["a", "b"] if k % 2 else ["c"]) for k in range(100)], "o long, h string, free boolean, f array<string>")
    capped = curation.cap_skeletons(df, "h", "o", share=0.05, exempt=F.col("free"))
    sizes = {r.h: r["count"] for r in capped.where("NOT free").groupBy("h").count().collect()}
    assert max(sizes.values()) <= 3 and capped.where("free").count() == 10
    assert curation.cap_pairs(df, "f", "o", 0.05).where("array_contains(f, 'a')").count() == 5
    assert curation.cap_share(df, F.col("free"), 0.05, 1, "o").where("free").count() == 5
    assert curation.first_of_each(df, F.col("h"), "o").count() == df.select("h").distinct().count()
    s = spark.createDataFrame([("x", "train"), ("x", "test"), ("y", "train")], "family string, split string")
    assert [r.family for r in curation.split_leaks(s, "family", "split").collect()] == ["x"]
    assert sorted(r.id for r in curation.numbered(s, "split", "family").collect()) == ["v2_test_00000", "v2_train_00000", "v2_train_00001"]
    assert curation.without_known(df, df.where("o < 30").select("h"), "h").where("o < 30").count() == 0
    assert {r.family: r.verdict for r in curation.distribution(s, "family", {"x": 65.0, "y": 50.0, "z": 1.0}).collect()} == {"x": "ok", "y": "off", "z": "ok"}


def test_scores(spark):
    rows = [(True, True, True, False, False, False), (True, True, False, False, False, True), (False, False, False, True, False, False), (None, None, None, True, True, None)]
    got = curation.score_predictions(spark.createDataFrame(rows, "valid boolean, grounded boolean, result_match boolean, declined boolean, unanswerable boolean, unscorable boolean"))
    assert (got["valid_pct"], got["result_match_pct"], got["decline_ok_pct"], got["over_decline_pct"], got["unscorable_rows"]) == (66.7, 50.0, 100.0, 33.3, 1)


def _bag(spark, rows, schema="k string, x double, y double"):
    return spark.createDataFrame(rows, schema)


def test_agreement_within_a_tolerance(spark):
    step = 0.9e-6
    one = [("a", 1.0, 5.0), ("a", 1.0 + step, 5.0), ("b", None, 0.0), ("b", float("nan"), 0.0), ("c", 1e12, -1e12)]
    near = [("a", 1.0 + step, 5.0), ("a", 1.0 + 1.8e-6, 5.0), ("b", None, 0.0), ("b", float("nan"), -0.0), ("c", 1e12 + 9e5, -1e12)]
    assert canonical.results_agree(_bag(spark, one), _bag(spark, near))
    far = [("a", 1.0, 5.0), ("a", 1.0 + 2.7e-6, 5.0), *near[2:]]
    found = canonical.mismatches(_bag(spark, one), _bag(spark, far)).collect()
    assert {(r.exact[0], r.n_a, r.n_b) for r in found} == {("=a", 2, 1), ("=a", 0, 1)}
    # as many rows of one level, not all of them near
    wide = [("a", 1.0, 5.0), ("a", 1.0 + step, 5.0), ("a", 1.0 + 2 * step, 5.0)]
    assert not canonical.results_agree(_bag(spark, wide[:1] * 2 + wide[1:2]), _bag(spark, wide[1:2] + wide[2:] * 2)) and canonical.results_agree(_bag(spark, wide), _bag(spark, wide[::-1]))
    # across the borders of ranges and at powers of ten, with rows that differ in several numbers
    edges = [(None, math.expm1(k / 4096) * s, 3.0) for k in (0, 1, 50, 4096, 90000) for s in (1, -1)]
    moved = [(k, v * (1 + 8e-7) + 1e-7, 3.0 - 1e-6) for k, v, _ in edges]
    assert canonical.results_agree(_bag(spark, edges), _bag(spark, moved)) and not canonical.results_agree(_bag(spark, edges), _bag(spark, moved[1:]))
    assert canonical.results_agree(_bag(spark, []), _bag(spark, [])) and not canonical.results_agree(_bag(spark, []), _bag(spark, one))
    # a wider result, its column near, not equal
    assert canonical.results_agree(_bag(spark, [(1.0,)], "p double"), _bag(spark, [("z", 1.0 + step, 9.0)]))
    assert not canonical.results_agree(_bag(spark, [(1.1,)], "p double"), _bag(spark, [("z", 1.0 + step, 9.0)]))


def test_agreement_of_one_number_is_exact(spark):
    rng = random.Random(2)
    for _ in range(3):
        a = [1 + rng.randrange(6) * 0.6e-6 for _ in range(5)]
        b = [x + rng.choice((0, 0.6e-6, 1.2e-6)) for x in a]
        want = all(abs(x - y) <= 1e-6 * max(1, x, y) for x, y in zip(sorted(a), sorted(b)))
        assert canonical.results_agree(_bag(spark, [(x,) for x in a], "x double"), _bag(spark, [(x,) for x in b], "x double")) == want


def test_command_line(spark, tmp_path, capsys):
    spec = {"name": "Made", "columns": COLUMNS, "seed": {"mode": "generate", "row_count": 5, "random_seed": 1}}
    (tmp_path / "spec.json").write_text(json.dumps(spec))
    run = lambda *args: harness.main(["--store", f"{tmp_path}/store", *args])
    said = lambda: capsys.readouterr().out
    assert run("load", f"{tmp_path}/spec.json") == 0 and json.loads(said())["rows"] == 5
    assert run("load", f"{tmp_path}/spec.json") == 1 and run("reload", f"{tmp_path}/spec.json") == 0
    said()
    assert run("list") == 0 and json.loads(said()) == ["made"]
    assert run("inspect", "Made") == 0 and json.loads(said())["rows"] == 5 and run("inspect", "nope") == 1
    assert run("validate", "SELECT COUNT(*) AS n FROM made") == 0 and json.loads(said())["sample"] == [{"n": 5}]
    (tmp_path / "a.jsonl").write_text("\n".join(json.dumps({"id": str(k), "query": q}) for k, q in enumerate(("SELECT COUNT(*) AS n FROM made", "SELECT nope FROM made"))))
    (tmp_path / "b.jsonl").write_text("\n".join(json.dumps({"id": str(k), "query": q}) for k, q in enumerate(("SELECT COUNT(*) AS n FROM gone", "SELECT nope FROM made"))))
    for x in "ab":
        assert run("validate-batch", f"{tmp_path}/{x}.jsonl", "--output", f"{tmp_path}/{x}.out", "--report", f"{tmp_path}/{x}.csv") == 0
    assert (tmp_path / "a.csv").read_text().splitlines()[1].startswith("1,")  # errors first
    assert run("diff", f"{tmp_path}/a.out", f"{tmp_path}/b.out", "--output", f"{tmp_path}/diff.csv") == 0
    lines = (tmp_path / "diff.csv").read_text().splitlines()
    assert lines[0] == "key,id,query,status_a,status_b,error_a,error_b" and len(lines) == 2 and ",VALID,INVALID," in lines[1]
    assert run("drop", "Made") == 0 and run("drop", "Made") == 1
    said()
    assert run("list") == 0 and json.loads(said()) == []
