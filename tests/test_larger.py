"""Results that were right on small tables only."""

import random
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.dialect import tokens
from tidemark.engine import Engine
from tidemark.operators import canonical, curation, gates, likeness, suite

from .test_operators import brute_near


def test_quantiles_of_many_values(spark):
    engine = Engine(spark)
    engine.register("t", spark.range(60_000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7919 % 60_000).cast("double").alias("v"), F.current_timestamp().alias("ts")), "ts")
    got = engine.sql("SELECT g, APPROX_QUANTILE_DS(v, 0.5) AS p50, APPROX_QUANTILE(v, 0.99) FILTER (WHERE v < 30000) AS p99 FROM t GROUP BY 1")
    values = [sorted(i * 7919 % 60_000 for i in range(g, 60_000, 3)) for g in range(3)]
    low = [[v for v in x if v < 30_000] for x in values]
    assert sorted(map(tuple, got.collect())) == [(g, values[g][9_999], low[g][9_899]) for g in range(3)]


def test_agreement_of_large_results(spark):
    engine = Engine(spark)
    for k in range(2):
        engine.register(f"t_{k}", spark.range(25_000).select((F.col("id") * 2 + k).alias("id"), F.current_timestamp().alias("ts")), "ts")
    seeds = [{"t": "t_0"}, {"t": "t_1"}]
    first, other = "SELECT id, COUNT(*) AS n FROM t GROUP BY 1", "SELECT COUNT(id) AS c, id AS i FROM t GROUP BY id"
    assert suite.g4_agreement(engine, first, other, seeds) == []
    assert len(suite.g4_agreement(engine, first, other.replace("COUNT(id)", "COUNT(id) + 1"), seeds)) == 2
    assert suite.g4_agreement(engine, first, other, seeds, max_rows=20_000) == ["G4 seed 0: over 20000 rows", "G4 seed 1: over 20000 rows"]
    assert canonical.agree_on_seeds(lambda q, k: spark.range(25_000).selectExpr(q), "id + 1 AS a", "1 + id AS b", [0, 1])[0]


def test_near_copies_cost_no_square(spark, monkeypatch):
    """1,500 near copies of one text: the pairs of the first span are made, then those with the one that is kept."""
    sizes = []

    def noted(df, real=curation._cut):
        out = real(df)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(curation, "_cut", noted)
    words = F.lit(" ".join(f"word{k}" for k in range(40)))
    rows = spark.range(1_500).select(F.col("id").alias("o"), F.lit("g").alias("g"), F.concat(words, F.lit(" own"), "id").alias("q"))
    assert [r["o"] for r in curation.drop_near_duplicates(rows, "q", "g", "o").collect()] == [0]
    assert max(sizes) < 512 * 511


def test_near_copies_by_spans(spark, monkeypatch):
    rows = [(k, f"g{k % 2}", " ".join(f"w{(k // 10) * 3 + j + (k % 7 == j) * 5}" for j in range(12))) for k in range(90)]
    df = spark.createDataFrame(rows, "o long, g string, q string")
    monkeypatch.setattr(curation, "_spans", lambda some: [4, 20, 21, 60])
    assert sorted(r["o"] for r in curation.drop_near_duplicates(df, "q", "g", "o").collect()) == brute_near(rows)


@pytest.mark.parametrize("cost", [0, 1e9])
def test_near_copies_by_lists_or_blocks(spark, monkeypatch, cost):
    """All pairs by lists; all by many small blocks."""
    rows = [(k, f"g{k % 2}", " ".join(f"w{(k // 10) * 3 + j + (k % 7 == j) * 5}" for j in range(12))) for k in range(90)]
    monkeypatch.setattr(likeness, "LIST_COST", cost)
    monkeypatch.setattr(likeness, "BLOCK_TERMS", 8 * likeness.ROW_TERMS)
    monkeypatch.setattr(curation, "_spans", lambda some: [40])
    got = curation.drop_near_duplicates(spark.createDataFrame(rows, "o long, g string, q string"), "q", "g", "o")
    assert sorted(r["o"] for r in got.collect()) == brute_near(rows)


def test_rows_with_rare_terms_in_common_are_not_all_joined(spark, monkeypatch):
    """400 rows of 12 of 60 words: most pairs share a term they are found by, hardly any is joined with its terms."""
    rng, met = random.Random(3), spark.sparkContext.accumulator(0)

    def noted(threshold, real=likeness._over):
        def run(batches):
            def counted():
                for b in batches:
                    met.add(len(b))
                    yield b

            return real(threshold)(counted())

        return run

    monkeypatch.setattr(likeness, "_over", noted)
    rows = [(k, "g", " ".join(rng.choices([f"w{j}" for j in range(60)], k=12))) for k in range(400)]
    got = curation.drop_near_duplicates(spark.createDataFrame(rows, "o long, g string, q string"), "q", "g", "o")
    assert sorted(r["o"] for r in got.collect()) == brute_near(rows)
    assert met.value < 4 * 400


@pytest.mark.parametrize("columns", [4, 1024])
def test_blocks_are_compared_exactly(monkeypatch, columns):
    """Counts near the threshold, with few columns for the terms and with one each."""
    rng = random.Random(4)
    monkeypatch.setattr(likeness, "OWN_COLUMNS", columns)
    monkeypatch.setattr(likeness, "SHARED_COLUMNS", columns)
    monkeypatch.setattr(likeness, "AT_ONCE", 7)
    sides = [[{t: rng.choice([1, 1, 2, 9]) for t in rng.sample(range(-9, 9), rng.randint(1, 15))} for _ in range(40)] for _ in range(2)]
    square = lambda v: sum(n * n for n in v.values())
    tables = [pa.table({"o": pa.array(range(k, k + 40)), "n2": pa.array([square(v) for v in side]), "ts": pa.array([list(v) for v in side]), "cs": pa.array([list(v.values()) for v in side])}) for k, side in ((0, sides[0]), (100, sides[1]))]
    found = likeness._compared(0.6)(*tables)
    over = {(i, 100 + j) for i, v in enumerate(sides[0]) for j, w in enumerate(sides[1]) if sum(n * w.get(t, 0) for t, n in v.items()) / (square(v) * square(w)) ** 0.5 > 0.6}
    assert set(zip(*found.to_pydict().values(), strict=True)) == over and len(over) > 50


def test_ends_of_spans(spark):
    ends = curation._spans(spark.range(20_000).withColumnRenamed("id", "o"))
    assert ends[:2] == [511, 4095] and len(ends) == 2 and curation._spans(spark.range(300).withColumnRenamed("id", "o")) == []


def test_skeletons_cost_no_square(spark):
    """One query of 20,000 words, whose pieces are looked at once each."""
    long = "select " + ", ".join(f"a{k} as b{k}" for k in range(10_000)) + " From t"
    began = time.monotonic()
    found = spark.createDataFrame([(long,), ("1e5 in éab, in_x.x1 IN 'in'\n",), ("",), (None,)], "q string").select(curation.skeleton(F.col("q"))).collect()
    assert [r[0] for r in found] == ["SELECT " + ", ".join(["ID AS ID"] * 10_000) + " FROM ID", "1e5 IN éab, ID.ID IN ID", "", None]
    assert time.monotonic() - began < 30


def test_texts_of_features_are_flattened_once(spark):
    df = spark.createDataFrame([('WITH a AS (SELECT 1) SELECT\n"TIME_SHIFT"\n(x) FROM (SELECT 2) JOIN b',), (None,)], "q string").select(curation.features(F.col("q")).alias("f"))
    assert [r["f"] for r in df.collect()] == [["cte", "join", "subquery", "time_shift"], []]
    assert df._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace(q") == 1


def test_records_are_judged_by_the_gates_asked_for(spark):
    """One counter alone and all of them; other columns come back as they are."""
    tables = [gates.Table("t", {"v": gates.NONADDITIVE, "at": gates.EPOCH}, [("exclude_flag", "is_test")])]
    rows = [(2**53 + 1, "orders yesterday", "SELECT SUM(v) FROM t", None, None, None, None), (None, "orders today of 'x'", "SELECT TIME_FLOOR(at * 1000, 'P1D');", "", "business", ["orders"], False),
            (3, "today", "SELECT 1", "p", "exact_column", [], True), (4, "", "SELECT 1", None, None, None, None), (5, "orders", "SELECT AVG(v) FROM t WHERE is_test = 0", "p", "exact_column", ["v"], None)]
    df = spark.createDataFrame(rows, "id long, question string, sql string, prompt string, style string, answer_columns array<string>, unanswerable boolean")
    broken = {c: [bool(q and s and not u and find({"question": q, "sql": s, "prompt": p or "", "style": y, "answer_columns": a or []}, tables)) for _, q, s, p, y, a, u in rows] for c, find in suite.COUNTERS.items()}
    assert [r[:2] + r[7:] for r in map(tuple, suite.judged(df, tables).collect())] == [(*rows[k][:2], *(broken[c][k] for c in suite.COUNTERS)) for k in range(5)]
    one = suite.judged(df, tables, ["phrase_violation"])
    assert one.columns == [*df.columns, "phrase_violation"] and [r[0::7] for r in map(tuple, one.collect())] == [(rows[k][0], k == 0) for k in range(5)]


def test_gates_share_the_tokens_of_a_query(monkeypatch):
    record = {"question": "orders yesterday", "sql": "SELECT AVG(v) AS m FROM one_of_a_kind", "prompt": "", "style": "", "answer_columns": []}
    before = tokens._tokens.cache_info().misses
    assert [c for c, find in suite.COUNTERS.items() if find(record, [])] == ["output_style_violation", "phrase_violation"]
    assert tokens._tokens.cache_info().misses == before + 1
    tokens.tokenize(record["sql"]).clear()
    assert len(tokens.tokenize(record["sql"])) == 9
    monkeypatch.setattr(gates, "tokenize", None)
    assert gates.g8_phrases("orders", record["sql"]) == []


def test_numbers_of_six_digits_are_whole(spark):
    """100,001 rows of a split keep different ids; rows without a split have none, as in SQL."""
    rows = spark.range(100_001).select(F.lit("a").alias("s"), "id").union(spark.createDataFrame([(None, 1)], "s string, id long")).withColumnRenamed("id", "o")
    ids = {(r["s"], r["o"]): r["id"] for r in curation.numbered(rows, "s", "o").collect()}
    assert len(set(ids.values())) == 100_002 and ids["a", 100_000] == "v2_a_100000" and ids["a", 10_000] == "v2_a_10000" and ids[None, 1] is None
