"""Synthetic tables, rewording and streaming windows."""

from pyspark.sql import functions as F

from tidemark.operators import curation, rewording
from tidemark.sources import synthesis as s
from tidemark.streaming import windows

MODEL = s.TableModel("t", 4000, "2024-06-01 00:00:00", metrics=[("amount", "lognormal", 3, 1), ("score", "uniform", 0, 5), ("is_x", "pick", [0, 1], None)], pools={"kind": ["a", "b", "c"]},
                     multi={"tags": ["p", "q", "r"]}, json_fields={"j": {"k": ["x", "y"]}}, nullable={"amount"}, times={"e": "epoch_s", "d": "str_dmy"})


def test_rows_have_the_dirt_they_should(spark):
    df = s.synthesize(spark, MODEL, 5).cache()
    share = lambda c: df.where(c).count() / 4000
    assert 0.09 < share("amount IS NULL") < 0.15 and 0.05 < share("size(tags) = 0") < 0.11 and 0.02 < share("try_parse_json(j) IS NULL") < 0.06
    assert 0.05 < share("__time > TIMESTAMP '2024-05-30 12:00:00'") < 0.13 and share("size(tags) > size(array_distinct(tags))") == 0
    assert df.where("d = date_format(__time, 'dd/MM/yyyy')").count() > 3000 and df.agg(F.countDistinct("kind")).first()[0] == 3


def test_copies_differ_and_repeat(spark):
    a, b = s.copies(spark, MODEL), s.copies(spark, MODEL)
    first = lambda df: df.agg(F.sum("score")).first()[0]
    assert len({first(x) for x in a}) == 3 and [first(x) for x in a] == [first(x) for x in b]
    assert len(s.widened(a[0], 30, 1, {"color": ["red"], "shape": ["round"]}).columns) == 30


def test_variants_of_a_family(spark):
    got = s.variants(spark, MODEL, {"color": ["red"], "shape_kind": ["round"]}, 3)
    assert list(got) == ["t_snake", "t_camel", "t_prefixed"]
    for (low, high), df in zip(s.WIDTHS, got.values()):
        assert low <= len(df.columns) <= high and len(set(df.columns)) == len(df.columns) and df.columns[0] == "__time"
    assert "isX" in got["t_camel"].columns and "t_is_x" in got["t_prefixed"].columns and "is_x" in got["t_snake"].columns


def test_roles():
    assert s.classify_metric("error_count", explicit={"error_count": ("flag", "neutral")}) == ("flag", "neutral")
    assert s.classify_metric("error_count") == ("additive", "higher_is_worse") and s.classify_metric("is_new") == ("flag", "neutral")
    assert s.classify_metric("success_rate") == ("nonadditive", "higher_is_better") and s.classify_metric("risk_level", [1, 2, 3])[0] == "category_numeric"


def test_wrappers_unwrap(spark):
    df = rewording.with_wrappers(spark.range(400).withColumn("sql", F.concat(F.lit("SELECT "), F.col("id"))), "sql", "id", share=0.5)
    assert df.where("wrapper IS NOT NULL").count() > 150 and df.select("wrapper").distinct().count() == 6
    assert df.where(curation.unwrap(F.col("answer")) != F.col("sql")).isEmpty()


def test_terms(spark):
    texts = ["A priority warranty claim", "priority warranty claims' list", "Priority claims and an apriority claim", "the priority claim's age"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(rewording.substitute_term(F.col("t"), "priority warranty claim", "urgent case")).collect()]
    assert got == ["An urgent case", "urgent cases' list", "Urgent cases and an apriority claim", "the urgent case's age"]


def test_renullable(spark):
    rows = [(r, f"c{k}", k == 0, k == 1, k == 2, k % 2 == 0) for r in range(50) for k in range(20)]
    out = rewording.renullable(spark.createDataFrame(rows, "row_id long, column string, is_time boolean, nullable boolean, protected boolean, used boolean"))
    per = {r.row_id: r.n for r in out.where("nullable").groupBy("row_id").agg(F.count("*").alias("n")).collect()}
    assert all(11 <= n <= 15 for n in per.values()) and out.where("nullable AND (is_time OR protected)").isEmpty()
    assert out.where("column = 'c1' AND NOT nullable").isEmpty()


def test_windows_batch_and_stream(spark, tmp_path):
    rows = spark.range(600).select(F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 30).alias("__time"), (F.col("id") % 2).alias("k"))
    assert windows.tumbling(rows, "5 minutes", F.count("*").alias("n"), by=("k",)).count() == 120
    assert windows.sessions(rows.where("id % 100 < 50") if "id" in rows.columns else rows, "40 seconds", F.count("*").alias("n"), by=("k",)).count() >= 2
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    out = windows.tumbling(stream, "5 minutes", F.count("*").alias("n"))
    q = out.writeStream.format("memory").queryName("buckets").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("buckets").agg(F.sum("n"), F.count("*")).first()[:] == (600, 60)
