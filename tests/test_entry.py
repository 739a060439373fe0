"""The driver's contract."""

import __spark_entry__ as entry

SMALL = "/root/testdata/sf0.001"


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["day", "record_count"] and df.count() > 0


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) > 80


def test_dialect_queries_match_their_oracles(spark):
    import duckdb

    db = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")

    def rows(df):
        df = df[sorted(df.columns)].astype(object)
        return sorted(tuple("" if v is None or v != v else f"{float(v):.6g}" if isinstance(v, (int, float)) else str(v) for v in r) for r in df.where(df.notna(), None).itertuples(index=False))

    from tidemark.plans import catalogue

    for name in catalogue.ORACLES:
        assert rows(catalogue.QUERIES[name](spark, SMALL).toPandas()) == rows(db.sql(catalogue.ORACLES[name]).df()), name
