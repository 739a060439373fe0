"""Tables that grow with the input are not gathered by the driver, however small Spark takes them for."""

import re

import pytest

from tidemark.llm import components, jaccard, variants, vector_dedup

#: One row for each group of more than a thousand classes.
ALLOWED = re.compile(r"BroadcastHashJoin \[root#\d+L?\], \[root#\d+L?\], LeftOuter")


@pytest.fixture
def gathered(monkeypatch):
    """Joins of the tables written by a module that send one side through the driver, at Spark's own threshold."""
    seen = []

    def watch(*modules):
        for m in modules:
            def noted(df, *rest, real=m.stash, **more):
                note(df)
                return real(df, *rest, **more)

            monkeypatch.setattr(m, "stash", noted)

    def note(df):
        plan = df._jdf.queryExecution().sparkPlan().toString()
        seen.extend(x for x in plan.splitlines() if "Broadcast" in x and not ALLOWED.search(x))

    watch.note, watch.seen = note, seen
    return watch


def test_variants(spark, gathered):
    gathered(variants)
    words = spark.createDataFrame([("letters", 50), ("lettres", 5), ("letter", 9), ("other", 7)], "word string, n long")
    out = variants.group_variants(words)
    gathered.note(out)
    assert out.count() == 4 and gathered.seen == []


def test_components(spark, gathered):
    gathered(components)
    out = components.connected_components(spark.createDataFrame([(1, 2), (2, 3), (5, 4)], "a long, b long"), "a", "b")
    assert {tuple(r) for r in out.collect()} == {(1, 1), (2, 1), (3, 1), (4, 4), (5, 4)} and gathered.seen == []


def test_jaccard_join(spark, gathered):
    gathered(jaccard, components)
    text = " ".join(f"word{i}" for i in range(60))
    docs = spark.createDataFrame([(1, text), (2, text + " more"), (3, "quite another text of six words"), (4, text)], "doc_id long, text string")
    out = jaccard.jaccard_join(docs)
    gathered.note(out)
    assert {(r["doc_id"], r["component_id"]) for r in out.collect()} == {(1, 1), (2, 1), (3, 3), (4, 1)}
    left = jaccard.keep_one(docs)
    gathered.note(left)
    assert {r["doc_id"] for r in left.collect()} == {1, 3} and gathered.seen == []


def test_vectors_travel_once_a_bunch(spark, monkeypatch):
    """However many lists of its label a vector probes, it goes to their bunch once."""
    import numpy as np
    import pandas as pd

    def counted(*_):
        return lambda key, queries, entries: pd.DataFrame({"id": [0], "links": [len(queries)], "other": pd.array([None], "Int64")})

    monkeypatch.setattr(vector_dedup, "_linked", counted)
    monkeypatch.setattr(vector_dedup, "PER_LIST", 10)
    x = np.random.default_rng(1).normal(size=(200, 8))
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    classes = spark.createDataFrame([(k, f"l{k % 2}", v.tolist(), 1) for k, v in enumerate(x)], "id long, label string, v array<double>, m long")
    assert vector_dedup._block_links(classes, 0.5).groupBy().sum("links").first()[0] == 200
