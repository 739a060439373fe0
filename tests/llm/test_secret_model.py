"""The model of the secret scan on held-out random strings and identifiers; mixing of equal rows."""

from __future__ import annotations

import random
import string

import pytest

from tidemark.llm import mixing, secret_scan

DOCS = "/root/testdata/sf0.01/documents.parquet"


@pytest.fixture(scope="module")
def model(spark):
    rows = spark.read.parquet(DOCS).select("text")
    return secret_scan.train(secret_scan.labelled_samples(rows, rows.distinct().count()))


def ratio(model: list[float], token: str) -> float:
    """By a loop over the characters."""
    total, before = 0.0, 0
    for c in token:
        code = secret_scan.ALPHABET.find(c) + 1
        total, before = total + model[before * secret_scan.SIZE + code], code
    return total


def test_recall_and_false_alarms(spark, model):
    rng = random.Random(5)
    kinds = [string.ascii_letters + string.digits, string.ascii_lowercase + string.digits, string.ascii_letters]
    secrets = ["".join(rng.choices(k, k=n)) for k in kinds for n in (12, 16, 20, 32) for _ in range(50)]
    words = spark.read.parquet(DOCS).selectExpr("explode(regexp_extract_all(text, '[a-z]{5,9}', 0)) w").distinct().orderBy("w").limit(400).collect()
    words = [r.w for r in words]
    plain = [a + b.title() + c.title() for a, b, c in zip(words, words[1:], words[2:])] + ["_".join(x) for x in zip(words, words[1:])] + ["2024-05-06-07-08-09"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(secrets + plain)], "id int, text string")
    found = {r.id: r.spans for r in secret_scan.scan(docs, model=model).collect()}
    hits = [bool(found[i]) for i in range(len(found))]
    assert sum(hits[: len(secrets)]) >= 0.97 * len(secrets)
    assert sum(hits[len(secrets) :]) <= 0.03 * len(plain)
    for i, t in enumerate(secrets + plain):
        loop = len(set(t)) >= secret_scan.DIFFERENT and ratio(model, t) > max(secret_scan.NATS, secret_scan.NATS_PER_CHAR * len(t))
        rule = any(s.kind != "random" for s in found[i])
        assert rule or loop == hits[i]


def test_ordinary_kinds_raise_no_alarm(spark, model):
    """Kinds of strings that training does not hold as they are: numbers, rules, paths, compounds, UUIDs, alphabets."""
    rng = random.Random(8)
    words = "invoice payment warehouse shipping delivery employee salary department insurance hospital patient doctor bridge mountain river garden kitchen window castle winter summer holiday travel ticket flight airport".split()
    some = lambda n=3: rng.sample(words, n)
    hexes = lambda *n: "-".join("".join(rng.choices("0123456789abcdef", k=k)) for k in n)
    kinds = {
        "numbers": ["".join(rng.choices(string.digits, k=n)) for n in (12, 16, 24, 40) for _ in range(50)],
        "rules": [c * n for c in "=_-/+x0" for n in (12, 20, 50)] + ["=-" * 10, "ab" * 9],
        "joined": ["".join(some()) for _ in range(100)], "camel": ["".join(w.title() for w in some()) for _ in range(100)],
        "snake": ["_".join(some()).upper() for _ in range(100)], "paths": ["/" + "/".join(some(4)) for _ in range(100)],
        "uuids": [hexes(8, 4, 4, 4, 12) for _ in range(50)], "alphabets": [string.ascii_lowercase, string.ascii_uppercase, "0123456789" * 2, "qwertyuiopasdf"],
        "others": ["/usr/local/lib/python3", "xmlhttprequestupload", "2024-05-06-07-08-09", "com/example/project/Main", "IMG_20240512_123456"],
    }
    docs = spark.createDataFrame([(k, t) for k, some_ in kinds.items() for t in some_], "kind string, text string")
    found = secret_scan.scan(docs, model=model).selectExpr("kind", "size(filter(spans, s -> s.kind = 'random')) > 0 AS alarm").groupBy("kind").agg({"alarm": "count_if", "*": "count"}).collect()
    assert {r["kind"]: r["count_if(alarm)"] <= 0.03 * r["count(1)"] for r in found} == dict.fromkeys(kinds, True)


def test_working_names_are_free(spark, model):
    docs = spark.createDataFrame([("a", "password = abcdefghijkl1", "b", "c", "d")], "_secret_text string, text string, _span_hex string, _secret_base string, _secret_spans string")
    row = secret_scan.scan(docs, model=model).first()
    assert (row._secret_text, row._span_hex, row._secret_base, row._secret_spans) == ("a", "b", "c", "d") and len(row.spans) == 1
    assert secret_scan.redact(docs, model=model).first()["_secret_spans"] == "d"


def test_equal_rows_share_the_mix(spark):
    rows = [(1, "a b c d", "x", k) for k in range(7)] + [(i, "w " * 5, "y", 0) for i in range(2, 9)] + [(None, None, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _th long")
    want = {}
    for r in mixing.mix(docs).where("size > 0").collect():
        want[r.doc_id] = want.get(r.doc_id, 0) + r.taken // r.size
    got = {}
    for r in mixing.mixed_rows(docs).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == {k: v for k, v in want.items() if v}
    each = {}
    for r in mixing.mixed_rows(docs).where("doc_id = 1").collect():
        each[r["_th"]] = each.get(r["_th"], 0) + 1
    assert max(each.values()) - min([each.get(k, 0) for k in range(7)]) <= 1
