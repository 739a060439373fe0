"""External data as a table: inline lines or files, JSON or CSV, with a declared signature."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..dialect.errors import QueryError

#: Types of a signature, as Spark names them.
SIGNATURE_TYPES = {"long": "bigint", "string": "string", "double": "double", "float": "float", "array<string>": "array<string>"}


def read_extern(spark: SparkSession, source: str, fmt: str, signature: str) -> DataFrame:
    """Rows of a source; source, format and signature are JSON texts.

    Lines that don't parse fail the query when it runs; missing fields are null.
    Inline data is part of the query's text, so its size is bounded by that.
    """
    try:
        where, how, columns = json.loads(source), json.loads(fmt), json.loads(signature)
        schema = ", ".join(f"`{c['name']}` {SIGNATURE_TYPES[c['type'].lower()]}" for c in columns)
        kind, parser = where["type"], how["type"]
    except (ValueError, KeyError, TypeError, AttributeError) as e:
        raise QueryError("S9", f"EXTERN takes a source, a format and a signature, as JSON: {e}") from e
    if kind not in ("inline", "local") or parser not in ("json", "csv"):
        raise QueryError("S9", f"EXTERN reads inline or local data as json or csv, not {kind} as {parser}")
    if kind == "local":
        reader = spark.read.schema(schema).option("mode", "FAILFAST")
        return reader.json(where["files"]) if parser == "json" else reader.option("header", True).csv(where["files"])
    lines = spark.createDataFrame([(x,) for x in where["data"].splitlines() if x.strip()], "value string")
    parse = F.from_json if parser == "json" else F.from_csv
    return lines.select(parse("value", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")
