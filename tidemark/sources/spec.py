"""Declared tables: a JSON description of columns and of where rows come from."""

from __future__ import annotations

import hashlib
import json
import os
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, LongType, StringType, StructField, StructType

TYPES = {"long": LongType(), "double": DoubleType(), "float": FloatType(), "string": StringType(), "array<string>": ArrayType(StringType())}
FORMATS = ("csv", "json", "parquet")


class SpecError(ValueError):
    """A description that is not valid; the message names the field."""


@dataclass(frozen=True)
class Column:
    name: str
    type: str
    is_time: bool
    nullable: bool


@dataclass(frozen=True)
class Spec:
    name: str
    columns: tuple[Column, ...]
    seed: dict
    folder: str = "."

    @property
    def time(self) -> Column:
        return next(c for c in self.columns if c.is_time)

    @property
    def raw_schema(self) -> StructType:
        """All columns as a reader of untyped files gives them."""
        return StructType([StructField(c.name, TYPES[c.type] if c.type == "array<string>" else StringType()) for c in self.columns])


def _need(ok: bool, message: str) -> None:
    if not ok:
        raise SpecError(message)


def parse_spec(raw: dict, folder: str = ".") -> Spec:
    """A checked description; exactly one column is the time."""
    _need(isinstance(raw, dict), "a spec must be a JSON object")
    text = lambda v: isinstance(v, str) and bool(v.strip())
    _need(text(raw.get("name")), "name is required")
    _need(isinstance(raw.get("columns"), list) and bool(raw["columns"]), "columns must be a non-empty list")
    columns = []
    for k, c in enumerate(raw["columns"]):
        _need(isinstance(c, dict) and text(c.get("name")), f"columns[{k}].name is required")
        _need(str(c.get("type")).lower() in TYPES, f"columns[{k}].type must be one of {sorted(TYPES)}")
        columns.append(Column(c["name"].strip(), c["type"].lower(), bool(c.get("is_time")), bool(c.get("nullable"))))
    _need(sum(c.is_time for c in columns) == 1, "exactly one column must have is_time")
    seed = raw.get("seed")
    _need(isinstance(seed, dict) and seed.get("mode") in ("generate", "file"), "seed.mode must be generate or file")
    if seed["mode"] == "generate":
        _need(isinstance(seed.get("row_count"), int) and seed["row_count"] > 0, "seed.row_count must be a positive integer")
        _need(isinstance(seed.get("random_seed", 42), int), "seed.random_seed must be an integer")
        _need(all(c.type != "array<string>" for c in columns), "array<string> columns cannot be generated")
    else:
        _need(text(seed.get("path")), "seed.path is required")
        _need(seed.get("format") in FORMATS, f"seed.format must be one of {sorted(FORMATS)}")
    return Spec(raw["name"].strip(), tuple(columns), seed, folder)


def load_spec(path: str) -> Spec:
    return parse_spec(json.loads(Path(path).read_text()), str(Path(path).resolve().parent))


def spec_fingerprint(spec: Spec) -> str:
    """SHA-1 of a description and of its seed file: equal means nothing to load."""
    h = hashlib.sha1(json.dumps([spec.name, [vars(c) for c in spec.columns], spec.seed], sort_keys=True).encode())
    if spec.seed["mode"] == "file":
        with open(os.path.join(spec.folder, spec.seed["path"]), "rb") as f:
            for part in iter(lambda: f.read(1 << 20), b""):
                h.update(part)
    return h.hexdigest()


def generated(spark: SparkSession, spec: Spec) -> DataFrame:
    """Seeded rows: a minute apart from 2024-01-01, values by column and seed.

    Longs lie in 0..1000, doubles and floats in 0..100, strings are one of six
    values of their column. The values follow from row number, column and seed.
    """
    seed = spec.seed.get("random_seed", 42)
    rows = spark.range(spec.seed["row_count"])
    out = []
    for c in spec.columns:
        draw = F.pmod(F.xxhash64(F.lit(seed), F.lit(c.name), F.col("id")), F.lit(1_000_003))
        if c.is_time:
            ms = F.lit(1_704_067_200_000) + F.col("id") * 60_000
            value = ms if c.type == "long" else F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd'T'HH:mm:ss'Z'")
        elif c.type == "long":
            value = draw % 1001
        elif c.type == "string":
            value = F.concat(F.lit(f"{c.name}_"), (draw % 6).cast("string"))
        else:
            value = F.round(draw / 10_000.03, 6)
        out.append(value.cast(TYPES[c.type]).alias(c.name))
    return rows.select(*out)


def coerced(df: DataFrame, spec: Spec) -> DataFrame:
    """Columns of the declared types; missing values and empty strings are null.

    A null where the column is not nullable, and a value that its type can't
    hold, is an error that names the column.
    """
    out = []
    for c in spec.columns:
        value = F.col(f"`{c.name}`") if c.name in df.columns else F.lit(None).cast("string")
        if c.type != "array<string>":
            value = F.nullif(value.cast("string"), F.lit(""))
            typed = value.try_cast(TYPES[c.type])
            bad = value.isNotNull() & typed.isNull()
            typed = F.when(bad, F.raise_error(F.concat(F.lit(f"column {c.name}: not a {c.type}: "), value)).cast(TYPES[c.type])).otherwise(typed)
        else:
            typed = value.cast(TYPES[c.type])
        if not c.nullable:
            typed = F.when(typed.isNull(), F.raise_error(F.lit(f"column {c.name} is not nullable")).cast(TYPES[c.type])).otherwise(typed)
        out.append(typed.alias(c.name))
    return df.select(*out)


def read_seed(spark: SparkSession, spec: Spec) -> DataFrame:
    """Rows of a description, coerced, with the time column as ``__time``."""
    if spec.seed["mode"] == "generate":
        df = generated(spark, spec)
    else:
        path = os.path.join(spec.folder, spec.seed["path"])
        if spec.seed["format"] == "csv":
            df = spark.read.option("header", True).csv(path)
        elif spec.seed["format"] == "json":
            first = spark.read.text(path).where(F.trim("value") != "").limit(1).collect()
            if not first:
                raise SpecError(f"seed file {path} is empty")
            df = spark.read.schema(spec.raw_schema).option("mode", "FAILFAST").option("multiLine", first[0][0].lstrip().startswith("[")).json(path)
        else:
            df = spark.read.parquet(path)
        df = coerced(df, spec)
    time = F.col(f"`{spec.time.name}`")
    stamp = F.timestamp_millis(time) if spec.time.type == "long" else F.coalesce(F.try_to_timestamp(time), F.try_to_timestamp(time, F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'")))
    return df.withColumn(spec.time.name, stamp).withColumnRenamed(spec.time.name, "__time")
