"""Synthetic fact tables: skewed times, metrics, multi-value and JSON columns with dirt.

Values follow from a seed, the row number and the column, so that copies of a
table differ by seed only and any task can make any row.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Shares of rows in the last 36 hours and in the last 45 days; the rest lies anywhere in the span.
RECENT, MONTHS = 0.06, 0.34
EMPTY_MV, BROKEN_JSON, NULLS = 0.08, 0.04, 0.12


@dataclass
class TableModel:
    """Columns by kind: metrics are (name, kind, a, b) with kind lognormal, uniform or pick."""

    name: str
    rows: int
    anchor: str
    span_days: int = 365
    metrics: list[tuple] = field(default_factory=list)
    pools: dict[str, list[str]] = field(default_factory=dict)
    multi: dict[str, list[str]] = field(default_factory=dict)
    json_fields: dict[str, dict[str, list[str]]] = field(default_factory=dict)
    nullable: set[str] = field(default_factory=set)
    times: dict[str, str] = field(default_factory=dict)  # name -> epoch_ms, epoch_s, str_space, str_iso, str_date, str_dmy


def unit(seed: int, *salt: str) -> Column:
    """A number in [0, 1) for each row."""
    return F.pmod(F.xxhash64(F.lit(seed), *map(F.lit, salt), F.col("id")), F.lit(1 << 52)).cast("double") / float(1 << 52)


def pick(values: list[str], seed: int, *salt: str) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (F.floor(unit(seed, *salt) * len(values)) + 1).cast("int"))


def _time_millis(m: TableModel, seed: int) -> Column:
    r, u = unit(seed, "time", "kind"), unit(seed, "time")
    hours = F.when(r < RECENT, u * 36).when(r < RECENT + MONTHS, u * 45 * 24).otherwise(u * m.span_days * 24)
    return F.unix_millis(F.lit(m.anchor).cast("timestamp")) - F.floor(hours * 3_600_000)


def encoded_time(ms: Column, encoding: str) -> Column:
    t = F.timestamp_millis(ms)
    if encoding in ("epoch_ms", "epoch_s"):
        return ms if encoding == "epoch_ms" else F.floor(ms / 1000)
    # The patterns of times in text.
    return F.date_format(t, {"str_space": "yyyy-MM-dd HH:mm:ss", "str_iso": "yyyy-MM-dd'T'HH:mm:ss'Z'", "str_date": "yyyy-MM-dd", "str_dmy": "dd/MM/yyyy"}[encoding])


def _metric(name: str, kind: str, a, b, seed: int) -> Column:
    u, v = unit(seed, name, "u"), unit(seed, name, "v")
    if kind == "lognormal":
        normal = F.sqrt(-2 * F.log(1 - u)) * F.cos(v * 6.283185307179586)
        return F.round(F.exp(F.lit(float(a)) + F.lit(float(b)) * normal), 3)
    if kind == "uniform":
        return F.round(F.lit(float(a)) + u * (b - a), 3)
    return F.element_at(F.array(*[F.lit(float(x)) for x in a]), (F.floor(u * len(a)) + 1).cast("int"))


def synthesize(spark: SparkSession, m: TableModel, seed: int) -> DataFrame:
    """Rows of a model: times thick toward the anchor, some empty multi-values, cut-off JSON and nulls."""
    ms = _time_millis(m, seed)
    out = {"__time": F.timestamp_millis(ms)}
    out |= {n: pick(v, seed, n) for n, v in m.pools.items()}
    out |= {n: _metric(n, k, a, b, seed) for n, k, a, b in m.metrics}
    for n, values in m.multi.items():
        # a run of distinct values from a random place on, one to three of them
        first, size = F.floor(unit(seed, n, "first") * len(values)), F.least(F.floor(unit(seed, n, "size") * 3) + 1, F.lit(len(values)))
        run = F.slice(F.array(*map(F.lit, values + values)), (first + 1).cast("int"), size.cast("int"))
        out[n] = F.when(unit(seed, n, "empty") < EMPTY_MV, F.array().cast("array<string>")).otherwise(run)
    for n, fields in m.json_fields.items():
        text = F.to_json(F.struct(*[pick(v, seed, n, k).alias(k) for k, v in fields.items()]))
        out[n] = F.when(unit(seed, n, "broken") < BROKEN_JSON, F.substring(text, F.lit(1), F.length(text) / 2)).otherwise(text)
    out |= {n: encoded_time(ms - F.floor(unit(seed, n) * 90_000), e) for n, e in m.times.items()}
    return spark.range(m.rows).select(*[(F.when(unit(seed, n, "null") >= NULLS, c) if n in m.nullable else c).alias(n) for n, c in out.items()])


def copies(spark: SparkSession, m: TableModel, n: int = 3) -> list[DataFrame]:
    """Independent copies of a table, by seeds from its name."""
    return [synthesize(spark, m, zlib.crc32(f"{m.name}:{i}".encode())) for i in range(n)]


def widened(df: DataFrame, width: int, seed: int, pools: dict[str, list[str]]) -> DataFrame:
    """``df`` with filler columns up to ``width``, names from the pools in turn, not yet used."""
    numbered = df.withColumn("id", F.monotonically_increasing_id())
    names, k = [], 0
    while len(df.columns) + len(names) < width:
        base = list(pools)[k % len(pools)]
        name = base if k < len(pools) else f"{base}_{k // len(pools)}"
        if name not in df.columns:
            names.append((name, pools[base]))
        k += 1
    return numbered.select(*df.columns, *[pick(v, seed, n).alias(n) for n, v in names])


#: Widths of the variants of a family, and how their columns are written.
WIDTHS = ((7, 25), (26, 80), (81, 200))
STYLES: dict[str, Callable[[str, str], str]] = {
    "snake": lambda column, table: column,
    "camel": lambda column, table: "".join(w if k == 0 else w.title() for k, w in enumerate(column.split("_"))),
    "prefixed": lambda column, table: f"{table[:3]}_{column}",
}


def variants(spark: SparkSession, m: TableModel, pools: dict[str, list[str]], seed: int = 0) -> dict[str, DataFrame]:
    """Tables of one family, by name: one for each of :data:`WIDTHS`, its width drawn from there by seed and name.

    Each has rows of its own, fillers from the pools, and its columns, but
    ``__time``, in a style of its own.
    """
    out = {}
    for (low, high), (style, written) in zip(WIDTHS, STYLES.items()):
        name = f"{m.name}_{style}"
        mark = zlib.crc32(f"{seed}:{name}".encode())
        df = widened(synthesize(spark, m, mark), low + mark % (high - low + 1), mark, pools)
        out[name] = df.select(*[F.col(f"`{c}`").alias(c if c == "__time" else written(c, m.name)) for c in df.columns])
    return out


#: What words of a column's name, or of its description, say of a metric: (aspect, value, words).
METRIC_WORDS = (
    ("role", "flag", "is has flag".split()),
    ("role", "category_numeric", "code type class level tier".split()),
    ("role", "nonadditive", "pct percent rate ratio score avg mean price temperature ms latency".split()),
    ("role", "additive", "count total num qty quantity amount bytes revenue cost units sum".split()),
    ("direction", "higher_is_worse", "error errors fail failed failure latency delay loss drop churn defect timeout downtime fraud".split()),
    ("direction", "higher_is_better", "revenue profit score success satisfaction uptime conversion margin".split()),
)


def classify_metric(name: str, values: list | None = None, description: str = "", explicit: dict[str, tuple[str, str]] | None = None) -> tuple[str, str]:
    """(role, direction) of a metric column by the words of its name, its values and its description.

    Of the words that tell a role the first in the order of ``METRIC_WORDS``
    counts; is, has and flag at an end of the name only. Columns of 0 and 1 are
    flags, and codes are categories where their values are known. A name in
    ``explicit`` is what stands there.
    """
    if explicit and name in explicit:
        return explicit[name]
    words = name.lower().split("_")
    told = {}
    for aspect, value, known in METRIC_WORDS:
        at = {w for w in words if w in known}
        if value == "flag":
            at = {w for w in (words[0], words[-1]) if w in known}
        if value == "category_numeric" and values is None:
            at = set()
        if aspect == "direction":
            at |= {w for w in description.lower().split() if w in known}
        if at:
            told.setdefault(aspect, value)
    if values is not None and set(values) == {0, 1}:
        told["role"] = "flag"
    role = told.get("role", "nonadditive")
    return role, "neutral" if role in ("flag", "category_numeric") else told.get("direction", "neutral")
