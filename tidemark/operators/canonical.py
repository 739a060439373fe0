"""Canonical results: comparable values, rows in any order, fingerprints, agreement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_NUMBER = r"^-?\d+(\.\d+)?$"
_DATE = r"^(\d{4})-(\d{2})(?:-(\d{2}))?(?:[T ](\d{2}):(\d{2})(?::(\d{2}))?.*)?$"


def canonical_value(c: Column, kind: str) -> Column:
    """Text of a value that compares equal across types: booleans and numbers, also
    in text, as numbers of six places; dates and times as seconds; null as null."""
    if kind == "boolean":
        return c.cast("int").cast("double").cast("string")
    if kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal"):
        return F.round(c.cast("double"), 6).cast("string")
    if kind.startswith("timestamp") or kind == "date":
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    text = c.cast("string")
    t = F.trim(text)
    part = lambda k, default: F.coalesce(F.nullif(F.regexp_extract(t, _DATE, k), F.lit("")), F.lit(default))
    stamp = F.concat(part(1, ""), F.lit("-"), part(2, ""), F.lit("-"), part(3, "01"), F.lit(" "), part(4, "00"), F.lit(":"), part(5, "00"), F.lit(":"), part(6, "00"))
    return F.when(t.rlike(_NUMBER), F.round(t.try_cast("double"), 6).cast("string")).when(t.rlike(_DATE), stamp).otherwise(text)


def canonical_rows(df: DataFrame) -> DataFrame:
    """``row``: the values of each row as a sorted array, nulls first, without names."""
    values = [F.coalesce(F.concat(F.lit("="), canonical_value(F.col(f"`{n}`"), t)), F.lit("")) for n, t in df.dtypes]
    return df.select(F.array_sort(F.array(*values)).alias("row"))


def fingerprint(df: DataFrame) -> str:
    """16 hex digits that follow from the canonical rows as a bag, whatever their order.

    Rows are hashed where they are; the sums of two 32-bit parts and the count
    make the digest, so no row travels.
    """
    h = F.sha1(F.array_join("row", "\x1f").cast("binary"))
    part = lambda k: F.sum(F.conv(F.substring(h, k, 8), 16, 10).cast("decimal(38,0)"))
    sums = canonical_rows(df).agg(F.count("*").alias("n"), *[part(1 + 8 * k).alias(f"s{k}") for k in range(4)])
    return sums.select(F.substring(F.sha1(F.concat_ws(":", *[F.col(c).cast("string") for c in sums.columns]).cast("binary")), 1, 16)).first()[0]


#: Two numbers are equal if they differ by no more than this part of the greater one, or of 1.
TOLERANCE = 1e-6
#: Steps of the logarithm in which numbers are dealt out: far wider than the tolerance.
_STEPS = 4096


def _near(x: Column, y: Column, tolerance: float) -> Column:
    return F.abs(x - y) <= tolerance * F.greatest(F.lit(1.0), F.abs(x), F.abs(y))


def parted_rows(df: DataFrame) -> DataFrame:
    """``(exact, numbers)``: of each row the values that must be equal and those that may differ a little, both sorted.

    Numbers in text count as numbers; null, NaN and infinite values are exact.
    """
    exact, numbers = [], []
    for n, t in df.dtypes:
        c = F.col(f"`{n}`")
        text = F.coalesce(F.concat(F.lit("="), canonical_value(c, t)), F.lit(""))
        number = _as_number(c, t)
        numbers.append(number)
        exact.append(F.when(number.isNull(), text))
    return df.select(F.array_sort(F.array_compact(F.array(F.lit(None).cast("string"), *exact))).alias("exact"), F.array_sort(F.array_compact(F.array(F.lit(None).cast("double"), *numbers))).alias("numbers"))


def _as_number(c: Column, kind: str) -> Column:
    """The finite number that a value is, also in text; else null."""
    if kind == "boolean":
        c = c.cast("int")
    elif kind == "string":
        c = F.when(F.trim(c).rlike(_NUMBER), F.trim(c).try_cast("double"))
    elif kind not in ("tinyint", "smallint", "int", "bigint", "float", "double") and not kind.startswith("decimal"):
        return F.lit(None).cast("double")
    c = c.cast("double")
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c + 0.0)  # -0.0 becomes 0.0


def _levels(values: DataFrame, tolerance: float) -> DataFrame:
    """``(exact, pos, v, level)`` of distinct ``(exact, pos, v)``: values reach one another by steps within the tolerance if their levels are equal.

    Levels are counted along the values in two steps: within ranges of values,
    then over the ranges, each of which goes on with the level before it if the
    values on both sides of the border are near.
    """
    place = F.floor(F.signum("v") * F.log1p(F.abs("v")) * _STEPS)
    along = Window.partitionBy("exact", "pos", "range").orderBy("v")
    before = F.lag("v").over(along)
    apart = F.coalesce((~_near(F.col("v"), before, tolerance)).cast("long"), F.lit(0))
    local = values.withColumn("range", place).withColumn("apart", apart).withColumn("local", F.sum("apart").over(along))
    ranges = local.groupBy("exact", "pos", "range").agg(F.min("v").alias("low"), F.max("v").alias("high"), F.max("local").alias("last"))
    over = Window.partitionBy("exact", "pos").orderBy("range")
    border = F.coalesce((~_near(F.col("low"), F.lag("high").over(over), tolerance)).cast("long"), F.lit(0))
    ranges = ranges.withColumn("border", border).withColumn("base", F.sum(F.col("border") + F.col("last")).over(over) - F.col("last"))
    return local.join(ranges.select("exact", "pos", "range", "base"), ["exact", "pos", "range"]).select("exact", "pos", "v", (F.col("base") + F.col("local")).alias("level"))


def _counted(a: DataFrame, b: DataFrame) -> DataFrame:
    """``(exact, numbers, n_a, n_b)``: the distinct rows of both, and how often each has them."""
    rows = parted_rows(a).withColumn("a", F.lit(1)).union(parted_rows(b).withColumn("a", F.lit(0)))
    return rows.groupBy("exact", "numbers").agg(F.sum("a").alias("n_a"), F.sum(1 - F.col("a")).alias("n_b"))


def mismatches(a: DataFrame, b: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """``(exact, low, high, n_a, n_b)``: sets of rows of two results that can't be paired; none if the results agree.

    Results are bags. Rows are alike if their exact values are equal and their
    numbers, sorted, differ by no more than the tolerance one by one. Rows are
    parted by the levels of their numbers, so that no pair is torn by a border;
    a part agrees if it holds as many rows of both and its numbers all lie within
    the tolerance. In a wider part, rows are paired in order. That finds a
    pairing wherever one number differs within the part; where several do, a
    pairing may be missed, so that the answer errs to the strict side.
    """
    rows = _parted(_counted(a, b), tolerance)
    parts = _parts(rows, max(len(a.columns), len(b.columns)), tolerance)
    unequal = parts.where("n_a <> n_b").select("exact", "low", "high", "n_a", "n_b")
    return unequal.union(_paired_wrongly(rows, parts, tolerance))


def _parted(rows: DataFrame, tolerance: float) -> DataFrame:
    """Counted rows and ``part``, the levels of their numbers."""
    each = rows.select("exact", "numbers", F.posexplode("numbers").alias("pos", "v"))
    levels = _levels(each.select("exact", "pos", "v").distinct(), tolerance)
    placed = each.join(levels, ["exact", "pos", "v"]).groupBy("exact", "numbers").agg(F.array_sort(F.collect_list(F.struct("pos", "level"))).alias("levels"))
    part = F.coalesce(F.transform("levels", lambda x: x["level"]), F.array().cast("array<bigint>"))
    return rows.join(placed, ["exact", "numbers"], "left").withColumn("part", part).drop("levels")


def _parts(rows: DataFrame, width: int, tolerance: float) -> DataFrame:
    """``(exact, part, n_a, n_b, low, high, narrow)``: the least and greatest numbers of each part, and whether all lie within the tolerance."""
    ends = [F.array_compact(F.array(*[f(F.get("numbers", F.lit(i))) for i in range(width)])).alias(n) for f, n in ((F.min, "low"), (F.max, "high"))]
    narrow = F.forall(F.zip_with("low", "high", lambda x, y: _near(x, y, tolerance)), lambda x: x)
    return rows.groupBy("exact", "part").agg(F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b"), *ends).withColumn("narrow", narrow)


def _paired_wrongly(rows: DataFrame, parts: DataFrame, tolerance: float) -> DataFrame:
    """Wide parts with as many rows of both results, in which rows paired in order are not alike."""
    wide = rows.join(parts.where("n_a = n_b AND NOT narrow").select("exact", "part", "low", "high", F.col("n_a").alias("all_a"), F.col("n_b").alias("all_b")), ["exact", "part"])
    nth = F.row_number().over(Window.partitionBy("exact", "part").orderBy("numbers"))
    each = lambda n: wide.where(F.col(n) > 0).select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col(n)))).withColumn("nth", nth)
    of_a, of_b = each("n_a").select("exact", "part", "low", "high", "all_a", "all_b", "nth", "numbers"), each("n_b")
    pairs = of_a.join(of_b.select("exact", "part", "nth", F.col("numbers").alias("others")), ["exact", "part", "nth"])
    alike = F.forall(F.zip_with("numbers", "others", lambda x, y: _near(x, y, tolerance)), lambda x: x)
    return pairs.where(~alike).select("exact", "low", "high", F.col("all_a").alias("n_a"), F.col("all_b").alias("n_b")).distinct()
def _column_digests(df: DataFrame) -> dict[str, tuple]:
    """Per column a digest of its canonical values as a bag, in one pass."""
    if not df.columns:
        return {}
    aggs = []
    for n, t in df.dtypes:
        v = F.coalesce(F.concat(F.lit("="), canonical_value(F.col(f"`{n}`"), t)), F.lit(""))
        aggs.append(F.struct(F.count("*").alias("n"), F.sum(F.xxhash64(v).cast("decimal(38,0)")).alias("s")).alias(n))
    row = df.agg(*aggs).first()
    return {n: tuple(row[n]) for n in df.columns}


def results_agree(a: DataFrame, b: DataFrame, tolerance: float = TOLERANCE) -> bool:
    """Whether two results hold the same rows, whatever their order and names, numbers within the tolerance.

    Columns that only the wider result has are left out if the narrower one's
    columns all occur in it.
    """
    if len(a.columns) > len(b.columns):
        a, b = b, a
    if len(a.columns) < len(b.columns):
        left = _columns_like(a, b, tolerance)
        if left is None:
            return False
        b = b.select(*[f"`{n}`" for n in left])
    rows = _counted(a, b).persist()
    unlike = rows.agg(F.count_if(F.col("n_a") != F.col("n_b")).alias("rows"), F.sum(F.col("n_a") - F.col("n_b")).alias("more")).first()
    if not unlike["rows"] or unlike["more"]:
        rows.unpersist()
        return not unlike["rows"]
    parted = _parted(rows, tolerance).persist()
    parts = _parts(parted, len(a.columns), tolerance)
    found = parts.agg(F.count_if(F.col("n_a") != F.col("n_b")).alias("unequal"), F.count_if(~F.col("narrow")).alias("wide")).first()
    agree = not found["unequal"] and (not found["wide"] or _paired_wrongly(parted, parts, tolerance).isEmpty())
    parted.unpersist()
    rows.unpersist()
    return agree


def _columns_like(a: DataFrame, b: DataFrame, tolerance: float) -> list[str] | None:
    """Columns of ``b`` with the values of those of ``a``, one each: by digest, else within the tolerance."""
    of_a, of_b, left = _column_digests(a), _column_digests(b), []
    for column, digest in of_a.items():
        open_ = [n for n in of_b if n not in left]
        hit = next((n for n in open_ if of_b[n] == digest), None)
        if hit is None:
            alike = [n for n in open_ if of_b[n][0] == digest[0]]
            hit = next((n for n in alike if mismatches(a.select(f"`{column}`"), b.select(f"`{n}`"), tolerance).isEmpty()), None)
        if hit is None:
            return None
        left.append(hit)
    return left


def agree_on_seeds(run, query_a: str, query_b: str, seeds: list, max_rows: int | None = None, least: int = 2) -> tuple[bool, str]:
    """Whether two queries agree on all seeds; ``run(query, seed)`` gives a DataFrame.

    Results over ``max_rows``, if given, and queries with rows on fewer than
    ``least`` seeds don't count as agreeing.
    """
    filled = 0
    for seed in seeds:
        a, b = run(query_a, seed), run(query_b, seed)
        n = a.limit((max_rows or 0) + 1).count()
        if max_rows is not None and n > max_rows:
            return False, f"over {max_rows} rows"
        filled += n > 0
        if not results_agree(a, b):
            return False, f"results differ on seed {seed}"
    return (True, "agree") if filled >= least else (False, f"rows on {filled} seeds only")
