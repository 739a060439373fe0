"""Mixing sources to target weights by weighted fair queueing.

Every document of a source is put in a shuffled order (by a hash of id and
text); the order is run through as often as ``max_passes`` allows. A pass of a
document finishes at the virtual time ``words of its source up to and with it /
target of the source``. All passes are ordered by finish time and taken until
the budget is spent, so that sources advance in proportion to their targets.

Only DataFrame functions; running sums are taken in two levels (hash slices of
a source, then within a slice; bins of finish time, then within the bin that
the budget ends in), so that no source or order is held by one task. Texts are
read once, for their sizes, and never shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, dealt_out, stash

WEIGHTS = (5, 2, 1)


def word_count(text: Column) -> Column:
    """Number of words, as long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD + "+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget_percent: int = 150, max_passes: int = 2) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, size)``.

    Sources in code-point order, null last, weigh ``weights``, repeating. The
    budget is shared by weight; no target passes ``max_passes`` times its
    source's size, and the excess is reshared by weight. Ordered by size per
    weight, the sources that are capped come first, so the level follows from
    sums over one row per source: the source that ends the caps has
    (budget - caps before it) / (weights from it on) below its own cap.
    One row per source meets in a task: sources are a list of settings.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(nth, F.lit(len(weights))) + 1).cast("long")
    per = per.withColumn("w", weight).withColumn("cap", F.col("source_size") * max_passes)
    per = per.withColumn("ratio", F.col("cap") * F.element_at(F.array(*[F.lit(math.lcm(*weights) // w) for w in weights]), F.pmod(nth, F.lit(len(weights))) + 1))
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before, after = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    left = F.sum("source_size").over(Window.partitionBy()) * budget_percent / 100 - F.coalesce(F.sum("cap").over(before), F.lit(0))
    per = per.withColumn("nth", F.row_number().over(by_ratio)).withColumn("level", left / F.sum("w").over(after))
    per = per.withColumn("open", F.col("cap") > F.col("w") * F.col("level"))
    first = F.min(F.when(F.col("open"), F.struct("nth", "level"))).over(Window.partitionBy())["level"]
    target = F.when(F.col("open"), F.col("w") * first).otherwise(F.col("cap").cast("double"))
    return per.select("source", "source_size", target.alias("target"))


def _slices(total_rows: int, rows_each: int) -> int:
    """A power of 16 with about ``rows_each`` rows a slice."""
    n, digits = total_rows // rows_each, 0
    while 16**digits < n and digits < 6:
        digits += 1
    return digits


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, budget_percent: int = 150, max_passes: int = 2, rows_each: int = 4096) -> DataFrame:
    """``(id, th, size, source_size, target, taken)``, a row for each row of ``docs``.

    ``taken`` is the number of words that the mix takes of the row: its size
    times the passes taken, at most ``max_passes``. ``th`` is the MD5 of the
    text. The order within a source is that of the MD5 of id and text; rows equal
    in both are ordered arbitrarily but get the same counts in any run as a set.
    Null texts have size 0 and, like all rows of size 0, are taken 0 times; null
    sources are a source; null ids count as empty. An empty table gives none.
    """
    th = F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), th.alias("th"))
    rows = rows.withColumn("o", F.md5(F.concat_ws(":", F.coalesce(F.col("id").cast("string"), F.lit("")), "th").cast("binary")))
    rows = stash(rows)
    n = rows.count()
    digits = _slices(n, rows_each)
    targets = source_targets(rows, weights, budget_percent, max_passes)

    # running sums of a source: of the slices before, then within the slice
    sliced = rows.withColumn("slice", F.substring("o", 1, digits))
    per_slice = sliced.groupBy("source", "slice").agg(F.sum("size").alias("s"))
    coarse = F.substring("slice", 1, max(0, digits - 2))
    upper = per_slice.groupBy("source", coarse.alias("up")).agg(F.sum("s").alias("s"))
    upper = upper.select("source", "up", (F.sum("s").over(Window.partitionBy("source").orderBy("up")) - F.col("s")).alias("before_up"))
    inner = per_slice.select("source", "slice", coarse.alias("up"), (F.sum("s").over(Window.partitionBy("source", coarse).orderBy("slice")) - F.col("s")).alias("before_in"))
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    starts = inner.join(upper, same(inner, upper) & (inner["up"] == upper["up"])).select(inner["source"], "slice", (F.col("before_up") + F.col("before_in")).alias("before"))
    starts = starts.join(targets, same(starts, targets)).select(starts["source"], "slice", "before", "source_size", "target")
    within = sliced.withColumn("cum", F.sum("size").over(Window.partitionBy("source", "slice").orderBy("o", "id").rowsBetween(Window.unboundedPreceding, 0)))
    timed = within.join(starts, same(within, starts) & (within["slice"] == starts["slice"])).select("id", within["source"], "th", "o", "size", "source_size", "target", (F.col("before") + F.col("cum")).alias("cum"))
    timed = stash(timed, n)

    # finish times of all passes; what the budget reaches, by bins of finish time first
    passes = timed.where("size > 0 and target > 0").select("source", "o", "id", "size", "target", F.explode(F.sequence(F.lit(0), F.lit(max_passes - 1))).alias("pass"), "cum", "source_size")
    finish = (F.col("cum") + F.col("pass") * F.col("source_size")).cast("double") / F.nullif(F.col("target"), F.lit(0.0))
    bins = max(16, 4 * (n // rows_each))
    passes = passes.select("source", "o", "id", "size", "pass", finish.alias("finish"), F.least(F.floor(finish * bins), F.lit(2 * bins)).alias("bin"))
    per_bin = passes.groupBy("bin").agg(F.sum("size").alias("s"))
    group = F.floor(F.col("bin") / 256)
    tops = per_bin.groupBy(group.alias("g")).agg(F.sum("s").alias("s")).select("g", (F.sum("s").over(Window.orderBy("g")) - F.col("s")).alias("before_g"))
    ins = per_bin.select("bin", "s", group.alias("g"), (F.sum("s").over(Window.partitionBy(group).orderBy("bin")) - F.col("s")).alias("before_in"))
    edges = ins.join(tops, "g").select("bin", "s", (F.col("before_g") + F.col("before_in")).alias("before"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    budget = total * budget_percent // 100
    last = edges.where((F.col("before") <= budget) & (F.col("before") + F.col("s") > budget)).select("bin", "before").first()
    if last is None:
        cut = None
    else:
        order = Window.orderBy("finish", "source", "o", "id", "pass").rowsBetween(Window.unboundedPreceding, 0)
        at = passes.where(F.col("bin") == last["bin"]).withColumn("run", F.sum("size").over(order) + last["before"])
        cut = at.where(F.col("run") > budget).orderBy("finish", "source", "o", "id", "pass").select("finish", "source", "o", "id", "pass").first()
    return _taken(timed, cut, id_col, max_passes)


def _taken(timed: DataFrame, cut, id_col: str, max_passes: int) -> DataFrame:
    """Counts the passes before ``cut``, the first that the budget doesn't hold."""
    taken = F.lit(0)
    for k in range(max_passes):
        finish = (F.col("cum") + k * F.col("source_size")).cast("double") / F.nullif(F.col("target"), F.lit(0.0))
        if cut is None:
            before = F.lit(True)
        else:
            key = [finish, F.col("source"), F.col("o"), F.col("id"), F.lit(k)]
            before, same = F.lit(False), F.lit(True)
            for x, c in zip(key, [cut["finish"], cut["source"], cut["o"], cut["id"], cut["pass"]]):
                c = F.lit(c)
                less = F.coalesce(x < c, x.isNull() & c.isNotNull())  # nulls first, as in the order
                before, same = before | (same & less), same & x.eqNullSafe(c)
        taken = taken + F.when((F.col("size") > 0) & (F.col("target") > 0) & before, 1).otherwise(0)
    return timed.select(F.col("id").alias(id_col), "th", "size", "source_size", "target", (F.col("size") * taken).cast("long").alias("taken"))


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **settings) -> DataFrame:
    """``docs`` as the mix takes them: a row comes as often as it is taken.

    Rows equal in id and text share their passes as evenly as can be, so the mix
    has as many words as :func:`mix` takes. Other columns, whatever their names,
    stay as they are.
    """
    found = mix(docs, id_col, text_col, source_col, **settings)
    times = found.groupBy(F.col(id_col).alias("id"), "th").agg(F.sum((F.col("taken") / F.greatest("size", F.lit(1))).cast("long")).alias("times"), F.count("*").alias("rows")).where("times > 0")
    times = stash(times, like=docs)
    each = docs.select(F.struct("*").alias("row"), docs[id_col].alias("row_id"), F.md5(F.coalesce(docs[text_col], F.lit("")).cast("binary")).alias("row_th"))
    each = each.join(dealt_out(times), each["row_id"].eqNullSafe(times["id"]) & (each["row_th"] == times["th"]))
    single = each if times.where("rows > 1").isEmpty() else each.where("rows = 1")
    out = single.select("row", F.col("times").alias("n"))
    if single is not each:
        nth = F.row_number().over(Window.partitionBy("row_id", "row_th").orderBy("row_id"))
        several = each.where("rows > 1").select("row", "times", "rows", nth.alias("nth"))
        out = out.union(several.select("row", F.expr("times div rows + CASE WHEN nth <= times % rows THEN 1 ELSE 0 END").alias("n")))
    return out.where("n > 0").select("row", F.explode(F.sequence(F.lit(1).cast("long"), "n"))).select("row.*")
