"""Rows alike by the cosine of their counts of terms, found without shuffling what need not be.

A row's terms are in one order, the rarest first. Weights squared, a pair over
the threshold shares one of the terms that carry all but threshold^2 of each
row's weight; these are the row's postings. At the first term that two rows
share, what both have from there on bounds their cosine: pairs under the
threshold by that never leave the task that makes them.

Rows that have a posting in a long list are wide. Two wide rows are compared in
blocks of bounded size by a product of matrices: frequent terms have a column
each, others share columns by the root of their weight, which bounds the cosine
from above; what is over the threshold by that is counted exactly where it is.
All other pairs meet in the short lists. Terms are known by 64-bit hashes of
group and text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: What a pair in a list costs, counted in pairs of two wide rows.
LIST_COST = 4
#: Terms in a block, where a row counts as ROW_TERMS at least; columns of frequent terms and of all others; rows of a product at once.
BLOCK_TERMS, ROW_TERMS, OWN_COLUMNS, SHARED_COLUMNS, AT_ONCE = 1 << 21, 512, 1024, 1024, 256


def vectors(rows: DataFrame, terms: Column) -> DataFrame:
    """``(o, g, n2, ts, cs)`` of ``(o, g)`` and their ``terms``: hashes of the terms in order, their counts, and the sum of the counts squared."""
    # dealt out by o once, all counting is done where the row lies
    each = rows.repartition("o").select("o", "g", F.explode(terms).alias("t")).select("o", "g", F.xxhash64("g", "t").alias("t"))
    counted = each.groupBy("o", "g", "t").count()
    packed = counted.groupBy("o", "g").agg(F.sum(F.col("count") * F.col("count")).alias("n2"), F.array_sort(F.collect_list(F.struct("t", "count"))).alias("e"))
    return packed.select("o", "g", "n2", F.col("e.t").alias("ts"), F.col("e.count").alias("cs"))


def postings(vec: DataFrame, threshold: float, cut: Callable[[DataFrame], DataFrame], discard: Callable[[DataFrame], None]) -> DataFrame:
    """``(o, t, rest, n)``: terms a row is found by, the share of its weight from there on, and how many rows the term's list has."""
    df_t = cut(vec.select(F.explode("ts").alias("t")).groupBy("t").agg(F.count("*").alias("df")).where("df > 1"))
    each = vec.select("o", F.explode(F.arrays_zip("ts", "cs")).alias("e")).select("o", F.col("e.ts").alias("t"), (F.col("e.cs") * F.col("e.cs")).alias("q"))
    # terms of one row only come first in its order and lead to no other: their weight is what is missing of n2
    row, along = Window.partitionBy("o"), Window.partitionBy("o").orderBy("df", "t")
    known = each.join(shuffled(df_t), "t").withColumn("rest", F.sum("q").over(row) - F.sum("q").over(along) + F.col("q"))
    rest = known.join(shuffled(vec.select("o", "n2")), "o").select("o", "t", (F.col("rest") / F.col("n2")).alias("rest"))
    listed = cut(rest.where(F.col("rest") >= threshold * threshold - 1e-9))
    sizes = listed.groupBy("t").agg(F.count("*").alias("n")).where("n > 1")
    out = cut(listed.join(shuffled(sizes), "t").select("o", "t", "rest", "n"))
    discard(df_t)
    discard(listed)
    return out


def longest_list(posts: DataFrame, rows: DataFrame) -> int:
    """Up to which length lists are joined: as it costs least, lists and pairs of wide rows together.

    ``rows`` has g and top, the length of a row's longest list. The driver holds a number for each power of two.
    """
    level = lambda n: F.ceil(F.log2(n)).cast("int")
    in_lists = {r["k"]: r["pairs"] for r in posts.groupBy(level("n").alias("k")).agg((F.sum(F.col("n") - 1) / 2).alias("pairs")).collect()}
    if not in_lists:
        return 0
    # a row is wide for each limit below its own longest list
    each = rows.where("top > 1").groupBy("g", level("top").alias("k")).agg(F.count("*").alias("n")).select("g", "n", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("k"))
    wide = {r["k"]: r["pairs"] for r in each.groupBy("g", "k").agg(F.sum("n").cast("double").alias("n")).groupBy("k").agg((F.sum(F.col("n") * F.col("n")) / 2).alias("pairs")).collect()}
    cost = lambda limit: LIST_COST * sum(n for k, n in in_lists.items() if k <= limit) + wide.get(limit, 0)
    return 1 << min(range(max(in_lists) + 1), key=cost)


def alike(vec: DataFrame, posts: DataFrame, a: DataFrame, b: DataFrame | None, limit: int, threshold: float, of_a: Column, of_b: Column) -> DataFrame:
    """``(x, y)``: rows x of ``a`` and later ones y of ``b`` whose cosine is over the threshold; without ``b`` rows of ``a`` with one another.

    Both have o, g, size (number of terms) and wide; all of ``b`` come after those of ``a``. ``of_a`` and ``of_b``
    are conditions on o that their rows fulfil, so that what can't be among them is not shuffled.
    """
    of_b = of_a if b is None else of_b
    short = posts.where(F.col("n") <= limit).select("o", "t", "rest")
    of_x, of_y = (short.where(held).join(shuffled(rows.select("o", "wide")), "o").select(F.col("o").alias(n), "t", F.col("rest").alias(f"r{n}"), F.col("wide").alias(f"w{n}")) for rows, n, held in ((a, "x", of_a), (a if b is None else b, "y", of_b)))
    met = of_x.join(shuffled(of_y), "t").where((F.col("x") < F.col("y")) & ~(F.col("wx") & F.col("wy")) & (F.col("rx") * F.col("ry") >= threshold * threshold - 1e-9))
    of_x, of_y = (vec.where(held).select(F.col("o").alias(n), F.col("n2").alias(f"n{n}"), F.col("ts").alias(f"t{n}"), F.col("cs").alias(f"c{n}")) for n, held in (("x", of_a), ("y", of_b)))
    pairs = met.select("x", "y").distinct().join(shuffled(of_x), "x").join(shuffled(of_y), "y").select("x", "y", "nx", "tx", "cx", "ny", "ty", "cy")
    schema = f"x {vec.schema['o'].dataType.simpleString()}, y {vec.schema['o'].dataType.simpleString()}"
    found = pairs.mapInArrow(_over(threshold), schema)
    parts = [_blocks(rows) for rows in ([a] if b is None else [a, b])]
    if not all(parts):
        return found
    rows, to = parts[0], parts[-1]
    block = lambda n: F.pmod(F.xxhash64("o"), F.lit(n)).cast("int")
    wide = [vec.where(held).join(shuffled(r.where("wide").select("o")), "o") for r, held in ((a, of_a), (a if b is None else b, of_b))]
    left, right = wide[0].withColumn("i", block(rows)), wide[1].withColumn("j", block(to))
    # of two blocks of the same rows one order is enough
    left = left.withColumn("j", F.explode(F.sequence(F.col("i") if b is None else F.lit(0), F.lit(to - 1))))
    right = right.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("j") if b is None else F.lit(rows - 1))))
    keys = ["g", "i", "j"]
    # named anew, as both sides come from the same table
    left, right = (s.select(*[F.col(c).alias(c) for c in (*keys, "o", "n2", "ts", "cs")]) for s in (left, right))
    met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_compared(threshold), schema)
    return found.union(met.where("x != y").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct())


def _blocks(rows: DataFrame) -> int:
    """Number of blocks for the wide ones of ``rows``: as the largest group needs them."""
    weight = rows.where("wide").groupBy("g").agg(F.sum(F.greatest("size", F.lit(ROW_TERMS))).alias("n")).agg(F.max("n")).first()[0]
    return -(-weight // BLOCK_TERMS) if weight else 0


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that the driver never gathers to broadcast it: its compressed size says little of what that takes."""
    return df.hint("merge")


def _lists(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A column of lists of whole numbers: all of them in a row, and how many each list has."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return whole.flatten().to_numpy(zero_copy_only=False), np.diff(whole.offsets.to_numpy())


def _over(threshold: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of pairs with both vectors those over the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sides = []
            for n in ("x", "y"):
                t, sizes = _lists(b.column(f"t{n}"))
                sides += [t, _lists(b.column(f"c{n}"))[0], np.concatenate(([0], np.cumsum(sizes)))]
            tx, cx, at_x, ty, cy, at_y = sides
            dots = np.zeros(len(b))
            for k in range(len(b)):
                x, y = slice(at_x[k], at_x[k + 1]), slice(at_y[k], at_y[k + 1])
                of = ty[y]
                place = np.minimum(np.searchsorted(of, tx[x]), len(of) - 1)
                dots[k] = np.dot(cx[x], np.where(of[place] == tx[x], cy[y][place], 0))
            keep = dots / np.sqrt(*_product(b.column("nx"), b.column("ny"))) > threshold
            yield b.select(["x", "y"]).filter(pa.array(keep))

    return run


def _product(nx: pa.Array, ny: pa.Array) -> tuple[np.ndarray]:
    return (nx.to_numpy(zero_copy_only=False).astype(np.float64) * ny.to_numpy(zero_copy_only=False),)


class _Block:
    """Rows of a block by the terms that two blocks share: row, column and count of each entry."""

    def __init__(self, rows: pa.Table) -> None:
        self.o, self.n2 = rows.column("o").combine_chunks(), rows.column("n2").to_numpy().astype(np.float64)
        self.t, sizes = _lists(rows.column("ts"))
        self.c = _lists(rows.column("cs"))[0].astype(np.float64)
        self.row = np.repeat(np.arange(len(sizes)), sizes)

    def number(self, shared: np.ndarray) -> None:
        place = np.minimum(np.searchsorted(shared, self.t), len(shared) - 1)
        keep = shared[place] == self.t
        self.row, self.column, self.c = self.row[keep], place[keep], self.c[keep]
        self.at = np.concatenate(([0], np.cumsum(np.bincount(self.row, minlength=len(self.n2)))))

    def sketch(self, column: np.ndarray, own: int, width: int) -> np.ndarray:
        """Counts of the first ``own`` columns, roots of the weights of the others, divided by the row's length."""
        to = column[self.column]
        squares = np.bincount(self.row * width + to, self.c * self.c, len(self.n2) * width).reshape(len(self.n2), width)
        return np.sqrt(squares / self.n2[:, None]).astype(np.float32)


def _compared(threshold: float) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Pairs of a row of either block whose cosine is over the threshold."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        kind = left.schema.field("o").type
        none = pa.table({"x": pa.array([], kind), "y": pa.array([], kind)})
        if not (len(left) and len(right)):
            return none
        a, b = _Block(left), _Block(right)
        shared = np.intersect1d(a.t, b.t)
        if not len(shared):
            return none
        a.number(shared)
        b.number(shared)
        # the heaviest terms have their own columns
        weight = np.bincount(a.column, a.c * a.c, len(shared)) * np.bincount(b.column, b.c * b.c, len(shared))
        own = min(OWN_COLUMNS, len(shared))
        column = np.empty(len(shared), np.int64)
        by_weight = np.argsort(-weight, kind="stable")
        column[by_weight[:own]] = np.arange(own)
        column[by_weight[own:]] = own + np.arange(len(shared) - own) % SHARED_COLUMNS
        width = int(column.max()) + 1
        of_a, of_b = a.sketch(column, own, width), b.sketch(column, own, width)
        dense, xs, ys = np.zeros(len(shared)), [], []
        for start in range(0, len(of_a), AT_ONCE):
            likely = of_a[start:start + AT_ONCE] @ of_b.T > threshold - 1e-3
            for k in np.flatnonzero(likely.any(1)):
                to, x = np.flatnonzero(likely[k]), start + int(k)
                mine = slice(a.at[x], a.at[x + 1])
                dense[a.column[mine]] = a.c[mine]
                sizes = b.at[to + 1] - b.at[to]
                ends = np.cumsum(sizes)
                entries = np.arange(ends[-1]) + np.repeat(b.at[to] - ends + sizes, sizes)
                dots = np.bincount(np.repeat(np.arange(len(to)), sizes), dense[b.column[entries]] * b.c[entries], len(to))
                dense[a.column[mine]] = 0
                over = to[dots / np.sqrt(a.n2[x] * b.n2[to]) > threshold]
                xs.append(np.full(len(over), x))
                ys.append(over)
        take = lambda o, at: o.take(pa.array(np.concatenate(at) if at else np.array([], np.int64)))
        return pa.table({"x": take(a.o, xs), "y": take(b.o, ys)})

    return run
