"""Approximate nearest neighbours by cross-polytope hashing.

Nearness is the inner product. Vectors are parted by norm into ranges; those of
a range are scaled by its largest norm and get one more component that makes
them unit vectors, so that the nearest by inner product are the nearest by
angle. Each table rotates them by sign flips and fast Hadamard transforms, three
times over, and hashes to the nearest signed axis. A query probes in each table
of each range its likeliest axes; what the probed buckets hold is reranked by
the exact inner product of the original vectors, bucket by bucket. Ranges of few
vectors are searched whole, ranges whose norms cannot reach the answer not at
all, and queries that find too few candidates are compared with every vector.

Equal vectors form one class of which the smallest ids matter alone: the others
come after these in any answer. Neighbouring buckets of a table travel as one
group of about ``PART`` vectors, to which a query goes once; groups that hold
more are cut in parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stash
from .vectors import is_usable, packed

TABLES, PROBES, PART = 16, 64, 8192
#: Longest vectors, as a multiple of k, whose scores bound those of an answer from below.
LONGEST = 64
#: Steps of norms to a doubling; a hashed range spans a doubling.
STEPS = 8


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Hadamard transform of rows whose length is a power of two."""
    n, h = x.shape[1], 1
    while h < n:
        x = x.reshape(len(x), -1, 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


class CrossPolytope:
    """Pseudo-rotations of all tables for ``count`` vectors; a bucket is a signed axis of each of a table's rotations."""

    def __init__(self, dims: int, count: int, tables: int = TABLES, probes: int = PROBES, seed: int = 11):
        self.n = 1 << max(1, (dims - 1).bit_length())
        left = 1 << max(0, int(np.log2(max(1.0, 0.5 * count**0.8))))
        self.buckets, self.axes = left, []
        while left > 1:
            self.axes.append(min(self.n, left // 2))
            left //= 2 * self.axes[-1]
        self.probes = min(probes, self.buckets)
        # one table is enough while all its buckets are probed; more buckets need more tables
        self.tables = min(tables, max(1, int((self.buckets / probes) ** (4 / 3))))
        #: neighbouring buckets of a group: those of about PART vectors, an eighth of a table at most
        self.span = 1 << max(0, int(np.log2(max(1, min(self.buckets // 8, self.buckets * PART // max(1, count))))))
        self.signs = np.random.default_rng(seed).choice([-1.0, 1.0], (tables, max(1, len(self.axes)), 3, self.n))

    def rotated(self, x: np.ndarray, table: int, nth: int = 0) -> np.ndarray:
        y = np.zeros((len(x), self.n))
        y[:, : x.shape[1]] = x
        for s in self.signs[table, nth]:
            y = hadamard(y * s)
        return y

    def nearest_buckets(self, x: np.ndarray, table: int, probes: int = 1) -> np.ndarray:
        """The likeliest buckets of each row, the best first: by the sum of the row's parts along their signed axes."""
        found, score = np.zeros((len(x), 1), np.int64), np.zeros((len(x), 1))
        for nth, m in enumerate(self.axes):
            y = self.rotated(x, table, nth)[:, :m]
            both = np.concatenate([y, -y], axis=1)
            score = (score[:, :, None] + both[:, None]).reshape(len(x), -1)
            found = (found[:, :, None] * (2 * m) + np.arange(2 * m)).reshape(len(x), -1)
            keep = min(probes, score.shape[1])
            top = np.argpartition(-score, keep - 1, axis=1)[:, :keep] if keep < score.shape[1] else np.tile(np.arange(keep), (len(x), 1))
            score, found = np.take_along_axis(score, top, axis=1), np.take_along_axis(found, top, axis=1)
        return np.take_along_axis(found, np.argsort(-score, axis=1, kind="stable"), axis=1)

    def keys(self, x: np.ndarray, probes: int) -> np.ndarray:
        """Buckets in all tables."""
        return np.concatenate([self.nearest_buckets(x, t, probes) + t * self.buckets for t in range(self.tables)], axis=1)


class Ranges:
    """Ranges of norms, the largest first, from ``(step, n, largest norm)`` of each step; each with its hashing.

    Ranges whose norms under- or overflow are searched whole: such vectors have no direction.
    """

    def __init__(self, steps: list[tuple[int, int, float]], dims: int, tables: int, probes: int):
        self.lows, self.largest, counts = [], [], []
        for step, count, norm in sorted(steps, reverse=True):
            hashable = 0 < norm < np.inf
            if self.lows and hashable and top - step < STEPS and np.isfinite(self.largest[-1]):
                counts[-1] += count
            else:
                self.lows.append(step)
                self.largest.append(norm)
                counts.append(count)
                top = step
            self.lows[-1] = step
        self.hashers = [CrossPolytope(dims, n, tables, probes) if 0 < norm < np.inf else None for n, norm in zip(counts, self.largest)]
        #: first key of each range, a multiple of its buckets
        self.first, at = [], 0
        for h in self.hashers:
            at = -(-at // h.buckets) * h.buckets if h else at
            self.first.append(at)
            at += h.buckets * h.tables if h else 0

    def of(self, steps: np.ndarray) -> np.ndarray:
        return np.searchsorted(-np.array(self.lows), -steps)


GROUPS = "groups array<struct<g: long, b: array<long>>>"


def _keyed(batch: pa.RecordBatch, at: list[np.ndarray], keys: list[np.ndarray], spans: list[int]) -> pa.RecordBatch:
    """``batch`` with the buckets of ``keys``, whose rows are ``at``, by group: a group is named by its first bucket."""
    none = np.zeros(0, np.int64)
    rows = np.concatenate([none, *(np.repeat(r, k.shape[1]) for r, k in zip(at, keys))])
    flat = np.concatenate([none, *(k.ravel() for k in keys)])
    group = np.concatenate([none, *((k - k % span if span else k).ravel() for k, span in zip(keys, spans))])
    order = np.lexsort((flat, group, rows))
    rows, flat, group = rows[order], flat[order], group[order]
    starts = np.flatnonzero(np.r_[True, (np.diff(rows) != 0) | (np.diff(group) != 0)]) if len(rows) else none
    inner = pa.ListArray.from_arrays(pa.array(np.r_[starts, len(rows)], pa.int32()), pa.array(flat, pa.int64()))
    ends = np.r_[0, np.cumsum(np.bincount(rows[starts], minlength=len(batch)))]
    groups = pa.StructArray.from_arrays([pa.array(group[starts], pa.int64()), inner], ["g", "b"])
    return pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), groups)], [*batch.schema.names, "groups"])


def _hashed_entries(ranges: Ranges, spread: int):
    """Adds the buckets of ``(cls, v, step)``; ranges without hashing are one bucket for each part of the queries, below 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            x, of = packed(b.column(1)), ranges.of(b.column(2).to_numpy())
            at, keys, spans = [], [], []
            for r in np.unique(of).tolist():
                rows = np.flatnonzero(of == r)
                at.append(rows)
                hasher = ranges.hashers[r]
                spans.append(hasher.span if hasher else 0)
                if hasher is None:
                    keys.append(np.tile(-1 - r * spread - np.arange(spread), (len(rows), 1)))
                    continue
                y = x[rows] / ranges.largest[r]
                # only the last component tells queries from entries: it raises entries to unit length
                unit = np.c_[y, np.sqrt(np.maximum(0, 1 - (y * y).sum(axis=1)))]
                keys.append(hasher.keys(unit, 1) + ranges.first[r])
            yield _keyed(b, at, keys, spans)

    return run


def _hashed_queries(ranges: Ranges, spread: int, k: int, longest: np.ndarray):
    """Adds the buckets that ``(id, v, cls)`` probes, in the ranges that can hold one of its ``k`` nearest.

    ``longest`` are vectors of different rows: but one of them are candidates of
    any query, and so the k + 1st of their scores is one that the kth nearest has.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in (whole.slice(a, 1024) for a in range(0, len(whole), 1024)):
                x = packed(b.column(1))
                y = x / np.abs(x).max(axis=1, keepdims=True)
                norm = np.linalg.norm(y, axis=1, keepdims=True)
                low = np.full(len(x), -np.inf)  # by the query's norm
                if len(longest) > k:
                    low = np.partition(y / norm @ longest.T, -k - 1, axis=1)[:, -k - 1]
                low -= 1e-9 * np.abs(low)
                part = b.column(0).to_numpy() % spread
                at, keys, spans = [], [], []
                for r, largest in enumerate(ranges.largest):
                    rows = np.flatnonzero(~(low > largest))
                    if not len(rows):
                        continue
                    at.append(rows)
                    hasher = ranges.hashers[r]
                    spans.append(hasher.span if hasher else 0)
                    if hasher is None:
                        keys.append(-1 - r * spread - part[rows, None])
                        continue
                    keys.append(hasher.keys(np.c_[y[rows] / norm[rows], np.zeros(len(rows))], hasher.probes) + ranges.first[r])
                yield _keyed(b, at, keys, spans)

    return run


def _best(x: np.ndarray, y: np.ndarray, least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of ``x``, rows of ``y`` and scores: of each row of ``x`` the ``k`` largest inner products, of equal ones those of the smallest ``least``.

    A first product finds all that can be among them, whatever its rounding;
    these are scored one by one.
    """
    s = x @ y.T
    rows, columns = np.repeat(np.arange(len(x)), len(y)), np.tile(np.arange(len(y)), len(x))
    if len(y) > k:
        cut = np.partition(s, -k, axis=1)[:, -k, None]
        slack = 1e-12 * np.linalg.norm(x, axis=1)[:, None] * np.linalg.norm(y, axis=1).max()
        rows, columns = np.nonzero(~(s < cut - slack))
    score = np.concatenate([np.zeros(0), *(np.einsum("ij,ij->i", x[rows[a : a + 65536]], y[columns[a : a + 65536]]) for a in range(0, len(rows), 65536))])
    kept = _first(rows, score, least[columns], k)
    return rows[kept], columns[kept], score[kept]


def _first(rows: np.ndarray, score: np.ndarray, least: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` first of each row: larger scores first, of equal ones smaller ``least``."""
    order = np.lexsort((least, -score, rows))
    rows = rows[order]
    starts = np.flatnonzero(np.r_[True, np.diff(rows) > 0]) if len(rows) else np.zeros(0, np.int64)
    return order[np.arange(len(rows)) - np.repeat(starts, np.diff(np.r_[starts, len(rows)])) < k]


def _reranked(k: int):
    """Of each query, the best classes among those in the buckets of a group that it probes."""

    def run(key, queries: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        found = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        if len(queries) and len(entries):
            x, y = (np.stack(f["v"]).astype(np.float64) for f in (queries, entries))
            least, bucket = entries["least"].to_numpy(), np.concatenate(entries["b"].to_numpy())
            probing, asked = np.repeat(np.arange(len(x)), queries["b"].map(len)), np.concatenate(queries["b"].to_numpy())
            by_bucket, by_asked = np.argsort(bucket, kind="stable"), np.argsort(asked, kind="stable")
            got = []
            for b in np.unique(bucket).tolist():
                of = by_bucket[slice(*np.searchsorted(bucket, (b, b + 1), sorter=by_bucket))]
                who = probing[by_asked[slice(*np.searchsorted(asked, (b, b + 1), sorter=by_asked))]]
                for a in range(0, len(who), 256):
                    # one more than k: the query's own class counts only if others share it
                    rows, columns, score = _best(x[who[a : a + 256]], y[of], least[of], k + 1)
                    got.append((who[a + rows], of[columns], score))
            if got:
                found = [np.concatenate(c) for c in zip(*got)]
                kept = _first(found[0], found[2], least[found[1]], k + 1)
                found = [c[kept] for c in found]
        rows, columns, score = found
        return pd.DataFrame({"q": queries["q"].to_numpy()[rows], "cls": entries["cls"].to_numpy()[columns], "least": entries["least"].to_numpy()[columns], "score": score})

    return run


def search(vectors: DataFrame, is_query: Column | None = None, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", tables: int = TABLES, probes: int = PROBES) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` found nearest of each query.

    Queries are the rows where ``is_query`` holds, by default those whose id is
    divisible by 20; candidates are all rows but the query's own. Ties among those
    found go to the smaller id. Up to about a thousand vectors of like norms have
    no more buckets than are probed, so that all are found; queries that find
    fewer than ``k`` search all vectors again, so with fewer candidates all come. Vectors that are null, empty,
    zero or hold null or non-finite components, rows with null ids, and vectors
    of another length than the query's take no part. Of rows with equal ids and
    vectors one takes part; ids with several vectors are several candidates.
    """
    spark = vectors.sparkSession
    is_query = F.col(id_col) % 20 == 0 if is_query is None else is_query
    usable = vectors.where(is_usable(F.col(vec_col)) & F.col(id_col).isNotNull())
    rows = usable.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("query"))
    # + 0.0 makes -0.0 and 0.0 one
    rows = rows.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0))).withColumn("cls", F.xxhash64("v"))
    rows = rows.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)))
    # norms under- or overflown have steps of their own
    step = F.when(F.col("norm") == 0, -(1 << 20)).when(F.col("norm") == float("inf"), 1 << 20).otherwise(F.floor(F.log2("norm") * STEPS))
    rows = stash(rows.withColumn("step", step.cast("long")))
    out = None
    for r in rows.select(F.size("v").alias("d")).distinct().collect():
        part = _search_dim(rows.where(F.size("v") == r["d"]), r["d"], k, tables, probes)
        out = part if out is None else out.union(part)
    if out is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return out


def _search_dim(rows: DataFrame, dims: int, k: int, tables: int, probes: int) -> DataFrame:
    least = Window.partitionBy("cls").orderBy("id")
    # of a class only the k + 1 smallest ids can come up; each task keeps its own first ones
    members = rows.select("cls", "id").withColumn("nth", F.row_number().over(least)).where(F.col("nth") <= k + 1).select("cls", "id")
    members = stash(members.distinct())
    classes = rows.groupBy("cls").agg(F.first("v").alias("v"), F.first("step").alias("step"), F.first("norm").alias("norm"), F.min("id").alias("least"))
    steps = rows.select("cls", "step", "norm").distinct().groupBy("step").agg(F.count("*"), F.max("norm")).collect()
    ranges = Ranges([tuple(r) for r in steps], dims + 1, tables, probes)
    longest = np.zeros((0, dims))
    if len(ranges.lows) > 1:
        # of rows that share an id, one: others may be a query's own
        top = classes.orderBy(F.desc("norm")).limit(LONGEST * k).select("least", "v").toArrow()
        longest = packed(top["v"])[np.unique(top["least"].to_numpy(), return_index=True)[1]]
    asked = rows.where("query").select("id", "v", "cls").dropDuplicates(["id", "cls"])
    spread = max(1, -(-asked.count() // PART))
    entries = stash(classes.select("cls", "v", "step", "least").mapInArrow(_hashed_entries(ranges, spread), f"cls long, v array<double>, step long, least long, {GROUPS}"))
    probing = asked.mapInArrow(_hashed_queries(ranges, spread, k, longest), f"id long, v array<double>, cls long, {GROUPS}")
    ranked = stash(_ranked(_found(probing, entries, k), members, k))
    short = stash(asked.join(ranked.where(F.col("rank") == k).select(F.col("query_id").alias("id")), "id", "left_anti"))
    spread = -(-short.count() // PART)
    if not spread:
        return ranked
    one = lambda g: F.struct(g.cast("long").alias("g"), F.array(F.lit(0).cast("long")).alias("b"))
    probing = short.select("id", "v", "cls", F.array(one(F.pmod("id", F.lit(spread)))).alias("groups"))
    everywhere = entries.select("cls", "v", "least", F.transform(F.sequence(F.lit(0), F.lit(spread - 1)), one).alias("groups"))
    again = _ranked(_found(probing, everywhere, k), members, k)
    return ranked.join(short.select(F.col("id").alias("query_id")).distinct(), "query_id", "left_anti").union(again)


def _found(asked: DataFrame, entries: DataFrame, k: int) -> DataFrame:
    """``(q, cls, score)``: the best classes of each query in the buckets that it probes."""
    entries = entries.select("cls", "v", "least", F.inline("groups"))
    sizes = entries.groupBy("g").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    entries = entries.join(sizes, "g").withColumn("part", F.pmod(F.hash("cls"), F.col("parts")))
    asked = asked.select(F.col("id").alias("q"), "v", F.inline("groups")).join(sizes, "g").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    found = asked.select("g", "part", "q", "v", "b").groupBy("g", "part").cogroup(entries.select("g", "part", "cls", "v", "least", "b").groupBy("g", "part")).applyInPandas(_reranked(k), "q long, cls long, least long, score double")
    found = found.groupBy("q", "cls").agg(F.max("score").alias("score"), F.first("least").alias("least"))
    # of classes beyond these, none has an id before k others
    best = Window.partitionBy("q").orderBy(F.desc("score"), "least", "cls")
    return found.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k + 1).drop("nth", "least")


def _ranked(found: DataFrame, members: DataFrame, k: int) -> DataFrame:
    each = found.join(members, "cls").where("id != q")
    order = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    ranked = each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("q").alias("query_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")
