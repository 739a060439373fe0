"""Embedding near-dedup by product quantisation, without losing a link.

Unit vectors go to the inverted list of their nearest coarse centroid; what is
left is coded by subspace, with the error of each code kept. With d the largest
distance of a link, a vector probes each list that can hold a partner: if y is
nearest to centroid j and x to i, the plane between the two parts x from y, so
``|x-c_j|^2 - |x-c_i|^2 <= 2 d |c_i-c_j|``; and ``|x-c_j| <= d + radius_j``. In
a list, table look-ups give the distances of a query to all codes; entries within
d plus their code's error, which no link can miss, are ranked by exact cosine.

Equal vectors of a label form one class. The lists of a label travel in bunches,
to each of which a query goes once, whatever lists of it it probes. Bunches are
cut in parts of bounded size; blocks return counts and a spanning forest of
their links, never pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import dealt_out, stash
from .components import connected_components
from .jaccard import Forest
from .vectors import bounded_sample, is_usable, kmeans, packed

SAMPLE, MAX_LISTS, PER_LIST = 20_000, 4096, 2048
#: Vectors in a bunch of lists, and in a part of it.
PART = 16_384
#: Queries of a bunch that one task takes.
QUERIES = 32_768
SUBSPACES, CODES = 8, 64


class ProductQuantizer:
    """Coarse centroids and codebooks of residual subspaces."""

    def __init__(self, sample: np.ndarray, lists: int):
        self.coarse = kmeans(sample, lists)
        near = self.nearest(sample)[0]
        rest = sample - self.coarse[near]
        self.cuts = np.array_split(np.arange(sample.shape[1]), min(SUBSPACES, sample.shape[1]))
        self.books = [kmeans(rest[:, c], CODES, rounds=5) for c in self.cuts]

    def distances(self, x: np.ndarray) -> np.ndarray:
        """Squared distances to all coarse centroids."""
        return np.maximum(0, (x * x).sum(axis=1)[:, None] - 2 * x @ self.coarse.T + (self.coarse**2).sum(axis=1))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest list of each vector and the distance to its centroid."""
        at, far = [], []
        for a in range(0, len(x), 4096):
            d = self.distances(x[a : a + 4096])
            at.append(d.argmin(axis=1))
            far.append(np.sqrt(d.min(axis=1)))
        return np.concatenate(at), np.concatenate(far)

    def encode(self, x: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the residuals, and the distances of vectors to what the codes stand for."""
        rest = x - self.coarse[lists]
        codes, error = np.zeros((len(x), len(self.cuts)), np.uint8), np.zeros(len(x))
        for m, (cut, book) in enumerate(zip(self.cuts, self.books)):
            part = rest[:, cut]
            d = (part * part).sum(axis=1)[:, None] - 2 * part @ book.T + (book * book).sum(axis=1)
            codes[:, m] = d.argmin(axis=1)
            error += np.maximum(0, d.min(axis=1))
        return codes, np.sqrt(error)

    def probes(self, x: np.ndarray, radii: np.ndarray, reach: float) -> Iterator[np.ndarray]:
        """For each vector the lists that can hold a vector within ``reach`` of it."""
        gaps = np.sqrt(np.maximum(0, ((self.coarse[:, None, :] - self.coarse[None, :, :]) ** 2).sum(axis=2))) if len(self.coarse) <= 256 else None
        for row, d in zip(x, self.distances(x)):
            i = d.argmin()
            gap = gaps[i] if gaps is not None else np.sqrt(((self.coarse - self.coarse[i]) ** 2).sum(axis=1))
            yield np.flatnonzero((d - d[i] <= 2 * reach * gap + 1e-9) & (np.sqrt(d) <= reach + radii + 1e-9) & (radii >= 0))

    def table_distances(self, queries: np.ndarray, centroid: int, codes: np.ndarray) -> np.ndarray:
        """Squared distances of queries to coded entries of a list, by look-ups."""
        rest = queries - self.coarse[centroid]
        out = np.zeros((len(queries), len(codes)), np.float32)
        for m, (cut, book) in enumerate(zip(self.cuts, self.books)):
            part = rest[:, cut]
            table = ((part * part).sum(axis=1)[:, None] - 2 * part @ book.T + (book * book).sum(axis=1)).astype(np.float32)
            out += table[:, codes[:, m]]
        return out


def _placed(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pq = shared.value
        for b in batches:
            if not len(b):
                continue
            x = packed(b.column(2))
            lists, far = pq.nearest(x)
            codes, error = pq.encode(x, lists)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lists), pa.array(far), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error)], ["id", "label", "v", "m", "list", "far", "codes", "error"])

    return run


def _probed(shared, reach: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pq, radii = shared.value
        for b in batches:
            if len(b):
                x = packed(b.column(2))
                own = pq.nearest(x)[0]
                # the bounds hold both ways: of two vectors within reach, the one of the earlier list meets the other
                lists = [[int(k), *p[p > k].tolist()] for k, p in zip(own, pq.probes(x, radii, reach))]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(own, pa.int64()), pa.array(lists, pa.list_(pa.int64()))], ["id", "label", "v", "m", "own", "lists"])

    return run


def _linked(shared, threshold: float, reach: float):
    def run(key, queries: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"id": pd.array([], "int64"), "links": pd.array([], "int64"), "other": pd.array([], "Int64")})
        if not len(queries) or not len(entries):
            return empty
        pq = shared.value[0]
        entries = entries.sort_values("list", kind="stable")
        y, codes = np.stack(entries["v"]).astype(np.float64), np.stack([np.frombuffer(c, np.uint8) for c in entries["codes"]])
        limit = (reach + entries["error"].to_numpy() + 1e-4) ** 2
        y_id, m, x_id = entries["id"].to_numpy(), entries["m"].to_numpy(), queries["id"].to_numpy()
        lists, starts = np.unique(entries["list"].to_numpy(), return_index=True)
        ends, own = np.r_[starts[1:], len(y_id)], queries["own"].to_numpy()
        probed = queries["lists"].to_list()
        asks_at = np.repeat(np.arange(len(x_id)), [len(p) for p in probed])
        asks_list = np.concatenate(probed)
        order = np.argsort(asks_list, kind="stable")
        asks_at, asks_list = asks_at[order], asks_list[order]
        ids, at = np.unique(np.r_[x_id, y_id], return_inverse=True)
        links, back, forest = np.zeros(len(x_id), np.int64), np.zeros(len(y_id), np.int64), Forest(len(ids))
        x_m, x_all = queries["m"].to_numpy(), np.stack(queries["v"]).astype(np.float64)
        for k, start, end in zip(lists.tolist(), starts.tolist(), ends.tolist()):
            asking = asks_at[np.searchsorted(asks_list, k) : np.searchsorted(asks_list, k, side="right")]
            for a in range(0, len(asking), 512):
                of = asking[a : a + 512]
                x = x_all[of]
                near = pq.table_distances(x, k, codes[start:end]) <= limit[start:end]
                i, j = np.nonzero(near & (x_id[of, None] != y_id[None, start:end]))
                for s in range(0, len(i), 100_000):  # exact rerank
                    p, q = i[s : s + 100_000], j[s : s + 100_000] + start
                    ok = np.einsum("ij,ij->i", x[p], y[q]) >= threshold
                    p, q = of[p[ok]], q[ok]
                    np.add.at(links, p, m[q])
                    far = own[p] != k  # such a pair is met here only: it counts for both
                    np.add.at(back, q[far], x_m[p[far]])
                    forest.add(at[p], at[len(x_id) + q])
        edges, found = ids[forest.edges()], np.r_[links, back]
        some, all_ids = np.flatnonzero(found), np.r_[x_id, y_id]
        return pd.concat([empty, pd.DataFrame({"id": all_ids[some], "links": found[some], "other": pd.array([None] * len(some), "Int64")}),
                          pd.DataFrame({"id": edges[:, 0], "links": np.zeros(len(edges), np.int64), "other": pd.array(edges[:, 1], "Int64")})])

    return run


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", threshold: float = 0.93) -> DataFrame:
    """``(id, n_links, component_id, kept)``, a row for each row of ``vectors``.

    Links are pairs of equal, non-null labels, equal length and a cosine of at
    least ``threshold`` in double precision. Vectors that are null, empty, zero or
    hold null or non-finite components, and null labels, link with nothing.
    component_id is the smallest id reachable, itself included; kept tells whether
    that is the row's own. Rows of equal vectors (also with equal ids) link as
    other rows do; ids must be whole numbers, and a null id stays null.
    """
    spark = vectors.sparkSession
    usable = is_usable(F.col(vec_col)) & F.col(label_col).isNotNull()
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vec_col).cast("array<double>").alias("raw"), usable.alias("ok"))
    norm = F.sqrt(F.aggregate("raw", F.lit(0.0), lambda s, x: s + x * x))
    # a power of two first, so that no square over- or underflows
    peak = F.array_max(F.transform("raw", F.abs))
    rows = rows.withColumn("raw", F.when(F.col("ok"), F.transform("raw", lambda x: x / peak)).otherwise(F.array().cast("array<double>")))
    rows = rows.withColumn("v", F.transform("raw", lambda x: x / norm)).withColumn("key", F.sha2(F.concat_ws(",", F.col("label"), F.col("v").cast("array<string>")).cast("binary"), 256))
    rows = rows.select("id", F.concat_ws(":", F.size("v").cast("string"), "label").alias("label"), "v", "ok", F.unhex("key").alias("key"))
    out_name = id_col
    good = stash(rows.where("ok").select("id", "label", "v", "key"))
    alone = rows.where("NOT ok").select(F.col("id").alias(out_name), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    # classes by number, in the order of their keys: small whole numbers for the joins
    classes = good.groupBy("key").agg(F.min("id").alias("least_id"), F.count("*").alias("m"), F.first("label").alias("label"), F.first("v").alias("v"))
    classes = stash(classes.withColumn("id", F.monotonically_increasing_id()))
    dims = [r["d"] for r in classes.select(F.size("v").alias("d")).distinct().collect()]
    found = None
    for d in dims:
        some = classes.where(F.size("v") == d).select("id", "label", "v", "m")
        part = _block_links(some, threshold)
        found = part if found is None else found.union(part)
    if found is None:
        return alone
    found = stash(found)
    links = found.where("links > 0").groupBy("id").agg(F.sum("links").alias("links"))
    comps = connected_components(found.where("other IS NOT NULL"), "id", "other")
    of = classes.select("id", "key", "least_id", "m").join(dealt_out(comps.select(F.col("node").alias("id"), "root")), "id", "left").withColumn("root", F.coalesce("root", "id"))
    least = of.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of = of.join(dealt_out(least), "root").join(dealt_out(links), "id", "left").select("key", "component_id", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links"))
    out = good.select("id", "key").join(dealt_out(of), "key").select(F.col("id").alias(out_name), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
    return out.union(alone)


def _block_links(classes: DataFrame, threshold: float) -> DataFrame:
    """``(id, links, other)``: links of each class, and rows of a spanning forest."""
    spark = classes.sparkSession
    n = classes.count()
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    sample = bounded_sample(classes, n, SAMPLE)
    if not len(sample):
        sample = packed(classes.select("v").limit(1000).toArrow()["v"])
    pq = ProductQuantizer(sample, min(MAX_LISTS, max(1, n // PER_LIST)))
    shared = spark.sparkContext.broadcast(pq)
    entries = stash(classes.select("id", "label", "v", "m").mapInArrow(_placed(shared), "id long, label string, v array<double>, m long, list long, far double, codes binary, error double"))
    radii = np.full(len(pq.coarse), -1.0)
    for r in entries.groupBy("list").agg(F.max("far").alias("r")).collect():  # as many rows as lists
        radii[r["list"]] = r["r"]
    shared = spark.sparkContext.broadcast((pq, radii))
    # lists of a label in bunches of about PART vectors; a longer one is a bunch of its own, or the end of one
    per_list = entries.groupBy("label", "list").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("label").orderBy("list")) - F.col("n")  # rows of a label: its lists, MAX_LISTS at most
    bunches = stash(per_list.select("label", "list", "n", F.floor(before / PART).alias("bunch")))
    sizes = bunches.groupBy("label", "bunch").agg(F.ceil(F.sum("n") / PART).cast("int").alias("parts"))
    entries = entries.join(bunches.select("label", "list", "bunch").join(sizes, ["label", "bunch"]), ["label", "list"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    queries = stash(classes.select("id", "label", "v", "m").mapInArrow(_probed(shared, reach), "id long, label string, v array<double>, m long, own long, lists array<long>"))
    # the lists that each label has, by bunch, meet the lists that a query probes
    of_label = bunches.groupBy("label", "bunch").agg(F.collect_list("list").alias("of_bunch")).groupBy("label").agg(F.collect_list(F.struct("bunch", "of_bunch")).alias("bunches"))
    met = F.transform("bunches", lambda b: F.struct(b["bunch"].alias("bunch"), F.array_intersect("lists", b["of_bunch"]).alias("lists")))
    asking = queries.join(of_label, "label").select("id", "label", "v", "m", "own", F.inline(F.filter(met, lambda b: F.size(b["lists"]) > 0)))
    # bunches that very many probe have their queries dealt out too, so that no group is unbounded; others go in one piece
    asked = stash(asking.groupBy("label", "bunch").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("deals")))
    sizes = sizes.join(asked, ["label", "bunch"])
    queries = asking.join(sizes, ["label", "bunch"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    queries = queries.withColumn("deal", F.pmod(F.hash("id"), F.col("deals")))
    entries = entries.join(asked, ["label", "bunch"]).withColumn("deal", F.explode(F.sequence(F.lit(0), F.col("deals") - 1)))
    keys = ["label", "bunch", "part", "deal"]
    return queries.select(*keys, "id", "v", "m", "own", "lists").groupBy(*keys).cogroup(entries.select(*keys, "id", "v", "m", "list", "codes", "error").groupBy(*keys)).applyInPandas(_linked(shared, threshold, reach), "id long, links long, other long")
