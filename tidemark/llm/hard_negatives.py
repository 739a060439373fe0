"""Hard-negative mining by blocked dense products.

Components become whole numbers, so a product of blocks in float64 is exact
while every sum stays below 2^53; blocks that could exceed that are multiplied
in 64-bit integers. Anchors, a stated share of the rows, are broadcast block by
block, each of bounded bytes, against the candidates where these lie: no
candidate is shuffled. A first pass keeps each anchor's best positives, a
second, which knows their scores, the best negatives in the window of each. In
both, a task keeps no more than the answer of its own candidates; the answers
of tasks are merged by anchor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import given_back, stash
from .vectors import packed

#: Bytes of a broadcast block of anchors, besides one anchor; candidates and anchors of one product.
BLOCK_BYTES, ROWS, LANES = 8 << 20, 4096, 256


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers: float64 where all sums stay below 2^53, else int64."""
    most = [int(np.abs(m).max(initial=0)) for m in (a, b)]
    bound = most[0] * most[1] * a.shape[1]
    if bound < 1 << 53:
        return a @ b.T
    if bound >= 1 << 63:
        raise ArithmeticError("inner products exceed 64 bits")
    return a.astype(np.int64) @ b.astype(np.int64).T


def first_k(scores: np.ndarray, ok: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the ``k`` largest ``ok`` scores of each row; of equal ones, earlier columns."""
    keep = ok
    if scores.shape[1] > k:
        lowest = -np.inf if scores.dtype.kind == "f" else np.iinfo(np.int64).min
        masked = np.where(ok, scores, lowest)
        cut = np.partition(masked, -k, axis=1)[:, -k, None]
        above = ok & (masked > cut)
        at = ok & (masked == cut)
        keep = above | at & (np.cumsum(at, axis=1) <= k - above.sum(axis=1, keepdims=True))
    return np.nonzero(keep)


class Best:
    """The ``k`` best ``(score, id)`` of each slot: larger scores first, of equal ones smaller ids."""

    def __init__(self, slots: int, k: int):
        self.k, self.n, self.limit = k, 0, 2 * k * slots + (1 << 16)
        self.floor = np.full(slots, -np.inf)  # no lower score can still come in
        self.parts: list[tuple[np.ndarray, ...]] = []

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if len(slot):
            self.parts.append((slot, score.astype(np.int64), ids))
            self.n += len(slot)
            if self.n > self.limit:
                self.merged()

    def merged(self) -> tuple[np.ndarray, ...]:
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        slot, score, ids = map(np.concatenate, zip(*self.parts))
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        starts = np.flatnonzero(np.r_[True, np.diff(slot) > 0])
        rank = np.arange(len(slot)) - np.repeat(starts, np.diff(np.r_[starts, len(slot)]))
        slot, score, ids, rank = (x[rank < self.k] for x in (slot, score, ids, rank))
        last = rank == self.k - 1
        self.floor[slot[last]] = np.nextafter(score[last].astype(np.float64), -np.inf)
        self.parts, self.n = [(slot, score, ids)], len(slot)
        return slot, score, ids


class Anchors:
    """Anchors of one length: keys, ids, labels, and a matrix of whole numbers."""

    def __init__(self, key: np.ndarray, ids: np.ndarray, label: np.ndarray, x: np.ndarray):
        self.key, self.ids, self.label, self.x = key, ids, label, x
        #: of each positive, (position of its anchor, id, score, lowest and highest score of negatives), by place
        self.positives: list[tuple[np.ndarray, ...]] = []


def _whole(vectors: pa.Array | pa.ChunkedArray, scale: float, d: int) -> np.ndarray:
    return np.floor(packed(vectors) * scale) if d else np.zeros((len(vectors), 0))


def _candidates(batches: Iterator[pa.RecordBatch], scale: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(ids, labels, whole vectors)`` of equal length, by id, up to ``ROWS`` at a time."""
    for b in batches:
        for part in (b.slice(a, ROWS) for a in range(0, len(b), ROWS)):
            sizes = pc.list_value_length(part.column(2)).to_numpy(zero_copy_only=False)
            for d in np.unique(sizes).tolist():
                same = part if len(part) == (sizes == d).sum() else part.filter(pa.array(sizes == d))
                ids = same.column(0).to_numpy()
                order = np.argsort(ids, kind="stable")
                yield ids[order], same.column(1).to_numpy()[order], _whole(same.column(2), scale, d)[order]


def _positives(wave: Broadcast, scale: float, k: int):
    """``(key, id, score)``: the best positives of the wave's anchors among a task's candidates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: dict[int, Anchors] = wave.value
        best = {d: Best(len(a.key), k) for d, a in anchors.items()}
        for ids, label, y in _candidates(batches, scale):
            d = y.shape[1]
            if d not in anchors:
                continue
            a, kept = anchors[d], best[d]
            for at in range(0, len(a.key), LANES):
                lane = slice(at, at + LANES)
                ok = (a.label[lane, None] == label) & (a.ids[lane, None] != ids)
                s = product(a.x[lane], y)
                _add(kept, np.arange(at, at + len(s)), s, ok, ids, k)
        for d, kept in best.items():
            slot, score, ids = kept.merged()
            yield pa.RecordBatch.from_arrays([pa.array(anchors[d].key[slot]), pa.array(ids), pa.array(score)], ["key", "id", "score"])

    return given_back(run)


def _negatives(wave: Broadcast, scale: float, k: int):
    """``(key, nth, anchor_id, positive_id, positive_score, negative_id, negative_score)``: the best negatives in the window of each positive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: dict[int, Anchors] = wave.value
        best = {d: [Best(len(p[0]), k) for p in a.positives] for d, a in anchors.items()}
        for ids, label, y in _candidates(batches, scale):
            d = y.shape[1]
            if d not in anchors:
                continue
            a = anchors[d]
            for at in range(0, len(a.key), LANES):
                lane = slice(at, at + LANES)
                s = product(a.x[lane], y)
                differ = a.label[lane, None] != label
                for (of, _, _, low, high), kept in zip(a.positives, best[d]):
                    slots = np.arange(*np.searchsorted(of, (at, at + LANES)))
                    rows = of[slots] - at
                    t = s[rows]
                    ok = differ[rows] & (t >= low[slots, None].astype(s.dtype)) & (t <= high[slots, None].astype(s.dtype))
                    _add(kept, slots, t, ok, ids, k)
        for d, places in best.items():
            a = anchors[d]
            for nth, ((of, pid, score, _, _), kept) in enumerate(zip(a.positives, places), 1):
                slot, found, ids = kept.merged()
                out = [a.key[of[slot]], np.full(len(slot), nth, np.int32), a.ids[of[slot]], pid[slot], score[slot], ids, found]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, out)), [c.split()[0] for c in FOUND.split(", ")])

    return given_back(run)


FOUND = "key long, nth int, anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"


def _add(kept: Best, slots: np.ndarray, scores: np.ndarray, ok: np.ndarray, ids: np.ndarray, k: int) -> None:
    """Adds what can still be among the best of its slot."""
    live = np.flatnonzero((ok & (scores >= kept.floor[slots, None])).any(axis=1))
    if len(live):
        r, c = first_k(scores[live], ok[live], k)
        kept.add(slots[live[r]], scores[live[r], c], ids[c])


def share(score: np.ndarray, percent: int, up: bool) -> np.ndarray:
    """``percent`` hundredths of whole scores, rounded down or up, without overflow."""
    q, r = np.divmod(score, 100)
    return q * percent + (-(-r * percent // 100) if up else r * percent // 100)


def mine(
    vectors: DataFrame, is_anchor: Column | None = None, positives: int = 5, negatives: int = 10, window: tuple[int, int] = (30, 90), scale: float = 256,
    id_col: str = "vec_id", vec_col: str = "embedding", label: str | Column = "label", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Anchors are the rows where ``is_anchor`` holds, by default those whose id is
    divisible by 100. A component x counts as floor(``scale`` * x); scores are
    inner products. An anchor's positives are its first ``positives`` rows of the
    same label by score, then id; the negatives of a pair are the first
    ``negatives`` rows of other labels whose scores lie within the ``window`` of
    hundredths of the positive's score, both ends included. Fewer if there are
    fewer; no rows for a pair without negatives.

    Rows with null ids, labels or vectors, and vectors with null or non-finite
    components, take no part; vectors of different lengths never meet; an empty
    vector meets its like at 0. Repeated rows are rows of their own as
    candidates, but one anchor; a candidate with the anchor's own id is none.
    An id with several vectors or labels is several anchors. Scores beyond 64
    bits are an error.
    """
    spark = vectors.sparkSession
    is_anchor = F.col(id_col) % 100 == 0 if is_anchor is None else is_anchor
    label = F.col(label) if isinstance(label, str) else label
    v = F.col(vec_col) if vectors.schema[vec_col].dataType.simpleString() == "array<float>" else F.col(vec_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), v.alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    finite = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    rows = stash(rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & finite))
    blocks, found = _in_blocks(rows.where("anchor").select("id", "label", "v"), block_bytes), None
    for r in blocks.groupBy("block").count().orderBy("block").collect():
        part = _of_block(rows.select("id", "label", "v"), blocks.where(F.col("block") == r["block"]), positives, negatives, window, scale)
        found = part if found is None else found.union(part)
    if found is None:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    return found


def _in_blocks(anchors: DataFrame, block_bytes: int) -> DataFrame:
    """``(block, key, id, label, v)``: distinct anchors, each with a key, in blocks of no more than ``block_bytes`` and an anchor."""
    anchors = stash(anchors.distinct().withColumn("bytes", F.size("v") * 8 + 64))
    buckets = max(1, -(-(anchors.agg(F.sum("bytes")).first()[0] or 0) // block_bytes))
    anchors = anchors.withColumn("hash", F.xxhash64("id", "label", "v")).withColumn("bucket", F.pmod("hash", F.lit(buckets)))
    order = Window.partitionBy("bucket").orderBy("hash", "id", "label", "v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = F.sum("bytes").over(order) - F.col("bytes")
    block = F.col("bucket") * (1 << 31) + F.floor(start / block_bytes)
    return stash(anchors.select(block.alias("block"), (F.col("bucket") * (1 << 40) + F.count("*").over(order)).alias("key"), "id", "label", "v"))


def _of_block(candidates: DataFrame, block: DataFrame, positives: int, negatives: int, window: tuple[int, int], scale: float) -> DataFrame:
    """The answer for the anchors of one block, written."""
    sc = candidates.sparkSession.sparkContext
    rows, anchors = block.select("key", "id", "label", "v").toArrow().combine_chunks(), {}
    sizes = pc.list_value_length(rows["v"]).to_numpy()
    for d in np.unique(sizes).tolist():
        same = rows.filter(pa.array(sizes == d)).sort_by("key")
        anchors[d] = Anchors(*(same[c].to_numpy() for c in ("key", "id", "label")), _whole(same["v"], scale, d))
    wave = sc.broadcast(anchors)
    kept = Window.partitionBy("key").orderBy(F.desc("score"), "id")
    best = candidates.mapInArrow(_positives(wave, scale, positives), "key long, id long, score long").withColumn("nth", F.row_number().over(kept)).where(F.col("nth") <= positives)
    best = best.toArrow()  # as many for each anchor of the block at most
    wave.destroy()
    for a in anchors.values():
        mine_ = best.filter(pc.is_in(best["key"], pa.array(a.key)))
        for nth in range(1, positives + 1):
            at = mine_.filter(pc.equal(mine_["nth"], nth)).sort_by("key")
            score = at["score"].to_numpy()
            a.positives.append((np.searchsorted(a.key, at["key"].to_numpy()), at["id"].to_numpy(), score, share(score, window[0], True), share(score, window[1], False)))
    wave = sc.broadcast(anchors)
    kept = Window.partitionBy("key", "nth").orderBy(F.desc("negative_score"), "negative_id")
    found = candidates.mapInArrow(_negatives(wave, scale, negatives), FOUND).withColumn("rank", F.row_number().over(kept)).where(F.col("rank") <= negatives)
    found = stash(found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"))
    wave.destroy()
    return found
