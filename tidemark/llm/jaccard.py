"""N-gram Jaccard join by signature trees.

Texts become sets of word shingles; texts with equal sets form one class, and
classes link when ``intersection / union >= threshold``. Steps:

1. *Sets.* Each text gives its set size and a digest of its set.
2. *Shared prefixes.* With t the threshold, linked sets x and y share at least
   r of the first ``|x| - ceil(t|x|) + k`` hashes of x, in hash order, with the
   like prefix of y. Prefix hashes are dealt out, packed, by hash; a class with
   fewer than r shared ones can have no link and goes. The few that stay deal out
   their whole sets: at least ``ceil(t|x|)`` hashes must be shared. Of these each
   takes its rarest, as many as must meet a partner's; they tie
   candidates together, so that a passage of many texts ties nothing.
3. *Blocks.* Components of these ties are dealt out in blocks: small components
   share blocks, large ones are split in parts, with a block for each pair of
   parts.
4. *Signature trees.* In a block, shingles that two sets share get a bit each;
   a tree's nodes hold the OR of their sets' bitmaps and the range of their
   sizes. Two trees are traversed together: a pair of nodes goes when its sizes
   or its common bits can't reach the overlap needed. A pair of leaves has the
   exact overlap. A block returns links per class and a spanning forest of its
   links, never the pairs.
5. *Components* of these forests are found by joins, for all blocks at once.

Shingles and sets are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, dealt_out, discard, given_back, in_slices, stash
from .components import connected_components
from .shingles import forget_words, shingle_set

#: Slack of the prefixes, as a share of the set: longer prefixes, stricter test.
SLACK = 0.1
FAN = 8
#: Sets in a block, and bytes of its bitmaps.
BLOCK, BITMAP_BYTES = 1024, 48 << 20


def least_overlap(n: np.ndarray, threshold: float) -> np.ndarray:
    """Shared shingles that a set of size n needs with any partner."""
    return np.ceil(threshold * n - 1e-9).astype(np.int64)


def prefix_plan(n, threshold: float):
    """(prefix length, shared ones needed) for sets of size n."""
    n = np.asarray(n, np.int64)
    need = least_overlap(n, threshold)
    length = n - need + 1 + (SLACK * n).astype(np.int64)
    return np.minimum(length, n), 1 + (SLACK * need).astype(np.int64)


def _digest(s: np.ndarray) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def _sized(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_slices(batches, 2):
            sets = [shingle_set(t.as_py(), k) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array([_digest(s) for s in sets], pa.int64())], ["id", "th", "n", "cls"])

    return run


def _prefixes(k: int, threshold: float, buckets: int):
    """Packed (hash, class) of the prefixes, by bucket of the hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        hashes, owners, held = [], [], 0

        def flush():
            h, o = np.concatenate(hashes), np.concatenate(owners)
            at = (h >> np.uint64(40)).astype(np.int64) % buckets
            order = np.argsort(at, kind="stable")
            at, h, o = at[order], h[order], o[order]
            cuts = np.flatnonzero(np.diff(at)) + 1
            starts, ends = np.r_[0, cuts], np.r_[cuts, len(at)]
            return pa.RecordBatch.from_arrays([pa.array(at[starts]), pa.array([h[a:e].tobytes() for a, e in zip(starts, ends)], pa.binary()), pa.array([o[a:e].tobytes() for a, e in zip(starts, ends)], pa.binary())], ["bucket", "h", "o"])

        for b in batches:
            for t in b.column(0):
                s = shingle_set(t.as_py(), k)
                if not len(s) or (d := _digest(s)) in seen:
                    continue
                if len(seen) < 1_000_000:
                    seen.add(d)
                p = s[: int(prefix_plan(len(s), threshold)[0])]
                hashes.append(p)
                owners.append(np.full(len(p), d, np.int64))
                held += len(p)
                if held > 1_000_000:
                    yield flush()
                    hashes, owners, held = [], [], 0
        if held:
            yield flush()

    return run


def _shared_counts(table: pa.Table) -> pa.Table:
    """Of one bucket of prefixes: how many hashes a class shares with others."""
    h = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in table["h"]])
    o = np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in table["o"]])
    o, count = np.unique(_owned(h, o)[1], return_counts=True)
    return pa.table([o, count.astype(np.int64)], ["cls", "shared"])


def _owned(h: np.ndarray, o: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, owner, number of owners, least owner) of hashes with two owners or more."""
    order = np.lexsort((o, h))
    h, o = h[order], o[order]
    if len(h):
        new = np.r_[True, (h[1:] != h[:-1]) | (o[1:] != o[:-1])]  # tasks may repeat a class
        h, o = h[new], o[new]
    first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
    df = np.diff(np.r_[first, len(h)])
    lead, count = np.repeat(o[first], df), np.repeat(df, df)
    keep = count > 1
    return h[keep], o[keep], count[keep].astype(np.int64), lead[keep]


def _dealt(k: int, buckets: int):
    """Packed whole sets of (class, text), by bucket: hashes, and runs of classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_slices(batches, 0, 8 << 20):
            sets = [shingle_set(t.as_py(), k) for t in b.column(0)]
            h = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            o = np.repeat(np.array([_digest(s) for s in sets], np.int64), [len(s) for s in sets])
            at = (h >> np.uint64(40)).astype(np.int64) % buckets
            order = np.argsort(at, kind="stable")
            at, h, o = at[order], h[order], o[order]
            cuts = np.r_[0, np.flatnonzero(np.diff(at)) + 1, len(at)]
            rows = []
            for a, e in zip(cuts[:-1], cuts[1:]):
                own = o[a:e]
                starts = np.r_[0, np.flatnonzero(np.diff(own)) + 1]
                rows.append((at[a], h[a:e].tobytes(), own[starts].tobytes(), np.diff(np.r_[starts, e - a]).astype(np.int32).tobytes()))
            rows = [r for r in rows if r[1]]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), *[pa.array([r[j] for r in rows], pa.binary()) for j in (1, 2, 3)]], ["bucket", "h", "o", "runs"])

    return run


def _shared(table: pa.Table) -> pa.Table:
    """Of one bucket of whole sets, per class: the hashes that others have too, as
    arrays of how many classes have each and of the least of these."""
    h = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in table["h"]])
    o = np.concatenate([np.repeat(np.frombuffer(x.as_buffer(), np.int64), np.frombuffer(r.as_buffer(), np.int32)) for x, r in zip(table["o"], table["runs"])])
    h, o, df, lead = _owned(h, o)
    order = np.argsort(o, kind="stable")
    h, o, df, lead = h[order], o[order], df[order], lead[order]
    cuts = np.r_[0, np.flatnonzero(np.diff(o)) + 1, len(o)].astype(np.int32) if len(o) else np.zeros(1, np.int32)
    parts = pa.StructArray.from_arrays([pa.array(df), pa.array(h.view(np.int64)), pa.array(lead)], ["df", "h", "lead"])
    return pa.table([pa.array(o[cuts[:-1]]), pa.ListArray.from_arrays(pa.array(cuts), parts)], ["cls", "l"])


class SignatureTree:
    """Bitmaps and size ranges of sets, and of groups of ``FAN`` nodes each."""

    def __init__(self, bits: np.ndarray, sizes: np.ndarray):
        self.levels = [(bits, sizes, sizes)]
        while len(bits) > 1:
            starts = np.arange(0, len(bits), FAN)
            bits = np.bitwise_or.reduceat(bits, starts, axis=0)
            lo, hi = np.minimum.reduceat(self.levels[-1][1], starts), np.maximum.reduceat(self.levels[-1][2], starts)
            self.levels.append((bits, lo, hi))

    def may_link(self, level: int, i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
        """Whether the node pairs can hold a linked pair; at level 0, whether they are one."""
        bits, lo, hi = self.levels[level]
        ok = (hi[i] >= threshold * lo[j] - 1e-9) & (hi[j] >= threshold * lo[i] - 1e-9)
        at = np.flatnonzero(ok)
        step = max(1, (8 << 20) // max(1, bits.shape[1] * 8))
        for a in range(0, len(at), step):
            e = at[a : a + step]
            common = np.bitwise_count(bits[i[e]] & bits[j[e]]).sum(axis=1, dtype=np.int64)
            both = lo[i[e]] + lo[j[e]]
            # intersection / union >= t, with union = both - intersection
            ok[e] = common * 1000 + common * round(threshold * 1000) >= round(threshold * 1000) * both
        return ok

    def pairs(self, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Linked pairs i < j, by traversing the tree against itself."""
        top = len(self.levels) - 1
        yield from self._down(top, np.zeros(1, np.int64), np.zeros(1, np.int64), threshold)

    def _down(self, level: int, i: np.ndarray, j: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for a in range(0, len(i), 4096):
            x, y = i[a : a + 4096], j[a : a + 4096]
            if level:
                ok = self.may_link(level, x, y, threshold)
                x, y = x[ok], y[ok]
                if not len(x):
                    continue
                n = len(self.levels[level - 1][1])
                kids = np.arange(FAN)
                cx = np.repeat(x[:, None] * FAN + kids, FAN, axis=1).ravel()
                cy = np.tile(y[:, None] * FAN + kids, (1, FAN)).ravel()
                ok = (cx < n) & (cy < n) & (cx <= cy if level > 1 else cx < cy)
                yield from self._down(level - 1, cx[ok], cy[ok], threshold)
            else:
                ok = self.may_link(0, x, y, threshold)
                if ok.any():
                    yield x[ok], y[ok]


class Forest:
    """Union by pairs of arrays; keeps the pairs that joined two parts."""

    def __init__(self, n: int):
        self.label, self.kept = np.arange(n), []

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            a, b = self.label[i], self.label[j]
            apart = a != b
            if not apart.any():
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            hi, lo = np.maximum(a, b), np.minimum(a, b)
            _, at = np.unique(hi, return_index=True)  # each part joins one smaller part a time
            to = np.arange(len(self.label))
            to[hi[at]] = lo[at]
            while not np.array_equal(to, to[to]):
                to = to[to]
            self.kept.append(np.stack([i[at], j[at]], axis=1))
            self.label = to[self.label]

    def edges(self) -> np.ndarray:
        return np.concatenate(self.kept) if self.kept else np.empty((0, 2), np.int64)


def tree_join(sets: list[np.ndarray], threshold: float, sides: np.ndarray | None = None, weights: np.ndarray | None = None, bitmap_bytes: int = BITMAP_BYTES):
    """(links per set, forest of links) among sets; with ``sides``, of pairs on both sides only.

    Links count ``weights`` of the partner. Bitmaps that need more than
    ``bitmap_bytes`` are built for pairs of halves instead.
    """
    n = len(sets)
    weights = np.ones(n, np.int64) if weights is None else weights
    links, forest = np.zeros(n, np.int64), Forest(n)

    def within(at: np.ndarray, own: np.ndarray | None) -> None:
        sizes = np.array([len(sets[i]) for i in at], np.int64)
        all_h = np.concatenate([sets[i] for i in at])
        _, inv, counts = np.unique(all_h, return_inverse=True, return_counts=True)
        bit = np.full(len(counts), -1, np.int64)
        bit[counts > 1] = np.arange((counts > 1).sum())
        width = max(1, -(-int((counts > 1).sum()) // 64))
        if len(at) * width * 8 > bitmap_bytes and len(at) > 2:
            half = len(at) // 2
            a, b = at[:half], at[half:]
            if own is None:
                within(a, None)
                within(b, None)
                within(at, np.r_[np.zeros(len(a), bool), np.ones(len(b), bool)])
            else:
                left, right = at[~own], at[own]
                for p in np.array_split(left, 2) if len(left) > 1 else [left]:
                    for q in np.array_split(right, 2) if len(right) > 1 else [right]:
                        within(np.r_[p, q], np.r_[np.zeros(len(p), bool), np.ones(len(q), bool)])
            return
        mine = bit[inv]
        row = np.repeat(np.arange(len(at)), sizes)[mine >= 0]
        mine = mine[mine >= 0]
        bits = np.zeros((len(at), width), np.uint64)
        np.bitwise_or.at(bits, (row, mine >> 6), np.uint64(1) << (mine & 63).astype(np.uint64))
        for x, y in SignatureTree(bits, sizes).pairs(threshold):
            if own is not None:
                across = own[x] != own[y]
                x, y = x[across], y[across]
            x, y = at[x], at[y]
            if sides is not None:
                across = sides[x] != sides[y]
                x, y = x[across], y[across]
            np.add.at(links, x, weights[y])
            np.add.at(links, y, weights[x])
            forest.add(x, y)

    if n > 1:
        lead = np.array([s[0] if len(s) else 0 for s in sets], np.uint64)
        order = np.lexsort((lead, [len(s) for s in sets]))
        within(order, None)
    return links, forest.edges()


def _joined(threshold: float):
    def run(block: pa.Table) -> pa.Table:
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in block["shingles"]]
        cls, m, side = (block[c].to_numpy() for c in ("cls", "m", "side"))
        links, edges = tree_join(sets, threshold, None if (side == 0).all() else side, m)
        some, none = np.flatnonzero(links), np.zeros(len(edges), np.int64)
        return pa.table({
            "cls": np.r_[cls[some], cls[edges[:, 0]]], "links": np.r_[links[some], none],
            "other": pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(cls[edges[:, 1]], pa.int64())]),
        })

    return run


def _members_texts(bits: np.ndarray):
    """Of (th, text), once in a task, those that may be members': by a bitmap of th."""
    mask = len(bits) * 64 - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            th = b.column(0).to_numpy()
            at = th & mask
            hits = np.flatnonzero((bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1))
            rows = []
            for i in hits.tolist():
                if th[i] not in seen:
                    rows.append(i)
                    if len(seen) < 1_000_000:
                        seen.add(th[i])
            if rows:
                yield b.take(pa.array(rows))

    return run


def _bitmap(members: DataFrame, n: int, max_bits: int = 1 << 26) -> np.ndarray:
    """Bits of the members' text hashes, modulo a size of 16 bits each, 8 MB at most.

    A prefilter only: where it fills up it lets more pass to the join behind it.
    """
    size = 1 << 16
    while size < min(16 * n, max_bits):
        size *= 2
    at = F.col("th").bitwiseAND(size - 1)
    words = members.groupBy(F.shiftright(at, 6).alias("w")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(th & 63 as int))")).alias("b")).toArrow()
    bits = np.zeros(size // 64, np.int64)
    bits[words["w"].to_numpy()] = words["b"].to_numpy()
    return bits.view(np.uint64)


def _with_sets(k: int):
    """Replaces the text of a placed member by its packed set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cls, out, last = b.column(0).to_pylist(), [], (None, None)
            for t in b.column(5):
                t = t.as_py()
                if last[0] != t:
                    last = t, shingle_set(t, k)
                out.append(last[1])
            same = pa.array([_digest(s) == c for s, c in zip(out, cls)])  # not so for other texts of equal hash
            made = pa.RecordBatch.from_arrays([*b.columns[:5], pa.array([s.tobytes() for s in out], pa.binary())], ["cls", "m", "g1", "g2", "side", "shingles"])
            yield made.filter(same)

    return run


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8, k: int = 5, block: int = BLOCK) -> DataFrame:
    """``(id, n_shingles, component_id, n_links)`` for each row of ``docs``.

    n_shingles is the size of the row's set, n_links the number of other rows
    linked directly, component_id the smallest id reachable by links, itself
    included. Null or empty texts and texts without words have empty sets,
    link with nothing and are their own component. Rows with equal ids stay
    apart as rows; a null id never is a component's smallest unless all are
    null. ``threshold`` counts to three decimals. Other columns of ``docs``
    are ignored.
    """
    return _join_rows(docs, id_col, text_col, threshold, k, block).drop("th", "root")


def _join_rows(docs: DataFrame, id_col: str, text_col: str, threshold: float, k: int, block: int) -> DataFrame:
    """:func:`jaccard_join`, with the hash of the text as ``th`` and one class of the component as ``root``, null for empty sets."""
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    sized = stash(rows.mapInArrow(given_back(_sized(k), forget_words), f"id {id_type}, th long, n long, cls long"))
    n_rows, total = sized.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    classes = stash(sized.where("n > 0").groupBy("cls").agg(F.count("*").alias("m"), F.min("id").alias("least_id"), F.min("th").alias("th"), F.min("n").alias("n")), n_rows)

    need = F.ceil(F.lit(threshold) * F.col("n") - 1e-9)
    r = 1 + F.floor(F.lit(SLACK) * need)
    packed = rows.select("text").mapInArrow(given_back(_prefixes(k, threshold, int(max(96, total // 1_500_000))), forget_words), "bucket long, h binary, o binary")
    counts = packed.groupBy("bucket").applyInArrow(_shared_counts, "cls long, shared long").groupBy("cls").agg(F.sum("shared").alias("shared"))
    first = stash(counts.join(dealt_out(classes), "cls").where(F.col("shared") >= r).select("cls", "m", "th", "n"), n_rows)
    n_first, sum_first = first.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    texts = rows.select("th", "text").mapInArrow(given_back(_members_texts(_bitmap(first, n_first)), forget_words), "th long, text string").dropDuplicates(["th"])
    texts = stash(texts.join(dealt_out(first.select("th").distinct()), "th", "left_semi"), like=rows)

    whole = texts.select("text").mapInArrow(given_back(_dealt(k, int(max(96, sum_first // 400_000))), forget_words), "bucket long, h binary, o binary, runs binary")
    shared = whole.groupBy("bucket").applyInArrow(_shared, "cls long, l array<struct<df:long,h:long,lead:long>>")
    lists = shared.groupBy("cls").agg(F.flatten(F.collect_list("l")).alias("l")).join(dealt_out(first), "cls").where(F.size("l") >= need)
    rarest = F.slice(F.array_sort("l"), F.lit(1), (F.size("l") - need + 1).cast("int"))
    ties = lists.select("cls", F.explode(F.array_distinct(F.transform(rarest, lambda x: x["lead"]))).alias("lead")).where("lead != cls")
    groups = connected_components(ties, "cls", "lead", rows)
    groups = stash(groups, n_first)

    large = groups.groupBy("root").count().where(F.col("count") > block).select("root", F.ceil(F.col("count") / (block // 2)).cast("int").alias("parts"))
    members = stash(groups.join(dealt_out(first), F.col("node") == F.col("cls")).join(large, "root", "left").select("cls", "m", "th", "root", "parts"), n_first)
    n_members = members.count()
    part = F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int")
    other = F.explode(F.when(F.col("parts").isNull(), F.array(F.lit(-1))).otherwise(F.sequence(F.lit(0), F.col("parts") - 1)))
    placed = members.select("*", part.alias("part")).select("*", other.alias("q"))
    small_blocks = max(1, -(-n_members * 4 // block))
    lo, hi = F.least("part", "q"), F.greatest("part", "q")
    placed = placed.select(
        "cls", "m", "th",
        F.when(F.col("parts").isNull(), F.pmod(F.xxhash64("root"), F.lit(small_blocks))).otherwise(F.col("root")).alias("g1"),
        F.when(F.col("parts").isNull(), F.lit(-1)).otherwise(lo * F.col("parts") + hi).alias("g2"),
        F.when(F.col("parts").isNull() | (lo == hi), F.lit(0)).when(F.col("part") == lo, F.lit(1)).otherwise(F.lit(2)).alias("side"),
    )
    sets = texts.join(dealt_out(placed), "th").select("cls", "m", "g1", "g2", "side", "text").mapInArrow(given_back(_with_sets(k), forget_words), "cls long, m long, g1 long, g2 int, side int, shingles binary")
    found = stash(sets.groupBy("g1", "g2").applyInArrow(_joined(threshold), "cls long, links long, other long"), like=rows)

    links = found.where("links > 0").groupBy("cls").agg(F.sum("links").alias("links"))
    comps = connected_components(found.where("other is not null"), "cls", "other", rows)
    of = classes.join(dealt_out(comps), F.col("cls") == F.col("node"), "left").select("cls", "m", "least_id", F.coalesce("root", "cls").alias("root"))
    least = of.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of = stash(of.join(dealt_out(least), "root").join(dealt_out(links), "cls", "left").select("cls", "root", "component_id", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links")), n_rows)
    out = sized.where("n > 0").join(dealt_out(of), "cls").select(F.col("id").alias(id_col), "th", "root", F.col("n").alias("n_shingles"), "component_id", "n_links")
    alone = sized.where("n = 0").select(F.col("id").alias(id_col), "th", F.lit(None).cast("long").alias("root"), F.col("n").alias("n_shingles"), F.col("id").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    for df in (members, groups, texts, first):
        discard(df)
    return out.union(alone)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8, k: int = 5) -> DataFrame:
    """``docs`` with one row of each component: that of its smallest id.

    A null id comes after all others; of equal ids in a component the text's
    hash decides, and of rows equal in id and text one stays. Rows with equal
    ids in different components are apart. Rows with empty sets all stay.
    """
    found = stash(_join_rows(docs, id_col, text_col, threshold, k, BLOCK).select(F.col(id_col).alias("_gone_id"), F.col("th").alias("_gone_th"), "root"), like=docs)
    rows = found.where("root IS NOT NULL")
    stays = rows.groupBy("root").agg(F.min(F.struct(F.col("_gone_id").isNull().alias("no"), F.col("_gone_id").alias("id"), F.col("_gone_th").alias("th"))).alias("s")).select("s.id", "s.th")
    gone = rows.select("_gone_id", "_gone_th").distinct()
    gone = gone.join(dealt_out(stays), gone["_gone_id"].eqNullSafe(stays["id"]) & (gone["_gone_th"] == stays["th"]), "left_anti")
    left = docs.join(dealt_out(gone), docs[id_col].eqNullSafe(gone["_gone_id"]) & (F.xxhash64(docs[text_col]) == gone["_gone_th"]), "left_anti")
    if rows.groupBy("_gone_id", "_gone_th").count().where("count > 1").isEmpty():
        return left
    # rows without words get a key of their own each
    own = F.when(F.col(text_col).rlike(WORD), F.lit(-1).cast("long")).otherwise(F.monotonically_increasing_id())
    return left.withColumn("_gone_key", own).dropDuplicates([id_col, text_col, "_gone_key"]).select(*[left[c] for c in docs.columns])
