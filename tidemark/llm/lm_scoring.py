"""Language-model scoring with a log-bilinear model and class-based rare words.

The model's outcomes are classes: the most frequent training words, a bucket
for other words by their last bytes, and the end of a text. A context is the
two classes before; each has a vector per position, and the sum predicts the
next class by its inner product with that class's vector, plus a bias. Training
is noise-contrastive, in numpy, over all training texts: they are dealt into
parts by their hash, about ``PART_TOKENS`` tokens each, each part trains from the
same start, and the parameters are averaged by tokens seen. So the model follows
from the texts, not from how the table is stored. Its size is fixed: words that
have no class of their own are told apart by their counts only.

The exponent is a sum over the two positions, so the normaliser of all contexts
is one matrix product, and log-probabilities are exact. A word of a bucket has
the bucket's probability times the word's share of it, with part of each count
put by for words that training lacks: all unknown words of a bucket are one
outcome.

Counts cover all training texts. A table of the most frequent words goes to all
tasks, its size bounded by a number; other words are looked up by a join.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_pieces, stash

#: Size bounds: classes (words, buckets and the end), vector length, frequent words known to all tasks.
CLASSES, BUCKETS, DIMS, FREQUENT = 2048, 256, 16, 1 << 18
END = b""
#: Part of a count put by for unknown words.
DISCOUNT = 0.5
BATCH, NOISE, RATE = 2048, 64, 0.15
#: Tokens of a part that trains by itself, and most parts.
PART_TOKENS, PARTS = 1_000_000, 1 << 16
LONGEST = 64


def key_of(word: bytes) -> bytes:
    """The word, or a digest of one over ``LONGEST`` bytes (0xff begins no word)."""
    return word if len(word) <= LONGEST else b"\xff" + hashlib.sha256(word).digest()


def words_of(text: str | None) -> Iterator[list[bytes]]:
    """Words of a text, A-Z lower-cased, in lists; of a null text none."""
    for piece in in_pieces((text or "").encode("utf-8", "surrogatepass").lower()):
        yield piece.split()


def bucket_of(key: bytes) -> int:
    return zlib.crc32(key[-3:]) % BUCKETS


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    train, other = Counter(), Counter()

    def flush():
        keys = Counter()
        for side, counts in enumerate((train, other)):
            for w, n in counts.items():
                keys[key_of(w), side] += n
        rows = list(keys.items())
        train.clear(), other.clear()
        return pa.RecordBatch.from_arrays([pa.array([k[0] for k, _ in rows], pa.binary()), pa.array([0 if k[1] else n for k, n in rows], pa.int64()), pa.array([n for _, n in rows], pa.int64())], ["token", "c", "c_all"])

    for b in batches:
        for t, learn in zip(b.column(0), b.column(1).to_pylist()):
            counts = train if learn else other
            for words in words_of(t.as_py()):
                counts.update(words)
            counts[END] += 1
        if len(train) + len(other) > 400_000:
            yield flush()
    if train or other:
        yield flush()


class _Codes(dict):
    """Code of a word: its place among the frequent words, else -1 - bucket."""

    def __missing__(self, word: bytes) -> int:
        key = key_of(word)
        if key is not word and key in self:
            return self[key]
        return -1 - bucket_of(key)


@dataclass
class Vocabulary:
    """Bounded tables of the counts; ``class_of`` etc. by place among the frequent words."""

    tokens: list[bytes]
    counts: np.ndarray
    n: int
    v: int
    bucket_n: np.ndarray
    bucket_v: np.ndarray
    end_count: int

    def prepare(self) -> Vocabulary:
        words = CLASSES - BUCKETS - 1
        buckets = np.array([bucket_of(t) for t in self.tokens], np.int64)
        # the most frequent in training come first; each has a class of its own
        self.top = min(words, int((self.counts > 0).sum()))
        self.class_of = np.concatenate([np.arange(self.top), words + buckets[self.top :]]) if len(buckets) else np.zeros(0, np.int64)
        self.end_class = CLASSES - 1
        n, v = self.bucket_n.astype(np.float64), self.bucket_v.astype(np.float64)
        np.subtract.at(n, buckets[: self.top], self.counts[: self.top])
        np.subtract.at(v, buckets[: self.top], 1)
        self.rest_n, self.rest_v = n, v
        self.unknown = np.where(n > 0, DISCOUNT * v / np.maximum(n, 1), 1.0)
        within = np.where(self.counts > 0, (self.counts - DISCOUNT) / np.maximum(n[buckets], 1), self.unknown[buckets]) if len(buckets) else np.zeros(0)
        within[: self.top] = 1.0
        self.within = np.log10(within)
        self.base = np.log10((self.counts + 1) / self.denominator)
        self.codes = _Codes({t: i for i, t in enumerate(self.tokens)})
        return self

    @property
    def denominator(self) -> int:
        return self.n + self.v + 1

    def class_counts(self) -> np.ndarray:
        c = np.zeros(CLASSES)
        c[: self.top] = self.counts[: self.top]
        c[CLASSES - BUCKETS - 1 : -1] = self.rest_n
        c[-1] = self.end_count
        return c

    def classes(self, codes: np.ndarray) -> np.ndarray:
        first = CLASSES - BUCKETS - 1
        return np.where(codes >= 0, self.class_of[np.maximum(codes, 0)] if len(self.class_of) else 0, first - 1 - codes)


class LogBilinear:
    """Parameters of the model and its noise-contrastive training."""

    SHAPES = {"context": (CLASSES, DIMS), "target": (CLASSES, DIMS), "bias": (CLASSES, 1), "near": (DIMS, DIMS), "far": (DIMS, DIMS)}

    def __init__(self, class_counts: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        p = (class_counts + 0.1) / (class_counts + 0.1).sum()
        self.log_k = np.log(NOISE * p)
        self.context = rng.normal(0, 0.3, (CLASSES, DIMS))
        self.target = rng.normal(0, 0.01, (CLASSES, DIMS))
        self.bias = np.log(p)[:, None]
        self.near, self.far = np.eye(DIMS), 0.5 * np.eye(DIMS)
        self.squares = {k: np.full(s, 1e-3) for k, s in self.SHAPES.items()}
        self.cumulative = np.cumsum(p)
        self.rng = rng

    def _step(self, name: str, rows, grad: np.ndarray) -> None:
        value, squares = getattr(self, name), self.squares[name]
        squares[rows] += grad * grad
        value[rows] -= RATE * grad / np.sqrt(squares[rows])

    @staticmethod
    def _by_row(rows: np.ndarray, grad: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(rows.astype(np.int16), kind="stable")  # classes fit, and 16 bits are sorted by radix
        rows = rows[order]
        at = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        return rows[at], np.add.reduceat(grad[order], at, axis=0)

    def learn(self, far: np.ndarray, near: np.ndarray, to: np.ndarray) -> None:
        """One step over a batch of (two classes before, class)."""
        n = len(to)
        noise = np.minimum(np.searchsorted(self.cumulative, self.rng.random(NOISE)), CLASSES - 1)
        r_far, r_near = self.context[far], self.context[near]
        q = r_near @ self.near + r_far @ self.far
        log_k = self.log_k
        t, t_noise = self.target[to], self.target[noise]
        s = np.einsum("ij,ij->i", q, t) + self.bias[to, 0] - log_k[to]
        g = -1 / (1 + np.exp(np.clip(s, -30, 30))) / n  # of the score of the true class
        # the one large matrix, batch by noise, in place and in single precision; parameters stay in double
        q_32, t_32 = q.astype(np.float32), t_noise.astype(np.float32)
        g_noise = q_32 @ t_32.T
        g_noise += (self.bias[noise, 0] - log_k[noise]).astype(np.float32)
        np.negative(np.clip(g_noise, -30, 30, out=g_noise), out=g_noise)
        np.exp(g_noise, out=g_noise)
        g_noise += 1
        np.divide(np.float32(1 / n), g_noise, out=g_noise)
        g_q = g[:, None] * t + g_noise @ t_32
        # the gradient of the bias is one more column of the target's
        both = np.concatenate([np.c_[g[:, None] * q, g], np.c_[g_noise.T @ q_32, g_noise.sum(axis=0, dtype=np.float64)]])
        rows, grad = self._by_row(np.r_[to, noise], both)
        rows_c, grad_c = self._by_row(np.r_[near, far], np.r_[g_q @ self.near.T, g_q @ self.far.T])
        near_g, far_g = r_near.T @ g_q, r_far.T @ g_q
        self._step("target", rows, grad[:, :-1])
        self._step("bias", rows, grad[:, -1:])
        self._step("context", rows_c, grad_c)
        self._step("near", slice(None), near_g)
        self._step("far", slice(None), far_g)

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Log10-probability tables: near[c, w] + far[f, w] - norm[f, c] with the bias in near."""
        near = (self.context @ self.near @ self.target.T + self.bias.T).astype(np.float32)
        far = (self.context @ self.far @ self.target.T).astype(np.float32)
        return near, far


class Scorer:
    """Normalised log-probabilities by matrix products over all contexts."""

    def __init__(self, model: LogBilinear):
        near, far = model.tables()
        near_top, far_top = near.max(axis=1, keepdims=True), far.max(axis=1, keepdims=True)
        total = np.exp(far - far_top) @ np.exp(near - near_top).T
        self.norm = np.log(np.maximum(total, 1e-37)) + far_top + near_top.T
        self.near, self.far = near, far

    def log10(self, far: np.ndarray, near: np.ndarray, to: np.ndarray) -> np.ndarray:
        return (self.near[near, to].astype(np.float64) + self.far[far, to] - self.norm[far, near]) / np.log(10)


def count_words(docs: DataFrame, learn: Column, text_col: str = "text") -> DataFrame:
    """``(token, c, c_all)``: counts over texts to learn from, and over all; END is the empty token."""
    rows = docs.select(F.col(text_col).alias("text"), learn.alias("learn"))
    return rows.mapInArrow(_counted, "token binary, c long, c_all long").groupBy("token").agg(F.sum("c").alias("c"), F.sum("c_all").alias("c_all"))


def vocabulary(counts: DataFrame, frequent: int = FREQUENT) -> Vocabulary:
    """Sums of the counts and their ``frequent`` most frequent words.

    The words of training come first, by count, for the classes; the table has
    the most frequent of training and, of the rest, those frequent elsewhere.
    """
    bucket = F.pmod(F.crc32(F.expr("substring(token, -3, 3)")), F.lit(BUCKETS))
    n, v, end = counts.agg(F.sum("c"), F.count_if(F.col("c") > 0), F.sum(F.when(F.length("token") == 0, F.col("c")))).first()
    per = counts.where("length(token) > 0").groupBy(bucket.alias("b")).agg(F.sum("c").alias("n"), F.count_if(F.col("c") > 0).alias("v")).collect()
    bucket_n, bucket_v = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for r in per:
        bucket_n[r["b"]], bucket_v[r["b"]] = r["n"], r["v"]
    top = counts.where("length(token) > 0").orderBy(F.desc("c"), F.desc("c_all"), "token").limit(frequent).toArrow()
    return Vocabulary(top["token"].to_pylist(), top["c"].to_numpy().astype(np.int64), n or 0, v or 0, bucket_n, bucket_v, end or 0).prepare()


def _trained(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = shared.value
        model, seen = LogBilinear(vocab.class_counts()), 0
        model.rng = np.random.default_rng(TaskContext.get().partitionId())
        held: list[np.ndarray] = []
        pad = np.full(2, vocab.end_class, np.int64)

        def learn(parts: list[np.ndarray], all_: bool) -> list[np.ndarray]:
            far, near, to = (np.concatenate(x) for x in zip(*[(p[:-2], p[1:-1], p[2:]) for p in parts if len(p) > 2]))
            order = model.rng.permutation(len(to))
            for a in range(0, len(to), BATCH):
                e = order[a : a + BATCH]
                model.learn(far[e], near[e], to[e])
            return []

        waiting = 0
        get = vocab.codes.__getitem__
        for b in batches:
            for t in b.column(0):
                before = pad
                for words in words_of(t.as_py()):
                    c = vocab.classes(np.fromiter(map(get, words), np.int64, len(words)))
                    held.append(np.r_[before, c])
                    before = held[-1][-2:]
                    waiting += len(c)
                held.append(np.r_[before, vocab.end_class])
                waiting += 1
                if waiting >= 64 * BATCH:
                    held, seen, waiting = learn(held, True), seen + waiting, 0
        if waiting:
            learn(held, True)
            seen += waiting
        if seen:
            for k, name in enumerate(LogBilinear.SHAPES):
                value = getattr(model, name)
                cols = [value[:, j] * seen if j < value.shape[1] else np.zeros(len(value)) for j in range(DIMS)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(value), k, np.int32)), pa.array(np.arange(len(value), dtype=np.int32)), pa.array(np.full(len(value), float(seen))), *map(pa.array, cols)], ["k", "r", "w", *[f"v{j}" for j in range(DIMS)]])

    return run


def train(docs: DataFrame, learn: Column, vocab: Vocabulary, text_col: str = "text", id_col: str | None = None) -> LogBilinear:
    """The average of the models that the parts train, by tokens seen.

    Rows go to parts, and come in order there, by a hash of text and id, so that
    neither files nor copies of a text matter.

    CLASSES * 2 + DIMS * 2 rows come to the driver. Without texts to learn from
    the model stays at its start.
    """
    model = LogBilinear(vocab.class_counts())
    shared = docs.sparkSession.sparkContext.broadcast(vocab)
    key = F.xxhash64(text_col, *([id_col] if id_col else []))
    rows = docs.where(learn).select(F.col(text_col).alias("text"), key.alias("key"))
    parts = max(1, min(PARTS, vocab.n // PART_TOKENS))
    rows = rows.repartition(parts, "key").sortWithinPartitions("key", "text").select("text")
    sums = rows.mapInArrow(_trained(shared), "k int, r int, w double, " + ", ".join(f"v{j} double" for j in range(DIMS)))
    got = sums.groupBy("k", "r").agg(F.sum("w").alias("w"), *[F.sum(f"v{j}").alias(f"v{j}") for j in range(DIMS)]).toPandas()
    for k, name in enumerate(LogBilinear.SHAPES):
        part = got[got["k"] == k]
        if len(part):
            value = getattr(model, name)
            value[part["r"].to_numpy()] = (part[[f"v{j}" for j in range(value.shape[1])]].to_numpy() / part["w"].to_numpy()[:, None])
    return model


def _scored(shared):
    """Per text a head row with the sums over known words, and a row for each other word."""
    made: list = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, model = shared.value
        if not made:
            made.append(Scorer(model))
        scorer, get, number = made[0], vocab.codes.__getitem__, TaskContext.get().partitionId() << 40
        end_base = np.log10((vocab.end_count + 1) / vocab.denominator)
        for b in batches:
            rk, token, count, n_tokens, known, base, score = [], [], [], [], [], [], []
            for t in b.column(1):
                number += 1
                before = np.full(2, vocab.end_class, np.int64)
                n, k, s_base, s_score, rare = 1, int(vocab.end_count > 0), end_base, 0.0, Counter()
                for words in words_of(t.as_py()):
                    codes = np.fromiter(map(get, words), np.int64, len(words))
                    c = np.r_[before, vocab.classes(codes)]
                    s_score += scorer.log10(c[:-2], c[1:-1], c[2:]).sum()
                    before, n = c[-2:], n + len(words)
                    at = codes[codes >= 0]
                    k += int((vocab.counts[at] > 0).sum())
                    s_base += vocab.base[at].sum()
                    s_score += vocab.within[at].sum()
                    rare.update([key_of(words[i]) for i in np.flatnonzero(codes < 0)])
                s_score += float(scorer.log10(before[:1], before[1:], np.array([vocab.end_class]))[0])
                rk += [number] * (1 + len(rare))
                token += [b"\xfe%d" % number, *rare]
                count += [0, *rare.values()]
                n_tokens += [n] + [None] * len(rare)
                known += [k] + [None] * len(rare)
                base += [s_base] + [None] * len(rare)
                score += [s_score] + [None] * len(rare)
            heads = np.cumsum([0] + [0]) if not rk else np.flatnonzero(np.array(count) == 0)
            ids = np.full(len(rk), -1)
            ids[heads] = np.arange(len(heads))
            ids = pa.array(ids, pa.int64(), mask=ids < 0)
            yield pa.RecordBatch.from_arrays([
                pa.array(rk, pa.int64()), pa.array(token, pa.binary()), pa.array(count, pa.int64()), b.column(0).take(ids), b.column(2).take(ids),
                pa.array(n_tokens, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(score, pa.float64()),
            ], ["rk", "token", "n", "id", "held_out", "n_tokens", "known", "base", "score"])

    return run


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT) -> DataFrame:
    """``(id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` for each row.

    Learns from the rows where ``held_out`` is false. Null texts count as empty:
    one token, the end. base_score is the add-one unigram log10-probability,
    score the model's. Rows with null or repeated ids are scored like any other.
    """
    counts = stash(count_words(docs, ~held_out, text_col))
    vocab = vocabulary(counts, frequent)
    model = train(docs, ~held_out, vocab, text_col, id_col)
    model.squares = model.rng = None
    shared = docs.sparkSession.sparkContext.broadcast((vocab, model))
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), held_out.alias("held_out"))
    parts = rows.mapInArrow(_scored(shared), f"rk long, token binary, n long, id {kind}, held_out boolean, n_tokens long, known long, base double, score double")
    found = parts.join(counts.select("token", "c"), "token", "left")
    rare = F.col("n") > 0
    c = F.coalesce("c", F.lit(0))
    bucket = F.pmod(F.crc32(F.expr("substring(token, -3, 3)")), F.lit(BUCKETS)).cast("int") + 1
    table = lambda x: F.element_at(F.lit([float(y) for y in x]), bucket)
    within = F.when(c > 0, (c - DISCOUNT) / table(np.maximum(vocab.rest_n, 1))).otherwise(table(vocab.unknown))
    found = found.select(
        "rk", "id", "held_out", "n_tokens",
        F.when(rare, F.when(c > 0, F.col("n")).otherwise(0)).otherwise(F.col("known")).alias("known"),
        F.when(rare, F.col("n") * F.log10((c + 1) / F.lit(float(vocab.denominator)))).otherwise(F.col("base")).alias("base"),
        F.when(rare, F.col("n") * F.log10(within)).otherwise(F.col("score")).alias("score"),
    )
    out = found.groupBy("rk").agg(
        F.max("id").alias(id_col), F.max("held_out").alias("held_out"), F.max("n_tokens").alias("n_tokens"), F.sum("known").cast("long").alias("n_known"),
        F.lit(vocab.n).cast("long").alias("train_tokens"), F.sum("base").alias("base_score"), F.sum("score").alias("score"))
    return out.drop("rk")
