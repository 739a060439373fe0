"""URL filters: rules by host and path, and a character model for the rest.

Two smoothed variable-order Markov models, of accepted and of rejected URLs, are
counted over all URLs that the rules decide. A URL without a rule is judged by
the difference of its log-likelihoods per character against a threshold that is
calibrated on decided URLs that it wasn't counted over.

Characters fold to a fixed alphabet (case and digits folded), so counts of all
contexts have a proven bound: ``SIZE ** (ORDER + 1)`` for each model.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALPHABET = "abcdefghijklmnopqrstuvwxyz0/.-_?=&%#:~+@"
SIZE = len(ALPHABET) + 2  # 0: start, last: others
ORDER = 3
#: Default rules: (host, path, verdict).
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
BINS = 2001
#: One part in so many of the decided URLs sets the threshold.
PARTS = 5

_CODES = np.full(0x110000, SIZE - 1, np.int64)
for _i, _c in enumerate(ALPHABET):
    _CODES[[ord(_c), ord(_c.upper())]] = _i + 1
_CODES[48:58] = ALPHABET.index("0") + 1


def host_of(url: Column) -> Column:
    """After the first ``://`` up to /, ?, # or end, A-Z lower-cased; empty without."""
    raw = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ?, # or end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _grams(url: str) -> np.ndarray:
    """Codes of each character with the ORDER before it."""
    c = _CODES[np.frombuffer(url.encode("utf-32-le", "surrogatepass"), np.uint32)]
    c = np.r_[np.zeros(ORDER, np.int64), c]
    out = np.zeros(len(c) - ORDER, np.int64)
    for k in range(ORDER + 1):
        out = out * SIZE + c[k : k + len(out)]
    return out


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums = np.zeros((4, SIZE ** (ORDER + 1)), np.int32)
    for b in batches:
        for url, side in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            np.add.at(sums[side], _grams(url), 1)
    for side in range(4):
        at = np.flatnonzero(sums[side])
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), side, np.int64)), pa.array(at), pa.array(sums[side][at], pa.int64())], ["side", "gram", "n"])


def smoothed(counts: np.ndarray) -> np.ndarray:
    """Log-probabilities of the last character after the ones before it.

    Each order backs off to the next shorter one by Witten-Bell weights: the
    share of a context's occurrences that brought a new character.
    """
    below = np.full(SIZE, 1.0 / SIZE)
    for order in range(ORDER + 1):
        n = counts.reshape(-1, SIZE ** (order + 1)).sum(axis=0).reshape(-1, SIZE).astype(np.float64)
        total, kinds = n.sum(axis=1, keepdims=True), (n > 0).sum(axis=1, keepdims=True)
        back = np.tile(below.reshape(-1, SIZE), (len(n) // max(1, below.size // SIZE), 1))
        below = np.where(total > 0, (n + kinds * back) / np.maximum(total + kinds, 1), back)
    return np.log(below).ravel()


class UrlModel:
    """Log-ratio of accepted to rejected for each n-gram, and the threshold."""

    def __init__(self, counts: np.ndarray):
        self.known = bool(counts[0].sum() and counts[1].sum())
        self.default = not counts[0].sum()  # with one kind only, that one; with none, allow
        self.ratio = (smoothed(counts[1]) - smoothed(counts[0])).astype(np.float32) if self.known else np.zeros(1, np.float32)
        self.threshold = 0.0
        self.error = None  # mean error of the two kinds at the threshold

    def score(self, url: str) -> float:
        """Log-likelihood difference per character; 0 for an empty URL."""
        if not url or not self.known:
            return 0.0
        return float(self.ratio[_grams(url)].mean(dtype=np.float64))


def _scored(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            s = [m.score(u or "") for u in b.column("url").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s, pa.float64())], [*b.schema.names, "score"])

    return run


def train(urls: DataFrame, rules=RULES) -> UrlModel:
    """The model of ``(url, verdict)``, the verdict null where no rule decides.

    At most 4 * SIZE ** (ORDER + 1) counts come to the driver. The threshold is
    the one with the least mean error of the two kinds on one part in
    ``PARTS`` of the decided URLs, by their hash, under a model counted over the
    others, from a histogram of the scores; the model that is returned counts
    all. If one of the two lacks a kind, the model of all URLs judges them all.
    """
    held_out = F.pmod(F.xxhash64("url"), F.lit(PARTS)) == 0
    decided = urls.where("verdict IS NOT NULL AND url IS NOT NULL").select("url", (F.col("verdict") == "allow").alias("allow"), held_out.alias("held_out"))
    side = F.col("allow").cast("long") + 2 * F.col("held_out").cast("long")
    got = decided.select("url", side.alias("side")).mapInArrow(_counted, "side long, gram long, n long").groupBy("side", "gram").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((4, SIZE ** (ORDER + 1)), np.int64)
    counts[got["side"].to_numpy(np.int64), got["gram"].to_numpy(np.int64)] = got["n"].to_numpy(np.int64)
    model, learnt = UrlModel(counts[:2] + counts[2:]), UrlModel(counts[:2])
    if not model.known:
        return model
    apart = learnt.known and counts[2].any() and counts[3].any()
    shared = urls.sparkSession.sparkContext.broadcast(learnt if apart else model)
    judged = decided.where("held_out") if apart else decided
    scores = judged.select("url", "allow").mapInArrow(_scored(shared), "url string, allow boolean, score double")
    bins = scores.groupBy("allow", F.least(F.greatest(F.floor((F.col("score") + 2) * (BINS // 4)), F.lit(0)), F.lit(BINS - 1)).alias("bin")).count().collect()
    hist = np.zeros((2, BINS))
    for r in bins:
        hist[int(r["allow"]), r["bin"]] += r["count"]
    below = np.cumsum(hist / np.maximum(hist.sum(axis=1, keepdims=True), 1), axis=1)
    error = below[1] + (1 - below[0])  # with bins up to k rejected
    best = np.flatnonzero(error <= error.min() + 1e-12)
    model.threshold = (best[len(best) // 2] + 1) / (BINS // 4) - 2
    model.error = float(error.min() / 2)
    return model


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """``(id, host, path, rule, verdict, score)``, a row for each page.

    Null URLs and those without ``://`` have empty host and path; no rule fits
    them. A URL that no rule decides is allowed if its score is over the
    threshold; without URLs of both kinds to learn from, it gets the verdict of
    the kind there is, or ``allow``. Other columns of ``pages`` are ignored.
    """
    url = F.col(url_col).cast("string")
    rows = pages.select(F.col(id_col).alias("id"), url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumn("r", rule_of(F.col("host"), F.col("path"), rules)).select("id", "url", "host", "path", "r.rule", "r.verdict")
    model = train(rows, rules)
    shared = pages.sparkSession.sparkContext.broadcast(model)
    kind = pages.schema[id_col].dataType.simpleString()
    out = rows.mapInArrow(_scored(shared), f"id {kind}, url string, host string, path string, rule string, verdict string, score double")
    allowed = (F.col("score") > model.threshold) if model.known else F.lit(model.default)
    verdict = F.coalesce("verdict", F.when(allowed, "allow").otherwise("block"))
    return out.select(F.col("id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), "score")
