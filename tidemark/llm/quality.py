"""Quality by hierarchical empirical Bayes.

A logistic classifier of text features gives each document its own evidence, a
log-likelihood ratio of good to poor. Labelled documents give each site (host)
and each path within a site a Beta posterior of being good, shrunk to its parent:
path to host, host to the global rate, with strengths fitted by moments. A
document's posterior log-odds are its path's prior log-odds plus its evidence,
and a second pass lets unlabelled documents speak for their site too, by their
evidence, each for all but itself. Sites are grouped aggregates, never groups held by a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_pieces, stash

FEATURES = ("log words", "word length", "upper", "symbols", "digits", "distinct words", "repeated neighbours", "distinct lines", "bars", "long words", "stops", "letters", "top word", "symbol words", "log line words", "longest run")


def features(text: str | None) -> list[float]:
    """Features of a whole text; zeros for null, empty or wordless texts."""
    if not text:
        return [0.0] * len(FEATURES)
    data = text.encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    n_bytes = max(1, len(data))
    upper, lower = counts[65:91].sum(), counts[97:123].sum()
    high, digits = counts[128:].sum(), counts[48:58].sum()
    spaces = counts[9:14].sum() + counts[32]
    stops = counts[46] + counts[63]
    symbols = n_bytes - upper - lower - high - digits - spaces - stops - counts[44]
    tally: dict[bytes, int] = {}
    n = repeats = long_words = odd = run = longest = 0
    before = None
    for piece in in_pieces(data.lower()):
        words = piece.split()
        n += len(words)
        for w in words:
            tally[w] = tally.get(w, 0) + 1
            if w == before:
                repeats += 1
                run += 1
                longest = max(longest, run)
            else:
                run = 0
            before = w
        long_words += sum([len(w) > 24 for w in words])
        odd += sum([not w[-1:].isalnum() and w[-1] < 128 and w[-1:] not in b".,?;:" for w in words])
    if not n:
        return [0.0] * len(FEATURES)
    lines = [x for x in text.split("\n") if x.strip()]
    return [
        np.log1p(n), (n_bytes - spaces) / n / 10, upper / max(1, upper + lower), 10 * symbols / n_bytes, 10 * digits / n_bytes, len(tally) / n, repeats / n,
        len(set(lines)) / max(1, len(lines)), counts[124] / n, long_words / n, stops / n, (upper + lower + high) / n_bytes, max(tally.values()) / n, odd / n, np.log1p(n / max(1, len(lines))), np.log1p(longest),
    ]


class Classifier:
    """Logistic regression on standardised features, their squares and products."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30):
        self.ok = bool(len(y) and 0 < y.mean() < 1)
        if not self.ok:
            return
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        z = self._expand(x)
        w = np.zeros(z.shape[1])
        self.prior = np.log(y.mean() / (1 - y.mean()))
        for _ in range(steps):  # Newton
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            h = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
            step = np.linalg.solve(h, z.T @ (y - p) - ridge * w)
            w += step
            if np.abs(step).max() < 1e-6:
                break
        self.w = w

    def _expand(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        i, j = np.triu_indices(z.shape[1])
        return np.concatenate([np.ones((len(z), 1)), z, z[:, i] * z[:, j] / 4], axis=1)

    def evidence(self, x: np.ndarray) -> np.ndarray:
        """Log-likelihood ratio of good to poor: log-odds less the training prior's."""
        if not self.ok:
            return np.zeros(len(x))
        return np.clip(self._expand(x) @ self.w - self.prior, -12, 12)


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [features(t.as_py()) for t in b.column(b.num_columns - 1)]
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(rows, pa.list_(pa.float64()))], [*b.schema.names[:-1], "x"])


def _strength(df: DataFrame, parent_mean: Column | float, floor: float = 2.0, ceiling: float = 1000.0) -> float:
    """Pseudo-count of a level's Beta prior, by moments.

    With rates p of n labels around means m, the sum of (p - m)^2 * n / (m(1-m))
    is about 1 + (n - 1) / (strength + 1) for each group.
    """
    m = F.greatest(F.least(parent_mean if isinstance(parent_mean, Column) else F.lit(parent_mean), F.lit(0.999)), F.lit(0.001))
    p = F.col("good") / F.col("n")
    got = df.where("n > 1").agg(F.sum(F.pow(p - m, 2) * F.col("n") / (m * (1 - m)) - 1).alias("over"), F.sum(F.col("n") - 1).alias("n")).first()
    if not got["n"]:
        return floor
    rho = max(1e-6, got["over"] / got["n"])
    return float(min(ceiling, max(floor, 1 / rho - 1)))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host: Column | None = None, path: Column | None = None, label_col: str = "quality", sample_rows: int = 20_000, threshold: float = 0.5) -> DataFrame:
    """``(id, evidence, host_rate, path_rate, score, kept)``, a row for each row of ``docs``.

    ``labels`` has ``id`` and a 0/1 label; rows without one, null labels and
    labels of unknown ids don't count, and of several for an id the greatest
    does. The classifier is fitted on about ``sample_rows`` labelled rows, chosen
    by hash of the id; rates cover all. ``host`` and ``path`` default to the
    columns source and lang; a null one is a site of its own. Null, empty and
    wordless texts have score 0 and are not kept. Both rates leave the row's own label or
    evidence out. Rows with null or repeated ids are judged like any other. Without labels of both kinds
    the evidence is 0, and without any label the global rate is 1/2.
    """
    spark = docs.sparkSession
    host = F.col("source") if host is None else host
    path = F.col("lang") if path is None else path
    rows = docs.select(F.col(id_col).alias("id"), host.cast("string").alias("host"), path.cast("string").alias("path"), F.col(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    made = stash(rows.mapInArrow(_featured, f"id {id_type}, host string, path string, x array<double>"))
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg((F.max(label_col) > 0).cast("int").alias("y"))
    labelled = stash(made.join(known, "id").where(F.element_at("x", 1) > 0))
    n = labelled.count()
    some = labelled.where(F.pmod(F.xxhash64("id"), F.lit(max(1, n))) < sample_rows).select("x", "y").toPandas()
    x = np.array(some["x"].tolist(), np.float64).reshape(-1, len(FEATURES))
    model = Classifier(x, some["y"].to_numpy(np.float64))
    shared = spark.sparkContext.broadcast(model)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            f = np.array(b.column(3).to_pylist(), np.float64).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(m.evidence(f)), pa.array(f[:, 0] > 0)], ["id", "host", "path", "evidence", "worded"])

    scored = stash(made.mapInArrow(judged, f"id {id_type}, host string, path string, evidence double, worded boolean"))
    rate = lambda s: 1 / (1 + F.exp(-s))
    logit = lambda p: F.log(p / (1 - p))
    total = labelled.agg(F.avg("y")).first()[0]
    overall = min(0.99, max(0.01, total if total is not None else 0.5))

    # a labelled document counts 1; others by their posterior under the global rate, a quarter each
    soft = scored.join(known, "id", "left").where("worded")
    weight = F.when(F.col("y").isNotNull(), 1.0).otherwise(0.25)
    good = F.coalesce(F.col("y").cast("double"), rate(F.lit(float(np.log(overall / (1 - overall)))) + F.col("evidence")))
    soft = soft.select("host", "path", weight.alias("w"), (good * weight).alias("g"))
    paths = stash(soft.groupBy("host", "path").agg(F.sum("w").alias("n"), F.sum("g").alias("good")))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    # how far rates differ between sites, and between paths of a site, shows in whole labels
    seen = stash(labelled.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("y").alias("good")))
    k_host = _strength(seen.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good")), overall)
    hosts = hosts.select(F.col("host").alias("h"), F.col("n").alias("host_n"), F.col("good").alias("host_good"))
    host_mean = (F.col("host_good") + k_host * overall) / (F.col("host_n") + k_host)
    k_path = _strength(seen.join(hosts, F.col("host").eqNullSafe(F.col("h"))), host_mean)
    paths = paths.select("host", F.col("path").alias("p"), F.col("n").alias("path_n"), F.col("good").alias("path_good"))
    paths = paths.join(hosts, F.col("host").eqNullSafe(F.col("h"))).drop("host")
    # what a document itself says, or its label, is left out of the rates that it meets
    own = scored.join(known, "id", "left")
    own = own.withColumn("w", F.when(~F.col("worded"), 0.0).otherwise(weight)).withColumn("g", F.when(~F.col("worded"), 0.0).otherwise(good * weight))
    out = own.join(paths, own["host"].eqNullSafe(paths["h"]) & own["path"].eqNullSafe(paths["p"]), "left")
    host_rate = (F.coalesce("host_good", F.lit(0.0)) - F.col("g") + k_host * overall) / (F.coalesce("host_n", F.lit(0.0)) - F.col("w") + k_host)
    out = out.withColumn("host_rate", F.greatest(F.least(host_rate, F.lit(0.999)), F.lit(0.001)))
    path_rate = (F.coalesce("path_good", F.lit(0.0)) - F.col("g") + k_path * F.col("host_rate")) / (F.coalesce("path_n", F.lit(0.0)) - F.col("w") + k_path)
    prior = F.greatest(F.least(path_rate, F.lit(0.999)), F.lit(0.001))
    score = F.when(F.col("worded"), rate(logit(prior) + F.col("evidence"))).otherwise(0.0)
    return out.select(F.col("id").alias(id_col), "evidence", "host_rate", prior.alias("path_rate"), score.alias("score"), (score >= threshold).alias("kept"))
