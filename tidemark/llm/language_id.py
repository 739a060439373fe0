"""Language identification by string kernels.

A text is the set of its character n-grams of lengths 1 to 3 (a blended
spectrum, presence only), over letters with all else as one space. The kernel of
two texts is the cosine of their sets. Landmark texts give a Nyström map; kernel
ridge regression on it, one language against the rest, gives the scores.

A kernel value is a sum over shared n-grams, so with W the landmarks' presence
matrix times the regression's weights, all scores of a batch are one product of
its presence matrix with W, divided by the norms.
"""

from __future__ import annotations

import copy
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import given_back, in_slices

UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
#: Codes of characters: space, other letters, then the alphabet.
MAX_ALPHABET = 94
BATCH = 64
#: Characters of a text that are worked off at a time.
PIECE = 1 << 18


class Featurizer:
    """Presence of n-grams, as codes, of a text."""

    def __init__(self, alphabet: str):
        self.alphabet = alphabet
        self.size = len(alphabet) + 2
        codes = np.zeros(0x110000, np.uint8)
        codes[_letters()] = 1
        for i, c in enumerate(alphabet):
            codes[[ord(x) for x in {c, c.upper()} if len(x) == 1]] = i + 2
        self.codes = codes
        self.offsets = (0, self.size, self.size + self.size**2)
        self.total = self.size + self.size**2 + self.size**3

    def grams(self, text: str) -> np.ndarray:
        """Sorted distinct codes of the n-grams of the whole text."""
        present = np.zeros(self.total, bool)
        before = np.zeros(0, np.int64)  # the last two characters, after merging, of the piece before
        for a in range(0, len(text), PIECE):
            raw = np.frombuffer(text[a : a + PIECE].encode("utf-32-le", "surrogatepass"), np.uint32)
            c = np.r_[before, self.codes[raw].astype(np.int64)]
            keep = np.ones(len(c), bool)
            keep[1:] = (c[1:] != 0) | (c[:-1] != 0)  # runs of spaces are one
            c = c[keep]
            before = c[-2:]
            present[c] = True
            if len(c) > 1:
                two = c[:-1] * self.size + c[1:]
                present[two + self.offsets[1]] = True
                if len(c) > 2:
                    present[two[:-1] * self.size + c[2:] + self.offsets[2]] = True
        return np.flatnonzero(present)


_letter_points: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Code points of letters."""
    if not _letter_points:
        _letter_points.append(np.array([i for i in range(0x110000) if not 0xD800 <= i < 0xE000 and chr(i).isalpha()]))
    return _letter_points[0]


class LanguageModel:
    """Nyström landmarks and one-versus-rest kernel ridge regression."""

    def __init__(self, texts: list[str], langs: list[str], landmarks: int = 192, ridge: float = 0.1):
        """Fit on labelled texts; the first ``landmarks`` in a round over the languages are landmarks."""
        self.langs = sorted(set(langs))
        letters = Counter(c for t in texts for c in t.lower() if c.isalpha())
        self.features = Featurizer("".join(c for c, _ in sorted(letters.items(), key=lambda x: (-x[1], x[0]))[:MAX_ALPHABET]))
        grams = [self.features.grams(t) for t in texts]
        by_lang = {x: [i for i, y in enumerate(langs) if y == x] for x in self.langs}
        rounds = [i for k in range(len(texts)) for x in self.langs for i in by_lang[x][k : k + 1]]
        marks = [i for i in rounds if len(grams[i])][:landmarks]
        self.vocabulary = np.unique(np.concatenate([grams[i] for i in marks])) if marks else np.zeros(0, np.int64)
        self.column = np.full(self.features.total, -1, np.int32)
        self.column[self.vocabulary] = np.arange(len(self.vocabulary))
        mark_rows = self.presence([grams[i] for i in marks])
        self.landmarks = mark_rows / np.sqrt(np.maximum(1, [len(grams[i]) for i in marks]))[:, None]
        if not marks:
            self.weights, self.bias = np.zeros((0, len(self.langs))), np.zeros(len(self.langs))
            return
        k_mm = self.landmarks @ self.landmarks.T
        values, vectors = np.linalg.eigh(k_mm.astype(np.float64))
        good = values > 1e-6 * values[-1]
        whiten = vectors[:, good] / np.sqrt(values[good])
        phi = np.concatenate([self.kernel(grams[i : i + BATCH]) for i in range(0, len(grams), BATCH)]) @ whiten
        y = np.where(np.array(langs)[:, None] == np.array(self.langs)[None, :], 1.0, -1.0)
        # every language weighs the same
        w = np.array([len(texts) / (len(self.langs) * len(by_lang[x])) for x in langs])
        mean, y_mean = np.average(phi, axis=0, weights=w), np.average(y, axis=0, weights=w)
        z = phi - mean
        beta = np.linalg.solve((z * w[:, None]).T @ z + ridge * np.eye(z.shape[1]), (z * w[:, None]).T @ (y - y_mean))
        self.dual = whiten @ beta
        self.bias = y_mean - mean @ beta
        self.weights = (self.landmarks.T @ self.dual).astype(np.float32)

    def for_tasks(self) -> LanguageModel:
        """A copy without the landmarks, which scores don't need."""
        out = copy.copy(self)
        out.landmarks = out.dual = None
        return out

    def presence(self, grams: list[np.ndarray]) -> np.ndarray:
        """Presence matrix of texts over the landmarks' n-grams."""
        out = np.zeros((len(grams), len(self.vocabulary)), np.float32)
        for i, g in enumerate(grams):
            at = self.column[g]
            out[i, at[at >= 0]] = 1
        return out

    def kernel(self, grams: list[np.ndarray]) -> np.ndarray:
        """Kernel of texts with the landmarks."""
        norms = np.sqrt(np.maximum(1, [len(g) for g in grams]))
        return (self.presence(grams) @ self.landmarks.T).astype(np.float64) / norms[:, None]

    def scores(self, texts: list[str]) -> np.ndarray:
        """A row of scores, one for each language, for each text."""
        grams = [self.features.grams(t) for t in texts]
        norms = np.sqrt(np.maximum(1, [len(g) for g in grams]))
        return (self.presence(grams) @ self.weights).astype(np.float64) / norms[:, None] + self.bias

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, score) of each text; ``und`` and 0 without a letter.

        The score is the best language's softmax share of the scores, with a
        margin of 1 taken as e^4.
        """
        out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
        at = [i for i, t in enumerate(texts) if t and _LETTER.search(t)]
        for a in range(0, len(at) if self.langs else 0, BATCH):
            some = at[a : a + BATCH]
            s = 4 * self.scores([texts[i] for i in some])
            p = np.exp(s - s.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            for i, k, q in zip(some, p.argmax(axis=1), p):
                out[i] = self.langs[k], float(q[k])
        return out


def training_sample(docs: DataFrame, use: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_lang: int = 250, max_chars: int = 20_000) -> list[tuple[str, str]]:
    """(language, text) of about ``per_lang`` distinct texts of each language, where ``use`` holds.

    Texts of at most ``max_chars`` characters come first, then by hash, for as
    long as they come to no more than ``per_lang * max_chars`` characters, but one
    at least: a bounded sample, in which copies count once. Each task passes on its own first rows of a language only.
    """
    rows = docs.where(use & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.xxhash64(text_col).alias("h"), F.greatest(F.length(text_col), F.lit(max_chars)).alias("size")).distinct()
    first = Window.partitionBy("lang").orderBy("size", "h")
    chosen = rows.withColumn("n", F.row_number().over(first)).where(F.col("n") <= per_lang)
    chosen = chosen.withColumn("sum", F.sum("size").over(first)).where((F.col("n") == 1) | (F.col("sum") <= per_lang * max_chars)).select("lang", "h").collect()
    wanted: dict[int, set[str]] = {}
    for r in chosen:
        wanted.setdefault(r["h"], set()).add(r["lang"])
    keys = docs.sparkSession.createDataFrame([(h,) for h in wanted] or [(0,)], "_h long")
    texts = docs.where(use & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("_h"))
    found = texts.join(F.broadcast(keys), "_h", "left_semi").dropDuplicates(["lang", "_h"]).collect()
    return sorted((r["lang"], r["text"]) for r in found if r["lang"] in wanted.get(r["_h"], ()))


def train(docs: DataFrame, use: Column | None = None, **settings) -> LanguageModel:
    """A model of the rows where ``use`` holds; settings as of :func:`training_sample`."""
    pairs = training_sample(docs, F.lit(True) if use is None else use, **settings)
    return LanguageModel([t for _, t in pairs], [x for x, _ in pairs])


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, from whole texts only.

    ``und`` and 0 where the text is null or has no letter, or if the model has
    no language. Texts with letters that share no n-gram with the landmarks get
    the model's bias. Existing columns of these two names are replaced.
    """
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    # the model goes to the tasks with the function: its size is bounded by landmarks and n-grams
    shared = docs.sparkSession.sparkContext.broadcast(model.for_tasks())
    at = kept.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in in_slices(batches, at):
            got = m.predict(b.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], [*b.schema.names, "lang_pred", "score"])

    from pyspark.sql.types import DoubleType, StringType, StructType

    source = docs.select(*[docs[c] for c in kept])
    return source.mapInArrow(given_back(run), StructType([*source.schema.fields]).add("lang_pred", StringType()).add("score", DoubleType()))
