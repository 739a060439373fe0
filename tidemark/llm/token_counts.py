"""Token counts of merge-type (BPE) SentencePiece models by a whole-token shortcut.

Before any text is seen it is proved, for each vocabulary string that can be a
whole pre-token, whether its own merges rebuild it: such a string encodes alone
as one token. A text falls into pre-tokens, words with the marks before them,
which never merge with one another; those that are such strings count one each
by a look-up in a set, and only the rest is merged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import piece_codec
from .common import given_back, in_slices
from .piece_codec import MARK, PieceModel, segments_of

_WHOLE = re.compile(f"{MARK}+[^{MARK}]*")
#: Merged pre-tokens that a partition remembers at most, and their longest.
REMEMBERED, LONGEST = 100_000, 64


def whole_tokens(m: PieceModel) -> frozenset[str]:
    """The vocabulary strings that, as a pre-token, encode as one token.

    A pre-token begins with a mark, as each text does. A string of several
    characters is its own encoding if merging its characters in the model's
    order ends in the whole: not all strings of a vocabulary do.
    """
    return frozenset(p for p in m.id_of if _WHOLE.fullmatch(p) and (len(p) == 1 or m.split[p]))


class TokenCounter:
    def __init__(self, m: PieceModel):
        self.model, self.whole = m, whole_tokens(m)
        self.merged: dict[str, int] = {}

    def _merge(self, segment: str) -> int:
        """Tokens of a pre-token that is no vocabulary string by itself; characters without a piece count their bytes."""
        m = self.model
        n = sum(1 if t in m.id_of or not m.bytes else len(t.encode("utf-8", "replace")) for t in m.tokens(segment))
        if len(segment) <= LONGEST:
            if len(self.merged) >= REMEMBERED:
                self.merged.clear()
            self.merged[segment] = n
        return n

    def count(self, text: str) -> int:
        """Tokens of a whole text, no begin or end token."""
        n, whole, merged = 0, self.whole, self.merged
        for segments in segments_of(MARK + text.replace(" ", MARK)) if text else ():
            rest = [s for s in segments if s not in whole]
            n += len(segments) - len(rest)
            for s in rest:
                n += merged.get(s) or self._merge(s)
        return n


_counters: dict[str, TokenCounter] = {}


def counter(path: str) -> TokenCounter:
    """The counter of a model file, made once in a process."""
    if path not in _counters:
        _counters[path] = TokenCounter(piece_codec.model(path))
    return _counters[path]


def forget() -> None:
    """Drop what the process's counters remember of merges."""
    for c in _counters.values():
        c.merged.clear()


def count_tokens(docs: DataFrame, path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_bytes, n_tokens, over_limit)`` of each text, in UTF-8 bytes and tokens of the model at ``path``.

    Null and empty texts have 0 of both. Neither begin nor end tokens count, and
    the strings of control tokens in a text are ordinary text. Rows with null or
    repeated ids are counted like any other. ``path`` must be readable on every
    node.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for b in in_slices(batches, 1):
            n = pa.array([c.count(t.as_py() or "") for t in b.column(1)], pa.int64())
            n_bytes = pc.fill_null(pc.binary_length(b.column(1)), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), n_bytes, n, pc.greater(n, limit)], ["id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(given_back(run, forget, piece_codec.forget), f"id {kind}, n_bytes long, n_tokens long, over_limit boolean").withColumnRenamed("id", id_col)
