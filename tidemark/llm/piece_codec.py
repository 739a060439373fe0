"""SentencePiece encoding and decoding of merge-type (BPE) models.

Encoding fills a prefix table: for each prefix of a text, the last token of its
encoding is unique. At each end position, tokens that end there come from an
Aho-Corasick automaton; the one whose predecessor, the last token of the prefix
before it, is compatible with it is the entry. Two tokens are compatible if the
merges would leave them apart. Following the entries backwards gives the ids.

No piece of such a vocabulary goes on past a word start (a space mark after
another character), so a text falls into independent segments, each a word with
the marks before it; segments of a partition are remembered, a bounded number. Characters without a
piece fall back to their UTF-8 bytes. The vocabulary is read with the library;
ids are this module's own work.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import given_back, in_slices

MARK = "▁"
_SEGMENT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
_BORDER = re.compile(f"[^{MARK}](?={MARK})")
#: Remembered at most: segments of a partition, tests of a process; characters worked off at a time.
SEGMENTS, TESTS, PIECE = 100_000, 400_000, 1 << 18


def segments_of(text: str) -> Iterator[list[str]]:
    """The segments of a text with marks for spaces, in lists: whatever the text's length, few are held at a time."""
    at = 0
    while at < len(text):
        border = _BORDER.search(text, at + PIECE)
        end = border.end() if border else len(text)
        yield _SEGMENT.findall(text, at, end)
        at = end


class PieceModel:
    """Vocabulary, merges and automaton of a merge-type model file."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(sp.get_piece_size())
        self.end_id, self.unk_id = sp.eos_id(), sp.unk_id()
        self.bytes = {int(sp.id_to_piece(i)[3:5], 16): i for i in ids if sp.is_byte(i)}
        normal = [i for i in ids if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.piece = {i: sp.id_to_piece(i) for i in normal}
        if any(MARK in p.lstrip(MARK) for p in self.piece.values()):
            raise ValueError("a piece goes on past a word start")
        if sp.encode("  a b  ", out_type=str)[-1] != MARK + MARK and sp.encode(" a ") == sp.encode("a"):
            raise ValueError("models that drop extra spaces are not supported")
        # rank: order of merging; single characters merge never
        by_score = sorted(normal, key=lambda i: (-sp.get_score(i), i))
        self.rank = {self.piece[i]: r for r, i in enumerate(by_score)}
        self.id_of = {p: i for i, p in self.piece.items()}
        self.split = {p: self.merge_order(p) for p in self.rank if len(p) > 1}
        # a piece that merges never make is no token; each has its tests against predecessors
        self.automaton = ahocorasick.Automaton()
        for p, parts in self.split.items():
            if parts:
                self.automaton.add_word(p, (len(p), p, {}))
        self.automaton.make_automaton()
        self.surface = {i: p.replace(MARK, " ") for i, p in self.piece.items()} | {self.unk_id: " ⁇ "}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.known: dict[str, tuple[str, int, str]] = {}
        self.tests = 0

    def merge_order(self, text: str) -> tuple[str, str] | None:
        """The two parts whose merge makes ``text`` a piece, None if merges leave it apart."""
        parts = list(text)
        while len(parts) > 2:
            best = min(range(len(parts) - 1), key=lambda k: (self.rank.get(parts[k] + parts[k + 1], 1 << 40), k))
            if parts[best] + parts[best + 1] not in self.rank:
                return None
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return (parts[0], parts[1]) if len(parts) == 2 else None

    def _tested(self, after: dict, before: str, piece: str) -> bool:
        """:meth:`are_compatible`, remembered for up to ``TESTS`` pairs."""
        self.tests += 1
        if self.tests % TESTS == 0:
            for _, _, other in self.automaton.values():
                other.clear()
        ok = after[before] = self.are_compatible(before, piece)
        return ok

    def are_compatible(self, a: str, b: str) -> bool:
        """Whether merging the text ``a + b`` ends with the two tokens a and b.

        Undoes merges of either token, latest first, and looks for a merge over
        the boundary that would have come before the one just undone. Of equal
        rank the one further left goes first.
        """
        rank, split = self.rank, self.split
        before = 1 << 40  # time of the merge that used up the boundary's neighbour
        left_made = False  # whether that merge was of the left token
        while True:
            over = rank.get(a + b)
            # a merge over the boundary comes first if its rank is lower, or equal and further left
            if over is not None and (over < before or (over == before and not left_made)):
                return False
            pa_, pb = split.get(a), split.get(b)
            ra = rank[a] if pa_ else -1
            rb = rank[b] if pb else -1
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                before, left_made, a = ra, True, pa_[1]
            elif rb > ra:
                before, left_made, b = rb, False, pb[0]
            else:  # the same piece on both sides: the right one was merged later
                before, left_made, b = rb, False, pb[0]

    def tokens(self, segment: str) -> list[str]:
        """Tokens of a segment by the prefix table."""
        last, done = ["", *segment], -1
        for end, (size, piece, after) in self.automaton.iter(segment):  # of an end, longest first
            if end == done:
                continue
            start = end + 1 - size
            if start:
                before = last[start]
                ok = after.get(before)
                if ok is None:
                    ok = self._tested(after, before, piece)
                if not ok:
                    continue
            last[end + 1], done = piece, end
        out, at = [], len(segment)
        while at:
            out.append(last[at])
            at -= len(last[at])
        return out[::-1]

    def ids(self, segment: str) -> list[int]:
        out: list[int] = []
        for t in self.tokens(segment):
            i = self.id_of.get(t)
            if i is not None:
                out.append(i)
            elif self.bytes:
                out += [self.bytes[b] for b in t.encode("utf-8", "replace")]
            else:
                out.append(self.unk_id)
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of ids: byte tokens joined to characters, marks to spaces, the first space dropped."""
        out, run, surface = [], bytearray(), self.surface
        for i in ids:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run = bytearray()
            out.append(surface.get(i, ""))
        if run:
            out.append(run.decode("utf-8", "replace"))
        text = "".join(out)
        return text[1:] if text.startswith(" ") else text

    def _remember(self, segment: str) -> tuple[str, int, str]:
        ids = self.ids(segment)
        got = " ".join(map(str, ids)), len(ids), self.decode([self.id_of[MARK], *ids]) if MARK in self.id_of else ""
        if len(segment) <= 64:
            if len(self.known) >= SEGMENTS:
                self.known.clear()
            self.known[segment] = got
        return got

    def encode(self, text: str) -> list[int]:
        """All ids of a text, without the end id."""
        if not text:
            return []
        return [i for part in segments_of(MARK + text.replace(" ", MARK)) for s in part for i in self.ids(s)]

    def digest(self, text: str) -> tuple[int, str, str]:
        """(ids with the end id, SHA-256 of the ids, SHA-256 of the decoded text)."""
        ids_hash, text_hash, n = hashlib.sha256(), hashlib.sha256(), 1
        known, remember, first = self.known, self._remember, True
        for segments in segments_of(MARK + text.replace(" ", MARK)) if text else ():
            got = [known.get(s) or remember(s) for s in segments]
            n += sum([g[1] for g in got])
            ids_hash.update((" ".join([g[0] for g in got]) + " ").encode())
            part = "".join([g[2] for g in got])
            text_hash.update((part[1:] if first and part.startswith(" ") else part).encode("utf-8", "replace"))
            first = False
        ids_hash.update(str(self.end_id).encode())
        return n, ids_hash.hexdigest(), text_hash.hexdigest()


_models: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    """The model of a file, loaded once in a process."""
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


def forget() -> None:
    """Drop the segments that the process's models remember."""
    for m in _models.values():
        m.known.clear()


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids, n_tokens)``: ids of each text and an end id.

    Null texts count as empty: the end id alone. ``path`` must be readable on
    every node. Rows with null or repeated ids are encoded like any other.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for b in in_slices(batches, 1):
            ids = [[*m.encode(t.as_py() or ""), m.end_id] for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array([len(x) for x in ids], pa.int64())], ["id", "ids", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(given_back(run, forget), f"id {kind}, ids array<int>, n_tokens long").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(id, text)`` of encoded rows; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([m.decode(x.as_py() or []) for x in b.column(1)], pa.string())], ["id", "text"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(F.col(id_col).alias("id"), ids_col).mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id_col)


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_tokens, ids_sha256, decoded_sha256)``: encode, then decode, whole texts.

    The digests are those of the decimal ids joined by spaces, end id included,
    and of the decoded text in UTF-8. Nulls as in :func:`encode`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for b in in_slices(batches, 1):
            got = [m.digest(t.as_py() or "") for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.string()), pa.array([g[2] for g in got], pa.string())], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(given_back(run, forget), f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)
