"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: ASCII white space that separates words; everything else belongs to a word.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes, as Catalyst estimates them, or rows of numbers in a written file, and least files of a table.
FILE_BYTES, FILE_ROWS, MIN_FILES = 4 << 20, 250_000, 8


def shared_dir(spark: SparkSession) -> str:
    """The folder all nodes share, as ``spark.checkpoint.dir`` names it.

    A local session without that setting gets a temporary folder, which is
    then set as the checkpoint folder.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all nodes share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
        named = sc.getCheckpointDir()
    return named.rstrip("/")


def stash(df: DataFrame, rows: int | None = None, like: DataFrame | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage: a lost executor costs no more than the tasks it ran.
    The shuffle files of the write are freed at its end. The table's files go when the application ends, or by :func:`discard`.
    Its files are as :func:`compacted` makes them.
    """
    spark = df.sparkSession
    df = compacted(df, rows, like)
    path = f"{shared_dir(spark)}/stash-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    out = spark.read.schema(df.schema).parquet(path)
    out._stashed_at = path
    return out


def compacted(df: DataFrame, rows: int | None = None, like: DataFrame | None = None) -> DataFrame:
    """``df`` without very many tiny partitions, which would be as many tiny files.

    A partition for each ``FILE_ROWS`` of the ``rows`` small rows that it has at
    most, or for each ``FILE_BYTES`` that Catalyst expects of it, or of ``like``,
    and no more than it has now. No row moves: partitions are worked off in a row.
    """
    if rows is None:
        size = int(str((like or df)._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        files = min(-(-size // FILE_BYTES), 1 << 30)
    else:
        files = -(-rows // FILE_ROWS)
    return df.coalesce(max(MIN_FILES, files))


def dealt_out(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is shuffled, never gathered by the driver to be broadcast.

    For tables that grow with the input: Spark takes them for small by their
    compressed size, of which the table to broadcast can be many times as large.
    """
    return df.hint("merge")


def discard(df: DataFrame) -> None:
    """Delete the files of a stashed frame that nothing reads any more."""
    path = getattr(df, "_stashed_at", None)
    if path:
        spark = df.sparkSession
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def unused(name: str, df: DataFrame) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def crc_bucket(key: Column, n: int) -> Column:
    """crc32 of the key's text, modulo ``n``; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % n


def is_bucket(key: Column, n: int, k: int) -> Column:
    """True where :func:`crc_bucket` is ``k``; false for a null key."""
    return F.coalesce(crc_bucket(key, n) == k, F.lit(False))


def in_pieces(data: bytes, size: int = 4 << 20) -> Iterator[bytes]:
    """``data`` cut at white space into pieces of about ``size`` bytes.

    A word is never cut, so words of all pieces are the words of the whole.
    """
    at, end = 0, len(data)
    while end - at > size:
        cut = at + size
        while cut < end and data[cut] not in b" \t\n\r\x0b\x0c":
            cut += 1
        yield data[at:cut]
        at = cut
    yield data[at:]


def in_slices(batches: Iterator[pa.RecordBatch], text: int, size: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batches, cut where the texts in column ``text`` come to about ``size`` bytes."""
    for b in batches:
        if len(b):
            ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            cuts = np.flatnonzero(np.diff(ends // size)) + 1
            for a, e in pairwise([0, *cuts.tolist(), len(b)]):
                yield b.slice(a, e - a)


def given_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], *forget: Callable[[], None]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, at whose end the worker drops what it remembers and gives its memory back.

    Spark reuses workers: without this, what one stage gathered would still be
    held while later ones run.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            for f in forget:
                f()
            gc.collect(0)
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return whole
