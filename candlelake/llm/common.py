"""Helpers the corpus operators share: tables in the shared folder, words, and Arrow batches."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlelake.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Spark's setting that removes the shuffle files of an execution at its end, not when the driver next collects garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Spark's bound of what goes to a Python worker at once; by default 10,000 rows whatever their texts, or 64 MB.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_PASSING: list[list[str]] = []


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are dropped at the end, but for those kept: nothing that goes on may read the others.

    What is staged is written, so the shuffle files it came from go with each execution inside; what goes to Python
    goes in batches of the size of a slice. The session's own settings for these come back at the end.
    """
    held: list[str] = []
    inside = {SHUFFLE_CLEANUP: "true", BATCH_BYTES: str(SLICE_BYTES)}
    before = {key: spark.conf.get(key) for key in inside}
    _PASSING.append(held)
    for key, value in inside.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        _PASSING.pop()
        for key, value in before.items():
            spark.conf.set(key, value)
        for path in held:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def staged(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """The rows as a table in the shared folder: cuts lineage and survives lost executors.

    Inside :func:`passing` the table goes with it, or if it is to be kept with what surrounds it.
    """
    path = scratch_path(df.sparkSession, label)
    for held in _PASSING[-2:-1] if keep else _PASSING[-1:]:
        held.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = 50_000) -> DataFrame:
    """A stored table with a broadcast hint if it has no more than so many rows, else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def shuffle_parts(spark: SparkSession) -> int:
    """Number of shuffle partitions the session was sized for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def worker_state() -> dict:
    """What a reused Python worker keeps between tasks; functions travel by value, globals do not stay."""
    return vars(sys.modules.setdefault("candlelake_worker", types.ModuleType("candlelake_worker")))


def give_back() -> None:
    """Memory that Arrow and the C library of this worker hold unused goes back: the worker waits for more tasks."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def utf8(texts: pa.Array) -> list[bytes]:
    """The texts as UTF-8, null as empty."""
    return [text or b"" for text in texts.cast(pa.binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES,
           row_bytes: int = 0) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about so many text bytes, one row at least; a row counts ``row_bytes`` besides.

    What the worker does not need any more goes back at the end.
    """
    for batch in batches:
        sizes = np.nan_to_num(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False))
        step = np.cumsum(sizes + row_bytes) // limit
        edges = np.flatnonzero(np.diff(step)) + 1
        for low, high in zip([0, *edges], [*edges, batch.num_rows], strict=True):
            if high > low:
                yield batch.slice(low, high - low)
    batch = None
    give_back()


def per_slice(work: Callable[[pa.RecordBatch], pa.RecordBatch]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """A mapInArrow function that applies work to slices of bounded size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield work(batch)
    return run
