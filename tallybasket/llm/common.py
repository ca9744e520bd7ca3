"""Shared helpers: written intermediate tables and vectorised tokens and hashes over Arrow batches.

A *word* is a maximal run of characters other than ``\\x20`` and ``\\x09-\\x0D``. All helpers work on
the UTF-8 bytes of many texts at once, so numpy runs over a megabyte and not over a document.
"""

from __future__ import annotations

import gc
import os
from collections.abc import Iterator
from functools import reduce
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybasket.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that one numpy step takes; a longer text is a step of its own.
STEP_BYTES = 1 << 20
#: Bytes of an Arrow batch.
BATCH_BYTES = 16 << 20
MAX64 = np.uint64(0xFFFFFFFFFFFFFFFF)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives lost executors.

    Afterwards the driver collects its garbage, so that Spark may delete shuffle files nobody needs.
    """
    path = scratch_path(df.sparkSession, name)
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    spark = df.sparkSession
    del df
    release(spark)
    table = spark.read.schema(schema).parquet(path)
    table.scratch = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``saved`` wrote and that no plan reads any more."""
    for table in tables:
        jvm = table.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(table.scratch)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner find shuffles that are no longer referenced."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def row_key() -> Column:
    """64-bit key of a row: rows that agree in id and text are one and the same document."""
    return F.xxhash64(F.col("doc_id"), F.col("text"))


def steps(texts: pa.Array, size: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts together have about ``size`` bytes."""
    ends = np.frombuffer(offsets_of(texts), dtype=np.int64)
    start, n = 0, len(texts)
    while start < n:
        stop = int(np.searchsorted(ends, ends[start] + size, side="right")) - 1
        stop = min(n, max(stop, start + 1))
        yield start, stop
        start = stop


def offsets_of(texts: pa.Array) -> np.ndarray:
    """Offsets of the texts in their common byte buffer, as int64."""
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    raw = np.frombuffer(texts.buffers()[1], dtype=kind)[texts.offset : texts.offset + len(texts) + 1]
    return raw.astype(np.int64)


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets starting at zero) of an array without nulls."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = offsets_of(texts)
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def single(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def is_space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each document the index of its first word (one more at the end)."""
    solid = ~is_space(data)
    before = np.empty_like(solid)
    before[:1] = False
    before[1:] = solid[:-1]
    after = np.empty_like(solid)
    after[-1:] = False
    after[:-1] = solid[1:]
    inner = offsets[:-1][(offsets[:-1] < len(data))]
    before[inner] = False
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(solid & ~before)
    ends = np.flatnonzero(solid & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every bit over the whole word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Hashes of any span of a sequence of 64-bit values, by differences of prefix sums modulo 2**64."""

    _powers = np.ones(1, np.uint64)
    _inverses = np.ones(1, np.uint64)

    def __init__(self, values: np.ndarray):
        n = len(values)
        if len(Rolling._powers) <= n:
            size = max(n + 1, STEP_BYTES * 5 // 4)
            with np.errstate(over="ignore"):
                Rolling._powers = np.cumprod(np.r_[np.uint64(1), np.full(size, _BASE)])
                Rolling._inverses = np.cumprod(np.r_[np.uint64(1), np.full(size, _BASE_INVERSE)])
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * Rolling._powers[:n], out=self.sums[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * Rolling._inverses[starts]
        return mixed(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def windows(self, length: int) -> np.ndarray:
        """Hash of the span of ``length`` values from every position that has one."""
        n = len(self.sums) - length
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mixed((self.sums[length:] - self.sums[:n]) * Rolling._inverses[:n])


def byte_values(data: np.ndarray) -> np.ndarray:
    return _BYTE_VALUES[data]


def word_values(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word."""
    return Rolling(byte_values(data)).spans(starts, ends)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` consecutive values."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    have, level = 1, values
    while have * 2 <= width:
        level = np.minimum(level[:-have], level[have:])
        have *= 2
    return np.minimum(level[:n], level[width - have : width - have + n]) if have < width else level[:n]


def prepare_tasks(spark: SparkSession) -> None:
    """Settings of the tasks that run Python.

    The bytes of an Arrow batch are bounded, since a batch of many long texts would not fit in memory. The
    folder this package was imported from goes onto the tasks' import path, for drivers that put it onto
    their own alone.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
