"""Shared pieces of the operators: reading tables, staging, and vectorised work on UTF-8 text."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelyard.workspace import shared_folder

#: Bytes of text that one vectorised step works on; a longer document makes a step of its own.
STEP_BYTES = 1 << 18
#: Bytes of a batch that Spark hands to Python, unless the session names its own size. Spark's 64 MB stand in each running task
#: several times, in the executor and in its worker.
ARROW_BYTES = "8m"
#: Places of the bit map of `may_be_in`.
FILTER_BITS = 1 << 26

GOLD = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: a lost executor costs one task, not the lineage."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/llm-{purpose}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(staged: DataFrame, least: int) -> None:
    """Remove the files of a staged table that nothing reads any more, if they have `least` bytes; small ones stay."""
    spark = staged.sparkSession
    for name in {f.rsplit("/", 1)[0] for f in staged.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if files.getContentSummary(path).getLength() >= least:
            files.delete(path, True)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of a write go when the write has ended, and not when the driver next collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def small_batches(spark: SparkSession) -> None:
    """Keep the session's Arrow batches small from now on, as plans read their size when they run."""
    size = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.set(size, spark.conf.get(size, ARROW_BYTES))


def give_back() -> None:
    """Return freed memory to the system: a worker lives on between tasks, and its peak would otherwise stay with it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def giving_back(work: Callable[[pd.DataFrame], pd.DataFrame]) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """`work` on one group, with the memory it took returned after it."""

    def run(rows):
        try:
            return work(rows)
        finally:
            give_back()

    return run


def map_batches(df: DataFrame, step: Callable[..., dict | Iterator[dict]], schema: str, start: Callable | None = None) -> DataFrame:
    """`mapInArrow` for a function that turns one batch into one or several column dictionaries.

    What `start` makes, once a task, is the function's second argument. It goes with the task: a worker lives on, and there
    are more of them than cores, so what each kept would stand in memory several times.
    """
    target = pa_schema(df.sparkSession, schema)
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if start and own is None:
                own = (start(),)
            made = step(batch, *own or ())
            for columns in [made] if isinstance(made, dict) else made:
                yield pa.RecordBatch.from_arrays([as_arrow(columns[f.name], f.type) for f in target], schema=target)
            del batch, made
            give_back()
        if own:
            own = None
            give_back()

    return df.mapInArrow(run, schema)


def pa_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def as_arrow(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    if isinstance(values, np.ndarray) and values.dtype == np.uint64:
        values = values.view(np.int64)
    return pa.array(values, type=kind)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; null is empty text."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
    return data, offsets.astype(np.int64)


def steps(offsets: np.ndarray, limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about `limit` bytes each."""
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1)
        yield low, min(high, rows)
        low = high


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit words."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def seeded(seed: int, n: int) -> np.ndarray:
    """`n` 64-bit numbers from a seed."""
    with np.errstate(over="ignore"):
        return mixed((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed)) * GOLD)


# Lookup tables by byte value: ASCII lower case, and the white space that separates words.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_BYTE = seeded(17, 256)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def word_spans(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in `data[offsets[0]:offsets[-1]]`; words end at bytes `between` and at a row's end.

    Positions are relative to `offsets[0]`.
    """
    low, high = int(offsets[0]), int(offsets[-1])
    inside = ~between[data[low:high]]
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    fresh = np.zeros(len(inside) + 1, bool)
    fresh[offsets - low] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | fresh[1:-1]
    ends = inside
    ends[:-1] &= ~inside[1:] | fresh[1:-1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def span_hashes(data: np.ndarray, low: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the lower-cased byte spans `[low + start, low + end)`, in blocks of bounded size."""
    out = np.zeros(len(starts), np.uint64)
    at = 0
    with np.errstate(over="ignore"):
        while at < len(starts):
            to = max(at + 1, int(np.searchsorted(ends, starts[at] + STEP_BYTES, side="right")))
            first, last = int(starts[at]), int(ends[to - 1])
            n = last - first
            powers = np.cumprod(np.full(n, _BASE, np.uint64))
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(_BYTE[LOWER[data[low + first : low + last]]] * powers, out=sums[1:])
            inverse = np.cumprod(np.full(n, _BASE_INVERSE, np.uint64))
            a, b = starts[at:to] - first, ends[at:to] - first
            out[at:to] = mixed((sums[b] - sums[a]) * inverse[a])
            at = to
    return out


def hashes_of(words: list[str]) -> np.ndarray:
    """The hashes that `span_hashes` gives to some words."""
    data = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w.encode()) for w in words])
    return span_hashes(data, 0, np.concatenate([[0], ends[:-1]]), ends)


def words_of(data: np.ndarray, offsets: np.ndarray, low: int, high: int, between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of rows `low` to `high`, and the number of words before each row (one more entry than rows)."""
    part = offsets[low : high + 1]
    starts, ends = word_spans(data, part, between)
    return span_hashes(data, int(part[0]), starts, ends), np.searchsorted(starts, part - part[0])


def may_be_in(ids: DataFrame):
    """A filter that passes every value of the one column of `ids` and few others, to keep texts out of a shuffle.

    It is a bit map of `FILTER_BITS` hashed places, 8 MB however many values there are; the exact join comes after it.
    """
    column = ids.columns[0]
    place = F.pmod(F.xxhash64(column), F.lit(FILTER_BITS))
    marks = ids.select(place.alias("place")).select(F.floor(F.col("place") / 64).alias("word"), F.expr("shiftleft(1L, cast(place % 64 AS int))").alias("bit"))
    words = marks.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    held = np.zeros(FILTER_BITS // 64, np.int64)
    held[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    shipped = ids.sparkSession.sparkContext.broadcast(held)

    @F.arrow_udf("boolean")
    def passes(places: pa.Array) -> pa.Array:
        at = places.fill_null(0).to_numpy(zero_copy_only=False)
        return pa.array((shipped.value[at >> 6] >> (at & 63)) & 1 == 1)

    return lambda *by: passes(F.pmod(F.xxhash64(*by), F.lit(FILTER_BITS)))
