"""Helpers shared by the operators: written stages, folds, global ranks, text batches."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.sources.zones import shared_scratch

# Bytes that separate words in every contract of this package (fixed values).
SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

# Rows of a batch are worked on in slices of about this many bytes, so that the
# numpy columns beside a text (eight bytes or more per byte) stay small.
SLICE_BYTES = 1 << 18


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder.

    Cuts lineage: what reads it twice sees the same rows, and a lost executor costs
    a task that reads files, not a recomputation.
    """
    path = shared_scratch(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(doc_id: Column, folds: int) -> Column:
    """``crc32(doc_id as text) mod folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


_SENT: ContextVar[list[Broadcast] | None] = ContextVar("sent", default=None)


def sent(spark: SparkSession, value: Any) -> Broadcast:
    """``value`` for every task; inside :func:`released`, until that ends."""
    broadcast = spark.sparkContext.broadcast(value)
    held = _SENT.get()
    if held is not None:
        held.append(broadcast)
    return broadcast


@contextmanager
def released() -> Iterator[None]:
    """Take back what is sent inside, from the driver, executors and their Python workers.

    For work whose result is written before this ends: what was sent is then of no use
    to a lost task either. Workers live on between stages and would keep every model.
    """
    held: list[Broadcast] = []
    token = _SENT.set(held)
    try:
        yield
    finally:
        _SENT.reset(token)
        for broadcast in held:
            broadcast.destroy()


def ranked_within(
    df: DataFrame, group: str, order: Sequence[str], purpose: str, rows: str | None = None
) -> DataFrame:
    """``df`` with ``row_rank``, the row's number from 1 within its group.

    Rows are range-partitioned by group and order, so a group of any size spreads
    over many tasks; each task numbers its own rows, and the counts of the tasks
    before it are added. Only rows equal in all of ``order`` may trade places: a range
    cannot part them, so where there may be many, count them first and name the count's
    column as ``rows``. A row then stands for that many, and has the number of its last.
    """
    keys = [group, *order]
    each = F.col(rows) if rows else F.lit(1)
    placed = written(
        df.repartitionByRange(*keys).withColumn("_task", F.spark_partition_id()), purpose
    )
    within = Window.partitionBy("_task", group).orderBy(*order)
    before = Window.partitionBy(group).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_task", group)
        .agg(F.sum(each).alias("_rows"))
        .select(
            F.col("_task").alias("_of_task"),
            F.col(group).alias("_of_group"),
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        )
    )
    place = F.sum(each).over(within.rowsBetween(Window.unboundedPreceding, 0))
    numbered = placed.withColumn("_place", place)
    same = (F.col("_task") == F.col("_of_task")) & F.col(group).eqNullSafe(F.col("_of_group"))
    return (
        numbered.join(offsets, same)
        .withColumn("row_rank", F.col("_before") + F.col("_place"))
        .drop("_task", "_place", "_of_task", "_of_group", "_before")
    )


def give_back_memory() -> None:
    """Return what this worker has freed to the system; workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def text_of(batch: pa.RecordBatch) -> pa.Array:
    """The batch's column ``text``, or that field of its column ``row``."""
    if "text" in batch.schema.names:
        return batch.column(batch.schema.names.index("text"))
    return pc.struct_field(batch.column(batch.schema.names.index("row")), "text")


def text_slices(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` of a string column, a slice at a time.

    Nulls are empty. A row is never divided, so one long text is a slice of its own.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if n == 0:
        return
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64, count=n + 1 + texts.offset)[texts.offset:]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, "right")) - 1
        end = min(max(end, first + 1), n)
        yield first, end, data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        first = end


def word_spans(
    data: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word of a slice; words end at white space and at row ends."""
    inside = ~(((data >= 9) & (data <= 13)) | (data == 32))
    if not len(data):
        nothing = np.zeros(0, np.int64)
        return nothing, nothing, nothing
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    starts[first] = inside[first]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    last = first[1:] - 1
    ends[last] = inside[last]
    begin, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return begin, end, np.searchsorted(offsets, begin, "right") - 1


_MULTIPLIER = 0x9E3779B97F4A7C15 | 1


def _powers(n: int, base: int) -> np.ndarray:
    """``base ** i`` modulo 2^64 for i below n, by doubling."""
    out = np.ones(max(n, 1), np.uint64)
    filled, step = 1, base
    while filled < n:
        more = min(filled, n - filled)
        out[filled:filled + more] = out[:more] * np.uint64(step)
        filled += more
        step = step * step % (1 << 64)
    return out


_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_TABLES: dict[str, np.ndarray] = {}


def _table(name: str, base: int, n: int) -> np.ndarray:
    known = _TABLES.get(name)
    if known is None or len(known) < n:
        known = _powers(max(n, SLICE_BYTES + 1), base)
        # Workers live on between tasks: what one very long text needs is not kept.
        if len(known) <= 4 * SLICE_BYTES:
            _TABLES[name] = known
    return known


def mixed(keys: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    keys = keys ^ (keys >> np.uint64(33))
    keys = keys * np.uint64(0xFF51AFD7ED558CCD)
    keys = keys ^ (keys >> np.uint64(33))
    keys = keys * np.uint64(0xC4CEB9FE1A85EC53)
    return keys ^ (keys >> np.uint64(33))


def span_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, equal for equal bytes wherever they stand.

    A polynomial over the bytes is summed once for the slice; a span's share is a
    difference of two prefix sums, divided by the power of its place.
    """
    n = len(data)
    terms = _table("powers", _MULTIPLIER, n)[:n] * mixed(data.astype(np.uint64) + np.uint64(1))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(terms, out=sums[1:])
    share = (sums[end] - sums[begin]) * _table("inverse", _INVERSE, n + 1)[begin]
    return mixed(share + (end - begin).astype(np.uint64))
