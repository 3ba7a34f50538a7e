"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.session import materialize, tune

#: Bytes of text that a worker turns into arrays at a time. A longer text is handled alone.
SLICE_BYTES = 1 << 20
#: Rows of a written table below which one of its two-column projections is sent to every task.
BROADCAST_ROWS = 1_000_000
#: What :func:`remembered` made: the worker's tools of all operators.
_REMEMBERED: list[Callable] = []


def prepare(spark: SparkSession) -> SparkSession:
    """The library's settings, and batches of few rows, since one text may have megabytes."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def sized(df: DataFrame) -> DataFrame:
    """``df`` (a written table of one or two numeric columns) with a broadcast hint if it is small.

    The rows are counted first; beyond :data:`BROADCAST_ROWS` the planner's own choice stands,
    which is a sort-merge join with skew splitting.
    """
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def labelled_sample(
    documents: DataFrame, labels: DataFrame, label: str, key: str, text: str, sample: int
) -> DataFrame:
    """(text, label) of at most ``sample`` labelled documents, written once.

    The labels are chosen first, in a pseudo-random order of their keys, and that bounded list is
    sent to the documents, which stay where they are. Null labels and keys are left out; of
    documents or labels that repeat a key, the least text and label count.
    """
    chosen = materialize(
        labels.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").cast("double").alias("label"))
        .filter("key is not null and label is not null")
        .groupBy("key").agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("key", F.lit(7)), "key").limit(sample),
        "chosen-labels",
    )
    rows = documents.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    found = rows.join(F.broadcast(chosen), "key").groupBy("key", "label").agg(F.min("text").alias("text"))
    return materialize(found.select("text", "label"), "labelled-sample")


def remembered(make: Callable) -> Callable:
    """``make`` with its last results kept for the next tasks, until :func:`give_back`."""
    kept = lru_cache(maxsize=2)(make)
    _REMEMBERED.append(kept)
    return kept


def give_back(*keep: Callable) -> None:
    """Drop the worker's tools, but for those of ``keep``, and return freed memory to the system.

    The allocators hold on to what was freed, up to the most that any task took so far.
    """
    for tool in _REMEMBERED:
        if tool not in keep:
            tool.cache_clear()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # the GNU library has it
        trim(0)


def lean(run: Callable, *keep: Callable) -> Callable:
    """``run``, a function for ``mapInArrow``, in a worker that stays for tasks of other operators.

    Before and after a task the worker keeps none of their tools, nor memory that is not in use.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back(*keep)
        try:
            yield from run(batches)
        finally:
            give_back(*keep)

    return task


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column, and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(
    batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Batches cut so that the texts of a slice stay below ``limit`` bytes, with those texts.

    Whole rows only: a text longer than the limit makes a slice of its own.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        body, bounds = texts(batch.column(batch.schema.get_field_index(column)))
        low = 0
        while low < batch.num_rows:
            high = int(np.searchsorted(bounds, bounds[low] + limit, side="right")) - 1
            high = min(max(high, low + 1), batch.num_rows)
            yield (
                batch.slice(low, high - low),
                body[bounds[low] : bounds[high]],
                bounds[low : high + 1] - bounds[low],
            )
            low = high
