"""Records of delimited files whose quoted fields may hold line ends, read in parallel.

A line is a record unless a quoted field goes on at its end, and whether one does depends on all
lines before it. So the file's blocks are looked at independently first: for each, what it does to
the state "within a quoted field", for either state it may start in. Composing these functions in
file order, a prefix scan over a few numbers per block, gives the state at the start of every block.
Then all blocks are cut at the same time: those without a record of several lines by built-in
functions, the others line by line, and the few records that cross blocks are joined by their block.

A quote opens a quoted field only at the field's start. Within, two quotes stand for one; after the
closing quote the field goes on as it is. Outside of quotes a line may end with a carriage return.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presswork.session import materialize
from presswork.sources.order import ORDER, with_file_order

QUOTE = '"'


def _closing(text: str, at: int) -> int:
    """Position of the quote that closes a quoted field open at ``at``, or -1."""
    while (found := text.find(QUOTE, at)) >= 0:
        if text[found + 1 : found + 2] != QUOTE:
            return found
        at = found + 2
    return -1


def ends_open(line: str, is_open: bool, sep: str) -> bool:
    """Whether a quoted field goes on at the end of a line, given whether one did at its start."""
    at = 0
    while True:
        if is_open or line.startswith(QUOTE, at):
            at = _closing(line, at if is_open else at + 1) + 1
            if not at:
                return True
            is_open = False
        at = line.find(sep, at) + 1
        if not at:
            return False


def fields_of(record: str, sep: str) -> list[str]:
    """The fields of a whole record."""
    fields, at = [], 0
    if record.endswith("\r"):
        record = record[:-1]
    while True:
        value = ""
        if record.startswith(QUOTE, at):
            end = _closing(record, at + 1)
            end = len(record) if end < 0 else end
            value = record[at + 1 : end].replace(QUOTE * 2, QUOTE)
            at = end + 1
        following = record.find(sep, at)
        if following < 0:
            return [*fields, value + record[at:]]
        fields.append(value + record[at:following])
        at = following + len(sep)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _fields(records: pd.Series, sep: pd.Series) -> pd.Series:
    return pd.Series([None if r is None else fields_of(r, s) for r, s in zip(records, sep, strict=True)])


# --- Blocks -----------------------------------------------------------------------------------
_PLACE = ["folder", "name", "block"]
_SUMMARY = "folder string, name string, block long, from_closed boolean, from_open boolean, started boolean, opened boolean"


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """(block, its rows) of rows that begin with folder, name and block, in file order."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    for block, lines in groupby(rows(), lambda row: row[:3]):
        yield block, (row[3:] for row in lines)


def _summaries(sep: str):
    """What each block does to the state, from either state at its start: the state at its end,
    whether a record that is open at the end began in it, and whether any line ends open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, lines in _by_block(batches):
            states, began, opened = [False, True], False, False
            for (line,) in lines:
                after = [ends_open(line, state, sep) for state in states]
                began |= after[1] and not states[1]
                opened |= after[0]
                states = after
            values = [*block, *states, began, opened]
            names = [*_PLACE, "from_closed", "from_open", "started", "opened"]
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in values], names=names)

    return run


def _block_states(lines: DataFrame, sep: str) -> DataFrame:
    """Per block: folder, name, block, first_row (that is not blank), is_open (the state at its
    start), origin (the block where the record open there began), by_line (whether it holds lines
    of a record of several)."""
    quoted = lines.where(F.contains("value", F.lit(QUOTE))).select(*_PLACE, "value")
    found = materialize(quoted.mapInArrow(_summaries(sep), _SUMMARY), "quoted-blocks")
    blocks = lines.groupBy(*_PLACE).agg(F.min(F.when(_filled(), F.col("_seq.row"))).alias("first_row"))
    # A block without a quote keeps the state.
    whole = blocks.join(found, _PLACE, "left").fillna({"from_closed": False, "from_open": True, "started": False, "opened": False})
    file = Window.partitionBy("folder", "name").orderBy("block")
    so_far = file.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = file.rowsBetween(Window.unboundedPreceding, -1)
    # A block keeps the state, sets it to either value, or swaps it.
    swaps = F.sum((F.col("from_closed") & ~F.col("from_open")).cast("int")).over(so_far) % 2 == 1
    fixed = F.when(F.col("from_closed") == F.col("from_open"), F.col("from_closed") != F.col("swapped"))
    last_fixed = F.coalesce(F.last(fixed, ignorenulls=True).over(so_far), F.lit(False))
    began = F.when(F.col("after") & (~F.col("is_open") | F.col("started")), F.col("block"))
    states = (
        whole.withColumn("swapped", swaps)
        .withColumn("after", last_fixed != F.col("swapped"))
        .withColumn("is_open", F.coalesce(F.lag("after").over(file), F.lit(False)))
        .withColumn("origin", F.last(began, ignorenulls=True).over(earlier))
    )
    by_line = F.col("is_open") | F.col("opened") | F.col("after")
    return materialize(states.select(*_PLACE, "first_row", "is_open", "after", "origin", by_line.alias("by_line")), "block-states")


# --- Records ----------------------------------------------------------------------------------
def _filled() -> Column:
    return F.col("value").rlike("[^ \r]")


def _cut(sep: str):
    """Records (origin is null) and, of those that cross blocks, pieces with the block where the
    record began. Only a record's first piece has the place of its first line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*_PLACE, "value", "_seq", "origin"]
        types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.struct(_ORDER_FIELDS), pa.int64()]
        out: list[tuple] = []

        def batch() -> pa.RecordBatch:
            columns = zip(*out, strict=True) if out else [[]] * len(names)
            made = pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=names
            )
            out.clear()
            return made

        for block, lines in _by_block(batches):
            held, first, origin, is_open = [], None, None, None
            for line, seq, open_at_start, began in lines:
                if is_open is None:
                    is_open, origin = open_at_start, began if open_at_start else None
                if not is_open:
                    held, first, origin = [], seq, None
                held.append(line)
                is_open = ends_open(line, is_open, sep)
                if not is_open:
                    out.append((*block, "\n".join(held), first, origin))
                    held, first = [], None
                if len(out) >= 1000:
                    yield batch()
            if held:
                out.append((*block, "\n".join(held), first, block[2] if origin is None else origin))
        yield batch()

    return run


_ORDER_FIELDS = [
    pa.field(f.name, {"integer": pa.int32(), "long": pa.int64(), "string": pa.string()}[f.dataType.typeName()])
    for f in ORDER.fields
]


def read_records(spark: SparkSession, path: str | list[str], sep: str = "\t") -> DataFrame:
    """(fields, _seq) of the records of files with a header each, which is left out.

    Blank lines outside of quotes are no records. A quoted field that a file never closes is an
    error, as it would take in the rest of the file.
    """
    lines = with_file_order(spark.read.option("lineSep", "\n").text(path)).select(
        *[F.col("_seq")[c].alias(c) for c in _PLACE], "value", "_seq"
    )
    states = _block_states(lines, sep)
    last = states.groupBy("folder", "name").agg(F.max_by("after", "block").alias("after")).where("after")
    unclosed = last.limit(5).collect()
    if unclosed:
        raise ValueError(f"a quoted field has no end: {[f'{r[0]}/{r[1]}' for r in unclosed]}")
    headers = states.groupBy("folder", "name").agg(F.min_by("first_row", "block").alias("row"))
    by_line = states.where("by_line").select(*_PLACE, "is_open", "origin")
    found = lines
    if not by_line.isEmpty():
        order = [*_PLACE, "_seq.row"]
        dealt = lines.join(by_line, _PLACE).repartition(*_PLACE).sortWithinPartitions(*order)
        schema = f"folder string, name string, block long, value string, _seq {ORDER.simpleString()}, origin long"
        cut = materialize(
            dealt.select(*_PLACE, "value", "_seq", "is_open", "origin").mapInArrow(_cut(sep), schema), "records-by-line"
        )
        pieces = cut.where("origin IS NOT NULL").groupBy("folder", "name", "origin").agg(
            F.array_sort(F.collect_list(F.struct("block", "value", "_seq"))).alias("pieces")
        )
        joined = pieces.select(
            "folder", "name", F.col("origin").alias("block"),
            F.array_join("pieces.value", "\n").alias("value"), F.col("pieces")[0]["_seq"].alias("_seq"),
        )
        rest = lines.join(by_line, _PLACE, "left_anti")
        found = rest.unionByName(cut.where("origin IS NULL").drop("origin")).unionByName(joined)
    first = F.struct("folder", "name", F.col("_seq.row").alias("row"))
    heads = headers.select(F.struct("folder", "name", "row").alias("head"))
    records = found.where(_filled()).join(heads, first == F.col("head"), "left_anti")
    quoted = F.contains("value", F.lit(QUOTE))
    plain = F.split(F.regexp_replace("value", r"\r\z", ""), rf"\Q{sep}\E", -1)
    fields = F.when(quoted, _fields(F.when(quoted, F.col("value")), F.lit(sep))).otherwise(plain)
    return records.select(fields.alias("fields"), "_seq")
