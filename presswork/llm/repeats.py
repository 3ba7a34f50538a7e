"""Removal of passages that occur more than once in a corpus.

A unit is a line, and a line of many words is cut further where its own words say so: before a word
whose hash is the smallest among its neighbours. A passage copied into the middle of another line
is thus cut at the same places in both, but for a few words at its ends. Units are normalised (A-Z
in lower case, white space and punctuation dropped), hashed, and grouped over the whole corpus. In
the row that comes first the unit stays; in all others it is a repeat, as is a second occurrence
within one text. Repeats next to each other form a run, and a run of at least ``min_words`` words is
removed. Of a shorter run, those lines are removed that are repeats of a whole line: the minimum is
only for fragments of longer lines. The offsets in the original text are kept with a run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from presswork.llm.frames import lean, prepare, read, slices
from presswork.llm.words import Words, mix
from presswork.session import materialize

#: Words of the shortest run that is removed although it is no whole line. Twelve words in a row do
#: not coincide by chance.
MIN_WORDS = 12
#: A line is cut before a word that is the least of this many on either side.
RADIUS = 4
#: Bits of the table that tells which units may repeat (8 MB, whatever the corpus).
FILTER_BITS = 26
#: Bytes of text that are cut into units at a time.
TEXT_BYTES = 1 << 18
#: Documents with repeats up to which their spans are sent to the texts.
SENT_ROWS = 300_000
_NO_ID = 2**63 - 1

_UNITS = pa.schema(
    [
        ("rank", pa.int64()),
        ("text_key", pa.int64()),
        ("unit", pa.int32()),
        ("start", pa.int32()),
        ("end", pa.int32()),
        ("words", pa.int32()),
        ("h1", pa.int64()),
        ("h2", pa.int64()),
        ("own", pa.bool_()),
        ("line", pa.int32()),
    ]
)


def _cuts(words: Words, line: np.ndarray) -> np.ndarray:
    """Whether a unit starts at each word."""
    n = len(words)
    starts = np.ones(n, bool)
    starts[1:] = line[1:] != line[:-1]
    least = np.ones(n, bool)
    for step in range(1, min(RADIUS, n - 1) + 1):
        same = line[step:] == line[:-step]
        least[step:] &= ~same | (words.hash[step:] < words.hash[:-step])
        least[:-step] &= ~same | (words.hash[:-step] <= words.hash[step:])
    return starts | least


def _characters(body: np.ndarray, bounds: np.ndarray, row: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Byte positions within a slice as character positions within their rows."""
    leads = np.zeros(len(body) + 1, np.int64)
    np.cumsum((body & 0xC0) != 0x80, out=leads[1:])
    return leads[at] - leads[bounds[row]]


def _units_of(
    batches: Iterator[pa.RecordBatch], min_words: int, wanted: np.ndarray | None = None
) -> Iterator[pa.RecordBatch]:
    """The units of a task's texts; with ``wanted`` only those whose hash has its bit there."""
    for rows, body, bounds in slices(batches, "text", TEXT_BYTES):
        words = Words(body, bounds, letters_only=True)
        if not len(words):
            continue
        newlines = np.cumsum(body == 10)
        line = newlines[words.start] + words.row
        first = np.flatnonzero(_cuts(words, line))
        last = np.append(first[1:], len(words)) - 1
        row = words.row[first]
        number = np.arange(len(first)) - np.searchsorted(row, row)
        # Two independent sums over a unit's words, each times a power of its place in the unit.
        h1, h2 = (_sequence(words.hash, first, salt) for salt in (1, 2))
        # Lines below the minimum once more as a whole, under hashes that no unit has.
        begin = np.flatnonzero(np.append(True, line[1:] != line[:-1]))
        final = np.append(begin[1:], len(words)) - 1
        brief = final - begin + 1 < min_words
        at = np.searchsorted(first, begin)
        held = np.diff(np.append(at, len(first)))[brief]
        for_lines = [_sequence(words.hash, begin, salt)[brief] for salt in (3, 4)]
        parts = np.concatenate([np.zeros(len(first), np.int64), held])
        number = np.concatenate([number, number[at[brief]]])
        row = np.concatenate([row, words.row[begin[brief]]])
        first = np.concatenate([first, begin[brief]])
        last = np.concatenate([last, final[brief]])
        h1, h2 = (np.concatenate(pair) for pair in zip((h1, h2), for_lines, strict=True))
        order = np.lexsort((number, h2, h1, row))
        own = np.zeros(len(first), bool)
        a, b = order[1:], order[:-1]
        own[a] = (row[a] == row[b]) & (h1[a] == h1[b]) & (h2[a] == h2[b])
        columns = [
            rows.column(0).to_numpy(zero_copy_only=False)[row],
            rows.column(1).to_numpy(zero_copy_only=False)[row],
            number.astype(np.int32),
            _characters(body, bounds, row, words.start[first]).astype(np.int32),
            _characters(body, bounds, row, words.end[last]).astype(np.int32),
            (last - first + 1).astype(np.int32),
            h1.view(np.int64),
            h2.view(np.int64),
            own,
            parts.astype(np.int32),
        ]
        kept = slice(None) if wanted is None else _held(wanted, h1)
        yield pa.RecordBatch.from_arrays([pa.array(v[kept]) for v in columns], schema=_UNITS)


def _held(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes >> np.uint64(64 - (len(bits) * 64).bit_length() + 1)
    return (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) != 0


def _sequence(hashes: np.ndarray, first: np.ndarray, salt: int) -> np.ndarray:
    base = mix(np.array([salt], np.uint64))[0] | np.uint64(1)
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    up = np.full(len(hashes), base, np.uint64)
    down = np.full(len(hashes), inverse, np.uint64)
    up[0] = down[0] = 1
    scrambled = mix(hashes + np.uint64(salt))
    sums = np.add.reduceat(scrambled * np.cumprod(up), first)
    return mix(sums * np.cumprod(down)[first])


def units(
    df: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, wanted=None
) -> DataFrame:
    """The units of every text: rank (its id; a null id comes last), text_key, unit, start, end
    (character offsets), words, two hashes, whether the text had the unit before, and line, which
    is 0. A line of fewer than ``min_words`` words has another row, where line counts its units and
    unit is the first of them. ``wanted`` is a broadcast filter (:func:`_filter`) of their hashes."""
    rank = F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(_NO_ID))
    source = df.select(
        rank.alias("rank"), F.xxhash64(f"`{text}`").alias("text_key"), F.col(f"`{text}`").alias("text")
    )
    schema = (
        "rank long, text_key long, unit int, start int, end int, words int,"
        " h1 long, h2 long, own boolean, line int"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _units_of(batches, min_words, None if wanted is None else wanted.value)

    return source.mapInArrow(lean(run), schema)


def _filter(repeated: DataFrame) -> np.ndarray:
    """A bit table of fixed size with the bits of the hashes that occur.

    It only spares units a way: the more hashes there are, the more others pass it, and the join
    that follows tells them apart.
    """
    place = F.shiftrightunsigned("h1", 64 - FILTER_BITS)
    rows = (
        repeated.select(F.shiftright(place, 6).alias("word"), F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(h1, {64 - FILTER_BITS}) & 63 AS INT))").alias("bit"))
        .groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    )
    table = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    table[np.asarray(rows.column("word"))] = np.asarray(rows.column("bits"))
    return table.view(np.uint64)


def repeated_spans(
    df: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """Runs to remove: rank, text_key, span_start, span_end, n_words, first_rank.

    A run has at least ``min_words`` words, or consists of lines that an earlier text, or the same
    text before, has as whole lines.
    ``first_rank`` is the smallest rank that holds the run's first unit. Rows with one id and one
    text are occurrences of the same rank: they are treated alike, and their runs are listed once.
    A null or empty text has no units. Hashes are grouped in the tasks that made them before they
    are shuffled, so a unit that a third of all texts holds leaves each task as one row; those that
    repeat are written. The texts are then cut again, and only units that pass a bit table of the
    repeated ones leave their task, so the many that occur once do not move. They meet the repeated
    ones in a join that Spark splits where it is skewed.
    """
    spark = df.sparkSession
    groups = materialize(
        units(df, key, text, min_words)
        .groupBy("h1", "h2")
        .agg(
            F.min("rank").alias("first_rank"),
            F.max("rank").alias("last_rank"),
            F.max("own").alias("any_own"),
        )
        .filter("first_rank < last_rank or any_own")
        .select("h1", "h2", "first_rank"),
        "repeated-units",
    )
    wanted = spark.sparkContext.broadcast(_filter(groups))
    found = units(df, key, text, min_words, wanted)
    repeats = found.join(groups, ["h1", "h2"]).filter("rank > first_rank or own")
    # The units of a repeated line are repeats as well, so the line itself only marks them.
    marked = repeats.select(
        "rank", "text_key", F.explode(F.expr("sequence(unit, unit + greatest(line, 1) - 1)")).alias("unit"),
        *[F.when(F.col("line") == 0, F.col(c)).alias(c) for c in ("start", "end", "words", "first_rank")],
        (F.col("line") > 0).alias("whole"),
    )
    in_text = Window.partitionBy("rank", "text_key").orderBy("unit")
    run = F.col("unit") - F.row_number().over(in_text)
    runs = (
        marked.groupBy("rank", "text_key", "unit")
        .agg(
            *[F.min(c).alias(c) for c in ("start", "end", "words", "first_rank")],
            F.max("whole").alias("whole"),
        )
        .withColumn("run", run)
        .withColumn("length", F.sum("words").over(Window.partitionBy("rank", "text_key", "run")))
        .filter(F.col("whole") | (F.col("length") >= min_words))
        .withColumn("run", run)
        .groupBy("rank", "text_key", "run")
        .agg(
            F.min("start").alias("span_start"),
            F.max("end").alias("span_end"),
            F.sum("words").alias("n_words"),
            F.min(F.struct("unit", "first_rank")).getField("first_rank").alias("first_rank"),
        )
    )
    return runs.drop("run")


@F.pandas_udf(StringType())
def _cut(text: pd.Series, spans: pd.Series) -> pd.Series:
    """Texts without their spans, which are in order and do not overlap."""

    def rest(whole: str, cuts: list[dict]) -> str:
        edges = [0, *[x for c in cuts for x in (c["span_start"], c["span_end"])], len(whole)]
        return "".join(whole[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))

    return pd.Series(
        [t if c is None else rest(t, list(c)) for t, c in zip(text, spans, strict=True)]
    )


def without_repeats(
    df: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """``df`` with the repeated runs cut out of its texts; what stood around a run stays.

    All rows and columns stay, also where a text becomes empty; a null text stays null. Spans are
    written first, and texts meet them by id and text hash. The spans of up to :data:`SENT_ROWS`
    documents, counted first, go to the texts; beyond, both are shuffled by id.
    """
    spans = materialize(repeated_spans(df, key, text, min_words), "repeated-spans")
    cut = materialize(
        spans.groupBy("rank", "text_key").agg(
            F.array_sort(F.collect_list(F.struct("span_start", "span_end"))).alias("spans")
        ),
        "document-spans",
    )
    cut = F.broadcast(cut) if cut.count() <= SENT_ROWS else cut
    rank = F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(_NO_ID))
    rows = df.select(  # the row as one column, whatever its own columns are called
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
        rank.alias("rank"),
        F.xxhash64(f"`{text}`").alias("text_key"),
    )
    own = F.col("row").getField(text)
    new = F.when(F.col("spans").isNull(), own).otherwise(_cut(own, F.col("spans")))
    columns = [(new if c == text else F.col("row").getField(c)).alias(c) for c in df.columns]
    return rows.join(cut, ["rank", "text_key"], "left").select(*columns)


def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Repeated runs of every document: doc_id, span_start, span_end, n_words, first_doc_id."""
    prepare(spark)
    spans = repeated_spans(read(spark, folder, "documents").select("doc_id", "text"))
    return spans.select(
        F.nullif("rank", F.lit(_NO_ID)).alias("doc_id"),
        "span_start",
        "span_end",
        "n_words",
        F.nullif("first_rank", F.lit(_NO_ID)).alias("first_doc_id"),
    )
