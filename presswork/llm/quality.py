"""Quality of texts by ordinal regression on graded ratings.

A text's features are hashed: runs of three characters as they stand (case and punctuation tell
much about form), words and pairs of neighbouring words, and a few marks of its build, such as the share of
words that repeat the word before. All share one weight vector. The ratings' grades are ordered,
and grade ``g`` or better has the probability ``logistic(score - threshold[g])`` with thresholds in
ascending order, so a text's score moves all of these tail probabilities together. The expected
grade is their sum.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.llm.frames import labelled_sample, lean, prepare, read, slices
from presswork.llm.words import Words, mix

#: Hash bins of the features.
BINS = 1 << 14
#: Rated texts for training, a fixed pseudo-random choice. The fit is done on the driver, so this
#: bounds its memory; scoring is done on every text.
SAMPLE = 6000
PASSES = 150
#: Bytes of text that are made into features at a time: these take about a hundred times as much.
FEATURE_BYTES = 1 << 18
#: Entries of the sample that the fit works on at a time, so that it holds little besides them.
FIT_ENTRIES = 1 << 18
#: Weight of the penalty on squared weights.
PENALTY = 2e-4
#: Probability of the acceptable grade from which a text is selected.
ACCEPT = 0.5


@dataclass
class Ordinal:
    """A fitted model: the grades in order, their thresholds but for the lowest, and the weights."""

    grades: list[float]
    thresholds: np.ndarray
    weights: np.ndarray

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= g) for each grade but the lowest, one row per text."""
        return 1 / (1 + np.exp(-np.clip(scores[:, None] - self.thresholds[None, :], -500, 500)))

    def expected(self, scores: np.ndarray) -> np.ndarray:
        return self.grades[0] + self.tails(scores) @ np.diff(self.grades)


def features(body: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bin, value) of the texts' features, one entry per row and bin, by row.

    Counts are taken to their square root, and each row is scaled to length one. An empty text has
    the marks of an empty build only.
    """
    n = len(bounds) - 1
    keys = []
    row = np.repeat(np.arange(n), np.diff(bounds))
    if len(body) >= 3:
        code = body.astype(np.uint64)
        runs = code[:-2] | code[1:-1] << np.uint64(8) | code[2:] << np.uint64(16)
        inside = row[:-2] == row[2:]
        keys.append((row[:-2][inside], _bin(runs[inside], 1)))
    words = Words(body, bounds)
    if len(words):
        keys.append((words.row, _bin(words.hash, 2)))
        pair = words.row[1:] == words.row[:-1]
        keys.append((words.row[1:][pair], _bin(words.hash[:-1] * np.uint64(3) + words.hash[1:], 3)[pair]))
    count = np.diff(words.first).astype(float)
    flat = np.concatenate([r * BINS + b for r, b in keys]) if keys else np.zeros(0, np.int64)
    entries, counts = np.unique(flat, return_counts=True)
    values = np.sqrt(counts)
    owner = entries // BINS
    norm = np.sqrt(np.bincount(owner, values**2, minlength=n))
    values = values / norm[owner]
    marks = _marks(body, bounds, words, count)
    mark_bins = _bin(np.arange(1, marks.shape[1] + 1, dtype=np.uint64), 4)
    rows = np.concatenate([owner, np.repeat(np.arange(n), marks.shape[1])])
    bins = np.concatenate([entries % BINS, np.tile(mark_bins, n)])
    values = np.concatenate([values, marks.ravel()])
    order = np.argsort(rows, kind="stable")
    return rows[order], bins[order], values[order]


def _bin(values: np.ndarray, salt: int) -> np.ndarray:
    return (mix(values + np.uint64(salt << 56)) % np.uint64(BINS)).astype(np.int64)


def _marks(body: np.ndarray, bounds: np.ndarray, words: Words, count: np.ndarray) -> np.ndarray:
    """Shares between 0 and 1 that describe how each text is built."""
    n = len(bounds) - 1
    row = np.repeat(np.arange(n), np.diff(bounds))
    size = np.maximum(np.diff(bounds), 1)

    def share(of: np.ndarray) -> np.ndarray:
        return np.bincount(row[of], minlength=n) / size

    def of_words(which: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.bincount(at[which], minlength=n) / np.maximum(count, 1)

    punctuation = (body > 32) & (body < 127) & ~_alnum()[body]
    same = (words.row[1:] == words.row[:-1]) & (words.hash[1:] == words.hash[:-1])
    order = np.lexsort((words.hash, words.row))
    owner, value = words.row[order], words.hash[order]
    first = np.ones(len(order), bool)
    first[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    distinct = np.bincount(owner[first], minlength=n)
    marks = np.stack(
        [
            np.ones(n),
            share((body >= 65) & (body <= 90)),
            share(punctuation),
            share((body >= 48) & (body <= 57)),
            of_words(same, words.row[1:]),
            distinct / np.maximum(count, 1),
            np.log1p(count) / 16,
            (count == 0).astype(float),
        ],
        axis=1,
    )
    return marks


def _alnum() -> np.ndarray:
    return np.array([chr(b).isalnum() and b < 128 for b in range(256)])


def _sums(rows: np.ndarray, bins: np.ndarray, values: np.ndarray, weights: np.ndarray, n: int):
    part = weights[bins]
    part *= values
    return np.bincount(rows, part, minlength=n)


def _added(index: np.ndarray, of: np.ndarray, table: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """``np.bincount(index, table[of] * values, n)``, in the same order of additions, part by part."""
    total = np.zeros(n)
    for low in range(0, len(index), FIT_ENTRIES):
        some = slice(low, low + FIT_ENTRIES)
        part = table[of[some]]
        part *= values[some]
        np.add.at(total, index[some].astype(np.intp), part)
    return total


def fit_ordinal(
    rows: np.ndarray, bins: np.ndarray, values: np.ndarray, ratings: np.ndarray,
    passes: int = PASSES, penalty: float = PENALTY,
) -> Ordinal:
    """Fit weights and thresholds by gradient steps (Adam) on the cumulative likelihood.

    Thresholds are a first one plus positive steps, so their order cannot be lost. Ratings of one
    grade only give a model that expects that grade of every text.
    """
    grades = np.unique(ratings)
    if len(grades) < 2:
        return Ordinal([float(g) for g in grades] or [0.0], np.zeros(0), np.zeros(BINS))
    n, steps = len(ratings), len(grades) - 1
    level = np.searchsorted(grades, ratings)
    above = (level[:, None] > np.arange(steps)[None, :]).astype(float)
    share = np.clip(above.mean(axis=0), 1e-3, 1 - 1e-3)
    start = np.log((1 - share) / share)
    free = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    state = np.concatenate([np.zeros(BINS), free])
    first, second = np.zeros_like(state), np.zeros_like(state)
    for turn in range(1, passes + 1):
        weights, free = state[:BINS], state[BINS:]
        gaps = np.exp(free[1:])
        thresholds = free[0] + np.concatenate([[0], np.cumsum(gaps)])
        model = Ordinal(grades.tolist(), thresholds, weights)
        tails = model.tails(_added(rows, bins, weights, values, n))
        # P(level) is the fall between neighbouring tails; its log's slope in each tail's argument.
        padded = np.concatenate([np.ones((n, 1)), tails, np.zeros((n, 1))], axis=1)
        chance = np.maximum(padded[np.arange(n), level] - padded[np.arange(n), level + 1], 1e-12)
        slope = padded * (1 - padded)
        up = slope[np.arange(n), level] / chance
        down = slope[np.arange(n), level + 1] / chance
        by_score = (up - down) / n
        by_threshold = np.zeros(steps)
        np.add.at(by_threshold, level[level > 0] - 1, -up[level > 0] / n)
        np.add.at(by_threshold, level[level < steps], down[level < steps] / n)
        by_weight = _added(bins, rows, by_score, values, BINS)
        tail_sums = np.cumsum(by_threshold[::-1])[::-1]
        by_free = np.concatenate([tail_sums[:1], tail_sums[1:] * gaps])
        gradient = np.concatenate([by_weight - penalty * weights, by_free])
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        state = state + 0.1 * (first / (1 - 0.9**turn)) / (
            np.sqrt(second / (1 - 0.999**turn)) + 1e-8
        )
    weights, free = state[:BINS], state[BINS:]
    thresholds = free[0] + np.concatenate([[0], np.cumsum(np.exp(free[1:]))])
    return Ordinal(grades.tolist(), thresholds, weights)


def train(
    documents: DataFrame, labels: DataFrame, rating: str, key: str = "doc_id", text: str = "text",
    sample: int = SAMPLE,
) -> Ordinal:
    """Fit on the texts of at most ``sample`` rated documents.

    Texts become features in tasks; only those come to the driver. Null ratings are left out.
    """
    chosen = labelled_sample(documents, labels, rating, key, text, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some, body, bounds in slices(batches, "text", FEATURE_BYTES):
            rows, bins, values = features(body, bounds)
            limits = np.searchsorted(rows, np.arange(some.num_rows + 1))
            yield pa.RecordBatch.from_arrays(
                [some.column(1)]
                + [
                    pa.array([a[x:y].tobytes() for x, y in zip(limits[:-1], limits[1:], strict=True)])
                    for a in (bins.astype(np.int16), values.astype(np.float32))
                ],
                names=["rating", "bins", "parts"],
            )

    held = chosen.mapInArrow(lean(run), "rating double, bins binary, parts binary")
    found = held.toArrow()
    if not found.num_rows:
        return fit_ordinal(np.zeros(0, int), np.zeros(0, int), np.zeros(0), np.zeros(0))
    ratings = np.array(found.column("rating"))
    (bins, counts), (parts, _) = _flat(found.column("bins"), np.int16), _flat(found.column("parts"), np.float32)
    del found  # the fit holds its own arrays, and not these a second time
    pa.default_memory_pool().release_unused()
    return fit_ordinal(np.repeat(np.arange(len(counts), dtype=np.int32), counts), bins, parts, ratings)


def _flat(column: pa.ChunkedArray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The numbers that a column of binary values holds, in one array, and how many each row has."""
    numbers, counts = [], []
    for chunk in column.cast(pa.binary()).chunks:
        _, offsets, data = chunk.buffers()
        bounds = np.frombuffer(offsets, np.int32)[chunk.offset : chunk.offset + len(chunk) + 1]
        body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        numbers.append(body[bounds[0] : bounds[-1]].view(kind))
        counts.append(np.diff(bounds) // np.dtype(kind).itemsize)
    return np.concatenate(numbers), np.concatenate(counts)


def grade(df: DataFrame, model: Ordinal, acceptable: float, text: str = "text") -> DataFrame:
    """``df`` with ``expected_grade``, ``tail_probability`` (of ``acceptable`` or better) and
    ``selected`` after its columns, which they replace if they had those names.

    Every row is graded, in place: a null text counts as empty.
    """
    held = df.sparkSession.sparkContext.broadcast(model)
    new = ["expected_grade", "tail_probability", "selected"]
    source = df.drop(*new)
    schema = source.select(
        "*", *[F.lit(0.0).alias(c) for c in new[:2]], F.lit(True).alias(new[2])
    ).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = held.value
        at = [k for k, g in enumerate(tool.grades[1:]) if g >= acceptable][:1]
        for some, body, bounds in slices(batches, text, FEATURE_BYTES):
            rows, bins, values = features(body, bounds)
            scores = _sums(rows, bins, values, tool.weights, some.num_rows)
            tail = tool.tails(scores)[:, at].sum(axis=1)
            if tool.grades[0] >= acceptable:
                tail = np.ones(some.num_rows)
            yield pa.RecordBatch.from_arrays(
                [
                    *some.columns, pa.array(tool.expected(scores)), pa.array(tail),
                    pa.array(tail >= ACCEPT),
                ],
                names=[*some.schema.names, *new],
            )

    return source.mapInArrow(lean(run), schema)


def accepted(df: DataFrame, model: Ordinal, acceptable: float, text: str = "text") -> DataFrame:
    """The rows of ``df`` that the model selects, with exactly their own columns, whatever the names."""
    names = [f"c{k}" for k in range(len(df.columns))]
    graded = grade(df.toDF(*names), model, acceptable, names[df.columns.index(text)])
    return graded.filter("selected").select(*names).toDF(*df.columns)


def op7_ordinal_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's doc_id, expected_grade, tail_probability and selected.

    Trained on a bounded sample of labelled documents whose id's crc32 is not divisible by 5.
    """
    prepare(spark)
    documents = read(spark, folder, "documents").select("doc_id", "text")
    labels = read(spark, folder, "labels").filter(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    return grade(documents, train(documents, labels, "quality"), 1.0).drop("text")
