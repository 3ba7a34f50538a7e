"""Whitening of vectors by their leading principal components, found by spectrum slicing.

Entries become integers, so counts and sums are exact and equal vectors are told apart exactly. The
covariance over the distinct vectors is added up where the rows are; only sums, one row of the
covariance per dimension, come to the driver, whose work depends on the dimension alone.

There the number of eigenvalues above a shift is read off the signs of a pivoted LDL factorisation
of the shifted covariance (Sylvester's law of inertia). Bisection with these counts encloses one
eigenvalue at a time from the top, inverse iteration enters the enclosure, Rayleigh quotient
iteration converges within it, and counts on both sides of the result certify its number.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.llm.frames import prepare, read
from presswork.session import materialize

SCALE, COMPONENTS = 256, 4
#: Eigenvalues below this share of the trace are round-off of a smaller rank, not components.
LEAST_SHARE = 1e-10
_EPS = float(np.finfo(float).eps)
_SAFE = 2.0**62


# --- Spectrum ---------------------------------------------------------------------------------
def above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix are greater than ``shift``.

    Bunch and Kaufman's pivoting gives blocks of one or two rows; a block of two has a negative
    determinant, hence one eigenvalue of either sign.
    """
    a = matrix - shift * np.eye(len(matrix))
    bound = (1 + np.sqrt(17)) / 8
    count, k, n = 0, 0, len(a)
    while k < n:
        column = np.abs(a[k + 1 :, k])
        r = k + 1 + int(column.argmax()) if k + 1 < n else k
        off = column.max() if k + 1 < n else 0.0
        size, swap = 1, k
        if off > 0 and abs(a[k, k]) < bound * off:
            others = np.abs(a[r, k:])
            others[r - k] = 0
            wide = others.max()
            if abs(a[k, k]) * wide >= bound * off * off:
                pass
            elif abs(a[r, r]) >= bound * wide:
                swap = r
            else:
                size, swap = 2, r
        at = k + size - 1
        if swap != at:
            a[[at, swap], :] = a[[swap, at], :]
            a[:, [at, swap]] = a[:, [swap, at]]
        if size == 1:
            pivot = a[k, k]
            count += pivot > 0
            if pivot != 0:
                a[k + 1 :, k + 1 :] -= np.outer(a[k + 1 :, k] / pivot, a[k, k + 1 :])
        else:
            count += 1
            block, rest = a[k : k + 2, k : k + 2], a[k + 2 :, k : k + 2]
            a[k + 2 :, k + 2 :] -= rest @ np.linalg.solve(block, rest.T)
        k += size
    return count


def _solve(matrix: np.ndarray, shift: float, vector: np.ndarray) -> np.ndarray:
    nudge = _EPS * max(abs(shift), np.abs(matrix).max())
    for k in range(4):
        try:
            found = np.linalg.solve(matrix - (shift + k * nudge) * np.eye(len(matrix)), vector)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(found).all() and np.abs(found).max() > 0:
            return found / np.linalg.norm(found)
    return vector


def _refined(matrix: np.ndarray, low: float, high: float, found: list[np.ndarray], seed: int):
    """Eigenvalue and vector within an enclosure, orthogonal to the vectors before."""

    def cleared(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            for u in found:
                v = v - (u @ v) * u
        return v / np.linalg.norm(v)

    vector = cleared(np.random.default_rng(seed).standard_normal(len(matrix)))
    middle = (low + high) / 2
    for _ in range(4):
        vector = cleared(_solve(matrix, middle, vector))
    value, best = float(vector @ matrix @ vector), np.inf
    for _ in range(12):
        if not low <= value <= high:
            break
        following = cleared(_solve(matrix, value, vector))
        new = float(following @ matrix @ following)
        residual = float(np.linalg.norm(matrix @ following - new * following))
        if residual >= best:
            break
        value, vector, best = new, following, residual
    return value, vector


def leading(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and their unit vectors as columns.

    Equal eigenvalues get some orthonormal basis. Fewer are returned where the trace says that the
    rest is round-off; a matrix of zeros has none.
    """
    n, trace = len(matrix), float(np.trace(matrix)) if len(matrix) else 0.0
    if not n or trace <= 0:
        return np.zeros(0), np.zeros((n, 0))
    top = float(np.abs(matrix).sum(1).max()) * (1 + 1e-9)
    close = 32 * n * _EPS * top
    values: list[float] = []
    vectors: list[np.ndarray] = []
    for k in range(1, min(wanted, n) + 1):
        low, high = -top, top
        floor = LEAST_SHARE * trace
        if above(matrix, floor) < k:
            break
        low = floor
        while True:
            # low has k or more eigenvalues above it, high has fewer; stop at one, then refine.
            alone = above(matrix, low) - above(matrix, high) == 1
            if alone or high - low <= close:
                value, vector = _refined(matrix, low, high, vectors, k)
                certain = above(matrix, value - close) >= k > above(matrix, value + close)
                if certain or high - low <= close:
                    break
            middle = (low + high) / 2
            low, high = (middle, high) if above(matrix, middle) >= k else (low, middle)
        values.append(value)
        vectors.append(vector)
    order = np.argsort(-np.array(values), kind="stable")
    basis = np.array(vectors).reshape(len(values), n)[order].T
    return np.array(values)[order], basis


# --- Rows -------------------------------------------------------------------------------------
def _integers(column: pa.Array, dimension: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the usable rows, and their entries as integers."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False).astype(float), nan=-1)
    usable = lengths > 0 if dimension is None else lengths == dimension
    usable &= lengths > 0
    at = np.flatnonzero(usable)
    if not len(at):
        return at, np.zeros((0, dimension or 0), np.int64)
    flat = column.take(pa.array(at)).flatten().cast(pa.float64())
    values = flat.to_numpy(zero_copy_only=False).reshape(len(at), -1) * SCALE
    good = (np.isfinite(values) & (np.abs(values) < _SAFE)).all(1)
    return at[good], np.floor(values[good]).astype(np.int64)


def _shifted(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: of Python's integers where 64 bits might not do."""
    most = max([abs(s) for s in sums], default=0)
    if len(x) and n * max(int(x.max()), -int(x.min())) + most >= 2**62:
        return x.astype(object) * n - np.array(sums, object)
    return x * np.int64(n) - np.array(sums, np.int64)


def _deviation(shifted: np.ndarray) -> list[int | None]:
    if shifted.dtype != object and shifted.size:
        if shifted.shape[1] * float(np.abs(shifted).max()) ** 2 < _SAFE:
            return (shifted * shifted).sum(1).tolist()
        shifted = shifted.astype(object)
    exact = [sum(v * v for v in row) for row in shifted.tolist()]
    return [v if v < 2**63 else None for v in exact]


def distinct_vectors(df: DataFrame, vector: str, dimension: int) -> DataFrame:
    """(x): each usable vector once, as integers. Equal ones are dropped before the shuffle too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, x = _integers(batch.column(0), dimension)
            flat = pa.array(x.reshape(-1))
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * dimension)
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, flat)], names=["x"])

    source = df.select(F.col(f"`{vector}`").alias("vector"))
    return source.mapInArrow(run, "x array<long>").groupBy("x").agg(F.lit(1).alias("one")).select("x")


def _matrix(batch: pa.RecordBatch, dimension: int) -> np.ndarray:
    return batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def _totals(fit: DataFrame, dimension: int) -> tuple[int, list[int]]:
    """Number of vectors, and exact sums per dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, sums = 0, [0] * dimension
        for batch in batches:
            x = _matrix(batch, dimension)
            if len(x) and float(np.abs(x).max()) * len(x) >= _SAFE:
                x = x.astype(object)
            rows += len(x)
            sums = [a + int(b) for a, b in zip(sums, x.sum(0), strict=True)]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(dimension), pa.int32()), pa.array([rows] * dimension, pa.int64()),
                 pa.array([Decimal(s) for s in sums], pa.decimal128(38, 0))],
                names=["dimension", "rows", "total"],
            )

    parts = fit.mapInArrow(run, "dimension int, rows long, total decimal(38,0)")
    total = parts.groupBy("dimension").agg(F.sum("rows").alias("rows"), F.sum("total").alias("total"))
    found = {r["dimension"]: r for r in total.collect()}  # one row per dimension
    if not found:
        return 0, [0] * dimension
    return found[0]["rows"], [int(found[i]["total"]) for i in range(dimension)]


def _products(fit: DataFrame, dimension: int, n: int, sums: list[int], basis: np.ndarray) -> np.ndarray:
    """Sum over the vectors of w w', where w is the centred vector times ``basis``, over n.

    A task adds up its own matrix and passes on its rows; these are dealt by their number, so a
    task of the second step holds some rows of one matrix.
    """
    width = basis.shape[1]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            w = (_shifted(_matrix(batch, dimension), n, sums).astype(float) / n) @ basis
            total += w.T @ w
        yield _rows(dict(enumerate(total)))

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, values in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held[number] = held.get(number, 0) + values.values.to_numpy()
        yield _rows(held)

    schema = "number int, values array<double>"
    dealt = fit.mapInArrow(add, schema).repartition("number")
    product = np.zeros((width, width))
    for row in dealt.mapInArrow(combine, schema).collect():  # as many rows as dimensions
        product[row["number"]] = row["values"]
    return product / max(n, 1)


def _rows(held: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(held), pa.int32()), pa.array([v.tolist() for v in held.values()], pa.list_(pa.float64()))],
        names=["number", "values"],
    )


@dataclass(frozen=True)
class Whitening:
    """A fitted transformation: n vectors, their sums, eigenvalues and unit vectors (columns)."""

    dimension: int
    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    @property
    def basis(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def dimension_of(df: DataFrame, vector: str) -> int:
    """The length that most vectors have, the greater one of equals; 0 without vectors."""
    sizes = df.select(F.size(F.col(f"`{vector}`")).alias("size")).filter("size > 0")
    most = sizes.groupBy("size").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    return most["size"] if most else 0


def fit_whitening(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """Fit on each distinct vector once; see :func:`whiten` for what takes part."""
    dimension = dimension_of(df, vector)
    if not dimension:
        return Whitening(0, 0, [], np.zeros(0), np.zeros((0, 0)), 0.0, 0.0)
    fit = materialize(distinct_vectors(df, vector, dimension), "distinct-vectors")
    n, sums = _totals(fit, dimension)
    covariance = _products(fit, dimension, n, sums, np.eye(dimension))
    covariance = (covariance + covariance.T) / 2
    values, vectors = leading(covariance, components)
    error = 0.0
    if len(values):
        product = _products(fit, dimension, n, sums, vectors / np.sqrt(values))
        error = float(np.abs(product - np.eye(len(values))).max())
    return Whitening(dimension, n, sums, values, vectors, float(np.trace(covariance)), error)


def whiten(
    df: DataFrame, model: Whitening, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """One row per usable row of ``df`` and component: key, component (from 1), n, deviation,
    whitened, explained, identity_error.

    A vector that is null or empty, or holds null or non-finite entries, or entries too large for
    a long, has no rows; nor has one of another length than most. Rows that repeat a key or a
    vector are all returned, a null key as null, and other columns play no part. Where the vectors
    span fewer dimensions than components are wanted there are fewer, none if all are equal. A
    deviation beyond a long is null.
    """
    count = len(model.values)
    explained = (model.values / model.trace).tolist() if count else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = _integers(batch.column(1), model.dimension)
            shifted = _shifted(x, model.n, model.sums)
            white = (shifted.astype(float) / max(model.n, 1)) @ model.basis
            keys = batch.column(0).take(pa.array(at))
            times = np.repeat(np.arange(len(at)), count)
            number = np.tile(np.arange(count), len(at))
            deviation = pa.array(_deviation(shifted), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [keys.take(pa.array(times)), pa.array((number + 1).astype(np.int32)),
                 pa.array(np.full(len(times), model.n)), deviation.take(pa.array(times)),
                 pa.array(white.reshape(-1)), pa.array(np.array(explained)[number]),
                 pa.array(np.full(len(times), model.identity_error))],
                names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    schema = (
        f"`{key}` long, component int, n long, deviation long, whitened double, explained double,"
        " identity_error double"
    )
    source = df.select(F.col(f"`{key}`").cast("long").alias(key), F.col(f"`{vector}`").alias("vector"))
    return (source if count else source.limit(0)).mapInArrow(run, schema)


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """The leading components of every usable vector of ``embeddings``, whitened."""
    prepare(spark)
    embeddings = read(spark, folder, "embeddings")
    return whiten(embeddings, fit_whitening(embeddings))
