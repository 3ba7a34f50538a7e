"""Nearest neighbours by cosine with a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample of unit vectors; every vector is then put in its leaf. A query
keeps a priority queue of tree nodes by their distance and opens the nearest one each time, so that
leaves come in a promising order. How many leaves it visits is calibrated: for a bounded number of
queries the true neighbours are found by brute force over all vectors, and visits are widened until
the leaves visited hold the target share of them. Leaves and the queries that visit them are dealt
out in blocks of bounded size, and each block gives its best few per query.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from presswork.llm.frames import prepare, read
from presswork.session import materialize

#: Vectors to fit the tree on, a fixed pseudo-random choice. It bounds the driver and the tree.
SAMPLE = 20_000
#: The least rows wanted in a leaf, which otherwise has about the square root of all rows, and the
#: least sampled rows that a leaf is made of.
LEAF_ROWS, LEAST_SAMPLED = 64, 8
BRANCHES = 8
#: Queries to calibrate with, and the share of true neighbours that visited leaves must hold.
TRIALS, TARGET = 200, 0.95
#: Vectors, and queries, of one block of a leaf.
BLOCK = 2000


@dataclass
class Tree:
    """Nodes in breadth-first order: centres, first child and number of children (0: a leaf)."""

    centres: np.ndarray
    first: np.ndarray
    count: np.ndarray
    leaf: np.ndarray
    leaves: int

    def assign(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each unit vector: always on to the nearest child."""
        node = np.zeros(len(vectors), np.int64)
        while True:
            inner = np.flatnonzero(self.count[node])
            if not len(inner):
                return self.leaf[node]
            for parent in np.unique(node[inner]):
                own = inner[node[inner] == parent]
                low, n = self.first[parent], self.count[parent]
                near = vectors[own] @ self.centres[low : low + n].T
                # Centres are means, not unit vectors: compare distances, not products.
                near = near - (self.centres[low : low + n] ** 2).sum(axis=1) / 2
                node[own] = low + near.argmax(axis=1)

    def visits(self, vector: np.ndarray, most: int) -> list[int]:
        """The first ``most`` leaves, best bin first."""
        queue, found = [(0.0, 0)], []
        while queue and len(found) < most:
            _, node = heapq.heappop(queue)
            n = int(self.count[node])
            if not n:
                found.append(int(self.leaf[node]))
                continue
            low = int(self.first[node])
            apart = ((self.centres[low : low + n] - vector) ** 2).sum(axis=1)
            for k, distance in enumerate(apart.tolist()):
                heapq.heappush(queue, (distance, low + k))
        return found


def _means(points: np.ndarray, k: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Lloyd's k-means; groups that lose all points vanish."""
    centres = points[rng.choice(len(points), k, replace=False)]
    for _ in range(8):
        near = points @ centres.T - (centres**2).sum(axis=1) / 2
        group = near.argmax(axis=1)
        used, group = np.unique(group, return_inverse=True)
        centres = np.zeros((len(used), points.shape[1]))
        np.add.at(centres, group, points)
        centres /= np.bincount(group)[:, None]
    return centres, group


def fit_tree(points: np.ndarray, leaf_points: int, branches: int = BRANCHES) -> Tree:
    """A tree over unit vectors. Equal points cannot be parted and make one leaf."""
    rng = np.random.default_rng(5)
    centres, first, count, waiting = [points.mean(axis=0)], [0], [0], [(0, points)]
    while waiting:
        node, own = waiting.pop(0)
        if len(own) <= leaf_points or (own == own[0]).all():
            continue
        means, group = _means(own, min(branches, len(own)), rng)
        if len(means) < 2:
            continue
        first[node], count[node] = len(centres), len(means)
        for k, centre in enumerate(means):
            waiting.append((len(centres), own[group == k]))
            centres.append(centre)
            first.append(0)
            count.append(0)
    counts = np.array(count)
    leaf = np.where(counts == 0, np.cumsum(counts == 0) - 1, -1)
    return Tree(np.array(centres), np.array(first), counts, leaf, int((counts == 0).sum()))


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 0))
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors**2).sum(axis=1, keepdims=True))


def usable(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, v) of the rows that can take part, written once.

    Rows without an id, and vectors that are null, empty, zero, or hold null or non-finite
    components, take no part; nor do vectors of another length than most have.
    """
    v = F.transform(F.col(f"`{vector}`"), lambda x: x.cast("double"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.select(F.col(f"`{key}`").cast("long").alias("id"), v.alias("v")).filter(
        F.col("id").isNotNull() & F.col("v").isNotNull() & ~bad & F.exists("v", lambda x: x != 0)
    )
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return materialize(rows.filter(F.size("v") == (sizes["d"] if sizes else 0)), "vectors")


def _best(query_ids, queries, ids, vectors, k: int) -> tuple[list, list, list]:
    """(query, id, score) of the ``k`` best per query; ties go to the smaller id.

    A matrix product picks candidates with some room for its rounding. Their scores are then
    worked out row by row, so equal vectors have equal scores wherever they stand.
    """
    q_norm, v_norm = np.sqrt((queries**2).sum(axis=1)), np.sqrt((vectors**2).sum(axis=1))
    rough = (queries / q_norm[:, None]) @ (vectors / v_norm[:, None]).T
    rough[query_ids[:, None] == ids[None, :]] = -np.inf
    out: tuple[list, list, list] = ([], [], [])
    for row, query in enumerate(query_ids.tolist()):
        own = rough[row]
        bar = np.partition(own, len(own) - k)[len(own) - k] if len(own) > k else -np.inf
        near = np.flatnonzero((own >= bar - 1e-9) & (own > -np.inf))
        exact = (vectors[near] * queries[row]).sum(axis=1) / (v_norm[near] * q_norm[row])
        for at in np.lexsort((ids[near], -exact))[:k].tolist():
            out[0].append(query)
            out[1].append(int(ids[near[at]]))
            out[2].append(float(exact[at]))
    return out


def brute_force(vectors: DataFrame, query_ids: np.ndarray, queries: np.ndarray, k: int) -> DataFrame:
    """(query_id, id, score): for a bounded number of queries, the best of all vectors, by blocks."""
    held = vectors.sparkSession.sparkContext.broadcast((query_ids, queries))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted_ids, wanted = held.value
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            columns = _best(wanted_ids, wanted, ids, _matrix(batch.column(1)), k)
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                 pa.array(columns[2], pa.float64())],
                names=["query_id", "id", "score"],
            )

    return _top(vectors.mapInArrow(run, "query_id long, id long, score double"), k)


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = found.distinct().withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "id", "score")


@dataclass
class Index:
    """A fitted tree, the vectors with their leaves, and the calibrated number of visits."""

    tree: Tree
    rows: DataFrame
    visits: int
    recall: float


def build_index(vectors: DataFrame, trials: DataFrame, k: int) -> Index:
    """Fit the tree on a bounded sample, put every vector in its leaf, and calibrate the visits.

    ``trials`` are vectors like those that will be asked for; at most :data:`TRIALS` are used.
    """
    spark = vectors.sparkSession
    n = vectors.count()
    sampled = vectors.orderBy(F.xxhash64("id", F.lit(3)), "id").limit(SAMPLE).select("v").toArrow()
    points = _unit(_matrix(sampled.column("v")))
    leaf_rows = max(LEAF_ROWS, isqrt(n))
    tree = fit_tree(points, max(LEAST_SAMPLED, leaf_rows * len(points) // max(n, 1)))
    held = spark.sparkContext.broadcast(tree)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = held.value.assign(_unit(_matrix(batch.column(1))))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(leaf.astype(np.int32))], names=["id", "v", "leaf"]
                )

    rows = materialize(
        vectors.mapInArrow(assign, "id long, v array<double>, leaf int"), "leaf-vectors"
    )
    chosen = trials.orderBy(F.xxhash64("id", F.lit(4)), "id").limit(TRIALS).toArrow()
    ids = np.asarray(chosen.column("id"), dtype=np.int64)
    asked = _matrix(chosen.column("v"))
    true = brute_force(vectors, ids, asked, k).join(rows.select("id", "leaf"), "id")
    needed: list[int] = []
    order = {
        i: {leaf: at for at, leaf in enumerate(tree.visits(v, tree.leaves), 1)}
        for i, v in zip(ids.tolist(), _unit(asked) if len(asked) else asked, strict=True)
    }
    for row in true.select("query_id", "leaf").collect():  # at most TRIALS * k rows
        needed.append(order[row["query_id"]][row["leaf"]])
    needed.sort()
    visits = needed[min(len(needed) - 1, int(np.ceil(TARGET * len(needed))))] if needed else tree.leaves
    share = float(np.mean(np.array(needed) <= visits)) if needed else 1.0
    return Index(tree, rows, visits, share)


def _search(index: Index, queries: DataFrame, k: int, visits: int) -> DataFrame:
    """(query_id, id, score): the best of each block that a query visits."""
    tree = queries.sparkSession.sparkContext.broadcast(index.tree)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column(1))
            unit = _unit(vectors) if len(vectors) else vectors
            for row, vector in enumerate(unit):
                found = tree.value.visits(vector, visits)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column(0)[row].as_py()] * len(found), pa.int64()),
                     pa.array(found, pa.int32())],
                    names=["query_id", "leaf"],
                )

    asked = materialize(queries.mapInArrow(ask, "query_id long, leaf int"), "leaf-queries")
    blocks = lambda df, name: df.groupBy("leaf").agg(
        F.ceil(F.count("*") / BLOCK).cast("int").alias(name)
    )
    both = materialize(blocks(index.rows, "vn").join(blocks(asked, "qn"), "leaf"), "leaf-blocks")
    both = F.broadcast(both)  # one row for each leaf of the tree, whose size the sample bounds
    spread = lambda own, n, other, m: [
        F.pmod(F.xxhash64(own), F.col(n)).cast("int").alias(n[0] + "b"),
        F.explode(F.sequence(F.lit(0), F.col(m) - 1)).alias(m[0] + "b"),
    ]
    left = index.rows.join(both, "leaf").select("leaf", "id", "v", *spread("id", "vn", "qb", "qn"))
    right = (
        asked.join(both, "leaf")
        .select("leaf", "query_id", *spread("query_id", "qn", "vb", "vn"))
        .join(queries.select(F.col("id").alias("query_id"), F.col("v").alias("qv")), "query_id")
    )

    def meet(rows: pd.DataFrame, visitors: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(visitors):
            return pd.DataFrame({"query_id": [], "id": [], "score": []})
        found = _best(
            visitors["query_id"].to_numpy(), np.stack(visitors["qv"]),
            rows["id"].to_numpy(), np.stack(rows["v"]), k,
        )
        return pd.DataFrame(dict(zip(("query_id", "id", "score"), found, strict=True)))

    keys = ["leaf", "vb", "qb"]
    return (
        left.groupBy(*keys)
        .cogroup(right.groupBy(*keys))
        .applyInPandas(meet, "query_id long, id long, score double")
    )


def search(index: Index, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, id, score) of the ``k`` nearest found for each query (id, v).

    A query's own id is no candidate. Queries whose visited leaves hold fewer than ``k`` others
    are asked again over all leaves, so all have ``k`` results if there are as many candidates.
    """
    found = materialize(_top(_search(index, queries, k, index.visits), k), "neighbours")
    full = found.groupBy("query_id").count().filter(F.col("count") >= k).select("query_id")
    short = materialize(
        queries.join(full, queries["id"] == full["query_id"], "left_anti"), "short-queries"
    )
    if index.visits >= index.tree.leaves or short.isEmpty():
        return found
    again = _top(_search(index, short, k, index.tree.leaves), k)
    rest = found.join(short, found["query_id"] == short["id"], "left_anti")
    return rest.unionByName(again)


def op8_nearest(spark: SparkSession, folder: str) -> DataFrame:
    """The 5 nearest found of every vector whose id is divisible by 50: query_id, rank, vec_id,
    score."""
    prepare(spark)
    vectors = usable(read(spark, folder, "embeddings"))
    queries = vectors.filter("id % 50 = 0").distinct()
    if vectors.isEmpty():
        nothing = "query_id long, rank int, vec_id long, score double"
        return spark.createDataFrame([], nothing)
    found = search(build_index(vectors, queries, 5), queries, 5)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")
