"""Near duplicates by a chosen-path set similarity join on minhash signatures.

Texts are sets of word shingles; equal sets are one document. A document's signature holds, for each
of some random orders of all shingles, the least shingle of its set. A tree starts with all documents
in its root. At every node some coordinates of the signature are chosen at random, ``1 / similarity``
of them on average, and a document goes on to one child per chosen coordinate: the one that its least
token names. Two documents at the wanted similarity thus keep meeting in one child per level on
average, less similar ones part within a few levels. The members of a small node are compared
exhaustively, larger nodes branch on, and independent trees are repeated until the recall is reached.

Links are wanted for the classes that they form. A node's members are compared by their signatures
first; the full sets of those that may be similar to one of another class then meet in the node's
task, which confirms pairs until their classes have become one. So a dense
group is not expanded into its pairs: a node gives at most one link per member. The first trees join
the dense groups, and all trees then find what is left between different classes.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from functools import cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.llm.components import connected_components
from presswork.llm.frames import prepare, read, sized, slices
from presswork.llm.words import Words, shingles
from presswork.session import materialize

#: Words of a shingle, and the least similarity in hundredths.
WIDTH, PERCENT = 4, 80
#: Coordinates of a signature, trees, and the levels after which the rest is cut into blocks. On the
#: first level no pair is missed. A pair at the least similarity meets on the second level of a tree
#: with a chance of 0.47, on the third with 0.37: 16 trees miss it in 4 or 60 of 100,000 cases.
COORDINATES, TREES, DEPTH = 64, 16, 8
#: Agreeing coordinates that a pair needs to be looked at in full. One at the least similarity has
#: 51 on average; it has fewer than 33 in one of ten million cases.
LEAST_AGREEING = 33
#: The trees of each round; dense groups become one class in the first.
ROUNDS = (2, TREES)
#: A node is small up to this many documents and shingles: its comparisons are done in one task.
NODE_DOCUMENTS, NODE_SHINGLES = 2_000, 4_000_000
#: Comparisons of a member up to which each is done on its own.
FEW = 8


@cache
def _orders() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(11)
    return tuple(rng.integers(1, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in "ab")


def chosen_at_root() -> list[tuple[int, int]]:
    """(tree, coordinate) of all trees. A tree gets one at least, and no two get the same."""
    rng = random.Random(11)
    chance = 100 / (PERCENT * COORDINATES)
    left, chosen = list(range(COORDINATES)), []
    for tree in range(TREES):
        own = [c for c in left if rng.random() < chance] or [rng.choice(left)]
        left = [c for c in left if c not in own]
        chosen += [(tree, c) for c in own]
    return chosen


def signatures(df: DataFrame, key: str, text: str) -> DataFrame:
    """Per row: key, n (size of its set), digest and signature (null if the set is empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks, factors = _orders()
        for rows, body, bounds in slices(batches, "text"):
            values, limits = shingles(Words(body, bounds), WIDTH)
            sizes = np.diff(limits)
            some = np.flatnonzero(sizes)
            least = np.zeros((len(some), COORDINATES), "<u4")
            for c in range(COORDINATES if len(some) else 0):
                hashed = (values ^ masks[c]) * factors[c]
                least[:, c] = np.minimum.reduceat(hashed, limits[:-1][some]) >> np.uint64(32)
            digests: list[bytes | None] = [None] * len(sizes)
            signed: list[bytes | None] = [None] * len(sizes)
            for k, r in enumerate(some.tolist()):
                digests[r] = blake2b(values[limits[r] : limits[r + 1]].tobytes(), digest_size=16).digest()
                signed[r] = least[k].tobytes()
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(sizes), pa.array(digests, pa.binary()), pa.array(signed, pa.binary())],
                names=["key", "n", "digest", "signature"],
            )

    source = df.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").alias("text"))
    return source.mapInArrow(run, "key long, n long, digest binary, signature binary")


def _full_sets(df: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """(cid, tokens) of the wanted documents; only the texts of one row of each are read again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, body, bounds in slices(batches, "text"):
            values, limits = shingles(Words(body, bounds), WIDTH)
            own = [values[a:b].tobytes() for a, b in zip(limits[:-1], limits[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([blake2b(s, digest_size=16).digest() for s in own], pa.binary()), pa.array(own, pa.binary())],
                names=["digest", "tokens"],
            )

    keys = wanted.select(F.col("min_key").alias("key"))
    source = df.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").alias("text"))
    chosen = source.join(sized(keys), "key", "left_semi").select("text")
    read_again = chosen.mapInArrow(run, "digest binary, tokens binary")
    named = read_again.join(wanted.select("cid", "digest"), "digest").select("cid", "tokens")
    return named.dropDuplicates(["cid"])  # a row may stand in the input twice


def _by_node(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[tuple[int, int]]]]:
    """Rows sorted by their first column, with the stretches of equal ones, each whole."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = batch.column(0)[-1].as_py()
        if held and held[-1].column(0)[-1].as_py() == last:
            held.append(batch)
            continue
        yield from _stretches([*held, batch.slice(0, (cut := _last_start(batch)))])
        held = [batch.slice(cut)]
    yield from _stretches(held)


def _last_start(batch: pa.RecordBatch) -> int:
    nodes = batch.column(0).to_numpy(zero_copy_only=False)
    return int(np.flatnonzero(nodes == nodes[-1])[0])


def _stretches(parts: list[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[tuple[int, int]]]]:
    for rows in pa.Table.from_batches(parts).combine_chunks().to_batches() if parts else []:
        nodes = rows.column(0).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(np.diff(nodes)) + 1).tolist(), len(nodes)]
        yield rows, list(zip(edges[:-1], edges[1:], strict=True))


class _Node:
    """The rows (node, cid, component, signature, coordinate, compared, ...) of some nodes."""

    def __init__(self, rows: pa.RecordBatch):
        self.keys, self.classes = (rows.column(k).to_numpy(zero_copy_only=False) for k in (1, 2))
        self.signed = np.frombuffer(b"".join(rows.column(3).to_pylist()), "<u4").reshape(-1, COORDINATES)
        self.coordinate = rows.column(4).to_numpy(zero_copy_only=False)
        bits = rows.column(5).to_numpy(zero_copy_only=False)
        self.compared = (bits[:, None] >> np.arange(COORDINATES)) & 1 != 0

    def alike(self, low: int, high: int) -> Iterator[tuple[int, np.ndarray]]:
        """Of each row from ``low``, the later rows up to ``high`` of other classes that may be
        similar. A pair that meets in several small nodes of first levels counts in that of the
        least coordinate only, and in no node below."""
        for k in range(low, high - 1):
            same = self.signed[k + 1 : high] == self.signed[k]
            near = (same.sum(1) >= LEAST_AGREEING) & (self.classes[k + 1 : high] != self.classes[k])
            if near.any():
                at = np.flatnonzero(near)
                met = same[at] & self.compared[k]
                first = np.where(met.any(1), met.argmax(1), COORDINATES)
                yield k, at[first == self.coordinate[k]] + k + 1


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The members that may be similar to one of another class in their node, by their signatures."""
    for rows, nodes in _by_node(batches):
        node, found = _Node(rows), np.zeros(rows.num_rows, bool)
        for low, high in nodes:
            for k, others in node.alike(low, high):
                found[others] = True
                found[k] |= len(others) > 0
        yield rows.take(pa.array(np.flatnonzero(found)))


class _Sets:
    """The full sets of a node's members, and their overlaps."""

    def __init__(self, column: pa.Array, low: int, high: int):
        self.sets = [np.frombuffer(column[k].as_buffer(), np.uint64) for k in range(low, high)]
        self.sizes = np.array([len(s) for s in self.sets])
        self.owners: np.ndarray | None = None

    def _overlaps(self, k: int) -> np.ndarray:
        """Shingles that member ``k`` shares with each, by the lists of members of its shingles."""
        if self.owners is None:
            _, self.numbers = np.unique(np.concatenate(self.sets), return_inverse=True)
            member = np.repeat(np.arange(len(self.sets)), self.sizes)
            self.owners = member[np.argsort(self.numbers, kind="stable")]
            self.ends = np.cumsum(np.bincount(self.numbers))
            self.firsts = np.cumsum(self.sizes) - self.sizes
        own = self.numbers[self.firsts[k] : self.firsts[k] + self.sizes[k]]
        lists = [self.owners[self.ends[t - 1] if t else 0 : self.ends[t]] for t in own.tolist()]
        return np.bincount(np.concatenate(lists), minlength=len(self.sets))

    def similar(self, k: int, others: np.ndarray) -> np.ndarray:
        """Which of the members ``others`` are similar to member ``k``, exactly."""
        if len(others) > FEW:
            met = self._overlaps(k)[others]
        else:
            met = np.array([len(np.intersect1d(self.sets[k], self.sets[o], assume_unique=True)) for o in others])
        return 100 * met >= PERCENT * (self.sizes[k] + self.sizes[others] - met)


def _links_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links that join the classes of each node: every pair that may be similar is compared on the
    full sets, unless its two classes have become one meanwhile."""
    for rows, nodes in _by_node(batches):
        node, links = _Node(rows), []
        for low, high in nodes:
            sets, classes = _Sets(rows.column(6), low, high), node.classes[low:high].copy()
            for k, others in node.alike(low, high):
                own, others = k - low, others - low
                others = others[classes[others] != classes[own]]
                for other in others[sets.similar(own, others)].tolist() if len(others) else ():
                    if classes[own] != classes[other]:
                        classes[classes == classes[other]] = classes[own]
                        links.append((int(node.keys[k]), int(node.keys[low + other])))
        yield pa.RecordBatch.from_arrays(
            [pa.array([link[k] for link in links], pa.int64()) for k in (0, 1)], names=["a", "b"]
        )


def _child(node: list[Column], coordinate: Column) -> Column:
    return F.xxhash64(*node, coordinate, F.substring("signature", coordinate * 4 + 1, F.lit(4)))


def _sized(members: DataFrame) -> DataFrame:
    """Members (node, cid, n) of nodes of two at least, with the node's size and shingles."""
    sizes = members.groupBy("node").agg(F.count("*").alias("size"), F.sum("n").alias("weight"))
    return members.join(sizes.filter("size > 1"), "node")


def _leaves(documents: DataFrame) -> DataFrame:
    """(tree, coordinate, node, cid) of the small nodes of all trees. The coordinate is that of a
    node on the first level, and :data:`COORDINATES` below."""
    chosen = F.array(*[F.struct(F.lit(t).alias("tree"), F.lit(c).alias("c")) for t, c in chosen_at_root()])
    members = documents.select("cid", "n", "signature", F.explode(chosen).alias("at")).select(
        "at.tree", F.col("at.c").alias("coordinate"), "cid", "n", _child([F.col("at.tree")], F.col("at.c")).alias("node")
    )
    small = (F.col("size") <= NODE_DOCUMENTS) & (F.col("weight") <= NODE_SHINGLES)
    chance = int(1_000_000 * 100 / (PERCENT * COORDINATES))
    coordinates = F.filter(
        F.sequence(F.lit(0), F.lit(COORDINATES - 1)),
        lambda c: F.pmod(F.xxhash64("node", c, F.lit("chosen")), F.lit(1_000_000)) < chance,
    )
    leaves, below = None, F.lit(COORDINATES).alias("coordinate")
    for _ in range(DEPTH):
        current = materialize(_sized(members), "tree-nodes")
        found = current.filter(small).select("tree", "coordinate", "node", "cid")
        leaves = found if leaves is None else leaves.union(found)
        large = current.filter(~small)
        if large.isEmpty():
            return leaves
        branches = large.select("tree", "node", "cid", "n", F.explode(coordinates).alias("c"))
        members = branches.join(documents.select("cid", "signature"), "cid").select(
            "tree", below, "cid", "n", _child([F.col("node")], F.col("c")).alias("node")
        )
    # What is still large is cut into blocks, and every two of its blocks make a node.
    blocks = F.greatest(F.ceil(F.col("size") * 2 / NODE_DOCUMENTS), F.ceil(F.col("weight") * 2 / NODE_SHINGLES))
    cut = _sized(members).withColumn("blocks", F.when(small, F.lit(1)).otherwise(blocks).cast("int"))
    own = F.pmod(F.xxhash64("cid"), F.col("blocks"))
    paired = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    node = F.xxhash64("node", F.least(own, "other"), F.greatest(own, "other"))
    return leaves.union(paired.select("tree", below, node.alias("node"), "cid"))


def _open(members: DataFrame, components: DataFrame) -> DataFrame:
    """Members, with their class, of the nodes that hold more than one class."""
    current = members.join(components, "cid")
    mixed = current.groupBy("node").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return current.join(mixed.filter("low < high").select("node"), "node")


def _in_nodes(members: DataFrame) -> DataFrame:
    """Members dealt out by node; nodes are small, so a task holds whole ones."""
    return members.repartition("node").sortWithinPartitions("node")


def _merged(components: DataFrame, links: DataFrame) -> DataFrame:
    """The classes after the links (a, b) between documents of theirs."""
    own, other = components.toDF("a", "ca"), components.toDF("b", "cb")
    between = links.join(own, "a").join(other, "b").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    joined = connected_components(between).toDF("component", "new")
    merged = components.join(joined, "component", "left")
    return materialize(merged.select("cid", F.coalesce("new", "component").alias("component")), "joined-classes")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: key, n_shingles, component_id, kept.

    ``component_id`` is the smallest key reachable by links, the row's own included; ``kept`` tells
    whether it is the row's own. A null or empty text, or one of white space only, has an empty set
    and no links. A row with a null key counts its shingles but takes no part in links: its class is
    null and it is kept. Rows that repeat a key and a text are in one class; rows with one key and
    different texts are different documents that bear the same key. Other columns play no part.
    """
    sets = materialize(signatures(df, key, text), "signatures")
    documents = materialize(
        sets.filter("digest is not null and key is not null")
        .groupBy("digest")
        .agg(F.min("key").alias("min_key"), F.min("n").alias("n"), F.min("signature").alias("signature"))
        .withColumn("cid", F.monotonically_increasing_id()),
        "signed-documents",
    )
    leaves = materialize(_leaves(documents.select("cid", "n", "signature")), "tree-leaves")
    signed = documents.select("cid", "signature")
    components = leaves.select("cid").distinct().select("cid", F.col("cid").alias("component"))
    components = materialize(components, "joined-classes")
    columns = "node cid component signature coordinate compared".split()
    for trees in ROUNDS:
        own = leaves.filter(F.col("tree") < trees).select("coordinate", "node", "cid")
        first = F.when(F.col("coordinate") < COORDINATES, F.expr("shiftleft(1L, coordinate)")).otherwise(F.lit(0))
        compared = own.groupBy("cid").agg(F.bit_or(first.cast("long")).alias("compared"))
        members = _open(own, components).join(compared.join(signed, "cid"), "cid").select(*columns)
        alike = materialize(_in_nodes(members).mapInArrow(_alike, members.schema), "alike-members")
        wanted = documents.select("cid", "digest", "min_key").join(alike.select("cid").distinct(), "cid", "left_semi")
        wanted = materialize(wanted, "wanted-documents")
        dealt = _in_nodes(alike.join(_full_sets(df, wanted, key, text), "cid").select(*columns, "tokens"))
        links = materialize(dealt.mapInArrow(_links_of, "a long, b long"), "links")
        if not links.isEmpty():
            components = _merged(components, links)
    keyed = components.join(documents.select("cid", "min_key"), "cid")
    smallest = keyed.groupBy("component").agg(F.min("min_key").alias("component_id"))
    least = keyed.join(smallest, "component").select("cid", "component_id")
    named = documents.select("cid", "digest", "min_key").join(least, "cid", "left")
    named = named.select("digest", F.coalesce("component_id", "min_key").alias("component_id"))
    own = F.when(F.col("key").isNotNull(), F.coalesce("component_id", "key"))
    return sets.join(named, "digest", "left").select(
        F.col("key").alias(key),
        F.col("n").alias("n_shingles"),
        own.alias("component_id"),
        F.coalesce(F.col("key") == own, F.lit(True)).alias("kept"),
    )


def op11_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Classes of similar documents: doc_id, n_shingles, component_id, kept."""
    prepare(spark)
    return near_duplicates(read(spark, folder, "documents"))


def similarity_sql(width: int, kept: bool) -> str:
    """The same classes by an exact join on shingles, and a recursive walk over the links."""
    last = ", doc_id = component_id AS kept" if kept else ""
    return rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(
    range(1, greatest(len(w) - {width - 1}, 1) + 1), lambda i: array_to_string(w[i:i + {width - 1}], ' '))) END AS s
  FROM words
), tokens AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS met, any_value(a.n) AS na, any_value(b.n) AS nb
  FROM tokens a JOIN tokens b ON a.t = b.t AND a.doc_id < b.doc_id
    AND 100 * a.n >= {PERCENT} * b.n AND 100 * b.n >= {PERCENT} * a.n
  GROUP BY ALL
), links AS (SELECT a, b FROM common WHERE 100 * met >= {PERCENT} * (na + nb - met)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(doc_id, node) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT reach.doc_id, edges.b FROM reach JOIN edges ON reach.node = edges.a
), least AS (SELECT doc_id, min(node) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id{last}
FROM sets JOIN least USING (doc_id)
"""


ORACLE = similarity_sql(WIDTH, kept=True)
