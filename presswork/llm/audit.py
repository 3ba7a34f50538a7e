"""How five text filters interact, in every order, with exact duplicates found by radix tries.

The filters: A too few words, B too few distinct words, C too many capitals, D a symbol of a list, E
a text that a row with a smaller key has as well, anywhere in the table. A to D look at one text. For
E the texts are dealt out by ranges of adaptive prefixes: a prefix whose texts weigh too much for
one task is lengthened until they do not, or until they are one text. Each task inserts its full
texts into a compressed trie whose terminals hold the smallest key, and a traversal tells which
texts have a smaller key elsewhere. What is left of a row is a mask of five bits; the rows of a part
are counted by mask, and all orders are worked out from these at most 32 counts.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from presswork.llm.frames import prepare, read
from presswork.session import materialize

MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 50, 65, 5
SYMBOLS = "#$%&*|"
FILTERS = "ABCDE"
#: Distinct texts that a task holds at a time to spare the shuffle equal ones, and their rows.
WINDOW_BYTES, WINDOW_ROWS = 16 << 20, 100_000
#: Weight of a trie: the bytes of its texts, and the size of a node for each.
TRIE_BYTES, NODE_BYTES = 64 << 20, 512
FIRST_PREFIX = 8
_CAPITALS = bytes(range(65, 91))


def failed(text: str) -> int:
    """The filters A to D that a text fails, as bits from A = 1."""
    body = text.encode("utf-8", "surrogatepass")
    words = body.split()  # of bytes: white space is 0x20 and 0x09 to 0x0D
    capitals = len(body) - len(body.translate(None, _CAPITALS))
    return (
        (len(words) < MIN_WORDS)
        | (100 * len(set(words)) < DISTINCT_PERCENT * len(words)) << 1
        | (100 * capitals > CAPITAL_PERCENT * len(text)) << 2
        | any(s in text for s in SYMBOLS) << 3
    )


_ROWS = pa.schema(
    [
        ("key", pa.int64()),
        ("part", pa.string()),
        ("mask", pa.int32()),
        ("group", pa.int64()),
        ("again", pa.bool_()),
        ("least", pa.int64()),
        ("text", pa.string()),
    ]
)


class _Window:
    """Rows waiting to leave a task, with each distinct text of theirs once."""

    def __init__(self, first_group: int):
        self.next = first_group
        self.clear()

    def clear(self) -> None:
        self.groups: dict[str, int] = {}
        self.masks: list[int] = []
        self.least: list[int | None] = []
        self.rows: list[tuple[int | None, str, int]] = []
        self.held = 0

    def add(self, key: int | None, part: str, text: str) -> None:
        group = self.groups.get(text)
        if group is None:
            group = self.groups[text] = len(self.masks)
            self.masks.append(failed(text))
            self.least.append(None)
            self.held += 4 * len(text)
        least = self.least[group]
        if key is not None and (least is None or key < least):
            self.least[group] = key
        self.rows.append((key, part, group))

    @property
    def full(self) -> bool:
        return self.held > WINDOW_BYTES or len(self.rows) >= WINDOW_ROWS

    def batch(self) -> pa.RecordBatch:
        """The rows; the first row of a text whose keys are not all null carries it."""
        texts: list[str | None] = list(self.groups)
        columns: list[list] = [[] for _ in _ROWS]
        for key, part, group in self.rows:
            least, text = self.least[group], texts[group]
            texts[group] = None
            again = key is not None and key > least
            row = (key, part, self.masks[group], self.next + group, again, least, None if least is None else text)
            for column, value in zip(columns, row, strict=True):
                column.append(value)
        self.next += len(self.masks)
        self.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, _ROWS, strict=True)], schema=_ROWS
        )


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    window = _Window(TaskContext.get().partitionId() << 40)
    for batch in batches:
        for key, part, text in zip(*batch.columns, strict=True):
            window.add(key.as_py(), part.as_py() or "", text.as_py() or "")
            if window.full:
                yield window.batch()
    if window.rows:
        yield window.batch()


# --- Tries ------------------------------------------------------------------------------------
class _Node:
    __slots__ = ("edges", "least", "groups")

    def __init__(self) -> None:
        self.edges: dict[str, tuple[str, _Node]] = {}
        self.least: int | None = None
        self.groups: list[tuple[int, int]] = []


def _common(label: str, text: str, at: int) -> int:
    """Length of the longest beginning of ``label`` that ``text`` has at ``at``."""
    low, high = 0, len(label)
    while low < high:
        middle = (low + high + 1) // 2
        if text.startswith(label[low:middle], at + low):
            low = middle
        else:
            high = middle - 1
    return low


class RadixTrie:
    """Full texts in a compressed trie; a text's terminal holds the smallest key put there."""

    def __init__(self) -> None:
        self.root = _Node()

    def insert(self, text: str, key: int, group: int) -> None:
        node, at = self.root, 0
        while at < len(text):
            label, child = node.edges.get(text[at], ("", None))
            if child is None:
                child = _Node()
                node.edges[text[at]] = (text[at:], child)
                node = child
                break
            shared = _common(label, text, at)
            if shared < len(label):
                middle = _Node()
                middle.edges[label[shared]] = (label[shared:], child)
                node.edges[text[at]] = (label[:shared], middle)
                child = middle
            node, at = child, at + shared
        node.least = key if node.least is None else min(node.least, key)
        node.groups.append((key, group))

    def beaten(self) -> Iterator[int]:
        """The groups whose text has a smaller key than their own."""
        waiting = [self.root]
        while waiting:
            node = waiting.pop()
            yield from (group for key, group in node.groups if key > node.least)
            waiting.extend(child for _, child in node.edges.values())


def _by_trie(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    trie = RadixTrie()
    for batch in batches:
        for text, least, group in zip(*batch.columns, strict=True):
            trie.insert(text.as_py(), least.as_py(), group.as_py())
    found = list(trie.beaten())
    for low in range(0, len(found), 10_000):
        yield pa.RecordBatch.from_arrays([pa.array(found[low : low + 10_000], pa.int64())], names=["group"])


def _by_prefix(texts: DataFrame) -> DataFrame:
    """``texts`` (text, least, group), dealt out by ranges of prefixes as long as their weight asks.

    Only the prefixes above a share of a task's weight come to the driver, a few per task at most.
    """
    spark = texts.sparkSession
    weight = F.octet_length("text") + F.lit(NODE_BYTES)
    total = texts.agg(F.sum(weight)).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // TRIE_BYTES))
    size, prefix, open_ = FIRST_PREFIX, F.left("text", F.lit(FIRST_PREFIX)), F.lit(True)
    while True:
        own = F.left("text", F.lit(size))
        heavy = [
            row["prefix"]
            for row in texts.filter(open_ & (F.char_length("text") > size))
            .groupBy(own.alias("prefix")).agg(F.sum(weight).alias("weight"))
            .filter(F.col("weight") > total / tasks / 4).collect()
        ]
        if not heavy:
            break
        open_ = own.isin(heavy)
        size *= 2
        prefix = F.when(open_, F.left("text", F.lit(size))).otherwise(prefix)
    return texts.select("text", "least", "group").repartitionByRange(tasks, prefix)


# --- Counts -----------------------------------------------------------------------------------
def masked(df: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """Per row of ``df``: key, part, mask (bits of the filters A to E that it fails).

    A null text counts as empty, a null part as the empty string. A null key is neither smaller nor
    greater than any, so its row does not fail E, nor makes others fail; rows that repeat a key and
    a text do not make each other fail. Other columns play no part.
    """
    source = df.select(
        F.col(f"`{key}`").cast("long").alias("key"),
        F.col(f"`{part}`").cast("string").alias("part"),
        F.col(f"`{text}`").alias("text"),
    )
    schema = "key long, part string, mask int, group long, again boolean, least long, text string"
    rows = materialize(source.mapInArrow(_scan, schema), "audit-rows")
    dealt = _by_prefix(rows.select("text", "least", "group").filter("text is not null"))
    beaten = materialize(dealt.mapInArrow(_by_trie, "group long"), "beaten-texts")
    # All keys of a beaten group are greater than the one that beats it.
    flagged = rows.select("key", "part", "mask", "group", "again").join(
        beaten.withColumn("beaten", F.lit(True)), "group", "left"
    )
    again = F.col("again") | (F.col("beaten").isNotNull() & F.col("key").isNotNull())
    return flagged.select("key", "part", (F.col("mask") + F.when(again, 16).otherwise(0)).alias("mask"))


def _steps() -> str:
    """Every order and step as JSON: the step's filter, its bit, and the bits applied before."""
    bits = {letter: 1 << k for k, letter in enumerate(FILTERS)}
    rows = []
    for order in permutations(FILTERS):
        prior = 0
        for step, letter in enumerate(order, 1):
            rows.append({"o": "".join(order), "s": step, "b": bits[letter], "p": prior})
            prior |= bits[letter]
    return json.dumps(rows)


def interactions(
    df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source"
) -> DataFrame:
    """One row per part, order and step: what the step keeps, removes and finds already removed.

    See :func:`masked` for nulls and repeated rows. A label counts as 1 if any row of ``labels``
    with the key says so; null keys and labels count as none. An empty table has no rows.
    """
    marks = (
        labels.select(
            F.col(f"`{key}`").cast("long").alias("key"),
            (F.col("quality") == 1).cast("int").alias("good"),
            (F.col("toxic") == 1).cast("int").alias("toxic"),
        )
        .groupBy("key")
        .agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
        .filter("key is not null and (good = 1 or toxic = 1)")
    )
    counts = (
        masked(df, key, text, part)
        .join(marks, "key", "left")
        .groupBy("part", "mask")
        .agg(
            F.count("*").alias("n"),
            F.sum(F.coalesce("good", F.lit(0))).alias("good"),
            F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic"),
        )
    )
    steps = F.from_json(F.lit(_steps()), "array<struct<o:string,s:int,b:int,p:int>>")
    cases = counts.withColumn("case", F.explode(steps)).select("*", "case.*")
    fails = F.col("mask").bitwiseAND(F.col("b")) != 0
    earlier = F.col("mask").bitwiseAND(F.col("p")) != 0

    def total(condition, value: str = "n"):
        return F.sum(F.when(condition, F.col(value)).otherwise(0))

    table = cases.groupBy("part", F.col("o").alias("filter_order"), F.col("s").alias("step"), "b").agg(
        total(~fails & ~earlier).alias("kept"),
        total(fails & ~earlier).alias("removed"),
        total(fails & earlier).alias("redundant"),
        total(F.col("mask") == F.col("b")).alias("unique_fails"),
        total(fails & ~earlier, "good").alias("good_lost"),
        total(fails & ~earlier, "toxic").alias("toxic_lost"),
    )
    shapley = F.sum("removed").over(Window.partitionBy("part", "b"))
    return table.withColumn("shapley", shapley).drop("b")


def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    """The interaction of the five filters in each source of ``documents``."""
    prepare(spark)
    documents = read(spark, folder, "documents")
    return interactions(documents, read(spark, folder, "labels"))


ORACLE = r"""
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents
), least AS (SELECT text, min(doc_id) AS first_id FROM docs GROUP BY text),
measured AS (
  SELECT doc_id, part, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM docs
), masks AS (
  SELECT doc_id, part,
    CASE WHEN len(words) < 50 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END
    + CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 5 * length(text) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN doc_id > first_id THEN 16 ELSE 0 END AS mask
  FROM measured JOIN least USING (text)
), marks AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), counts AS (
  SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM masks LEFT JOIN marks USING (doc_id) GROUP BY part, mask
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.x NOT IN (b.x, c.x, d.x, e.x) AND b.x NOT IN (c.x, d.x, e.x) AND c.x NOT IN (d.x, e.x) AND d.x <> e.x
), steps AS (
  SELECT filter_order, s AS step, 1 << (ascii(filter_order[s]) - 65) AS bit,
    list_sum(list_transform(range(1, s), lambda i: 1 << (ascii(filter_order[i]) - 65))) AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS s) t
), cases AS (
  SELECT part, filter_order, step, bit, n, good, toxic, mask,
    (mask & bit)::INT <> 0 AS fails, (mask & coalesce(before, 0)::INT)::INT <> 0 AS earlier
  FROM counts, steps
), summed AS (
  SELECT part, filter_order, step, bit,
    sum(CASE WHEN NOT fails AND NOT earlier THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN fails AND NOT earlier THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN fails AND earlier THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN fails AND NOT earlier THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN fails AND NOT earlier THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM cases GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  sum(removed) OVER (PARTITION BY part, bit)::BIGINT AS shapley
FROM summed
"""
