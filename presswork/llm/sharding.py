"""Placement of rows on shards by a permutation-filled lookup table.

Each shard has a preference order over the slots of a prime-sized table: it starts at its offset
and steps by its skip. The shards take turns, each claiming the first free slot of its order, until
the table is full. A row's key is hashed to a slot, and the slot's owner is its shard. Every shard
owns as many slots as any other, give or take one, and when a shard leaves few other slots change
their owner.
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.llm.frames import prepare, read

#: Shards of the registered query, and slots: a prime over a hundred times as large.
SHARDS = 64
SLOTS = 8191


def _number(text: str) -> int:
    """The same 60 bits of md5 that :func:`slot_of` takes."""
    return int(md5(text.encode()).hexdigest()[:15], 16)


def fill_table(shards: Sequence[str], slots: int) -> list[int]:
    """The owner's position in ``shards`` for each slot.

    The table has a fixed size that no data changes, so it is filled while the plan is built.
    """
    if slots < 2 or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"{slots} slots: the table's size must be prime")
    if not 0 < len(shards) <= slots or len(set(shards)) < len(shards):
        raise ValueError("shards must have different names, and be no more than the slots")
    at = [_number(f"offset {name}") % slots for name in shards]
    skip = [_number(f"skip {name}") % (slots - 1) + 1 for name in shards]
    owner, left = [-1] * slots, slots
    while left:
        for shard in range(min(len(shards), left)):
            while owner[at[shard]] >= 0:
                at[shard] = (at[shard] + skip[shard]) % slots
            owner[at[shard]] = shard
            left -= 1
    return owner


def slot_of(keys: Sequence[str], slots: int) -> Column:
    """The slot of a row: 60 bits of the md5 of its key columns as text, modulo the table's size.

    A null column counts as the text ``null`` with a mark that no value has in its place.
    """
    parts = [F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("-")) for k in keys]
    digest = F.substring(F.md5(F.concat_ws("\u0001", *parts)), 1, 15)
    return F.conv(digest, 16, 10).cast("long") % F.lit(slots)


def lookup_table(spark: SparkSession, shards: Sequence[str], slots: int) -> DataFrame:
    """The filled table as rows (slot, shard)."""
    owners = ",".join(map(str, fill_table(shards, slots)))
    return spark.range(1).select(
        F.posexplode(F.split(F.lit(owners), ",")).alias("slot", "shard")
    ).select(F.col("slot").cast("long"), F.col("shard").cast("int"))


def assign_shards(
    df: DataFrame, keys: Sequence[str], shards: Sequence[str], slots: int = SLOTS
) -> DataFrame:
    """``df`` with ``slot`` and ``shard`` (position in ``shards``) after its own columns.

    Rows with equal keys, repeated rows among them, go to one shard; null keys are keys like any
    other. Columns of ``df`` that have the new names are replaced. The table is broadcast: it has
    ``slots`` rows whatever the input, and every row finds its shard with one probe. There is no
    shuffle, so a source or key that holds a third of all rows costs nothing extra.
    """
    kept = [c for c in df.columns if c not in ("slot", "shard")]
    table = F.broadcast(lookup_table(df.sparkSession, shards, slots))
    placed = df.select(*[F.col(f"`{c}`") for c in kept], slot_of(keys, slots).alias("slot"))
    return placed.join(table, "slot").select(*[f"`{c}`" for c in kept], "slot", "shard")


def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Shard of every document by its id: doc_id, slot, shard."""
    prepare(spark)
    documents = read(spark, folder, "documents").select("doc_id")
    return assign_shards(documents, ["doc_id"], [f"shard-{i:05d}" for i in range(SHARDS)])


ORACLE = f"""
WITH RECURSIVE shards AS (
  SELECT i, ('0x' || substr(md5('offset shard-' || lpad(i::VARCHAR, 5, '0')), 1, 15))::BIGINT % {SLOTS} AS o,
         ('0x' || substr(md5('skip shard-' || lpad(i::VARCHAR, 5, '0')), 1, 15))::BIGINT % {SLOTS - 1} + 1 AS k
  FROM range({SHARDS}) t(i)
), lists AS (SELECT list(o ORDER BY i) AS os, list(k ORDER BY i) AS ks FROM shards),
filled(turn, owners, steps) AS (
  SELECT 0, list_transform(range({SLOTS}), lambda x: -1), list_transform(range({SHARDS}), lambda x: 0)
  FROM lists
  UNION ALL
  SELECT turn + 1,
         owners[:(os[s] + n * ks[s]) % {SLOTS}] || [turn % {SHARDS}]
           || owners[(os[s] + n * ks[s]) % {SLOTS} + 2:],
         steps[:s - 1] || [n + 1] || steps[s + 1:]
  FROM (
    SELECT turn, owners, steps, os, ks, turn % {SHARDS} + 1 AS s,
           list_filter(range(steps[turn % {SHARDS} + 1], {SLOTS}),
             lambda j: owners[(os[turn % {SHARDS} + 1] + j * ks[turn % {SHARDS} + 1]) % {SLOTS} + 1] < 0)[1] AS n
    FROM filled, lists WHERE turn < {SLOTS}
  )
), owner AS (SELECT unnest(range({SLOTS})) AS slot, unnest(owners) AS shard FROM filled WHERE turn = {SLOTS})
SELECT d.doc_id, d.slot, owner.shard::INTEGER AS shard
FROM (SELECT doc_id, ('0x' || substr(md5('=' || doc_id), 1, 15))::BIGINT % {SLOTS} AS slot FROM documents) d
JOIN owner USING (slot)
"""
