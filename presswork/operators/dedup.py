"""Keep-first de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.session import materialize


#: Estimated bytes up to which rows are moved whole: the two extra steps would take longer.
SMALL_BYTES = 256 << 20


def keep_first(df: DataFrame, key: str, order: str = "_seq") -> DataFrame:
    """Drop rows with a NULL key and keep, per key, the row that comes first in ``order``.

    An empty key is a key like any other. The ``row_number() = 1`` form lets Spark insert a group
    limit below the shuffle: each task passes on at most one row per key, so a key that holds a
    large share of the input does not pile up in one task. Rows move whole, so this suits narrow
    ones; :func:`keep_first_in_place` is the form for wide rows.
    """
    rank = f"row_number() OVER (PARTITION BY `{key}` ORDER BY `{order}`) AS _rank"
    present = df.where(f"`{key}` IS NOT NULL")
    return present.selectExpr("*", rank).where("_rank = 1").drop("_rank")


def repeated_keys(df: DataFrame, key: str, order: str = "_seq") -> DataFrame:
    """The keys of several rows as a written table: ``_key``, ``_first`` (the least order) and
    ``_ties`` (rows that have it). Only keys and orders are read and shuffled."""
    slim = df.where(F.col(f"`{key}`").isNotNull()).select(
        F.col(f"`{key}`").alias("_key"), F.col(f"`{order}`").alias("_first")
    )
    per_place = slim.groupBy("_key", "_first").agg(F.count("*").alias("_ties"))
    least = per_place.groupBy("_key").agg(
        F.min(F.struct("_first", "_ties")).alias("_least"), F.sum("_ties").alias("_rows")
    )
    several = least.where("_rows > 1").select("_key", "_least._first", "_least._ties")
    return materialize(several, "repeated-keys")


def _estimated_bytes(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def keep_first_in_place(df: DataFrame, key: str, order: str = "_seq") -> DataFrame:
    """As :func:`keep_first`, without moving wide rows for a few repeated keys.

    The keys that repeat are a written table of known size: below the broadcast threshold the rows
    meet it where they are, above it in a sort-merge join that adaptive execution splits where it
    is skewed. Of rows that tie in the first place, which are moved, any one is kept. ``order`` must
    be the same in two scans, as the order of rows in files is. Input that the planner estimates at
    no more than :data:`SMALL_BYTES` takes the other form, with the same result.
    """
    if _estimated_bytes(df) <= SMALL_BYTES:
        return keep_first(df, key, order)
    repeated = repeated_keys(df, key, order)
    present = df.where(F.col(f"`{key}`").isNotNull())
    met = present.join(repeated, F.col(f"`{key}`") == F.col("_key"), "left")
    first = met.where(F.col("_key").isNull() | F.col(f"`{order}`").eqNullSafe(F.col("_first")))
    if repeated.where("_ties > 1").isEmpty():
        return first.select(*[f"`{c}`" for c in df.columns])
    alone = first.where("_ties IS NULL OR _ties = 1").select(*[f"`{c}`" for c in df.columns])
    tied = first.where("_ties > 1").select(*[f"`{c}`" for c in df.columns])
    return alone.unionByName(tied.dropDuplicates([key]))
