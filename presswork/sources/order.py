"""File order as an explicit column.

Shuffles do not keep the order of lines, but two rules refer to it: the first of several duplicates
is kept, and the first member of a content group decides its stratum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Name under which a raw batch keeps the order of the files that it was made from.
KEPT_ORDER = "_order"


def file_order(rank: Column | None = None, position: Column | None = None) -> Column:
    """Position of a row: file rank, folder, part, name, block, row in the block, position in the row.

    Folders of batches start with the same prefix and carry the batch time, so they sort by time.
    Part files sort by their number. The row number is only compared within one block, where it
    follows the lines.
    """
    path = F.col("_metadata.file_path")
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    part = F.regexp_extract(name, r"^part-(\d+)", 1)
    return F.struct(
        (F.lit(0) if rank is None else rank).cast("int").alias("rank"),
        F.regexp_replace(path, r"/[^/]*$", "").alias("folder"),
        F.coalesce(part.try_cast("long"), F.lit(-1)).cast("long").alias("part"),
        name.alias("name"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        (F.lit(0) if position is None else position).cast("int").alias("pos"),
    )


ORDER = T.StructType(
    [
        T.StructField("rank", T.IntegerType()),
        T.StructField("folder", T.StringType()),
        T.StructField("part", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("block", T.LongType()),
        T.StructField("row", T.LongType()),
        T.StructField("pos", T.IntegerType()),
    ]
)


def with_file_order(df: DataFrame, rank: Column | None = None) -> DataFrame:
    """Add ``_seq`` to a frame read straight from files."""
    return df.select("*", file_order(rank).alias("_seq"))
