"""Sinks for raw batches, unified batches and the split dataset."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presswork import schemas as S
from presswork.sources.order import KEPT_ORDER


def batch_id(moment: datetime | None = None) -> str:
    """Batch name of a UTC moment, now by default."""
    return (moment or datetime.now(UTC)).strftime("%Y%m%d_%H%M%S")


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    rows = Observation()
    return df.observe(rows, F.count(F.lit(1)).alias("rows")), rows


def write_raw(
    df: DataFrame, root: str, source: str, batch: str | None = None
) -> tuple[str, int]:
    """Write a raw batch as JSON Lines under its source; return its path and row count.

    Every run has its own batch folder. A fixed ``batch`` name suits static sets and replaces the
    earlier batch of that name. The order of the landed files goes along in a technical column:
    the parts of a batch do not follow it, and which of several duplicates is first depends on it.
    """
    path = f"{root}/{source}/batch_ts={batch or batch_id()}"
    ordered = "_seq" in df.columns and isinstance(df.schema["_seq"].dataType, T.StructType)
    observed, rows = _counted(df.withColumnRenamed("_seq", KEPT_ORDER) if ordered else df.drop("_seq"))
    observed.write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return path, rows.get["rows"]


def write_unified(
    df: DataFrame, root: str, batch: str | None = None, fmt: str = "parquet"
) -> tuple[str, int]:
    """Write a unified batch; return its path and row count.

    Columns are checked against the article schema. JSON holds exactly those, with explicit NULLs;
    Parquet also keeps the technical ``_seq``, so that the first-member rule survives the write.
    """
    S.assert_columns(df, S.ARTICLE, technical=("_seq",))
    path = f"{root}/batch_ts={batch or batch_id()}"
    observed, rows = _counted(df.drop("_seq") if fmt == "json" else df)
    observed.write.mode("overwrite").format(fmt).option("ignoreNullFields", False).save(path)
    return path, rows.get["rows"]


def write_splits(df: DataFrame, path: str, fmt: str = "json") -> str:
    """Write the split dataset, one folder per split; the rows themselves carry no split."""
    columns = [*S.ARTICLE.fieldNames(), "split"]
    out = df.select(*columns)
    out.write.mode("overwrite").partitionBy("split").format(fmt).option(
        "ignoreNullFields", False
    ).save(path)
    return path
