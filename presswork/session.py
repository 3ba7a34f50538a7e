"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the plans rely on. A value the caller has already set is left alone.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Whole pages travel to Python in one column: bound batches by bytes, not only by rows.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
}

_local_scratch: str | None = None


def tune(spark: SparkSession) -> SparkSession:
    """Apply :data:`SETTINGS` where the session has no value of its own."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master may do without it, because there every task sees the same disk.
    """
    global _local_scratch
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not (spark.conf.get("spark.master", "") or "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="presswork-")
    return _local_scratch


def materialize(df: DataFrame, name: str, partition_by: Iterable[str] = ()) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Used where a result feeds several later scans. The written table survives the loss of
    executors, cuts the lineage, and gives the planner a measured size: a join against it is
    broadcast only below ``spark.sql.autoBroadcastJoinThreshold`` and is a sort-merge join, with
    skew splitting, above it.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/presswork/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
