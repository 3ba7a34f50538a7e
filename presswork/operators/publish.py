"""The flat article table and its full refresh."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from presswork import schemas as S
from presswork.sources import files

MANIFEST = "current.json"


def flatten_articles(df: DataFrame) -> DataFrame:
    """Flat row per record; a record without metadata gets NULL in its three columns."""
    nested = {f.name for f in S.METADATA.fields}
    missing = [c for c in S.FLAT_COLUMNS if c not in df.columns and c not in nested]
    padded = df.select("*", *[F.lit(None).cast("string").alias(c) for c in missing])
    has_metadata = "metadata" in df.columns
    types = {f.name: f.dataType for f in S.METADATA.fields}
    columns = [
        F.col(c)
        if c not in nested
        else (F.col("metadata")[c] if has_metadata else F.lit(None)).cast(types[c]).alias(c)
        for c in S.FLAT_COLUMNS
    ]
    return padded.select(*columns)


def full_refresh(df: DataFrame, target: str, fmt: str = "parquet") -> int:
    """Replace the table at ``target`` by the flattened records; return the number written.

    The rows go to a version folder of their own, and a manifest that names it is replaced last, in
    one step: readers (:func:`read_current`) find the old rows or the new ones, and a write that
    fails leaves the old ones. The version before stays for readers at work, older ones are
    removed. Running it again leaves the same rows.
    """
    spark = df.sparkSession
    version = f"version={uuid.uuid4().hex}"
    rows = Observation()
    stamped = flatten_articles(df).withColumn("loaded_at", F.current_timestamp())
    observed = stamped.observe(rows, F.count(F.lit(1)).alias("rows"))
    observed.write.format(fmt).save(f"{target}/{version}")
    count, before = rows.get["rows"], _manifest(spark, target)
    manifest = json.dumps({"version": version, "format": fmt, "rows": count})
    files.replace_text(spark, f"{target}/{MANIFEST}", manifest, f"{target}/.{MANIFEST}-{uuid.uuid4().hex}")
    kept = {version, before["version"] if before else version}
    for name in files.names(spark, target):
        if name.startswith("version=") and name not in kept:
            files.delete(spark, f"{target}/{name}")
    return count


def _manifest(spark: SparkSession, target: str) -> dict | None:
    text = files.read_text(spark, f"{target}/{MANIFEST}")
    return None if text is None else json.loads(text)


def read_current(spark: SparkSession, target: str) -> DataFrame:
    """The rows of the last refresh that ended."""
    manifest = _manifest(spark, target)
    if manifest is None:
        raise FileNotFoundError(f"no refresh of {target} has ended")
    return spark.read.format(manifest["format"]).load(f"{target}/{manifest['version']}")


def full_refresh_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """Replace the rows of a database table.

    The table is emptied and refilled by parallel connections, so this is not one transaction:
    load into a staging table and swap it by name where readers must never see a partial refresh.
    """
    stamped = flatten_articles(df).withColumn("loaded_at", F.current_timestamp())
    stamped.write.mode("overwrite").option("truncate", True).jdbc(url, table, properties=properties)
