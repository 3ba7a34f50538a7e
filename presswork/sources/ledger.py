"""An append-only table of the runs of stages, with their durations and row counts."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

RUN = T.StructType(
    [
        T.StructField("stage", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("finished_at", T.TimestampType()),
        T.StructField("rows", T.LongType()),
        T.StructField("ok", T.BooleanType()),
    ]
)


class Run:
    """What a stage tells about itself while it runs."""

    rows: int | None = None


@contextmanager
def recorded(spark: SparkSession, ledger: str, stage: str, source: str | None = None) -> Iterator[Run]:
    """Append a row to the ledger when the stage ends, also when it fails."""
    run, started, ok = Run(), datetime.now(UTC), False
    try:
        yield run
        ok = True
    finally:
        row = (stage, source, started, datetime.now(UTC), run.rows, ok)
        spark.createDataFrame([row], RUN).coalesce(1).write.mode("append").parquet(ledger)


def read_runs(spark: SparkSession, ledger: str) -> DataFrame:
    return spark.read.schema(RUN).parquet(ledger)
