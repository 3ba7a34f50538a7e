"""The stages end to end: ingest, transform, build, attach images, publish, measure."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from presswork import schemas as S
from presswork.operators import images, kpi, stats
from presswork.operators.dedup import keep_first_in_place
from presswork.operators.filters import filter_articles, first_rows
from presswork.operators.normalize import Moment, normalize
from presswork.operators.pages import feed_claims
from presswork.operators.publish import full_refresh
from presswork.operators.splits import assign_splits
from presswork.operators.validate import valid_rows
from presswork.session import materialize
from presswork.sources import readers, writers

logger = logging.getLogger(__name__)


# --- Ingest: landed files to raw batches ------------------------------------------------------
def ingest_posts(
    spark: SparkSession, path: str, raw_root: str, limit: int | None = None, batch: str = "posts"
) -> tuple[str, int]:
    """Posts with an image, as a raw batch of a fixed name."""
    rows = first_rows(readers.read_posts(spark, path), limit)
    return writers.write_raw(rows, raw_root, "fakeddit", batch)


def ingest_news(
    spark: SparkSession,
    path: str,
    raw_root: str,
    max_pages: int | None = None,
    require_image: bool = True,
    batch: str | None = None,
) -> tuple[str, int]:
    """Wanted articles of the landed result pages, as a new raw batch."""
    seen = Observation()
    landed = readers.read_news_payloads(spark, path, max_pages).observe(
        seen, F.count(F.lit(1)).alias("rows")
    )
    written = writers.write_raw(filter_articles(landed, require_image), raw_root, "guardian", batch)
    logger.info("skipped %d results that are no article or lack an image", seen.get["rows"] - written[1])
    return written


def ingest_claims(
    spark: SparkSession,
    feed_path: str,
    pages: DataFrame,
    raw_root: str,
    limit: int | None = None,
    batch: str | None = None,
) -> tuple[str, int]:
    """Claims read from the fetched pages of the feed items, as a new raw batch."""
    feed = readers.read_feed_items(spark, feed_path, limit)
    rows = feed_claims(feed, pages).select(*S.RAW_CLAIM.fieldNames())
    written = writers.write_raw(rows, raw_root, "snopes", batch)
    logger.info("skipped %d feed items without a readable page", feed.count() - written[1])
    return written


def ingest_statements(
    spark: SparkSession,
    path: str | list[str],
    raw_root: str,
    splits: Sequence[str] = S.SPLITS,
    limit: int | None = None,
    batch: str = "statements",
) -> tuple[str, int]:
    """Statements of the chosen splits, as a raw batch of a fixed name."""
    rows = first_rows(readers.read_statements(spark, path, splits), limit)
    return writers.write_raw(rows, raw_root, "liar", batch)


# --- Transform: raw batches to one unified batch ----------------------------------------------
def transform_source(df: DataFrame, source: str, collected_at: Moment) -> DataFrame:
    """De-duplicate, normalise and validate the raw rows of one source."""
    first = keep_first_in_place(df, S.NATURAL_KEYS[source])
    return valid_rows(normalize(first, source, collected_at))


def unify(raw: Mapping[str, DataFrame], collected_at: Moment) -> DataFrame:
    """Valid articles of all given sources, in the order of the sources, with one timestamp."""
    parts = []
    for rank, source in enumerate(S.SOURCES):
        if source in raw:
            rows = transform_source(raw[source], source, collected_at)
            order = F.struct(F.lit(rank).alias("source_rank"), F.col("_seq").alias("row"))
            parts.append(rows.withColumn("_seq", order))
    return readers.union_of(parts)


def read_latest_raw(
    spark: SparkSession, raw_root: str, sources: Sequence[str] = S.SOURCES
) -> dict[str, DataFrame]:
    """Latest raw batch of each source; a source without one is left out with a warning."""
    raw = {}
    for source in sources:
        path = readers.latest_batch_path(spark, raw_root, source)
        if path is None:
            logger.warning("no raw batch for source %r, skipping", source)
            continue
        raw[source] = readers.read_json_lines(
            spark, path, S.RAW_SCHEMAS[source], nan_is_missing=source == "fakeddit"
        )
    return raw


def transform(
    spark: SparkSession,
    raw_root: str,
    unified_root: str,
    sources: Sequence[str] = S.SOURCES,
    collected_at: datetime | None = None,
    fmt: str = "parquet",
) -> int:
    """Write a unified batch from the latest raw batches; return the number of valid records."""
    moment = collected_at or datetime.now(UTC)
    raw = read_latest_raw(spark, raw_root, sources)
    if not raw:
        logger.warning("no raw batch at all, nothing written")
        return 0
    _, written = writers.write_unified(
        unify(raw, moment), unified_root, writers.batch_id(moment), fmt
    )
    return written


def read_unified(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A unified batch with its ``_seq``; from JSON the order is that of the files."""
    if fmt == "json":
        return readers.read_json_lines(spark, path, S.ARTICLE)
    return spark.read.format(fmt).load(path)


# --- Build, images, publish -------------------------------------------------------------------
def build_dataset(
    spark: SparkSession,
    unified_root: str,
    dataset_path: str,
    ratios: tuple[float, float, float] = S.DEFAULT_RATIOS,
    seed: int = S.DEFAULT_SEED,
    fmt: str = "json",
    unified_fmt: str = "parquet",
) -> DataFrame:
    """Split the latest unified batch, write it and return the statistics of what was written."""
    path = readers.latest_batch_path(spark, unified_root)
    if path is None:
        raise FileNotFoundError(f"no unified batch under {unified_root}: run transform first")
    tagged = assign_splits(read_unified(spark, path, unified_fmt), ratios, seed)
    writers.write_splits(tagged, dataset_path, fmt)
    return stats.dataset_stats(readers.read_splits(spark, dataset_path, fmt))


def acquire_images(
    spark: SparkSession,
    dataset_path: str,
    responses: DataFrame,
    corrected_path: str,
    fmt: str = "json",
) -> DataFrame:
    """Write a new version of the dataset with corrected image flags; return the summary.

    A dataset is never rewritten in place, because Spark reads it while it writes.
    """
    if corrected_path.rstrip("/") == dataset_path.rstrip("/"):
        raise ValueError("the corrected dataset needs a path of its own")
    records = readers.read_splits(spark, dataset_path, fmt)
    outcomes = materialize(images.image_outcomes(records, responses), "image-outcomes")
    writers.write_splits(outcomes, corrected_path, fmt)
    return images.image_summary(outcomes)


def load_articles(
    spark: SparkSession, dataset_path: str, target: str, fmt: str = "json", table_fmt: str = "parquet"
) -> int:
    """Full refresh of the flat article table from the split dataset; return its row count."""
    return full_refresh(readers.read_splits(spark, dataset_path, fmt), target, table_fmt)


# --- Indicators -------------------------------------------------------------------------------
def compute_kpis(
    spark: SparkSession,
    raw_root: str,
    unified_root: str,
    dataset_path: str,
    fmt: str = "json",
    unified_fmt: str = "parquet",
) -> dict[str, DataFrame]:
    """Every indicator as a small frame, from the files of the last run.

    The split dataset is the final state. Without it the latest unified batch stands in, and then
    no record belongs to a split.
    """
    raw = read_latest_raw(spark, raw_root)
    present = {
        source: df if (df := raw.get(source)) is not None else _no_rows(spark, source)
        for source in S.SOURCES
    }
    final = _final_records(spark, unified_root, dataset_path, fmt, unified_fmt)
    rejection = kpi.per_source_rejection(kpi.count_by_source(present), final)
    return {
        "stats": stats.dataset_stats(final),
        "rejection": rejection,
        "overall_rejection": kpi.overall_rejection(rejection),
        "volumetry": kpi.volumetry(rejection),
        "split_sizes": kpi.split_sizes(final),
        "split_crosstab": stats.split_crosstab(final),
        "leakage": kpi.leakage_count(final.where("split IS NOT NULL")),
        "image_coverage": kpi.image_coverage(final),
        "label_detail": kpi.label_detail_ranking(final),
    }


def _no_rows(spark: SparkSession, source: str) -> DataFrame:
    return spark.createDataFrame([], S.RAW_SCHEMAS[source])


def _final_records(
    spark: SparkSession, unified_root: str, dataset_path: str, fmt: str, unified_fmt: str
) -> DataFrame:
    columns = S.ARTICLE.fieldNames()
    if readers.has_entries(spark, dataset_path):
        splits = readers.read_splits(spark, dataset_path, fmt)
        if not splits.isEmpty():
            return splits
    path = readers.latest_batch_path(spark, unified_root)
    if path is None:
        records = spark.createDataFrame([], S.ARTICLE)
    else:
        records = read_unified(spark, path, unified_fmt).select(*columns)
    return records.withColumn("split", F.lit(None).cast("string"))
