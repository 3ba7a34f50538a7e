"""Dataset statistics as small long-form frames.

Every function first folds the rows into counts per distinct value with a hash aggregate, and
derives the report from those counts. No statistic gathers rows in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork import schemas as S
from presswork.functions.columns import content_key, label_key

DIMENSIONS = ("source", "label", "label_detail", "language")


def has_image(df: DataFrame) -> Column:
    """Image flag of a nested or a flat record; a missing flag is false."""
    column = F.col("metadata.has_image") if "metadata" in df.columns else F.col("has_image")
    return F.coalesce(column, F.lit(False))


def _attribute_counts(df: DataFrame) -> DataFrame:
    """Records per combination of the reported attributes; a handful of rows per task."""
    return (
        df.select(
            "source",
            label_key(F.col("label")).alias("label"),
            "label_detail",
            "language",
            has_image(df).alias("image"),
        )
        .groupBy(*DIMENSIONS, "image")
        .agg(F.count("*").alias("n"))
    )


def _unpivoted(counts: DataFrame) -> DataFrame:
    entries = F.inline(
        F.array(
            *[
                F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value"))
                for d in DIMENSIONS
            ]
        )
    )
    return (
        counts.select("n", entries).groupBy("dimension", "value").agg(F.sum("n").alias("n"))
    )


def frequency_tables(df: DataFrame) -> DataFrame:
    """Counts per source, label, detail and language as ``(dimension, value, n)``.

    A NULL label is reported as ``null``; a NULL in another dimension stays NULL. Combinations are
    counted once and only that result is unpivoted.
    """
    return _unpivoted(_attribute_counts(df)).orderBy("dimension", F.col("value").asc_nulls_last())


def content_length_stats(df: DataFrame) -> DataFrame:
    """Minimum, maximum, mean and median length of the content in code points.

    The lengths are folded into a histogram first, so the exact median is computed from at most
    one row per distinct length.
    """
    return _length_report(
        df.select(_content_size()).groupBy("size").agg(F.count("*").alias("n"))
    )


def _content_size() -> Column:
    return F.expr("coalesce(CAST(length(content) AS BIGINT), 0) AS size")


def _length_report(histogram: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("long")
    chars = F.coalesce(F.sum(F.col("size") * F.col("n")), zero)
    records = F.coalesce(F.sum("n"), zero)
    return histogram.agg(
        F.coalesce(F.min("size"), zero).alias("min_length"),
        F.coalesce(F.max("size"), zero).alias("max_length"),
        F.coalesce(F.percentile("size", 0.5, F.col("n")).cast("long"), zero).alias("median_length"),
        chars.alias("total_length"),
        records.alias("records"),
        F.when(records > 0, F.round(chars / records, 1)).otherwise(0.0).alias("mean_length"),
    )


def duplicate_groups(df: DataFrame) -> DataFrame:
    """Number of contents that occur more than once."""
    return (
        df.groupBy(content_key().alias("content_key"))
        .agg(F.count("*").alias("n"))
        .agg(F.count_if(F.col("n") > 1).alias("duplicate_content_groups"))
    )


def dataset_totals(df: DataFrame) -> DataFrame:
    """Number of records, with and without an image."""
    flag = has_image(df)
    return df.agg(
        F.count("*").alias("total"),
        F.count_if(flag).alias("with_image"),
        F.count_if(~flag).alias("without_image"),
    )


def dataset_stats(df: DataFrame) -> DataFrame:
    """The whole summary in long form: ``(metric, value, n)``.

    Metrics are ``total``, ``has_image``, the frequency tables, the content lengths and the number
    of duplicate content groups. The rows are read twice: once for the attributes and once for the
    content; each of the two aggregates is shuffled once and feeds two reports.
    """
    attributes = _attribute_counts(df)
    contents = (
        df.select(content_key().alias("content_key"), _content_size())
        .groupBy("content_key", "size")
        .agg(F.count("*").alias("n"))
    )
    zero = F.lit(0).cast("long")
    totals = attributes.agg(
        F.coalesce(F.sum("n"), zero).alias("total"),
        F.coalesce(F.sum(F.when(F.col("image"), F.col("n"))), zero).alias("with_image"),
    ).select(
        F.inline(
            F.array(
                _entry("total", None, F.col("total")),
                _entry("has_image", "true", F.col("with_image")),
                _entry("has_image", "false", F.col("total") - F.col("with_image")),
            )
        )
    )
    frequencies = _unpivoted(attributes).select(
        F.concat(F.lit("by_"), "dimension").alias("metric"), "value", F.col("n").cast("double").alias("n")
    )
    lengths = _length_report(
        contents.groupBy("size").agg(F.sum("n").alias("n"))
    ).select(
        F.inline(
            F.array(
                *[
                    _entry("content_length", m, F.col(f"{m}_length"))
                    for m in ("min", "max", "mean", "median")
                ]
            )
        )
    )
    duplicates = (
        contents.groupBy("content_key")
        .agg(F.sum("n").alias("n"))
        .agg(F.count_if(F.col("n") > 1).alias("groups"))
        .select(F.inline(F.array(_entry("duplicate_content_groups", None, F.col("groups")))))
    )
    return totals.unionByName(frequencies).unionByName(lengths).unionByName(duplicates)


def _entry(metric: str, value: str | None, n: Column) -> Column:
    return F.struct(
        F.lit(metric).alias("metric"),
        F.lit(value).cast("string").alias("value"),
        n.cast("double").alias("n"),
    )


def split_crosstab(df: DataFrame) -> DataFrame:
    """Records per split and source in long form, every combination present, with row totals.

    The total of a split carries a NULL source. Absent cells are zero.
    """
    cells = (
        df.groupBy("source")
        .agg(*[F.count_if(F.col("split") == s).alias(s) for s in S.SPLITS])
        .select(
            "source",
            F.inline(
                F.array(*[F.struct(F.lit(s).alias("split"), F.col(s).alias("n")) for s in S.SPLITS])
            ),
        )
    )
    return (
        cells.rollup("split", "source")
        .agg(F.sum("n").alias("n"), F.grouping_id().alias("level"))
        .where("level < 3")
        .select("split", "source", "n", (F.col("level") == 1).alias("is_total"))
    )
