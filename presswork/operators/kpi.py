"""Health indicators of a run: volumes, rejection, leakage, coverage and alert levels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presswork import schemas as S
from presswork.functions.columns import content_key, ratio
from presswork.operators.filters import select_sources
from presswork.operators.stats import has_image


def count_by_source(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per source of one frame each; a source without rows still counts, as zero."""
    counts = [
        df.agg(F.count("*").alias("raw")).select(F.lit(source).alias("source"), "raw")
        for source, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def per_source_rejection(raw_counts: DataFrame, records: DataFrame) -> DataFrame:
    """Raw, valid and rejected rows per source, driven by the raw side."""
    valid = records.groupBy("source").agg(F.count("*").alias("valid"))
    counted = raw_counts.join(valid, "source", "left").na.fill(0, ["valid"])
    rejected = F.col("raw") - F.col("valid")
    return counted.select(
        "source",
        "raw",
        "valid",
        rejected.alias("rejected"),
        F.round(ratio(rejected, F.col("raw")), 4).alias("rate"),
    )


def overall_rejection(rejection: DataFrame) -> DataFrame:
    """Rejection rate over all sources, from the summed counts."""
    raw = F.coalesce(F.sum("raw"), F.lit(0).cast("long"))
    valid = F.coalesce(F.sum("valid"), F.lit(0).cast("long"))
    return rejection.agg(
        raw.alias("raw"),
        valid.alias("valid"),
        F.when(raw != 0, (raw - valid) / raw).otherwise(0.0).alias("rate"),
    )


def volumetry(rejection: DataFrame, sources: Sequence[str] = ()) -> DataFrame:
    """Raw and valid volumes of the chosen sources; no choice means all."""
    return select_sources(rejection, sources).select("source", "raw", "valid")


def rejection_table(rejection: DataFrame) -> DataFrame:
    """Volumes with the rate as a whole-number percentage."""
    return rejection.select(
        "source",
        "raw",
        "valid",
        "rejected",
        F.format_string("%.0f%%", F.bround(F.col("rate") * 100, 0)).alias("rate"),
    )


def label_detail_ranking(df: DataFrame) -> DataFrame:
    """Original verdicts by descending frequency, ties by name."""
    return (
        df.groupBy("label_detail")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), F.col("label_detail").asc_nulls_last())
    )


def split_sizes(df: DataFrame) -> DataFrame:
    """Records per split; a split without records is listed with zero."""
    return df.agg(*[F.count_if(F.col("split") == s).alias(s) for s in S.SPLITS]).select(
        F.inline(
            F.array(*[F.struct(F.lit(s).alias("split"), F.col(s).alias("n")) for s in S.SPLITS])
        )
    )


def leakage_count(df: DataFrame) -> DataFrame:
    """Number of contents found in more than one split, case and outer whitespace ignored.

    Splits are numbered so that the per-content state is two integers, which keeps the aggregate
    hashed and folded before the shuffle.
    """
    number = F.array_position(F.array(*[F.lit(s) for s in S.SPLITS]), F.col("split"))
    return (
        df.select(content_key().alias("content_key"), number.alias("number"))
        .groupBy("content_key")
        .agg(F.min("number").alias("low"), F.max("number").alias("high"))
        .agg(F.count_if(F.col("low") < F.col("high")).alias("leakage"))
    )


def image_coverage(df: DataFrame) -> DataFrame:
    """Records with an image, all records, and their ratio."""
    with_image = F.count_if(has_image(df))
    total = F.count("*")
    return df.agg(
        with_image.alias("with_image"),
        total.alias("total"),
        F.round(ratio(with_image, total), 4).alias("coverage"),
    )


# --- Fixed values: alert thresholds -----------------------------------------------------------
REJECTION_LEVELS = (0.15, 0.30)
IMAGE_FAILURE_LEVELS = (0.10, 0.25)
FRESHNESS_HOURS = (24.0, 48.0)
VOLUME_DROPS = (0.30, 0.60)
MIN_VALID_RATE = 0.80
MIN_IMAGE_COVERAGE = 0.70
MIN_RECORDS = 10
LABEL_BALANCE = (0.3, 0.7)
STAGE_SECONDS = {"extract": 120.0, "transform": 60.0}
# ----------------------------------------------------------------------------------------------


def alert_level(value: Column, levels: tuple[float, float]) -> Column:
    """ok, warn or critical: from the first threshold it warns, beyond the second it is critical."""
    warn, critical = levels
    return F.when(value > critical, "critical").when(value >= warn, "warn").otherwise("ok")


def rejection_alerts(rejection: DataFrame) -> DataFrame:
    """Alert level of each source's rejection rate."""
    rate = ratio(F.col("rejected"), F.col("raw"))
    return rejection.select(
        "source", "raw", "rejected", alert_level(rate, REJECTION_LEVELS).alias("level")
    )


def image_failure_alert(summary: DataFrame) -> DataFrame:
    """Alert level of the share of attempted downloads that failed."""
    attempted = F.col("downloaded") + F.col("failed")
    return summary.select(
        "*", alert_level(ratio(F.col("failed"), attempted), IMAGE_FAILURE_LEVELS).alias("level")
    )


def leakage_alert(leakage: DataFrame) -> DataFrame:
    """Any leaked content is critical."""
    return leakage.select(
        "leakage", F.when(F.col("leakage") >= 1, "critical").otherwise("ok").alias("level")
    )


def freshness_alerts(runs: DataFrame, now: Column) -> DataFrame:
    """Alert level per source from the age of its last successful run (``finished_at``)."""
    hours = (F.unix_timestamp(now) - F.unix_timestamp("last_success")) / 3600
    return (
        runs.groupBy("source")
        .agg(F.max("finished_at").alias("last_success"))
        .select("source", "last_success", alert_level(hours, FRESHNESS_HOURS).alias("level"))
    )


def volume_alerts(daily: DataFrame, until: Column | None = None) -> DataFrame:
    """Compare each day's volume (``source, day, n``) with the mean of the seven days before.

    A source counts from its first day to the last day of any source, or to ``until``. A day of
    these without rows is a day of volume 0, which is critical, and part of later means. A first
    day has nothing to compare with. Only days and counts are handled.
    """
    spans = daily.groupBy("source").agg(F.min("day").alias("first"), F.max("day").alias("last"))
    end = F.max("last").over(Window.partitionBy(F.lit(0))) if until is None else until
    days = spans.withColumn("end", end).select(
        "source", F.explode(F.sequence("first", F.greatest("first", "end"))).alias("day")
    )
    whole = days.join(daily, ["source", "day"], "left").select(
        "source", "day", F.coalesce("n", F.lit(0)).alias("n")
    )
    day_number = F.unix_date("day")
    week = Window.partitionBy("source").orderBy(day_number).rangeBetween(-7, -1)
    drop = F.lit(1.0) - F.col("n") * F.col("days") / F.nullif("previous", F.lit(0))
    return (
        whole.select("*", F.sum("n").over(week).alias("previous"), F.count("n").over(week).alias("days"))
        .select(
            "source",
            "day",
            "n",
            "previous",
            "days",
            F.when(F.col("n") == 0, "critical")
            .when(drop >= VOLUME_DROPS[1], "critical")
            .when(drop >= VOLUME_DROPS[0], "warn")
            .otherwise("ok")
            .alias("level"),
        )
    )


def duration_alerts(runs: DataFrame) -> DataFrame:
    """Seconds of each run (``stage, source, started_at, finished_at``), and whether that is too
    long for its stage; a stage without a limit never alerts."""
    limits = F.create_map(*[F.lit(v) for pair in STAGE_SECONDS.items() for v in pair])
    seconds = (F.unix_millis("finished_at") - F.unix_millis("started_at")) / 1000
    late = seconds > F.try_element_at(limits, F.col("stage"))
    return runs.select(
        "stage", "source", "started_at", seconds.alias("seconds"), F.coalesce(late, F.lit(False)).alias("alert")
    )


def run_alerts(rejection: DataFrame, records: DataFrame) -> DataFrame:
    """Run-level checks in long form: ``(check, numerator, denominator, alert)``."""
    valid = overall_rejection(rejection).select(
        F.lit("valid_rate").alias("check"),
        F.col("valid").alias("numerator"),
        F.col("raw").alias("denominator"),
        (ratio(F.col("valid"), F.col("raw")) < MIN_VALID_RATE).alias("alert"),
    )
    counts = records.agg(
        F.count("*").alias("total"),
        F.count("image_url").alias("with_url"),
        F.count_if(F.col("label") == "fake").alias("fake"),
        F.count("label").alias("labelled"),
    )
    balance = ratio(F.col("fake"), F.col("labelled"))

    def check(name: str, numerator: str, denominator: str, alert: Column) -> Column:
        return F.struct(
            F.lit(name).alias("check"),
            F.col(numerator).alias("numerator"),
            F.col(denominator).alias("denominator"),
            alert.alias("alert"),
        )

    checks = counts.select(
        F.inline(
            F.array(
                check(
                    "image_coverage",
                    "with_url",
                    "total",
                    ratio(F.col("with_url"), F.col("total")) < MIN_IMAGE_COVERAGE,
                ),
                check("records_per_run", "total", "total", F.col("total") < MIN_RECORDS),
                check(
                    "label_balance",
                    "fake",
                    "labelled",
                    (balance < LABEL_BALANCE[0]) | (balance > LABEL_BALANCE[1]),
                ),
            )
        )
    )
    return valid.unionByName(checks)


def kpi_summary(rejection: DataFrame, final: DataFrame) -> DataFrame:
    """All indicators of a run in long form: ``(metric, key, value)``."""

    def entry(metric: str, key: Column, value: str) -> Column:
        return F.struct(
            F.lit(metric).alias("metric"),
            key.cast("string").alias("key"),
            F.col(value).cast("double").alias("value"),
        )

    none = F.lit(None)
    parts = [
        (rejection, [entry(f"rejection_{c}", F.col("source"), c) for c in ("raw", "valid", "rejected")]),
        (split_sizes(final), [entry("split_size", F.col("split"), "n")]),
        (leakage_count(final), [entry("leakage", none, "leakage")]),
        (image_coverage(final), [entry(c, none, c) for c in ("with_image", "total")]),
    ]
    frames = [df.select(F.inline(F.array(*entries))) for df, entries in parts]
    return reduce(DataFrame.unionByName, frames)
