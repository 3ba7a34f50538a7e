"""Statistics, indicators, alerts and reports."""

from __future__ import annotations

import statistics

import pytest
from pyspark.sql import functions as F

from presswork.operators import kpi, stats
from presswork.plans import report

DDL = (
    "source string, label string, label_detail string, language string, content string, "
    "metadata struct<has_image:boolean>, split string"
)


def record(source="liar", label="fake", detail="false", content="some statement", image=False, split="train"):
    return (source, label, detail, "en", content, (image,), split)


def frame(spark, *records):
    return spark.createDataFrame(list(records), DDL)


def summary(spark, *records):
    rows = stats.dataset_stats(frame(spark, *records)).collect()
    return {(r["metric"], r["value"]): r["n"] for r in rows}


class TestStats:
    def test_counts(self, spark):
        got = summary(
            spark,
            record(image=True),
            record(source="snopes", label=None, detail=None),
            record(label="real", content="same"),
            record(content="  SAME "),
            record(content=None, image=None),
        )
        assert got[("total", None)] == 5
        assert got[("by_source", "liar")] == 4 and got[("by_source", "snopes")] == 1
        assert got[("by_label", "null")] == 1 and got[("by_label", "fake")] == 3
        assert got[("by_label_detail", None)] == 1
        assert got[("by_language", "en")] == 5
        assert got[("has_image", "true")] == 1 and got[("has_image", "false")] == 4
        assert got[("duplicate_content_groups", None)] == 2

    @pytest.mark.parametrize(
        "contents", [["a"], ["a", "bb"], ["a", "bb", "cccc", None], ["é" * 7, "x" * 2, ""], ["ab"] * 9 + ["c" * 100]]
    )
    def test_lengths(self, spark, contents):
        df = frame(spark, *[record(content=c) for c in contents]).repartition(3)
        row = stats.content_length_stats(df).first()
        sizes = [len(c or "") for c in contents]
        assert (row["min_length"], row["max_length"]) == (min(sizes), max(sizes))
        assert row["median_length"] == int(statistics.median(sizes))
        assert row["mean_length"] == pytest.approx(round(statistics.mean(sizes), 1))

    def test_empty(self, spark):
        got = summary(spark)
        assert got[("total", None)] == 0
        assert {got[("content_length", m)] for m in ("min", "max", "mean", "median")} == {0}
        assert got[("duplicate_content_groups", None)] == 0

    def test_crosstab_lists_absent_cells(self, spark):
        df = frame(spark, record(), record(source="snopes", split="test"), record())
        rows = {(r["split"], r["source"], r["is_total"]): r["n"] for r in stats.split_crosstab(df).collect()}
        assert rows == {
            ("train", "liar", False): 2,
            ("train", "snopes", False): 0,
            ("train", None, True): 2,
            ("validation", "liar", False): 0,
            ("validation", "snopes", False): 0,
            ("validation", None, True): 0,
            ("test", "liar", False): 0,
            ("test", "snopes", False): 1,
            ("test", None, True): 1,
        }


def rejection(spark, raw, valid):
    raw_counts = spark.createDataFrame(list(raw.items()), "source string, raw bigint")
    rows = [(s,) for s, n in valid.items() for _ in range(n)]
    return kpi.per_source_rejection(raw_counts, spark.createDataFrame(rows, "source string"))


class TestRejection:
    def test_counts_and_rate(self, spark):
        rows = rejection(spark, {"snopes": 20, "guardian": 45}, {"snopes": 13, "guardian": 45, "liar": 3})
        got = {r["source"]: (r["raw"], r["valid"], r["rejected"], r["rate"]) for r in rows.collect()}
        assert got == {"snopes": (20, 13, 7, 0.35), "guardian": (45, 45, 0, 0.0)}

    def test_source_without_valid_rows(self, spark):
        row = rejection(spark, {"liar": 100}, {}).first()
        assert (row["valid"], row["rejected"], row["rate"]) == (0, 100, 1.0)

    def test_no_raw_rows_is_no_rejection(self, spark):
        assert rejection(spark, {"liar": 0}, {"liar": 2}).first()["rate"] == 0.0

    def test_overall(self, spark):
        row = kpi.overall_rejection(rejection(spark, {"a": 5, "b": 5}, {"a": 5, "b": 3})).first()
        assert row["rate"] == pytest.approx(0.2)

    def test_overall_of_nothing(self, spark):
        row = kpi.overall_rejection(rejection(spark, {}, {})).first()
        assert (row["raw"], row["valid"], row["rate"]) == (0, 0, 0.0)

    def test_frames(self, spark):
        rows = rejection(spark, {"a": 5, "b": 40}, {"a": 5, "b": 25})
        assert kpi.volumetry(rows).columns == ["source", "raw", "valid"]
        assert [r["source"] for r in kpi.volumetry(rows, ["b"]).collect()] == ["b"]
        assert {r["source"]: r["rate"] for r in kpi.rejection_table(rows).collect()} == {"a": "0%", "b": "38%"}

    def test_raw_counts_list_empty_sources(self, spark):
        frames = {"a": spark.range(3), "b": spark.range(0)}
        assert {r["source"]: r["raw"] for r in kpi.count_by_source(frames).collect()} == {"a": 3, "b": 0}


class TestLeakage:
    def count(self, spark, *pairs):
        return kpi.leakage_count(spark.createDataFrame(list(pairs), "split string, content string")).first()[0]

    def test_no_overlap(self, spark):
        assert self.count(spark, ("train", "a"), ("validation", "b"), ("test", "c"), ("test", "c")) == 0

    def test_overlap(self, spark):
        assert self.count(spark, ("train", "shared"), ("test", "shared"), ("test", "unique")) == 1

    def test_case_and_whitespace(self, spark):
        assert self.count(spark, ("train", "Same Text"), ("test", "  same text  ")) == 1

    def test_null_content_is_one_key(self, spark):
        assert self.count(spark, ("train", None), ("test", "")) == 1


class TestSizes:
    def test_split_sizes_list_every_split(self, spark):
        rows = kpi.split_sizes(frame(spark, record(), record(split="test"))).collect()
        assert {r["split"]: r["n"] for r in rows} == {"train": 1, "validation": 0, "test": 1}

    def test_coverage(self, spark):
        row = kpi.image_coverage(frame(spark, record(image=True), record(), record())).first()
        assert (row["with_image"], row["total"], row["coverage"]) == (1, 3, 0.3333)
        assert kpi.image_coverage(frame(spark)).first()["coverage"] == 0.0

    def test_detail_ranking(self, spark):
        df = frame(spark, record(detail="b"), record(detail="a"), record(detail=None), record(detail="c"), record(detail="c"))
        rows = [(r["label_detail"], r["n"]) for r in kpi.label_detail_ranking(df).collect()]
        assert rows == [("c", 2), ("a", 1), ("b", 1), (None, 1)]


class TestAlerts:
    @pytest.mark.parametrize(
        ("value", "level"), [(0.149, "ok"), (0.15, "warn"), (0.30, "warn"), (0.301, "critical")]
    )
    def test_level(self, spark, value, level):
        df = spark.range(1).select(kpi.alert_level(F.lit(value), kpi.REJECTION_LEVELS))
        assert df.first()[0] == level

    def test_rejection_is_judged_by_source(self, spark):
        rows = kpi.rejection_alerts(rejection(spark, {"a": 10, "b": 10, "c": 10}, {"a": 10, "b": 8, "c": 5}))
        assert {r["source"]: r["level"] for r in rows.collect()} == {"a": "ok", "b": "warn", "c": "critical"}

    def test_leakage(self, spark):
        df = spark.createDataFrame([(0,), (1,)], "leakage bigint")
        assert [r["level"] for r in kpi.leakage_alert(df).collect()] == ["ok", "critical"]

    def test_image_failures(self, spark):
        df = spark.createDataFrame([(9, 1), (8, 3), (0, 0), (1, 1)], "downloaded bigint, failed bigint")
        assert [r["level"] for r in kpi.image_failure_alert(df).collect()] == ["warn", "critical", "ok", "critical"]

    def test_freshness(self, spark):
        runs = spark.createDataFrame(
            [("a", "2026-01-03 01:00:00"), ("a", "2026-01-01 00:00:00"), ("b", "2026-01-02 06:00:00"), ("c", "2026-01-01 00:00:00")],
            "source string, finished_at string",
        ).withColumn("finished_at", F.col("finished_at").cast("timestamp"))
        now = F.lit("2026-01-03 12:00:00").cast("timestamp")
        rows = kpi.freshness_alerts(runs, now).collect()
        assert {r["source"]: r["level"] for r in rows} == {"a": "ok", "b": "warn", "c": "critical"}

    def test_volume(self, spark):
        days = [("a", f"2026-01-{d:02d}", n) for d, n in ((1, 100), (2, 100), (3, 65), (4, 30), (5, 0), (20, 5))]
        df = spark.createDataFrame(days, "source string, day string, n bigint").withColumn("day", F.to_date("day"))
        rows = kpi.volume_alerts(df).orderBy("day").collect()
        assert [r["level"] for r in rows] == ["ok", "ok", "warn", "critical", *["critical"] * 15, "ok"]
        assert [r["days"] for r in rows] == [0, 1, 2, 3, 4, 5, 6, *[7] * 13]
        assert [r["n"] for r in rows] == [100, 100, 65, 30, *[0] * 15, 5]

    def test_a_source_that_falls_silent(self, spark):
        days = [("a", f"2026-01-{d:02d}", 10) for d in range(1, 11)] + [("b", f"2026-01-{d:02d}", 10) for d in (1, 2, 3)]
        df = spark.createDataFrame(days, "source string, day string, n bigint").withColumn("day", F.to_date("day"))
        silent = kpi.volume_alerts(df).where("source = 'b' AND n = 0")
        assert silent.count() == 7 and {r["level"] for r in silent.collect()} == {"critical"}
        later = kpi.volume_alerts(df, F.to_date(F.lit("2026-01-12"))).where("source = 'a' AND n = 0")
        assert later.count() == 2
        assert kpi.volume_alerts(df.limit(0)).count() == 0

    def test_durations(self, spark):
        runs = spark.createDataFrame(
            [("extract", 121), ("extract", 120), ("transform", 61), ("load", 9999), ("transform", None)], "stage string, s int"
        ).selectExpr("stage", "'x' AS source", "timestamp_seconds(0) AS started_at", "timestamp_seconds(s) AS finished_at")
        assert [r["alert"] for r in kpi.duration_alerts(runs).collect()] == [True, False, True, False, False]

    def test_run_checks(self, spark):
        records = spark.createDataFrame(
            [("u", "fake")] * 8 + [(None, "real")] * 2 + [(None, None)] * 2, "image_url string, label string"
        )
        rows = kpi.run_alerts(rejection(spark, {"a": 10}, {"a": 7}), records).collect()
        assert {r["check"]: r["alert"] for r in rows} == {
            "valid_rate": True,
            "image_coverage": True,
            "records_per_run": False,
            "label_balance": True,
        }


class TestReports:
    def test_data_card(self, spark):
        df = frame(spark, record(), record(source="guardian", label=None, split="test", image=True))
        card = report.data_card(stats.dataset_stats(df), stats.split_crosstab(df), "2026-01-01")
        assert "- Records: 2" in card and "| null | 1 |" in card
        assert "| train | 0 | 1 | 1 |" in card and "| validation | 0 | 0 | 0 |" in card
        assert "(2026-01-01)" in card

    def test_data_card_of_nothing(self, spark):
        df = frame(spark)
        assert "- Records: 0" in report.data_card(stats.dataset_stats(df), stats.split_crosstab(df))

    def test_kpi_report(self, spark):
        df = frame(spark, record(image=True), record(label=None, split="test"))
        kpis = {
            "stats": stats.dataset_stats(df),
            "rejection": rejection(spark, {"liar": 4}, {"liar": 2}),
            "image_coverage": kpi.image_coverage(df),
            "split_sizes": kpi.split_sizes(df),
            "leakage": kpi.leakage_count(df),
        }
        text = report.kpi_report(kpis)
        assert "| liar | 4 | 2 | 2 | 50% |" in text
        assert "50% (1/2)" in text and "more than one split: 1" in text
        assert "train 1, validation 0, test 1" in text
