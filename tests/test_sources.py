"""Readers and sinks over files in a temporary folder."""

from __future__ import annotations

import json
import os
import random
from datetime import UTC, datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presswork import schemas as S
from presswork.operators import kpi
from presswork.operators.publish import flatten_articles, full_refresh, read_current
from presswork.session import materialize, scratch_root
from presswork.sources import ledger, readers, writers

AT = datetime(2026, 5, 15, tzinfo=UTC)
META = ("high", False, "human_expert")


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def post_line(**values):
    return "\t".join(values.get(n, "x") for n in S.RAW_POST.fieldNames())


class TestPosts:
    def read(self, spark, tmp_path, *lines):
        text = "\n".join(["\t".join(S.RAW_POST.fieldNames()), *lines]) + "\n"
        return readers.read_header_tsv(spark, write(tmp_path / "p.tsv", text), S.RAW_POST)

    def test_long_rows_are_skipped_and_short_rows_padded(self, spark, tmp_path):
        df = self.read(
            spark, tmp_path, post_line(id="a"), post_line(id="b") + "\textra", "c\tauthor", "", post_line(id="d")
        )
        rows = df.orderBy("_seq").collect()
        assert [r["id"] for r in rows] == ["a", "c", "d"]
        assert rows[1]["image_url"] is None and rows[1]["author"] == "author"

    def test_missing_value_words(self, spark, tmp_path):
        df = self.read(spark, tmp_path, *[post_line(id=f"i{i}", domain=w) for i, w in enumerate(readers.NA_WORDS)])
        assert {r["domain"] for r in df.collect()} == {None}
        df = self.read(spark, tmp_path, post_line(domain="none"), post_line(domain="nAn"))
        assert [r["domain"] for r in df.orderBy("_seq").collect()] == ["none", "nAn"]

    def test_quotes(self, spark, tmp_path):
        df = self.read(spark, tmp_path, post_line(clean_title='"a\tb ""c"""'), post_line(clean_title='say "hi"'))
        assert [r["clean_title"] for r in df.orderBy("_seq").collect()] == ['a\tb "c"', 'say "hi"']

    def test_any_column_alone_sees_long_rows(self, spark, tmp_path):
        df = self.read(spark, tmp_path, post_line(id="a"), post_line(id="b") + '\t"' + "y" * 100_000 + '"')
        assert df.count() == 1 and [r["id"] for r in df.select("id").collect()] == ["a"]

    @pytest.mark.parametrize("seed", range(4))
    def test_quoted_fields_over_many_blocks(self, spark, tmp_path, seed):
        """Equal to a single reader of the whole file, however the file is cut into blocks."""
        rng = random.Random(seed)
        names = ["a", "b", "c"]

        def field():
            inner = "".join(rng.choice(["x", "\t", "\n", '""', "yé", "\r\n", " "]) for _ in range(rng.choice([0, 3, 40])))
            plain = "".join(rng.choice("xyz ") for _ in range(rng.choice([1, 5, 30])))
            return rng.choice([plain, plain, plain + '"', f'"{inner}"', f'"{inner}"tail"', 'q"' + plain])

        lines = ["\t".join(names), "first\trow\there"]
        lines += ["\t".join(field() for _ in range(rng.choice([1, 2, 3, 3, 3, 4]))) for _ in range(300)]
        lines[100] = '"' + "long\n" * 200 + '"\tafter\tit'
        text = rng.choice(["\n", "\r\n"]).join(lines) + "\n"
        path = tmp_path / "r.tsv"
        path.write_bytes(text.encode())
        expected = pd.read_csv(path, sep="\t", dtype=str, on_bad_lines="skip")
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        before = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", rng.choice([100, 400, 3000]))
        try:
            found = readers.read_header_tsv(spark, str(path), schema).orderBy("_seq").collect()
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        wanted = [tuple(None if pd.isna(v) else v for v in row) for row in expected.itertuples(index=False)]
        assert [tuple(r)[:3] for r in found] == wanted

    def test_a_quote_without_an_end_is_an_error(self, spark, tmp_path):
        with pytest.raises(ValueError, match="p.tsv"):
            self.read(spark, tmp_path, post_line(id="a"), post_line(id='"b'))

    def test_only_posts_with_an_image(self, spark, tmp_path):
        text = "\n".join(
            ["\t".join(S.RAW_POST.fieldNames()), post_line(id="a"), post_line(id="b", image_url=""), post_line(id="c", image_url="NA")]
        )
        df = readers.read_posts(spark, write(tmp_path / "p.tsv", text))
        assert [r["id"] for r in df.collect()] == ["a"]


class TestStatements:
    def files(self, tmp_path):
        for name, ids in {"train.tsv": "ab", "valid.tsv": "c", "test.tsv": "d"}.items():
            lines = ["\t".join([i, "true", f'he said "{i}', *[""] * 11]) for i in ids]
            write(tmp_path / name, "\n".join(lines) + "\n")
        return str(tmp_path)

    def test_tagged_in_order(self, spark, tmp_path):
        rows = readers.read_statements(spark, self.files(tmp_path)).orderBy("_seq").collect()
        assert [(r["id"], r["split"]) for r in rows] == [
            ("a", "train"),
            ("b", "train"),
            ("c", "validation"),
            ("d", "test"),
        ]
        assert rows[0]["statement"] == 'he said "a' and rows[0]["context"] == ""

    def test_chosen_splits(self, spark, tmp_path):
        rows = readers.read_statements(spark, self.files(tmp_path), ("test",)).collect()
        assert [r["id"] for r in rows] == ["d"]


class TestJsonLines:
    SCHEMA = S.RAW_CLAIM

    def test_blank_lines_and_nan(self, spark, tmp_path):
        path = write(tmp_path / "c.jsonl", '{"url": "a", "verdict": NaN}\n\n{"url": "b", "verdict": "x"}\n')
        rows = readers.read_json_lines(spark, path, self.SCHEMA, nan_is_missing=True).orderBy("_seq").collect()
        assert [(r["url"], r["verdict"]) for r in rows] == [("a", None), ("b", "x")]

    def test_bad_line_is_fatal(self, spark, tmp_path):
        path = write(tmp_path / "c.jsonl", '{"url": "a"}\n{broken\n')
        with pytest.raises(Exception, match="[Mm]alformed"):
            readers.read_json_lines(spark, path, self.SCHEMA).collect()


class TestNewsPayloads:
    def landed(self, tmp_path, *pages, last=9):
        for number, ids in enumerate(pages, 1):
            results = [{"id": i, "type": "article", "webTitle": i, "fields": {"headline": i}} for i in ids]
            body = {"response": {"currentPage": number, "pages": last, "total": 9, "results": results}}
            write(tmp_path / f"page-{number}.json", json.dumps(body))
        return str(tmp_path)

    def ids(self, spark, path, **options):
        return [r["id"] for r in readers.read_news_payloads(spark, path, **options).orderBy("_seq").collect()]

    def test_pages_in_order(self, spark, tmp_path):
        assert self.ids(spark, self.landed(tmp_path, "ab", "c")) == ["a", "b", "c"]

    def test_stops_at_empty_page(self, spark, tmp_path):
        assert self.ids(spark, self.landed(tmp_path, "ab", "", "c")) == ["a", "b"]

    def test_stops_at_announced_and_allowed_page(self, spark, tmp_path):
        path = self.landed(tmp_path, "a", "b", "c", last=2)
        assert self.ids(spark, path) == ["a", "b"]
        assert self.ids(spark, path, max_pages=1) == ["a"]


def test_feed(spark, tmp_path):
    items = "".join(f"<item><title>T{i}</title><link>u{i}</link><pubDate>d</pubDate></item>" for i in range(4))
    path = write(tmp_path / "feed.xml", f"<rss><channel><title>F</title>{items}</channel></rss>")
    rows = readers.read_feed_items(spark, path, limit=3).collect()
    assert [(r["link"], r["title"], r["description"]) for r in rows] == [(f"u{i}", f"T{i}", None) for i in range(3)]


class TestBatches:
    def test_latest_folder_by_name(self, spark, tmp_path):
        for ts in ("20260102_000000", "20260103_000000", "20260101_000000"):
            write(tmp_path / "liar" / f"batch_ts={ts}" / "part.json", "{}")
        assert readers.latest_batch_path(spark, str(tmp_path), "liar").endswith("batch_ts=20260103_000000")
        assert readers.latest_batch_path(spark, str(tmp_path), "snopes") is None

    def test_latest_file_by_time(self, spark, tmp_path):
        for name, moment in (("a.jsonl", 100), ("b.jsonl", 50), ("c.txt", 900)):
            os.utime(write(tmp_path / "liar" / name, ""), (moment, moment))
        assert readers.latest_batch_path(spark, str(tmp_path), "liar").endswith("a.jsonl")

    def test_latest_rows_per_source(self, spark):
        rows = [("a", "1", 1), ("a", "2", 2), ("a", "2", 3), ("b", "1", 4), (None, "7", 5)]
        df = spark.createDataFrame(rows, "source string, batch_ts string, n int")
        assert sorted(r["n"] for r in readers.latest_batch(df).collect()) == [2, 3, 4, 5]

    def test_raw_batches_do_not_overwrite_each_other(self, spark, tmp_path):
        df = spark.createDataFrame([("u", None)], "url string, verdict string")
        first, n = writers.write_raw(df, str(tmp_path), "snopes", "1")
        second, _ = writers.write_raw(df, str(tmp_path), "snopes", "2")
        assert n == 1 and first != second
        assert writers.batch_id(datetime(2026, 1, 2, 3, 4, 5)) == "20260102_030405"


ARTICLES = T.StructType([*S.ARTICLE.fields, T.StructField("_seq", T.LongType())])


def articles(spark, n=3):
    rows = [(f"i{i}", "liar", "é", f"c{i}", None, None, "half-true", "en", "d", AT, META, i) for i in range(n)]
    return spark.createDataFrame(rows, ARTICLES)


class TestSinks:
    @pytest.mark.parametrize(("fmt", "kept"), [("json", False), ("parquet", True)])
    def test_unified(self, spark, tmp_path, fmt, kept):
        path, n = writers.write_unified(articles(spark), str(tmp_path), "1", fmt)
        assert n == 3
        back = spark.read.format(fmt).load(path)
        assert ("_seq" in back.columns) is kept
        assert set(S.ARTICLE.fieldNames()) <= set(back.columns)

    def test_json_has_explicit_nulls_and_plain_text(self, spark, tmp_path):
        path, _ = writers.write_unified(articles(spark, 1), str(tmp_path), "1", "json")
        line = spark.read.text(path).first()[0]
        assert '"image_url":null' in line and '"title":"é"' in line
        assert list(json.loads(line)) == S.ARTICLE.fieldNames()

    def test_unknown_columns_are_refused(self, spark, tmp_path):
        with pytest.raises(ValueError, match="extra"):
            writers.write_unified(articles(spark).withColumn("extra", F.lit(1)), str(tmp_path), "1")

    def test_splits_leave_the_rows(self, spark, tmp_path):
        df = articles(spark).withColumn("split", F.element_at(F.array(*map(F.lit, S.SPLITS)), F.col("_seq").cast("int") + 1))
        path = writers.write_splits(df, str(tmp_path / "d"))
        assert sorted(e for e in os.listdir(path) if e.startswith("split=")) == sorted(f"split={s}" for s in S.SPLITS)
        assert "split" not in json.loads(spark.read.text(f"{path}/split=test").first()[0])
        rows = {r["id"]: r["split"] for r in readers.read_splits(spark, path).collect()}
        assert rows == {"i0": "train", "i1": "validation", "i2": "test"}


class TestPublish:
    def test_columns(self, spark):
        flat = flatten_articles(articles(spark, 1).withColumn("split", F.lit("train")))
        assert tuple(flat.columns) == S.FLAT_COLUMNS
        row = flat.first()
        assert (row["split"], row["label"], row["label_detail"]) == ("train", None, "half-true")
        assert (row["source_credibility"], row["has_image"], row["label_method"]) == META

    def test_missing_metadata(self, spark):
        df = spark.createDataFrame([("x", "liar", "test")], "id string, source string, split string")
        row = flatten_articles(df).first()
        assert (row["split"], row["has_image"], row["source_credibility"], row["title"]) == ("test", None, None, None)

    def test_refresh_is_idempotent(self, spark, tmp_path):
        target = str(tmp_path / "t")
        df = articles(spark).withColumn("split", F.lit("train"))
        assert full_refresh(df, target) == 3
        assert full_refresh(df.limit(2), target) == 2
        back = read_current(spark, target)
        assert back.count() == 2 and back.where("loaded_at IS NULL").count() == 0

    def test_a_failed_refresh_leaves_the_old_rows(self, spark, tmp_path):
        target = str(tmp_path / "t")
        df = articles(spark).withColumn("split", F.lit("train"))
        with pytest.raises(FileNotFoundError):
            read_current(spark, target)
        full_refresh(df, target)
        broken = df.withColumn("title", F.raise_error(F.lit("lost")).cast("string"))
        with pytest.raises(Exception, match="lost"):
            full_refresh(broken, target)
        assert read_current(spark, target).count() == 3
        # The table may be one of the inputs of its own refresh, and old versions go.
        for _ in range(3):
            full_refresh(read_current(spark, target).drop("loaded_at"), target)
        assert read_current(spark, target).count() == 3
        assert sum(name.startswith("version=") for name in os.listdir(target)) == 2

    def test_runs_are_recorded(self, spark, tmp_path):
        book = str(tmp_path / "runs")
        with ledger.recorded(spark, book, "extract", "posts") as run:
            run.rows = 7
        with pytest.raises(KeyError), ledger.recorded(spark, book, "transform"):
            raise KeyError("x")
        rows = {r["stage"]: r for r in ledger.read_runs(spark, book).collect()}
        assert (rows["extract"]["rows"], rows["extract"]["ok"], rows["extract"]["source"]) == (7, True, "posts")
        assert (rows["transform"]["rows"], rows["transform"]["ok"]) == (None, False)
        assert kpi.duration_alerts(ledger.read_runs(spark, book)).where("alert").count() == 0


class _Session:
    """Stands in for a session with the given settings."""

    def __init__(self, **settings):
        self.conf = self
        self.settings = settings

    def get(self, key, default=None):
        return self.settings.get(key, default)


class TestScratch:
    def test_written_table_is_read_back(self, spark):
        df = materialize(spark.range(5), "numbers")
        assert df.count() == 5
        assert scratch_root(spark) in df.inputFiles()[0]

    def test_configured_folder_wins(self):
        settings = {"spark.checkpoint.dir": "hdfs:///shared/", "spark.master": "yarn"}
        assert scratch_root(_Session(**settings)) == "hdfs:///shared"

    def test_cluster_needs_a_shared_folder(self):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            scratch_root(_Session(**{"spark.master": "yarn"}))
