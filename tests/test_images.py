from __future__ import annotations

from pathlib import Path
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from presswork.operators import images
from presswork.sources import bodies

RECORDS = "id string, source string, image_url string, metadata struct<source_credibility:string,has_image:boolean,label_method:string>, split string"


def records(spark, *rows):
    return spark.createDataFrame(
        [(i, "guardian", u, ("high", flag, "human_expert"), "train") for i, u, flag in rows], RECORDS
    )


def responses(spark, *rows):
    return spark.createDataFrame(list(rows), images.RESPONSE)


def outcome(spark, rows, answers):
    out = images.image_outcomes(records(spark, *rows), responses(spark, *answers)).collect()
    return {r["id"]: (r["outcome"], r["metadata"]["has_image"], r["image_path"]) for r in out}


URLS = [
    "https://pictures.example.net/",
    "https://pictures.example.net/ferry/17.gif",
    "https://pictures.example.net/ferry-17",
    "https://cdn/a.b/photo",
    "https://cdn/photo.PNG?x=.gif",
    "https://cdn/photo.webp#f.gif",
    "https://cdn/photo.jpeg;v=1.png",
    "https://cdn/.png",
    "https://cdn/photo.png/",
    "https://cdn.png",
    "https://cdn/photo.tiff",
    "photo.gif",
]


@pytest.mark.parametrize(
    "content_type", ["image/jpeg", " IMAGE/PNG ; q=1", "image/webp", "application/octet-stream", "image/avif", "", None]
)
def test_extension(spark, content_type):
    df = spark.createDataFrame([(content_type, u) for u in URLS], "t string, u string")
    got = [r[0] for r in df.select(images.image_extension(F.col("t"), F.col("u"))).collect()]
    kind = (content_type or "").split(";")[0].strip().lower()
    for url, extension in zip(URLS, got, strict=True):
        suffix = Path(urlparse(url).path).suffix.lower()
        by_url = suffix if suffix in images.URL_EXTENSIONS else images.DEFAULT_EXTENSION
        assert extension == images.MEDIA_EXTENSIONS.get(kind, by_url), url


class TestOutcomes:
    def test_downloaded(self, spark):
        got = outcome(spark, [("abc", "https://cdn/x", False)], [("https://cdn/x", "image/png", b"x")])
        assert got == {"abc": ("downloaded", True, "abc.png")}

    def test_missing_response(self, spark):
        assert outcome(spark, [("abc", "https://cdn/x", True)], []) == {"abc": ("failed", False, None)}

    @pytest.mark.parametrize(("kind", "body"), [("text/html", b"<html>"), ("image/png", b""), (None, b"x"), ("image/png", None)])
    def test_not_an_image(self, spark, kind, body):
        got = outcome(spark, [("abc", "https://cdn/x", True)], [("https://cdn/x", kind, body)])
        assert got == {"abc": ("failed", False, None)}

    def test_without_address_is_skipped_untouched(self, spark):
        got = outcome(spark, [("a", None, True), ("b", "", False)], [("", "image/png", b"x")])
        assert got == {"a": ("skipped", True, None), "b": ("skipped", False, None)}

    def test_repeated_addresses_do_not_multiply_rows(self, spark):
        rows = [(f"r{i}", "https://cdn/x" if i % 3 == 0 else None, True) for i in range(60)]
        answers = [("https://cdn/x", "image/png", b"x")] * 4
        got = outcome(spark, rows, answers)
        assert len(got) == 60 and sum(o == "downloaded" for o, *_ in got.values()) == 20

    def test_hot_address_is_split(self, spark):
        settings = {
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        }
        many = spark.range(60000).selectExpr(
            "CAST(id AS STRING) AS id",
            "'guardian' AS source",
            "CASE WHEN id % 3 = 0 THEN 'https://cdn/x' WHEN id % 3 = 1 THEN concat('https://cdn/', id) END AS image_url",
            "named_struct('source_credibility', 'high', 'has_image', true, 'label_method', 'human_expert') AS metadata",
        ).repartition(12)
        for key, value in settings.items():
            spark.conf.set(key, value)
        try:
            out = images.image_outcomes(many, responses(spark, ("https://cdn/x", "image/png", b"x")))
            counts = {r["outcome"]: r["n"] for r in out.groupBy("outcome").agg(F.count("*").alias("n")).collect()}
            out.write.format("noop").mode("overwrite").save()
            out.collect()
            plan = out._jdf.queryExecution().executedPlan().toString()
        finally:
            for key in settings:
                spark.conf.unset(key)
        assert counts == {"downloaded": 20000, "failed": 20000, "skipped": 20000}
        assert "SortMergeJoin(skew=true)" in plan

    def test_summary(self, spark):
        rows = [("a", "https://cdn/x", True), ("b", "https://cdn/y", True), ("c", None, False)]
        out = images.image_outcomes(records(spark, *rows), responses(spark, ("https://cdn/x", "image/png", b"x")))
        got = {r["split"]: tuple(r)[1:] for r in images.image_summary(out).collect()}
        assert got == {"train": (1, 1, 1, 3, False), None: (1, 1, 1, 3, True)}

    def test_bodies_are_not_shuffled(self, spark, tmp_path):
        responses(spark, ("https://cdn/x", "image/png", b"x")).write.parquet(str(tmp_path / "r"))
        facts = images.response_facts(spark.read.parquet(str(tmp_path / "r")))
        plan = facts._jdf.queryExecution().executedPlan().toString()
        assert "body" not in plan[: plan.index("Project [url")]


def test_fetcher(spark):
    def fetch(url):
        return None if "bad" in url else (b"\xff\xd8", "image/jpeg")

    rows = [("a", "https://cdn/ok", True), ("b", "https://cdn/ok", True), ("c", "https://cdn/bad", True), ("d", None, False)]
    got = images.fetch_responses(records(spark, *rows), fetch).collect()
    assert [(r["url"], r["content_type"], bytes(r["body"])) for r in got] == [("https://cdn/ok", "image/jpeg", b"\xff\xd8")]


class TestFetch:
    def test_hosts_are_paced_and_bodies_leave_by_bytes(self, spark):
        class Clock:
            now = 0.0

        def sleep(seconds):
            Clock.now += seconds

        asked = []

        def fetch(url):
            asked.append((Clock.now, url))
            return None if url.endswith("7") else (b"x" * 100, "image/png")

        urls = [f"https://{host}.example.net/{k}" for k in range(10) for host in ("a", "b")]
        pacer = images.Pacer(1.0, lambda: Clock.now, sleep)
        for url in urls:
            pacer.wait(url.split("/")[2])
            fetch(url)
        per_host = {}
        for at, url in asked:
            per_host.setdefault(url.split("/")[2], []).append(at)
        assert all(b - a >= 1.0 for times in per_host.values() for a, b in zip(times, times[1:], strict=False))
        assert Clock.now == 9.0  # the hosts take turns

    def test_each_address_once(self, spark):
        def fetch(url):
            return None if url.endswith("7") else (url.encode(), "image/png")

        rows = [(str(k), f"https://h{k % 3}.example.net/{k % 20}", True) for k in range(60)] + [("x", None, True), ("y", "", True)]
        found = images.fetch_responses(records(spark, *rows), fetch, pause=0.0, held_bytes=50).collect()
        expected = {u for _, u, _ in rows if u and not u.endswith("7")}
        assert {r["url"] for r in found} == expected and len(found) == len(expected)
        assert all(bytes(r["body"]).decode() == r["url"] for r in found)

    def test_hosts(self, spark):
        urls = ["https://A.example.net:8080/x", "http://user@b.example.net?q", "c.png", "ftp://d/"]
        df = spark.createDataFrame([(u,) for u in urls], "u string").select(images.host_of(F.col("u")).alias("h"))
        assert [r["h"] for r in df.collect()] == ["a.example.net", "b.example.net", "", "d"]


class TestBodies:
    def test_good_bodies_are_written_under_the_record(self, spark, tmp_path):
        rows = [("1", "u/a.png", True), ("2", "u/b.png", True), ("3", "u/a.png", True), ("4", None, False), ("5", "u/c", True)]
        answers = [
            ("u/a.png", "text/html", b"no"), ("u/a.png", "image/png", b"yes"), ("u/a.png", "image/png", b"yes"),
            ("u/b.png", "image/gif", b"gif"), ("u/c", "image/png", b""),
        ]
        answered = responses(spark, *answers)
        outcomes = images.image_outcomes(records(spark, *rows), answered)
        target = tmp_path / "images"
        bodies.write_bodies(images.image_bodies(outcomes, answered), str(target))
        assert {p.name: p.read_bytes() for p in target.iterdir()} == {"1.png": b"yes", "2.gif": b"gif", "3.png": b"yes"}
        bodies.write_bodies(spark.createDataFrame([("9.png", None)], "name string, body binary"), str(target))
        assert {p.name: p.read_bytes() for p in target.iterdir()} == {"9.png": b""}
        assert [p.name for p in tmp_path.iterdir()] == ["images"]

    def test_a_failed_job_leaves_nothing(self, spark, tmp_path):
        rows = [(f"{k}.png" if k != 150 else "../x", b"b") for k in range(200)]
        df = spark.createDataFrame(rows, "name string, body binary").repartition(4)
        with pytest.raises(Exception, match="not a file name"):
            bodies.write_bodies(df, str(tmp_path / "images"))
        assert list(tmp_path.iterdir()) == []
