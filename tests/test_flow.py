"""The stages end to end on small files."""

from __future__ import annotations

import json
from datetime import UTC, datetime

import pytest

from presswork import schemas as S
from presswork.operators.publish import read_current
from presswork.plans import flow, report
from presswork.sources import readers

AT = datetime(2026, 5, 15, tzinfo=UTC)


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    """Ingest all four sources, transform, build and attach images once."""
    root = tmp_path_factory.mktemp("run")
    raw, unified = str(root / "raw"), str(root / "unified")
    header = "\t".join(S.RAW_POST.fieldNames())

    def post(i, url):
        values = {"id": f"p{i}", "clean_title": f"Post {i}", "image_url": url, "2_way_label": str(i % 2)}
        return "\t".join(values.get(n, "0") for n in S.RAW_POST.fieldNames())

    lines = [header, *[post(i, f"https://img/{i}") for i in range(20)], post(3, "https://img/dup"), post(99, "")]
    flow.ingest_posts(spark, write(root / "posts.tsv", "\n".join(lines)), raw)

    results = [
        {"id": f"n{i}", "type": "article", "webTitle": f"News {i}", "fields": {"body": f"<p>Body {i}</p>", "thumbnail": t}}
        for i, t in enumerate(["https://img/n0", None, "bad-url"])
    ]
    payload = {"response": {"currentPage": 1, "pages": 1, "total": 3, "results": results}}
    flow.ingest_news(spark, write(root / "news" / "1.json", json.dumps(payload)), raw)

    items = "".join(f"<item><title>Feed {i}</title><link>https://claims/{i}</link></item>" for i in range(3))
    feed = write(root / "feed.xml", f"<rss><channel>{items}</channel></rss>")
    review = '<script type="application/ld+json">{"@type":"ClaimReview","claimReviewed":"Claim","reviewRating":{"alternateName":"False"}}</script>'
    pages = spark.createDataFrame([("https://claims/0", review), ("https://claims/1", "<h1>Story</h1>")], "url string, html string")
    flow.ingest_claims(spark, feed, pages, raw)

    def statement(i):
        return "\t".join([f"s{i}", "half-true", f"Statement {i}", *[""] * 11])

    write(root / "statements" / "train.tsv", "\n".join(statement(i) for i in range(8)))
    write(root / "statements" / "test.tsv", statement(8))
    flow.ingest_statements(spark, str(root / "statements"), raw, limit=8)

    written = flow.transform(spark, raw, unified, collected_at=AT)
    dataset, corrected = str(root / "dataset"), str(root / "dataset-images")
    stats = flow.build_dataset(spark, unified, dataset)
    stats_rows = {(r["metric"], r["value"]): r["n"] for r in stats.collect()}
    responses = spark.createDataFrame([("https://img/1", "image/png", 5), ("https://img/2", "text/html", 5)], "url string, content_type string, body_length int")
    summary = flow.acquire_images(spark, dataset, responses, corrected)
    return {
        "raw": raw,
        "unified": unified,
        "dataset": dataset,
        "corrected": corrected,
        "written": written,
        "stats": stats_rows,
        "summary": {r["split"]: r for r in summary.collect()},
        "root": root,
    }


def test_counts(run):
    # 20 posts, one news article with a usable image, one claim with a verdict, eight statements
    assert run["written"] == 30
    assert run["stats"][("total", None)] == 30
    assert {k[1]: v for k, v in run["stats"].items() if k[0] == "by_source"} == {
        "fakeddit": 20,
        "guardian": 1,
        "snopes": 1,
        "liar": 8,
    }


def test_kpis(spark, run):
    kpis = flow.compute_kpis(spark, run["raw"], run["unified"], run["corrected"])
    rows = {r["source"]: (r["raw"], r["valid"], r["rejected"]) for r in kpis["rejection"].collect()}
    assert rows == {"fakeddit": (21, 20, 1), "guardian": (2, 1, 1), "snopes": (2, 1, 1), "liar": (8, 8, 0)}
    assert kpis["leakage"].first()["leakage"] == 0
    assert sum(r["n"] for r in kpis["split_sizes"].collect()) == 30
    assert kpis["image_coverage"].first()["with_image"] == 1
    text = report.kpi_report(kpis)
    assert "| liar | 8 | 8 | 0 | 0% |" in text
    assert "- Records: 30" in report.data_card(kpis["stats"], kpis["split_crosstab"])


def test_images(spark, run):
    total = run["summary"][None]
    assert (total["downloaded"], total["failed"], total["skipped"], total["total"]) == (1, 20, 9, 30)
    flags = readers.read_splits(spark, run["corrected"]).where("metadata.has_image").collect()
    assert [r["image_url"] for r in flags] == ["https://img/1"]
    with pytest.raises(ValueError, match="path of its own"):
        flow.acquire_images(spark, run["dataset"], spark.range(0), run["dataset"] + "/")


def test_load(spark, run):
    target = str(run["root"] / "articles")
    assert flow.load_articles(spark, run["corrected"], target) == 30
    assert flow.load_articles(spark, run["corrected"], target) == 30
    table = read_current(spark, target)
    assert table.count() == 30 and table.select("id").distinct().count() == 30


def test_rerun_gives_the_same_ids_and_splits(spark, run, tmp_path):
    again = str(tmp_path / "unified")
    flow.transform(spark, run["raw"], again, collected_at=AT, fmt="json")
    flow.build_dataset(spark, again, str(tmp_path / "d"), unified_fmt="json")
    first, second = (
        {r["id"]: r["split"] for r in readers.read_splits(spark, p).collect()} for p in (run["dataset"], str(tmp_path / "d"))
    )
    assert first == second


def test_kpis_before_splits_exist(spark, run, tmp_path):
    kpis = flow.compute_kpis(spark, run["raw"], run["unified"], str(tmp_path / "none"))
    assert kpis["image_coverage"].first()["total"] == 30
    assert sum(r["n"] for r in kpis["split_sizes"].collect()) == 0
    assert kpis["leakage"].first()["leakage"] == 0


def test_nothing_to_do(spark, tmp_path):
    assert flow.transform(spark, str(tmp_path), str(tmp_path / "u")) == 0
    with pytest.raises(FileNotFoundError):
        flow.build_dataset(spark, str(tmp_path / "u"), str(tmp_path / "d"))
    kpis = flow.compute_kpis(spark, str(tmp_path), str(tmp_path / "u"), str(tmp_path / "d"))
    assert kpis["image_coverage"].first()["total"] == 0
    assert {r["raw"] for r in kpis["rejection"].collect()} == {0}
