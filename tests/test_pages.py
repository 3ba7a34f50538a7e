from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from presswork.functions import markup
from presswork.operators import pages


def script(value, kind='type="application/ld+json"'):
    text = value if isinstance(value, str) else json.dumps(value)
    return f"<script {kind}>{text}</script>"


REVIEW = {
    "@type": "ClaimReview",
    "claimReviewed": "C",
    "reviewRating": {"alternateName": "False", "ratingValue": "1"},
}
OTHER = {**REVIEW, "claimReviewed": "D"}
FOUND = ("False", "C", "1", True, False)
NOTHING = (None, None, None, False, False)


def rated(**rating):
    return {**REVIEW, "reviewRating": rating}


REVIEWS = [
    (script(REVIEW), FOUND),
    (script([{"@type": "Person"}, REVIEW, OTHER]), FOUND),
    (script({"@graph": [{"@type": "WebPage"}, REVIEW]}), FOUND),
    (script({"@graph": REVIEW}), FOUND),
    (script({"@type": "WebPage"}) + script(REVIEW), FOUND),
    (script("{not json") + script(REVIEW), FOUND),
    (script("") + script(REVIEW), FOUND),
    (script([[REVIEW], OTHER]), FOUND),
    (script({"@graph": [{"@graph": [REVIEW]}, OTHER]}), FOUND),
    (script([{"@graph": [[REVIEW]]}, OTHER]), FOUND),
    (script(REVIEW, "type='application/ld+json' id=x"), FOUND),
    (script(REVIEW, "id=x type=application/ld+json"), FOUND),
    (script(REVIEW, 'type="application/json"'), NOTHING),
    (script(REVIEW, 'type="application/LD+json"'), NOTHING),
    ("<!-- " + script(REVIEW) + " -->", NOTHING),
    (script("var a = '<!--';", "") + script(REVIEW), FOUND),
    (script({**REVIEW, "@type": ["ClaimReview"]}), NOTHING),
    (script("[1, \"x\", null]"), NOTHING),
    (script('{"@type": "ClaimReview", "a": 1, "a": 2, "claimReviewed": "C"}'), (None, "C", None, True, False)),
    (script({k: v for k, v in REVIEW.items() if k != "reviewRating"}), (None, "C", None, True, False)),
    (script(rated(ratingValue="5")), ("5", "C", "5", True, False)),
    (script(rated(alternateName="", ratingValue="5")), ("5", "C", "5", True, False)),
    (script(rated(alternateName=None, ratingValue=5)), ("5", "C", "5", True, False)),
    (script(rated(ratingValue=0)), (None, "C", "0", True, False)),
    (script(rated(ratingValue=4.0)), ("4.0", "C", "4.0", True, False)),
    (script(rated()), (None, "C", None, True, False)),
    (script({**REVIEW, "reviewRating": None}), (None, None, None, True, True)),
    (script({**REVIEW, "reviewRating": ["x"]}), (None, None, None, True, True)),
    (script({**REVIEW, "reviewRating": "x"}), (None, None, None, True, True)),
    (script("[" * 5000), NOTHING),
    ("<p>application/ld+json</p>", NOTHING),
    ("", NOTHING),
]


def test_reviews(spark):
    df = spark.createDataFrame([(i, h) for i, (h, _) in enumerate(REVIEWS)], "i int, html string")
    rows = {r["i"]: r["review"] for r in pages.with_review(df.repartition(3)).collect()}
    for i, (markup_text, expected) in enumerate(REVIEWS):
        got = rows[i]
        if got["failed"]:
            assert expected[3:] == (True, True), markup_text
        else:
            assert tuple(got) == expected, markup_text


def test_plain_pages_do_not_reach_python(spark):
    calls = [(i, script([{"@type": "Person"}, REVIEW])) for i in range(5)]
    df = spark.createDataFrame(calls, "i int, html string")
    staged = pages.with_review(df)
    assert staged.where("review.found").count() == 5


META = [
    ('<meta property="og:title" content="OG"><h1>H</h1>', ("OG", None, None)),
    ("<meta content='A &amp; B' property='og:title'>", ("A & B", None, None)),
    ('<meta property="og:title" content=""><h1> H <b>x</b> &lt;1 </h1>', ("Hx<1", None, None)),
    ('<meta property="og:title"><h1>H</h1>', ("H", None, None)),
    ('<meta property="og:titles" content="no"><h1>H</h1>', ("H", None, None)),
    ('<!-- <meta property="og:title" content="no"> --><h1 class="a">H</h1>', ("H", None, None)),
    ("<script>'<meta property=\"og:title\" content=\"no\">'</script>", ("", None, None)),
    ('<meta property="og:image" content="https://x/y.png?a=1&amp;b=2">', ("", "https://x/y.png?a=1&b=2", None)),
    ('<META NAME="description" CONTENT="a > b">', ("", None, "a > b")),
    ('<meta property="og:image" content="">', ("", "", None)),
    ('<meta property="og:title" content="first"><meta property="og:title" content="second">', ("first", None, None)),
    ("<p>none</p>", ("", None, None)),
]


def test_page_meta(spark):
    df = spark.createDataFrame([(i, h) for i, (h, _) in enumerate(META)], "page_id int, html string")
    rows = {r["page_id"]: tuple(r)[1:] for r in pages.page_meta(df).collect()}
    assert rows == {i: expected for i, (_, expected) in enumerate(META)}


RATINGS = [
    ('<div class="rating-label">Unproven</div><p class="claim">K</p>', ("Unproven", "K")),
    ('<i class="star-rating">3</i><div class="x rating-label-text"> <b>Mostly</b> True </div>', ("MostlyTrue", None)),
    ('<i class="star-rating">3</i>', ("3", None)),
    ('<p class="claim">a</p><p class="claim-text">b <script>no</script></p>', (None, "b")),
    ('<p class="claims">a</p><p id="rating">b</p>', (None, None)),
    ('<img class="rating" alt="x">text', ("", None)),
    ('<div class="claim"><p>one<div>two</div></div>three', (None, "onetwo")),
    ('<div class="claim">open to the end', (None, "open to the end")),
    ("<p>rating and claim in text</p>", (None, None)),
]


def test_fallback(spark):
    df = spark.createDataFrame([(i, h) for i, (h, _) in enumerate(RATINGS)], "page_id int, html string")
    rows = {r["page_id"]: (r["verdict"], r["claim"]) for r in pages.css_fallback(df).collect()}
    assert rows == {i: expected for i, (_, expected) in enumerate(RATINGS)}
    assert markup.rating_and_claim("")["verdict"] is None


@pytest.fixture(scope="module")
def feed(spark):
    rows = [(f"u{i}", f"Feed {i}", "today", "s") for i in range(5)]
    return spark.createDataFrame(rows, "link string, title string, pubDate string, description string")


@pytest.fixture(scope="module")
def fetched(spark):
    broken = script({**REVIEW, "reviewRating": None})
    rows = [("u0", script(REVIEW)), ("u1", broken), ("u2", RATINGS[0][0]), ("u3", "<p></p>"), ("zz", "")]
    return spark.createDataFrame(rows, "url string, html string")


def test_feed_claims(spark, feed, fetched):
    rows = {r["url"]: r for r in pages.feed_claims(feed, fetched, F.lit("2026-01-01").cast("timestamp")).collect()}
    assert set(rows) == {"u0", "u2", "u3"}
    assert (rows["u0"]["verdict"], rows["u0"]["extraction_method"]) == ("False", pages.STRUCTURED)
    assert (rows["u2"]["verdict"], rows["u2"]["extraction_method"]) == ("Unproven", pages.FALLBACK)
    assert rows["u3"]["verdict"] is None
    assert rows["u0"]["rss_title"] == "Feed 0"
    assert rows["u0"]["scraped_at"] == "2026-01-01T00:00:00Z"


def test_feed_counts(feed, fetched):
    row = pages.feed_counts(feed, fetched).first()
    assert (row["seen"], row["skipped"]) == (3, 2)


def test_a_quote_opens_a_value_only_after_an_equals_sign(spark):
    review = script(REVIEW, """data-x=it's type="application/ld+json\"""")
    html = [
        "<h1 data-x=it's>Head</h1><p>they don't know</p>" + review + "<p>it's</p>",
        "<h1 title='a > b' data-y=5\">Head</h1>" + script(REVIEW, "title='x>y' type='application/ld+json'"),
        "<h1 'odd>Head</h1><p>'</p>" + script(REVIEW, "type=application/ld+json async"),
    ]
    df = spark.createDataFrame(list(enumerate(html)), "page_id long, html string")
    assert [r["title"] for r in pages.page_meta(df).collect()] == ["Head"] * 3
    assert pages.claim_reviews(df).count() == 3


def test_attributes_are_read_as_a_whole(spark):
    metas = [
        """<meta content="property='og:title'" property="og:image">""",
        """<meta data-content="no" property="og:title" content="yes" content="again">""",
        """<meta property = og:title content = plain/x >""",
        """<meta title="content='no' > property='x'" PROPERTY='og:title' content="it's > that">""",
    ]
    df = spark.createDataFrame(list(enumerate(metas)), "page_id long, html string")
    rows = pages.page_meta(df).orderBy("page_id").collect()
    assert [r["title"] for r in rows] == ["", "yes", "plain/x", "it's > that"]
    assert rows[0]["image_url"] == "property='og:title'"


def test_long_tags_do_not_exhaust_the_stack(spark):
    tag = "<meta " + " ".join(f"a{k}='{k}'" for k in range(3000)) + ' property="og:title" content="T">'
    long_value = f'<meta content="{"x" * 300_000}" property="og:image">'
    df = spark.createDataFrame([(1, tag + long_value)], "page_id long, html string")
    row = pages.page_meta(df).first()
    assert row["title"] == "T" and len(row["image_url"]) == 300_000
