from __future__ import annotations

import html
import random
import sys
import unicodedata

import pytest
from pyspark.sql import functions as F

from presswork.functions import columns, markup, text


def parsed(raw: str) -> str:
    """The parser alone, without any of the shortcuts."""
    nodes = markup.MarkupReader().read(html.unescape(raw)).nodes
    return " ".join(unicodedata.normalize("NFKC", " ".join(nodes)).split())


def sanitize(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, t string")
    rows = text.with_clean_text(df, clean="t").select("i", "clean").collect()
    return [r["clean"] for r in sorted(rows, key=lambda r: r["i"])]


CASES = {
    "<p>Hello <b>world</b></p>": "Hello world",
    "Bread &amp; butter": "Bread & butter",
    "a\n\n  b\t c": "a b c",
    "ﬁle": "file",
    "": "",
    "   ": "",
    "&lt;b&gt;bold&lt;/b&gt;": "bold",
    "&amp;lt;b&amp;gt;": "<b>",
    "3<4": "3<4",
    "foo<b>bar</b>baz": "foo bar baz",
    "a<!-- note -->b": "a b",
    "<script>var x = '</p>';</script>kept": "kept",
    "<style>p{}</style>kept": "kept",
    "<template>gone<b>too</b></template>kept": "kept",
    "<title>T</title>kept": "T kept",
    "one&nbsp;two": "one two",
    "<a href='x?a=1&b=2'>link</a>": "link",
    "<img alt=\"1 > 0\">after": "after",
    " wide space　": "wide space",
}


def test_sanitize_cases(spark):
    assert sanitize(spark, [*CASES, None]) == [*CASES.values(), ""]


def test_shortcuts_agree_with_the_parser(spark):
    rng = random.Random(5)
    pieces = (
        "<p>|</p>|<b>|<br/>|<!-- c -->|<!-- a-b -->|<!-- <b> -->|<!--x--y-->|<!doctype html>|<script>|"
        "</script>|<script>a='</p>'<1;</script>|<style>p{}</style>|<title>|</title>|<title>T</title>|"
        '<a href="x?a=1&b=2">|<a href=x>|<img alt="a>b">|&amp;|&lt;|&gt;|&quot;|&nbsp;|&copy|&copy;|&#39;|'
        "&#x3c;|&amp;lt;|&|<|>| |\n|é|ﬁ|x|AT&T|<template>|</template>|<rt>|</rt>|<textarea>|</textarea>|"
        "<?pi?>|<![CDATA[z]]>|3<4|--|->|<p|<script/>| |“|’|…|ｶ"
    ).split("|")
    cases = ["".join(rng.choices(pieces, k=rng.randint(1, 9))) for _ in range(8000)]
    expected = [parsed(c) for c in cases]
    assert [markup.visible_text(c) for c in cases] == expected
    assert sanitize(spark, cases) == expected


def test_long_markup_does_not_overflow(spark):
    cases = [
        "<p>" * 100_000,
        "<!--" + "-a" * 50_000 + "-->",
        "<a" + ' b="c"' * 20_000 + ">x",
        '<a href="' + "&x" * 50_000 + '">k</a>',
        "é " * 200_000,
    ]
    assert sanitize(spark, cases) == [parsed(c) for c in cases]


def test_stable_characters_are_left_alone_by_nfkc(spark):
    letters = [chr(c) for c in range(0x80, 0x3000) if unicodedata.category(chr(c)) != "Cs"]
    df = spark.createDataFrame([(c,) for c in letters], "c string")
    stable = [r["c"] for r in df.where(~F.col("c").rlike(text._UNSTABLE)).collect()]
    assert "é" in stable and " " not in stable and "́" not in stable
    assert all(unicodedata.normalize("NFKC", a + b) == a + b for a in stable for b in stable)


def test_spaces_are_those_of_python():
    assert set(columns.SPACES) == {c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace()}


@pytest.mark.parametrize("value", ["", " X\t", " Straße\x1c", None, "École"])
def test_content_key(spark, value):
    import hashlib

    df = spark.createDataFrame([(value,)], "content string").select(columns.content_key())
    expected = hashlib.sha256((value or "").strip().lower().encode()).hexdigest()
    assert df.first()[0] == expected


def test_stable_uuid_is_uuid_shaped(spark):
    import uuid

    df = spark.createDataFrame([("a",), ("b",)], "id string").selectExpr(columns.stable_uuid("liar", "id"))
    values = [r[0] for r in df.collect()]
    assert len(set(values)) == 2
    assert [str(uuid.UUID(v)) for v in values] == values
