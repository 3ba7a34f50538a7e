"""Fact-check pages: structured review data, page metadata and the class-name fallback.

The scan over whole pages uses built-in regular expressions and the VARIANT type. Python sees
only JSON-LD that is nested deeper than the built-in form opens or that Spark's parser refuses,
short values that hold character references, and pages without a structured review.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.functions.columns import quote, stripped
from presswork.functions.markup import element_text_udf, rating_udf, review_udf, unescape_udf
from presswork.operators.dedup import keep_first_in_place

# --- Fixed values -----------------------------------------------------------------------------
JSONLD_TYPE = "application/ld+json"
REVIEW_TYPE = "ClaimReview"
STRUCTURED = "claim_review_jsonld"
FALLBACK = "css_fallback"
# ----------------------------------------------------------------------------------------------

# Comments and scripts in document order: whichever opens first swallows the other.
# A tag goes on past a ">" within a quoted value. A quote opens a value only after "=", any other
# one, and one without a partner, is an ordinary character.
_IN_TAG = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')|=)*+"""
_COMMENT_OR_SCRIPT = rf"(?is)<!--.*?-->|<script\b{_IN_TAG}>.*?</script\s*>"
_COMMENT_OR_RAW_TEXT = rf"(?is)<!--.*?-->|<(script|style)\b{_IN_TAG}>.*?</\1\s*>"
_SCRIPT_BODY = rf"(?is)^<script\b{_IN_TAG}>(.*)</script\s*>$"
_META_TAG = rf"(?is)<meta\b{_IN_TAG}>"
_HEADING = rf"(?is)<h1\b{_IN_TAG}>(.*?)(?:</h1\s*>|\z)"


# An attribute, and those of a tag before the first of a name. A value ends with its own quote, or
# with white space where it has none.
_ATTRIBUTE = r"""[^\s>/=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|(?!["'])[^\s>]++)?+)?+"""


def _attribute_pattern(name: str) -> str:
    named = rf"(?i:{name})(?=[\s=/>])"
    earlier = rf"(?:[\s/]++(?!{named}){_ATTRIBUTE})*+"
    value = r"""(?:"([^"]*+)"|'([^']*+)'|((?!["'])[^\s>]++))"""
    return rf"^<[^\s/>]++{earlier}[\s/]++(?i:{name})\s*+=\s*+{value}"


def _attribute(tag: str, name: str) -> str:
    """SQL: value of a tag's attribute as written, NULL when the tag does not have it."""
    pattern = quote(_attribute_pattern(name))
    groups = ", ".join(f"regexp_extract({tag}, {pattern}, {i})" for i in (1, 2, 3))
    return f"CASE WHEN rlike({tag}, {pattern}) THEN concat({groups}) END"


def _attribute_is(tag: str, name: str, value: str) -> str:
    """SQL: the tag has the attribute with exactly this value."""
    return f"coalesce({_attribute(tag, name)} = {quote(value)}, false)"


def jsonld_block_array(html: str = "html") -> str:
    """SQL: bodies of the page's JSON-LD scripts in document order; blank ones are left out.

    Most pages without structured data are told apart by one substring search.
    """
    tokens = f"regexp_extract_all({html}, {quote(_COMMENT_OR_SCRIPT)}, 0)"
    scripts = f"filter({tokens}, t -> t NOT LIKE '<!--%' AND {_attribute_is('t', 'type', JSONLD_TYPE)})"
    bodies = f"transform({scripts}, t -> regexp_extract(t, {quote(_SCRIPT_BODY)}, 1))"
    filled = f"filter({bodies}, b -> rlike(b, {quote(chr(92) + 'S')}))"
    return f"CASE WHEN contains({html}, {quote(JSONLD_TYPE)}) THEN {filled} ELSE array() END"


def jsonld_blocks(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """One row per JSON-LD block: key, position, text, and whether it is valid JSON."""
    return pages.selectExpr(key, f"posexplode({jsonld_block_array()}) AS (pos, block)").selectExpr(
        key, "pos", "block", "try_parse_json(block) IS NOT NULL AS is_json"
    )


def _as_list(node: str) -> str:
    return f"try_variant_get({node}, '$', 'array<variant>')"


def _members(node: str) -> str:
    """SQL: elements of a JSON list, or the value itself as the only element."""
    return f"coalesce({_as_list(node)}, array({node}))"


def _field(node: str, name: str, kind: str = "variant") -> str:
    path = f'$["{name}"]'
    return f"try_variant_get({node}, {quote(path)}, '{kind}')"


def _graph(node: str) -> str:
    inner = _field(node, "@graph")
    none = "CAST(array() AS array<variant>)"
    return f"CASE WHEN {inner} IS NOT NULL THEN {_members(inner)} ELSE {none} END"


def _is_text(value: str) -> str:
    """SQL: the JSON value is a string, null or absent."""
    return f"coalesce(schema_of_variant({value}) IN ('STRING', 'VOID'), true)"


def with_review(pages: DataFrame) -> DataFrame:
    """Add ``review``: the first ClaimReview of the page, if any.

    One list level and one ``@graph`` level are opened by built-in functions. Pages with deeper
    nesting, JSON that Spark's parser refuses, or a rating that is not text go to Python as a
    whole, because any of their blocks may come first.
    """
    alternate = _field("_rating", "alternateName")
    value = _field("_rating", "ratingValue")
    claim = _field("_review", "claimReviewed")
    deep_graph = f"{_as_list('g')} IS NOT NULL OR {_field('g', '@graph')} IS NOT NULL"
    hard = " OR ".join(
        [
            "exists(_parsed, p -> p IS NULL)",
            f"exists(_top, n -> {_as_list('n')} IS NOT NULL)",
            f"exists(_top, n -> exists({_graph('n')}, g -> {deep_graph}))",
            *[f"NOT {_is_text(leaf)}" for leaf in (alternate, value, claim)],
        ]
    )
    is_object = "try_variant_get(_rating, '$', 'map<string,variant>') IS NOT NULL"
    texts = {name: f"CAST({v} AS STRING)" for name, v in (("a", alternate), ("v", value), ("c", claim))}
    verdict = f"nullif(coalesce(nullif({texts['a']}, ''), {texts['v']}), '')"
    staged = pages.selectExpr(
        "*",
        f"{jsonld_block_array()} AS _blocks",
        "transform(_blocks, b -> try_parse_json(b)) AS _parsed",
        f"flatten(transform(_parsed, p -> {_members('p')})) AS _top",
        f"flatten(transform(_top, n -> concat(array(n), {_graph('n')}))) AS _nodes",
        f"get(filter(_nodes, n -> {_field('n', '@type', 'string')} = '{REVIEW_TYPE}'), 0) AS _review",
        f"{_field('_review', 'reviewRating')} AS _rating",
        f"coalesce({hard}, false) AS _hard",
        "CASE WHEN _hard THEN to_json(_blocks) END AS _hard_blocks",
        f"named_struct('verdict', {verdict}, 'claim', {texts['c']}, 'rating_value', {texts['v']}, "
        f"'found', _review IS NOT NULL, 'failed', _rating IS NOT NULL AND NOT {is_object}) AS _native",
    ).select(*pages.columns, "_hard_blocks", "_native")
    python = review_udf()(F.col("_hard_blocks")).alias("_python")
    return staged.select(*pages.columns, "_native", python).selectExpr(
        *pages.columns, "coalesce(_python, _native) AS review"
    )


def claim_reviews(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """Verdict, claim and rating of the pages that carry a structured review."""
    return (
        with_review(pages)
        .where("review.found AND NOT review.failed")
        .select(key, "review.verdict", "review.claim", "review.rating_value")
    )


def with_page_meta(pages: DataFrame) -> DataFrame:
    """Add ``page_title``, ``page_image`` and ``page_description``.

    The title is ``og:title``, else the first heading, else empty.
    """
    def written(attribute: str, value: str) -> str:
        hits = f"filter(_metas, m -> {_attribute_is('m', attribute, value)})"
        return f"get({hits}, 0)"

    tags = {
        "title": written("property", "og:title"),
        "image": written("property", "og:image"),
        "description": written("name", "description"),
    }
    # Values as written, and apart from them those with references or markup left to decode.
    staged = pages.selectExpr(
        "*",
        f"regexp_replace(html, {quote(_COMMENT_OR_RAW_TEXT)}, '') AS _markup",
        f"regexp_extract_all(_markup, {quote(_META_TAG)}, 0) AS _metas",
        *[f"{tag} AS _tag_{n}" for n, tag in tags.items()],
        *[f"{_attribute(f'_tag_{n}', 'content')} AS _{n}" for n in tags],
        f"regexp_extract(_markup, {quote(_HEADING)}, 1) AS _heading",
        *[f"CASE WHEN contains(_{n}, '&') THEN _{n} END AS _coded_{n}" for n in tags],
        "CASE WHEN rlike(_heading, '[<&]') THEN _heading END AS _coded_heading",
    ).select(
        *pages.columns,
        *[f"_{n}" for n in (*tags, "heading")],
        *[f"_coded_{n}" for n in (*tags, "heading")],
    )
    unescape, inner_text = unescape_udf(), element_text_udf()
    decoded = [unescape(F.col(f"_coded_{n}")).alias(f"_text_{n}") for n in tags]
    decoded.append(inner_text(F.col("_coded_heading")).alias("_text_heading"))
    heading = f"coalesce(_text_heading, {stripped('_heading')})"
    return staged.select(
        *pages.columns, *[f"_{n}" for n in (*tags, "heading")], *decoded
    ).selectExpr(
        *pages.columns,
        f"coalesce(nullif(coalesce(_text_title, _title), ''), {heading}) AS page_title",
        "coalesce(_text_image, _image) AS page_image",
        "coalesce(_text_description, _description) AS page_description",
    )


def page_meta(pages: DataFrame, key: str = "page_id") -> DataFrame:
    return with_page_meta(pages.select(key, "html")).select(
        key,
        F.col("page_title").alias("title"),
        F.col("page_image").alias("image_url"),
        F.col("page_description").alias("description"),
    )


def with_fallback(reviewed: DataFrame) -> DataFrame:
    """Add ``fallback`` (verdict and claim by class name) to pages without a structured review.

    A page in which neither word occurs cannot match any of the selectors.
    """
    candidate = "NOT review.found AND (contains(html, 'rating') OR contains(html, 'claim'))"
    staged = reviewed.selectExpr("*", f"CASE WHEN {candidate} THEN html END AS _candidate")
    return staged.select(*reviewed.columns, rating_udf()(F.col("_candidate")).alias("fallback"))


def css_fallback(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """Verdict and claim by class name for every page without a structured review."""
    return (
        with_fallback(with_review(pages.select(key, "html")))
        .where("NOT review.found AND NOT review.failed")
        .select(key, "fallback.verdict", "fallback.claim")
    )


def extraction_method() -> Column:
    return F.when(F.col("review.found"), STRUCTURED).otherwise(FALLBACK)


def extraction_coverage(pages: DataFrame) -> DataFrame:
    """Pages per extraction method, with all pages for the rate."""
    counts = (
        with_review(pages.select("html"))
        .where("NOT review.failed")
        .groupBy(extraction_method().alias("extraction_method"))
        .agg(F.count("*").alias("n"))
    )
    return counts.select("extraction_method", "n")


def extract_pages(pages: DataFrame, scraped_at: Column | None = None) -> DataFrame:
    """Claim rows of fetched pages (``url``, ``html``; other columns pass through).

    ``failed`` marks a page whose review has no usable rating object; it yields no claim.
    """
    passed = [c for c in pages.columns if c not in ("url", "html")]
    page = with_fallback(with_page_meta(with_review(pages)))
    found = F.col("review.found")
    stamp = F.current_timestamp() if scraped_at is None else scraped_at
    return page.select(
        "url",
        F.col("page_title").alias("title"),
        F.when(found, F.col("review.claim")).otherwise(F.col("fallback.claim")).alias("claim"),
        F.when(found, F.col("review.verdict")).otherwise(F.col("fallback.verdict")).alias("verdict"),
        F.when(found, F.col("review.rating_value")).alias("rating_value"),
        F.col("page_image").alias("image_url"),
        F.col("page_description").alias("description"),
        F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ssXXX").alias("scraped_at"),
        extraction_method().alias("extraction_method"),
        *passed,
        F.col("review.failed").alias("failed"),
    )


def attach_pages(feed: DataFrame, pages: DataFrame) -> DataFrame:
    """Feed items with the page fetched for their address; ``html`` is NULL where none was.

    Of several fetches of an address the latest counts, by ``fetched_at`` where the pages have it.
    Only addresses, times and digests are ranked; pages move only to meet their feed items.
    """
    items = feed.select(
        F.col("link").alias("url"),
        F.col("title").alias("rss_title"),
        F.col("pubDate").alias("rss_published"),
        *[c for c in feed.columns if c not in ("link", "title", "pubDate", "description")],
    )
    fetched = F.col("fetched_at") if "fetched_at" in pages.columns else F.lit(None)
    age = -F.unix_micros(fetched.cast("timestamp"))
    ordered = pages.select("url", "html", F.struct(age.isNull(), age, F.md5("html")).alias("_order"))
    latest = keep_first_in_place(ordered, "url", "_order").drop("_order")
    return items.join(latest, "url", "left")


def feed_claims(feed: DataFrame, pages: DataFrame, scraped_at: Column | None = None) -> DataFrame:
    """Claims of the feed items; pages that are missing or cannot be read are left out."""
    fetched = attach_pages(feed, pages).where(F.col("html").isNotNull())
    return extract_pages(fetched, scraped_at).where("NOT failed").drop("failed")


def feed_counts(feed: DataFrame, pages: DataFrame) -> DataFrame:
    """One row with the number of feed items that gave a page and that were skipped."""
    joined = with_review(attach_pages(feed, pages).select("html"))
    skipped = F.col("html").isNull() | F.col("review.failed")
    return joined.agg(F.count_if(~skipped).alias("seen"), F.count_if(skipped).alias("skipped"))
