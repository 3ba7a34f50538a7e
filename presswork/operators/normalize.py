"""Mapping of each raw source onto the unified article record."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork import schemas as S
from presswork.functions.columns import lookup, quote, stable_uuid, stripped
from presswork.functions.text import with_clean_text

Moment = datetime | Column


def _as_column(value: Moment) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def _filled(text: str) -> str:
    return f"coalesce(length({text}) > 0, false)"


def _first_filled(first: str, second: str) -> str:
    """The first text unless it is NULL or empty, else the second as it is."""
    return f"coalesce(nullif({first}, ''), {second})"


def _articles(
    df: DataFrame,
    source: str,
    collected_at: Moment,
    *,
    title: str,
    content: str | None = None,
    image_url: str,
    label: str,
    label_detail: str,
    domain: str,
    credibility: str,
    method: str,
) -> DataFrame:
    """Common record builder; every value is given as SQL.

    Without ``content`` the title text serves as both and is cleaned once.
    """
    texts = {"title": "_title"} if content is None else {"title": "_title", "content": "_content"}
    base = df.selectExpr(
        "_seq",
        f"{stable_uuid(source, S.NATURAL_KEYS[source])} AS id",
        f"CAST({image_url} AS STRING) AS image_url",
        f"CAST({label} AS STRING) AS label",
        f"CAST({label_detail} AS STRING) AS label_detail",
        f"CAST({domain} AS STRING) AS domain",
        f"{title} AS _title",
        *([] if content is None else [f"{content} AS _content"]),
    )
    return with_clean_text(base, **texts).select(
        F.expr("_seq"),
        F.expr("id"),
        F.expr(f"{quote(source)} AS source"),
        F.expr("title"),
        F.expr(f"{'title' if content is None else 'content'} AS content"),
        F.expr("image_url"),
        F.expr("label"),
        F.expr("label_detail"),
        F.expr(f"{quote(S.LANGUAGE)} AS language"),
        F.expr("domain"),
        _as_column(collected_at).alias("collected_at"),
        F.expr(
            f"named_struct('source_credibility', {quote(credibility)}, "
            f"'has_image', {_filled('image_url')}, 'label_method', {quote(method)}) AS metadata"
        ),
    )


def posts(df: DataFrame, collected_at: Moment) -> DataFrame:
    """Community posts: two-way label to the binary, six-way label to the detail."""
    return _articles(
        df,
        "fakeddit",
        collected_at,
        title="clean_title",
        image_url="image_url",
        label=lookup("`2_way_label`", S.POST_LABELS),
        label_detail=lookup("`6_way_label`", S.POST_LABEL_DETAILS),
        domain="domain",
        credibility="medium",
        method="community",
    )


def news(df: DataFrame, collected_at: Moment) -> DataFrame:
    """News articles: the credible baseline, labelled real without a detail."""
    return _articles(
        df,
        "guardian",
        collected_at,
        title=_first_filled("fields.headline", "webTitle"),
        content=_first_filled("fields.body", "fields.trailText"),
        image_url="fields.thumbnail",
        label="'real'",
        label_detail="NULL",
        domain=quote(S.SOURCE_DOMAINS["guardian"]),
        credibility="high",
        method="human_expert",
    )


def claims(df: DataFrame, collected_at: Moment) -> DataFrame:
    """Fact-checked claims: rows without a verdict are dropped, nuanced verdicts get no label."""
    title = _first_filled("title", "rss_title") if "rss_title" in df.columns else "nullif(title, '')"
    return _articles(
        df.where(_filled("verdict")),
        "snopes",
        collected_at,
        title=title,
        content=_first_filled("claim", "description"),
        image_url="image_url",
        label=lookup(f"lower({stripped('verdict')})", S.CLAIM_LABELS),
        label_detail=stripped("verdict"),
        domain=quote(S.SOURCE_DOMAINS["snopes"]),
        credibility="high",
        method="human_expert",
    )


def statements(df: DataFrame, collected_at: Moment) -> DataFrame:
    """Rated statements: the verdict is kept verbatim, only its extremes become a label."""
    return _articles(
        df,
        "liar",
        collected_at,
        title="statement",
        image_url="NULL",
        label=lookup(f"lower({stripped('label_text')})", S.STATEMENT_LABELS),
        label_detail="label_text",
        domain=quote(S.SOURCE_DOMAINS["liar"]),
        credibility="high",
        method="human_expert",
    )


MAPPERS: dict[str, Callable[[DataFrame, Moment], DataFrame]] = {
    "fakeddit": posts,
    "guardian": news,
    "snopes": claims,
    "liar": statements,
}


def normalize(df: DataFrame, source: str, collected_at: Moment) -> DataFrame:
    """Apply the mapping registered for ``source``."""
    return MAPPERS[source](df, collected_at)
