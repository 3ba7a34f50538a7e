"""Row filters applied while reading the sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.functions.columns import is_filled

# Fixed value: the payload types kept from the news source.
ARTICLE_TYPES = ("article",)


def has_image_url(df: DataFrame, column: str = "image_url") -> DataFrame:
    """Keep the rows with a non-empty image address."""
    return df.where(is_filled(F.col(column)))


def wanted_article(require_image: bool = True) -> Column:
    """Editorial article, with a thumbnail unless ``require_image`` is off; never NULL."""
    wanted = F.coalesce(F.col("type").isin(*ARTICLE_TYPES), F.lit(False))
    return wanted & is_filled(F.col("fields.thumbnail")) if require_image else wanted


def filter_articles(df: DataFrame, require_image: bool = True) -> DataFrame:
    return df.where(wanted_article(require_image))


def skip_counts(df: DataFrame, wanted: Column) -> DataFrame:
    """One row with the number of rows kept and skipped by a condition."""
    return df.agg(
        F.count_if(wanted).alias("kept"),
        F.count_if(~wanted).alias("skipped"),
    )


def select_sources(df: DataFrame, sources: Sequence[str] = (), column: str = "source") -> DataFrame:
    """Restrict to the named sources; no names means all of them."""
    return df.where(F.col(column).isin(*sources)) if sources else df


def first_rows(df: DataFrame, n: int | None, order: str = "_seq") -> DataFrame:
    """The first ``n`` rows in file order, or every row when ``n`` is None."""
    return df if n is None else df.orderBy(order).limit(n)
