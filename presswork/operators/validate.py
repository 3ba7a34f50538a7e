"""Row validation with an explicit reason for every rejected row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork import schemas as S
from presswork.functions.columns import one_of, quote, stripped

# Scheme, then a non-empty authority. Control characters and spaces may lead.
_WEB_URL = r"^[\x00-\x20]*(?i:https?)://([^/?#]+)"


def is_web_url(url: str) -> str:
    """SQL: http or https address with an authority part; brackets in it must pair up."""
    compact = f"translate({url}, '\\t\\r\\n', '')"
    authority = f"regexp_extract({compact}, {quote(_WEB_URL)}, 1)"
    paired = f"contains({authority}, '[') = contains({authority}, ']')"
    return f"(length({authority}) > 0 AND {paired})"


def breaks_schema() -> str:
    """SQL: a required value is missing or a closed vocabulary is violated."""
    required = ["source", "language", "collected_at"]
    required += [f"metadata.{name}" for name in S.METADATA.fieldNames()]
    missing = " OR ".join(f"{column} IS NULL" for column in required)
    return (
        f"({missing} OR metadata.source_credibility NOT IN {one_of(S.CREDIBILITY_LEVELS)}"
        f" OR metadata.label_method NOT IN {one_of(S.LABEL_METHODS)}"
        f" OR coalesce(label NOT IN {one_of(S.LABELS)}, false))"
    )


def _is_blank(text: str) -> str:
    return f"coalesce(length({stripped(text)}), 0) = 0"


def reject_reason() -> str:
    """SQL: the first rule a row breaks, or NULL for a valid row."""
    return (
        f"CASE WHEN {_is_blank('title')} THEN 'empty_title'"
        f" WHEN {_is_blank('content')} THEN 'empty_content'"
        f" WHEN image_url IS NOT NULL AND NOT {is_web_url('image_url')} THEN 'invalid_image_url'"
        f" WHEN {breaks_schema()} THEN 'schema_violation' END"
    )


def with_reject_reason(df: DataFrame) -> DataFrame:
    """Add ``reject_reason``: the first rule a row breaks, or NULL for a valid row."""
    return df.selectExpr("*", f"{reject_reason()} AS reject_reason")


def valid_rows(df: DataFrame) -> DataFrame:
    """Rows that pass every rule."""
    return df.where(f"({reject_reason()}) IS NULL")


def rejected_rows(df: DataFrame) -> DataFrame:
    """Rows that break a rule, with the reason."""
    return with_reject_reason(df).where("reject_reason IS NOT NULL")


def reject_counts(df: DataFrame) -> DataFrame:
    """Number of rows per source and reason; valid rows count under ``valid``."""
    reason = F.expr("coalesce(reject_reason, 'valid') AS reject_reason")
    return with_reject_reason(df).groupBy("source", reason).agg(F.count("*").alias("n"))
