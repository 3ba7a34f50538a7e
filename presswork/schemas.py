"""Record types and closed vocabularies shared by every stage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# --- Fixed values: source names, natural keys, labels and vocabularies ------------------------
SOURCES = ("fakeddit", "guardian", "snopes", "liar")
NATURAL_KEYS = {"fakeddit": "id", "guardian": "id", "snopes": "url", "liar": "id"}
SOURCE_DOMAINS = {"guardian": "theguardian.com", "snopes": "snopes.com", "liar": "politifact.com"}
LANGUAGE = "en"

LABELS = ("fake", "real")
CREDIBILITY_LEVELS = ("high", "medium", "low")
LABEL_METHODS = ("human_expert", "community", "automated")

POST_LABELS = {"0": "real", "1": "fake"}
POST_LABEL_DETAILS = {
    "0": "true",
    "1": "satire",
    "2": "misleading_content",
    "3": "imposter_content",
    "4": "false_connection",
    "5": "manipulated_content",
}
CLAIM_LABELS = {"true": "real", "false": "fake", "fake": "fake"}
STATEMENT_LABELS = {"true": "real", "false": "fake", "pants-fire": "fake"}

SPLITS = ("train", "validation", "test")
DEFAULT_RATIOS = (0.70, 0.15, 0.15)
DEFAULT_SEED = 42
# ----------------------------------------------------------------------------------------------


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


METADATA = T.StructType(
    [
        T.StructField("source_credibility", T.StringType()),
        T.StructField("has_image", T.BooleanType()),
        T.StructField("label_method", T.StringType()),
    ]
)

ARTICLE = T.StructType(
    [
        *_strings("id", "source", "title", "content", "image_url"),
        *_strings("label", "label_detail", "language", "domain"),
        T.StructField("collected_at", T.TimestampType()),
        T.StructField("metadata", METADATA),
    ]
)

# Columns of the flat relational target, without the load timestamp.
FLAT_COLUMNS = (
    "id",
    "source",
    "split",
    "title",
    "content",
    "image_url",
    "label",
    "label_detail",
    "language",
    "domain",
    "collected_at",
    "source_credibility",
    "has_image",
    "label_method",
)

RAW_POST = T.StructType(
    _strings(
        "id",
        "author",
        "subreddit",
        "domain",
        "clean_title",
        "title",
        "image_url",
        "2_way_label",
        "3_way_label",
        "6_way_label",
        "score",
        "num_comments",
        "upvote_ratio",
        "hasImage",
        "created_utc",
    )
)

RAW_STATEMENT = T.StructType(
    _strings(
        "id",
        "label_text",
        "statement",
        "subjects",
        "speaker",
        "job_title",
        "state_info",
        "party",
        "barely_true_counts",
        "false_counts",
        "half_true_counts",
        "mostly_true_counts",
        "pants_on_fire_counts",
        "context",
    )
)

NEWS_FIELDS = T.StructType(
    _strings(
        "headline", "trailText", "body", "thumbnail", "byline", "publication", "lastModified"
    )
)

RAW_NEWS = T.StructType(
    [*_strings("id", "type", "webTitle"), T.StructField("fields", NEWS_FIELDS)]
)

NEWS_PAYLOAD = T.StructType(
    [
        T.StructField(
            "response",
            T.StructType(
                [
                    T.StructField("currentPage", T.IntegerType()),
                    T.StructField("pages", T.IntegerType()),
                    T.StructField("total", T.LongType()),
                    T.StructField("results", T.ArrayType(RAW_NEWS)),
                ]
            ),
        )
    ]
)

FEED_ITEM = T.StructType(_strings("link", "title", "pubDate", "description"))

RAW_CLAIM = T.StructType(
    _strings(
        "url",
        "title",
        "claim",
        "verdict",
        "rating_value",
        "image_url",
        "description",
        "scraped_at",
        "extraction_method",
        "rss_title",
        "rss_published",
    )
)

RAW_SCHEMAS = {
    "fakeddit": RAW_POST,
    "guardian": RAW_NEWS,
    "snopes": RAW_CLAIM,
    "liar": T.StructType([*RAW_STATEMENT.fields, T.StructField("split", T.StringType())]),
}


def assert_columns(df: DataFrame, schema: T.StructType, technical: tuple[str, ...] = ()) -> DataFrame:
    """Refuse a frame whose columns are not exactly those of ``schema``.

    Columns named in ``technical`` may be present as well; nothing else may. The check reads
    only the plan's schema, so it costs no job.
    """
    expected = {field.name: field.dataType for field in schema.fields}
    unknown = [c for c in df.columns if c not in expected and c not in technical]
    missing = [c for c in expected if c not in df.columns]
    if unknown or missing:
        raise ValueError(f"unexpected columns {unknown}, missing columns {missing}")
    for name, data_type in expected.items():
        actual = df.schema[name].dataType
        if actual.simpleString() != data_type.simpleString():
            raise ValueError(
                f"column {name!r} is {actual.simpleString()}, expected {data_type.simpleString()}"
            )
    return df
