"""Source-shaped views over the benchmark tables.

Each statement runs unchanged in Spark and in DuckDB: table names stand in braces, so that Spark
binds DataFrames to them and the checks bind plain names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Schemas are given, so that opening a table costs no job.
TABLES = {
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
    "value DOUBLE, props STRING",
}

VIEWS = {
    "raw_posts": """
WITH d AS (
  SELECT d.doc_id, d.text, d.source, l.quality
  FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id),
r AS (
  SELECT doc_id * 2 AS _seq, doc_id, text AS clean_title, source, quality FROM d
  UNION ALL
  SELECT doc_id * 2 + 1, doc_id, concat('repost ', text), source, quality FROM d WHERE doc_id % 20 = 0)
SELECT _seq,
  CASE WHEN doc_id % 50 = 7 THEN NULL ELSE CAST(doc_id AS STRING) END AS id,
  CASE WHEN doc_id % 37 = 5 THEN '   ' ELSE clean_title END AS clean_title,
  CASE WHEN doc_id % 11 = 0 THEN '' WHEN doc_id % 13 = 1 THEN 'not-a-url'
       ELSE concat('https://img.example.org/', CAST(doc_id AS STRING), '.png') END AS image_url,
  concat(source, '.example.org') AS domain,
  CAST(1 - quality AS STRING) AS two_way_label,
  CAST(doc_id % 7 AS STRING) AS six_way_label
FROM r""",
    "raw_statements": """
SELECT conv_id * 1000 + turn AS _seq,
  concat(CAST(conv_id AS STRING), '-', CAST(turn AS STRING), '.json') AS id,
  CASE (conv_id + turn) % 8 WHEN 0 THEN 'true' WHEN 1 THEN 'mostly-true' WHEN 2 THEN 'half-true'
    WHEN 3 THEN 'barely-true' WHEN 4 THEN 'false' WHEN 5 THEN 'pants-fire' WHEN 6 THEN ' TRUE ' END AS label_text,
  text AS statement,
  CASE WHEN conv_id % 10 < 8 THEN 'train' WHEN conv_id % 10 = 8 THEN 'validation' ELSE 'test' END AS split
FROM {conversations}""",
    "raw_news": """
SELECT page_id AS _seq, url AS id,
  CASE WHEN page_id % 6 = 0 THEN 'liveblog' WHEN page_id % 17 = 3 THEN 'crossword' ELSE 'article' END AS type,
  concat('Web title ', CAST(page_id AS STRING)) AS web_title,
  CASE WHEN page_id % 4 = 0 THEN '' ELSE concat('Headline ', CAST(page_id AS STRING)) END AS f_headline,
  concat('Trail ', CAST(page_id AS STRING)) AS f_trail_text,
  CASE WHEN page_id % 5 = 0 THEN NULL ELSE html END AS f_body,
  CASE WHEN page_id % 9 = 2 THEN NULL
       ELSE concat('https://media.example.org/', CAST(page_id AS STRING), '.jpg') END AS f_thumbnail
FROM {pages}""",
    "raw_claims": """
SELECT page_id AS _seq, url,
  concat('Was claim ', CAST(page_id AS STRING), ' true?') AS title,
  CASE WHEN page_id % 7 = 0 THEN '' ELSE concat('Claim ', CAST(page_id AS STRING)) END AS claim,
  CASE page_id % 10 WHEN 0 THEN 'True' WHEN 1 THEN 'False' WHEN 2 THEN 'Mixture' WHEN 3 THEN ' fake '
    WHEN 4 THEN NULL WHEN 5 THEN '' WHEN 6 THEN '  ' WHEN 7 THEN 'Mostly True'
    WHEN 8 THEN 'Originated as Satire' ELSE 'Unproven' END AS verdict,
  CASE WHEN page_id % 3 = 0 THEN NULL
       ELSE concat('https://media.example.org/c', CAST(page_id AS STRING), '.png') END AS image_url,
  concat('Description ', CAST(page_id AS STRING)) AS description
FROM {pages}""",
    "page_html": """
SELECT page_id, url,
  replace(replace(html, '</head>', concat(
    CASE WHEN page_id % 4 = 1 THEN '' ELSE concat('<meta data-x="a > b" property="og:title" content="OG ', CAST(page_id AS STRING), '">') END,
    CASE WHEN page_id % 3 = 0 THEN concat('<meta content=''https://img.example.org/o', CAST(page_id AS STRING), '.png'' property=og:image>') ELSE '' END,
    CASE WHEN page_id % 7 = 2 THEN concat('<meta data-x=it''s name="description" content="don''t > ', CAST(page_id AS STRING), ' &amp; more">') ELSE '' END,
    CASE page_id % 5
      WHEN 0 THEN ''
      WHEN 1 THEN '<script type="application/ld+json">{{not json</script>'
      WHEN 2 THEN concat('<script data-x=it''s title="a > b" type="application/ld+json">{{"@type":"ClaimReview","claimReviewed":"C', CAST(page_id AS STRING), '","reviewRating":{{"alternateName":"False","ratingValue":"1"}}}}</script>')
      WHEN 3 THEN concat('<script type="application/ld+json">{{"@graph":[{{"@type":"WebPage"}},{{"@type":"ClaimReview","claimReviewed":"C', CAST(page_id AS STRING), '","reviewRating":{{"ratingValue":"5"}}}}]}}</script>')
      ELSE concat('<script type="application/ld+json">[{{"@type":"Person"}},{{"@type":"ClaimReview","claimReviewed":"C', CAST(page_id AS STRING), '","reviewRating":{{"alternateName":"Mixture"}}}}]</script>') END,
    '</head>')),
  '</article>', concat(
    CASE WHEN page_id % 5 < 2 AND page_id % 3 <> 0
         THEN concat('<div class="rating-label">Unproven</div><p class="claim">K', CAST(page_id AS STRING), '</p>') ELSE '' END,
    '</article>')) AS html
FROM {pages}""",
    "image_responses": """
SELECT concat('https://img.example.org/', CAST(doc_id AS STRING), '.png') AS url,
  CASE doc_id % 5 WHEN 0 THEN 'image/jpeg' WHEN 1 THEN 'IMAGE/PNG; charset=binary' WHEN 2 THEN 'text/html'
    WHEN 3 THEN 'image/avif' ELSE 'image/webp' END AS content_type,
  CASE WHEN doc_id % 19 = 4 THEN 0 ELSE 1024 END AS body_length
FROM {documents} WHERE doc_id % 8 <> 3""",
    "labelled_documents": """
SELECT d.doc_id AS _seq, d.source, d.text AS content, d.lang AS language,
  CASE l.quality WHEN 1 THEN 'real' WHEN 0 THEN 'fake' END AS label,
  CASE WHEN l.toxic = 1 THEN 'toxic' END AS label_detail,
  l.quality = 1 AS has_image
FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id""",
    "feed": """
SELECT url AS link, concat('Feed ', CAST(page_id AS STRING)) AS title,
  concat('day ', CAST(page_id % 28 AS STRING)) AS pubDate,
  concat('Summary ', CAST(page_id AS STRING)) AS description
FROM {pages}""",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A view as a DataFrame; only the tables it names are opened."""
    statement = VIEWS[name]
    bound = {t: table(spark, folder, t) for t in TABLES if f"{{{t}}}" in statement}
    return spark.sql(statement, **bound)


def view_sql(name: str) -> str:
    """The statement with plain table names."""
    return VIEWS[name].format(**{t: t for t in TABLES})


def raw_posts(spark: SparkSession, folder: str) -> DataFrame:
    names = {"two_way_label": "2_way_label", "six_way_label": "6_way_label"}
    return view(spark, folder, "raw_posts").withColumnsRenamed(names)


def raw_news(spark: SparkSession, folder: str) -> DataFrame:
    return view(spark, folder, "raw_news").selectExpr(
        "_seq",
        "id",
        "type",
        "web_title AS webTitle",
        "named_struct('headline', f_headline, 'trailText', f_trail_text, 'body', f_body, "
        "'thumbnail', f_thumbnail) AS fields",
    )


def raw_claims(spark: SparkSession, folder: str) -> DataFrame:
    return view(spark, folder, "raw_claims")


def raw_statements(spark: SparkSession, folder: str) -> DataFrame:
    return view(spark, folder, "raw_statements")


RAW = {"fakeddit": raw_posts, "guardian": raw_news, "snopes": raw_claims, "liar": raw_statements}


def raw_views(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The four raw sources by name."""
    return {source: build(spark, folder) for source, build in RAW.items()}
