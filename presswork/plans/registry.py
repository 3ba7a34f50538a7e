"""The registered queries: every operator over the whole benchmark tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork import schemas as S
from presswork.functions.columns import content_key
from presswork.operators import images, kpi, pages, splits, stats, validate
from presswork.operators.dedup import keep_first_in_place
from presswork.operators.filters import (
    filter_articles,
    first_rows,
    has_image_url,
    skip_counts,
    wanted_article,
)
from presswork.operators.normalize import normalize
from presswork.operators.publish import flatten_articles, full_refresh, read_current
from presswork.plans import flow, views
from presswork.plans.oracle import COLLECTED_AT
from presswork.session import materialize, scratch_root, tune
from presswork.sources import bodies, readers, writers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a query under the name of its function, without a trailing underscore."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(tune(spark), folder)

    QUERIES[function.__name__.rstrip("_")] = run
    return function


def _moment() -> Column:
    return F.lit(COLLECTED_AT).cast("timestamp")


def _flat(df: DataFrame, *extra: str) -> DataFrame:
    """Article columns with metadata unnested and the timestamp as text."""
    nested = S.METADATA.fieldNames()
    columns = [c for c in S.ARTICLE.fieldNames() if c not in ("metadata", "collected_at")]
    return df.select(
        *columns,
        F.date_format("collected_at", "yyyy-MM-dd HH:mm:ss").alias("collected_at"),
        *[F.col("metadata")[c].alias(c) for c in nested],
        *extra,
    )


def _normalized(spark: SparkSession, folder: str, source: str) -> DataFrame:
    raw = views.RAW[source](spark, folder)
    return normalize(keep_first_in_place(raw, S.NATURAL_KEYS[source]), source, _moment())


def _unified(spark: SparkSession, folder: str) -> DataFrame:
    return flow.unify(views.raw_views(spark, folder), _moment())


def _unified_batch(spark: SparkSession, folder: str) -> DataFrame:
    """The unified batch as a written table, as the later stages find it."""
    return materialize(_unified(spark, folder), "unified")


def _final(spark: SparkSession, folder: str) -> DataFrame:
    return splits.assign_splits(_unified_batch(spark, folder))


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return views.view(spark, folder, "labelled_documents")


def _document_splits(spark: SparkSession, folder: str) -> DataFrame:
    return splits.assign_splits(_documents(spark, folder))


def _raw_counts(spark: SparkSession, folder: str) -> DataFrame:
    return kpi.count_by_source(views.raw_views(spark, folder))


def _rejection(spark: SparkSession, folder: str) -> DataFrame:
    return kpi.per_source_rejection(_raw_counts(spark, folder), _unified(spark, folder))


def _file_folder(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/presswork/{name}-{uuid.uuid4().hex}"


def _one_line(column: str) -> Column:
    return F.trim(F.regexp_replace(column, r"\s+", " "))


# --- Sources and sinks ------------------------------------------------------------------------
@query
def scan_tsv(spark: SparkSession, folder: str) -> DataFrame:
    """Header TSV with rows that are too long and too short, spelled-out missing values, quoted
    fields with tabs, line breaks and much text, and bare quotes."""
    path = _file_folder(spark, "posts-tsv")
    posts = views.raw_posts(spark, folder)
    label = F.when(F.col("_seq") % 6 == 1, "N/A").otherwise(F.col("2_way_label"))
    domain = (
        F.when(F.col("_seq") % 15 == 2, F.concat(F.lit('"'), "domain", F.lit('\n""x""\n\ty"')))
        .when(F.col("_seq") % 15 == 3, F.concat("domain", F.lit(' "bare')))
        .otherwise(F.col("domain"))
    )
    values = {"id": F.col("id"), "domain": domain, "2_way_label": label}
    long_text = F.concat(F.lit('"'), F.repeat(F.lit("x\ty"), 40_000), F.lit('"'))
    extra = F.when(F.col("_seq") % 1000 == 6, long_text).otherwise(F.lit("extra"))
    cells = F.array(
        *[F.coalesce(values.get(n, F.lit("x")), F.lit("")) for n in S.RAW_POST.fieldNames()]
    )
    uneven = (
        F.when(F.col("_seq") % 10 == 6, F.concat(cells, F.array(extra)))
        .when(F.col("_seq") % 10 == 4, F.slice(cells, 1, 2))
        .otherwise(cells)
    )
    header = "\t".join(S.RAW_POST.fieldNames())
    line = F.array_join(uneven, "\t")
    first = F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1)) == 0  # of each file
    posts.select(F.when(first, F.concat(F.lit(header + "\n"), line)).otherwise(line)).write.text(path)
    return readers.read_header_tsv(spark, path, S.RAW_POST).select(
        "id", "domain", F.col("2_way_label").alias("two_way_label")
    )


@query
def scan_tsv_unquoted(spark: SparkSession, folder: str) -> DataFrame:
    """Headerless TSV without quoting: bare quotes stay, empty fields stay empty."""
    path = _file_folder(spark, "statements-tsv")
    rows = views.view(spark, folder, "raw_statements")
    values = {
        "id": F.col("id"),
        "label_text": F.col("label_text"),
        "statement": _one_line("statement"),
        "subjects": F.concat(F.lit('"'), "split"),
    }
    cells = [F.coalesce(values.get(n, F.lit("")), F.lit("")) for n in S.RAW_STATEMENT.fieldNames()]
    rows.select(F.concat_ws("\t", *cells).alias("value")).write.text(path)
    read = readers.read_statement_files(spark, path)
    return read.select("id", "label_text", "statement", "subjects", "speaker")


@query
def tag_origin_split(spark: SparkSession, folder: str) -> DataFrame:
    """Split and its rank from the name of the file a statement came from."""
    rows = views.view(spark, folder, "raw_statements")
    name = F.concat(F.when(F.col("split") == "validation", "valid").otherwise(F.col("split")), F.lit(".tsv"))
    tagged = rows.select("id", readers.origin_split(name).alias("split"))
    return tagged.select("id", "split", readers.origin_rank(F.col("split")).cast("int").alias("rank"))


@query
def scan_jsonl(spark: SparkSession, folder: str) -> DataFrame:
    """Raw claims written as a JSON Lines batch and read back as the latest batch."""
    root = _file_folder(spark, "raw")
    claims = views.view(spark, folder, "raw_claims")
    writers.write_raw(claims, root, "snopes", "20260101_000000")
    path = readers.latest_batch_path(spark, root, "snopes")
    read = readers.read_json_lines(spark, path, S.RAW_CLAIM)
    return read.select("url", "title", "claim", "verdict", "image_url", "description")


@query
def latest_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Events of the latest day of each type."""
    events = views.table(spark, folder, "events").select(
        "event_id",
        F.col("event_type").alias("source"),
        F.date_format("ts", "yyyyMMdd").alias("batch_ts"),
    )
    return readers.latest_batch(events)


@query
def explode_results(spark: SparkSession, folder: str) -> DataFrame:
    """News articles landed as result pages of fifty and unpacked again."""
    path = _file_folder(spark, "news-payload")
    news = views.raw_news(spark, folder)
    page = F.floor(F.col("_seq") / 50).cast("int") + 1
    item = F.struct("id", "type", "webTitle", "fields")
    landed = news.groupBy(page.alias("currentPage")).agg(F.collect_list(item).alias("results"))
    landed.select(F.struct("currentPage", "results").alias("response")).write.json(path)
    read = readers.read_news_payloads(spark, path)
    return read.select(
        "id",
        "type",
        F.col("webTitle").alias("web_title"),
        F.col("fields.headline").alias("headline"),
        F.col("fields.thumbnail").alias("thumbnail"),
    )


@query
def scan_feed_items(spark: SparkSession, folder: str) -> DataFrame:
    """Feed items written as XML and read back."""
    path = _file_folder(spark, "feed-xml")
    feed = views.view(spark, folder, "feed")
    feed.write.format("xml").option("rootTag", "channel").option("rowTag", "item").save(path)
    items = readers.read_feed_items(spark, path)
    return items.select("link", "title", F.col("pubDate").alias("pub_date"), "description")


@query
def limit_ordered(spark: SparkSession, folder: str) -> DataFrame:
    """The row cap of an extraction: the first hundred claims in file order."""
    return first_rows(views.view(spark, folder, "raw_claims"), 100).select("_seq", "url", "verdict")


@query
def sink_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Normalised posts written as a unified JSON batch with explicit NULLs and read back."""
    root = _file_folder(spark, "unified-json")
    path, _ = writers.write_unified(
        _normalized(spark, folder, "fakeddit"), root, "20260101_000000", "json"
    )
    return _flat(flow.read_unified(spark, path, "json"))


@query
def split_sink(spark: SparkSession, folder: str) -> DataFrame:
    """The split dataset written by split and read back."""
    path = writers.write_splits(_final(spark, folder), _file_folder(spark, "splits"))
    return readers.read_splits(spark, path).select(
        "id", "source", "label", F.col("metadata.has_image").alias("has_image"), "split"
    )


# --- Pages ------------------------------------------------------------------------------------
@query
def jsonld_blocks(spark: SparkSession, folder: str) -> DataFrame:
    blocks = pages.jsonld_blocks(views.view(spark, folder, "page_html"))
    return blocks.select("page_id", "pos", "is_json")


@query
def claim_review(spark: SparkSession, folder: str) -> DataFrame:
    return pages.claim_reviews(views.view(spark, folder, "page_html"))


@query
def page_meta(spark: SparkSession, folder: str) -> DataFrame:
    return pages.page_meta(views.view(spark, folder, "page_html"))


@query
def css_fallback(spark: SparkSession, folder: str) -> DataFrame:
    return pages.css_fallback(views.view(spark, folder, "page_html"))


@query
def extraction_coverage(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extraction_coverage(views.view(spark, folder, "page_html"))


def _feed_and_pages(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Every page is a feed item; one in nine could not be fetched."""
    fetched = views.view(spark, folder, "page_html").where("page_id % 9 <> 4")
    return views.view(spark, folder, "feed"), fetched


@query
def join_feed_pages(spark: SparkSession, folder: str) -> DataFrame:
    claims = pages.feed_claims(*_feed_and_pages(spark, folder))
    return claims.select(
        "url", "rss_title", "rss_published", "verdict", "claim", "rating_value", "extraction_method"
    )


@query
def feed_skip_counts(spark: SparkSession, folder: str) -> DataFrame:
    return pages.feed_counts(*_feed_and_pages(spark, folder))


# --- Filters, mappings, validation ------------------------------------------------------------
@query
def filter_has_image(spark: SparkSession, folder: str) -> DataFrame:
    return has_image_url(views.raw_posts(spark, folder)).select("_seq", "id", "image_url")


@query
def filter_articles_(spark: SparkSession, folder: str) -> DataFrame:
    kept = filter_articles(views.raw_news(spark, folder))
    return kept.select("_seq", "id", F.col("fields.thumbnail").alias("thumbnail"))


@query
def skipped_counts(spark: SparkSession, folder: str) -> DataFrame:
    return skip_counts(views.raw_news(spark, folder), wanted_article())


@query
def dedup_first(spark: SparkSession, folder: str) -> DataFrame:
    first = keep_first_in_place(views.raw_posts(spark, folder), "id")
    return first.select("_seq", "id", "clean_title", "image_url")


@query
def normalize_posts(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(_normalized(spark, folder, "fakeddit"))


@query
def normalize_news(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(_normalized(spark, folder, "guardian"))


@query
def normalize_claims(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(_normalized(spark, folder, "snopes"))


@query
def normalize_statements(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(_normalized(spark, folder, "liar"))


@query
def label_policy(spark: SparkSession, folder: str) -> DataFrame:
    """Which verdicts become a label and which stay a detail only."""
    both = readers.union_of(_normalized(spark, folder, s) for s in ("snopes", "liar"))
    return both.groupBy("source", "label_detail", "label").agg(F.count("*").alias("n"))


@query
def reject_reasons(spark: SparkSession, folder: str) -> DataFrame:
    checked = validate.with_reject_reason(_normalized(spark, folder, "fakeddit"))
    return checked.select("id", "reject_reason")


@query
def reject_counts(spark: SparkSession, folder: str) -> DataFrame:
    return validate.reject_counts(
        readers.union_of(_normalized(spark, folder, s) for s in S.SOURCES)
    )


@query
def unified_dataset(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(_unified(spark, folder))


# --- Splits -----------------------------------------------------------------------------------
@query
def content_keys(spark: SparkSession, folder: str) -> DataFrame:
    return _documents(spark, folder).select("_seq", content_key().alias("content_key"))


@query
def split_quotas(spark: SparkSession, folder: str) -> DataFrame:
    return splits.split_quotas(_documents(spark, folder))


@query
def assign_splits(spark: SparkSession, folder: str) -> DataFrame:
    return _document_splits(spark, folder).select("_seq", "source", "label", "content_key", "split")


@query
def unified_splits(spark: SparkSession, folder: str) -> DataFrame:
    return _final(spark, folder).select("id", "source", "label", "split")


# --- Statistics -------------------------------------------------------------------------------
@query
def dataset_totals(spark: SparkSession, folder: str) -> DataFrame:
    return stats.dataset_totals(_unified(spark, folder))


@query
def frequency_tables(spark: SparkSession, folder: str) -> DataFrame:
    return stats.frequency_tables(_unified(spark, folder))


@query
def content_length_stats(spark: SparkSession, folder: str) -> DataFrame:
    return stats.content_length_stats(_documents(spark, folder)).drop("mean_length")


@query
def duplicate_groups(spark: SparkSession, folder: str) -> DataFrame:
    return stats.duplicate_groups(_documents(spark, folder))


@query
def dataset_stats(spark: SparkSession, folder: str) -> DataFrame:
    return stats.dataset_stats(_documents(spark, folder))


@query
def split_crosstab(spark: SparkSession, folder: str) -> DataFrame:
    return stats.split_crosstab(_document_splits(spark, folder))


# --- Indicators -------------------------------------------------------------------------------
@query
def raw_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _raw_counts(spark, folder)


@query
def per_source_rejection(spark: SparkSession, folder: str) -> DataFrame:
    return _rejection(spark, folder).drop("rate")


@query
def overall_rejection(spark: SparkSession, folder: str) -> DataFrame:
    return kpi.overall_rejection(_rejection(spark, folder))


@query
def volumetry(spark: SparkSession, folder: str) -> DataFrame:
    return kpi.volumetry(_rejection(spark, folder), ["fakeddit", "snopes"])


@query
def rejection_table(spark: SparkSession, folder: str) -> DataFrame:
    return kpi.rejection_table(_rejection(spark, folder))


@query
def label_detail_ranking(spark: SparkSession, folder: str) -> DataFrame:
    return kpi.label_detail_ranking(_unified(spark, folder))


@query
def split_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return kpi.split_sizes(_final(spark, folder))


@query
def leakage_count(spark: SparkSession, folder: str) -> DataFrame:
    return kpi.leakage_count(_final(spark, folder))


@query
def leakage_of_origin_split(spark: SparkSession, folder: str) -> DataFrame:
    """Contents that the statements' own split puts on more than one side."""
    rows = views.view(spark, folder, "raw_statements")
    return kpi.leakage_count(rows.select(F.col("statement").alias("content"), "split"))


@query
def image_coverage(spark: SparkSession, folder: str) -> DataFrame:
    return kpi.image_coverage(_unified(spark, folder)).drop("coverage")


@query
def kpi_summary(spark: SparkSession, folder: str) -> DataFrame:
    batch = _unified_batch(spark, folder)
    rejection = kpi.per_source_rejection(_raw_counts(spark, folder), batch)
    final = materialize(
        splits.assign_splits(batch).select("source", "content", "metadata", "split"), "final"
    )
    return kpi.kpi_summary(rejection, final)


# --- Images and the flat table ----------------------------------------------------------------
def _outcomes(spark: SparkSession, folder: str, records: DataFrame) -> DataFrame:
    return images.image_outcomes(records, views.view(spark, folder, "image_responses"))


@query
def image_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    outcomes = _outcomes(spark, folder, _normalized(spark, folder, "fakeddit"))
    flag = F.col("metadata.has_image").alias("has_image")
    return outcomes.select("id", "image_url", "outcome", flag, "image_path")


@query
def image_bodies(spark: SparkSession, folder: str) -> DataFrame:
    """Files of the downloaded images, read back: id of the record, path, length."""
    target = _file_folder(spark, "images")
    body = F.when(F.col("body_length") > 0, F.encode(F.concat(F.lit("body of "), "url"), "UTF-8"))
    responses = views.view(spark, folder, "image_responses").withColumn("body", body)
    outcomes = images.image_outcomes(_normalized(spark, folder, "fakeddit"), responses)
    bodies.write_bodies(images.image_bodies(outcomes, responses), target)
    name = F.regexp_extract("path", "[^/]+$", 0)
    found = spark.read.format("binaryFile").load(target).select(name.alias("path"), "length")
    return found.select(F.regexp_extract("path", r"^(.*)\.", 1).alias("id"), "path", "length")


@query
def image_extension(spark: SparkSession, folder: str) -> DataFrame:
    responses = views.view(spark, folder, "image_responses")
    extension = images.image_extension(F.col("content_type"), F.col("url"))
    return responses.select("url", "content_type", extension.alias("extension"))


@query
def image_summary(spark: SparkSession, folder: str) -> DataFrame:
    batch = materialize(_normalized(spark, folder, "fakeddit"), "posts")
    return images.image_summary(_outcomes(spark, folder, splits.assign_splits(batch)))


@query
def flatten_articles_(spark: SparkSession, folder: str) -> DataFrame:
    flat = flatten_articles(_final(spark, folder))
    return flat.withColumn("collected_at", F.date_format("collected_at", "yyyy-MM-dd HH:mm:ss"))


@query
def full_refresh_(spark: SparkSession, folder: str) -> DataFrame:
    """The table after two refreshes."""
    target = _file_folder(spark, "articles")
    final = _final(spark, folder)
    full_refresh(final, target)
    full_refresh(final, target)
    table = read_current(spark, target).drop("loaded_at")
    return table.withColumn("collected_at", F.date_format("collected_at", "yyyy-MM-dd HH:mm:ss"))


# --- Alerts -----------------------------------------------------------------------------------
@query
def rejection_alerts(spark: SparkSession, folder: str) -> DataFrame:
    return kpi.rejection_alerts(_rejection(spark, folder))


@query
def run_alerts(spark: SparkSession, folder: str) -> DataFrame:
    batch = _unified_batch(spark, folder)
    return kpi.run_alerts(kpi.per_source_rejection(_raw_counts(spark, folder), batch), batch)


@query
def freshness_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """Events as runs of their type, seen from a fixed moment."""
    runs = views.table(spark, folder, "events").select(
        F.col("event_type").alias("source"), F.col("ts").cast("timestamp").alias("finished_at")
    )
    alerts = kpi.freshness_alerts(runs, F.lit("2024-02-01 06:00:00").cast("timestamp"))
    return alerts.withColumn("last_success", F.col("last_success").cast("string"))


@query
def volume_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """Daily event volumes against the week before; one type is silent on some days."""
    silent = "event_type = 'click' AND unix_date(to_date(ts)) % 6 = 3"
    daily = (
        views.table(spark, folder, "events")
        .where(f"NOT ({silent})")
        .groupBy(F.col("event_type").alias("source"), F.to_date("ts").alias("day"))
        .agg(F.count("*").alias("n"))
    )
    return kpi.volume_alerts(daily).withColumn("day", F.col("day").cast("string"))


@query
def image_failure_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """Share of failed downloads over all posts."""
    outcomes = _outcomes(spark, folder, _normalized(spark, folder, "fakeddit"))
    counts = outcomes.agg(
        F.count_if(F.col("outcome") == "downloaded").alias("downloaded"),
        F.count_if(F.col("outcome") == "failed").alias("failed"),
    )
    return kpi.image_failure_alert(counts)


@query
def leakage_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """Contents on both sides of the statements' own split."""
    return kpi.leakage_alert(leakage_of_origin_split(spark, folder))


@query
def duration_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """Runs that took too long; an event stands for a run of as many seconds as its value."""
    stage = F.element_at(F.array(*map(F.lit, ("extract", "transform", "load"))), (F.col("event_id") % 3 + 1).cast("int"))
    started = F.to_utc_timestamp(F.col("ts").cast("timestamp"), "UTC")
    seconds = F.col("event_id") % 181
    runs = views.table(spark, folder, "events").select(
        stage.alias("stage"), F.col("event_type").alias("source"), started.alias("started_at"),
        F.timestamp_seconds(F.unix_seconds(started) + seconds).alias("finished_at"),
    ).withColumn("started_at", F.timestamp_seconds(F.unix_seconds("started_at")))
    alerts = kpi.duration_alerts(runs)
    return alerts.groupBy("stage", "source").agg(
        F.count("*").alias("runs"), F.count_if("alert").alias("late"), F.max("seconds").alias("longest")
    )
