"""Typed readers for the raw inputs and the stored batches."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presswork import schemas as S
from presswork.functions.columns import is_filled
from presswork.session import materialize
from presswork.sources.order import KEPT_ORDER, ORDER, file_order, with_file_order
from presswork.sources.records import read_records

# --- Fixed values: spellings of a missing value in posts files, and the split of each file -----
NA_WORDS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)
ORIGIN_FILES = {"train.tsv": "train", "valid.tsv": "validation", "test.tsv": "test"}
# ----------------------------------------------------------------------------------------------


def read_header_tsv(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """Header TSV as text columns plus ``_seq``; quoted fields may span lines.

    Rows with too many fields are skipped and short rows are padded with NULL. The usual spellings
    of a missing value become NULL.
    """
    rows = read_records(spark, path).where(F.size("fields") <= len(schema.fields))
    cells = [F.get("fields", F.lit(k)) for k in range(len(schema.fields))]
    return rows.select(
        *[
            F.when(~cell.isin(*NA_WORDS), cell).alias(c)
            for c, cell in zip(schema.fieldNames(), cells, strict=True)
        ],
        "_seq",
    )


def read_posts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Posts with an image address."""
    posts = read_header_tsv(spark, path, S.RAW_POST)
    return posts.where(is_filled(F.col("image_url")))


def origin_split(file_name: Column) -> Column:
    """Split a statements file stands for, by its name; NULL for another name."""
    result = F.lit(None).cast("string")
    for name, split in ORIGIN_FILES.items():
        result = F.when(file_name == name, split).otherwise(result)
    return result


def origin_rank(split: Column) -> Column:
    """Position of a split in the fixed order train, validation, test."""
    return F.array_position(F.array(*[F.lit(s) for s in S.SPLITS]), split)


def _statement_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return (
        spark.read.schema(S.RAW_STATEMENT)
        .option("sep", "\t")
        .option("header", False)
        .option("quote", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(paths)
    )


def _empty_kept(schema: T.StructType) -> list[Column]:
    return [F.coalesce(F.col(c), F.lit("")).alias(c) for c in schema.fieldNames()]


def read_statement_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Headerless, unquoted statements of any files, untagged; empty fields stay empty text."""
    return with_file_order(_statement_lines(spark, paths)).select(
        *_empty_kept(S.RAW_STATEMENT), "_seq"
    )


def read_statements(
    spark: SparkSession, paths: str | list[str], splits: Sequence[str] = S.SPLITS
) -> DataFrame:
    """Headerless, unquoted statements of the chosen splits, tagged with their split.

    Empty fields stay empty text. File order is train, validation, test.
    """
    rows = _statement_lines(spark, paths)
    split = origin_split(F.col("_metadata.file_name"))
    tagged = rows.select(
        *_empty_kept(S.RAW_STATEMENT),
        split.alias("split"),
        file_order(origin_rank(split)).alias("_seq"),
    )
    return tagged.where(F.col("split").isin(*splits))


def read_json_lines(
    spark: SparkSession, path: str | list[str], schema: T.StructType, nan_is_missing: bool = False
) -> DataFrame:
    """JSON Lines with a fixed schema plus ``_seq``; blank lines are skipped, a bad line is fatal.

    With ``nan_is_missing`` a bare ``NaN`` in a text column, which Spark reads as text, becomes
    NULL. Only the posts source writes such values, and it never holds that word as text.
    A batch that keeps the order of its landed files has that order, any other that of its own.
    """
    kept = T.StructType([*schema.fields, T.StructField(KEPT_ORDER, ORDER)])
    rows = spark.read.schema(kept).option("mode", "FAILFAST").json(path)
    columns = [
        f"nullif(`{f.name}`, 'NaN') AS `{f.name}`"
        if nan_is_missing and isinstance(f.dataType, T.StringType)
        else f"`{f.name}`"
        for f in schema.fields
    ]
    return with_file_order(rows).selectExpr(*columns, f"coalesce({KEPT_ORDER}, _seq) AS _seq")


def read_news_payloads(
    spark: SparkSession, path: str | list[str], max_pages: int | None = None
) -> DataFrame:
    """Articles of the landed result pages of one pull, in page order.

    A pull is a folder of pages. Reading one stops at its first empty page, at the last page the
    source announces, and after ``max_pages``. A page that does not tell its number is read in any
    case. Page headers are a few numbers per file; the first empty page of each pull is a small
    written table, which the wide rows meet without a shuffle while it is below the threshold.
    """
    pages = spark.read.schema(S.NEWS_PAYLOAD).option("mode", "FAILFAST").json(path)
    kind = pages.schema["response"].dataType["results"].dataType
    number = F.col("response.currentPage")
    numbered = pages.select(
        number.alias("page"),
        F.col("response.pages").alias("pages"),
        F.coalesce(F.col("response.results"), F.array().cast(kind)).alias("results"),
        file_order(number).alias("_page_order"),
    ).withColumn("pull", F.col("_page_order.folder"))
    ends = materialize(
        numbered.where(F.size("results") == 0).groupBy("pull").agg(F.min("page").alias("end")),
        "pull-ends",
    )
    no_limit = F.lit(2**31 - 1)
    read = numbered.join(ends, "pull", "left").where(
        F.col("page").isNull()
        | (
            (F.col("page") < F.coalesce("end", no_limit))
            & (F.col("page") <= F.coalesce("pages", no_limit))
        )
    )
    if max_pages is not None:
        read = read.where(F.col("page").isNull() | (F.col("page") <= max_pages))
    return read.select("_page_order", F.posexplode("results").alias("pos", "item")).select(
        "item.*", F.col("_page_order").withField("pos", F.col("pos").cast("int")).alias("_seq")
    )


def read_feed_items(spark: SparkSession, path: str | list[str], limit: int | None = None) -> DataFrame:
    """Items of a feed (link, title, date, summary); the first ``limit`` in feed order."""
    items = (
        spark.read.format("xml")
        .schema(S.FEED_ITEM)
        .option("rowTag", "item")
        .option("mode", "FAILFAST")
        .load(path)
    )
    ordered = with_file_order(items)
    return ordered if limit is None else ordered.orderBy("_seq").limit(limit)


def latest_batch(df: DataFrame, batch: str = "batch_ts", source: str = "source") -> DataFrame:
    """Rows of the newest batch of each source; a fixed name is older than any time.

    The newest batch per source is a hash aggregate written as a small table of known size; the
    rows meet it in a broadcast join while it is below the broadcast threshold.
    """
    name = F.col(batch).cast("string")
    moment = F.struct(name.rlike(r"^[0-9]{8}(_[0-9]{6})?$"), F.col(batch))
    newest = materialize(
        df.groupBy(F.col(source).alias("_source")).agg(F.max_by(batch, moment).alias("_batch")),
        "latest-batch",
    )
    same = F.col(source).eqNullSafe(F.col("_source")) & (F.col(batch) == F.col("_batch"))
    return df.join(newest, same, "left_semi")


def _list_folder(spark: SparkSession, folder: str) -> list[tuple[str, str, int]]:
    """Name, path and modification time of the entries of a folder, without reading any data."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    return [
        (status.getPath().getName(), status.getPath().toString(), status.getModificationTime())
        for status in files.listStatus(path)
    ]


def latest_batch_path(spark: SparkSession, root: str, source: str | None = None) -> str | None:
    """Newest batch of a source, or None.

    Batches are ``batch_ts=...`` folders; ``*.jsonl`` files are accepted where there is no such
    folder. Of batches named by their time the last by name counts; it and any with fixed names
    are compared by the time at which they were written.
    """
    entries = _list_folder(spark, root if source is None else f"{root}/{source}")
    folders = [e for e in entries if e[0].startswith("batch_ts=")]
    timed = [e for e in folders if re.fullmatch(r"batch_ts=\d{8}(_\d{6})?", e[0])]
    newest = [max(timed)] if timed else []
    newest += [e for e in folders if e not in timed]
    newest = newest or [e for e in entries if e[0].endswith(".jsonl")]
    return max(newest, key=lambda e: (e[2], e[0]))[1] if newest else None


def read_splits(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """The split dataset; the split comes from the folder a record lies in."""
    schema = T.StructType([*S.ARTICLE.fields, T.StructField("split", T.StringType())])
    return spark.read.schema(schema).format(fmt).load(path)


def union_of(frames: Iterable[DataFrame]) -> DataFrame:
    """UNION ALL by column name."""
    first, *rest = frames
    for df in rest:
        first = first.unionByName(df)
    return first


def has_entries(spark: SparkSession, folder: str) -> bool:
    """True when the folder exists and holds data."""
    return any(not name.startswith(("_", ".")) for name, _, _ in _list_folder(spark, folder))
