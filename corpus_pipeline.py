"""The corpus pipeline: documents in, token ids out, in stages that each call one operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.llm import bpe, contamination, jaccard, quality, repeats
from presswork.llm.frames import prepare, read
from presswork.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the table of labels, accepts.

    A null text is graded as an empty one, and a repeated row like any other. Columns keep their
    values, whatever their names. An empty table gives an empty one.
    """
    prepare(spark)
    model = quality.train(docs, read(spark, sf_dir, "labels"), "quality")
    return quality.accepted(docs, model, 1.0)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar ones, that with the smallest id.

    Null and empty texts are like nothing and stay; so do rows with a null id. Of rows that repeat
    id and text one stays; a different text under the same id is judged for itself. Other columns
    play no part. An empty table gives an empty one.
    """
    prepare(spark)
    return jaccard.one_per_class(docs).select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that an earlier one has; ``n_chars`` follows the text."""
    prepare(spark)
    cut = repeats.without_repeats(docs)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut.select(*docs.columns)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    prepare(spark)
    return contamination.decontaminated(docs, read(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level ids of every text: their number and digest, and the digest of the text back."""
    prepare(spark)
    return bpe.round_trip(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_filter),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", benchmark_free),
    ("tokens", tokens),
]

#: A trained model and a similarity join have no SQL that ends on whole tables.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and read before the next one."""
    prepare(spark)
    docs = read(spark, sf_dir, "documents")
    for position, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if position < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{name}")
    return docs
