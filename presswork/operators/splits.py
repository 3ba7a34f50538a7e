"""Deterministic, stratified and leakage-safe train / validation / test assignment.

Rows with the same content form a group, a group belongs to the stratum ``(source, label)`` of its
first member, and inside a stratum the groups are ordered by a seeded hash and cut by quotas.

A row needs only two facts to find its split: its stratum and the two hash values at which that
stratum is cut. The cuts are order statistics of a slim group table, found without sorting it, so
the wide rows are neither shuffled nor sorted: they meet a table of cuts, and a table of the few
groups whose members disagree on the stratum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork import schemas as S
from presswork.functions.columns import content_key
from presswork.session import materialize

# Hexadecimal digits of the hash that name a bucket: 65,536 buckets per stratum.
_BUCKET_DIGITS = 4


def with_content_key(df: DataFrame) -> DataFrame:
    return df.withColumn("content_key", content_key())


def content_groups(df: DataFrame, order: str = "_seq") -> DataFrame:
    """One row per content: the stratum of its first member and whether members disagree.

    Only the key, the order and the stratum are read. Partial aggregation folds each task's
    copies of a content into one row before the shuffle.
    """
    slim = with_content_key(df).selectExpr(
        "content_key",
        order,
        "named_struct('source', source, 'label', coalesce(label, 'null')) AS stratum",
    )
    return (
        slim.groupBy("content_key")
        .agg(
            F.expr(f"min_by(stratum, {order}) AS head"),
            F.expr("min(stratum) AS low"),
            F.expr("max(stratum) AS high"),
        )
        .selectExpr(
            "content_key",
            "head.source AS source",
            "head.label AS label",
            "CASE WHEN low <=> high THEN 0 ELSE 1 END AS mixed",
        )
    )


def _quotas(n: str, ratios: tuple[float, float, float]) -> tuple[str, str]:
    """SQL of the train and validation sizes of ``n`` groups, rounded half to even.

    The rest is test; ratios that add up to more than one leave less for validation.
    """
    train, validation = (f"CAST(bround({n} * {float(r)!r}D) AS BIGINT)" for r in ratios[:2])
    return train, f"least({validation}, {n} - {train})"


def split_quotas(
    df: DataFrame, ratios: tuple[float, float, float] = S.DEFAULT_RATIOS, order: str = "_seq"
) -> DataFrame:
    """Number of content groups per stratum and how many go to each split."""
    train, validation = _quotas("n_groups", ratios)
    return (
        content_groups(df, order)
        .groupBy("source", "label")
        .agg(F.count("*").alias("n_groups"))
        .selectExpr(
            "source",
            "label",
            "n_groups",
            f"{train} AS n_train",
            f"{validation} AS n_validation",
            "n_groups - n_train - n_validation AS n_test",
        )
    )


def _order_hash(seed: int) -> str:
    return f"sha2(concat('{int(seed)}:', content_key), 256)"


def split_cuts(groups: DataFrame, ratios: tuple[float, float, float], seed: int) -> DataFrame:
    """Per stratum, the hash of the last train group and of the last validation group.

    Groups are counted per hash bucket, running counts tell which bucket holds each cut, and only
    those buckets (two per stratum, about 1/65,536 of it each) are ranked.
    """
    placed = groups.selectExpr(
        "source",
        "label",
        f"{_order_hash(seed)} AS position",
        f"substring(position, 1, {_BUCKET_DIGITS}) AS bucket",
    )
    train, validation = _quotas("total", ratios)
    stratum = "PARTITION BY source, label"
    edges = materialize(
        placed.groupBy("source", "label", "bucket")
        .agg(F.count("*").alias("n"))
        .selectExpr(
            "*",
            f"sum(n) OVER ({stratum} ORDER BY bucket) - n AS before",
            f"sum(n) OVER ({stratum}) AS total",
        )
        .selectExpr(
            "source AS e_source",
            "label AS e_label",
            "bucket AS e_bucket",
            "n",
            "before",
            f"stack(2, 'train_end', least({train}, total), "
            f"'validation_end', least({train} + {validation}, total)) AS (cut, rank)",
        )
        .where("rank > before AND rank <= before + n")
        .selectExpr("e_source", "e_label", "e_bucket", "cut", "rank - before AS rank"),
        "split-edges",
    )
    same_bucket = F.expr("source <=> e_source AND label = e_label AND bucket = e_bucket")
    at = f"row_number() OVER ({stratum}, cut ORDER BY position) AS at"
    return (
        placed.join(edges, same_bucket)
        .selectExpr("source", "label", "cut", "rank", "position", at)
        .where("at = rank")
        .groupBy("source", "label")
        .agg(
            F.expr("max(CASE WHEN cut = 'train_end' THEN position END) AS train_end"),
            F.expr("max(CASE WHEN cut = 'validation_end' THEN position END) AS validation_end"),
        )
    )


def assign_splits(
    df: DataFrame,
    ratios: tuple[float, float, float] = S.DEFAULT_RATIOS,
    seed: int = S.DEFAULT_SEED,
    order: str = "_seq",
) -> DataFrame:
    """Add ``content_key`` and ``split`` to every row.

    ``order`` must be unique per row; it decides which member of a group comes first.
    """
    groups = materialize(content_groups(df, order), "content-groups", partition_by=["mixed"])
    cuts = materialize(split_cuts(groups, ratios, seed), "split-cuts").selectExpr(
        "source AS c_source", "label AS c_label", "train_end", "validation_end"
    )
    heads = groups.where("mixed = 1").selectExpr(
        "content_key", "named_struct('source', source, 'label', label) AS _head"
    )
    own = "named_struct('source', source, 'label', coalesce(label, 'null'))"
    staged = (
        with_content_key(df)
        .join(heads, "content_key", "left")
        .selectExpr(
            *[f"`{c}`" for c in df.columns],
            "content_key",
            f"coalesce(_head, {own}) AS _stratum",
            f"{_order_hash(seed)} AS _position",
        )
    )
    train, validation, test = S.SPLITS
    split = (
        f"CASE WHEN _position <= train_end THEN '{train}' "
        f"WHEN _position <= validation_end THEN '{validation}' ELSE '{test}' END AS split"
    )
    same_stratum = F.expr("_stratum.source <=> c_source AND _stratum.label = c_label")
    return staged.join(cuts, same_stratum, "left").selectExpr(
        *[f"`{c}`" for c in df.columns], "content_key", split
    )
