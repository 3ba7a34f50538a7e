"""The registered queries of this subpackage and, where SQL can express one, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from presswork.llm import (
    audit,
    bpe,
    contamination,
    jaccard,
    licenses,
    minhash,
    neighbours,
    quality,
    repeats,
    sharding,
    tokenstore,
    toxicity,
    whitening,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        sharding.op1_sharding,
        bpe.op2_byte_bpe,
        contamination.op3_decontamination,
        repeats.op4_substring_dedup,
        tokenstore.op5_token_store,
        toxicity.op6_toxicity,
        quality.op7_ordinal_quality,
        neighbours.op8_nearest,
        licenses.op9_license_scan,
        jaccard.op10_ngram_jaccard,
        minhash.op11_minhash_dedup,
        whitening.op12_whitening,
        audit.op13_filter_audit,
    )
}

#: The other operators have no SQL that ends on whole tables; their tests compare them with brute
#: force, exact round trips or held-out labels.
ORACLES: dict[str, str] = {
    "op1_sharding": sharding.ORACLE,
    "op10_ngram_jaccard": minhash.similarity_sql(jaccard.WIDTH, kept=False),
    "op11_minhash_dedup": minhash.ORACLE,
    "op13_filter_audit": audit.ORACLE,
}
