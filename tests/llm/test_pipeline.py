"""The pipeline over a small folder of tables, against plain versions of its stages."""

from __future__ import annotations

import random
from hashlib import sha256

from pyspark.sql import functions as F

import corpus_pipeline
from presswork.llm import queries
from tests.llm.samples import prose


def test_stages_take_effect(spark, tmp_path):
    rng = random.Random(12)
    texts = {i: prose(rng, 120) for i in range(80)}
    for i in range(20):
        texts[100 + i] = " ".join(["SPAM!!"] * 40 + prose(rng, 5).upper().split())
    texts[80] = texts[3]  # an exact copy
    texts[81] = texts[4] + " end"  # a near copy
    passage = prose(rng, 70)
    texts[5] = prose(rng, 60) + " " + passage + " " + prose(rng, 60)
    texts[6] = prose(rng, 60) + " " + passage + " " + prose(rng, 60)
    item = prose(rng, 30)
    texts[7] = prose(rng, 50) + " " + item + " " + prose(rng, 50)
    docs = [(i, t, "en", "s", len(t)) for i, t in texts.items()]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(docs, schema).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, int(i < 100), 0) for i in texts if i % 2]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(found) == set(range(80)) - {7}
    for i, row in found.items():
        same = row["decoded_sha256"] == sha256(texts[i].encode()).hexdigest()
        assert same == (i != 6)


def test_first_stages_on_rough_rows(spark, tmp_path):
    rng = random.Random(13)
    good = [prose(rng, 60) for _ in range(30)]
    bad = [" ".join(["SPAM!!"] * 40 + prose(rng, 5).upper().split()) for _ in range(10)]
    rows = [(i, t, f"own {i}", i) for i, t in enumerate(good + bad)]
    labels = [(i, int(i < 30)) for i in range(40)]
    rows += [rows[2], (3, good[4] + " end", "other", 0), (3, prose(rng, 60), "third", 0), (None, good[5], "no id", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, selected string, component_id long")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    clean = corpus_pipeline.quality_filter(spark, docs, str(tmp_path))
    assert clean.schema == docs.schema
    wanted = [r for r in rows if r[1] not in bad]
    assert sorted(map(str, clean.collect())) == sorted(map(str, spark.createDataFrame(wanted, docs.schema).collect()))
    kept = corpus_pipeline.near_duplicates(spark, clean, str(tmp_path))
    assert kept.columns == docs.columns
    # A document of id 3 is like that of id 4 and stays for their class: its id is the smaller one.
    assert sorted(r["selected"] for r in kept.collect()) == sorted(
        [f"own {i}" for i in range(30) if i != 4] + ["other", "third", "no id"]
    )
    nothing = docs.filter("doc_id is null").withColumn("text", F.lit(None).cast("string"))
    assert corpus_pipeline.near_duplicates(spark, nothing, str(tmp_path)).count() == 1


def test_all_operators_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLES) <= set(queries.QUERIES)
