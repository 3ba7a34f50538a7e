"""Near duplicates by chosen paths, against all pairs in full."""

from __future__ import annotations

import random

import pytest

from presswork.llm import minhash
from presswork.llm.frames import prepare
from tests.llm.samples import documents, prose
from tests.llm.test_corpus_operators import as_rows, brute_classes, sample_texts


def expected(rows):
    return [(k, n, c, k is None or k == c) for k, n, c in brute_classes(rows, width=4)]


@pytest.mark.parametrize("seed", [3, 4])
def test_near_duplicates_equal_brute_force(spark, seed):
    prepare(spark)
    rows = sample_texts(seed, 400)
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert as_rows(found) == sorted(expected(rows))


@pytest.mark.parametrize("limit", [1000, 60])
def test_groups_of_copies_and_a_common_passage(spark, monkeypatch, limit):
    """A dense group, a chain of small edits, and many texts that share a third of their words."""
    monkeypatch.setattr(minhash, "NODE_DOCUMENTS", limit)  # nodes branch, or are cut into blocks
    rng, rows = random.Random(9), []
    base = prose(rng, 100).split()
    for _ in range(250):
        copy = list(base)
        for _ in range(rng.choice([0, 1, 2, 3])):
            copy[rng.randrange(100)] = f"w{rng.randrange(10**6)}"
        rows.append(" ".join(copy))
    chain = prose(rng, 80).split()
    for k in range(60):
        chain[k] = f"c{k}"
        rows.append(" ".join(chain))
    passage = prose(rng, 40)
    rows += [f"{prose(rng, 40)} {passage} {prose(rng, 40)}" for _ in range(150)]
    keys = list(range(len(rows)))
    rng.shuffle(keys)
    rows = list(zip(keys, rows, strict=True))
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert as_rows(found) == sorted(expected(rows))


def test_near_duplicates_of_rough_rows(spark):
    df = documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    order = lambda t: tuple((x is None, x or 0) for x in t)
    clash = df.withColumnRenamed("lang", "component_id").withColumnRenamed("source", "node")
    assert as_rows(minhash.near_duplicates(clash)) == sorted(expected(rows), key=order)
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_pairs_at_the_limit_meet():
    """The chosen coordinates of all roots leave next to no pair at the limit apart."""
    chosen = minhash.chosen_at_root()
    assert {t for t, _ in chosen} == set(range(minhash.TREES))
    assert (1 - minhash.PERCENT / 100) ** len({c for _, c in chosen}) < 1e-12
