"""Invented texts for the tests of this folder."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SENTENCES = [
    "BUY NOW!!! buy now!!!", "click click click here", "$$$ win win win $$$",
    "The harbour froze early that winter.", "Two barges waited by the lock.",
    "Nobody had kept the old ledger.", "A lamp burned in the signal house.",
]
_PARTS = "ka ro mi ten sul var pel ond gri esk tam bo lu fen dra ith".split()


def prose(rng: random.Random, words: int) -> str:
    """Invented words in sentences of about nine words."""
    out = []
    for k in range(words):
        word = "".join(rng.choice(_PARTS) for _ in range(rng.choice([1, 2, 2, 3, 3])))
        out.append(word + ("." if k % 9 == 8 else ""))
    return " ".join(out)


def documents(spark: SparkSession) -> DataFrame:
    """Rows with nulls, empty and very long texts, ties and repeats, in the columns of documents."""
    rng = random.Random(1)
    same = prose(rng, 60)
    rows = [
        (1, same, "en", "a", 1), (1, same, "en", "a", 1), (2, same, None, None, None),
        (3, None, "en", "a", 0), (4, "", "en", "a", 0), (5, " \n\t ", "de", "b", 3),
        (None, same, "en", "a", 1), (None, None, None, None, None), (6, "one", "en", "a", 3),
        (7, prose(rng, 40_000), "en", "b", 1), (8, "w" * 300_000, "en", "b", 1),
        (9, "é漢😀 \x00 ’ it's", "fr", "c", 9), (10, "one", "en", "a", 3),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    return spark.createDataFrame(rows, schema)
