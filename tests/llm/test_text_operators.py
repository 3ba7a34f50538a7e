"""Operators that look at one text at a time: encoding, quality, toxicity, benchmark items."""

from __future__ import annotations

import base64
import random
import tracemalloc
from hashlib import sha256
from types import SimpleNamespace
from unittest.mock import MagicMock

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from presswork.llm import bpe, contamination, jaccard, quality, toxicity
from presswork.llm.frames import prepare, slices
from tests.llm.samples import SENTENCES, documents, prose


@pytest.fixture(scope="module")
def oracle():
    with open(bpe.VOCABULARY, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def tool():
    with open(bpe.VOCABULARY, "rb") as file:
        return bpe.Encoder(file.read())


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("abeionrst AB01'.,\n\t éß漢😀\x00\x1c"), max_size=60))
def test_ids_equal_the_merges(tool, oracle, text):
    assert tool.encode(text) == oracle.encode_ordinary(text)
    assert tool.decode(tool.encode(text)) == text.encode()


@pytest.mark.parametrize("text", ["a" * 20_000, "ab" * 9000, " " * 5000, "é漢" * 3000, "x \n" * 90_000])
def test_long_texts(tool, oracle, text):
    assert tool.encode(text) == oracle.encode_ordinary(text)


def test_latin_pattern_is_the_general_one(tool):
    rng = random.Random(3)
    for _ in range(3000):
        text = "".join(chr(rng.randrange(0x250)) for _ in range(15))
        assert tool.latin.findall(text) == tool.pattern.findall(text)


def test_round_trip_keeps_all_rows(spark, oracle):
    prepare(spark)
    df = documents(spark)
    rows = bpe.round_trip(df.withColumnRenamed("n_chars", "n_tokens")).collect()
    texts = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in df.collect())
    found = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["decoded_sha256"], r["ids_sha256"], r["n_tokens"]) for r in rows)
    expected = []
    for null, key, text in texts:
        ids = oracle.encode_ordinary(text)
        packed = np.array(ids, "<u4").tobytes()
        expected.append((null, key, sha256(text.encode()).hexdigest(), sha256(packed).hexdigest(), len(ids)))
    assert found == sorted(expected)
    assert bpe.round_trip(df.limit(0)).count() == 0


def test_encode_and_decode_columns(spark):
    df = documents(spark).withColumnRenamed("lang", "token_ids")
    back = bpe.decode(bpe.encode(df))
    assert back.columns == ["doc_id", "source", "n_chars", "decoded"]
    texts = sorted((r["text"] or "").encode() for r in df.collect())
    assert sorted(bytes(r["decoded"]) for r in back.collect()) == texts


def test_ordinal_model_orders_grades(spark):
    rng = np.random.default_rng(1)
    bad, good = SENTENCES[:3], SENTENCES[3:6]
    rows = []
    for i in range(400):
        grade = i % 4
        words = [*(rng.choice(bad) for _ in range(6 - 2 * grade)), *(rng.choice(good) for _ in range(2 * grade))]
        rows.append((i, " ".join(words), float(grade)))
    df = spark.createDataFrame(rows, "doc_id long, text string, stars double")
    model = quality.train(df, df, "stars")
    assert model.grades == [0, 1, 2, 3] and (np.diff(model.thresholds) > 0).all()
    graded = quality.grade(df, model, 2.0).toPandas()
    means = graded.groupby("stars")["expected_grade"].mean()
    assert means.is_monotonic_increasing and means[3] > 2.4 and means[0] < 0.6
    assert ((graded["tail_probability"] >= 0.5) == graded["selected"]).all()
    assert (graded["selected"] == (graded["stars"] >= 2)).mean() > 0.95


def test_quality_of_rough_rows(spark):
    df = documents(spark).withColumnRenamed("lang", "selected")
    rated = spark.createDataFrame([(1, "a b", 1.0), (2, None, None)], "doc_id long, text string, r double")
    one = quality.train(rated, rated, "r")
    graded = quality.grade(df, one, 1.0)
    assert graded.count() == df.count() and graded.filter("selected").count() == df.count()
    none = quality.train(rated.limit(0), rated.limit(0), "r")
    assert quality.grade(df, none, 1.0).filter("selected").count() == 0
    assert graded.columns.count("selected") == 1


def _peak(run, batches) -> int:
    """Most MB that Python holds at once while ``run`` goes through the batches."""
    tracemalloc.start()
    try:
        for _ in run(iter(batches)):
            pass
        return tracemalloc.get_traced_memory()[1] >> 20
    finally:
        tracemalloc.stop()


def test_features_are_made_of_few_texts_at_a_time(spark):
    rng = random.Random(2)
    texts = [" ".join(f"{rng.getrandbits(40):x}" for _ in range(200)) for _ in range(700)]
    df = MagicMock()
    df.sparkSession.sparkContext.broadcast.side_effect = lambda model: SimpleNamespace(value=model)
    quality.grade(df, quality.Ordinal([0.0, 1.0], np.zeros(1), np.zeros(quality.BINS)), 1.0)
    run = df.drop.return_value.mapInArrow.call_args[0][0]
    run(iter([]))
    assert _peak(run, [pa.RecordBatch.from_pydict({"text": texts})]) < 60


def test_shingles_are_counted_in_place(spark):
    rng = random.Random(3)
    texts = [" ".join(f"{rng.getrandbits(30):x}" for _ in range(5000)) for _ in range(900)]
    df = MagicMock()
    jaccard.shingle_counts(df)
    run = df.select.return_value.mapInArrow.call_args[0][0]
    batches = [pa.RecordBatch.from_pydict({"text": texts[k : k + 10] + texts[k : k + 1]}) for k in range(0, 900, 10)]
    assert _peak(run, batches) < 130


def _language(texts):
    total = np.zeros(toxicity.CODES**3, np.int64)
    codes = toxicity.TABLE[np.frombuffer("".join(f" {t} " for t in texts).encode(), np.uint8)]
    np.add.at(total, (codes[:-2] * 128 + codes[1:-1]) * 128 + codes[2:], 1)
    grams = np.flatnonzero(total)
    return toxicity.LanguageModel(grams, total[grams])


def test_disguises_are_undone():
    tool = toxicity.Restorer(_language(["the idiot was a moron and a stupid clown in the trash"] * 30))
    for written, meant in {
        "an 1d10t here": "an idiot here", "m0r0n": "moron", "i d i o t": "idiot",
        "m.o.r.o.n": "moron", "stuuuuupid": "stupid", "cl0wn!": "clown!", "tr@sh": "trash",
    }.items():
        assert tool.text(written) == meant
    for plain in ("", "all is well.", "in 1999 and 4703207988783059", "THE!! END!!", "a b c", "é" * 3 + " x"):
        assert tool.text(plain).lower() == plain.lower() or "é" in plain


def test_toxicity_learns_and_generalises(spark):
    prepare(spark)
    rng = random.Random(2)
    insults = ["idiot", "moron", "clown"]
    rows = []
    for i in range(600):
        words = prose(rng, 30).split()
        if i % 3 == 0:
            words[5:5] = [rng.choice(insults)]
        rows.append((i, " ".join(words), int(i % 3 == 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.learn(df, df)
    tests = [(1, prose(rng, 40)), (2, prose(rng, 20) + " you m0ron " + prose(rng, 20)), (3, "i d i o t"), (4, None), (5, "")]
    found = toxicity.score(spark.createDataFrame(tests, "doc_id long, text string"), model)
    scores = {r["doc_id"]: r["score"] for r in found.collect()}
    assert scores[1] < 0.5 and scores[2] >= 0.5 and scores[3] >= 0.5 and scores[4] == scores[5] < 0.5
    rough = documents(spark).withColumnRenamed("lang", "score")
    assert toxicity.score(rough, model).count() == rough.count()
    empty = df.limit(0)
    prior = toxicity.learn(empty, empty)
    assert {round(r["score"], 3) for r in toxicity.score(rough, prior).collect()} == {0.5}


def _brute_contamination(text: str, item: str) -> int:
    def words(t):
        return "".join(c.lower() if c.isalnum() or ord(c) > 127 else " " for c in t).split()

    item, text = words(item), words(text)
    row = [0] * (len(text) + 1)
    for i, word in enumerate(item, 1):
        new = [i]
        for j, other in enumerate(text, 1):
            new.append(min(row[j - 1] + (word != other), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_edited_items_are_found():
    rng = random.Random(8)
    items = [(k, prose(rng, rng.randrange(10, 60))) for k in range(60)]
    index = contamination.Index(items)
    texts, truth = [], set()
    for i in range(300):
        base = prose(rng, 120).split()
        if i % 2:
            k, item = rng.choice(items)
            edited = item.split()
            for _ in range(int(len(edited) * rng.choice([0, 0.05, 0.1, 0.15]))):
                edited[rng.randrange(len(edited))] = rng.choice(["zzz", edited[0]])
            base[40:40] = edited
        texts.append(" ".join(base))
    for i, text in enumerate(texts):
        for k, item in items:
            if _brute_contamination(text, item) <= int(0.2 * len(item.split()) + 1e-9):
                truth.add((i, k))
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    found = set()
    for _, body, bounds in slices([batch], "text", 1 << 40):
        for row, item, edits, start, end in index.search(body, bounds):
            found.add((row, index.ids[item]))
            stretch = body[start:end].tobytes().decode().split(texts[row][0] + "\0")[0]
            assert edits == _brute_contamination(stretch, items[item][1])
    assert found <= truth and len(found) >= 0.97 * len(truth) and len(truth) >= 140


@pytest.mark.parametrize("size", [15, 30, 59])
def test_edits_at_the_limit_are_found_wherever_they_are(size):
    rng = random.Random(size)
    items = [(k, prose(rng, size)) for k in range(50)]
    limit, texts, truth = int(0.2 * size), [], set()
    for k, item in items:
        words = item.split()
        for at in (0, size // 2, size - limit):
            for new in (["zzz"] * limit, []):  # foreign words in their place, or none
                own = [*words[:at], *new, *words[at + limit :]]
                for text in (own, prose(rng, 30).split() + own + prose(rng, 30).split()):
                    truth.add((len(texts), k))
                    texts.append(" ".join(text))
        spread = list(words)
        for at in rng.sample(range(size // 2), limit):
            spread[at] = "zzz"
        truth.add((len(texts), k))
        texts.append(" ".join(spread))
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    index, found = contamination.Index(items), set()
    for _, body, bounds in slices([batch], "text", 1 << 40):
        found = {(row, index.ids[item]) for row, item, *_ in index.search(body, bounds)}
    assert found == truth


def test_short_items_and_scripts_without_spaces():
    items = [(1, "Zebra crossing"), (2, "four words in order"), (3, "one more than four words"), (4, "?!"),
             (5, "昔々ある所に、お爺さんとお婆さんが住んでいました。"), (6, "กาลครั้งหนึ่งนานมาแล้ว"), (7, "Quagga"),
             (8, "𠀀𠀁")]
    texts = ["the zebra crossing", "zebra and crossing", "four, words; in order!", "four words not in order",
             "one more than six words", "話は昔々ある所に、お爺さんとお姫さんが住んでいましたと続く", "xกาลครั้งหนึ่งนานมาแล้วจบ", "?!",
             "a quagga.", "quaggas", "昔々", "漢𠀀𠀁字", "zebra", "crossing"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    index, found = contamination.Index(items), set()
    for _, body, bounds in slices([batch], "text", 1 << 40):
        for row, item, edits, start, end in index.search(body, bounds):
            found.add((row, index.ids[item], edits, body[start:end].tobytes().decode()))
    assert found == {
        (0, 1, 0, "zebra crossing"), (2, 2, 0, "four, words; in order"), (4, 3, 1, texts[4]),
        (5, 5, 2, texts[5][2:-3]), (6, 6, 0, texts[6][1:-2]), (8, 7, 0, "quagga"), (11, 8, 0, "𠀀𠀁"),
    }


def test_contamination_of_rough_rows(spark):
    item = "the seven grey herons stood along the frozen river until the evening bell rang out"
    items = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "too short"), (5, item)], "item_id long, text string")
    df = documents(spark)
    more = spark.createDataFrame([(900, f"é {item.upper()}!", "en", "s", 1), (None, item, "en", "s", 1)], df.schema)
    both = df.unionByName(more)
    hits = contamination.matches(both, items).collect()
    assert sorted((r["doc_id"] or 0, r["item_id"], r["edits"], r["start"], r["end"]) for r in hits) == [
        (0, 1, 0, 0, len(item)), (0, 5, 0, 0, len(item)),
        (900, 1, 0, 2, len(item) + 2), (900, 5, 0, 2, len(item) + 2),
    ]
    clean = contamination.decontaminated(both, items)
    assert clean.columns == df.columns and clean.count() == df.count()
    assert contamination.decontaminated(both, items.limit(0)).count() == both.count()
    assert contamination.matches(both.limit(0), items).count() == 0


def test_items_come_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(contamination, "BLOCK_ITEMS", 2)
    rng = random.Random(4)
    texts = [prose(rng, 20) for _ in range(5)]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    df = spark.createDataFrame([(i, "x " + t) for i, t in enumerate(texts)] + [(9, "y")], "doc_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in contamination.matches(df, items).collect()} == {(i, i) for i in range(5)}
    assert [r["doc_id"] for r in contamination.decontaminated(df, items).collect()] == [9]


def test_fit_holds_little_besides_its_entries():
    rng = np.random.default_rng(3)
    rows = np.repeat(np.arange(1000, dtype=np.int32), 1500)
    bins = rng.integers(0, quality.BINS, len(rows)).astype(np.int16)
    values = rng.random(len(rows), dtype=np.float32)
    tracemalloc.start()
    try:
        model = quality.fit_ordinal(rows, bins, values, np.arange(1000) % 2.0, passes=1)
        held = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert held < 9e6  # an array of numbers for all entries takes 12 MB
    total = np.bincount(rows, model.weights[bins] * values)
    assert (quality._added(rows, bins, model.weights, values, 1000) == total).all()
