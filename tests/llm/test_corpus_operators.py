"""Operators that compare texts or vectors, place rows, or write files."""

from __future__ import annotations

import random
import re
import resource
import textwrap
import tracemalloc
from collections import Counter
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from presswork.llm import bpe, components, frames, jaccard, licenses, neighbours, repeats, sharding, tokenstore, words
from presswork.llm.frames import prepare, texts
from presswork.llm.words import Words, shingles
from presswork.session import scratch_root
from tests.llm.samples import documents, prose


# --- Sharding ---------------------------------------------------------------------------------
def test_table_is_even_and_stable():
    names = [f"s{i}" for i in range(10)]
    table = sharding.fill_table(names, 1009)
    sizes = np.bincount(table)
    assert sizes.max() - sizes.min() <= 1
    fewer = sharding.fill_table(names[:-1], 1009)
    moved = sum(a != b for a, b in zip(table, fewer, strict=True) if a != 9)
    assert moved < 0.15 * 1009
    with pytest.raises(ValueError):
        sharding.fill_table(names, 1000)
    with pytest.raises(ValueError):
        sharding.fill_table(["a", "a"], 11)


def test_rows_with_equal_keys_meet(spark):
    df = documents(spark).withColumnRenamed("lang", "shard")
    placed = sharding.assign_shards(df, ["doc_id", "source"], ["a", "b", "c"], 101).cache()
    assert placed.count() == df.count() and placed.columns == ["doc_id", "text", "source", "n_chars", "slot", "shard"]
    per_key = placed.groupBy("doc_id", "source").agg(F.countDistinct("shard").alias("n"))
    assert per_key.filter("n <> 1").count() == 0
    plan = placed._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "Python" not in plan
    assert sharding.assign_shards(df.limit(0), ["doc_id"], ["a"], 11).count() == 0


# --- Similarity join --------------------------------------------------------------------------
def brute_classes(rows, width=5):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for key, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
        wide = {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()
        sets.append((key, wide))
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (a, x) in enumerate(sets):
        for j, (b, y) in enumerate(sets[:i]):
            if a is not None and b is not None and x and y and 100 * len(x & y) >= 80 * len(x | y):
                parent[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(sets):
        if key is not None:
            least[root(i)] = min(least.get(root(i), key), key)
    return [(k, len(s), None if k is None else least[root(i)]) for i, (k, s) in enumerate(sets)]


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, x or 0) for x in t))


def sample_texts(seed, n):
    rng = random.Random(seed)
    rows, key = [], 0
    while len(rows) < n:
        base = prose(rng, rng.choice([3, 8, 40, 120])).split()
        for _ in range(rng.choice([1, 1, 2, 12])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(["Edit", "é"])
            rows.append((key, " ".join(copy)))
            key += rng.choice([1, 1, 3])
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_equal_brute_force(spark, seed):
    prepare(spark)
    rows = sample_texts(seed, 300)
    found = jaccard.similarity_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert as_rows(found) == sorted(brute_classes(rows))


def test_hot_group_of_near_copies(spark):
    rng = random.Random(5)
    base, rows = prose(rng, 100).split(), []
    for key in range(400):
        copy = list(base)
        for _ in range(rng.choice([0, 1, 2, 3])):
            copy[rng.randrange(100)] = f"w{rng.randrange(10**6)}"
        rows.append((key, " ".join(copy)))
    found = jaccard.similarity_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert as_rows(found) == sorted(brute_classes(rows))


def _batches(bodies: list[str]) -> list[pa.RecordBatch]:
    ids = pa.array(range(len(bodies)), pa.int64())
    return pa.Table.from_arrays([ids, ids, pa.array(bodies)], names=["key", "order", "text"]).to_batches(1000)


def _peak_mb(rows) -> float:
    """Of what numpy takes while ``rows`` are worked out."""
    tracemalloc.start()
    try:
        for _ in rows:
            pass
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_workers_hold_little_text_as_arrays():
    """A worker stays, with what it once took, for all stages of the pipeline."""
    rng = random.Random(18)
    batches = _batches([prose(rng, 100) for _ in range(2000)] * 2)
    assert _peak_mb(jaccard._counted(iter(batches))) < 85  # two tables of 32 MB, and a slice
    assert _peak_mb(repeats._units_of(iter(batches), 12)) < 25


def test_a_worker_keeps_no_tools_of_other_operators(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "some text " * 30), (2, None)], "doc_id long, text string")
    run = {}  # what each operator gives to its workers

    def noted(self, task, schema):
        run[operator] = task
        return spark.createDataFrame([], schema)

    monkeypatch.setattr(type(docs), "mapInArrow", noted)
    operator = "tokens"
    bpe.round_trip(docs)
    operator = "counts"
    jaccard.shingle_counts(docs)
    operator = "units"
    repeats.units(docs)
    bodies = ["some text " * 30] * 2
    batch = pa.RecordBatch.from_pydict({"key": [1, 2], "text": bodies})
    rows = pa.RecordBatch.from_pydict({"rank": [1, 2], "text_key": [3, 4], "text": bodies})
    given = {"tokens": batch, "counts": batch.select(["text"]), "units": rows}

    def kept(name) -> tuple[int, int]:
        assert list(run[name](iter([given[name]])))
        return bpe.encoder.cache_info().currsize, words._powers.cache_info().currsize

    words._powers(16)
    assert kept("tokens") == (1, 0)
    assert kept("tokens") == (1, 0)  # the encoder serves the next task of its operator
    assert kept("counts") == (0, 0)
    assert kept("tokens") == (1, 0)
    assert kept("units") == (0, 0)


def test_freed_memory_goes_back():
    """Blocks below those that are still used do not stay with the worker."""

    def held() -> int:
        with open("/proc/self/statm") as file:
            return int(file.read().split()[1]) * resource.getpagesize() // 1_000_000

    def run(batches):
        blocks = [bytearray(60_000) for _ in range(3000)]
        last.append(blocks[-1])
        yield from batches

    last, before = [], held()
    assert list(frames.lean(run)(iter([1, 2]))) == [1, 2]
    assert held() - before < 90  # of 180 MB


@pytest.mark.parametrize("step", [1, 2, 7, 1 << 18])
def test_shingles_are_counted_across_steps(monkeypatch, step):
    monkeypatch.setattr(jaccard, "_STEP", step)
    monkeypatch.setattr(jaccard, "COUNT_BITS", 10)
    rng = random.Random(19)
    some = [prose(rng, 9) for _ in range(12)]
    bodies = [some[rng.randrange(12)] for _ in range(40)] + ["once and never again in this table"]
    values = [v for t in bodies for v in shingles(Words(*texts(pa.array([t]))))[0].tolist()]
    expected = Counter(v >> 54 for v, n in Counter(values).items() if n > 1 for _ in range(n))
    found = Counter()
    for part in jaccard._counted(iter(_batches(bodies))):
        found.update(dict(zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)))
    assert found == expected


def test_lists_of_the_same_members_have_the_same_leaders(spark):
    lists = (
        spark.range(20).withColumnRenamed("id", "token").crossJoin(spark.range(400).withColumnRenamed("id", "cid"))
        .filter("cid < 380 + token")
        .select("token", "cid", F.lit(100).alias("n"), F.lit(0).alias("place"), F.col("cid").alias("component"))
    )
    # Of 79,800 pairs; about LEADERS times 400 if all lists agree.
    assert 0 < jaccard._star_pairs(lists, 0).count() < 4 * jaccard.LEADERS * 400


def test_the_member_of_most_lists_leads(spark):
    rng = random.Random(6)
    rows = [(t, c, 100, 0, c) for t in range(30) for c in {7, *rng.sample(range(200), 40)}]
    lists = spark.createDataFrame(rows, "token long, cid long, n long, place int, component long")
    pairs = {(r["a"], r["b"]) for r in jaccard._star_pairs(lists, 0).collect()}
    assert all((min(c, 7), max(c, 7)) in pairs for _, c, *_ in rows if c != 7)


def test_sets_to_compare_are_shuffled_once(spark):
    """Also where the list of classes is above the planner's bound for broadcasts."""
    rows = [(k, prose(random.Random(k), 30)) for k in range(6)]
    df = spark.createDataFrame([*rows, rows[0], (1, rows[2][1])], "doc_id long, text string")
    levels = spark.sparkContext.broadcast(jaccard._levels(jaccard.shingle_counts(df)))
    sets = jaccard.shingle_sets(spark.createDataFrame(rows, df.schema), levels, "doc_id", "text")
    wanted = sets.select(F.col("key").alias("cid"), "digest", F.col("key").alias("min_key")).localCheckpoint()
    bound = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cut = jaccard._segments(df, wanted, levels, [0], "doc_id", "text")
        assert cut._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
        found = {(r["cid"], t) for r in cut.collect() for t in r["tokens"]}
        assert sum(len(r["tokens"]) for r in cut.collect()) == len(found)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
    assert {c: sum(x == c for x, _ in found) for c in range(6)} == {r["key"]: r["n"] for r in sets.collect()}


def test_split_lists_lose_no_link(spark, monkeypatch):
    """Unlike texts that share long passages, and edited copies of some: no list is short."""
    for name, value in (("SHORT", 1), ("ROUNDS", 0), ("LONG", 2), ("FEW", 0)):
        monkeypatch.setattr(jaccard, name, value)
    rng = random.Random(8)
    passages, rows = [prose(rng, 40) for _ in range(6)], []
    for _ in range(60):
        text = [*rng.sample(passages, 3), prose(rng, rng.randrange(4, 20))]
        rng.shuffle(text)
        for _ in range(rng.choice([1, 1, 2, 3])):
            words = " ".join(text).split()
            for _ in range(rng.randrange(4)):
                words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(words)))
    found = jaccard.similarity_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert as_rows(found) == sorted(brute_classes(rows))


def test_rows_of_one_key_are_judged_each(spark):
    rng = random.Random(9)
    a, b, c = (prose(rng, 30) for _ in "abc")
    rows = [(1, a), (5, a), (5, b), (7, c), (7, b), (7, c), (9, None), (9, ""), (None, a)]
    kept = jaccard.one_per_class(spark.createDataFrame(rows, "doc_id long, text string"))
    expected = [(1, a), (5, b), (7, c), (9, None), (9, ""), (None, a)]
    assert sorted(str(tuple(r)) for r in kept.collect()) == sorted(map(str, expected))


def test_classes_of_rough_rows(spark):
    df = documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    order = lambda t: tuple((x is None, x or 0) for x in t)
    assert as_rows(jaccard.similarity_classes(df)) == sorted(brute_classes(rows), key=order)
    assert jaccard.similarity_classes(df.limit(0)).count() == 0
    clash = df.withColumnRenamed("lang", "component_id").withColumnRenamed("source", "cid")
    kept = jaccard.one_per_class(clash)
    assert kept.columns == clash.columns
    ids = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect())
    assert ids == [(False, k) for k in (1, 3, 4, 5, 6, 7, 8, 9)] + [(True, 0)] * 2


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 3), (9, 8), (8, 7), (7, 9), (None, 4), (5, 6), (5, 6)]
    edges += [(100 + i, 101 + i) for i in range(40)]
    found = components.connected_components(spark.createDataFrame(edges, "a long, b long"))
    expected = {1: 1, 2: 1, 3: 1, 7: 7, 8: 7, 9: 7, 5: 5, 6: 5} | {100 + i: 100 for i in range(41)}
    assert {r["node"]: r["component"] for r in found.collect()} == expected
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- Repeated passages ------------------------------------------------------------------------
def test_passages_within_lines_are_cut(spark):
    prepare(spark)
    rng = random.Random(6)
    passages = [prose(rng, 60) for _ in range(20)]
    rows = []
    for i in range(120):
        words = prose(rng, 80).split()
        if i % 3:
            words[30:30] = [passages[i % 20]]
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spans = repeats.repeated_spans(df).toPandas()
    texts = dict(rows)
    first = {}
    for i in range(120):
        if i % 3:
            first.setdefault(i % 20, i)
    later = {i for i in range(120) if i % 3 and first[i % 20] != i}
    assert set(spans["rank"]) == later
    for span in spans.itertuples():
        piece = texts[span.rank][span.span_start : span.span_end]
        assert piece in passages[span.rank % 20] and span.first_rank == first[span.rank % 20]
        assert len(piece.split()) == span.n_words >= 12
    cut = {r["doc_id"]: r["text"] for r in repeats.without_repeats(df).collect()}
    assert all(cut[i] == texts[i] for i in range(120) if i not in later)
    assert all(len(cut[i]) < len(texts[i]) - 200 for i in later)


def test_lines_and_rough_rows(spark):
    line = "Sent from the office of the harbour master on the northern quay of the town"
    df = documents(spark).unionByName(
        spark.createDataFrame(
            [(50, f"é {line}\nx\n{line.upper()}!", "en", "s", 1), (40, f"{line}\nshort\n", "en", "s", 1),
             (None, f"a\n{line}", "en", "s", 1)],
            "doc_id long, text string, lang string, source string, n_chars long",
        )
    ).withColumnRenamed("lang", "spans").withColumnRenamed("source", "_rank")
    cut = repeats.without_repeats(df)
    assert cut.columns == df.columns and cut.count() == df.count()
    found = {(r["doc_id"], r["text"]) for r in cut.filter("doc_id >= 40 or doc_id is null").collect()}
    assert (40, f"{line}\nshort\n") in found and (50, "é \nx\n!") in found or (50, f"é {line}\nx\n!") in found
    assert (None, "a\n") in found and (None, None) in found
    same = {r["doc_id"]: r["text"] for r in cut.filter("doc_id in (1, 2)").collect()}
    assert len(same[1]) > 100 and len(same[2]) < 20
    assert repeats.repeated_spans(df.limit(0)).count() == 0


def test_short_lines_are_cut_but_not_short_fragments(spark):
    prepare(spark)
    rng = random.Random(12)
    lines = ["Share this page", "Subscribe", "Read more news from the harbour of the old town"]
    texts = [f"{lines[0]}\n{prose(rng, 30)}\n\n{lines[1]}\n{prose(rng, 30)}\n{lines[2]}" for _ in range(40)]
    texts += [f"{prose(rng, 20)} {lines[2]} {prose(rng, 20)}", f"unlike\n{lines[1]}\nother\n{lines[1].upper()}!"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = repeats.repeated_spans(df).toPandas().sort_values(["rank", "span_start"])
    pieces = {i: [texts[i][s.span_start : s.span_end] for s in own.itertuples()] for i, own in spans.groupby("rank")}
    assert pieces == {i: lines for i in range(1, 40)} | {41: [lines[1], lines[1].upper()]}
    assert set(spans["first_rank"]) == {0}
    assert spans["n_words"].tolist() == [len(p.split()) for i in sorted(pieces) for p in pieces[i]]
    cut = {r["doc_id"]: r["text"] for r in repeats.without_repeats(df).collect()}
    assert cut[0] == texts[0] and cut[40] == texts[40] and cut[41] == "unlike\n\nother\n!"


@pytest.mark.parametrize("bits", [26, 6])
def test_repeated_lines_equal_brute_force(spark, monkeypatch, bits):
    """Lines drawn from a pool: each stays where it comes first, also if the bit table is crowded."""
    monkeypatch.setattr(repeats, "FILTER_BITS", bits)
    prepare(spark)
    rng = random.Random(31)  # lines too long to be equal to a piece of another one
    pool = [prose(rng, rng.choice([8, 11, 12, 40])) for _ in range(150)]
    rows = [(k, "\n".join(rng.choice([line, line.upper()]) for line in rng.choices(pool, k=rng.choice([0, 1, 4, 9])))) for k in range(200)]
    seen, expected = set(), {}
    for k, text in rows:
        kept = []
        for line in text.split("\n"):
            words = re.findall(r"[a-z0-9]+", line.lower())
            if words and tuple(words) not in seen:
                kept.append(words)
            seen.add(tuple(words))
        expected[k] = kept
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    found = {r["doc_id"]: r["text"] for r in repeats.without_repeats(df).collect()}
    lines = {k: [w for line in t.split("\n") if (w := re.findall(r"[a-z0-9]+", line.lower()))] for k, t in found.items()}
    assert lines == expected


# --- Token store ------------------------------------------------------------------------------
def test_perfect_hash_is_minimal_and_tells_strangers():
    keys = np.unique(np.random.default_rng(2).integers(-(2**62), 2**62, 20_000))
    table = tokenstore.PerfectHash.build(keys)
    assert sorted(table.slots(keys).tolist()) == list(range(len(keys)))
    body = tokenstore.bucket_bytes(keys, keys.astype(np.int32), keys, keys)
    bucket = tokenstore.Bucket(body)
    there, at = bucket.find(keys)
    assert there.all() and (bucket.offset[at] == keys).all()
    strangers = np.arange(2**62 + 1, 2**62 + 20_001)
    assert bucket.find(strangers)[0].mean() < 0.001
    assert tokenstore.PerfectHash.build(np.array([5])).slots(np.array([5])).tolist() == [0]


def rough_store(spark):
    more = [(11, "a <|endoftext|> b<|startoftext|>", "x", "x", 1), (11, "A <|ENDOFTEXT|> É", "x", "x", 1), (5, "other", "x", "x", 1)]
    more += [(12, f"copy {k % 3}", "x", "x", 1) for k in range(200)] + [(None, "copy", "x", "x", 1)]
    df = documents(spark)
    return df.union(spark.createDataFrame(more, df.schema)).repartition(5)


def test_store_gives_back_every_row(spark, monkeypatch):
    from tokenizers import Tokenizer

    prepare(spark)
    monkeypatch.setattr(tokenstore, "BUCKET_KEYS", 30)
    df = rough_store(spark).withColumnRenamed("lang", "key").withColumnRenamed("source", "shard")
    folder = f"{scratch_root(spark)}/store-{random.random()}"
    catalogue = tokenstore.write_store(df, folder).toPandas()
    keys = df.select(F.col("doc_id").alias("key"))
    places = tokenstore.lookup(tokenstore.numbered(keys), folder)
    found = tokenstore.digests(tokenstore.read_store(places, folder)).toPandas()
    tool = Tokenizer.from_file(tokenstore.VOCABULARY)
    expected = []
    for row in df.collect():
        ids = [*tool.encode(row["text"] or "", add_special_tokens=False).ids, 1]
        expected.append((row["doc_id"], len(ids), crc32(np.array(ids, "<u4").tobytes())))
    order = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    rows = [(None if pd.isna(r.key) else int(r.key), r.n, r.crc) for r in found.itertuples()]
    assert sorted(rows, key=order) == sorted(expected, key=order)
    # Files hold the rows by ascending key, one after the other.
    laid = catalogue.sort_values("start")
    assert (laid["start"].to_numpy()[1:] == (laid["start"] + laid["n"]).to_numpy()[:-1]).all() and laid["start"].min() == 0
    ids = [None if pd.isna(k) else int(k) for k in laid["key"]]
    assert ids == sorted(ids, key=lambda k: (k is not None, k or 0))
    assert not laid.assign(key=laid["key"].fillna(-1)).duplicated(["key", "number"]).any()
    strangers = spark.createDataFrame([(77, 0), (12, 200), (None, 9)], "key long, number long")
    assert tokenstore.lookup(strangers, folder).count() == 0
    firsts = tokenstore.lookup(spark.createDataFrame([(12,), (None,), (78,)], "key long"), folder).collect()
    assert [(r["key"], r["number"]) for r in firsts] == [(12, 0)]


def test_empty_store(spark):
    folder = f"{scratch_root(spark)}/store-{random.random()}"
    assert tokenstore.write_store(documents(spark).limit(0), folder).count() == 0


LETTERS = "aZ's'tré'llÀÿß²½1 9\n\t\xa0\x85_-.,!?\"İſȺŉǅªµºK\x1c\x00"


def test_words_are_kept_within_bounds(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(tokenstore, "_KEPT_WORDS", 50)
    with open(tokenstore.VOCABULARY, encoding="utf-8") as file:
        words = tokenstore.WordIds(file.read())
    tool = Tokenizer.from_file(tokenstore.VOCABULARY)
    rng = random.Random(9)
    for _ in range(30):
        tails = [" \x1c é x <|endoftext|>", " ÉÀ İ ß", " <|EndOfText|>y", " UPPER Case's", ""]
        texts = [prose(rng, 30) + rng.choice(tails) for _ in range(4)]
        texts += ["".join(rng.choice(LETTERS) for _ in range(60)) for _ in range(60)]
        for text, body in zip(texts, words.packed(texts), strict=True):
            assert np.frombuffer(body, words.kind).tolist() == tool.encode(text, add_special_tokens=False).ids


# --- Nearest neighbours -----------------------------------------------------------------------
def test_single_pieces_go_to_the_model(monkeypatch):
    with open(tokenstore.VOCABULARY, encoding="utf-8") as file:
        words = tokenstore.WordIds(file.read())
    sent = []
    encode = words.encode

    def noted(batch, **options):
        sent.extend(batch)
        return encode(batch, **options)

    monkeypatch.setattr(words, "encode", noted)
    texts = ["Plain words, éèñß and 42 signs!! don't I'LL", "a'sb 'S ''s \x7f\xad²½ ŉ ǆ ſ", "<|endoftext|> It's", "漢字 e\u0301"]
    rng = random.Random(4)
    chars = [*map(chr, range(1, 0x250)), " ", " ", "'", "s"]
    texts += ["".join(rng.choices(chars, k=40)) for _ in range(300)]
    for text, ids in zip(texts, words.packed(texts), strict=True):
        expected = words.tool.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, words.kind).tolist() == expected, text
    assert not {"plain", "words", "éèñß", "signs", "!!", "'s"} & set(sent)


def brute_neighbours(vectors, k):
    ids = np.array([i for i, _ in vectors])
    m = np.array([v for _, v in vectors], float)
    norm = np.sqrt((m**2).sum(axis=1))
    out = {}
    for q in np.flatnonzero(ids % 50 == 0):
        score = (m * m[q]).sum(axis=1) / (norm * norm[q])
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != ids[q]][:k]
        out[int(ids[q])] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def test_neighbours_reach_the_recall(spark, tmp_path):
    prepare(spark)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(30, 16))
    data = [(i, (centres[i % 30] + 0.4 * rng.normal(size=16)).tolist()) for i in range(3000)]
    data += [(10_000 + i, [1.0] * 16) for i in range(300)]  # one vector many times
    bad = [(20_000, None), (20_050, [0.0] * 16), (20_001, [float("nan")] * 16), (None, [1.0] * 16), (20_002, [1.0] * 3)]
    df = spark.createDataFrame(data + bad, "vec_id long, embedding array<double>").withColumn("id", F.lit("x"))
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    found = neighbours.op8_nearest(spark, str(tmp_path)).toPandas().sort_values(["query_id", "rank"])
    true = brute_neighbours(data, 5)
    assert set(found["query_id"]) == set(true)
    hits = 0
    for query, own in found.groupby("query_id"):
        assert own["rank"].tolist() == [1, 2, 3, 4, 5]
        assert (np.diff(own["score"]) <= 0).all()
        hits += len(set(own["vec_id"]) & {i for i, _ in true[query]})
    assert hits >= 0.9 * 5 * len(true)
    same = found[found["query_id"] == 10_000]
    assert same["vec_id"].tolist() == [10_001, 10_002, 10_003, 10_004, 10_005]


@pytest.mark.parametrize("n", [0, 1, 3])
def test_few_vectors(spark, tmp_path, n):
    rows = [(50 * i, [1.0, float(i)]) for i in range(n)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    found = neighbours.op8_nearest(spark, str(tmp_path))
    assert found.count() == n * max(0, n - 1)


# --- Licences ---------------------------------------------------------------------------------
def test_licences(spark):
    rng = random.Random(7)
    notices = ["Licensed under the Apache License, Version 2.0.", "Released under the MIT License.",
               "This work is licensed under the GNU General Public License, version 3."]
    odd = "This work is licensed under the Grand Harbour Document License, version 7."
    rows = [(i, f"{prose(rng, 40)}\n{notices[i % 3]}\n{prose(rng, 10)}") for i in range(60)]
    rows += [(100 + i, prose(rng, 60)) for i in range(60)] + [(200, odd), (201, None), (202, ""), (None, notices[0])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("family", F.lit("x"))
    scanner = licenses.train(df)
    found = licenses.scan(df, scanner).toPandas()
    families = ["apache-2.0", "mit", "gpl-3.0"]
    got = {r.doc_id: r.family for r in found.itertuples() if not pd.isna(r.doc_id)}
    assert got == {i: families[i % 3] for i in range(60)} | {200: "unknown"}
    assert found[found["doc_id"].isna()]["family"].tolist() == ["apache-2.0"]
    assert licenses.scan(df.limit(0), scanner).count() == 0
    plan = licenses.scan(df, scanner)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_the_model_of_families_is_no_larger_than_its_examples(spark):
    prepare(spark)
    scanner = licenses.train(documents(spark), sample=300)
    bins = licenses._examples(spark).select(F.explode(licenses._bins(F.col("body")))).distinct().count()
    assert scanner.families.numFeatures == len(scanner.features.vocabulary) <= bins < licenses.BINS / 4


def test_weights_are_learnt_and_held_no_more_than_needed(spark, monkeypatch):
    sizes, vocabulary = [], licenses._vocabulary
    monkeypatch.setattr(licenses, "_vocabulary", lambda bins: sizes.append(len(bins)) or vocabulary(bins))
    df = documents(spark)
    scanner = licenses.train(df, sample=300)
    assert len(sizes) == 2 and max(sizes) < licenses.BINS / 2  # of the families and of the first model
    assert sum(w != 0 for w in scanner.weights) <= max(sizes)
    plan = licenses.scan(df, scanner)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"\[[-.,E\d\s]{100000,}\]", plan)) == 2  # for the pieces and for the paragraphs


def test_a_written_row_of_weights_stays_out_of_the_plan(spark):
    prepare(spark)
    rng = random.Random(20)
    odd = ["All rights reserved.", "Released under the MIT License.", "Licensed under CC BY 4.0."]
    rows = [(i, f"{prose(rng, 40)}\n{odd[i % 3]}\n{prose(rng, 10)}") for i in range(60)] + [(60, None), (None, odd[1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    scanner = licenses.train(df)
    lean = licenses.scan(df, scanner, weights=scanner.table)
    lean.collect()
    assert len(lean._jdf.queryExecution().toString()) < 100_000
    assert sorted(map(str, lean.collect())) == sorted(map(str, licenses.scan(df, scanner).collect()))
    assert lean.count() >= 60


def test_notices_unlike_all_templates_are_unknown(spark):
    rng = random.Random(17)
    odd = ["All rights reserved.", "Unauthorized copying of this file is prohibited.",
           "This software is released into the public domain.", "Alle Rechte vorbehalten."]
    rows = [(i, f"{prose(rng, 40)}\n{odd[i % 4]}\n{prose(rng, 10)}") for i in range(80)]
    rows += [(100 + i, f"{prose(rng, 30)}\n{prose(rng, 12)}") for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = licenses.scan(df, licenses.train(df)).toPandas()
    got = sorted((r.doc_id, r.family, r.body) for r in found.itertuples())
    assert got == [(i, "unknown", odd[i % 4]) for i in range(80)]


def test_wrapped_notices_are_one_paragraph(spark):
    rng = random.Random(23)
    families = ["mit", "gpl-3.0", "bsd-3-clause", "apache-2.0"]
    whole = [max(licenses.TEMPLATES[f], key=len) for f in families]
    rows = []
    for i in range(80):
        lines = "\n".join(textwrap.wrap(whole[i % 4], 60 if i % 8 < 4 else 80))
        rows.append((i, f"{prose(rng, 40)}.\n{lines}\n{prose(rng, 12)}"))
    rows += [(100 + i, f"{prose(rng, 30)}\n{prose(rng, 12)}") for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = licenses.scan(df, licenses.train(df)).toPandas()
    got = sorted((r.doc_id, r.family) for r in found.itertuples())
    assert got == [(i, families[i % 4]) for i in range(80)]


def test_notices_in_any_script_and_in_lines_of_any_length(spark):
    rng = random.Random(29)
    odd = ["Все права защищены.", "版权所有，保留所有权利。", "無断転載を禁じます。", "جميع الحقوق محفوظة."]
    rows = [(i, f"{prose(rng, 40)}\n{odd[i % 4]}\n{prose(rng, 10)}") for i in range(40)]
    notice = "This work is licensed under the GNU General Public License, version 3."
    rows += [(50 + i, f"{prose(rng, n)}. {notice} The {prose(rng, n)}") for i, n in enumerate([5, 30, 100, 3000])]
    rows += [(100 + i, f"The {prose(rng, 5)}. The {prose(rng, 60)}") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = licenses.scan(df, licenses.train(df)).toPandas()
    got = {(r.doc_id, r.family) for r in found.itertuples()}
    assert got == {(i, "unknown") for i in range(40)} | {(50 + i, "gpl-3.0") for i in range(4)}
