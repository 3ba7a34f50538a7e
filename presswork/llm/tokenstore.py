"""Token ids of texts as binary shards, with a minimal perfect hash index over the documents' keys.

A shard is a file ``ids-00000.bin`` of little-endian ids, 16 bits each where the vocabulary allows
and else 32, the texts of one range of keys in ascending order, one after the other. The index is dealt out over buckets by the key's hash.
Each bucket's file ``index-00000.bin`` holds a minimal perfect hash of its keys: levels of
bit arrays, in which a key's place is where it was alone on its level, and its slot is the number of
bits set before that place. At its slot stand the key's fingerprint, shard, offset and length. So a
key is found by a fixed number of reads, whatever the number of documents, and keys that were never
written are told by their fingerprint.

Files are written under a temporary name and renamed when whole, so a task that runs again, or
twice, leaves the same files.
"""

from __future__ import annotations

import io
import json
import os
import re
import uuid
from array import array
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.llm.frames import prepare, read, slices
from presswork.llm.words import mix
from presswork.session import materialize, scratch_root
from presswork.sources.files import qualified

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1
#: Keys of an index bucket on average: a bucket is built in one task, in some megabytes.
BUCKET_KEYS = 50_000
#: Bits per key on a level of the hash, and levels before the last, which is a sorted list.
GAMMA, LEVELS = 2.0, 24
_KEPT_WORDS = 500_000
#: Unlike ``str.split``, the tokenizer takes these four control characters for text.
_CONTROL = re.compile("[\x1c-\x1f]").search
_WORDS = re.compile(r"(?:[^\s]|[\x1c-\x1f])+").findall
# --- Fixed values: how the vocabulary's tokenizer cuts texts, and the same for Latin letters -----
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LETTERS = "a-zA-Z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_NUMBERS = "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
# ------------------------------------------------------------------------------------------------
_PIECES = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\s{_LETTERS}{_NUMBERS}]+"
).findall
#: Characters beyond Latin letters, or of which ``\s`` tells something else than the tokenizer.
_UNUSUAL = re.compile("[^\x00-\x1b\x20-\u024f]").search


def id_type(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


class WordIds(dict):
    """Ids of words and pieces of words, encoded by the tokenizers library when first met.

    The tokenizer drops white space and merges within pieces only, so the ids of a text are those of
    its words in turn. Texts in Latin letters are cut into the tokenizer's own pieces, in small
    letters as it makes them: of these there are fewer than of words with their signs. Full, the
    words move to an older generation, and come back when used.
    """

    def __init__(self, definition: str):
        # One thread: a pool would keep spinning between the many small calls of a task.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.tool = Tokenizer.from_str(definition)
        self.encode = getattr(self.tool, "encode_batch_fast", self.tool.encode_batch)
        self.kind = id_type(self.tool.get_vocab_size())
        made = json.loads(definition)
        steps = [step.get("type") for step in (made.get("normalizer") or {}).get("normalizers", [])]
        cuts = (made.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        own = cuts[0].get("pattern", {}).get("Regex")
        self.pieces = steps == ["NFC", "Replace", "Lowercase"] and own == PATTERN
        self.older: dict[str, bytes] = {}
        self.kept: dict[int, str] = {}
        last = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}
        if self.pieces and len(cuts) == 2 and last.items() <= cuts[1].items() and not made.get("post_processor"):
            self.kept = self._kept()
        self.alone = _single(self.kept)

    def _kept(self) -> dict[int, str]:
        """Characters that the tokenizer leaves as they are, and what its model sees of each."""
        from tokenizers.pre_tokenizers import ByteLevel

        seen = ByteLevel(add_prefix_space=False, use_regex=False)
        found = [c for c in map(chr, [*range(0x21, 0x7F), *range(0xA1, 0x250)]) if self.tool.normalizer.normalize_str(c) == c]
        return {ord(c): "".join(part for part, _ in seen.pre_tokenize_str(c)) for c in found}

    def learn(self, words: set[str]) -> None:
        """Make sure that all of ``words`` are known, encoding new ones in one call.

        A word that is one piece and stays as it is goes to the tokenizer's model at once: nothing is
        left to normalise or to cut.
        """
        new = [w for w in words if w not in self]
        if len(self) + len(new) > _KEPT_WORDS:
            self.older = dict(self)
            self.clear()
            new = list(words)
        self.update((w, self.older[w]) for w in new if w in self.older)
        new = [w for w in new if w not in self]
        kind = "H" if self.kind == "<u2" else "I"
        if self.kept:
            merge, alone, kept, rest = self.tool.model.tokenize, self.alone, self.kept, []
            for word in new:
                if alone(word):
                    found = merge(word if word.isascii() else word.translate(kept))
                    self[word] = array(kind, [token.id for token in found]).tobytes()
                else:
                    rest.append(word)
            new = rest
        found = self.encode(new, add_special_tokens=False)
        self.update((w, array(kind, e.ids).tobytes()) for w, e in zip(new, found, strict=True))

    def packed(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts, in the store's width; new words of all of them are encoded at once."""
        split, packed = [self.split(text) for text in texts], []
        for k, words in enumerate(split):
            try:
                packed.append(b"".join(map(self.__getitem__, words)))
            except KeyError:
                self.learn(set().union(*split[k:]))
                packed.append(b"".join(map(self.__getitem__, words)))
        return packed

    def split(self, text: str) -> list[str]:
        if self.pieces and "<|" not in text:  # a special token is told by its letters
            small = text.lower()
            if not _UNUSUAL(small):
                return _PIECES(small)
        return _WORDS(text) if _CONTROL(text) else text.split()


def _single(kept: dict[int, str]):
    """Whether a word of ``kept`` characters is a single piece, by a pattern's ``fullmatch``."""
    letters, numbers, signs = [], [], []
    for c in map(chr, kept):
        if re.match(f"[{_LETTERS}]", c):
            letters.append(c)
        elif re.match(f"[{_NUMBERS}]", c):
            numbers.append(c)
        elif not c.isspace():
            signs.append(c)
    sets = [f"[{re.escape(''.join(s))}]" for s in (letters, numbers, signs) if s]
    if len(sets) < 3:
        return None
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|{sets[0]}+|{sets[1]}|{sets[2]}+").fullmatch


@lru_cache(maxsize=2)
def _word_ids(definition: str) -> WordIds:
    return WordIds(definition)


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def _publish(folder: str, name: str, body: bytes) -> None:
    store, root = _open(folder)
    store.create_dir(root, recursive=True)
    draft = f"{root}/.{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(draft) as out:
        out.write(body)
    store.move(draft, f"{root}/{name}")


def _hash(keys: np.ndarray, salt: int) -> np.ndarray:
    return mix(keys.view(np.uint64) + np.uint64(salt * 0x9E3779B97F4A7C15 % (1 << 64)))


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit keys: slots 0 to n - 1."""

    def __init__(self, levels: list[np.ndarray], rest: np.ndarray):
        self.levels, self.rest = levels, rest
        counts = [int(bits.sum()) for bits in levels]
        self.before = np.cumsum([0, *counts])
        self.ranks = [np.concatenate([[0], np.cumsum(bits)[:-1]]).astype(np.int64) for bits in levels]

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, left = [], keys
        while len(left) and len(levels) < LEVELS:
            size = max(64, int(GAMMA * len(left)))
            place = (_hash(left, len(levels) + 1) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size) == 1
            levels.append(alone)
            left = left[~alone[place]]
        return cls(levels, np.sort(left))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key. A key that was never there gets any slot, or -1."""
        found = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for k, bits in enumerate(self.levels):
            place = (_hash(keys[open_], k + 1) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[place]
            found[open_[hit]] = self.before[k] + self.ranks[k][place[hit]]
            open_ = open_[~hit]
        if len(open_) and len(self.rest):
            at = np.minimum(np.searchsorted(self.rest, keys[open_]), len(self.rest) - 1)
            hit = self.rest[at] == keys[open_]
            found[open_[hit]] = self.before[-1] + at[hit]
        return found


def _fingerprint(keys: np.ndarray) -> np.ndarray:
    return (_hash(keys, 1_000_003) >> np.uint64(32)).astype(np.uint32)


def bucket_bytes(keys: np.ndarray, shard: np.ndarray, offset: np.ndarray, n: np.ndarray) -> bytes:
    """An index bucket as the bytes of its file."""
    table = PerfectHash.build(keys)
    order = np.argsort(table.slots(keys))
    out = io.BytesIO()
    arrays = {f"level{k}": np.packbits(bits) for k, bits in enumerate(table.levels)}
    sizes = np.array([len(bits) for bits in table.levels], np.int64)
    np.savez(
        out, sizes=sizes, rest=table.rest, fingerprint=_fingerprint(keys)[order],
        shard=shard[order], offset=offset[order], n=n[order], **arrays,
    )
    return out.getvalue()


class Bucket:
    """An index bucket read from its file."""

    def __init__(self, body: bytes):
        held = np.load(io.BytesIO(body))
        sizes = held["sizes"].tolist()
        levels = [np.unpackbits(held[f"level{k}"], count=s).astype(bool) for k, s in enumerate(sizes)]
        self.table = PerfectHash(levels, held["rest"])
        self.fingerprint, self.shard = held["fingerprint"], held["shard"]
        self.offset, self.n = held["offset"], held["n"]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each key is there, and its slot."""
        slots = self.table.slots(keys)
        at = np.maximum(slots, 0)
        if not len(self.fingerprint):
            return np.zeros(len(keys), bool), at
        return (slots >= 0) & (self.fingerprint[at] == _fingerprint(keys)), at


def write_store(
    df: DataFrame, folder: str, key: str = "doc_id", text: str = "text",
    vocabulary: str = VOCABULARY, end_id: int = END_ID,
) -> DataFrame:
    """Encode the texts and write shards and index; returns the catalogue of the documents.

    The catalogue has key, number, shard, offset (of ids within the shard), n and start (ids before
    the document over all shards). Texts are dealt out once, by ranges of key and text hash that
    Spark's range partitioner balances, and each range becomes a shard in the task that encodes it;
    only a few values per shard come to the driver. A null text counts as empty; every text has
    ``end_id`` after it. Every row is stored, nulls among the keys first. Rows that repeat a key
    follow each other, by text hash, and ``number`` counts them from 0; a key with a third of all
    rows is spread over shards by the rows' place in the input.
    """
    spark = df.sparkSession
    folder = qualified(spark, folder)
    with open(vocabulary, encoding="utf-8") as file:
        definition = spark.sparkContext.broadcast(file.read())
    width = 2 if _word_ids(definition.value).kind == "<u2" else 4
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tool = _word_ids(definition.value)
        end = np.array([end_id], tool.kind).tobytes()
        shard = TaskContext.get().partitionId()
        store, root = _open(folder)
        store.create_dir(root, recursive=True)
        draft, at, last, number, some = f"{root}/.ids-{shard:05d}-{uuid.uuid4().hex}", 0, None, 0, False
        with store.open_output_stream(draft) as out:
            for batch, _, _ in slices(batches, "text"):
                keys, numbers = batch.column(0).to_pylist(), []
                bodies = [b + end for b in tool.packed(batch.column(1).fill_null("").to_pylist())]
                for own in keys:
                    number = number + 1 if some and own == last else 0
                    last, some = own, True
                    numbers.append(number)
                for body in bodies:
                    out.write(body)
                sizes = np.array([len(b) // width for b in bodies], np.int64)
                offsets = at + np.cumsum(sizes) - sizes
                at += int(sizes.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(numbers, pa.int64()),
                     pa.array(np.full(len(sizes), shard, np.int32)), pa.array(offsets), pa.array(sizes)],
                    names=["key", "number", "shard", "offset", "n"],
                )
        if some:
            store.move(draft, f"{root}/ids-{shard:05d}.bin")
        else:
            store.delete_file(draft)

    ordered = (
        df.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").alias("text"))
        .withColumn("hash", F.xxhash64("text"))
        .withColumn("place", F.monotonically_increasing_id())
        .repartitionByRange(parts, "key", "hash", "place")
        .sortWithinPartitions("key", "hash", "place")
        .select("key", "text")
    )
    written = materialize(
        ordered.mapInArrow(shards, "key long, number long, shard int, offset long, n long"), "token-catalogue"
    )
    before = spark.createDataFrame(_before(written), "shard int, before long, first long, earlier long")
    same = F.col("key").eqNullSafe(F.col("first"))
    catalogue = written.join(F.broadcast(before), "shard").select(
        "key", (F.col("number") + F.when(same, F.col("earlier")).otherwise(0)).alias("number"),
        "shard", "offset", "n", (F.col("before") + F.col("offset")).alias("start"),
    )
    buckets = max(1, -(-written.count() // BUCKET_KEYS))

    def index(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        columns = [rows[c].to_numpy() for c in ("address", "shard", "offset", "n")]
        if len(np.unique(columns[0])) < len(rows):
            raise ValueError("two rows have one address: write the store with another ADDRESS_SEED")
        _publish(folder, f"index-{int(group[0]):05d}.bin", bucket_bytes(*columns))
        return pd.DataFrame({"bucket": [int(group[0])], "keys": [len(rows)]})

    written = (
        catalogue.select(_address().alias("address"), "shard", "offset", "n")
        .withColumn("bucket", _bucket("address", buckets))
        .groupBy("bucket")
        .applyInPandas(index, "bucket int, keys long")
    )
    materialize(written, "token-index")
    spark.createDataFrame([(buckets, width)], "buckets int, width int").write.json(f"{folder}/meta")
    return catalogue


def _before(written: DataFrame) -> list[tuple]:
    """(shard, ids before it, its first key, rows of that key in earlier shards), one per shard."""
    totals = (
        written.groupBy("shard")
        .agg(
            F.sum("n").alias("n"),
            F.min_by("key", "offset").alias("first"),
            F.max_by(F.struct("key", "number"), "offset").alias("last"),
        )
        .orderBy("shard")
    )
    found, at, held, count = [], 0, None, 0
    for row in totals.collect():
        earlier = count if found and row["first"] == held else 0
        found.append((row["shard"], at, row["first"], earlier))
        at += row["n"]
        last = row["last"]
        count = last["number"] + 1 + (earlier if last["key"] == row["first"] else 0)
        held = last["key"]
    return found


#: Changes the addresses of rows that repeat a key.
ADDRESS_SEED = 0


def _address():
    """Key of a row in the index: its own key, or a hash where that is null or not the first."""
    further = F.xxhash64(F.col("key").isNull(), "key", "number", F.lit(ADDRESS_SEED))
    return F.when(F.col("key").isNotNull() & (F.col("number") == 0), F.col("key")).otherwise(further)


def _bucket(key: str, buckets: int):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def numbered(keys: DataFrame) -> DataFrame:
    """(key, number) of all rows of a table with these keys, from the keys' counts."""
    counts = keys.groupBy("key").agg(F.count("*").alias("rows"))
    block, size = F.explode(F.expr(f"sequence(0L, (rows - 1) DIV {BUCKET_KEYS})")), F.lit(BUCKET_KEYS)
    blocks = counts.select("key", "rows", block.alias("block"))
    last = F.least(F.col("rows"), (F.col("block") + 1) * size) - 1
    return blocks.select("key", F.explode(F.sequence(F.col("block") * size, last)).alias("number"))


def lookup(rows: DataFrame, folder: str) -> DataFrame:
    """(key, number, shard, offset, n) of the rows (key, number) that the store has, by its index
    alone. Without a column ``number`` the first row of each key is meant.

    Rows go to the task of their bucket, which reads one index file.
    """
    keys = rows if "number" in rows.columns else rows.where("key is not null").withColumn("number", F.lit(0))
    folder = qualified(rows.sparkSession, folder)
    buckets = rows.sparkSession.read.json(f"{folder}/meta").first()["buckets"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(folder)
        number, bucket = -1, None
        for batch in batches:
            own = batch.column(2).to_numpy(zero_copy_only=False)
            groups = batch.column(3).to_numpy(zero_copy_only=False)
            for low, high in _stretches(groups):
                if groups[low] != number:
                    number = int(groups[low])
                    with store.open_input_stream(f"{root}/index-{number:05d}.bin") as file:
                        bucket = Bucket(file.read())
                there, at = bucket.find(own[low:high])
                at, rows = at[there], batch.slice(low, high - low).take(pa.array(np.flatnonzero(there)))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(bucket.shard[at]),
                     pa.array(bucket.offset[at]), pa.array(bucket.n[at])],
                    names=["key", "number", "shard", "offset", "n"],
                )

    dealt = (
        keys.select(F.col("key").cast("long"), F.col("number").cast("long"))
        .withColumn("address", _address())
        .withColumn("bucket", _bucket("address", buckets))
        .repartition("bucket")
        .sortWithinPartitions("bucket")
    )
    return dealt.mapInArrow(find, "key long, number long, shard int, offset long, n long")


def _stretches(values: np.ndarray) -> Iterator[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(values)) + 1
    yield from zip([0, *edges.tolist()], [*edges.tolist(), len(values)], strict=True)


def read_store(places: DataFrame, folder: str) -> DataFrame:
    """(key, shard, offset, ids) of documents found by :func:`lookup`, from the shard files.

    The ids come back as little-endian 32-bit integers, whatever the width in the store.
    """
    folder = qualified(places.sparkSession, folder)
    width = places.sparkSession.read.json(f"{folder}/meta").first()["width"]

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(folder)
        number, file = -1, None
        for batch in batches:
            for low in range(0, batch.num_rows, 200):
                rows = batch.slice(low, 200)
                bodies = []
                for shard, offset, n in zip(*(rows.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
                    if shard != number:
                        number, file = shard, store.open_input_file(f"{root}/ids-{shard:05d}.bin")
                    file.seek(width * offset)
                    body = np.frombuffer(file.read(width * n), f"<u{width}")
                    bodies.append(body.astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), rows.column(2), pa.array(bodies, pa.binary())],
                    names=["key", "shard", "offset", "ids"],
                )

    dealt = (
        places.select("key", "shard", "offset", "n").repartition("shard").sortWithinPartitions("shard", "offset")
    )
    return dealt.mapInArrow(load, "key long, shard int, offset long, ids binary")


def digests(documents: DataFrame) -> DataFrame:
    """(key, shard, offset, n, crc) of documents read by :func:`read_store`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = [b.as_buffer() for b in batch.column(3)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2),
                 pa.array([b.size // 4 for b in bodies], pa.int64()),
                 pa.array([crc32(b) for b in bodies], pa.int64())],
                names=["key", "shard", "offset", "n", "crc"],
            )

    return documents.mapInArrow(run, "key long, shard int, offset long, n long, crc long")


def shard_starts(documents: DataFrame) -> DataFrame:
    """(shard, before): ids in all shards before each one, from the shards' last documents."""
    rows = documents.groupBy("shard").agg(F.max(F.col("offset") + F.col("n")).alias("n"))
    starts, at = [], 0
    for row in rows.orderBy("shard").collect():
        starts.append((row["shard"], at))
        at += row["n"]
    return documents.sparkSession.createDataFrame(starts, "shard int, before long")


def op5_token_store(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's ids, written, found by the index and read back: doc_id, start, n_tokens,
    ids_crc32."""
    prepare(spark)
    documents = read(spark, folder, "documents")
    target = f"{scratch_root(spark)}/presswork/token-store-{uuid.uuid4().hex}"
    write_store(documents, target)
    places = lookup(numbered(documents.select(F.col("doc_id").cast("long").alias("key"))), target)
    found = materialize(digests(read_store(places, target)), "token-digests")
    return found.join(F.broadcast(shard_starts(found)), "shard").select(
        F.col("key").alias("doc_id"),
        (F.col("before") + F.col("offset")).alias("start"),
        F.col("n").alias("n_tokens"),
        F.col("crc").alias("ids_crc32"),
    )
