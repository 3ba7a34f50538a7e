"""Byte-level BPE: encoding in linear time by backtracking, and decoding.

The vocabulary is a file of ranks. All its tokens go, as Latin-1 text, into one Aho-Corasick
automaton, and a single pass gives the longest token that starts at each byte of a piece. The
encoder takes longest tokens from left to right. A token may follow another only if the two would
stay apart under the merges, which is decided by undoing merges on both sides of the border and is
remembered per pair. Where no shorter token fits either, the encoder steps back and marks the place
as a dead end, so each byte is left at most once. The only sequence in which all neighbours are
compatible is the one that the merges give.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from hashlib import sha256
from itertools import islice
from struct import pack

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from ahocorasick import Automaton
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.llm.frames import lean, prepare, read, remembered

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
#: Pieces kept with their ids by each worker, and the longest such piece. More only cost time.
KEPT_PIECES, KEPT_LENGTH = 250_000, 40
KEPT_PAIRS = 500_000
#: Characters from which a text's pieces are taken a few at a time.
LONG_TEXT = 200_000


class BytePairs:
    """The tokens of a rank file, their last merges, and the encoder over them."""

    def __init__(self, ranks: bytes):
        self.tokens: dict[bytes, int] = {}
        for line in ranks.split(b"\n"):
            if line.strip():
                token, rank = line.split()
                self.tokens[base64.b64decode(token)] = int(rank)
        self.bytes: list[bytes] = [b""] * (max(self.tokens.values()) + 1)
        for token, rank in self.tokens.items():
            self.bytes[rank] = token
        missing = [b for b in range(256) if bytes([b]) not in self.tokens]
        if missing:
            raise ValueError(f"the vocabulary lacks the bytes {missing}")
        self.automaton = Automaton()
        for token, rank in self.tokens.items():
            self.automaton.add_word(token.decode("latin-1"), (len(token) - 1, rank))
        self.automaton.make_automaton()
        self.sizes = [len(t) for t in self.bytes]
        #: The longest token that is a proper prefix of each token, or -1.
        self.shorter = [self._prefix(t) for t in self.bytes]
        #: The halves that the last merge of each token joins; a single byte has itself.
        self.lefts, self.rights = list(range(len(self.bytes))), list(range(len(self.bytes)))
        self.merged: dict[tuple[int, int], int] = {}
        self.together: dict[tuple[int, int], bool] = {}
        for rank, token in enumerate(self.bytes):
            if len(token) > 1:
                self._split(rank, token)
        self.together.clear()

    def _prefix(self, token: bytes) -> int:
        for end in range(len(token) - 1, 0, -1):
            if (rank := self.tokens.get(token[:end])) is not None:
                return rank
        return -1

    def _split(self, rank: int, token: bytes) -> None:
        """Note the last merge that makes ``token``: two older tokens that would stay apart."""
        left = self.shorter[rank]
        while left >= 0:
            right = self.tokens.get(token[len(self.bytes[left]) :])
            if right is not None and left < rank and right < rank and self._apart(left, right):
                self.lefts[rank], self.rights[rank] = left, right
                self.merged[left, right] = rank
                return
            left = self.shorter[left]

    def _apart(self, left: int, right: int) -> bool:
        """Whether the merges, run over both tokens' bytes, would leave exactly these two.

        Merges are undone from the youngest on, until two single bytes face each other. A merge
        across the border that is older than all those undone would have come first.
        """
        lefts, rights, merged = self.lefts, self.rights, self.merged
        bound = len(self.bytes)
        while True:
            joint = merged.get((left, right))
            if joint is not None and joint < bound:
                return False
            inner, outer = rights[left], lefts[right]
            # Of two merges of the same rank the left one comes first, hence the one more.
            if inner != left and (left > right or outer == right):
                bound, left = left, inner
            elif outer != right:
                bound, right = right + 1, outer
            else:
                return True

    def _remember(self, left: int, right: int) -> bool:
        if len(self.together) >= KEPT_PAIRS:
            self.together.clear()
        known = self.together[left, right] = self._apart(left, right)
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one match of the pattern."""
        whole = self.tokens.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        longest = [-1] * n
        for last, (before, rank) in self.automaton.iter(piece.decode("latin-1")):
            longest[last - before] = rank  # of two with the same start, the longer comes later
        sizes, shorter, together = self.sizes, self.shorter, self.together
        open_at = bytearray(b"\1") * (n + 1)
        ids: list[int] = []
        at, token, previous = 0, longest[0], -1
        while True:
            end = at + sizes[token]
            if open_at[end]:
                fits = previous < 0 or together.get((previous, token))
                if fits is None:
                    fits = self._remember(previous, token)
                if fits:
                    ids.append(token)
                    if end == n:
                        return ids
                    at, previous, token = end, token, longest[end]
                    continue
            if shorter[token] >= 0:
                token = shorter[token]
            else:
                open_at[at] = 0
                token = ids.pop()
                previous = ids[-1] if ids else -1
                at -= sizes[token]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


class Pieces(dict):
    """Ids of pieces as little-endian 32-bit integers, worked out when first asked for.

    When it is full, all move to an older generation, from which those still in use come back.
    """

    def __init__(self, pairs: BytePairs):
        super().__init__()
        self.pairs = pairs
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            found = self.pairs.encode_piece(piece.encode())
            ids = pack(f"<{len(found)}I", *found)
        if len(piece) <= KEPT_LENGTH:
            if len(self) >= KEPT_PIECES:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


#: :data:`PATTERN` for texts of characters below U+0250 only, with the classes spelled out, since
#: the standard library's matcher has no names for them. It takes a third of the time.
_LETTER, _DIGIT = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾"
_SPACE = " \\t\\n\\x0b\\f\\r\\x85\\xa0"
LATIN_PATTERN = (
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_DIGIT}]+| ?[^{_SPACE}{_LETTER}{_DIGIT}]+"
    f"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)


class Encoder:
    """Whole texts to ids and back."""

    def __init__(self, ranks: bytes, pattern: str = PATTERN):
        self.pairs = BytePairs(ranks)
        self.pieces = Pieces(self.pairs)
        self.pattern = regex.compile(pattern)
        self.latin = re.compile(LATIN_PATTERN) if pattern == PATTERN else None
        self.beyond_latin = re.compile("[^\\x00-\u024f]").search

    def packed(self, text: str) -> Iterator[bytes]:
        """Ids of ``text``, packed, in parts; the parts of a long text come a few pieces at a time."""
        latin = self.latin is not None and not self.beyond_latin(text)
        pattern = self.latin if latin else self.pattern
        if len(text) < LONG_TEXT:
            yield b"".join(map(self.pieces.__getitem__, pattern.findall(text)))
            return
        found = (m.group() for m in pattern.finditer(text))
        while part := list(islice(found, 50_000)):
            yield b"".join(map(self.pieces.__getitem__, part))

    def encode(self, text: str) -> list[int]:
        return [i for part in self.packed(text) for i in np.frombuffer(part, "<u4").tolist()]

    def decode(self, ids: list[int]) -> bytes:
        return self.pairs.decode(ids)


@remembered
def encoder(ranks: bytes, pattern: str) -> Encoder:
    """One encoder per worker process and vocabulary, until a task of another operator comes."""
    return Encoder(ranks, pattern)


def _vocabulary(spark: SparkSession, path: str):
    """The rank file, read where the plan is built and sent once to each executor.

    Its size is that of the vocabulary, under a megabyte, and does not change with the data.
    """
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def encode(
    df: DataFrame, text: str = "text", vocabulary: str = VOCABULARY, pattern: str = PATTERN
) -> DataFrame:
    """``df`` with ``token_ids`` (array of int) in place of the column ``text``.

    A null text gives no ids, like an empty one. Special tokens are ordinary text. Other columns
    stay, but a column named ``token_ids`` is replaced. Rows are independent and none is shuffled.
    """
    ranks = _vocabulary(df.sparkSession, vocabulary)
    source = df.drop("token_ids") if text != "token_ids" else df
    kept = [c for c in source.columns if c != text]
    schema = source.select(*[f"`{c}`" for c in kept], F.array(F.lit(0)).alias("token_ids")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(ranks.value, pattern)
        for batch in batches:
            at = batch.schema.get_field_index(text)
            others = [batch.column(i) for i in range(batch.num_columns) if i != at]
            names = [n for n in batch.schema.names if n != text]
            for low in range(0, batch.num_rows, 100):
                rows = batch.column(at).slice(low, 100).to_pylist()
                flat = [b"".join(tool.packed(t or "")) for t in rows]
                sizes = np.cumsum([0, *[len(x) // 4 for x in flat]], dtype=np.int32)
                values = pa.array(np.frombuffer(b"".join(flat), "<i4"))
                ids = pa.ListArray.from_arrays(pa.array(sizes), values)
                yield pa.RecordBatch.from_arrays(
                    [c.slice(low, 100) for c in others] + [ids], names=[*names, "token_ids"]
                )

    return source.mapInArrow(lean(run, encoder), schema)


def decode(df: DataFrame, ids: str = "token_ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """``df`` with ``decoded`` (binary, as ids may cut a character) in place of the ids."""
    ranks = _vocabulary(df.sparkSession, vocabulary)
    source = df.drop("decoded")
    kept = [c for c in source.columns if c != ids]
    schema = source.select(*[f"`{c}`" for c in kept], F.lit(b"").alias("decoded")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(ranks.value, PATTERN)
        for batch in batches:
            at = batch.schema.get_field_index(ids)
            texts = [tool.decode(x or []) for x in batch.column(at).to_pylist()]
            others = [batch.column(i) for i in range(batch.num_columns) if i != at]
            names = [n for n in batch.schema.names if n != ids]
            yield pa.RecordBatch.from_arrays(
                [*others, pa.array(texts, pa.binary())], names=[*names, "decoded"]
            )

    return source.mapInArrow(lean(run, encoder), schema)


def round_trip(
    df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY
) -> DataFrame:
    """Digest of the ids of each text and of the bytes that they decode to.

    Returns the key, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` for every row, repeated
    rows and null keys included; a null text counts as empty. Encoding, decoding and both digests
    go through a text part by part, so a very long one needs little more memory than itself.
    """
    ranks = _vocabulary(df.sparkSession, vocabulary)
    source = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    kind = source.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(ranks.value, PATTERN)
        for batch in batches:
            counts, ids, back = [], [], []
            for value in batch.column(1):
                written, read_back, n = sha256(), sha256(), 0
                for part in tool.packed(value.as_py() or ""):
                    written.update(part)
                    n += len(part) // 4
                    read_back.update(tool.decode(np.frombuffer(part, "<u4").tolist()))
                counts.append(n)
                ids.append(written.hexdigest())
                back.append(read_back.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids), pa.array(back)],
                names=["key", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return source.mapInArrow(lean(run, encoder), schema).withColumnRenamed("key", key)


def op2_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document by the public byte-level ranks, and the texts decoded from them."""
    prepare(spark)
    return round_trip(read(spark, folder, "documents"))
