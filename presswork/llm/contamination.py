"""Benchmark items within texts, verbatim or edited, found by pieces that no edit has touched.

Texts and items are sequences of words (A-Z in lower case; ASCII punctuation separates words). Each
character of a script that puts no spaces between words is a word of its own. Items of any length
count; below five words no edit is allowed, so they must stand in the text word by word. A text is contaminated by an item of m words if some stretch of it is within k = ``EDITS`` * m word
edits of the item. To find such stretches:

1. An item is cut into k + 1 pieces of about equal length. As k edits touch k pieces at most, every
   stretch within the limit holds one of them word by word, wherever the edits are, and at most k
   words away from its place in the item. So looking up the pieces misses no stretch.
2. Where a text has a piece, the stretch around it stays if enough of its words are words of items,
   and enough of this item's different words are there. This loses nothing either.
3. The exact edit distance of the item to the best part of that stretch decides.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.llm.frames import lean, prepare, read, slices
from presswork.llm.words import Words, joined

#: Word edits allowed per word of an item.
EDITS = 0.2
#: Items of one pass over the corpus. More items make more passes, each with an index of this size.
BLOCK_ITEMS = 5000


class Index:
    """The items of one block, made ready for search. Its size is bounded by the block's."""

    def __init__(self, rows: list[tuple[int, str]]):
        rows = [(i, t) for i, t in rows if t]
        body = [t.encode() for _, t in rows]
        bounds = np.cumsum([0, *map(len, body)])
        words = Words(np.frombuffer(b"".join(body), np.uint8), bounds, letters_only=True, unspaced=True)
        parts = [words.hash[a:b] for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
        self.ids, self.hashes = [], []
        for (item, _), part in zip(rows, parts, strict=True):
            if len(part):
                self.ids.append(item)
                self.hashes.append(part)
        self.ready = False

    def build(self) -> None:
        """Derive codes and the tables of pieces; done once in each worker."""
        self.ready = True
        every = np.concatenate(self.hashes) if self.hashes else np.zeros(0, np.uint64)
        self.vocabulary = np.unique(every)
        self.codes = [np.searchsorted(self.vocabulary, h) + 1 for h in self.hashes]
        self.limits = [int(EDITS * len(c) + 1e-9) for c in self.codes]
        self.distinct = [np.unique(c) for c in self.codes]
        self.present = np.zeros(len(self.vocabulary) + 1, bool)
        self.bitmap = _bitmap(self.vocabulary)
        self.sizes = np.array([len(c) for c in self.codes], np.int64)
        self.allowed = np.array(self.limits, np.int64)
        self.gap = 2 * int(self.sizes.max(initial=1)) + 2
        pieces: dict[int, list[tuple[np.uint64, int, int]]] = defaultdict(list)
        for k, (hashes, limit) in enumerate(zip(self.hashes, self.limits, strict=True)):
            edges = [len(hashes) * i // (limit + 1) for i in range(limit + 2)]
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                piece = joined(hashes[low:high], high - low, 1)[0]
                pieces[high - low].append((piece, k, low))
        #: By length: the sorted distinct hashes of pieces, their bitmap, where the entries of each
        #: begin, and the entries: item, and the piece's place in it.
        self.pieces = {}
        for length, own in sorted(pieces.items()):
            keys, item, offset = (np.array(x) for x in zip(*own, strict=True))
            order = np.argsort(keys, kind="stable")
            distinct, begin = np.unique(keys[order], return_index=True)
            begin = np.append(begin, len(keys))
            self.pieces[length] = distinct, _bitmap(distinct), begin, item[order], offset[order]

    def _candidates(self, words: Words, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Items and the places where they may start, give or take their limit."""
        starts, items = [], []
        for length, (keys, bitmap, begin, item, offset) in self.pieces.items():
            n = len(words) - length + 1
            if n <= 0:
                continue
            hashes = joined(words.hash, length, n)
            where = np.flatnonzero(bitmap[hashes >> np.uint64(44)])
            where = where[words.row[where] == words.row[where + length - 1]]
            found = np.minimum(np.searchsorted(keys, hashes[where]), len(keys) - 1)
            same = keys[found] == hashes[where]
            where, found = where[same], found[same]
            counts = begin[found + 1] - begin[found]
            entry = np.repeat(begin[found] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
            items.append(item[entry])
            starts.append(place[np.repeat(where, counts)] - offset[entry])
        return np.concatenate(items), np.concatenate(starts)

    def search(self, body: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """(row, item, distance, first byte, last byte + 1) of the best stretch per row and item."""
        if not self.ready:
            self.build()
        words = Words(body, bounds, letters_only=True, unspaced=True)
        if not len(words) or not self.codes:
            return
        hit = self.bitmap[words.hash >> np.uint64(44)]
        found = np.searchsorted(self.vocabulary, words.hash[hit])
        found = np.minimum(found, len(self.vocabulary) - 1)
        exact = self.vocabulary[found] == words.hash[hit]
        where = np.flatnonzero(hit)[exact]
        # A gap of foreign words before each row keeps its windows from reaching into the next.
        place = np.arange(len(words)) + (words.row + 1) * self.gap
        codes = np.zeros(len(words) + (len(bounds) + 1) * self.gap, np.int32)
        codes[place[where]] = found[exact] + 1
        inner = np.zeros(len(codes) + 1, np.int32)
        np.cumsum(codes > 0, out=inner[1:])
        item, start = self._candidates(words, place)
        size, limit = self.sizes[item], self.allowed[item]
        known = inner[start + size + limit] - inner[start - limit]
        item, start = item[known >= size - limit], start[known >= size - limit]
        # A start may lie before its text, in the gap; the gap belongs to the text after it.
        row = words.row[np.minimum(np.searchsorted(place, start), len(place) - 1)]
        groups: dict[tuple[int, int], list[int]] = defaultdict(list)
        for found in sorted(set(zip(row.tolist(), item.tolist(), start.tolist(), strict=True))):
            groups[found[:2]].append(found[2])
        for (row, item), own in sorted(groups.items()):
            best = self._best(codes, item, own)
            if best:
                distance, low, high = best
                first, last = np.searchsorted(place, [low, high])
                yield row, item, distance, int(words.start[first]), int(words.end[last])

    def _best(self, codes: np.ndarray, item: int, starts: list[int]) -> tuple[int, int, int] | None:
        """Distance and first and last place of the best stretch near any of the starts."""
        wanted, limit = self.codes[item], self.limits[item]
        best, covered, distinct = None, -1, self.distinct[item]
        for start in starts:
            if start <= covered:
                continue
            low = start - limit
            region = codes[low : start + len(wanted) + 2 * limit + 1]
            covered = start + limit
            self.present[region] = True  # an edit takes away one of the item's words at most
            enough = self.present[distinct].sum() >= len(distinct) - limit
            self.present[region] = False
            if not enough:
                continue
            distance, last = edit_search(wanted, region)
            if distance > limit or (best and distance >= best[0]):
                continue
            _, back = edit_search(wanted[::-1], region[last::-1], anchored=True)
            best = (distance, low + last - back, low + last)
            if distance == 0:
                break
        return best


def _bitmap(hashes: np.ndarray) -> np.ndarray:
    """Whether there is a hash with given upper bits."""
    bits = np.zeros(1 << 20, bool)
    bits[hashes >> np.uint64(44)] = True
    return bits


def edit_search(item: np.ndarray, text: np.ndarray, anchored: bool = False) -> tuple[int, int]:
    """Least edit distance of ``item`` to a stretch of ``text``, and the stretch's last place.

    ``anchored``: the stretch starts where the text does. Of equal stretches the first counts.
    """
    places = np.arange(len(text) + 1)
    row = places.copy() if anchored else np.zeros(len(text) + 1, np.int64)
    for count, word in enumerate(item, 1):
        new = np.empty_like(row)
        new[0] = count
        np.minimum(row[:-1] + (text != word), row[1:] + 1, out=new[1:])
        row = np.minimum.accumulate(new - places) + places
    last = int(np.argmin(row))
    return int(row[last]), max(last - 1, 0)


def _indexes(items: DataFrame, item_id: str, text: str) -> Iterator[Index]:
    """The items in blocks of bounded size, one after the other."""
    rows = items.select(
        F.col(f"`{item_id}`").cast("long").alias("item"), F.col(f"`{text}`").alias("text")
    ).filter(F.col("text").isNotNull())
    blocks = max(1, -(-rows.count() // BLOCK_ITEMS))
    for block in range(blocks):
        own = rows.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block)
        yield Index([tuple(r) for r in own.collect()])


def matches(
    df: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(key, item_id, edits, start, end): the best stretch of each text for each item in it.

    ``start`` and ``end`` are character offsets. A null or empty text, or an item that is null or
    has no word, matches nothing. An item of one or two words may well be in a text by chance; it
    counts all the same, with its number of edits, which is 0. Repeated rows, null keys and equal items match each for itself. Texts are read in
    place: there is no shuffle.
    """
    source = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    kind = source.schema["key"].dataType.simpleString()
    schema = f"key {kind}, item_id long, edits int, start int, end int"
    found = None
    for index in _indexes(items, item_id, item_text):
        held = df.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            tool = held.value
            for rows, body, bounds in slices(batches, "text"):
                hits = list(tool.search(body, bounds))
                if not hits:
                    continue
                row, item, edits, start, end = (np.array(x, np.int64) for x in zip(*hits, strict=True))
                leads = np.zeros(len(body) + 1, np.int64)
                np.cumsum((body & 0xC0) != 0x80, out=leads[1:])
                base = leads[bounds[row]]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).take(pa.array(row)),
                     pa.array([tool.ids[k] for k in item.tolist()], pa.int64()),
                     pa.array(edits.astype(np.int32)),
                     pa.array((leads[start] - base).astype(np.int32)),
                     pa.array((leads[end] - base).astype(np.int32))],
                    names=["key", "item_id", "edits", "start", "end"],
                )

        part = source.mapInArrow(lean(run), schema)
        found = part if found is None else found.unionByName(part)
    return found.withColumnRenamed("key", key)


def decontaminated(
    df: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The rows of ``df`` whose text holds none of the items, with all columns, in place."""
    for index in _indexes(items, item_id, item_text):
        held = df.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            tool = held.value
            for rows, body, bounds in slices(batches, text):
                clean = np.ones(rows.num_rows, bool)
                clean[[hit[0] for hit in tool.search(body, bounds)]] = False
                yield rows.filter(pa.array(clean))

        df = df.mapInArrow(lean(run), df.schema)
    return df


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items in the documents: doc_id, item_id, edits, start, end."""
    prepare(spark)
    return matches(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
