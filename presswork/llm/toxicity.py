"""Toxicity of texts, scored after disguises have been undone.

A noisy channel turns what was meant into what is written: letters become digits and signs that
look alike, letters are repeated, words are spaced out. For each stretch of text that shows such
marks a lattice holds what its characters can stand for; the Viterbi path under a character
language model of the corpus and the costs of the channel is the restored stretch. A logistic
regression on words and word beginnings that tell toxic texts from others scores the restored text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.llm.frames import labelled_sample, prepare, read, slices
from presswork.llm.words import Words

# Letters that a sign may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "!": "i", "|": "li", "+": "t", "(": "c",
}
#: Signs that may part the letters of one word.
PARTERS = " .-_*"
#: Costs of the channel, as negative logarithms: a sign for a letter, a letter said again, a parter
#: within a word; and, in a stretch that shows marks of disguise, a sign or parter that is just that.
SIGN, REPEAT, PART, PLAIN = 1.0, 0.7, 0.4, 1.5
#: Single characters in a row that count as one spaced word.
SPACED = 4
#: Labelled texts to learn from, the first of a fixed pseudo-random order; it bounds the driver.
SAMPLE = 12_000
#: Toxic texts that must have a feature, and how many times likelier it must be in these.
LEAST_TEXTS, LEAST_RATIO = 8, 12.0
HEADS = (4, 5, 6, 7)
#: Gradient steps, penalty on squared weights, and share of a text's features in a step.
PASSES, PENALTY, SHOWN = 500, 1e-5, 0.3
CODES = 128
_KEPT = 100_000


def _code_table() -> np.ndarray:
    """Bytes as codes of the language model: letters without case, bytes of longer characters, and
    0 for all else, which is the border of a word."""
    table = np.zeros(256, np.int32)
    for k in range(26):
        table[65 + k] = table[97 + k] = k + 1
    table[0x80:0xC0] = 27 + np.arange(64)
    table[0xC0:0x100] = 91 + np.arange(64) % 32
    return table


TABLE = _code_table()


def character_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """(gram, n): how often each run of three codes occurs in all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CODES**3, np.int64)
        for _, body, bounds in slices(batches, "text"):
            codes = np.zeros(len(body) + len(bounds) + 1, np.int32)
            row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
            codes[np.arange(len(body)) + row + 1] = TABLE[body]
            gram = (codes[:-2] * CODES + codes[1:-1]) * CODES + codes[2:]
            gram = gram[(codes[1:-1] > 0) | (codes[2:] > 0)]
            total += np.bincount(gram, minlength=len(total))
        grams = np.flatnonzero(total)
        for low in range(0, len(grams), 100_000):
            part = grams[low : low + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int32)), pa.array(total[part])], names=["gram", "n"]
            )

    found = df.select(F.col(f"`{text}`").alias("text")).mapInArrow(run, "gram int, n long")
    return found.groupBy("gram").agg(F.sum("n").alias("n"))


class LanguageModel:
    """Costs of a code after two others, from counts of runs of three, mixed with shorter runs."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        self.grams, self.counts = grams.astype(np.int32), counts.astype(np.int64)
        self.costs = None

    def build(self) -> None:
        three = np.zeros(CODES**3)
        three[self.grams] = self.counts
        three = three.reshape(CODES, CODES, CODES)
        two, one = three.sum(axis=0), three.sum(axis=(0, 1)) + 0.5
        one = one / one.sum()
        two = (two + 8 * one[None, :]) / (two.sum(axis=1, keepdims=True) + 8)
        three = (three + 8 * two[None, :, :]) / (three.sum(axis=2, keepdims=True) + 8)
        self.costs = -np.log(three).astype(np.float32)

    def cost(self, before: int, last: int, code: int) -> float:
        return float(self.costs[before, last, code])


class Restorer:
    """Undoes disguises under a language model. Words already seen are remembered, up to a bound."""

    def __init__(self, model: LanguageModel):
        if model.costs is None:
            model.build()
        self.model, self.known = model, {}

    def word(self, written: str) -> str:
        found = self.known.get(written)
        if found is None:
            if len(self.known) >= _KEPT:
                self.known.clear()
            found = self.known[written] = self._decode(written)
        return found

    def _lattice(self, written: str) -> list[list[tuple[str, float]]]:
        """What each character, or run of one character, can stand for, with the channel's costs."""
        steps, at = [], 0
        text = written.lower()
        while at < len(text):
            end = at + 1
            while end < len(text) and text[end] == text[at]:
                end += 1
            char, times = text[at], end - at
            if char.isalpha():
                options = [(char, REPEAT * (times - 1))]
                if times > 1:
                    options.append((char * 2, REPEAT * (times - 2)))
                steps.append(options)
            elif char in PARTERS:
                steps.append([(char * times, PLAIN), ("", PART * times)])
            elif char in LOOKALIKES:
                meant = LOOKALIKES[char]
                if times <= 2:
                    options = [(m * times, SIGN * times) for m in meant]
                else:
                    options = [(m, SIGN + REPEAT * (times - 1)) for m in meant]
                steps.append([(char * times, PLAIN * times), *options])
            else:
                steps.append([(char * times, 0.0)])
            at = end
        return steps

    def _decode(self, written: str) -> str:
        cost_of = self.model.cost
        states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        for options in [*self._lattice(written), [(" ", 0.0)]]:
            following: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (before, last), (cost, path) in states.items():
                for meant, channel in options:
                    a, b, total = before, last, cost + channel
                    for code in TABLE[np.frombuffer(meant.encode(), np.uint8)].tolist():
                        if a or b or code:
                            total += cost_of(a, b, code)
                        a, b = b, code
                    old = following.get((a, b))
                    if old is None or total < old[0]:
                        following[a, b] = (total, (path, meant))
            states = following
        _, path = min(states.values(), key=lambda s: s[0])
        parts = []
        while path is not None:
            path, meant = path
            parts.append(meant)
        return "".join(reversed(parts)).strip()

    def text(self, text: str) -> str:
        """``text`` with its disguised stretches restored; the rest is as it was."""
        spans = disguised(text.encode())
        if not spans:
            return text
        body, parts, at = text.encode(), [], 0
        for start, end in spans:
            parts += [body[at:start].decode(), self.word(body[start:end].decode())]
            at = end
        return "".join([*parts, body[at:].decode()])


_LETTER = TABLE > 0
_SIGN = np.zeros(256, bool)
_SIGN[[ord(c) for c in LOOKALIKES]] = True
_EDGE = np.zeros(256, bool)
_EDGE[[ord(c) for c in "!|+(.-_*,;:?\"')]}[{#%&~"]] = True
_JOIN = np.zeros(256, bool)
_JOIN[[ord(c) for c in ".-_*"]] = True


def disguised(body: bytes) -> list[tuple[int, int]]:
    """Byte spans that show marks of disguise: words with signs among their letters, with a letter
    three times in a row or with all letters parted, and rows of single characters."""
    codes = np.frombuffer(body, np.uint8)
    if not len(codes):
        return []
    words = Words(codes, np.array([0, len(codes)]))
    if not len(words):
        return []
    letter = _LETTER[codes]

    def within(mask: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(mask, out=sums[1:])
        return sums[words.end] - sums[words.start]

    sign = _SIGN[codes]
    inner = np.zeros(len(codes), bool)
    inner[1:-1] = sign[1:-1] & (letter[2:] | letter[:-2])
    inner[1:-1] &= ~(_EDGE[codes[1:-1]] & ~(letter[2:] & letter[:-2]))
    inner[:1] = sign[:1] & ~_EDGE[codes[:1]] & letter[1:2].any()
    inner[-1:] = sign[-1:] & ~_EDGE[codes[-1:]] & letter[-2:-1].any()
    thrice = np.zeros(len(codes), bool)
    thrice[2:] = letter[2:] & (codes[2:] == codes[1:-1]) & (codes[1:-1] == codes[:-2])
    parted = np.zeros(len(codes), bool)
    parted[1:-1] = _JOIN[codes[1:-1]] & letter[:-2] & letter[2:]
    letters = within(letter)
    marked = (letters > 0) & ((within(inner) > 0) | (within(thrice) > 0))
    marked |= (within(parted) >= SPACED - 1) & (letters <= within(parted) + 1)
    single = (words.end - words.start == 1) & (letter | sign)[words.start]
    spans = []
    if single.any():
        edges = np.flatnonzero(np.diff(np.concatenate([[0], single.astype(np.int8), [0]])))
        for low, high in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if high - low >= SPACED:
                spans.append((int(words.start[low]), int(words.end[high - 1])))
                marked[low:high] = False
    for k in np.flatnonzero(marked).tolist():
        start, end = int(words.start[k]), int(words.end[k])
        while end > start and _EDGE[codes[end - 1]]:
            end -= 1
        run = end
        while run > start and codes[run - 1] == codes[end - 1] and _SIGN[codes[run - 1]]:
            run -= 1
        if end - run > 2 and not 48 <= codes[run] <= 57:  # signs said over and over
            end = run
        if end > start:
            spans.append((start, end))
    return sorted(spans)


def features(body: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the words of texts and of their beginnings, each once per text."""
    words = Words(body, bounds, letters_only=True)
    rows, hashes = [words.row], [words.hash]
    for size in HEADS:
        longer, heads = words.heads(size)
        rows.append(words.row[longer])
        hashes.append(heads ^ np.uint64(0x5A5A5A5A5A5A5A5A))
    row, value = np.concatenate(rows), np.concatenate(hashes)
    return row, value


@dataclass
class Model:
    """Language model, and the features with their weights in ascending order of their hashes."""

    language: LanguageModel
    hashes: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, body: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        n = len(bounds) - 1
        row, place = _present(self.hashes, *features(body, bounds))
        total = np.bincount(row, self.weights[place] if len(place) else None, minlength=n)
        return 1 / (1 + np.exp(-np.clip(self.bias + total, -50, 50)))


def _present(hashes: np.ndarray, row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, position in ``hashes``) of the features that a text has, each once."""
    if not len(hashes) or not len(value):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    place = np.minimum(np.searchsorted(hashes, value), len(hashes) - 1)
    hit = hashes[place] == value
    both = np.unique(row[hit] * len(hashes) + place[hit])
    return both // len(hashes), both % len(hashes)


def _restored(batches: Iterator[pa.RecordBatch], language: LanguageModel):
    """Slices of batches whose first column is the text, with restored texts."""
    tool = Restorer(language)
    for rows, _, _ in slices(batches, "text"):
        texts = [tool.text(t or "") for t in rows.column(0).to_pylist()]
        body = [t.encode() for t in texts]
        bounds = np.cumsum([0, *map(len, body)])
        yield rows, np.frombuffer(b"".join(body), np.uint8), bounds


def learn(corpus: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id",
          text: str = "text", sample: int = SAMPLE) -> Model:
    """Language model of the whole ``corpus``, and a classifier of at most ``sample`` of its texts,
    labelled by ``labels`` (key, label).

    Null labels are left out. With one label only, or none, every text scores by the smoothed share.
    """
    spark = corpus.sparkSession
    counted = character_counts(corpus, text).toArrow()
    language = LanguageModel(np.asarray(counted.column("gram")), np.asarray(counted.column("n")))
    held = spark.sparkContext.broadcast(language)
    chosen = labelled_sample(corpus, labels, label, key, text, sample).select(
        "text", (F.col("label") > 0).alias("label")
    )

    def of_toxic(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, body, bounds in _restored(batches, held.value):
            row, value = features(body, bounds)
            toxic = np.asarray(rows.column(1).to_pylist(), bool)
            keep = toxic[row]
            pairs = np.unique(np.stack([row[keep].astype(np.uint64), value[keep]]), axis=1)
            values, counts = np.unique(pairs[1], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(values.view(np.int64)), pa.array(counts.astype(np.int64))], names=["h", "n"]
            )

    frequent = (
        chosen.filter("label").mapInArrow(of_toxic, "h long, n long").groupBy("h")
        .agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_TEXTS).select("h").toArrow()
    )
    hashes = np.sort(np.asarray(frequent.column("h"), dtype=np.int64).view(np.uint64))
    known = spark.sparkContext.broadcast(hashes)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, body, bounds in _restored(batches, held.value):
            row, place = _present(known.value, *features(body, bounds))
            limits = np.searchsorted(row, np.arange(rows.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [rows.column(1),
                 pa.ListArray.from_arrays(pa.array(limits), pa.array(place.astype(np.int32)))],
                names=["label", "places"],
            )

    table = chosen.mapInArrow(found, "label boolean, places array<int>").toArrow()
    labels = np.array(table.column("label").to_pylist(), float)
    lists = table.column("places").combine_chunks()
    place = np.asarray(lists.flatten(), dtype=np.int64)
    row = np.repeat(np.arange(len(labels)), np.asarray(lists.value_lengths(), dtype=np.int64))
    return _fit(language, hashes, row, place, labels)


def _fit(language, hashes: np.ndarray, row: np.ndarray, place: np.ndarray, labels: np.ndarray) -> Model:
    n, toxic = len(labels), labels.sum()
    bias = log((toxic + 0.5) / (n - toxic + 0.5))
    if not len(hashes) or toxic in (0, n):
        return Model(language, np.zeros(0, np.uint64), np.zeros(0), bias)
    with_it = np.bincount(place, labels[row], minlength=len(hashes))
    without = np.bincount(place, 1 - labels[row], minlength=len(hashes))
    ratio = ((with_it + 0.5) / (toxic + 1)) / ((without + 0.5) / (n - toxic + 1))
    good = ratio >= LEAST_RATIO
    number = np.cumsum(good) - 1
    keep = good[place]
    row, place = row[keep], number[place[keep]]
    size = int(good.sum())
    weights = np.zeros(size)
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    rng = np.random.default_rng(11)
    for turn in range(1, PASSES + 1):
        # Texts lose most of their features at random, so that a few must do where many agree.
        shown = rng.random(len(row)) < SHOWN
        total = bias + np.bincount(row[shown], weights[place[shown]], minlength=n)
        error = labels - 1 / (1 + np.exp(-np.clip(total, -50, 50)))
        by_weight = np.bincount(place[shown], error[row[shown]], minlength=size) / n - PENALTY * weights
        step = np.append(by_weight, error.mean())
        first, second = 0.9 * first + 0.1 * step, 0.999 * second + 0.001 * step**2
        move = 0.2 * (first / (1 - 0.9**turn)) / (np.sqrt(second / (1 - 0.999**turn)) + 1e-8)
        weights, bias = weights + move[:-1], bias + move[-1]
    return Model(language, hashes[good], weights, float(bias))


def score(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with ``restored_text`` and ``score`` after its columns, in place of such columns.

    Every row is scored; a null text counts as empty and has the score of one without features.
    """
    held = df.sparkSession.sparkContext.broadcast(model)
    source = df.drop("restored_text", "score")
    schema = source.select("*", F.lit("").alias("restored_text"), F.lit(0.0).alias("score")).schema
    names = source.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = Restorer(held.value.language)
        for rows, _, _ in slices(batches, text):
            texts = [tool.text(t or "") for t in rows.column(names.index(text)).to_pylist()]
            body = [t.encode() for t in texts]
            bounds = np.cumsum([0, *map(len, body)])
            values = held.value.scores(np.frombuffer(b"".join(body), np.uint8), bounds)
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(texts, pa.string()), pa.array(values)],
                names=[*names, "restored_text", "score"],
            )

    return source.mapInArrow(run, schema)


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's doc_id, held_out, score and predicted label."""
    prepare(spark)
    documents = read(spark, folder, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    labels = read(spark, folder, "labels").select("doc_id", "toxic").filter(~held_out)
    model = learn(documents, labels)
    return score(documents, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
