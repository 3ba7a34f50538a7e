"""Words and word shingles of many texts at once, as 64-bit hashes in numpy arrays.

A word's hash is the sum of a random constant per byte times a power of an odd base, modulo 2**64,
divided by the power at the word's start. Prefix sums give it for all words in a few passes over
the bytes, with no Python step per word.
"""

from __future__ import annotations

from functools import cache

import numpy as np

from presswork.llm.frames import remembered

_BASE = 0x9E3779B97F4A7C15 | 1
_SEED = 20_240_229
WIDTH = 5
ASCII_SPACE = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


@cache
def byte_map(letters_only: bool = False) -> np.ndarray:
    """Bytes with A-Z in lower case and 0 for separators.

    Separators are the ASCII white space bytes, and with ``letters_only`` every ASCII byte that is
    neither letter nor digit. The zero byte itself is an ordinary character of a word.
    """
    table = np.arange(256, dtype=np.int16)
    table[65:91] += 32
    table[0] = 256
    table[list(ASCII_SPACE)] = 0
    if letters_only:
        table[[b for b in range(128) if not chr(b).isalnum()]] = 0
    return table


@cache
def _constants() -> np.ndarray:
    return np.random.default_rng(_SEED).integers(1, 2**63, 257, dtype=np.uint64) * np.uint64(2) + 1


@remembered
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    n = 1 << bits
    inverse = pow(_BASE, -1, 1 << 64)
    up, down = np.full(n, _BASE, np.uint64), np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    values *= np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def _unspaced(body: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First bytes and lengths of the characters of scripts without spaces between words."""
    first = np.flatnonzero(body >= 0xE0)
    lead, second = body[first], body[first + 1]
    among = lambda low, high: (second >= low) & (second <= high)
    found = (lead >= 0xE3) & (lead <= 0xE9)  # U+3000 to U+9FFF
    found |= (lead == 0xE0) & (second >= 0xB8)  # Thai, Lao, Tibetan: U+0E00 to U+0FFF
    found |= (lead == 0xE1) & (among(0x80, 0x81) | among(0x9E, 0x9F))  # Burmese, Khmer
    found |= (lead == 0xE2) & (second >= 0xBA)  # radicals: U+2E80 to U+2FFF
    found |= (lead == 0xEF) & (among(0xA4, 0xAB) | among(0xBC, 0xBF))  # compatibility, wide forms
    found |= (lead == 0xF0) & among(0xA0, 0xB3)  # U+20000 to U+33FFF
    return first[found], np.where(lead[found] == 0xF0, 4, 3)


class Words:
    """The words of a slice of texts: byte ``start`` and ``end``, ``row``, ``hash``.

    ``first[r]:first[r + 1]`` are the words of row ``r``. With ``unspaced``, each character of
    Chinese, Japanese, Thai, Lao, Tibetan, Burmese or Khmer writing is a word.
    """

    def __init__(self, body: np.ndarray, bounds: np.ndarray, letters_only: bool = False, unspaced: bool = False):
        codes = byte_map(letters_only)[body]
        inside = codes != 0
        before = np.zeros(len(inside), bool)
        before[1:] = inside[:-1]
        after = np.zeros(len(inside), bool)
        after[:-1] = inside[1:]
        edges = bounds[(bounds > 0) & (bounds < len(inside))]
        before[edges] = False
        after[edges - 1] = False
        if unspaced:
            first, size = _unspaced(body)
            last = first + size - 1
            before[first] = after[last] = False
            after[first[first > 0] - 1] = False
            before[last[last + 1 < len(inside)] + 1] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, bounds)
        self.row = np.repeat(np.arange(len(bounds) - 1), np.diff(self.first))
        up, down = _powers(max(16, int(len(codes)).bit_length()))
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(_constants()[codes] * up[: len(codes)], out=sums[1:])
        self._sums, self._down = sums, down
        self.hash = self._hash(self.end)

    def _hash(self, end: np.ndarray) -> np.ndarray:
        raw = (self._sums[end] - self._sums[self.start]) * self._down[self.start]
        return mix(raw + (end - self.start).astype(np.uint64))

    def heads(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Which words have more than ``size`` bytes, and the hashes of their first ``size``."""
        longer = self.end - self.start > size
        return longer, self._hash(np.where(longer, self.start + size, self.end))[longer]

    def __len__(self) -> int:
        return len(self.start)


def joined(hashes: np.ndarray, width: int, n: int) -> np.ndarray:
    """The hashes of the first ``n`` sequences of ``width`` words."""
    factors = _constants()[1 : width + 1]
    total = np.full(n, width, np.uint64) * factors[0]
    for k in range(width):
        total += hashes[k : k + n] * factors[k]
    return mix(total)


def shingles(words: Words, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of each row, sorted within the row, and the rows' bounds.

    A row with fewer words than ``width`` has its whole sequence as its only shingle; a row
    without words has none.
    """
    counts = np.diff(words.first)
    n = len(words) - width + 1
    values = joined(words.hash, width, n) if n > 0 else np.zeros(0, np.uint64)
    found, sizes = [], np.zeros(len(counts), np.int64)
    for r, count in enumerate(counts.tolist()):
        if not count:
            continue
        at = words.first[r]
        if count >= width:
            own = np.unique(values[at : at + count - width + 1])
        else:
            own = joined(words.hash[at : at + count], count, 1)
        found.append(own)
        sizes[r] = len(own)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    return (np.concatenate(found) if found else np.zeros(0, np.uint64)), bounds
