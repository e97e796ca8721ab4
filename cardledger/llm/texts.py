"""Whole batches of texts as numpy arrays: words, hashes of words and of byte ranges.

Every function here works on a bounded group of texts inside one task. Hashes are polynomials mod
2**64, passed through a mixing step: equal strings always have equal hashes, and where a result
rests on two strings being equal, the operator that uses them says what it checks besides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

GROUP_BYTES = 1 << 20  # texts worked on at a time, in bytes; a longer text is a group of its own

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))

# Words are runs of the bytes that are neither ASCII controls, blanks nor punctuation; A-Z count as
# a-z. In UTF-8 every byte of a character beyond ASCII is 0x80 or more, so bytes will do.
_fold = bytearray(b" " * 256)
for _b in range(256):
    if _b >= 0x80 or chr(_b).isalnum():
        _fold[_b] = _b + 32 if 0x41 <= _b <= 0x5A else _b
FOLD = bytes(_fold)
_is_word = np.frombuffer(FOLD, np.uint8) != 0x20


def wrapped(docs: DataFrame, row: str) -> DataFrame:
    """Two columns: a row's number, named `row`, and _doc with all columns of `docs`, so that no names clash."""
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(F.monotonically_increasing_id().alias(row), doc.alias("_doc"))


def fold_words(text: bytes) -> list[bytes]:
    """The words of a text, lower-cased."""
    return text.translate(FOLD).split()


def as_bytes(column: pa.Array) -> list[bytes]:
    """A string column as UTF-8, null as empty."""
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_binary())
    else:
        column = column.cast(pa.binary())
    return [t or b"" for t in column.to_pylist()]


def groups(texts: list[bytes], limit: int = GROUP_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Neighbouring texts of `limit` bytes together, or one longer text; with the first's index."""
    first = size = 0
    for i, text in enumerate(texts):
        if i > first and size + len(text) > limit:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(text) + 1
    if first < len(texts):
        yield first, texts[first:]


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]  # a worker keeps the longest it has needed


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n."""
    if n > len(_powers[0]):
        for k, base in enumerate((BASE, BASE_INVERSE)):
            p = np.full(n + n // 4, base, np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the entropy of the high bits: a bijection of 64-bit values."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


class Prefix:
    """Prefix hashes of an array, so that any range's hash costs two look-ups."""

    def __init__(self, values: np.ndarray):
        up, self.down = powers(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[:-1], out=self.sums[1:])

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Mixed hashes of values[start:end]; ranges of other lengths differ too."""
        raw = (self.sums[end] - self.sums[start]) * self.down[start]
        return mix(raw + (end - start).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


class Words:
    """The words of a group of texts: `hash` per word, `first[i]:first[i+1]` are those of text i."""

    def __init__(self, texts: list[bytes]):
        joined = b" ".join(texts).translate(FOLD)
        data = np.frombuffer(joined, np.uint8)
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = _is_word[data]
        edge = np.diff(inside)
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.at = np.cumsum([0] + [len(t) + 1 for t in texts])  # where each text starts
        self.first = np.searchsorted(self.start, self.at)
        self.prefix = Prefix(data)
        self.hash = self.prefix.hashes(self.start, self.end)
        self.count = np.diff(self.first)

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.count)), self.count)


def shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `width` words, and the text of each; a shorter text is one run."""
    n = words.count
    runs = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    owner = np.repeat(np.arange(len(n)), runs)
    before = np.cumsum(runs) - runs
    start = words.first[:-1][owner] + np.arange(len(owner)) - before[owner]
    end = start + np.minimum(n, width)[owner]
    return Prefix(words.hash).hashes(start, end), owner
