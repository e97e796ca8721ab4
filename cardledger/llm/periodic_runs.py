"""Periodic runs of words, found by internal pattern matching.

A run is a stretch of words with smallest period q and at least max(LEAST, EXPONENT * q) words that
cannot be extended. Such a run holds a whole dyadic block (2**k words, from a multiple of 2**k) with
q < 2**k <= 2 * q, and the block occurs again q words to the right or to the left, still inside the
run. No occurrence lies nearer: it would give the run a smaller period (Fine and Wilf). So per block
two questions are enough, both asked in the windows that adjoin it: where does it occur next, and
where did it occur last? The places of a block are an interval of the suffix array, and "next after
here in this interval" is a range successor, answered by a wavelet matrix over the suffix array in as
many steps as a position has bits. Occurrences so near that they overlap are an arithmetic progression;
its step is the candidate period. The stretch is then extended both ways by binary search over prefix
hashes and compared word by word, so a hash collision cannot change a result.

The suffix array is built by prefix doubling, whose classes of 2**k words are just the blocks'
intervals. All documents of a group are worked on at once, as arrays; symbols of different documents
differ, so no occurrence is found in another document. Time is O(n log n) in the words of a group.

Each document stands alone: nothing is shuffled. Memory is bounded by a group of GROUP_BYTES of texts
or, where it is longer, one text (some 300 bytes a word).

Defined cases: a null or empty text has no words, no runs, and collapses to an empty text. Repeated
rows, and rows with a null id, are documents of their own. An empty table gives no rows. Other columns
are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from cardledger.llm.plain_words import GROUP_BYTES, PlainWords
from cardledger.llm.texts import Prefix, as_bytes, groups

LEAST = 6  # words that a run has at least
EXPONENT = 4  # periods that a run has at least


def sorted_suffixes(symbol: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array, and the dyadic blocks that occur more than once: rows of (start, size,
    from, to), where the block's places are suffix_array[from:to].

    `end[i]` is the end of the text of word i; equal symbols are of one text.
    """
    n = len(symbol)
    places = np.argsort(symbol, kind="stable")
    rank = np.empty(n, np.int64)  # how many suffixes have a smaller beginning of `size` words
    slots, pos, key = np.arange(n), places.copy(), symbol[places]
    blocks, size = [], 1
    while len(slots):
        heads = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        members = np.diff(np.r_[heads, len(key)])
        rank[pos] = np.repeat(slots[heads], members)
        again = np.repeat(members > 1, members)  # a beginning that occurs once needs no more sorting
        slots, pos, members = slots[again], pos[again], np.repeat(members, members)[again]
        if size > 1:
            whole = np.flatnonzero(pos % size == 0)
            s = pos[whole]
            blocks.append(np.stack([s, np.full(len(s), size), rank[s], rank[s] + members[whole]], 1))
        after = pos + size
        inside = after < end[pos]
        key = rank[pos] * (n + 1) + np.where(inside, rank[np.where(inside, after, 0)] + 1, 0)
        order = np.argsort(key, kind="stable")
        pos, key = pos[order], key[order]
        places[slots] = pos
        size *= 2
    return places, np.concatenate(blocks) if blocks else np.zeros((0, 4), np.int64)


class Wavelet:
    """A wavelet matrix: one plane per bit of the values, from the highest, each with a popcount index."""

    def __init__(self, values: np.ndarray):
        self.planes = []
        for bit in reversed(range(max(1, int(values.max(initial=0)).bit_length()))):
            ones = (values >> bit & 1).astype(bool)
            padded = np.zeros((len(ones) // 64 + 1) * 64, bool)
            padded[: len(ones)] = ones
            words = np.packbits(padded, bitorder="little").view(np.uint64)
            before = np.cumsum(np.r_[0, np.bitwise_count(words)[:-1].astype(np.int64)])
            self.planes.append((bit, words, before, len(ones) - int(ones.sum())))
            values = np.concatenate([values[~ones], values[ones]])

    @staticmethod
    def _ones(words: np.ndarray, before: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Ones of a plane before place i."""
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return before[i >> 6] + np.bitwise_count(words[i >> 6] & below)

    def smaller(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many of values[lo:hi] are smaller than x."""
        count = np.zeros(len(lo), np.int64)
        for bit, words, before, zeros in self.planes:
            a, b = self._ones(words, before, lo), self._ones(words, before, hi)
            up = (x >> bit & 1).astype(bool)
            count += np.where(up, hi - b - lo + a, 0)
            lo, hi = np.where(up, zeros + a, lo - a), np.where(up, zeros + b, hi - b)
        return count

    def nth(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest (from 0) of values[lo:hi]."""
        value = np.zeros(len(lo), np.int64)
        for bit, words, before, zeros in self.planes:
            a, b = self._ones(words, before, lo), self._ones(words, before, hi)
            low = hi - b - lo + a
            up = k >= low
            value |= up.astype(np.int64) << bit
            k = np.where(up, k - low, k)
            lo, hi = np.where(up, zeros + a, lo - a), np.where(up, zeros + b, hi - b)
        return value

    def neighbours(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range successor and predecessor: of values[lo:hi], which hold x, the next above and below x
        (x itself where there is none)."""
        place = self.smaller(lo, hi, x)
        return self.nth(lo, hi, np.minimum(place + 1, hi - lo - 1)), self.nth(lo, hi, np.maximum(place - 1, 0))


def _reach(same, limit: np.ndarray) -> np.ndarray:
    """The largest m <= limit with same(m), for each element, by binary search."""
    low, high = np.zeros(len(limit), np.int64), limit.astype(np.int64)
    while (low < high).any():
        middle = (low + high + 1) // 2
        fits = same(middle)
        low, high = np.where(fits, middle, low), np.where(fits, high, middle - 1)
        high = np.maximum(low, high)
    return low


def runs_of(symbol: np.ndarray, start: np.ndarray, end: np.ndarray, least: int = LEAST) -> np.ndarray:
    """All runs, as rows of (start, length, period) by start and period; start and end of each word's text."""
    none = np.zeros((0, 3), np.int64)
    if not len(symbol):
        return none
    places, blocks = sorted_suffixes(symbol, end)
    if not len(blocks):
        return none
    at, size, lo, hi = blocks.T
    after, before = Wavelet(places).neighbours(lo, hi, at)
    left = np.r_[at, before]
    step = np.r_[after - at, at - before]
    size = np.tile(size, 2)
    near = np.flatnonzero((2 * step >= size) & (step < size))
    left, step = left[near], step[near]
    prefix = Prefix(symbol)
    hashes = prefix.hashes
    ahead = _reach(lambda m: hashes(left, left + m) == hashes(left + step, left + step + m), end[left] - left - step)
    back = _reach(lambda m: hashes(left - m, left) == hashes(left + step - m, left + step), left - start[left])
    found = np.stack([left - back, left + step + ahead, step, left], 1)
    long = found[:, 1] - found[:, 0] >= np.maximum(least, EXPONENT * step)
    found = found[long]
    _, once = np.unique(found[:, :3], axis=0, return_index=True)
    sure = set()
    for a, b, q, inside in found[once].tolist():
        wrong = np.flatnonzero(symbol[a : b - q] != symbol[a + q : b]) + a
        if len(wrong):  # a hash collision: up to the next words that differ, on both sides
            a = int(max(wrong[wrong < inside], default=a - 1)) + 1
            b = int(min(wrong[wrong >= inside], default=b - q)) + q
        if b - a >= max(least, EXPONENT * q):
            sure.add((a, b - a, q))
    return np.array(sorted((a, n, q) for a, n, q in sure), np.int64).reshape(-1, 3)


def by_text(texts: list[bytes], least: int = LEAST) -> tuple[PlainWords, np.ndarray, np.ndarray]:
    """The words of a group of texts, all runs in it, and bounds of each text's runs."""
    words = PlainWords(texts)
    owner = words.owner()
    found = runs_of(owner * max(1, len(words.kinds)) + words.id, words.first[owner], words.first[owner + 1], least)
    found = found[np.lexsort((found[:, 2], found[:, 0]))]
    return words, found, np.searchsorted(found[:, 0], words.first)


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words, of each run the first period only, joined by one space."""
    if not len(runs):
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([w for w, inside in zip(words, np.cumsum(edge).tolist()) if not inside])


RUN = StructType([StructField(name, LongType()) for name in ("start", "length", "period")])


def find(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start and period) and the collapsed text."""
    slim = docs.select("doc_id", "text")
    schema = StructType([slim.schema["doc_id"]])
    schema.add("n_words", LongType()).add("runs", ArrayType(RUN)).add("collapsed", StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, group in groups(as_bytes(batch["text"]), GROUP_BYTES):
                words, found, bounds = by_text(group, least)
                own = found.copy()
                own[:, 0] -= words.first[np.searchsorted(words.first, found[:, 0], "right") - 1]
                texts = [
                    collapsed(w, own[a:b]) for w, a, b in zip(words.words, bounds.tolist(), bounds[1:].tolist())
                ]
                fields = pa.StructArray.from_arrays([pa.array(own[:, k]) for k in range(3)], ["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(first, len(group)),
                        pa.array(np.diff(words.first)),
                        pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), fields),
                        pa.array(texts, pa.binary()).view(pa.string()),
                    ],
                    names=schema.names,
                )

    return slim.mapInArrow(run, schema)


def strongest() -> F.Column:
    """Of `runs` the one with the greatest length / period, compared exactly; then by start and period."""
    return F.aggregate(
        "runs",
        F.lit(None).cast(RUN),
        lambda best, r: F.when(
            best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r
        ).otherwise(best),
    )


def digest(found: DataFrame) -> DataFrame:
    """One row per document: its runs counted, the strongest, and digests of all runs and of what is left."""
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    top = found.withColumn("_top", strongest())
    return top.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("_top.start").alias("start"),
        F.col("_top.length").alias("length"),
        F.col("_top.period").alias("period"),
        F.expr("(1000 * _top.length) div _top.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(listed, lambda x: F.concat(x, F.lit("\n"))), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def with_planted(docs: DataFrame) -> DataFrame:
    """doc_id and text, where one document in ten repeats a stretch of its words up to its end.

    With h = crc32(decimal doc_id), g = h div 10, n words, a = g mod n and p = 1 + (n - a) div (3 + g mod 8):
    if h mod 10 = 0, word i >= a becomes the word a + (i - a) mod p.
    """
    words = "filter(split(text, '[\\\\x20\\\\x09-\\\\x0D]+'), w -> w <> '')"
    hashed = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("_h"))
    planted = f"""
      case when _h % 10 = 0 then
        element_at(transform(array({words}), w -> element_at(transform(array((_h div 10) % greatest(size(w), 1)), a ->
          element_at(transform(array(1 + (size(w) - a) div (3 + (_h div 10) % 8)), p ->
            concat_ws(' ', transform(w, (x, i) -> if(i < a, x, w[int(a + (i - a) % p)])))), 1)), 1)), 1)
      else text end"""
    return hashed.select("doc_id", F.expr(planted).alias("text"))
