"""Bloom filters of 64-bit keys, built by Spark and looked up inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from cardledger.llm.texts import mix
from cardledger.sources.scratch import saved

BITS_PER_KEY = 16
BITS = 5  # that a key sets, all in one word
MOST_KEYS = 3 << 24  # of one filter: 96 MB
STRETCH = 1 << 19  # words of a filter that the driver fetches at a time: 8 MB


def _places(keys: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The word of each key, and the bits it has there."""
    h = mix(keys + np.uint64(0x9E3779B97F4A7C15))
    word = ((h >> np.uint64(32)) * np.uint64(words) >> np.uint64(32)).astype(np.int64)
    bits = np.zeros(len(keys), np.int64)
    for i in range(BITS):
        bits |= np.int64(1) << ((h >> np.uint64(6 * i)) & np.uint64(63)).astype(np.int64)
    return word, bits


class Bloom:
    """A set of keys that knows all its members, and some other keys besides (under 1 in 150).

    A key's bits are in one word, so that building it moves a row per key, and a look-up reads once. The
    words may be a broadcast variable: then the driver does not hold them, however many filters there are.
    """

    def __init__(self, words: np.ndarray | Broadcast):
        self._words = words

    @property
    def words(self) -> np.ndarray:
        return self._words.value if isinstance(self._words, Broadcast) else self._words

    def knows(self, keys: np.ndarray) -> np.ndarray:
        words = self.words
        word, bits = _places(keys.view(np.uint64), len(words))
        return words[word] & bits == bits

    def look_up(self, column: Column) -> Column:
        @F.pandas_udf("boolean")
        def knows(values: pd.Series) -> pd.Series:
            return pd.Series(self.knows(values.to_numpy(np.int64)))

        return knows(column)


def _build(keys: DataFrame, n: int, stretch: int) -> Bloom:
    size = max(1, -(-n * BITS_PER_KEY // 64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, bits = _places(batch["key"].to_numpy().view(np.uint64), size)
            order = np.argsort(at)
            word, first = np.unique(at[order], return_index=True)
            masks = np.bitwise_or.reduceat(bits[order], first) if len(word) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(masks)], names=["word", "mask"])

    set_bits = keys.select("key").mapInArrow(run, "word long, mask long")
    merged = set_bits.groupBy("word").agg(F.bit_or("mask").alias("mask"))  # at most `size` rows
    words = np.zeros(size, np.int64)
    parts = [merged]
    if stretch < size:
        merged = saved(merged, "bits")
        parts = [merged.where(F.col("word").between(k, k + stretch - 1)) for k in range(0, size, stretch)]
    for part in parts:
        rows = part.toArrow()  # two arrays; a row of Python objects takes some hundred bytes
        words[rows["word"].to_numpy()] = rows["mask"].to_numpy()
    return Bloom(keys.sparkSession.sparkContext.broadcast(words))


def blooms(keys: DataFrame, most: int = MOST_KEYS, stretch: int = STRETCH) -> list[Bloom]:
    """Filters that together know all rows of `keys` (a table with the column key).

    One filter holds at most about `most` keys, so its size has a bound. Of more keys each filter has
    a part, dealt by hash; whoever uses them goes through them one by one. The driver fetches `stretch` words
    of a filter at a time, and lets go of each filter once it is a broadcast variable.
    """
    n = keys.count()
    parts = max(1, -(-n // most))
    if parts == 1:
        return [_build(keys, n, stretch)]
    part = F.pmod(F.xxhash64("key"), F.lit(parts))
    return [_build(keys.where(part == k), n // parts + n // parts // 16 + 64, stretch) for k in range(parts)]


def only_keys(df: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """The rows of `df` whose `column` (long) is among `keys`, and few others: less to move in a join."""
    filters = blooms(keys)
    part = F.pmod(F.xxhash64(F.col(column)), F.lit(len(filters)))
    kept = None
    for k, bloom in enumerate(filters):
        mine = bloom.look_up(F.col(column))
        found = df.where(mine if len(filters) == 1 else (part == k) & mine)
        kept = found if kept is None else kept.union(found)
    return kept
