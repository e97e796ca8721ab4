"""Benchmark decontamination: one Aho-Corasick automaton over the windows of normalised items.

A text is normalised to its lower-cased words with one blank between them, and is scanned once.
Matches are mapped back to words and to byte offsets of the original text.

Defined cases: a null or wordless document has no words and no hits. A null or wordless item has no
window. An item with fewer than `width` words is one window. An item id listed twice counts once.
Equal windows of several items count for each. Repeated rows give repeated results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from cardledger.llm.texts import FOLD, as_bytes, fold_words

WIDTH = 10
# Items' text that one automaton takes. More items make more automata, and each scans all documents.
AUTOMATON_BYTES = 8 << 20

Items = list[tuple[str, bytes]]


def item_blocks(items: DataFrame, id_col: str, text_col: str, limit: int) -> Iterator[Items]:
    """The items in blocks of about `limit` bytes, one block at a time on the driver."""
    rows = items.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    rows = rows.where(F.col("id").isNotNull() & F.col("text").isNotNull())
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-int(size) // limit))
    for k in range(blocks):
        mine = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == k) if blocks > 1 else rows
        yield sorted((r.id, r.text.encode()) for r in mine.toLocalIterator())


class Automaton:
    """All windows of a block of items; a window carries its word count and its items."""

    def __init__(self, items: Items, width: int):
        owners: dict[bytes, set[str]] = {}
        for item, text in items:
            words = fold_words(text)
            for k in range(max(len(words) - width, 0) + 1 if words else 0):
                window = b" " + b" ".join(words[k : k + width]) + b" "
                owners.setdefault(window, set()).add(item)
        self.found = ahocorasick.Automaton()
        for window, ids in owners.items():
            self.found.add_word(window.decode("latin-1"), (len(window), sorted(ids)))
        self.empty = not owners
        if owners:
            self.found.make_automaton()

    def scan(self, text: bytes) -> tuple[int, np.ndarray, set[str]]:
        """Number of words, the indexes of hit words, and the items with an occurring window."""
        words = fold_words(text)
        none = np.zeros(0, np.int64)
        if self.empty or not words:
            return len(words), none, set()
        plain = b" ".join(words)
        matches = [(end, *hit) for end, hit in self.found.iter(f" {plain.decode('latin-1')} ")]
        if not matches:
            return len(words), none, set()
        starts = np.cumsum([0] + [len(w) + 1 for w in words])  # of each word, after the first blank
        last = np.searchsorted(starts, [m[0] for m in matches])
        first = np.searchsorted(starts, [m[0] - m[1] + 1 for m in matches])
        cover = np.zeros(len(words) + 1, np.int64)
        np.add.at(cover, first, 1)
        np.add.at(cover, last, -1)
        return len(words), np.flatnonzero(np.cumsum(cover)[:-1]), set().union(*(m[2] for m in matches))


_built: dict[str, Automaton] = {}


def automaton(items: Items, width: int) -> Automaton:
    """A worker builds an automaton once and keeps the last few."""
    key = hashlib.sha256(repr((width, items)).encode()).hexdigest()
    if key not in _built:
        while len(_built) > 2:
            _built.pop(next(iter(_built)))
        _built[key] = Automaton(items, width)
    return _built[key]


def word_spans(text: bytes, hits: np.ndarray) -> list[list[int]]:
    """Byte ranges of the original text for runs of neighbouring hit words."""
    if not len(hits):
        return []
    inside = np.frombuffer(b" " + text.translate(FOLD) + b" ", np.uint8) != 0x20
    edge = np.diff(inside.astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    cut = np.flatnonzero(np.diff(hits) > 1)
    runs = zip(hits[np.r_[0, cut + 1]], hits[np.r_[cut, len(hits) - 1]])
    return [[int(start[a]), int(end[b])] for a, b in runs]


HITS = ArrayType(LongType())
FOUND = StructType(
    [
        StructField("_id", LongType()),
        StructField("_text", StringType()),
        StructField("n_words", LongType()),
        StructField("hit_words", HITS),
        StructField("items", ArrayType(StringType())),
    ]
)


def scan(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = WIDTH,
    limit: int = AUTOMATON_BYTES,
    id_col: str = "doc_id",
) -> DataFrame:
    """(id, text, n_words, hit_words, items) of every row of `docs`, without a shuffle.

    hit_words holds the numbers of hit words, ascending; items the sorted ids found. Only the two
    named columns of `docs` are read, so other columns may have any name.
    """
    out = docs.select(
        F.col(id_col).cast("long").alias("_id"),
        F.col(text_col).alias("_text"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<bigint>").alias("hit_words"),
        F.array().cast("array<string>").alias("items"),
    )
    for block in item_blocks(items, item_id, item_text, limit):

        def scan_block(batches: Iterator[pa.RecordBatch], block: Items = block) -> Iterator[pa.RecordBatch]:
            found = automaton(block, width)
            for batch in batches:
                n_words, hits, ids = [], [], []
                old = zip(batch["hit_words"].to_pylist(), batch["items"].to_pylist())
                for text, (old_hits, old_ids) in zip(as_bytes(batch["_text"]), old):
                    n, h, i = found.scan(text)
                    n_words.append(n)
                    hits.append(np.union1d(h, np.array(old_hits, np.int64)) if old_hits else h)
                    ids.append(sorted(i.union(old_ids)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["_id"],
                        batch["_text"],
                        pa.array(n_words, pa.int64()),
                        pa.array(hits, pa.list_(pa.int64())),
                        pa.array(ids, pa.list_(pa.string())),
                    ],
                    names=FOUND.names,
                )

        out = out.mapInArrow(scan_block, FOUND)
    return out.withColumnsRenamed({"_id": id_col, "_text": text_col})


def spans(scanned: DataFrame, text_col: str = "text") -> DataFrame:
    """`scan`'s rows with `spans`: byte ranges of the original text under runs of hit words."""
    schema = StructType(scanned.schema.fields + [StructField("spans", ArrayType(HITS))])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = (np.array(h, np.int64) for h in batch["hit_words"].to_pylist())
            marked = [word_spans(t, h) for t, h in zip(as_bytes(batch[text_col]), hits)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(marked, pa.list_(pa.list_(pa.int64())))], names=schema.names
            )

    return scanned.mapInArrow(mark, schema)


def digest(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per document: counts, the found items' digest, and the verdict."""
    return scanned.select(
        id_col,
        "n_words",
        F.size("hit_words").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text", width: int = WIDTH, **names) -> DataFrame:
    """The rows of `docs`, with all their columns, in which no window of an item occurs."""
    for block in item_blocks(items, names.get("item_id", "item_id"), names.get("item_text", "text"), AUTOMATON_BYTES):

        def keep(batches: Iterator[pa.RecordBatch], block: Items = block) -> Iterator[pa.RecordBatch]:
            found = automaton(block, width)
            for batch in batches:
                hit = [bool(len(found.scan(text)[1])) for text in as_bytes(batch[text_col])]
                yield batch.filter(pa.array([not h for h in hit], pa.bool_()))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
