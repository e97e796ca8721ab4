"""Removal of word windows that occur earlier, by recompression.

Each document's words are rewritten in steps: first maximal runs of a word become one symbol, then, in
each step, neighbours (x, y) with x in one half of the alphabet and y in the other become one. A symbol's
name is a hash of the words that it stands for and the halves are read off the name, so that all tasks,
and all documents, name the same runs and pairs alike, with nothing exchanged. Equal stretches of words
are therefore rewritten alike but for symbols that reach over their borders: on both sides at most the
outer run, and in each step the outer symbol where its half may pair it with what lies outside. What is
left after taking these off is the window's core, a function of its words alone. Of the symbols in its
last cores the one that stands for the most words (then by hash, then the last) is its anchor. Equal
windows have equal anchors at equal places; neighbouring windows mostly share one. A window all of which
is taken off (two runs, or little more) is its own anchor.

So Spark compares anchors, of which there is about one per six words, and not windows. They are dealt by
name, once. Anchors whose name occurs once are done. Of the others, those with equal words in all windows
that they stand for are one class: all but its first member are repeats as a whole. Only where a name has
several classes, the windows of one member of each are compared one by one, and the first of each window
stays. Longer repeats, down to whole copies, are found by class, with one row per anchor.

Hot names: equal anchors in the texts that a task works on together are settled there, and neighbouring
ones that are repeats become one row, so that of many copies few rows are dealt. The rest of a name is
sorted by Spark, with spilling, and never collected.

Stretches are compared by two 64-bit hashes over names of words, which are halves of a cryptographic
digest: the anchor's name by one, the words of all its windows by the other.

A word is removed if any window that covers it has its words also at an earlier place: in a document with
a smaller id, or in an earlier row of the same id, or earlier in the same document. Windows are judged
on the input.

Defined cases: a null or empty text has no words. Texts shorter than a window keep all words. Null ids
come first. Rows with one id come in the order of the table. Of repeated rows the first keeps its words,
if it has a window at all. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

from cardledger.llm.ngram_jaccard_join import numbered
from cardledger.llm.plain_words import GROUP_BYTES, PlainWords
from cardledger.llm.texts import Prefix, as_bytes, groups, mix
from cardledger.sources.scratch import saved

WIDTH = 20  # words in a window
PAIRS = 4  # steps of pairs after that of runs: then symbols stand for three words on average
LAST = 2  # so many of the last steps give anchors


class Symbols:
    """A rewritten sequence of words: `start` per symbol; symbols fill the texts without gaps."""

    def __init__(self, prefix: Prefix, owner: np.ndarray):
        self.prefix, self.owner = prefix, owner
        self._set(np.arange(len(owner)))

    def _set(self, start: np.ndarray) -> None:
        self.start = start
        self.end = np.r_[start[1:], len(self.owner)]
        self.name = self.prefix.hashes(start, self.end)

    def _joined(self, second: np.ndarray) -> np.ndarray:
        """Join each symbol that is `second` to the one before it; the new number of each old symbol."""
        number = np.cumsum(~second) - 1
        self._set(self.start[~second])
        return number

    def runs(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Replace runs; cores [lo, hi) lose the outer run on both sides."""
        text = self.owner[self.start]
        same = (self.name[1:] == self.name[:-1]) & (text[1:] == text[:-1])
        number = self._joined(np.r_[False, same])
        return number[lo] + 1, number[hi - 1]

    def pairs(self, lo: np.ndarray, hi: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray]:
        """Replace pairs; cores lose a first symbol that may be a second, and a last that may be a first."""
        text = self.owner[self.start]
        first = mix(self.name ^ np.uint64(0x9E3779B97F4A7C15 * (salt + 1) % (1 << 64))) & np.uint64(1) == 0
        paired = first[:-1] & ~first[1:] & (text[1:] == text[:-1])
        lo, hi = lo + ~first[lo], hi - first[hi - 1]
        number = self._joined(np.r_[False, paired])
        left = lo < hi
        return np.where(left, number[np.minimum(lo, len(number) - 1)], 0), np.where(left, number[hi - 1] + 1, 0)

    def longest(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol in [lo, hi) that ranks highest, and its rank: by length, then by hash; the last of equals."""
        rank = np.minimum(self.end - self.start, 63).astype(np.uint64) << np.uint64(58) | mix(self.name) >> np.uint64(6)
        best = [np.arange(len(rank))]  # best[k][i] is the one in [i, i + 2**k)
        size = hi - lo
        for k in range(int(size.max()).bit_length() - 1):
            a, b = best[k][: -(1 << k)], best[k][1 << k :]
            best.append(np.where(rank[b] >= rank[a], b, a))
        out = np.empty(len(lo), np.int64)
        power = np.frexp(size)[1] - 1
        for k, table in enumerate(best):
            some = np.flatnonzero(power == k)
            a, b = table[lo[some]], table[hi[some] - (1 << k)]
            out[some] = np.where((rank[b] > rank[a]) | (rank[b] == rank[a]) & (b > a), b, a)
        return out, rank[out]


def window_starts(words: PlainWords, width: int) -> np.ndarray:
    """The first words of all windows."""
    n = np.maximum(np.diff(words.first) - width + 1, 0)
    return np.repeat(words.first[:-1] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))


def anchors_of(words: PlainWords, width: int, pairs: int = PAIRS) -> tuple[np.ndarray, ...]:
    """(key, words, first, count): per anchor its name, a hash of the words of all its windows, and these
    windows, which are neighbours: `count` of them from word `first` on."""
    at = window_starts(words, width)
    if not len(at):
        none = np.zeros(0, np.int64)
        return none, none, none, none
    one, two = (Prefix(n) for n in words.names())
    symbols = Symbols(one, words.owner())
    start, end = at.copy(), at + width  # of each window's anchor
    rank = np.zeros(len(at), np.uint64)
    alive, lo, hi = np.arange(len(at)), at, at + width
    for step in range(pairs + 1):
        lo, hi = symbols.pairs(lo, hi, step) if step else symbols.runs(lo, hi)
        left = np.flatnonzero(lo < hi)
        alive, lo, hi = alive[left], lo[left], hi[left]
        if not len(alive):
            break
        if step > pairs - LAST:
            best, its_rank = symbols.longest(lo, hi)
            better = its_rank >= rank[alive]
            which, best = alive[better], best[better]
            rank[which], start[which], end[which] = its_rank[better], symbols.start[best], symbols.end[best]
    fresh = np.r_[True, (start[1:] != start[:-1]) | (end[1:] != end[:-1]) | (at[1:] != at[:-1] + 1)]
    begin = np.flatnonzero(fresh)
    count = np.diff(np.r_[begin, len(at)])
    first = at[begin]
    return one.hashes(start[begin], end[begin]), two.hashes(first, first + count - 1 + width), first, count


def settled(key: np.ndarray, more: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Which rows have an equal one (key, more) at an earlier place."""
    order = np.lexsort((place, more, key))
    again = (key[order][1:] == key[order][:-1]) & (more[order][1:] == more[order][:-1])
    out = np.zeros(len(key), bool)
    out[order[1:]] = again
    return out


class _Group:
    """Documents worked on together, and rows about their words as a batch of `SCHEMA`."""

    def __init__(self, batch: pa.RecordBatch, begin: int, texts: list[bytes]):
        self.doc_id, self.row = (batch[c].slice(begin, len(texts)) for c in ("doc_id", "row"))
        self.words = PlainWords(texts)
        order = pa.table({"doc_id": self.doc_id, "row": self.row})
        places = pa.compute.sort_indices(
            order, sort_keys=[("doc_id", "ascending"), ("row", "ascending")], null_placement="at_start"
        ).to_numpy()
        self.turn = np.empty(len(texts), np.int64)  # the document's place among these
        self.turn[places] = np.arange(len(texts))

    def batch(self, key: np.ndarray, more: np.ndarray, first: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
        """Rows of windows from word `first` on (counted over the group), one per key and `more`; the
        later ones of a key are `known` to be repeats, and neighbours among them become one row."""
        owner = np.searchsorted(self.words.first, first, "right") - 1
        longest = int(np.diff(self.words.first).max(initial=0)) + 1
        own = first - self.words.first[owner]
        known = settled(key, more, self.turn[owner] * longest + own)
        rows = np.flatnonzero(~known)
        again = np.flatnonzero(known)
        a, n = first[again], count[again]
        begin = np.flatnonzero(np.r_[True, (a[1:] != a[:-1] + n[:-1]) | (owner[again][1:] != owner[again][:-1])][: len(a)])
        total = np.add.reduceat(n, begin) if len(begin) else n
        again = again[begin]
        chosen = np.r_[rows, again]
        # Rows that are known to be repeats need no key; they are dealt by place.
        deal = np.r_[key[rows], mix(first[again].astype(np.uint64))]
        which = pa.array(owner[chosen])
        return pa.RecordBatch.from_arrays(
            [
                self.doc_id.take(which),
                self.row.take(which),
                pa.array(deal.view(np.int64)),
                pa.array(np.r_[more[rows], np.zeros(len(again), np.uint64)].view(np.int64)),
                pa.array(own[chosen].astype(np.int32)),
                pa.array(np.r_[count[rows], total].astype(np.int32)),
                pa.array(np.r_[np.zeros(len(rows), bool), np.ones(len(again), bool)]),
            ],
            names=SCHEMA.names,
        )


SCHEMA = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("row", LongType()),
        StructField("key", LongType()),
        StructField("more", LongType()),
        StructField("first", IntegerType()),
        StructField("count", IntegerType()),
        StructField("known", BooleanType()),
    ]
)


def anchor_table(docs: DataFrame, width: int) -> DataFrame:
    """SCHEMA: the anchors of all documents (row, doc_id, text); `first` counts within the document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in groups(as_bytes(batch["text"]), GROUP_BYTES):
                group = _Group(batch, begin, texts)
                yield group.batch(*anchors_of(group.words, width))

    return docs.select("doc_id", "row", "text").mapInArrow(run, SCHEMA)


def window_table(docs: DataFrame, width: int) -> DataFrame:
    """SCHEMA: the windows that are listed per document in `anchors` (first, count), one by one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in groups(as_bytes(batch["text"]), GROUP_BYTES):
                group = _Group(batch, begin, texts)
                listed = batch["anchors"].slice(begin, len(texts))
                flat = listed.flatten()
                owner = np.repeat(np.arange(len(texts)), listed.value_lengths().to_numpy())
                first, count = (flat.field(c).to_numpy().astype(np.int64) for c in ("first", "count"))
                first = first + group.words.first[owner]
                at = np.sort(np.repeat(first - np.cumsum(count) + count, count) + np.arange(int(count.sum())))
                hashes = [Prefix(names).hashes(at, at + width) for names in group.words.names()]
                yield group.batch(*hashes, at, np.ones(len(at), np.int64))

    return docs.select("doc_id", "row", "text", "anchors").mapInArrow(run, SCHEMA)


def _place() -> Window:
    return Window.partitionBy("key", "more", "known").orderBy("doc_id", "row", "first")


def repeated_windows(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(row, first, count): windows of documents (row, doc_id, text) that occur earlier, `count` from `first` on."""
    # One exchange, by name, serves both windows; nothing is sent of names that occur once.
    dealt = anchor_table(docs, width).repartition("key")
    by_name = Window.partitionBy("key", "known")
    placed = dealt.withColumn("_place", F.row_number().over(_place())).withColumn(
        "_several", F.min("more").over(by_name) < F.max("more").over(by_name)
    )
    again = F.col("known") | (F.col("_place") > 1)
    found = placed.select("row", "first", "count", again.alias("again"), "_several").where("again or _several")
    found = saved(found.drop("_several"), "anchors")

    # A name with several classes: the windows of the first member of each class.
    listed = found.where("not again").groupBy(F.col("row").alias("_row")).agg(
        F.collect_list(F.struct("first", "count")).alias("anchors")  # of one document
    )
    windows = window_table(docs.join(listed, F.col("row") == F.col("_row")), width).repartition("key")
    later = windows.withColumn("_place", F.row_number().over(_place())).where(F.col("known") | (F.col("_place") > 1))
    return found.where("again").select("row", "first", "count").union(later.select("row", "first", "count"))


def without_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words, joined by one space, for every row of `docs` (doc_id, text).

    `docs` must be a table or a plan that gives the same rows in the same partitions each time.
    """
    rows = numbered(docs.select("doc_id", "text"))
    found = repeated_windows(rows, width)
    listed = found.groupBy(F.col("row").alias("_row")).agg(F.collect_list(F.struct("first", "count")).alias("spans"))
    joined = rows.join(listed, F.col("row") == F.col("_row"), "left").select("doc_id", "text", "spans")
    schema = StructType([docs.schema["doc_id"]]).add("n_words", "long").add("n_removed", "long").add("kept", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for text, spans in zip(as_bytes(batch["text"]), batch["spans"]):
                words = text.split()
                n_words.append(len(words))
                if spans.is_valid and len(spans.values):
                    first, count = (spans.values.field(c).to_numpy().astype(np.int64) for c in ("first", "count"))
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, first, 1)
                    np.add.at(edge, first + count - 1 + width, -1)
                    words = [w for w, gone in zip(words, np.cumsum(edge).tolist()) if not gone]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words))
            columns = [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).view(pa.string())]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns], names=schema.names)

    return joined.mapInArrow(run, schema)


def digest(kept: DataFrame) -> DataFrame:
    """The result with the SHA-256 of the kept words in place of them."""
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
