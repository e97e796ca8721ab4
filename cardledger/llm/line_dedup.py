"""Line de-duplication across all documents by a deletion-neighbourhood join.

A line is its words, lower-cased. Two lines are the same if their words differ by at most one edit (more
with `growing`, see below): one word put in, left out or replaced. Lines of fewer than `EDIT_FROM` words allow no edit, so that
the words of two matching lines agree by 0.9 at least; lines of fewer than `MIN_WORDS` words are never
removed. A line is removed if an earlier line (by document id, row, line number) is the same.

Every line's variants within the bound (itself, and itself without one of its words) are hashed
keys; equal keys are joined by their earliest line, never as pairs, so any number of lines may share
one. Two lines share a variant if they are one edit apart, but also if a word moved; the edit
distance is verified from the places of the deletions: the same place in both lines is a
replacement, a place in one line and none in the other an insertion. A 64-bit and a 32-bit hash
stand for the words compared.

Most lines are like no other, and their variants are not moved. In turn, the keys that two different
lines have in common are found, and a Bloom filter of these keys tells the next pass over the texts
which lines or variants to emit: first the halves of lines (of two lines one edit apart, the words
before the middle or those after it are equal), then the variants. A filter loses nothing and its size
has a bound (`bloom.blooms`); what it lets through by mistake is dropped by the join.

Defined cases: a null text stays null and has no lines; wordless lines stay. Repeated rows count as
later copies. Ties cannot be: a line's place is unique. An empty table gives no rows. All columns
of the input are kept, whatever their names; only `text` (and n_chars, if there) changes. The two counts
that are added take the place of input columns of their names.

With `growing`, the bound grows with the length: one edit per `EDIT_FROM` words of the shorter line, so
that the agreement asked for is 0.9 whatever the length. Two lines that are k edits apart share one of
the k + 1 equal segments of the shorter one, at places at most k words apart. Segments are the keys: a
Bloom filter of all of them tells which other runs of words to emit, and only keys that two lines have
are joined. Each line is compared with the earliest line of its keys first, and only lines that stay with
the others, so that a large group of near copies is not compared in pairs. The edit distance is computed
from the words' hashes. Lines are told apart by their 64-bit hash there.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, IntegerType, LongType, StructField, StructType

from cardledger.llm.bloom import Bloom, blooms, only_keys
from cardledger.llm.texts import BASE_INVERSE, Prefix, Words, as_bytes, groups, mix, wrapped
from cardledger.sources.scratch import saved

MIN_WORDS = 3
EDIT_FROM = 10

ROW = "_line_dedup_row"  # a row's number: fixed as long as the input's files are

_SECOND = np.uint64(0x5851F42D4C957F2D)
_DELETED = np.uint64(0xA24BAED4963EE407)  # the factor of the length in Prefix.hashes

LINES = StructType(
    [
        StructField("row", LongType()),
        StructField("line", IntegerType()),
        StructField("doc_id", LongType()),
        StructField("h1", LongType()),
        StructField("h2", IntegerType()),
    ]
)

KEYED = StructType(
    [
        *LINES.fields,
        StructField("n", IntegerType()),
        StructField("words", ArrayType(LongType())),
        StructField("segments", ArrayType(LongType())),
    ]
)

# A key of a line, and the line's own hash.
KEYS = StructType([StructField("key", LongType()), StructField("line", LongType())])

VARIANTS = StructType([*LINES.fields, StructField("at", IntegerType())])

# A run of words of a line (its hash `of`, `n` words), from word `at` on; whether it is a segment.
RUNS = StructType(
    [
        StructField("key", LongType()),
        StructField("of", LongType()),
        StructField("at", IntegerType()),
        StructField("n", IntegerType()),
        StructField("segment", BooleanType()),
    ]
)

WORDS = StructType([StructField("of", LongType()), StructField("words", ArrayType(LongType()))])


class Lines:
    """The lines of a group of texts as ranges of their words."""

    def __init__(self, texts: list[bytes]):
        raw = np.frombuffer(b"\n".join(texts), np.uint8)
        breaks = np.flatnonzero(raw == 0x0A)
        self.words = Words(texts)
        start = np.r_[0, breaks + 1]
        self.owner = np.searchsorted(self.words.at, start, "right") - 1
        self.owner[-1] = min(self.owner[-1], len(texts) - 1)
        self.number = np.arange(len(start)) - np.searchsorted(self.owner, self.owner)
        self.first = np.searchsorted(self.words.start, start)
        self.last = np.searchsorted(self.words.start, np.r_[breaks, len(raw)])
        self.count = self.last - self.first
        self.hash = self.words.hash

    @classmethod
    def stored(cls, words: pa.Array, number: pa.Array) -> Lines:
        """Lines whose words' hashes are in a table, a row per line."""
        lines = cls.__new__(cls)
        offsets = words.offsets.to_numpy()
        lines.first, lines.last = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
        lines.count = lines.last - lines.first
        lines.owner, lines.number = np.arange(len(words)), number.to_numpy()
        lines.hash = words.flatten().to_numpy().view(np.uint64)
        return lines

    @cached_property
    def hash1(self) -> Prefix:
        return Prefix(self.hash)

    @cached_property
    def hash2(self) -> Prefix:
        return Prefix(mix(self.hash ^ _SECOND))


def _lines_of(batch: pa.RecordBatch) -> Iterator[tuple[int, Lines]]:
    """The lines of a batch of texts, by groups with their first text's index, or those stored by their words."""
    if "words" in batch.schema.names:
        yield 0, Lines.stored(batch["words"], batch["line"])
        return
    for first, group in groups(as_bytes(batch["text"])):
        yield first, Lines(group)


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def _short(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _half(lines: Lines, pick: np.ndarray, length: np.ndarray, kind: int) -> np.ndarray:
    """Keys of the first (0) or last (1) half of lines that are compared as `length` words long."""
    half = length // 2
    first, last = lines.first[pick], lines.last[pick]
    part = lines.hash1.hashes(first, first + half) if kind == 0 else lines.hash1.hashes(last - (length - half), last)
    return mix(part ^ mix((length * 2 + kind).astype(np.uint64)))


def _halves(lines: Lines, pick: np.ndarray) -> list[np.ndarray]:
    """Four keys per line: it may be as long as the other line, or a word longer."""
    n = lines.count[pick]
    return [_half(lines, pick, n - less, kind) for less in (0, 1) for kind in (0, 1)]


def _lists(values: np.ndarray, count: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(count)].astype(np.int32)), pa.array(_signed(values)))


def line_table(docs: DataFrame, growing: bool = False) -> DataFrame:
    """LINES of all documents (columns row, doc_id, text): a line's place and hashes, not its text.
    With `growing` KEYED: also the words of lines that allow an edit and are not longer than LONG, and the
    segments of lines from LONG words on."""
    schema = KEYED if growing else LINES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch["row"].to_numpy()
            for first, lines in _lines_of(batch):
                pick = np.flatnonzero(lines.count >= MIN_WORDS)
                owner = lines.owner[pick] + first
                begin, end, n = lines.first[pick], lines.last[pick], lines.count[pick]
                columns = [
                    pa.array(rows[owner]),
                    pa.array(lines.number[pick].astype(np.int32)),
                    batch["doc_id"].take(pa.array(owner)),
                    pa.array(_signed(lines.hash1.hashes(begin, end))),
                    pa.array(_short(lines.hash2.hashes(begin, end))),
                ]
                if growing:
                    short = np.where((n >= EDIT_FROM) & (n <= LONG), n, 0)
                    word = np.repeat(begin - (np.cumsum(short) - short), short) + np.arange(short.sum())
                    line, at, length = _segments(lines)
                    at = lines.first[line] + at
                    columns += [
                        pa.array(n.astype(np.int32)),
                        _lists(lines.hash[word], short),
                        _lists(lines.hash1.hashes(at, at + length), np.where(n >= LONG, n // EDIT_FROM + 1, 0)),
                    ]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select("row", "doc_id", "text").mapInArrow(run, schema)


def half_table(docs: DataFrame) -> DataFrame:
    """KEYS: the halves of all lines that allow an edit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, lines in _lines_of(batch):
                pick = np.flatnonzero(lines.count >= EDIT_FROM)
                itself = lines.hash1.hashes(lines.first[pick], lines.last[pick])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_signed(np.concatenate(_halves(lines, pick)))), pa.array(_signed(np.tile(itself, 4)))],
                    names=KEYS.names,
                )

    return docs.mapInArrow(run, KEYS)


def _deletions(prefix: Prefix, first: np.ndarray, last: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hashes of words[first:last] without word `at`: what Prefix.hashes gives for the shorter line."""
    s = prefix.sums
    raw = ((s[at] - s[first]) + (s[last] - s[at + 1]) * BASE_INVERSE) * prefix.down[first]
    return mix(raw + (last - first - 1).astype(np.uint64) * _DELETED)


def _variants(lines: Lines, like: Bloom) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the lines with a half that `like` knows: line, deleted word (-1: none) and hash of each variant."""
    pick = np.flatnonzero(lines.count >= EDIT_FROM)
    seen = np.zeros(len(pick), bool)
    for half in _halves(lines, pick):
        seen |= like.knows(half)
    pick = pick[seen]
    begin, end = lines.first[pick], lines.last[pick]
    of = np.repeat(np.arange(len(pick)), end - begin)  # one deletion per word
    at = np.arange(len(of)) - (np.cumsum(end - begin) - (end - begin))[of]
    h1 = np.r_[lines.hash1.hashes(begin, end), _deletions(lines.hash1, begin[of], end[of], begin[of] + at)]
    return np.r_[pick, pick[of]], np.r_[np.full(len(pick), -1), at], h1


def variant_keys(docs: DataFrame, like: Bloom) -> DataFrame:
    """KEYS: the variants of lines that share a half with another line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, lines in _lines_of(batch):
                line, _, h1 = _variants(lines, like)
                itself = lines.hash1.hashes(lines.first[line], lines.last[line])
                yield pa.RecordBatch.from_arrays([pa.array(_signed(h1)), pa.array(_signed(itself))], names=KEYS.names)

    return docs.mapInArrow(run, KEYS)


def variant_table(docs: DataFrame, like: Bloom, shared: Bloom) -> DataFrame:
    """VARIANTS that `shared` knows, with their lines' places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch["row"].to_numpy()
            for first, lines in _lines_of(batch):
                line, at, h1 = _variants(lines, like)
                busy = shared.knows(h1)
                line, at, h1 = line[busy], at[busy], h1[busy]
                begin, end = lines.first[line], lines.last[line]
                h2 = lines.hash2.hashes(begin, end)
                cut = at >= 0
                h2[cut] = _deletions(lines.hash2, begin[cut], end[cut], begin[cut] + at[cut])
                owner = lines.owner[line] + first
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rows[owner]),
                        pa.array(lines.number[line].astype(np.int32)),
                        batch["doc_id"].take(pa.array(owner)),
                        pa.array(_signed(h1)),
                        pa.array(_short(h2)),
                        pa.array(at.astype(np.int32)),
                    ],
                    names=VARIANTS.names,
                )

    return docs.mapInArrow(run, VARIANTS)


def shared_keys(keys: DataFrame) -> list[Bloom]:
    """Filters of the keys that two different lines have."""
    ends = keys.groupBy("key").agg(F.min("line").alias("low"), F.max("line").alias("high"))
    return blooms(saved(ends.where("low < high").select("key"), "shared"))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


PLACE = ("doc_id", "row", "line")


def near_lines(docs: DataFrame) -> DataFrame:
    """(row, line) of lines that have an earlier line one edit away."""
    alike = shared_keys(half_table(docs))
    shared = shared_keys(_union([variant_keys(docs, like) for like in alike]))
    variants = _union([variant_table(docs, like, keys) for like in alike for keys in shared])
    variants = saved(variants, "variants").withColumn("place", F.struct(*PLACE))
    key = ["h1", "h2"]
    earliest = saved(variants.groupBy(*key, "at").agg(F.min("place").alias("earliest")), "earliest")
    itself = earliest.where("at = -1").select(*key, "earliest")
    shorter = earliest.where("at >= 0").groupBy(*key).agg(F.min("earliest").alias("earliest"))
    replaced = variants.where("at >= 0").join(earliest, [*key, "at"])
    longer = variants.where("at >= 0").join(itself, key)
    inserted = variants.where("at = -1").join(shorter, key)
    found = [x.where(F.col("earliest") < F.col("place")).select("row", "line") for x in (replaced, longer, inserted)]
    return _union(found)


LONG = 2 * EDIT_FROM  # words from which on a line allows more than one edit


def _run_length(n: np.ndarray) -> np.ndarray:
    """Words of each of the equal segments that lines of n words are cut into: one more than their edits."""
    return n // (n // EDIT_FROM + 1)


def _asked_lengths() -> np.ndarray:
    """[n, length]: may a line of n words be compared with a shorter one whose segments have this length?"""
    most = 12 * EDIT_FROM  # from here on all have segments of EDIT_FROM - 1 words
    asked = np.zeros((most, EDIT_FROM), bool)
    for n in range(LONG, most):
        asked[n : n + n // EDIT_FROM + 1, _run_length(n)] = True
    asked[most - 1] = False
    asked[most - 1, EDIT_FROM - 1] = True
    return asked


ASKED = _asked_lengths()


def _segments(lines: Lines) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Line, first word (within the line) and length of the segments of all long lines."""
    pick = np.flatnonzero(lines.count >= LONG)
    n = lines.count[pick]
    parts = n // EDIT_FROM + 1
    of = np.repeat(np.arange(len(pick)), parts)
    i = np.arange(len(of)) - (np.cumsum(parts) - parts)[of]
    return pick[of], n[of] * i // parts[of], _run_length(n)[of]


def _other_runs(lines: Lines) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Line, first word and length of all runs that may equal a segment of a shorter line, per length;
    without the lines' own segments."""
    long = np.flatnonzero(lines.count >= LONG)
    for length in range(1, EDIT_FROM):
        pick = long[ASKED[np.minimum(lines.count[long], len(ASKED) - 1), length]]
        runs = lines.count[pick] - length + 1
        of = np.repeat(np.arange(len(pick)), runs)
        at = np.arange(len(of)) - (np.cumsum(runs) - runs)[of]
        n = lines.count[pick][of]
        parts = n // EDIT_FROM + 1
        i = (at * parts + n - 1) // n
        own = (_run_length(n) == length) & (i < parts) & (n * i // parts == at)
        yield pick[of[~own]], at[~own], np.full((~own).sum(), length)


def segment_table(lines: DataFrame) -> DataFrame:
    """RUNS: the segments of all long lines of KEYED."""
    each = lines.select(F.col("h1").alias("of"), "n", F.posexplode("segments").alias("i", "key"))
    at = F.expr(f"cast(n * i div (n div {EDIT_FROM} + 1) as int)")
    return each.select("key", "of", at.alias("at"), "n", F.lit(True).alias("segment"))


def run_table(docs: DataFrame, like: Bloom) -> DataFrame:
    """RUNS of all long lines that `like` knows, without their segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, lines in _lines_of(batch):
                for line, at, length in _other_runs(lines):
                    begin = lines.first[line] + at
                    key = lines.hash1.hashes(begin, begin + length)
                    known = like.knows(key)
                    key, line, at = key[known], line[known], at[known]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(_signed(key)),
                            pa.array(_signed(lines.hash1.hashes(lines.first[line], lines.last[line]))),
                            pa.array(at.astype(np.int32)),
                            pa.array(lines.count[line].astype(np.int32)),
                            pa.array(np.zeros(len(key), bool)),
                        ],
                        names=RUNS.names,
                    )

    return docs.select("text").mapInArrow(run, RUNS)


def word_table(docs: DataFrame, asked: Bloom) -> DataFrame:
    """WORDS of the long lines whose hash `asked` knows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, lines in _lines_of(batch):
                pick = np.flatnonzero(lines.count >= LONG)
                itself = _signed(lines.hash1.hashes(lines.first[pick], lines.last[pick]))
                known = asked.knows(itself)
                pick, itself = pick[known], itself[known]
                n = lines.count[pick]
                before = np.cumsum(n) - n
                word = np.repeat(lines.first[pick] - before, n) + np.arange(n.sum())
                words = _lists(lines.hash[word], n)
                yield pa.RecordBatch.from_arrays([pa.array(itself), words], names=WORDS.names)

    return docs.select("text").mapInArrow(run, WORDS)


def _left_over(a: np.ndarray, b: np.ndarray) -> int:
    """Words of one that the other lacks, whatever their order: a and b are this many edits apart at least."""
    words, first = np.unique(np.r_[a, b], return_inverse=True)
    more = np.bincount(first[: len(a)], minlength=len(words)) - np.bincount(first[len(a) :], minlength=len(words))
    return int(max(more[more > 0].sum(), -more[more < 0].sum()))


def within(a: np.ndarray, b: np.ndarray, most: int) -> bool:
    """Are a and b at most `most` edits apart? Furthest places reached per diagonal, edit by edit."""
    if abs(len(a) - len(b)) > most:
        return False
    if len(a) == len(b) and np.count_nonzero(a != b) <= most:
        return True
    if _left_over(a, b) > most:
        return False
    a, b = a.tolist(), b.tolist()
    reach = {}  # by diagonal (place in b minus place in a): words of a that are used up
    for edits in range(most + 1):
        now = {}
        for d in range(-edits, edits + 1):
            i = max(reach.get(d, -2) + 1, reach.get(d - 1, -2), reach.get(d + 1, -2) + 1) if edits else 0
            i = min(i, len(a), len(b) - d)
            if i < 0 or i + d < 0:
                continue
            while i < len(a) and i + d < len(b) and a[i] == b[i + d]:
                i += 1
            now[d] = i
        reach = now
        if reach.get(len(b) - len(a)) == len(a):
            return True
    return False


def _verified(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """The later lines of the pairs (early, late) that are within the bound: column `of`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = []
            for name in ("_a", "_b"):
                column = batch[name]
                flat, offsets = column.values.to_numpy(), column.offsets.to_numpy()
                sides.append([flat[x:y] for x, y in zip(offsets, offsets[1:])])
            good = [within(a, b, min(len(a), len(b)) // EDIT_FROM) for a, b in zip(*sides)]
            yield pa.RecordBatch.from_arrays([batch["late"].filter(pa.array(good, pa.bool_()))], names=["of"])

    both = pairs.join(words.select(F.col("of").alias("early"), F.col("words").alias("_a")), "early")
    both = both.join(words.select(F.col("of").alias("late"), F.col("words").alias("_b")), "late")
    return both.select("late", "_a", "_b").mapInArrow(run, "of long").distinct()


def _edits(n) -> Column:
    return F.floor(n / EDIT_FROM).cast("int")


def _stretch(bits) -> Column:
    """Words of the stretches in which keys are sought in lines of n words, 2 ** (bits - 1) <= n < 2 ** bits:
    four times the edits that any of them allows, at least."""
    return F.floor(F.pow(F.lit(2), bits) * 4 / EDIT_FROM).cast("int") + 1


def _bits(n) -> Column:
    return F.length(F.bin(n))


def far_lines(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """(row, line) of long lines that have an earlier line within their bound. First copies only, as
    the others are exact copies. `lines`: KEYED, with their `place`."""
    segments = segment_table(lines)
    others = saved(_union([run_table(docs, like) for like in blooms(segments.select("key"))]), "runs")
    ends = segments.groupBy("key").agg(F.min("of").alias("low"), F.max("of").alias("high"))
    wanted = ends.where("low < high").select("key").union(others.select("key").distinct())
    runs = only_keys(segments, "key", saved(wanted, "wanted")).union(others)
    # Of a line's runs with one key, those in one stretch of the line are one row.
    runs = runs.withColumn("stretch", F.floor(F.col("at") / _stretch(_bits(F.col("n")))))
    runs = runs.groupBy("key", "of", "n", "stretch").agg(
        F.min("at").alias("low_at"), F.max("at").alias("high_at"), F.max("segment").alias("segment")
    )
    runs = saved(runs, "places")
    ends = runs.groupBy("key").agg(F.min("of").alias("low"), F.max("of").alias("high")).where("low < high")
    runs = saved(runs.join(ends.select("key"), "key"), "shared")
    asked = saved(runs.select(F.col("of").alias("key")).distinct(), "asked")
    words = _union([word_table(docs, some) for some in blooms(asked)])
    words = saved(words.groupBy("of").agg(F.min("words").alias("words")), "words")
    firsts = lines.join(asked, F.col("h1") == F.col("key")).groupBy(F.col("h1").alias("of"))
    firsts = firsts.agg(F.min("place").alias("place")).orderBy("place")
    firsts = saved(firsts.select("of", F.monotonically_increasing_id().alias("rank"), "place.row", "place.line"), "firsts")
    runs = saved(runs.join(firsts.select("of", "rank"), "of"), "ranked")

    bound = _edits(F.least("n", "m"))
    fits = (F.abs(F.col("n") - F.col("m")) <= bound) & (F.col("early_rank") < F.col("rank"))
    first = runs.groupBy("key").agg(
        F.min("rank").alias("early_rank"), F.min_by("of", "rank").alias("early"), F.min_by("n", "rank").alias("m")
    )
    leading = runs.join(first, "key").where(fits).select("early", F.col("of").alias("late")).distinct()
    found = saved(_verified(leading, words), "found")

    # The lines that stay are compared with all earlier lines that have a key in the same stretch, or within
    # the bound of it: a line is in the stretches of all lengths that it may be compared with.
    left = runs.join(found, "of", "left_anti").withColumn("bits", _bits(F.col("n")))
    m, most = F.col("m"), _edits(F.col("m"))
    before = runs.select(
        "key",
        F.col("of").alias("early"),
        F.col("n").alias("m"),
        F.col("rank").alias("early_rank"),
        F.col("low_at").alias("early_low"),
        F.col("high_at").alias("early_high"),
        F.col("segment").alias("early_segment"),
    ).withColumn("bits", F.explode(F.array_distinct(F.array(_bits(m - most), _bits(m + most)))))
    size = _stretch(F.col("bits"))
    reach = F.sequence(F.floor((F.col("early_low") - most) / size), F.floor((F.col("early_high") + most) / size))
    before = before.withColumn("stretch", F.explode(reach))
    # Words before an equal run, and those after it, need as many edits as their numbers differ by.
    longer = F.col("m") - F.col("n")
    shift = F.greatest(
        F.lit(0),
        F.col("early_low") - F.col("high_at") - F.greatest(F.lit(0), longer),
        F.least(F.lit(0), longer) - (F.col("early_high") - F.col("low_at")),
    )
    near = F.abs(longer) + 2 * shift <= bound
    shorter = F.when(F.col("n") < F.col("m"), F.col("segment")).otherwise(F.col("early_segment"))
    pairs = left.join(before, ["key", "bits", "stretch"]).where(fits & near & shorter)
    rest = _verified(saved(pairs.select("early", F.col("of").alias("late")).distinct(), "pairs"), words)
    return firsts.join(found.union(rest), "of", "left_semi").select("row", "line")


def removed_lines(docs: DataFrame, growing: bool = False) -> DataFrame:
    """(row, removed): the numbers of the lines to remove, for rows that have any."""
    lines = saved(line_table(docs, growing), "lines").withColumn("place", F.struct(*PLACE))
    first = lines.groupBy("h1", "h2").agg(F.min("place").alias("earliest"))
    copies = lines.join(first, ["h1", "h2"]).where(F.col("earliest") < F.col("place")).select("row", "line")
    if growing:
        short = lines.where(F.col("n").between(EDIT_FROM, LONG)).select("row", "doc_id", "line", "words")
        every = copies.union(near_lines(short)).union(far_lines(docs, lines))
    else:
        every = copies.union(near_lines(docs))
    return every.groupBy(F.col("row").alias("_row")).agg(F.collect_set("line").alias("_removed"))


@F.pandas_udf(BinaryType())
def _without_lines(texts: pd.Series, removed: pd.Series) -> pd.Series:
    """The texts without the lines of these numbers."""

    def left(text: bytes, gone: set[int]) -> bytes:
        return b"\n".join(line for i, line in enumerate(text.split(b"\n")) if i not in gone)

    return pd.Series([None if t is None else left(t, set(gone.tolist())) for t, gone in zip(texts, removed)], dtype=object)


def dedup_lines(docs: DataFrame, growing: bool = False) -> DataFrame:
    """All rows of `docs`, with their columns, and _n_lines and _n_removed; text without the lines removed.

    `docs` must be a table or a plan that gives the same rows in the same partitions each time: rows
    are told apart by their place in it. `growing`: one edit per EDIT_FROM words, not one edit per line.
    """
    slim = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
    )
    removed = removed_lines(slim, growing).hint("shuffle_hash")  # the texts are moved, but not sorted
    joined = wrapped(docs, ROW).join(removed, F.col(ROW) == F.col("_row"), "left")
    whole = F.col("_doc.text").cast("string")
    breaks = F.octet_length(whole) - F.octet_length(F.replace(whole, F.lit("\n"), F.lit("")))
    lossy = F.col("_removed").isNotNull()
    left = _without_lines(F.when(lossy, whole.cast("binary")), "_removed")  # only these go to Python
    text = F.when(lossy, left.cast("string")).otherwise(whole)
    kept = [c for c in docs.columns if c not in ("_n_lines", "_n_removed")]
    out = joined.select(
        *[text.alias("text") if c == "text" else F.col(f"_doc.`{c}`").alias(c) for c in kept],
        F.coalesce(breaks + 1, F.lit(0)).cast("long").alias("_n_lines"),
        F.coalesce(F.when(F.col("_removed").isNotNull(), F.size("_removed")), F.lit(0)).cast("long").alias("_n_removed"),
    )
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def drop_emptied(deduped: DataFrame) -> DataFrame:
    """Without the documents that lost lines and have no word left, and without the two counts."""
    emptied = (F.col("_n_removed") > 0) & ~F.col("text").rlike(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
    return deduped.where(~emptied | F.col("text").isNull()).drop("_n_lines", "_n_removed")
