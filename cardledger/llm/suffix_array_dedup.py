"""Removal of long strings that occur more than once, by a hash-compared suffix sort.

A string of `LENGTH` bytes that starts at two places is repeated, and every byte it covers is
removed, at both places. Not every suffix is sorted, but a sample that meets every such string: of
the 128-byte grams that a string holds, the one with the smallest hash is its anchor, and two equal
strings have their anchors at the same place. So only suffixes at anchors are compared, each with
those that begin with the same gram, and extended to both sides.

Suffixes are compared by the length of their common extension, found by binary search over prefix
polynomial hashes; so a comparison takes a logarithmic number of look-ups. A merge sort over such
comparisons orders the suffixes of a gram, once to the right and once, mirrored, to the left; all
grams of a batch are merged in step. Walking down the left order's common extensions, sets of
suffixes are joined small into large, and each suffix meets its neighbours in the right order: these
pairs hold every maximal common string, and there are O(m log m) of them. The bytes of each pair that
counts are compared to rule out collisions.

Groups of any size: suffixes with equal surroundings (128-bit digest) count once. A gram with more
than `MOST` different surroundings is split by where in the string the gram lies: strings that start
at most so far before the gram share more bytes after it, the others share more before it, and each
half is a finer key. Equal surroundings within the half again count once, so splitting ends, and
nothing is dropped.

Defined cases: a null or empty text has no bytes. Texts shorter than `LENGTH` keep all their bytes.
A text that repeats itself, and overlapping repeats, count. Repeated rows are copies of each other,
so all that is long enough in them goes, in every copy. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from cardledger.llm.ngram_jaccard_join import _grouped, numbered
from cardledger.llm.texts import Prefix, as_bytes, groups, mix
from cardledger.sources.scratch import saved

LENGTH = 400
GRAM = 128
MOST = 2_000  # suffixes with different surroundings that one task sorts for a gram
SEGMENT = 1 << 20  # window starts worked on at a time in a long text
BATCH_BYTES = 3 << 20  # surroundings sorted together
TEXT_BYTES = 1 << 20  # texts whose anchors are sought together, if they are short

_second = np.random.default_rng(10).integers(1, 1 << 63, 256, dtype=np.uint64)

ANCHORS = StructType(
    [
        StructField("gram", LongType()),
        StructField("d1", LongType()),
        StructField("d2", LongType()),
        StructField("row", LongType()),
        StructField("pos", LongType()),
        StructField("left", IntegerType()),
        StructField("right", IntegerType()),
    ]
)


def _smallest(packed: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` neighbours, by doubling."""
    step, out = 1, packed
    while step * 2 <= width:
        out = np.minimum(out[:-step], out[step:])
        step *= 2
    rest = width - step
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def anchors_of(texts: list[bytes], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """For a group of texts: owner, position, gram hash, two digests, bytes before and from the anchor."""
    joined = b"\0".join(texts)
    data = np.frombuffer(joined, np.uint8)
    at = np.cumsum([0] + [len(t) + 1 for t in texts])
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none.view(np.uint64), none.view(np.uint64), none.view(np.uint64), none, none
    found: dict[str, list[np.ndarray]] = {k: [] for k in ("pos", "gram", "d1", "d2", "left", "right")}
    for begin in range(0, len(data) - length + 1, SEGMENT):
        end = min(begin + SEGMENT, len(data) - length + 1)  # window starts begin..end-1
        base = max(0, begin - length)  # hashes of this stretch alone, so long texts take no more memory
        stretch = data[base : end + 2 * length]
        first, second = Prefix(stretch), Prefix(_second[stretch])
        start = np.arange(begin, end + length - gram) - base
        hashes = first.hashes(start, start + gram)
        packed = (hashes & ~np.uint64(0xFFFFFF)) | np.arange(len(start), dtype=np.uint64)
        best = (_smallest(packed, length - gram + 1) & np.uint64(0xFFFFFF)).astype(np.int64)
        starts = np.arange(begin, end)
        inside = starts + length <= at[np.searchsorted(at, starts, "right")] - 1
        pos = np.unique(best[inside]) + begin
        owner = np.searchsorted(at, pos, "right") - 1
        left = np.minimum(pos - at[owner], length - gram)
        right = np.minimum(at[owner + 1] - 1 - pos, length)
        here = pos - base
        found["pos"].append(pos)
        found["gram"].append(first.hashes(here, here + gram))
        found["left"].append(left)
        found["right"].append(right)
        for name, prefix in (("d1", first), ("d2", second)):
            found[name].append(mix(prefix.hashes(here - left, here + right) ^ left.astype(np.uint64)))
    every = {k: np.concatenate(v) for k, v in found.items()}
    pos, once = np.unique(every["pos"], return_index=True)
    owner = np.searchsorted(at, pos, "right") - 1
    return owner, pos - at[owner], *(every[k][once] for k in ("gram", "d1", "d2", "left", "right"))


def anchor_table(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """ANCHORS of all documents (row, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch["row"].to_numpy()
            for first, group in groups(as_bytes(batch["text"]), TEXT_BYTES):
                owner, pos, *hashes, left, right = anchors_of(group, length, gram)
                columns = [pa.array(h.view(np.int64)) for h in hashes]
                columns += [pa.array(rows[owner + first]), pa.array(pos)]
                columns += [pa.array(x.astype(np.int32)) for x in (left, right)]
                yield pa.RecordBatch.from_arrays(columns, names=ANCHORS.names)

    return docs.select("row", "text").mapInArrow(run, ANCHORS)


SURROUNDINGS = StructType(
    [
        StructField("key", LongType()),
        StructField("row", LongType()),
        StructField("pos", LongType()),
        StructField("left", IntegerType()),
        StructField("bytes", BinaryType()),
    ]
)


def surroundings(docs: DataFrame) -> DataFrame:
    """SURROUNDINGS of the anchors listed per document in `anchors` (gram, pos, left, right)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for row, text, listed in zip(
                batch["row"].to_pylist(), as_bytes(batch["text"]), batch["anchors"].to_pylist()
            ):
                for a in listed:
                    cut = text[a["pos"] - a["left"] : a["pos"] + a["right"]]
                    for column, value in zip(out, (a["gram"], row, a["pos"], a["left"], cut)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(out, _arrow(SURROUNDINGS))], names=SURROUNDINGS.names
            )

    return docs.select("row", "text", "anchors").mapInArrow(run, SURROUNDINGS)


def _arrow(schema: StructType) -> pa.Schema:
    kinds = {LongType(): pa.int64(), IntegerType(): pa.int32(), BinaryType(): pa.binary()}
    return pa.schema([(f.name, kinds[f.dataType]) for f in schema.fields])


class Suffixes:
    """Suffixes (to the right) or mirrored prefixes (to the left) of surroundings, at their anchors."""

    def __init__(self, data: np.ndarray, start: np.ndarray, length: np.ndarray):
        self.data, self.start, self.length = data, start, length
        self.prefix = Prefix(data)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lengths of the common extensions of suffixes a and b (arrays of numbers), by binary search."""
        low = np.zeros(len(a), np.int64)  # equal so far
        high = np.minimum(self.length[a], self.length[b])
        while (open_ := low < high).any():
            middle = np.where(open_, (low + high + 1) // 2, low)
            same = self.prefix.hashes(self.start[a], self.start[a] + middle) == self.prefix.hashes(
                self.start[b], self.start[b] + middle
            )
            low = np.where(same, middle, low)
            high = np.where(same, high, middle - 1)
            high = np.maximum(high, low)
        return low

    def before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Is suffix a smaller than b? The bytes after the common extension decide; then the length."""
        n = self.common(a, b)
        ended = (n >= self.length[a]) | (n >= self.length[b])
        last = len(self.data) - 1
        differ = self.data[np.minimum(self.start[a] + n, last)] < self.data[np.minimum(self.start[b] + n, last)]
        return np.where(ended, self.length[a] < self.length[b], differ)

    def sort(self, group: np.ndarray) -> np.ndarray:
        """Merge sort within groups (equal neighbours in `group`): the suffixes' numbers in order.

        Runs of all groups are doubled in step; an element's place in the merged run is its own index
        plus its rank in the other run, found by binary search.
        """
        n = len(group)
        order = np.arange(n)
        begin = np.searchsorted(group, group, "left")
        size = np.searchsorted(group, group, "right") - begin
        width = 1
        while n and width < size.max():
            index = np.arange(n) - begin  # place within the group
            base = index // (2 * width) * (2 * width)
            in_left = index - base < width
            other = np.minimum(np.where(in_left, base + width, base), size)
            other_end = np.minimum(np.where(in_left, base + 2 * width, base + width), size)
            low, high = other.copy(), other_end.copy()
            while (open_ := np.flatnonzero(low < high)).size:
                middle = (low[open_] + high[open_]) // 2
                theirs = order[begin[open_] + middle]
                mine = order[open_]
                # Left elements come before equal right ones.
                goes_after = np.where(in_left[open_], self.before(theirs, mine), ~self.before(mine, theirs))
                low[open_] = np.where(goes_after, middle + 1, low[open_])
                high[open_] = np.where(goes_after, high[open_], middle)
            own = np.where(in_left, index - base, index - base - width)
            place = begin + base + own + (low - other)
            merged = np.empty_like(order)
            merged[place] = order
            order = merged
            width *= 2
        return order


def meetings(order: list[int], shared: list[int], rank: list[int]) -> Iterator[tuple[int, int, int]]:
    """Pairs (a, b, common extension to the left) that hold every maximal common string.

    order: suffixes in left order; shared[i]: common extension of order[i] and order[i + 1]; rank: a
    suffix's place in right order. Sets are joined by falling common extension, small into large, and
    a newcomer meets its two neighbours in right order: any other member of the set has less in common
    with it to the right than one of these.
    """
    sets = [[(rank[s], s)] for s in order]
    root = list(range(len(order)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in sorted(range(len(order) - 1), key=lambda i: -shared[i]):
        a, b = find(i), find(i + 1)
        if len(sets[a]) < len(sets[b]):
            a, b = b, a
        large = sets[a]
        for item in sets[b]:
            k = bisect_left(large, item)
            if k:
                yield item[1], large[k - 1][1], shared[i]
            if k < len(large):
                yield item[1], large[k][1], shared[i]
        for item in sets[b]:
            large.insert(bisect_left(large, item), item)
        sets[b] = []
        root[b] = a


def repeats(cuts: list[bytes], left: np.ndarray, group: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(suffix, from, to): bytes around the anchors of suffixes that a string of `length` bytes covers
    which also lies around another suffix of the same group. `group` is sorted."""
    size = np.array([len(c) for c in cuts])
    at = np.cumsum(size) - size
    data = np.frombuffer(b"".join(cuts), np.uint8)
    right = Suffixes(data, at + left, size - left)
    # Mirrored: the bytes before the anchor, backwards.
    leftward = Suffixes(data[::-1].copy(), len(data) - (at + left), left)
    right_order, left_order = right.sort(group), leftward.sort(group)
    rank = np.empty(len(cuts), np.int64)
    rank[right_order] = np.arange(len(cuts))
    shared = leftward.common(left_order[:-1], left_order[1:])
    cut = np.flatnonzero(np.diff(group)) + 1
    met: list[tuple[int, int, int]] = []
    for a, b in zip(np.r_[0, cut], np.r_[cut, len(cuts)]):
        if b - a == 2:
            met.append((int(left_order[a]), int(left_order[a + 1]), int(shared[a])))
        elif b - a > 2:
            local = left_order[a:b]
            met.extend(
                (int(x) + a, int(y) + a, s)
                for x, y, s in meetings((local - a).tolist(), shared[a : b - 1].tolist(), rank[a:b].tolist())
            )
    if not met:
        none = np.zeros(0, np.int64)
        return none, none, none
    x, y, to_left = np.array(met, np.int64).T
    to_right = right.common(x, y)
    keep = np.flatnonzero(to_left + to_right >= length)
    x, y, to_left, to_right = x[keep], y[keep], to_left[keep], to_right[keep]
    for k in range(len(x)):  # collisions: compare the bytes, and count them one by one if they differ
        a, b, p, q = cuts[x[k]], cuts[y[k]], int(left[x[k]]), int(left[y[k]])
        if a[p - to_left[k] : p + to_right[k]] != b[q - to_left[k] : q + to_right[k]]:
            to_left[k] = _equal(a[:p][::-1], b[:q][::-1])
            to_right[k] = _equal(a[p:], b[q:])
    sure = to_left + to_right >= length
    both = np.r_[x[sure], y[sure]]
    return both, np.tile(-to_left[sure], 2), np.tile(to_right[sure], 2)


def _equal(a: bytes, b: bytes) -> int:
    return next((i for i, (u, v) in enumerate(zip(a, b)) if u != v), min(len(a), len(b)))


SPANS = StructType(
    [StructField("row", LongType()), StructField("from", LongType()), StructField("to", LongType())]
)


def compare(members: DataFrame, length: int) -> DataFrame:
    """SPANS of repeated strings among the surroundings of each `key`; at most MOST per key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(tables: list[pa.Table]) -> pa.RecordBatch:
            table = pa.concat_tables(tables)
            cuts = as_bytes(table["bytes"].combine_chunks())
            key = table["key"].to_numpy()
            group = np.cumsum(np.r_[0, key[1:] != key[:-1]])
            which, start, end = repeats(cuts, table["left"].to_numpy().astype(np.int64), group, length)
            row, pos = table["row"].to_numpy()[which], table["pos"].to_numpy()[which]
            return pa.RecordBatch.from_arrays([pa.array(row), pa.array(pos + start), pa.array(pos + end)], names=SPANS.names)

        held, size = [], 0
        for table in _grouped(batches, ["key"]):
            if table.num_rows > 1:
                held.append(table)
                size += table.num_rows * (2 * length)
            if size >= BATCH_BYTES:
                yield solve(held)
                held, size = [], 0
        if held:
            yield solve(held)

    slim = members.select("key", "row", "pos", "left", "bytes").repartition("key")
    return slim.sortWithinPartitions("key").mapInArrow(run, SPANS)


def split(crowded: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """(spans, members) of keys with too many suffixes, under the finer keys of two halves each.

    A member's string starts between `near` and `far` bytes before the anchor. All members of a key
    share what every such string covers. Where even all that any such string can cover is equal, it
    is repeated, and one member stands for the others from then on.
    """
    middle = F.floor((F.col("near") + F.col("far")) / 2).cast("int")
    halves = F.array(
        F.struct(F.col("near").alias("near"), middle.alias("far")),
        F.struct((middle + 1).alias("near"), F.col("far").alias("far")),
    )
    rows = crowded.withColumn("_half", F.explode(halves)).withColumns({"near": F.col("_half.near"), "far": F.col("_half.far")})
    size = F.octet_length("bytes")
    rows = rows.where((F.col("near") <= F.col("far")) & (F.col("left") >= F.col("near")))
    rows = rows.where(size - F.col("left") >= length - F.col("far"))
    core = F.expr(f"substring(bytes, left - near + 1, near + {length} - far)")
    reach = F.expr(f"least(left, far)")
    span = F.expr(f"least(octet_length(bytes) - left, {length} - near)")
    rows = rows.withColumn("key", F.xxhash64("key", "near", "far", core))
    rows = rows.withColumns({"_reach": reach, "_span": span})
    whole = F.sha2(F.expr("substring(bytes, left - _reach + 1, _reach + _span)"), 256)
    rows = saved(rows.withColumn("_same", F.concat_ws(":", whole, "_reach")).drop("_half"), "crowded")
    same = rows.groupBy(F.col("key").alias("_key"), F.col("_same").alias("_of")).agg(
        F.count(F.lit(1)).alias("_times"), F.min(F.struct("row", "pos")).alias("_one")
    )
    joined = rows.join(same, (F.col("key") == F.col("_key")) & (F.col("_same") == F.col("_of")))
    enough = (F.col("_times") > 1) & (F.col("_reach") + F.col("_span") >= length)
    spans = joined.where(enough).select(
        "row", (F.col("pos") - F.col("_reach")).alias("from"), (F.col("pos") + F.col("_span")).alias("to")
    )
    one = (F.col("_one.row") == F.col("row")) & (F.col("_one.pos") == F.col("pos"))
    return spans, joined.where(one).select("key", "row", "pos", "left", "bytes", "near", "far")


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, most: int = MOST) -> DataFrame:
    """SPANS (they may overlap) that repeated strings cover in the documents (row, text)."""
    anchors = saved(anchor_table(docs, length, gram), "anchors")
    often = anchors.groupBy(F.col("gram").alias("_gram")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    again = anchors.join(often, F.col("gram") == F.col("_gram")).drop("_gram", "_n")
    again = saved(again, "repeated")
    classes = again.groupBy("gram", "d1", "d2").agg(
        F.count(F.lit(1)).alias("times"), F.min(F.struct("row", "pos", "left", "right")).alias("one")
    )
    classes = saved(classes, "classes")

    # Equal surroundings: all of them is repeated.
    equal = classes.where("times > 1").select(F.col("gram").alias("_g"), F.col("d1").alias("_d1"), F.col("d2").alias("_d2"))
    copies = again.join(
        equal, (F.col("gram") == F.col("_g")) & (F.col("d1") == F.col("_d1")) & (F.col("d2") == F.col("_d2"))
    ).select("row", (F.col("pos") - F.col("left")).alias("from"), (F.col("pos") + F.col("right")).alias("to"))

    # Different surroundings of one gram: sort them.
    several = classes.groupBy(F.col("gram").alias("_g")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("times").alias("_least")
    )
    several = several.where("_n > 1 and _least = 1").select("_g")
    listed = (
        classes.join(several, F.col("gram") == F.col("_g"))
        .groupBy(F.col("one.row").alias("_row"))
        .agg(F.collect_list(F.struct("gram", "one.pos", "one.left", "one.right")).alias("anchors"))  # of one document
    )
    members = surroundings(docs.join(listed, F.col("row") == F.col("_row")))
    members = saved(members.withColumns({"near": F.lit(0), "far": F.lit(length - gram)}), "members")
    found = [copies]
    while True:
        size = members.groupBy(F.col("key").alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
        crowds = saved(size.where(F.col("_n") > most).select("_key"), "crowds")
        if not crowds.limit(1).count():
            found.append(compare(members, length))
            break
        found.append(compare(members.join(crowds, F.col("key") == F.col("_key"), "left_anti"), length))
        crowded = members.join(crowds, F.col("key") == F.col("_key")).drop("_key")
        spans, members = split(crowded.where("near < far"), length)
        found.append(saved(spans, "spans"))
        members = saved(members, "members")
    out = found[0]
    for part in found[1:]:
        out = out.union(part)
    return out


KEPT = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("n_bytes", LongType()),
        StructField("n_removed", LongType()),
        StructField("n_spans", LongType()),
        StructField("kept", BinaryType()),
    ]
)


def merged(spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs that spans (rows of from, to) cover."""
    spans = spans[np.argsort(spans[:, 0])]
    reach = np.maximum.accumulate(spans[:, 1])
    fresh = np.r_[True, spans[1:, 0] > reach[:-1]]
    return spans[fresh, 0], reach[np.r_[np.flatnonzero(fresh)[1:] - 1, len(spans) - 1]]


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, most: int = MOST, digest: bool = False) -> DataFrame:
    """KEPT for every row of `docs` (doc_id, text); with `digest` the kept bytes' SHA-256 instead.

    `docs` must be a table or a plan that gives the same rows in the same partitions each time.
    """
    rows = numbered(docs)
    spans = repeated_spans(rows.select("row", "text"), length, gram, most).distinct()
    listed = spans.groupBy(F.col("row").alias("_row")).agg(F.collect_list(F.array("from", "to")).alias("spans"))
    joined = rows.join(listed, F.col("row") == F.col("_row"), "left").select("doc_id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for text, listed in zip(as_bytes(batch["text"]), batch["spans"].to_pylist()):
                kept, n_spans = text, 0
                if listed:
                    start, end = merged(np.array(listed, np.int64))
                    kept = b"".join(text[a:b] for a, b in zip([0, *end], [*start, len(text)]))
                    n_spans = len(start)
                value = hashlib.sha256(kept).hexdigest().encode() if digest else kept
                for column, x in zip(out, (len(text), len(text) - len(kept), n_spans, value)):
                    column.append(x)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *[pa.array(c, pa.int64()) for c in out[:3]], pa.array(out[3], pa.binary())],
                names=KEPT.names,
            )

    result = joined.mapInArrow(run, KEPT)
    if not digest:
        return result
    return result.withColumn("kept_sha256", F.col("kept").cast("string")).drop("kept")
