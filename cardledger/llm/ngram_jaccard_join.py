"""N-gram Jaccard self-join of documents by chosen paths.

A document is the set of its runs of five lower-cased words. Sets are split recursively: a run of the
algorithm draws a hash function per level, which samples one token of each set (its smallest under
that function), and sets with the same sampled tokens share a bucket. A bucket of at most `CAP` sets
is compared at once; a larger one is split on by the next level's token, at most to `DEPTH` tokens.
Two sets of similarity s share a sampled token with probability s, so a run finds them with s**DEPTH
at least, and `runs_for` repeats runs until the target recall at the threshold.

Inside a bucket sets are compared by sketches of 64 sampled tokens, loosely enough to lose no pair
(`LOOSE`); what remains are chains of likely pairs, kept as one edge per set, never as pairs. Each
connected component of those edges is then compared exactly, on the whole sets: intersections are
counted through the lists of sets that hold a token. A component of many sets is cut into blocks, and
each pair of blocks is one task's work, so no task holds a group of unbounded size. Per set the
number of linked documents and one edge come out, again never pairs.

Documents with equal sets are one class, found by a 128-bit digest of the set, and only one of them
takes part. Components, sets and digests never reach the driver.

Defined cases: a null, empty or wordless text has no runs: it is a class and a group of its own, with
no links. A text of one to four words is one run. Repeated rows are copies. An empty table gives no
rows. Ties: the smallest (document id, row) stands for a class and for a group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from cardledger.llm.bloom import only_keys
from cardledger.llm.components import components
from cardledger.llm.texts import Words, as_bytes, groups, mix, shingles, wrapped
from cardledger.sources.scratch import saved

WIDTH = 5
THRESHOLD = 0.8
TARGET_RECALL = 0.999
CAP = 500  # sets compared at once without splitting on
DEPTH = 3
SKETCH = 64
LOOSE = 36 / 64  # share of equal sketch tokens; a pair at the threshold has fewer in 1 of 100,000 cases
BLOCK_SETS = 1_000  # sets of a block, and tokens of a block, where a component or bucket is cut up
BLOCK_TOKENS = 1_000_000

ROW = "_ngram_join_row"  # a row's number: fixed as long as the input's files are


def runs_for(threshold: float, recall: float, depth: int = DEPTH) -> int:
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold**depth)))


def _draws(n: int) -> np.ndarray:
    return np.random.default_rng(5).integers(1, 1 << 63, size=(n, 2), dtype=np.uint64) | np.uint64(1)


def unique_shingles(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes sorted within each text, and where each text's begin."""
    tokens, owner = shingles(Words(texts), width)
    order = np.lexsort((tokens, owner))
    tokens, owner = tokens[order], owner[order]
    fresh = np.ones(len(tokens), bool)
    fresh[1:] = (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])
    tokens, owner = tokens[fresh], owner[fresh]
    return tokens, np.searchsorted(owner, np.arange(len(texts) + 1))


def sample(tokens: np.ndarray, first: np.ndarray, n_samples: int) -> np.ndarray:
    """One sampled token per set (row) and hash function (column); 0 for empty sets."""
    n = np.diff(first)
    out = np.zeros((len(n), n_samples), np.uint64)
    full = np.flatnonzero(n > 0)
    if len(full):
        for k, (a, b) in enumerate(_draws(n_samples)):
            hashed = (tokens ^ b) * a
            hashed ^= hashed >> np.uint64(29)
            hashed *= np.uint64(0xBF58476D1CE4E5B9)
            out[full, k] = np.minimum.reduceat(hashed, first[:-1][full])
    return out


MARKS = StructType(
    [
        StructField("row", LongType()),
        StructField("doc_id", LongType()),
        StructField("d1", LongType()),
        StructField("d2", LongType()),
        StructField("n", LongType()),
        StructField("tokens", ArrayType(LongType())),
        StructField("sketch", BinaryType()),
    ]
)


def marks(docs: DataFrame, width: int, n_path: int) -> DataFrame:
    """MARKS of all documents: digest and size of the set, sampled tokens, sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, group in groups(as_bytes(batch["text"])):
                tokens, at = unique_shingles(group, width)
                n = np.diff(at)
                sums = [np.r_[np.uint64(0), np.cumsum(mix(tokens ^ np.uint64(c)))] for c in (0x1234567, 0x89ABCDEF1)]
                digests = [(s[at[1:]] - s[at[:-1]]).view(np.int64) for s in sums]
                drawn = sample(tokens, at, max(n_path, SKETCH))
                sketch = (drawn[:, :SKETCH] & np.uint64(0xFF)).astype(np.uint8)
                path = np.ascontiguousarray(drawn[:, :n_path]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["row"].slice(first, len(group)),
                        batch["doc_id"].slice(first, len(group)),
                        pa.array(digests[0]),
                        pa.array(digests[1]),
                        pa.array(n.astype(np.int64)),
                        pa.array(list(path), pa.list_(pa.int64())),
                        pa.array([s.tobytes() for s in sketch], pa.binary()),
                    ],
                    names=MARKS.names,
                )

    return docs.select("row", "doc_id", "text").mapInArrow(run, MARKS)


def buckets(classes: DataFrame, runs: int, depth: int = DEPTH, cap: int = CAP) -> DataFrame:
    """(bucket, size, node): the buckets of two or more sets in which each run ends."""
    each = F.transform(
        F.sequence(F.lit(0), F.lit(runs - 1)),
        lambda r: F.struct(r.alias("run"), F.slice("tokens", r * depth + 1, depth).alias("path")),
    )
    state = classes.select("node", F.explode(each).alias("_x")).select(
        "node", "_x.path", F.xxhash64("_x.run", F.get("_x.path", F.lit(0))).alias("bucket")
    )
    ended = None
    for level in range(1, depth + 1):
        state = saved(state, "paths")
        size = state.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        sized = state.join(size, "bucket")
        done = sized if level == depth else sized.where(F.col("size") <= cap)
        done = done.select("bucket", "size", "node")
        ended = done if ended is None else ended.union(done)
        if level < depth:
            deeper = F.xxhash64("bucket", F.get("path", F.lit(level))).alias("bucket")
            state = sized.where(F.col("size") > cap).select("node", "path", deeper)
    return ended


def in_blocks(members: DataFrame, key: str, n_blocks: str) -> DataFrame:
    """Members dealt to the pairs of blocks of their group: adds side_i, side_j and `block`.

    With one block that is one pair. With b blocks, a member goes to the b pairs its block is in.
    """
    block = F.pmod(F.xxhash64("node"), F.col(n_blocks)).cast("int")
    dealt = members.withColumn("block", block).withColumn(
        "_other", F.explode(F.sequence(F.lit(0), (F.col(n_blocks) - 1).cast("int")))
    )
    return dealt.select(
        *[c for c in members.columns if c != n_blocks],
        "block",
        F.least("block", "_other").alias("side_i"),
        F.greatest("block", "_other").alias("side_j"),
    ).repartition(key, "side_i", "side_j")


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Whole groups of neighbouring rows with equal keys, across batches."""
    held: list[pa.Table] = []
    held_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        values = np.stack([table[k].to_numpy().astype(np.int64) for k in keys], axis=1)
        cuts = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
        for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(values)]):
            key = tuple(values[a])
            if held and key != held_key:
                yield pa.concat_tables(held)
                held = []
            held.append(table.slice(a, b - a))
            held_key = key
    if held:
        yield pa.concat_tables(held)


def _stars(n: int, near: Iterator[tuple[int, np.ndarray]]) -> np.ndarray:
    """For each of n members the smallest member it is connected with; `near` yields (i, neighbours)."""
    label = np.arange(n)

    def root(i: int) -> int:
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    for i, others in near:
        for j in others:
            a, b = root(i), root(int(j))
            if a != b:
                label[max(a, b)] = min(a, b)
    return np.array([root(i) for i in range(n)], np.int64)


EDGES = StructType([StructField("a", LongType()), StructField("b", LongType())])


def likely(bucketed: DataFrame, threshold: float) -> DataFrame:
    """EDGES that connect the sets of a bucket whose sketches are alike: one per set at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a: list[np.ndarray] = []
        b: list[np.ndarray] = []
        for table in _grouped(batches, ["bucket", "side_i", "side_j"]):
            node, n, block = (table[c].to_numpy() for c in ("node", "n", "block"))
            order = np.argsort(node)
            node, n, block = node[order], n[order], block[order]
            sketch = np.stack([np.frombuffer(s, np.uint8) for s in table["sketch"].to_pylist()])[order]
            across = table["side_i"][0].as_py() != table["side_j"][0].as_py()

            def near() -> Iterator[tuple[int, np.ndarray]]:
                for i in range(len(node) - 1):
                    rest = slice(i + 1, None)
                    ok = np.minimum(n[rest], n[i]) >= threshold * np.maximum(n[rest], n[i]) - 1e-9
                    ok &= (sketch[rest] == sketch[i]).mean(axis=1) >= LOOSE
                    if across:
                        ok &= block[rest] != block[i]
                    yield i, np.flatnonzero(ok) + i + 1

            star = _stars(len(node), near())
            moved = star != np.arange(len(node))
            a.append(node[moved])
            b.append(node[star[moved]])
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=EDGES.names)

    slim = bucketed.select("bucket", "side_i", "side_j", "block", "node", "n", "sketch")
    return slim.sortWithinPartitions("bucket", "side_i", "side_j").mapInArrow(run, EDGES)


LINKS = StructType(
    [StructField("node", LongType()), StructField("links", LongType()), StructField("star", LongType())]
)


def exact(dealt: DataFrame, threshold: float, width: int) -> DataFrame:
    """LINKS: per set and pair of blocks, the documents of linked sets, and an edge to one of them."""
    parts, whole = (round(threshold * 1000), 1000)

    def compare(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        node, copies, block = (table[c].to_numpy() for c in ("node", "copies", "block"))
        order = np.argsort(node)
        node, copies, block = node[order], copies[order], block[order]
        texts = as_bytes(table["text"].combine_chunks())
        sets = []
        for _, group in groups([texts[i] for i in order]):
            tokens, at = unique_shingles(group, width)
            sets.extend(tokens[at[k] : at[k + 1]] for k in range(len(group)))
        n = np.array([len(s) for s in sets])
        across = table["side_i"][0].as_py() != table["side_j"][0].as_py()
        # Sets by token: `holder[begin[t]:begin[t + 1]]` are the sets that hold token t.
        every, number = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(len(sets)), n)
        by_token = np.argsort(number, kind="stable")
        holder = owner[by_token]
        begin = np.searchsorted(number[by_token], np.arange(len(every) + 1))
        place = np.cumsum(n) - n
        links = np.zeros(len(sets), np.int64)

        def near() -> Iterator[tuple[int, np.ndarray]]:
            for i in range(len(sets)):
                mine = number[place[i] : place[i] + n[i]]
                spans = begin[mine + 1] - begin[mine]
                at = np.repeat(begin[mine] - (np.cumsum(spans) - spans), spans) + np.arange(spans.sum())
                shared = np.bincount(holder[at], minlength=len(sets))
                linked = whole * shared >= parts * (n + n[i] - shared)
                linked[i] = False
                if across:
                    linked &= block != block[i]
                links[i] = copies[linked].sum()
                yield i, np.flatnonzero(linked)

        star = _stars(len(sets), near())
        return node, links, node[star]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _grouped(batches, ["label", "side_i", "side_j"]):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in compare(table)], names=LINKS.names)

    slim = dealt.select("label", "side_i", "side_j", "block", "node", "copies", "text")
    return slim.sortWithinPartitions("label", "side_i", "side_j").mapInArrow(run, LINKS)


def near_documents(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    width: int = WIDTH,
    recall: float = TARGET_RECALL,
    cap: int = CAP,
) -> DataFrame:
    """(row, doc_id, class_id, group_id, n_links, first_of_group) per row of `docs` (row, doc_id, text)."""
    runs = runs_for(threshold, recall)
    marked = saved(marks(docs, width, runs * DEPTH), "marks")
    some = marked.where("n > 0")
    classes = some.groupBy("d1", "d2").agg(
        F.min(F.struct("doc_id", "row")).alias("rep"),
        F.count(F.lit(1)).alias("copies"),
        F.max("n").alias("n"),
        F.any_value("tokens").alias("tokens"),
        F.any_value("sketch").alias("sketch"),
    )
    classes = saved(classes.withColumn("node", F.col("rep.row")), "classes")

    ended = buckets(classes, runs, cap=cap).withColumn("blocks", F.ceil(F.col("size") / BLOCK_SETS))
    described = ended.drop("size").join(classes.select("node", "n", "sketch"), "node")
    alike = components(likely(in_blocks(described, "bucket", "blocks"), threshold))

    weight = classes.select(F.col("node").alias("_node"), "copies", "n")
    members = saved(alike.join(weight, F.col("node") == F.col("_node")).drop("_node"), "members")
    blocks = members.groupBy(F.col("label").alias("_label")).agg(
        F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_SETS, F.sum("n") / BLOCK_TOKENS)).alias("blocks")
    )
    members = members.join(blocks, F.col("label") == F.col("_label")).drop("_label", "n")
    texts = only_keys(docs.select(F.col("row").alias("_row"), "text"), "_row", members.select(F.col("node").alias("key")))
    texts = texts.join(members, F.col("_row") == F.col("node")).drop("_row")
    found = saved(exact(in_blocks(texts, "label", "blocks"), threshold, width), "links")

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    grouped = components(found.select(F.col("node").alias("a"), F.col("star").alias("b")))
    rep = classes.select(F.col("node").alias("_node"), "rep")
    grouped = saved(grouped.join(rep, F.col("node") == F.col("_node")).drop("_node"), "grouped")
    heads = grouped.groupBy(F.col("label").alias("_label")).agg(F.min("rep").alias("head"))
    grouped = grouped.join(heads, F.col("label") == F.col("_label")).select(F.col("node").alias("_g"), "head")
    about = (
        classes.select("d1", "d2", "node", "rep", "copies")
        .join(links.withColumnRenamed("node", "_l"), F.col("node") == F.col("_l"), "left")
        .join(grouped, F.col("node") == F.col("_g"), "left")
        .select(
            F.col("d1").alias("_d1"),
            F.col("d2").alias("_d2"),
            "rep",
            F.coalesce("head", "rep").alias("head"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    rows = marked.select("row", "doc_id", "n", "d1", "d2")
    with_class = rows.where("n > 0").join(about, (F.col("d1") == F.col("_d1")) & (F.col("d2") == F.col("_d2")))
    alone = F.struct("doc_id", "row")
    without = rows.where("n = 0").select("*", alone.alias("rep"), alone.alias("head"), F.lit(0).cast("long").alias("n_links"))
    columns = ["row", "doc_id", "rep", "head", "n_links"]
    return (
        with_class.select(columns)
        .union(without.select(columns))
        .select(
            "row",
            "doc_id",
            F.col("rep.doc_id").alias("class_id"),
            F.col("head.doc_id").alias("group_id"),
            "n_links",
            (F.col("head.row") == F.col("row")).alias("first_of_group"),
        )
    )


def numbered(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text) of `docs`."""
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
    )


def join(docs: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH) -> DataFrame:
    """One row per document: doc_id, class_id (equal sets), group_id (connected by links), n_links."""
    return near_documents(numbered(docs), threshold, width).select("doc_id", "class_id", "group_id", "n_links")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH) -> DataFrame:
    """The rows of `docs`, with all their columns, that come first in their group.

    `docs` must be a table or a plan that gives the same rows in the same partitions each time.
    """
    later = near_documents(numbered(docs), threshold, width).where(~F.col("first_of_group"))
    later = later.select(F.col("row").alias("_later"))
    return wrapped(docs, ROW).join(later, F.col(ROW) == F.col("_later"), "left_anti").select("_doc.*")
