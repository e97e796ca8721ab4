"""Hard negatives for anchors: high-scoring rows of another label, but clearly below a positive.

Positives of an anchor are its best POSITIVES rows of the same label. For each positive with score s the
negatives are the best NEGATIVES rows of another label with LOW * s <= 100 * score <= HIGH * s. These
windows of scores overlap. They are not searched one by one: their upper limits split the scores into
disjoint slots, from one limit down to the next. A row falls into one slot, and each slot keeps its best
NEGATIVES rows, first within a task, then over all. What lies under a limit is the slots from its own
downwards, so going through the slots from the lowest to the highest and merging each one's best into
what is below gives the answers of all windows; the lower limits then cut off the ends.

Anchors meet all rows, in cells of a grid: anchors are dealt by hash of the id into groups of about
ANCHORS, rows into blocks of about ROWS, and the cell of a group and a block is one matrix product in one
task. What is sent grows with rows x groups and anchors x blocks, and no cell grows with the data. A
label that a third of all rows have changes nothing, as cells do not go by label; in a cell only rows of
the anchor's label are multiplied for positives, and only the others for negatives. A task gives at most
POSITIVES rows per anchor and cell, then NEGATIVES per slot and cell.

Scores are exact: components are whole numbers, products are taken as doubles while no sum can reach
2**53 and as Python's whole numbers beyond (a score outside of a long is an error there).

Defined cases: rows with a null id, label or vector, or with a null or non-finite component, take no part.
Ids tell rows apart: of rows that share an id, equal ones count once and of different ones the smallest by
(label, vector) stays. Of vectors of different lengths the shorter is filled up with zeros. An anchor
without positives, or whose positives have no negative, gives no rows. An empty table gives no rows.
Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from cardledger.sources.scratch import saved

POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95  # percent of the positive's score
ANCHORS, ROWS = 8192, 8192
CELLS_AT_ONCE = 1 << 22  # scores worked on at a time in a cell

_EXACT = 1 << 53


def usable(rows: DataFrame) -> DataFrame:
    """vec_id, label, vector of the rows that take part, one per id."""
    fine = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    slim = rows.select("vec_id", "label", "vector").where(fine).where(finite)
    return slim.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("_r")).select("vec_id", "_r.*")


def _matrix(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows of doubles, filled up with zeros."""
    flat = pa.concat_arrays([c.flatten() for c in vectors.chunks]).to_numpy(zero_copy_only=False)
    size = np.concatenate([c.value_lengths().to_numpy(zero_copy_only=False) for c in vectors.chunks]).astype(np.int64)
    out = np.zeros((len(size), width))
    out[np.arange(width) < size[:, None]] = flat
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of a with all of b, exactly."""
    largest = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(1, a.shape[1])
    if largest * max(100, 2 * len(b)) < _EXACT:
        return (a @ b.T).astype(np.int64)
    whole = [np.array([[int(x) for x in row] for row in m.tolist()], object).reshape(m.shape) for m in (a, b)]
    return whole[0].dot(whole[1].T)


def _best(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k largest allowed scores per row; of equal ones those furthest to the left."""
    n = scores.shape[1]
    if not scores.size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if scores.dtype == object:  # their ranks do as well
        scores = np.unique(scores, return_inverse=True)[1].reshape(scores.shape)
    key = np.where(allowed, scores * n + np.arange(n - 1, -1, -1), np.iinfo(np.int64).min)
    column = np.argpartition(key, n - k, 1)[:, n - k :] if n > k else np.tile(np.arange(n), (len(key), 1))
    row = np.repeat(np.arange(len(key)), column.shape[1])
    column = column.ravel()
    kept = allowed[row, column]
    return row[kept], column[kept]


def _cells(anchors: DataFrame, rows: DataFrame, shape: tuple[int, int], choose: Callable, schema: str) -> DataFrame:
    """choose(anchors, rows) in each cell of the grid, as tables sorted by id."""
    groups, blocks = shape
    mine = anchors.withColumn("_group", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(groups)))
    mine = mine.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<bigint>")))
    own = rows.select(*[F.col(c).alias(c) for c in rows.columns])  # both sides come from one table
    theirs = own.withColumn("_block", F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(blocks)))
    theirs = theirs.withColumn("_group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<bigint>")))

    def cell(a: pa.Table, r: pa.Table) -> pa.Table:
        return choose(a.combine_chunks().sort_by("vec_id"), r.combine_chunks().sort_by("vec_id"))

    return mine.groupBy("_group", "_block").cogroup(theirs.groupBy("_group", "_block")).applyInArrow(cell, schema)


class _Cell:
    """Scores of a cell, for one label of anchors at a time and few anchors at a time."""

    def __init__(self, a: pa.Table, r: pa.Table, same: bool):
        width = max((int(np.max(t["vector"].combine_chunks().value_lengths().to_numpy(), initial=0)) for t in (a, r)), default=0)
        self.a, self.r = _matrix(a["vector"], width), _matrix(r["vector"], width)
        self.a_label, self.r_label = a["label"].to_numpy(), r["label"].to_numpy()
        self.same = same

    def parts(self):
        for label in np.unique(self.a_label):
            anchors = np.flatnonzero(self.a_label == label)
            rows = np.flatnonzero((self.r_label == label) == self.same)
            at_once = max(1, CELLS_AT_ONCE // max(1, len(rows)))
            for i in range(0, len(anchors), at_once):
                some = anchors[i : i + at_once]
                yield some, rows, _products(self.a[some], self.r[rows])


def _table(names: list[str], parts: list[list[np.ndarray]]) -> pa.Table:
    columns = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in zip(*parts)] or [np.zeros(0, np.int64)] * len(names)
    return pa.table([pa.array(c.tolist(), pa.int64()) if c.dtype == object else pa.array(c) for c in columns], names)


def positives(anchors: DataFrame, rows: DataFrame, shape: tuple[int, int], count: int = POSITIVES) -> DataFrame:
    """anchor_id, positive_id, positive_score: an anchor's best other rows of its label."""
    names = ["anchor_id", "positive_id", "positive_score"]

    def choose(a: pa.Table, r: pa.Table) -> pa.Table:
        a_id, r_id, out = a["vec_id"].to_numpy(), r["vec_id"].to_numpy(), []
        if len(a_id) and len(r_id):
            for some, theirs, scores in _Cell(a, r, True).parts():
                i, j = _best(scores, a_id[some][:, None] != r_id[theirs], count)
                out.append([a_id[some][i], r_id[theirs][j], scores[i, j]])
        return _table(names, out)

    found = _cells(anchors, rows, shape, choose, "anchor_id long, positive_id long, positive_score long")
    return _first(found, ["anchor_id"], "positive", count)


def _first(found: DataFrame, keys: list[str], kind: str, count: int) -> DataFrame:
    """The best `count` per key: tasks drop what cannot be among them before the shuffle."""
    order = Window.partitionBy(*keys).orderBy(F.desc(f"{kind}_score"), f"{kind}_id")
    return found.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= count).drop("_place")


def _limit(score: Column, percent: int) -> Column:
    """The largest whole score with 100 * score <= percent * `score`."""
    product = score.cast("decimal(38,0)") * percent
    return F.floor(product / F.lit(100).cast("decimal(3,0)")).cast("long")


def slots_of(found: DataFrame, low: int = LOW, high: int = HIGH) -> DataFrame:
    """Per anchor: `uppers`, the positives' upper limits from the highest down, and `lowest`, under
    which no window reaches."""
    upper = _limit(F.col("positive_score"), high)
    lower = -_limit(-F.col("positive_score"), low)  # rounded up
    bounds = found.select("anchor_id", upper.alias("_upper"), lower.alias("_lower")).where("_lower <= _upper")
    return bounds.groupBy("anchor_id").agg(
        F.sort_array(F.collect_set("_upper"), asc=False).alias("uppers"),  # one per positive at most
        F.min("_lower").alias("lowest"),
    )


def slot_best(anchors: DataFrame, rows: DataFrame, slots: DataFrame, shape: tuple[int, int], count: int = NEGATIVES) -> DataFrame:
    """anchor_id, slot, negative_id, negative_score: the best `count` of each slot, slot 0 the highest."""
    names = ["anchor_id", "slot", "negative_id", "negative_score"]

    def choose(a: pa.Table, r: pa.Table) -> pa.Table:
        a_id, r_id, out = a["vec_id"].to_numpy(), r["vec_id"].to_numpy(), []
        if len(a_id) and len(r_id):
            lowest = a["lowest"].to_numpy()
            limits = a["uppers"].to_pylist()
            uppers = np.array([u + [low - 1] * (max(map(len, limits)) + 1 - len(u)) for u, low in zip(limits, lowest.tolist())])
            for some, theirs, scores in _Cell(a, r, False).parts():
                for slot in range(uppers.shape[1] - 1):
                    upper, under = uppers[some, slot, None], uppers[some, slot + 1, None]
                    under = np.maximum(under, lowest[some, None] - 1)
                    i, j = _best(scores, ((scores <= upper) & (scores > under)).astype(bool), count)
                    out.append([a_id[some][i], np.full(len(i), slot), r_id[theirs][j], scores[i, j]])
        return _table(names, out)

    chosen = anchors.join(slots.withColumnRenamed("anchor_id", "vec_id"), "vec_id")
    found = _cells(chosen, rows, shape, choose, "anchor_id long, slot long, negative_id long, negative_score long")
    return _first(found, ["anchor_id", "slot"], "negative", count)


def windows(found: DataFrame, slots: DataFrame, best: DataFrame, count: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """Per anchor and positive the negatives of its window, from the best of each slot.

    Per anchor there are at most POSITIVES slots of NEGATIVES rows, in one list. `under[i]` is the best
    `count` of slot i and all lower ones, merged from the lowest up.
    """
    row = F.struct((-F.col("negative_score")).alias("minus"), F.col("negative_id").alias("id"))
    lists = best.groupBy("anchor_id", "slot").agg(F.sort_array(F.collect_list(row)).alias("top"))
    lists = lists.groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("slot", "top"))).alias("tops"))
    empty = "array_repeat(named_struct('minus', 0L, 'id', 0L), 0)"
    merged = f"""
      reverse(aggregate(reverse(sequence(0L, size(uppers) - 1L)), array_repeat({empty}, 0),
        (done, slot) -> array_append(done, slice(array_sort(concat(
          coalesce(element_at(done, -1), {empty}), coalesce(element_at(tops, slot), {empty}))), 1, {count}))))"""
    merged = merged.replace("element_at(done, -1)", "try_element_at(done, -1)").replace("element_at(tops, slot)", "try_element_at(tops, slot)")
    under = slots.join(lists, "anchor_id").select("anchor_id", "uppers", F.expr(merged).alias("under"))
    upper = _limit(F.col("positive_score"), high)
    lower = -_limit(-F.col("positive_score"), low)
    joined = found.join(under, "anchor_id").withColumns({"_upper": upper, "_lower": lower})
    joined = joined.where("_lower <= _upper")
    own = F.expr("filter(try_element_at(under, cast(array_position(uppers, _upper) as int)), x -> -x.minus >= _lower)")
    return joined.select(
        "anchor_id", "positive_id", "positive_score", F.posexplode(own).alias("_place", "_n")
    ).select(
        "anchor_id",
        "positive_id",
        (F.col("_place") + 1).alias("rank"),
        F.col("_n.id").alias("negative_id"),
        "positive_score",
        (-F.col("_n.minus")).alias("negative_score"),
    )


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    n_positives: int = POSITIVES,
    n_negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    cell: tuple[int, int] = (ANCHORS, ROWS),
) -> DataFrame:
    """Hard negatives for the rows of `vectors` (vec_id, label, vector of whole numbers) that `is_anchor`."""
    rows = saved(usable(vectors), "vectors")
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(is_anchor, 1)).alias("anchors")).first()
    shape = tuple(max(1, -(-n // most)) for n, most in zip((sizes["anchors"], sizes["n"]), cell))
    anchors = rows.where(is_anchor)
    found = saved(positives(anchors, rows, shape, n_positives), "positives")
    slots = saved(slots_of(found, low, high), "slots")
    best = slot_best(anchors, rows, slots, shape, n_negatives)
    return windows(found, slots, best, n_negatives, low, high)


def labelled_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id, label, vector for `mine`: 256 steps to one; of each seventh id the label is off by one."""
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    vector = F.transform("embedding", lambda x: _floor(x))
    return embeddings.select("vec_id", moved.alias("label"), vector.alias("vector"))


def _floor(x: Column) -> Column:
    """floor(256 * x) as a double; null, infinity and NaN stay what they are."""
    scaled = F.lit(256.0) * x.cast("double")
    whole = F.floor(scaled).cast("double")
    return F.when(F.abs(scaled) < float(1 << 52), whole).otherwise(scaled)
