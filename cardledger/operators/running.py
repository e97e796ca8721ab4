"""Running aggregates per key that split a hot key over many tasks.

A plain window puts all rows of a key into one task. The rows of hot keys are dealt by ranges of
(key, order), with bounds that Spark samples, and written once with the number of their range. Each
range of a key is a window of its own; what came before it is the sum of the totals of the key's
earlier ranges, of which there are few whatever the ids look like.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from cardledger.operators.hot import piece_rows, split
from cardledger.sources.scratch import saved



@dataclass(frozen=True)
class Measure:
    """What to keep a running value of; `inclusive` says whether the row itself counts."""

    value: Column
    kind: str = "sum"
    inclusive: bool = True

    def total(self, value: Column) -> Column:
        return F.sum(value) if self.kind == "sum" else F.min(value)

    def merge(self, a: Column, b: Column) -> Column:
        if self.kind == "sum":
            return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))
        return F.least(a, b)

    def alone(self, a: Column) -> Column:
        return F.coalesce(a, F.lit(0)) if self.kind == "sum" else a


Measures = dict[str, Measure]


def running(
    df: DataFrame, key: str, order: list[str], measures: Measures, hot: DataFrame | None
) -> DataFrame:
    """Add one running column per measure, in the given order within each key.

    Nulls come first, in `order` as in the key, which has a group for null. `hot` comes from
    `find_hot`.
    """
    if hot is None:
        return running_by_key(df, key, order, measures)
    ordinary, busy = split(df, key, hot)
    return running_by_key(ordinary, key, order, measures).unionByName(
        running_by_range(busy, key, order, measures, n_ranges(hot))
    )


def running_by_key(df: DataFrame, key: str, order: list[str], measures: Measures) -> DataFrame:
    """One window per key. The result is partitioned by `key` and sorted by key and `order`."""
    return df.repartition(key).select("*", *_local(measures, [key], order))


def n_ranges(hot: DataFrame) -> int:
    """As many ranges as the rows of all hot keys fill twice: a range has about half of a piece's rows."""
    n_rows, in_piece = piece_rows(hot)
    return max(2, 2 * -(-n_rows // in_piece))


def running_by_range(
    df: DataFrame, key: str, order: list[str], measures: Measures, ranges: int
) -> DataFrame:
    """One window per key and range, and the totals of the key's ranges before it."""
    dealt = df.repartitionByRange(ranges, key, *order).withColumn("_range", F.spark_partition_id())
    rows = saved(dealt, "ranges")
    totals = rows.groupBy(F.col(key).alias("_key"), F.col("_range").alias("_of")).agg(
        *[m.total(m.value).alias(name) for name, m in measures.items()]
    )
    frame = Window.partitionBy("_key").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(
        "_key", "_of", *[m.total(F.col(name)).over(frame).alias(f"_before_{name}") for name, m in measures.items()]
    )
    local = rows.repartition(key, "_range").select("*", *_local(measures, [key, "_range"], order))
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_range") == F.col("_of"))
    return local.join(before, same, "left").select(
        *df.columns,
        *[m.merge(F.col(name), F.col(f"_before_{name}")).alias(name) for name, m in measures.items()],
    )


def _local(measures: Measures, keys: list[str], order: list[str]) -> list[Column]:
    w = Window.partitionBy(*keys).orderBy(*order)
    out = []
    for name, m in measures.items():
        last = Window.currentRow if m.inclusive else -1
        frame = w.rowsBetween(Window.unboundedPreceding, last)
        out.append(m.alone(m.total(m.value).over(frame)).alias(name))
    return out
