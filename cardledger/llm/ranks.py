"""Numbers without gaps, and running sums, inside groups of any size."""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window, functions as F


def _piece(order: list[str], n_rows: int) -> Column:
    """A piece number from the hash of `order`: as many pieces as a piece has rows."""
    return F.pmod(F.xxhash64(*order), F.lit(isqrt(n_rows) + 1)).cast("int")


def with_running(
    df: DataFrame, keys: list[str], order: list[str], n_rows: int, value: Column, name: str, first: Column | None = None
) -> DataFrame:
    """Add `name`: the sum of `value` over the rows of the same `keys` that come before this one.

    Rows come by `first` (a column of few values; default none), then in an order fixed by a hash of
    `order`. A group is cut into about sqrt(n_rows) pieces by that hash; each piece is summed by its
    own task and starts after the group's earlier pieces. Only one sum per piece meets in one task,
    so a group may hold any share of the rows. Null keys are a group. Rows equal in `keys` and
    `order` come in any order.
    """
    cut = df.withColumns(
        {"_first": F.lit(0) if first is None else first, "_piece": _piece(order, n_rows), "_value": value.cast("long")}
    )
    local = Window.partitionBy(*keys, "_first", "_piece").orderBy(*order)
    cut = cut.withColumn("_local", F.sum("_value").over(local.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_value"))
    before = Window.partitionBy(*keys).orderBy("_first", "_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        df.select(
            *keys,
            (F.lit(0) if first is None else first).alias("_first"),
            _piece(order, n_rows).alias("_piece"),
            value.cast("long").alias("_value"),
        )
        .groupBy(*keys, "_first", "_piece")
        .agg(F.sum("_value").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    )
    starts = starts.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_first").alias("_f"), F.col("_piece").alias("_p"), "_before")
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    joined = cut.join(starts, [*same, F.col("_first") == F.col("_f"), F.col("_piece") == F.col("_p")], "left")
    return joined.withColumn(name, F.col("_before") + F.col("_local")).select(*df.columns, name)


def with_rank(df: DataFrame, keys: list[str], order: list[str], n_rows: int, name: str) -> DataFrame:
    """Add `name`: 0, 1, 2, ... within `keys`, gapless, a function of the rows alone."""
    return with_running(df, keys, order, n_rows, F.lit(1), name)
