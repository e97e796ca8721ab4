"""Keys that hold very many rows: finding them, and taking their rows another way.

Rows of ordinary keys are joined and put in order with one shuffle by key. Rows of hot keys would
all go to one task in that shuffle, so they are split off: what they are joined with is small (one
row per hot key) and is broadcast, and `running` deals them by ranges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cardledger.sources.scratch import saved

# A key with more rows than this is hot. A table of N rows has fewer than N / HOT_ROWS such keys
# (10^12 rows: 500,000 keys, 4 MB), which bounds what is broadcast below.
HOT_ROWS = 2_000_000

# Rows of hot keys are cut into more pieces than this only where pieces would have more than HOT_ROWS rows.
PIECES = 256


def find_hot(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """The keys (null counts as one) with more than `hot_rows` rows, or None if there are none.

    Counts are combined before the shuffle. A list that is not empty is saved, as a plan asks for
    it more than once.
    """
    hot = (
        df.groupBy(F.col(key).alias("_hot_key"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > hot_rows)
        .select("_hot_key", "_n", F.lit(hot_rows).cast("long").alias("_over"))
    )
    return None if hot.isEmpty() else saved(hot, "hot")


def piece_rows(hot: DataFrame) -> tuple[int, int]:
    """(rows of all hot keys, rows in a piece of them): as many as make a key hot, but no more than PIECES
    pieces while they have up to HOT_ROWS rows, as each piece costs a task and is listed by the driver."""
    n_rows, smallest = hot.agg(F.sum("_n"), F.min("_over")).first()
    return n_rows, max(1, smallest, min(HOT_ROWS, -(-n_rows // PIECES)))


def split(df: DataFrame, key: str, hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ordinary keys, and those of hot keys."""
    same = F.col(key).eqNullSafe(F.col("_hot_key"))
    return df.join(F.broadcast(hot), same, "left_anti"), df.join(F.broadcast(hot), same, "left_semi")


def of_hot_keys(dim: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """The rows of `dim` (one per key) that rows of hot keys are joined with, to be broadcast."""
    few = dim.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left_semi")
    return F.broadcast(few)


def lookup(rows: DataFrame, dim: DataFrame, key: str, hot: DataFrame | None) -> DataFrame:
    """Left join `rows` to `dim`, which has one row per `key`."""
    if hot is None:
        return rows.join(dim, key, "left")
    ordinary, busy = split(rows, key, hot)
    few = of_hot_keys(dim, key, hot)
    return ordinary.join(dim, key, "left").unionByName(busy.join(few, key, "left"))
