"""Small table operators: first copy, latest row per key, overlays, approval."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cardledger.functions import fixed


def dedupe_first(df: DataFrame, key: str, arrival: list[Column]) -> DataFrame:
    """One row per key: the one that arrived first.

    Spark keeps one row per key and task before the shuffle (WindowGroupLimit), so many copies of
    one key do not travel.
    """
    w = Window.partitionBy(key).orderBy(*arrival)
    return df.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") == 1).drop("_n")


def distinct_count(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.countDistinct(key).alias("n_distinct"))


def latest_by_key(df: DataFrame, key: str, by: str, value: str) -> DataFrame:
    """`value` of the row with the largest `by` per key: an aggregate, combined before the shuffle."""
    return df.groupBy(key).agg(F.max_by(value, by).alias(value))


def with_stream_defaults(transactions: DataFrame) -> DataFrame:
    return transactions.withColumns(
        {"pending_balance": F.lit(0.0), "status": F.lit(fixed.NEVER_STREAMED)}
    )


def overlay(base: DataFrame, updates: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """`base` with `columns` taken from `updates` where it has the key and a value."""
    new = updates.select(key, *[F.col(c).alias(f"_new_{c}") for c in columns])
    return base.join(new, key, "left").select(
        *[F.coalesce(f"_new_{c}", c).alias(c) if c in columns else F.col(c) for c in base.columns]
    )


def approved_status() -> Column:
    status = F.col("status")
    return F.when(status == fixed.PENDING, fixed.APPROVED).otherwise(status)


def approve_pending(transactions: DataFrame) -> DataFrame:
    return transactions.withColumn("status", approved_status())
