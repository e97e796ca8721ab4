"""Batch steps: balances, scores and limits."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cardledger.functions.credit import adjusted_limit, score_adjustment, utilisation
from cardledger.functions.money import from_wide_micros, to_wide_micros
from cardledger.operators.ledger import latest_by_key, overlay


def roll_forward_balances(
    cards: DataFrame, transactions: DataFrame, compat_float: bool = False
) -> DataFrame:
    """Add to each card the pending balance of its transaction with the largest id.

    `compat_float` passes the old balance through a 32-bit float first and adds doubles.
    """
    latest = latest_by_key(transactions, "card_id", "transaction_id", "pending_balance")
    joined = cards.join(latest, "card_id", "left")
    if compat_float:
        pending = F.coalesce("pending_balance", F.lit(0.0))
        balance = F.col("current_balance").cast("float").cast("double") + pending
    else:
        # A card without pending amounts keeps its balance as it is.
        pending = to_wide_micros("pending_balance")
        balance = F.when(pending != 0, from_wide_micros(to_wide_micros("current_balance") + pending))
        balance = F.coalesce(balance, F.col("current_balance"))
    return joined.withColumn("current_balance", balance).select(*cards.columns)


def credit_usage(cards: DataFrame) -> DataFrame:
    """Percent of all limits in use per customer; null where the limits sum to zero."""
    held, limit = (F.sum(to_wide_micros(c)).cast("double") for c in ("current_balance", "credit_limit"))
    return cards.groupBy("customer_id").agg(utilisation(held, limit).alias("usage_percent"))


def score_changes(cards: DataFrame, customers: DataFrame) -> DataFrame:
    """Score change and new score of each customer with a card."""
    change = F.coalesce(score_adjustment(F.col("usage_percent")), F.lit(0))
    return (
        credit_usage(cards)
        .join(customers.select("customer_id", "credit_score"), "customer_id")
        .select(
            "customer_id",
            "usage_percent",
            change.alias("credit_score_change"),
            (F.col("credit_score") + change).alias("credit_score"),
        )
    )


def rescore_customers(cards: DataFrame, customers: DataFrame) -> DataFrame:
    """Customers with their new score and `credit_score_change` (0 without a card)."""
    changes = score_changes(cards, customers).drop("usage_percent")
    base = customers.withColumn("credit_score_change", F.lit(0))
    return overlay(base, changes, "customer_id", ["credit_score", "credit_score_change"])


def adjust_limits(cards: DataFrame, customers: DataFrame) -> DataFrame:
    """Cards with the limit cut where the score of the customer fell."""
    changes = customers.select("customer_id", "credit_score_change")
    change = F.coalesce("credit_score_change", F.lit(0))
    return (
        cards.join(changes, "customer_id", "left")
        .withColumn("credit_limit", adjusted_limit(F.col("credit_limit"), change))
        .select(*cards.columns)
    )
