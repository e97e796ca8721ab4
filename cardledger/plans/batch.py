"""The batch layer: approve, roll balances forward, rescore customers, cut limits."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from cardledger.operators.ledger import approve_pending
from cardledger.operators.settle import adjust_limits, rescore_customers, roll_forward_balances
from cardledger.sources.scratch import saved


@dataclass(frozen=True)
class BatchResult:
    transactions: DataFrame
    cards: DataFrame
    customers: DataFrame


def run_batch(
    stream: DataFrame,
    cards: DataFrame,
    customers: DataFrame,
    compat_float: bool = False,
    save_balances: bool = False,
) -> BatchResult:
    """The batch results for the stream results; nothing is written over its input.

    The new balances feed both the scores and the cards. `save_balances` stores them (one row per
    card) so that the transactions are aggregated once when several results are written.
    """
    transactions = approve_pending(stream)
    rolled = roll_forward_balances(cards, transactions, compat_float)
    if save_balances:
        rolled = saved(rolled, "balances")
    rescored = rescore_customers(rolled, customers)
    return BatchResult(
        transactions,
        adjust_limits(rolled, rescored),
        rescored.drop("credit_score_change"),
    )


def sorted_for_output(result: BatchResult) -> BatchResult:
    """Sorted by key, as the result files are. A range sort: spread over tasks by sampled bounds."""
    return BatchResult(
        result.transactions.orderBy(F.col("transaction_id")),
        result.cards.orderBy("card_id"),
        result.customers.orderBy("customer_id"),
    )
