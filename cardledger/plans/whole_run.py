"""Everything in order: check the transactions, settle the batch, publish the new tables."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

from cardledger.operators.hot import find_hot
from cardledger.operators.ledger import approved_status, dedupe_first
from cardledger.plans.authorize import as_aside, as_stream, checked_whole, set_aside, stream_transactions
from cardledger.plans.batch import BatchResult, run_batch, sorted_for_output
from cardledger.sources.messages import replay_order
from cardledger.sources.scratch import saved
from cardledger.sources.tables import Store, load_all, publish_serving, save_csv, save_sorted


@dataclass(frozen=True)
class WholeRun:
    """`aside`: transactions not checked, with the cause; `n_aside`: how many."""

    stream: DataFrame
    batch: BatchResult
    aside: DataFrame
    n_aside: int


def run_tables(
    tables: dict[str, DataFrame],
    running_limit: bool = False,
    compat_float: bool = False,
    dedupe: bool = False,
    updates: DataFrame | None = None,
) -> WholeRun:
    """From the loaded tables to the results. Each step goes on from a parquet table.

    `updates` are results that a stream has given; without them the transactions are checked here.
    `dedupe` keeps the first copy of each transaction.
    """
    transactions, cards, customers = (tables[n] for n in ("transactions", "cards", "customers"))
    may_be_hot = True
    if dedupe:
        # First copies of a card are no more than its copies. They are stored only where they are read again.
        may_be_hot = updates is not None or find_hot(transactions, "card_id") is not None
        transactions = dedupe_first(transactions, "transaction_id", replay_order())
        transactions = saved(transactions, "transactions") if may_be_hot else transactions
    if updates is None:
        rows = saved(checked_whole(transactions, cards, customers, running_limit, may_be_hot=may_be_hot), "checked")
        stream, aside = (part(rows, transactions.columns) for part in (as_stream, as_aside))
    else:
        stream = saved(stream_transactions(transactions, updates), "stream")
        aside = saved(set_aside(transactions, cards, customers), "aside")
    batch = run_batch(stream, cards, customers, compat_float, save_balances=True)
    return WholeRun(stream, batch, aside, aside.count())


def run_all(
    store: Store,
    results: str,
    running_limit: bool = False,
    compat_float: bool = False,
    dedupe: bool = False,
    updates: DataFrame | None = None,
    single_file: bool = False,
    compression: str | None = "gzip",
) -> WholeRun:
    """Read the tables, check their keys, write the result files, put the new tables in place.

    `compression` is that of the results with a row per transaction or card; None writes plain files.
    """
    tables = load_all(store, unchecked=("transactions",) if dedupe else ())
    run = run_tables(tables, running_limit, compat_float, dedupe, updates)
    cards, customers = saved(run.batch.cards, "cards"), saved(run.batch.customers, "customers")
    run = replace(run, batch=replace(run.batch, cards=cards, customers=customers))
    batch = sorted_for_output(run.batch)
    # The batch's transactions are those of the stream with another status.
    both = {"stream_transactions": {}, "batch_transactions": {"status": approved_status()}}
    save_sorted(run.stream, "transaction_id", results, both, single_file, compression)
    save_csv(batch.cards, f"{results}/cards_updated", single_file, compression)
    save_csv(batch.customers, f"{results}/customers_updated", single_file)
    save_csv(run.aside, f"{results}/transactions_aside", single_file)
    publish_serving(store, run.batch.cards, run.batch.customers)
    return run
