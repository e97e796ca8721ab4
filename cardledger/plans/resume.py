"""A whole run under a name, which goes on where it stopped and happens once.

Each step's table is written to the run's own folder. Spark's committer marks a folder as whole after its
last file, and a step whose folder is marked is read, not done again. The run keeps to the version of the
tables that it began with, so all its steps see the same rows. Publishing names the run, so a run that has
published does nothing when it is started again; its step folders are removed.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cardledger.operators.ledger import approve_pending, approved_status
from cardledger.operators.settle import adjust_limits, rescore_customers, roll_forward_balances
from cardledger.plans.authorize import as_aside, as_stream, checked_whole
from cardledger.sources import files
from cardledger.sources.published import VersionedStore
from cardledger.sources.scratch import COMPRESSION
from cardledger.sources.tables import load_all, save_csv, save_sorted


@dataclass(frozen=True)
class Steps:
    """The tables of one run's steps, under `root`."""

    spark: SparkSession
    root: str

    def table(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        path = f"{self.root}/{name}"
        if not self.is_done(name):
            make().write.mode("overwrite").parquet(path, compression=COMPRESSION)
        return self.spark.read.parquet(path)

    def csv(self, name: str, path: str, make: Callable[[], DataFrame | None]) -> None:
        """Result files at `path`, over what an earlier run or a broken-off one left there. A `make` that
        returns None has written them itself."""
        if not self.is_done(name):
            df = make()
            if df is not None:
                save_csv(df, path)
            self._mark(name)

    def is_done(self, name: str) -> bool:
        return files.exists(self.spark, f"{self.root}/{name}/_SUCCESS")

    def begin(self, version: int) -> int:
        """The version the run began with: `version`, where it begins now."""
        path = f"{self.root}/begun.json"
        if not files.exists(self.spark, path):
            files.write_new(self.spark, path, json.dumps({"version": version}))
        return json.loads(files.read_text(self.spark, path))["version"]

    def clear(self) -> None:
        files.remove_folder(self.spark, self.root)

    def _mark(self, name: str) -> None:
        files.write_new(self.spark, f"{self.root}/{name}/_SUCCESS", "")


def run_once(
    store: VersionedStore,
    results: str,
    work: str,
    run: str,
    running_limit: bool = False,
    compat_float: bool = False,
    compression: str | None = "gzip",
) -> bool:
    """Do what is left of the run named `run`; whether anything was. `compression`: see `run_all`.

    `work` is a folder in the shared space that outlives the driver; the run's steps are in `work`/`run`.
    Where another run has published since this one began, publishing is an error: its tables would be lost.
    """
    steps = Steps(store.spark, f"{work}/{run}")
    if store.run() == run:
        steps.clear()
        return False
    begun = store.at(steps.begin(store.version()))
    tables = load_all(begun)
    transactions, cards, customers = (tables[n] for n in ("transactions", "cards", "customers"))

    rows = steps.table("stream", lambda: checked_whole(transactions, cards, customers, running_limit))
    stream = as_stream(rows, transactions.columns)
    aside = steps.table("aside", lambda: as_aside(rows, transactions.columns))
    approved = approve_pending(stream)
    rolled = steps.table("balances", lambda: roll_forward_balances(cards, approved, compat_float))
    rescored = steps.table("scores", lambda: rescore_customers(rolled, customers))
    new_cards = steps.table("cards", lambda: adjust_limits(rolled, rescored))
    new_customers = rescored.drop("credit_score_change")

    # Both results with a row per transaction are written by the first step, as they are sorted once.
    both = {"stream_transactions": {}, "batch_transactions": {"status": approved_status()}}
    make = {
        "stream_transactions": lambda: save_sorted(stream, "transaction_id", results, both, compression=compression),
        "batch_transactions": lambda: None,
        "cards_updated": lambda: new_cards.orderBy("card_id"),
        "customers_updated": lambda: new_customers.orderBy("customer_id"),
    }
    for name, made in make.items():
        steps.csv(f"files_{name}", f"{results}/{name}", made)
    steps.csv("files_transactions_aside", f"{results}/transactions_aside", lambda: aside)
    begun.publish({"cards": new_cards, "customers": new_customers}, run)
    steps.clear()
    return True
