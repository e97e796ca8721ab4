"""The batch layer kept up to date: each night reads the stream results that are new.

What a card has pending is a state that merges: of two rows the one with the larger transaction id. An
increment writes the states of its own rows, one per card in it, and its approved transactions, under its
number; it reads no earlier transaction and no earlier state. Results merge the states over all increments:
as much work as there are cards. Spark's file source keeps account of the files that have been taken in.

The balances are laid over the cards as they were when the account was opened, so the results after any
number of increments are those of one batch over all their transactions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from cardledger.operators.ledger import approve_pending
from cardledger.operators.settle import adjust_limits, rescore_customers, roll_forward_balances
from cardledger.plans.batch import BatchResult
from cardledger.schemas import STREAM_TRANSACTIONS
from cardledger.sources.files import exists
from cardledger.sources.scratch import COMPRESSION, saved
from cardledger.sources.versions import Ledger, Merged

PENDING = "card_id long, transaction_id long, pending_balance double"


@dataclass(frozen=True)
class NightlyBatch:
    """The account under `root`, a folder in the shared space.

    `schema` is that of the stream's result files. Every `every`-th increment merges the states so far.
    """

    spark: SparkSession
    root: str
    schema: StructType = STREAM_TRANSACTIONS
    every: int = 32

    def open(self, cards: DataFrame, customers: DataFrame) -> None:
        """Open the account with these cards and customers. Once something is taken in, they stay."""
        if exists(self.spark, f"{self.root}/ledger"):
            raise FileExistsError(self.root)
        cards.write.mode("overwrite").parquet(f"{self.root}/cards")
        customers.write.mode("overwrite").parquet(f"{self.root}/customers")

    @property
    def pending(self) -> Merged:
        """Per card its transaction with the largest id. Rows without a card or an id have no part in it."""
        return Merged(
            self.spark,
            f"{self.root}/pending",
            "card_id",
            PENDING,
            {
                "transaction_id": F.max("transaction_id"),
                "pending_balance": F.max_by("pending_balance", "transaction_id"),
            },
            self.every,
        )

    @property
    def ledger(self) -> Ledger:
        return Ledger(self.spark, f"{self.root}/ledger", ["rows"])

    def take_in(self, folder: str, files_at_once: int = 100_000) -> None:
        """Take in the parquet files of `folder` that have not been taken in, in one or more increments."""
        new = self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", files_at_once).parquet(folder)
        writer = new.writeStream.foreachBatch(self._increment).option("checkpointLocation", f"{self.root}/taken")
        writer.trigger(availableNow=True).start().awaitTermination()

    def _increment(self, rows: DataFrame, number: int) -> None:
        """May be run again: it writes folders of its own number, and enters itself into the ledger last."""
        counted = Observation()
        approved = approve_pending(rows).observe(counted, F.count(F.lit(1)).alias("rows"))
        approved.write.mode("overwrite").parquet(f"{self.root}/approved/batch={number}", compression=COMPRESSION)
        written = self.spark.read.schema(self.schema).parquet(f"{self.root}/approved/batch={number}")
        self.pending.write(written.filter("card_id is not null and transaction_id is not null"), number)
        self.ledger.commit(number, {"rows": counted.get["rows"]})

    def transactions(self) -> DataFrame:
        """All transactions taken in by finished increments, approved."""
        finished = [f"{self.root}/approved/batch={n}" for n in range(self.ledger.finished() + 1)]
        reader = self.spark.read.schema(self.schema)
        return reader.parquet(*finished) if finished else self.spark.createDataFrame([], self.schema)

    def result(self, compat_float: bool = False) -> BatchResult:
        """The batch's results for all that has been taken in. The transactions are not read for the others."""
        cards, customers = (self.spark.read.parquet(f"{self.root}/{n}") for n in ("cards", "customers"))
        pending = self.pending.upto(self.ledger.finished())
        rolled = saved(roll_forward_balances(cards, pending, compat_float), "balances")
        rescored = rescore_customers(rolled, customers)
        return BatchResult(self.transactions(), adjust_limits(rolled, rescored), rescored.drop("credit_score_change"))
