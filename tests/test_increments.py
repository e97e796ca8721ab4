"""Nights that read new results only, against one batch over all of them."""

import re
from pathlib import Path

import pytest
import tables as t
from pyspark.sql import functions as F

from cardledger.plans.batch import run_batch
from cardledger.plans.increments import NightlyBatch
from cardledger.schemas import STREAM_TRANSACTIONS
from cardledger.sources.versions import Ledger


@pytest.fixture(autouse=True)
def few_tasks(conf):
    conf("spark.sql.shuffle.partitions", "2")


def results(spark, n, start=1, cards=7):
    """Stream results: ids `start` and up, in no order, a third of them on card 1."""
    rows = [
        {
            "transaction_id": i,
            "card_id": 1 if i % 3 == 0 else i % cards,
            "pending_balance": round((i * 37 % 101) - 50 + i / 4, 2),
            "status": ["pending", "declined", ""][i % 3 - 1],
            "amount": float(i),
        }
        for i in range(start, start + n)
    ]
    return t.make(spark, STREAM_TRANSACTIONS, rows[::-1])


def base(spark):
    cards = [t.card(k, 1 + k % 3, 100.0 * k, 5.0 * k) for k in range(9)]
    return t.cards(spark, cards), t.customers(spark, [t.customer(k) for k in range(1, 4)])


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def same(batch, stream, cards, customers):
    want, got = run_batch(stream, cards, customers), batch.result()
    assert rows(got.cards) == rows(want.cards)
    assert rows(got.customers) == rows(want.customers)
    assert rows(got.transactions) == rows(want.transactions)


def spoil(folder):
    """From now on, whoever reads these files fails."""
    for file in Path(folder).glob("*.parquet"):
        file.write_bytes(b"no parquet")
        (file.parent / f".{file.name}.crc").unlink(missing_ok=True)


@pytest.mark.parametrize("every", [2, 32])
def test_nights_are_one_batch(spark, tmp_path, every):
    cards, customers = base(spark)
    batch = NightlyBatch(spark, str(tmp_path / "account"), every=every)
    batch.open(cards, customers)
    folder, stream = str(tmp_path / "in"), None
    # The second night brings smaller ids than the first one.
    for n, start in ((30, 100), (20, 1), (25, 300), (1, 500), (5, 600)):
        new = results(spark, n, start)
        stream = new if stream is None else stream.unionByName(new)
        new.coalesce(2).write.mode("append").parquet(folder)
        batch.take_in(folder)
        same(batch, stream, cards, customers)
        spoil(folder)  # no later night reads them
    assert [r.rows for r in batch.ledger.read().orderBy("batch").collect()] == [0, 30, 20, 25, 1, 5]


def test_nothing_new_and_nothing_at_all(spark, tmp_path):
    cards, customers = base(spark)
    batch = NightlyBatch(spark, str(tmp_path / "account"))
    batch.open(cards, customers)
    folder = str(tmp_path / "in")
    results(spark, 0).write.parquet(folder)
    batch.take_in(folder)
    same(batch, results(spark, 0), cards, customers)
    results(spark, 9).write.mode("append").parquet(folder)
    for _ in range(2):
        batch.take_in(folder)
        same(batch, results(spark, 9), cards, customers)
    with pytest.raises(FileExistsError):
        batch.open(cards, customers)


def test_many_files_in_several_increments(spark, tmp_path):
    cards, customers = base(spark)
    batch = NightlyBatch(spark, str(tmp_path / "account"), every=3)
    batch.open(cards, customers)
    results(spark, 70).repartition(8, "transaction_id").write.parquet(str(tmp_path / "in"))
    batch.take_in(str(tmp_path / "in"), files_at_once=1)
    assert batch.ledger.finished() >= 5
    same(batch, results(spark, 70), cards, customers)


def test_broken_off_and_run_again(spark, tmp_path, monkeypatch):
    cards, customers = base(spark)
    batch = NightlyBatch(spark, str(tmp_path / "account"))
    batch.open(cards, customers)
    folder = str(tmp_path / "in")
    results(spark, 30).write.parquet(folder)
    batch.take_in(folder)

    plain = Ledger.commit
    monkeypatch.setattr(Ledger, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost driver")))
    results(spark, 20, 50).write.mode("append").parquet(folder)
    with pytest.raises(Exception, match="lost driver"):
        batch.take_in(folder)
    same(batch, results(spark, 30), cards, customers)  # what is not finished is not seen
    monkeypatch.setattr(Ledger, "commit", plain)
    batch.take_in(folder)
    same(batch, results(spark, 30).unionByName(results(spark, 20, 50)), cards, customers)


def test_rows_without_card_or_id_or_balance(spark, tmp_path):
    cards, customers = base(spark)
    batch = NightlyBatch(spark, str(tmp_path / "account"))
    batch.open(cards, customers)
    odd = [
        {"transaction_id": 900, "card_id": None, "pending_balance": 5.0, "status": "pending"},
        {"transaction_id": None, "card_id": 2, "pending_balance": 5.0, "status": "pending"},
        {"transaction_id": 901, "card_id": 3, "pending_balance": None, "status": "pending"},
        {"transaction_id": 902, "card_id": 77, "pending_balance": 1.0, "status": None},
    ]
    stream = results(spark, 30).unionByName(t.make(spark, STREAM_TRANSACTIONS, odd))
    stream.write.parquet(str(tmp_path / "in"))
    batch.take_in(str(tmp_path / "in"))
    same(batch, stream, cards, customers)


def test_states_are_combined_before_the_shuffle(spark, tmp_path):
    batch = NightlyBatch(spark, str(tmp_path / "account"))
    text = batch.pending._merged(results(spark, 5))._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"HashAggregate.*max_by[\s\S]*Exchange[\s\S]*HashAggregate.*partial_max_by", text)
    assert "SortAggregate" not in text
