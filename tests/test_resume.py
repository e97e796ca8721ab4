"""A run that is stopped after any step goes on from there, with the same tables."""

import pytest
import tables as t

from cardledger.plans import resume
from cardledger.plans.resume import Steps, run_once
from cardledger.plans.whole_run import run_tables
from cardledger.schemas import TABLES
from cardledger.sources.published import VersionedStore

STEPS = ["stream", "aside", "balances", "scores", "cards"]
FILES = ["stream_transactions", "batch_transactions", "cards_updated", "customers_updated", "transactions_aside"]


@pytest.fixture(autouse=True)
def few_tasks(conf):
    conf("spark.sql.shuffle.partitions", "2")


@pytest.fixture
def tables(spark):
    cards, customers, tx = t.random_tables(5, 60)
    return {
        "cards": t.cards(spark, cards),
        "customers": t.customers(spark, customers),
        "transactions": t.transactions(spark, tx),
        "credit_card_types": spark.createDataFrame([], TABLES["credit_card_types"][0]),
    }


@pytest.fixture
def store(spark, tmp_path, tables):
    store = VersionedStore(spark, str(tmp_path / "store"))
    store.publish(tables)
    return store


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def published(store):
    return rows(store.read("cards")), rows(store.read("customers"))


def test_like_a_run_in_one_go(store, tables, tmp_path):
    want = run_tables(tables)
    assert run_once(store, str(tmp_path / "results"), str(tmp_path / "work"), "day 1")
    assert published(store) == (rows(want.batch.cards), rows(want.batch.customers))
    assert store.run() == "day 1"
    assert not (tmp_path / "work" / "day 1").exists()
    assert sorted(p.name for p in (tmp_path / "results").iterdir()) == sorted(FILES)


@pytest.mark.parametrize("stop", ["aside", "cards", "files_batch_transactions", "publish"])
def test_goes_on_after(store, tables, tmp_path, monkeypatch, stop):
    made = []
    plain_table, plain_csv, plain_publish = Steps.table, Steps.csv, VersionedStore.publish

    def counted(name, make):
        def run():
            made.append(name)
            return make()

        return run

    def table(self, name, make):
        done = plain_table(self, name, counted(name, make))
        if name == stop:
            raise RuntimeError("lost driver")
        return done

    def csv(self, name, path, make):
        plain_csv(self, name, path, counted(name, make))
        if name == stop:
            raise RuntimeError("lost driver")

    def publish(self, *a):
        plain_publish(self, *a)
        if stop == "publish":
            raise RuntimeError("lost driver")

    monkeypatch.setattr(Steps, "table", table)
    monkeypatch.setattr(Steps, "csv", csv)
    monkeypatch.setattr(VersionedStore, "publish", publish)
    arguments = (store, str(tmp_path / "results"), str(tmp_path / "work"), "day 1")
    with pytest.raises(RuntimeError, match="lost driver"):
        run_once(*arguments)
    before, stop = stop, None
    assert run_once(*arguments) == (before != "publish")
    assert sorted(made) == sorted([*STEPS, *(f"files_{f}" for f in FILES)])  # each step once
    want = run_tables(tables)
    assert published(store) == (rows(want.batch.cards), rows(want.batch.customers))
    assert store.version() == 1


def test_a_published_run_does_nothing_again(store, tmp_path):
    arguments = (store, str(tmp_path / "results"), str(tmp_path / "work"))
    assert run_once(*arguments, "day 1")
    first = published(store)
    assert not run_once(*arguments, "day 1")
    assert published(store) == first and store.version() == 1
    assert run_once(*arguments, "day 2") and store.version() == 2


def test_a_step_broken_off_is_done_again(spark, tmp_path):
    steps = Steps(spark, str(tmp_path / "work"))
    fails = spark.range(4).selectExpr("id", "if(id = 3, raise_error('lost'), 1) as x")
    with pytest.raises(Exception, match="lost"):
        steps.table("some", lambda: fails)
    assert not steps.is_done("some")
    assert steps.table("some", lambda: spark.range(4)).count() == 4


def test_another_run_in_between_is_an_error(store, tables, tmp_path, monkeypatch):
    plain = resume.adjust_limits

    def meanwhile(*a):
        store.publish({"customers": tables["customers"]}, "other")
        return plain(*a)

    monkeypatch.setattr(resume, "adjust_limits", meanwhile)
    with pytest.raises(FileExistsError):
        run_once(store, str(tmp_path / "results"), str(tmp_path / "work"), "day 1")
    assert store.run() == "other" and rows(store.read("cards")) == rows(tables["cards"])
