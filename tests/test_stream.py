import pytest
import tables as t

from cardledger.operators.lookup import card_profiles
from cardledger.plans.authorize import authorize
from cardledger.sources.messages import read_files, save_messages
from cardledger.streaming.speed import authorize_stream, run_available, stream_aside


class Run:
    """A stream over one folder of messages, to be run several times."""

    def __init__(self, spark, tmp_path, cards, customers, running_limit, **more):
        self.spark, self.path = spark, tmp_path
        self.profiles = card_profiles(t.cards(spark, cards), t.customers(spark, customers))
        self.running_limit, self.more, self.wave = running_limit, more, 0

    def send(self, rows, order=None):
        """What is sent later arrives later."""
        save_messages(t.transactions(self.spark, rows), str(self.path / "in"), self.wave, order)
        self.wave += 1

    def aside(self):
        out = run_available(
            stream_aside(read_files(self.spark, str(self.path / "in")), self.profiles),
            str(self.path / "aside"),
            str(self.path / "aside_checkpoint"),
        )
        return {(r["transaction_id"], r["cause"]) for r in out.collect()}

    def process(self, per_trigger=None):
        stream = read_files(self.spark, str(self.path / "in"), per_trigger)
        updates = authorize_stream(stream, self.profiles, self.running_limit, buckets=4, **self.more)
        out = run_available(updates, str(self.path / "out"), str(self.path / "checkpoint"))
        rows = out.collect()
        assert len({r["transaction_id"] for r in rows}) == len(rows)
        return t.results(out)


@pytest.mark.parametrize("running_limit", [False, True])
@pytest.mark.parametrize("slices, per_trigger", [(1, None), (3, 1)])
def test_stream_equals_batch(spark, tmp_path, running_limit, slices, per_trigger):
    c, u, x = t.random_tables(21, 250)
    x.sort(key=lambda r: (r["timestamp"], r["transaction_id"]))
    run = Run(spark, tmp_path, c, u, running_limit)
    for i in range(slices):
        run.send(x[len(x) * i // slices : len(x) * (i + 1) // slices])
    got = run.process(per_trigger)
    batch = authorize(
        t.transactions(spark, x), t.cards(spark, c), t.customers(spark, u), running_limit
    )
    assert got == t.results(batch) == t.model(c, u, x, running_limit)


def test_restart_goes_on_with_balances_and_seen_ids(spark, tmp_path):
    c, u, x = t.random_tables(22, 200)
    x.sort(key=lambda r: (r["timestamp"], r["transaction_id"]))
    run = Run(spark, tmp_path, c, u, running_limit=True)
    run.send(x[:100])
    assert len(run.process()) == 100
    later = [r | {"amount": r["amount"] + 1} for r in x[:30]]  # sent again, changed
    run.send(later)
    run.send(x[100:])
    assert run.process() == t.model(c, u, x, True)
    assert run.process() == t.model(c, u, x, True)  # nothing new


@pytest.mark.parametrize("per_trigger", [None, 1])
def test_verdicts_go_by_arrival_whatever_a_trigger_holds(spark, tmp_path, per_trigger):
    """Three payments of 450 on a limit of 1000, not sent in the order of their days."""
    run = Run(spark, tmp_path, [t.card()], [t.customer()], running_limit=True)
    for i, day in ((1, 5), (2, 0), (3, 1)):
        run.send([t.tx(i, 450.0, day=day)])
    got = run.process(per_trigger)
    assert [got[i][0] for i in (1, 2, 3)] == ["pending", "pending", "declined"]


@pytest.mark.parametrize("per_trigger", [None, 1])
def test_first_copy_by_arrival_counts(spark, tmp_path, per_trigger):
    run = Run(spark, tmp_path, [t.card()], [t.customer()], running_limit=False)
    run.send([t.tx(1, None), t.tx(2, 7.0)])  # a copy without amount does not shut out the next
    run.send([t.tx(1, 5.0, day=3), t.tx(2, 8.0)])
    run.send([t.tx(1, 6.0, day=1)])
    got = run.process(per_trigger)
    assert got == {1: ("pending", None, 500 + (700 if got[2][2] == 700 else 0)), 2: ("pending", None, got[2][2])}
    assert run.aside() == {(1, "no amount")}


def test_messages_that_cannot_be_checked_are_left_out(spark, tmp_path):
    c, u = [t.card()], [t.customer()]
    run = Run(spark, tmp_path, c, u, running_limit=False)
    run.send([t.tx(1, None), t.tx(2, 5.0), t.tx(3, 5.0, card_id=None), t.tx(4, 5.0, card_id=8)])
    junk = [("1", "not json", 9), ("1", '{"transaction_id": "batch:7", "card_id": "1", "amount": "2.5", '
            '"timestamp": "2024-01-01 00:00:00", "location": "Shop 10001"}', 10)]
    spark.createDataFrame(junk, "key string, value string, arrival long").write.mode("append").parquet(
        str(tmp_path / "in")
    )
    got = run.process()
    assert got.pop(7) == ("pending", None, 750)
    assert run.aside() == {(1, "no amount"), (None, "no transaction id")}
    assert got == {
        2: ("pending", None, 500), 3: ("declined", "Card not found", 0),
        4: ("declined", "Card not found", 0),
    }


def test_dedupe_with_bounded_state(spark, tmp_path):
    c, u, x = t.random_tables(23, 60)
    run = Run(spark, tmp_path, c, u, running_limit=False, dedupe_within="30 days")
    run.send(x + x[:10])
    assert run.process() == t.model(c, u, x, False)
