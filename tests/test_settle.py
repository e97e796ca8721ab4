import tables as t

from cardledger.operators import ledger, settle
from cardledger.plans.authorize import authorize, stream_transactions
from cardledger.plans.batch import run_batch
from pyspark.sql import functions as F


def pending(spark, rows):
    return spark.createDataFrame(rows, "transaction_id long, card_id long, pending_balance double")


def test_balance_grows_by_the_pending_of_the_largest_id(spark):
    cards = t.cards(spark, [t.card(1, balance=10.1), t.card(2, balance=5.0), t.card(3, balance=1.5)])
    rows = pending(spark, [(7, 1, 20.2), (9, 1, -3.3), (8, 1, 99.0), (1, 2, 0.0)])
    got = settle.roll_forward_balances(cards, rows)
    assert {r["card_id"]: r["current_balance"] for r in got.collect()} == {1: 6.8, 2: 5.0, 3: 1.5}
    assert got.columns == cards.columns


def test_balance_through_a_32_bit_float(spark):
    cards = t.cards(spark, [t.card(1, balance=659.26), t.card(2, balance=659.26)])
    got = settle.roll_forward_balances(cards, pending(spark, [(1, 1, 40.45)]), compat_float=True)
    by_card = {r["card_id"]: r["current_balance"] for r in got.collect()}
    assert by_card == {1: 659.260009765625 + 40.45, 2: 659.260009765625}


def scores(spark, cards, customers):
    got = settle.rescore_customers(t.cards(spark, cards), t.customers(spark, customers))
    return {r["customer_id"]: (r["credit_score"], r["credit_score_change"]) for r in got.collect()}


def test_scores(spark):
    cards = [
        t.card(1, 1, 1000.0, 50.0), t.card(2, 1, 1000.0, 150.0),  # 10 percent
        t.card(3, 2, 1000.0, 100.1),
        t.card(4, 3, 1000.0, 700.1),
        t.card(5, 4, 0.0, 0.0),  # no limit at all
        t.card(6, 9, 1000.0, 0.0),  # no such customer
        t.card(7, None, 1000.0, 0.0),
    ]
    customers = [t.customer(i, score=840) for i in (1, 2, 3, 4, 5)]
    assert scores(spark, cards, customers) == {
        1: (855, 15), 2: (850, 10), 3: (815, -25), 4: (840, 0), 5: (840, 0),
    }


def test_no_cards_at_all(spark):
    assert scores(spark, [], [t.customer(1, score=700)]) == {1: (700, 0)}


def test_limits(spark):
    cards = t.cards(
        spark,
        [t.card(1, 1, 1234.56), t.card(2, 2, 1000.0), t.card(3, 3, 1234.56), t.card(4, None, 1.5)],
    )
    customers = spark.createDataFrame(
        [(1, 5), (2, -5), (4, -25)], "customer_id long, credit_score_change int"
    )
    got = settle.adjust_limits(cards, customers)
    limits = {r["card_id"]: r["credit_limit"] for r in got.collect()}
    assert limits == {1: 1234.56, 2: 1000.0, 3: 1234.56, 4: 1.5}
    assert got.columns == cards.columns


def test_dedupe_takes_the_first_arrival(spark):
    rows = [(1, 2, "b"), (1, 1, "a"), (2, 5, "c"), (1, 3, "d")] + [(3, i, str(i)) for i in range(50)]
    df = spark.createDataFrame(rows, "id long, at long, v string").repartition(6)
    got = ledger.dedupe_first(df, "id", [F.col("at")])
    assert sorted(map(tuple, got.collect())) == [(1, 1, "a"), (2, 5, "c"), (3, 0, "0")]


def test_batch_from_end_to_end(spark):
    cards = t.cards(spark, [t.card(1, 1, 1000.0, 100.0), t.card(2, 2, 2000.0, 1500.0)])
    customers = t.customers(spark, [t.customer(1), t.customer(2), t.customer(3)])
    rows = t.transactions(spark, [t.tx(1, 300.0), t.tx(2, 200.0, day=1), t.tx(3, 900.0, card_id=2)])
    stream = stream_transactions(rows, authorize(rows, cards, customers))
    for save in (False, True):
        result = run_batch(stream, cards, customers, save_balances=save)
        assert {r["transaction_id"]: r["status"] for r in result.transactions.collect()} == {
            1: "approved", 2: "approved", 3: "declined",
        }
        assert {r["card_id"]: (r["current_balance"], r["credit_limit"]) for r in result.cards.collect()} == {
            1: (600.0, 900.0), 2: (1500.0, 1700.0),
        }
        assert {r["customer_id"]: r["credit_score"] for r in result.customers.collect()} == {
            1: 585, 2: 575, 3: 600,
        }
        assert result.customers.columns == customers.columns


def test_large_balances_are_summed_like_others(spark):
    """A pending amount on two thousand millions, and a use that is nearly the whole limit."""
    large = [t.card(1, 1, 2e9, 2e9), t.card(2, 1, 100.0, 10.0), t.card(3, 2, 4e12, 3e12)]
    frame = t.cards(spark, large)
    latest = pending(spark, [(5, 1, 100.25)])
    rolled = {r.card_id: r.current_balance for r in settle.roll_forward_balances(frame, latest).collect()}
    assert rolled == {1: 2e9 + 100.25, 2: 10.0, 3: 3e12}
    usage = {r.customer_id: r.usage_percent for r in settle.credit_usage(frame).collect()}
    assert abs(usage[1] - 100 * 2000000010 / 2000000100) < 1e-9 and usage[2] == 75.0


def test_a_payment_on_a_large_limit_is_judged(spark):
    cards = [t.card(1, 1, 2e9, 0.0), t.card(2, 1, 2e9, 2e9)]
    rows = [t.tx(1, 5.0), t.tx(2, 5.0, card_id=2)]
    done = authorize(t.transactions(spark, rows), t.cards(spark, cards), t.customers(spark, [t.customer()]))
    assert t.results(done) == {1: ("pending", None, 500), 2: ("declined", "Total balance exceeds credit limit", 0)}
