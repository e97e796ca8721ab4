import pytest
import tables as t

from cardledger.operators.lookup import card_profiles
from cardledger.plans.authorize import authorize, set_aside, stream_table, stream_transactions


def run(spark, cards, customers, rows, running_limit=False, **more):
    return t.results(
        authorize(
            t.transactions(spark, rows), t.cards(spark, cards), t.customers(spark, customers),
            running_limit, **more,
        )
    )


HALF = "Transaction exceeds 50% of credit limit"
TOTAL = "Total balance exceeds credit limit"
HOME = "Customer address not found"
FAR = "Merchant location too far"


@pytest.mark.parametrize("running_limit", [False, True])
@pytest.mark.parametrize(
    "card, customer, tx, want",
    [
        (t.card(), t.customer(), t.tx(1, 500.0), ("declined", HALF, 0)),
        (t.card(), t.customer(), t.tx(1, 499.99), ("pending", None, 49999)),
        (t.card(balance=600.0), t.customer(), t.tx(1, 400.0), ("declined", TOTAL, 0)),
        (t.card(balance=600.0), t.customer(), t.tx(1, 399.99), ("pending", None, 39999)),
        (t.card(), t.customer(), t.tx(1, -50.0), ("pending", None, -5000)),
        (t.card(), t.customer(), t.tx(1, 5.0, card_id=9), ("declined", "Card not found", 0)),
        (t.card(), t.customer(), t.tx(1, 5.0, card_id=None), ("declined", "Card not found", 0)),
        (t.card(customer_id=7), t.customer(), t.tx(1, 5.0), ("declined", HOME, 0)),
        (t.card(customer_id=None), t.customer(), t.tx(1, 5.0), ("declined", HOME, 0)),
        (t.card(), t.customer(address=None), t.tx(1, 5.0), ("declined", HOME, 0)),
        (t.card(), t.customer(address=""), t.tx(1, 5.0), ("declined", HOME, 0)),
        (t.card(), t.customer(address="  "), t.tx(1, 5.0), ("declined", FAR, 0)),
        (t.card(), t.customer(address="NY 1"), t.tx(1, 5.0), ("declined", FAR, 0)),
        (t.card(), t.customer(address="NY 10580\n\t"), t.tx(1, 5.0), ("pending", None, 500)),
        (t.card(), t.customer(), t.tx(1, 5.0, location="Shop 20001"), ("declined", FAR, 0)),
        (t.card(), t.customer(), t.tx(1, 5.0, location="Shop 19579 "), ("pending", None, 500)),
        (
            t.card(), t.customer(), t.tx(1, 5.0, location=None),
            ("declined", "Error extracting zip codes: 'NoneType' object has no attribute 'strip'", 0),
        ),
        (t.card(balance=990.0), t.customer(), t.tx(1, 20.0, location="x"), ("declined", TOTAL, 0)),
        (t.card(balance=990.0), t.customer(address=None), t.tx(1, 20.0), ("declined", TOTAL, 0)),
    ],
)
def test_rules_and_their_order(spark, card, customer, tx, want, running_limit):
    assert run(spark, [card], [customer], [tx], running_limit) == {1: want}


def test_pending_does_not_count_by_default(spark):
    rows = [t.tx(i, 400.0, day=i) for i in (1, 2, 3)]
    got = run(spark, [t.card()], [t.customer()], rows)
    assert got == {i: ("pending", None, 40000 * i) for i in (1, 2, 3)}


def test_pending_counts_with_running_limit(spark):
    rows = [t.tx(i, 400.0, day=i) for i in (1, 2, 3)]
    got = run(spark, [t.card()], [t.customer()], rows, running_limit=True)
    assert got == {
        1: ("pending", None, 40000), 2: ("pending", None, 80000), 3: ("declined", TOTAL, 80000),
    }


def test_pending_counts_only_after_a_smaller_id(spark):
    rows = [t.tx(4 - i, 400.0, day=i) for i in (1, 2, 3)]
    got = run(spark, [t.card()], [t.customer()], rows, running_limit=True)
    assert got == {
        3: ("pending", None, 40000), 2: ("pending", None, 80000), 1: ("pending", None, 120000),
    }


def test_refund_makes_room_under_the_running_limit(spark):
    cards, rows = [t.card(balance=900.0)], [t.tx(1, -400.0, day=1), t.tx(2, 300.0, day=2)]
    assert run(spark, cards, [t.customer()], rows)[2] == ("declined", TOTAL, -40000)
    assert run(spark, cards, [t.customer()], rows, True)[2] == ("pending", None, -10000)


def test_rows_of_one_day_go_by_id(spark):
    rows = [t.tx(i, 400.0) for i in (3, 1, 2)]
    got = run(spark, [t.card()], [t.customer()], rows, True)
    assert [got[i][0] for i in (1, 2, 3)] == ["pending", "pending", "declined"]


def test_rows_without_amount_or_card_limit_are_left_out(spark):
    rows = [t.tx(1, None), t.tx(2, float("nan")), t.tx(3, 5.0, card_id=2), t.tx(4, 5.0)]
    cards = [t.card(), t.card(card_id=2, limit=None)]
    assert set(run(spark, cards, [t.customer()], rows)) == {4}
    args = [t.transactions(spark, rows), t.cards(spark, cards), t.customers(spark, [t.customer()])]
    aside = {r["transaction_id"]: r["cause"] for r in set_aside(*args).collect()}
    assert aside == {
        1: "no amount", 2: "amount is not a number that fits", 3: "card without limit or balance",
    }


@pytest.mark.parametrize("running_limit", [False, True])
def test_huge_amounts_end_no_job(spark, running_limit):
    rows = [t.tx(1, float("inf")), t.tx(2, 1e18), t.tx(3, -1e300), t.tx(4, 5.0)]
    got = run(spark, [t.card()], [t.customer()], rows, running_limit)
    assert got == {4: ("pending", None, 500)}


def test_amounts_are_not_rounded_before_the_rules(spark):
    rows = [t.tx(1, 499.996), t.tx(2, 500.0)]
    got = run(spark, [t.card()], [t.customer()], rows)
    assert [got[i][0] for i in (1, 2)] == ["pending", "declined"]


@pytest.mark.parametrize("running_limit", [False, True])
def test_whole_table_equals_overlay_of_updates(spark, running_limit):
    c, u, x = t.random_tables(12, 200)
    x += [t.tx(None, 5.0), t.tx(10**7, None), t.tx(10**7 + 1, 5.0) | {"timestamp": None}]
    args = [t.transactions(spark, x), t.cards(spark, c), t.customers(spark, u)]
    whole = stream_table(*args, running_limit, hot_rows=60)
    laid = stream_transactions(args[0], authorize(*args, running_limit))
    assert whole.columns == laid.columns
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, laid.collect()))


@pytest.mark.parametrize("running_limit", [False, True])
@pytest.mark.parametrize("seed", [1, 2])
def test_against_model(spark, seed, running_limit):
    c, u, x = t.random_tables(seed, 400)
    assert run(spark, c, u, x, running_limit) == t.model(c, u, x, running_limit)


# hot_rows so small that several cards, and the unknown ones, are split into many pieces.
@pytest.mark.parametrize("running_limit", [False, True])
@pytest.mark.parametrize("seed, hot_rows", [(3, 40), (5, 15), (6, 100)])
def test_split_cards_against_model(spark, seed, hot_rows, running_limit):
    c, u, x = t.random_tables(seed, 500)
    got = run(spark, c, u, x, running_limit, hot_rows=hot_rows)
    assert got == t.model(c, u, x, running_limit)


@pytest.mark.parametrize("running_limit", [False, True])
def test_many_rows_without_card(spark, running_limit):
    c, u, x = t.random_tables(7, 300)
    x = [r | {"card_id": None} if i % 3 == 0 else r for i, r in enumerate(x)]
    x += [t.tx(10**6 + i, 5.0, card_id=0, day=i % 5) for i in range(60)]
    c.append(t.card(0, 1, 300.0))
    got = run(spark, c, u, x, running_limit, hot_rows=30)
    assert got == t.model(c, u, x, running_limit)


def test_input_order_and_partitions_do_not_matter(spark):
    c, u, x = t.random_tables(8, 300)
    shuffled = t.transactions(spark, x[::-1]).repartition(13, "amount")
    got = authorize(shuffled, t.cards(spark, c), t.customers(spark, u), True, hot_rows=50)
    assert t.results(got) == t.model(c, u, x, True)


def test_customer_with_very_many_cards(spark):
    cards = [t.card(i, 1 if i % 2 else i) for i in range(60)]
    customers = [t.customer(i, f"NY 10{i:03}") for i in range(60)]
    got = card_profiles(t.cards(spark, cards), t.customers(spark, customers))
    zips = {r["card_id"]: r["home_zip"] for r in got.collect()}
    assert zips == {i: "10001" if i % 2 else f"10{i:03}" for i in range(60)}


def test_overlay_keeps_rows_that_were_not_streamed(spark):
    rows = [t.tx(1, 400.0), t.tx(2, 600.0), t.tx(3, 10.0)]
    all_rows = t.transactions(spark, rows)
    updates = authorize(
        all_rows.filter("transaction_id < 3"), t.cards(spark, [t.card()]),
        t.customers(spark, [t.customer()]),
    )
    out = stream_transactions(all_rows, updates)
    got = {r["transaction_id"]: (r["status"], r["pending_balance"]) for r in out.collect()}
    assert got == {1: ("pending", 400.0), 2: ("declined", 400.0), 3: ("", 0.0)}
    assert out.columns == all_rows.columns + ["pending_balance", "status"]
    assert out.first()["timestamp"] == "01-01-2024 09:30:00"
