"""Small hand-made tables, and a plain Python model of what the jobs compute."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from cardledger.schemas import CARDS, CUSTOMERS, TRANSACTIONS

DAY0 = datetime(2024, 1, 1, 9, 30)


def make(spark, schema, rows):
    """Rows as dicts; columns that are left out are null."""
    return spark.createDataFrame([tuple(r.get(c) for c in schema.names) for r in rows], schema)


def cards(spark, rows):
    return make(spark, CARDS, rows)


def customers(spark, rows):
    return make(spark, CUSTOMERS, rows)


def transactions(spark, rows):
    return make(spark, TRANSACTIONS, rows)


def card(card_id=1, customer_id=1, limit=1000.0, balance=0.0):
    return {
        "card_id": card_id,
        "customer_id": customer_id,
        "credit_limit": limit,
        "current_balance": balance,
    }


def customer(customer_id=1, address="1 Elm St, Rye, NY 10580", score=600):
    return {"customer_id": customer_id, "address": address, "credit_score": score}


def tx(transaction_id, amount, card_id=1, day=0, location="Shop 10001", **more):
    return {
        "transaction_id": transaction_id,
        "card_id": card_id,
        "timestamp": DAY0 + timedelta(days=day),
        "amount": amount,
        "location": location,
        "transaction_type": "refund" if amount is not None and amount < 0 else "purchase",
    } | more


def cents(amount):
    return round(amount * 100)


def model(card_rows, customer_rows, tx_rows, running_limit):
    """{transaction_id: (status, reason, pending cents)}, one transaction after the other."""
    by_card = {c["card_id"]: c for c in card_rows}
    homes = {c["customer_id"]: c["address"] for c in customer_rows}
    pending, ids, out = {}, {}, {}
    for t in sorted(tx_rows, key=lambda t: (t["timestamp"].date(), t["transaction_id"])):
        key, amount = t["card_id"], cents(t["amount"])
        held = pending.get(key, 0)
        earlier = min(ids.get(key, [t["transaction_id"]])) < t["transaction_id"]
        counted = held if running_limit and earlier else 0
        reason = _reason(by_card.get(key), homes, t, amount, counted)
        pending[key] = held + (amount if reason is None else 0)
        ids.setdefault(key, []).append(t["transaction_id"])
        out[t["transaction_id"]] = ("declined" if reason else "pending", reason, pending[key])
    return out


def _reason(c, homes, t, amount, counted):
    if c is None:
        return "Card not found"
    limit, balance = cents(c["credit_limit"]), cents(c["current_balance"])
    if 2 * amount >= limit:
        return "Transaction exceeds 50% of credit limit"
    if amount + balance + counted >= limit:
        return "Total balance exceeds credit limit"
    home = homes.get(c["customer_id"])
    if not home:
        return "Customer address not found"
    zips = [home.strip()[-5:], t["location"].strip()[-5:]]
    if min(map(len, zips)) < 5 or zips[0][0] != zips[1][0]:
        return "Merchant location too far"
    return None


def random_tables(seed, n, n_cards=6, hot_share=0.4, days=9, refunds=0.3, limit=2000.0):
    """A card with id 1 holds `hot_share` of the rows."""
    r = random.Random(seed)
    card_rows = [
        card(i, i % 3, limit * (4 if i == 1 else 1), float(r.randint(0, int(limit / 2))))
        for i in range(1, n_cards)
    ]
    customer_rows = [customer(0), customer(1), customer(2, address="2 Oak St, Reno, NV 89501")]
    ids = r.sample(range(1, 50 * n), n)
    tx_rows = []
    for i in ids:
        amount = r.randint(100, int(limit * 60)) / 100
        if r.random() < refunds:
            amount = -amount
        card_id = 1 if r.random() < hot_share else r.randint(1, n_cards)
        location = "Shop " + r.choice(["10001", "19999", "89001", "123"])
        tx_rows.append(tx(i, amount, card_id, r.randint(0, days), location))
    return card_rows, customer_rows, tx_rows


def results(df):
    """Updates as the model gives them."""
    return {
        r["transaction_id"]: (r["status"], r["decline_reason"], cents(r["pending_balance"]))
        for r in df.collect()
    }
