"""The speed layer on bounded input: check transactions and keep the pending balance per card.

Every row goes through one shuffle, by card, with the columns the caller wants to keep, and comes out
with its verdict: a table that is checked as a whole is not joined to its own results. Rows that
cannot be checked come out too, with the cause; nothing is dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cardledger.functions import fixed
from cardledger.functions.money import from_micros
from cardledger.functions.times import result_time
from cardledger.operators import checks
from cardledger.operators.fold import fold_by_card, fold_by_chunk
from cardledger.operators.hot import HOT_ROWS, find_hot, lookup, of_hot_keys, piece_rows, split
from cardledger.operators.ledger import overlay, with_stream_defaults
from cardledger.operators.lookup import card_profiles
from cardledger.operators.running import Measure, n_ranges, running_by_key, running_by_range

ARRIVAL = ["arrival_day", "transaction_id"]

# What the fold passes on: why a row is aside, and the reasons of the rules around the total rule.
FOLD_KEEPS = ["transaction_id", "card_id", "aside", "_before", "_after"]

UPDATE = ["transaction_id", "card_id", "status", "decline_reason", "pending_balance"]


def enrich(
    transactions: DataFrame,
    profiles: DataFrame,
    hot: DataFrame | None = None,
    payload: Sequence[str] = (),
) -> DataFrame:
    """All transactions, narrow, with the data of their card, and why a row is set aside."""
    if set(checks.READ) <= set(payload):  # what is made of these columns need not travel beside them
        data = [c for c in profiles.columns if c != "card_id"]
        rows = transactions.select("transaction_id", "card_id", *payload)
        joined = checks.prepare(lookup(rows, profiles, "card_id", hot), [*payload, *data])
    else:
        joined = lookup(checks.prepare(transactions, payload), profiles, "card_id", hot)
    known = F.col("card_known").isNotNull()
    lacks = known & (F.col("limit_micros").isNull() | F.col("balance_micros").isNull())
    return joined.withColumn("aside", F.coalesce("aside", F.when(lacks, fixed.CARD_WITHOUT_LIMIT)))


def verdicts(enriched: DataFrame, payload: Sequence[str] = ()) -> DataFrame:
    """Verdict per transaction, each on its own: the pending balance does not count."""
    reason = checks.decline_reason(
        checks.reason_before_total(), checks.over_total(), checks.reason_after_total()
    )
    return enriched.select(
        *checks.NARROW,
        *payload,
        "aside",
        reason.alias("decline_reason"),
        checks.status(reason).alias("status"),
    )


def pending_measure() -> Measure:
    """The approved amounts up to and with the row."""
    return Measure(F.when(F.col("status") == fixed.PENDING, F.col("amount_micros")).otherwise(0))


def smallest_measure() -> Measure:
    """The smallest id before the row."""
    checked_id = F.when(F.col("aside").isNull(), F.col("transaction_id"))
    return Measure(checked_id, "min", inclusive=False)


def has_earlier() -> Column:
    """Whether an earlier transaction of the card has a smaller id."""
    return F.coalesce(F.col("_smallest") < F.col("transaction_id"), F.lit(False))


def checked(
    transactions: DataFrame,
    cards: DataFrame,
    customers: DataFrame,
    running_limit: bool = False,
    hot_rows: int = HOT_ROWS,
    payload: Sequence[str] = (),
    may_be_hot: bool = True,
) -> DataFrame:
    """Every transaction with `payload`, `aside` (null, or why it is not checked), status, decline
    reason, and the pending balance of the card after it.

    Transaction ids must be unique (see `dedupe_first`), cards too. With `running_limit` the pending
    balance counts towards the limit; without it each verdict stands on its own. Each row is
    shuffled once, by card; the rows of cards with more than `hot_rows` rows by ranges of arrival. Who
    knows that there are no such cards says so with `may_be_hot`: then the transactions are read once.
    """
    profiles = card_profiles(cards, customers)
    hot = find_hot(transactions, "card_id", hot_rows) if may_be_hot else None
    if hot is None:
        return finished(_by_card(enrich(transactions, profiles, None, payload), running_limit, payload), payload)

    ordinary, busy = split(transactions, "card_id", hot)
    done = _by_card(enrich(ordinary, profiles, None, payload), running_limit, payload)
    rows = enrich(busy, of_hot_keys(profiles, "card_id", hot), None, payload)
    if running_limit:
        measures = {"_smallest": smallest_measure(), "position": Measure(F.lit(1))}
        guarded = running_by_range(
            for_fold(rows, payload), "card_id", ARRIVAL, measures, n_ranges(hot)
        ).withColumn("_guard", has_earlier())
        split_done = fold_by_chunk(guarded, [*FOLD_KEEPS, *payload], ARRIVAL, piece_rows(hot)[1])
    else:
        split_done = running_by_range(
            verdicts(rows, payload), "card_id", ARRIVAL, {"pending_micros": pending_measure()}, n_ranges(hot)
        )
    return finished(done, payload).unionByName(finished(split_done, payload))


def authorize(
    transactions: DataFrame,
    cards: DataFrame,
    customers: DataFrame,
    running_limit: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One update per transaction that can be checked. `set_aside` has the others."""
    rows = checked(transactions, cards, customers, running_limit, hot_rows)
    return rows.filter(F.col("aside").isNull()).select(UPDATE)


def set_aside(transactions: DataFrame, cards: DataFrame, customers: DataFrame) -> DataFrame:
    """The transactions that `authorize` cannot check, with the cause."""
    profiles = card_profiles(cards, customers)
    rows = enrich(transactions, profiles, find_hot(transactions, "card_id"), _rest(transactions))
    return rows.filter(F.col("aside").isNotNull()).select(*transactions.columns, F.col("aside").alias("cause"))


def stream_table(
    transactions: DataFrame,
    cards: DataFrame,
    customers: DataFrame,
    running_limit: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """All transactions with their verdict; what `stream_transactions` gives, without a join."""
    rows = checked_whole(transactions, cards, customers, running_limit, hot_rows)
    return as_stream(rows, transactions.columns)


def checked_whole(
    transactions: DataFrame,
    cards: DataFrame,
    customers: DataFrame,
    running_limit: bool = False,
    hot_rows: int = HOT_ROWS,
    may_be_hot: bool = True,
) -> DataFrame:
    """`checked` with all columns of the transactions: saved, it gives `as_stream` and `as_aside`."""
    return checked(transactions, cards, customers, running_limit, hot_rows, _rest(transactions), may_be_hot)


def as_stream(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The transactions (their `columns`) with their verdict, out of `checked_whole`."""
    done = rows.withColumns(
        {
            "pending_balance": F.when(F.col("aside").isNull(), F.col("pending_balance")).otherwise(0.0),
            "status": F.coalesce("status", F.lit(fixed.NEVER_STREAMED)),
            "timestamp": result_time(F.col("timestamp")),
        }
    )
    return done.select(*columns, "pending_balance", "status")


def as_aside(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The transactions that are not checked, with the cause, out of `checked_whole`."""
    return rows.filter(F.col("aside").isNotNull()).select(*columns, F.col("aside").alias("cause"))


def _rest(transactions: DataFrame) -> list[str]:
    return [c for c in transactions.columns if c not in ("transaction_id", "card_id")]


def for_fold(enriched: DataFrame, payload: Sequence[str] = (), more: Sequence[Column] = ()) -> DataFrame:
    before, after = checks.reason_before_total(), checks.reason_after_total()
    return enriched.select(
        "transaction_id",
        "card_id",
        "arrival_day",
        # Rows set aside change nothing.
        F.when(F.col("aside").isNull(), F.col("amount_micros")).otherwise(0).alias("amount_micros"),
        # Unknown cards have no limit; their rows are never open.
        F.coalesce(F.col("limit_micros") - F.col("balance_micros"), F.lit(0)).alias("_room"),
        "aside",
        before.alias("_before"),
        after.alias("_after"),
        (F.col("aside").isNull() & before.isNull() & after.isNull()).alias("_open"),
        *payload,
        *more,
    )


def _by_card(enriched: DataFrame, running_limit: bool, payload: Sequence[str]) -> DataFrame:
    if not running_limit:
        return running_by_key(
            verdicts(enriched, payload), "card_id", ARRIVAL, {"pending_micros": pending_measure()}
        )
    guarded = running_by_key(
        for_fold(enriched, payload), "card_id", ARRIVAL, {"_smallest": smallest_measure()}
    ).withColumn("_guard", has_earlier())
    return fold_by_card(guarded, [*FOLD_KEEPS, *payload], ARRIVAL)


def finished(done: DataFrame, payload: Sequence[str] = ()) -> DataFrame:
    if "total_fails" in done.columns:
        reason = checks.decline_reason(F.col("_before"), F.col("total_fails"), F.col("_after"))
        done = done.withColumns({"decline_reason": reason, "status": checks.status(reason)})
    return done.select(
        "transaction_id",
        "card_id",
        *payload,
        "aside",
        "status",
        "decline_reason",
        from_micros("pending_micros").alias("pending_balance"),
    )


def as_updates(done: DataFrame) -> DataFrame:
    return finished(done).select(UPDATE)


def stream_transactions(transactions: DataFrame, updates: DataFrame) -> DataFrame:
    """All transactions with results laid over them that came from elsewhere; the time becomes text."""
    merged = overlay(
        with_stream_defaults(transactions), updates, "transaction_id", ["pending_balance", "status"]
    )
    return merged.withColumn("timestamp", result_time(F.col("timestamp")))
