"""Every query: (spark, sf_dir) -> DataFrame, over the driver's tables in their roles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from cardledger import roles
from cardledger.functions import text, times
from cardledger.functions.credit import adjusted_limit, score_adjustment
from cardledger.functions.money import from_micros
from cardledger.operators import checks, ledger, settle
from cardledger.operators.hot import find_hot
from cardledger.operators.lookup import card_profiles
from cardledger.operators.running import Measure, running
from cardledger.plans import authorize as plan
from cardledger.plans.batch import BatchResult, run_batch
from cardledger.plans.increments import NightlyBatch
from cardledger.plans.resume import run_once
from cardledger.plans.whole_run import run_all
from cardledger.schemas import STREAM_TRANSACTIONS, TABLES, TRANSACTIONS, duplicate_keys
from cardledger.sources import files, messages, tables
from cardledger.sources.bucketed import read_bucketed, save_bucketed
from cardledger.sources.published import VersionedStore
from cardledger.sources.scratch import COMPRESSION, saved, scratch_path
from cardledger.streaming.table_state import SpeedLayer
from cardledger.streaming.speed import authorize_stream, run_available, stream_aside

Query = Callable[[SparkSession, str], DataFrame]

# The stream of `overlay_transactions` was stopped on this day.
STREAM_STOPPED = "1999-01-01"

# Small pieces, so that the split of a hot card shows at test scale.
SMALL_HOT_ROWS = 2500

# Buckets of cards that a stream keeps its state in.
STREAM_BUCKETS = 256

# Messages in a file that a stream of scattered messages reads.
STREAM_FILE_ROWS = 1_000_000

# Ids in a folder of the speed layer's tables: those of ten thousand orders.
STREAM_ID_RANGE = 10**10


def _joined(spark: SparkSession, d: str) -> DataFrame:
    tx = roles.transactions(spark, d)
    profiles = card_profiles(roles.cards(spark, d), roles.customers(spark, d))
    rows = plan.enrich(tx, profiles, find_hot(tx, "card_id"))
    return rows.filter(F.col("aside").isNull())


def _updates(spark: SparkSession, d: str, running_limit: bool = False) -> DataFrame:
    return plan.authorize(
        roles.transactions(spark, d), roles.cards(spark, d), roles.customers(spark, d), running_limit
    )


def _stream(spark: SparkSession, d: str) -> DataFrame:
    """All transactions with the stream results."""
    return plan.stream_table(
        roles.transactions(spark, d), roles.cards(spark, d), roles.customers(spark, d)
    )


def _batch(spark: SparkSession, d: str, save_balances: bool = True) -> BatchResult:
    return run_batch(
        _stream(spark, d), roles.cards(spark, d), roles.customers(spark, d), save_balances=save_balances
    )


def blank_to_null(spark, d):
    raw = F.when(
        F.col("transaction_type") == "refund", F.concat(F.lit(" "), F.col("card_id").cast("string"))
    ).otherwise("  ")
    return roles.transactions(spark, d).select(
        "transaction_id",
        text.strip_white_space(text.blank_to_null(raw)).cast("long").alias("related_transaction_id"),
    )


def numeric_id(spark, d):
    name = F.concat(F.lit("batch:"), F.col("transaction_id").cast("string"))
    return roles.transactions(spark, d).select(
        name.alias("prefixed_id"), text.numeric_id(name).alias("id_number")
    )


def replay_order(spark, d):
    """Day by day, and by id within the day: the position of each message in its day."""
    rows = roles.transactions(spark, d).select(
        "transaction_id",
        times.arrival_day(F.col("timestamp")).alias("arrival_day"),
        times.message_time(F.col("timestamp")).alias("message_time"),
    )
    numbered = running(
        rows,
        "arrival_day",
        ["transaction_id"],
        {"position": Measure(F.lit(1))},
        find_hot(rows, "arrival_day"),
    )
    parsed = times.arrival_day(times.parse_message_time(F.col("message_time")))
    return numbered.select(
        "transaction_id",
        F.col("arrival_day").cast("string").alias("arrival_day"),
        parsed.cast("string").alias("parsed_day"),
        "message_time",
        "position",
    )


def json_roundtrip(spark, d):
    sent = messages.to_messages(roles.transactions(spark, d))
    info = messages.transaction_info(messages.from_messages(sent))
    return info.withColumn("timestamp", times.message_time(F.col("timestamp")))


def dedupe_first(spark, d):
    sent = roles.with_resent_refunds(roles.transactions(spark, d))
    first = ledger.dedupe_first(sent, "transaction_id", messages.replay_order())
    return first.select(
        "transaction_id", "card_id", times.message_time(F.col("timestamp")).alias("sent_at"), "amount"
    )


def distinct_count(spark, d):
    sent = roles.with_resent_refunds(roles.transactions(spark, d))
    return ledger.distinct_count(sent, "transaction_id")


def duplicate_ids(spark, d):
    return duplicate_keys(roles.with_resent_refunds(roles.transactions(spark, d)), "transaction_id")


def lookup_join(spark, d):
    return _joined(spark, d).select(
        "transaction_id",
        "card_id",
        "customer_id",
        from_micros("limit_micros").alias("credit_limit"),
        from_micros("balance_micros").alias("current_balance"),
        "home_zip",
    )


def check_single_amount(spark, d):
    return _joined(spark, d).select(
        "transaction_id",
        F.coalesce(checks.reason_before_total(), F.lit("passes")).alias("verdict"),
    )


def check_total_limit(spark, d):
    return _joined(spark, d).select(
        "transaction_id", F.coalesce(checks.over_total(), F.lit(False)).alias("total_fails")
    )


def check_address(spark, d):
    return _joined(spark, d).select(
        "transaction_id", checks.address_missing().alias("address_missing")
    )


def same_region(spark, d):
    return _joined(spark, d).select(
        "transaction_id",
        "merchant_zip",
        "home_zip",
        text.same_region(F.col("home_zip"), F.col("merchant_zip")).alias("same_region"),
    )


def unprocessable(spark, d):
    """Amounts of refunds are lost in two ways; such rows are kept aside."""
    lost = F.when(F.col("transaction_type") != "refund", F.col("amount")).when(
        F.col("card_id") % 2 == 0, F.lit(float("nan"))
    )
    rows = roles.transactions(spark, d).withColumn("amount", lost)
    return checks.unprocessable(rows).select(
        "transaction_id", F.col("amount").isNull().alias("amount_missing")
    )


def validate(spark, d):
    return plan.verdicts(_joined(spark, d)).select(
        "transaction_id", "card_id", "decline_reason", "status"
    )


def earlier_smaller_id(spark, d):
    tx = roles.transactions(spark, d)
    rows = running(
        checks.prepare(tx),
        "card_id",
        plan.ARRIVAL,
        {"_smallest": plan.smallest_measure()},
        find_hot(tx, "card_id"),
    )
    return rows.select("transaction_id", "card_id", plan.has_earlier().alias("has_earlier"))


def running_pending(spark, d):
    return _updates(spark, d)


def authorize_running(spark, d):
    return _updates(spark, d, running_limit=True)


def _corporate(spark, d, running_limit):
    return plan.authorize(
        roles.corporate_transactions(spark, d),
        roles.corporate_cards(spark, d),
        roles.customers(spark, d),
        running_limit,
        hot_rows=SMALL_HOT_ROWS,
    )


def running_pending_hot_card(spark, d):
    return _corporate(spark, d, running_limit=False)


def authorize_running_hot_card(spark, d):
    return _corporate(spark, d, running_limit=True)


def overlay_transactions(spark, d):
    tx = roles.transactions(spark, d)
    streamed = tx.filter(F.col("timestamp") < F.to_timestamp(F.lit(STREAM_STOPPED)))
    updates = plan.authorize(streamed, roles.cards(spark, d), roles.customers(spark, d))
    return plan.stream_transactions(tx, updates).select(
        "transaction_id", "card_id", "timestamp", "amount", "location", "pending_balance", "status"
    )


def format_timestamp(spark, d):
    return roles.transactions(spark, d).select(
        "transaction_id", times.result_time(F.col("timestamp")).alias("timestamp")
    )


def approve_pending(spark, d):
    return ledger.approve_pending(_updates(spark, d)).select(
        "transaction_id", "status", "pending_balance"
    )


def latest_pending(spark, d):
    return ledger.latest_by_key(_updates(spark, d), "card_id", "transaction_id", "pending_balance")


def roll_forward_balances(spark, d):
    return settle.roll_forward_balances(roles.cards(spark, d), _updates(spark, d))


def roll_forward_balances_float(spark, d):
    cards = roles.cards(spark, d).withColumn("current_balance", F.col("current_balance") + 0.37)
    return settle.roll_forward_balances(cards, _updates(spark, d), compat_float=True)


def credit_usage(spark, d):
    return settle.credit_usage(roles.cards(spark, d))


def _large(cards):
    """Limits and balances of some 10**10."""
    return cards.withColumns({c: F.col(c) * 100_000 for c in ("credit_limit", "current_balance")})


def credit_usage_large(spark, d):
    """Sums beyond what amounts of transactions may be: no card is left out."""
    return settle.credit_usage(_large(roles.cards(spark, d)))


def roll_forward_balances_large(spark, d):
    return settle.roll_forward_balances(_large(roles.cards(spark, d)), _updates(spark, d))


def validate_large(spark, d):
    """Cards with large limits: judged like all others."""
    tx = roles.transactions(spark, d).withColumn("amount", F.col("amount") * 5000)
    return plan.authorize(tx, _large(roles.cards(spark, d)), roles.customers(spark, d)).select(
        "transaction_id", "card_id", "status", "decline_reason"
    )


def score_changes(spark, d):
    return settle.score_changes(roles.cards(spark, d), roles.customers(spark, d))


def rescore_customers(spark, d):
    return settle.rescore_customers(roles.cards(spark, d), roles.customers(spark, d))


def score_bands(spark, d):
    """The bands over many utilisations, their edges included."""
    usage = (F.col("card_id") % 1601).cast("double") / 20
    return roles.cards(spark, d).select(
        "card_id", score_adjustment(usage).alias("credit_score_change")
    )


def limit_cuts(spark, d):
    """Every score change on every limit."""
    change = (F.col("card_id") % 9 * 5 - 25).cast("int")
    return roles.cards(spark, d).select(
        "card_id",
        change.alias("credit_score_change"),
        adjusted_limit(F.col("credit_limit"), change).alias("credit_limit"),
    )


def adjust_limits(spark, d):
    cards, customers = roles.cards(spark, d), roles.customers(spark, d)
    return settle.adjust_limits(cards, settle.rescore_customers(cards, customers))


def batch_transactions(spark, d):
    return _batch(spark, d, save_balances=False).transactions.select(
        "transaction_id", "card_id", "timestamp", "amount", "status", "pending_balance"
    )


def batch_cards(spark, d):
    return _batch(spark, d).cards


def batch_customers(spark, d):
    return _batch(spark, d).customers


def quarantine(spark, d):
    """Transactions and cards damaged in every way: what is set aside, with the cause."""
    tx, kind = roles.transactions(spark, d), F.col("transaction_id") % 13
    damaged = tx.select(
        F.when(kind != 1, F.col("transaction_id")).alias("transaction_id"),
        "card_id",
        "merchant_name",
        F.when(kind != 2, F.col("timestamp")).alias("timestamp"),
        F.when(kind == 4, F.lit(float("nan")))
        .when(kind == 5, F.lit(float("inf")))
        .when(kind == 6, F.lit(1e18))
        .when(kind != 3, F.col("amount"))
        .alias("amount"),
        "location",
    )
    limit = F.when(F.col("card_id") % 7 != 0, F.col("credit_limit"))
    cards = roles.cards(spark, d).withColumn("credit_limit", limit)
    aside = plan.set_aside(damaged, cards, roles.customers(spark, d))
    return aside.select("card_id", "merchant_name", "cause")


def _made(spark, d):
    """The transactions, made once for all that read them."""
    return saved(roles.transactions(spark, d), "transactions")


def _sent(spark, tx, order=None):
    """All transactions as messages, then the refunds again with another amount."""
    path = scratch_path(spark, "messages")
    _send(tx, path, order)
    return messages.read_files(spark, path)


def _send(tx, path, order=None):
    again = tx.filter(F.col("transaction_type") == "refund").withColumn("amount", F.col("amount") - 1)
    messages.save_messages(tx, path, order=order)
    messages.save_messages(again, path, wave=1, order=order)


def _streamed(spark, d, tx, running_limit, order=None):
    """The updates that a stream of the messages gives: the first copy of each transaction counts."""
    profiles = saved(card_profiles(roles.cards(spark, d), roles.customers(spark, d)), "profiles")
    updates = authorize_stream(_sent(spark, tx, order), profiles, running_limit, buckets=STREAM_BUCKETS)
    work = scratch_path(spark, "stream")
    return run_available(updates, f"{work}/updates", f"{work}/checkpoint")


def stream_authorize(spark, d):
    return _streamed(spark, d, _made(spark, d), running_limit=False)


def stream_authorize_running(spark, d):
    return _streamed(spark, d, _made(spark, d), running_limit=True)


def stream_restarted(spark, d):
    """A stream that is stopped and goes on from its checkpoint: resent refunds are known as copies."""
    tx, path, work = _made(spark, d), scratch_path(spark, "messages"), scratch_path(spark, "stream")
    profiles = saved(card_profiles(roles.cards(spark, d), roles.customers(spark, d)), "profiles")
    again = tx.filter(F.col("transaction_type") == "refund").withColumn("amount", F.col("amount") - 1)
    for wave, rows in enumerate((tx, again)):
        messages.save_messages(rows, path, wave=wave)
        updates = authorize_stream(messages.read_files(spark, path), profiles, buckets=STREAM_BUCKETS)
        out = run_available(updates, f"{work}/updates", f"{work}/checkpoint")
    return out


def stream_bucketed(spark, d):
    """The speed layer with profiles stored in buckets by card, once for all micro-batches."""
    path, stored = scratch_path(spark, "messages"), scratch_path(spark, "profiles")
    _send(_made(spark, d), path)
    save_bucketed(card_profiles(roles.cards(spark, d), roles.customers(spark, d)), stored, "card_id")
    layer = SpeedLayer(
        spark, scratch_path(spark, "speed"), read_bucketed(spark, stored), running_limit=True, id_range=STREAM_ID_RANGE
    )
    layer.run(_scattered(spark, path), scratch_path(spark, "checkpoint"))
    layer.reconcile(messages.n_sent(spark, path))
    return layer.updates()


def stream_out_of_order(spark, d):
    """Messages that come in another order than that of days and ids: verdicts go by arrival."""
    mixed = [F.col("transaction_id") % 7, F.col("transaction_id")]
    return _streamed(spark, d, _made(spark, d), running_limit=True, order=mixed)


def stream_merged(spark, d):
    """All transactions with the results of the stream over them."""
    tx = _made(spark, d)
    merged = plan.stream_transactions(tx, _streamed(spark, d, tx, False))
    return merged.select(
        "transaction_id", "card_id", "timestamp", "amount", "location", "pending_balance", "status"
    )


def _scattered(spark, path):
    """The messages in other files, so that a card's messages lie in all of them, in no order.

    Each of two triggers takes half of the files, of which there are more where there are more messages.
    """
    per_trigger = max(1, -(-messages.n_sent(spark, path) // (2 * STREAM_FILE_ROWS)))
    schema = f"key string, value string, {messages.ARRIVAL} long, {messages.PREVIOUS} long"
    other = scratch_path(spark, "scattered")
    spark.read.schema(schema).parquet(path).repartition(2 * per_trigger).write.parquet(other, compression=COMPRESSION)
    return messages.read_files(spark, other, per_trigger, linked=True)


def stream_hot_card(spark, d):
    """A card with a third of all messages, over several files and triggers, folded in chunks."""
    path = scratch_path(spark, "messages")
    messages.save_messages(saved(roles.corporate_transactions(spark, d), "transactions"), path)
    profiles = saved(card_profiles(roles.corporate_cards(spark, d), roles.customers(spark, d)), "profiles")
    layer = SpeedLayer(
        spark, scratch_path(spark, "speed"), profiles, True, hot_rows=SMALL_HOT_ROWS, id_range=STREAM_ID_RANGE
    )
    layer.run(_scattered(spark, path), scratch_path(spark, "checkpoint"))
    layer.reconcile(messages.n_sent(spark, path))
    return layer.updates()


def stream_table(spark, d):
    """All transactions, which the stream itself lays its results over; refunds are sent twice."""
    tx, path = _made(spark, d), scratch_path(spark, "messages")
    _send(tx, path)
    profiles = saved(card_profiles(roles.cards(spark, d), roles.customers(spark, d)), "profiles")
    layer = SpeedLayer(spark, scratch_path(spark, "speed"), profiles, id_range=STREAM_ID_RANGE)
    layer.start(tx)
    layer.run(_scattered(spark, path), scratch_path(spark, "checkpoint"))
    layer.reconcile(messages.n_sent(spark, path))
    return layer.merged().select(
        "transaction_id", "card_id", "timestamp", "amount", "location", "pending_balance", "status"
    )


def stream_counts(spark, d):
    """The speed layer's own account of a run: messages got, copies, set aside, and verdicts."""
    tx, path = _made(spark, d), scratch_path(spark, "messages")
    damaged = F.when(F.col("transaction_id") % 11 != 0, F.col("amount"))
    _send(tx.withColumn("amount", damaged), path)
    profiles = saved(card_profiles(roles.cards(spark, d), roles.customers(spark, d)), "profiles")
    layer = SpeedLayer(spark, scratch_path(spark, "speed"), profiles, id_range=STREAM_ID_RANGE)
    layer.run(_scattered(spark, path), scratch_path(spark, "checkpoint"))
    layer.reconcile(messages.n_sent(spark, path))
    return layer.ledger.read().agg(*[F.sum(c).alias(f"n_{c}") for c in ("got", "aside", "copies", "checked")])


def stream_quarantine(spark, d):
    """Messages with ids and amounts as text, some of which make no sense: what the stream sets aside."""
    path = scratch_path(spark, "messages")
    kind, quoted = F.col("transaction_id") % 5, F.col("amount").cast("string")
    sent = roles.transactions(spark, d).select(
        F.when(kind == 0, "none").otherwise(F.concat(F.lit("batch:"), "transaction_id")).alias("transaction_id"),
        F.col("card_id").cast("string").alias("card_id"),
        "merchant_name",
        "timestamp",
        F.when(kind == 1, "a lot").when(kind == 2, "Infinity").otherwise(quoted).alias("amount"),
        "location",
        F.lit(1).cast("long").alias(messages.ARRIVAL),
    )
    messages.to_messages(sent, messages.ARRIVAL).write.parquet(path)
    profiles = saved(card_profiles(roles.cards(spark, d), roles.customers(spark, d)), "profiles")
    aside = stream_aside(messages.read_files(spark, path), profiles)
    work = scratch_path(spark, "stream")
    return run_available(aside, f"{work}/aside", f"{work}/checkpoint").select(
        "transaction_id", "card_id", "amount", "cause"
    )


def _nightly(spark, d):
    """The stream results, taken in over three nights: a third of the transactions each, by their ids."""
    rows, written, folder = _stream(spark, d), scratch_path(spark, "stream"), scratch_path(spark, "nights")
    batch = NightlyBatch(spark, scratch_path(spark, "account"), rows.schema)
    batch.open(roles.cards(spark, d), roles.customers(spark, d))
    by_night = rows.withColumn("night", F.col("transaction_id") % 3).write.partitionBy("night")
    by_night.parquet(written, compression=COMPRESSION)
    for night in range(3):
        # Written once; a night's files come into the folder that the batch reads when it is that night.
        files.move_folder(spark, f"{written}/night={night}", f"{folder}/{night}")
        batch.take_in(f"{folder}/*")
    return batch.result()


def nightly_transactions(spark, d):
    """All transactions as approved over three nights."""
    return _nightly(spark, d).transactions.select(
        "transaction_id", "card_id", "timestamp", "amount", "pending_balance", "status"
    )


def nightly_cards(spark, d):
    """The cards after three nights, each of which has read its new transactions only."""
    return _nightly(spark, d).cards


def nightly_customers(spark, d):
    return _nightly(spark, d).customers


def _store(spark, d, transactions=roles.transactions):
    """The four tables in a parquet store; columns that the roles lack are null."""
    return _fill(tables.ParquetStore(spark, scratch_path(spark, "store")), spark, d, transactions)


def _fill(store, spark, d, transactions=roles.transactions):
    types = roles.table(spark, d, "region").select(
        F.col("r_regionkey").cast("int").alias("card_type_id"), F.col("r_name").alias("name")
    )
    found = {
        "credit_card_types": types,
        "customers": roles.customers(spark, d),
        "cards": roles.cards(spark, d),
        "transactions": transactions(spark, d),
    }
    for name, df in found.items():
        columns = [
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in TABLES[name][0].fields
        ]
        store.write(df.select(*columns), name)
    return store


def whole_run_cards(spark, d):
    """From stored tables to published ones: the cards as published."""
    store = _store(spark, d)
    run_all(store, scratch_path(spark, "results"))
    return store.read("cards").select("card_id", "customer_id", "credit_limit", "current_balance")


def whole_run_customers(spark, d):
    """The customers as published, after a run with the float cast and copies of transactions."""
    store = _store(spark, d, lambda *a: roles.with_resent_refunds(roles.transactions(*a)))
    run_all(store, scratch_path(spark, "results"), compat_float=True, dedupe=True)
    return store.read("customers").select("customer_id", "name", "address", "credit_score")


def sorted_results(spark, d):
    """The result files of a whole run: how many rows, and how many out of the order of their ids."""
    results = scratch_path(spark, "results")
    run_all(_store(spark, d), results)
    written = {
        "stream_transactions": (STREAM_TRANSACTIONS, "transaction_id"),
        "batch_transactions": (STREAM_TRANSACTIONS, "transaction_id"),
        "cards_updated": (TABLES["cards"][0], "card_id"),
        "customers_updated": (TABLES["customers"][0], "customer_id"),
    }
    reports = None
    for name, (schema, key) in written.items():
        report = tables.sorted_report(spark, f"{results}/{name}", schema, key).withColumn("result", F.lit(name))
        reports = report if reports is None else reports.union(report)
    return reports


def published_together(spark, d):
    """Cards with the scores of their customers, from one version of both, published by a run that happens once."""
    store = _fill(VersionedStore(spark, scratch_path(spark, "store")), spark, d)
    results, work = scratch_path(spark, "results"), scratch_path(spark, "work")
    for _ in range(2):
        run_once(store, results, work, "day 1")
    scores = store.read("customers").select("customer_id", "credit_score")
    return store.read("cards").join(scores, "customer_id", "left").select(
        "card_id", "customer_id", "credit_limit", "current_balance", "credit_score"
    )


def load_and_publish(spark, d):
    """Customers with line breaks and empty text, from a CSV file into a store and published again."""
    store, path = _store(spark, d), scratch_path(spark, "csv")
    named = F.concat("name", F.when(F.col("customer_id") % 3 == 0, '\n"second", line').otherwise(""))
    tables.save_csv(roles.customers(spark, d).withColumn("name", named), path)
    loaded, _ = tables.load_table(store, path, "customers")
    tables.publish_serving(store, store.read("cards"), loaded)
    return store.read("customers").select("customer_id", "name", "address", "credit_score")


def csv_line_breaks(spark, d):
    """Typed result files whose text holds line breaks and quotes, read back by splits."""
    path = scratch_path(spark, "csv")
    broken = F.concat("merchant_name", F.when(F.col("transaction_id") % 5 == 0, '\n"a, b"\n').otherwise(""))
    rows = _stream(spark, d).select(
        "transaction_id", "card_id", broken.alias("merchant_name"), "timestamp", "amount", "pending_balance", "status"
    )
    tables.save_csv(rows, path)
    return tables.read_typed_csv(spark, path, rows.schema)


def csv_roundtrip(spark, d):
    path = scratch_path(spark, "csv")
    tables.save_csv(roles.customers(spark, d), path)
    schema = StructType(
        [
            StructField("customer_id", LongType()),
            StructField("name", StringType()),
            StructField("address", StringType()),
            StructField("credit_score", LongType()),
            StructField("annual_income", DoubleType()),
        ]
    )
    return tables.read_csv(spark, path, schema)


def _damaged_csv(spark, d):
    """Refunds are written with a field too many, small purchases with one too few."""
    path = scratch_path(spark, "csv")
    names = ["transaction_id", "card_id", "merchant_name", "transaction_type"]
    refund = F.col("transaction_type") == "refund"
    line = F.concat_ws(
        ",",
        *names[:-1],
        F.when(refund | (F.col("amount") >= 20000), F.col("transaction_type")),
        F.when(refund, "extra"),
    )
    # One column, and a separator that does not occur, so that lines are written as they are.
    roles.transactions(spark, d).select(line.alias(",".join(names))).write.csv(
        path, header=True, sep="\x01"
    )
    return path, StructType([TRANSACTIONS[c] for c in names])


def csv_skip_bad_rows(spark, d):
    return tables.read_csv(spark, *_damaged_csv(spark, d))


def csv_skipped_lines(spark, d):
    return tables.skipped_lines(spark, *_damaged_csv(spark, d))


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in [
        blank_to_null,
        numeric_id,
        replay_order,
        json_roundtrip,
        dedupe_first,
        distinct_count,
        duplicate_ids,
        lookup_join,
        check_single_amount,
        check_total_limit,
        check_address,
        same_region,
        unprocessable,
        validate,
        earlier_smaller_id,
        running_pending,
        running_pending_hot_card,
        authorize_running,
        authorize_running_hot_card,
        overlay_transactions,
        format_timestamp,
        approve_pending,
        latest_pending,
        roll_forward_balances,
        roll_forward_balances_float,
        credit_usage,
        credit_usage_large,
        roll_forward_balances_large,
        validate_large,
        score_changes,
        score_bands,
        rescore_customers,
        limit_cuts,
        adjust_limits,
        batch_transactions,
        batch_cards,
        batch_customers,
        stream_authorize,
        stream_authorize_running,
        stream_out_of_order,
        stream_restarted,
        stream_bucketed,
        stream_merged,
        stream_quarantine,
        stream_hot_card,
        stream_table,
        stream_counts,
        quarantine,
        whole_run_cards,
        whole_run_customers,
        nightly_transactions,
        nightly_cards,
        nightly_customers,
        published_together,
        sorted_results,
        load_and_publish,
        csv_line_breaks,
        csv_roundtrip,
        csv_skip_bad_rows,
        csv_skipped_lines,
    ]
}
