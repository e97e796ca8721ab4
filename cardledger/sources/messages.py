"""Transactions as JSON messages, one object per message, in Kafka or in files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from cardledger.functions import fixed
from cardledger.functions.text import numeric_id, strip_white_space
from cardledger.operators.hot import find_hot, lookup
from cardledger.operators.running import Measure, running
from cardledger.schemas import TRANSACTIONS
from cardledger.sources.scratch import COMPRESSION

# The order in which a card's messages came: the offset in Kafka, a number in files.
ARRIVAL = "arrival"
# In files: the arrival of the card's message before this one, 0 for the first. Null: not known.
PREVIOUS = "previous"

_JSON = {"timestampFormat": fixed.MESSAGE_TIME, "ignoreNullFields": "false"}


def to_messages(transactions: DataFrame, *more: str) -> DataFrame:
    """Key and value per transaction. Keyed by card, as order matters within a card only."""
    fields = [c for c in transactions.columns if c not in more]
    value = F.to_json(F.struct(*fields), _JSON)
    return transactions.select(F.col("card_id").cast("string").alias("key"), value.alias("value"), *more)


def from_messages(messages: DataFrame, *more: str) -> DataFrame:
    """Decode the column `value`; fields that a message lacks, or that make no sense, are null.

    Fields are read as text first, so that ids and amounts may come as numbers, in quotes, or (ids)
    with a prefix, as in "batch:17".
    """
    text = StructType([StructField(f.name, StringType()) for f in TRANSACTIONS.fields])
    # One row per message, but through explode: filters on fields are not pushed below it, where each
    # mention of a field would parse the message once more.
    parsed = F.from_json(F.col("value").cast("string"), text)
    decoded = messages.select(F.explode(F.array(parsed)).alias("t"), *more)
    return decoded.select(*[_decoded(f).alias(f.name) for f in TRANSACTIONS.fields], *more)


def _decoded(f: StructField) -> Column:
    raw = F.col(f"t.{f.name}")
    if isinstance(f.dataType, LongType):
        return numeric_id(raw)
    if isinstance(f.dataType, TimestampType):
        return F.try_to_timestamp(raw, F.lit(fixed.MESSAGE_TIME))
    return raw if isinstance(f.dataType, StringType) else strip_white_space(raw).try_cast(f.dataType)


def transaction_info(transactions: DataFrame) -> DataFrame:
    """The fields that checking looks at, under the names it uses."""
    return transactions.select(
        F.col("transaction_id").alias("txn_id"),
        "card_id",
        "merchant_name",
        "timestamp",
        "amount",
        "location",
        "transaction_type",
    )


def replay_order() -> list[Column]:
    return [F.to_date("timestamp"), F.col("transaction_id")]


def kafka_options(servers: str, topic: str = fixed.TOPIC, per_trigger: int | None = None) -> dict:
    """Read options: from the earliest offset; `per_trigger` bounds a micro-batch."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }
    return options | ({"maxOffsetsPerTrigger": str(per_trigger)} if per_trigger else {})


def read_kafka(
    spark: SparkSession, servers: str, topic: str = fixed.TOPIC, per_trigger: int | None = 10_000_000
) -> DataFrame:
    """A stream of transactions with their `arrival`. Needs the Kafka connector on the class path.

    All messages of a card are in one partition, whose offsets are their order of arrival.
    """
    stream = spark.readStream.format("kafka").options(**kafka_options(servers, topic, per_trigger))
    return from_messages(stream.load().select("value", F.col("offset").alias(ARRIVAL)), ARRIVAL)


def publish_kafka(transactions: DataFrame, servers: str, topic: str = fixed.TOPIC) -> None:
    """Send all transactions, each card's in replay order within a partition of the topic."""
    placed = transactions.repartition("card_id").sortWithinPartitions(*replay_order())
    to_messages(placed).write.format("kafka").options(
        **{"kafka.bootstrap.servers": servers, "topic": topic}
    ).save()


def read_files(
    spark: SparkSession, path: str, per_trigger: int | None = None, linked: bool = False
) -> DataFrame:
    """A stream of transactions with their `arrival`, from files of messages, oldest file first.

    `linked` adds the message's `key` and `previous`, so that a reader can tell whether messages of the
    card are still to come from other files.
    """
    stream = spark.readStream.schema(f"key string, value string, {ARRIVAL} long, {PREVIOUS} long")
    if per_trigger:
        stream = stream.option("maxFilesPerTrigger", per_trigger)
    return from_messages(stream.parquet(path), ARRIVAL, *(["key", PREVIOUS] if linked else []))


def save_messages(
    transactions: DataFrame, path: str, wave: int = 0, order: Sequence[Column] | None = None
) -> None:
    """Append all transactions as messages, numbered per card in replay order (or `order`).

    A later call has a higher `wave`, so its messages arrive after the earlier ones of the card. How many
    messages of a card a wave has is kept beside the messages (`_sent`, which readers of the folder do
    not see), so that the first message of a wave names the last one before it.
    """
    spark = transactions.sparkSession
    by = {f"_by{i}": c for i, c in enumerate(order or replay_order())}
    hot = find_hot(transactions, "card_id")
    numbered = running(transactions.withColumns(by), "card_id", list(by), {"_number": Measure(F.lit(1))}, hot)
    if wave:
        sent = spark.read.schema("card_id long, last long, wave int").parquet(f"{path}/_sent")
        before = sent.filter(F.col("wave") < wave).groupBy("card_id").agg(F.max("last").alias("_last"))
        # A null card is a group of its own here, and no key of a join.
        without = before.filter(F.col("card_id").isNull()).select(F.col("_last").alias("_last_of_null"))
        numbered = lookup(numbered, before, "card_id", hot).join(F.broadcast(without.limit(1)), F.col("card_id").isNull(), "left")
        last = F.coalesce("_last", "_last_of_null", F.lit(0).cast("long"))
    else:
        last = F.lit(0).cast("long")
    number, first = F.col("_number"), F.lit(wave << 40)
    counted = transactions.groupBy("card_id").agg((first + F.count(F.lit(1))).alias("last"))
    counted.write.mode("overwrite").parquet(f"{path}/_sent/wave={wave}")
    sent = numbered.withColumns(
        {ARRIVAL: first + number, PREVIOUS: F.when(number > 1, first + number - 1).otherwise(last)}
    )
    more = (ARRIVAL, PREVIOUS)
    to_messages(sent.select(*transactions.columns, *more), *more).write.mode("append").parquet(path, compression=COMPRESSION)


def n_sent(spark: SparkSession, path: str) -> int:
    """How many messages `save_messages` has written to `path`, by its own count."""
    sent = spark.read.schema("card_id long, last long, wave long").parquet(f"{path}/_sent")
    return sent.agg(F.sum(F.col("last") - F.col("wave") * F.lit(1 << 40))).first()[0] or 0
