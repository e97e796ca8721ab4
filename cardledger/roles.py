"""The driver's tables in the roles of cards, customers and transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cardledger.operators.hot import find_hot
from cardledger.operators.running import Measure, running


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A card per order. Balances depend on the customer."""
    price, share = F.col("o_totalprice"), F.col("o_custkey") % 20
    return (
        table(spark, sf_dir, "orders")
        .select(
            F.col("o_orderkey").alias("card_id"),
            F.col("o_custkey").alias("customer_id"),
            (F.floor(price / 100) * 100).cast("double").alias("credit_limit"),
            F.floor(price * 0.05 * share).cast("double").alias("current_balance"),
        )
    )


def _zip(nation: str, key: str):
    number = F.col(nation) % 3 * 10000 + F.col(key) % 10000
    return F.lpad(number.cast("string"), 5, "0")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer per customer; every 40th has an empty address."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.when(F.col("c_custkey") % 40 == 7, "")
        .otherwise(F.concat("c_name", F.lit(", NY "), _zip("c_nationkey", "c_custkey")))
        .alias("address"),
        (300 + F.col("c_custkey") % 551).alias("credit_score"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A transaction per line item. Ids number the lines of an order; returns are refunds.

    The transactions of every 50th order are made with a card that nobody has.
    """
    order = [
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate", "l_quantity",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus",
    ]
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", *order)
    numbered = running(
        items,
        "l_orderkey",
        order,
        {"line": Measure(F.lit(1))},
        find_hot(items, "l_orderkey"),
    )
    merchants = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), "s_name", _zip("s_nationkey", "s_suppkey").alias("zip")
    )
    price = F.col("l_extendedprice")
    order_key = F.col("l_orderkey")
    return numbered.join(merchants, "l_suppkey", "left").select(
        (F.col("l_orderkey") * 1000000 + F.col("line")).alias("transaction_id"),
        F.when(order_key % 50 == 0, -1 - order_key).otherwise(order_key).alias("card_id"),
        F.col("s_name").alias("merchant_name"),
        F.col("l_shipdate").cast("timestamp").alias("timestamp"),
        F.when(F.col("l_returnflag") == "R", -price).otherwise(price).alias("amount"),
        F.concat("s_name", F.lit(" "), "zip").alias("location"),
        F.when(F.col("l_returnflag") == "R", "refund").otherwise("purchase").alias("transaction_type"),
    )


CORPORATE_CARD = 1


def corporate_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cards, one of which has a very large limit."""
    is_corporate = F.col("card_id") == CORPORATE_CARD
    return cards(spark, sf_dir).withColumns(
        {
            "credit_limit": F.when(is_corporate, 5e6).otherwise(F.col("credit_limit")),
            "current_balance": F.when(is_corporate, 0.0).otherwise(F.col("current_balance")),
        }
    )


def corporate_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transactions, a third of which are made with one card."""
    card = F.col("card_id")
    return transactions(spark, sf_dir).withColumn(
        "card_id", F.when(card % 3 == 0, F.lit(CORPORATE_CARD)).otherwise(card).cast("long")
    )


def with_resent_refunds(rows: DataFrame) -> DataFrame:
    """The transactions and, a day later, each refund once more with another amount."""
    changed = {"timestamp": F.col("timestamp") + F.expr("interval 1 day"), "amount": F.col("amount") - 1}
    once = F.struct(*rows.columns)
    again = F.struct(*[changed.get(c, F.col(c)).alias(c) for c in rows.columns])
    # Copies of a row are made where it is: the transactions are made once.
    sent = F.when(F.col("transaction_type") == "refund", F.array(once, again)).otherwise(F.array(once))
    return rows.select(F.explode(sent).alias("_sent")).select("_sent.*")
