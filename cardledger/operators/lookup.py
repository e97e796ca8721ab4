"""Card and customer data that a transaction is checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cardledger.functions.money import LARGEST_HELD, to_micros
from cardledger.functions.text import zip_code


def card_profiles(cards: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per card: limit and balance in millionths, and the zip code of its customer.

    `home_zip` is null when there is no customer or no address. Cards are joined to customers here,
    once per card and not once per transaction.
    """
    homes = customers.select(
        "customer_id",
        F.when(F.col("address") != "", zip_code(F.col("address"))).alias("home_zip"),
    )
    narrow = cards.select(
        "card_id",
        "customer_id",
        to_micros("credit_limit", LARGEST_HELD).alias("limit_micros"),
        to_micros("current_balance", LARGEST_HELD).alias("balance_micros"),
    )
    # One row per customer on the right: a customer with very many cards is a skew that the join splits.
    return narrow.join(homes, "customer_id", "left").select(
        "card_id",
        "customer_id",
        "limit_micros",
        "balance_micros",
        "home_zip",
        F.lit(True).alias("card_known"),
    )
