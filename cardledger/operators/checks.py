"""The decline rules. The first rule that fails gives the reason."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cardledger.functions import fixed
from cardledger.functions.money import fits, to_micros
from cardledger.functions.text import same_region, zip_code

# The columns, beside the ids, that `prepare` reads.
READ = ["timestamp", "amount", "location"]

NARROW = ["transaction_id", "card_id", "arrival_day", "amount_micros"]


def prepare(transactions: DataFrame, payload: Sequence[str] = ()) -> DataFrame:
    """`payload` as it is, why the row cannot be checked (null if it can), and what checking needs.

    That is ids, the arrival day, the amount in millionths and the merchant's zip code.
    """
    return transactions.select(
        "transaction_id",
        "card_id",
        F.to_date("timestamp").alias("arrival_day"),
        to_micros("amount").alias("amount_micros"),
        zip_code(F.col("location")).alias("merchant_zip"),
        unfit_cause().alias("aside"),
        *payload,
    )


def unfit_cause() -> Column:
    """Why a row cannot be checked by itself; null if it can."""
    return (
        F.when(F.col("transaction_id").isNull(), fixed.NO_ID)
        .when(F.col("timestamp").isNull(), fixed.NO_TIME)
        .when(F.col("amount").isNull(), fixed.NO_AMOUNT)
        .when(~fits("amount"), fixed.AMOUNT_UNFIT)
    )


def unprocessable(transactions: DataFrame) -> DataFrame:
    """Rows that cannot be checked whatever their card: no id, time or amount that fits."""
    return transactions.filter(unfit_cause().isNotNull())


def card_missing() -> Column:
    return F.col("card_known").isNull()


def over_half_limit() -> Column:
    # amount >= 0.5 * limit.
    return F.col("amount_micros") >= fixed.SINGLE_AMOUNT_SHARE * F.col("limit_micros")


def over_total() -> Column:
    """The total rule without the pending balance."""
    return F.col("amount_micros") + F.col("balance_micros") >= F.col("limit_micros")


def address_missing() -> Column:
    return F.col("home_zip").isNull()


def reason_before_total() -> Column:
    """The rules tried before the total rule."""
    return F.when(card_missing(), fixed.CARD_NOT_FOUND).when(
        over_half_limit(), fixed.OVER_HALF_LIMIT
    )


def reason_after_total() -> Column:
    """The rules tried after the total rule."""
    return (
        F.when(address_missing(), fixed.ADDRESS_NOT_FOUND)
        .when(F.col("merchant_zip").isNull(), fixed.NO_LOCATION)
        .when(~same_region(F.col("home_zip"), F.col("merchant_zip")), fixed.TOO_FAR)
    )


def decline_reason(before: Column, total_fails: Column, after: Column) -> Column:
    """The cascade; null means approved, or set aside."""
    reason = F.coalesce(before, F.when(total_fails, fixed.OVER_TOTAL_LIMIT), after)
    return F.when(F.col("aside").isNull(), reason)


def status(reason: Column) -> Column:
    """Null for rows set aside."""
    verdict = F.when(reason.isNull(), fixed.PENDING).otherwise(fixed.DECLINED)
    return F.when(F.col("aside").isNull(), verdict)
