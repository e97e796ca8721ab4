"""Table definitions: one StructType and one primary key per table.

Transaction ids are 64 bit, so that tables with more than 2^31 rows load.
"""

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _table(*columns) -> StructType:
    return StructType([StructField(name, kind()) for name, kind in columns])


CREDIT_CARD_TYPES = _table(
    ("card_type_id", IntegerType),
    ("name", StringType),
    ("credit_score_min", IntegerType),
    ("credit_score_max", IntegerType),
    ("credit_limit_min", IntegerType),
    ("credit_limit_max", IntegerType),
    ("annual_fee", IntegerType),
    ("rewards_rate", DoubleType),
)

CUSTOMERS = _table(
    ("customer_id", LongType),
    ("name", StringType),
    ("phone_number", StringType),
    ("address", StringType),
    ("email", StringType),
    ("credit_score", LongType),
    ("annual_income", DoubleType),
)

CARDS = _table(
    ("card_id", LongType),
    ("customer_id", LongType),
    ("card_type_id", IntegerType),
    ("card_number", StringType),
    ("expiration_date", StringType),
    ("credit_limit", DoubleType),
    ("current_balance", DoubleType),
    ("issue_date", DateType),
)

TRANSACTIONS = _table(
    ("transaction_id", LongType),
    ("card_id", LongType),
    ("merchant_name", StringType),
    ("timestamp", TimestampType),
    ("amount", DoubleType),
    ("location", StringType),
    ("transaction_type", StringType),
    ("related_transaction_id", LongType),
)

# The stream result: the time is text, status and pending balance are added.
STREAM_TRANSACTIONS = StructType(
    [
        StructField("timestamp", StringType()) if f.name == "timestamp" else f
        for f in TRANSACTIONS.fields
    ]
    + [StructField("pending_balance", DoubleType()), StructField("status", StringType())]
)

TABLES = {
    "credit_card_types": (CREDIT_CARD_TYPES, "card_type_id"),
    "customers": (CUSTOMERS, "customer_id"),
    "cards": (CARDS, "card_id"),
    "transactions": (TRANSACTIONS, "transaction_id"),
}


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that break the primary key, null included, with their row counts."""
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter((F.col("n_rows") > 1) | F.col(key).isNull())
    )


def require_primary_key(df: DataFrame, key: str) -> DataFrame:
    """Raise when `key` is not unique: a lookup join on it would multiply rows."""
    found = duplicate_keys(df, key).take(5)
    if found:
        raise ValueError(f"{key} is not a primary key, for example {found}")
    return df
