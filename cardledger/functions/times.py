"""Time formats and the arrival day."""

from pyspark.sql import Column, functions as F

from cardledger.functions import fixed


def arrival_day(ts: Column) -> Column:
    """Replay goes day by day; within a day, by transaction_id."""
    return F.to_date(ts)


def parse_message_time(c: Column) -> Column:
    return F.to_timestamp(c, fixed.MESSAGE_TIME)


def message_time(ts: Column) -> Column:
    return F.date_format(ts, fixed.MESSAGE_TIME)


def result_time(ts: Column) -> Column:
    return F.date_format(ts, fixed.RESULT_TIME)
