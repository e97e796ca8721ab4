"""Money is summed as whole millionths (BIGINT): exact, and the same in any order.

Six decimal places hold what amount columns hold, so comparisons come out as on the amounts
themselves and nothing is rounded to cents.
"""

from pyspark.sql import Column, functions as F

MICROS = 1_000_000

# Amounts of transactions beyond this are set aside, with the cause. A card's pending balance is a BIGINT
# sum of them, and Spark raises an error where one does not fit (beyond 9 * 10**12).
LARGEST_AMOUNT = 1e9

# Limits and balances of cards: one of them plus an amount fits into a BIGINT.
LARGEST_HELD = 4e12


def fits(amount, largest: float = LARGEST_AMOUNT) -> Column:
    """Whether an amount is a number that can be summed; false for null, NaN and infinity."""
    number = F.coalesce(_col(amount).cast("double"), F.lit(float("nan")))
    return ~F.isnan(number) & (F.abs(number) <= largest)


def to_micros(amount, largest: float = LARGEST_AMOUNT) -> Column:
    """Null where the amount does not fit."""
    return F.when(fits(amount, largest), F.rint(_col(amount).cast("double") * MICROS).cast("long"))


def to_wide_micros(amount) -> Column:
    """As 38 digits, for sums over cards that leave none out: null for null, NaN and infinity only.

    An amount of 10**32 or more is an error, not a null.
    """
    number = _col(amount).cast("double")
    is_number = ~F.isnan(number) & (F.abs(number) < float("inf"))
    return F.when(is_number, F.rint(number * MICROS).cast("decimal(38,0)"))


def from_micros(micros) -> Column:
    return _col(micros).cast("double") / MICROS


def from_wide_micros(micros) -> Column:
    return (_col(micros) / F.lit(MICROS).cast("decimal(7,0)")).cast("double")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c
