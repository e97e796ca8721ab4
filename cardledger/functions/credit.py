"""Credit rules as expressions."""

from pyspark.sql import Column, functions as F

from cardledger.functions import fixed


def utilisation(balance: Column, limit: Column) -> Column:
    """Percent of the limit in use; null where the limit is zero."""
    return F.try_divide(balance, limit) * 100


def score_adjustment(usage: Column) -> Column:
    """Score change for a utilisation in percent; null stays null."""
    bands = F.when(usage.isNull(), F.lit(None).cast("int"))
    for highest, change in fixed.SCORE_BANDS:
        bands = bands.when(usage <= highest, change)
    return bands.otherwise(fixed.SCORE_ABOVE_BANDS)


def adjusted_limit(limit: Column, score_change: Column) -> Column:
    """Cut the limit when the score fell, to whole hundreds (half to even); else keep it as is."""
    factor = F.when(score_change <= fixed.LIMIT_FACTORS[0][0], fixed.LIMIT_FACTORS[0][1])
    for highest, share in fixed.LIMIT_FACTORS[1:]:
        factor = factor.when(score_change <= highest, share)
    factor = factor.otherwise(fixed.LIMIT_FACTOR_SMALL_DROP)
    return F.when(score_change < 0, F.bround(limit * factor, -2)).otherwise(limit)
