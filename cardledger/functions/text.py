"""Text rules: white space, zip codes, blank values, prefixed ids."""

from pyspark.sql import Column, functions as F

from cardledger.functions import fixed


def strip_white_space(c: Column) -> Column:
    # trim() takes off blanks only; btrim with a character list stays in generated code.
    return F.btrim(c, F.lit(fixed.WHITE_SPACE))


def zip_code(c: Column) -> Column:
    return F.right(strip_white_space(c), F.lit(fixed.ZIP_LENGTH))


def same_region(zip_a: Column, zip_b: Column) -> Column:
    """True when both zips are whole and start with the same character; false, never null."""
    whole = (F.length(zip_a) >= fixed.ZIP_LENGTH) & (F.length(zip_b) >= fixed.ZIP_LENGTH)
    return F.coalesce(whole & (F.left(zip_a, F.lit(1)) == F.left(zip_b, F.lit(1))), F.lit(False))


def blank_to_null(c: Column) -> Column:
    return F.when(strip_white_space(c) != "", c)


def numeric_id(c: Column) -> Column:
    """The number of an id that may carry a prefix, as in ``batch:17``."""
    return strip_white_space(F.substring_index(c.cast("string"), ":", -1)).try_cast("long")
