"""Number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skytally.constants import FEET_PER_METRE, KNOTS_PER_METRE_SECOND


def nan_to_null(col: Column) -> Column:
    return F.nanvl(col, F.lit(None).cast("double"))


def to_double(text: Column) -> Column:
    """Text to double, NULL when it is not a plain decimal number.

    Java reads more than that as a number: type letters ("3d"), hexadecimal ("0x1p3"), words for infinity.
    """
    return F.when(text.rlike(r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"), nan_to_null(text.try_cast("double")))


def to_exact_decimal(col: Column) -> Column:
    """Shortest decimal text of a number as an exact decimal.

    NULL for NaN and for what 20 digits before and 18 behind the point cannot hold: a number is kept whole or not
    at all (see ``sources.quarantine.inexact``).
    """
    value = nan_to_null(col.cast("double"))
    exact = value.cast("string").try_cast("decimal(38,18)")
    return F.when(exact.cast("double") == value, exact)


def metres_to_feet(col: Column) -> Column:
    return col * F.lit(FEET_PER_METRE)


def metres_per_second_to_knots(col: Column) -> Column:
    return col * F.lit(KNOTS_PER_METRE_SECOND)
