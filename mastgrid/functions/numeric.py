"""Rounding rules. All are plain arithmetic, so they stay inside generated code.

``F.round`` on a double goes through BigDecimal for every row, tens of times the cost.
"""
from pyspark.sql import functions as F


def to_int_half_up(x):
    """Nearest integer, halves away from zero; NULL for NaN and out-of-range values."""
    whole = x.try_cast("int")
    rest = x - whole
    return whole + F.when(rest >= 0.5, 1).when(rest <= -0.5, -1).otherwise(0)


def to_int_half_even(x):
    """Nearest integer, halves to the even one; NULL for NaN and out-of-range values."""
    return F.rint(x).try_cast("int")


def round_half_even(x, digits):
    """Round as Python's ``round(x, digits)`` does: on the double's exact value, ties to even.

    ``x * 10**digits`` may itself be rounded onto a tie, so its rounding error (Dekker's
    product) decides which side of the tie the exact value lies on.
    """
    scale = 10.0**digits
    product = x * scale
    split = x * 134217729.0
    high = split - (split - x)
    error = (high * scale - product) + (x - high) * scale
    below = F.floor(product).cast("double")
    tie = product - below == 0.5
    nearest = (
        F.when(tie & (error > 0), below + 1.0)
        .when(tie & (error < 0), below)
        .otherwise(F.rint(product))
    )
    return nearest / scale


def clip(x, low, high):
    return F.least(F.greatest(x, F.lit(float(low))), F.lit(float(high)))
