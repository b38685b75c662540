"""Measures that read the same from tower rows and from a summary of them.

A summary (``plans.summary``) holds one row per fine-grained group with its tower count and
its sums. Operators written with these measures accept either table, so a report scans the
towers once and works on the summary after that.
"""
from pyspark.sql import functions as F


def is_summary(df):
    return {"tower_count", "range_sum", "samples_sum"} <= set(df.columns)


def tower_count(df):
    return (F.sum("tower_count") if is_summary(df) else F.count(F.lit(1))).alias("tower_count")


def total(df, name):
    return F.sum(f"{name}_sum" if is_summary(df) else name)


def mean(df, name):
    if is_summary(df):
        return F.try_divide(F.sum(f"{name}_sum"), F.sum(f"{name}_n"))
    return F.avg(name)


def lowest(df, name):
    return F.min(f"{name}_min" if is_summary(df) else name)


def highest(df, name):
    return F.max(f"{name}_max" if is_summary(df) else name)


def spread(df, name):
    """Sample standard deviation, NULL for one value."""
    if not is_summary(df):
        return F.stddev(name)
    sums = [F.sum(f"{name}_{part}") for part in ("n", "sum", "squares")]
    return spread_of(*sums, F.min(f"{name}_min"), F.max(f"{name}_max"))


def square(name):
    """A whole number squared, without loss."""
    exact = F.col(name).cast("decimal(19,0)")
    return exact * exact


def spread_of(n, total, squares, low, high):
    """Sample standard deviation from a count, a sum and a sum of squares of whole numbers.

    Sums of squares are ``decimal(38,0)`` and the difference of two large products is taken
    before anything is rounded; only where it has more digits than that, in doubles.
    """
    exact = F.try_subtract(_product(n, squares), _product(total, total)).cast("double")
    rough = n * squares.cast("double") - total.cast("double") * total.cast("double")
    count = n.cast("double")
    variance = F.coalesce(exact, rough) / (count * (count - 1))
    return F.when(
        n > 1, F.when(low == high, 0.0).otherwise(F.sqrt(F.greatest(variance, F.lit(0.0))))
    )


def _product(a, b):
    return F.try_multiply(a.cast("decimal(38,0)"), b.cast("decimal(38,0)"))
