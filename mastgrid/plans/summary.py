"""One pass over the towers that later counts and means can start from."""
from pyspark.sql import functions as F

from mastgrid.functions.derive import REGION, with_region, with_year
from mastgrid.functions.measures import square

KEYS = [*REGION, "radio", "mcc", "mnc", "year"]


def tower_summary(df, mode="half_up"):
    """Counts and sums per region, technology, network and year.

    Its size is bounded by regions times networks times years, not by towers. The operators of
    ``plans.report.summary_tables`` take it in place of the towers and give the same result;
    its regions are those of ``mode``, and asking them for another raises.
    """
    sums = [F.count(F.lit(1)).alias("tower_count")]
    for name in ("range", "samples"):
        sums += [
            F.count(name).alias(f"{name}_n"),
            F.sum(name).alias(f"{name}_sum"),
            F.sum(square(name)).alias(f"{name}_squares"),
            F.min(name).alias(f"{name}_min"),
            F.max(name).alias(f"{name}_max"),
        ]
    return with_year(with_region(df, mode)).groupBy(*KEYS).agg(*sums)
