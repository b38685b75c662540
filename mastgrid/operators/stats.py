"""Samples, centres, density grid and density curves."""
import math

from pyspark.sql import functions as F

from mastgrid.functions import measures as m
from mastgrid.functions.derive import with_operator
from mastgrid.functions.select import sample_rows, sample_rows_by
from mastgrid.operators.tech import range_counts, range_sums
from mastgrid.schema import DEFAULT_OPERATOR


def tower_sample(df, n=3000, seed=42, by=()):
    """A repeatable sample of exactly ``min(n, rows)`` towers, of each group with ``by``.

    It depends on the towers and the seed only, not on how the table is partitioned.
    """
    return sample_rows_by(df, n, by, seed) if by else sample_rows(df, n, seed)


def centroid(df, by=()):
    """Mean latitude and longitude, to six decimals, of all towers or of each group."""
    centre = [F.round(F.avg(c), 6).alias(c) for c in ("lat", "lon")]
    return df.groupBy(*by).agg(*centre)


def density_grid(df, size=1.0):
    """Towers per grid cell of ``size`` degrees, named by its south-west corner."""
    north, east = (F.floor(F.col(c) / float(size)) for c in ("lat", "lon"))
    counts = df.groupBy(north.alias("north"), east.alias("east")).agg(
        F.count(F.lit(1)).alias("tower_count")
    )
    return counts.select(
        (F.col("north") * float(size)).alias("cell_lat"),
        (F.col("east") * float(size)).alias("cell_lon"),
        "tower_count",
    )


def radius_kde(counts, by, points=200, cut=3):
    """Gaussian density curve of the radius per group, from ``range_counts`` rows.

    The bandwidth is the deviation times n^(-1/5); the curve has ``points`` values from
    ``cut`` bandwidths below the least radius to as many above the greatest. Groups whose
    radius does not vary have no curve. Groups named NULL have theirs.
    """
    counts = counts.filter(F.col("range").isNotNull())
    sums = counts.groupBy(*by).agg(*range_sums())
    n, low, high = F.col("n"), F.col("low"), F.col("high")
    deviation = m.spread_of(n, F.col("total"), F.col("squares"), low, high)
    width = deviation * F.pow(n.cast("double"), F.lit(-0.2))
    curves = sums.select(*by, "n", "low", "high", width.alias("h")).filter(F.col("h") > 0)

    h = F.col("h")
    grid = F.explode(F.sequence(F.lit(0), F.lit(points - 1)))
    start, span = low - cut * h, high - low + 2 * cut * h
    x = start + F.col("grid_no") * span / (points - 1)
    weight = F.col("towers") / (n * h * math.sqrt(2 * math.pi))
    bump = weight * F.exp(-0.5 * F.pow((F.col("x") - F.col("range")) / h, F.lit(2.0)))
    curves = curves.withColumnsRenamed({c: f"_{c}" for c in by})
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    rows = counts.join(curves, same).withColumn("grid_no", grid).withColumn("x", x)
    curve = rows.groupBy(*by, "grid_no").agg(
        F.round(F.min("x"), 4).alias("x"), F.round(F.sum(bump), 10).alias("density")
    )
    return curve


def tech_radius_kde(df, points=200, cut=3):
    """Density curve of the radius per technology."""
    return radius_kde(range_counts(df, "radio"), ["radio"], points, cut)


def operator_radius_kde(df, points=200, cut=3, operators=None, default=DEFAULT_OPERATOR):
    """Density curve of the radius per operator and technology."""
    by = ["operator_name", "radio"]
    codes = range_counts(df, "mcc", "mnc", "radio")
    named = with_operator(codes, operators, default)
    counts = named.groupBy(*by, "range").agg(F.sum("towers").alias("towers"))
    return radius_kde(counts, by, points, cut)
