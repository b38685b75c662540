"""Breakdowns by technology and of the coverage radius."""
from pyspark.sql import Window
from pyspark.sql import functions as F

from mastgrid.functions import measures as m
from mastgrid.functions.derive import tower_id, tower_key
from mastgrid.functions.numeric import round_half_even
from mastgrid.functions.select import top


def distinct_tech(df):
    """The technologies present, sorted."""
    return df.select("radio").distinct().orderBy("radio")


def distinct_tech_count(df):
    """How many technologies are present."""
    return df.agg(F.count_distinct("radio").alias("tech_count"))


def distinct_cells(df, approx=False):
    """Number of distinct cell ids; ``approx`` trades exactness for a fixed-size sketch."""
    count = F.approx_count_distinct("cell") if approx else F.count_distinct("cell")
    return df.agg(count.alias("cell_count"))


def tech_count(df):
    """Towers per technology."""
    return df.groupBy("radio").agg(m.tower_count(df))


def tech_share(df):
    """Towers per technology and their percentage of all, to one decimal."""
    counts = tech_count(df)
    # One row per technology reaches this window.
    everything = F.sum("tower_count").over(Window.partitionBy())
    share = round_half_even(F.col("tower_count") * 100 / everything, 1)
    return counts.withColumn("share_pct", share)


def tech_stats(df):
    """Towers, mean and deviation of the radius, and samples per technology."""
    return df.groupBy("radio").agg(
        m.tower_count(df),
        m.mean(df, "range").alias("avg_radius"),
        m.spread(df, "range").alias("stddev_radius"),
        m.total(df, "samples").alias("total_samples"),
    )


def tech_avg_radius(df):
    """Mean radius per technology."""
    return df.groupBy("radio").agg(m.mean(df, "range").alias("avg_radius"))


def range_counts(df, *keys):
    """Towers per key and distinct radius: metres, so far fewer rows than towers."""
    return df.groupBy(*keys, "range").agg(F.count(F.lit(1)).alias("towers"))


def range_sums():
    """Aggregates over ``range_counts`` rows from which the moments follow."""
    metres, towers = F.col("range"), F.col("towers")
    return [
        F.coalesce(F.sum(F.when(metres.isNotNull(), towers)), F.lit(0)).alias("n"),
        F.sum(towers * metres).alias("total"),
        F.sum(towers.cast("decimal(19,0)") * m.square("range")).alias("squares"),
        F.min("range").alias("low"),
        F.max("range").alias("high"),
    ]


def tech_describe(df):
    """Count, mean, deviation, extremes and quartiles of the radius per technology.

    Quartiles are exact and interpolated. Equal radii are counted before the percentile, so
    it works on one weighted row per distinct radius.
    """
    shares = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    quartiles = F.percentile("range", shares, F.col("towers"))
    sums = range_counts(df, "radio").groupBy("radio").agg(*range_sums(), quartiles.alias("q"))
    n, low, high = F.col("n"), F.col("low"), F.col("high")
    columns = {
        "mean": F.try_divide(F.col("total"), n),
        "std": m.spread_of(n, F.col("total"), F.col("squares"), low, high),
        "min": low.cast("double"),
        "p25": F.col("q")[0],
        "p50": F.col("q")[1],
        "p75": F.col("q")[2],
        "max": high.cast("double"),
    }
    rounded = [(F.rint(column * 100) / 100).alias(name) for name, column in columns.items()]
    return sums.select("radio", n.alias("count"), *rounded)


def range_stats(df):
    """Extremes, mean and deviation of the radius over the whole table."""
    return df.agg(
        m.lowest(df, "range").alias("min_radius"),
        m.highest(df, "range").alias("max_radius"),
        m.mean(df, "range").alias("avg_radius"),
        m.spread(df, "range").alias("stddev_radius"),
    )


def tower_samples(df, k=None, full_key=False):
    """Samples per tower id, or the ``k`` towers with the most.

    ``area_cell`` leaves out the network, so two networks may share an id; ``full_key`` puts
    mcc and mnc in front. Rows are grouped by the numbers; the text is built afterwards.
    Towers without one of the numbers have no id and are left out.
    """
    key = tower_key(full_key)
    sums = df.dropna(subset=key).groupBy(*key).agg(F.sum("samples").alias("total_samples"))
    named = sums.select(tower_id(full_key).alias("tower_id"), "total_samples")
    return top(named, k, F.desc("total_samples"), F.asc("tower_id"))
