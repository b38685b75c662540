"""Breakdowns by one-degree region."""
from pyspark.sql import functions as F

from mastgrid.functions import measures as m
from mastgrid.functions.derive import REGION, with_region
from mastgrid.functions.numeric import round_half_even
from mastgrid.functions.select import top


def most_towers(*ties):
    """Order by tower count, largest first, then by the columns ``ties``."""
    return [F.desc("tower_count"), *[F.asc(c) for c in ties]]


def region_count(df, k=None, mode="half_up"):
    """Towers per region, or the ``k`` densest regions."""
    counts = with_region(df, mode).groupBy(*REGION).agg(m.tower_count(df))
    return top(counts, k, *most_towers(*REGION))


def region_densest(df, k=5, mode="half_up"):
    """The regions with the most towers."""
    return region_count(df, k, mode)


def top_regions(df, k=5, mode="half_up"):
    """Keys of the regions with the most towers."""
    return region_count(df, k, mode).select(*REGION)


def region_stats(df, k=None, mode="half_up"):
    """Towers, mean radius and mean samples per region, or of the ``k`` densest regions."""
    stats = with_region(df, mode).groupBy(*REGION).agg(
        m.tower_count(df),
        m.mean(df, "range").alias("avg_radius"),
        m.mean(df, "samples").alias("avg_samples"),
    )
    return top(stats, k, *most_towers(*REGION))


def region_tech_count(df, k=None, mode="half_up"):
    """Towers per region and technology, or the ``k`` largest such groups."""
    counts = with_region(df, mode).groupBy(*REGION, "radio").agg(m.tower_count(df))
    return top(counts, k, *most_towers(*REGION, "radio"))


def region_avg_radius(df, k=None, mode="half_up"):
    """Mean radius per region to two decimals, or the ``k`` regions with the largest."""
    average = round_half_even(m.mean(df, "range"), 2)
    radius = with_region(df, mode).groupBy(*REGION).agg(average.alias("avg_radius"))
    return top(radius, k, F.desc("avg_radius"), *REGION)


def region_largest_radius(df, k=5, mode="half_up"):
    """The regions with the largest mean radius."""
    return top(region_stats(df, mode=mode), k, F.desc("avg_radius"), *REGION)


def region_smallest_radius(df, k=5, mode="half_up"):
    """The regions with the smallest mean radius."""
    return top(region_stats(df, mode=mode), k, F.asc("avg_radius"), *REGION)


def is_underserved(max_towers=10, max_radius=2000):
    """Few towers and a small mean radius."""
    return (F.col("tower_count") < max_towers) & (F.col("avg_radius") < max_radius)


def region_underserved(df, max_towers=10, max_radius=2000, k=None, mode="half_up"):
    """Regions with few towers of small radius, all or the ``k`` of smallest mean radius."""
    few = region_stats(df, mode=mode).filter(is_underserved(max_towers, max_radius))
    return top(few, k, F.asc("avg_radius"), *REGION)


def top_region_tech_share(df, k=5, mode="half_up"):
    """Towers per technology in the ``k`` densest regions, ordered by region.

    Both the counts and the choice of regions come from one small table of counts, so the
    towers themselves are neither read twice nor joined.
    """
    counts = region_tech_count(df, mode=mode)
    regions = counts.groupBy(*REGION).agg(F.sum("tower_count").alias("tower_count"))
    keys = [F.col(c).alias(f"_{c}") for c in REGION]
    densest = top(regions, k, *most_towers(*REGION)).select(*keys)
    # At most k rows are broadcast. A null-safe inner join leaves both sides of the plan
    # alike, so they share one exchange; a semi join would be pushed down to the towers.
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in REGION]
    chosen = counts.join(F.broadcast(densest), same).select(*counts.columns)
    return chosen.orderBy(*REGION, F.desc("tower_count"), F.asc("radio"))
