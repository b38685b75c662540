"""Breakdowns by mobile operator."""
from pyspark.sql import Window
from pyspark.sql import functions as F

from mastgrid.functions import measures as m
from mastgrid.functions.derive import REGION, with_operator, with_region
from mastgrid.functions.select import first_rows, top
from mastgrid.operators.region import most_towers
from mastgrid.schema import DEFAULT_OPERATOR

NAME = "operator_name"


def operator_counts(df, *keys, operators=None, default=DEFAULT_OPERATOR):
    """Towers per operator and ``keys``.

    Towers are counted by network code first and only the counts are joined with the names,
    so the join stays small even for a large table of operators.
    """
    if NAME in df.columns:
        return df.groupBy(NAME, *keys).agg(m.tower_count(df))
    counts = df.groupBy("mcc", "mnc", *keys).agg(m.tower_count(df))
    named = with_operator(counts, operators, default)
    return named.groupBy(NAME, *keys).agg(F.sum("tower_count").alias("tower_count"))


def distinct_operator(df, operators=None, default=DEFAULT_OPERATOR):
    """The operators present, sorted."""
    codes = df if NAME in df.columns else df.select("mcc", "mnc").distinct()
    named = with_operator(codes, operators, default)
    return named.select(NAME).distinct().orderBy(NAME)


def operator_count(df, operators=None, default=DEFAULT_OPERATOR):
    """Towers per operator."""
    return operator_counts(df, operators=operators, default=default)


def operator_tech_count(df, k=None, operators=None, default=DEFAULT_OPERATOR):
    """Towers per operator and technology, or the ``k`` largest such groups."""
    counts = operator_counts(df, "radio", operators=operators, default=default)
    return top(counts, k, *most_towers(NAME, "radio"))


def operator_tech_split(df, operators=None, default=DEFAULT_OPERATOR):
    """Technologies of each operator, most towers first."""
    counts = operator_tech_count(df, operators=operators, default=default)
    return counts.orderBy(NAME, F.desc("tower_count"), F.asc("radio"))


def region_operator_count(df, mode="half_up", operators=None, default=DEFAULT_OPERATOR):
    """Towers per region and operator."""
    counts = operator_counts(
        with_region(df, mode), *REGION, operators=operators, default=default
    )
    return counts.select(*REGION, NAME, "tower_count")


def region_top_operator(df, mode="half_up", operators=None, default=DEFAULT_OPERATOR):
    """The operator with the most towers in each region; alphabetically first on a tie."""
    counts = region_operator_count(df, mode, operators, default)
    best_first = Window.partitionBy(*REGION).orderBy(*most_towers(NAME))
    ranked = counts.withColumn("_row", F.row_number().over(best_first))
    return ranked.filter(F.col("_row") == 1).drop("_row")


def operator_top_regions(df, k=10, mode="half_up", operators=None, default=DEFAULT_OPERATOR):
    """The ``k`` regions with the most towers of each operator, with their rank."""
    counts = region_operator_count(df, mode, operators, default)
    best_first = Window.partitionBy(NAME).orderBy(*most_towers(*REGION))
    ranked = counts.withColumn("rank", F.row_number().over(best_first))
    return ranked.filter(F.col("rank") <= k).select(NAME, *REGION, "tower_count", "rank")


def operator_preview(df, n=20, operators=None, default=DEFAULT_OPERATOR):
    """The first ``n`` towers of each operator, ordered by area, cell and time of creation."""
    shown = [NAME, "radio", "lat", "lon", "range", "samples"]
    order = ["area", "cell", "created", "samples", "range", "lat", "lon", "radio"]
    rows = with_operator(df, operators, default).select(*shown, "area", "cell", "created")
    return first_rows(rows, n, [NAME], order).select(*shown)
