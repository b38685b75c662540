"""Row filters and whole-table counts."""
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mastgrid.functions.derive import named_operator, with_operator, with_year
from mastgrid.schema import DEFAULT_OPERATOR


def usable_position():
    """Latitude and longitude are both present, not NaN and not zero."""
    lat, lon = F.col("lat"), F.col("lon")
    present = lat.isNotNull() & lon.isNotNull()  # pushed down to the scan
    return present & (F.nanvl(lat, F.lit(0.0)) != 0) & (F.nanvl(lon, F.lit(0.0)) != 0)


def clean_towers(df):
    """Drop towers with a missing or zero coordinate.

    A zero in either coordinate drops the row, so towers on the equator or the prime
    meridian go too. Every region, map and site operator expects this table.
    """
    return df.filter(usable_position())


def tower_row_count(df):
    """Rows before and after cleaning, in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("raw_count"),
        F.count_if(usable_position()).alias("clean_count"),
    )


def by_operator(df, name, operators=None, default=DEFAULT_OPERATOR):
    """Towers of one operator, with ``operator_name``."""
    if isinstance(operators, DataFrame) or "operator_name" in df.columns:
        return with_operator(df, operators, default).filter(F.col("operator_name") == name)
    rows = df.filter(named_operator(name, operators, default))
    return rows.withColumn("operator_name", F.lit(name))


def by_tech(df, radio):
    """Towers of one technology."""
    return df.filter(F.col("radio") == radio)


def by_operator_tech(df, name, radio, operators=None, default=DEFAULT_OPERATOR):
    """Towers of one operator and one technology, with ``operator_name``."""
    return by_operator(by_tech(df, radio), name, operators, default)


def recent_years(df, since=2015):
    """Towers created in the year ``since`` or later, with ``year``.

    Where ``created`` holds epoch seconds the start of that year is compared as well; that
    comparison reaches the scan.
    """
    recent = with_year(df).filter(F.col("year") >= since)
    if "created" in df.columns and df.schema["created"].dataType.typeName() == "long":
        start = datetime(since, 1, 1, tzinfo=timezone.utc)
        recent = recent.filter(F.col("created") >= int(start.timestamp()))
    return recent
