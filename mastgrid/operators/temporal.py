"""Breakdowns by year of creation."""
from mastgrid.functions import measures as m
from mastgrid.functions.derive import parse_time, with_year
from mastgrid.operators.clean import recent_years


def year_tech_count(df):
    """Towers per year of creation and technology, in order."""
    counts = with_year(df).groupBy("year", "radio").agg(m.tower_count(df))
    return counts.orderBy("year", "radio")


def recent_year_tech_count(df, since=2015):
    """The same for the years from ``since`` on."""
    return year_tech_count(recent_years(df, since))


def created_parsed(df):
    """Time and year of creation per tower; NULL where ``created`` is not a time."""
    stamped = with_year(df.withColumn("created_ts", parse_time(df, "created")))
    return stamped.select("area", "cell", "created_ts", "year")
