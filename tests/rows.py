"""Hand-made tower rows."""
from mastgrid.schema import BASE_COLUMNS, tower_schema

DEFAULTS = {
    "radio": "LTE", "mcc": 310, "mnc": 260, "area": 1, "cell": 1, "unit": 0, "lon": -75.2,
    "lat": 40.1, "range": 1000, "samples": 5, "changeable": 1, "created": 1459813819,
    "updated": 1459813819,
}


def towers(spark, *rows, text_dates=False):
    """A tower table; each row is a dict of what differs from the defaults."""
    values = [tuple({**DEFAULTS, **row}[c] for c in BASE_COLUMNS) for row in rows]
    return spark.createDataFrame(values, tower_schema(BASE_COLUMNS, text_dates))


def column(df, *names):
    rows = [tuple(row) for row in df.select(*names).collect()]
    return [row[0] for row in rows] if len(names) == 1 else rows
