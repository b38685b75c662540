"""The tower record: column names, types and the small fixed lookup tables."""
from pyspark.sql import types as T

# Column order of a tower file 13 columns wide.
BASE_COLUMNS = [
    "radio", "mcc", "mnc", "area", "cell", "unit", "lon", "lat", "range",
    "samples", "changeable", "created", "updated",
]
# The columns that may follow, the 14th and the 15th.
OPTIONAL_COLUMNS = ["average_signal", "unknown"]

DROPPED_COLUMNS = ["unit", "unknown"]

COLUMN_TYPES = {
    "radio": T.StringType(),
    "mcc": T.IntegerType(),
    "mnc": T.IntegerType(),
    "area": T.LongType(),
    "cell": T.LongType(),
    "unit": T.IntegerType(),
    "lon": T.DoubleType(),
    "lat": T.DoubleType(),
    "range": T.LongType(),
    "samples": T.LongType(),
    "changeable": T.IntegerType(),
    "created": T.LongType(),
    "updated": T.LongType(),
    "average_signal": T.IntegerType(),
    "unknown": T.StringType(),
}

# Operator name by (mcc, mnc).
OPERATORS = {
    (310, 260): "T-Mobile US",
    (310, 410): "AT&T US",
    (311, 480): "Verizon US",
    (310, 120): "Sprint",
}
DEFAULT_OPERATOR = "Other"

# Marker colours.
TECH_COLORS = {"LTE": "blue", "GSM": "green", "UMTS": "orange", "NR": "red"}
OPERATOR_COLORS = {
    "T-Mobile US": "blue",
    "AT&T US": "green",
    "Verizon US": "red",
    "Sprint": "orange",
    "Other": "gray",
}
DEFAULT_COLOR = "gray"


def positional_names(names):
    """Names for a file's columns: its own if they include lat and lon, else by position."""
    if {"lat", "lon"} <= set(names):
        return list(names)
    known = BASE_COLUMNS + OPTIONAL_COLUMNS
    if not len(BASE_COLUMNS) <= len(names) <= len(known):
        raise ValueError(
            f"a tower table has {len(BASE_COLUMNS)} to {len(known)} columns, "
            f"or a header naming lat and lon; got {len(names)}: {list(names)}"
        )
    return known[: len(names)]


def tower_schema(names, text_dates=False):
    """StructType for columns of these names; unknown names are strings."""
    fields = []
    for name in names:
        dtype = COLUMN_TYPES.get(name, T.StringType())
        if text_dates and name in ("created", "updated"):
            dtype = T.StringType()
        fields.append(T.StructField(name, dtype))
    return T.StructType(fields)
