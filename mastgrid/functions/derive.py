"""Columns derived from one tower row."""
import operator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mastgrid.functions.durable import durable
from mastgrid.functions.numeric import to_int_half_even, to_int_half_up
from mastgrid.schema import (
    DEFAULT_COLOR,
    DEFAULT_OPERATOR,
    OPERATOR_COLORS,
    OPERATORS,
    TECH_COLORS,
)

REGION = ["lat_r", "lon_r"]
ROUNDING = {"half_up": to_int_half_up, "half_even": to_int_half_even}
BROADCAST_ROWS = 100_000


#: Where a region column says by which rule it was rounded.
RULE = "rounding"


def with_region(df, mode="half_up"):
    """Add the one-degree region key ``lat_r, lon_r``.

    The columns record the rule. A table that has them is left as it is, but one whose regions
    were made by another rule raises.
    """
    if mode not in ROUNDING:
        raise ValueError(f"mode is one of {sorted(ROUNDING)}, not {mode!r}")
    if set(REGION) <= set(df.columns):
        made = {df.schema[name].metadata.get(RULE, mode) for name in REGION}
        if made != {mode}:
            raise ValueError(f"the table's regions were made by {sorted(made)}, not by {mode!r}")
        return df
    to_int = ROUNDING[mode]
    keys = [to_int(F.col(c)).alias(name, metadata={RULE: mode}) for c, name in zip(("lat", "lon"), REGION)]
    return df.select("*", *keys)


def with_tower_id(df, full_key=False):
    """Add ``tower_id``, area_cell, or mcc_mnc_area_cell with ``full_key``."""
    return df.withColumn("tower_id", tower_id(full_key))


def tower_id(full_key=False):
    parts = tower_key(full_key)
    return F.concat_ws("_", *[F.col(p).cast("string") for p in parts])


def tower_key(full_key=False):
    return ["mcc", "mnc", "area", "cell"] if full_key else ["area", "cell"]


def epoch_year(seconds):
    """UTC year of epoch seconds, whatever the session time zone."""
    return F.year(F.date_from_unix_date(F.floor(seconds / 86400).try_cast("int")))


def with_year(df):
    """Add the UTC ``year`` of ``created``; a table that has it is left as it is."""
    if "year" in df.columns:
        return df
    dtype = df.schema["created"].dataType.typeName()
    if dtype == "string":
        stamp = parse_time(df, "created")
        number = F.col("created").try_cast("bigint")
        return df.withColumn("year", F.coalesce(epoch_year(number), F.year(stamp)))
    if dtype in ("timestamp_ntz", "date"):
        return df.withColumn("year", F.year("created"))
    if dtype == "timestamp":
        return df.withColumn("year", epoch_year(F.unix_seconds("created")))
    return df.withColumn("year", epoch_year(F.col("created")))


def parse_time(df, name):
    """Timestamp of epoch seconds or of a date text; NULL where it is neither."""
    dtype = df.schema[name].dataType.typeName()
    if dtype == "string":
        number = F.timestamp_seconds(F.col(name).try_cast("bigint"))
        return F.coalesce(number, F.try_to_timestamp(F.col(name)))
    if dtype in ("timestamp", "timestamp_ntz", "date"):
        return F.col(name).cast("timestamp")
    return F.timestamp_seconds(F.col(name))


def with_timestamps(df):
    """Add ``created_ts``, ``updated_ts`` and ``year``."""
    stamps = {f"{name}_ts": parse_time(df, name) for name in ("created", "updated")}
    return with_year(df.withColumns(stamps))


def with_operator_code(df):
    """Add ``operator``, the digits of mcc and mnc put together as one number.

    Different pairs can share a code, so names are looked up by the pair, not by this.
    """
    digits = F.concat(F.col("mcc").cast("string"), F.col("mnc").cast("string"))
    return df.withColumn("operator", digits.try_cast("int"))


def with_operator(df, operators=None, default=DEFAULT_OPERATOR):
    """Add ``operator_name`` looked up by ``(mcc, mnc)``, ``default`` where there is none.

    ``operators`` is a dict ``{(mcc, mnc): name}`` or a table ``mcc, mnc, operator_name``; a pair
    named twice there gets the alphabetically first name, so no row doubles. A dict of a known
    small size is broadcast. Of a table only the names of codes that occur are of use: the codes
    are counted first, and the names of all of them are broadcast, or of the common ones if
    they are more than BROADCAST_ROWS. So the towers are never exchanged by a common code.
    """
    if "operator_name" in df.columns:
        return df
    if not isinstance(operators, DataFrame):
        operators = OPERATORS if operators is None else operators
        if len(operators) <= BROADCAST_ROWS:
            return _named(df, F.broadcast(_lookup_table(df.sparkSession, operators)), default)
        operators = _lookup_table(df.sparkSession, operators).withColumnRenamed("_name", "operator_name")
    codes = df.groupBy("mcc", "mnc").agg(F.count(F.lit(1)).alias("_rows"))
    names = operators.groupBy("mcc", "mnc").agg(F.min("operator_name").alias("_name"))
    used = durable(codes.join(names, ["mcc", "mnc"], "left"))
    total = used.agg(F.count(F.lit(1)).alias("codes"), F.sum("_rows").alias("rows")).first()
    if total.codes <= BROADCAST_ROWS:
        return _named(df, F.broadcast(used.filter("_name IS NOT NULL").drop("_rows")), default)
    # At most BROADCAST_ROWS codes can have more than that part of all rows.
    common = used.filter(F.col("_rows") > total.rows // BROADCAST_ROWS).drop("_rows")
    marked = F.broadcast(common.withColumn("_common", F.lit(True)))
    split = df.join(marked, ["mcc", "mnc"], "left")
    columns = [F.col(f"`{c}`") for c in df.columns]
    often = split.filter("_common OR mcc IS NULL OR mnc IS NULL")
    often = often.select(*columns, F.coalesce("_name", F.lit(default)).alias("operator_name"))
    rare = split.filter("_common IS NULL AND mcc IS NOT NULL AND mnc IS NOT NULL").select(*columns)
    return often.union(_named(rare, used.filter("_name IS NOT NULL").drop("_rows"), default))


def _named(df, lookup, default):
    joined = df.join(lookup, ["mcc", "mnc"], "left")
    name = F.coalesce(F.col("_name"), F.lit(default)).alias("operator_name")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], name)


def _lookup_table(spark, operators):
    rows = sorted(operators.items())
    return spark.createDataFrame(pa.table({
        "mcc": pa.array([pair[0] for pair, _ in rows], pa.int32()),
        "mnc": pa.array([pair[1] for pair, _ in rows], pa.int32()),
        "_name": pa.array([name for _, name in rows], pa.string()),
    }))


def named_operator(name, operators=None, default=DEFAULT_OPERATOR):
    """Predicate on mcc and mnc that holds for the rows ``with_operator`` names ``name``.

    Unlike a filter on the joined name it needs no join and is pushed down to the scan.
    """
    operators = OPERATORS if operators is None else operators

    def among(pairs):
        by_country = {}
        for mcc, mnc in pairs:
            by_country.setdefault(mcc, []).append(mnc)
        matches = [(F.col("mcc") == a) & F.col("mnc").isin(b) for a, b in by_country.items()]
        return reduce(operator.or_, matches, F.lit(False))

    match = among([pair for pair, other in operators.items() if other == name])
    if name == default:
        match = match | ~F.coalesce(among(operators), F.lit(False))
    return match


def _color(column, colors):
    pairs = [F.lit(v) for item in colors.items() for v in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(column)), F.lit(DEFAULT_COLOR))


def tech_color():
    return _color("radio", TECH_COLORS)


def operator_color():
    return _color("operator_name", OPERATOR_COLORS)


def with_tech_color(df):
    """Add ``color`` of the technology, gray for others."""
    return df.withColumn("color", tech_color())


def with_operator_color(df, operators=None, default=DEFAULT_OPERATOR):
    """Add ``color`` of the operator, gray for others."""
    return with_operator(df, operators, default).withColumn("color", operator_color())
