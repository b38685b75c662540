"""Read tower tables and bring them to one schema."""
from pyspark.sql import functions as F

from mastgrid.functions.durable import durable
from mastgrid.schema import (
    BASE_COLUMNS,
    COLUMN_TYPES,
    DROPPED_COLUMNS,
    OPTIONAL_COLUMNS,
    positional_names,
)
from mastgrid.sources.sinks import TECH_KEY, tech_of_key

#: Different headers that files of one folder may have.
MOST_HEADERS = 100
WIDTHS = range(len(BASE_COLUMNS), len(BASE_COLUMNS) + len(OPTIONAL_COLUMNS) + 1)


def line_width(line):
    """Fields of a CSV line; separators inside quotes don't count."""
    plain = F.when(F.contains(line, F.lit('"')), F.regexp_replace(line, '"(?:[^"]|"")*+"', "")).otherwise(line)
    return (F.length(plain) - F.length(F.replace(plain, F.lit(","), F.lit(""))) + 1).cast("int")


def tower_lines(spark, path):
    """What the lines of CSV files are: ``file, header, width, line_count``.

    ``header`` holds the lines that name a lat and a lon column, NULL for all others. Lines are
    read as text, so none is lost, whatever its width; blank ones don't count. Counts combine
    in each task; there is a row per file and width.
    """
    line = F.col("value")
    rows = spark.read.text(path).select(line, F.col("_metadata.file_path").alias("file"))
    rows = rows.filter(F.trim(line) != "")
    names = F.transform(F.split(F.lower(line), ","), lambda x: F.trim(x, F.lit(' "')))
    is_header = F.contains(F.lower(line), F.lit("lat")) & F.array_contains(names, "lat") & (
        F.array_contains(names, "lon"))
    kinds = ["file", F.when(is_header, line).alias("header"), line_width(line).alias("width")]
    return rows.groupBy(*kinds).agg(F.count(F.lit(1)).alias("line_count"))


def _header_names(header):
    return [name.strip(' "') for name in header.split(",")]


def read_towers(spark, path, fmt="csv", header=False, text_dates=False, bad_lines="raise"):
    """Tower table at ``path`` with a declared schema; no type inference, no driver copy.

    CSV files say themselves whether they have a header, so no data row is taken for one. Files
    may differ: lines are 13 to 15 fields by position, and with ``header`` each file whose first
    line names a lat and a lon column goes by its own names. Every line is accounted for by a
    pass over the text first (``tower_lines``): lines of another width raise one error with
    their number, or are left out with ``bad_lines="drop"``.

    Empty, ``NaN`` and unparsable fields become NULL; whole numbers may be written with a
    fraction of zeros. ``text_dates`` keeps ``created`` and ``updated`` as text for
    ``with_timestamps`` to parse; by default they are epoch seconds. Other formats (parquet,
    orc, json) are read as they are and conformed.
    """
    if fmt != "csv":
        rows = spark.read.format(fmt).load(path)
        if TECH_KEY in rows.columns:  # written by save_clean
            rows = rows.select(tech_of_key().alias("radio"), *[c for c in rows.columns if c != TECH_KEY])
        return conform_towers(rows)
    if bad_lines not in ("raise", "drop"):
        raise ValueError(f"bad_lines is raise or drop, not {bad_lines!r}")
    lines = durable(tower_lines(spark, path))
    named = lines.filter("header IS NOT NULL").select("file", "header").distinct()
    headers = []
    if header:
        headers = [r.header for r in named.select("header").distinct().orderBy("header").limit(
            MOST_HEADERS + 1).collect()]
        if len(headers) > MOST_HEADERS:
            raise ValueError(f"more than {MOST_HEADERS} different headers under {path}")
    names = [_header_names(h) for h in headers]
    # A row per header and width: few, whatever the number of files.
    data = lines.filter("header IS NULL") if header else lines
    by_file = named.withColumnRenamed("header", "of") if header else named.limit(0).withColumnRenamed("header", "of")
    counted = data.join(F.broadcast(by_file), "file", "left").groupBy("of", "width").agg(
        F.sum("line_count").alias("n")).collect()
    allowed = {None: set(WIDTHS), **{h: {len(n)} for h, n in zip(headers, names)}}
    bad = {r.width: r.n for r in counted if r.width not in allowed[r.of]}
    if bad and bad_lines == "raise":
        raise ValueError(
            f"{sum(bad.values())} of {sum(r.n for r in counted)} lines have neither 13 to 15 columns nor "
            f"those of a header naming lat and lon; lines by width: {dict(sorted(bad.items()))}")
    widths = [r.width for r in counted if r.of is None and r.width in WIDTHS]
    by_position = (BASE_COLUMNS + OPTIONAL_COLUMNS)[:max(widths, default=0)]
    if not by_position and not names:
        by_position = BASE_COLUMNS
    rows = _fields(spark, path, header, max(map(len, [by_position, *names])), bool(bad))
    if not header or not headers:
        rows = rows.filter(F.col("_width").between(WIDTHS[0], WIDTHS[-1])) if bad else rows
        rows = rows.select(*[F.col(f"_c{i}").alias(n) for i, n in enumerate(by_position)])
    else:
        rows = _by_own_names(rows, named, headers, names, by_position, bool(bad))
    return conform_towers(rows, text_dates)


def _fields(spark, path, header, width, with_width):
    """The lines as ``width`` texts ``_c0, _c1, ...``, their file, and their width if asked for.

    The raw line is kept for lines of any other width than the schema's. Without it only the
    columns in use are parsed.
    """
    schema = ", ".join(f"_c{i} string" for i in range(width)) + (", _line string" if with_width else "")
    # A pruned line is never of another width, so then all of it is parsed.
    rows = spark.read.option("columnPruning", not with_width).csv(
        path, schema=schema, header=header, enforceSchema=True, mode="PERMISSIVE",
        columnNameOfCorruptRecord="_line")
    rows = rows.withColumn("_file", F.col("_metadata.file_path"))
    if with_width:
        rows = rows.withColumn("_width", F.coalesce(line_width(F.col("_line")), F.lit(width)))
    return rows


def _by_own_names(rows, named, headers, names, by_position, bad):
    """Rows with each file's own columns; a file without a header that counts goes by position."""
    numbers = F.create_map(*[F.lit(x) for i, h in enumerate(headers) for x in (h, i)])
    # A row per file.
    files = named.select(F.col("file").alias("_file"), numbers[F.col("header")].alias("_names"))
    rows = rows.join(F.broadcast(files), "_file", "left")
    layouts = [(F.col("_names") == i, n) for i, n in enumerate(names)]
    if by_position:
        layouts.append((F.col("_names").isNull(), by_position))
    if bad:
        fits = F.col("_names").isNull() & F.col("_width").between(WIDTHS[0], WIDTHS[-1])
        for i, n in enumerate(names):
            fits = fits | ((F.col("_names") == i) & (F.col("_width") == len(n)))
        rows = rows.filter(F.coalesce(fits, F.lit(False)))
    wanted = list(dict.fromkeys(name for _, layout in layouts for name in layout))

    def value(name):
        found = [F.when(mine, F.col(f"_c{layout.index(name)}")) for mine, layout in layouts if name in layout]
        return (F.coalesce(*found) if len(found) > 1 else found[0]).alias(name)

    return rows.select(*[value(name) for name in wanted])


def _typed(column, given, wanted):
    """A column cast; NULL where the value is none of the type.

    Whole numbers in texts may carry a fraction of zeros, NaN is NULL.
    """
    kind = wanted.typeName()
    if kind == "double":
        number = column.try_cast("double")
        return F.when(~F.isnan(number), number)
    if given.typeName() == "string" and kind in ("integer", "long"):
        exact = column.try_cast("decimal(38,6)")
        return F.coalesce(column.try_cast(wanted), F.when(F.floor(exact) == exact, exact.try_cast(wanted)))
    return column.try_cast(wanted)


def conform_towers(df, text_dates=True):
    """Name columns by position where needed, fix types, drop the unused columns.

    With ``text_dates`` dates that come as texts or times stay as they are.
    """
    df = df.toDF(*positional_names(df.columns))
    columns = []
    for field in df.schema.fields:
        if field.name in DROPPED_COLUMNS:
            continue
        wanted = COLUMN_TYPES.get(field.name, field.dataType)
        text_date = text_dates and field.name in ("created", "updated") and field.dataType.typeName() in (
            "string", "timestamp", "timestamp_ntz", "date",
        )
        column = F.col(f"`{field.name}`")
        if field.dataType != wanted and not text_date:
            column = _typed(column, field.dataType, wanted).alias(field.name)
        columns.append(column)
    return df.select(*columns)
