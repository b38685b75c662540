"""Choosing rows: top-k, first rows of each group, repeatable samples."""
from pyspark.sql import Window
from pyspark.sql import functions as F

from mastgrid.functions.durable import durable

#: Ranks of ``percentile_approx`` are off by one part in ACCURACY of a group at most, so the
#: value at a share that is twice that above n rows has n rows at or below it for certain.
ACCURACY = 2000
SHARES = [2.0**-k for k in range(10)]
#: Groups of fewer rows are not cut; larger ones are if they hold more than one part in
#: SENT_CUTS of all rows, so no more than SENT_CUTS cuts are ever sent to the tasks.
CUT_ROWS, SENT_CUTS = 100_000, 100_000
#: Passes that narrow a cut; each leaves about a thousandth of a large group.
CUT_ROUNDS = 3


def top(df, k, *order):
    """The first ``k`` rows in a total order; all rows, unordered, if ``k`` is None."""
    return df if k is None else df.orderBy(*order).limit(k)


def cut_rows(df, n, keys, value):
    """``df`` without most rows of large groups that can't be among the first ``n`` by ``value``.

    ``value`` is a number by which the order starts. Narrow passes over the keys and the value
    alone find one cut per large group; rows beyond it are dropped where they are read, before
    any exchange, and at least the first ``n`` of each group and all its ties stay. Rows without
    a value stay. Small groups aren't cut; equal values can't be told apart by one.
    """
    named = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    names = [f"_k{i}" for i in range(len(keys))]
    rows = df.select(*named, value.cast("double").alias("_value")).filter("_value IS NOT NULL")
    cuts = None

    def below(table, columns, value):
        """Rows of ``table`` up to their group's cut, if it has one."""
        if not keys:
            return table.filter(value <= cuts.first()._cut)
        same = [F.col(c).eqNullSafe(F.col(f"_of{i}")) for i, c in enumerate(columns)]
        mine = cuts.select(*[F.col(c).alias(f"_of{i}") for i, c in enumerate(names)], "_cut")
        return table.join(F.broadcast(mine), same, "left").filter(
            F.col("_cut").isNull() | value.isNull() | (value <= F.col("_cut"))).select(*table.columns)

    for _ in range(CUT_ROUNDS):
        stats = rows.groupBy(*names).agg(
            F.count("_value").alias("_n"),
            F.percentile_approx("_value", F.array(*map(F.lit, SHARES)), F.lit(ACCURACY)).alias("_at"))
        stats = durable(stats)  # a row per group
        total = stats.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
        share = F.lit(float(n)) / F.col("_n") + 2.0 / ACCURACY
        place = F.floor(-F.log2(share)).cast("int")
        large = stats.filter((F.col("_n") > max(CUT_ROWS, total // SENT_CUTS)) & (place >= 1))
        place = F.least(place, F.lit(len(SHARES) - 1))
        found = large.select(*names, F.element_at("_at", place + 1).alias("_cut"))
        left = large.agg(F.max(F.col("_n") * (F.pow(F.lit(2.0), -place) + 1.0 / ACCURACY))).first()[0]
        if left is None:
            break
        # A group that was cut before and is small enough now keeps its cut.
        before, cuts = cuts, found
        if before is not None and keys:
            same = [F.col(f"b.{c}").eqNullSafe(F.col(f"a.{c}")) for c in names]
            cuts = before.alias("a").join(F.broadcast(found.alias("b")), same, "left").select(
                *[f"a.{c}" for c in names], F.least("a._cut", "b._cut").alias("_cut"))
        elif before is None and keys:
            # From now on only the groups that were cut are looked at.
            same = [F.col(c).eqNullSafe(F.col(f"_of{i}")) for i, c in enumerate(names)]
            few = found.select(*[F.col(c).alias(f"_of{i}") for i, c in enumerate(names)])
            rows = rows.join(F.broadcast(few), same, "left_semi")
        cuts = durable(cuts)
        if left <= CUT_ROWS:
            break  # no group is large any more, so another pass would cut nothing
        rows = below(rows, names, F.col("_value"))
    if cuts is None:
        return df
    return below(df, list(keys), value.cast("double"))


def first_rows(df, n, keys, order):
    """The first ``n`` rows of each group, exactly, however large a group is.

    Each scan task keeps ``n`` rows per group (WindowGroupLimit); for ``n`` beyond
    ``spark.sql.optimizer.windowGroupLimitThreshold`` large groups are cut by the first column
    of the order where that is a number. What is left is merged in two steps, first within a
    slice of the scan tasks and then over all slices, so that no task merges the rows of every
    scan task at once.
    """
    conf = df.sparkSession.conf
    first = order[0]
    if n > int(conf.get("spark.sql.optimizer.windowGroupLimitThreshold")) and isinstance(first, str) and (
            df.schema[first].dataType.typeName() in ("integer", "long", "double")):
        df = cut_rows(df, n, keys, F.col(first))
    slices = int(conf.get("spark.sql.shuffle.partitions"))
    sliced = df.withColumn("_slice", F.spark_partition_id() % slices)
    for keys_of_step in ([*keys, "_slice"], list(keys)):
        window = Window.partitionBy(*keys_of_step).orderBy(*order)
        sliced = sliced.withColumn("_row", F.row_number().over(window)).filter(F.col("_row") <= n)
    return sliced.drop("_row", "_slice")


def sample_key(seed):
    """A pseudo-random text that depends only on the tower and the seed."""
    return F.md5(F.concat_ws("_", "area", "cell", "created", F.lit(seed)))


def sample_order(df):
    """Columns that settle the order of towers with the same sample key."""
    ties = ["samples", "range", "lat", "lon", "radio", "mcc", "mnc", "updated", "changeable",
            "average_signal"]
    return ["_key", *[c for c in ties if c in df.columns]]


def _sampled(df, n, keys, seed):
    """The rows among which the sample is, with their sample key."""
    keyed = df.withColumn("_key", sample_key(seed))
    # 52 bits of the key are a number that a double holds.
    leading = F.conv(F.substring("_key", 1, 13), 16, 10).cast("double")
    return cut_rows(keyed, n, keys, leading)


def sample_rows(df, n, seed=42):
    """Exactly ``min(n, rows)`` rows: those with the lowest sample keys.

    Rows are cut by their keys at the scan, so the final top-n sees little more than ``n``
    rows and not ``n`` rows of every task.
    """
    return _sampled(df, n, [], seed).orderBy(*sample_order(df)).limit(n).drop("_key")


def sample_rows_by(df, n, keys, seed=42):
    """Exactly ``min(n, rows)`` rows of each group: those with the lowest sample keys."""
    kept = _sampled(df, n, list(keys), seed)
    return first_rows(kept.select(*df.columns, "_key"), n, list(keys), sample_order(df)).drop("_key")
