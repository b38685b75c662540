"""Connected components of a table of links, by alternating star steps."""
from pyspark.sql import functions as F

from mastgrid.functions.durable import durable


def _star(links, larger):
    """Connect the neighbours of each node to the smallest id around it.

    The large step moves neighbours above the node, the small step those below it and the
    node itself. Minima are combined in each task; the join back may be split when skewed.
    """
    both = links if not larger else links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    joined = both.join(least, "u").withColumn("m", F.least("u", "m"))
    if larger:
        moved = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            joined.select("u", F.col("m").alias("v")))
    return moved.filter("u <> v").distinct()


def _state(links):
    return links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()


def components(links):
    """``id, label`` of every linked id but the smallest of each component, its label.

    ``links`` has columns ``u`` and ``v``. Each round's table is written to the shared folder,
    which cuts the plan; the rounds end when a round changes nothing.
    """
    rows = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    rows = durable(rows.filter("u <> v").distinct())
    state = _state(rows)
    while True:
        rows = durable(_star(_star(rows, True), False))
        new = _state(rows)
        if new == state:
            return rows.select(F.col("u").alias("id"), F.col("v").alias("label"))
        state = new
