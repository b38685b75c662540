"""Collapse logged conversation snapshots, then render what remains.

A chat service that logs the whole conversation after each turn leaves every conversation
many times, each log a prefix of the next. Rolling hashes of the turns name each prefix;
logs that are a prefix of a longer one are dropped by an anti-join.
"""
from pyspark.sql import functions as F
from pyspark.sql.window import Window

PREFIX = ["pos", "h1", "h2"]


def turn_prefixes(turns):
    """``conv_id, pos, role, text, n, h1, h2``: each turn with the hashes of all up to it.

    A turn's hashes cover its position, role and text, so their running exclusive-or names
    the sequence so far, in 128 bits. Turns are ordered by turn, role and text, NULL first.
    """
    rows = turns.select("conv_id", "turn", "role", "text")
    ordered = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # NULL and the empty text differ: the hash of a struct of flags and values.
    said = [F.col("role").isNull(), F.col("text").isNull(), "role", "text"]
    rows = rows.withColumn("pos", F.row_number().over(ordered))
    rows = rows.withColumns({
        "h1": F.bit_xor(F.xxhash64("pos", *said)).over(running),
        "h2": F.bit_xor(F.xxhash64(F.lit("second"), *reversed(said), "pos")).over(running),
        "n": F.count(F.lit(1)).over(Window.partitionBy("conv_id")).cast("int"),
    })
    return rows.drop("turn")


def maximal(prefixes):
    """``conv_id, n_logs`` of the conversations that no longer one continues.

    Of equal ones the smallest id stays, and ``n_logs`` counts them. Both sides of the
    anti-join are distinct, so a first turn or a conversation that is logged by a large part
    of all rows costs one row per task.
    """
    whole = prefixes.filter("pos = n").groupBy(*PREFIX).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_logs"))
    shorter = prefixes.filter("pos < n").select(*PREFIX).distinct()
    return whole.join(shorter, PREFIX, "left_anti").select("conv_id", "n_logs")


def render(turns):
    """``conv_id, n_turns, n_logs, text`` of the maximal conversations.

    NULL roles render as ``unknown`` and NULL texts as empty. Turns without an id form one
    conversation. Repeated rows are turns of their own. Each result row holds one
    conversation in whole, which is what bounds its size.
    """
    prefixes = turn_prefixes(turns)
    kept = maximal(prefixes)
    said = F.concat(
        F.lit("<|im_start|>"), F.coalesce("role", F.lit("unknown")), F.lit("\n"),
        F.coalesce("text", F.lit("")), F.lit("<|im_end|>\n"))
    lines = prefixes.select(F.col("conv_id").alias("id"), F.struct("pos", said.alias("said")).alias("t"))
    whole = lines.groupBy("id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return whole.join(kept, F.col("id").eqNullSafe(F.col("conv_id"))).select(
        "conv_id", F.size("t").cast("long").alias("n_turns"), "n_logs",
        F.array_join(F.col("t.said"), "").alias("text"))
