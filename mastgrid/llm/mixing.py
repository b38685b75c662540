"""Mix sources to target weights by temperature.

Token shares are raised to an exponent between 0 (all sources alike) and 1 (as they are),
found by bisection: the largest that reaches a target entropy, raised further if a source
would otherwise repeat more often than allowed. Each source then contributes whole passes over
its documents and a part of one more pass, taken along a keyed permutation in blocks.
"""
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mastgrid.functions.durable import durable
from mastgrid.llm.exprs import bind

TARGET_ENTROPY, MAX_REPEATS, SEED = 0.95, 4.0, 17
#: Halvings of the exponent's interval: past these a double no longer changes much.
STEPS = 40
#: Keys are 60 bits; their first 14 name one of 16,384 blocks of a source.
BLOCK_SHIFT = 46
#: Sources that are sent to every task; more are joined by source and block.
BROADCAST_SOURCES = 100_000
PPM = 1e6


def n_words(text):
    """Words between white space; NULL has none."""
    trimmed = F.trim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(trimmed == "", F.lit(0)).otherwise(
        F.size(F.split(trimmed, "[\\x20\\x09-\\x0D]+"))).cast("long")


def order_key(doc_id, seed=SEED):
    """60 bits that put a document at its place in the permutation."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _source(name="source"):
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def _bisected(fits):
    """The largest exponent in [0, 1] with ``fits``, which holds from 0 up to some place."""
    def halve(x, _):
        middle = (x["lo"] + x["hi"]) / 2
        return bind(F.struct(x["lo"].alias("lo"), middle.alias("m"), x["hi"].alias("hi")), lambda y:
                    F.when(fits(y["m"]), F.struct(y["m"].alias("lo"), y["hi"].alias("hi")))
                    .otherwise(F.struct(y["lo"].alias("lo"), y["m"].alias("hi"))))

    ends = F.struct(F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi"))
    return F.when(fits(F.lit(1.0)), F.lit(1.0)).otherwise(
        F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), ends, halve, lambda x: x["lo"]))


def _total(values):
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def source_weights(totals, target_entropy=TARGET_ENTROPY, max_repeats=MAX_REPEATS, budget=None):
    """``source, n_tokens, weight_ppm, target_tokens`` from ``source, n_tokens``.

    ``target_entropy`` is a part of the entropy of equal weights. Without a ``budget`` the
    tokens suffice for each source to be used once in whole. Sources without tokens get none.
    One row per source is gathered into one row: they are few against the documents.
    """
    rows = totals.filter("n_tokens > 0").agg(F.sort_array(F.collect_list(
        F.struct("source", F.col("n_tokens").cast("double").alias("n")))).alias("s"))
    rows = rows.filter(F.size("s") > 0)
    rows = rows.select("s", F.explode(F.array(bind(
        _total(F.transform("s", lambda y: y["n"])),
        lambda t: F.transform("s", lambda x: x["n"] / t)))).alias("p"))

    def entropy(alpha):
        raised = F.transform("p", lambda p: F.pow(p, alpha))
        return bind(raised, lambda w: bind(
            _total(w), lambda t: F.log(t) - _total(F.transform(w, lambda x: x * F.log(x))) / t))

    equal = F.log(F.size("s").cast("double"))
    # Repeats go as p ** (alpha - 1); the least repeated source is used once.
    spread = F.array_max("p") / F.array_min("p")
    limited = 1 - _bisected(lambda a: F.pow(spread, a) <= max_repeats)
    wanted = _bisected(lambda a: entropy(a) >= target_entropy * equal)
    rows = rows.select("s", "p", F.greatest(wanted, limited).alias("alpha"))
    weights = bind(
        F.transform("p", lambda p: F.pow(p, F.col("alpha"))),
        lambda w: bind(_total(w), lambda t: F.transform(w, lambda x: F.greatest(
            F.lit(1.0), F.round(x / t * PPM)))))
    rows = rows.select("s", F.explode(F.array(weights)).alias("w"))
    whole = F.array_max(F.zip_with("s", "w", lambda x, w: F.ceil(x["n"] * PPM / w).cast("double")))
    given = whole if budget is None else F.lit(float(budget))
    rows = rows.select("s", "w", given.alias("budget"))
    each = rows.select("budget", F.inline(F.arrays_zip("s", "w")))
    target = F.floor(F.col("budget") * F.col("w") / PPM).cast("long")
    tokens = F.col("s.n").cast("long")
    return each.select(
        F.col("s.source").alias("source"), tokens.alias("n_tokens"),
        F.col("w").cast("long").alias("weight_ppm"),
        (F.greatest(tokens, target) if budget is None else target).alias("target_tokens"))


def mix(docs, seed=SEED, **options):
    """``docs`` with ``copies`` and ``weight_ppm``; rows that are not used have 0 copies.

    NULL counts as the source ''. Documents without words follow their key like others.
    Rows with one ``doc_id`` share a place in the permutation and are taken together. A part
    of a pass never holds more tokens than are left for it. An empty table stays empty.
    """
    names = docs.columns
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("__row"), _source().alias("source"),
        F.col("text").alias("__text"), order_key(F.col("doc_id"), seed).alias("key"))
    block = F.shiftright("key", BLOCK_SHIFT)
    rows = rows.withColumn("block", block)
    sized = rows.select("source", "block", n_words(F.col("__text")).alias("n"))
    # Words are counted once; all else reads these sums, a row per source and block.
    blocks = durable(sized.groupBy("source", "block").agg(F.sum("n").alias("n")))
    totals = blocks.groupBy("source").agg(F.sum("n").alias("n_tokens"))
    plan = source_weights(totals, **options).withColumns({
        "full": F.expr("target_tokens div n_tokens"),
        "rest": F.expr("target_tokens % n_tokens")})
    # The block in which the last, partial pass ends, and the tokens left there.
    before = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = blocks.join(plan, "source").withColumn(
        "before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    last = placed.filter("before <= rest AND before + n > rest").select(
        "source", "block", (F.col("rest") - F.col("before")).alias("left"))
    up_to = Window.partitionBy("source", "block").orderBy("key").rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    few = totals.count() <= BROADCAST_SOURCES
    small = F.broadcast if few else (lambda df: df)
    taken = rows.join(small(last), ["source", "block"]).select(
        "source", "block", "key", "left", n_words(F.col("__text")).alias("n"))
    taken = taken.withColumn("upto", F.sum("n").over(up_to))
    cuts = last.join(
        taken.filter("upto <= left").groupBy("source").agg(F.max("key").alias("cut")),
        "source", "left",
    ).select("source", F.coalesce(
        "cut", F.shiftleft(F.col("block"), BLOCK_SHIFT) - 1).alias("cut"))
    plan = plan.join(cuts, "source", "left").select(
        "source", "weight_ppm", "full", F.coalesce("cut", F.lit(-1)).alias("cut"))
    if few:
        found = rows.join(F.broadcast(plan), "source", "left")
    else:
        plan = blocks.select("source", "block").join(plan, "source")
        found = rows.join(plan, ["source", "block"], "left")
    extra = F.when(F.col("key") <= F.col("cut"), 1).otherwise(0)
    # A source without any word has no weight; its documents stay as they are.
    return found.select(
        *[F.col("__row").getField(c).alias(c) for c in names],
        F.coalesce(F.col("full") + extra, F.lit(1)).cast("long").alias("copies"),
        F.coalesce("weight_ppm", F.lit(0)).cast("long").alias("weight_ppm"))


def realise(docs, **options):
    """The rows of ``docs``, all columns, each as often as its copies."""
    names = docs.columns
    mixed = mix(docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
                            "doc_id", "source", "text"), **options)
    often = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")
    used = mixed.filter("copies > 0").select("row", often)
    return used.select(*[F.col("row").getField(c).alias(c) for c in names])
