"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document; the ledger keeps one bit per failed rule beside
the measurements. A policy is a set of rules, so another policy, or a policy without one of
its rules, is a bitwise test of the stored bits and reads no text again.
"""
from pyspark.sql import functions as F

from mastgrid.llm.exprs import bind, with_struct

SPACE = "[\\x20\\x09-\\x0D]"
SPACES = " \t\n\x0b\f\r"

#: name -> condition over the measurements; the place in this list is the rule's bit, so
#: new rules go to the end.
RULES = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "2 * n_dup_lines > n_lines",
    "capitals": "10 * n_capitals > 3 * word_chars",
    "word_length": "word_chars > 15 * n_words",
}
BASE = ("few_words", "repeated_words")
#: version -> rules that reject a document.
POLICIES = {"v1": BASE, "v2": tuple(RULES)}
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals",
)


def mask_of(rules):
    """The bits of the named rules."""
    places = list(RULES)
    return sum(1 << places.index(name) for name in rules)


def _count(text, pattern):
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def _words(text):
    trimmed = F.trim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACE + "+"))


def _windows(words):
    """Each three-word window as 33 bits of its hash over 31 bits of its place, sorted."""
    last = F.size(words) - 3
    packed = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.shiftleft(
            F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)), 31
        ).bitwiseOR(i.cast("long")),
    )
    return F.sort_array(F.when(last < 0, F.array().cast("array<bigint>")).otherwise(packed))


def _alike(windows):
    """Places of the windows that share their hash bits with a neighbour."""
    def same(x, y):
        return F.shiftright(x, 31) == F.shiftright(y, 31)

    kept = bind(windows, lambda s: F.filter(
        s, lambda x, k: same(x, F.get(s, k - 1)) | same(x, F.get(s, k + 1))))
    return F.transform(kept, lambda x: x.bitwiseAND(F.lit(2**31 - 1)).cast("int"))


def _repeat_words(words, places):
    """Words inside windows that occur twice or more, among the windows at ``places``.

    Windows whose hash bits agree are compared by their words, so no collision counts.
    """
    named = F.transform(places, lambda i: F.struct(
        F.concat_ws(" ", F.slice(words, i + 1, 3)).alias("w"), i.alias("i")))
    twice = bind(F.sort_array(named), lambda s: F.filter(
        s, lambda x, k: (F.get(s, k - 1)["w"] == x["w"]) | (F.get(s, k + 1)["w"] == x["w"])))
    return F.aggregate(
        F.sort_array(F.transform(twice, lambda x: x["i"])),
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, i: F.struct(
            i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")),
        lambda a: a["n"],
    )


def _measured(rows):
    """Append the measurements of ``__text``; each step's arrays are computed once.

    Sorting brings equal windows together, so the work is n log n in the words however often
    one window occurs.
    """
    text, words, lines = F.col("__text"), F.col("__words"), F.col("__lines")
    rows = with_struct(rows, F.struct(
        _words(text).alias("__words"),
        F.filter(F.split(text, "\n"), lambda x: F.trim(x, F.lit(SPACES)) != "").alias("__lines"),
    ))
    rows = with_struct(rows, F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        _count(text, "[#*$%&|<>]").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.size(lines).cast("long").alias("n_lines"),
        _count(text, "[A-Z]").alias("n_capitals"),
        _windows(words).alias("__windows"),
    )).drop("__text", "__lines")
    rows = with_struct(rows, F.struct(_alike(F.col("__windows")).alias("__places")))
    rows = with_struct(rows.drop("__windows"), F.struct(
        _repeat_words(words, F.col("__places")).alias("n_repeat_words")))
    return rows.drop("__words", "__places")


def ledger(docs, text="text", keep=("doc_id",)):
    """One row per document: the ``keep`` columns, the measurements and ``fail_bits``.

    NULL and empty texts have no words and so fail ``few_words``. Repeated rows are measured
    each on its own; an empty table gives an empty ledger. Columns not in ``keep`` are left
    out, so none can clash with a measurement.
    """
    # The generator reads a fixed name that no kept column has.
    rows = docs.select(*[F.col(f"`{c}`") for c in keep],
                       F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"))
    rows = _measured(rows).select(*keep, *MEASURES)
    bits = F.lit(0).cast("long")
    for place, condition in enumerate(RULES.values()):
        bits = bits.bitwiseOR(F.when(F.expr(condition), F.lit(1 << place)).otherwise(F.lit(0)))
    return rows.withColumn("fail_bits", bits)


def passes(policy="v2", bits="fail_bits"):
    """Whether the stored bits satisfy a policy."""
    return F.col(bits).bitwiseAND(F.lit(mask_of(POLICIES[policy])).cast("long")) == 0


def ablations(rows, policy="v2"):
    """Per rule of a policy: documents that fail it, and that fail no other rule of it.

    The ledger is first counted by distinct bits, at most two to the number of rules rows.
    """
    mask = mask_of(POLICIES[policy])
    bits = F.col("fail_bits").bitwiseAND(F.lit(mask).cast("long"))
    counted = rows.groupBy(bits.alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    rules = F.array(*[
        F.struct(F.lit(name).alias("rule"), F.lit(mask_of([name])).cast("long").alias("bit"))
        for name in POLICIES[policy]
    ])
    each = counted.select("bits", "n", F.inline(rules))
    failed = F.col("bits").bitwiseAND(F.col("bit")) != 0
    return each.groupBy("rule").agg(
        F.coalesce(F.sum(F.when(failed, F.col("n"))), F.lit(0)).alias("n_failed"),
        F.coalesce(F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n"))), F.lit(0)).alias(
            "n_failed_alone"),
    )


def keep_good(docs, policy="v2"):
    """The rows of ``docs``, all columns, that satisfy a policy.

    NULL and empty texts go: they have too few words. Repeated rows all stay or all go; columns
    that are named like a measurement stay as they are; an empty table stays empty.
    """
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("__row"),
                       F.col("text").alias("__text"))
    held = ledger(rows, "__text", ("__row",)).filter(passes(policy))
    return held.select(*[F.col("__row").getField(c).alias(c) for c in names])
