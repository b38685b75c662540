"""Small column helpers shared by the native operators."""
from pyspark.sql import functions as F


def bind(value, body):
    """``body(x)`` with ``x`` bound to ``value`` once, however often ``body`` names it.

    Lambda bodies are evaluated per element, so an outer expression inside one would be
    computed again each time; a lambda variable is not.
    """
    return F.transform(F.array(value), body)[0]


def with_struct(df, value):
    """Append the fields of a struct column, computed once per row.

    The generator is a barrier: later projections can't be merged into it and so repeat it.
    """
    return df.select(*[F.col(f"`{c}`") for c in df.columns], F.inline(F.array(value)))


def columns_of(df, *names):
    """The named columns only, so extra columns with clashing names can't interfere."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def located(text, pattern, needs=None, chunk=256):
    """``start, end, found`` of all matches of a pattern, in code points, end exclusive.

    Splitting at a pattern and extracting it meet the same matches, so a match starts after
    the lengths of the gaps and matches before it. The running sum is kept per ``chunk`` of
    matches, which keeps its cost near their number. A text without ``needs`` isn't searched.
    """
    pattern = F.lit(pattern)
    match_type = "struct<start:bigint,end:bigint,found:string>"
    none = F.array().cast(f"array<{match_type}>")

    def place(found, gaps):
        def one(state, k):
            start = state["at"] + F.length(F.get(gaps, k))
            end = start + F.length(F.get(found, k))
            match = F.struct(start.alias("start"), end.alias("end"), F.get(found, k).alias("found"))
            return F.struct(end.alias("at"), F.concat(state["m"], F.array(match)).alias("m"))

        def several(state, c):
            inner = F.aggregate(
                F.sequence(c * chunk, F.least(F.size(found), (c + 1) * chunk) - 1),
                F.struct(state["at"].alias("at"), none.alias("m")), one)
            return bind(inner, lambda x: F.struct(
                x["at"].alias("at"), F.concat(state["m"], F.array(x["m"])).alias("m")))

        start = F.struct(
            F.lit(0).cast("long").alias("at"), F.array().cast(f"array<array<{match_type}>>").alias("m"))
        chunks = F.sequence(F.lit(0), ((F.size(found) - 1) / chunk).cast("int"))
        return F.flatten(F.aggregate(chunks, start, several, lambda x: x["m"]))

    found = F.regexp_extract_all(text, pattern, F.lit(0))
    if needs:
        found = F.when(F.contains(text, F.lit(needs)), found).otherwise(
            F.array().cast("array<string>"))
    return bind(found, lambda m: F.when(F.size(m) > 0, bind(
        F.split(text, pattern, -1), lambda gaps: place(m, gaps))).otherwise(none))
