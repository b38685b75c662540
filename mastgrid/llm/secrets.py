"""Secrets: patterns propose parts of credentials, and weak parts count only in company.

Base kinds stand by themselves. A weak part (a name that could be a login, a value that could
be a key, an address) says little alone; it is reported if a part that completes a credential
lies in the same scope, a block of lines without a blank one, within reach of it. Intervals are
joined by a sweep: parts of a text in order of place each meet the nearest part of every role
on both sides, so the work is n log n in the parts however many lie within reach of each other.
"""
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mastgrid.functions.durable import durable
from mastgrid.llm.exprs import located

# The base kinds. Possessive repeats and longer least lengths, where a shorter
# match would be dropped anyway, give the same spans in fewer steps.
VALUE = "[A-Za-z0-9+/_.=-]"
ASSIGNED = "[\"']?+\\x20*+[:=]\\x20*+[\"']?+"
PATTERNS = {
    "assign": f"(?i:password|passwd|secret|token|api_?key){ASSIGNED}({VALUE}++)",
    "access": "AKIA[A-Z0-9]{16,}+",
    "hex": "(?<![0-9a-f])[0-9a-f]{24,}+",
    # Weak kinds.
    "key": f"(?i:key|pwd|passphrase|credential){ASSIGNED}({VALUE}++)",
    "blob": "(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{40,}+",
    "client": f"(?i:key_?id|client_?id|account_?id|user_?name|user|login){ASSIGNED}([A-Za-z0-9@_.-]++)",
    "endpoint": "(?i:https?|ftp|s3|jdbc:[a-z0-9]+|postgresql|mysql|mongodb|redis|amqp)://[^\\x00-\\x20\"'<>]++",
}
BASE = ("assign", "access", "hex")
#: Least characters of the value that a pattern's group holds.
LEAST_VALUE = {"assign": 6, "key": 8, "client": 3}
ROLES = {
    "assign": "secret", "access": "identifier", "key": "secret", "blob": "secret",
    "client": "identifier", "endpoint": "endpoint",
}
#: role -> roles that complete it: a credential has a secret and what it opens.
COMPLETED_BY = {
    "identifier": ("secret",), "endpoint": ("secret",), "secret": ("identifier", "endpoint"),
}
#: Code points between two parts of one credential, at most.
REACH = 300
#: A blank line ends a scope.
BREAK = "\\n[\\x20\\t\\r]*+\\n"
#: A text without this can't hold the kind; a cheap test before the pattern.
NEEDS = {"access": "AKIA", "endpoint": "://"}
SPAN = ("struct<kind:string,start:bigint,end:bigint,found:string,weak:boolean,"
        "partner_start:bigint,partner_end:bigint>")


PLACES = {kind: place for place, kind in enumerate(PATTERNS)}


def _looked_up(values, kind):
    """The value of a kind; NULL for none."""
    return F.try_element_at(
        F.create_map(*[F.lit(x) for item in values.items() for x in item]),
        F.coalesce(kind, F.lit("")))


def _holds(kind, found):
    """Whether a match passes the check of its kind."""
    if kind in LEAST_VALUE:
        value = F.regexp_extract(found, PATTERNS[kind], 1)
        return F.length(value) >= LEAST_VALUE[kind]
    if kind == "blob":
        mixed = [F.rlike(found, F.lit(c)) for c in ("[A-Z]", "[a-z]", "[0-9]")]
        return (F.length(found) == 40) & mixed[0] & mixed[1] & mixed[2]
    return F.lit(True)


def _parts(kind, text):
    """Spans of one kind that pass their check, without a partner yet."""
    found = located(text, PATTERNS[kind], NEEDS.get(kind))
    none = F.lit(None).cast("long")
    return F.transform(
        F.filter(found, lambda x: _holds(kind, x["found"])),
        lambda x: F.struct(
            F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
            x["found"].alias("found"), F.lit(kind not in BASE).alias("weak"),
            none.alias("partner_start"), none.alias("partner_end")))


def _ordered(spans):
    """Spans by start, then kind as listed, then end."""
    keyed = F.transform(spans, lambda x: F.struct(
        x["start"].alias("start"), _looked_up(PLACES, x["kind"]).alias("place"),
        x["end"].alias("end"), x.alias("span")))
    return F.transform(F.sort_array(keyed), lambda x: x["span"])


def _linked(parts, reach):
    """Weak rows of ``parts`` (``__row`` and the fields of a span) with their nearest partner.

    Kind NULL is the end of a scope. Running extremes in both directions give, for each part,
    the last and next part of each role, the scope's ends and the base spans around it.
    """
    rows = parts.withColumns({
        "role": _looked_up(ROLES, F.col("kind")),
        "order": F.coalesce(_looked_up(PLACES, F.col("kind")), F.lit(-1))})
    onward = Window.partitionBy("__row").orderBy("start", "end", "order").rowsBetween(
        Window.unboundedPreceding, -1)
    back = Window.partitionBy("__row").orderBy(
        F.desc("start"), F.desc("end"), F.desc("order")).rowsBetween(Window.unboundedPreceding, -1)
    base = F.col("kind").isNotNull() & ~F.col("weak")
    limits = {
        "scope_start": F.max(F.when(F.col("kind").isNull(), F.col("end"))).over(onward),
        "scope_end": F.min(F.when(F.col("kind").isNull(), F.col("start"))).over(back),
        "base_before": F.max(F.when(base, F.col("end"))).over(onward),
        "base_after": F.min(F.when(base, F.col("start"))).over(back),
    }
    for name in COMPLETED_BY:
        mine = F.col("role") == name
        limits[f"last_{name}"] = F.max(F.when(mine, F.struct("end", "start"))).over(onward)
        limits[f"next_{name}"] = F.min(F.when(mine, F.struct("start", "end"))).over(back)
    rows = rows.select("*", *[value.alias(name) for name, value in limits.items()])
    rows = rows.filter("""weak AND (base_before IS NULL OR base_before <= start)
        AND (base_after IS NULL OR base_after >= end)""")

    def partner(name):
        last, following = F.col(f"last_{name}"), F.col(f"next_{name}")
        gap_before = F.greatest(F.lit(0), F.col("start") - last["end"])
        gap_after = F.greatest(F.lit(0), following["start"] - F.col("end"))
        inside = (gap_before <= reach) & (last["start"] >= F.coalesce("scope_start", F.lit(0)))
        inside_after = following.isNotNull() & (gap_after <= reach) & (
            F.col("scope_end").isNull() | (following["end"] <= F.col("scope_end")))
        return [
            F.when(inside, F.struct(gap_before.alias("gap"), last["start"].alias("start"),
                                    last["end"].alias("end"))),
            F.when(inside_after, F.struct(gap_after.alias("gap"), following["start"].alias("start"),
                                          following["end"].alias("end"))),
        ]

    nearest = None
    for name, others in COMPLETED_BY.items():
        found = F.array_min(F.filter(
            F.array(*[p for other in others for p in partner(other)]), lambda x: x.isNotNull()))
        nearest = F.when(F.col("role") == name, found) if nearest is None else nearest.when(
            F.col("role") == name, found)
    return rows.withColumn("near", nearest).filter("near IS NOT NULL").select(
        "__row", "kind", "start", "end", "found", "weak",
        F.col("near.start").alias("partner_start"), F.col("near.end").alias("partner_end"))


def find_secrets(docs, text="text", keep=("doc_id",), reach=REACH):
    """Per row the ``keep`` columns and ``spans``, by start, then kind as listed.

    Matches of one kind are leftmost and don't overlap; those that fail their check are
    dropped. Spans of the base kinds always stay. Weak spans stay if they overlap no base span
    and a span of a role that completes theirs is in their scope, with at most ``reach`` code
    points between; ``partner_start`` and ``partner_end`` name the nearest such span.

    A NULL or empty text has no spans. Rows are read each on their own, whether their ids or
    texts repeat or are NULL; an empty table gives an empty one. Columns not kept can't clash.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("__keep"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"))
    value = F.col("__text")
    spans = F.concat(*[_parts(kind, value) for kind in PATTERNS])
    # The generator is a barrier, so each pattern runs once a row.
    rows = rows.select("__keep", "__text", F.inline(F.array(F.struct(spans.alias("__spans")))))
    some = F.exists("__spans", lambda x: x["weak"]) & (F.size("__spans") > 1)
    breaks = F.when(some, located(value, BREAK)).otherwise(F.array().cast(
        "array<struct<start:bigint,end:bigint,found:string>>"))
    # Written, so that the number of a row is the same wherever it is read again.
    rows = durable(rows.select(
        "__keep", "__spans", F.transform(breaks, lambda x: F.struct(
            F.lit(None).cast("string").alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
            F.lit(None).cast("string").alias("found"), F.lit(False).alias("weak"),
            F.lit(None).cast("long").alias("partner_start"),
            F.lit(None).cast("long").alias("partner_end"))).cast(f"array<{SPAN}>").alias("__breaks"),
        F.monotonically_increasing_id().alias("__row")))
    parts = rows.filter(some).select("__row", F.inline(F.concat("__spans", "__breaks")))
    linked = _linked(parts, reach).groupBy("__row").agg(F.collect_list(F.struct(
        "kind", "start", "end", "found", "weak", "partner_start", "partner_end")).alias("__weak"))
    # A row's spans come from its own text, so their number is bounded by it.
    whole = rows.join(linked, "__row", "left")
    found = _ordered(F.concat(
        F.filter("__spans", lambda x: ~x["weak"]),
        F.coalesce("__weak", F.array().cast(f"array<{SPAN}>"))))
    return whole.select(*[F.col("__keep").getField(c).alias(c) for c in keep], found.alias("spans"))


def joined(spans):
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(
        spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def base_spans(spans):
    return F.filter(spans, lambda x: ~x["weak"])


def count_kind(spans, kind):
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")
