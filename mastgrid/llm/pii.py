"""Personal data: patterns propose spans, checksums confirm them, context moves the score.

Base kinds stand by themselves. A further kind stays if its score reaches a threshold: a checksum
or a telling key gets it there alone, a mere shape of digits only with a word that names it nearby.
"""
from pyspark.sql import functions as F

from mastgrid.llm.exprs import bind, with_struct

# Characters of an account number by country (ISO 13616).
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK|FI|FO|GL|NL", 19: "MK|SI", 20: "AT|BA|EE|KZ|LT|LU|XK",
    21: "CH|HR|LI|LV", 22: "BG|BH|CR|DE|GB|GE|IE|ME|RS|VA", 23: "AE|GI|IL|IQ|TL",
    24: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG", 25: "LY|PT|ST", 26: "IS|TR",
    27: "BI|DJ|FR|GR|IT|MC|MR|SM", 28: "AL|AZ|BY|CY|DO|GT|HU|LB|PL|SV", 29: "BR|EG|PS|QA|UA",
    30: "JO|KW|MU", 31: "MT|SC", 32: "LC", 33: "RU",
}
IBAN = "|".join(f"(?:{lands})[0-9]{{2}}(?:\\x20?[A-Z0-9]){{{size - 4}}}"
                for size, lands in IBAN_LENGTHS.items())

# What each kind matches. Possessive repeats and a start at the end of the last
# match or outside a run give the same matches in one pass over a long run of letters or digits.
MAIL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": f"(?:\\G|(?<!{MAIL})){MAIL}++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "ip": "(?:\\G|(?<![0-9]))[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++",
    "card": "[0-9](?:[\\x20-]?+[0-9])++",
    "phone": "\\+[0-9][\\x20().0-9-]+[0-9]",
    "iban": f"(?<![A-Za-z0-9])(?:{IBAN})(?![A-Za-z0-9])",
    "ssn": "(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "local": "(?<![0-9+(.-])(?<!\\+[0-9]{1,3}[\\x20.-])(?:\\([0-9]{3}\\)\\x20?|[0-9]{3}[\\x20.-])"
             "[0-9]{3}[\\x20.-][0-9]{4}(?![0-9-])",
    "secret": "(?i:password|passwd|secret|token|api_?key)[\"']?+\\x20*+[:=]\\x20*+[\"']?+"
              "[A-Za-z0-9+/_.=-]{8,}+",
}
BASE = ("email", "ip", "card", "phone")
#: A text without this can't hold the kind; a cheap test before the pattern.
NEEDS = {"email": "@", "ip": ".", "phone": "+", "ssn": "-"}
#: kind -> score of a confirmed span, and starts of words nearby that raise it by CONTEXT_GAIN.
CALLS = "phone|tel|call|fax|mobile|telefon|llam"
SCORES = {
    "email": (0.9, "mail|contact|write|address"),
    "ip": (0.6, "ip|host|server|address|login"),
    "card": (0.8, "card|visa|credit|payment|kredit|tarjeta|carte"),
    "phone": (0.6, CALLS),
    "iban": (0.8, "iban|account|bank|konto|cuenta|compte"),
    "ssn": (0.5, "ssn|social|security|taxpayer"),
    "local": (0.5, CALLS),
    "secret": (0.8, "login|user|key|account"),
}
CONTEXT_GAIN, CONTEXT_CHARS, MIN_SCORE = 0.3, 40, 0.8
CHUNK = 256
#: Fixed value: a number of at most 255, leading zeros allowed.
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
SPAN = "struct<kind:string,start:bigint,end:bigint,found:string,score:double>"


def _digits(found):
    return F.regexp_replace(found, "[^0-9]", "")


def _luhn(digits):
    """Digits from the right, every second one doubled and its digits added, sum to 0 mod 10."""
    def add(total, i):
        digit = F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
        twice = F.substring(F.lit("0246813579"), digit + 1, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 0, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _mod97(found):
    """An account number read as digits (A = 10) from its fifth place on is 1 mod 97."""
    plain = F.translate(found, " ", "")
    turned = F.concat(F.substring(plain, 5, 60), F.substring(plain, 1, 4))

    def step(rest, c):
        value = F.when(F.ascii(c) < 58, rest * 10 + F.ascii(c) - 48)
        return value.otherwise(rest * 100 + F.ascii(c) - 55) % 97

    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), step) == 1


def _confirmed(kind, found):
    if kind == "ip":
        return F.rlike(found, F.lit(f"^{OCTET}(?:\\.{OCTET}){{3}}$"))
    if kind == "card":
        return bind(_digits(found), lambda d: F.when(
            F.length(d).between(16, 19), _luhn(d)).otherwise(F.lit(False)))
    if kind == "phone":
        return F.length(_digits(found)).between(8, 15)
    if kind == "iban":
        return _mod97(found)
    if kind == "ssn":
        return ~F.rlike(found, F.lit("^(?:000|666|9)|-00-|0000$"))
    if kind == "secret":
        value = F.regexp_extract(found, "[A-Za-z0-9+/_.=-]+$", 0)
        return F.rlike(value, F.lit("[0-9]")) & F.rlike(value, F.lit("[A-Za-z]"))
    return F.lit(True)


def _spans(kind, text):
    """Confirmed spans of one kind: kind, start, end (code points, end exclusive), text, score.

    Splitting at a pattern and extracting it meet the same matches, so a span starts after
    the lengths of the gaps and matches before it. The running sum is kept per chunk of
    matches, which keeps its cost near the number of matches.
    """
    pattern, (score, words) = F.lit(PATTERNS[kind]), SCORES[kind]
    none = F.array().cast(f"array<{SPAN}>")

    def place(found, gaps):
        def one(state, k):
            start = state["at"] + F.length(F.get(gaps, k))
            match = F.get(found, k)
            end = start + F.length(match)
            near = F.lower(F.concat_ws(
                " ", F.substring(F.get(gaps, k), -CONTEXT_CHARS, CONTEXT_CHARS),
                F.substring(F.get(gaps, k + 1), 1, CONTEXT_CHARS)))
            scored = F.when(F.rlike(near, F.lit(f"\\b(?:{words})")), score + CONTEXT_GAIN).otherwise(score)
            span = F.struct(
                F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"),
                match.alias("found"), F.least(F.lit(1.0), scored).alias("score"))
            return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

        def chunk(state, c):
            inner = F.aggregate(
                F.sequence(c * CHUNK, F.least(F.size(found), (c + 1) * CHUNK) - 1),
                F.struct(state["at"].alias("at"), none.alias("spans")), one)
            return bind(inner, lambda x: F.struct(
                x["at"].alias("at"),
                F.concat(state["spans"], F.array(x["spans"])).alias("spans")))

        chunks = F.sequence(F.lit(0), ((F.size(found) - 1) / CHUNK).cast("int"))
        start = F.struct(
            F.lit(0).cast("long").alias("at"),
            F.array().cast(f"array<array<{SPAN}>>").alias("spans"))
        spans = F.flatten(F.aggregate(chunks, start, chunk, lambda x: x["spans"]))
        return F.filter(spans, lambda x: _confirmed(kind, x["found"]))

    found = F.regexp_extract_all(text, pattern, F.lit(0))
    if kind in NEEDS:
        found = F.when(F.contains(text, F.lit(NEEDS[kind])), found).otherwise(
            F.array().cast("array<string>"))
    return bind(found, lambda m: F.when(F.size(m) > 0, bind(
        F.split(text, pattern, -1), lambda gaps: place(m, gaps))).otherwise(none))


def find_pii(docs, text="text", keep=("doc_id",), kinds=tuple(PATTERNS), min_score=MIN_SCORE):
    """Per document the ``keep`` columns and ``spans``, ordered by kind as listed, then start.

    Matches of one kind are leftmost and don't overlap; those that fail their check are
    dropped. Spans of the base kinds always stay; other kinds stay from ``min_score`` on.
    A word of the kind's context within CONTEXT_CHARS before or after a span, up to the next match
    of that kind, raises its score. A NULL or empty text has no spans, long texts are read
    whole, repeated rows each on their own, and an empty table gives no rows. Columns other
    than ``text`` and ``keep`` are not read, so their names can't clash; ``keep`` can't name
    ``spans``.
    """
    rows = docs.select(*[F.col(f"`{c}`") for c in keep],
                       F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"))
    value = F.col("__text")
    spans = F.concat(*[_spans(kind, value) for kind in kinds])
    spans = F.filter(spans, lambda x: x["kind"].isin(*BASE) | (x["score"] >= min_score))
    return with_struct(rows, F.struct(spans.alias("spans"))).drop("__text")


def joined(spans):
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(
        spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def scores(spans):
    """Scores of spans to one place, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.format_string("%.1f", x["score"])), ",")


def base_spans(spans):
    return F.filter(spans, lambda x: x["kind"].isin(*BASE))


def count_kind(spans, kind):
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")
