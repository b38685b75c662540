"""Personal data against a plain Python version, and context that decides."""
import hashlib
import os
import random

import pytest
import regex

from mastgrid.llm import pii
from mastgrid.llm.queries import QUERIES

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(found):
    total = 0
    for k, c in enumerate(reversed([int(c) for c in found if c.isdigit()])):
        total += c if k % 2 == 0 else sum(divmod(2 * c, 10))
    return total % 10 == 0


def holds(kind, found):
    n = sum(c.isdigit() for c in found)
    if kind == "ip":
        return all(int(x) <= 255 for x in found.split("."))
    if kind == "card":
        return 16 <= n <= 19 and luhn(found)
    return kind != "phone" or 8 <= n <= 15


def plain_spans(text):
    """Base spans of a text, by kind and start."""
    return [(kind, m.start(), m.end()) for kind, pattern in PLAIN.items()
            for m in regex.finditer(pattern, text or "") if holds(kind, m.group())]


def hostile():
    draw = random.Random(7)
    bits = ["a", "é", "😀", "@", ".", "-", " ", "1", "25", "255", "256", "+", "(", ")", "x.org", "\n",
            "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 123-4567", "10.0.0.1", "u@h.de",
            "GB82 WEST 1234 5698 7654 32", "078-05-1120", "555-123-4567", "call", "token = 'ab12cd34ef'"]
    return ["".join(draw.choice(bits) for _ in range(draw.randrange(60))) for _ in range(300)]


def test_base_spans_by_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    texts = {r.doc_id: r.text for r in docs}
    texts |= {-k - 1: t for k, t in enumerate(hostile() + [None, "", "7" * 50_000, "1.2.3." * 20_000])}
    found = pii.find_pii(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(5))
    wrong = []
    for r in found.collect():
        base = [(s.kind, s.start, s.end) for s in r.spans if s.kind in pii.BASE]
        if base != plain_spans(texts[r.doc_id]):
            wrong.append(r.doc_id)
        for s in r.spans:
            assert texts[r.doc_id][s.start:s.end] == s.found
            assert s.kind in pii.BASE or s.score >= pii.MIN_SCORE
    assert found.count() == len(texts) and wrong == []


def test_query_columns(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    for r in QUERIES["op1_pii"](spark, DATA).collect():
        spans = plain_spans(docs[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(
            sum(s[0] == kind for s in spans) for kind in PLAIN)
        assert r.spans.startswith(joined) and r.spans.count(":") == 2 * len(r.scores.split(",")) * bool(r.spans)


@pytest.mark.parametrize("text, wanted", [
    ("my ssn is 078-05-1120 ok", [("ssn", "078-05-1120")]),
    ("the part is 078-05-1120 ok", []),
    ("ssn 000-05-1120, ssn 666-05-1120, ssn 078-00-1120, ssn 078-05-0000", []),
    ("call 555-123-4567 now", [("local", "555-123-4567")]),
    ("call (555) 123-4567 now", [("local", "(555) 123-4567")]),
    ("item 555-123-4567 now", []),
    ("ssn" + " " * 60 + "078-05-1120", []),
    ("GB82 WEST 1234 5698 7654 32 THE end", [("iban", "GB82 WEST 1234 5698 7654 32")]),
    ("GB82WEST12345698765432 OK", [("iban", "GB82WEST12345698765432")]),
    ("GB82WEST12345698765433 OK", []),
    ("DE89 3704 0044 0532 0130 00.", [("iban", "DE89 3704 0044 0532 0130 00")]),
    ("token = \"24be64439e3e49cf\"", [("secret", "token = \"24be64439e3e49cf")]),
    ("token: something", []),
])
def test_context_and_checks_decide(spark, text, wanted):
    row = pii.find_pii(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert [(s.kind, s.found) for s in row.spans if s.kind not in pii.BASE] == wanted


def test_threshold_moves_the_further_kinds(spark):
    df = spark.createDataFrame([(1, "part 078-05-1120, mail a@b.de")], "doc_id bigint, text string")
    kinds = {low: [s.kind for s in pii.find_pii(df, min_score=low).first().spans] for low in (0.0, 0.8, 1.0)}
    assert kinds == {0.0: ["email", "ssn"], 0.8: ["email"], 1.0: ["email"]}
