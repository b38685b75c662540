"""Ranked search against a plain Python version."""
import math
import random
import re

import numpy as np

from mastgrid.llm import ranked_search

TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
LOWER = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def terms(text):
    return re.findall(TERM, (text or "").translate(LOWER))


def plain(docs, items, k):
    said = [(i, terms(t)) for i, t in docs]
    said = [(i, w) for i, w in said if w]
    n_docs, total = len(said), sum(len(w) for _, w in said)
    held = {}
    for _, w in said:
        for t in set(w):
            held[t] = held.get(t, 0) + 1
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, wanted in asked.items():
        scores = []
        for i, w in said:
            m = 100 - 50 + 50 * len(w) * n_docs // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[t] + 1)))
                * (1_000_000_000 * w.count(t) // (1000 * w.count(t) + 20 * m))
                for t in wanted if t in w)
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores)[:k], start=1)]
    return sorted(out, key=str)


def table(spark, docs, items):
    return (spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5),
            spark.createDataFrame(items, "item_id bigint, text string"))


def awkward():
    draw = random.Random(3)
    # Long words, words alike but for their end, other alphabets, repeats, ties.
    vocabulary = [f"w{i}" for i in range(60)] + ["é" * n for n in (1, 4, 5, 9)] + [
        "a" * n for n in (7, 8, 9, 16, 17, 300)] + ["Äpfel", "äpfel", "漢字", "ſ", "K", "k"]
    docs = [(i, " ".join(draw.choice(vocabulary) for _ in range(draw.randint(0, 40)))) for i in range(300)]
    docs += [(i + 1000, t) for i, t in docs[:60]] + [(7, "w1 w2"), (7, "w1 w2"), (None, "w1 W2 w3"), (8, None)]
    items = [(i, " ".join(draw.choice(vocabulary) for _ in range(draw.randint(1, 25)))) for i in range(40)]
    items += [(3, "w5 w6 unheard"), (None, "w1"), (None, "w9"), (50, None), (51, "..."), (52, "unheard of")]
    return docs, items


def test_equals_plain_version(spark):
    docs, items = awkward()
    for k, block_terms in ((5, 50_000), (50, 20)):
        found = ranked_search.search(*table(spark, docs, items), k=k, block_terms=block_terms).collect()
        assert sorted(map(tuple, found), key=str) == plain(docs, items, k)


def test_small_chunks(spark, monkeypatch):
    docs, items = awkward()
    monkeypatch.setattr(ranked_search, "HELD_SCORES", 1)
    queries = ranked_search.Queries(
        ranked_search.Terms([b"w1", b"w2", b"w3"]), [{b"w1", b"w2"}, {b"w1", b"w2", b"w3"}, set()])
    assert queries.n_classes == 2 and queries.asked.tolist() == [0, 1]
    found = ranked_search.search(*table(spark, docs, items)).collect()
    assert sorted(map(tuple, found), key=str) == plain(docs, items, 50)


def test_shared_sums_are_exact_and_fewer():
    draw = np.random.default_rng(1)
    common = list(range(20))
    sets = [sorted(set(common[: draw.integers(5, 20)]) | set(draw.integers(20, 400, 10).tolist()))
            for _ in range(80)]
    rounds, roots = ranked_search.shared_sums(sets)
    value = {i: 2**i for i in range(401)}
    node = max(max(s) for s in sets) + 1
    for pairs in rounds:
        for a, b in pairs.tolist():
            value[node], node = value[a] + value[b], node + 1
    assert [sum(value[n] for n in r.tolist()) for r in roots] == [sum(2**x for x in s) for s in sets]
    additions = sum(map(len, rounds)) + sum(len(r) - 1 for r in roots)
    assert additions < 0.8 * sum(len(s) - 1 for s in sets)
    assert ranked_search.shared_sums([[], []])[0] == []


def test_terms_with_one_hash(monkeypatch):
    monkeypatch.setattr(ranked_search, "words", lambda d, o: (lambda s, e, h, f: (s, e, h * 0, f))(
        *_words(d, o)))
    found = ranked_search.Terms([b"ab", b"cd", b"abcdefghij"])
    data = np.frombuffer(b"cd ab ab abcdefghij abcdefghik xy", np.uint8)
    n, row, term, tf = found.counts(data, np.array([0, len(data)]))
    assert n.tolist() == [6]
    assert {found.spelled[t]: c for t, c in zip(term, tf.tolist())} == {
        b"cd": 1, b"ab": 2, b"abcdefghij": 1}


_words = ranked_search.words


def test_edges(spark, edge_docs, no_docs):
    items = spark.createDataFrame([(1, "one"), (2, "word5 a"), (3, "")], "item_id bigint, text string")
    found = ranked_search.search(edge_docs, items).collect()
    assert [r.doc_id for r in found if r.item_id == 1] == [3]
    assert sorted(r.doc_id for r in found if r.item_id == 2) == [4, 5, 5, 11]
    assert {r.item_id for r in found} == {1, 2}
    assert ranked_search.search(no_docs, items).collect() == []
    assert ranked_search.search(edge_docs, items.limit(0)).collect() == []
