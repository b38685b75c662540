"""Registered queries against DuckDB, and edge cases of every operator."""
import os
import re
import sys

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import corpus_pipeline  # noqa: E402
from mastgrid.llm import (  # noqa: E402
    bag_minhash, chat, decontaminate, line_dedup, mixing, pii, quality, suffix_dedup, token_count,
    token_shards,
)
from mastgrid.llm.queries import ORACLES, QUERIES  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(name, spark):
    duck = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    wanted = duck.execute(ORACLES[name])
    names = sorted(c[0] for c in wanted.description)
    order = [[c[0] for c in wanted.description].index(n) for n in names]
    expected = sorted(tuple(r[i] for i in order) for r in wanted.fetchall())
    found = QUERIES[name](spark, DATA)
    assert sorted(found.columns) == names
    assert sorted(tuple(r) for r in found.select(*names).collect()) == expected and expected


OPERATORS = {
    "pii": pii.find_pii,
    "lines": line_dedup.dedup_lines,
    "near": bag_minhash.near_duplicates,
    "mix": mixing.mix,
    "quality": quality.ledger,
    "substrings": suffix_dedup.dedup_substrings,
    "tokens": token_count.count_tokens,
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_edges(name, edge_docs, no_docs):
    found = OPERATORS[name](edge_docs).collect()
    assert len(found) == edge_docs.count()
    assert OPERATORS[name](no_docs).collect() == []


def test_quality_of_edges(spark, edge_docs, no_docs):
    rows = quality.ledger(edge_docs.withColumn("n_words", F.lit(9))).collect()
    found = {r.doc_id: r for r in rows}
    assert [tuple(found[1])[1:8], found[1].fail_bits] == [(0,) * 7, 1] and tuple(found[2])[1:] == tuple(found[1])[1:]
    assert found[3].n_words == 1 and found[4].n_words == 30_000 == found[5].n_words
    assert found[4].n_repeat_words == 30_000 and found[10].word_chars == 5000
    assert found[8].n_words == 1 and found[7].n_words == 0 and found[11].n_words == 4000
    good = spark.createDataFrame(
        [(1, None, 1), (2, "", 2), (3, " ".join(f"w{i}" for i in range(60)), 3)] * 2,
        "doc_id bigint, text string, n_words int")
    kept = quality.keep_good(good)
    assert kept.columns == good.columns and [tuple(r)[::2] for r in kept.collect()] == [(3, 3)] * 2
    assert quality.keep_good(no_docs).collect() == []


def test_near_edges(edge_docs):
    found = {r.doc_id: r.class_id for r in bag_minhash.near_duplicates(edge_docs).collect()}
    assert found[5] == 4 and found[9] == 8 and found[2] == 1 and found[None] is None
    assert found[3] == 3 and found[11] == 11


def test_passage_edges(spark, edge_docs, no_docs):
    benchmark = spark.createDataFrame(
        [(1, None), (2, ""), (3, "ONE"), (4, " ".join(f"Word{i}" for i in range(12)))],
        "item_id bigint, text string")
    found = decontaminate.find_passages(edge_docs, benchmark).collect()
    items = {r.doc_id: r["items"] for r in found}
    assert items[3] == ["3"] and items[5] == ["4"] and items[1] == [] == items[None]
    split = decontaminate.find_passages(edge_docs, benchmark, sent_bytes=1).collect()
    assert sorted(map(str, split)) == sorted(map(str, found))
    assert decontaminate.find_passages(no_docs, benchmark).count() == 0
    assert decontaminate.clean_documents(edge_docs, benchmark).count() == edge_docs.count() - 4
    cut = decontaminate.find_passages(edge_docs, benchmark, keep=("doc_id",)).filter("doc_id = 3")
    assert cut.select(decontaminate.without_spans().alias("t")).first().t == ""


def test_chat_edges(spark):
    said = [(1, 0, "user", "hi"), (2, 0, "user", "hi"), (2, 1, "assistant", "yo"), (3, 0, None, None),
            (4, 0, "user", None), (5, 0, "user", "hi"), (5, 1, "assistant", "yo"), (None, 0, "user", "x")]
    rows = spark.createDataFrame(said, "conv_id bigint, turn bigint, role string, text string")
    found = {r.conv_id: r for r in chat.render(rows).collect()}
    assert set(found) == {2, 3, 4, None} and found[2].n_logs == 2
    assert found[2].text == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nyo<|im_end|>\n"
    assert found[3].text == "<|im_start|>unknown\n<|im_end|>\n"
    assert chat.render(rows.limit(0)).count() == 0


def test_pii_spans(spark):
    text = ("é mail a.b@c.de_f@g.org host 1.2.3.4.5.6.7.8 256.1.1.1 card 4111 1111 1111 1111 "
            "4111 1111 1111 1112 call +1 (555) 123-4567 iban GB82 WEST 1234 5698 7654 32 end")
    row = pii.find_pii(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    kinds = [(s.kind, text[s.start:s.end]) for s in row.spans]
    assert ("email", "a.b@c.de") in kinds and ("email", "_f@g.org") in kinds
    assert [t for k, t in kinds if k == "ip"] == ["1.2.3.4", "5.6.7.8"]
    assert ("phone", "+1 (555) 123-4567") in kinds
    assert ("iban", "GB82 WEST 1234 5698 7654 32") in kinds
    many = " ".join(f"u{i}@h.org" for i in range(700))
    row = pii.find_pii(spark.createDataFrame([(1, many)], "doc_id bigint, text string")).first()
    assert [many[s.start:s.end] for s in row.spans] == many.split()


def test_quality_ablations(spark):
    rows = quality.ledger(spark.read.parquet(f"{DATA}/documents.parquet")).cache()
    found = {r.rule: r for r in quality.ablations(rows).collect()}
    assert set(found) == set(quality.RULES)
    assert found["few_words"].n_failed == rows.filter("n_words < 50").count()
    assert found["symbols"].n_failed_alone == rows.filter("fail_bits = 4").count()


def test_token_counts_equal_library(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=token_count.default_model())
    texts = [r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    texts += ["", " ", "  a\n\n b\t", "▁▁x ▁", "<s></s><unk>", "漢字😀\x00", "a" * 300]
    counts = token_count.PieceCounts(token_count.default_model())
    assert [counts.tokens(t) for t in texts] == [len(x) for x in library.encode(texts)]


def test_training_order_round_trip(spark, tmp_path, edge_docs):
    length, per_shard = 16, 64
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(40)
    rows = token_shards.training_order(docs, length, per_shard)
    path = str(tmp_path / "shards")
    token_shards.write_shards(rows, path)
    found = rows.orderBy("slot").collect()
    assert [r.slot for r in found] == list(range(len(found)))
    for shard in {r.shard for r in found}:
        files = [f for f in os.listdir(f"{path}/shard={shard}") if f.startswith("part-")]
        assert len(files) == 1
        raw = open(f"{path}/shard={shard}/{files[0]}", "rb").read()
        for r in found:
            if r.shard == shard:
                assert raw[r.byte_offset:r.byte_offset + 2 * length] == bytes(r.record)
                assert r.byte_offset == r.slot % per_shard * token_shards.stride(length)
    encoding, parts = token_shards.encoding(), {}
    for r in found:
        parts.setdefault(r.doc_id, {})[r.seq_no] = bytes(r.record)[:2 * r.n_tokens]
    for doc in docs.collect():
        got = b"".join(parts[doc.doc_id][k] for k in sorted(parts[doc.doc_id]))
        tokens = [int.from_bytes(got[i:i + 2], "little") for i in range(0, len(got), 2)]
        assert encoding.decode(tokens) == doc.text
    assert token_shards.training_order(edge_docs.limit(0)).count() == 0
    assert token_shards.training_order(edge_docs).count() > 100


def plain_feistel(x, n, key=token_shards.KEY):
    """The permutation on one Python integer, turn by turn."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    word = 2**64
    while True:
        left, right = x >> half, x % 2**half
        for turn in range(token_shards.ROUNDS):
            h = (right * 0x9E3779B97F4A7C15 + key * 1_000_003 + turn) % word
            h = (h ^ h >> 31) * 0xBF58476D1CE4E5B9 % word
            left, right = right, left ^ (h ^ h >> 29) % 2**half
        x = left << half | right
        if x < n:
            return x


def test_slots_do_not_depend_on_the_layout(spark):
    """Slots are the permuted rank by id, text hash and place, under three layouts."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(300)
    twice = docs.unionByName(docs.filter("doc_id % 7 = 0"))
    layouts = [twice.coalesce(1), twice.repartition(5), twice.orderBy("n_chars").repartition(11, "lang")]
    found = [sorted(tuple(r) for r in token_shards.training_order(d, 16, 64).select(
        "slot", "doc_id", "seq_no", "n_tokens", "record").collect()) for d in layouts]
    assert found[0] == found[1] == found[2]
    hashed = twice.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()
    encode, number = token_shards.encoding().encode_ordinary, []
    for r in sorted(hashed, key=lambda r: (r.doc_id, r.h)):
        number += [(r.doc_id, k) for k in range(-(-len(encode(r.text)) // 16))]
    slots = sorted((plain_feistel(x, len(number)), *pair) for x, pair in enumerate(number))
    assert [r[:3] for r in found[0]] == slots


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000, 65_537])
def test_feistel_is_a_permutation(n):
    assert sorted(token_shards.feistel(range(n), n)) == list(range(n))


def plain_substrings(rows):
    """Kept bytes by id, texts in order of their ids."""
    seen, kept = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - 99):
            if raw[s:s + 100] in seen:
                gone[s:s + 100] = b"\1" * 100
            seen.add(raw[s:s + 100])
        kept[doc_id] = bytes(x for x, g in zip(raw, gone) if not g)
    return kept


def test_substrings_by_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    found = {r.doc_id: bytes(r.kept) for r in suffix_dedup.dedup_substrings(docs.repartition(7)).collect()}
    assert found == plain_substrings([(r.doc_id, r.text) for r in docs.collect()])


def test_substrings_across_tasks(spark, monkeypatch):
    """Periodic texts, cut copies, copies inside one text, in tiny batches over many tasks."""
    import random

    draw = random.Random(9)
    base = ["".join(draw.choice("abcdé ") for _ in range(700)) for _ in range(4)]
    texts = [None, "", "a" * 99, "a" * 100, "a" * 1500, "ab" * 400, "ba" * 400, base[0] + base[0]]
    for _ in range(60):
        x, y = draw.sample(base, 2)
        i, j = sorted(draw.sample(range(700), 2))
        texts.append(x[i:j] + "".join(draw.choice("xyz") for _ in range(draw.randint(0, 30))) + y[j - i:])
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(13)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
        found = {r.doc_id: bytes(r.kept) for r in suffix_dedup.dedup_substrings(docs).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert found == plain_substrings(rows)


def test_long_texts_are_sorted_in_parts(monkeypatch):
    import numpy as np
    draw = np.random.default_rng(2)
    text = "".join(map(chr, draw.integers(97, 101, 30_000))) * 2
    runs = pa.array([[{"start": 0, "n": 59_000}, {"start": 59_000, "n": 5000}]],
                    pa.list_(pa.struct([("start", pa.int64()), ("n", pa.int64())])))
    batch = pa.RecordBatch.from_arrays([pa.array([5]), pa.array([text]), runs], ["doc_id", "text", "runs"])
    whole = {}
    for part in (100_000, 7_001):
        monkeypatch.setattr(suffix_dedup, "SORT_WINDOWS", part)
        rows = pa.Table.from_batches(list(suffix_dedup._compare_windows([batch])))
        starts = [s + i for s, n in zip(rows.column("start").to_pylist(), rows.column("n").to_pylist())
                  for i in range(n)]
        assert sorted(starts) == list(range(60_000 - 99))
        whole[part] = [(r["start"], r["n"]) for r in rows.to_pylist() if r["kind"] == suffix_dedup.COVERED]
    assert whole[100_000] == [(30_000, 30_000 - 99)]


def test_suffix_order_is_the_order_of_bytes():
    import numpy as np

    for seed, letters in ((1, "ab"), (2, "abcdefgh"), (3, "a")):
        draw = np.random.default_rng(seed)
        text = "".join(draw.choice(list(letters), 400)) + "abab" * 60 + "".join(draw.choice(list(letters), 300))
        text = (text * 2).encode()
        data = np.frombuffer(text, np.uint8)
        starts = draw.permutation(len(data) - 99)
        sums = suffix_dedup.FIRST_HASH.prefixes(data)
        order, same = suffix_dedup.suffix_order(data, starts, suffix_dedup.FIRST_HASH, sums)
        said = [text[s:s + 100] for s in starts[order]]
        assert said == sorted(said)
        assert [(x == y) for x, y in zip(said, said[1:])] == same.tolist()


def plain_classes(rows):
    """Class of every id by comparing all pairs of texts."""
    from collections import Counter

    def bag(text):
        found = re.findall("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+", (text or "").translate(
            {c: c + 32 for c in range(65, 91)}))
        size = min(5, len(found))
        return Counter(tuple(found[i:i + size]) for i in range(len(found) - size + 1)) if size else (text or "")

    bags = {i: bag(t) for i, t in rows}
    label = {i: i for i in bags}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in bags:
        for j in bags:
            if i < j:
                a, b = bags[i], bags[j]
                if isinstance(a, Counter) and isinstance(b, Counter):
                    common = (a & b).total()
                    alike = common >= 0.8 * (a.total() + b.total() - common) - 1e-9
                else:
                    alike = a == b
                if alike:
                    x, y = sorted((root(i), root(j)))
                    label[y] = x
    return {i: root(i) for i in bags}


def test_near_duplicates_by_brute_force(spark):
    """Planted pairs from barely to very similar, in several partitions: no link is lost."""
    import random

    draw = random.Random(4)
    texts = [r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").select("text").limit(60).collect()]
    for share in (0.5, 1, 1.5, 2, 2.5, 3, 4, 6):
        for _ in range(6):
            base = [f"w{draw.randint(0, 400)}" for _ in range(draw.randint(60, 160))]
            other = list(base)
            for _ in range(max(1, int(len(base) * share / 100))):
                other[draw.randrange(len(other))] = "new"
            texts += [" ".join(base), " ".join(other)]
    rows = list(enumerate(texts)) + [(5000, None), (5001, ""), (5002, "!!"), (5003, "!!")]
    wanted = plain_classes(rows)
    assert len(set(wanted.values())) < len(rows) - 20
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    found = {r.doc_id: r.class_id for r in bag_minhash.near_duplicates(docs).collect()}
    assert found == wanted


def test_pipeline(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, DATA).cache()
        assert kept.columns == names and 0 < kept.count()
        docs = kept
    classes = bag_minhash.near_duplicates(docs)
    assert classes.select(F.count_distinct("class_id")).first()[0] == docs.select("doc_id").distinct().count()
    found = decontaminate.find_passages(docs, spark.read.parquet(f"{DATA}/benchmark.parquet"))
    assert found.filter(F.size("spans") > 0).count() == 0


def test_compared_pairs_do_not_depend_on_blocks(monkeypatch):
    from collections import Counter

    def bag(text):
        words = (text or "").split()
        return Counter(tuple(words[i:i + 5]) for i in range(max(len(words) - 4, min(len(words), 1))))

    one = " ".join(f"w{i}" for i in range(60))
    texts = [one, one + " more", one.replace("w30", "x"), "", None, one + " " + one, "w1 w2"]
    pairs = [(i, j, a, b) for i, a in enumerate(texts) for j, b in enumerate(texts)]
    wanted = []
    for i, j, a, b in pairs:
        common, joint = (bag(a) & bag(b)).total(), (bag(a) | bag(b)).total()
        if joint and common >= 0.8 * joint:
            wanted.append((i, j))
    assert 5 < len(wanted) < len(pairs) - 20
    kinds = pa.int64(), pa.int64(), pa.string(), pa.string()
    batch = pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*pairs), kinds)], ["u", "v", "a", "b"])
    for size in (1, 700, 1_000_000):
        monkeypatch.setattr(bag_minhash, "BLOCK_BYTES", size)
        # The second part of the batch keeps its offsets in the whole.
        parts = [batch.slice(0, 20), batch.slice(20), batch.slice(0, 0)]
        rows = pa.Table.from_batches(bag_minhash._overlaps(parts)).to_pylist()
        assert [(r["u"], r["v"]) for r in rows] == wanted
