"""Token alignment against a plain version that reads whole texts."""
from collections import Counter

import pytest

from mastgrid.llm import token_align

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain():
    import sentencepiece
    from tokenizers import Tokenizer

    import public_tokenizers

    path_b = token_align.default_paths()[1]
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=path_b)
    symbols = token_align.byte_symbols()
    names_a = {i: p for p, i in a.get_vocab().items()}

    def tokens(text):
        """Both lists of (id, bytes)."""
        if not text:
            return [], []
        one = [(i, bytes(symbols[c] for c in names_a[i]))
               for i in a.encode(" " + text, add_special_tokens=False).ids]
        other = []
        for i in b.encode(text):
            piece = b.id_to_piece(i)
            other.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i)
                          else piece.replace("▁", " ").encode()))
        raw = (" " + text).encode()
        if b"".join(x for _, x in one) != raw or b"".join(x for _, x in other) != raw:
            return [], []
        return one, other

    def spans(side):
        at, out = 0, []
        for i, x in side:
            out.append((at, at + len(x), i))
            at += len(x)
        return out

    def run(docs):
        laid = [(i, *map(spans, tokens(t))) for i, t in docs]
        links = []
        for _, one, other in laid:
            mine, low = [], 0
            for s, e, i in one:
                while low < len(other) and other[low][1] <= s:
                    low += 1
                j = low
                while j < len(other) and other[j][0] < e:
                    mine.append((i, other[j][2]))
                    j += 1
            links.append(mine)
        count = Counter(x for mine in links for x in mine)
        most = {}
        for (_, j), n in count.items():
            most[j] = max(n, most.get(j, 0))
        out = []
        for (doc, one, other), mine in zip(laid, links):
            common = sorted({e for _, e, _ in one} & {e for _, e, _ in other})
            groups, low = [], 0
            for end in common:
                sides = [",".join(str(i) for s, e, i in side if low < e <= end) for side in (one, other)] if (
                    len(common) < 400) else None
                groups.append("|".join(sides) if sides else None)
                low = end
            said = (";".join(groups) if len(common) < 400 else "long") if common else None
            out.append((doc, len(one), len(other), len(common), len(mine),
                        sum(count[x] == most[x[1]] for x in mine), sum(count[x] for x in mine), said))
        return out

    return run


AWKWARD = [
    None, "", " ", "  ", "\n", "a", " a", "a ", "  a  b   c ", "a \n b\t c\n\n\nd", "don't you'll  we're", "<|endoftext|> <s> </s>",
    "x▁y", "▁ ", "a ▁b", "漢字 漢字。かな", "😀😀 👩‍👩‍👧 é é", "\x00\x01 \x7f", "1234567890 12 3",
    "a b   c　d", "a\x1cb \x85 c", "ab" * 3000, "==== ---- ....", "word " * 50, "word " * 50,
    "Ünïcödé ÑÑÑ ß", "\r\n x \r\n", "﻿start end​", "'s 's's", "tab\tspace \tboth\t ",
]


def rows_of(found):
    return sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum,
                    r.groups if r.n_groups < 400 else "long") for r in found), key=str)


def test_equals_plain_version(spark, plain, monkeypatch):
    docs = list(enumerate(AWKWARD)) + [(3, "a b"), (3, "a b"), (None, "the end")]
    table = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(6)
    for sent_pairs in (2_000_000, 50):
        found = token_align.align(table, sent_pairs=sent_pairs).collect()
        assert rows_of(found) == sorted(plain(docs), key=str)


def test_equals_plain_version_on_documents(spark, plain):
    table = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    docs = [tuple(r) for r in table.collect()]
    assert rows_of(token_align.align(table).collect()) == sorted(plain(docs), key=str)


def test_both_forms_of_a(spark):
    import public_tokenizers

    paths = public_tokenizers.path("byte_bpe_50k.json"), token_align.default_paths()[1]
    table = spark.createDataFrame(list(enumerate(AWKWARD)), "doc_id bigint, text string")
    assert rows_of(token_align.align(table, paths).collect()) == rows_of(token_align.align(table).collect())


def test_starting_anew_changes_nothing(plain, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(token_align, "REMEMBERED", 5)
    monkeypatch.setattr(token_align, "CHUNK_CHARS", 40)
    paths = token_align.default_paths()
    token_align._loaded.cache_clear()
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(AWKWARD))), pa.array(AWKWARD, pa.string())], ["doc_id", "text"])
    counts = Counter()
    for part in token_align._count_pairs(paths)([batch]):
        counts.update(dict(zip(*[c.to_pylist() for c in part.columns])))

    class Sent:
        value = None

    import numpy as np
    most = {}
    for pair, n in counts.items():
        most[pair % token_align.SHIFT] = max(n, most.get(pair % token_align.SHIFT, 0))
    pairs = sorted(counts)
    Sent.value = (np.array(pairs), np.array([counts[p] for p in pairs]),
                  np.array([counts[p] == most[p % token_align.SHIFT] for p in pairs]))
    found = []
    for part in token_align._add_counts(paths, Sent, True)([batch]):
        columns = [c.to_pylist() for i, c in enumerate(part.columns) if i != 1]
        found += [r if r[3] < 400 else (*r[:-1], "long") for r in zip(*columns)]
    assert found == plain(list(enumerate(AWKWARD)))
    token_align._loaded.cache_clear()


def test_edges(spark, edge_docs, no_docs):
    clash = edge_docs.withColumn("n_a", edge_docs.doc_id).withColumn("row", edge_docs.doc_id)
    found = token_align.align(clash, keep=("doc_id", "source", "row")).collect()
    assert len(found) == edge_docs.count()
    none = [r for r in found if r.doc_id in (1, 2)]
    assert len(none) == 2 and all(r.groups is None and r.n_links == 0 == r.count_sum for r in none)
    assert token_align.align(no_docs).collect() == []
