"""Find benchmark passages in training texts by an FM-index per shard of texts."""
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from mastgrid.llm.fm_index import FMIndex
from mastgrid.llm.texts import blocks, utf8, words

WINDOW = 10
#: Benchmark text that is sent to every task at once, in bytes; a larger benchmark is searched
#: in blocks, one pass over the texts after another.
SENT_BYTES = 16_000_000
SPAN = "struct<start:int,end:int,from_byte:bigint,to_byte:bigint>"
FOUND = f"n_words bigint, spans array<{SPAN}>, items array<string>"
SPAN_TYPE = pa.list_(pa.struct([
    ("start", pa.int32()), ("end", pa.int32()), ("from_byte", pa.int64()), ("to_byte", pa.int64())]))


class Passages:
    """The distinct windows of some benchmark items, as word numbers.

    An item of fewer than WINDOW words, but not none, is one window. Words are numbered by
    the order of their hashes, from 1.
    """

    def __init__(self, items):
        texts = pa.array([text for _, text in items], pa.large_string())
        data, offsets = utf8(texts)
        starts, ends, hashes, first = words(data, offsets)
        self.hashes, places = np.unique(hashes, return_index=True)
        raw = data.tobytes().lower()
        self.spelled = [raw[starts[i]:ends[i]] for i in places]
        if any(raw[starts[i]:ends[i]] != self.spelled[k]
               for i, k in enumerate(np.searchsorted(self.hashes, hashes))):
            raise ValueError("two benchmark words share a hash; use another seed")
        numbers = np.searchsorted(self.hashes, hashes) + 1
        owners = defaultdict(set)
        for i, (item, _) in enumerate(items):
            own = tuple(numbers[first[i]:first[i + 1]].tolist())
            size = min(WINDOW, len(own))
            for k in range(len(own) - size + 1) if size else ():
                owners[own[k:k + size]].add(str(item))
        self.by_length = {}
        for size in sorted({len(w) for w in owners}):
            mine = [w for w in owners if len(w) == size]
            self.by_length[size] = (np.array(mine, np.int64), [sorted(owners[w]) for w in mine])

    def scan(self, data, offsets):
        """Per text of a shard: number of words, spans of hit words, items that occur."""
        starts, ends, hashes, first = words(data, offsets)
        n_rows = len(offsets) - 1
        spans, items = {}, defaultdict(set)
        if self.by_length and len(hashes):
            numbers = np.searchsorted(self.hashes, hashes)
            known = self.hashes[np.minimum(numbers, len(self.hashes) - 1)] == hashes
            numbers = np.where(known, numbers + 1, 0)
            covered = self._covered(numbers, first, items)
            wrong = [i for i in np.flatnonzero(covered) if
                     data[starts[i]:ends[i]].tobytes().lower() != self.spelled[numbers[i] - 1]]
            if wrong:  # a word of the texts has the hash of another word
                numbers[wrong] = 0
                items.clear()
                covered = self._covered(numbers, first, items)
            cut = np.zeros(len(covered) + 1, bool)
            cut[first] = True
            opens = np.flatnonzero(covered & (cut[:-1] | ~np.concatenate([[False], covered[:-1]])))
            closes = np.flatnonzero(covered & (cut[1:] | ~np.concatenate([covered[1:], [False]])))
            rows = np.searchsorted(first, opens, "right") - 1
            for row, a, b in zip(rows.tolist(), opens.tolist(), closes.tolist()):
                base = int(first[row])
                spans.setdefault(row, []).append((
                    a - base, b + 1 - base, int(starts[a] - offsets[row]),
                    int(ends[b] - offsets[row])))
        return np.diff(first), spans, {row: items[row] for row in spans}, n_rows

    def _covered(self, numbers, first, items):
        """Words inside an occurrence of a window; adds the items found to ``items`` by text."""
        covered = np.zeros(len(numbers) + 1, np.int64)
        # A run of benchmark words shorter than every window can't hold one, so the index is
        # built over the longer runs, each closed by a zero.
        inside = numbers > 0
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        cut = first[:-1][first[:-1] < len(numbers)]
        begins[cut] = inside[cut]
        run_start = np.flatnonzero(begins)
        stop = ~inside
        stop[run_start] = True
        stops = np.append(np.flatnonzero(stop), len(numbers))
        run_end = stops[np.searchsorted(stops, run_start, "right")]
        long = run_end - run_start >= min(self.by_length)
        run_start, run_end = run_start[long], run_end[long]
        if not len(run_start):
            return covered[:-1] > 0
        lengths = run_end - run_start + 1
        ends = np.cumsum(lengths)
        where = np.arange(ends[-1]) + np.repeat(run_start - (ends - lengths), lengths)
        symbols = numbers[np.minimum(where, len(numbers) - 1)]
        symbols[ends - 1] = 0
        index = FMIndex(symbols, len(self.hashes))
        for size, (patterns, owners) in self.by_length.items():
            low, high = index.search(patterns)
            hit = np.flatnonzero(high > low)
            count = (high - low)[hit]
            if not len(hit):
                continue
            offset = np.cumsum(count) - count
            rows = np.arange(count.sum()) + np.repeat(low[hit] - offset, count)
            place = where[index.locate(rows)]
            np.add.at(covered, place, 1)
            np.add.at(covered, place + size, -1)
            found = np.unique(np.stack([
                np.searchsorted(first, place, "right") - 1, np.repeat(hit, count)], 1), axis=0)
            for row, pattern in found.tolist():
                items[row].update(owners[pattern])
        return np.cumsum(covered)[:-1] > 0


def _merged(a, b):
    """Two lists of spans as one, touching ones joined only where they overlap in a window."""
    out = []
    for span in sorted(a + b):
        if out and span[0] <= out[-1][1]:
            if span[1] > out[-1][1]:
                out[-1] = (out[-1][0], span[1], out[-1][2], span[3])
        else:
            out.append(span)
    return out


def _benchmark_blocks(benchmark, sent_bytes):
    """Items of the benchmark a block at a time, so the driver holds one block's texts."""
    held, size = [], 0
    for row in benchmark.select("item_id", "text").filter("text IS NOT NULL").toLocalIterator():
        held.append((row.item_id, row.text))
        size += len(row.text.encode())
        if size >= sent_bytes:
            yield held
            held, size = [], 0
    yield held


def find_passages(docs, benchmark, keep=("doc_id",), sent_bytes=SENT_BYTES):
    """The ``keep`` columns with ``n_words``, merged ``spans`` of hit words, and ``items``.

    Texts are lower-cased (A-Z) and cut into words; a word is hit if it lies in an occurrence
    of a window of benchmark words. Spans count words and bytes of the text. A NULL text has
    no words; repeated rows are read each on its own; an empty benchmark hits nothing.
    """
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text"))
    rows = rows.selectExpr(
        "*", "CAST(0 AS BIGINT) AS n_words", f"CAST(array() AS array<{SPAN}>) AS spans",
        "CAST(array() AS array<string>) AS items")
    schema = rows.schema
    for held in _benchmark_blocks(benchmark, sent_bytes):
        rows = rows.mapInArrow(_pass(rows.sparkSession.sparkContext.broadcast(Passages(held))), schema)
    return rows


def _pass(sent):
    def scan(batches):
        passages = sent.value
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for a, b in blocks(offsets):
                part = batch.slice(a, b - a)
                n_words, spans, items, n = passages.scan(data, offsets[a:b + 1])
                all_spans = part.column("spans").to_pylist()
                all_items = part.column("items").to_pylist()
                for row, new in spans.items():
                    old = [tuple(s.values()) for s in all_spans[row]]
                    all_spans[row] = [
                        dict(zip(("start", "end", "from_byte", "to_byte"), s))
                        for s in _merged(old, new)]
                    all_items[row] = sorted(items[row].union(all_items[row]))
                arrays = [part.column(c) for c in part.schema.names[:-3]]
                arrays += [pa.array(n_words, pa.int64()), pa.array(all_spans, SPAN_TYPE),
                           pa.array(all_items, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(arrays, part.schema.names)

    return scan


def n_hit(spans="spans"):
    """Hit words of a text."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda a, s: a + (s["end"] - s["start"]))


def _cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
    def cut(text, found):
        if text is None or found is None or not len(found):
            return text
        raw, out, at = text.encode(), [], 0
        for s in found:
            out.append(raw[at:s["from_byte"]])
            at = s["to_byte"]
        return b"".join(out + [raw[at:]]).decode()

    return pd.Series([cut(t, s) for t, s in zip(texts, spans)], dtype=object)


def without_spans(text="text", spans="spans"):
    """Texts with the bytes of their spans taken out."""
    return F.pandas_udf(_cut, "string")(text, spans)


def clean_documents(docs, benchmark):
    """The rows of ``docs``, all columns, without any hit word."""
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), "text")
    found = find_passages(rows, benchmark, keep=("row",)).filter(F.size("spans") == 0)
    return found.select(*[F.col("row").getField(c).alias(c) for c in names])
