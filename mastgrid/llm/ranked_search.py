"""Rank all documents for many queries at once; what queries have in common is computed once.

Terms that the same items hold form a class. Pairs of classes that several items share are
mined round by round and become nodes of a graph in which each node is the sum of two others,
and each item the sum of a few nodes. Per block of documents every node's partial scores are
made once and combined along the graph, so a set of terms that many items share is added up
once and not once an item. Each task keeps the best rows of each item; those are merged.
"""
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mastgrid.functions.select import first_rows
from mastgrid.llm.texts import LOWER, blocks, utf8, words

TOP = 50
#: Items are searched in blocks of so many distinct terms, or one larger item, each a pass
#: over the documents; what a block sends to the tasks and the driver is bounded by it.
BLOCK_TERMS = 50_000
#: Partial scores held at a time: documents times nodes.
HELD_SCORES = 2_000_000
#: Fixed values of the score.
UNIT, FACTOR, FLAT, SLOPE = 1_000_000_000, 1000, 50, 20
NO_ID = np.iinfo(np.int64).max
MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


def _eights(data):
    """Every eight consecutive bytes as one number, the last ones filled with zeros."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))


class Terms:
    """Distinct terms, numbered; found in texts by hash and confirmed by their bytes."""

    def __init__(self, spelled):
        self.spelled = sorted(set(spelled))
        joined = np.frombuffer(b" ".join(self.spelled), np.uint8)
        starts, ends, hashes, _ = words(joined, np.array([0, len(joined)]))
        order = np.argsort(hashes, kind="stable")
        self.data, self.hashes = joined, hashes[order]
        self.starts, self.sizes = starts[order], (ends - starts)[order]
        self.spelled = [self.spelled[i] for i in order]
        # Terms that share a hash are neighbours; a word is held against each of them.
        _, alike = np.unique(self.hashes, return_counts=True)
        self.ways = int(alike.max()) if len(alike) else 0

    def __len__(self):
        return len(self.spelled)

    def counts(self, data, offsets):
        """``(n, row, term, tf)``: words per text, and each text's terms with their number."""
        starts, ends, hashes, first = words(data, offsets)
        n = np.diff(first).astype(np.int64)
        found = np.full(len(hashes), -1)
        if len(self) and len(hashes):
            low = int(offsets[0])
            text, own = _eights(LOWER[data[low:int(offsets[-1])]]), _eights(self.data)
            at = np.searchsorted(self.hashes, hashes)
            for way in range(self.ways):
                place = np.minimum(at + way, len(self) - 1)
                todo = np.flatnonzero((self.hashes[place] == hashes) & (found < 0))
                todo = todo[self.sizes[place[todo]] == (ends - starts)[todo]]
                mine, step = place[todo], 0
                while len(todo):
                    rest = self.sizes[mine] - step
                    same = (text[starts[todo] - low + step] ^ own[self.starts[mine] + step]) & MASKS[
                        np.minimum(rest, 8)] == 0
                    found[todo[same & (rest <= 8)]] = mine[same & (rest <= 8)]
                    more = same & (rest > 8)
                    todo, mine, step = todo[more], mine[more], step + 8
        at = np.flatnonzero(found >= 0)
        row = np.searchsorted(first, at, "right") - 1
        key, tf = np.unique(row * max(1, len(self)) + found[at], return_counts=True)
        return n, key // max(1, len(self)), key % max(1, len(self)), tf.astype(np.int64)


def shared_sums(sets):
    """``(rounds, roots)``: sums shared by several sets of numbers, and each set's nodes.

    A round is a list of pairs of nodes, numbered on from the greatest node so far. Numbers
    of a set are put in order of how many sets hold them; neighbours that stand together in
    two sets or more become one node, most frequent first, until no such pair is left.
    """
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    node = np.concatenate([np.asarray(s, np.int64) for s in sets]) if len(owner) else np.empty(0, np.int64)
    total = int(node.max()) + 1 if len(node) else 0
    rounds = []
    while True:
        often = np.bincount(node, minlength=total)
        order = np.lexsort((node, -often[node], owner))
        owner, node = owner[order], node[order]
        at = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, count = np.unique(np.stack([node[at], node[at + 1]], 1), axis=0, return_counts=True)
        chosen, used = {}, set()
        for i in np.argsort(-count, kind="stable"):
            a, b = pairs[i].tolist()
            if count[i] < 2:
                break
            if a not in used and b not in used:
                chosen[a, b] = total + len(chosen)
                used.update((a, b))
        if not chosen:
            return rounds, [node[owner == i] for i in range(len(sets))]
        rounds.append(np.array(list(chosen), np.int64))
        new = np.array([chosen.get(p, -1) for p in zip(node[at].tolist(), node[at + 1].tolist())], np.int64)
        hit = at[new >= 0]
        node[hit] = new[new >= 0]
        keep = np.ones(len(node), bool)
        keep[hit + 1] = False
        owner, node, total = owner[keep], node[keep], total + len(chosen)


class Queries:
    """The items of a block as sums over classes of terms."""

    def __init__(self, terms, items):
        self.terms = terms
        number = {term: i for i, term in enumerate(terms.spelled)}
        holders = [[] for _ in number]
        for i, item in enumerate(items):
            for term in item:
                holders[number[term]].append(i)
        classes = {}
        self.class_of = np.array(
            [classes.setdefault(tuple(sorted(h)), len(classes)) for h in holders], np.int64)
        sets = [[] for _ in items]
        for held, number in classes.items():
            for i in held:
                sets[i].append(number)
        self.n_items, self.n_classes = len(items), len(classes)
        self.rounds, roots = shared_sums(sets)
        self.n_nodes = self.n_classes + sum(map(len, self.rounds))
        # Items without terms match nothing and take no part.
        self.asked = np.array([i for i, r in enumerate(roots) if len(r)], np.int64)
        self.roots = np.concatenate([roots[i] for i in self.asked]) if len(self.asked) else None
        self.begins = np.cumsum([0] + [len(roots[i]) for i in self.asked])[:-1].astype(np.int64)
        self.weights = None

    def weigh(self, n_docs, total, held):
        """Take in the statistics: documents with terms, all their terms, holders by term."""
        self.n_docs, self.total = n_docs, total
        self.weights = np.floor(1000 * np.log((2.0 * n_docs + 2) / (2.0 * held + 1))).astype(np.int64)

    def scores(self, n, row, term, tf, n_rows):
        """Scores of the asked items, one row each, for ``n_rows`` documents."""
        m = 100 - FLAT + FLAT * n * self.n_docs // self.total
        part = self.weights[term] * (UNIT * tf // (FACTOR * tf + SLOPE * m[row]))
        held = np.zeros((self.n_nodes, n_rows), np.int64)
        np.add.at(held.reshape(-1), self.class_of[term] * n_rows + row, part)
        low = self.n_classes
        for pairs in self.rounds:
            np.add(held[pairs[:, 0]], held[pairs[:, 1]], out=held[low:low + len(pairs)])
            low += len(pairs)
        return np.add.reduceat(held[self.roots], self.begins, axis=0)


class Best:
    """The best ``k`` rows of each item: highest score, then smallest id."""

    def __init__(self, n_items, k):
        self.k = k
        self.item = self.score = self.doc = np.empty(0, np.int64)
        self.least = np.ones(n_items, np.int64)

    def add(self, scores, docs):
        item, column = np.nonzero(scores >= self.least[:, None])
        item = np.concatenate([self.item, item])
        score = np.concatenate([self.score, scores[item[len(self.item):], column]])
        doc = np.concatenate([self.doc, docs[column]])
        order = np.lexsort((doc, -score, item))
        item, score, doc = item[order], score[order], doc[order]
        first = np.searchsorted(item, np.arange(len(self.least)))
        place = np.arange(len(item)) - first[item]
        kept = place < self.k
        self.item, self.score, self.doc = item[kept], score[kept], doc[kept]
        full = place == self.k - 1
        self.least[item[full]] = score[full]


def _blocks_of(items, block_terms):
    """Items in order of their ids, a block at a time: ``[(id, terms)]``."""
    held, terms, seen = [], set(), object()
    for row in items.select("item_id", "text").orderBy("item_id").toLocalIterator():
        data, offsets = utf8(pa.array([row.text], pa.large_string()))
        starts, ends, _, _ = words(data, offsets)
        raw = LOWER[data].tobytes()
        mine = {raw[a:z] for a, z in zip(starts.tolist(), ends.tolist())}
        if held and row.item_id == seen:
            held[-1][1].update(mine)
        else:
            if len(terms) >= block_terms:
                yield held
                held, terms = [], set()
            held.append((row.item_id, mine))
            seen = row.item_id
        terms |= mine
    if held:
        yield held


def _statistics(rows, sent):
    """``(documents with terms, all terms, documents by term)`` of the whole table."""
    def count(batches):
        terms = sent.value.terms
        held, docs, total = np.zeros(len(terms), np.int64), 0, 0
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, z in blocks(offsets):
                n, _, term, _ = terms.counts(data, offsets[a:z + 1])
                held += np.bincount(term, minlength=len(terms))
                docs, total = docs + int((n > 0).sum()), total + int(n.sum())
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, [-1, -2])), pa.array(np.append(held[at], [docs, total]))],
            ["term", "n"])

    found = rows.mapInArrow(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    # A row per term of the block.
    sums = dict(found.collect())
    held = np.zeros(len(sent.value.terms), np.int64)
    for term, n in sums.items():
        if term >= 0:
            held[term] = n
    return sums.get(-1, 0), sums.get(-2, 0), held


def _ranked(rows, sent, k):
    """``item, doc_id, score``: the best rows of each item in each task."""
    def rank(batches):
        queries = sent.value
        best = Best(len(queries.asked), k)
        step = max(1, HELD_SCORES // max(1, queries.n_nodes))
        for batch in batches:
            ids = batch.column(0).fill_null(NO_ID).to_numpy()
            data, offsets = utf8(batch.column(1))
            for a, z in blocks(offsets):
                n, row, term, tf = queries.terms.counts(data, offsets[a:z + 1])
                for i in range(0, z - a, step):
                    j = min(z - a, i + step)
                    cut = slice(*np.searchsorted(row, [i, j]))
                    scores = queries.scores(n[i:j], row[cut] - i, term[cut], tf[cut], j - i)
                    best.add(scores, ids[a + i:a + j])
        yield pa.RecordBatch.from_arrays(
            [pa.array(queries.asked[best.item], pa.int64()), pa.array(best.doc, mask=best.doc == NO_ID),
             pa.array(best.score)], ["item", "doc_id", "score"])

    return rows.mapInArrow(rank, "item bigint, doc_id bigint, score bigint")


def search(docs, items, k=TOP, block_terms=BLOCK_TERMS):
    """``item_id, rank, doc_id, score``: the ``k`` documents of highest score above 0 per item.

    Equal scores go by id; rows without an id come last among them. Statistics cover all rows:
    each row of ``docs`` is a document, also where ids or texts repeat. Rows of ``items`` that
    share an id, or have none, are one item with the terms of all. NULL and empty texts have
    no terms; an item without terms, or an empty table on either side, gives no rows. Only
    ``doc_id``, ``text`` and ``item_id`` are read, so other columns can't clash.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    id_type = items.schema["item_id"].dataType.simpleString()
    whole = spark.createDataFrame([], f"item_id {id_type}, rank int, doc_id bigint, score bigint")
    for block in _blocks_of(items, block_terms):
        queries = Queries(Terms(t for _, terms in block for t in terms), [terms for _, terms in block])
        if not len(queries.asked):
            continue
        queries.weigh(*_statistics(rows, spark.sparkContext.broadcast(queries)))
        if not queries.total:
            continue
        best = _ranked(rows, spark.sparkContext.broadcast(queries), k)
        order = [F.desc("score"), F.asc_nulls_last("doc_id")]
        best = first_rows(best, k, ["item"], order)
        rank = F.row_number().over(Window.partitionBy("item").orderBy(*order))
        names = spark.createDataFrame(
            [(i, name) for i, (name, _) in enumerate(block)], f"item bigint, item_id {id_type}")
        found = best.withColumn("rank", rank).join(F.broadcast(names), "item")
        whole = whole.union(found.select("item_id", "rank", "doc_id", "score"))
    return whole
