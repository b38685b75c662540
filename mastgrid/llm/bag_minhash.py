"""Near-duplicates by weighted Jaccard similarity of word-shingle multisets.

BagMinHash: every shingle starts Poisson processes over weight, one per dyadic interval of the
weights up to its own. A point of a process has a time, a component of the signature and a
weight; it counts if the weight is below the shingle's. The first point of each component is
the signature, so two texts agree in a component with the probability of their weighted
Jaccard similarity. Bands of components propose pairs, which are verified on the multisets.
"""
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mastgrid.functions.durable import durable
from mastgrid.llm.components import components
from mastgrid.llm.texts import blocks, mixed, utf8, words

SHINGLE, SIMILARITY = 5, 0.8
#: 30 bands of 5: a pair at 0.8 shares no band with probability 7e-6.
BANDS, BAND_ROWS = 30, 5
#: Texts are worked on so many bytes and rows at a time, or one longer text.
BLOCK_BYTES, BLOCK_ROWS = 1_000_000, 2_048
#: Rounds in which unconnected members of a bucket are compared with one of them.
STAR_ROUNDS = 2
SCHEMA = "doc_id bigint, k1 bigint, k2 bigint, n_shingles bigint, bands array<bigint>"
A, B, C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def shingles(hashes, first, size=SHINGLE):
    """``(shingle, row)`` of all runs of ``size`` words; fewer words are one shingle."""
    counts = np.diff(first)
    n = np.where(counts >= size, counts - size + 1, counts > 0)
    rows = np.repeat(np.arange(len(counts)), n)
    ends = np.cumsum(n)
    starts = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n, n) + first[rows]
    padded = np.concatenate([hashes, np.zeros(size, np.uint64)])
    total = np.zeros(len(starts), np.uint64)
    for k in range(size):
        total = mixed(total * A + np.where(k < counts[rows], padded[starts + k], B))
    return total, rows


def multisets(shingle, rows):
    """Distinct ``(shingle, row, count)``, sorted by row and shingle."""
    order = np.lexsort((shingle, rows))
    shingle, rows = shingle[order], rows[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (shingle[1:] != shingle[:-1])
    at = np.flatnonzero(new)
    return shingle[at], rows[at], np.diff(np.append(at, len(rows)))


def _times(n, odd):
    """A product modulo 2 ** 64."""
    return np.uint64(n * int(odd) % 2**64)


def _uniform(h):
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def signatures(shingle, rows, weight, n_rows, size):
    """BagMinHash signatures, a row of ``size`` point names per text that has shingles."""
    names = np.zeros(n_rows * size, np.uint64)
    best = np.full(n_rows * size, np.inf)
    total = np.bincount(rows, weight, n_rows)
    # By this time all components are likely to have a point; else the text is done again.
    limit = (math.log(size) + 3) / np.maximum(total, 1)
    todo = total > 0
    while todo.any():
        mine = todo[rows]
        element, row, w = shingle[mine], rows[mine], weight[mine]
        low, length, level = 0, 1, 0
        while len(element):
            _points(element, row, w, low, length, level, limit, size, names, best)
            low, length, level = low + length, max(1, low + length), level + 1
            more = w > low
            element, row, w = element[more], row[more], w[more]
        todo &= np.isinf(best.reshape(n_rows, size)).any(1)
        limit[todo] *= 2
    return names.reshape(n_rows, size)


def _points(element, row, weight, low, length, level, limit, size, names, best):
    """Points of one weight interval of all elements, in order of time, up to the limits."""
    seed = mixed(element + _times(level + 1, B))
    time, step = np.zeros(len(seed)), 0
    while len(seed):
        draw = mixed(seed + _times(step + 1, A))
        time = time - np.log(_uniform(draw)) / (size * length)
        alive = time <= limit[row]
        seed, row, weight, time, draw = (x[alive] for x in (seed, row, weight, time, draw))
        where = mixed(draw + C)
        counts = low + length * _uniform(mixed(draw ^ B)) < weight
        key = row * size + (where % np.uint64(size)).astype(np.int64)
        at = np.flatnonzero(counts & (time < best[key]))
        at = at[np.argsort(-time[at], kind="stable")]
        # Of several points for one component the earliest is written last.
        best[key[at]], names[key[at]] = time[at], where[at]
        step += 1


def band_hashes(names, bands=BANDS, per_band=BAND_ROWS):
    grouped = names.reshape(len(names), bands, per_band)
    total = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * C, grouped.shape[:2])
    for k in range(per_band):
        total = mixed(total * A + grouped[:, :, k])
    return total


def _texts_alike(hashes, first):
    """Two 64-bit names of each text's word sequence."""
    place = (np.arange(len(hashes)) - np.repeat(first[:-1], np.diff(first))).astype(np.uint64)
    keys = []
    for seed in (A, C):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed(hashes ^ mixed((place + np.uint64(1)) * seed)))])
        keys.append(mixed(sums[first[1:]] - sums[first[:-1]] + np.diff(first).astype(np.uint64)))
    return keys


def _sign(batches):
    for batch in batches:
        ids = batch.column(0)
        data, offsets = utf8(batch.column(1))
        for a, z in blocks(offsets, BLOCK_BYTES):
            for i in range(a, z, BLOCK_ROWS):
                j = min(z, i + BLOCK_ROWS)
                _, _, hashes, first = words(data, offsets[i:j + 1])
                k1, k2 = _texts_alike(hashes, first)
                shingle, rows = shingles(hashes, first)
                n = np.bincount(rows, minlength=j - i)
                names = signatures(*multisets(shingle, rows), j - i, BANDS * BAND_ROWS)
                bands = band_hashes(names).view(np.int64)
                for row in np.flatnonzero(n == 0):  # no word: alike if the text is the same
                    raw = np.append(data[offsets[i + row]:offsets[i + row + 1]], 0).astype(np.uint64)
                    place = np.arange(1, len(raw) + 1, dtype=np.uint64)
                    k1[row] = mixed((mixed(raw * A + place)).sum(keepdims=True))[0]
                    k2[row] = mixed((mixed(raw * C + place)).sum(keepdims=True) + B)[0]
                counts = np.where(n > 0, BANDS, 0)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()),
                    pa.array(bands[n > 0].reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, j - i), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)),
                     pa.array(n, pa.int64()), lists],
                    ["doc_id", "k1", "k2", "n_shingles", "bands"])


def _overlaps(batches):
    """Pairs whose multisets' common count is at least SIMILARITY of their joint count."""
    for batch in batches:
        texts = [utf8(batch.column(column)) for column in (2, 3)]
        # A batch may hold one long text once per partner, so bytes bound what is compared.
        for a, z in blocks(sum(offsets - offsets[0] for _, offsets in texts), BLOCK_BYTES):
            sides = []
            for data, offsets in texts:
                _, _, hashes, first = words(data, offsets[a:z + 1])
                shingle, rows, count = multisets(*shingles(hashes, first))
                sides.append((shingle, count, np.searchsorted(rows, np.arange(z - a + 1))))
            (s, c, at), (s2, c2, at2) = sides
            keep = []
            for i in range(z - a):
                x, y = slice(at[i], at[i + 1]), slice(at2[i], at2[i + 1])
                _, p, q = np.intersect1d(s[x], s2[y], assume_unique=True, return_indices=True)
                common = int(np.minimum(c[x][p], c2[y][q]).sum())
                joint = int(c[x].sum() + c2[y].sum()) - common
                keep.append(joint > 0 and common >= SIMILARITY * joint - 1e-9)
            yield pa.RecordBatch.from_arrays(
                [batch.column(k).slice(a, z - a).filter(pa.array(keep)) for k in (0, 1)],
                ["u", "v"])


def _verified(pairs, texts):
    """The pairs ``u, v`` that are similar enough, by their texts."""
    one = texts.select(F.col("doc_id").alias("u"), F.col("text").alias("a"))
    other = texts.select(F.col("doc_id").alias("v"), F.col("text").alias("b"))
    both = pairs.join(one, "u").join(other, "v").select("u", "v", "a", "b")
    return durable(both.mapInArrow(_overlaps, "u bigint, v bigint").distinct())


def near_duplicates(docs):
    """``doc_id, class_id, n_shingles``: the smallest id of each document's class.

    Words are lower-cased runs of letters and digits; shingles are five words, or all words of
    a shorter text, with their counts. Texts with the same words are one class, as are texts
    without words that are equal. A NULL text counts as empty. Rows of
    one id are one document. Rows without an id are compared with none; their class is NULL.

    Different texts that share a band are linked if their similarity is at least 0.8; classes
    are the connected components. A bucket's members are first compared with one of them, in
    a few rounds; those still in other components are then compared by an exact prefix filter,
    so no link between components is lost and no group is compared pair by pair.
    """
    named = docs.filter("doc_id IS NOT NULL")
    signed = durable(named.select("doc_id", "text").mapInArrow(_sign, SCHEMA))
    # One row per distinct word sequence: copies cost one row per task.
    distinct = durable(signed.groupBy("k1", "k2").agg(
        F.min(F.struct("doc_id", "bands")).alias("r")).select(
        "k1", "k2", F.col("r.doc_id").alias("rep"), F.col("r.bands").alias("bands")))
    banded = distinct.select("rep", F.posexplode("bands").alias("band", "h"))
    shared = banded.groupBy("band", "h").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    members = durable(banded.join(shared, ["band", "h"]).select("band", "h", "rep"))
    # All that is compared is among these texts; they are fetched once, whatever their number.
    ids = members.select(F.col("rep").alias("doc_id")).distinct()
    texts = durable(named.select("doc_id", "text").join(ids.hint("merge"), "doc_id"))
    labels = links = tokens = None
    for turn in range(STAR_ROUNDS + 2):
        rows, open_ = _open(members, labels, turn)
        if turn < STAR_ROUNDS:
            pairs = _stars(rows, open_)
        else:
            tokens = tokens or _rare_tokens(rows, open_, texts)
            pairs = _token_pairs(tokens, labels, turn == STAR_ROUNDS)
        pairs = durable(pairs)
        if pairs.isEmpty():
            break
        found = _verified(pairs, texts)
        links = found if links is None else links.union(found)
        labels = components(links)
    classes = distinct.select("k1", "k2", "rep")
    if labels is not None:
        classes = classes.join(labels.withColumnRenamed("id", "rep"), "rep", "left")
    else:
        classes = classes.withColumn("label", F.col("rep"))
    classes = classes.select("k1", "k2", F.coalesce("label", "rep").alias("class_id"))
    found = signed.join(classes, ["k1", "k2"]).select("doc_id", "class_id", "n_shingles")
    # Rows of one id with different texts meet in the smallest class.
    nameless = docs.filter("doc_id IS NULL").selectExpr(
        "doc_id", "CAST(NULL AS BIGINT) AS class_id", "CAST(NULL AS BIGINT) AS n_shingles")
    return found.union(nameless)


def _open(members, labels, turn):
    """Members with the label of their component, and the buckets that hold several.

    Each bucket has a chosen member, the first in an order that changes by turn.
    """
    if labels is None:
        rows = members.withColumn("label", F.col("rep"))
    else:
        rows = members.join(labels.withColumnRenamed("id", "rep"), "rep", "left").select(
            "band", "h", "rep", F.coalesce("label", "rep").alias("label"))
    chosen = F.min(F.struct(F.xxhash64("rep", F.lit(turn)).alias("o"), "rep", "label")).alias("c")
    return rows, rows.groupBy("band", "h").agg(
        chosen, F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high")


def _pairs(rows, one, other):
    return rows.select(F.least(one, other).alias("u"), F.greatest(one, other).alias("v")).distinct()


def _stars(rows, open_):
    """In each open bucket, the chosen member with those of other components."""
    pairs = rows.join(open_, ["band", "h"]).filter(F.col("label") != F.col("c.label"))
    return _pairs(pairs, "rep", "c.rep")


def _tokens(batches):
    """``rep, label, size, token``: each shingle once per occurrence, numbered."""
    for batch in batches:
        data, offsets = utf8(batch.column(2))
        for a, z in blocks(offsets, BLOCK_BYTES):
            _, _, hashes, first = words(data, offsets[a:z + 1])
            shingle, rows, count = multisets(*shingles(hashes, first))
            ends = np.cumsum(count)
            turn = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - count, count)
            token = mixed(np.repeat(shingle, count) + turn.astype(np.uint64) * C)
            rows = np.repeat(rows, count)
            size = np.bincount(rows, minlength=z - a)
            at = pa.array(rows + a)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(size[rows]),
                 pa.array(token.view(np.int64))], ["rep", "label", "size", "token"])


def _rare_tokens(rows, open_, texts):
    """``token, rep, size, most``: the rarest shingles of members of buckets still open.

    With shingles in order of rarity, two multisets of similarity s share one among the first
    size - s * size + 1 of either; ``most`` is the largest partner that what follows allows. A
    group of texts that each differ from the rest in too many shingles of their own thus
    proposes no pair, whatever its size.
    """
    ids = rows.join(open_.select("band", "h"), ["band", "h"]).select(
        F.col("rep").alias("doc_id"), "label").distinct()
    texts = texts.join(ids, "doc_id").select("doc_id", "label", "text")
    tokens = durable(texts.mapInArrow(
        _tokens, "rep bigint, label bigint, size bigint, token bigint").distinct())
    often = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("often")).filter("often > 1")
    # Tokens of one text only come first in its order and pair with none.
    ranked = tokens.join(often, "token", "left").withColumn("often", F.coalesce("often", F.lit(1)))
    place = F.row_number().over(Window.partitionBy("rep").orderBy("often", "token"))
    ranked = ranked.withColumn("rest", F.col("size") - place + 1).filter(
        f"rest >= ceil({SIMILARITY} * size - 1e-9) AND often > 1")
    most = (1 + SIMILARITY) / SIMILARITY * F.col("rest") - F.col("size") + 1e-9
    return durable(ranked.select("token", "rep", "size", most.alias("most")))


def _token_pairs(tokens, labels, stars):
    """Pairs across components that share a rare token: with one per token, or all."""
    rows = tokens
    if labels is not None:
        rows = rows.join(labels.withColumnRenamed("id", "rep"), "rep", "left")
        rows = rows.withColumn("label", F.coalesce("label", "rep"))
    else:
        rows = rows.withColumn("label", F.col("rep"))
    # The smallest text allows the most partners.
    chosen = F.min(F.struct("size", F.xxhash64("rep").alias("o"), "rep", "label", "most"))
    groups = rows.groupBy("token").agg(
        chosen.alias("c"), F.min("size").alias("smallest"), F.min("label").alias("low"),
        F.max("label").alias("high")).filter("low <> high")
    left = rows.join(groups, "token").filter("smallest <= most")
    other = [F.col(f"c.{c}").alias(f"{c}2") for c in ("rep", "label", "size", "most")]
    if stars:
        pairs = rows.join(groups, "token").select("*", *other)
    else:
        right = left.select("token", *[
            F.col(c).alias(f"{c}2") for c in ("rep", "label", "size", "most")])
        pairs = left.join(right, "token").filter("label < label2")
    return _pairs(pairs.filter(f"""label <> label2 AND size2 <= most AND size <= most2
        AND size2 >= {SIMILARITY} * size - 1e-9 AND size >= {SIMILARITY} * size2 - 1e-9"""),
        "rep", "rep2")


def keep_first(docs):
    """The rows of ``docs`` whose id is that of their class, one row each, all columns."""
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), "doc_id", "text")
    kept = near_duplicates(rows).filter("doc_id = class_id").select("doc_id").distinct()
    first = rows.join(kept, "doc_id").dropDuplicates(["doc_id"]).select("row")
    whole = first.union(rows.filter("doc_id IS NULL").select("row"))
    return whole.select(*[F.col("row").getField(c).alias(c) for c in names])
