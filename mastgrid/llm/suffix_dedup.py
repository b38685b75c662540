"""Remove repeated 100-byte strings by a hash-compared suffix sort.

Every window of 100 bytes belongs to the least of its 40-byte hashes, so equal windows belong
to equal hashes and consecutive windows share one: texts fall into runs, one per 30 bytes or
so, and only runs of one hash need to meet. A run whose whole content occurs earlier is
covered. Where runs of one hash differ, at the edges of copies, their windows are compared:
suffix-sorted within a task, by hash across tasks.
"""
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from mastgrid.functions.durable import durable
from mastgrid.llm.texts import PrefixHash, blocks, mixed, utf8

SIZE, GRAM = 100, 40
REACH = SIZE - GRAM
GRAM_HASH, FIRST_HASH, SECOND_HASH = (PrefixHash(seed) for seed in (3, 5, 7))
PIECE_BYTES = 1_000_000
#: Windows that are sorted at a time.
SORT_WINDOWS = 300_000
#: Kinds of rows: bytes known to go, a run seen once in its shard, a hash with several runs in
#: a shard, a run whose windows must be compared, a window.
COVERED, RUN, SEVERAL, COMPARE, WINDOW = range(5)
NAMES = ["kind", "h1", "h2", "doc_id", "start", "n"]
ROWS = "kind int, h1 bigint, h2 bigint, doc_id bigint, start bigint, n bigint"


def _table(kind, h1, h2, doc, start, n):
    size = len(doc)
    columns = [np.broadcast_to(np.asarray(x), size) for x in (kind, h1, h2, doc, start, n)]
    columns = [c.view(np.int64) if c.dtype == np.uint64 else c for c in columns]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int32() if i == 0 else pa.int64()) for i, c in enumerate(columns)], NAMES)


def _sliding(values, width, best):
    """The best of each ``width`` consecutive values, by doubling."""
    done = 1
    while done * 2 <= width:
        values = best(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return best(values[:len(values) - rest], values[rest:]) if rest else values


def runs(data, offsets):
    """``(hash, content, row, start, n, tied)`` of all runs of windows in some texts."""
    low, high = int(offsets[0]), int(offsets[-1])
    if high - low < SIZE:
        return [np.empty(0, t) for t in (np.uint64, np.uint64, int, int, int, bool)]
    data, cuts = data[low:high], offsets - low
    sums = GRAM_HASH.prefixes(data)
    at = np.arange(len(data) - GRAM + 1)
    grams = GRAM_HASH.of(sums, at, at + GRAM)
    least = _sliding(grams, REACH + 1, np.minimum)
    starts = np.arange(len(least))
    row = np.searchsorted(cuts, starts, "right") - 1
    whole = starts + SIZE <= cuts[row + 1]
    least[~whole] = 0
    begins = whole.copy()
    begins[1:] &= (least[1:] != least[:-1]) | ~whole[:-1]
    a = np.flatnonzero(begins)
    stop = np.append(np.flatnonzero(begins | ~whole), len(least))
    n = stop[np.searchsorted(stop, a, "right")] - a
    # Equal hashes close together: windows of one run may repeat each other.
    padded = np.concatenate([np.zeros(REACH, np.uint64), least, np.zeros(REACH, np.uint64)])
    chosen = np.flatnonzero(_sliding(padded, REACH + 1, np.maximum)[:len(grams)] == grams)
    near = (grams[chosen[1:]] == grams[chosen[:-1]]) & (np.diff(chosen) <= REACH)
    pairs = np.concatenate([[0], np.cumsum(near)])
    first = np.searchsorted(chosen, a)
    last = np.maximum(np.searchsorted(chosen, a + n - 1 + REACH, "right") - 1, first)
    top = len(pairs) - 1
    tied = pairs[np.minimum(last, top)] > pairs[np.minimum(first, top)]
    content = FIRST_HASH.of(FIRST_HASH.prefixes(data), a, a + n - 1 + SIZE)
    return [least[a], mixed(content + n.astype(np.uint64)), row[a], a - cuts[row[a]], n, tied]


def _pieces(offsets):
    """Ranges of texts, and of long texts parts that overlap by SIZE - 1 bytes."""
    for a, z in blocks(offsets, PIECE_BYTES):
        low, high = int(offsets[a]), int(offsets[z])
        if z - a > 1 or high - low <= PIECE_BYTES:
            yield a, 0, offsets[a:z + 1]
            continue
        for at in range(low, max(low + 1, high - SIZE + 1), PIECE_BYTES):
            yield a, at - low, np.array([at, min(high, at + PIECE_BYTES + SIZE - 1)])


def _find_runs(batches):
    """Per Arrow batch, a shard: what its texts alone decide, and a row per hash for the rest."""
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        data, offsets = utf8(batch.column(1))
        found = []
        for a, shift, cuts in _pieces(offsets):
            part = runs(data, cuts)
            part[2], part[3] = ids[part[2] + a], part[3] + shift
            found.append(part)
        h, content, doc, start, n, tied = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((start, doc, content, h))
        h, content, doc, start, n, tied = (x[order] for x in (h, content, doc, start, n, tied))
        new_hash = np.append(True, h[1:] != h[:-1])[:len(h)]
        new = new_hash | np.append(True, content[1:] != content[:-1])[:len(h)]
        yield from _covered_later(new, doc, start, n, merge=True)
        h, content, doc, start, n, tied = (x[new] for x in (h, content, doc, start, n, tied))
        group = np.cumsum(new_hash[new]) - 1
        several = (np.bincount(group) > 1) | (np.bincount(group, tied) > 0) if len(h) else group
        many = several[group] if len(h) else tied
        # By content, not by hash: copies in other shards meet, and a common hash spreads.
        yield _table(COMPARE, content[many], h[many], doc[many], start[many], n[many])
        marks = np.unique(h[many])
        yield _table(SEVERAL, marks, 0, np.zeros(len(marks), int), 0, 0)
        one = ~many
        yield _table(RUN, h[one], content[one], doc[one], start[one], n[one])


def _covered_later(new, doc, start, n, merge=False):
    """Rows that are not the first of their kind lose their bytes, unless they are the same.

    With ``merge``, windows that follow each other in a text become one row.
    """
    if not len(new):
        return
    first = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    later = ~new & ((doc != doc[first]) | (start != start[first]))
    doc, start, n = doc[later], start[later], n[later]
    if merge and len(doc):
        order = np.lexsort((start, doc))
        doc, start, end = doc[order], start[order], (start + n)[order]
        at = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (start[1:] > end[:-1])))
        doc, start, n = doc[at], start[at], np.maximum.reduceat(end, at) - start[at]
    yield _table(COVERED, doc, 0, doc, start, n)


def _columns(batch):
    return [c.to_numpy() for c in batch.columns]


def _compare_shards(batches):
    """Runs of all shards, sorted by hash and content: decide those whose contents all agree.

    Only the last run of a batch is carried on, however many runs share a hash.
    """
    carried, several, told = None, False, False
    for batch in batches:
        kind, h1, h2, doc, start, n = _columns(batch)
        done = kind == COVERED
        yield _table(COVERED, doc[done], 0, doc[done], start[done], n[done])
        columns = [x[~done] for x in (kind, h1, h2, doc, start, n)]
        if carried is not None:
            columns = [np.append(c, x) for c, x in zip(carried, columns)]
        kind, h1, h2, doc, start, n = columns
        if not len(kind):
            continue
        new_hash = np.append(True, h1[1:] != h1[:-1])
        new = new_hash | np.append(True, (h2[1:] != h2[:-1]) | (kind[1:] != kind[:-1]))
        group = np.cumsum(new_hash) - 1
        many = (np.bincount(group, new) > 1) | (np.bincount(group, kind != RUN) > 0)
        ghost = carried is not None
        if ghost and several:
            many[0] = True
        fresh = np.ones(len(kind), bool)
        if ghost and told:
            fresh[0] = False
        yield from _covered_later(new, doc, start, n)
        tell = new & many[group] & (kind != SEVERAL) & fresh
        yield _table(COMPARE, doc[tell], 0, doc[tell], start[tell], n[tell])
        # Carry the first row of the last content on, and whether it was told.
        at = np.flatnonzero(new)[-1]
        carried = [x[at:at + 1] for x in (kind, h1, h2, doc, start, n)]
        several = bool(many[-1])
        told = bool(tell[at] or not fresh[at] or kind[at] == SEVERAL)


def _heads(data, starts):
    """The eight bytes at each place as a number that sorts as they do."""
    head = np.zeros(len(starts), np.uint64)
    for k in range(8):
        head = (head << np.uint64(8)) | data[starts + k]
    return head


def suffix_order(data, starts, first, sums):
    """Order of the suffixes at ``starts`` by their first SIZE bytes; which are as the one before.

    Suffixes are laid out by their first 16 bytes; those that agree in them are merge-sorted:
    each level merges neighbouring sorted runs by searching every suffix's place in the other
    run. Two suffixes are compared by their prefix hashes: over SIZE bytes, and where those
    differ by the longest common extension, found by halving, and the byte after it.
    """
    def part(start, end):
        return (sums[end] - sums[start]) * first.back[start]

    whole = part(starts, starts + SIZE)

    def less(i, j):
        out = whole[i] != whole[j]
        at = np.flatnonzero(out)
        p, q = starts[i[at]], starts[j[at]]
        length = np.full(len(at), 16)
        for step in (64, 32, 16, 8, 4, 2, 1):
            to = np.minimum(length + step, SIZE)
            length = np.where(part(p, p + to) == part(q, q + to), to, length)
        ends = np.minimum(length, SIZE - 1)
        out[at] = (length < SIZE) & (data[p + ends] < data[q + ends])
        return out

    total = len(starts)
    head, second = _heads(data, starts), _heads(data, starts + 8)
    order = np.lexsort((second, head))
    new = np.append(True, (head[order][1:] != head[order][:-1]) | (
        second[order][1:] != second[order][:-1]))[:total]
    del head, second
    # Only suffixes whose head others share are merged, each group of them for itself.
    group_start = np.maximum.accumulate(np.where(new, np.arange(total), 0))
    bounds = np.append(np.flatnonzero(new), total)
    group_end = bounds[np.cumsum(new)]
    place = np.flatnonzero(group_end - group_start > 1)
    width = 1
    while len(place):
        begin, end = group_start[place], group_end[place]
        block = (place - begin) // width
        own, other = begin + block * width, begin + (block ^ 1) * width
        low, high = np.minimum(other, end), np.minimum(other + width, end)
        low_at, left = low.copy(), block % 2 == 0
        active = np.flatnonzero(low < high)
        while len(active):
            middle = (low[active] + high[active]) // 2
            x, y = order[place[active]], order[middle]
            before = left[active]
            goes = less(np.where(before, y, x), np.where(before, x, y))
            goes = np.where(before, goes, ~goes)
            low[active[goes]] = middle[goes] + 1
            high[active[~goes]] = middle[~goes]
            active = active[low[active] < high[active]]
        merged = order.copy()
        merged[np.minimum(own, other) + (place - own) + (low - low_at)] = order[place]
        order, width = merged, width * 2
        place = place[end - begin > width]
    return order, ~new[1:] & (whole[order[1:]] == whole[order[:-1]])


def _parts_of_runs(start, n, row):
    """Runs a bounded number of windows at a time; a longer run in parts."""
    parts = np.maximum(1, -(-n // SORT_WINDOWS))
    which = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    start, n, row = (np.repeat(x, parts) for x in (start, n, row))
    start, n = start + which * SORT_WINDOWS, np.minimum(n - which * SORT_WINDOWS, SORT_WINDOWS)
    upto = np.cumsum(n)
    a = 0
    while a < len(n):
        done = upto[a - 1] if a else 0
        z = max(a + 1, int(np.searchsorted(upto, done + SORT_WINDOWS, "right")))
        yield start[a:z], n[a:z], row[a:z]
        a = z


def _compare_windows(batches):
    """Texts with the runs to compare: windows repeated here go, one row for each other.

    Only the bytes of runs are laid out, so memory follows from SORT_WINDOWS and not from the
    length of a text.
    """
    for batch in batches:
        ids = batch.column(0).to_numpy()
        data, offsets = utf8(batch.column(1))
        wanted = batch.column(2)
        begins, values = wanted.offsets.to_numpy(), wanted.values
        run_start, run_n = (values.field(k).to_numpy() for k in (0, 1))
        run_row = np.repeat(np.arange(len(ids)), np.diff(begins))
        # Rows that repeat an id may have another text; windows past its end are none.
        size = offsets[run_row + 1] - offsets[run_row]
        run_n = np.minimum(run_n, size - SIZE + 1 - run_start)
        real = run_n > 0
        for start, n, row in _parts_of_runs(run_start[real], run_n[real], run_row[real]):
            ends = np.cumsum(n + SIZE - 1)
            lengths = n + SIZE - 1
            at = np.repeat(offsets[row] + start - (ends - lengths), lengths) + np.arange(ends[-1])
            text = data[at]
            windows = np.cumsum(n)
            inside = np.arange(windows[-1]) - np.repeat(windows - n, n)
            place = np.repeat(ends - lengths, n) + inside
            start, doc = np.repeat(start, n) + inside, np.repeat(ids[row], n)
            del at, inside
            sums = FIRST_HASH.prefixes(text)
            order, same = suffix_order(text, place, FIRST_HASH, sums)
            for i in np.array_split(np.flatnonzero(same), max(1, int(same.sum()) // 20_000)):
                p, q = place[order[i]], place[order[i + 1]]
                span = np.arange(SIZE)
                # The hashes agree; the bytes decide.
                same[i] = (text[p[:, None] + span] == text[q[:, None] + span]).all(1)
            group = np.empty(len(order), np.int64)
            group[order] = np.cumsum(np.append(True, ~same))
            order = np.lexsort((start, doc, group))
            group, doc, start, place = (x[order] for x in (group, doc, start, place))
            new = np.append(True, group[1:] != group[:-1])
            yield from _covered_later(new, doc, start, np.ones(len(doc), int), merge=True)
            at = place[new]
            h1 = FIRST_HASH.of(sums, at, at + SIZE)
            h2 = SECOND_HASH.of(SECOND_HASH.prefixes(text), at, at + SIZE)
            # 96 bits tell windows of different tasks apart.
            yield _table(WINDOW, h1, h2 >> np.uint64(32), doc[new], start[new], 1)


def _later_windows(batches):
    """Windows of all tasks, sorted by hash and place: all but the first of each go."""
    carried = None
    for batch in batches:
        kind, h1, h2, doc, start, n = _columns(batch)
        done = kind == COVERED
        yield _table(COVERED, doc[done], 0, doc[done], start[done], n[done])
        columns = [x[~done] for x in (h1, h2, doc, start, n)]
        if carried is not None:
            columns = [np.append(c, x) for c, x in zip(carried, columns)]
        h1, h2, doc, start, n = columns
        if not len(h1):
            continue
        new = np.append(True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]))
        yield from _covered_later(new, doc, start, n)
        at = np.flatnonzero(new)[-1]
        carried = [x[at:at + 1] for x in columns]


def _cut(batches):
    """Texts without the bytes of their windows, and what was taken out."""
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        spans = batch.column(2).to_pylist()
        kept, sizes, removed, counts = [], np.diff(offsets), [], []
        for i, found in enumerate(spans):
            raw = data[offsets[i]:offsets[i + 1]]
            if not found:
                kept.append(raw.tobytes())
                removed.append(0)
                counts.append(0)
                continue
            edge = np.zeros(len(raw) + 1, np.int64)
            start = np.array([s["start"] for s in found])
            end = start + np.array([s["n"] for s in found]) - 1 + SIZE
            np.add.at(edge, np.minimum(start, len(raw)), 1)
            np.add.at(edge, np.minimum(end, len(raw)), -1)
            gone = np.cumsum(edge)[:-1] > 0
            kept.append(raw[~gone].tobytes())
            removed.append(int(gone.sum()))
            counts.append(int((gone & ~np.append(False, gone[:-1])).sum()))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(counts, pa.int64()), pa.array(kept, pa.binary())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def dedup_substrings(docs):
    """``doc_id, n_bytes, n_removed, n_spans, kept``: bytes that 100-byte repeats don't cover.

    A byte goes if a 100-byte string over it also starts earlier: in a smaller id, or further
    up in the same document. Texts are taken as they come in, NULL as empty; texts under 100
    bytes stay. An id names one text; rows that repeat it are the same document and all stay.
    Rows without an id are kept whole and compared with none.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    named = rows.filter("doc_id IS NOT NULL")
    # One row per hash and shard at most, so a common string loads no task.
    found = named.mapInArrow(_find_runs, ROWS).repartition("h1")
    found = found.sortWithinPartitions("h1", "h2", "kind", "doc_id", "start")
    decided = durable(found.mapInArrow(_compare_shards, ROWS))
    place = F.collect_list(F.struct("start", "n"))
    open_ = decided.filter(f"kind = {COMPARE}").groupBy("doc_id").agg(place.alias("runs"))
    windows = named.join(open_, "doc_id").select("doc_id", "text", "runs")
    windows = windows.mapInArrow(_compare_windows, ROWS).repartition("h1")
    windows = windows.sortWithinPartitions("h1", "h2", "doc_id", "start")
    spans = decided.filter(f"kind = {COVERED}").union(windows.mapInArrow(_later_windows, ROWS))
    spans = spans.groupBy("doc_id").agg(place.alias("spans"))
    marked = named.join(spans, "doc_id", "left").select("doc_id", "text", "spans")
    whole = rows.filter("doc_id IS NULL").withColumn(
        "spans", F.lit(None).cast(marked.schema["spans"].dataType))
    return marked.union(whole).mapInArrow(
        _cut, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
