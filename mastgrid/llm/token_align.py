"""Align the tokens of two tokenizers over the same bytes.

Both token sequences of a text are laid out by the bytes they cover. Places where tokens of
both end are the common keys of two dictionaries from ends to token numbers; sorted, they cut
both sequences into groups, and inside a group tokens are linked where their bytes overlap.

Neither tokenizer looks past a single space between two other characters, so a text falls into
units there, each aligned on its own, and the alignment of short units is remembered.
"""
import functools
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from mastgrid.functions.durable import durable
from mastgrid.llm.token_count import REMEMBERED_CHARS, SPACE, PieceCounts
from mastgrid.llm.token_shards import encoding

#: Units and links in them that a task remembers; then it starts anew.
REMEMBERED, REMEMBERED_LINKS = 600_000, 8_000_000
#: New units that are read at a time.
TOGETHER = 2_000
#: Pairs of ids whose counts are sent to every task at a time.
SENT_PAIRS = 2_000_000
#: Characters of text whose rows are made at a time, or one longer text.
CHUNK_CHARS = 500_000
#: An id of A and one of B as one number.
SHIFT = 1 << 24
#: Every unit but the first begins with a single space between two characters that aren't.
UNITS = re.compile(r"(?<=\S) (?=\S)")
COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def default_paths():
    """Files of A and B. A's is the same vocabulary as byte_bpe_50k.json, in a form that is read
    four times as fast; the tests hold both forms against each other."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model")


def byte_symbols():
    """The character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


def _byte_level(path):
    """Encoder and bytes by id of a byte-level model in a file of the tokenizers library."""
    from tokenizers import Tokenizer

    model, symbols, pieces = Tokenizer.from_file(path), byte_symbols(), {}
    model.encode_special_tokens = True
    for piece, i in model.get_vocab(with_added_tokens=True).items():
        known = all(c in symbols for c in piece)
        pieces[i] = bytes(symbols[c] for c in piece) if known else piece.encode()
    return (lambda text: model.encode(text, add_special_tokens=False).ids), pieces


def _is_odd(piece):
    """Whether a piece begins or ends in white space, or is one with what comes before."""
    return not piece or piece[0].isspace() or piece[-1].isspace() or SPACE in piece


class Aligner:
    """Both tokenizers, the alignments of units met so far, and the pairs of ids in them."""

    def __init__(self, path_a, path_b):
        import sentencepiece

        PieceCounts(path_b)  # raises unless texts can be cut at spaces
        if path_a.endswith(".tiktoken"):
            known = encoding(path_a)
            self.encode_a = functools.partial(known.encode_to_numpy, disallowed_special=())
            self.bytes_a = {i: known.decode_single_token_bytes(i) for i in range(known.n_vocab)}
        else:
            self.encode_a, self.bytes_a = _byte_level(path_a)
        if {bytes([i]) for i in range(256)} - set(self.bytes_a.values()):
            raise ValueError("A must have a token for each byte")
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            byte = self.b.is_byte(i)
            self.bytes_b.append(bytes([int(piece[1:-1], 16)]) if byte else piece.replace(SPACE, " ").encode())
        self.sizes_a = np.zeros(max(self.bytes_a) + 1, np.int64)
        for i, piece in self.bytes_a.items():
            self.sizes_a[i] = len(piece)
        self.sizes_b = np.array([len(x) for x in self.bytes_b], np.int64)
        self.texts_a, self.texts_b = (
            np.array([[f"{i},", f"{i}{end}"] for i in range(n)], object)
            for n, end in ((len(self.sizes_a), "|"), (len(self.sizes_b), ";")))
        self.forget()

    def forget(self, spell=True):
        """Start with no unit; numbers given out before are void. Groups are made to ``spell``."""
        self.known, self.said, self.n_units, self.spell = {}, [], 0, spell
        self.counts, self.begins, self.pair = (array("q") for _ in range(3))
        self.begins.append(0)

    def full(self):
        """Whether so much is remembered that it is time to start anew."""
        return self.n_units >= REMEMBERED or len(self.pair) >= REMEMBERED_LINKS

    def _tokens(self, text):
        """Flat ids of A and B for a text without its first space; None if they don't spell it.

        A has a token for each byte and merges them without loss, so only B can fail to.
        """
        ids_b = self.b.encode(text)
        if b"".join(map(self.bytes_b.__getitem__, ids_b)) != (" " + text).encode():
            return None
        return np.asarray(self.encode_a(" " + text)).astype(np.int64), np.array(ids_b, np.int64)

    def learn(self, pieces, alone=frozenset()):
        """Align new units, given without their space: a number for each, -1 if unsound.

        Units are read many at a time, put together as in a text; if that doesn't spell them,
        and for those in ``alone``, each is read by itself.
        """
        numbers = dict.fromkeys(pieces, -1)
        plain = [x for x in pieces if x not in alone] if alone else pieces
        alone = list(alone)
        for i in range(0, len(plain), TOGETHER):
            part = plain[i:i + TOGETHER]
            tokens = self._tokens(" ".join(part))
            if tokens is None or not self._align(*tokens, [len(x.encode()) + 1 for x in part]):
                alone += part
            else:
                numbers.update(zip(part, range(self.n_units - len(part), self.n_units)))
        for piece in alone:
            tokens = self._tokens(piece)
            if tokens is not None and self._align(*tokens, [len(piece.encode()) + 1]):
                numbers[piece] = self.n_units - 1
        return numbers

    def _align(self, a, b, sizes):
        """Groups and links of units that lie one after another; whether both sides end there."""
        at_a, at_b, units = np.cumsum(self.sizes_a[a]), np.cumsum(self.sizes_b[b]), np.cumsum(sizes)
        if not (np.isin(units, at_a).all() and np.isin(units, at_b).all()):
            return False
        ends_a, ends_b = (dict(zip(x.tolist(), range(len(x)))) for x in (at_a, at_b))
        common = sorted(ends_a.keys() & ends_b.keys())
        # Within a slice each stretch between neighbouring ends of either side lies in one
        # token of both, and two tokens that overlap share one such stretch.
        ends = np.union1d(at_a, at_b)
        link_ends = np.searchsorted(ends, units, "right")
        group_ends = np.searchsorted(np.array(common), units, "right")
        low = len(self.pair)
        self.pair.frombytes(
            (a[np.searchsorted(at_a, ends)] * SHIFT + b[np.searchsorted(at_b, ends)]).tobytes())
        self.begins.frombytes((low + link_ends).tobytes())
        counts = [np.searchsorted(at_a, units, "right"), np.searchsorted(at_b, units, "right"),
                  group_ends, link_ends]
        self.counts.frombytes(np.diff(np.stack(counts, 1), axis=0, prepend=0).tobytes())
        self.n_units += len(sizes)
        if self.spell:
            last_a, last_b = (np.fromiter(map(x.__getitem__, common), np.int64) for x in (ends_a, ends_b))
            self.said += self._said(a, b, last_a, last_b, group_ends)
        return True

    def _said(self, a, b, last_a, last_b, group_ends):
        """The groups of each unit as text, closed by a semicolon.

        Each slice is A's ids, then B's; an id's text ends in what follows it.
        """
        closes = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        closes[0][last_a] = closes[1][last_b] = 1
        slices = [np.cumsum(x) - x for x in closes]
        # An id comes after all of its side before it, and the other side's earlier slices.
        place_a = np.arange(len(a)) + np.concatenate([[0], last_b + 1])[slices[0]]
        place_b = np.arange(len(b)) + (last_a + 1)[slices[1]]
        parts = np.empty(len(a) + len(b), object)
        parts[place_a], parts[place_b] = self.texts_a[a, closes[0]], self.texts_b[b, closes[1]]
        parts = parts.tolist()
        cuts = [0, *(last_a[group_ends - 1] + last_b[group_ends - 1] + 2).tolist()]
        return ["".join(parts[i:j]) for i, j in zip(cuts, cuts[1:])]

    def read(self, texts):
        """Per text the numbers of its units; none if it is empty or unsound."""
        pieces = [text.split(" ") if text else [] for text in texts]
        new = set().union(*pieces).difference(self.known)
        odd = set(filter(_is_odd, new))
        if odd:  # spaces next to other white space: not every space begins a unit
            for i, found in enumerate(pieces):
                if not odd.isdisjoint(found):
                    pieces[i] = UNITS.split(texts[i])
            new = set().union(*pieces).difference(self.known)
            odd = set(filter(_is_odd, new))
        if new:
            self.known.update(self.learn(list(new), odd))
        numbers = [np.fromiter(map(self.known.__getitem__, x), np.int64, len(x)) for x in pieces]
        for piece in new:
            if len(piece) > REMEMBERED_CHARS or piece in odd:
                del self.known[piece]
        for i, found in enumerate(numbers):
            if len(found) and found.min() < 0:  # the text as a whole decides
                whole = self.learn([texts[i]], {texts[i]}).values()
                numbers[i] = np.array([n for n in whole if n >= 0], np.int64)
        return numbers

    def links(self, done=0):
        """Where the links of the units from number ``done`` on begin, and their pairs."""
        begins = np.array(self.begins[done:], np.int64)
        return begins - begins[0], np.array(self.pair[int(begins[0]):], np.int64)


@functools.lru_cache(maxsize=1)
def _loaded(paths):
    return Aligner(*paths)


def _aligner(paths, spell):
    """The process's aligner; what it remembers is of use to later tasks of the same kind."""
    aligner = _loaded(paths)
    if aligner.spell != spell:
        aligner.forget(spell)
    return aligner


def _chunks(batches, aligner):
    """Ids, texts and units of some rows at a time, before the aligner starts anew."""
    for batch in batches:
        ids, column = batch.column(0), batch.column(1)
        at = 0
        while at < len(batch):
            texts, held, first = [], 0, at
            while at < len(batch) and held < CHUNK_CHARS:
                texts.append(column[at].as_py())
                held += len(texts[-1] or "")
                at += 1
            yield ids.slice(first, at - first), aligner.read(texts)
            if aligner.full():
                aligner.forget(aligner.spell)


def _count_pairs(paths):
    """Tasks that yield ``pair, n``: links per pair of ids."""
    def count(batches):
        aligner = _aligner(paths, False)
        used = np.zeros(0, np.int64)

        def told():
            begins, pairs = aligner.links()
            often = np.zeros(len(begins) - 1, np.int64)
            often[:len(used)] = used
            names, place = np.unique(pairs, return_inverse=True)
            n = np.zeros(len(names), np.int64)
            np.add.at(n, place, np.repeat(often, np.diff(begins)))
            at = np.flatnonzero(n)
            return pa.RecordBatch.from_arrays([pa.array(names[at]), pa.array(n[at])], ["pair", "n"])

        for _, numbers in _chunks(batches, aligner):
            flat = np.concatenate(numbers)
            more = np.bincount(flat, minlength=aligner.n_units)
            more[:len(used)] += used
            used = more
            if aligner.full():
                yield told()
                used = np.zeros(0, np.int64)
        yield told()

    return count


def _add_counts(paths, sent, first):
    """Tasks that add the counts of one block of pairs to the rows.

    The first block's tasks also make the other columns.
    """
    def add(batches):
        aligner = _aligner(paths, first)
        pairs, counts, best = sent.value
        by_unit = np.zeros((0, 2), np.int64)
        for batch in batches:
            done = 0
            for ids, numbers in _chunks([batch], aligner):
                if len(by_unit) < aligner.n_units:
                    begins, names = aligner.links(len(by_unit))
                    sums = np.zeros((len(names) + 1, 2), np.int64)
                    if len(pairs):
                        at = np.minimum(np.searchsorted(pairs, names), len(pairs) - 1)
                        known = pairs[at] == names
                        np.cumsum(np.stack([known & best[at], known * counts[at]], 1), axis=0, out=sums[1:])
                    by_unit = np.concatenate([by_unit, np.diff(sums[begins], axis=0)])
                sizes = np.array([len(x) for x in numbers])
                flat = np.concatenate(numbers)
                part = batch.slice(done, len(numbers))
                done += len(numbers)
                added = _by_row(by_unit, flat, sizes)
                if first:
                    told = [pa.array(c) for c in _by_row(
                        np.array(aligner.counts, np.int64).reshape(-1, 4), flat, sizes).T]
                    said = pa.array(["".join(map(aligner.said.__getitem__, x.tolist()))[:-1] if len(x) else None
                                     for x in numbers], pa.string())
                else:
                    told = [part.column(name) for name in COUNTS]
                    added += np.stack([part.column(c).to_numpy() for c in ("n_best", "count_sum")], 1)
                    said = part.column("groups")
                yield pa.RecordBatch.from_arrays(
                    [ids, part.column(1), *told, *[pa.array(c) for c in added.T], said],
                    ["row", "text", *COUNTS, "n_best", "count_sum", "groups"])
                if aligner.full():
                    by_unit = np.zeros((0, 2), np.int64)

    return add


def _by_row(values, flat, sizes):
    """Sums of the rows of ``values`` that each text's units name."""
    sums = np.zeros((len(flat) + 1, values.shape[1]), np.int64)
    if len(flat):
        np.cumsum(values[flat], axis=0, out=sums[1:])
    ends = np.cumsum(sizes)
    return sums[ends] - sums[ends - sizes]


def pair_counts(docs, paths=None):
    """A written table ``pair, n, best``: links by pair of ids over all texts.

    ``pair`` is the id of A times SHIFT plus that of B; ``best`` marks the highest count of an
    id of B, ties included. Tasks count before anything is shuffled.
    """
    found = docs.select("doc_id", "text").mapInArrow(
        _count_pairs(paths or default_paths()), "pair bigint, n bigint")
    found = durable(found.groupBy("pair").agg(F.sum("n").alias("n")))
    other = F.expr(f"pair % {SHIFT}").alias("b")
    # A row per id of B, so at most its vocabulary.
    most = found.groupBy(other).agg(F.max("n").alias("most"))
    return found.withColumn("b", other).join(F.broadcast(most), "b").select(
        "pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align(docs, paths=None, keep=("doc_id",), sent_pairs=SENT_PAIRS):
    """The ``keep`` columns with ``n_a, n_b, n_groups, n_links, n_best, count_sum, groups``.

    ``paths`` are the files of the tokenizers A and B on the executors. A reads a space and
    the text, B the text, to which it adds that space itself. ``groups`` is the alignment as
    ``a1,a2|b1;a3|b2,b3``; links, those of the counts too, are as the module says. ``n_best``
    counts the links whose pair is the most frequent of its id of B, ``count_sum`` adds up the
    frequencies of all.

    The frequencies are sent to the tasks in blocks of ``sent_pairs``; each block is one more
    narrow step over the rows, so what is sent is bounded and nothing is left out.

    NULL and empty texts, and those that the tokens don't spell, have no tokens: zeros, and
    NULL groups. Rows are aligned and counted each on their own, whether their ids or texts
    repeat or are NULL; an empty table gives an empty one. Kept columns go along in a struct,
    so their names can't clash with the working ones.
    """
    paths = tuple(paths or default_paths())
    spark = docs.sparkSession
    counts = durable(pair_counts(docs, paths))
    blocks = max(1, -(-counts.count() // sent_pairs))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), "text")
    numbers = ", ".join(f"{name} bigint" for name in (*COUNTS, "n_best", "count_sum"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, text string, {numbers}, groups string"
    for block in range(blocks):
        part = counts.filter(F.pmod(F.xxhash64("pair"), F.lit(blocks)) == block).toArrow()
        pair, n, best = (part.column(c).to_numpy() for c in ("pair", "n", "best"))
        order = np.argsort(pair)
        sent = spark.sparkContext.broadcast((pair[order], n[order], best[order]))
        rows = rows.mapInArrow(_add_counts(paths, sent, block == 0), schema)
    return rows.select(
        *[F.col("row").getField(c).alias(c) for c in keep], *COUNTS, "n_best", "count_sum", "groups")
