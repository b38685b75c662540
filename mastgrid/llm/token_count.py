"""Count the tokens of texts under a byte-pair model without making the tokens.

The model joins, again and again, the adjacent pair of symbols whose piece ranks first. A heap
holds the candidate pairs, a linked list the symbols; the count is that of the first symbols
less the joins.
"""
import functools
import heapq
import os
import re

import pyarrow as pa

SPACE = "▁"
#: Counts of short units are remembered, up to so many.
REMEMBERED, REMEMBERED_CHARS = 500_000, 40
SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint"


def default_model():
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class PieceCounts(dict):
    """unit -> number of tokens, counted when first asked for."""

    def __init__(self, path):
        super().__init__()
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        spec = model.normalizer_spec
        plain = not (spec.precompiled_charsmap or spec.remove_extra_whitespaces)
        kinds = {piece.type for piece in model.pieces}
        if not (plain and spec.add_dummy_prefix and spec.escape_whitespaces
                and model.trainer_spec.byte_fallback and model.trainer_spec.model_type == 2
                and kinds <= {1, 2, 3, 6}):
            raise ValueError(f"{os.path.basename(path)}: only byte-fallback BPE on raw text")
        # Best score first; equal scores go by place.
        self.rank = {p.piece: -p.score for p in model.pieces if p.type == 1}
        joined = [piece for piece in self.rank if len(piece) > 1]
        if any(SPACE in piece.lstrip(SPACE) for piece in joined):
            raise ValueError("a piece goes on past a space, so texts can't be cut at spaces")
        # No piece of several characters holds these, so no join crosses them.
        alone = "".join(c for c in "\n\t\r" if not any(c in piece for piece in joined))
        units = f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+"
        self.units = re.compile(f"{units}|[{alone}]+" if alone else units)

    def __missing__(self, unit):
        n = self.count(unit)
        if len(unit) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED:
                self.clear()
            self[unit] = n
        return n

    def count(self, unit):
        """Tokens of one unit; a symbol without a piece counts its UTF-8 bytes."""
        rank, symbols = self.rank, list(unit)
        size = [1 if s in rank else len(s.encode()) for s in symbols]
        n, total = len(symbols), sum(size)
        following, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def propose(left, right):
            piece = symbols[left] + symbols[right]
            if piece in rank:
                heapq.heappush(heap, (rank[piece], left, right, piece))

        for i in range(n - 1):
            propose(i, i + 1)
        while heap:
            _, left, right, piece = heapq.heappop(heap)
            # A pair whose symbols have changed since is out of date.
            if symbols[left] is None or following[left] != right or (
                    symbols[left] + symbols[right] != piece):
                continue
            total -= size[left] + size[right] - 1
            symbols[left], symbols[right], size[left] = piece, None, 1
            after = following[right]
            following[left] = after
            if after < n:
                before[after] = left
                propose(left, after)
            if before[left] >= 0:
                propose(before[left], left)
        return total

    def tokens(self, text):
        """Tokens of a whole text; none if it is empty."""
        if not text:
            return 0
        text = SPACE + text.replace(" ", SPACE)
        if len(text) < 1_000_000:
            return sum(map(self.__getitem__, self.units.findall(text)))
        return sum(self[match.group()] for match in self.units.finditer(text))


@functools.lru_cache(maxsize=2)
def _counts(path):
    return PieceCounts(path or default_model())


def count_tokens(docs, model=None):
    """``doc_id, n_bytes, n_tokens`` of every text, NULL as empty, each row on its own.

    ``model`` is the path of the model file on the executors; by default the installed public
    one. Units between spaces are independent, so their counts are remembered in a table of
    bounded size. A text without spaces costs n log n in its length.
    """
    def count(batches):
        counts = _counts(model)
        for batch in batches:
            texts = (t.as_py() or "" for t in batch.column(1))
            sizes, tokens = [], []
            for text in texts:
                sizes.append(len(text.encode()))
                tokens.append(counts.tokens(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"])

    return docs.select("doc_id", "text").mapInArrow(count, SCHEMA)
