"""Texts of an Arrow batch as byte arrays, in blocks of bounded size."""
import numpy as np
import pyarrow as pa

BLOCK_BYTES = 4_000_000


def utf8(column):
    """``(data, offsets)`` of a string column as NumPy arrays; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    empty = data is None or not data.size
    return (np.empty(0, np.uint8) if empty else np.frombuffer(data, np.uint8)), offsets


def blocks(offsets, limit=BLOCK_BYTES):
    """Row ranges whose texts hold at most ``limit`` bytes together, or one longer text."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(rows, max(first + 1, last))
        yield first, last
        first = last


def mixed(h):
    """Spread the entropy of 64-bit hashes over all their bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


class PrefixHash:
    """Polynomial hashes of substrings from one pass of prefix sums, modulo 2 ** 64.

    The base is odd, so its inverse shifts a difference of two prefix sums to place 0.
    """

    def __init__(self, seed):
        values = np.random.default_rng(seed).integers(1, 2**63, 257, dtype=np.uint64)
        self.values, base = values[:256], int(values[256]) * 2 + 1
        self.base, self.inverse = base % 2**64, pow(base, -1, 2**64)
        self.power = self.back = np.ones(1, np.uint64)

    def _grow(self, n):
        if len(self.power) < n:
            for name, b in (("power", self.base), ("back", self.inverse)):
                steps = np.full(n, b, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))

    def prefixes(self, data):
        """Sums before each place, and after the last."""
        self._grow(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.power[:len(data)], out=sums[1:])
        return sums

    def of(self, sums, start, end):
        """Hashes of ``data[start:end]`` for arrays of places."""
        return mixed((sums[end] - sums[start]) * self.back[start])


# ASCII letters, digits and all bytes of other characters make up words.
IS_WORD = np.zeros(256, bool)
IS_WORD[ord("0"):ord("9") + 1] = IS_WORD[ord("A"):ord("Z") + 1] = True
IS_WORD[ord("a"):ord("z") + 1] = IS_WORD[128:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
WORD_HASH = PrefixHash(11)
HASHED_BYTES = 1_000_000


def words(data, offsets):
    """``(starts, ends, hashes, first)`` of the lower-cased words of texts.

    ``first`` has the number of words before each text, and in all. Hashes are made of at
    most HASHED_BYTES at a time, or of one longer word.
    """
    low, high = int(offsets[0]), int(offsets[-1])
    data = LOWER[data[low:high]]
    cuts = offsets - low
    inside = IS_WORD[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    before[cuts[:-1][cuts[:-1] < len(data)]] = False
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    after[cuts[1:][cuts[1:] > 0] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    hashes = np.empty(len(starts), np.uint64)
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + HASHED_BYTES, "right")))
        at = starts[a]
        sums = WORD_HASH.prefixes(data[at:ends[b - 1]])
        hashes[a:b] = WORD_HASH.of(sums, starts[a:b] - at, ends[a:b] - at)
        a = b
    return starts + low, ends + low, hashes, np.searchsorted(starts, cuts)
