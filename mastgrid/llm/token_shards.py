"""Lay tokenised sequences out in training order, in shards of records of one size."""
import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mastgrid.functions.durable import durable

LENGTH, PER_SHARD, KEY, ROUNDS = 512, 16_384, 2024, 4
#: The free identifier after the vocabulary fills the last record of a text.
PAD = 50_256
TASKS_SENT = 1_000_000
#: Shards that one task lays out, one after another: some 64 MB to sort.
SHARDS_TOGETHER = 4


def default_ranks():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@functools.lru_cache(maxsize=2)
def encoding(path=None):
    import base64

    import public_tokenizers
    import tiktoken

    with open(path or default_ranks(), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(
        "texts", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def sequences(docs, length=LENGTH, ranks=None):
    """A written table ``part, place, doc_id, seq_no, n_tokens, tokens`` of cut token streams.

    ``tokens`` holds 16-bit little-endian identifiers, ``length`` at most. Tasks take ranges of
    ``doc_id`` in order, so ``part`` and ``place`` number the sequences by ``doc_id``, text hash
    and ``seq_no`` however the input is split, and an id that holds many rows is split as well.
    NULL and empty texts give none; repeated rows give their own.
    """
    def cut(batches):
        from pyspark import TaskContext

        part, place = TaskContext.get().partitionId(), 0
        encode = encoding(ranks).encode_ordinary
        for batch in batches:
            for ids, texts in ((batch.column(0)[i:i + 256], batch.column(1)[i:i + 256])
                               for i in range(0, len(batch), 256)):
                out = []
                for doc_id, text in zip(ids, texts):
                    tokens = np.array(encode(text.as_py() or ""), "<u2")
                    for k in range(0, len(tokens), length):
                        piece = tokens[k:k + length]
                        out.append((part, place, doc_id.as_py(), k // length, len(piece),
                                    piece.tobytes()))
                        place += 1
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out), (
                            pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(),
                            pa.binary()))],
                        ["part", "place", "doc_id", "seq_no", "n_tokens", "tokens"])

    order = ["doc_id", "text_hash", "row"]
    rows = docs.select(
        "doc_id", "text", F.xxhash64("text").alias("text_hash"),
        F.monotonically_increasing_id().alias("row"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return durable(rows.select("doc_id", "text").mapInArrow(
        cut, "part bigint, place bigint, doc_id bigint, seq_no bigint, n_tokens bigint, tokens binary"),
        compression="zstd")


def feistel(index, n, key=KEY):
    """A keyed permutation of 0..n-1, applied to an array of numbers.

    Both halves of a number are mixed in turn; a result past n - 1 goes through again, which
    ends because the permutation of the next power of four is made of cycles.
    """
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64(2**half - 1)
    x = np.asarray(index).astype(np.uint64)
    todo = np.arange(len(x))
    while len(todo):
        left, right = x[todo] >> np.uint64(half), x[todo] & mask
        for turn in range(ROUNDS):
            h = right * np.uint64(0x9E3779B97F4A7C15) + np.uint64((key * 1_000_003 + turn) % 2**64)
            h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((h ^ (h >> np.uint64(29))) & mask)
        x[todo] = (left << np.uint64(half)) | right
        todo = todo[x[todo] >= n]
    return x.astype(np.int64)


def stride(length=LENGTH):
    """Bytes from one record of a shard file to the next."""
    return 2 * length + 1


def training_order(docs, length=LENGTH, per_shard=PER_SHARD, key=KEY, ranks=None):
    """Every sequence with its global slot, shard, byte offset in the shard and record.

    Slots are a keyed permutation of the sequence numbers, so they are even and dense: shard
    ``k`` holds slots ``k * per_shard`` on. In the files of ``write_shards`` each record of
    ``2 * length`` bytes is followed by a line end; ``byte_offset`` is its place there, so a
    reader resumes at any slot. A partition holds SHARDS_TOGETHER shards, in order.

    Sequences are numbered by ``doc_id``, the hash of the text and ``seq_no``, so the same
    documents have the same slots however they are split, and a reader resumes across a rebuild.
    Rows alike in id and text are interchangeable.
    NULL and empty texts have no sequence, rows that repeat have their own, and only ``doc_id``
    and ``text`` are read, so other columns can't clash; an empty table gives no rows.
    """
    table = sequences(docs, length, ranks)
    spark = table.sparkSession
    # One row per writing task.
    counts = table.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    n, tasks = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    if tasks > TASKS_SENT:
        raise ValueError(f"more than {TASKS_SENT} writing tasks; use larger input splits")

    @F.arrow_udf("bigint")
    def slot_of(number: pa.Array) -> pa.Array:
        return pa.array(feistel(number.to_numpy(zero_copy_only=False), n, key))

    numbered = table.join(F.broadcast(starts), "part").withColumn(
        "slot", slot_of(F.col("base") + F.col("place")))
    shard = F.expr(f"slot div {per_shard}")
    fill = F.lit(PAD.to_bytes(2, "little") * length).cast("binary")
    record = F.when(F.col("n_tokens") == length, F.col("tokens")).otherwise(
        F.substring(F.concat("tokens", fill), 1, 2 * length))
    rows = numbered.select(
        "slot", shard.alias("shard"), (F.expr(f"slot % {per_shard}") * stride(length)).alias("byte_offset"),
        "doc_id", "seq_no", "n_tokens", "tokens")
    tasks = max(1, -(-n // (per_shard * SHARDS_TOGETHER)))
    together = F.expr(f"CAST(shard div {SHARDS_TOGETHER} AS INT)")
    rows = rows.repartitionById(tasks, together).sortWithinPartitions("shard", "slot")
    return rows.withColumn("record", record).drop("tokens")


def write_shards(rows, path):
    """Write the records of ``training_order`` as one binary file per shard, in slot order.

    The text writer puts the bytes down as they are, each record closed by one byte, so a record
    is at its ``byte_offset``. It writes to any store Spark reaches, and a lost task's output
    is written again by another.
    """
    rows.select("shard", F.col("record").cast("string").alias("value")).write.partitionBy(
        "shard").text(path)
