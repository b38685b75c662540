"""A training-text pipeline: five stages, each written as Parquet and read by the next."""
from mastgrid.functions.durable import durable
from mastgrid.llm import bag_minhash, decontaminate, mixing, quality, token_shards


def quality_rules(spark, docs, sf_dir):
    """Documents that pass the current rule policy."""
    return quality.keep_good(docs)


def near_dedup(spark, docs, sf_dir):
    """One document of each near-duplicate class, that with the smallest id."""
    return bag_minhash.keep_first(docs)


def decontamination(spark, docs, sf_dir):
    """Documents that hold no benchmark passage."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.clean_documents(docs, benchmark)


def mixture(spark, docs, sf_dir):
    """Documents as often as their source's weight asks; each is used once at least."""
    return mixing.realise(docs)


def training_order(spark, docs, sf_dir):
    """Token sequences with their slot, shard, offset and record."""
    return token_shards.training_order(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_dedup),
    ("decontamination", decontamination),
    ("mixture", mixture),
    ("training order", training_order),
]

#: Near-duplicate classes are no SQL; tests hold them against a brute-force version, and what
#: the other stages keep against their operators.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The stages one after another, from ``documents`` on."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *most, last = STAGES
    for _, stage in most:
        docs = durable(stage(spark, docs, sf_dir))
    return last[1](spark, docs, sf_dir)
