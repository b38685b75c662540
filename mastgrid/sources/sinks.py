"""Write results and the cleaned table."""
from pyspark.sql import functions as F

#: The partition column of a kept table and what it says of a technology: its name behind a
#: mark, so that blank differs from NULL and no name is taken for a number.
TECH_KEY, NO_TECH, MARK = "radio_key", "none", "is "


def tech_key():
    return F.coalesce(F.concat(F.lit(MARK), F.col("radio")), F.lit(NO_TECH))


def tech_of_key():
    """The technology that a partition holds; a filter on it picks the partitions."""
    return F.when(F.col(TECH_KEY) != NO_TECH, F.substring(TECH_KEY, len(MARK) + 1, 1_000_000))


def write_result(df, path, fmt="parquet", partition_by=(), mode="errorifexists"):
    """Write a result table; ``fmt`` is parquet, orc, json or csv (with a header)."""
    writer = df.write.format(fmt).mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def save_clean(towers, path, mode="errorifexists"):
    """Keep a cleaned tower table as Parquet folders by technology; read it by ``read_towers``.

    A filter on ``radio`` then reads one folder. The rebalance hint lets adaptive execution
    split the common technologies over many files and join the rare ones into few.
    """
    rows = towers.withColumn(TECH_KEY, tech_key()).drop("radio").hint("rebalance", TECH_KEY)
    write_result(rows, path, "parquet", [TECH_KEY], mode)
