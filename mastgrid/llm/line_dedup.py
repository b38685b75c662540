"""Remove repeated runs of lines: three-line windows that occurred before go."""
import pandas as pd
from pyspark.sql import functions as F

LINES = 3
KEY = ["h1", "h2"]


def _identified(docs):
    """A row's id and a hash of its text, which tells rows of one id apart."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.struct(F.col("doc_id").alias("doc_id"), F.xxhash64(text).alias("t")).alias("at"),
        F.col("doc_id"), text.alias("text"))


def windows(rows):
    """``at, pos, h1, h2`` of every three consecutive lines."""
    lines = F.split("text", "\n")
    three = F.filter(F.sequence(F.lit(0), F.greatest(F.size("x"), F.lit(LINES)) - LINES),
                     lambda i: F.size("x") >= LINES)
    hashed = F.transform(three, lambda i: F.struct(
        i.alias("pos"),
        F.xxhash64(F.get("x", i), F.get("x", i + 1), F.get("x", i + 2)).alias("h1"),
        F.xxhash64(F.get("x", i + 2), F.lit(1), F.get("x", i + 1), F.get("x", i)).alias("h2")))
    split = rows.select("at", F.explode(F.array(lines)).alias("x"))
    return split.select("at", F.inline(hashed))


def repeated(found):
    """``at, positions``: per document, where windows start that an earlier place has.

    Earlier is a smaller id, or the same document further up; rows of one id and text are at
    the same place. A window in a third of all documents is one row per task in the count;
    the join that brings it back to its places may be split by adaptive execution.
    """
    place = F.struct("at.doc_id", "pos")
    first = found.groupBy(*KEY).agg(
        F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    later = found.join(first, KEY).filter(place > F.col("first"))
    return later.groupBy("at").agg(F.collect_set("pos").alias("positions"))


RESULT = "struct<text:string,n_lines:bigint,n_removed:bigint,n_spans:bigint>"


def _without(texts: pd.Series, positions: pd.Series) -> pd.DataFrame:
    out = []
    for text, starts in zip(texts, positions):
        if starts is None:
            out.append((text, text.count("\n") + 1, 0, 0))
            continue
        covered = {line for start in starts for line in range(start, start + LINES)}
        lines = text.split("\n")
        spans = sum(line - 1 not in covered for line in covered)
        text = "\n".join(x for i, x in enumerate(lines) if i not in covered)
        out.append((text, len(lines), len(covered), spans))
    return pd.DataFrame(out, columns=["text", "n_lines", "n_removed", "n_spans"])


def dedup_lines(docs):
    """``doc_id, text, n_lines, n_removed, n_spans`` with later repeats taken out.

    Lines are split at \\n and compared as they are; a text of fewer than three lines has no
    window and stays. NULL counts as the empty text, which is one empty line.
    """
    rows = _identified(docs)
    marks = repeated(windows(rows)).select(F.col("at").alias("m"), "positions")
    joined = rows.join(marks, F.col("at").eqNullSafe(F.col("m")), "left")
    return joined.select("doc_id", F.pandas_udf(_without, RESULT)("text", "positions").alias("r")).select("doc_id", "r.*")
