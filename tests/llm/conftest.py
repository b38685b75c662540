import pytest


DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, spans string"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """NULLs in every column, empty and long texts, repeated rows, a clashing extra column."""
    long = " ".join(f"word{i % 700}" for i in range(30_000))
    texts = [(1, None), (2, ""), (3, "one"), (4, long), (5, long), (5, long), (None, "no id at all"),
             (7, "\n\n\n"), (8, "!!!"), (9, "!!!"), (10, "a" * 5000), (11, "a b " * 2000)]
    rows = [(i, t, None, None if k % 2 else "s", None, "x") for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
