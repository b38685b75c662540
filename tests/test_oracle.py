"""Every registered query against DuckDB, value for value."""
import math
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as driver  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = driver.tower_queries(), driver.tower_sql()
NO_SQL = {
    "suggest_sites_all", "suggest_sites_operator", "suggest_sites_tech",
    "suggest_sites_operator_tech", "layer_sites", "map_layers",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{DATA}/lineitem.parquet'")
    yield connection
    connection.close()


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "timestamp": "TIMESTAMP", "boolean": "BOOLEAN"}


def kind(value):
    return "number" if isinstance(value, (int, float)) else type(value).__name__


def rows_by_name(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    table = [tuple(row[i] for i in order) for row in rows]
    return sorted(table, key=lambda row: [(v is None, kind(v), v if v is not None else 0) for v in row])


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return a == b or math.isclose(a, b, rel_tol=1e-12)
    return a == b and type(a) is type(b)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(name, spark, duck):
    result = QUERIES[name](spark, DATA)
    expected = duck.execute(ORACLES[name])
    names = [column[0] for column in expected.description]
    assert sorted(result.columns) == sorted(names)
    types = {column[0]: str(column[1]) for column in expected.description}
    assert {name: TYPES[dtype] for name, dtype in result.dtypes} == types
    found = rows_by_name(result.columns, [tuple(row) for row in result.collect()])
    wanted = rows_by_name(names, expected.fetchall())
    assert len(found) == len(wanted) > 0
    wrong = [(f, w) for f, w in zip(found, wanted) if not all(map(same, f, w))]
    assert not wrong, wrong[:3]


def test_every_query_has_an_oracle():
    assert set(QUERIES) - set(ORACLES) == NO_SQL
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert driver.entry(spark).count() == 133
