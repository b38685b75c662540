"""A tower table derived from the ``lineitem`` test table, row for row."""

NETWORKS = "array(260, 260, 410, 480, 480, 120, 410, 260, 4, 30)"
WEST = "least(4000D / ((l_partkey * 7919 + l_orderkey * 31) % 10007 + 1), 45D)"
NORTH = "least(4000D / ((l_orderkey * 104729 + l_linenumber * 1299709) % 10009 + 1), 24D)"
DAY = "(l_orderkey * 31337 + l_linenumber) % 6500"

COLUMNS = [
    """CASE WHEN l_partkey % 10 < 5 THEN 'LTE' WHEN l_partkey % 10 < 7 THEN 'UMTS'
       WHEN l_partkey % 10 < 9 THEN 'GSM' ELSE 'NR' END AS radio""",
    "IF(l_suppkey % 10 IN (3, 4), 311, 310) AS mcc",
    f"{NETWORKS}[CAST(l_suppkey % 10 AS INT)] AS mnc",
    "l_suppkey AS area",
    "l_partkey AS cell",
    "0 AS unit",
    f"""CASE WHEN l_orderkey % 101 = 0 THEN NULL WHEN l_orderkey % 97 = 0 THEN 0D
        WHEN l_linenumber = 1 THEN -75.5D - l_partkey % 40 ELSE -75D - {WEST} END AS lon""",
    f"""CASE WHEN l_orderkey % 103 = 0 THEN NULL WHEN l_orderkey % 89 = 0 THEN 0D
        WHEN l_linenumber = 1 THEN 25.5D + l_suppkey % 20 ELSE 25D + {NORTH} END AS lat""",
    "500 + (l_partkey * 37 + l_orderkey) % 40 * 100 AS range",
    "CAST(l_quantity AS BIGINT) AS samples",
    "1 AS changeable",
    f"1104537600 + {DAY} * 86400 AS created",
    f"1104537600 + ({DAY} + 30) * 86400 AS updated",
]


def towers_from_lineitem(lineitem):
    """One tower per line item; holds null, zero and exact-half coordinates by design."""
    return lineitem.selectExpr(*COLUMNS)
