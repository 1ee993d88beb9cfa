"""Raw order events made from the ``orders`` table, for Spark and for DuckDB.

Three versions per order, with every timestamp format, out-of-order updates,
moved dates and at least one fault for each rule.  The expressions are plain SQL
that both engines read the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

BASE = {
    "k": "o_orderkey",
    "o_custkey": "o_custkey",
    "o_totalprice": "o_totalprice",
    "v": "v",
    "e": "o_orderkey * 3 + v",
    "ed": "CAST(CAST(o_orderdate AS DATE) + CASE WHEN v = 3 AND o_orderkey % 10 = 0 THEN 1 ELSE 0 END AS STRING)",
    "ud": "CAST(CAST(o_orderdate AS DATE) + CASE WHEN o_orderkey % 7 = 0 THEN 4 - v ELSE v END AS STRING)",
    "hms": (
        "lpad(CAST(o_orderkey % 24 AS STRING),2,'0') || ':' || lpad(CAST(o_orderkey % 60 AS STRING),2,'0')"
        " || ':' || lpad(CAST((o_orderkey * 7) % 60 AS STRING),2,'0')"
    ),
}

EVENT = {
    "orderId": "CASE WHEN e % 97 = 1 THEN '   ' ELSE ' o' || CAST(k AS STRING) || ' ' END",
    "customerId": "CASE WHEN e % 89 = 2 THEN NULL ELSE 'c' || CAST(o_custkey AS STRING) END",
    "amount": (
        "CASE WHEN e % 83 = 3 THEN NULL WHEN e % 79 = 4 THEN -o_totalprice"
        " WHEN v = 1 THEN o_totalprice ELSE o_totalprice + v END"
    ),
    "timestamp": (
        "CASE WHEN e % 73 = 5 THEN 'not-a-date' WHEN e % 71 = 6 THEN '' WHEN e % 67 = 7 THEN NULL"
        " WHEN e % 5 = 0 THEN ed || 'T' || hms || '.' || lpad(CAST(k % 1000 AS STRING), 3, '0') || 'Z'"
        " WHEN e % 5 = 1 THEN ed || 'T' || hms || 'Z'"
        " WHEN e % 5 = 2 THEN ed || 'T' || hms"
        " WHEN e % 5 = 3 THEN ed || ' ' || hms"
        " ELSE ed END"
    ),
    "updatedAt": (
        "CASE WHEN e % 61 = 8 THEN 'garbage' WHEN e % 59 = 9 THEN '  ' WHEN e % 53 = 10 THEN NULL"
        " ELSE ' ' || ud || 'T' || hms || 'Z' END"
    ),
    "eventVersion": (
        "CASE WHEN e % 47 = 11 THEN CAST(NULL AS BIGINT) WHEN e % 43 = 12 THEN CAST(-1 AS BIGINT)"
        " ELSE CAST(v AS BIGINT) END"
    ),
    "_rescued_data": "CASE WHEN e % 41 = 13 THEN '{\"extra\":\"x\"}' END",
    "_corrupt_record": "CASE WHEN e % 101 = 14 THEN '{broken' END",
    "ingest_timestamp": (
        "CASE v WHEN 1 THEN TIMESTAMP '2026-01-01 00:00:00' WHEN 2 THEN TIMESTAMP '2026-01-02 00:00:00'"
        " ELSE TIMESTAMP '2026-01-03 00:00:00' END"
    ),
}


def _select_list(expressions: dict[str, str], quote: str) -> list[str]:
    return [f"{sql} AS {quote}{name}{quote}" for name, sql in expressions.items()]


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"
    )
    versions = orders.withColumn("v", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
    return versions.selectExpr(*_select_list(BASE, "`")).selectExpr(*_select_list(EVENT, "`"))


ORDER_EVENTS_SQL = (
    f"SELECT {', '.join(_select_list(EVENT, chr(34)))}\n"
    f"FROM (SELECT {', '.join(_select_list(BASE, chr(34)))}\n"
    "      FROM orders CROSS JOIN (VALUES (1),(2),(3)) AS t(v)) b"
)
