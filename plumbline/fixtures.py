"""The domain's tables as projections of the test tables, in SQL that Spark and DuckDB both read.

A name in braces stands for a table. Coordinates come from an integer key with whole-number
arithmetic, so both engines get the same doubles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LAT = "(CAST(-26.5 AS DOUBLE) + CAST((({k}) * 7919) % 100003 AS DOUBLE) / CAST(100003 AS DOUBLE) * CAST(2.5 AS DOUBLE))"
LNG = "(CAST(-58.5 AS DOUBLE) + CAST((({k}) * 104729) % 100019 AS DOUBLE) / CAST(100019 AS DOUBLE) * CAST(2.5 AS DOUBLE))"


def at(key: str) -> str:
    return f"{LAT.replace('{k}', key)} AS lat, {LNG.replace('{k}', key)} AS lng"


_PIN = "CASE WHEN o_orderkey % 50 = 0 THEN 17 ELSE o_orderkey + 31 END"

TABLES = {
    "business": f"""SELECT c_custkey AS id, c_name AS name, c_mktsegment AS category, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_mktsegment END AS business_category,
        concat(c_mktsegment, CAST(c_nationkey % 3 AS STRING)) AS business_type,
        CAST(CASE c_custkey % 4 WHEN 0 THEN 90 WHEN 1 THEN 85 WHEN 2 THEN 60 ELSE 40 END AS DOUBLE) / CAST(100 AS DOUBLE) AS category_confidence, c_custkey % 20 <> 0 AS is_active, {at('c_custkey')} FROM {{customer}}""",
    "listing": f"""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN 'portal_a' ELSE 'portal_b' END AS fuente, CASE WHEN o_orderkey % 5 = 0 THEN 'alquiler' ELSE 'venta' END AS operacion,
        o_totalprice AS precio, CASE o_orderkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'PYG' ELSE 'EUR' END AS moneda, CAST(30 * (o_orderkey % 97) AS DOUBLE) AS superficie_m2, {at(_PIN)} FROM {{orders}}""",
    "population": f"SELECT l_orderkey * 8 + l_linenumber AS id, l_quantity AS population, {at('l_orderkey * 8 + l_linenumber')} FROM {{lineitem}}",
    "poi": f"""SELECT s_suppkey AS id, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_name END AS name,
        CASE s_suppkey % 5 WHEN 0 THEN 'hospital' WHEN 1 THEN 'university' WHEN 2 THEN 'bus_station' WHEN 3 THEN 'police' ELSE 'marketplace' END AS amenity, {at('s_suppkey + 17')} FROM {{supplier}}""",
    "district": f"SELECT n_nationkey AS id, n_name AS name, {at('CAST(n_nationkey AS BIGINT) * 1009 + 5')} FROM {{nation}}",
    "rate": "SELECT DISTINCT CAST(ts AS DATE) AS fecha, CAST(7300 + day(ts) AS DOUBLE) AS pyg_por_usd FROM {events}",
    "page": "SELECT page_id, url, html FROM {pages}",
    "task_event": """SELECT event_id AS seq, concat(CAST(user_id AS STRING), '/', event_type) AS task, CAST(floor(value) AS BIGINT) AS results_count,
        CASE event_type WHEN 'view' THEN 'pending' WHEN 'click' THEN 'in_progress' WHEN 'purchase' THEN 'completed' ELSE 'failed' END AS status, user_id, ts FROM {events}""",
    "part_name": "SELECT p_partkey AS id, p_name AS name FROM {part}",
}


def spark_sql(name: str, sf_dir: str) -> str:
    import re

    return re.sub(r"\{(\w+)\}", lambda m: f"parquet.`{sf_dir}/{m[1]}.parquet`", TABLES[name])


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.sql(spark_sql(name, sf_dir))


def oracle(name: str) -> str:
    """The same projection for DuckDB, in parentheses."""
    import re

    return "(" + re.sub(r"\{(\w+)\}", r"\1", TABLES[name]) + ")"
