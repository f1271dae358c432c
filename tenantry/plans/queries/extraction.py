"""Subsets of the tables for one nation or region."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenantry.model import ForeignKey
from tenantry.operators import extract
from tenantry.operators.validate import reference_findings
from tenantry.plans.bindings import KEYS, STORE_OF, reader, tables
from tenantry.sources.tables import bounded_query
from tenantry.state import materialize

ALL_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
NATION = {"nation": {"n_nationkey": 7}}


def _day(column: str):
    return F.date_format(column, "yyyy-MM-dd").alias(column)


def extract_direct(spark: SparkSession, folder: str) -> DataFrame:
    return extract.extract_direct(reader(spark, folder)("customer"), {"c_nationkey": 7, "c_mktsegment": "BUILDING"})


def extract_one_hop(spark: SparkSession, folder: str) -> DataFrame:
    t = reader(spark, folder)
    rows = extract.extract_through_parent(t("orders"), t("customer"), {"c_nationkey": 7}, "o_custkey", "c_custkey")
    return rows.withColumn("o_orderdate", _day("o_orderdate"))


def extract_chain(spark: SparkSession, folder: str) -> DataFrame:
    data = tables(spark, folder, "region", "nation", "customer", "orders", "lineitem")
    chain = [k for k in KEYS if k.child in ("nation", "customer", "orders", "lineitem") and k.parent in data]
    rows = extract.extract_through_chain(data, chain, {"r_name": "ASIA"})
    return rows.withColumn("l_shipdate", _day("l_shipdate"))


def extract_bridge(spark: SparkSession, folder: str) -> DataFrame:
    t = reader(spark, folder)
    return extract.extract_bridge(
        t("lineitem"),
        t("orders").filter("o_orderstatus = 'F'"),
        [("l_orderkey", "o_orderkey")],
        t("part").filter("p_brand = 'Brand#7'"),
        [("l_partkey", "p_partkey")],
    ).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")


def _keep(name: str, df: DataFrame) -> DataFrame:
    return materialize(df, name)


def _nation_counts(spark: SparkSession, folder: str) -> DataFrame:
    data = tables(spark, folder, *ALL_TABLES)
    subset = extract.extract_dataset(data, KEYS, {}, tenant_columns=NATION, save=_keep)
    return extract.manifest(subset, STORE_OF.__getitem__)


def extract_totals(spark: SparkSession, folder: str) -> DataFrame:
    return extract.manifest_totals(_nation_counts(spark, folder))


def extract_checks(spark: SparkSession, folder: str) -> DataFrame:
    expected = [*ALL_TABLES, "events"]
    return extract.extraction_checks(_nation_counts(spark, folder), expected, "nation")


def extract_cycle(spark: SparkSession, folder: str) -> DataFrame:
    """Customers refer to their last order, orders to their customer: the first key is broken."""
    data = tables(spark, folder, "customer", "orders")
    last = data["orders"].groupBy("o_custkey").agg(F.max("o_orderkey").alias("c_lastorder"))
    data["customer"] = data["customer"].join(last, F.col("c_custkey") == F.col("o_custkey"), "left").drop("o_custkey")
    back = ForeignKey.of("customer", "c_lastorder", "orders", "o_orderkey")
    there = ForeignKey.of("orders", "o_custkey", "customer", "c_custkey")
    subset = extract.extract_dataset(data, [back, there], {"c_nationkey": 7}, broken=[back])
    counts = extract.manifest(subset, STORE_OF.__getitem__).select("table_name", "rows")
    lost = reference_findings(subset, [back]).select(F.lit("broken key").alias("table_name"), F.col("failed").alias("rows"))
    return counts.unionByName(lost)


def missing_references(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of one region's customers against suppliers of the same region."""
    data = tables(spark, folder, "nation", "customer", "orders", "lineitem", "supplier")
    region = {"nation": {"n_regionkey": 2}}
    keys = [k for k in KEYS if k.child in data and k.parent in data]
    first = [k for k in keys if k.columns != ("l_suppkey",)]
    subset = extract.extract_dataset(data, first, {}, tenant_columns=region, save=_keep)
    found = reference_findings(subset, keys, count_rows=True)
    return found.select("table_name", "column_name", "ref_table", "failed")


def bounded_read(spark: SparkSession, folder: str) -> DataFrame:
    reader(spark, folder)("orders").createOrReplaceTempView("bounded_orders")
    query = """
        SELECT o_orderkey, o_custkey, o_totalprice FROM bounded_orders
        WHERE o_orderstatus = :status ORDER BY o_totalprice DESC, o_orderkey
    """
    return bounded_query(spark, query, {"status": "F"}, limit=1000)


_NATION_CTE = """
WITH n AS (SELECT * FROM nation WHERE n_nationkey = 7),
c AS (SELECT * FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM n)),
s AS (SELECT * FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM n)),
o AS (SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM c)),
l AS (SELECT * FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM o) AND l_suppkey IN (SELECT s_suppkey FROM s)),
p AS (SELECT * FROM part WHERE p_partkey IN (SELECT l_partkey FROM l)),
r AS (SELECT * FROM region WHERE r_regionkey IN (SELECT n_regionkey FROM n)),
counts AS (
  SELECT 'catalog' AS store, 'region' AS table_name, count(*) AS "rows" FROM r
  UNION ALL SELECT 'catalog', 'nation', count(*) FROM n
  UNION ALL SELECT 'sales', 'customer', count(*) FROM c
  UNION ALL SELECT 'catalog', 'supplier', count(*) FROM s
  UNION ALL SELECT 'catalog', 'part', count(*) FROM p
  UNION ALL SELECT 'sales', 'orders', count(*) FROM o
  UNION ALL SELECT 'sales', 'lineitem', count(*) FROM l
)
"""

QUERIES = {
    "extract_direct": extract_direct,
    "extract_one_hop": extract_one_hop,
    "extract_chain": extract_chain,
    "extract_bridge": extract_bridge,
    "extract_manifest": _nation_counts,
    "extract_totals": extract_totals,
    "extract_checks": extract_checks,
    "extract_cycle": extract_cycle,
    "missing_references": missing_references,
    "bounded_read": bounded_read,
}

SQL = {
    "extract_direct": "SELECT * FROM customer WHERE c_nationkey = 7 AND c_mktsegment = 'BUILDING'",
    "extract_one_hop": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority
        FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey = 7)
    """,
    "extract_chain": """
        SELECT l.* REPLACE (strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate) FROM lineitem l
        WHERE l_orderkey IN (
          SELECT o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
          JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA')
    """,
    "extract_bridge": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity FROM lineitem
        WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
          AND l_partkey IN (SELECT p_partkey FROM part WHERE p_brand = 'Brand#7')
    """,
    "extract_manifest": f"{_NATION_CTE} SELECT * FROM counts",
    "extract_totals": f"""{_NATION_CTE}
        SELECT store, count(*) AS tables, CAST(sum("rows") AS BIGINT) AS "rows" FROM counts GROUP BY store
        UNION ALL SELECT 'ALL', count(*), CAST(sum("rows") AS BIGINT) FROM counts
    """,
    "extract_checks": f"""{_NATION_CTE}
        SELECT table_name, "rows", CASE WHEN "rows" > 0 THEN 'ok' WHEN table_name = 'nation' THEN 'tenant_not_found' ELSE 'empty_table' END AS result
        FROM counts UNION ALL SELECT 'events', 0, 'missing_table'
    """,
    "extract_cycle": """
        WITH c AS (SELECT * FROM customer WHERE c_nationkey = 7),
        o AS (SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM c)),
        f AS (SELECT max(o_orderkey) AS k FROM orders WHERE o_custkey IN (SELECT c_custkey FROM c) GROUP BY o_custkey)
        SELECT 'customer' AS table_name, count(*) AS "rows" FROM c
        UNION ALL SELECT 'orders', count(*) FROM o
        UNION ALL SELECT 'broken key', count(DISTINCT k) FROM f WHERE k NOT IN (SELECT o_orderkey FROM o)
    """,
    "missing_references": """
        WITH n AS (SELECT * FROM nation WHERE n_regionkey = 2),
        c AS (SELECT * FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM n)),
        s AS (SELECT * FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM n)),
        o AS (SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM c)),
        l AS (SELECT * FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM o))
        SELECT 'customer' AS table_name, 'c_nationkey' AS column_name, 'nation' AS ref_table,
               (SELECT count(*) FROM c WHERE c_nationkey NOT IN (SELECT n_nationkey FROM n)) AS failed
        UNION ALL SELECT 'supplier', 's_nationkey', 'nation', (SELECT count(*) FROM s WHERE s_nationkey NOT IN (SELECT n_nationkey FROM n))
        UNION ALL SELECT 'orders', 'o_custkey', 'customer', (SELECT count(*) FROM o WHERE o_custkey NOT IN (SELECT c_custkey FROM c))
        UNION ALL SELECT 'lineitem', 'l_orderkey', 'orders', (SELECT count(*) FROM l WHERE l_orderkey NOT IN (SELECT o_orderkey FROM o))
        UNION ALL SELECT 'lineitem', 'l_suppkey', 'supplier', (SELECT count(*) FROM l WHERE l_suppkey NOT IN (SELECT s_suppkey FROM s))
    """,
    "bounded_read": """
        SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'
        ORDER BY o_totalprice DESC, o_orderkey LIMIT 1000
    """,
}
