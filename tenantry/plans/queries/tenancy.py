"""Footprints and ranking of tenants."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenantry.operators import tenants
from tenantry.plans.bindings import customer_metrics, reader
from tenantry.skew import look_up
from tenantry.sources.graph import entries_text

CRITERIA = {"min_students": 8, "min_schools": 3, "min_total_records": 30, "max_total_records": 70, "min_completeness_pct": 85}
SCALE = {"size_cap": 80, "activity_cap": 4, "large_from": 55, "medium_from": 45}


def _by_nation(spark: SparkSession, folder: str) -> dict[str, tuple[DataFrame, str]]:
    t = reader(spark, folder)
    nation_of = t("customer").select(F.col("c_custkey"), F.col("c_nationkey"))
    orders = look_up(t("orders").select("o_orderkey", "o_custkey"), nation_of, [("o_custkey", "c_custkey")])
    nation_of_order = orders.select("o_orderkey", "c_nationkey")
    per_order = look_up(t("lineitem").select("l_orderkey"), nation_of_order, [("l_orderkey", "o_orderkey")])
    return {
        "customer": (t("customer"), "c_nationkey"),
        "supplier": (t("supplier"), "s_nationkey"),
        "orders": (orders, "c_nationkey"),
        "lineitem": (per_order, "c_nationkey"),
    }


def volume_profile(spark: SparkSession, folder: str) -> DataFrame:
    return tenants.volume_profile(_by_nation(spark, folder))


def footprint(spark: SparkSession, folder: str) -> DataFrame:
    store = {"customer": "crm", "supplier": "erp", "orders": "shop", "lineitem": "shop"}
    found = tenants.footprint({(store[name], name): value for name, value in _by_nation(spark, folder).items()})
    by_store = F.col("footprint_by_store").cast("map<string,string>")
    return found.select("tenant", "total_records", entries_text(by_store).alias("footprint"))


def recent_activity(spark: SparkSession, folder: str) -> DataFrame:
    return tenants.recent_activity(reader(spark, folder)("events"), "user_id", "ts", as_of="2024-02-14")


def completeness_percent(spark: SparkSession, folder: str) -> DataFrame:
    """Zero rates of tax and discount are taken as missing."""
    lines = reader(spark, folder)("lineitem").select(
        "l_suppkey",
        F.nullif("l_tax", F.lit(0.0)).alias("l_tax"),
        F.nullif("l_discount", F.lit(0.0)).alias("l_discount"),
        "l_quantity",
    )
    found = tenants.completeness(lines, "l_suppkey", ["l_tax", "l_discount", "l_quantity"])
    return found.select("tenant", F.round("data_completeness_pct", 6).alias("data_completeness_pct"))


def eligible_tenants(spark: SparkSession, folder: str) -> DataFrame:
    return tenants.eligible(customer_metrics(spark, folder), CRITERIA).select("tenant", "students", "schools", "total_records")


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    return tenants.score_tenants(customer_metrics(spark, folder), **SCALE)


def tenant_score(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(spark, folder).select("tenant", "priority_score", "size_category")


def planned_hours(spark: SparkSession, folder: str) -> DataFrame:
    """Hours for the records of each customer, taken a thousandfold."""
    counts = customer_metrics(spark, folder)
    return counts.select("tenant", tenants.migration_hours(F.col("total_records") * 1000).alias("hours"))


def tenant_rank(spark: SparkSession, folder: str) -> DataFrame:
    return tenants.rank_all(_scored(spark, folder)).select("tenant", "priority_score", "priority")


def _recommended(spark: SparkSession, folder: str) -> DataFrame:
    chosen = tenants.eligible(customer_metrics(spark, folder), CRITERIA)
    return tenants.recommend(tenants.score_tenants(chosen, **SCALE))


def pilot_pick(spark: SparkSession, folder: str) -> DataFrame:
    return _recommended(spark, folder).select("tenant", "size_category", "priority_score", "priority", "recommended_for_pilot")


def tenant_summary(spark: SparkSession, folder: str) -> DataFrame:
    return tenants.summarize(_recommended(spark, folder))


_NATIONS = """
by_table AS (
  SELECT 'customer' AS table_name, c_nationkey AS tenant, count(*) AS "rows" FROM customer GROUP BY 2
  UNION ALL SELECT 'supplier', s_nationkey, count(*) FROM supplier GROUP BY 2
  UNION ALL SELECT 'orders', c_nationkey, count(*) FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 2
  UNION ALL SELECT 'lineitem', c_nationkey, count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey GROUP BY 2
)
"""
# printf rounds the exact value of a double, ties to even
_METRICS = """
per_order AS (
  SELECT l_orderkey, count(*) AS lines, sum((l_tax <> 0)::INT + (l_discount <> 0)::INT) AS filled FROM lineitem GROUP BY 1
),
m AS (
  SELECT c_custkey AS tenant, count(*) AS students, count(DISTINCT o_orderpriority) AS schools,
    CAST(count(*) + coalesce(sum(lines), 0) AS BIGINT) AS total_records,
    count(*) FILTER (WHERE o_orderdate >= DATE '2001-01-01') AS recent,
    CAST(sum(filled) AS DOUBLE) * 100e0 / CAST(sum(lines) * 2 AS DOUBLE) AS complete,
    coalesce(max(lines), 0) AS staff,
    CASE WHEN max(c_acctbal) >= 0 THEN floor(max(c_acctbal) / 100e0) END AS business
  FROM orders LEFT JOIN per_order ON o_orderkey = l_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY 1
),
s AS (
  SELECT *, CAST(printf('%.2f',
      least(100e0, CAST(total_records AS DOUBLE) / 80e0 * 100e0) * 0.4e0 + least(100e0, CAST(recent AS DOUBLE) / 4e0 * 100e0) * 0.3e0
      + coalesce(complete, 100e0) * 0.2e0 + coalesce(business, 50e0) * 0.1e0) AS DOUBLE) AS priority_score,
    CASE WHEN total_records >= 55 THEN 'large' WHEN total_records >= 45 THEN 'medium' ELSE 'small' END AS size_category,
    CAST(printf('%.1f', (CAST(total_records AS DOUBLE) / 50000e0 + CAST(total_records AS DOUBLE) / 100000e0
      + CAST(total_records AS DOUBLE) / 200000e0 + CAST(total_records AS DOUBLE) / 30000e0) * 1.1e0 / 60e0) AS DOUBLE) AS hours
  FROM m
),
e AS (SELECT * FROM s WHERE students >= 8 AND schools >= 3 AND total_records BETWEEN 30 AND 70 AND coalesce(complete, 100e0) >= 85),
best AS (SELECT *, row_number() OVER (ORDER BY priority_score DESC, tenant) AS priority FROM e QUALIFY priority <= 15),
picked AS (SELECT *, row_number() OVER (PARTITION BY size_category ORDER BY priority) = 1 AS recommended_for_pilot FROM best)
"""

QUERIES = {
    "volume_profile": volume_profile,
    "footprint": footprint,
    "recent_activity": recent_activity,
    "completeness_percent": completeness_percent,
    "eligible_tenants": eligible_tenants,
    "tenant_score": tenant_score,
    "planned_hours": planned_hours,
    "tenant_rank": tenant_rank,
    "pilot_pick": pilot_pick,
    "tenant_summary": tenant_summary,
}

SQL = {
    "volume_profile": f"WITH {_NATIONS} SELECT * FROM by_table",
    "footprint": f"""
        WITH {_NATIONS}, by_store AS (
          SELECT tenant, CASE table_name WHEN 'customer' THEN 'crm' WHEN 'supplier' THEN 'erp' ELSE 'shop' END AS store,
            CAST(sum("rows") AS BIGINT) AS n FROM by_table GROUP BY 1, 2)
        SELECT tenant, CAST(sum(n) AS BIGINT) AS total_records, string_agg(store || '=' || n, ',' ORDER BY store) AS footprint
        FROM by_store GROUP BY tenant
    """,
    "recent_activity": """
        SELECT user_id AS tenant, count(*) AS recent_updates_30d FROM events WHERE ts >= DATE '2024-02-14' - INTERVAL 30 DAY GROUP BY 1
    """,
    "completeness_percent": """
        SELECT l_suppkey AS tenant, round(CAST(sum((l_tax <> 0)::INT + (l_discount <> 0)::INT + 1) AS DOUBLE) * 100e0
          / CAST(count(*) * 3 AS DOUBLE), 6) AS data_completeness_pct FROM lineitem GROUP BY 1
    """,
    "eligible_tenants": f"WITH {_METRICS} SELECT tenant, students, schools, total_records FROM e",
    "tenant_score": f"WITH {_METRICS} SELECT tenant, priority_score, size_category FROM s",
    "planned_hours": f"""WITH {_METRICS}, x AS (SELECT tenant, CAST(total_records * 1000 AS DOUBLE) AS n FROM m)
        SELECT tenant, CAST(printf('%.1f', (n / 50000e0 + n / 100000e0 + n / 200000e0 + n / 30000e0) * 1.1e0 / 60e0) AS DOUBLE) AS hours FROM x""",
    "tenant_rank": f"""WITH {_METRICS}
        SELECT tenant, priority_score, row_number() OVER (ORDER BY priority_score DESC, tenant) AS priority FROM s""",
    "pilot_pick": f"""WITH {_METRICS}
        SELECT tenant, size_category, priority_score, CAST(priority AS INTEGER) AS priority, recommended_for_pilot FROM picked""",
    "tenant_summary": f"""WITH {_METRICS}
        SELECT count(*) AS recommended_tenants, CAST(coalesce(sum(students), 0) AS BIGINT) AS total_students,
          CAST(coalesce(sum(staff), 0) AS BIGINT) AS total_staff, CAST(coalesce(sum(schools), 0) AS BIGINT) AS total_schools,
          CAST(coalesce(sum(total_records), 0) AS BIGINT) AS total_records, round(coalesce(sum(hours), 0e0), 1) AS estimated_total_migration_hours,
          count(*) FILTER (WHERE size_category = 'large') AS large_tenants, count(*) FILTER (WHERE size_category = 'medium') AS medium_tenants,
          count(*) FILTER (WHERE size_category = 'small') AS small_tenants FROM picked
    """,
}
