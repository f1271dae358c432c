"""Figures about runs, with events as phases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenantry.functions.numbers import duration_text
from tenantry.operators import report
from tenantry.plans.bindings import reader, run_metrics


def run_rollup(spark: SparkSession, folder: str) -> DataFrame:
    rolled = report.roll_up(run_metrics(spark, folder))
    day = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return rolled.withColumns({"start_time": day("start_time"), "end_time": day("end_time")})


def phase_breakdown(spark: SparkSession, folder: str) -> DataFrame:
    return report.phase_breakdown(run_metrics(spark, folder))


def top_warnings(spark: SparkSession, folder: str) -> DataFrame:
    warnings = run_metrics(spark, folder).filter("warnings > 0")
    warnings = warnings.select("run_id", F.substring("message", 7, 20).cast("bigint").alias("event"), "message")
    return report.first_warnings(warnings, "run_id", ["event"]).drop("event")


def error_list(spark: SparkSession, folder: str) -> DataFrame:
    """Every failed phase as a finding."""
    metrics = run_metrics(spark, folder)
    severity = F.when(F.col("phase").isin("validation", "loading"), "ERROR").otherwise("WARNING")
    findings = metrics.select("run_id", "phase", "message", severity.alias("severity"), (~F.col("success")).cast("bigint").alias("failed"))
    return report.errors(findings).select("run_id", "phase", "message")


def duration_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Prices read as seconds."""
    lines = reader(spark, folder)("lineitem")
    return lines.groupBy("l_extendedprice", "l_quantity").agg(F.count(F.lit(1)).alias("rows")).select(
        "l_extendedprice",
        "l_quantity",
        "rows",
        duration_text(F.col("l_extendedprice") / 16).alias("long"),
        duration_text(F.col("l_quantity") * 1.05).alias("short"),
    )


_METRICS = """
m AS (
  SELECT CAST(user_id AS VARCHAR) AS run_id, CASE event_type WHEN 'click' THEN 'extraction' WHEN 'view' THEN 'anonymization'
      WHEN 'signup' THEN 'validation' WHEN 'purchase' THEN 'loading' ELSE 'reporting' END AS phase,
    CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'signup' THEN 3 WHEN 'purchase' THEN 4 ELSE 5 END AS place,
    substr(props, 7, 1) AS store, CAST(floor(value) AS BIGINT) AS n, length(props) AS fields, value < 250 AS success,
    CASE WHEN value > 100 THEN 1 ELSE 0 END AS warnings, floor(value) * 8 + 0.25e0 AS seconds, ts, event_id, 'event ' || event_id AS message
  FROM events
)
"""


def duration_sql(seconds: str) -> str:
    # printf rounds the exact value of a double, ties to even
    return f"""CASE WHEN {seconds} < 60 THEN printf('%.1f', {seconds}) || ' seconds' WHEN {seconds} < 3600
        THEN printf('%.1f', {seconds} / 60e0) || ' minutes' ELSE printf('%.1f', {seconds} / 3600e0) || ' hours' END"""


def _sum(column: str, phase: str) -> str:
    return f"coalesce(sum({column}) FILTER (WHERE phase = '{phase}'), 0)"


QUERIES = {
    "run_rollup": run_rollup,
    "phase_breakdown": phase_breakdown,
    "top_warnings": top_warnings,
    "error_list": error_list,
    "duration_texts": duration_texts,
}

SQL = {
    "run_rollup": f"""WITH {_METRICS}
        SELECT run_id, CAST({_sum('n', 'extraction')} AS BIGINT) AS records_extracted, CAST({_sum('fields', 'anonymization')} AS BIGINT) AS fields_anonymized,
          CAST({_sum('warnings', 'validation')} AS BIGINT) AS validation_warnings, CAST({_sum('n', 'loading')} AS BIGINT) AS records_loaded,
          {', '.join(f"{_sum('seconds', p)} AS {p}_seconds" for p in report.PHASES)},
          sum(seconds) AS total_seconds, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start_time, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS end_time,
          bool_and(success) AS overall_success, max({{'p': place, 'm': message}}) FILTER (WHERE NOT success).m AS error_message,
          CASE WHEN bool_and(success) THEN 'SUCCESS' ELSE 'FAILED' END AS overall_status FROM m GROUP BY run_id
    """,
    "phase_breakdown": f"""WITH {_METRICS}, g AS (
          SELECT run_id, phase, count(DISTINCT store) AS stores, count(*) AS tables, CAST(sum(n) AS BIGINT) AS "rows", CAST(sum(fields) AS BIGINT) AS fields,
            CAST(sum(warnings) AS BIGINT) AS warnings, bool_and(success) AS success, sum(seconds) AS seconds FROM m GROUP BY 1, 2)
        SELECT *, {duration_sql('seconds')} AS duration FROM g
    """,
    "top_warnings": f"""WITH {_METRICS}, w AS (
          SELECT run_id, message, row_number() OVER (PARTITION BY run_id ORDER BY event_id) AS place, count(*) OVER (PARTITION BY run_id) AS n
          FROM m WHERE warnings > 0)
        SELECT run_id, message, CAST(place AS INTEGER) AS place, greatest(n - 10, 0) AS more FROM w WHERE place <= 10
    """,
    "error_list": f"WITH {_METRICS} SELECT run_id, phase, message FROM m WHERE phase IN ('validation', 'loading') AND NOT success",
    "duration_texts": f"""
        SELECT l_extendedprice, l_quantity, count(*) AS "rows", {duration_sql('(l_extendedprice / 16e0)')} AS long,
          {duration_sql('(l_quantity * 1.05e0)')} AS short FROM lineitem GROUP BY 1, 2
    """,
}
