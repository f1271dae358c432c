"""Figures about runs, from one row per run, phase and table.

``run_metrics(run_id, tenant, phase, store, table_name, rows, fields, success,
warnings, seconds, started, message)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenantry.functions.numbers import duration_text

PHASES = ("extraction", "anonymization", "validation", "loading", "reporting")
METRICS_SCHEMA = (
    "run_id STRING, tenant STRING, phase STRING, store STRING, table_name STRING, rows BIGINT, fields BIGINT, "
    "success BOOLEAN, warnings BIGINT, seconds DOUBLE, started TIMESTAMP_NTZ, message STRING"
)
SHOWN_WARNINGS = 10


def _of(phase: str, value: Column) -> Column:
    return F.when(F.col("phase") == phase, value)


def roll_up(metrics: DataFrame) -> DataFrame:
    """One row per run: records, fields, warnings, seconds by phase, start, end and status.

    A run failed if any phase did; its message is that of the last failed phase.
    All phases come from one grouping, without a pivot.
    """
    total = lambda phase, c: F.coalesce(F.sum(_of(phase, F.col(c))), F.lit(0))
    place = F.array_position(F.array(*[F.lit(p) for p in PHASES]), F.col("phase"))
    failed = F.when(~F.col("success"), F.struct(place, F.col("message")))
    figures = [
        total("extraction", "rows").alias("records_extracted"),
        total("anonymization", "fields").alias("fields_anonymized"),
        total("validation", "warnings").alias("validation_warnings"),
        total("loading", "rows").alias("records_loaded"),
        *[total(p, "seconds").alias(f"{p}_seconds") for p in PHASES],
        F.coalesce(F.sum("seconds"), F.lit(0.0)).alias("total_seconds"),
        F.min("started").alias("start_time"),
        F.max("started").alias("end_time"),
        F.bool_and("success").alias("overall_success"),
        F.max(failed)["message"].alias("error_message"),
    ]
    status = F.when(F.col("overall_success"), "SUCCESS").otherwise("FAILED")
    return metrics.groupBy("run_id").agg(*figures).withColumn("overall_status", status)


def phase_breakdown(metrics: DataFrame) -> DataFrame:
    """Stores, tables, rows, fields, warnings and duration per run and phase."""
    per_phase = metrics.groupBy("run_id", "phase").agg(
        F.count_distinct("store").alias("stores"),
        F.count(F.lit(1)).alias("tables"),
        F.sum("rows").alias("rows"),
        F.sum("fields").alias("fields"),
        F.sum("warnings").alias("warnings"),
        F.bool_and("success").alias("success"),
        F.sum("seconds").alias("seconds"),
    )
    return per_phase.withColumn("duration", duration_text(F.col("seconds")))


def first_warnings(warnings: DataFrame, per: str, order: list[str], shown: int = SHOWN_WARNINGS) -> DataFrame:
    """The first warnings of each run with their place, and how many more there are.

    Spark keeps only ``shown`` rows per run and task before the shuffle, because
    of the limit on the row number; the total is a grouping of its own.
    """
    place = F.row_number().over(Window.partitionBy(per).orderBy(*order))
    first = warnings.withColumn("place", place).filter(F.col("place") <= shown)
    totals = warnings.groupBy(F.col(per).alias("of")).agg(F.count(F.lit(1)).alias("all"))
    more = F.greatest(F.col("all") - shown, F.lit(0)).alias("more")
    return first.join(totals, F.col(per).eqNullSafe(F.col("of"))).select(*warnings.columns, "place", more)


def errors(findings: DataFrame) -> DataFrame:
    """Failed checks of severity ERROR."""
    return findings.filter((F.col("severity") == "ERROR") & (F.col("failed") > 0))


def append_decision(log: str, decision: DataFrame) -> None:
    """Add the decision of a run to the log of decisions."""
    decision.coalesce(1).write.mode("append").parquet(log)
