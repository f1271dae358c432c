"""Tenant footprints, scoring and selection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenantry.functions.numbers import round_exact
from tenantry.operators.ranking import number_rows

# Fixed values of the scoring and planning rules.
SIZE_CAP = 1_000_000
ACTIVITY_CAP = 10_000
WEIGHTS = {"size": 0.40, "activity": 0.30, "completeness": 0.20, "business": 0.10}
DEFAULT_BUSINESS_PRIORITY = 50
DEFAULT_COMPLETENESS = 100
RECORDS_PER_MINUTE = {"extraction": 50_000, "anonymization": 100_000, "validation": 200_000, "loading": 30_000}
OVERHEAD = 1.1
LARGE_FROM = 700_000
MEDIUM_FROM = 300_000
DEFAULT_CRITERIA = {
    "min_students": 5_000,
    "min_schools": 10,
    "min_total_records": 50_000,
    "max_total_records": 2_000_000,
    "min_completeness_pct": 85,
}
DEFAULT_TOP = 15


def volume_profile(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows per table and tenant; each table comes with its tenant column."""
    result = None
    for name, (df, tenant) in tables.items():
        counts = df.groupBy(F.col(tenant).alias("tenant")).agg(F.count(F.lit(1)).alias("rows"))
        counts = counts.select(F.lit(name).alias("table_name"), "tenant", "rows")
        result = counts if result is None else result.unionByName(counts)
    return result


def footprint(tables: Mapping[tuple[str, str], tuple[DataFrame, str]]) -> DataFrame:
    """Records per tenant in all, and by store as a map."""
    profile = volume_profile({f"{store}.{table}": value for (store, table), value in tables.items()})
    by_store = (
        profile.withColumn("store", F.split("table_name", r"\.", 2)[0])
        .groupBy("tenant", "store")
        .agg(F.sum("rows").alias("rows"))
    )
    # one entry for each store, so the list stays short
    entries = F.array_sort(F.collect_list(F.struct("store", "rows")))
    return by_store.groupBy("tenant").agg(
        F.sum("rows").alias("total_records"), F.map_from_entries(entries).alias("footprint_by_store")
    )


def recent_activity(df: DataFrame, tenant: str, updated_at: str, as_of: str, days: int = 30) -> DataFrame:
    """Rows updated within the last ``days`` days; the filter reaches the scan."""
    since = F.date_sub(F.to_date(F.lit(as_of)), days).cast(df.schema[updated_at].dataType)
    recent = df.filter(F.col(updated_at) >= since)
    return recent.groupBy(F.col(tenant).alias("tenant")).agg(F.count(F.lit(1)).alias("recent_updates_30d"))


def completeness(df: DataFrame, tenant: str, columns: Sequence[str]) -> DataFrame:
    """Percentage of non-null cells per tenant."""
    filled = sum((F.col(c).isNotNull().cast("int") for c in columns), F.lit(0))
    share = F.sum(filled) * 100.0 / (F.count(F.lit(1)) * len(columns))
    return df.groupBy(F.col(tenant).alias("tenant")).agg(share.alias("data_completeness_pct"))


def eligible(metrics: DataFrame, criteria: Mapping[str, float] | None = None) -> DataFrame:
    """Tenants inside all bounds, which are inclusive; no schools count as 0, no completeness as 100."""
    c = {**DEFAULT_CRITERIA, **(criteria or {})}
    return metrics.filter(
        (F.col("students") >= c["min_students"])
        & (F.coalesce("schools", F.lit(0)) >= c["min_schools"])
        & F.col("total_records").between(c["min_total_records"], c["max_total_records"])
        & (F.coalesce("data_completeness_pct", F.lit(DEFAULT_COMPLETENESS)) >= c["min_completeness_pct"])
    )


def priority_score(
    total_records: Column,
    recent_updates: Column,
    completeness_pct: Column,
    business_priority: Column,
    size_cap: float = SIZE_CAP,
    activity_cap: float = ACTIVITY_CAP,
) -> Column:
    """Weighted score between 0 and 100, two decimals."""
    hundred = F.lit(100.0)
    size = F.least(hundred, total_records / F.lit(float(size_cap)) * 100)
    activity = F.least(hundred, F.coalesce(recent_updates, F.lit(0)) / F.lit(float(activity_cap)) * 100)
    complete = F.coalesce(completeness_pct, F.lit(float(DEFAULT_COMPLETENESS)))
    business = F.coalesce(business_priority, F.lit(float(DEFAULT_BUSINESS_PRIORITY)))
    score = (
        size * WEIGHTS["size"] + activity * WEIGHTS["activity"] + complete * WEIGHTS["completeness"] + business * WEIGHTS["business"]
    )
    return round_exact(score, 2)


def migration_hours(total_records: Column) -> Column:
    """Planned hours for all phases with overhead, one decimal."""
    minutes = None
    for rate in RECORDS_PER_MINUTE.values():
        part = total_records / F.lit(float(rate))
        minutes = part if minutes is None else minutes + part
    return round_exact(minutes * OVERHEAD / 60, 1)


def size_category(total_records: Column, large_from: float = LARGE_FROM, medium_from: float = MEDIUM_FROM) -> Column:
    return F.when(total_records >= large_from, "large").when(total_records >= medium_from, "medium").otherwise("small")


def score_tenants(
    metrics: DataFrame,
    *,
    size_cap: float = SIZE_CAP,
    activity_cap: float = ACTIVITY_CAP,
    large_from: float = LARGE_FROM,
    medium_from: float = MEDIUM_FROM,
) -> DataFrame:
    """Add score, planned hours and size category."""
    column = lambda name: F.col(name) if name in metrics.columns else F.lit(None).cast("double")
    return metrics.select(
        "*",
        priority_score(
            F.col("total_records"),
            column("recent_updates_30d"),
            column("data_completeness_pct"),
            column("business_priority"),
            size_cap,
            activity_cap,
        ).alias("priority_score"),
        migration_hours(F.col("total_records")).alias("estimated_migration_hours"),
        size_category(F.col("total_records"), large_from, medium_from).alias("size_category"),
    )


def rank_all(scored: DataFrame, key: str = "tenant") -> DataFrame:
    """Rank of every tenant by score, ties by key, without a global window."""
    return number_rows(scored, [F.desc("priority_score"), F.asc(key)], name="priority")


def recommend(scored: DataFrame, top: int = DEFAULT_TOP, key: str = "tenant") -> DataFrame:
    """The first ``top`` tenants with rank and pilot flag.

    The pilots are the best large, medium and small tenant among them.  Both
    windows see no more than ``top`` rows.
    """
    best = scored.orderBy(F.desc("priority_score"), F.asc(key)).limit(top)
    order = [F.desc("priority_score"), F.asc(key)]
    return best.select(
        "*",
        F.row_number().over(Window.orderBy(*order)).alias("priority"),
        (F.row_number().over(Window.partitionBy("size_category").orderBy(*order)) == 1).alias("recommended_for_pilot"),
    )


def summarize(recommended: DataFrame) -> DataFrame:
    """Totals over the recommended tenants and their number by size."""
    total = lambda name: F.coalesce(F.sum(name), F.lit(0)).alias(f"total_{name}")
    return recommended.agg(
        F.count(F.lit(1)).alias("recommended_tenants"),
        total("students"),
        total("staff"),
        total("schools"),
        F.coalesce(F.sum("total_records"), F.lit(0)).alias("total_records"),
        F.round(F.coalesce(F.sum("estimated_migration_hours"), F.lit(0.0)), 1).alias("estimated_total_migration_hours"),
        F.count_if(F.col("size_category") == "large").alias("large_tenants"),
        F.count_if(F.col("size_category") == "medium").alias("medium_tenants"),
        F.count_if(F.col("size_category") == "small").alias("small_tenants"),
    )
