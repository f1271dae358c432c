"""The registered queries, and the SQL each of them has to agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tenantry.plans.queries import anonymizing, extraction, graphs, loading, reporting, tenancy, validation

MODULES = (extraction, graphs, tenancy, anonymizing, validation, loading, reporting)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.SQL.items()}
