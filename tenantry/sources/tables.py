"""Reading and writing tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenantry.model import Tables


def load_tables(spark: SparkSession, folder: str, names: Iterable[str] | None = None) -> Tables:
    """Every Parquet table of a folder by name; nothing is read until it is used.

    Without ``names`` the folder is listed through the file system it lives on.
    """
    folder = folder.rstrip("/")
    if names is not None:
        return {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in names}
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/*.parquet")
    files = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    paths = sorted(status.getPath().toString() for status in files)
    return {path.rsplit("/", 1)[1].removesuffix(".parquet"): spark.read.parquet(path) for path in paths}


def matching(df: DataFrame, where: Mapping[str, object]) -> DataFrame:
    """Rows where every column equals its value; a null value matches nothing."""
    if not where:
        return df
    return df.filter(reduce(lambda a, b: a & b, [F.col(c) == F.lit(v) for c, v in where.items()]))


def jdbc_scan(
    spark: SparkSession,
    url: str,
    table: str,
    where: Mapping[str, object] | None = None,
    *,
    split_on: str | None = None,
    bounds: tuple[object, object] | None = None,
    parts: int = 1,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Scan of a relational table; the equality filter runs in the database.

    With ``split_on`` the table is read in ``parts`` ranges at once, so that no
    single task pulls all of it.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **(properties or {}))
    if split_on is not None:
        if bounds is None:
            raise ValueError("split_on needs bounds")
        reader = reader.options(
            partitionColumn=split_on,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(parts),
        )
    return matching(reader.load(), where or {})


def table_names(spark: SparkSession, database: str | None = None) -> list[str]:
    """Tables of a database, sorted by name."""
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)


def has_column(df: DataFrame, column: str) -> bool:
    return column in df.columns


def bounded_query(spark: SparkSession, query: str, args: Mapping[str, object] | None = None, limit: int = 1000) -> DataFrame:
    """At most ``limit`` rows of a query; give it an ORDER BY to make them definite."""
    return spark.sql(query, args=dict(args or {})).limit(limit)


def write_table(df: DataFrame, path: str, partition_by: str | None = None, mode: str = "error") -> None:
    """Snappy Parquet, optionally one folder per tenant.

    Rows are brought together by tenant before a partitioned write; the
    rebalance hint lets Spark cut a tenant that is too big for one file.
    """
    if partition_by is None:
        df.write.mode(mode).option("compression", "snappy").parquet(path)
        return
    grouped = df.hint("rebalance", F.col(partition_by))
    grouped.write.mode(mode).option("compression", "snappy").partitionBy(partition_by).parquet(path)


def write_tables(tables: Tables, folder: str, partition_by: str | None = None) -> None:
    for name, df in tables.items():
        column = partition_by if partition_by in df.columns else None
        write_table(df, f"{folder.rstrip('/')}/{name}.parquet", column)


def write_manifest(metrics: DataFrame, path: str) -> None:
    """Append a small metrics frame as JSON lines."""
    metrics.coalesce(1).write.mode("append").json(path)


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None) -> None:
    """Append to a relational table in batches, one connection for each partition."""
    df.write.jdbc(url, table, mode="append", properties=dict(properties or {}))
