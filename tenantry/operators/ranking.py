"""Dense positions over a whole table without sending it through one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenantry.state import materialize


def number_rows(
    df: DataFrame,
    order: Sequence[Column | str],
    per: Sequence[str] = (),
    name: str = "position",
    start: int = 1,
    weight: str | None = None,
) -> DataFrame:
    """Add the position of each row in ``order`` (within ``per``), counted from ``start``.

    ``order`` has to be unique within ``per``; null is a group like any other.  The rows are range-partitioned by
    (per, order) and written once; each range then counts its own rows, and a
    running sum over the ranges gives every range its offset.  With ``weight`` a row
    stands for that many, and gets the position of the last of them.
    """
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    ranges = df.repartitionByRange(*[F.col(c) for c in per], *keys).withColumn("__range", F.spark_partition_id())
    ranges = materialize(ranges, "ranges")
    before = Window.partitionBy(*per).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranges.groupBy("__range", *per)
        .agg((F.count(F.lit(1)) if weight is None else F.sum(weight)).alias("__rows"))
        .withColumn("__offset", F.coalesce(F.sum("__rows").over(before), F.lit(0)))
        .select(F.col("__range").alias("__of"), *[F.col(c).alias(f"__of_{c}") for c in per], "__offset")
    )
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__of_{c}")) for c in per], F.col("__range") == F.col("__of"))
    inside = Window.partitionBy("__range", *per).orderBy(*keys)
    so_far = F.row_number().over(inside) if weight is None else F.sum(weight).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    return (
        ranges.withColumn("__inside", so_far)
        .join(offsets, same)
        .withColumn(name, (F.col("__inside") + F.col("__offset") + (start - 1)).cast("bigint"))
        .drop("__range", "__inside", "__offset", "__of", *[f"__of_{c}" for c in per])
    )
