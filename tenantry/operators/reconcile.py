"""Comparing a source with a target after a load."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenantry.model import ForeignKey, Tables
from tenantry.operators.ranking import number_rows
from tenantry.skew import keep_matching
from tenantry.state import materialize


def compare_counts(source: Tables, target: Tables) -> DataFrame:
    """Rows per table on both sides; a table that one side lacks counts as 0."""
    parts = []
    for side, tables in (("source", source), ("target", target)):
        for name, df in tables.items():
            parts.append(
                df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), F.lit(side).alias("side"), "n")
            )
    both = reduce(DataFrame.unionByName, parts).groupBy("table_name")
    rows = lambda side: F.coalesce(F.sum(F.when(F.col("side") == side, F.col("n"))), F.lit(0))
    counted = both.agg(rows("source").alias("source_rows"), rows("target").alias("target_rows"))
    return counted.withColumn("equal", F.col("source_rows") == F.col("target_rows"))


# A hash is summed in three parts of at most 22 bits.  A sum of BIGINTs is much
# faster than one of decimals, and holds the parts of 2**41 rows.
_PARTS = ((0, 22), (22, 21), (43, 21))


def _split(value: str) -> list[str]:
    return [f"shiftrightunsigned({value}, {start}) & {2**bits - 1}L" for start, bits in _PARTS]


def _row_hash(df: DataFrame, columns: Sequence[str], salt: str = "") -> str:
    """A hash of a row.  It passes over nulls, so it also takes where they are; maps are hashed as ordered entries."""
    maps = {f.name for f in df.schema if isinstance(f.dataType, T.MapType)}
    values = [f"array_sort(map_entries(`{c}`))" if c in maps else f"`{c}`" for c in columns]
    return f"xxhash64({salt}{', '.join([*values, *(f'isnull(`{c}`)' for c in columns)])})"


def _hash_sums(df: DataFrame, columns: Sequence[str], name: str) -> list[Column]:
    """Sums of row hashes."""
    return [F.expr(f"sum({part}) AS `{name}_{start}`") for (start, _), part in zip(_PARTS, _split(_row_hash(df, columns)), strict=True)]


def checksum(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows and the sum of their unsigned 64-bit hashes, which does not depend on the order of rows."""
    sums = df.agg(F.count(F.lit(1)).alias("rows"), *_hash_sums(df, columns or df.columns, "h"))
    part = lambda start: F.coalesce(f"h_{start}", F.lit(0)).cast("decimal(19,0)")
    whole = part(0) + part(22) * F.lit(2**22) + part(43) * F.lit(2**43)
    return sums.select("rows", whole.cast("decimal(38,0)").alias("checksum"))


def compare_checksums(source: Tables, target: Tables) -> DataFrame:
    """Whether each common table has the same rows on both sides."""
    parts = []
    for name in source:
        if name not in target:
            continue
        columns = sorted(source[name].columns)
        sides = [checksum(t[name], columns).withColumn("side", F.lit(i)) for i, t in enumerate((source, target))]
        both = sides[0].unionByName(sides[1]).agg(
            F.max(F.when(F.col("side") == 0, F.col("rows"))).alias("source_rows"),
            F.max(F.when(F.col("side") == 1, F.col("rows"))).alias("target_rows"),
            F.count_distinct("rows", "checksum").alias("n"),
        )
        parts.append(both.select(F.lit(name).alias("table_name"), "source_rows", "target_rows", (F.col("n") == 1).alias("equal")))
    return reduce(DataFrame.unionByName, parts)


def fan_out(child: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How many keys have 1, 2, 3, ... children."""
    per_key = child.dropna(subset=list(columns)).groupBy(*columns).agg(F.count(F.lit(1)).alias("children"))
    return per_key.groupBy("children").agg(F.count(F.lit(1)).alias("parents"))


def compare_fan_out(source: Tables, target: Tables, keys: Sequence[ForeignKey]) -> DataFrame:
    """Fan-out of every foreign key on both sides, one row per number of children."""
    parts = []
    for key in keys:
        before = fan_out(source[key.child], key.columns).withColumnRenamed("parents", "source_parents")
        after = fan_out(target[key.child], key.columns).withColumnRenamed("parents", "target_parents")
        both = before.join(after, "children", "full_outer")
        parts.append(
            both.select(
                F.lit(key.child).alias("table_name"),
                F.lit(",".join(key.columns)).alias("column_name"),
                "children",
                F.coalesce("source_parents", F.lit(0)).alias("source_parents"),
                F.coalesce("target_parents", F.lit(0)).alias("target_parents"),
            )
        )
    union = reduce(DataFrame.unionByName, parts)
    return union.withColumn("equal", F.col("source_parents") == F.col("target_parents"))


def share_distance(source: DataFrame, target: DataFrame, bucket: Column) -> DataFrame:
    """Total variation distance between the shares of each bucket: 0 is equal, 1 is disjoint."""

    def shares(df: DataFrame, side: str) -> DataFrame:
        return df.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n")).withColumn("side", F.lit(side))

    both = shares(source, "source").unionByName(shares(target, "target"))
    per_bucket = both.groupBy("bucket").agg(
        F.coalesce(F.sum(F.when(F.col("side") == "source", F.col("n"))), F.lit(0)).alias("a"),
        F.coalesce(F.sum(F.when(F.col("side") == "target", F.col("n"))), F.lit(0)).alias("b"),
    )
    all_of = lambda side: both.agg(F.sum(F.when(F.col("side") == side, F.col("n")))).scalar()
    gap = F.abs(F.col("a") / all_of("source") - F.col("b") / all_of("target"))
    gaps = per_bucket.select(gap.alias("gap"))
    return gaps.agg(F.count(F.lit(1)).alias("buckets"), (F.sum("gap") / 2).alias("distance"))


def exact_quantiles(df: DataFrame, column: str, grid: Sequence[float], accuracy: int = 10_000) -> list:
    """The value at rank ceil(q * n), 1 at least, for each q; nulls left out, None if there is no value.

    A summary of bounded size says near which values to look.  Only values there are told apart, all between two
    such places are counted as one, and running counts over range partitions give the ranks.  Should the summary
    have pointed elsewhere, which the counts show, all values are told apart.
    """
    values = df.select(F.col(column).alias("v")).dropna()
    slack = 3 / accuracy
    near = [p for q in grid for p in (max(0.0, q - slack), min(1.0, q + slack))]
    n, bounds = values.agg(F.count(F.lit(1)), F.percentile_approx("v", F.array(*map(F.lit, near)), accuracy)).first()
    if not n:
        return [None] * len(grid)
    kind = df.schema[column].dataType
    ranks = [max(1, math.ceil(q * n)) for q in grid]
    edges = F.array(*[F.lit(x).cast(kind) for x in bounds])
    inside = reduce(lambda x, y: x | y, [F.col("v").between(F.get(edges, 2 * i), F.get(edges, 2 * i + 1)) for i in range(len(grid))])
    told = (F.when(inside, F.col("v")).otherwise(F.array_max(F.filter(edges, lambda e: e <= F.col("v")))), ~inside)
    for value, between in (told, (F.col("v"), F.lit(False))):
        counts = values.groupBy(value.alias("value"), between.alias("between")).agg(F.count(F.lit(1)).alias("n"))
        placed = number_rows(counts, ["value", "between"], name="upto", weight="n")
        first = [F.min(F.when(F.col("upto") >= rank, F.struct("upto", "value", "between"))).alias(f"q{i}") for i, rank in enumerate(ranks)]
        found = placed.agg(*first).first()
        if not any(x.between for x in found):
            break
    return [x.value for x in found]


def quantile_gaps(source: DataFrame, target: DataFrame, column: str, grid: Sequence[float] = (0.1, 0.25, 0.5, 0.75, 0.9)) -> DataFrame:
    """Exact quantiles of a column on both sides."""
    rows = list(zip(map(float, grid), exact_quantiles(source, column, grid), exact_quantiles(target, column, grid), strict=True))
    kinds = [T.StructField("quantile", T.DoubleType()), T.StructField("source_value", source.schema[column].dataType), T.StructField("target_value", target.schema[column].dataType)]
    return source.sparkSession.createDataFrame(rows, T.StructType(kinds))


def row_differences(source: DataFrame, target: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys whose rows were lost, added or changed, and the columns that differ.

    Rows are brought together by key on both sides first, as sums of hashes, so
    that a repeated key is compared as a whole and multiplies nothing.  One sum
    over all columns tells which keys differ; only the rows of those are summed
    by column.
    """
    columns = [c for c in source.columns if c not in key]
    starts = [start for start, _ in _PARTS]

    def signed(values: Callable[[DataFrame], dict[str, str]]) -> DataFrame:
        """Rows of both sides by key; sums of values times side are 0 where both sides agree."""
        sides = []
        for df, sign in ((source, 1), (target, -1)):
            keys = [F.col(c).alias(f"key_{c}") for c in key]
            sides.append(df.select(*keys, F.lit(sign).alias("side"), *[F.expr(f"{value} AS `value_{name}`") for name, value in values(df).items()]))
        same = F.struct(*[F.col(f"key_{c}").alias(c) for c in key]).alias("key")  # null keys are equal inside
        return sides[0].unionByName(sides[1]).select(same, "side", *[f"`{name}`" for name in sides[0].columns[len(key) + 1 :]])

    def of_row(df: DataFrame) -> dict[str, str]:
        hashes = [_split(_row_hash(df, [c], f"{i}, ")) for i, c in enumerate(columns)]
        return {f"sum_{start}": " + ".join(["0L", *(f"({parts[i]})" for parts in hashes)]) for i, start in enumerate(starts)}

    def of_columns(df: DataFrame) -> dict[str, str]:
        return {c: _row_hash(df, [c]) for c in columns}

    differs = reduce(lambda x, y: x | y, [F.expr(f"sum(side * value_sum_{start})") != 0 for start in starts])
    here, there = F.count_if(F.col("side") > 0), F.count_if(F.col("side") < 0)
    change = F.when(there == 0, "lost").when(here == 0, "added").when((here != there) | differs, "changed")
    by_key = signed(of_row).groupBy("key").agg(change.alias("change"))
    found = materialize(by_key.filter("change IS NOT NULL"), "differences")
    none = F.array().cast("array<string>")
    if not columns:
        return found.select("key.*", "change", none.alias("columns"))
    rows = keep_matching(signed(of_columns), found.filter("change = 'changed'"), [("key", "key")], hashed=True)
    unlike = [F.when(reduce(lambda x, y: x | y, [F.expr(f"sum(side * ({part}))") != 0 for part in _split(f"`value_{c}`")]), F.lit(c)) for c in columns]
    detail = rows.groupBy("key").agg(F.array_compact(F.array(*unlike)).alias("columns"))
    return found.join(detail, "key", "left").select("key.*", "change", F.coalesce("columns", none).alias("columns"))
