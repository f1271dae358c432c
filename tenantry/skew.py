"""Row-level joins against a key table that hold up when one key owns much of the data.

Counting operators in this library aggregate by key before they join, so a hot
key costs them nothing.  Operators that must return the rows themselves use the
two joins below.  Where the rows are many, the keys are written once and
measured:

* keys that fit a broadcast are sent to the rows, which then need no shuffle;
* more keys than that are joined by shuffle, and the rows of hot keys are spread
  over ``SALTS`` tasks, with the matching key rows repeated as often.

Which keys are salted never changes the result, so the search for hot keys may
look at a sample; every row takes part in the join either way.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenantry.state import materialize


@dataclass(frozen=True)
class Limits:
    """From which sizes on the joins take which path."""

    small_bytes: int = 512 * 1024 * 1024  # rows below this size are joined plainly
    broadcast_bytes: int = 128 * 1024 * 1024  # measured size up to which keys are broadcast
    hot_rows: int = 1_000_000  # a key with fewer rows is left to one task
    max_hot_keys: int = 1_000
    salts: int = 128
    sample_share: float = 0.01


LIMITS = Limits()
_ROW_OVERHEAD = 32
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def limits(**changes) -> Limits:
    """The limits in force with some changed."""
    return replace(LIMITS, **changes)


def set_limits(bounds: Limits) -> Limits:
    """Put other limits in force for all operators; returns those before."""
    global LIMITS
    before, LIMITS = LIMITS, bounds
    return before


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate, or None where the session does not expose it."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except AttributeError:
        return None


def is_small(df: DataFrame, bounds: Limits | None = None) -> bool:
    size = estimated_bytes(df)
    return size is not None and size <= (bounds or LIMITS).small_bytes


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows of a written table, from their number and the length of their texts; nested values count as text."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    texts = [F.col(f.name).cast("string") if isinstance(f.dataType, nested) else F.col(f.name) for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType, *nested))]
    fixed = _ROW_OVERHEAD + 8 * len(df.columns)
    length = reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(c), F.lit(0)) for c in texts], F.lit(0))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(length.cast("bigint")), F.lit(0)).alias("b")).first()
    return row.n * fixed + row.b


def _key_hash(columns: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(c).cast("string") for c in columns])


def hot_keys(df: DataFrame, columns: Sequence[str], bounds: Limits | None = None) -> list[int]:
    """Hashes of the keys that hold about ``hot_rows`` rows or more; a bounded number of them."""
    bounds = bounds or LIMITS
    counts = (
        df.select(_key_hash(columns).alias("h")).sample(fraction=bounds.sample_share, seed=17).groupBy("h").count()
    )
    hot = (
        counts.filter(F.col("count") >= bounds.hot_rows * bounds.sample_share)
        .orderBy(F.desc("count"))
        .limit(bounds.max_hot_keys)
    )
    return [row.h for row in hot.collect()]


@dataclass(frozen=True)
class Probe:
    """What a loop needs to know about the rows that it joins again and again."""

    small: bool
    hot: tuple[int, ...] = ()

    @classmethod
    def of(cls, df: DataFrame, columns: Sequence[str], bounds: Limits | None = None) -> Probe:
        small = is_small(df, bounds)
        return cls(small, () if small else tuple(hot_keys(df, columns, bounds)))


def is_hot(columns: Sequence[str], probe: Probe) -> Column:
    """Whether a row has one of the busiest keys, of which there are ``max_hot_keys`` at most."""
    return _key_hash(columns).isin(list(probe.hot))


def distinct_keys(df: DataFrame, columns: Sequence[str], bounds: Limits | None = None) -> DataFrame:
    """The key columns of a table, to test for; many rows are thinned out before they are shuffled.

    A join on the same columns then needs no further shuffle of them.
    """
    keys = df.select(*columns)
    return keys if is_small(keys, bounds) else keys.distinct()


def _texts_decide(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]]) -> bool:
    """Whether keys are equal exactly where their texts are, so that hot keys may be told by a hash of the text."""

    def plain(kind: T.DataType) -> bool:
        return isinstance(kind, (*_INTEGRAL, T.DateType, T.BooleanType)) or kind == T.StringType()

    for a, b in on:
        x, y = left.schema[a].dataType, right.schema[b].dataType
        if not plain(x) or not (x == y or (isinstance(x, _INTEGRAL) and isinstance(y, _INTEGRAL))):
            return False
    return True


def grouped_as_joined(kind: T.DataType) -> bool:
    """Whether two columns of this type can be brought together by a grouping as by ``=``."""
    return isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)) or kind == T.StringType()


def comparable(left: T.DataType, a: Column, right: T.DataType, b: Column) -> tuple[Column, Column]:
    """Two key columns made ready for ``=``: a text next to a number is read as one, and is null where it is none."""
    if isinstance(left, T.StringType) and isinstance(right, T.NumericType):
        return a.try_cast(right), b
    if isinstance(left, T.NumericType) and isinstance(right, T.StringType):
        return a, b.try_cast(left)
    return a, b


#: Estimated bytes of rows, or measured bytes of their keys, that make another part where keys are held in memory.
PART_BYTES = 4 * 1024 * 1024


def _hash_join(rows: DataFrame, keys: DataFrame, names: Sequence[str], match: Column, size: int) -> DataFrame:
    """Rows with one of ``keys``, of which none comes twice; neither side is sorted, a task holds the keys of its part.

    Both sides are dealt into as many parts as their sizes ask for.  A semi-join
    would be moved below that, to each table of a union, where parts are put
    together again by the bytes shuffled, until a few tasks hold all keys.  An
    inner join stays, and finds the same rows as each key comes once.
    """
    most = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(most, min(16 * most, max(estimated_bytes(rows) or 0, size) // PART_BYTES))
    return rows.repartition(parts, *names).join(keys.hint("shuffle_hash"), match)


def _join(rows: DataFrame, keys: DataFrame, on: Sequence[tuple[str, str]], how: str, probe: Probe | None, bounds: Limits | None, hashed: bool = False) -> DataFrame:
    bounds = bounds or LIMITS
    names = [c for c, _ in on]
    right = [f"__key_{i}" for i in range(len(on))]
    renamed = keys.withColumnsRenamed({k: right[i] for i, (_, k) in enumerate(on)})
    kinds = [(rows.schema[c].dataType, keys.schema[k].dataType) for c, k in on]
    pairs = [comparable(x, F.col(c), y, F.col(k)) for (x, y), c, k in zip(kinds, names, right, strict=True)]
    match = reduce(lambda a, b: a & b, [a == b for a, b in pairs])
    if probe.small if probe is not None else is_small(rows, bounds):
        one_each = renamed if how == "left_outer" else distinct_keys(renamed, right, bounds)
        return rows.join(one_each, match, how).drop(*right)
    measured = materialize(renamed if how == "left_outer" else renamed.distinct(), "keys")
    size = measured_bytes(measured)
    if size <= bounds.broadcast_bytes:
        return rows.join(F.broadcast(measured), match, how).drop(*right)
    hot: Sequence[int] = ()
    if _texts_decide(rows, keys, on):
        hot = probe.hot if probe is not None else hot_keys(rows, names, bounds)
    if not hot:
        if hashed and how == "left_semi" and all(x.simpleString() == y.simpleString() for x, y in kinds):
            return _hash_join(rows, measured, names, match, size).drop(*right)
        return rows.join(measured, match, how).drop(*right)
    # a hash of the row is the same if a task is run again
    told = [f.name for f in rows.schema if "map<" not in f.dataType.simpleString()]
    salt = F.pmod(F.xxhash64(*told), F.lit(bounds.salts))
    spread = F.when(_key_hash(names).isin(list(hot)), salt).otherwise(F.lit(0))
    repeats = F.when(_key_hash(right).isin(list(hot)), F.sequence(F.lit(0), F.lit(bounds.salts - 1))).otherwise(
        F.array(F.lit(0))
    )
    salted_rows = rows.withColumn("__salt", spread.cast("int"))
    salted_keys = measured.withColumn("__key_salt", F.explode(repeats))
    joined = salted_rows.join(salted_keys, match & (F.col("__salt") == F.col("__key_salt")), how)
    return joined.drop("__salt", "__key_salt", *right)


def keep_matching(
    rows: DataFrame,
    keys: DataFrame,
    on: Sequence[tuple[str, str]],
    *,
    absent: bool = False,
    probe: Probe | None = None,
    bounds: Limits | None = None,
    hashed: bool = False,
) -> DataFrame:
    """Rows whose key occurs in ``keys`` (or, with ``absent``, does not).

    ``on`` pairs a column of ``rows`` with a column of ``keys``.  A null key
    occurs nowhere.  ``probe`` is what is known of ``rows`` already.  ``hashed``
    spares sorting the rows where they are much wider than the keys.
    """
    key_columns = keys.select(*dict.fromkeys(k for _, k in on))
    return _join(rows, key_columns, on, "left_anti" if absent else "left_semi", probe, bounds, hashed)


def look_up(
    rows: DataFrame,
    table: DataFrame,
    on: Sequence[tuple[str, str]],
    *,
    probe: Probe | None = None,
    bounds: Limits | None = None,
) -> DataFrame:
    """All rows with the other columns of ``table``, null where there is no match.

    ``table`` must hold at most one row per key.
    """
    return _join(rows, table, on, "left_outer", probe, bounds)
