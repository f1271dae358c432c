"""The joins must give the same rows on every path, and spread hot keys."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tenantry import skew
from tenantry.skew import Probe, keep_matching, limits, look_up

PLAIN = limits()
BROADCAST = limits(small_bytes=0)
SHUFFLE = limits(small_bytes=0, broadcast_bytes=0, hot_rows=10**12)
SALTED = limits(small_bytes=0, broadcast_bytes=0, hot_rows=100, sample_share=1.0, salts=8)


@pytest.fixture(scope="module")
def fact(spark):
    """A third of the rows has one key; some have none."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 10 == 1, F.lit(None)).otherwise(F.col("id") % 500)
    return spark.range(9_000).select("id", key.cast("int").alias("k"), (F.col("id") % 2).cast("string").alias("s"))


@pytest.fixture(scope="module")
def keys(spark):
    return spark.range(0, 400).select(F.col("id").alias("pk"), F.concat(F.lit("v"), F.col("id").cast("string")).alias("v"))


@pytest.mark.parametrize("bounds", [BROADCAST, SHUFFLE, SALTED])
@pytest.mark.parametrize("absent", [False, True])
def test_semi_and_anti_on_every_path(fact, keys, rows, bounds, absent):
    doubled = keys.union(keys)
    expected = rows(keep_matching(fact, doubled, [("k", "pk")], absent=absent, bounds=PLAIN))
    got = keep_matching(fact, doubled, [("k", "pk")], absent=absent, bounds=bounds)
    assert rows(got) == expected and got.columns == fact.columns
    assert len(expected) == fact.filter("k IS NULL OR k >= 400" if absent else "k < 400").count()


@pytest.mark.parametrize("bounds", [BROADCAST, SHUFFLE, SALTED])
def test_look_up_on_every_path(fact, keys, rows, bounds):
    expected = rows(look_up(fact, keys, [("k", "pk")], bounds=PLAIN))
    got = rows(look_up(fact, keys, [("k", "pk")], bounds=bounds))
    assert got == expected and len(got) == fact.count()


def test_composite_keys(fact, rows):
    pairs = fact.filter("id < 50").select(F.col("k").alias("a"), F.col("s").alias("b"))
    on = [("k", "a"), ("s", "b")]
    assert rows(keep_matching(fact, pairs, on, bounds=SALTED)) == rows(keep_matching(fact, pairs, on, bounds=PLAIN))


def test_hot_key_is_found_and_spread(fact, keys):
    hot = skew.hot_keys(fact.dropna(), ["k"], SALTED)
    assert len(hot) == 1
    joined = keep_matching(fact, keys, [("k", "pk")], bounds=SALTED)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "__salt" in plan and "__key_salt" in plan
    salts = fact.withColumn("s", F.when(F.col("k") == 7, F.monotonically_increasing_id() % 8)).filter("k = 7").groupBy("s").count()
    assert salts.count() == 8


def test_key_types_that_print_differently_are_not_salted(spark, fact, rows):
    floats = spark.createDataFrame([(7.0,), (11.0,)], "pk DOUBLE")
    expected = rows(keep_matching(fact, floats, [("k", "pk")], bounds=PLAIN))
    assert rows(keep_matching(fact, floats, [("k", "pk")], bounds=SALTED)) == expected


def test_measured_size_counts_texts(spark):
    df = spark.createDataFrame([("x" * 1000,), (None,)], "t STRING")
    assert skew.measured_bytes(df) >= 1000


def test_probe_is_used(fact, keys, rows):
    probe = Probe.of(fact, ["k"], SALTED)
    assert not probe.small and probe.hot
    got = keep_matching(fact, keys, [("k", "pk")], probe=probe, bounds=SALTED)
    assert rows(got) == rows(keep_matching(fact, keys, [("k", "pk")], bounds=PLAIN))
