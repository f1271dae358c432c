"""Nulls, collations, repeated keys and keys of different types, on which joins and sums could disagree."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tenantry.model import ForeignKey
from tenantry.operators import dependencies, reconcile, report, validate
from tenantry.operators.ranking import number_rows
from tenantry.skew import keep_matching, limits, look_up, measured_bytes

SALTED = limits(small_bytes=0, broadcast_bytes=0, hot_rows=10, sample_share=1.0, salts=4)


@pytest.mark.parametrize("bounds", [limits(), SALTED])
def test_collated_texts_and_signed_zeros(spark, bounds):
    words = spark.range(100).select(F.lit("A").alias("k"), "id").withColumn("k", F.col("k").cast("string collate UTF8_LCASE"))
    key = spark.range(1).select(F.lit("a").cast("string collate UTF8_LCASE").alias("k"))
    assert keep_matching(words, key, [("k", "k")], bounds=bounds).count() == 100
    zeros = spark.range(100).select(F.lit(0.0).alias("k"), "id")
    minus = spark.range(1).select(F.lit(-0.0).alias("k"), F.lit("x").alias("v"))
    assert look_up(zeros, minus, [("k", "k")], bounds=bounds).filter("v = 'x'").count() == 100


def test_maps_and_rows_are_salted_alike(spark):
    rows_ = spark.range(200).select(F.lit(1).alias("k"), F.create_map(F.lit("a"), F.col("id")).alias("m"))
    assert keep_matching(rows_, spark.range(3).select(F.col("id").alias("k")), [("k", "k")], bounds=SALTED).count() == 200


def test_nested_columns_are_measured(spark):
    wide = spark.range(10).select(F.array_repeat(F.lit("0123456789"), 10_000).alias("a"))
    assert measured_bytes(wide) > 10 * 100_000


def test_text_keys_next_to_number_keys(spark, rows):
    child = spark.createDataFrame([("1",), ("7",), ("x",), ("x",), (None,)], "p_id string")
    parent = spark.createDataFrame([(1,), (2,)], "id bigint")
    key = ForeignKey.of("c", "p_id", "ps")
    assert rows(validate.orphans(child, parent, key), "p_id", "rows") == [("7", 1), ("x", 2)]
    assert rows(validate.orphans(parent.toDF("p_id"), child.toDF("id"), key), "p_id", "rows") == [(2, 1)]
    found = dependencies.infer_foreign_keys({"c": child, "ps": parent}).collect()
    assert [(r.distinct_values, r.orphans, r.status) for r in found] == [(3, 2, "VIOLATED")]
    assert rows(keep_matching(child, parent, [("p_id", "id")])) == [("1",)]
    assert rows(keep_matching(child, parent, [("p_id", "id")], absent=True)) == [(None,), ("7",), ("x",), ("x",)]


def test_checksums_see_nulls_and_maps(spark):
    a = spark.createDataFrame([("x", None), (None, "y")], "a string, b string")
    b = spark.createDataFrame([(None, "x"), ("y", None)], "a string, b string")
    assert reconcile.checksum(a).first() != reconcile.checksum(b).first()
    one, two, three = (spark.sql(f"SELECT map({m}) AS m") for m in ("'a', 1, 'b', 2", "'b', 2, 'a', 1", "'a', 2, 'b', 1"))
    assert reconcile.checksum(one).first() == reconcile.checksum(two).first() != reconcile.checksum(three).first()


def test_conflicts_between_least_and_greatest(spark, rows):
    first = spark.createDataFrame([(1, 1, "a"), (1, 2, "a"), (1, 9, None), (2, 5, "b"), (2, 5, "b"), (3, 1, "z")], "k int, v int, t string")
    second = spark.createDataFrame([(1, 1, None), (1, 5, "a"), (1, 9, "a"), (2, 5, "b"), (4, 1, "z")], "k int, v bigint, t string")
    assert rows(validate.conflicts(first, second, ["k"], ["v", "t"])) == [("t", 2, 0), ("v", 2, 1)]


def test_null_groups_keep_their_rows(spark, rows):
    df = spark.createDataFrame([("a", 1), (None, 2), (None, 1)], "g string, v int")
    assert rows(number_rows(df, ["v"], per=["g"])) == [(None, 1, 1), (None, 2, 2), ("a", 1, 1)]
    assert report.first_warnings(df, "g", ["v"]).count() == 3


def test_long_cycles_and_lost_nodes(spark):
    ring = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("d", "a")], "parent string, child string")
    nodes = ring.select(F.col("parent").alias("name"))
    cycles = dependencies.simple_cycles(nodes, ring)
    assert [r.members for r in cycles.collect()] == [["a", "b", "c", "d", "a"]]
    assert dependencies.levels_with_breaks(nodes, ring, dependencies.break_points(cycles, ring)).count() == 4
    short = dependencies.simple_cycles(nodes, ring, max_length=3)
    with pytest.raises(ValueError, match="4 nodes"):
        dependencies.levels_with_breaks(nodes, ring, dependencies.break_points(short, ring))


def test_duplicate_keys_of_texts(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 1), (None, 1), ("b", 2)], "k string, n int")
    assert validate.duplicate_key_finding(df, "t", ["k", "n"]).first().failed == 2
