"""What is shuffled, sorted and kept where tables are large, seen in the plans."""

from __future__ import annotations

import random
from functools import reduce

import pytest
from pyspark.sql import functions as F

from tenantry import skew
from tenantry.model import ForeignKey
from tenantry.operators import reconcile, traversal, validate
from tenantry.sources.graph import EDGE_SCHEMA


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def large(spark):
    """All tables taken as large, nothing broadcast."""
    before = skew.set_limits(skew.limits(small_bytes=0, broadcast_bytes=0, hot_rows=10**12))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    skew.set_limits(before)


RING = [(i, "a", (i + 1) % 6, {"p": str(i)}) for i in range(6)] + [(7, "b", 1, {}), (None, "b", 1, {}), (0, "b", None, {}), (0, "a", 1, {"p": "0"})]


def test_a_round_shuffles_the_frontier_but_not_the_steps(spark, large):
    steps = spark.createDataFrame([(1, 2), (2, 1), (2, 3), (3, 2)], "at BIGINT, next BIGINT")
    table, forget = traversal._steps_by_node(steps, None)
    frontier = spark.createDataFrame([(2,)], "node_id BIGINT").hint("shuffle_hash")
    beyond = table.join(frontier, table["at"] == frontier["node_id"], "left_semi")
    assert plan(beyond).count("Exchange") == 1 and "SortMergeJoin" not in plan(beyond)
    assert sorted(r.next for r in beyond.collect()) == [1, 3]
    forget()
    assert not spark.catalog.listTables()


def test_steps_are_written_where_they_are_read_and_not_shuffled(spark):
    steps = spark.range(0, 60, 1, 3).select(F.lit(1).cast("bigint").alias("at"), F.col("id").alias("next"))
    more = steps.select("at", (F.col("next") + 60).alias("next"))
    table, forget = traversal._steps_by_node(steps, 0, more)
    # each of the three tasks writes a file of its own for each of both frames, in the one bucket
    assert table.select(F.input_file_name()).distinct().count() == 6
    assert sorted(r.next for r in table.collect()) == list(range(120))
    forget()


@pytest.mark.parametrize("seed", range(3))
def test_rounds_look_back_no_further_than_a_step_can_lead(spark, large, seed):
    rng = random.Random(seed)
    pairs = [(rng.randrange(i), i) for i in range(1, 25)] + [(rng.randrange(25), rng.randrange(25)) for _ in range(6)] + [(3, 3), (None, 4), (5, None), (40, 41)]
    edges = spark.createDataFrame([(a, "a", b, {}) for a, b in pairs], EDGE_SCHEMA)
    dist, depth = {0: 0, 24: 0, 50: 0}, 0
    while depth < 6:
        depth += 1
        reached = {y for a, b in pairs if None not in (a, b) for x, y in ((a, b), (b, a)) if x in dist} - set(dist)
        dist |= dict.fromkeys(reached, depth)
    found = traversal.distances(edges, spark.createDataFrame([(0,), (24,), (50,), (0,)], "node_id BIGINT"), 6)
    assert sorted((r.node_id, r.dist) for r in found.collect()) == sorted(dist.items())


@pytest.mark.parametrize("depth", [1, 2, 10])
def test_edges_are_shuffled_once_by_their_start(spark, large, depth):
    edges = spark.createDataFrame(RING, EDGE_SCHEMA)
    roots = spark.createDataFrame([(0,)], "node_id BIGINT")
    near = {0: {0}, 1: {0, 1, 5}}.get(depth - 1, {0, 1, 2, 3, 4, 5, 7})
    found = traversal.neighbourhood_edges(edges, roots, depth)
    expected = {(a, t, b, tuple(p.items())) for a, t, b, p in RING if a in near or b in near}
    assert sorted(map(str, ((r.start_id, r.type, r.end_id, tuple(r.properties.items())) for r in found.collect()))) == sorted(map(str, expected))
    if depth == 10:
        assert "hashpartitioning(start_id#" in plan(found) and "type#" not in "".join(line for line in plan(found).splitlines() if "Exchange" in line)


def test_keys_held_in_memory_are_dealt_into_parts_that_stay(spark, large, rows, monkeypatch):
    monkeypatch.setattr(skew, "PART_BYTES", 100, raising=False)
    kept = [(i, i % 2) for i in range(60)] + [(7, 1), (7, 1), (None, 0)]
    sides = [spark.createDataFrame([r for r in kept if r[1] == side], "k BIGINT, side INT") for side in (0, 1)]
    keys = spark.createDataFrame([(i,) for i in range(40)] * 2 + [(None,), (99,)], "pk BIGINT")
    found = skew.keep_matching(sides[0].unionByName(sides[1]), keys, [("k", "pk")], hashed=True)
    assert found.columns == ["k", "side"] and rows(found) == sorted(r for r in kept if r[0] is not None and r[0] < 40)
    # by their few bytes they would come together again in one task for each side of the union
    assert found.select(F.spark_partition_id()).distinct().count() > 8
    narrow = skew.keep_matching(sides[0].unionByName(sides[1]), keys.select(F.col("pk").cast("int")), [("k", "pk")], hashed=True)
    assert rows(narrow) == rows(found)


def test_edges_of_several_tables_are_looked_up_in_one_join(spark, large):
    edges = reduce(lambda a, b: a.unionByName(b), [spark.createDataFrame(RING[i::3], EDGE_SCHEMA) for i in range(3)])
    found = traversal.neighbourhood_edges(edges, spark.createDataFrame([(0,)], "node_id BIGINT"), 10)
    assert plan(found).count("ShuffledHashJoin") == 1
    assert sorted(map(str, ((r.start_id, r.type, r.end_id, r.properties) for r in found.collect()))) == sorted({str(e) for e in RING})


def test_busy_nodes_are_followed_too(spark):
    before = skew.set_limits(skew.limits(small_bytes=0, hot_rows=3, sample_share=1.0))
    edges = spark.createDataFrame([(0, "a", i, {}) for i in range(1, 9)] + [(8, "a", 9, {})], EDGE_SCHEMA)
    found = traversal.distances(edges, spark.createDataFrame([(3,)], "node_id BIGINT"), 10)
    skew.set_limits(before)
    assert {r.node_id: r.dist for r in found.collect()} == {3: 0, 0: 1, **{i: 2 for i in (1, 2, 4, 5, 6, 7, 8)}, 9: 3}

def test_only_rows_of_differing_keys_are_summed_by_column(spark, rows):
    schema = "k INT, l INT, v STRING, w DOUBLE"
    a = spark.createDataFrame([(1, 1, "x", 1.0), (1, None, "x", 1.0), (2, 1, "x", None), (2, 1, "y", 2.0), (3, 1, "x", 1.0), (None, None, "n", 0.0)], schema)
    b = spark.createDataFrame([(1, 1, "x", 1.0), (1, None, "x", 2.0), (2, 1, "y", None), (2, 1, "x", 2.0), (4, 1, "x", 1.0), (None, None, None, 0.0)], schema)
    found = reconcile.row_differences(a, b, ["k", "l"])
    # the rows of key 2 were only paired otherwise, which is the same by column
    assert rows(found) == [(None, None, "changed", ["v"]), (1, None, "changed", ["w"]), (3, 1, "lost", []), (4, 1, "added", [])]
    assert "xxhash64" not in found.groupBy("change").count()._jdf.queryExecution().optimizedPlan().toString()
    assert rows(reconcile.row_differences(a.select("k", "l"), b.select("k", "l"), ["k", "l"])) == [(3, 1, "lost", []), (4, 1, "added", [])]

def test_references_are_grouped_without_sorting(spark, large, rows):
    child = spark.createDataFrame([(i % 9, i % 2) for i in range(20)] + [(None, 1)], "a INT, b INT")
    parent = spark.createDataFrame([(i, 0) for i in range(5)] * 2 + [(None, 0)], "x INT, y INT")
    key = ForeignKey.of("c", "a,b", "p", "x,y")
    lost = validate.orphans(child, parent, key)
    assert "Sort" not in plan(lost)
    assert sum(r.rows for r in lost.collect()) == sum(1 for i in range(20) if i % 2 or i % 9 > 4)
    found = validate.reference_findings({"c": child, "p": parent}, [key])
    assert "Window" not in plan(found)
    assert found.first().sample == ["0,1", "1,1", "2,1", "3,1", "4,1"]


def test_keys_of_large_tables_are_dealt_before_they_are_grouped(spark, large, rows, monkeypatch):
    monkeypatch.setattr(validate, "KEY_BYTES", 200)
    child = spark.createDataFrame([(i % 9, i % 2) for i in range(40)] + [(None, 1), (3, None)], "a INT, b INT")
    parent = spark.createDataFrame([(i, 0) for i in range(5)] * 2 + [(None, 0)], "x INT, y INT")
    lost = validate.orphans(child, parent, ForeignKey.of("c", "a,b", "p", "x,y"))
    operators = [line.strip(" +-*(0123456789:)") for line in plan(lost).splitlines()]
    exchange = next(i for i, line in enumerate(operators) if line.startswith("Exchange"))
    # nothing is grouped before keys are dealt, into more parts than a shuffle has by default
    assert sum("HashAggregate" in line for line in operators[:exchange]) == 2 and not any("Aggregate" in line for line in operators[exchange:])
    assert "REPARTITION_BY_NUM" in operators[exchange] and int(operators[exchange].split(", ")[2].split(")")[0]) > 2
    expected = {}
    for i in range(40):
        if i % 2 or i % 9 > 4:
            expected[i % 9, i % 2] = expected.get((i % 9, i % 2), 0) + 1
    assert rows(lost) == sorted((*k, n) for k, n in expected.items())


def test_rows_of_busy_keys_are_counted_before_they_are_dealt(spark, rows, monkeypatch):
    monkeypatch.setattr(validate, "KEY_BYTES", 100)
    monkeypatch.setattr(validate, "BUSY_BYTES", 0)
    child = spark.createDataFrame([(i if i < 9 else i % 2 * 7,) for i in range(200)] + [(None,)], "a BIGINT")
    parent = spark.createDataFrame([(i,) for i in range(5)], "x BIGINT")
    before = skew.set_limits(skew.limits(hot_rows=50, sample_share=1.0))
    lost = validate.orphans(child, parent, ForeignKey.of("c", "a", "p", "x"))
    found = rows(lost)
    skew.set_limits(before)
    assert found == [(5, 1), (6, 1), (7, 97), (8, 1)]
    assert "HashAggregate" in plan(lost).split("Union", 1)[1]
