"""Graph operators against brute force on small random graphs."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tenantry.operators import dependencies as dep
from tenantry.operators import traversal
from tenantry.sources.graph import EDGE_SCHEMA, NODE_SCHEMA, nodes_with


def make_graph(spark, edges, nodes=None, roots=(0,)):
    """``edges`` are (start, type, end, properties); root nodes carry the label Root."""
    ids = sorted(set(nodes or ()) | {e[0] for e in edges} | {e[2] for e in edges} | set(roots))
    node_rows = [(i, ["Root"] if i in roots else ["Item"], {"id": "r" if i in roots else str(i)}) for i in ids]
    return spark.createDataFrame(node_rows, NODE_SCHEMA), spark.createDataFrame(edges, EDGE_SCHEMA)


def trails(edges, starts, depth):
    """All trails of 1 to ``depth`` steps, as (start, end, edge numbers)."""
    found, frontier = [], [(s, s, ()) for s in starts]
    for _ in range(depth):
        step = []
        for start, at, used in frontier:
            for i, (a, _, b, _) in enumerate(edges):
                if i in used:
                    continue
                if a == at:
                    step.append((start, b, (*used, i)))
                if b == at and a != b:
                    step.append((start, a, (*used, i)))
        found += step
        frontier = step
    return found


def random_edges(seed, nodes=7, count=9):
    rng = random.Random(seed)
    return [(rng.randrange(nodes), rng.choice("ab"), rng.randrange(nodes), rng.choice([{}, {"p": "1"}, {"p": "1", "q": "2"}])) for _ in range(count)]


CASES = [random_edges(seed) for seed in range(2)] + [
    [(0, "a", 0, {}), (0, "a", 1, {}), (0, "a", 1, {}), (1, "a", 2, {"x": "1"}), (2, "b", 0, {})],  # loop, parallel edges, ring
    [(i, "a", i + 1, {}) for i in range(5)],  # ends exactly at the depth
]


@pytest.mark.parametrize("edges", CASES)
@pytest.mark.parametrize("depth", [3])
def test_neighbourhood_equals_the_ends_of_all_trails(spark, edges, depth):
    nodes, table = make_graph(spark, edges, nodes=[99])
    root = nodes_with(nodes, "Root", "id", "r")
    paths = trails(edges, [0], depth)
    expected_nodes = {0} | {end for _, end, _ in paths}
    assert {r.node_id for r in traversal.neighbourhood_nodes(nodes, table, root, depth).collect()} == expected_nodes
    expected_edges = {(edges[i][0], edges[i][1], edges[i][2], tuple(sorted(edges[i][3].items()))) for _, _, used in paths for i in used}
    got = traversal.neighbourhood_edges(table, root, depth).collect()
    assert Counter((r.start_id, r.type, r.end_id, tuple(sorted(r.properties.items()))) for r in got) == Counter(expected_edges)


def test_isolated_root_and_two_roots(spark):
    nodes, table = make_graph(spark, [(1, "a", 2, {}), (5, "a", 6, {})], roots=(0, 5))
    root = nodes_with(nodes, "Root", "id", "r")
    assert {(r.node_id, r.dist) for r in traversal.distances(table, root, 10).collect()} == {(0, 0), (5, 0), (6, 1)}


@pytest.mark.parametrize("edges", CASES)
@pytest.mark.parametrize("limit", [4, 1000])
def test_paths_are_the_first_trails(spark, edges, limit):
    nodes, table = make_graph(spark, edges, roots=(0, 1))
    numbered = spark.createDataFrame([(i, a, b) for i, (a, _, b, _) in enumerate(edges)], "edge_id BIGINT, start_id BIGINT, end_id BIGINT")
    got = traversal.paths_from(nodes, numbered, "Root", "id", "r", max_depth=3, limit=limit).collect()
    expected = sorted(((len(used), used, start, end) for start, end, used in trails(edges, [0, 1], 3)))[:limit]
    assert sorted((r.depth, tuple(r.path_edges), r.start_id, r.end_id) for r in got) == expected


def kahn(nodes, edges):
    level, left = {}, set(nodes)
    while True:
        ready = {n for n in left if not any(c == n and p in left for p, c in edges)}
        if not ready:
            return level
        for n in ready:
            level[n] = max([level[p] + 1 for p, c in edges if c == n], default=0)
        left -= ready


@pytest.mark.parametrize("seed", range(2))
def test_levels_core_and_cycles(spark, seed):
    rng = random.Random(seed)
    names = "abcdefgh"
    pairs = [(rng.choice(names), rng.choice(names)) for _ in range(10)] + [("a", "b"), ("a", "b")]
    nodes = spark.createDataFrame([(n,) for n in names], "name STRING")
    edges = spark.createDataFrame(pairs, "parent STRING, child STRING")
    levels = {r.name: r.level for r in dep.topological_levels(nodes, edges).collect()}
    assert levels == kahn(names, pairs)
    rest = set(names) - set(levels)
    down = kahn(rest, [(c, p) for p, c in pairs if p in rest and c in rest])
    core, _ = dep.cyclic_core(nodes, edges)
    assert {r.name for r in core.collect()} == rest - set(down)

    def cycles(path):
        for p, c in set(pairs):
            if p == path[-1] and c == path[0]:
                yield (*path, c)
            if p == path[-1] and c > path[0] and c not in path and len(path) < 4:
                yield from cycles((*path, c))

    expected = {cycle for n in names for cycle in cycles((n,))}
    found = dep.simple_cycles(nodes, edges, max_length=4)
    assert Counter(tuple(r.members) for r in found.collect()) == Counter(expected)
    degree = Counter(p for p, _ in pairs)
    for row in dep.break_points(found, edges).collect():
        ring = row.members[:-1]
        best = min(range(len(ring)), key=lambda i: (degree[ring[i]], i))
        assert (row.break_from, row.break_to, row.affected) == (ring[best], ring[(best + 1) % len(ring)], degree[ring[best]])


def test_order_with_breaks_and_reverse(spark, rows):
    nodes = spark.createDataFrame([("s.a",), ("s.b",), ("t.c",)], "name STRING")
    edges = spark.createDataFrame([("s.a", "s.b"), ("s.b", "s.a"), ("s.b", "t.c")], "parent STRING, child STRING")
    assert dep.topological_levels(nodes, edges).count() == 0
    breaks = dep.break_points(dep.simple_cycles(nodes, edges, 3), edges)
    levels = dep.levels_with_breaks(nodes, edges, breaks)
    assert rows(levels) == [("s.a", 1), ("s.b", 0), ("t.c", 1)]
    assert rows(dep.reverse_order(levels), "position", "name") == [(1, "s.a"), (2, "t.c"), (3, "s.b")]
    assert rows(dep.order_by_store(levels), "store", "table_name", "position") == [("s", "a", 2), ("s", "b", 1), ("t", "c", 1)]
    assert rows(dep.graph_totals(nodes, edges)) == [(3, 3)]


def test_dependency_edges_leave_out_other_stores(spark, rows):
    tables = spark.createDataFrame(
        [("ids", "postgresql", "public", "alone"), ("sp", "neo4j", "public", "nodes")], "store STRING, store_type STRING, schema STRING, table STRING"
    )
    keys = spark.createDataFrame(
        [("ids", "postgresql", "public", "child", "public", "parent")] * 2 + [("sp", "neo4j", "x", "a", "x", "b")],
        "store STRING, store_type STRING, child_schema STRING, child_table STRING, parent_schema STRING, parent_table STRING",
    )
    nodes, edges = dep.dependency_edges(tables, keys)
    assert rows(nodes) == [("ids.public.alone",), ("ids.public.child",), ("ids.public.parent",)]
    assert rows(edges) == [("ids.public.parent", "ids.public.child")] * 2


def test_schema_drift(spark, rows):
    old = spark.createDataFrame([("t", "a", "int"), ("t", "b", "int"), ("t", "c", None)], "t STRING, c STRING, k STRING")
    new = spark.createDataFrame([("t", "b", "string"), ("t", "c", None), ("u", "a", "int")], "t STRING, c STRING, k STRING")
    drift = dep.schema_drift(old, new, ["t", "c"], ["k"])
    assert rows(drift) == [("t", "a", "removed"), ("t", "b", "changed"), ("u", "a", "added")]


def test_positions_do_not_depend_on_partitions(spark):
    from tenantry.operators.ranking import number_rows

    df = spark.range(5_000).select((F.col("id") * 7919 % 5003).alias("v"), (F.col("id") % 3).alias("g"))
    for parts in (1, 5, 16):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        numbered = number_rows(df, [F.desc("v")], per=["g"]).collect()
        for g in range(3):
            group = sorted((r.position, -r.v) for r in numbered if r.g == g)
            assert [p for p, _ in group] == list(range(1, len(group) + 1))
            assert [v for _, v in group] == sorted(v for _, v in group)
    spark.conf.set("spark.sql.shuffle.partitions", 2)
