"""Components and breaks against brute force, on graphs with and without chains."""

from __future__ import annotations

import random

import pytest

from tenantry.operators import cycles, dependencies


def reached(start, edges, allowed=lambda n: True):
    seen, open_ = {start}, [start]
    while open_:
        at = open_.pop()
        for parent, child in edges:
            if parent == at and child not in seen and allowed(child):
                seen.add(child)
                open_.append(child)
    return seen


def expected_components(edges):
    nodes = {n for e in edges for n in e}
    reach = {n: reached(n, edges) for n in nodes}
    of = {n: min(m for m in nodes if m in reach[n] and n in reach[m]) for n in nodes}
    return sorted((n, of[n], sum(of[m] == of[n] for m in nodes)) for n in nodes)


def expected_breaks(edges):
    nodes = {n for e in edges for n in e}
    children = {n: sum(p == n for p, _ in edges) for n in nodes}
    rank = {n: (children[n], n) for n in nodes}
    steps = set(edges)
    return sorted((a, b, children[a]) for a, b in steps if rank[a] <= rank[b] and a in reached(b, steps, lambda n, a=a: rank[n] >= rank[a]))


def random_graph(seed, nodes, count):
    rng = random.Random(seed)
    return [(f"n{rng.randrange(nodes):02d}", f"n{rng.randrange(nodes):02d}") for _ in range(count)]


CHAINS = [("a", "b"), ("b", "c"), ("c", "d"), ("d", "a"), ("c", "x"), ("x", "y"), ("y", "c"), ("y", "z"), ("z", "z"), ("p", "a")]


@pytest.mark.parametrize("edges", [random_graph(2, 11, 26), CHAINS])
def test_components_and_breaks(spark, rows, edges):
    table = spark.createDataFrame(edges, "parent string, child string")
    assert rows(cycles.strong_components(table)) == expected_components(edges)
    breaks = cycles.cycle_breaks(table)
    assert rows(breaks) == expected_breaks(edges)
    nodes = table.selectExpr("parent AS name").union(table.selectExpr("child")).distinct()
    assert dependencies.levels_with_breaks(nodes, table, breaks).count() == nodes.count()


def test_long_ring_is_one_edge(spark, rows):
    ring = spark.range(1000).selectExpr("id AS parent", "(id + 1) % 1000 AS child")
    assert rows(cycles.cycle_breaks(ring)) == [(0, 1, 1)]


def test_complete_graph_loses_every_edge_upwards(spark, rows):
    edges = spark.range(8 * 8).selectExpr("id div 8 AS parent", "id % 8 AS child")
    assert rows(cycles.cycle_breaks(edges)) == [(a, b, 8) for a in range(8) for b in range(a, 8)]


def test_no_edges_and_no_cycles(spark, rows):
    none = spark.createDataFrame([], "parent string, child string")
    assert rows(cycles.cycle_breaks(none)) == []
    chain = spark.createDataFrame([("a", "b"), ("b", "c"), (None, "a")], "parent string, child string")
    assert rows(cycles.strong_components(chain)) == [("a", "a", 1), ("b", "b", 1), ("c", "c", 1)]
