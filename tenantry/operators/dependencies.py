"""Foreign-key and row dependency graphs.

A graph is a frame of nodes ``(name)`` and a frame of edges ``(parent, child)``.
The same operators serve a schema with a few dozen tables and row hierarchies
with billions of edges: each works level by level, every level is one set of
joins, and its result is written to the shared folder.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenantry.model import Tables
from tenantry.operators.ranking import number_rows
from tenantry.skew import Probe, comparable, keep_matching
from tenantry.state import materialize, new_folder


def dependency_edges(tables: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges from schema metadata; only relational stores take part.

    ``tables(store, store_type, schema, table)`` and ``keys(store, store_type,
    child_schema, child_table, parent_schema, parent_table)``.  A table without
    any key stays as a node.
    """
    relational = F.col("store_type") == "postgresql"
    full = lambda schema, table: F.concat_ws(".", "store", schema, table)
    edges = keys.filter(relational).select(
        full("parent_schema", "parent_table").alias("parent"),
        full("child_schema", "child_table").alias("child"),
    )
    nodes = (
        tables.filter(relational)
        .select(full("schema", "table").alias("name"))
        .union(edges.select("parent"))
        .union(edges.select("child"))
        .distinct()
    )
    return nodes, edges


def topological_levels(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(name, level)`` of every node that can be ordered; parents have lower levels.

    The level is the longest chain of parents above a node.  Nodes on or below a
    cycle get no level, so a graph has a cycle if this returns fewer rows than
    there are nodes.  Each round carries only the nodes that it reaches, with the
    number of their parents already placed, and writes them once: those that are
    ready make up the level, the others wait.
    """
    spark = nodes.sparkSession
    folder = new_folder(spark, "levels")
    edges = materialize(edges.select("parent", "child"), "relations")  # every level reads them
    probe = Probe.of(edges, ["parent"])
    needed = materialize(edges.groupBy("child").agg(F.count(F.lit(1)).alias("needed")), "needed")
    schema = f"name {nodes.schema['name'].dataType.simpleString()}, seen BIGINT"

    def round_of(number: int, ready: bool) -> DataFrame:
        part = spark.read.schema(f"{schema}, ready BOOLEAN").parquet(f"{folder}/level={number}")
        return part.filter(F.col("ready") == ready).select("name", "seen")

    def write(reached: DataFrame, number: int) -> None:
        reached.write.partitionBy("ready").parquet(f"{folder}/level={number}")

    first = keep_matching(nodes.select("name").distinct(), needed, [("name", "child")], absent=True)
    write(first.select("name", F.lit(0).cast("bigint").alias("seen"), F.lit(True).alias("ready")), 0)
    number = 0
    while not round_of(number, True).isEmpty():
        placed = round_of(number, True)
        hits = keep_matching(edges, placed, [("parent", "name")], probe=probe)
        hits = hits.select(F.col("child").alias("name"), F.lit(1).cast("bigint").alias("seen"))
        if number > 0:
            hits = hits.unionByName(round_of(number, False))
        seen = hits.groupBy("name").agg(F.sum("seen").alias("seen"))
        reached = seen.join(needed, F.col("name") == F.col("child"))
        number += 1
        write(reached.select("name", "seen", (F.col("seen") == F.col("needed")).alias("ready")), number)
    done = spark.read.schema(f"{schema}, level INT, ready BOOLEAN").parquet(folder)
    return done.filter("ready").select("name", "level")


def unordered_nodes(nodes: DataFrame, levels: DataFrame) -> DataFrame:
    """Nodes that a topological order leaves out."""
    return nodes.select("name").distinct().join(levels.select("name"), "name", "left_anti")


def cyclic_core(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes on a cycle or between cycles, and the edges among them.

    What remains after taking away sources and then sinks until none is left.
    """
    rest = materialize(unordered_nodes(nodes, topological_levels(nodes, edges)), "unordered")
    inner = _edges_among(rest, edges)
    backward = inner.select(F.col("child").alias("parent"), F.col("parent").alias("child"))
    core = materialize(unordered_nodes(rest, topological_levels(rest, backward)), "core")
    return core, _edges_among(core, inner)


def _edges_among(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    inner = keep_matching(edges.select("parent", "child"), nodes, [("parent", "name")])
    return materialize(keep_matching(inner, nodes, [("child", "name")]), "inner-edges")


def simple_cycles(nodes: DataFrame, edges: DataFrame, max_length: int | None = None) -> DataFrame:
    """Every cycle, once, as ``members``; with ``max_length`` only those of so many edges at most.

    A cycle starts at its smallest member, which also ends it.  Paths only grow
    through members above their start, so no rotation is built twice.
    """
    _, core_edges = cyclic_core(nodes, edges)
    steps = materialize(core_edges.distinct(), "steps")
    loops = steps.filter("parent = child").select(F.array("parent", "child").alias("members"))
    found = [loops]
    paths = steps.filter("child > parent").select(F.array("parent", "child").alias("path"))
    following = steps.select(F.col("parent").alias("at"), F.col("child").alias("next"))
    for length in itertools.count(2):
        if max_length is not None and length > max_length:
            break
        grown = paths.withColumn("at", F.element_at("path", -1)).join(following, "at").drop("at")
        grown = grown.filter(F.col("next") >= F.col("path")[0])
        closed = grown.filter(F.col("next") == F.col("path")[0])
        found.append(closed.select(F.concat("path", F.array("next")).alias("members")))
        if length == max_length:
            break
        paths = materialize(
            grown.filter((F.col("next") > F.col("path")[0]) & ~F.array_contains("path", F.col("next"))).select(
                F.concat("path", F.array("next")).alias("path")
            ),
            "paths",
        )
        if paths.isEmpty():
            break
    result = found[0]
    for part in found[1:]:
        result = result.unionByName(part)
    return result


def break_points(cycles: DataFrame, edges: DataFrame) -> DataFrame:
    """For each cycle the member with the fewest children, and the edge to give up.

    Ties go to the member that comes first in the cycle.
    """
    children = edges.groupBy(F.col("parent").alias("member")).agg(F.count(F.lit(1)).alias("children"))
    ring = F.slice("members", F.lit(1), F.size("members") - 1)
    chosen = (
        cycles.select("members", F.posexplode(ring).alias("at", "member"))
        .join(children, "member", "left")
        .groupBy("members")
        .agg(F.min(F.struct(F.coalesce("children", F.lit(0)).alias("children"), "at", "member")).alias("pick"))
    )
    after = (F.col("pick.at") + 1) % (F.size("members") - 1)
    return chosen.select(
        "members",
        F.col("pick.member").alias("break_from"),
        F.col("members")[after].alias("break_to"),
        F.col("pick.children").alias("affected"),
    )


def levels_with_breaks(nodes: DataFrame, edges: DataFrame, breaks: DataFrame) -> DataFrame:
    """Topological levels after the broken edges are taken out.

    Raises a ValueError if cycles are left, as nodes on them would have no level.
    """
    kept = keep_matching(edges, breaks, [("parent", "break_from"), ("child", "break_to")], absent=True)
    levels = materialize(topological_levels(nodes, kept), "levels")
    lost = keep_matching(nodes, levels, [("name", "name")], absent=True).count()
    if lost:
        raise ValueError(f"{lost} nodes are on or behind cycles that have no break point")
    return levels


def order_by_store(levels: DataFrame) -> DataFrame:
    """Position of each table within its store, by level and name."""
    parts = F.split("name", r"\.", 2)
    named = levels.select(parts[0].alias("store"), parts[1].alias("table_name"), "level")
    return number_rows(named, ["level", "table_name"], per=["store"])


def reverse_order(levels: DataFrame) -> DataFrame:
    """Position for removal: children before parents, then by name."""
    return number_rows(levels, [F.desc("level"), F.asc("name")])


def graph_totals(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Number of tables and of relationships; parallel relationships all count."""
    counts = nodes.select(F.lit(1).alias("n"), F.lit(0).alias("e")).unionByName(
        edges.select(F.lit(0).alias("n"), F.lit(1).alias("e"))
    )
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_tables"),
        F.coalesce(F.sum("e"), F.lit(0)).alias("total_relationships"),
    )


def infer_foreign_keys(tables: Tables, names: Iterable[str] | None = None) -> DataFrame:
    """Guess ``x_id -> xs.id`` by name and verify each guess against the values.

    ``orphans`` counts distinct non-null values that the parent lacks; a key
    without a table of that name has status SKIPPED.
    """
    result = None
    for name in names or sorted(tables):
        df = tables[name]
        for column in df.columns:
            if not column.endswith("_id"):
                continue
            parent = column.removesuffix("_id") + "s"
            known = parent in tables and "id" in tables[parent].columns
            values = df.select(F.col(column).alias("value")).dropna().distinct()
            if known:
                ids = tables[parent].select(F.col("id").alias("id")).dropna().distinct().withColumn("hit", F.lit(1))
                mine, theirs = comparable(df.schema[column].dataType, F.col("value"), ids.schema["id"].dataType, F.col("id"))
                values = values.join(ids, mine == theirs, "left")
            else:
                values = values.withColumn("hit", F.lit(None).cast("int"))
            counted = values.agg(
                F.count(F.lit(1)).alias("distinct_values"),
                F.count_if(F.col("hit").isNull()).alias("missing"),
            )
            row = counted.select(
                F.lit(name).alias("child_table"),
                F.lit(column).alias("column_name"),
                F.lit(parent if known else None).cast("string").alias("parent_table"),
                "distinct_values",
                F.when(F.lit(known), F.col("missing")).alias("orphans"),
                (F.when(F.lit(not known), "SKIPPED").when(F.col("missing") == 0, "VERIFIED").otherwise("VIOLATED")).alias(
                    "status"
                ),
            )
            result = row if result is None else result.unionByName(row)
    if result is None:
        raise ValueError("no column ends with _id")
    return result


def schema_drift(before: DataFrame, after: DataFrame, key: Sequence[str], compare: Sequence[str] = ()) -> DataFrame:
    """Entries added, removed or changed between two metadata snapshots."""
    old = before.select(*key, F.struct(F.lit(1), *compare).alias("old"))
    new = after.select(*key, F.struct(F.lit(1), *compare).alias("new"))
    change = (
        F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(F.col("old") != F.col("new"), "changed")
    )
    return old.join(new, list(key), "full_outer").select(*key, change.alias("change")).filter("change IS NOT NULL")


def graph_schema(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Labels, relationship types and property keys in use, with their counts."""

    def counted(df: DataFrame, kind: str, value) -> DataFrame:
        return df.select(F.lit(kind).alias("kind"), value.alias("name")).groupBy("kind", "name").count()

    return (
        counted(nodes, "label", F.explode("labels"))
        .unionByName(counted(edges, "relationship_type", F.col("type")))
        .unionByName(counted(nodes, "node_property", F.explode(F.map_keys("properties"))))
        .unionByName(counted(edges, "edge_property", F.explode(F.map_keys("properties"))))
        .withColumnRenamed("count", "uses")
    )
