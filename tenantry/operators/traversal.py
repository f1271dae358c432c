"""Neighbourhoods and paths in a property graph; edges are followed both ways."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenantry.skew import Probe, estimated_bytes, is_hot, keep_matching
from tenantry.sources.graph import nodes_with, ordered_entries
from tenantry.state import materialize, new_folder


def _both_ends(edges: DataFrame) -> tuple[Probe, Probe]:
    """Size and busiest nodes of the edges, looked up once for all rounds of a traversal."""
    start = Probe.of(edges, ["start_id"])
    return start, start if start.small else Probe.of(edges, ["end_id"])


#: Estimated bytes of edges for each bucket of their steps; there are no more buckets than shuffle partitions.
BUCKET_BYTES = 4 * 1024 * 1024


def _steps_by_node(steps: DataFrame, size: int | None, *more: DataFrame) -> tuple[DataFrame, Callable[[], None]]:
    """The steps written in buckets of the node they start at, and what forgets the table.

    Each task that reads edges writes its share of every bucket, so that steps
    are not shuffled.  ``more`` are steps to add, which are sorted on their own.
    """
    spark = steps.sparkSession
    most, name, path = int(spark.conf.get("spark.sql.shuffle.partitions")), f"steps_{uuid.uuid4().hex}", new_folder(spark, "steps")
    parts = most if size is None else min(most, 1 + size // BUCKET_BYTES)
    for some in (steps, *more):
        written = some.write.mode("append").bucketBy(parts, "at").sortBy("at", "next").option("path", path).option("compression", "zstd")
        written.saveAsTable(name, format="parquet")
    return spark.table(name), lambda: spark.sql(f"DROP TABLE IF EXISTS {name}")


def distances(edges: DataFrame, roots: DataFrame, max_depth: int) -> DataFrame:
    """``(node_id, dist)`` of every node within ``max_depth`` steps of a root.

    The steps are written once, both ways, in buckets of the node they start at,
    and never shuffled; those of the busiest nodes, which would make buckets
    uneven, are written apart.  Breadth first: each round takes the frontier to
    the buckets, drops nodes already reached, and stops when nothing new turns
    up.  As every step can be taken back, a node next to the frontier is at
    least as far as the round before it, so only the last two rounds are looked
    at.  A step is followed in one round only, so over all rounds no more nodes
    are shuffled than there are steps.
    """
    spark = edges.sparkSession
    folder = new_folder(spark, "reached")

    def frontier(depth: int) -> DataFrame:
        return spark.read.schema("node_id BIGINT").parquet(f"{folder}/dist={depth}")

    roots.select("node_id").distinct().write.parquet(f"{folder}/dist=0")
    pairs = edges.filter("start_id IS NOT NULL AND end_id IS NOT NULL")
    forth = pairs.select(F.col("start_id").alias("at"), F.col("end_id").alias("next"))
    back = pairs.select(F.col("end_id").alias("at"), F.col("start_id").alias("next"))
    size, probe = estimated_bytes(forth), Probe.of(forth.unionByName(back), ["at"])
    busy = materialize(forth.unionByName(back).filter(is_hot(["at"], probe)), "busy") if probe.hot else None
    if probe.hot:
        forth, back = forth.filter(~is_hot(["at"], probe)), back.filter(~is_hot(["at"], probe))
    by_node, forget = _steps_by_node(forth, size, back)
    try:
        for depth in range(1, max_depth + 1):
            last = frontier(depth - 1)
            if last.isEmpty():
                break
            match = F.col("at") == F.col("node_id")
            beyond = by_node.join(last.hint("shuffle_hash"), match, "left_semi")
            if busy is not None:
                beyond = beyond.unionByName(busy.join(F.broadcast(last.filter(is_hot(["node_id"], probe))), match, "left_semi"))
            near = last if depth == 1 else last.unionByName(frontier(depth - 2))
            found = beyond.select(F.col("next").alias("node_id")).distinct().join(near, "node_id", "left_anti")
            found.write.parquet(f"{folder}/dist={depth}")
    finally:
        forget()
    return spark.read.schema("node_id BIGINT, dist INT").parquet(folder)


def neighbourhood_nodes(nodes: DataFrame, edges: DataFrame, roots: DataFrame, max_depth: int = 10) -> DataFrame:
    """Distinct nodes within ``max_depth`` steps of a root, the roots included."""
    return nodes.join(distances(edges, roots, max_depth), "node_id")


def neighbourhood_edges(edges: DataFrame, roots: DataFrame, max_depth: int = 10) -> DataFrame:
    """Distinct relationships that lie on a trail of up to ``max_depth`` steps from a root.

    Those are the edges with an end nearer than ``max_depth``.  All neighbours
    of nodes before the last ring were reached too, so only edges into the last
    ring, or without a start, have to be looked up by their end.
    """
    near = distances(edges, roots, max_depth - 1)
    nodes, ring = near.select("node_id"), near.filter(F.col("dist") == max_depth - 1).select("node_id")
    by_start, by_end = _both_ends(edges)
    columns = ["start_id", "type", "end_id"]
    texts = edges.select(*columns, ordered_entries(F.col("properties")).alias("entries"))
    found = [keep_matching(texts.filter("start_id IS NOT NULL"), nodes, [("start_id", "node_id")], probe=by_start, hashed=True)]
    if not ring.isEmpty():
        inward = keep_matching(texts.filter("start_id IS NOT NULL"), ring, [("end_id", "node_id")], probe=by_end)
        found.append(keep_matching(inward, nodes, [("start_id", "node_id")], absent=True))
    found.append(keep_matching(texts.filter("start_id IS NULL"), nodes, [("end_id", "node_id")], probe=by_end))
    # rows that were brought together by their start need no further shuffle, and equal ones are in the same part
    apart = [part.distinct() for part in found]
    return reduce(DataFrame.unionByName, apart).select(*columns, F.map_from_entries("entries").alias("properties"))


#: Paths that are sent to every task; more of them are joined by a shuffle.
BROADCAST_PATHS = 100_000


def paths_from(
    nodes: DataFrame,
    edges: DataFrame,
    label: str,
    prop: str,
    value: str,
    max_depth: int = 3,
    limit: int = 1000,
) -> DataFrame:
    """The first ``limit`` paths of 1 to ``max_depth`` steps that use no edge twice.

    Paths come in order of depth, then of their edge ids, then of their start.
    ``edges`` needs a unique ``edge_id``.  A deeper round is only needed when all
    shallower paths together are fewer than ``limit``, so no round ever extends
    more than ``limit`` paths, however many edges a hub has.
    """
    links = edges.select("edge_id", "start_id", "end_id")
    by_start, by_end = _both_ends(links)
    starts = nodes_with(nodes, label, prop, value).select("node_id").distinct()
    forth = keep_matching(links, starts, [("start_id", "node_id")], probe=by_start).select(
        "start_id", "end_id", F.array("edge_id").alias("path_edges")
    )
    back = keep_matching(links.filter("start_id <> end_id"), starts, [("end_id", "node_id")], probe=by_end).select(
        F.col("end_id").alias("start_id"), F.col("start_id").alias("end_id"), F.array("edge_id").alias("path_edges")
    )
    candidates = forth.unionByName(back)
    left, found = limit, []
    for depth in range(1, max_depth + 1):
        paths = materialize(candidates.orderBy("path_edges", "start_id").limit(left), "paths")
        found.append(paths.withColumn("depth", F.lit(depth)))
        left -= paths.count()
        if left <= 0 or depth == max_depth:
            break
        tips = paths.withColumnRenamed("end_id", "tip")
        if limit - left <= BROADCAST_PATHS:
            tips = F.broadcast(tips)
        onward = links.join(tips.withColumnRenamed("start_id", "origin"), F.col("start_id") == F.col("tip"))
        inward = links.filter("start_id <> end_id").join(
            tips.withColumnRenamed("start_id", "origin"), F.col("end_id") == F.col("tip")
        )
        steps = onward.select("origin", "path_edges", "edge_id", F.col("end_id").alias("next")).unionByName(
            inward.select("origin", "path_edges", "edge_id", F.col("start_id").alias("next"))
        )
        candidates = steps.filter(~F.array_contains("path_edges", F.col("edge_id"))).select(
            F.col("origin").alias("start_id"),
            F.col("next").alias("end_id"),
            F.concat("path_edges", F.array("edge_id")).alias("path_edges"),
        )
    result = found[0]
    for part in found[1:]:
        result = result.unionByName(part)
    return result
