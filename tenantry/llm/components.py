"""Connected components of an edge table, by alternating stars.

In every round each node links its larger neighbours to its least one (large
star), then its smaller neighbours to the least (small star).  The edges become
stars around each component's least node in about log(n) rounds.  A node with
very many edges is only ever a key of a minimum, which is pre-aggregated, and of
a join, which Spark splits; rounds are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenantry.state import materialize


def _with_least(directed: DataFrame) -> DataFrame:
    least = directed.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("of"), F.least("of", "m").alias("m"))
    return directed.join(least, F.col("u") == F.col("of")).select("u", "v", "m")


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def connected(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v) of longs to (node, component): every node that has an edge, with the least node it is linked to."""
    now = materialize(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before, state = None, _state(now)
    while state != before:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        starred = _with_least(large)  # edges from larger to smaller nodes
        small = starred.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(starred.select("u", F.col("m").alias("v")))
        now = materialize(small.filter("u <> v").distinct(), "edges")
        before, state = state, _state(now)
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
