"""A property graph held as a node table and an edge table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NODE_SCHEMA = "node_id BIGINT, labels ARRAY<STRING>, properties MAP<STRING,STRING>"
EDGE_SCHEMA = "start_id BIGINT, type STRING, end_id BIGINT, properties MAP<STRING,STRING>"


@dataclass(frozen=True)
class Graph:
    nodes: DataFrame
    edges: DataFrame


def read_graph(spark: SparkSession, nodes_path: str, edges_path: str) -> Graph:
    nodes = spark.read.schema(NODE_SCHEMA).parquet(nodes_path)
    edges = spark.read.schema(EDGE_SCHEMA).parquet(edges_path)
    return Graph(nodes, edges)


def nodes_with(nodes: DataFrame, label: str, prop: str, value: str) -> DataFrame:
    """Nodes that carry the label and have the property value."""
    return nodes.filter(F.array_contains("labels", label) & (F.col("properties")[prop] == value))


def ordered_entries(properties: Column) -> Column:
    """A map as a sorted array of entries, which can be compared and grouped by."""
    return F.array_sort(F.map_entries(properties))


def entries_text(properties: Column) -> Column:
    """A map as text ``k=v,k=v`` in key order."""
    entries = ordered_entries(properties)
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
