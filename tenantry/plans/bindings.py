"""The library's inputs, made from the tables of a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenantry.model import ForeignKey, Tables
from tenantry.operators.ranking import number_rows
from tenantry.sources.graph import Graph
from tenantry.state import materialize

SALT = "pepper"
AS_OF = "2024-06-30"

KEYS = (
    ForeignKey.of("nation", "n_regionkey", "region", "r_regionkey"),
    ForeignKey.of("customer", "c_nationkey", "nation", "n_nationkey"),
    ForeignKey.of("supplier", "s_nationkey", "nation", "n_nationkey"),
    ForeignKey.of("orders", "o_custkey", "customer", "c_custkey"),
    ForeignKey.of("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ForeignKey.of("lineitem", "l_partkey", "part", "p_partkey"),
    ForeignKey.of("lineitem", "l_suppkey", "supplier", "s_suppkey"),
)
STORE_OF = {
    "region": "catalog",
    "nation": "catalog",
    "part": "catalog",
    "supplier": "catalog",
    "customer": "sales",
    "orders": "sales",
    "lineitem": "sales",
}


def reader(spark: SparkSession, folder: str) -> Callable[[str], DataFrame]:
    """A function from table name to table, which reads the footer of each table once."""
    seen: Tables = {}

    def read(name: str) -> DataFrame:
        if name not in seen:
            seen[name] = spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
        return seen[name]

    return read


def tables(spark: SparkSession, folder: str, *names: str) -> Tables:
    read = reader(spark, folder)
    return {name: read(name) for name in names}


# Each kind of row gets its own range of ids: key * 8 + code.
CODES = {"Region": 0, "Nation": 1, "Customer": 2, "Supplier": 3, "Part": 4, "Order": 5}


def node_id(kind: str, key: str | Column) -> Column:
    column = F.col(key) if isinstance(key, str) else key
    return (column.cast("bigint") * 8 + CODES[kind]).alias("node_id")


def property_graph(spark: SparkSession, folder: str) -> Graph:
    """Regions, nations, customers, suppliers, parts and orders, tied by their keys and by order lines."""
    t = reader(spark, folder)

    def nodes(kind: str, table: str, key: str, **properties: str) -> DataFrame:
        entries = [F.lit("id"), F.col(key).cast("string")]
        for name, column in properties.items():
            entries += [F.lit(name), F.col(column).cast("string")]
        return t(table).select(node_id(kind, key), F.array(F.lit(kind)).alias("labels"), F.create_map(*entries).alias("properties"))

    def edges(df: DataFrame, start: Column, kind: str, end: Column, **properties: str) -> DataFrame:
        entries: list[Column] = []
        for name, column in properties.items():
            entries += [F.lit(name), F.col(column).cast("string")]
        bag = F.create_map(*entries) if entries else F.create_map().cast("map<string,string>")
        return df.select(start.alias("start_id"), F.lit(kind).alias("type"), end.alias("end_id"), bag.alias("properties"))

    all_nodes = (
        nodes("Region", "region", "r_regionkey", name="r_name")
        .union(nodes("Nation", "nation", "n_nationkey", name="n_name"))
        .union(nodes("Customer", "customer", "c_custkey", name="c_name", segment="c_mktsegment"))
        .union(nodes("Supplier", "supplier", "s_suppkey", name="s_name"))
        .union(nodes("Part", "part", "p_partkey", name="p_name", brand="p_brand"))
        .union(nodes("Order", "orders", "o_orderkey", status="o_orderstatus"))
    )
    lines = t("lineitem")
    all_edges = (
        edges(t("nation"), node_id("Nation", "n_nationkey"), "IN_REGION", node_id("Region", "n_regionkey"))
        .union(edges(t("customer"), node_id("Customer", "c_custkey"), "IN_NATION", node_id("Nation", "c_nationkey")))
        .union(edges(t("supplier"), node_id("Supplier", "s_suppkey"), "IN_NATION", node_id("Nation", "s_nationkey")))
        .union(edges(t("orders"), node_id("Order", "o_orderkey"), "PLACED_BY", node_id("Customer", "o_custkey")))
        .union(edges(lines, node_id("Order", "l_orderkey"), "CONTAINS", node_id("Part", "l_partkey"), flag="l_returnflag"))
        .union(edges(lines, node_id("Supplier", "l_suppkey"), "SUPPLIES", node_id("Part", "l_partkey")))
    )
    return Graph(all_nodes, all_edges)


#: Tells the rows of ``lineitem`` apart, which has no key of its own.
LINE_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"]


def numbered_edges(spark: SparkSession, folder: str) -> DataFrame:
    """All edges with an id of their own; those of lines are numbered in the order of what tells lines apart."""
    t = reader(spark, folder)

    def edges(df: DataFrame, key: str, code: int, start: Column, end: Column) -> DataFrame:
        number = (F.col(key).cast("bigint") * 8 + code).alias("edge_id")
        return df.select(number, start.alias("start_id"), end.alias("end_id"))

    lines = materialize(number_rows(t("lineitem").select(*LINE_KEY), LINE_KEY, name="line"), "lines")
    return (
        edges(t("nation"), "n_nationkey", 0, node_id("Nation", "n_nationkey"), node_id("Region", "n_regionkey"))
        .union(edges(t("customer"), "c_custkey", 1, node_id("Customer", "c_custkey"), node_id("Nation", "c_nationkey")))
        .union(edges(t("supplier"), "s_suppkey", 2, node_id("Supplier", "s_suppkey"), node_id("Nation", "s_nationkey")))
        .union(edges(t("orders"), "o_orderkey", 3, node_id("Order", "o_orderkey"), node_id("Customer", "o_custkey")))
        .union(edges(lines, "line", 4, node_id("Order", "l_orderkey"), node_id("Part", "l_partkey")))
        .union(edges(lines, "line", 5, node_id("Supplier", "l_suppkey"), node_id("Part", "l_partkey")))
    )


def row_hierarchy(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Rows as nodes and references as edges from the referred row to the referring one."""
    graph = property_graph(spark, folder)
    nodes = graph.nodes.select(F.col("node_id").alias("name"))
    downward = F.col("type").isin("CONTAINS", "SUPPLIES")
    edges = graph.edges.select(
        F.when(downward, F.col("start_id")).otherwise(F.col("end_id")).alias("parent"),
        F.when(downward, F.col("end_id")).otherwise(F.col("start_id")).alias("child"),
    )
    return nodes, edges


def trade_edges(spark: SparkSession, folder: str, level: str) -> DataFrame:
    """Buyer and seller of every order line: nations, regions, or nations in the year of the shipment (which leads to the next)."""
    t = reader(spark, folder)
    place = t("nation").select(
        F.col("n_nationkey").alias("key"),
        (F.concat(F.lit("R"), F.col("n_regionkey").cast("string")) if level == "region" else F.col("n_name")).alias("place"),
    )
    buyers = t("customer").join(place, F.col("c_nationkey") == F.col("key")).select("c_custkey", F.col("place").alias("parent"))
    sellers = t("supplier").join(place, F.col("s_nationkey") == F.col("key")).select("s_suppkey", F.col("place").alias("child"))
    lines = t("lineitem").select("l_orderkey", "l_suppkey", F.year("l_shipdate").alias("year")).distinct()
    sold = (
        lines.join(t("orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(buyers, F.col("o_custkey") == F.col("c_custkey"))
        .join(sellers, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    if level != "year":
        return sold.select("parent", "child").distinct()
    at = lambda place, year: F.concat(place, F.lit("@"), year.cast("string"))
    within = sold.select(at("parent", F.col("year")).alias("parent"), at("child", F.col("year")).alias("child"))
    onward = sold.select(at("parent", F.col("year")).alias("parent"), at("parent", F.col("year") + 1).alias("child"))
    return within.union(onward).distinct()


def named_tables(spark: SparkSession, folder: str) -> Tables:
    """The tables under the naming convention ``id`` and ``x_id``."""
    t = reader(spark, folder)
    return {
        "regions": t("region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name")),
        "nations": t("nation").select(F.col("n_nationkey").alias("id"), F.col("n_regionkey").alias("region_id")),
        "customers": t("customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation_id")),
        "suppliers": t("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nation_id")),
        "parts": t("part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name")),
        "orders": t("orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer_id")),
        "lines": t("lineitem").select(
            F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("part_id"), F.col("l_suppkey").alias("supplier_id")
        ),
        "events": t("events").select(
            F.col("event_id").alias("id"), F.col("user_id"), F.col("user_id").alias("supplier_id")
        ),
        "labels": t("labels").select(F.col("doc_id").alias("id"), F.col("doc_id").alias("document_id")),
        "documents": t("documents").select(F.col("doc_id").alias("id"), F.col("doc_id").alias("label_id")),
    }


def customer_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as tenants, with the figures the scoring needs."""
    t = reader(spark, folder)
    orders = t("orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    per_order = t("lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum((F.col("l_tax") != 0).cast("int") + (F.col("l_discount") != 0).cast("int")).alias("filled"),
    )
    joined = orders.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    figures = joined.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("students"),
        F.count_distinct("o_orderpriority").alias("schools"),
        (F.count(F.lit(1)) + F.coalesce(F.sum("lines"), F.lit(0))).alias("total_records"),
        F.count_if(F.col("o_orderdate") >= F.lit("2001-01-01").cast("date")).alias("recent_updates_30d"),
        (F.sum("filled") * 100.0 / (F.sum("lines") * 2)).alias("data_completeness_pct"),
        F.coalesce(F.max("lines"), F.lit(0)).alias("staff"),
    )
    business = F.when(F.col("c_acctbal") >= 0, F.floor(F.col("c_acctbal") / 100).cast("double"))
    return (
        t("customer")
        .join(figures, F.col("c_custkey") == F.col("o_custkey"))
        .select(
            F.col("c_custkey").alias("tenant"),
            "students",
            "staff",
            "schools",
            "total_records",
            "recent_updates_30d",
            "data_completeness_pct",
            business.alias("business_priority"),
        )
    )


def run_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Events as phases of runs: a run per user, a phase per type of event."""
    t = reader(spark, folder)
    phase = F.create_map(
        *[
            F.lit(x)
            for x in (
                "click", "extraction", "view", "anonymization", "signup", "validation", "purchase", "loading", "error", "reporting",
            )
        ]
    )[F.col("event_type")]
    return t("events").select(
        F.col("user_id").cast("string").alias("run_id"),
        F.lit("all").alias("tenant"),
        phase.alias("phase"),
        F.substring("props", 7, 1).alias("store"),
        F.col("event_type").alias("table_name"),
        F.floor("value").alias("rows"),
        F.length("props").cast("bigint").alias("fields"),
        (F.col("value") < 250).alias("success"),
        F.when(F.col("value") > 100, 1).otherwise(0).cast("bigint").alias("warnings"),
        (F.floor("value").cast("double") * 8 + 0.25).alias("seconds"),
        F.col("ts").alias("started"),
        F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("message"),
    )
