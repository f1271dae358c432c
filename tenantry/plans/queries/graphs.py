"""Dependency graphs, neighbourhoods and paths over the rows of the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenantry.operators import cycles, dependencies, traversal
from tenantry.plans.bindings import named_tables, numbered_edges, property_graph, reader, row_hierarchy, trade_edges
from tenantry.sources.graph import entries_text, nodes_with
from tenantry.state import materialize


def khop_nodes(spark: SparkSession, folder: str) -> DataFrame:
    graph = property_graph(spark, folder)
    root = nodes_with(graph.nodes, "Nation", "id", "7")
    near = traversal.neighbourhood_nodes(graph.nodes, graph.edges, root, max_depth=10)
    return near.select("node_id", F.col("labels")[0].alias("label"), entries_text(F.col("properties")).alias("properties"), "dist")


def khop_edges(spark: SparkSession, folder: str) -> DataFrame:
    graph = property_graph(spark, folder)
    root = nodes_with(graph.nodes, "Nation", "id", "7")
    near = traversal.neighbourhood_edges(graph.edges, root, max_depth=10)
    return near.select("start_id", "type", "end_id", entries_text(F.col("properties")).alias("properties"))


def path_enumeration(spark: SparkSession, folder: str) -> DataFrame:
    graph = property_graph(spark, folder)
    paths = traversal.paths_from(graph.nodes, numbered_edges(spark, folder), "Customer", "segment", "BUILDING")
    return paths.select("start_id", "end_id", F.concat_ws("-", F.col("path_edges").cast("array<string>")).alias("path"), "depth")


def path_enumeration_deep(spark: SparkSession, folder: str) -> DataFrame:
    graph = property_graph(spark, folder)
    paths = traversal.paths_from(graph.nodes, numbered_edges(spark, folder), "Customer", "id", "7", max_depth=3)
    return paths.select("start_id", "end_id", F.concat_ws("-", F.col("path_edges").cast("array<string>")).alias("path"), "depth")


def graph_schema(spark: SparkSession, folder: str) -> DataFrame:
    graph = property_graph(spark, folder)
    return dependencies.graph_schema(graph.nodes, graph.edges)


def topological_levels(spark: SparkSession, folder: str) -> DataFrame:
    return dependencies.topological_levels(*row_hierarchy(spark, folder))


def reverse_order(spark: SparkSession, folder: str) -> DataFrame:
    return dependencies.reverse_order(topological_levels(spark, folder))


def order_by_store(spark: SparkSession, folder: str) -> DataFrame:
    graph = property_graph(spark, folder)
    levels = topological_levels(spark, folder).withColumnRenamed("name", "node_id")
    named = levels.join(graph.nodes, "node_id").select(
        F.concat(F.col("labels")[0], F.lit("."), F.col("properties")["id"]).alias("name"), "level"
    )
    return dependencies.order_by_store(named)


def graph_totals(spark: SparkSession, folder: str) -> DataFrame:
    return dependencies.graph_totals(*row_hierarchy(spark, folder))


def foreign_key_inference(spark: SparkSession, folder: str) -> DataFrame:
    return dependencies.infer_foreign_keys(named_tables(spark, folder))


def dependency_order(spark: SparkSession, folder: str) -> DataFrame:
    """Levels of the tables from the foreign keys that the values bear out."""
    found = materialize(foreign_key_inference(spark, folder), "keys").filter("status = 'VERIFIED'")
    fixed = {"store": "dw", "store_type": "postgresql", "child_schema": "public", "parent_schema": "public"}
    keys = found.select("child_table", "parent_table", *[F.lit(v).alias(c) for c, v in fixed.items()])
    names = [("dw", "postgresql", "public", name) for name in named_tables(spark, folder)]
    names.append(("sp", "neo4j", "public", "nodes"))
    tables = spark.createDataFrame(names, "store STRING, store_type STRING, schema STRING, table STRING")
    return dependencies.topological_levels(*dependencies.dependency_edges(tables, keys))


def _trade(spark: SparkSession, folder: str, level: str) -> tuple[DataFrame, DataFrame]:
    edges = materialize(trade_edges(spark, folder, level), "trade")
    nodes = edges.select(F.col("parent").alias("name")).union(edges.select("child")).distinct()
    return nodes, edges


def cycle_core(spark: SparkSession, folder: str) -> DataFrame:
    """Trade between nations, with the customers below and the regions above them."""
    t = reader(spark, folder)
    _, trade = _trade(spark, folder, "nation")
    names = t("nation").select("n_nationkey", "n_name", "n_regionkey")
    regions = names.join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    customers = t("customer").join(names, F.col("c_nationkey") == F.col("n_nationkey"))
    edges = (
        trade.unionByName(regions.select(F.col("r_name").alias("parent"), F.col("n_name").alias("child")))
        .unionByName(customers.select(F.col("n_name").alias("parent"), F.col("c_name").alias("child")))
    )
    nodes = edges.select(F.col("parent").alias("name")).union(edges.select("child")).distinct()
    core, _ = dependencies.cyclic_core(nodes, edges)
    return core


def simple_cycles(spark: SparkSession, folder: str) -> DataFrame:
    found = dependencies.simple_cycles(*_trade(spark, folder, "region"))
    return found.select(F.concat_ws(">", "members").alias("cycle"), (F.size("members") - 1).alias("length"))


def break_points(spark: SparkSession, folder: str) -> DataFrame:
    nodes, edges = _trade(spark, folder, "region")
    chosen = dependencies.break_points(dependencies.simple_cycles(nodes, edges), edges)
    return chosen.select(F.concat_ws(">", "members").alias("cycle"), "break_from", "break_to", "affected")


def order_with_breaks(spark: SparkSession, folder: str) -> DataFrame:
    nodes, edges = _trade(spark, folder, "region")
    breaks = dependencies.break_points(dependencies.simple_cycles(nodes, edges), edges)
    return dependencies.levels_with_breaks(nodes, edges, materialize(breaks, "breaks"))


def strong_components(spark: SparkSession, folder: str) -> DataFrame:
    """Nations in each year, tied by trade within the year and by time to the next."""
    return cycles.strong_components(_trade(spark, folder, "year")[1])


def cycle_breaks(spark: SparkSession, folder: str) -> DataFrame:
    """The edges to give up for all cycles of the trade between nations, of which there are too many to list."""
    return cycles.cycle_breaks(_trade(spark, folder, "nation")[1])


def order_of_all(spark: SparkSession, folder: str) -> DataFrame:
    """Levels of all nations, with the cycles among them broken."""
    nodes, edges = _trade(spark, folder, "nation")
    return dependencies.levels_with_breaks(nodes, edges, materialize(cycles.cycle_breaks(edges), "breaks"))


def schema_drift(spark: SparkSession, folder: str) -> DataFrame:
    """Types sold by each brand early and late, as columns of a table, with the largest size."""
    t = reader(spark, folder)
    lines = t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey"))

    def snapshot(period) -> DataFrame:
        return lines.filter(period).groupBy(F.col("p_brand").alias("table_name"), F.col("p_name").alias("column_name")).agg(
            F.max("p_size").alias("width")
        )

    before = snapshot(F.col("l_shipdate") < F.lit("1996-01-01").cast("date"))
    after = snapshot(F.col("l_shipdate") >= F.lit("2001-01-01").cast("date"))
    return dependencies.schema_drift(before, after, ["table_name", "column_name"], ["width"])


_LINKS = """
links AS (
  SELECT n_nationkey::BIGINT * 8 + 1 AS a, 'IN_REGION' AS t, n_regionkey::BIGINT * 8 AS b, '' AS p FROM nation
  UNION ALL SELECT c_custkey * 8 + 2, 'IN_NATION', c_nationkey::BIGINT * 8 + 1, '' FROM customer
  UNION ALL SELECT s_suppkey * 8 + 3, 'IN_NATION', s_nationkey::BIGINT * 8 + 1, '' FROM supplier
  UNION ALL SELECT o_orderkey * 8 + 5, 'PLACED_BY', o_custkey * 8 + 2, '' FROM orders
  UNION ALL SELECT l_orderkey * 8 + 5, 'CONTAINS', l_partkey * 8 + 4, 'flag=' || l_returnflag FROM lineitem
  UNION ALL SELECT l_suppkey * 8 + 3, 'SUPPLIES', l_partkey * 8 + 4, '' FROM lineitem
),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT 7::BIGINT * 8 + 1 AS v, 0 AS d
  UNION SELECT e.b, r.d + 1 FROM reach r JOIN both_ways e ON e.a = r.v WHERE r.d < 10
),
dist AS (SELECT v, min(d) AS d FROM reach GROUP BY v)
"""
_NODES = """
nodes AS (
  SELECT r_regionkey::BIGINT * 8 AS v, 'Region' AS label, 'id=' || r_regionkey || ',name=' || r_name AS p FROM region
  UNION ALL SELECT n_nationkey::BIGINT * 8 + 1, 'Nation', 'id=' || n_nationkey || ',name=' || n_name FROM nation
  UNION ALL SELECT c_custkey * 8 + 2, 'Customer', 'id=' || c_custkey || ',name=' || c_name || ',segment=' || c_mktsegment FROM customer
  UNION ALL SELECT s_suppkey * 8 + 3, 'Supplier', 'id=' || s_suppkey || ',name=' || s_name FROM supplier
  UNION ALL SELECT p_partkey * 8 + 4, 'Part', 'brand=' || p_brand || ',id=' || p_partkey || ',name=' || p_name FROM part
  UNION ALL SELECT o_orderkey * 8 + 5, 'Order', 'id=' || o_orderkey || ',status=' || o_orderstatus FROM orders
)
"""
_HIERARCHY = f"""
WITH RECURSIVE {_NODES},
edges AS (
  SELECT n_regionkey::BIGINT * 8 AS parent, n_nationkey::BIGINT * 8 + 1 AS child FROM nation
  UNION SELECT c_nationkey::BIGINT * 8 + 1, c_custkey * 8 + 2 FROM customer
  UNION SELECT s_nationkey::BIGINT * 8 + 1, s_suppkey * 8 + 3 FROM supplier
  UNION SELECT o_custkey * 8 + 2, o_orderkey * 8 + 5 FROM orders
  UNION SELECT l_orderkey * 8 + 5, l_partkey * 8 + 4 FROM lineitem
  UNION SELECT l_suppkey * 8 + 3, l_partkey * 8 + 4 FROM lineitem
),
walk AS (
  SELECT v AS name, 0 AS level FROM nodes WHERE v NOT IN (SELECT child FROM edges)
  UNION SELECT e.child, w.level + 1 FROM walk w JOIN edges e ON e.parent = w.name
),
levels AS (SELECT name, max(level) AS level FROM walk GROUP BY name)
"""


def _paths(start: str, depth: int) -> str:
    return f"""
WITH RECURSIVE lines AS (
  SELECT *, row_number() OVER (ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity) AS r FROM lineitem),
links AS MATERIALIZED (
  SELECT n_nationkey::BIGINT * 8 AS e, n_nationkey::BIGINT * 8 + 1 AS a, n_regionkey::BIGINT * 8 AS b FROM nation
  UNION ALL SELECT c_custkey * 8 + 1, c_custkey * 8 + 2, c_nationkey::BIGINT * 8 + 1 FROM customer
  UNION ALL SELECT s_suppkey * 8 + 2, s_suppkey * 8 + 3, s_nationkey::BIGINT * 8 + 1 FROM supplier
  UNION ALL SELECT o_orderkey * 8 + 3, o_orderkey * 8 + 5, o_custkey * 8 + 2 FROM orders
  UNION ALL SELECT r * 8 + 4, l_orderkey * 8 + 5, l_partkey * 8 + 4 FROM lines
  UNION ALL SELECT r * 8 + 5, l_suppkey * 8 + 3, l_partkey * 8 + 4 FROM lines
),
both_ways AS (SELECT e, a, b FROM links UNION ALL SELECT e, b, a FROM links),
walk AS (
  SELECT c_custkey * 8 + 2 AS s, c_custkey * 8 + 2 AS v, CAST([] AS BIGINT[]) AS path, 0 AS depth FROM customer WHERE {start}
  UNION ALL
  SELECT w.s, x.b, list_append(w.path, x.e), w.depth + 1 FROM walk w JOIN both_ways x ON x.a = w.v
  WHERE w.depth < {depth} AND NOT list_contains(w.path, x.e)
)
SELECT s AS start_id, v AS end_id, array_to_string(path, '-') AS path, depth FROM (
  SELECT * FROM walk WHERE depth > 0 ORDER BY depth, path, s LIMIT 1000)
"""


def _trade_sql(place: str) -> str:
    return f"""
sold AS (
  SELECT {place.format('b')} AS parent, {place.format('s')} AS child, year(l_shipdate) AS y
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation b ON c_nationkey = b.n_nationkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation s ON s_nationkey = s.n_nationkey
),
trade AS MATERIALIZED (SELECT DISTINCT parent, child FROM sold)
"""


_NATIONS = _trade_sql("{}.n_name")
_REGIONS = _trade_sql("'R' || {}.n_regionkey")
_YEARS = """
links AS MATERIALIZED (SELECT DISTINCT parent || '@' || y AS a, child || '@' || y AS b FROM sold UNION SELECT parent || '@' || y, parent || '@' || (y + 1) FROM sold),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
"""
# every cycle from its smallest member
_CYCLES = """
walks AS (SELECT [parent, child] AS m FROM trade WHERE child >= parent
  UNION ALL SELECT list_append(w.m, t.child) FROM walks w JOIN trade t ON t.parent = w.m[len(w.m)]
  WHERE w.m[len(w.m)] <> w.m[1] AND t.child >= w.m[1] AND (t.child = w.m[1] OR NOT list_contains(w.m, t.child))),
cycles AS (SELECT m[1:len(m) - 1] AS m FROM walks WHERE m[1] = m[len(m)]),
degree AS (SELECT parent, count(*) AS n FROM trade GROUP BY parent),
members AS (SELECT m, unnest(m) AS v, unnest(range(1, len(m) + 1)) AS i FROM cycles),
ranked AS (SELECT m, v, i, coalesce(n, 0) AS n, row_number() OVER (PARTITION BY m ORDER BY coalesce(n, 0), i) AS r
  FROM members LEFT JOIN degree ON v = parent)
"""
# an edge up closes a cycle over nodes that come after its start
_BREAKS = """
rank AS MATERIALIZED (SELECT name, coalesce(n, 0) AS n, row_number() OVER (ORDER BY coalesce(n, 0), name) AS r
  FROM (SELECT parent AS name FROM trade UNION SELECT child FROM trade) LEFT JOIN (SELECT parent, count(*) AS n FROM trade GROUP BY parent) ON parent = name),
steps AS MATERIALIZED (SELECT parent, child, f.r AS fr, f.n AS n, t.r AS tr FROM trade JOIN rank f ON f.name = parent JOIN rank t ON t.name = child),
away AS (SELECT parent AS a, child AS b, fr AS least, child AS head FROM steps WHERE fr <= tr
  UNION SELECT w.a, w.b, w.least, s.child FROM away w JOIN steps s ON s.parent = w.head WHERE s.tr >= w.least),
breaks AS (SELECT DISTINCT a, b FROM away WHERE head = a)
"""
_LEVELS = """
kept AS (SELECT parent, child FROM trade WHERE NOT EXISTS (SELECT 1 FROM breaks WHERE a = parent AND b = child)),
names AS (SELECT parent AS name FROM trade UNION SELECT child FROM trade),
walk AS (SELECT name, 0 AS level FROM names WHERE name NOT IN (SELECT child FROM kept)
  UNION SELECT child, level + 1 FROM walk JOIN kept ON parent = name)
SELECT name, max(level) AS level FROM walk GROUP BY name
"""


def _inferred(child: str, column: str, table: str, parent: str | None, parent_sql: str | None) -> str:
    if parent is None:
        return f"""SELECT '{child}' AS child_table, '{column}' AS column_name, CAST(NULL AS VARCHAR) AS parent_table,
            count(DISTINCT k) AS distinct_values, CAST(NULL AS BIGINT) AS orphans, 'SKIPPED' AS status FROM ({table})"""
    return f"""SELECT '{child}' AS child_table, '{column}' AS column_name, '{parent}' AS parent_table, count(*) AS distinct_values,
        count(*) FILTER (WHERE id IS NULL) AS orphans,
        CASE WHEN count(*) FILTER (WHERE id IS NULL) = 0 THEN 'VERIFIED' ELSE 'VIOLATED' END AS status
        FROM (SELECT DISTINCT k FROM ({table})) LEFT JOIN (SELECT DISTINCT id FROM ({parent_sql})) ON k = id"""


_INFERENCE = " UNION ALL ".join(
    _inferred(*row)
    for row in (
        ("nations", "region_id", "SELECT n_regionkey AS k FROM nation", "regions", "SELECT r_regionkey AS id FROM region"),
        ("customers", "nation_id", "SELECT c_nationkey AS k FROM customer", "nations", "SELECT n_nationkey AS id FROM nation"),
        ("suppliers", "nation_id", "SELECT s_nationkey AS k FROM supplier", "nations", "SELECT n_nationkey AS id FROM nation"),
        ("orders", "customer_id", "SELECT o_custkey AS k FROM orders", "customers", "SELECT c_custkey AS id FROM customer"),
        ("lines", "order_id", "SELECT l_orderkey AS k FROM lineitem", "orders", "SELECT o_orderkey AS id FROM orders"),
        ("lines", "part_id", "SELECT l_partkey AS k FROM lineitem", "parts", "SELECT p_partkey AS id FROM part"),
        ("lines", "supplier_id", "SELECT l_suppkey AS k FROM lineitem", "suppliers", "SELECT s_suppkey AS id FROM supplier"),
        ("events", "user_id", "SELECT user_id AS k FROM events", None, None),
        ("events", "supplier_id", "SELECT user_id AS k FROM events", "suppliers", "SELECT s_suppkey AS id FROM supplier"),
        ("labels", "document_id", "SELECT doc_id AS k FROM labels", "documents", "SELECT doc_id AS id FROM documents"),
        ("documents", "label_id", "SELECT doc_id AS k FROM documents", "labels", "SELECT doc_id AS id FROM labels"),
    )
)

QUERIES = {
    "khop_nodes": khop_nodes,
    "khop_edges": khop_edges,
    "path_enumeration": path_enumeration,
    "path_enumeration_deep": path_enumeration_deep,
    "graph_schema": graph_schema,
    "topological_levels": topological_levels,
    "reverse_order": reverse_order,
    "order_by_store": order_by_store,
    "graph_totals": graph_totals,
    "foreign_key_inference": foreign_key_inference,
    "dependency_order": dependency_order,
    "cycle_core": cycle_core,
    "simple_cycles": simple_cycles,
    "break_points": break_points,
    "order_with_breaks": order_with_breaks,
    "strong_components": strong_components,
    "cycle_breaks": cycle_breaks,
    "order_of_all": order_of_all,
    "schema_drift": schema_drift,
}

SQL = {
    "khop_nodes": f"WITH RECURSIVE {_LINKS}, {_NODES} SELECT v AS node_id, label, p AS properties, d AS dist FROM dist JOIN nodes USING (v)",
    "khop_edges": f"""WITH RECURSIVE {_LINKS}, near AS (SELECT v FROM dist WHERE d <= 9)
        SELECT DISTINCT a AS start_id, t AS type, b AS end_id, p AS properties FROM links
        WHERE a IN (SELECT v FROM near) OR b IN (SELECT v FROM near)""",
    "path_enumeration": _paths("c_mktsegment = 'BUILDING'", 3),
    "path_enumeration_deep": _paths("c_custkey = 7", 3),
    "graph_schema": """
        SELECT 'label' AS kind, label AS name, count(*) AS uses FROM (
          SELECT 'Region' AS label FROM region UNION ALL SELECT 'Nation' FROM nation UNION ALL SELECT 'Customer' FROM customer
          UNION ALL SELECT 'Supplier' FROM supplier UNION ALL SELECT 'Part' FROM part UNION ALL SELECT 'Order' FROM orders) GROUP BY label
        UNION ALL SELECT 'relationship_type', 'IN_REGION', count(*) FROM nation
        UNION ALL SELECT 'relationship_type', 'IN_NATION', (SELECT count(*) FROM customer) + (SELECT count(*) FROM supplier)
        UNION ALL SELECT 'relationship_type', 'PLACED_BY', count(*) FROM orders
        UNION ALL SELECT 'relationship_type', 'CONTAINS', count(*) FROM lineitem
        UNION ALL SELECT 'relationship_type', 'SUPPLIES', count(*) FROM lineitem
        UNION ALL SELECT 'edge_property', 'flag', count(*) FROM lineitem
        UNION ALL SELECT 'node_property', 'status', count(*) FROM orders
        UNION ALL SELECT 'node_property', 'brand', count(*) FROM part
        UNION ALL SELECT 'node_property', 'segment', count(*) FROM customer
        UNION ALL SELECT 'node_property', 'name', (SELECT count(*) FROM region) + (SELECT count(*) FROM nation)
          + (SELECT count(*) FROM customer) + (SELECT count(*) FROM supplier) + (SELECT count(*) FROM part)
        UNION ALL SELECT 'node_property', 'id', (SELECT count(*) FROM region) + (SELECT count(*) FROM nation) + (SELECT count(*) FROM customer)
          + (SELECT count(*) FROM supplier) + (SELECT count(*) FROM part) + (SELECT count(*) FROM orders)
    """,
    "topological_levels": f"{_HIERARCHY} SELECT name, level FROM levels",
    "reverse_order": f"{_HIERARCHY} SELECT name, level, row_number() OVER (ORDER BY level DESC, name) AS position FROM levels",
    "order_by_store": f"""{_HIERARCHY},
        keyed AS (SELECT label AS store, CAST((v - v % 8) // 8 AS VARCHAR) AS table_name, level FROM levels JOIN nodes ON name = v)
        SELECT store, table_name, level, row_number() OVER (PARTITION BY store ORDER BY level, table_name) AS position FROM keyed""",
    "graph_totals": """
        SELECT (SELECT count(*) FROM region) + (SELECT count(*) FROM nation) + (SELECT count(*) FROM customer)
          + (SELECT count(*) FROM supplier) + (SELECT count(*) FROM part) + (SELECT count(*) FROM orders) AS total_tables,
          (SELECT count(*) FROM nation) + (SELECT count(*) FROM customer) + (SELECT count(*) FROM supplier) + (SELECT count(*) FROM orders)
          + 2 * (SELECT count(*) FROM lineitem) AS total_relationships
    """,
    "foreign_key_inference": _INFERENCE,
    "dependency_order": f"""
        WITH RECURSIVE keys AS (SELECT 'dw.public.' || child_table AS child, 'dw.public.' || parent_table AS parent
          FROM ({_INFERENCE}) WHERE status = 'VERIFIED'),
        names AS (SELECT 'dw.public.' || unnest(['regions', 'nations', 'customers', 'suppliers', 'parts', 'orders', 'lines', 'events', 'labels', 'documents']) AS name),
        walk AS (SELECT name, 0 AS level FROM names WHERE name NOT IN (SELECT child FROM keys)
          UNION SELECT child, level + 1 FROM walk JOIN keys ON parent = name)
        SELECT name, max(level) AS level FROM walk GROUP BY name
    """,
    "cycle_core": f"""
        WITH RECURSIVE {_NATIONS},
        reach AS (SELECT parent AS a, child AS b FROM trade UNION SELECT r.a, t.child FROM reach r JOIN trade t ON r.b = t.parent),
        ring AS (SELECT a AS v FROM reach WHERE a = b)
        SELECT DISTINCT n_name AS name FROM nation
        WHERE n_name IN (SELECT v FROM ring)
           OR (n_name IN (SELECT b FROM reach WHERE a IN (SELECT v FROM ring)) AND n_name IN (SELECT a FROM reach WHERE b IN (SELECT v FROM ring)))
    """,
    "simple_cycles": f"""WITH RECURSIVE {_REGIONS}, {_CYCLES}
        SELECT array_to_string(list_append(m, m[1]), '>') AS cycle, CAST(len(m) AS INTEGER) AS length FROM cycles""",
    "break_points": f"""WITH RECURSIVE {_REGIONS}, {_CYCLES}
        SELECT array_to_string(list_append(m, m[1]), '>') AS cycle, v AS break_from, m[i % len(m) + 1] AS break_to, n AS affected
        FROM ranked WHERE r = 1""",
    "order_with_breaks": f"""WITH RECURSIVE {_REGIONS}, {_CYCLES},
        breaks AS (SELECT DISTINCT v AS a, m[i % len(m) + 1] AS b FROM ranked WHERE r = 1), {_LEVELS}""",
    "strong_components": f"""WITH RECURSIVE {_NATIONS}, {_YEARS},
        mutual AS (SELECT a, b FROM reach WHERE (b, a) IN (SELECT (a, b) FROM reach) UNION SELECT a, a FROM links UNION SELECT b, b FROM links)
        SELECT a AS name, min(b) AS component, count(*) AS size FROM mutual GROUP BY a""",
    "cycle_breaks": f"""WITH RECURSIVE {_NATIONS}, {_BREAKS}
        SELECT a AS break_from, b AS break_to, n AS affected FROM breaks JOIN rank ON name = a""",
    "order_of_all": f"WITH RECURSIVE {_NATIONS}, {_BREAKS}, {_LEVELS}",
    "schema_drift": """
        WITH b AS (SELECT p_brand AS t, p_name AS c, max(p_size) AS w FROM lineitem JOIN part ON l_partkey = p_partkey
          WHERE l_shipdate < DATE '1996-01-01' GROUP BY 1, 2),
        a AS (SELECT p_brand AS t, p_name AS c, max(p_size) AS w FROM lineitem JOIN part ON l_partkey = p_partkey
          WHERE l_shipdate >= DATE '2001-01-01' GROUP BY 1, 2)
        SELECT coalesce(b.t, a.t) AS table_name, coalesce(b.c, a.c) AS column_name,
          CASE WHEN b.t IS NULL THEN 'added' WHEN a.t IS NULL THEN 'removed' ELSE 'changed' END AS change
        FROM b FULL OUTER JOIN a ON b.t = a.t AND b.c = a.c WHERE b.t IS NULL OR a.t IS NULL OR a.w <> b.w
    """,
}
