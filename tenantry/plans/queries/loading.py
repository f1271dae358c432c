"""Loads, removals, comparisons and whole migrations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenantry.model import AnonymizationRule, BusinessRule, ForeignKey, RelationRule, RequiredFields, SchemaRule, StoreRule, Tables
from tenantry.operators import extract, load, reconcile
from tenantry.operators.anonymize import MAP_BY, Anonymizer, resolve, stored_entries
from tenantry.operators.load import Target
from tenantry.plans import migrate
from tenantry.plans.bindings import AS_OF, KEYS, LINE_KEY, SALT, STORE_OF, property_graph, reader, tables
from tenantry.plans.default_rules import ANONYMIZATION_RULES, EMAIL_FORMAT, PHONE_FORMAT
from tenantry.plans.queries.anonymizing import made_sql
from tenantry.plans.queries.extraction import ALL_TABLES, NATION
from tenantry.skew import look_up
from tenantry.sources.graph import entries_text
from tenantry.state import new_folder

PRIMARY_KEYS = {
    "region": ["r_regionkey"],
    "nation": ["n_nationkey"],
    "customer": ["c_custkey"],
    "supplier": ["s_suppkey"],
    "part": ["p_partkey"],
    "orders": ["o_orderkey"],
    "lineitem": LINE_KEY,
}


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    return reader(spark, folder)("orders").select(*columns, F.col("o_orderdate").cast("date").alias("day"))


def _old_and_new(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Orders up to 1997 as the target; orders from 1997 on, partly changed, as the batch."""
    orders = _orders(spark, folder)
    target = orders.filter("day < DATE'1998-01-01'").drop("day")
    batch = orders.filter("day >= DATE'1997-01-01'").drop("day")
    batch = batch.withColumns(
        {
            "o_orderstatus": F.nullif("o_orderstatus", F.lit("P")),
            "o_totalprice": F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice") * 2).otherwise(F.col("o_totalprice") / 2),
            "o_orderpriority": F.upper(F.concat("o_orderpriority", F.lit("!"))),
        }
    )
    return target, batch


def insert_append(spark: SparkSession, folder: str) -> DataFrame:
    orders = _orders(spark, folder)
    before, after = orders.filter("day < DATE'1998-01-01'"), orders.filter("day >= DATE'1998-01-01'")
    return load.insert(before, after, ["o_orderkey"]).drop("day")


def key_conflicts(spark: SparkSession, folder: str) -> DataFrame:
    target, batch = _old_and_new(spark, folder)
    return load.conflicting_keys(target, batch, ["o_orderkey"])


def upsert(spark: SparkSession, folder: str) -> DataFrame:
    target, batch = _old_and_new(spark, folder)
    return load.upsert(target, batch, ["o_orderkey"])


def upsert_latest(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines repeat their key; the last shipped line of a key wins."""
    columns = ["l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity"]
    lines = reader(spark, folder)("lineitem").select(*columns)
    key, order = ["l_orderkey", "l_linenumber"], ["l_shipdate"]
    early = load.latest_rows(lines.filter("l_shipdate < TIMESTAMP_NTZ'1998-07-01'"), key, order)
    merged = load.upsert(early, lines.filter("l_shipdate >= TIMESTAMP_NTZ'1998-01-01'"), key, order)
    return merged.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))


def merge_policies(spark: SparkSession, folder: str) -> DataFrame:
    target, batch = _old_and_new(spark, folder)
    policies = {"o_orderstatus": "coalesce", "o_totalprice": "greatest", "o_orderpriority": "keep"}
    return load.merge(target, batch, ["o_orderkey"], policies)


def choose_strategy(spark: SparkSession, folder: str) -> DataFrame:
    t = reader(spark, folder)
    nation_of = t("customer").select("c_custkey", F.col("c_nationkey").alias("nation"))
    orders = look_up(_orders(spark, folder), nation_of, [("o_custkey", "c_custkey")])
    held = {
        "customer": t("customer").withColumnRenamed("c_nationkey", "nation"),
        "orders": orders.filter("day < DATE'1997-01-01'"),
        "supplier": t("supplier").withColumnRenamed("s_nationkey", "nation").filter("s_acctbal < -999999"),
    }
    subset = extract.extract_dataset(tables(spark, folder, *ALL_TABLES), KEYS, {}, tenant_columns=NATION)
    arriving = extract.manifest({n: subset[n] for n in ("customer", "orders", "supplier", "lineitem")})
    return load.strategies(load.existing_rows(held, "nation", 7), arriving.select("table_name", "rows"))


def node_upsert(spark: SparkSession, folder: str) -> DataFrame:
    nodes = property_graph(spark, folder).nodes
    customer = F.array_contains("labels", "Customer")
    new = nodes.filter(customer | F.array_contains("labels", "Supplier")).select(
        F.when(customer, F.col("node_id")).otherwise(F.col("node_id") + 3).alias("node_id"),
        "labels",
        F.create_map(
            F.lit("id"), F.col("properties")["id"], F.lit("_source"), F.lit("import"), F.lit("segment"), F.nullif(F.col("properties")["segment"], F.lit("BUILDING")),
        ).alias("properties"),
    )
    merged = load.upsert_nodes(nodes, new)
    return merged.select("node_id", F.col("labels")[0].alias("label"), entries_text(F.col("properties")).alias("properties"))


def edge_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Lines shipped late replace the flags of the same order and part; events only count for existing suppliers."""
    graph = property_graph(spark, folder)
    t = reader(spark, folder)
    key = ["start_id", "type", "end_id"]
    flags = t("lineitem").filter("l_shipdate >= TIMESTAMP_NTZ'1999-01-01'").select(
        (F.col("l_orderkey") * 8 + 5).alias("start_id"),
        F.lit("CONTAINS").alias("type"),
        (F.col("l_partkey") * 8 + 4).alias("end_id"),
        F.create_map(F.lit("flag"), F.col("l_returnflag")).alias("properties"),
    )
    seen = t("events").select(
        (F.col("user_id") * 8 + 2).alias("start_id"),
        F.lit("SAW").alias("type"),
        (F.col("user_id") * 8 + 3).alias("end_id"),
        F.create_map(F.lit("event"), F.col("event_type")).alias("properties"),
    )
    placed = t("orders").filter("o_orderdate >= TIMESTAMP_NTZ'1999-01-01'").select(
        (F.col("o_orderkey") * 8 + 5).alias("start_id"),
        F.lit("PLACED_BY").alias("type"),
        (F.col("o_custkey") * 8 + 2).alias("end_id"),
        F.create_map(F.lit("status"), F.col("o_orderstatus")).alias("properties"),
    )
    merged = load.upsert_edges(graph.edges, flags.unionByName(seen).unionByName(placed), graph.nodes)
    return merged.select(*key, entries_text(F.col("properties")).alias("properties"))


def _rest(spark: SparkSession, folder: str) -> Tables:
    return load.without_tenant(tables(spark, folder, *ALL_TABLES), KEYS, {}, tenant_columns=NATION)


def rollback(spark: SparkSession, folder: str) -> DataFrame:
    """Rows left, and the sum of their keys, after one nation is taken out."""
    parts = []
    for name, df in _rest(spark, folder).items():
        key = F.sum(F.col(PRIMARY_KEYS[name][0]).cast("bigint"))
        parts.append(df.agg(F.count(F.lit(1)).alias("rows"), key.alias("keys")).select(F.lit(name).alias("table_name"), "rows", "keys"))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _staff(spark: SparkSession, folder: str) -> tuple[Tables, list[ForeignKey]]:
    """Customers as staff in chains of command of sixteen across nations, with their orders."""
    t = reader(spark, folder)
    boss = F.when(F.col("c_custkey") % 16 != 0, F.col("c_custkey") - 1).alias("boss_id")
    staff = t("customer").select(F.col("c_custkey").alias("id"), boss, F.col("c_nationkey").alias("nation"))
    orders = t("orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("staff_id"))
    keys = [ForeignKey.of("staff", "boss_id", "staff"), ForeignKey.of("staff", "nation", "nation", "n_nationkey"), ForeignKey.of("orders", "staff_id", "staff")]
    return {"staff": staff, "orders": orders, "nation": t("nation")}, keys


def _listed(found: Tables) -> DataFrame:
    names = {"staff": "id", "orders": "id", "nation": "n_nationkey"}
    return reduce(DataFrame.unionByName, [found[n].select(F.lit(n).alias("table_name"), F.col(c).cast("bigint").alias("id")) for n, c in names.items()])


def extract_hierarchy(spark: SparkSession, folder: str) -> DataFrame:
    """The staff of a nation with all bosses above them, and the orders of the staff itself."""
    data, keys = _staff(spark, folder)
    return _listed(extract.extract_dataset(data, keys, {"nation": 7}))


def remove_hierarchy(spark: SparkSession, folder: str) -> DataFrame:
    """What is left without the staff of a nation, all staff below them, and the orders of both."""
    data, keys = _staff(spark, folder)
    return _listed(load.without_tenant(data, keys, {"nation": 7}))


def residual(spark: SparkSession, folder: str) -> DataFrame:
    return load.residual(_rest(spark, folder), KEYS, {}, tenant_columns=NATION)


def _history(target: Target, names: list[str]) -> list[DataFrame]:
    version = target.version()
    return [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(version).alias("version"), F.lit(name).alias("table_name"), "rows")
        for name, df in target.read().items()
        if name in names
    ]


def versioned_load(spark: SparkSession, folder: str) -> DataFrame:
    """All tables: insert, upsert, go back to the first version, remove a nation, load it again."""
    target = Target(spark, new_folder(spark, "target"))
    data = tables(spark, folder, *ALL_TABLES)
    early = data["orders"].filter("o_orderdate < TIMESTAMP_NTZ'1998-01-01'")
    late = data["orders"].filter("o_orderdate >= TIMESTAMP_NTZ'1997-01-01'")
    nothing = data["orders"].filter("o_totalprice < -1")
    names = ["customer", "orders", "lineitem"]
    first = {**data, "orders": early}
    load.load_dataset(target, {**first, "empty": nothing}, {**PRIMARY_KEYS, "empty": ["o_orderkey"]})
    steps = _history(target, names)
    load.load_dataset(target, {"orders": late}, PRIMARY_KEYS, "upsert")
    steps += _history(target, names)
    target.restore(1)
    steps += _history(target, names)
    load.remove_tenant(target, KEYS, {}, tenant_columns=NATION)
    steps += _history(target, names)
    subset = extract.extract_dataset(first, KEYS, {}, tenant_columns=NATION)
    load.reload_tenant(target, subset, KEYS, {}, PRIMARY_KEYS, tenant_columns=NATION)
    steps += _history(target, names)
    result = steps[0]
    for step in steps[1:]:
        result = result.unionByName(step)
    return result


def incremental_load(spark: SparkSession, folder: str) -> DataFrame:
    """What each version of tables kept by nation and by status holds, and how many rows were written for it."""
    t = reader(spark, folder)
    target = Target(spark, new_folder(spark, "target"), {"customer": "c_nationkey", "orders": "o_orderstatus"})
    orders, customers = t("orders"), t("customer")
    early, late = orders.filter("o_orderdate < TIMESTAMP_NTZ'1998-01-01'"), orders.filter("o_orderdate >= TIMESTAMP_NTZ'1998-01-01'")
    load.load_dataset(target, {"customer": customers, "orders": early}, PRIMARY_KEYS)
    load.load_dataset(target, {"orders": late}, PRIMARY_KEYS)
    paid = orders.filter("o_orderstatus = 'P'").withColumn("o_totalprice", F.lit(0.0))
    load.load_dataset(target, {"orders": paid}, PRIMARY_KEYS, "upsert")
    load.remove_tenant(target, [], {}, tenant_columns={"customer": {"c_nationkey": 7}})
    target.compact(1)
    parts, seen = [], set()
    for version in range(1, target.version() + 1):
        now = target.folders(version)
        for name, df in target.read(version).items():
            added = [f.path for f in now[name] if f not in seen]
            seen |= set(now[name])
            written = spark.read.schema(df.schema).option("recursiveFileLookup", True).parquet(*[f"{target.root}/{p}" for p in added]) if added else df.limit(0)
            # as every version is read after the last one was made, it has to be as it was
            held = df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("o_totalprice" if name == "orders" else "c_custkey"), F.lit(0)).cast("decimal(20,2)").cast("double").alias("total"))
            parts.append(held.select(F.lit(version).alias("version"), F.lit(name).alias("table_name"), "rows", "total", F.lit(written.count()).cast("long").alias("written")))
    return reduce(DataFrame.unionByName, parts)


def _before_after(spark: SparkSession, folder: str) -> tuple[Tables, Tables]:
    """The tables, and the same with orders replaced by an upsert and lines of one flag lost."""
    t = reader(spark, folder)
    source = {"customer": t("customer"), "orders": _orders(spark, folder).drop("day"), "lineitem": t("lineitem")}
    target, batch = _old_and_new(spark, folder)
    changed = load.upsert(target, batch, ["o_orderkey"])
    return source, {"customer": t("customer"), "orders": changed, "lineitem": t("lineitem").filter("l_returnflag <> 'R'"), "extra": t("nation")}


def count_check(spark: SparkSession, folder: str) -> DataFrame:
    return reconcile.compare_counts(*_before_after(spark, folder))


def checksum_check(spark: SparkSession, folder: str) -> DataFrame:
    return reconcile.compare_checksums(*_before_after(spark, folder))


def fan_out_check(spark: SparkSession, folder: str) -> DataFrame:
    keys = [k for k in KEYS if (k.child, k.parent) in (("orders", "customer"), ("lineitem", "orders"))]
    return reconcile.compare_fan_out(*_before_after(spark, folder), keys)


def distribution_check(spark: SparkSession, folder: str) -> DataFrame:
    source, target = _before_after(spark, folder)
    parts = []
    for name, bucket in (("orders", F.col("o_orderpriority")), ("orders", F.col("o_orderstatus")), ("lineitem", F.floor(F.col("l_quantity") / 10))):
        found = reconcile.share_distance(source[name], target[name], bucket)
        parts.append(found.select(F.lit(f"{name} {len(parts)}").alias("name"), "buckets", F.round("distance", 9).alias("distance")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def quantile_check(spark: SparkSession, folder: str) -> DataFrame:
    source, target = _before_after(spark, folder)
    return reconcile.quantile_gaps(source["orders"], target["orders"], "o_totalprice", (0.1, 0.25, 0.5, 0.75, 0.9))


def row_differences(spark: SparkSession, folder: str) -> DataFrame:
    source, target = _before_after(spark, folder)
    orders = reconcile.row_differences(source["orders"], target["orders"], ["o_orderkey"])
    lines = reconcile.row_differences(source["lineitem"], target["lineitem"], ["l_orderkey", "l_linenumber"])
    return orders.select(F.lit("orders").alias("table_name"), F.col("o_orderkey").alias("key"), "change", F.concat_ws(",", "columns").alias("columns")).unionByName(
        lines.groupBy("change").agg(F.count(F.lit(1)).alias("key")).select(F.lit("lineitem").alias("table_name"), "key", "change", F.lit("").alias("columns"))
    )


def _source(spark: SparkSession, folder: str) -> Tables:
    """The tables with personal data under names that the rules know."""
    data = tables(spark, folder, *ALL_TABLES)
    name = F.col("c_name")
    data["customer"] = data["customer"].select(
        "c_custkey",
        name.alias("c_full_name"),
        F.concat(F.lower(name), F.lit("@corp.example.com")).alias("c_email"),
        F.col("c_custkey").cast("string").alias("c_phone"),
        "c_nationkey",
        "c_acctbal",
        "c_mktsegment",
    )
    data["supplier"] = data["supplier"].withColumnRenamed("s_name", "s_full_name")
    return data


def migration_plan(**options) -> migrate.Plan:
    return migrate.Plan(
        keys=KEYS,
        primary_keys=PRIMARY_KEYS,
        where={},
        anonymizer=Anonymizer(ANONYMIZATION_RULES, SALT, AS_OF),
        tenant_columns=NATION,
        rules=(
            BusinessRule("email_format_valid", "customer", f"c_email RLIKE r'{EMAIL_FORMAT}' OR c_email IS NULL", "WARNING"),
            BusinessRule("phone_format_valid", "customer", f"c_phone RLIKE '{PHONE_FORMAT}' OR c_phone IS NULL", "WARNING"),
            BusinessRule("balance_positive", "customer", "c_acctbal >= 0", "WARNING"),
        ),
        required=(RequiredFields("order_fields", "orders", ("o_orderkey", "o_custkey"), "ERROR"),),
        schemas=(SchemaRule("orders", {"o_orderkey": "bigint"}, ("o_custkey",), {"o_totalprice": (0, 10**9)}),),
        relations=(
            RelationRule("orders_have_lines", KEYS[4]),
            RelationRule("minimum_lines", KEYS[4], minimum=3),
            RelationRule("line_status_matches", KEYS[4], (("l_linestatus", "o_orderstatus"),)),
            RelationRule("customers_have_orders", KEYS[3]),
        ),
        stores=(StoreRule("customers_everywhere", {"customer": "c_custkey", "orders": "o_custkey"}),),
        **options,
    )


def migrate_tenant(spark: SparkSession, folder: str) -> DataFrame:
    """One nation end to end; the metrics of the run without its times."""
    target = Target(spark, new_folder(spark, "target"))
    result = migrate.migrate_tenant(_source(spark, folder), migration_plan(), target)
    return result.metrics.select("phase", "table_name", "rows", "fields", "success", "warnings")


def remembered_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Customers of two nations, the first moved twice, with one map: tokens, what they stand for, and how many names share a surrogate.

    Later runs have another salt, but what the map has already stays.
    """
    data = _source(spark, folder)
    customers = data["customer"].withColumn("c_code", (F.col("c_custkey") % 97).cast("string"))
    data = {"nation": data["nation"], "customer": customers}
    rules = (AnonymizationRule("codes", "c_code", "tokenize"), *ANONYMIZATION_RULES)
    maps, target = Target(spark, new_folder(spark, "maps"), MAP_BY), Target(spark, new_folder(spark, "target"))
    for nation, salt in ((7, SALT), (8, "later"), (7, "later")):
        own = {"nation": {"n_nationkey": nation}}
        plan = migrate.Plan(KEYS[1:2], PRIMARY_KEYS, {}, Anonymizer(rules, salt, AS_OF), own, strategy="upsert", reviewed=True)
        migrate.migrate_tenant(data, plan, target, maps=maps)
    moved = target.read()["customer"].select("c_custkey", F.col("c_code").alias("token"), "c_full_name", "c_code")
    resolved = resolve(moved, rules, maps).withColumnRenamed("c_code", "code")
    names = stored_entries(maps, "full_names").filter("rule = 'full_names'").select(F.col("surrogate").alias("c_full_name"))
    return look_up(resolved, names.groupBy("c_full_name").agg(F.count(F.lit(1)).alias("entries")), [("c_full_name", "c_full_name")])


def validate_migration(spark: SparkSession, folder: str) -> DataFrame:
    """What was loaded against what should have been; phones were tampered with on the way."""
    target = Target(spark, new_folder(spark, "target"))
    plan = migration_plan()
    result = migrate.migrate_tenant(_source(spark, folder), plan, target)
    loaded = target.read()
    loaded["customer"] = loaded["customer"].withColumn("c_phone", F.when(F.col("c_acctbal") < 0, F.lit("none")).otherwise(F.col("c_phone")))
    checks = migrate.validate_migration(result.tables, loaded, plan)
    unequal = lambda part, name: checks[part].filter("NOT equal").select(F.lit(part).alias("part"), name.alias("name"))
    failed = checks["findings"].filter("failed > 0").select(F.lit("findings").alias("part"), F.col("rule").alias("name"))
    return (
        failed.unionByName(unequal("counts", F.col("table_name")))
        .unionByName(unequal("checksums", F.col("table_name")))
        .unionByName(unequal("fan_out", F.col("table_name")))
    )


# --- the same in SQL ------------------------------------------------------------

_BATCH = """
old AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders WHERE o_orderdate < DATE '1998-01-01'),
new AS (SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus,
    CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice / 2 END AS o_totalprice, upper(o_orderpriority || '!') AS o_orderpriority
  FROM orders WHERE o_orderdate >= DATE '1997-01-01'),
done AS (SELECT * FROM old WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new) UNION ALL SELECT * FROM new),
src AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders)
"""
_SUBSET = """
n AS (SELECT * FROM nation WHERE n_nationkey = 7),
c AS (SELECT * FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM n)),
s AS (SELECT * FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM n)),
o AS (SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM c)),
l AS (SELECT * FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM o) AND l_suppkey IN (SELECT s_suppkey FROM s)),
p AS (SELECT * FROM part WHERE p_partkey IN (SELECT l_partkey FROM l)),
r AS (SELECT * FROM region WHERE r_regionkey IN (SELECT n_regionkey FROM n)),
counts AS (
  SELECT 'region' AS table_name, count(*) AS "rows", 0 AS fields FROM r UNION ALL SELECT 'nation', count(*), 0 FROM n
  UNION ALL SELECT 'customer', count(*), 3 FROM c UNION ALL SELECT 'supplier', count(*), 1 FROM s
  UNION ALL SELECT 'part', count(*), 0 FROM p UNION ALL SELECT 'orders', count(*), 0 FROM o UNION ALL SELECT 'lineitem', count(*), 0 FROM l
)
"""
_GONE = """
n AS (SELECT n_nationkey FROM nation WHERE n_nationkey = 7),
c AS (SELECT c_custkey FROM customer WHERE c_nationkey IN (FROM n)),
s AS (SELECT s_suppkey FROM supplier WHERE s_nationkey IN (FROM n)),
o AS (SELECT o_orderkey FROM orders WHERE o_custkey IN (FROM c))
"""


def _latest(where: str) -> str:
    return f"""SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity FROM lineitem WHERE {where}
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC) = 1"""


def _fan(child: str, source: str, target: str, column: str) -> str:
    return f"""SELECT '{child}' AS table_name, '{column}' AS column_name, coalesce(a.k, b.k) AS children, coalesce(a.n, 0) AS source_parents,
        coalesce(b.n, 0) AS target_parents, coalesce(a.n, 0) = coalesce(b.n, 0) AS equal
        FROM (SELECT k, count(*) AS n FROM (SELECT count(*) AS k FROM {source} GROUP BY {column}) GROUP BY k) a
        FULL OUTER JOIN (SELECT k, count(*) AS n FROM (SELECT count(*) AS k FROM {target} GROUP BY {column}) GROUP BY k) b ON a.k = b.k"""


def _distance(name: str, source: str, target: str, bucket: str) -> str:
    return f"""SELECT '{name}' AS name, count(*) AS buckets, round(sum(abs(coalesce(a.n, 0)::DOUBLE / (SELECT count(*) FROM {source})::DOUBLE
          - coalesce(b.n, 0)::DOUBLE / (SELECT count(*) FROM {target})::DOUBLE)) / 2, 9) AS distance
        FROM (SELECT {bucket} AS k, count(*) AS n FROM {source} GROUP BY 1) a
        FULL OUTER JOIN (SELECT {bucket} AS k, count(*) AS n FROM {target} GROUP BY 1) b ON a.k IS NOT DISTINCT FROM b.k"""


_KEPT_LINES = "(SELECT * FROM lineitem WHERE l_returnflag <> 'R')"
_STEPS = ((1, "old"), (2, "all"), (3, "old"), (4, "without"), (5, "old"))
# a line goes with its order or its supplier, and comes back with both
_LINES = """
WITH lines AS (SELECT coalesce(o_orderdate < DATE '1998-01-01' AND c_nationkey = 7 AND s_nationkey = 7, false) AS back,
    coalesce(o_orderdate < DATE '1998-01-01' AND c_nationkey = 7, false) OR coalesce(s_nationkey = 7, false) AS gone
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN supplier ON l_suppkey = s_suppkey)
"""
_STEP_SQL = {
    "old": "SELECT count(*) FROM orders WHERE o_orderdate < DATE '1998-01-01'",
    "all": "SELECT count(*) FROM orders",
    "without": "SELECT count(*) FROM orders WHERE o_orderdate < DATE '1998-01-01' AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey = 7)",
}

QUERIES = {
    "migrate_tenant": migrate_tenant,
    "validate_migration": validate_migration,
    "remembered_runs": remembered_runs,
    "insert_append": insert_append,
    "key_conflicts": key_conflicts,
    "upsert": upsert,
    "upsert_latest": upsert_latest,
    "merge_policies": merge_policies,
    "choose_strategy": choose_strategy,
    "node_upsert": node_upsert,
    "edge_upsert": edge_upsert,
    "rollback": rollback,
    "residual": residual,
    "extract_hierarchy": extract_hierarchy,
    "remove_hierarchy": remove_hierarchy,
    "versioned_load": versioned_load,
    "incremental_load": incremental_load,
    "count_check": count_check,
    "checksum_check": checksum_check,
    "fan_out_check": fan_out_check,
    "distribution_check": distribution_check,
    "quantile_check": quantile_check,
    "row_differences": row_differences,
}

_RELATIONS = """
idle AS (SELECT count(*) FILTER (WHERE c_custkey NOT IN (SELECT o_custkey FROM o)) AS idle FROM c),
lines AS (SELECT count(*) FILTER (WHERE n = 0) AS none, count(*) FILTER (WHERE n < 3) AS few
  FROM (SELECT o_orderkey, count(l_orderkey) AS n FROM o LEFT JOIN l ON l_orderkey = o_orderkey GROUP BY 1)),
odd AS (SELECT count(*) AS odd FROM l JOIN o ON l_orderkey = o_orderkey WHERE l_linestatus <> o_orderstatus)
"""

_STAFF = """
WITH RECURSIVE staff AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 16 <> 0 THEN c_custkey - 1 END AS boss, c_nationkey AS nation FROM customer),
own AS (SELECT id FROM staff WHERE nation = 7),
up AS (SELECT id, boss, nation FROM staff WHERE nation = 7 UNION SELECT s.id, s.boss, s.nation FROM up JOIN staff s ON s.id = up.boss),
down AS (SELECT id FROM own UNION SELECT s.id FROM down JOIN staff s ON s.boss = down.id)
"""

SQL = {
    "extract_hierarchy": f"""{_STAFF} SELECT 'staff' AS table_name, id FROM up
        UNION ALL SELECT 'orders', o_orderkey FROM orders WHERE o_custkey IN (SELECT id FROM own)
        UNION ALL SELECT 'nation', n_nationkey FROM nation WHERE n_nationkey IN (SELECT nation FROM up)""",
    "remove_hierarchy": f"""{_STAFF} SELECT 'staff' AS table_name, id FROM staff WHERE id NOT IN (SELECT id FROM down)
        UNION ALL SELECT 'orders', o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT id FROM down)
        UNION ALL SELECT 'nation', n_nationkey FROM nation""",
    "migrate_tenant": f"""
        WITH {_SUBSET}, {_RELATIONS},
        warned AS (SELECT count(*) FILTER (WHERE c_acctbal < 0) AS debt,
            count(*) FILTER (WHERE NOT regexp_full_match({made_sql('email', 'email_addresses', "lower(c_name) || '@corp.example.com'")}, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{{2,}}')) AS mail,
            count(*) FILTER (WHERE NOT regexp_full_match({made_sql('phone_number', 'phone_numbers', 'c_custkey')}, '[0-9]{{3}}-[0-9]{{3}}-[0-9]{{4}}')) AS phone FROM c)
        SELECT 'extraction' AS phase, table_name, "rows", 0 AS fields, true AS success, 0 AS warnings FROM counts
        UNION ALL SELECT 'anonymization', table_name, "rows", fields, true, 0 FROM counts
        UNION ALL SELECT 'validation', NULL, 77, 0, true, (debt > 0)::INT + (mail > 0)::INT + (phone > 0)::INT
            + 2 * (idle > 0)::INT + (none > 0)::INT + (few > 0)::INT + (odd > 0)::INT FROM warned, idle, lines, odd
        UNION ALL SELECT 'loading', table_name, "rows", 0, true, 0 FROM counts WHERE "rows" > 0
    """,
    "validate_migration": f"""
        WITH {_SUBSET}, {_RELATIONS}
        SELECT 'findings' AS part, unnest(CASE WHEN idle > 0 THEN ['customers_have_orders', 'customers_everywhere'] ELSE [] END) AS name FROM idle WHERE EXISTS (SELECT 1 FROM o)
        UNION ALL SELECT 'findings', 'orders_have_lines' FROM lines WHERE none > 0 AND EXISTS (SELECT 1 FROM l)  -- empty tables are not loaded
        UNION ALL SELECT 'findings', 'minimum_lines' FROM lines WHERE few > 0 AND EXISTS (SELECT 1 FROM l)
        UNION ALL SELECT 'findings', 'line_status_matches' FROM odd WHERE odd > 0
        UNION ALL SELECT 'findings' AS part, 'balance_positive' AS name FROM customer WHERE c_nationkey = 7 AND c_acctbal < 0 GROUP BY 1
        UNION ALL SELECT 'findings', 'phone_format_valid' FROM customer WHERE c_nationkey = 7 AND c_acctbal < 0 GROUP BY 1
        UNION ALL SELECT 'checksums', 'customer' FROM customer WHERE c_nationkey = 7 AND c_acctbal < 0 GROUP BY 1
    """,
    "remembered_runs": f"""
        WITH c AS (SELECT c_custkey, c_nationkey, CAST(c_custkey % 97 AS VARCHAR) AS code,
            CASE WHEN c_nationkey = 7 THEN {made_sql('name', 'full_names', 'c_name')} ELSE {made_sql('name', 'full_names', 'c_name', 'later')} END AS c_full_name
          FROM customer WHERE c_nationkey IN (7, 8)),
        first_run AS (SELECT code, min(c_nationkey) AS run FROM c GROUP BY 1),
        numbers AS (SELECT code, row_number() OVER (ORDER BY run, code) AS number FROM first_run),
        shared AS (SELECT c_full_name, count(*) AS entries FROM c GROUP BY 1)
        SELECT c_custkey, 'TOKEN_' || lpad(CAST(number AS VARCHAR), 8, '0') AS token, c_full_name, code, entries
        FROM c JOIN numbers USING (code) JOIN shared USING (c_full_name)
    """,
    "insert_append": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders",
    "key_conflicts": "SELECT o_orderkey FROM orders WHERE o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1998-01-01'",
    "upsert": f"WITH {_BATCH} SELECT * FROM done",
    "upsert_latest": f"""
        WITH early AS ({_latest("l_shipdate < DATE '1998-07-01'")}), late AS ({_latest("l_shipdate >= DATE '1998-01-01'")})
        SELECT * REPLACE (strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate) FROM (
          SELECT * FROM early e WHERE NOT EXISTS (SELECT 1 FROM late x WHERE x.l_orderkey = e.l_orderkey AND x.l_linenumber = e.l_linenumber)
          UNION ALL SELECT * FROM late)
    """,
    "merge_policies": f"""
        WITH {_BATCH} SELECT coalesce(n.o_orderkey, o.o_orderkey) AS o_orderkey, coalesce(n.o_custkey, o.o_custkey) AS o_custkey,
          coalesce(n.o_orderstatus, o.o_orderstatus) AS o_orderstatus, greatest(n.o_totalprice, o.o_totalprice) AS o_totalprice,
          coalesce(o.o_orderpriority, n.o_orderpriority) AS o_orderpriority FROM old o FULL OUTER JOIN new n ON o.o_orderkey = n.o_orderkey
    """,
    "choose_strategy": f"""
        WITH {_SUBSET}, held AS (SELECT 'customer' AS t, count(*) AS n FROM c UNION ALL SELECT 'orders', count(*) FROM o WHERE o_orderdate < DATE '1997-01-01'),
        x AS (SELECT table_name, coalesce(held.n, 0) AS existing_rows, "rows" AS new_rows FROM counts LEFT JOIN held ON t = table_name
          WHERE table_name IN ('customer', 'orders', 'supplier', 'lineitem'))
        SELECT *, CASE WHEN existing_rows = 0 THEN 'insert' WHEN existing_rows < new_rows * 0.5 THEN 'upsert' ELSE 'merge' END AS strategy FROM x
    """,
    "node_upsert": """
        SELECT r_regionkey::BIGINT * 8 AS node_id, 'Region' AS label, 'id=' || r_regionkey || ',name=' || r_name AS properties FROM region
        UNION ALL SELECT n_nationkey::BIGINT * 8 + 1, 'Nation', 'id=' || n_nationkey || ',name=' || n_name FROM nation
        UNION ALL SELECT c_custkey * 8 + 2, 'Customer', 'id=' || c_custkey || CASE WHEN c_mktsegment <> 'BUILDING' THEN ',segment=' || c_mktsegment ELSE '' END FROM customer
        UNION ALL SELECT s_suppkey * 8 + 3, 'Supplier', 'id=' || s_suppkey || ',name=' || s_name FROM supplier
        UNION ALL SELECT s_suppkey * 8 + 6, 'Supplier', 'id=' || s_suppkey FROM supplier
        UNION ALL SELECT p_partkey * 8 + 4, 'Part', 'brand=' || p_brand || ',id=' || p_partkey || ',name=' || p_name FROM part
        UNION ALL SELECT o_orderkey * 8 + 5, 'Order', 'id=' || o_orderkey || ',status=' || o_orderstatus FROM orders
    """,
    "edge_upsert": """
        WITH late AS (SELECT l_orderkey AS o, l_partkey AS p, max(l_returnflag) AS flag FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-01-01' GROUP BY 1, 2)
        SELECT c_custkey * 8 + 2 AS start_id, 'IN_NATION' AS type, c_nationkey::BIGINT * 8 + 1 AS end_id, '' AS properties FROM customer
        UNION ALL SELECT s_suppkey * 8 + 3, 'IN_NATION', s_nationkey::BIGINT * 8 + 1, '' FROM supplier
        UNION ALL SELECT o_orderkey * 8 + 5, 'PLACED_BY', o_custkey * 8 + 2, CASE WHEN o_orderdate >= DATE '1999-01-01' THEN 'status=' || o_orderstatus ELSE '' END FROM orders
        UNION ALL SELECT n_nationkey::BIGINT * 8 + 1, 'IN_REGION', n_regionkey::BIGINT * 8, '' FROM nation
        UNION ALL SELECT o * 8 + 5, 'CONTAINS', p * 8 + 4, 'flag=' || flag FROM late
        UNION ALL SELECT l_orderkey * 8 + 5, 'CONTAINS', l_partkey * 8 + 4, 'flag=' || l_returnflag FROM lineitem
          WHERE NOT EXISTS (SELECT 1 FROM late WHERE o = l_orderkey AND p = l_partkey)
        UNION ALL SELECT l_suppkey * 8 + 3, 'SUPPLIES', l_partkey * 8 + 4, '' FROM lineitem
        UNION ALL SELECT user_id * 8 + 2, 'SAW', user_id * 8 + 3, 'event=' || max(event_type) FROM events
          WHERE user_id IN (SELECT s_suppkey FROM supplier) AND user_id IN (SELECT c_custkey FROM customer) GROUP BY user_id
    """,
    "rollback": f"""
        WITH {_GONE}
        SELECT 'region' AS table_name, count(*) AS "rows", CAST(sum(r_regionkey) AS BIGINT) AS keys FROM region
        UNION ALL SELECT 'nation', count(*), CAST(sum(n_nationkey) AS BIGINT) FROM nation WHERE n_nationkey NOT IN (FROM n)
        UNION ALL SELECT 'customer', count(*), CAST(sum(c_custkey) AS BIGINT) FROM customer WHERE c_custkey NOT IN (FROM c)
        UNION ALL SELECT 'supplier', count(*), CAST(sum(s_suppkey) AS BIGINT) FROM supplier WHERE s_suppkey NOT IN (FROM s)
        UNION ALL SELECT 'part', count(*), CAST(sum(p_partkey) AS BIGINT) FROM part
        UNION ALL SELECT 'orders', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM orders WHERE o_orderkey NOT IN (FROM o)
        UNION ALL SELECT 'lineitem', count(*), CAST(sum(l_orderkey) AS BIGINT) FROM lineitem WHERE l_orderkey NOT IN (FROM o) AND l_suppkey NOT IN (FROM s)
    """,
    "residual": """
        SELECT unnest(['region', 'nation', 'customer', 'supplier', 'part', 'orders', 'lineitem']) AS table_name,
          (SELECT count(*) FROM nation WHERE n_nationkey = 7 AND n_nationkey <> 7) AS "rows"
    """,
    "versioned_load": _LINES + " UNION ALL ".join(
        f"""SELECT {v} AS version, 'orders' AS table_name, ({_STEP_SQL[kind]}) AS "rows"
        UNION ALL SELECT {v}, 'customer', (SELECT count(*) FROM customer WHERE {v} <> 4 OR c_nationkey <> 7)
        UNION ALL SELECT {v}, 'lineitem', (SELECT count(*) FROM lines WHERE {v} < 4 OR NOT gone OR ({v} = 5 AND back))"""
        for v, kind in _STEPS
    ),
    "incremental_load": """
        WITH o AS (SELECT *, o_orderdate < TIMESTAMP '1998-01-01' AS early FROM orders),
        c AS (SELECT count(*) AS n, sum(c_custkey) AS s FROM customer), k AS (SELECT count(*) AS n, sum(c_custkey) AS s FROM customer WHERE c_nationkey <> 7)
        SELECT 1 AS version, 'customer' AS table_name, n AS "rows", s::DOUBLE AS total, n AS written FROM c
        UNION ALL SELECT v, 'customer', n, s::DOUBLE, 0 FROM c, (SELECT unnest([2, 3]) AS v)
        UNION ALL SELECT v, 'customer', n, s::DOUBLE, 0 FROM k, (SELECT unnest([4, 5]) AS v)
        UNION ALL SELECT 1, 'orders', count(*), sum(o_totalprice)::DECIMAL(20, 2)::DOUBLE, count(*) FROM o WHERE early
        UNION ALL SELECT 2, 'orders', count(*), sum(o_totalprice)::DECIMAL(20, 2)::DOUBLE, count(*) FILTER (WHERE NOT early) FROM o
        UNION ALL SELECT v, 'orders', count(*), sum(CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_totalprice END)::DECIMAL(20, 2)::DOUBLE,
            CASE v WHEN 3 THEN count(*) FILTER (WHERE o_orderstatus = 'P') WHEN 4 THEN 0 ELSE count(*) FILTER (WHERE o_orderstatus <> 'P') END
            FROM o, (SELECT unnest([3, 4, 5]) AS v) GROUP BY v
    """,
    "count_check": f"""
        SELECT 'customer' AS table_name, count(*) AS source_rows, count(*) AS target_rows, true AS equal FROM customer
        UNION ALL SELECT 'orders', count(*), count(*), true FROM orders
        UNION ALL SELECT 'lineitem', count(*), count(*) FILTER (WHERE l_returnflag <> 'R'), count(*) = count(*) FILTER (WHERE l_returnflag <> 'R') FROM lineitem
        UNION ALL SELECT 'extra', 0, count(*), count(*) = 0 FROM nation
    """,
    "checksum_check": f"""
        WITH {_BATCH} SELECT 'customer' AS table_name, count(*) AS source_rows, count(*) AS target_rows, true AS equal FROM customer
        UNION ALL SELECT 'orders', (SELECT count(*) FROM src), (SELECT count(*) FROM done),
          (SELECT count(*) FROM (FROM src EXCEPT ALL FROM done)) + (SELECT count(*) FROM (FROM done EXCEPT ALL FROM src)) = 0
        UNION ALL SELECT 'lineitem', count(*), count(*) FILTER (WHERE l_returnflag <> 'R'), count(*) FILTER (WHERE l_returnflag = 'R') = 0 FROM lineitem
    """,
    "fan_out_check": f"""WITH {_BATCH} {_fan('orders', 'src', 'done', 'o_custkey')} UNION ALL {_fan('lineitem', 'lineitem', _KEPT_LINES, 'l_orderkey')}""",
    "distribution_check": f"""WITH {_BATCH} {_distance('orders 0', 'src', 'done', 'o_orderpriority')}
        UNION ALL {_distance('orders 1', 'src', 'done', 'o_orderstatus')} UNION ALL {_distance('lineitem 2', 'lineitem', _KEPT_LINES, 'floor(l_quantity / 10)')}""",
    "quantile_check": f"""WITH {_BATCH}
        SELECT CAST(unnest([0.1, 0.25, 0.5, 0.75, 0.9]) AS DOUBLE) AS quantile,
          unnest((SELECT quantile_disc(o_totalprice, [0.1, 0.25, 0.5, 0.75, 0.9]) FROM src)) AS source_value,
          unnest((SELECT quantile_disc(o_totalprice, [0.1, 0.25, 0.5, 0.75, 0.9]) FROM done)) AS target_value
    """,
    "row_differences": f"""WITH {_BATCH},
        x AS (SELECT s.o_orderkey AS key, concat_ws(',', CASE WHEN s.o_custkey IS DISTINCT FROM d.o_custkey THEN 'o_custkey' END,
            CASE WHEN s.o_orderstatus IS DISTINCT FROM d.o_orderstatus THEN 'o_orderstatus' END,
            CASE WHEN s.o_totalprice IS DISTINCT FROM d.o_totalprice THEN 'o_totalprice' END,
            CASE WHEN s.o_orderpriority IS DISTINCT FROM d.o_orderpriority THEN 'o_orderpriority' END) AS columns
          FROM src s JOIN done d ON s.o_orderkey = d.o_orderkey),
        k AS (SELECT l_orderkey, l_linenumber, count(*) FILTER (WHERE l_returnflag = 'R') AS lost, count(*) AS n FROM lineitem GROUP BY 1, 2)
        SELECT 'orders' AS table_name, key, 'changed' AS change, columns FROM x WHERE columns <> ''
        UNION ALL SELECT 'lineitem', count(*), CASE WHEN lost = n THEN 'lost' ELSE 'changed' END, '' FROM k WHERE lost > 0 GROUP BY 3
    """,
}
