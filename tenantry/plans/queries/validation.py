"""Checks on the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenantry.model import BusinessRule, ForeignKey, RelationRule, RequiredFields, StoreRule
from tenantry.operators import validate
from tenantry.plans.bindings import KEYS, reader, tables
from tenantry.skew import look_up

SHORT = ("rule", "table_name", "column_name", "severity", "failed", "message")


def _short(findings: DataFrame) -> DataFrame:
    return findings.select(*SHORT)


def _sparse_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with zero rates taken as missing."""
    return reader(spark, folder)("lineitem").select(
        "l_orderkey",
        F.nullif("l_tax", F.lit(0.0)).alias("l_tax"),
        F.nullif("l_discount", F.lit(0.0)).alias("l_discount"),
        F.nullif("l_returnflag", F.lit("N")).alias("l_returnflag"),
    )


def null_profile(spark: SparkSession, folder: str) -> DataFrame:
    lines = _sparse_lines(spark, folder)
    return _short(validate.row_findings(lines, "lineitem", validate.null_checks(lines)))


def schema_conformity(spark: SparkSession, folder: str) -> DataFrame:
    lines = _sparse_lines(spark, folder)
    parts = reader(spark, folder)("part")
    orders = reader(spark, folder)("orders").select(
        F.substring("o_orderpriority", 1, 1).alias("priority"), F.col("o_orderpriority").alias("label")
    )
    found = [
        validate.row_findings(
            parts, "part", validate.type_checks(parts, {"p_size": "int", "p_brand": "int", "p_color": "string"})
        ),
        validate.row_findings(orders, "orders", validate.type_checks(orders, {"priority": "int", "label": "int"})),
        validate.row_findings(lines, "lineitem", validate.not_null_checks(["l_orderkey", "l_tax"])),
        validate.row_findings(parts, "part", validate.range_checks({"p_size": (5, 45), "p_retailprice": (905.0, 1500.0)})),
    ]
    return _short(validate.union_all(found))


REFERENCES = (
    ForeignKey.of("orders", "o_orderkey", "lineitem", "l_orderkey"),
    ForeignKey.of("documents", "doc_id", "labels", "doc_id"),
    ForeignKey.of("events", "user_id", "supplier", "s_suppkey"),
    ForeignKey.of("lineitem", "l_orderkey,l_partkey", "pairs", "l_orderkey,l_partkey"),
    ForeignKey.of("pages", "page_id", "sites", "id"),
    *KEYS,
)


def _references(spark: SparkSession, folder: str, count_rows: bool) -> DataFrame:
    names = ("orders", "lineitem", "documents", "labels", "events", "supplier", "customer", "nation", "region", "part", "pages")
    data = tables(spark, folder, *names)
    data["pairs"] = data["lineitem"].filter("l_returnflag <> 'R'")
    found = validate.reference_findings(data, REFERENCES, count_rows)
    return found.select("table_name", "column_name", "ref_table", "severity", "failed", "message", F.concat_ws("|", "sample").alias("sample"))


def referential_integrity(spark: SparkSession, folder: str) -> DataFrame:
    return _references(spark, folder, count_rows=False)


def orphan_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _references(spark, folder, count_rows=True)


LINE_RULES = (
    BusinessRule("quantity_range", "lineitem", "l_quantity >= 5 AND l_quantity <= 45", "WARNING", "Quantity must be 5 to 45"),
    BusinessRule(
        "ship_window", "lineitem", "l_shipdate >= '1996-01-01' AND l_shipdate <= '2000-12-31'", "WARNING", "Shipped within the years"
    ),
    BusinessRule("taxed", "lineitem", "nullif(l_tax, 0) > 0.02", "INFO", "Tax above two percent"),
    BusinessRule("flag_known", "lineitem", "l_returnflag IN ('A', 'N', 'R')", "ERROR", "Flag is known"),
)
ORDER_RULES = (
    BusinessRule("price_positive", "orders", "o_totalprice > 0", "ERROR", "Price must be positive"),
    BusinessRule("priority_format", "orders", "o_orderpriority RLIKE '^[1-3]-[A-Z]+$' OR o_orderpriority IS NULL", "WARNING", "Priority format"),
)


def business_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Ranges, windows, formats and null handling; one pass per table."""
    t = reader(spark, folder)
    found = [
        validate.row_findings(t("lineitem"), "lineitem", validate.business_checks(LINE_RULES)),
        validate.row_findings(t("orders"), "orders", validate.business_checks(ORDER_RULES)),
    ]
    return _short(validate.union_all(found))


def date_order(spark: SparkSession, folder: str) -> DataFrame:
    t = reader(spark, folder)
    ordered = t("orders").select("o_orderkey", "o_orderdate")
    dated = look_up(t("lineitem").select("l_orderkey", "l_shipdate"), ordered, [("l_orderkey", "o_orderkey")])
    rule = BusinessRule("ship_after_order", "lineitem", "o_orderdate < l_shipdate OR l_shipdate IS NULL", "ERROR", "Ship date must be after order date")
    return _short(validate.row_findings(dated, "lineitem", validate.business_checks([rule])))


def tenant_membership(spark: SparkSession, folder: str) -> DataFrame:
    t = reader(spark, folder)
    found = [
        validate.row_findings(t(name), name, [validate.tenant_check(column, 7)])
        for name, column in (("customer", "c_nationkey"), ("supplier", "s_nationkey"))
    ]
    return _short(validate.union_all(found))


def cross_table(spark: SparkSession, folder: str) -> DataFrame:
    """Status of lines against that of their order; flag of lines against the priority of their order."""
    t = reader(spark, folder)
    key = ForeignKey.of("lineitem", "l_orderkey", "orders", "o_orderkey")
    found = validate.cross_table_finding(t("lineitem"), t("orders"), key, [("l_linestatus", "o_orderstatus")], "line_status_matches")
    return found.select(*SHORT, "ref_table")


def existence(spark: SparkSession, folder: str) -> DataFrame:
    t = reader(spark, folder)
    pairs = [
        ("orders", "lineitem", ForeignKey.of("lineitem", "l_orderkey", "orders", "o_orderkey")),
        ("customer", "events", ForeignKey.of("events", "user_id", "customer", "c_custkey")),
        ("documents", "labels", ForeignKey.of("labels", "doc_id", "documents", "doc_id")),
    ]
    found = [validate.existence_finding(t(parent), t(child), key, f"{parent}_has_{child}") for parent, child, key in pairs]
    return _short(validate.union_all(found))


def required_fields(spark: SparkSession, folder: str) -> DataFrame:
    lines = _sparse_lines(spark, folder)
    rules = [
        RequiredFields("line_fields", "lineitem", ("l_orderkey", "l_tax", "l_color"), "ERROR"),
        RequiredFields("line_details", "lineitem", ("l_returnflag", "l_size"), "WARNING"),
    ]
    found = [validate.row_findings(lines, "lineitem", validate.required_checks(lines, rules)), validate.missing_fields(lines, "lineitem", rules)]
    return _short(validate.union_all(found))


def minimum_children(spark: SparkSession, folder: str) -> DataFrame:
    t = reader(spark, folder)
    lines = ForeignKey.of("lineitem", "l_orderkey", "orders", "o_orderkey")
    orders = ForeignKey.of("orders", "o_custkey", "customer", "c_custkey")
    return _short(
        validate.minimum_children_finding(t("orders"), t("lineitem"), lines, 3, "minimum_lines").unionByName(
            validate.minimum_children_finding(t("customer"), t("orders"), orders, 10, "minimum_orders")
        )
    )


def duplicate_keys(spark: SparkSession, folder: str) -> DataFrame:
    t = reader(spark, folder)
    found = [
        validate.duplicate_key_finding(t("lineitem"), "lineitem", ["l_orderkey", "l_linenumber"]),
        validate.duplicate_key_finding(t("orders"), "orders", ["o_orderkey"]),
        validate.duplicate_key_finding(t("documents").select(F.col("text").alias("copy")), "documents", ["copy"]),
    ]
    return _short(validate.union_all(found))


def id_values(spark: SparkSession, folder: str) -> DataFrame:
    """Keys start at 0, so the strict check finds one row; text keys are not checked."""
    t = reader(spark, folder)
    shifted = t("customer").select((F.col("c_custkey") - F.col("c_nationkey")).alias("id"))
    named = t("customer").select(F.col("c_name").alias("id"))
    assert validate.id_checks(named) == []
    found = [
        validate.row_findings(t("orders"), "orders", validate.id_checks(t("orders"), "o_orderkey")),
        validate.row_findings(t("orders"), "orders strict", validate.id_checks(t("orders"), "o_orderkey", strict=True)),
        validate.row_findings(shifted, "customer", validate.id_checks(shifted)),
    ]
    return _short(validate.union_all(found))


def created_dates(spark: SparkSession, folder: str) -> DataFrame:
    t = reader(spark, folder)
    events = t("events").select(F.col("ts").alias("created_at"))
    orders = t("orders").select(F.col("o_orderdate").alias("created_at"))
    found = [
        validate.row_findings(events, "events", validate.created_checks(events, "2024-01-20")),
        validate.row_findings(orders, "orders", validate.created_checks(orders, "2001-06-30")),
    ]
    return _short(validate.union_all(found))


def name_length(spark: SparkSession, folder: str) -> DataFrame:
    parts = reader(spark, folder)("part")
    sites = reader(spark, folder)("pages").select(F.col("url").alias("page_name"))
    found = [
        validate.row_findings(parts, "part", validate.name_length_checks(parts, 1, 10)),
        validate.row_findings(sites, "pages", validate.name_length_checks(sites, 1, 40)),
    ]
    return _short(validate.union_all(found))


def _all_findings(spark: SparkSession, folder: str) -> DataFrame:
    data = tables(spark, folder, "orders", "lineitem", "customer", "nation")
    custom = validate.CustomChecks()

    @custom.register("no_debt")
    def no_debt(found: dict[str, DataFrame]) -> DataFrame:
        check = validate.RowCheck("custom", None, F.col("c_acctbal") < 0, "WARNING", "c_acctbal", "%d customers in debt")
        return validate.row_findings(found["customer"], "customer", [check])

    return validate.validate_dataset(
        data,
        keys=[k for k in KEYS if k.child in data and k.parent in data],
        primary_keys={
            "orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"], "customer": ["c_custkey"], "nation": ["n_nationkey"],
        },
        rules=[*LINE_RULES, *ORDER_RULES],
        required=[RequiredFields("order_fields", "orders", ("o_orderkey", "o_custkey"), "ERROR")],
        tenant=("c_nationkey", 7),
        custom=custom,
    )


def findings_by_rule(spark: SparkSession, folder: str) -> DataFrame:
    return validate.by_rule(_all_findings(spark, folder)).filter("failed_checks > 0")


def validation_outcome(spark: SparkSession, folder: str) -> DataFrame:
    return validate.outcome(_all_findings(spark, folder), max_warnings=10)


def row_sample(spark: SparkSession, folder: str) -> DataFrame:
    return validate.row_sample(reader(spark, folder)("lineitem"), ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"
    )


def _stores(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    t = reader(spark, folder)
    return {"crm": t("customer").select("c_custkey"), "shop": t("orders").select("o_custkey"), "web": t("events").select("user_id")}


def relation_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Rules of every kind between tables and stores, with one join for each key."""
    data = tables(spark, folder, "orders", "lineitem", "customer", "events")
    lines, orders = KEYS[4], KEYS[3]
    relations = [
        RelationRule("orders_have_lines", lines),
        RelationRule("minimum_lines", lines, minimum=3),
        RelationRule("line_status_matches", lines, (("l_linestatus", "o_orderstatus"),), severity="ERROR"),
        RelationRule("customers_have_ten_orders", orders, minimum=10),
        RelationRule("no_such_table", KEYS[5]),
    ]
    stores = [
        StoreRule("customers_everywhere", {"customer": "c_custkey", "orders": "o_custkey", "events": "user_id"}),
        StoreRule("as_many_lines", {"lineitem": "l_orderkey", "orders": "o_orderkey"}, tolerance=0.05),
        StoreRule("one_store", {"orders": "o_orderkey", "part": "p_partkey"}),
    ]
    return _short(validate.union_all(validate.relation_findings(data, relations) + validate.store_findings(data, stores)))


def store_presence(spark: SparkSession, folder: str) -> DataFrame:
    return validate.not_in_every_store(_stores(spark, folder))


def store_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of orders in one currency of status against another."""
    t = reader(spark, folder)
    flags = {flag: t("lineitem").filter(F.col("l_returnflag") == flag) for flag in ("A", "N", "R")}
    found = validate.count_tolerance(flags, 0.05)
    return found.select("fewest", "most", F.round("variance", 9).alias("variance"), "within")


def store_missing(spark: SparkSession, folder: str) -> DataFrame:
    t = reader(spark, folder)
    events = t("events").select(F.col("user_id").alias("c_custkey"))
    return validate.missing_in(t("customer"), events, ["c_custkey"]).select("c_custkey", "c_name")


def store_conflicts(spark: SparkSession, folder: str) -> DataFrame:
    """What orders say about their status and date, and what their lines say."""
    t = reader(spark, folder)
    orders = t("orders").select(
        F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status"), F.col("o_orderdate").cast("date").alias("day")
    )
    lines = t("lineitem").select(
        F.col("l_orderkey").alias("key"), F.col("l_linestatus").alias("status"), F.col("l_shipdate").cast("date").alias("day")
    )
    return validate.conflicts(orders, lines, ["key"], ["status", "day"])


# --- the same in SQL ------------------------------------------------------------


def _row(rule, table, column, severity, failed, message, source=None) -> str:
    text = lambda v: "CAST(NULL AS VARCHAR)" if v is None else "'" + v.replace("'", "''") + "'"
    before, _, after = message.partition("%d")
    shown = f"{text(before)} || n || {text(after)}" if "%d" in message else text(message)
    return f"""SELECT {text(rule)} AS rule, {text(table)} AS table_name, {text(column)} AS column_name, {text(severity)} AS severity,
        CAST(n AS BIGINT) AS failed, CASE WHEN n > 0 THEN {shown} END AS message FROM (SELECT {failed} AS n FROM {source or table})"""


def _all(*rows: str) -> str:
    return " UNION ALL ".join(rows)


def _failing(condition: str) -> str:
    return f"count(*) FILTER (WHERE NOT coalesce({condition}, false))"


_SPARSE = """(SELECT l_orderkey, nullif(l_tax, 0) AS l_tax, nullif(l_discount, 0) AS l_discount, nullif(l_returnflag, 'N') AS l_returnflag FROM lineitem)"""
_NULLS = "Column has %d NULL values"
_RULES = {
    "quantity_range": ("lineitem", "l_quantity >= 5 AND l_quantity <= 45", "WARNING", "Quantity must be 5 to 45"),
    "ship_window": ("lineitem", "l_shipdate >= DATE '1996-01-01' AND l_shipdate <= DATE '2000-12-31'", "WARNING", "Shipped within the years"),
    "taxed": ("lineitem", "nullif(l_tax, 0) > 0.02e0", "INFO", "Tax above two percent"),
    "flag_known": ("lineitem", "l_returnflag IN ('A', 'N', 'R')", "ERROR", "Flag is known"),
    "price_positive": ("orders", "o_totalprice > 0", "ERROR", "Price must be positive"),
    "priority_format": ("orders", "regexp_full_match(o_orderpriority, '[1-3]-[A-Z]+')", "WARNING", "Priority format"),
}
_RULES_SQL = _all(
    *[_row(name, table, None, severity, _failing(c), f"%d records failed rule: {text}") for name, (table, c, severity, text) in _RULES.items()]
)


def _reference_sql(rows: bool) -> str:
    parts = []
    sources = {"pairs": "(SELECT * FROM lineitem WHERE l_returnflag <> 'R')"}
    for key in REFERENCES:
        column, table = ",".join(key.columns), key.child
        if key.parent == "sites":
            parts.append(
                f"""SELECT '{table}' AS table_name, '{column}' AS column_name, 'sites' AS ref_table, 'SKIPPED' AS severity,
                CAST(0 AS BIGINT) AS failed, CAST(NULL AS VARCHAR) AS message, '' AS sample"""
            )
            continue
        match = " AND ".join(f"p.{k} = c.{c}" for c, k in key.pairs)
        text = " || ',' || ".join(key.columns)
        lost = f"""(SELECT {column}, count(*) AS r, row_number() OVER (ORDER BY {column}) AS i FROM {table} c
            WHERE NOT EXISTS (SELECT 1 FROM {sources.get(key.parent, key.parent)} p WHERE {match}) GROUP BY {column})"""
        figure = "coalesce(sum(r), 0)" if rows else "count(*)"
        unit = "orphaned rows" if rows else "orphaned FK values"
        parts.append(
            f"""SELECT '{table}' AS table_name, '{column}' AS column_name, '{key.parent}' AS ref_table, 'ERROR' AS severity,
            CAST({figure} AS BIGINT) AS failed, CASE WHEN count(*) > 0 THEN CAST({figure} AS BIGINT) || ' {unit} (not in {key.parent})' END AS message,
            coalesce(string_agg(CAST({text} AS VARCHAR), '|' ORDER BY i) FILTER (WHERE i <= 5), '') AS sample FROM {lost}"""
        )
    return _all(*parts)


def _conflict(column: str, a: str, b: str) -> str:
    return f"""SELECT '{column}' AS column_name, count(*) AS keys, count(*) FILTER (WHERE a.lo <> b.lo OR a.hi <> b.hi) AS conflicts
        FROM (SELECT o_orderkey AS k, min({a}) AS lo, max({a}) AS hi FROM orders GROUP BY 1) a
        JOIN (SELECT l_orderkey AS k, min({b}) AS lo, max({b}) AS hi FROM lineitem GROUP BY 1) b ON a.k = b.k"""


def _duplicates(key: str, table: str) -> str:
    return f"(SELECT count(*) - 1 AS extra FROM {table} GROUP BY {key})"


_COLUMNS = {
    "orders": ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"),
    "lineitem": (
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate",
    ),
    "customer": ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
    "nation": ("n_nationkey", "n_name", "n_regionkey"),
}


def _findings_sql() -> str:
    """Check, rule, severity and failures of everything that the full validation looks at."""
    rows = []

    def add(check: str, rule: str | None, severity: str, failed: str, source: str) -> None:
        name = "CAST(NULL AS VARCHAR)" if rule is None else f"'{rule}'"
        rows.append(f"""SELECT '{check}' AS "check", {name} AS rule, '{severity}' AS severity, CAST({failed} AS BIGINT) AS failed FROM {source}""")

    for table, columns in _COLUMNS.items():
        for column in columns:
            add("schema_validation", "null_profile", "WARNING", f"count(*) - count({column})", table)
    for name, (table, condition, severity, _) in _RULES.items():
        add("business_rule", name, severity, _failing(condition), table)
    for column in ("o_orderkey", "o_custkey"):
        add("completeness", "order_fields", "ERROR", f"count(*) - count({column})", "orders")
    for table, key in (("orders", "o_orderkey"), ("customer", "c_custkey"), ("nation", "n_nationkey")):
        add("data_quality", "positive_ids", "ERROR", f"count(*) FILTER (WHERE {key} < 0)", table)
        add("data_quality", "unique_ids", "ERROR", "coalesce(sum(extra), 0)", _duplicates(key, table))
    add("data_quality", "unique_ids", "ERROR", "coalesce(sum(extra), 0)", _duplicates("l_orderkey, l_linenumber", "lineitem"))
    for table, column in (("customer", "c_name"), ("nation", "n_name")):
        add("data_quality", "name_length_reasonable", "WARNING", f"count(*) FILTER (WHERE length({column}) NOT BETWEEN 1 AND 100)", table)
    add("business_rule", "school_district_match", "ERROR", "count(*) FILTER (WHERE c_nationkey <> 7)", "customer")
    for child, column, parent, key in (
        ("customer", "c_nationkey", "nation", "n_nationkey"), ("orders", "o_custkey", "customer", "c_custkey"), ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ):
        add("referential_integrity", None, "ERROR", f"count(DISTINCT {column})", f"(SELECT {column} FROM {child} WHERE {column} NOT IN (SELECT {key} FROM {parent}))")
    add("custom", "no_debt", "WARNING", "count(*) FILTER (WHERE c_acctbal < 0)", "customer")
    return _all(*rows)


QUERIES = {
    "null_profile": null_profile,
    "schema_conformity": schema_conformity,
    "referential_integrity": referential_integrity,
    "orphan_rows": orphan_rows,
    "business_rules": business_rules,
    "date_order": date_order,
    "tenant_membership": tenant_membership,
    "cross_table": cross_table,
    "existence": existence,
    "required_fields": required_fields,
    "minimum_children": minimum_children,
    "duplicate_keys": duplicate_keys,
    "id_values": id_values,
    "created_dates": created_dates,
    "name_length": name_length,
    "findings_by_rule": findings_by_rule,
    "validation_outcome": validation_outcome,
    "row_sample": row_sample,
    "relation_rules": relation_rules,
    "store_presence": store_presence,
    "store_counts": store_counts,
    "store_missing": store_missing,
    "store_conflicts": store_conflicts,
}

SQL = {
    "null_profile": _all(
        *[
            _row("null_profile", "lineitem", c, "WARNING", f"count(*) - count({c})", _NULLS, _SPARSE)
            for c in ("l_orderkey", "l_tax", "l_discount", "l_returnflag")
        ]
    ),
    "schema_conformity": _all(
        _row("column_type", "part", "p_size", "ERROR", "0", "", "(SELECT 1)"),
        _row("column_type", "part", "p_brand", "ERROR", "count(*) FILTER (WHERE TRY_CAST(p_brand AS INTEGER) IS NULL)", "%d values do not convert to int"),
        _row("column_type", "part", "p_color", "ERROR", "count(*)", "Column of type string is missing"),
        _row("column_type", "orders", "priority", "ERROR", "count(*) FILTER (WHERE TRY_CAST(o_orderpriority[1] AS INTEGER) IS NULL)", "%d values do not convert to int"),
        _row("column_type", "orders", "label", "ERROR", "count(*) FILTER (WHERE TRY_CAST(o_orderpriority AS INTEGER) IS NULL)", "%d values do not convert to int"),
        _row("not_null", "lineitem", "l_orderkey", "ERROR", "count(*) - count(l_orderkey)", "%d NULL values in a NOT NULL column", _SPARSE),
        _row("not_null", "lineitem", "l_tax", "ERROR", "count(*) - count(l_tax)", "%d NULL values in a NOT NULL column", _SPARSE),
        _row("value_range", "part", "p_size", "ERROR", "count(*) FILTER (WHERE p_size NOT BETWEEN 5 AND 45)", "%d values outside 5 to 45"),
        _row("value_range", "part", "p_retailprice", "ERROR", "count(*) FILTER (WHERE p_retailprice NOT BETWEEN 905 AND 1500)", "%d values outside 905.0 to 1500.0"),
    ),
    "referential_integrity": _reference_sql(rows=False),
    "orphan_rows": _reference_sql(rows=True),
    "business_rules": _RULES_SQL,
    "date_order": _row(
        "ship_after_order", "lineitem", None, "ERROR", _failing("o_orderdate < l_shipdate"),
        "%d records failed rule: Ship date must be after order date", "lineitem JOIN orders ON l_orderkey = o_orderkey",
    ),
    "tenant_membership": _all(
        _row("school_district_match", "customer", "c_nationkey", "ERROR", "count(*) FILTER (WHERE c_nationkey <> 7)", "%d records belong to another tenant"),
        _row("school_district_match", "supplier", "s_nationkey", "ERROR", "count(*) FILTER (WHERE s_nationkey <> 7)", "%d records belong to another tenant"),
    ),
    "cross_table": f"""SELECT *, 'orders' AS ref_table FROM ({_row(
        "line_status_matches", "lineitem", "l_linestatus", "ERROR", "count(*) FILTER (WHERE l_linestatus <> o_orderstatus)",
        "%d records differ from orders", "lineitem JOIN orders ON l_orderkey = o_orderkey")})""",
    "existence": _all(
        _row("orders_has_lineitem", "orders", "o_orderkey", "WARNING", "count(*) FILTER (WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem))", "%d records without lineitem"),
        _row("customer_has_events", "customer", "c_custkey", "WARNING", "count(*) FILTER (WHERE c_custkey NOT IN (SELECT user_id FROM events))", "%d records without events"),
        _row("documents_has_labels", "documents", "doc_id", "WARNING", "count(*) FILTER (WHERE doc_id NOT IN (SELECT doc_id FROM labels))", "%d records without labels"),
    ),
    "relation_rules": _all(
        _row("orders_have_lines", "orders", "o_orderkey", "WARNING", "count(*) FILTER (WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem))", "%d records without lineitem"),
        _row("minimum_lines", "orders", "o_orderkey", "WARNING", "count(*) FILTER (WHERE n < 3)", "%d records with fewer than 3 in lineitem",
             "(SELECT count(l_orderkey) AS n FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey)"),
        _row("line_status_matches", "lineitem", "l_linestatus", "ERROR", "count(*) FILTER (WHERE l_linestatus <> o_orderstatus)",
             "%d records differ from orders", "lineitem JOIN orders ON l_orderkey = o_orderkey"),
        _row("customers_have_ten_orders", "customer", "c_custkey", "WARNING", "count(*) FILTER (WHERE n < 10)", "%d records with fewer than 10 in orders",
             "(SELECT count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey)"),
        _row("no_such_table", "part", "p_partkey", "SKIPPED", "0", "", "(SELECT 1)"),
        _row("customers_everywhere", "customer", "c_custkey", "WARNING", "count(*) FILTER (WHERE n < 3)", "%d keys are not in every store",
             "(SELECT count(*) AS n FROM (SELECT c_custkey AS k, 1 FROM customer UNION SELECT o_custkey, 2 FROM orders UNION SELECT user_id, 3 FROM events) WHERE k IS NOT NULL GROUP BY k)"),
        _row("as_many_lines", "lineitem", "l_orderkey", "WARNING", "((SELECT count(*) FROM lineitem) - (SELECT count(*) FROM orders) > 0.05 * (SELECT count(*) FROM lineitem))::INT",
             "row counts differ by more than 0.05", "(SELECT 1)"),
        _row("one_store", "orders", "o_orderkey", "SKIPPED", "0", "", "(SELECT 1)"),
    ),
    "required_fields": _all(
        _row("line_fields", "lineitem", "l_orderkey", "ERROR", "count(*) - count(l_orderkey)", "Required field 'l_orderkey' has %d NULL values", _SPARSE),
        _row("line_fields", "lineitem", "l_tax", "ERROR", "count(*) - count(l_tax)", "Required field 'l_tax' has %d NULL values", _SPARSE),
        _row("line_details", "lineitem", "l_returnflag", "WARNING", "count(*) - count(l_returnflag)", "Required field 'l_returnflag' has %d NULL values", _SPARSE),
        _row("line_fields", "lineitem", "l_color", "ERROR", "1", "Required field 'l_color' is missing", "(SELECT 1)"),
        _row("line_details", "lineitem", "l_size", "ERROR", "1", "Required field 'l_size' is missing", "(SELECT 1)"),
    ),
    "minimum_children": _all(
        _row("minimum_lines", "orders", "o_orderkey", "WARNING", "count(*) FILTER (WHERE coalesce(c, 0) < 3)", "%d records with fewer than 3 in lineitem",
             "orders LEFT JOIN (SELECT l_orderkey, count(*) AS c FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey"),
        _row("minimum_orders", "customer", "c_custkey", "WARNING", "count(*) FILTER (WHERE coalesce(c, 0) < 10)", "%d records with fewer than 10 in orders",
             "customer LEFT JOIN (SELECT o_custkey, count(*) AS c FROM orders GROUP BY 1) ON o_custkey = c_custkey"),
    ),
    "duplicate_keys": _all(
        _row("unique_ids", "lineitem", "l_orderkey,l_linenumber", "ERROR", "sum(extra)", "Found %d duplicate ID values", _duplicates("l_orderkey, l_linenumber", "lineitem")),
        _row("unique_ids", "orders", "o_orderkey", "ERROR", "sum(extra)", "Found %d duplicate ID values", _duplicates("o_orderkey", "orders")),
        _row("unique_ids", "documents", "copy", "ERROR", "sum(extra)", "Found %d duplicate ID values", _duplicates("text", "documents")),
    ),
    "id_values": _all(
        _row("positive_ids", "orders", "o_orderkey", "ERROR", "count(*) FILTER (WHERE o_orderkey < 0)", "Found %d negative ID values"),
        _row("positive_ids", "orders strict", "o_orderkey", "ERROR", "count(*) FILTER (WHERE o_orderkey <= 0)", "Found %d negative ID values", "orders"),
        _row("positive_ids", "customer", "id", "ERROR", "count(*) FILTER (WHERE c_custkey - c_nationkey < 0)", "Found %d negative ID values"),
    ),
    "created_dates": _all(
        _row("no_future_created_dates", "events", "created_at", "WARNING", "count(*) FILTER (WHERE CAST(ts AS DATE) > DATE '2024-01-20')", "%d dates in the future"),
        _row("reasonable_created_dates", "events", "created_at", "WARNING", "count(*) FILTER (WHERE CAST(ts AS DATE) < DATE '2000-01-01')", "%d dates before 2000-01-01"),
        _row("no_future_created_dates", "orders", "created_at", "WARNING", "count(*) FILTER (WHERE CAST(o_orderdate AS DATE) > DATE '2001-06-30')", "%d dates in the future"),
        _row("reasonable_created_dates", "orders", "created_at", "WARNING", "count(*) FILTER (WHERE CAST(o_orderdate AS DATE) < DATE '2000-01-01')", "%d dates before 2000-01-01"),
    ),
    "name_length": _all(
        _row("name_length_reasonable", "part", "p_name", "WARNING", "count(*) FILTER (WHERE length(p_name) NOT BETWEEN 1 AND 10)", "%d names not 1 to 10 characters long"),
        _row("name_length_reasonable", "pages", "page_name", "WARNING", "count(*) FILTER (WHERE length(url) NOT BETWEEN 1 AND 40)", "%d names not 1 to 40 characters long"),
    ),
    "findings_by_rule": f"""
        SELECT "check", rule, severity, count(*) AS checks, count(*) FILTER (WHERE failed > 0) AS failed_checks, CAST(sum(failed) AS BIGINT) AS failures
        FROM ({_findings_sql()}) GROUP BY 1, 2, 3 HAVING failed_checks > 0
    """,
    "validation_outcome": f"""
        WITH t AS (SELECT count(*) AS total_checks, count(*) FILTER (WHERE failed > 0 AND severity = 'ERROR') AS total_failed,
          count(*) FILTER (WHERE failed > 0 AND severity = 'WARNING') AS total_warnings FROM ({_findings_sql()}))
        SELECT total_checks, total_checks - total_failed AS total_passed, total_failed, total_warnings,
          CASE WHEN total_failed > 0 OR total_warnings > 10 THEN 'FAILED' WHEN total_warnings > 0 THEN 'PASSED_WITH_WARNINGS' ELSE 'PASSED' END AS overall_status,
          CASE WHEN total_failed > 0 THEN 'STOP' WHEN total_warnings > 10 THEN 'REVIEW' ELSE 'CONTINUE' END AS decision FROM t
    """,
    "row_sample": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem
        ORDER BY md5(concat_ws(':', l_orderkey, l_partkey, l_suppkey, l_linenumber)), 1, 2, 3, 4 LIMIT 1000
    """,
    "store_presence": """
        SELECT key, CAST(max(c) AS INTEGER) AS in_crm, CAST(max(s) AS INTEGER) AS in_shop, CAST(max(w) AS INTEGER) AS in_web, max(c) + max(s) + max(w) AS stores
        FROM (SELECT c_custkey AS key, 1 AS c, 0 AS s, 0 AS w FROM customer UNION ALL SELECT o_custkey, 0, 1, 0 FROM orders
          UNION ALL SELECT user_id, 0, 0, 1 FROM events) GROUP BY key HAVING max(c) + max(s) + max(w) < 3
    """,
    "store_counts": """
        WITH c AS (SELECT count(*) AS n FROM lineitem GROUP BY l_returnflag)
        SELECT min(n) AS fewest, max(n) AS most, round((max(n) - min(n))::DOUBLE / max(n)::DOUBLE, 9) AS variance,
          (max(n) - min(n))::DOUBLE / max(n)::DOUBLE <= 0.05e0 AS within FROM c
    """,
    "store_missing": "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)",
    "store_conflicts": _all(
        _conflict("status", "o_orderstatus", "l_linestatus"), _conflict("day", "CAST(o_orderdate AS DATE)", "CAST(l_shipdate AS DATE)")
    ),
}
