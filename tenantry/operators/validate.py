"""Checks on a dataset, as findings.

Every check gives one row: how many rows or values failed, and at which
severity.  All row checks of a table share a single aggregation, so a table is
read once however many rules apply to it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenantry.model import BusinessRule, ForeignKey, RelationRule, RequiredFields, RowCheck, SchemaRule, StoreRule, Tables
from tenantry.skew import Probe, comparable, distinct_keys, estimated_bytes, grouped_as_joined, hot_keys, is_hot, keep_matching
from tenantry.state import materialize

FINDING_COLUMNS = ("check", "rule", "table_name", "column_name", "ref_table", "severity", "failed", "message", "sample")

# The texts and limits of findings.
NULLS_TEXT = "Column has %d NULL values"
ORPHANS_TEXT = "{failed} orphaned FK values (not in {parent})"
RULE_TEXT = "%d records failed rule: {description}"
FIELD_MISSING_TEXT = "Required field '{field}' is missing"
FIELD_NULLS_TEXT = "Required field '{field}' has %d NULL values"
DUPLICATES_TEXT = "Found %d duplicate ID values"
NEGATIVES_TEXT = "Found %d negative ID values"
SAMPLE_VALUES = 5
REVIEW_ABOVE = 10


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _text(value: object) -> str:
    """A SQL string literal, or a null string."""
    if value is None:
        return "CAST(NULL AS STRING)"
    escaped = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _message(template: str, failed: str) -> str:
    """The message of a failed check, with the count in place of %d; null if it passed."""
    before, found, after = template.partition("%d")
    shown = f"concat({_text(before)}, CAST({failed} AS STRING), {_text(after)})" if found else _text(template)
    return f"CASE WHEN {failed} > 0 THEN {shown} END"


def _finding(check, rule, table, column, ref_table, severity, failed: str, message: str) -> dict[str, str]:
    """The columns of a finding as SQL; ``failed`` names the column that has the count."""
    texts = (check, rule, table, column, ref_table, severity)
    values = [_text(v) for v in texts]
    values += [f"CAST({failed} AS BIGINT)", _message(message, failed), "CAST(array() AS ARRAY<STRING>)"]
    return dict(zip(FINDING_COLUMNS, values, strict=True))


def _one(counted: DataFrame, *finding) -> DataFrame:
    """The finding for a frame of one row with the count in ``failed``."""
    columns = _finding(*finding[:-1], "failed", finding[-1])
    return counted.selectExpr(*[f"{value} AS `{name}`" for name, value in columns.items()])


def row_findings(df: DataFrame, table: str, checks: Sequence[RowCheck]) -> DataFrame:
    """One finding per check, from one aggregation over the table."""
    counts = df.agg(*[F.count_if(c.failing).alias(f"f{i}") for i, c in enumerate(checks)])
    rows = []
    for i, c in enumerate(checks):
        columns = _finding(c.check, c.rule, table, c.column, c.ref_table, c.severity, f"f{i}", c.message)
        rows.append(f"named_struct({', '.join(f'{_text(name)}, {value}' for name, value in columns.items())})")
    return counts.selectExpr(f"inline(array({', '.join(rows)}))")


# --- row checks -----------------------------------------------------------------


def null_checks(df: DataFrame) -> list[RowCheck]:
    """A warning for every column that has nulls."""
    return [
        RowCheck("schema_validation", "null_profile", F.col(c).isNull(), "WARNING", c, NULLS_TEXT)
        for c in df.columns
    ]


def type_checks(df: DataFrame, expected: Mapping[str, str]) -> list[RowCheck]:
    """A column of another type fails for every value that does not convert; a missing one for every row."""
    checks = []
    for column, wanted in expected.items():
        if column not in df.columns:
            failing, message = F.lit(True), f"Column of type {wanted} is missing"
        elif df.schema[column].dataType.simpleString() == wanted:
            failing, message = F.lit(False), ""
        else:
            converted = F.expr(f"try_cast(`{column}` AS {wanted})")
            failing, message = F.col(column).isNotNull() & converted.isNull(), f"%d values do not convert to {wanted}"
        checks.append(RowCheck("schema_validation", "column_type", failing, "ERROR", column, message))
    return checks


def not_null_checks(columns: Sequence[str]) -> list[RowCheck]:
    return [
        RowCheck("schema_validation", "not_null", F.col(c).isNull(), "ERROR", c, "%d NULL values in a NOT NULL column")
        for c in columns
    ]


def range_checks(bounds: Mapping[str, tuple[object, object]]) -> list[RowCheck]:
    return [
        RowCheck("schema_validation", "value_range", ~F.col(c).between(low, high), "ERROR", c, f"%d values outside {low} to {high}")
        for c, (low, high) in bounds.items()
    ]


def business_checks(rules: Sequence[BusinessRule]) -> list[RowCheck]:
    """A row fails unless the condition is true; null counts as failed."""
    return [
        RowCheck(
            "business_rule",
            rule.name,
            ~F.coalesce(F.expr(rule.condition), F.lit(False)),
            rule.severity,
            message=RULE_TEXT.format(description=rule.description or rule.condition),
        )
        for rule in rules
    ]


def tenant_check(column: str, tenant: object, rule: str = "school_district_match") -> RowCheck:
    """Every row belongs to the tenant."""
    outside = ~F.col(column).eqNullSafe(F.lit(tenant))
    return RowCheck("business_rule", rule, outside, "ERROR", column, "%d records belong to another tenant")


def required_checks(df: DataFrame, rules: Sequence[RequiredFields]) -> list[RowCheck]:
    """A missing required column is always an error; nulls fail at the severity of the rule.

    A missing column counts as one failure, however many rows there are.
    """
    checks = []
    for rule in rules:
        for field in rule.fields:
            if field in df.columns:
                message = FIELD_NULLS_TEXT.format(field=field)
                checks.append(RowCheck("completeness", rule.name, F.col(field).isNull(), rule.severity, field, message))
    return checks


def missing_fields(df: DataFrame, table: str, rules: Sequence[RequiredFields]) -> DataFrame | None:
    spark = df.sparkSession
    rows = [(rule.name, field) for rule in rules for field in rule.fields if field not in df.columns]
    if not rows:
        return None
    shown = [(rule, field, FIELD_MISSING_TEXT.format(field=field)) for rule, field in rows]
    found = spark.createDataFrame(shown, "rule STRING, field STRING, message STRING")
    columns = _finding("completeness", None, table, None, None, "ERROR", "1", "")
    columns.update(rule="rule", column_name="field", message="message")
    return found.selectExpr(*[f"{value} AS `{name}`" for name, value in columns.items()])


def id_checks(df: DataFrame, column: str = "id", strict: bool = False) -> list[RowCheck]:
    """Negative ids (with ``strict`` also zero), on numeric columns."""
    if column not in df.columns or not isinstance(df.schema[column].dataType, T.NumericType):
        return []
    failing = F.col(column) <= 0 if strict else F.col(column) < 0
    return [RowCheck("data_quality", "positive_ids", failing, "ERROR", column, NEGATIVES_TEXT)]


def created_checks(df: DataFrame, as_of: str, column: str = "created_at", earliest: str = "2000-01-01") -> list[RowCheck]:
    """Creation dates that lie in the future or before ``earliest``."""
    if column not in df.columns:
        return []
    day = F.col(column).cast("date")
    return [
        RowCheck("data_quality", "no_future_created_dates", day > F.to_date(F.lit(as_of)), "WARNING", column, "%d dates in the future"),
        RowCheck(
            "data_quality",
            "reasonable_created_dates",
            day < F.to_date(F.lit(earliest)),
            "WARNING",
            column,
            f"%d dates before {earliest}",
        ),
    ]


def name_length_checks(df: DataFrame, lowest: int = 1, highest: int = 100) -> list[RowCheck]:
    """Length of every text column with ``name`` in its name."""
    return [
        RowCheck(
            "data_quality",
            "name_length_reasonable",
            ~F.length(f.name).between(lowest, highest),
            "WARNING",
            f.name,
            f"%d names not {lowest} to {highest} characters long",
        )
        for f in df.schema
        if "name" in f.name.lower() and isinstance(f.dataType, T.StringType)
    ]


# --- checks across rows and tables ----------------------------------------------


#: Estimated bytes of keys, as they are stored, that one task groups; some hundred thousand keys.
KEY_BYTES = 1024 * 1024
#: From these estimated bytes of keys on, the busiest are looked for.
BUSY_BYTES = 8 * 1024 * 1024


def _key_parts(keys: DataFrame) -> int:
    """Into how many parts keys are dealt before they are grouped, so that a task holds about as many of them at any size.

    Grouped where they are read, or in parts that were put together for their
    few bytes, a task would hold more keys the larger the tables.
    """
    most, size = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")), estimated_bytes(keys)
    return most if size is None else min(16 * most, 1 + size // KEY_BYTES)


def _by_key(used: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of a key, with those of the busiest keys of a large table counted where they are read; other rows are left as they are."""
    size = estimated_bytes(used)
    if size is not None and size < BUSY_BYTES:
        return used
    probe = Probe(False, tuple(hot_keys(used.dropna(subset=list(columns)), columns)))
    if not probe.hot:
        return used
    busy = used.filter(is_hot(columns, probe)).groupBy(*columns).agg(F.sum("__rows").alias("__rows"))
    return used.filter(~is_hot(columns, probe)).unionByName(busy)


def orphans(child: DataFrame, parent: DataFrame, key: ForeignKey) -> DataFrame:
    """Distinct non-null foreign keys that the parent lacks, with the rows that hold them.

    A text that refers to a number is an orphan if it is no number.

    Rows of a frequent key are counted before sides meet, so such a key is one row then.
    """
    kinds = [(child.schema[c].dataType, parent.schema[k].dataType) for c, k in zip(key.columns, key.keys, strict=True)]
    if all(x == y and grouped_as_joined(x) for x, y in kinds):
        used = child.select(*key.columns, F.lit(1).cast("bigint").alias("__rows"))
        known = parent.select(*[F.col(k).alias(c) for c, k in key.pairs], F.lit(0).cast("bigint").alias("__rows"))
        # one grouping of both sides takes the memory of one table of keys, and no sorting
        both = _by_key(used, key.columns).unionByName(known).dropna(subset=list(key.columns))
        parts = _key_parts(both)
        dealt = both.repartition(parts, *key.columns) if parts > 1 else both
        counted = dealt.groupBy(*key.columns).agg(F.sum("__rows").alias("rows"), F.min("__rows").alias("__known"))
        return counted.filter("__known > 0").drop("__known")
    values = child.dropna(subset=list(key.columns)).groupBy(*key.columns).agg(F.count(F.lit(1)).alias("rows"))
    ids = distinct_keys(parent, key.keys).toDF(*[f"__k{i}" for i in range(len(key.keys))])
    pairs = [comparable(x, F.col(c), y, F.col(f"__k{i}")) for i, ((x, y), c) in enumerate(zip(kinds, key.columns, strict=True))]
    match = reduce(lambda a, b: a & b, [a == b for a, b in pairs])
    return values.join(ids, match, "left_anti")


def _sortable(df: DataFrame, column: str) -> Column:
    """Text that sorts like the value: whole numbers are shifted to be positive and padded."""
    text = F.col(column).cast("string")
    if isinstance(df.schema[column].dataType, T.IntegralType):
        return F.lpad((F.col(column).cast("decimal(20,0)") + F.lit(str(2**63)).cast("decimal(20,0)")).cast("string"), 20, "0")
    return text


def reference_findings(tables: Tables, keys: Sequence[ForeignKey], count_rows: bool = False) -> DataFrame:
    """Orphans per foreign key with the five smallest as a sample; a key to an absent table is SKIPPED.

    ``failed`` counts distinct values, or rows with ``count_rows``.  The orphans
    of all keys are found in one job and written, which is little where the data
    is sound; totals and samples are then taken from there.
    """
    spark = tables[keys[0].child].sparkSession
    checked = [(i, key) for i, key in enumerate(keys) if key.parent in tables]
    text = ORPHANS_TEXT.replace("FK values", "rows") if count_rows else ORPHANS_TEXT
    described = [
        (
            i,
            key.child,
            ",".join(key.columns),
            key.parent,
            "ERROR" if key.parent in tables else "SKIPPED",
            text.format(failed="", parent=key.parent),
        )
        for i, key in enumerate(keys)
    ]
    all_keys = spark.createDataFrame(
        described, "i INT, table_name STRING, column_name STRING, ref_table STRING, severity STRING, text STRING"
    )
    parts = []
    for i, key in checked:
        lost = orphans(tables[key.child], tables[key.parent], key)
        value = F.concat_ws(",", *[F.col(c).cast("string") for c in key.columns])
        place = F.concat_ws(",", *[_sortable(tables[key.child], c) for c in key.columns])
        parts.append(lost.select(F.lit(i).alias("i"), value.alias("value"), place.alias("place"), "rows"))
    if parts:
        lost = materialize(union_all(parts), "orphans")
    else:
        lost = spark.createDataFrame([], "i INT, value STRING, place STRING, rows BIGINT")
    totals = lost.groupBy("i").agg((F.sum("rows") if count_rows else F.count(F.lit(1))).alias("n"))
    # five rows of each key that lacks some: an order with a limit keeps no more than those of a task
    failing = [row.i for row in lost.select("i").distinct().collect()]
    firsts = [lost.filter(F.col("i") == i).select("i", "place", "value").orderBy("place", "value").limit(SAMPLE_VALUES) for i in failing]
    first = union_all(firsts) if firsts else lost.select("i", "place", "value")
    samples = first.groupBy("i").agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("s"))
    found = all_keys.join(totals, "i", "left").join(samples, "i", "left")
    failed = F.coalesce("n", F.lit(0)).cast("bigint")
    return found.select(
        F.lit("referential_integrity").alias("check"),
        F.lit(None).cast("string").alias("rule"),
        "table_name",
        "column_name",
        "ref_table",
        "severity",
        failed.alias("failed"),
        F.when(failed > 0, F.concat(failed.cast("string"), F.col("text"))).alias("message"),
        F.coalesce(F.transform("s", lambda x: x["value"]), F.array().cast("array<string>")).alias("sample"),
    )


def cross_table_finding(
    child: DataFrame, parent: DataFrame, key: ForeignKey, compare: Sequence[tuple[str, str]], rule: str, severity: str = "ERROR"
) -> DataFrame:
    """Joined rows whose child and parent columns differ; counted by value before the join."""
    left = child.groupBy(*dict.fromkeys([*key.columns, *[a for a, _ in compare]])).agg(F.count(F.lit(1)).alias("__rows"))
    right = parent.select(*[F.col(c).alias(f"__{c}") for c in dict.fromkeys([*key.keys, *[b for _, b in compare]])])
    match = reduce(lambda a, b: a & b, [F.col(a) == F.col(f"__{b}") for a, b in key.pairs])
    differs = reduce(lambda a, b: a | b, [~F.col(a).eqNullSafe(F.col(f"__{b}")) for a, b in compare])
    failed = left.join(right, match).agg(F.sum(F.when(differs, F.col("__rows")).otherwise(0)).alias("failed"))
    failed = failed.select(F.coalesce("failed", F.lit(0)).alias("failed"))
    column = ",".join(a for a, _ in compare)
    message = f"%d records differ from {key.parent}"
    return _one(failed, "business_rule", rule, key.child, column, key.parent, severity, message)


def existence_finding(parent: DataFrame, child: DataFrame, key: ForeignKey, rule: str, severity: str = "WARNING") -> DataFrame:
    """Parents that no child row refers to."""
    used = child.select(*[F.col(c).alias(f"__{c}") for c in key.columns]).distinct()
    idle = parent.select(*key.keys).join(used, _on_child(key), "left_anti")
    failed = idle.agg(F.count(F.lit(1)).alias("failed"))
    message = f"%d records without {key.child}"
    return _one(failed, "business_rule", rule, key.parent, ",".join(key.keys), key.child, severity, message)


def _on_child(key: ForeignKey) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__{c}") for c, k in key.pairs])


def children_per_parent(parent: DataFrame, child: DataFrame, key: ForeignKey) -> DataFrame:
    """Number of children of every parent, parents without any included."""
    counts = child.groupBy(*[F.col(c).alias(f"__{c}") for c in key.columns]).agg(F.count(F.lit(1)).alias("n"))
    joined = parent.select(*key.keys).join(counts, _on_child(key), "left")
    return joined.select(*key.keys, F.coalesce("n", F.lit(0)).alias("children"))


def minimum_children_finding(
    parent: DataFrame, child: DataFrame, key: ForeignKey, minimum: int, rule: str, severity: str = "WARNING"
) -> DataFrame:
    failed = children_per_parent(parent, child, key).agg(F.count_if(F.col("children") < minimum).alias("failed"))
    message = f"%d records with fewer than {minimum} in {key.child}"
    return _one(failed, "completeness", rule, key.parent, ",".join(key.keys), key.child, severity, message)


def duplicate_key_finding(df: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
    """Rows beyond the first of each key; nulls are equal to each other.

    Texts are grouped by a 256-bit digest, which is all that is shuffled of them.
    """
    plain_text = {f.name for f in df.schema if f.dataType == T.StringType()}
    short = [(F.sha2(c, 256) if c in plain_text else F.col(c)).alias(f"__k{i}") for i, c in enumerate(key)]
    groups = df.groupBy(*short).agg(F.count(F.lit(1)).alias("__rows"))
    failed = groups.agg(F.coalesce(F.sum(F.col("__rows") - 1), F.lit(0)).alias("failed"))
    return _one(failed, "data_quality", "unique_ids", table, ",".join(key), None, "ERROR", DUPLICATES_TEXT)


# --- checks across stores -------------------------------------------------------


def store_presence(stores: Mapping[str, DataFrame]) -> DataFrame:
    """In which stores each key occurs; every frame has the key as its first column."""
    parts = [
        df.select(F.col(df.columns[0]).alias("key"), *[F.lit(int(s == store)).alias(f"in_{s}") for s in stores])
        for store, df in stores.items()
    ]
    found = union_all(parts).groupBy("key").agg(*[F.max(f"in_{s}").alias(f"in_{s}") for s in stores])
    present = reduce(lambda a, b: a + b, [F.col(f"in_{s}") for s in stores])
    return found.withColumn("stores", present.cast("bigint"))


def not_in_every_store(stores: Mapping[str, DataFrame]) -> DataFrame:
    return store_presence(stores).filter(F.col("stores") < len(stores))


def count_tolerance(stores: Mapping[str, DataFrame], tolerance: float) -> DataFrame:
    """Do the row counts of the stores lie within a share of the largest."""
    counts = union_all([df.agg(F.count(F.lit(1)).alias("n")) for df in stores.values()])
    spread = counts.agg(F.min("n").alias("fewest"), F.max("n").alias("most"))
    share = F.coalesce((F.col("most") - F.col("fewest")) / F.nullif(F.col("most"), F.lit(0)), F.lit(0.0))
    return spread.select("fewest", "most", share.alias("variance"), (share <= tolerance).alias("within"))


def missing_in(first: DataFrame, second: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of the first store whose key the second lacks."""
    return keep_matching(first, second, [(c, c) for c in key], absent=True)


def _hashed(column: str, kinds: Sequence[T.DataType]) -> Column:
    """A hash that is equal for equal values of both stores; 0 for null."""
    value = F.col(column)
    if all(isinstance(k, T.IntegralType) for k in kinds):
        value = value.cast("bigint")
    elif any(isinstance(k, T.FractionalType) for k in kinds) and not all(isinstance(k, T.DecimalType) for k in kinds):
        value = value.cast("double") + F.lit(0.0)  # -0.0 equals 0.0
    elif kinds[0] != kinds[1]:
        value = value.cast("string")
    return F.when(F.col(column).isNull(), F.lit(0).cast("bigint")).otherwise(F.xxhash64(value))


def conflicts(first: DataFrame, second: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Keys that both stores hold, and how many disagree, per column.

    The stores agree on a key if they have the same set of values for it, null
    counted as a value.  Values are brought to one row per key, column and value
    by a grouping that Spark starts before the shuffle, so that neither repeated
    keys nor frequent values cost more.
    """
    places = {c: i for i, c in enumerate(columns)}

    def values(df: DataFrame, side: int) -> DataFrame:
        each = [F.struct(F.lit(i).alias("place"), _hashed(c, (first.schema[c].dataType, second.schema[c].dataType)).alias("value")) for c, i in places.items()]
        return df.dropna(subset=list(key)).select(*key, F.lit(side == 0).alias("in_first"), F.lit(side == 1).alias("in_second"), F.inline(F.array(*each)))

    both = values(first, 0).unionByName(values(second, 1))
    per_value = both.groupBy(*key, "place", "value").agg(F.max("in_first").alias("in_first"), F.max("in_second").alias("in_second"))
    per_key = per_value.groupBy(*key, "place").agg(
        (F.max("in_first") & F.max("in_second")).alias("shared"), F.max(F.col("in_first") != F.col("in_second")).alias("differs")
    )
    counts = per_key.filter("shared").groupBy("place").agg(F.count(F.lit(1)).alias("keys"), F.count_if("differs").alias("conflicts"))
    names = first.sparkSession.createDataFrame([(c, i) for c, i in places.items()], "column_name string, place int")
    found = names.join(counts, "place", "left")
    return found.select("column_name", F.coalesce("keys", F.lit(0)).cast("bigint").alias("keys"), F.coalesce("conflicts", F.lit(0)).cast("bigint").alias("conflicts"))


def row_sample(df: DataFrame, key: Sequence[str], size: int = 1000) -> DataFrame:
    """A fixed number of rows in the order of a hash of the key: the same rows every time."""
    mark = F.md5(F.concat_ws(":", *[F.col(c).cast("string") for c in key]))
    return df.orderBy(mark, *key).limit(size)


# --- rules between tables and stores, as findings ----------------------------------


def schema_checks(df: DataFrame, rules: Sequence[SchemaRule]) -> list[RowCheck]:
    """The row checks of a table's schema rules; a column that is missing fails as such and is not looked at otherwise."""
    checks = []
    for rule in rules:
        there = {c: b for c, b in rule.bounds.items() if c in df.columns}
        needed = {c: "any type" for c in (*rule.filled, *rule.bounds) if c not in df.columns and c not in rule.types}
        checks += type_checks(df, {**rule.types, **needed}) + not_null_checks([c for c in rule.filled if c in df.columns]) + range_checks(there)
    return checks


def relation_findings(tables: Tables, rules: Sequence[RelationRule]) -> list[DataFrame]:
    """Findings of all rules between tables, with one join for each key however many rules use it.

    Children are counted by key and compared columns, parents by the same, before they meet.  A rule with an absent
    table or column is SKIPPED.
    """
    parts = []
    for key in dict.fromkeys(r.key for r in rules):
        mine, skipped = [], []
        for r in (r for r in rules if r.key == key):
            there = {key.child, key.parent} <= set(tables) and all(a in tables[key.child].columns for a in (*key.columns, *[a for a, _ in r.compare]))
            (mine if there and all(b in tables[key.parent].columns for b in (*key.keys, *[b for _, b in r.compare])) else skipped).append(r)
        if mine:
            parts.append(_relations_of_key(tables[key.child], tables[key.parent], key, mine))
        if skipped:
            spark = next(iter(tables.values())).sparkSession
            parts += [_one(spark.range(1).selectExpr("0 AS failed"), *_described(r)[:5], "SKIPPED", "") for r in skipped]
    return parts


def _described(rule: RelationRule) -> tuple[str, str, str, str, str, str, str]:
    key = rule.key
    if rule.compare:
        return "business_rule", rule.name, key.child, ",".join(a for a, _ in rule.compare), key.parent, rule.severity, f"%d records differ from {key.parent}"
    if rule.minimum == 1:
        return "business_rule", rule.name, key.parent, ",".join(key.keys), key.child, rule.severity, f"%d records without {key.child}"
    return "completeness", rule.name, key.parent, ",".join(key.keys), key.child, rule.severity, f"%d records with fewer than {rule.minimum} in {key.child}"


def _relations_of_key(child: DataFrame, parent: DataFrame, key: ForeignKey, rules: Sequence[RelationRule]) -> DataFrame:
    compared = list(dict.fromkeys(pair for r in rules for pair in r.compare))
    lefts, rights = list(dict.fromkeys(a for a, _ in compared)), list(dict.fromkeys(b for _, b in compared))
    left = child.select(*[F.col(c).alias(f"__c{i}") for i, c in enumerate(key.columns)], *[F.col(a).alias(f"__a{i}") for i, a in enumerate(lefts)])
    left = left.groupBy(*left.columns).agg(F.count(F.lit(1)).alias("__rows"))
    right = parent.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(key.keys)], *[F.col(b).alias(f"__b{i}") for i, b in enumerate(rights)])
    right = right.groupBy(*right.columns).agg(F.count(F.lit(1)).alias("__copies"))
    kinds = [(parent.schema[k].dataType, child.schema[c].dataType) for c, k in key.pairs]
    match = reduce(lambda a, b: a & b, [x == y for x, y in (comparable(p, F.col(f"__k{i}"), c, F.col(f"__c{i}")) for i, (p, c) in enumerate(kinds))])
    joined = right.join(left, match, "left")
    figures = [F.coalesce(F.sum("__rows"), F.lit(0)).alias("__children")]
    for i, r in enumerate(rules):
        if r.compare:
            differs = reduce(lambda a, b: a | b, [~F.col(f"__a{lefts.index(a)}").eqNullSafe(F.col(f"__b{rights.index(b)}")) for a, b in r.compare])
            figures.append(F.coalesce(F.sum(F.when(differs, F.col("__rows"))), F.lit(0)).alias(f"__d{i}"))
    per_parent = joined.groupBy(*right.columns).agg(*figures)
    totals = [
        F.coalesce(F.sum(F.col("__copies") * F.col(f"__d{i}")) if r.compare else F.sum(F.when(F.col("__children") < r.minimum, F.col("__copies"))), F.lit(0)).alias(f"f{i}")
        for i, r in enumerate(rules)
    ]
    return _as_rows(per_parent.agg(*totals), [_described(r) for r in rules])


def _as_rows(totals: DataFrame, findings: Sequence[tuple]) -> DataFrame:
    """Findings for a frame of one row with a count ``f0``, ``f1`` and so on for each."""
    rows = []
    for i, f in enumerate(findings):
        columns = _finding(*f[:-1], f"f{i}", f[-1])
        rows.append(f"named_struct({', '.join(f'{_text(name)}, {value}' for name, value in columns.items())})")
    return totals.selectExpr(f"inline(array({', '.join(rows)}))")


def store_findings(tables: Tables, rules: Sequence[StoreRule]) -> list[DataFrame]:
    """Findings of the rules between stores; a rule with fewer than two of its tables is SKIPPED."""
    parts = []
    for rule in rules:
        present = {name: tables[name].select(c) for name, c in rule.columns.items() if name in tables and c in tables[name].columns}
        names = list(present)
        finding = ("cross_store", rule.name, names[0] if names else None, rule.columns[names[0]] if names else None, ",".join(names[1:]) or None)
        if len(present) < 2:
            parts.append(_one(next(iter(tables.values())).sparkSession.range(1).selectExpr("0 AS failed"), *finding, "SKIPPED", ""))
        elif rule.tolerance is not None:
            failed = count_tolerance(present, rule.tolerance).select(F.when(F.col("within"), 0).otherwise(1).alias("failed"))
            parts.append(_one(failed, *finding, rule.severity, f"row counts differ by more than {rule.tolerance}"))
        else:
            keyed = {n: df.toDF("key").dropna() for n, df in present.items()}
            failed = not_in_every_store(keyed).agg(F.count(F.lit(1)).alias("failed"))
            parts.append(_one(failed, *finding, rule.severity, "%d keys are not in every store"))
        if rule.values and len(present) >= 2:
            first, second = names[:2]
            other = tables[second].withColumnRenamed(rule.columns[second], rule.columns[first])
            found = conflicts(tables[first], other, [rule.columns[first]], rule.values).agg(F.coalesce(F.sum("conflicts"), F.lit(0)).alias("failed"))
            parts.append(_one(found, "cross_store", rule.name, first, ",".join(rule.values), second, rule.severity, "%d values differ between stores"))
    return parts


# --- outcome --------------------------------------------------------------------


def by_rule(findings: DataFrame) -> DataFrame:
    """Failed checks and failures per check and rule."""
    return findings.groupBy("check", "rule", "severity").agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if(F.col("failed") > 0).alias("failed_checks"),
        F.sum("failed").alias("failures"),
    )


def outcome(findings: DataFrame, *, fail_on_warnings: bool = False, max_warnings: int | None = None) -> DataFrame:
    """Totals, status and decision over all findings.

    A failed ERROR fails the run.  A failed WARNING passes with a warning, unless
    ``fail_on_warnings`` or more than ``max_warnings`` of them.  INFO and SKIPPED
    are not counted against the run.
    """
    bad = F.col("failed") > 0
    totals = findings.agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(bad & (F.col("severity") == "ERROR")).alias("total_failed"),
        F.count_if(bad & (F.col("severity") == "WARNING")).alias("total_warnings"),
    )
    warnings = F.col("total_warnings")
    failed = F.col("total_failed") > 0
    if fail_on_warnings:
        failed = failed | (warnings > 0)
    if max_warnings is not None:
        failed = failed | (warnings > max_warnings)
    status = F.when(failed, "FAILED").when(warnings > 0, "PASSED_WITH_WARNINGS").otherwise("PASSED")
    decision = F.when(F.col("total_failed") > 0, "STOP").when(warnings > REVIEW_ABOVE, "REVIEW").otherwise("CONTINUE")
    return totals.select(
        "total_checks",
        (F.col("total_checks") - F.col("total_failed")).alias("total_passed"),
        "total_failed",
        "total_warnings",
        status.alias("overall_status"),
        decision.alias("decision"),
    )


CustomCheck = Callable[[Tables], DataFrame]


class CustomChecks:
    """Named user functions from a dataset to findings."""

    def __init__(self) -> None:
        self._functions: dict[str, CustomCheck] = {}

    def register(self, name: str) -> Callable[[CustomCheck], CustomCheck]:
        def keep(function: CustomCheck) -> CustomCheck:
            self._functions[name] = function
            return function

        return keep

    def run(self, tables: Tables) -> list[DataFrame]:
        """The findings of every function, named by it where they carry no rule."""
        results = []
        for name, function in self._functions.items():
            findings = function(tables).select(*FINDING_COLUMNS)
            results.append(findings.withColumn("rule", F.coalesce("rule", F.lit(name))))
        return results


def validate_dataset(
    tables: Tables,
    *,
    keys: Sequence[ForeignKey] = (),
    primary_keys: Mapping[str, Sequence[str]] | None = None,
    rules: Sequence[BusinessRule] = (),
    required: Sequence[RequiredFields] = (),
    as_of: str | None = None,
    tenant: tuple[str, object] | None = None,
    custom: CustomChecks | None = None,
    schemas: Sequence[SchemaRule] = (),
    relations: Sequence[RelationRule] = (),
    stores: Sequence[StoreRule] = (),
) -> DataFrame:
    """All checks over a dataset: one pass per table, one join per foreign key for orphans and one for all rules along it."""
    if not tables:
        raise ValueError("there is nothing to validate")
    parts = []
    for name, df in tables.items():
        need = [r for r in required if r.table == name]
        id_column = (primary_keys or {}).get(name, ("id",))
        checks = null_checks(df) + business_checks([r for r in rules if r.table == name]) + required_checks(df, need)
        checks += schema_checks(df, [r for r in schemas if r.table == name])
        if len(id_column) == 1:
            checks += id_checks(df, id_column[0])
        if as_of is not None:
            checks += created_checks(df, as_of)
        checks += name_length_checks(df)
        if tenant is not None and tenant[0] in df.columns:
            checks.append(tenant_check(*tenant))
        parts.append(row_findings(df, name, checks))
        missing = missing_fields(df, name, need)
        if missing is not None:
            parts.append(missing)
        if all(c in df.columns for c in id_column):
            parts.append(duplicate_key_finding(df, name, id_column))
    present = [key for key in keys if key.child in tables]
    if present:
        parts.append(reference_findings(tables, present))
    parts += relation_findings(tables, relations) + store_findings(tables, stores)
    if custom is not None:
        parts += custom.run(tables)
    return union_all(parts)
