"""Extraction, anonymization, validation, loading and whole runs on small hand-made tables."""

from __future__ import annotations

import datetime
import math

import pytest
from pyspark.sql import functions as F

from tenantry.model import AnonymizationRule, BusinessRule, ForeignKey, RelationRule, RequiredFields, SchemaRule, StoreRule
from tenantry.operators import anonymize, extract, load, reconcile, report, tenants, validate
from tenantry.operators.anonymize import Anonymizer, match_rule
from tenantry.operators.load import KeyConflict, Target
from tenantry.plans import default_rules, migrate
from tenantry.sources import tables as sources
from tenantry.state import new_folder
from tenantry.streaming import anonymize_stream

KEYS = (
    ForeignKey.of("schools", "district_id", "districts"),
    ForeignKey.of("students", "school_id", "schools"),
    ForeignKey.of("enrollments", "student_id", "students"),
    ForeignKey.of("enrollments", "course_id", "courses"),
    ForeignKey.of("notes", "student_id", "students"),
    ForeignKey.of("notes", "school_id", "schools"),
)


@pytest.fixture
def data(spark):
    make = spark.createDataFrame
    return {
        "districts": make([("d1", "One"), ("d2", "Two")], "id STRING, name STRING"),
        "schools": make([(1, "d1", "A", "NY"), (2, "d2", "B", "NY"), (3, None, "C", "CA")], "id BIGINT, district_id STRING, name STRING, state STRING"),
        "students": make(
            [(1, 1, "Ann", "ann@x.org", "1", 7), (2, 1, "Bob", None, "2", 30), (3, 2, "Ann", "ann@x.org", None, 9), (4, None, "Cy", "c@x.org", "4", 9)],
            "id BIGINT, school_id BIGINT, first_name STRING, email STRING, phone STRING, age INT",
        ),
        "courses": make([(1, "Math"), (2, "Art"), (3, "Gym")], "id BIGINT, title STRING"),
        "enrollments": make([(1, 1, 1), (2, 3, 2), (3, 2, 1), (4, None, 1)], "id BIGINT, student_id BIGINT, course_id BIGINT"),
        "notes": make([(1, 1, 1), (2, 1, 2), (3, None, 1), (4, None, None), (5, 2, None)], "id BIGINT, student_id BIGINT, school_id BIGINT"),
    }


def ids(df):
    return sorted(r.id for r in df.collect())


# --- extraction -----------------------------------------------------------------


def test_subset_is_closed(data):
    subset = extract.extract_dataset(data, KEYS, {"district_id": "d1"}, tenant_columns={"districts": {"id": "d1"}})
    assert {n: ids(df) for n, df in subset.items()} == {
        "districts": ["d1"], "schools": [1], "students": [1, 2], "courses": [1], "enrollments": [1, 3], "notes": [1, 3, 5],
    }
    found = validate.reference_findings(subset, KEYS).collect()
    assert len(found) == len(KEYS) and all(f.failed == 0 and f.message is None for f in found)


def test_filters(data):
    schools = data["schools"]
    assert ids(extract.extract_direct(schools, {})) == [1, 2, 3]
    assert ids(extract.extract_direct(schools, {"district_id": None})) == []
    assert ids(extract.extract_direct(schools, {"state": "NY", "district_id": "d2"})) == [2]
    twice = schools.union(schools)
    assert ids(extract.extract_through_parent(data["students"], twice, {"district_id": "d1"}, "school_id")) == [1, 2]


def test_whole_extraction_without_filter(data):
    subset = extract.extract_dataset(data, KEYS, {})
    assert {n: df.count() for n, df in subset.items()} == {n: df.count() for n, df in data.items()}


def test_order_and_broken_keys():
    keys = [ForeignKey.of("a", "b_id", "b"), ForeignKey.of("b", "a_id", "a"), ForeignKey.of("c", "c_id", "c")]
    assert extract.table_order(["a", "b", "c"], keys, broken=[keys[1]]).index("b") < extract.table_order(["a", "b", "c"], keys, broken=[keys[1]]).index("a")
    with pytest.raises(ValueError):
        extract.table_order(["a", "b"], keys)


def test_extraction_checks(data, rows):
    counts = extract.manifest({"ids_a": data["schools"], "ids_b": data["schools"].limit(0)})
    assert rows(counts) == [("ids", "ids_a", 3), ("ids", "ids_b", 0)]
    found = extract.extraction_checks(counts, ["ids_a", "ids_b", "ids_c"], root="ids_b")
    assert rows(found, "table_name", "result") == [("ids_a", "ok"), ("ids_b", "tenant_not_found"), ("ids_c", "missing_table")]


# --- anonymization --------------------------------------------------------------

PINNED = {
    "email": "email_addresses", "user_email": "email_addresses", "ssn": "ssn", "first_name": "first_names", "lname": "last_names",
    "full_name": "full_names", "phone": "phone_numbers", "address_line1": "street_addresses", "city": "cities", "state": "states",
    "zip_code": "zip_codes", "dob": "birth_dates", "student_id": "entity_ids", "username": "usernames", "pwd_hash": "passwords",
    "ip_address": "ip_addresses", "homepage_url": "urls", "hotel_id": "phone_numbers", "schoolname": "last_names",
    "last_login_ip": "usernames", "EMAIL": "email_addresses", "name": None, "id": None,
}


@pytest.mark.parametrize("column", PINNED)
def test_default_rules_match_in_order(column):
    rule = match_rule(column, default_rules.ANONYMIZATION_RULES)
    assert (rule.name if rule else None) == PINNED[column]


def anonymizer(**options):
    return Anonymizer(default_rules.ANONYMIZATION_RULES, "salt", "2024-06-30", **options)


def test_equal_values_get_equal_surrogates_in_every_table(spark, data, rows):
    made = anonymizer().dataset(data)
    names = {r.id: r.first_name for r in made["students"].collect()}
    assert names[1] == names[3] != names[2]
    assert rows(made["students"], "id", "school_id") == rows(data["students"], "id", "school_id")
    again = anonymizer().table(data["students"].repartition(5))
    assert rows(again) == rows(made["students"])
    other = spark.createDataFrame([("Ann",)], "given_name STRING")
    assert anonymizer().table(other).first().given_name == names[1]
    assert rows(anonymize.suspicious_values(made["students"], default_rules.ANONYMIZATION_RULES)) == [
        ("email", "email_addresses", 0), ("first_name", "first_names", 0),
    ]


def test_tokens(spark, rows):
    rule = (AnonymizationRule("codes", "code", "tokenize"),)
    a = spark.createDataFrame([("x",), ("b",), (None,), ("x",)], "code STRING")
    b = spark.createDataFrame([("c",), ("b",)], "code STRING")
    made = Anonymizer(rule, "s", "2024-01-01").dataset({"a": a, "b": b})
    assert rows(made["a"]) == [(None,), ("TOKEN_00000001",), ("TOKEN_00000003",), ("TOKEN_00000003",)]
    assert rows(made["b"]) == [("TOKEN_00000001",), ("TOKEN_00000002",)]
    stored = anonymize.build_tokens(b)
    more = anonymize.build_tokens(a, stored)
    assert rows(more) == [("b", "TOKEN_00000001"), ("c", "TOKEN_00000002"), ("x", "TOKEN_00000003")]
    assert rows(anonymize.detokenize(anonymize.tokenize(a, "code", more), "code", more)) == rows(a)


def test_map_outlives_its_run(spark, rows, tmp_path):
    rules = (AnonymizationRule("codes", "code", "tokenize"), *default_rules.ANONYMIZATION_RULES)
    a = spark.createDataFrame([("x", "Ann"), ("b", "Bob"), (None, None)], "code STRING, first_name STRING")
    b = spark.createDataFrame([("c", "Ann"), ("b", "Cid")], "code STRING, first_name STRING")
    maps = anonymize.Target(spark, str(tmp_path / "maps"), anonymize.MAP_BY)
    one = anonymize.remember(maps, {"a": a}, Anonymizer(rules, "s", "2024-01-01")).dataset({"a": a})["a"]
    dry = anonymize.remember(maps, {"b": b}, Anonymizer(rules, "other", "2024-01-01"), keep=False).dataset({"b": b})["b"]
    assert anonymize.stored_entries(maps).count() == 4 and maps.version() == 1
    two = anonymize.remember(maps, {"b": b}, Anonymizer(rules, "other", "2024-01-01")).dataset({"b": b})["b"]
    again = anonymize.remember(maps, {"a": a}, Anonymizer(rules, "third", "2024-01-01")).dataset({"a": a})["a"]
    assert rows(again) == rows(one) and rows(dry) == rows(two)
    assert {r.code for r in two.collect()} == {"TOKEN_00000001", "TOKEN_00000003"}
    assert {r.first_name for r in one.collect()} & {r.first_name for r in two.collect()}
    assert rows(anonymize.resolve(two, rules, maps), "code") == [("b",), ("c",)]
    assert anonymize.stored_entries(maps, "codes").count() == 3 and anonymize.stored_entries(maps).count() == 6
    empty = anonymize.remember(maps, {"a": a.limit(0)}, Anonymizer(rules, "s", "2024-01-01"))
    assert empty.dataset({"a": a.limit(0)})["a"].isEmpty()
    nothing = anonymize.Target(spark, str(tmp_path / "none"), anonymize.MAP_BY)
    assert anonymize.remember(nothing, {"a": a.select(F.lit(1).alias("n"))}, Anonymizer(rules, "s", "2024-01-01")).dataset({"a": a.limit(0)})["a"].isEmpty()


def test_stored_map_wins_and_grows(spark, rows):
    df = spark.createDataFrame([("Ann", datetime.date(2000, 1, 1)), ("Bob", None)], "first_name STRING, dob DATE")
    stored = spark.createDataFrame([("first_names", "Ann", "Zed"), ("birth_dates", "2000-01-01", "1999-09-09")], "rule STRING, original STRING, surrogate STRING")
    made = anonymizer(stored=stored).table(df).collect()
    assert made[0].first_name == "Zed" and made[0].dob == datetime.date(1999, 9, 9)
    assert made[1].first_name not in ("Bob", "Zed") and made[1].dob is None
    merged = anonymize.merge_maps(stored, anonymize.consistency_map({"t": df}, anonymizer()))
    assert merged.count() == 3
    assert anonymize.inconsistent_values(merged).isEmpty()


def test_content_scan_and_redaction(spark, rows):
    text = "mail a.b@c.org or x@y.net, ssn 123-45-6789, call 555-123-4567 or (555) 123-4567."
    df = spark.createDataFrame([(text,), ("nothing",), (None,)], "t STRING")
    assert rows(anonymize.pii_in_text(df, ["t"])) == [("t", "email", 1, 2), ("t", "phone", 1, 2), ("t", "ssn", 1, 1)]
    redacted = df.select(anonymize.redact(F.col("t")).alias("t"))
    assert redacted.first().t == "mail [EMAIL] or [EMAIL], ssn [SSN], call [PHONE] or [PHONE]."


def test_stream_gives_the_same_as_a_batch(spark, data, rows):
    path = new_folder(spark, "stream")
    data["students"].write.parquet(path)
    stream = anonymize_stream(spark.readStream.schema(data["students"].schema).parquet(path), anonymizer())
    query = stream.writeStream.format("memory").queryName("anonymized").trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert rows(spark.table("anonymized")) == rows(anonymizer().table(data["students"]))
    with pytest.raises(ValueError):
        anonymize_stream(data["students"], anonymizer())


# --- validation -----------------------------------------------------------------


def test_default_business_rules(spark, rows):
    students = spark.createDataFrame(
        [(1, 5, 0, "a@b.org", "555-123-4567"), (2, 23, 13, "bad", "5551234567"), (3, None, 12, None, None)],
        "id INT, age INT, grade_level INT, email STRING, phone STRING",
    )
    rules = [r for r in default_rules.BUSINESS_RULES if r.table == "ids_students"]
    found = validate.row_findings(students, "ids_students", validate.business_checks(rules))
    assert rows(found, "rule", "failed") == [
        ("email_format_valid", 1), ("grade_level_range", 1), ("phone_format_valid", 1), ("student_age_range", 2),
    ]
    day = datetime.date
    enrollments = spark.createDataFrame([(day(2020, 1, 1), day(2021, 1, 1)), (day(2021, 1, 1), day(2021, 1, 1)), (day(2020, 1, 1), None)], "enrollment_date DATE, graduation_date DATE")
    rules = [r for r in default_rules.BUSINESS_RULES if r.table == "ids_enrollments"]
    assert rows(validate.row_findings(enrollments, "e", validate.business_checks(rules)), "failed", "severity") == [(1, "ERROR")]
    attendance = spark.createDataFrame([(day(2024, 8, 1),), (day(2025, 7, 1),)], "attendance_date DATE")
    rules = [r for r in default_rules.BUSINESS_RULES if r.table == "ids_attendance"]
    assert rows(validate.row_findings(attendance, "a", validate.business_checks(rules)), "failed") == [(1,)]


def test_orphans_samples_and_nulls(data):
    bad = {**data, "schools": data["schools"].filter("id = 3")}
    found = {(f.table_name, f.column_name): f for f in validate.reference_findings(bad, KEYS).collect()}
    students = found["students", "school_id"]
    assert students.failed == 2 and students.sample == ["1", "2"] and students.message == "2 orphaned FK values (not in schools)"
    by_row = {(f.table_name, f.column_name): f.failed for f in validate.reference_findings(bad, KEYS, count_rows=True).collect()}
    assert by_row["students", "school_id"] == 3
    unknown = validate.reference_findings({"students": data["students"]}, [KEYS[1]]).first()
    assert unknown.severity == "SKIPPED" and unknown.failed == 0


def test_samples_are_the_smallest_numbers(spark):
    child = spark.createDataFrame([(x,) for x in (100, 9, -5, 20, 3, 7, 1000)], "k INT")
    found = validate.reference_findings({"c": child, "p": child.limit(0)}, [ForeignKey.of("c", "k", "p", "k")]).first()
    assert found.failed == 7 and found.sample == ["-5", "3", "7", "9", "20"]


def test_status_and_decision(spark):
    def outcome(*failed, **options):
        rows = [("c", "r", severity, n) for severity, n in failed]
        findings = spark.createDataFrame(rows, "check STRING, rule STRING, severity STRING, failed BIGINT")
        row = validate.outcome(findings, **options).first()
        return row.overall_status, row.decision

    assert outcome(("ERROR", 0), ("INFO", 5), ("SKIPPED", 1)) == ("PASSED", "CONTINUE")
    assert outcome(("WARNING", 3)) == ("PASSED_WITH_WARNINGS", "CONTINUE")
    assert outcome(*[("WARNING", 1)] * 11) == ("PASSED_WITH_WARNINGS", "REVIEW")
    assert outcome(*[("WARNING", 1)] * 11, max_warnings=10) == ("FAILED", "REVIEW")
    assert outcome(("WARNING", 1), fail_on_warnings=True) == ("FAILED", "CONTINUE")
    assert outcome(("ERROR", 1), ("WARNING", 1)) == ("FAILED", "STOP")


def test_missing_column_and_text_ids(spark, rows):
    df = spark.createDataFrame([("x", None)], "id STRING, name STRING")
    rule = RequiredFields("needed", "t", ("id", "name", "grade"), "WARNING")
    found = validate.validate_dataset({"t": df}, required=[rule]).filter("rule = 'needed'")
    assert rows(found, "column_name", "severity", "failed") == [("grade", "ERROR", 1), ("id", "WARNING", 0), ("name", "WARNING", 1)]
    assert validate.id_checks(df) == []
    with pytest.raises(ValueError):
        validate.validate_dataset({})


def test_duplicate_keys_count_nulls_as_equal(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "id INT")
    assert validate.duplicate_key_finding(df, "t", ["id"]).first().failed == 2


def test_custom_checks_take_part(spark, rows):
    custom = validate.CustomChecks()

    @custom.register("mine")
    def mine(tables):
        return validate.row_findings(tables["t"], "t", [validate.RowCheck("custom", None, F.col("id") > 1, "ERROR")])

    df = spark.createDataFrame([(1,), (2,)], "id INT")
    found = validate.validate_dataset({"t": df}, custom=custom).filter("rule = 'mine'")
    assert rows(found, "severity", "failed") == [("ERROR", 1)]


def test_conflicts_with_repeated_keys(spark, rows):
    a = spark.createDataFrame([(1, "x"), (1, "y"), (2, None), (3, "z"), (4, "q")], "k INT, v STRING")
    b = spark.createDataFrame([(1, "y"), (1, "x"), (2, "n"), (3, "w"), (5, "q")], "k INT, v STRING")
    assert rows(validate.conflicts(a, b, ["k"], ["v"])) == [("v", 3, 2)]


# --- loading --------------------------------------------------------------------


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, None, 30)], "id INT, v STRING, n INT")


def test_insert_refuses_conflicts(spark, target, rows):
    fresh = spark.createDataFrame([(4, "d", 40)], "id INT, v STRING, n INT")
    assert load.insert(target, fresh, ["id"]).count() == 4
    for bad in (target.limit(1), fresh.union(fresh)):
        with pytest.raises(KeyConflict):
            load.insert(target, bad, ["id"])


def test_upsert(spark, target, rows):
    new = spark.createDataFrame([(2, "B", None), (4, "d", 40), (4, "e", 41)], "id INT, v STRING, n INT")
    with pytest.raises(KeyConflict):
        load.upsert(target, new, ["id"])
    once = load.upsert(target, new, ["id"], order=["n"])
    assert rows(once) == [(1, "a", 10), (2, "B", None), (3, None, 30), (4, "e", 41)]
    assert rows(load.upsert(once, new, ["id"], order=["n"])) == rows(once)
    keys_only = target.select("id")
    assert rows(load.upsert(keys_only, new.select("id").distinct(), ["id"])) == [(1,), (2,), (3,), (4,)]


def test_merge_policies(spark, target, rows):
    new = spark.createDataFrame([(1, None, 5), (3, "c", 99), (9, "z", 1)], "id INT, v STRING, n INT")
    assert rows(load.merge(target, new, ["id"])) == rows(load.upsert(target, new, ["id"]))
    merged = load.merge(target, new, ["id"], {"v": "coalesce", "n": "greatest"})
    assert rows(merged) == [(1, "a", 10), (2, "b", 20), (3, "c", 99), (9, "z", 1)]
    assert rows(load.merge(target, new, ["id"], {"v": "keep", "n": "keep"}))[0] == (1, "a", 10)


@pytest.mark.parametrize("existing,new,expected", [(0, 0, "insert"), (0, 9, "insert"), (4, 10, "upsert"), (5, 10, "merge"), (20, 10, "merge")])
def test_strategy(spark, existing, new, expected):
    assert spark.range(1).select(load.choose_strategy(F.lit(existing), F.lit(new))).first()[0] == expected


def test_graph_upserts(spark, rows):
    from tenantry.sources.graph import EDGE_SCHEMA, NODE_SCHEMA

    nodes = spark.createDataFrame([(1, ["A"], {"p": "1", "q": "2"}), (2, ["B"], {})], NODE_SCHEMA)
    new = spark.createDataFrame([(1, ["A"], {"p": "9", "_x": "y", "z": None}), (3, ["A", "B"], {})], NODE_SCHEMA)
    merged = load.upsert_nodes(nodes, new)
    assert {r.node_id: r.properties for r in merged.collect()} == {1: {"p": "9"}, 2: {}, 3: {}}
    edges = spark.createDataFrame([(1, "t", 2, {"a": "1"})], EDGE_SCHEMA)
    added = spark.createDataFrame([(1, "t", 2, {"b": "2"}), (2, "t", 1, {}), (1, "t", 77, {})], EDGE_SCHEMA)
    result = load.upsert_edges(edges, added, merged)
    assert {(r.start_id, r.end_id): r.properties for r in result.collect()} == {(1, 2): {"b": "2"}, (2, 1): {}}


TENANT = {"districts": {"id": "d1"}}
PRIMARY = {name: ["id"] for name in ("districts", "schools", "students", "courses", "enrollments", "notes")}


def test_removal_takes_the_tenant_and_nothing_else(data):
    where = {"district_id": "d1"}
    kept = load.without_tenant(data, KEYS, where, tenant_columns=TENANT)
    assert {n: ids(df) for n, df in kept.items()} == {
        "districts": ["d2"], "schools": [2, 3], "students": [3, 4], "courses": [1, 2, 3], "enrollments": [2, 4], "notes": [4],
    }
    again = load.without_tenant(kept, KEYS, where, tenant_columns=TENANT)
    assert {n: ids(df) for n, df in again.items()} == {n: ids(df) for n, df in kept.items()}
    assert all(r.rows == 0 for r in load.residual(kept, KEYS, where, tenant_columns=TENANT).collect())


def test_load_then_remove_restores_the_target(spark, data, rows):
    target = Target(spark, new_folder(spark, "target"))
    where = {"district_id": "d1"}
    rest = load.without_tenant(data, KEYS, where, tenant_columns=TENANT)
    rest["notes"] = rest["notes"].limit(0)
    load.load_dataset(target, rest, PRIMARY)
    before = {n: rows(df) for n, df in target.read().items()}
    assert "notes" not in before
    subset = extract.extract_dataset(data, KEYS, where, tenant_columns=TENANT)
    del subset["courses"]
    load.load_dataset(target, subset, PRIMARY)
    load.remove_tenant(target, KEYS, where, tenant_columns=TENANT)
    assert {n: rows(df) for n, df in target.read().items() if n != "notes"} == before
    target.restore(1)
    assert {n: rows(df) for n, df in target.read().items()} == before


def test_failed_load_leaves_the_target_alone(spark, data, rows):
    target = Target(spark, new_folder(spark, "target"))
    load.load_dataset(target, {"districts": data["districts"]}, PRIMARY)
    with pytest.raises(KeyConflict):
        load.load_dataset(target, {"courses": data["courses"], "districts": data["districts"]}, PRIMARY)
    assert target.version() == 1 and set(target.read()) == {"districts"}
    with pytest.raises(ValueError):
        load.load_dataset(target, {}, PRIMARY)
    with pytest.raises(ValueError):
        load.load_dataset(target, data, PRIMARY, "replace")


# --- comparison and reports -----------------------------------------------------


def test_row_differences_with_repeated_and_null_keys(spark, rows):
    a = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z"), (None, "n"), (4, "q")], "k INT, v STRING")
    b = spark.createDataFrame([(1, "y"), (1, "x"), (2, "Z"), (None, "n"), (5, "q")], "k INT, v STRING")
    assert rows(reconcile.row_differences(a, b, ["k"])) == [(2, "changed", ["v"]), (4, "lost", []), (5, "added", [])]
    assert rows(reconcile.compare_checksums({"t": a}, {"t": b}), "equal") == [(False,)]
    assert rows(reconcile.compare_checksums({"t": a}, {"t": a.repartition(3)}), "equal") == [(True,)]


def test_quantiles_and_shares(spark):
    a = spark.range(1, 101).select(F.col("id").cast("double").alias("v"))
    gaps = reconcile.quantile_gaps(a, a.select((F.col("v") + 1).alias("v")), "v", (0.5,)).first()
    assert (gaps.source_value, gaps.target_value) == (50.0, 51.0)
    for rows in ([3.0, 1.0, 2.0] * 40 + [2.0] * 200, [float(x * x % 97) for x in range(500)], [5.0], [None, 1.0, None]):
        frame = spark.createDataFrame([(x,) for x in rows], "v double")
        have = sorted(x for x in rows if x is not None)
        for accuracy in (2, 10_000):  # a summary that coarse points elsewhere
            grid = (0.0, 0.01, 0.3, 0.5, 0.99, 1.0)
            assert reconcile.exact_quantiles(frame, "v", grid, accuracy) == [have[max(1, math.ceil(q * len(have))) - 1] for q in grid]
    assert reconcile.exact_quantiles(a.limit(0), "v", (0.5,)) == [None]
    assert reconcile.share_distance(a, a.filter("v > 50"), F.col("v") > 50).first().distance == 0.5


def test_recommendation_bounds_and_ties(spark, rows):
    metrics = spark.createDataFrame(
        [("b", 5000, 10, 50_000, None), ("a", 5000, 10, 50_000, None), ("c", 4999, 10, 50_000, 100.0), ("d", 5000, None, 50_000, 100.0),
         ("e", 5000, 10, 2_000_000, 85.0), ("f", 5000, 10, 2_000_001, 85.0), ("g", 5000, 10, 300_000, 84.9), ("h", 6000, 11, 700_000, 90.0), ("i", 6000, 11, 300_000, 90.0)],
        "tenant STRING, students INT, schools INT, total_records BIGINT, data_completeness_pct DOUBLE",
    )
    chosen = tenants.eligible(metrics)
    assert rows(chosen, "tenant") == [("a",), ("b",), ("e",), ("h",), ("i",)]
    best = tenants.recommend(tenants.score_tenants(chosen), top=4)
    assert rows(best, "priority", "tenant", "size_category", "recommended_for_pilot") == [
        (1, "e", "large", True), (2, "h", "large", False), (3, "i", "medium", True), (4, "a", "small", True),
    ]
    hours = {r.tenant: r.h for r in metrics.select("tenant", tenants.migration_hours(F.col("total_records")).alias("h")).collect()}
    assert hours["h"] == round((700_000 / 50_000 + 700_000 / 100_000 + 700_000 / 200_000 + 700_000 / 30_000) * 1.1 / 60, 1)


def test_warnings_overflow(spark, rows):
    warnings = spark.createDataFrame([("r", i) for i in range(11)] + [("s", 1)], "run_id STRING, n INT")
    first = report.first_warnings(warnings, "run_id", ["n"])
    assert first.filter("run_id = 'r'").count() == 10
    assert rows(first.select("run_id", "more").distinct()) == [("r", 1), ("s", 0)]
    log = new_folder(spark, "log")
    for _ in range(2):
        report.append_decision(log, spark.createDataFrame([("r", "STOP")], "run STRING, decision STRING"))
    assert spark.read.parquet(log).count() == 2


# --- sources and sinks ----------------------------------------------------------


def test_tables_round_trip(spark, data, rows):
    folder = new_folder(spark, "tables")
    sources.write_tables(data, folder, partition_by="district_id")
    loaded = sources.load_tables(spark, folder)
    assert set(loaded) == set(data)
    assert rows(loaded["schools"].select(*data["schools"].columns)) == rows(data["schools"])
    assert set(sources.load_tables(spark, folder, ["courses"])) == {"courses"}
    assert "PartitionFilters: [isnotnull(district_id" in sources.matching(loaded["schools"], {"district_id": "d1"})._jdf.queryExecution().toString()
    assert sources.has_column(loaded["schools"], "state") and not sources.has_column(loaded["courses"], "state")
    manifest = new_folder(spark, "manifest")
    sources.write_manifest(extract.manifest(data), manifest)
    sources.write_manifest(extract.manifest(data), manifest)
    assert spark.read.json(manifest).count() == 2 * len(data)


def test_bounded_query(spark, data):
    data["students"].createOrReplaceTempView("bounded_students")
    df = sources.bounded_query(spark, "SELECT id FROM bounded_students WHERE age > :age ORDER BY id", {"age": 8}, limit=2)
    assert [r.id for r in df.collect()] == [2, 3]


# --- whole runs -----------------------------------------------------------------


def plan(**options):
    return migrate.Plan(
        keys=KEYS, primary_keys=PRIMARY, where={"district_id": "d1"}, tenant_columns=TENANT, anonymizer=anonymizer(), **options,
    )


def test_migration_and_its_validation(spark, data):
    target = Target(spark, new_folder(spark, "target"))
    result = migrate.migrate_tenant(data, plan(), target)
    assert result.outcome["overall_status"] == "PASSED_WITH_WARNINGS"
    loaded = target.read()
    assert {n: df.count() for n, df in loaded.items()} == {"districts": 1, "schools": 1, "students": 2, "courses": 1, "enrollments": 2, "notes": 3}
    assert {r.first_name for r in loaded["students"].collect()}.isdisjoint({"Ann", "Bob"})
    checks = migrate.validate_migration(result.tables, loaded, plan())
    for part in ("counts", "checksums", "fan_out"):
        assert checks[part].filter("NOT equal").isEmpty()
    rolled = report.roll_up(result.metrics).first()
    assert rolled.overall_status == "SUCCESS" and rolled.records_extracted == rolled.records_loaded == 10


def test_gate_and_options(spark, data):
    strict = plan(rules=[BusinessRule("age", "students", "age < 20", "ERROR")])
    target = Target(spark, new_folder(spark, "target"))
    stopped = migrate.migrate_tenant(data, strict, target)
    assert stopped.outcome["overall_status"] == "FAILED" and stopped.outcome["decision"] == "STOP" and target.version() == 0
    failed = report.roll_up(stopped.metrics).first()
    assert failed.overall_status == "FAILED" and failed.error_message == "Validation failed: 1 checks failed"
    eleven = [BusinessRule(f"r{i}", "students", "age < 20", "WARNING") for i in range(11)]
    waiting = migrate.migrate_tenant(data, plan(rules=eleven), target)
    assert waiting.outcome["decision"] == "REVIEW" and target.version() == 0
    assert "have to be reviewed" in waiting.metrics.filter("phase = 'validation'").first().message
    dry = migrate.migrate_tenant(data, plan(), target, dry_run=True)
    assert dry.outcome["overall_status"] != "FAILED" and target.version() == 0
    resumed = migrate.migrate_tenant({}, plan(), target, extracted=data, validation_only=True)
    assert resumed.tables is data and {r.phase for r in resumed.metrics.collect()} == {"validation"}


# --- rules of all kinds -----------------------------------------------------------


def test_rules_between_tables_and_stores(spark, data):
    enrolled = ForeignKey.of("enrollments", "student_id", "students")
    relations = [
        RelationRule("any", enrolled), RelationRule("two", enrolled, minimum=2), RelationRule("course", enrolled, (("course_id", "id"),), severity="ERROR"),
        RelationRule("no_table", ForeignKey.of("grades", "student_id", "students")), RelationRule("no_column", enrolled, (("course_id", "course"),)),
    ]
    found = {r.rule: r for r in validate.union_all(validate.relation_findings(data, relations)).collect()}
    assert {name: (r.failed, r.severity) for name, r in found.items()} == {
        "any": (1, "WARNING"), "two": (4, "WARNING"), "course": (2, "ERROR"), "no_table": (0, "SKIPPED"), "no_column": (0, "SKIPPED"),
    }
    assert found["two"].message == "4 records with fewer than 2 in enrollments"
    stores = [
        StoreRule("keys", {"students": "id", "courses": "id"}), StoreRule("counts", {"students": "id", "courses": "id"}, tolerance=0.2),
        StoreRule("alone", {"students": "id", "none": "id"}), StoreRule("values", {"students": "id", "courses": "id"}, values=("id",)),
    ]
    got = sorted((r.rule, r.failed, r.severity) for r in validate.union_all(validate.store_findings(data, stores)).collect())
    assert got == [("alone", 0, "SKIPPED"), ("counts", 1, "WARNING"), ("keys", 1, "WARNING"), ("values", 0, "WARNING"), ("values", 1, "WARNING")]
    schema = [SchemaRule("students", {"age": "string", "phone": "int", "grade": "int"}, ("email", "missing"), {"age": (8, 25)})]
    rows = validate.row_findings(data["students"], "students", validate.schema_checks(data["students"], schema)).collect()
    assert [(r.column_name, r.rule, r.failed) for r in rows] == [
        ("age", "column_type", 0), ("phone", "column_type", 0), ("grade", "column_type", 4), ("missing", "column_type", 4), ("email", "not_null", 1), ("age", "value_range", 2),
    ]


def test_tokens_continue_after_the_greatest(spark, rows):
    stored = spark.createDataFrame([("a", "TOKEN_00000001"), ("c", "TOKEN_00000007")], "original string, surrogate string")
    values = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "v string")
    assert rows(anonymize.build_tokens(values, stored)) == [("a", "TOKEN_00000001"), ("b", "TOKEN_00000008"), ("c", "TOKEN_00000007"), ("d", "TOKEN_00000009")]
