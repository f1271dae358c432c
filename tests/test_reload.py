"""Reloading a tenant in a dataset whose rows have parents of several tenants."""

from __future__ import annotations

from tenantry.model import ForeignKey
from tenantry.operators.extract import extract_dataset
from tenantry.operators.load import Target, conflicting_keys, load_dataset, merge, reload_tenant, remove_tenant
from tenantry.state import new_folder


def test_reload_gives_everything_back(spark, rows):
    frame = spark.createDataFrame
    data = {
        "suppliers": frame([(7, "t7"), (8, "t8")], "id int, tenant string"),
        "orders": frame([(70, "t7"), (80, "t8")], "id int, tenant string"),
        "lines": frame([(100, 70, 7), (101, 80, 7), (102, 80, 8), (103, 80, None), (104, None, 7)], "id int, order_id int, supplier_id int"),
    }
    keys = [ForeignKey.of("lines", "order_id", "orders"), ForeignKey.of("lines", "supplier_id", "suppliers")]
    primary = {name: ["id"] for name in data}
    target = Target(spark, new_folder(spark, "target"))
    load_dataset(target, data, primary)
    for tenant in ("t7", "t8"):
        reload_tenant(target, extract_dataset(data, keys, {"tenant": tenant}), keys, {"tenant": tenant}, primary)
        assert all(rows(target.read()[name]) == rows(df) for name, df in data.items())


def test_line_of_a_parent_that_is_gone_goes(spark, rows):
    frame = spark.createDataFrame
    data = {
        "suppliers": frame([(7, "t7"), (8, "t8")], "id int, tenant string"),
        "orders": frame([(80, "t8")], "id int, tenant string"),
        "lines": frame([(101, 80, 7), (102, 80, 8)], "id int, order_id int, supplier_id int"),
    }
    keys = [ForeignKey.of("lines", "order_id", "orders"), ForeignKey.of("lines", "supplier_id", "suppliers")]
    target = Target(spark, new_folder(spark, "target"))
    load_dataset(target, data, {name: ["id"] for name in data})
    new = {"suppliers": data["suppliers"].filter("id = 9"), "orders": data["orders"].filter("id = 9"), "lines": data["lines"].filter("id = 9")}
    reload_tenant(target, new, keys, {"tenant": "t7"}, {name: ["id"] for name in data})
    assert rows(target.read()["lines"], "id") == [(102,)]


def test_merge_and_conflicts_leave_the_target_where_it_is(spark, rows):
    target = spark.range(1000).selectExpr("id", "id AS v")
    new = spark.createDataFrame([(5, None), (2000, 1)], "id bigint, v bigint")
    assert rows(conflicting_keys(target, new, ["id"])) == [(5,)]
    merged = merge(target, new, ["id"], {"v": "coalesce"})
    assert rows(merged.filter("id IN (5, 6, 2000)")) == [(5, 5), (6, 6), (2000, 1)] and merged.count() == 1001


def test_only_touched_folders_are_written(spark, rows):
    target = Target(spark, new_folder(spark, "target"), {"people": "city"})
    people = spark.createDataFrame([(1, "a b/c", 1), (2, "x", 1), (3, None, 1), (4, "", 1)], "id int, city string, v int")
    load_dataset(target, {"people": people}, {})
    assert sorted(f.tenant or "" for f in target.folders()["people"]) == ["", "a b/c", "x"]  # null and empty share one
    load_dataset(target, {"people": spark.createDataFrame([(5, "x", 2)], "id int, city string, v int")}, {})
    first, second = (set(target.folders(v)["people"]) for v in (1, 2))
    assert first < second and len(second - first) == 1
    load_dataset(target, {"people": spark.createDataFrame([(4, "y", 3), (6, "z", 3)], "id int, city string, v int")}, {}, "upsert")
    assert {f.tenant for f in second - set(target.folders()["people"])} == {None}
    assert rows(target.read()["people"]) == [(1, "a b/c", 1), (2, "x", 1), (3, None, 1), (4, "y", 3), (5, "x", 2), (6, "z", 3)]
    assert rows(target.read(tenants=["x"])["people"], "id") == [(2,), (5,)]
    before = target.read()["people"]
    remove_tenant(target, [], {"city": "x"})
    assert rows(before, "id") == [(i,) for i in range(1, 7)]  # whoever reads the version before goes on reading it
    assert rows(target.read()["people"], "id") == [(1,), (3,), (4,), (6,)] and rows(target.read(3)["people"]) == rows(before)
    assert {f.tenant for f in target.folders()["people"]} == {None, "a b/c", "y", "z"}
    target.restore(2)
    assert set(target.folders()["people"]) == second and target.compact(1) == 6
    assert len(target.folders()["people"]) == 3 and rows(target.read()["people"]) == rows(target.read(2)["people"])
    assert target.compact(1) is None


def test_table_without_any_row_left_is_empty_and_has_columns(spark, rows):
    target = Target(spark, new_folder(spark, "target"))
    load_dataset(target, {"people": spark.createDataFrame([(1, "x")], "id int, city string")}, {})
    remove_tenant(target, [], {"city": "x"})
    assert rows(target.read()["people"]) == [] and target.read()["people"].columns == ["id", "city"]
    load_dataset(target, {"people": spark.createDataFrame([(1, "y")], "id int, city string")}, {})
    assert rows(target.read()["people"]) == [(1, "y")]
