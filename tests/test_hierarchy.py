"""Tables that refer to themselves: extraction goes up, removal goes down."""

from __future__ import annotations

import pytest

from tenantry.model import ForeignKey
from tenantry.operators.extract import extract_dataset
from tenantry.operators.load import residual, without_tenant
from tenantry.operators.validate import reference_findings

KEYS = [
    ForeignKey.of("staff", "boss_id", "staff"),
    ForeignKey.of("staff", "site", "sites"),
    ForeignKey.of("orders", "staff_id", "staff"),
    ForeignKey.of("orders", "checked_by", "staff"),
]


@pytest.fixture
def data(spark):
    make = spark.createDataFrame
    chain = [(i, i - 1 if i else None, "north" if i < 10 else "south", "t2" if i < 10 else "t1") for i in range(12)]
    ring = [(20, 21, "west", "t1"), (21, 22, "west", "t2"), (22, 20, "east", "t3"), (23, 22, "east", "t3"), (24, 99, "east", "t3")]
    return {
        "sites": make([(s,) for s in ("north", "south", "west", "east", "empty")], "id string"),
        "staff": make(chain + ring, "id int, boss_id int, site string, tenant string"),
        "orders": make([(1, 11, None), (2, 11, 0), (3, 5, 11), (4, 3, None), (5, 20, 23), (6, 23, None)], "id int, staff_id int, checked_by int"),
    }


def ids(tables):
    return {name: sorted(r.id for r in df.collect()) for name, df in tables.items()}


def test_extraction_brings_all_bosses(data):
    subset = extract_dataset(data, KEYS, {"tenant": "t1"})
    # a boss brings no orders, but an order may be checked by one
    assert ids(subset) == {"sites": ["east", "north", "south", "west"], "staff": [*range(12), 20, 21, 22], "orders": [1, 2, 3]}
    assert all(f.failed == 0 for f in reference_findings(subset, KEYS).collect())


def test_removal_takes_all_below(data):
    rest = without_tenant(data, KEYS, {"tenant": "t2"})
    assert ids(rest) == {"sites": ["east", "empty", "north", "south", "west"], "staff": [24], "orders": []}
    rest = without_tenant(data, KEYS, {"tenant": "t1"})
    assert ids(rest) == {"sites": ["east", "empty", "north", "south", "west"], "staff": [*range(10), 24], "orders": [4]}
    assert all(r.rows == 0 for r in residual(rest, KEYS, {"tenant": "t1"}).collect())
