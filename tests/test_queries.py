"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

from tenantry.plans import queries as registered
from tests.oracle import compare, connect

QUERIES, SQL = registered.queries(), registered.oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, folder, con, name):
    assert compare(con, QUERIES[name](spark, folder), SQL[name]) is None


def test_entry_runs(spark):
    import __spark_entry__

    metrics = __spark_entry__.entry(spark)
    assert metrics.filter("phase = 'loading'").count() > 0
    assert metrics.filter("NOT success").isEmpty()
