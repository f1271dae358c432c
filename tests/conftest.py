from __future__ import annotations

import os

import pytest

from tenantry.session import local_session

SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.shuffle.partitions", 2)
    yield session
    session.stop()


@pytest.fixture(scope="module", autouse=True)
def no_views_left(spark):
    """Views that a module's tests make are not seen by the next."""
    yield
    for table in spark.catalog.listTables():
        if table.isTemporary:
            spark.catalog.dropTempView(table.name)


@pytest.fixture(scope="session")
def folder() -> str:
    return SMALL


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples."""

    def of(df, *columns):
        chosen = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in chosen.collect()), key=lambda t: tuple((v is not None, str(type(v)), v) if not isinstance(v, (list, dict)) else (True, "", str(v)) for v in t))

    return of
