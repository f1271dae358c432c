"""Runs registered queries against their SQL in DuckDB.

``python -m tests.oracle <folder> [query ...]`` prints one line per query.
With TEST_LIMITS=broadcast, shuffle or salted all joins take the path that large
tables take.
"""

from __future__ import annotations

import datetime
import decimal
import os
import sys
import time
from collections import Counter

import duckdb

from tenantry import skew

LARGE = {
    "broadcast": skew.limits(small_bytes=0),
    "shuffle": skew.limits(small_bytes=0, broadcast_bytes=0, hot_rows=10**12),
    "salted": skew.limits(small_bytes=0, broadcast_bytes=0, hot_rows=20, sample_share=1.0, salts=4),
}
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, float):
        return int(value) if value == int(value) else value
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def compare(con, df, sql: str) -> str | None:
    """What differs, or None."""
    relation = con.sql(sql)
    columns, expected = list(relation.columns), relation.fetchall()
    got = [tuple(row) for row in df.collect()]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(columns)}"
    ours, theirs = rows_of(df.columns, got), rows_of(columns, expected)
    if ours == theirs:
        return None
    extra, lacking = list((ours - theirs).items())[:3], list((theirs - ours).items())[:3]
    return f"{len(got)} rows instead of {len(expected)}; too many {extra}; lacking {lacking}"


def main(folder: str, names: list[str]) -> int:
    from tenantry.plans import queries as registered
    from tenantry.session import local_session

    if os.environ.get("TEST_LIMITS"):
        skew.set_limits(LARGE[os.environ["TEST_LIMITS"]])
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    all_queries, sql = registered.queries(), registered.oracle_sql()
    bad = 0
    for name in names or all_queries:
        start = time.monotonic()
        try:
            df = all_queries[name](spark, folder)
            if name in sql:
                problem = compare(con, df, sql[name])
                if problem is None and df.isEmpty():
                    problem = "equal but empty"
            else:
                problem = f"no SQL, {df.count()} rows"
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{time.monotonic() - start:6.1f}s {name}: {problem or 'ok'}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(min(1, main(sys.argv[1], sys.argv[2:])))
