from __future__ import annotations

import os
from pathlib import Path

import pytest
from pyspark.sql import types as T

from tenantry.llm.common import ship

os.environ["PYTHONPATH"] = os.pathsep.join([str(Path(__file__).resolve().parents[2]), os.environ.get("PYTHONPATH", "")])

DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
)


@pytest.fixture
def documents(spark):
    """A frame of documents from (doc_id, text) pairs, with a column whose name an operator uses inside."""
    ship(spark)

    def of(pairs, parts=3):
        rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in pairs]
        return spark.createDataFrame(rows, DOCS).repartition(parts).selectExpr("*", "'x' AS key", "1 AS chunk", "2 AS size")

    return of


@pytest.fixture
def sample(spark, folder):
    """The documents of the smallest tables, with null, empty, long and repeated ones added."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    long = " ".join(f"w{i}" for i in range(20_000))
    return [*rows, (10**6, None), (10**6 + 1, ""), (10**6 + 2, long), (10**6 + 3, long[1000:]), rows[0], (10**6 + 4, "é" * 60), (10**6 + 5, "è" * 10 + "é" * 60), (10**6 + 6, " \n\t ")]
