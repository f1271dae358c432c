"""The five stages on the smallest tables, each against its operator's own brute force."""

from __future__ import annotations

import re

import corpus_pipeline
from tenantry.llm import queries
from tenantry.state import materialize
from tests.llm.test_near_dedup import expected_classes
from tests.llm.test_repeats import expected_strings


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(materialize(stage(spark, seen[-1], folder), name))
        assert name == "packing" or seen[-1].columns == columns
    first, clean, single, cut, unseen, packed = (df.collect() for df in seen)
    toxic = {r.doc_id for r in queries.QUERIES["op1_classifier_chain"](spark, folder).filter("toxic").collect()}
    assert {r.doc_id for r in clean} == {r.doc_id for r in first} - toxic
    classes = expected_classes([(r.doc_id, r.text) for r in clean])
    assert sorted(r.doc_id for r in single) == sorted(set(classes.values()))
    removed = {i: n for i, _, n, *_ in expected_strings([(r.doc_id, r.text) for r in single])}
    before = {r.doc_id: r.text for r in single}
    for r in cut:
        assert r.n_chars == len(r.text) and (removed[r.doc_id] or r.text == before[r.doc_id])
    assert {r.doc_id for r in single} - {r.doc_id for r in cut} <= {i for i, n in removed.items() if n}
    items = [" ".join(re.findall(r"\w+", r.text.lower())) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    for r in unseen:  # no item is left whole
        own = " ".join(re.findall(r"\w+", r.text.lower()))
        assert not any(item in own for item in items)
    assert {r.doc_id for r in packed} == {r.doc_id for r in unseen}


def test_run_and_guard(spark, folder):
    import __spark_entry__

    assert not corpus_pipeline.run(spark, folder).isEmpty()
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in __spark_entry__.queries() if re.match(r"op\d+_", q)}
    assert "pipeline" in __spark_entry__.queries()
