from __future__ import annotations

import corpus_pipeline as cp
import plain
from llm_fixtures import SMALL, entry  # noqa: F401

from caudal.session import materialise


def test_stages_in_turn(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in cp.STAGES[:-1]:
        docs = materialise(stage(spark, docs, SMALL))
        assert docs.columns == columns, name
        rows = docs.collect()
        assert all(r.n_chars == len(r.text) for r in rows)
        if name == "language_id":
            assert 0.95 * before < len(rows) <= before
        if name == "near_dedup":
            found, _ = plain.components([(r.doc_id, r.text) for r in rows], 80)
            assert all(found[r.doc_id] == r.doc_id for r in rows)
    pieces = cp.STAGES[-1][1](spark, docs, SMALL).collect()
    assert {p.doc_id for p in pieces} == {r.doc_id for r in docs.select("doc_id").collect()}
    assert [n for n, _ in cp.STAGES] == ["language_id", "near_dedup", "substring_dedup", "mixing", "packing"]


def test_run_equals_the_stages_and_reruns(spark, entry):
    a = sorted((p.doc_id, p.start, p.length, p.ids_crc32) for p in entry["pipeline"](spark, SMALL).collect())
    b = sorted((p.doc_id, p.start, p.length, p.ids_crc32) for p in cp.run(spark, SMALL).collect())
    assert a == b and a


def test_no_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in cp.STAGES:
        docs = materialise(stage(spark, docs, SMALL))
    assert docs.collect() == []
