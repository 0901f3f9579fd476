"""The pipeline, stage by stage, against the operators' brute force."""

from __future__ import annotations

import corpus_pipeline
from galley.llm import pii
from tests.llm.test_text import brute_components, documents, plain_spans

SF_DIR = "/root/testdata/sf0.001"


def test_every_stage_does_its_work(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, tables = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, tables[-1], SF_DIR).write.parquet(f"{tmp_path}/{name}")
        tables.append(spark.read.parquet(f"{tmp_path}/{name}"))
    assert all(t.columns == columns for t in tables[:-1])
    raw, known, single, clean, packed = (t.collect() for t in tables)
    assert {r.doc_id for r in known} == {r.doc_id for r in raw if any(c.isalpha() for c in r.text or "")}
    roots = brute_components([(r.doc_id, r.text) for r in known])
    assert sorted(r.doc_id for r in single) == sorted(k for k, (_, root) in roots.items() if k == root)
    before = {r.doc_id: r for r in single}
    for r in clean:
        spans = plain_spans(before[r.doc_id].text)
        assert (r.text == before[r.doc_id].text) == (not spans)
        assert not pii.base_spans(r.text) and r.n_chars == len(r.text)
    assert {r.doc_id for r in packed} == {r.doc_id for r in clean}
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 4


def test_run_gives_rows(spark):
    assert not corpus_pipeline.run(spark, SF_DIR).isEmpty()


def test_unlabelled_documents_pass_the_language_stage(spark):
    docs = documents(spark, [(1, "the cat"), (2, None), (3, "12 !!"), (4, ""), (5, "12 é"), (6, "猫")])
    kept = corpus_pipeline.known_language(spark, docs, SF_DIR)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 5, 6]
