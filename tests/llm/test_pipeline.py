"""The corpus pipeline and the registered queries on the smallest tables."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from rollcall.llm import queries, tokens
from tests.compare import check, connect

SF_DIR = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    found = entry.queries()
    assert [n for n in range(1, 14) if not any(q.startswith(f"op{n}_") for q in found)] == []
    assert "pipeline" in found


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    state, text = check(spark, connect(SF_DIR), name, queries.QUERIES[name], queries.SQL[name], SF_DIR)
    assert state == "ok", text


def test_stages_keep_the_documents_columns(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kinds, texts = docs.dtypes, {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF_DIR)
        assert after.dtypes == kinds, name
        assert {r.doc_id for r in after.collect()} <= set(texts)
        docs = after
    labels = {r.doc_id for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").where("toxic = 1").collect()}
    assert len({r.doc_id for r in docs.collect()} & labels) <= len(labels) // 2
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=tokens.model_path())
    rows = {}
    for r in docs.collect():
        rows.setdefault(r.doc_id, []).append(r.text)
    assert sorted((r.doc_id, r.n_tokens) for r in last) == sorted((i, len(model.encode(t or ""))) for i, own in rows.items() for t in own)
