from __future__ import annotations

import pytest

import corpus_pipeline
import oracle
import rows
from auditloom.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_its_sql(name, spark, folder):
    got = oracle.spark_table(QUERIES[name](spark, folder))
    assert oracle.differences(got, oracle.sql_table(oracle.connect(folder), SQL[name])) == []


def test_all_stages(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    total = spark.read.parquet(f"{folder}/documents.parquet").count()
    ids = [r["doc_id"] for r in out.select("doc_id").collect()]
    assert 0.7 * total < len(ids) == len(set(ids)) <= total


@pytest.mark.parametrize("data", [rows.DOCUMENTS, []], ids=["awkward", "empty"])
def test_stages_take_awkward_rows(spark, folder, data):
    docs = rows.documents(spark, data)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        assert out.count() <= len(data)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
