"""The registered text queries against their SQL, and on a session without a shared folder."""

import pytest
from compare import connect, difference
from conftest import SF_SMALL, plan_of

import corpus_pipeline
from spendlight.llm import queries as registered

QUERIES, SQL = registered.queries(), registered.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    assert difference(QUERIES[name](spark, SF_SMALL), connect(SF_SMALL), SQL[name]) is None


def test_there_is_one_query_for_each_operator():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]


@pytest.mark.parametrize("name", ["op2_imatch_fingerprints", "op4_source_mix", "op9_license_scan"])
def test_native_queries_stay_in_the_jvm(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_SMALL))
    for node in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_pipeline_keeps_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
            assert 0 < out.count()
            docs = out
    assert out.count() == docs.count()
