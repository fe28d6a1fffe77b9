"""The registered queries: SQL where there is some, shapes where not, and the pipeline."""

import pytest
from oracle import connect, differences

import corpus_pipeline
from quillforge.llm.queries import ORACLES, QUERIES
from quillforge.session import stage

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, name):
    assert differences(QUERIES[name](spark, SMALL), connect(SMALL), ORACLES[name]) == []


def test_each_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_stages(spark):
    docs = start = spark.read.parquet(f"{SMALL}/documents.parquet")
    counts = [docs.count()]
    for name, apply in corpus_pipeline.STAGES:
        docs = stage(apply(spark, docs, SMALL))
        if name != "packing":
            assert docs.schema == start.schema, name
            assert docs.count() <= counts[-1]
        counts.append(docs.count())
    assert counts[1] < counts[0] and counts[2] < counts[1]
    assert corpus_pipeline.run(spark, SMALL).select("doc_id").distinct().count() == counts[4]


def test_pipeline_of_awkward_rows(spark, awkward):
    docs = awkward
    for name, apply in corpus_pipeline.STAGES:
        docs = stage(apply(spark, docs, SMALL))
        assert name == "packing" or docs.columns == awkward.columns
    empty = awkward.limit(0)
    for _, apply in corpus_pipeline.STAGES:
        empty = stage(apply(spark, empty, SMALL))
    assert empty.count() == 0
