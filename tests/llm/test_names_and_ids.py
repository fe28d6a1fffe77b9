"""Columns named like the operators' own, extra columns everywhere, and ids that several rows share."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quillforge.llm.bitsliced import search
from quillforge.llm.html import extract_main_text
from quillforge.llm.warc import archive_pages
from quillforge.session import stage

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_with_clashing_columns(spark, name):
    apply = dict(corpus_pipeline.STAGES)[name]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("doc_id < 80")
    own = ["_id", "_hash", "_own", "_key", "ID", "own", "rep", "cls", "text_hash", "key", "_bloom_maybe", "_bloom_block"]
    more = docs.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in own if c != "ID"}).withColumn("_Hash_", F.lit(1))
    got, want = (stage(apply(spark, d, SMALL)) for d in (more, docs))
    if name == "packing":
        assert got.count() == want.count()
        return
    assert got.columns == more.columns and got.schema.simpleString() == more.schema.simpleString()
    assert sorted(map(tuple, got.select(docs.columns).collect())) == sorted(map(tuple, want.collect()))
    assert all(r["_own"] == f"_own{r['doc_id']}" for r in got.collect())


def test_pages_and_vectors_with_extra_columns(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").limit(40)
    more = pages.withColumns({c: F.lit(1) for c in ("payload", "digest", "path", "at", "text", "host", "revisit", "response")})
    for apply in (archive_pages, extract_main_text):
        assert sorted(apply(more).collect()) == sorted(apply(pages).collect())
    vectors = spark.read.parquet(f"{SMALL}/embeddings.parquet").where("vec_id < 100")
    more = vectors.withColumns({c: F.lit(1) for c in ("v", "dim", "block", "part", "query", "rank", "score")})
    assert sorted(search(more, k=3).collect()) == sorted(search(vectors, k=3).collect())


def test_queries_of_one_id(spark):
    """Python's hash of -1 and -2 is the same, that of the vectors too."""
    rows = [(20, [-1.0, 32.0]), (20, [-2.0, 32.0]), (1, [1.0, 2.0]), (2, [-1.0, 1.0]), (3, [0.5, -3.0])]
    got = search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=2, scale=1).collect()
    want = []
    for _, q in rows[:2]:
        scores = sorted((-sum(int(a // 1) * int(b // 1) for a, b in zip(q, v, strict=True)), i) for i, v in rows[2:])
        want += [(20, k, i, -s) for k, (s, i) in enumerate(scores[:2], 1)]
    assert sorted(map(tuple, got)) == sorted(want) and len(got) == 4
