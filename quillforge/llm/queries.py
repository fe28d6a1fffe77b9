"""Queries over the given tables, one for each operator, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quillforge.llm import periodic, pseudolikelihood
from quillforge.llm.alignment import align_documents
from quillforge.llm.bitsliced import search
from quillforge.llm.decontaminate import contamination
from quillforge.llm.html import extract_main_text
from quillforge.llm.neardup import similarity_join
from quillforge.llm.packing import pack_documents
from quillforge.llm.quality import learn, score_quality
from quillforge.llm.substring import deduplicated
from quillforge.llm.tokenfile import round_trip
from quillforge.llm.tokens import count_tokens
from quillforge.llm.warc import archive_pages
from quillforge.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name."""

    def register(build: Query) -> Query:
        QUERIES[build.__name__] = lambda spark, folder: build(configure(spark), folder)
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query()
def op1_compression_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality scores of the documents, learnt from the labels outside the held-out fold."""
    docs = table(spark, folder, "documents")
    return score_quality(docs, learn(docs, table(spark, folder, "labels")))


@query()
def op2_warc_bundles(spark: SparkSession, folder: str) -> DataFrame:
    """Pages written to seekable WARC bundles and read back."""
    return archive_pages(table(spark, folder, "pages"))


@query(
    r"""
    WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
    s AS (SELECT doc_id, s, md5(array_to_string(w[s:s + 49], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS s FROM d WHERE len(w) >= 50)),
    f AS (SELECT h, min(doc_id) AS f FROM s GROUP BY h),
    x AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS p FROM s JOIN f USING (h) WHERE doc_id > f),
    r AS (SELECT doc_id, list(p) AS p, count(*) AS n FROM x GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed,
           sha256(CASE WHEN n IS NULL THEN array_to_string(w, ' ')
                  ELSE array_to_string(list_filter(w, lambda v, i: NOT list_contains(p, i)), ' ') END) AS kept_sha256
    FROM d LEFT JOIN r USING (doc_id)
    """
)
def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words of the documents that are left without passages of smaller documents."""
    return deduplicated(table(spark, folder, "documents"))


@query()
def op4_html_consensus(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of the pages by the paths their hosts agree on."""
    return extract_main_text(table(spark, folder, "pages"))


@query(
    """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
          FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
    FROM s QUALIFY rank <= 20
    """
)
def op5_bit_sliced_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest vectors by integer inner product, for every twentieth vector."""
    return search(table(spark, folder, "embeddings"))


@query()
def op6_masked_pseudo_likelihood(spark: SparkSession, folder: str) -> DataFrame:
    """Log-probability of the documents' words, each from its neighbours on both sides."""
    docs = table(spark, folder, "documents")
    return pseudolikelihood.score(docs, pseudolikelihood.learn(docs))


@query()
def op7_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Near copies among the documents: class and number of links of each."""
    return similarity_join(table(spark, folder, "documents")).drop("text_hash")


ASCII = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = "regexp_extract_all(" + ASCII + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
CONTAMINATION_SQL = f"""
WITH i AS (SELECT item_id, {WORDS.format("text")} AS w FROM benchmark WHERE text IS NOT NULL),
win AS (SELECT DISTINCT item_id, w[s:s + 12] AS q, len(w[s:s + 12]) AS l
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
d AS (SELECT doc_id, coalesce({WORDS.format("text")}, []) AS w FROM documents),
p AS (SELECT doc_id, l, s, w[s:s + l - 1] AS q FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS s FROM d), (SELECT DISTINCT l FROM win)),
h AS (SELECT DISTINCT p.doc_id, win.item_id, s, p.l FROM p JOIN win ON p.q = win.q AND p.l = win.l),
c AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + l)) AS x FROM h) GROUP BY doc_id),
n AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM h GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)
"""


@query(CONTAMINATION_SQL)
def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of the documents that occur in benchmark windows of 13 words."""
    found = contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.drop("near_items", "key")


@query()
def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of the documents by a unigram vocabulary."""
    return count_tokens(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query()
def op10_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Documents packed into sequences of 1024 tokens."""
    return pack_documents(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query()
def op11_pair_bitmaps(spark: SparkSession, folder: str) -> DataFrame:
    """Links between the ids of two tokenizers in the documents, scored by the pairs' counts over the corpus."""
    docs = table(spark, folder, "documents")
    return align_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


@query()
def op12_recompression_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of the documents' words, some documents ending in planted repeats."""
    return periodic.detect(table(spark, folder, "documents"), prepare=periodic.planted)


@query()
def op13_huffman_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of the documents, written to Huffman-coded files and read back."""
    return round_trip(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
