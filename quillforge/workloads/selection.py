"""Queries over document names, keys, order and pending work."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillforge.functions import text as X
from quillforge.operators import dedupe, ordering, pairing, pending
from quillforge.sources.objects import locate_output
from quillforge.workloads.inputs import DOCUMENTS_SQL, documents
from quillforge.workloads.registry import query, table

def _number():
    return F.col("doc_id").cast("string")


def _pick(*choices):
    return F.element_at(F.array(*choices), (F.col("doc_id") % len(choices) + 1).cast("int"))


_MEMBERS_SQL = """members AS (
  SELECT doc_id,
    ['batch/document_' || doc_id || '.json', 'batch/' || md5(CAST(doc_id AS VARCHAR)) || '.json', 'x/y/other_' || doc_id || '.json',
     'document_' || doc_id || '.txt', substr(md5(CAST(doc_id AS VARCHAR)), 1, 31) || '.json',
     substr(md5(CAST(doc_id AS VARCHAR)), 1, 31) || 'g.json', 'batch/' || upper(md5(CAST(doc_id AS VARCHAR))) || '.json',
     'document_' || doc_id, 'metadata.json', 'batch/document_.json'][CAST(doc_id % 10 AS INTEGER) + 1] AS member,
    source || '-' || doc_id || ['.tar', '.tar.gz', '.zip', '.tar.gz.tar', '.tgz'][CAST(doc_id % 5 AS INTEGER) + 1] AS archive
  FROM documents)"""


@query(
    "document_members",
    f"""WITH {_MEMBERS_SQL}, named AS (SELECT *, regexp_extract(member, '([^/]*)$', 1) AS base FROM members)
    SELECT doc_id, base, (starts_with(base, 'document_') AND ends_with(base, '.json'))
        OR regexp_full_match(base, '[0-9a-f]{{32}}\\.json') AS is_member,
      ends_with(archive, '.tar') OR ends_with(archive, '.tar.gz') AS is_archive,
      replace(replace(archive, '.tar.gz', ''), '.tar', '') AS batch,
      regexp_replace(member, '^batch/', '') AS inner_name
    FROM named""",
)
def document_members(spark: SparkSession, folder: str) -> DataFrame:
    """Which archive members are documents, and which batch they belong to."""
    digest = F.md5(_number())
    member = _pick(
        F.concat(F.lit("batch/document_"), _number(), F.lit(".json")),
        F.concat(F.lit("batch/"), digest, F.lit(".json")),
        F.concat(F.lit("x/y/other_"), _number(), F.lit(".json")),
        F.concat(F.lit("document_"), _number(), F.lit(".txt")),
        F.concat(F.substring(digest, 1, 31), F.lit(".json")),
        F.concat(F.substring(digest, 1, 31), F.lit("g.json")),
        F.concat(F.lit("batch/"), F.upper(digest), F.lit(".json")),
        F.concat(F.lit("document_"), _number()),
        F.lit("metadata.json"),
        F.lit("batch/document_.json"),
    )
    endings = _pick(*[F.lit(e) for e in (".tar", ".tar.gz", ".zip", ".tar.gz.tar", ".tgz")])
    archive = F.concat("source", F.lit("-"), _number(), endings)
    named = documents(spark, folder).select("doc_id", member.alias("member"), archive.alias("archive"))
    return named.select(
        "doc_id",
        X.base_name(F.col("member")).alias("base"),
        X.is_document_member(F.col("member")).alias("is_member"),
        X.is_archive(F.col("archive")).alias("is_archive"),
        X.batch_name(F.col("archive")).alias("batch"),
        X.remove_prefix(F.col("member"), "batch/").alias("inner_name"),
    )


@query(
    "output_keys",
    """SELECT doc_id, 'notes' || '1_' || (doc_id % 5) || '_3' || '_' || source || '_' || substr(md5(text), 1, 8) || '.json' AS output_key,
      'notes' || '1_' || (doc_id % 5) || '_3' || '_' || source || '_' || md5(text) AS sample_key,
      '1_' || (doc_id % 5) || '_3' AS token FROM documents""",
)
def output_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Sample names and join keys under changing schema versions."""
    version = F.concat(F.lit("1."), (F.col("doc_id") % 5).cast("string"), F.lit(".3.4"))
    token = X.version_token(version)
    return documents(spark, folder).select(
        "doc_id",
        X.output_key("notes", token, F.col("source"), F.col("content")).alias("output_key"),
        X.sample_key("notes", token, F.col("source"), F.col("content")).alias("sample_key"),
        token.alias("token"),
    )


def _hashed(spark: SparkSession, folder: str) -> DataFrame:
    return documents(spark, folder).select(X.content_hash(F.col("content")).alias("content_key"), "doc_id", "source", "n_chars")


@query(
    "first_per_key",
    """SELECT md5(text) AS content_key, doc_id, source, n_chars FROM documents
    QUALIFY row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) = 1""",
)
def first_per_key(spark: SparkSession, folder: str) -> DataFrame:
    """First document of every content."""
    return dedupe.first_per_key(_hashed(spark, folder), ["content_key"], ["doc_id"])


@query(
    "first_document_of_text",
    """SELECT min(doc_id) AS doc_id, md5(text) AS content_key, length(text) AS chars FROM documents WHERE text IS NOT NULL GROUP BY text
    UNION ALL SELECT doc_id, NULL, NULL FROM documents WHERE text IS NULL""",
)
def first_document_of_text(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents, one per text: rows that lose are told by their address in the files, and texts are not sorted."""
    kept = dedupe.one_per_key_of_files(table(spark, folder, "documents"), [F.md5("text")], ["doc_id"])
    return kept.select("doc_id", F.md5("text").alias("content_key"), F.length("text").cast("bigint").alias("chars"))


@query(
    "last_per_key",
    """SELECT md5(text) AS content_key, doc_id, source, n_chars FROM documents
    QUALIFY row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id DESC) = 1""",
)
def last_per_key(spark: SparkSession, folder: str) -> DataFrame:
    """Last document of every content."""
    return dedupe.latest_per_key(_hashed(spark, folder), ["content_key"], ["doc_id"])


@query(
    "capped_sample",
    f"""WITH {DOCUMENTS_SQL} SELECT CAST(row_number() OVER (ORDER BY batch_pos, file_name) - 1 AS VARCHAR) AS record_id,
      doc_id, batch_name, md5(content) AS content_key FROM docs ORDER BY batch_pos, file_name LIMIT 100""",
)
def capped_sample(spark: SparkSession, folder: str) -> DataFrame:
    """First 100 documents in batch and name order, with their record ids."""
    first = ordering.assign_record_id(documents(spark, folder), n=100)
    return first.select("record_id", "doc_id", "batch_name", X.content_hash(F.col("content")).alias("content_key"))


@query(
    "record_ids",
    f"""WITH {DOCUMENTS_SQL} SELECT CAST(row_number() OVER (ORDER BY batch_pos, file_name) - 1 AS VARCHAR) AS record_id,
      doc_id FROM docs""",
)
def record_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Position of every document in batch and name order."""
    return ordering.assign_record_id(documents(spark, folder).drop("content")).select("record_id", "doc_id")


@query(
    "ordered_documents",
    f"WITH {DOCUMENTS_SQL} SELECT doc_id, batch_name, file_name, n_chars FROM docs ORDER BY batch_pos, file_name",
)
def ordered_documents(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in batch and name order."""
    return ordering.document_order(documents(spark, folder).drop("content")).select(
        "doc_id", "batch_name", "file_name", "n_chars"
    )


@query(
    "first_keys",
    """SELECT source, min('out/' || doc_id || '/' || md5(text) || '.out') AS key FROM documents
    WHERE md5(text) < '8' GROUP BY source""",
)
def first_keys(spark: SparkSession, folder: str) -> DataFrame:
    """First matching key of every source."""
    key = F.concat(F.lit("out/"), _number(), F.lit("/"), F.md5("content"), F.lit(".out"))
    hits = documents(spark, folder).filter(F.md5("content") < "8")
    return hits.groupBy("source").agg(F.min(key).alias("key"))


def _done(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "labels").filter("quality = 1").select("doc_id")


@query(
    "pending_documents",
    """SELECT doc_id, source, n_chars FROM documents d
    WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1)""",
)
def pending_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without a finished output."""
    docs = documents(spark, folder).select("doc_id", "source", "n_chars")
    return pending.pending(docs, _done(spark, folder), ["doc_id"])


@query(
    "pending_by_content",
    """SELECT doc_id, 'notes1_0_0_' || source || '_' || md5(text) AS sample_key FROM documents d
    WHERE NOT EXISTS (SELECT 1 FROM documents o JOIN labels l ON l.doc_id = o.doc_id AND l.quality = 1
                      WHERE o.source = d.source AND md5(o.text) = md5(d.text))""",
)
def pending_by_content(spark: SparkSession, folder: str) -> DataFrame:
    """Documents none of whose copies has an output; copies are spread over tasks."""
    key = X.sample_key("notes", "1_0_0", F.col("source"), F.col("content"))
    docs = documents(spark, folder).select("doc_id", key.alias("sample_key"))
    outputs = docs.join(_done(spark, folder), "doc_id").select("sample_key")
    return pending.pending(docs, outputs, spread_by=["doc_id"])


@query(
    "pending_by_filter",
    """SELECT doc_id, md5(text) AS content_key, length(text) AS chars FROM documents d
    WHERE md5(text) IS NULL OR NOT EXISTS (SELECT 1 FROM documents o JOIN labels l ON l.doc_id = o.doc_id AND l.quality = 1
                                           WHERE md5(o.text) = md5(d.text))""",
)
def pending_by_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents of which no copy has an output; those that a filter of the finished keys excludes are not shuffled."""
    docs = documents(spark, folder).select("doc_id", "content", X.content_hash(F.col("content")).alias("content_key"))
    outputs = docs.join(_done(spark, folder), "doc_id").select("content_key")
    left = pending.pending(docs, outputs, ["content_key"], spread_by=["doc_id"], prefilter=True)
    return left.select("doc_id", "content_key", F.length("content").cast("bigint").alias("chars"))


@query(
    "capped_then_pending",
    f"""WITH {DOCUMENTS_SQL}, capped AS (SELECT * FROM docs ORDER BY batch_pos, file_name LIMIT 300)
    SELECT doc_id, source, file_name FROM capped c
    WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = c.doc_id AND l.quality = 1)""",
)
def capped_then_pending(spark: SparkSession, folder: str) -> DataFrame:
    """Of the first 300 documents, those without a finished output."""
    docs = documents(spark, folder).drop("content")
    return pending.capped_then_pending(docs, _done(spark, folder), 300, ["doc_id"]).select("doc_id", "source", "file_name")


_REPLIES_SQL = """answered AS (
  SELECT CAST(doc_id AS VARCHAR) AS record_id, 'reply to ' || source AS reply FROM documents WHERE doc_id % 10 <> 3
  UNION ALL SELECT 'x' || doc_id, 'orphan' FROM documents WHERE doc_id % 50 = 0)"""


def _numbered(spark: SparkSession, folder: str) -> DataFrame:
    return documents(spark, folder).select(_number().alias("record_id"), "doc_id", "source", "n_chars")


def _answers(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    real = docs.filter("doc_id % 10 <> 3").select(
        _number().alias("record_id"), F.concat(F.lit("reply to "), "source").alias("reply")
    )
    orphans = docs.filter("doc_id % 50 = 0").select(
        F.concat(F.lit("x"), _number()).alias("record_id"), F.lit("orphan").alias("reply")
    )
    return real.unionByName(orphans)


@query(
    "attached_replies",
    f"""WITH {_REPLIES_SQL} SELECT record_id, doc_id, source, n_chars, reply FROM documents d
    JOIN answered a ON a.record_id = CAST(d.doc_id AS VARCHAR)""",
)
def attached_replies(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with their replies."""
    return pairing.attach_responses(_numbered(spark, folder), _answers(spark, folder))


@query(
    "orphan_replies",
    f"""WITH {_REPLIES_SQL} SELECT record_id, reply FROM answered
    WHERE record_id NOT IN (SELECT CAST(doc_id AS VARCHAR) FROM documents)""",
)
def orphan_replies(spark: SparkSession, folder: str) -> DataFrame:
    """Replies without a document."""
    return pairing.orphan_replies(_numbered(spark, folder), _answers(spark, folder))


@query(
    "unanswered_documents",
    f"""WITH {_REPLIES_SQL} SELECT CAST(doc_id AS VARCHAR) AS record_id, doc_id, source, n_chars FROM documents
    WHERE CAST(doc_id AS VARCHAR) NOT IN (SELECT record_id FROM answered)""",
)
def unanswered_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without a reply."""
    return pairing.unanswered(_numbered(spark, folder), _answers(spark, folder))


@query(
    "replies_by_position",
    f"""WITH {_REPLIES_SQL},
    r AS (SELECT reply, record_id AS line, row_number() OVER (ORDER BY record_id) AS i FROM answered),
    d AS (SELECT doc_id, row_number() OVER (ORDER BY n_chars, doc_id) AS i FROM documents)
    SELECT CAST(r.i - 1 AS VARCHAR) AS record_id, line, reply, coalesce(doc_id, -1) AS doc_id FROM r LEFT JOIN d ON r.i = d.i""",
)
def replies_by_position(spark: SparkSession, folder: str) -> DataFrame:
    """The i-th reply with the i-th document."""
    answers = _answers(spark, folder).withColumn("line", F.col("record_id"))
    paired = pairing.attach_by_position(_numbered(spark, folder), answers, ["n_chars", "doc_id"], ["line"])
    return paired.select("record_id", "line", "reply", F.coalesce("doc_id", F.lit(-1)).alias("doc_id"))


@query(
    "free_versions",
    """WITH m AS (SELECT DISTINCT source AS name, '1_0_' || (doc_id % 40) AS version FROM documents),
    c AS (SELECT DISTINCT source AS name, '1_0_' || (n_chars % 60) AS version FROM documents)
    SELECT name, version FROM c WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.name = c.name AND m.version = c.version)""",
)
def free_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Wanted dataset versions that are not taken yet."""
    docs = documents(spark, folder)
    version = lambda n, m: F.concat(F.lit("1_0_"), (F.col(n) % m).cast("string")).alias("version")
    manifest = docs.select(F.col("source").alias("name"), version("doc_id", 40)).distinct()
    wanted = docs.select(F.col("source").alias("name"), version("n_chars", 60)).distinct()
    return pending.free_versions(wanted, manifest)


_LISTING_SQL = """listing AS (
  SELECT ['generation/' || source || '/output/' || doc_id || '/job.jsonl.out', 'generation/' || source || '/input/job.jsonl',
          'generation/' || source || '-' || doc_id || '/output/job.jsonl.out', 'generation/' || source || '/output/output/job.jsonl.out',
          'generation/late-' || source || '/output/job.jsonl.tmp'][CAST(doc_id % 5 AS INTEGER) + 1] AS key
  FROM documents),
jobs AS (SELECT DISTINCT 'generation/' || source AS job_id FROM documents
  UNION SELECT DISTINCT 'generation/late-' || source FROM documents
  UNION SELECT DISTINCT 'generation/' || source || '/output' FROM documents
  UNION SELECT DISTINCT 'generation/' || source || '-' || doc_id FROM documents)"""


def _listing(spark: SparkSession, folder: str) -> DataFrame:
    source, job = F.col("source"), "generation/"
    key = _pick(
        F.concat(F.lit(job), source, F.lit("/output/"), _number(), F.lit("/job.jsonl.out")),
        F.concat(F.lit(job), source, F.lit("/input/job.jsonl")),
        F.concat(F.lit(job), source, F.lit("-"), _number(), F.lit("/output/job.jsonl.out")),
        F.concat(F.lit(job), source, F.lit("/output/output/job.jsonl.out")),
        F.concat(F.lit(job + "late-"), source, F.lit("/output/job.jsonl.tmp")),
    )
    return documents(spark, folder).select(key.alias("key"))


@query(
    "ready_jobs",
    f"""WITH {_LISTING_SQL} SELECT job_id FROM jobs WHERE EXISTS (SELECT 1 FROM listing
    WHERE starts_with(key, job_id || '/output/') AND ends_with(key, 'job.jsonl.out'))""",
)
def ready_jobs(spark: SparkSession, folder: str) -> DataFrame:
    """Batch jobs whose output has appeared."""
    docs = documents(spark, folder)
    source = F.concat(F.lit("generation/"), "source")
    jobs = docs.select(
        F.explode(
            F.array(
                source,
                F.concat(F.lit("generation/late-"), "source"),
                F.concat(source, F.lit("/output")),
                F.concat(source, F.lit("-"), _number()),
            )
        ).alias("job_id")
    ).distinct()
    return pending.ready_jobs(jobs, _listing(spark, folder), "job.jsonl")


@query(
    "located_output",
    f"""WITH {_LISTING_SQL} SELECT min(key) AS key FROM listing
    WHERE starts_with(key, 'generation/src1/output/') AND ends_with(key, 'job.jsonl.out')""",
)
def located_output(spark: SparkSession, folder: str) -> DataFrame:
    """First listed output of one job."""
    return locate_output(_listing(spark, folder), "generation/src1/output/*/job.jsonl.out")
