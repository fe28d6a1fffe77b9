"""Queries over batches as wholes, and over names, versions and times."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillforge.functions import text as X
from quillforge.operators import audits
from quillforge.sinks.training import manifest_rows
from quillforge.workloads.inputs import documents
from quillforge.workloads.registry import query, table


@query("document_count", "SELECT source AS batch_name, count(*) AS n_documents FROM documents GROUP BY source")
def document_count(spark: SparkSession, folder: str) -> DataFrame:
    """Documents per batch."""
    return audits.document_count(documents(spark, folder))


_FILES_SQL = """files AS (
  SELECT source AS batch_name, source || ['/train.jsonl/part-' || doc_id, '/metadata.yaml', '/extra-' || (n_chars % 3) || '.jsonl',
     '/train.jsonl.bak'][CASE WHEN CAST(substr(source, 4) AS INTEGER) % 3 = 1 AND doc_id % 4 = 2 THEN 3
       WHEN CAST(substr(source, 4) AS INTEGER) % 3 = 2 THEN 2 WHEN doc_id % 4 = 0 THEN 4 ELSE 1 END] AS key
  FROM documents),
requested AS (SELECT DISTINCT source AS batch_name FROM documents)"""


@query(
    "single_file",
    f"""WITH {_FILES_SQL}, units AS (
      SELECT batch_name, count(DISTINCT regexp_extract(key, '^(.*?\\.jsonl)(/.*)?$', 1)) AS n_files FROM files
      WHERE regexp_matches(key, '^.*?\\.jsonl(/.*)?$') GROUP BY batch_name)
    SELECT r.batch_name, coalesce(n_files, 0) AS n_files, coalesce(n_files, 0) = 1 AS ok
    FROM requested r LEFT JOIN units u ON u.batch_name = r.batch_name""",
)
def single_file(spark: SparkSession, folder: str) -> DataFrame:
    """How many training files every batch has; one is right."""
    number, doc = F.col("batch_pos"), F.col("doc_id")
    name = (
        F.when((number % 3 == 1) & (doc % 4 == 2), F.format_string("/extra-%d.jsonl", F.col("n_chars") % 3))
        .when(number % 3 == 2, "/metadata.yaml")
        .when(doc % 4 == 0, "/train.jsonl.bak")
        .otherwise(F.concat(F.lit("/train.jsonl/part-"), doc.cast("string")))
    )
    docs = documents(spark, folder)
    listing = docs.select("batch_name", F.concat("batch_name", name).alias("key"))
    counts = audits.files_per_batch(listing, docs.select("batch_name").distinct())
    return counts.select("batch_name", "n_files", (F.col("n_files") == 1).alias("ok"))


@query(
    "batch_manifest",
    """SELECT 'notes' AS schema, '1_0_0' AS schema_version, source AS short_description, 'batch ' || source AS description,
      count(*) FILTER (WHERE trim(text, E' \\n\\t\\r') <> '') AS num_samples FROM documents GROUP BY source""",
)
def batch_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Manifest facts of every batch, counted from its lines."""
    nonblank = F.col("content").rlike(r"(?U)[^\s\x1c-\x1f]")
    counts = documents(spark, folder).groupBy(F.col("source").alias("batch_name")).agg(F.count_if(nonblank).alias("num_samples"))
    version, description = X.version_token(F.lit("1.0.0.7")), F.concat(F.lit("batch "), "batch_name")
    return manifest_rows(counts, "notes", version, F.col("batch_name"), description=description).drop("batch_name", "created_at")


@query("sample_count", "SELECT count(*) FILTER (WHERE trim(text, E' \\n\\t\\r') <> '') AS num_samples FROM documents")
def sample_count(spark: SparkSession, folder: str) -> DataFrame:
    """Lines that are not blank."""
    return audits.sample_count(table(spark, folder, "documents"), "text")


@query(
    "step_budget",
    """WITH n AS (SELECT source AS batch_name, count(*) AS n_documents FROM documents GROUP BY source),
    i AS (SELECT *, CAST(ceil(n_documents / 4.0) * 3 AS BIGINT) AS iters FROM n),
    s AS (SELECT *, iters // 2 AS schedule_steps FROM i)
    SELECT *, CAST(round_even(0.25 * schedule_steps, 0) AS BIGINT) AS warmup FROM s""",
)
def step_budget(spark: SparkSession, folder: str) -> DataFrame:
    """Training steps per batch."""
    counts = audits.document_count(documents(spark, folder))
    return audits.step_budget(counts, "n_documents", epochs=3, batch_size=4, accumulation=2, warmup_ratio=0.25)


_TITLE_SQL = "p_name || ' / ' || p_type || '  #' || p_brand || '--' || repeat(p_name, CAST(p_partkey % 5 AS INTEGER))"


@query(
    "slugs",
    f"""SELECT p_partkey, substr(regexp_replace(regexp_replace(lower({_TITLE_SQL}), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 40) AS slug
    FROM part""",
)
def slugs(spark: SparkSession, folder: str) -> DataFrame:
    """Part names as slugs."""
    title = F.concat(
        "p_name", F.lit(" / "), "p_type", F.lit("  #"), "p_brand", F.lit("--"),
        F.expr("repeat(p_name, CAST(p_partkey % 5 AS INT))"),
    )
    return table(spark, folder, "part").select("p_partkey", X.slug(title).alias("slug"))


@query(
    "semver",
    """WITH v AS (SELECT p_partkey, [p_size || '.' || (p_partkey % 7) || '.' || (p_partkey % 11), p_size || '.' || p_partkey,
        p_size || '.x.1', '1.2.3.' || p_size][CAST(p_partkey % 4 AS INTEGER) + 1] AS version FROM part),
    s AS (SELECT *, regexp_full_match(version, '[0-9]+[.][0-9]+[.][0-9]+') AS ok FROM v)
    SELECT p_partkey, ok, CASE WHEN ok THEN CAST(split_part(version, '.', 1) AS INTEGER) ELSE -1 END AS major,
      CASE WHEN ok THEN CAST(split_part(version, '.', 2) AS INTEGER) ELSE -1 END AS minor,
      CASE WHEN ok THEN CAST(split_part(version, '.', 3) AS INTEGER) ELSE -1 END AS patch,
      CASE WHEN ok THEN replace(version, '.', '_') ELSE '' END AS joined FROM s""",
)
def semver(spark: SparkSession, folder: str) -> DataFrame:
    """Version texts taken apart and put together again."""
    size, part = F.col("p_size").cast("string"), F.col("p_partkey")
    variants = F.array(
        F.concat_ws(".", size, (part % 7).cast("string"), (part % 11).cast("string")),
        F.concat_ws(".", size, part.cast("string")),
        F.concat(size, F.lit(".x.1")),
        F.concat(F.lit("1.2.3."), size),
    )
    version = F.element_at(variants, (part % 4 + 1).cast("int"))
    v = table(spark, folder, "part").select("p_partkey", X.split_semver(version).alias("v"))
    number = lambda name: F.coalesce(F.col(f"v.{name}"), F.lit(-1)).alias(name)
    joined = F.when(F.col("v").isNotNull(), X.join_semver(F.col("v.major"), F.col("v.minor"), F.col("v.patch"), "_"))
    return v.select(
        "p_partkey",
        F.col("v").isNotNull().alias("ok"),
        number("major"),
        number("minor"),
        number("patch"),
        F.coalesce(joined, F.lit("")).alias("joined"),
    )


@query(
    "run_names",
    """SELECT event_id, strftime(ts, '%Y%m%d-%H%M%S') || '_' || event_type AS run,
      strftime(ts, '%Y%m%d-%H%M%S') || CASE WHEN event_id % 3 = 0 THEN '' ELSE '-' || event_type || '-run' END AS job,
      'generation/' || strftime(ts, '%Y-%m-%d-%H%M') AS batch_job FROM events""",
)
def run_names(spark: SparkSession, folder: str) -> DataFrame:
    """Run, job and batch-job names from event times."""
    described = F.when(F.col("event_id") % 3 == 0, "***").otherwise(F.concat("event_type", F.lit("  RUN!")))
    return table(spark, folder, "events").select(
        "event_id",
        X.run_name(F.col("ts"), F.col("event_type")).alias("run"),
        X.job_name(F.col("ts"), described).alias("job"),
        X.batch_job_id(F.col("ts")).alias("batch_job"),
    )


@query("previews", "SELECT doc_id, substr(text, 1, 500) AS preview FROM documents")
def previews(spark: SparkSession, folder: str) -> DataFrame:
    """Start of every text."""
    return table(spark, folder, "documents").select("doc_id", X.preview(F.col("text")).alias("preview"))
