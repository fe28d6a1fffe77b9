"""Queries over what is written and read back, checked on registration, and asked for again."""

from __future__ import annotations

import contextlib
import uuid
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillforge.functions.chat import chat_sample, dump_json
from quillforge.functions.payload import strict_object
from quillforge.functions.prompts import generation_prompt, main_prompt
from quillforge.functions.tokens import token_count
from quillforge.functions.validation import validate
from quillforge.operators.audits import require_non_empty
from quillforge.operators.inference import RateLimited, Retry, infer, with_retry
from quillforge.plans.prepare import prepare_training_data
from quillforge.schema.kinds import Choice, Field, Record, Text
from quillforge.schema.registry import get_schema, self_check
from quillforge.schema.samples import REPORT, ROLES, TWO_FIELD
from quillforge.session import stage_folder
from quillforge.sinks.commit import committed_path, latest_version, write_committed
from quillforge.sinks.guard import write_if_absent, write_lines
from quillforge.sinks.training import MANIFEST_COLUMNS, export_sample_set, manifest_rows, training_line, write_manifests, write_prepared
from quillforge.sources.training import parse_training_examples, read_training_batches, read_training_examples
from quillforge.workloads.inputs import documents
from quillforge.workloads.registry import query, table

PROMPT = "Name it."


def _place(spark: SparkSession, kind: str) -> str:
    return f"{stage_folder(spark)}/{kind}-{uuid.uuid4().hex}"


def _line(content: Column, number: Column) -> Column:
    answer = F.format_string('{"foo": "x", "bar": %d}', number)
    return training_line(chat_sample(PROMPT, content, answer))


@query(
    "prepared_ranks",
    """WITH lines AS (SELECT source AS batch_name, text, count(*) AS n FROM documents GROUP BY ALL)
    SELECT md5(text) AS content_key, CAST(sum(n) AS BIGINT) AS n, count(DISTINCT batch_name) AS n_ranks FROM lines GROUP BY md5(text)""",
)
def prepared_ranks(spark: SparkSession, folder: str) -> DataFrame:
    """Lines read back from files and shuffled: a rank of its own for every batch and text, one for its copies."""
    place = _place(spark, "ranks")
    docs = documents(spark, folder)
    docs.select(_line(F.col("content"), F.lit(1)).alias("value"), "source").write.partitionBy("source").text(f"{place}/by-source")
    names = sorted(r["source"] for r in docs.select("source").distinct().collect())
    for name in names:
        spark.read.text(f"{place}/by-source/source={name}").write.text(f"{place}/batches/{name}/train.jsonl")
    lines = read_training_batches(spark, f"{place}/batches", names)
    ranked = prepare_training_data(lines, TWO_FIELD, PROMPT, seed=11).table
    content = F.get(F.from_json("value", "messages array<struct<role string, content string>>")["messages"], F.lit(1))
    keyed = ranked.groupBy(F.md5(content["content"]).alias("content_key"))
    return keyed.agg(F.count("*").alias("n"), F.countDistinct("rank").alias("n_ranks"))


@query("prepared_files", "SELECT md5(text) AS content_key, count(*) AS n FROM documents GROUP BY ALL")
def prepared_files(spark: SparkSession, folder: str) -> DataFrame:
    """The prepared table written as lines and read again; without a shuffle, in the order of the batches."""
    docs = documents(spark, folder)
    lines = docs.select("batch_name", "batch_pos", F.col("doc_id").cast("string").alias("line_id"), _line(F.col("content"), F.col("doc_id")).alias("value"))
    place = _place(spark, "prepared")
    write_prepared(prepare_training_data(require_non_empty(lines), TWO_FIELD, PROMPT, shuffle=False).table, place)
    content = F.get(F.from_json("value", "messages array<struct<role string, content string>>")["messages"], F.lit(1))
    return spark.read.text(place).groupBy(F.md5(content["content"]).alias("content_key")).agg(F.count("*").alias("n"))


@query(
    "exported_examples",
    """SELECT md5(text) AS content_key, '{"z": ' || doc_id || '.50, "foo":"' || source || '",  "bar":"' || doc_id || '"}' AS raw_json, count(*) AS n
    FROM documents GROUP BY ALL""",
)
def exported_examples(spark: SparkSession, folder: str) -> DataFrame:
    """Single examples read, their raw payloads exported as written, and read back."""
    raw = F.format_string('{"z": %d.50, "foo":"%s",  "bar":"%d"}', "doc_id", "source", "doc_id")
    whole = F.concat(F.lit('{"content": '), F.to_json(F.array("content")), F.lit(', "output": '), raw, F.lit("}"))
    # The array's brackets go: what is left is the text as a JSON string.
    whole = F.regexp_replace(whole, r'(?s)\A\{"content": \[(.*)\], "output": ', '{"content": $1, "output": ')
    examples = parse_training_examples(documents(spark, folder).select("file_name", whole.alias("value")), TWO_FIELD)
    place = _place(spark, "export")
    export_sample_set(examples.filter("is_valid").withColumnRenamed("file_name", "output_key"), place)
    raw_json = F.regexp_extract("value", r'(?s),"output":(\{.*\})\}\z', 1).alias("raw_json")
    content = F.from_json("value", "content string")["content"]
    back = spark.read.text(place).select(content.alias("content"), raw_json)
    return back.groupBy(F.md5("content").alias("content_key"), "raw_json").agg(F.count("*").alias("n"))


@query("example_files", "SELECT source AS file_name, count(*) AS n_chars FROM documents GROUP BY ALL")
def example_files(spark: SparkSession, folder: str) -> DataFrame:
    """One example file per source of the documents, read as files; files in sub-folders are left out."""
    grouped = table(spark, folder, "documents").groupBy("source").agg(F.count("*").alias("n"))
    example = grouped.select(F.col("source").alias("content"), F.struct(F.lit("x").alias("foo"), F.col("n").alias("bar")).alias("output"))
    place = _place(spark, "examples")
    example.write.option("compression", "none").option("maxRecordsPerFile", 1).json(place)
    example.write.option("compression", "none").json(f"{place}/invalid")
    files = read_training_examples(spark, place, TWO_FIELD)
    return files.filter("is_valid").select(F.col("content").alias("file_name"), F.col("output.bar").alias("n_chars"))


@query(
    "guarded_writes",
    "SELECT 'first' AS kept, count(*) AS n FROM documents UNION ALL SELECT 'forced', count(*) FILTER (WHERE lang = 'en') FROM documents",
)
def guarded_writes(spark: SparkSession, folder: str) -> DataFrame:
    """A second write leaves the first as it is, unless it is forced."""
    docs = table(spark, folder, "documents")
    ids, english = (d.select(F.col("doc_id").cast("string").alias("value")) for d in (docs, docs.filter("lang = 'en'")))
    out = None
    for kept, force in (("first", False), ("forced", True)):
        place = _place(spark, "guard")
        write_if_absent(ids, place, write_lines)
        write_if_absent(english, place, write_lines, force=force)
        counted = spark.read.text(place).agg(F.lit(kept).alias("kept"), F.count("*").alias("n"))
        out = counted if out is None else out.unionByName(counted)
    return out


@query(
    "committed_writes",
    """SELECT 0 AS version, source, count(*) AS n FROM documents GROUP BY source
    UNION ALL SELECT 1, source, count(*) FROM documents WHERE lang = 'en' GROUP BY source""",
)
def committed_writes(spark: SparkSession, folder: str) -> DataFrame:
    """Versions written with a commit marker: a second writer of a version changes nothing, a failed one leaves nothing to read."""
    docs = table(spark, folder, "documents").select("doc_id", "source", "lang")
    place = _place(spark, "commits")
    parquet = lambda df, path: df.write.parquet(path)

    def broken(df: DataFrame, path: str) -> None:
        parquet(df, path)
        raise OSError("lost before the commit")

    with contextlib.suppress(OSError):
        write_committed(docs.limit(1), place, broken)
    for version, rows in ((0, docs), (0, docs.limit(1)), (1, docs.where("lang = 'en'")), (1, docs)):
        write_committed(rows, place, parquet, version)
    read = [spark.read.parquet(committed_path(spark, place, v)).withColumn("version", F.lit(v)) for v in range(latest_version(spark, place) + 1)]
    return reduce(DataFrame.unionByName, read).groupBy("version", "source").agg(F.count("*").alias("n"))


@query(
    "written_manifests",
    """SELECT 'two_field' AS schema, '1_0_0' AS schema_version, source AS short_description, count(*) AS num_samples, 1 AS n_files
    FROM documents GROUP BY source""",
)
def written_manifests(spark: SparkSession, folder: str) -> DataFrame:
    """Manifests of all batches, written at once, and read back from the manifest table and the batches' own files."""
    place = _place(spark, "manifests")
    counts = table(spark, folder, "documents").groupBy(F.col("source").alias("batch_name")).agg(F.count("*").alias("num_samples"))
    rows = manifest_rows(counts, TWO_FIELD.name, TWO_FIELD.version_token, F.col("batch_name"), F.lit(datetime(2024, 1, 1)))
    write_manifests(rows, place, f"{place}-table")
    own = spark.read.text(f"{place}/metadata.yaml").select("batch_name", F.from_json("value", MANIFEST_COLUMNS).alias("m"))
    files = own.where("m.short_description = batch_name").groupBy("batch_name").agg(F.count("*").cast("int").alias("n_files"))
    listed = spark.read.parquet(f"{place}-table").join(files.withColumnRenamed("batch_name", "short_description"), "short_description", "left")
    return listed.select("schema", "schema_version", "short_description", F.col("num_samples").cast("bigint").alias("num_samples"), "n_files")


@query(
    "folded_roles",
    """SELECT conv_id, turn, CASE WHEN turn % 7 <> 6 THEN role END AS role, CASE WHEN turn % 7 = 6 THEN 'role|domain' ELSE '' END AS errors
    FROM conversations""",
)
def folded_roles(spark: SparkSession, folder: str) -> DataFrame:
    """Roles of all turns, spelt in changing case, by a choice that folds it; every seventh is no role."""
    role = F.when(F.col("turn") % 7 == 6, F.concat("role", F.lit("s"))).when(F.col("turn") % 2 == 0, F.upper("role")).otherwise(F.initcap("role"))
    text = F.to_json(F.struct(role.alias("role"), F.col("text").alias("content")))
    parsed = table(spark, folder, "conversations").select("conv_id", "turn", strict_object(text).alias("payload"))
    checked = validate(parsed, "payload", Record(Field("role", Choice(*ROLES, ignore_case=True)), Field("content", Text())))
    listed = F.array_join(F.transform("errors", lambda e: F.concat(e["path"], F.lit("|"), e["code"])), ",")
    return checked.select("conv_id", "turn", F.col("output.role").alias("role"), listed.alias("errors"))


@query(
    "folded_choices",
    """SELECT doc_id, CASE WHEN doc_id % 4 = 3 THEN NULL ELSE 'final' END AS status, CASE WHEN doc_id % 4 IN (0, 1) THEN 'high' END AS grade,
      CASE WHEN doc_id % 4 = 3 THEN 1 ELSE 0 END AS n_errors FROM documents""",
)
def folded_choices(spark: SparkSession, folder: str) -> DataFrame:
    """Choices read in any case, nested ones too; another word is an error."""
    texts = (
        '{"status": "FINAL", "finding": {"grade": "High", "size": 1}}',
        '{"status": "Final", "finding": {"grade": "hIGH", "size": null}}',
        '{"status": "final", "finding": null, "notes": ["Draft"]}',
        '{"status": "finalX", "finding": null}',
    )
    text = F.element_at(F.array(*map(F.lit, texts)), (F.col("doc_id") % 4 + 1).cast("int"))
    parsed = table(spark, folder, "documents").select("doc_id", strict_object(text).alias("payload"))
    checked = validate(parsed, "payload", REPORT.root)
    return checked.select("doc_id", F.col("output.status").alias("status"), F.col("output.finding.grade").alias("grade"), F.size("errors").alias("n_errors"))


@query(
    "schemas_by_name",
    """SELECT name, count(*) AS n, CAST(sum(has_example) AS BIGINT) AS n_with_example FROM (
      SELECT ['one_field', 'two_field', 'event_payload', 'entity_payload', 'report_payload'][CAST(doc_id % 5 AS INTEGER) + 1] AS name,
        CASE WHEN doc_id % 5 IN (2, 3) THEN 1 ELSE 0 END AS has_example FROM documents) GROUP BY name""",
)
def schemas_by_name(spark: SparkSession, folder: str) -> DataFrame:
    """Registered schemas looked up by name, their own examples checked, their prompts filled in for every document."""
    names = ("one_field", "two_field", "event_payload", "entity_payload", "report_payload")
    schemas = [get_schema(n) for n in names]
    for schema in schemas:
        self_check(spark, schema)
    rows = [(s.name, generation_prompt(s), main_prompt(s)) for s in schemas]
    prompts = F.element_at(F.array(*[F.struct(*map(F.lit, r)) for r in rows]), (F.col("doc_id") % 5 + 1).cast("int"))
    chosen = table(spark, folder, "documents").select(prompts.alias("p")).select(*[F.col(f"p.col{k}").alias(n) for k, n in enumerate(("name", "long", "short"), 1)])
    with_example = F.contains("long", F.lit("For example")) & ~F.contains("short", F.lit("For example"))
    return chosen.groupBy("name").agg(F.count("*").alias("n"), F.count_if(with_example).alias("n_with_example"))


def _hesitant() -> object:
    """A completer that asks to slow down before every second answer."""
    asked = {"n": 0}

    def complete(request):
        asked["n"] += 1
        if asked["n"] % 2:
            raise RateLimited
        return request.user[:1]

    return with_retry(complete, Retry(retries=2, sleep=lambda _: None))


@query("retried_calls", "SELECT doc_id, substr(text, 1, 1) AS reply, CAST(NULL AS VARCHAR) AS error FROM documents")
def retried_calls(spark: SparkSession, folder: str) -> DataFrame:
    """Calls that are put off and made again."""
    docs = table(spark, folder, "documents").select("doc_id", F.col("text").alias("content"))
    return infer(docs, _hesitant, PROMPT).select("doc_id", "reply", "error")


@query(
    "template_tokens",
    """SELECT conv_id, CAST(sum(len(regexp_extract_all(text, '[^ \\t\\n\\r\\f\\v]+')) + 2) + 1 AS BIGINT) AS n_tokens
    FROM conversations GROUP BY conv_id""",
)
def template_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of whole conversations by another chat template: turn by turn, summed before the shuffle."""
    turns = table(spark, folder, "conversations")
    written = F.concat(F.lit("<"), "role", F.lit(">\n"), "text", F.lit("\n</turn>\n"))
    counted = turns.select("conv_id", token_count(written).alias("n"))
    return counted.groupBy("conv_id").agg((F.sum("n") + 1).cast("bigint").alias("n_tokens"))
