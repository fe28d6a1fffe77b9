"""Queries that go through model calls, files, archives and streams."""

from __future__ import annotations

import io
import json
import tarfile
import uuid
from collections.abc import Callable, Iterator
from datetime import datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillforge.functions.chat import dump_json
from quillforge.functions.markup import html_to_text, markup_to_text, resolve_references
from quillforge.functions.tokens import length_verdict, token_count, whitespace_tokens
from quillforge.operators.inference import Completion
from quillforge.plans.generate import batch_requests, batch_results, generate
from quillforge.plans.prepare import prepare_training_data
from quillforge.plans.publish import publish_batch
from quillforge.operators.routing import VALID, to_samples
from quillforge.schema.samples import TWO_FIELD
from quillforge.session import stage_folder
from quillforge.sinks.tables import write_batch_requests, write_quarantine, write_samples
from quillforge.sources.archives import document_members, documents_of, open_location
from quillforge.sources.objects import list_document_batches
from quillforge.sources.replies import read_batch_outputs
from quillforge.sources.training import parse_training_examples, read_training_batches
from quillforge.streaming.backfill import backfill_stream, read_document_stream
from quillforge.workloads.inputs import documents
from quillforge.workloads.registry import query, spread, table

SYSTEM = "Count the characters."


def stub_completer() -> Callable[[Completion], str | None]:
    """Stands in for a model: the answer, good or bad, depends only on the text."""

    def complete(request: Completion) -> str | None:
        n = len(request.user)
        good = json.dumps({"foo": f"{n % 100:02d}", "bar": n})
        answers = [f"<output>{good}</output>", f"Sure! {good}", json.dumps({"foo": n}), "No idea.", None]
        return answers[n % 5]

    return complete


_STUB_SQL = """unique_docs AS (
  SELECT source, text, min_by(doc_id, (batch_pos, file_name)) AS doc_id, length(text) AS n
  FROM (SELECT *, CAST(substr(source, 4) AS INTEGER) AS batch_pos, 'document_' || doc_id || '.json' AS file_name FROM documents)
  GROUP BY source, text),
answered AS (
  SELECT *, ['valid', 'valid', 'schema_invalid', 'no_json', 'error'][CAST(n % 5 AS INTEGER) + 1] AS status FROM unique_docs)"""


@query(
    "infer_stub",
    f"WITH {_STUB_SQL} SELECT doc_id, status, CASE WHEN status = 'valid' THEN n ELSE -1 END AS bar FROM answered",
)
def infer_stub(spark: SparkSession, folder: str) -> DataFrame:
    """Real-time generation over all documents with a stand-in model."""
    routed = generate(documents(spark, folder), TWO_FIELD, stub_completer, SYSTEM, threads=2)
    return routed.select("doc_id", "status", F.coalesce("output.bar", F.lit(-1)).alias("bar"))


@query(
    "infer_backfill",
    f"""WITH {_STUB_SQL} SELECT doc_id, status FROM answered a WHERE NOT EXISTS (
      SELECT 1 FROM documents o JOIN labels l ON l.doc_id = o.doc_id AND l.quality = 1
      WHERE o.source = a.source AND o.text = a.text)""",
)
def infer_backfill(spark: SparkSession, folder: str) -> DataFrame:
    """Generation for documents without an output only."""
    docs = documents(spark, folder)
    done = docs.join(table(spark, folder, "labels").filter("quality = 1"), "doc_id", "left_semi")
    samples = done.withColumns({"payload": F.lit("{}"), "status": F.lit(VALID), "output": F.struct(F.lit(1).alias("x"))})
    routed = generate(docs, TWO_FIELD, stub_completer, SYSTEM, outputs=to_samples(samples, TWO_FIELD))
    return routed.select("doc_id", "status")


@query(
    "batch_job",
    """SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN 'unanswered' WHEN n_chars % 9 = 0 THEN 'bad_reply' WHEN n_chars % 4 IN (0, 2) THEN 'valid'
      WHEN n_chars % 4 = 1 THEN 'no_json' ELSE 'schema_invalid' END AS status FROM documents
    UNION ALL SELECT NULL, 'orphan' FROM documents WHERE doc_id % 11 = 0 AND n_chars % 9 <> 0""",
)
def batch_job(spark: SparkSession, folder: str) -> DataFrame:
    """Batch generation through request and reply files; some replies are broken records."""
    place = f"{stage_folder(spark)}/batch-{uuid.uuid4().hex}"
    docs = documents(spark, folder)
    numbered, _ = batch_requests(docs, SYSTEM)
    write_batch_requests(numbered, SYSTEM, f"{place}/input")
    requests = spark.read.schema(
        "recordId string, modelInput struct<anthropic_version string, max_tokens int, "
        "messages array<struct<role string, content array<struct<type string, text string>>>>>"
    ).json(f"{place}/input")
    n = F.length(F.element_at(F.element_at(F.col("modelInput.messages"), 1)["content"], 1)["text"])
    answer = (
        F.when(n % 4 == 0, F.format_string('<output>{"foo": "%d", "bar": %d}</output>', n, n))
        .when(n % 4 == 1, "nothing")
        .when(n % 4 == 2, F.format_string('{"foo": "a", "bar": "%d"}', n))
        .otherwise('{"foo": "a"}')
    )
    part = F.array(F.struct(F.lit("text").alias("type"), answer.alias("text")))
    output = F.struct(
        F.lit("m").alias("model"), F.lit("1").alias("id"), F.lit("message").alias("type"), F.lit("assistant").alias("role"),
        part.alias("content"), F.lit("end_turn").alias("stop_reason"), F.struct(F.lit(1).alias("input_tokens")).alias("usage"),
    )
    # Every eleventh document's reply comes under an id that nothing has.
    astray = numbered.filter("doc_id % 11 = 0").select(F.col("record_id").alias("recordId"), F.lit("astray-").alias("before"))
    record = F.struct("modelInput", F.when(n % 9 != 0, output).alias("modelOutput"), F.concat(F.coalesce("before", F.lit("")), "recordId").alias("recordId"))
    sent = requests.join(astray, "recordId", "left").filter((n % 9 != 0) | F.col("before").isNull())
    sent.select(F.to_json(record).alias("value")).write.text(f"{place}/output")
    replies = read_batch_outputs(spark, f"{place}/output").select("record_id", "reply", "is_valid")
    return batch_results(numbered, replies, TWO_FIELD).select("doc_id", "status")


@query(
    "page_text",
    r"""SELECT page_id, replace(replace(replace(replace(
      regexp_replace(regexp_replace(regexp_replace(html, '(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>', '', 'g'),
        '(?is)<h1\b[^>]*>.*?</h1\s*>', ''), '(?s)<[/!?]?[A-Za-z][^<>]*>', '', 'g'),
      '&middot;', '·'), '&copy;', '©'), '&quot;', '"'), '&amp;', '&') AS text FROM pages""",
)
def page_text(spark: SparkSession, folder: str) -> DataFrame:
    """Plain text of every page, without its title."""
    text = resolve_references(html_to_text(F.col("html")))
    return spread(table(spark, folder, "pages"), "page_id").select("page_id", text.alias("text"))


@query("markup_lengths")
def markup_lengths(spark: SparkSession, folder: str) -> DataFrame:
    """Documents and pages read as Markdown with embedded HTML."""
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("t"))
    pages = table(spark, folder, "pages").select(F.col("page_id").alias("id"), F.col("html").alias("t"))
    text = markup_to_text(F.col("t"))
    return docs.unionByName(pages).select("id", F.length(text).cast("bigint").alias("n_chars"))


def word_tokenizer() -> Callable[[str], list]:
    """A small tokenizer: words and punctuation marks, as a tokenizer library splits them."""
    from tokenizers.pre_tokenizers import WhitespaceSplit

    split = WhitespaceSplit()
    return lambda text: split.pre_tokenize_str(text)


@query(
    "tokenizer_counts",
    "SELECT doc_id, CAST(len(regexp_extract_all(text, '[^ \\t\\n\\r\\f\\v]+')) AS BIGINT) AS n_tokens FROM documents",
)
def tokenizer_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document by a tokenizer library."""
    return spread(table(spark, folder, "documents"), "doc_id").select("doc_id", token_count(F.col("text"), word_tokenizer).alias("n_tokens"))


VERDICT_LIMIT = 600
_WORDS_SQL = "len(regexp_extract_all(text, '[^ \\t\\n\\r\\f\\v]+'))"


@query(
    "length_verdicts",
    f"""SELECT doc_id, {_WORDS_SQL} < {VERDICT_LIMIT} AS fits,
      CASE WHEN strlen(text) < {VERDICT_LIMIT} THEN 'most' WHEN {_WORDS_SQL} // 2 >= {VERDICT_LIMIT} THEN 'least' WHEN text IS NOT NULL THEN 'tokens' END AS decided_by
    FROM documents""",
)
def length_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    """Which documents are short enough, and what told: only those between the bounds meet the tokenizer."""
    docs = spread(table(spark, folder, "documents"), "doc_id")
    # Half the words is a weaker bound than there could be, so that some texts stay open.
    half = lambda text: F.floor(whitespace_tokens(text) / 2)
    verdict = length_verdict(F.col("text"), VERDICT_LIMIT, word_tokenizer, least=half)
    return docs.select("doc_id", verdict.alias("v")).select("doc_id", "v.fits", "v.decided_by")


ARCHIVE_DOCUMENTS = 500


def write_archives(docs: DataFrame, folder: str) -> None:
    """Archives of at most 500 documents each, plain and compressed, written by Spark tasks."""

    def pack(rows: pa.Table) -> pa.Table:
        first = rows.slice(0, 1).to_pylist()[0]
        name = f"{first['batch']}.tar" + (".gz" if first["zipped"] else "")
        buffer = io.BytesIO()
        with tarfile.open(fileobj=buffer, mode="w:gz" if first["zipped"] else "w") as tar:
            for row in rows.to_pylist():
                info = tarfile.TarInfo(f"{first['batch']}/{row['file_name']}")
                data = row["raw"].encode()
                info.size = len(data)
                tar.addfile(info, io.BytesIO(data))
        filesystem, location = open_location(f"{folder}/{name}")
        filesystem.create_dir(location.rsplit("/", 1)[0], recursive=True)
        with filesystem.open_output_stream(location, compression=None) as sink:
            sink.write(buffer.getvalue())
        return pa.table({"name": [name]})

    docs.groupBy("batch").applyInArrow(pack, "name string").write.format("noop").mode("overwrite").save()


@query("archive_roundtrip", "SELECT doc_id, source, md5(text) AS content_key, n_chars FROM documents")
def archive_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Documents packed into archives and read back."""
    place = f"{stage_folder(spark)}/archives-{uuid.uuid4().hex}"
    docs = documents(spark, folder)
    group = F.floor(F.col("doc_id") / ARCHIVE_DOCUMENTS).cast("string")
    raw = dump_json(F.struct("content", "source", F.lit("2024-01-01").alias("timestamp"), "doc_id"))
    packed = docs.select(
        F.concat(F.lit("part-"), group).alias("batch"),
        (F.floor(F.col("doc_id") / ARCHIVE_DOCUMENTS) % 2 == 0).alias("zipped"),
        "file_name",
        raw.alias("raw"),
    )
    write_archives(packed, place)
    archives = list_document_batches(spark, place).withColumn("batch_pos", F.lit(0))
    back = documents_of(document_members(archives))
    doc_id = F.regexp_extract("file_name", "([0-9]+)", 1).cast("bigint")
    return back.select(
        doc_id.alias("doc_id"), "source", F.md5("content").alias("content_key"), F.length("content").cast("bigint").alias("n_chars")
    )


@query(
    "publish_and_prepare",
    """SELECT md5(text) AS content_key, count(*) AS n FROM documents WHERE n_chars % 3 <> 0 GROUP BY ALL""",
)
def publish_and_prepare(spark: SparkSession, folder: str) -> DataFrame:
    """Examples validated, published as two batches, read back and prepared."""
    place = f"{stage_folder(spark)}/training-{uuid.uuid4().hex}"
    docs = documents(spark, folder)
    bar = F.when(F.col("n_chars") % 3 == 0, F.lit("none")).otherwise(F.col("n_chars").cast("string"))
    example = F.struct("content", F.struct(F.col("source").alias("foo"), bar.alias("bar")).alias("output"))
    examples = parse_training_examples(spread(docs, "doc_id").select("batch_pos", "file_name", dump_json(example).alias("value")), TWO_FIELD)
    when = datetime(2024, 1, 1)
    names = []
    for half, name in enumerate(("even", "odd")):
        chosen = examples.filter(F.col("batch_pos") % 2 == half)
        batch = publish_batch(chosen, TWO_FIELD, SYSTEM, name, place, now=when, manifest_table=f"{place}-manifest")
        names.append(batch.path.rsplit("/", 1)[-1])
    lines = read_training_batches(spark, place, names)
    table = prepare_training_data(lines, TWO_FIELD, SYSTEM, seed=7).table
    content = F.get(F.from_json("value", "messages array<struct<role string, content string>>")["messages"], F.lit(1))
    return table.groupBy(F.md5(content["content"]).alias("content_key")).agg(F.count("*").alias("n"))


@query(
    "backfill_stream",
    f"WITH {_STUB_SQL} SELECT 'two_field1_0_0_' || source || '_' || md5(text) AS sample_key, n AS bar FROM answered WHERE status = 'valid'",
)
def backfill_samples(spark: SparkSession, folder: str) -> DataFrame:
    """Documents landing as files, processed by the incremental backfill."""
    place = f"{stage_folder(spark)}/stream-{uuid.uuid4().hex}"
    docs = documents(spark, folder).select(
        "batch_name", "batch_pos", "file_name", "content", "source", F.lit("").alias("timestamp")
    )
    docs.write.json(f"{place}/landing")
    landed = read_document_stream(spark, f"{place}/landing")
    backfill_stream(landed, f"{place}/sink", TWO_FIELD, stub_completer, SYSTEM, f"{place}/progress").awaitTermination()
    samples = spark.read.parquet(f"{place}/sink/samples")
    return samples.select("sample_key", F.get_json_object("output_json", "$.bar").cast("bigint").alias("bar"))


@query(
    "stored_samples",
    f"""WITH {_STUB_SQL} SELECT 'sample' AS kind, 'two_field1_0_0_' || source || '_' || md5(text) AS sample_key FROM answered WHERE status = 'valid'
    UNION ALL SELECT status, 'two_field1_0_0_' || source || '_' || md5(text) FROM answered WHERE status <> 'valid'""",
)
def stored_samples(spark: SparkSession, folder: str) -> DataFrame:
    """Sample and quarantine tables written and read back."""
    place = f"{stage_folder(spark)}/tables-{uuid.uuid4().hex}"
    routed = generate(documents(spark, folder), TWO_FIELD, stub_completer, SYSTEM)
    write_samples(routed, TWO_FIELD, f"{place}/samples")
    write_quarantine(routed, TWO_FIELD, f"{place}/quarantine")
    samples = spark.read.parquet(f"{place}/samples").select(F.lit("sample").alias("kind"), "sample_key")
    rejects = spark.read.parquet(f"{place}/quarantine").select(F.col("status").alias("kind"), "sample_key")
    return samples.unionByName(rejects)
