"""Queries over replies and payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillforge.functions import payload as P
from quillforge.functions.validation import validate
from quillforge.operators.audits import outcome_counts, success_and_failure
from quillforge.operators.routing import VALID, extract_replies, to_quarantine, to_samples
from quillforge.schema.kinds import Record
from quillforge.schema.samples import ENTITY, EVENT
from quillforge.workloads.inputs import CHECKED_SQL, MEMBERS, PAYLOADS_SQL, REPLIES_SQL, documents, replies
from quillforge.workloads.registry import query, spread


def _routed(spark: SparkSession, folder: str) -> DataFrame:
    return extract_replies(replies(spark, folder), EVENT)


@query("reply_outcomes", f"WITH {CHECKED_SQL} SELECT status, count(*) AS n FROM routed GROUP BY status")
def reply_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """Replies by outcome."""
    return outcome_counts(_routed(spark, folder))


@query(
    "outcome_totals",
    f"""WITH {CHECKED_SQL} SELECT count(*) FILTER (WHERE status = 'valid') AS successful,
    count(*) FILTER (WHERE status <> 'valid') AS failed FROM routed""",
)
def outcome_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Successful and failed replies."""
    return success_and_failure(_routed(spark, folder), F.col("status") == VALID)


@query("reply_extract", f"WITH {CHECKED_SQL} SELECT event_id, status, coalesce(payload, '') AS payload FROM routed")
def reply_extract(spark: SparkSession, folder: str) -> DataFrame:
    """The JSON text found in every reply, and its outcome."""
    return _routed(spark, folder).select("event_id", "status", F.coalesce("payload", F.lit("")).alias("payload"))


@query(
    "tagged_replies",
    f"""WITH {PAYLOADS_SQL} SELECT event_id, tagged IS NOT NULL AS found,
    CASE WHEN tagged IS NOT NULL
      THEN 'Successfully extracted content from <output> tags (length=' || length(tagged) || ' chars)'
      ELSE 'No <output> tags found in response, using full response text' END AS message,
    coalesce(tagged, whole) AS content FROM payloads""",
)
def tagged_replies(spark: SparkSession, folder: str) -> DataFrame:
    """Tagged text or whole reply, with a status text."""
    return replies(spark, folder).select("event_id", P.tagged_or_all(F.col("reply")).alias("r")).select("event_id", "r.*")


@query(
    "outermost_objects",
    f"""WITH {REPLIES_SQL} SELECT event_id, regexp_extract(reply, '(?s)\\{{.*\\}}') AS span FROM replies
    WHERE regexp_matches(reply, '(?s)\\{{.*\\}}')""",
)
def outermost_objects(spark: SparkSession, folder: str) -> DataFrame:
    """First to last brace of every reply that has such a span."""
    spans = replies(spark, folder).select("event_id", P.outermost_braces(F.col("reply")).alias("span"))
    return spans.filter(F.col("span").isNotNull())


@query(
    "parsed_objects",
    f"""WITH {REPLIES_SQL}, whole AS (SELECT event_id, trim(reply, E' \\n\\t\\r') AS t FROM replies)
    SELECT event_id FROM whole
    WHERE CASE WHEN json_valid(t) THEN json_type(t) = 'OBJECT' ELSE FALSE END""",
)
def parsed_objects(spark: SparkSession, folder: str) -> DataFrame:
    """Replies that are one JSON object and nothing else."""
    return replies(spark, folder).filter(P.strict_object(F.col("reply")).isNotNull()).select("event_id")


@query(
    "validated_events",
    f"""WITH {CHECKED_SQL} SELECT event_id, {", ".join(f"out_{m}" for m in MEMBERS)} FROM routed
    WHERE status = 'valid'""",
)
def validated_events(spark: SparkSession, folder: str) -> DataFrame:
    """Normalised payloads of the valid replies."""
    valid = _routed(spark, folder).filter(F.col("status") == VALID)
    return valid.select("event_id", *[F.col(f"output.{m}").alias(f"out_{m}") for m in MEMBERS])


@query(
    "validation_errors",
    f"WITH {CHECKED_SQL} "
    + " UNION ALL ".join(
        f"SELECT event_id, '{m}' AS path, code_{m} AS code FROM routed WHERE payload IS NOT NULL AND code_{m} IS NOT NULL"
        for m in MEMBERS
    ),
)
def validation_errors(spark: SparkSession, folder: str) -> DataFrame:
    """Every reason for which a payload was rejected."""
    return _routed(spark, folder).select("event_id", F.explode("errors").alias("e")).select("event_id", "e.path", "e.code")


_KEYED_SQL = f"""{CHECKED_SQL},
keyed AS (SELECT *, 'event_payload1_2_0_src' || (event_id % 3) || '_' AS base, 'event ' || event_id AS content FROM routed)"""


def _keyed(spark: SparkSession, folder: str) -> DataFrame:
    return _routed(spark, folder).withColumns(
        {
            "source": F.concat(F.lit("src"), (F.col("event_id") % 3).cast("string")),
            "content": F.concat(F.lit("event "), F.col("event_id").cast("string")),
        }
    )


@query(
    "samples",
    f"""WITH {_KEYED_SQL} SELECT base || md5(content) AS sample_key, base || substr(md5(content), 1, 8) || '.json' AS output_key,
    payload AS raw_json, out_event_id, out_event_type, out_value, out_k FROM keyed WHERE status = 'valid'""",
)
def samples(spark: SparkSession, folder: str) -> DataFrame:
    """The sample table: keys, raw payload and normalised members (read back from their JSON text)."""
    table = to_samples(_keyed(spark, folder), EVENT)
    out = F.from_json("output_json", EVENT.spark_type())
    parsed = table.withColumn("o", out)
    return parsed.select("sample_key", "output_key", "raw_json", *[F.col(f"o.{m}").alias(f"out_{m}") for m in MEMBERS])


@query(
    "quarantine",
    f"""WITH {_KEYED_SQL} SELECT base || md5(content) AS sample_key, status, coalesce(payload, '') AS raw_json,
    substr(reply, 1, 500) AS reply_preview,
    CASE WHEN payload IS NULL THEN 0 ELSE {" + ".join(f"CAST(code_{m} IS NOT NULL AS INTEGER)" for m in MEMBERS)} END AS n_errors
    FROM keyed WHERE status <> 'valid'""",
)
def quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """The reject table: reason, raw payload, start of the reply."""
    return to_quarantine(_keyed(spark, folder), EVENT).select(
        "sample_key",
        "status",
        F.coalesce("raw_json", F.lit("")).alias("raw_json"),
        "reply_preview",
        F.size("errors").alias("n_errors"),
    )


@query(
    "unknown_members",
    f"""WITH {PAYLOADS_SQL}, keys AS (SELECT event_id, unnest(json_keys(payload)) AS key FROM payloads WHERE payload IS NOT NULL)
    SELECT event_id, key AS path FROM keys WHERE key NOT IN ('event_id', 'event_type', 'value', 'k')""",
)
def unknown_members(spark: SparkSession, folder: str) -> DataFrame:
    """Members of the payloads that a schema which forbids unknown ones reports."""
    found = replies(spark, folder).select("event_id", P.payload(F.col("reply"))["object"].alias("payload")).where("payload is not null")
    checked = validate(found, "payload", Record(*EVENT.root.fields, forbid_unknown=True))
    return checked.select("event_id", F.explode("errors").alias("e")).where("e.code = 'unknown'").select("event_id", "e.path")


# One payload per document: an entity per line of its text, some of them faulty.
def _entity_payloads(spark: SparkSession, folder: str) -> DataFrame:
    def entity(line, i):
        chars = F.length(line)
        kinds = F.array(*[F.lit(k) for k in ("person", "place", "thing", "other")])
        kind = F.when(i % 5 == 4, "Person").otherwise(F.element_at(kinds, i % 4 + 1))
        members = [
            F.concat(F.lit('{"entity":"'), kind, F.lit('","source_text":')),
            F.when(chars % 17 == 0, chars.cast("string")).otherwise(F.concat(F.lit('"'), F.md5(line), F.lit('"'))),
            F.lit(',"assertion":"positive"'),
            F.when(
                i % 3 != 0,
                F.concat(
                    F.lit(',"snippets":['),
                    F.array_join(F.array_repeat(F.lit('"w"'), (chars % 7).cast("int")), ","),
                    F.lit("]"),
                ),
            ).otherwise(""),
            F.lit(',"year":'),
            F.when(i % 2 == 1, "null").otherwise((chars % 230 + 1890).cast("string")),
            F.lit("}"),
        ]
        return F.concat(*members)

    lines = F.split("content", "\n")
    text = F.concat(
        F.lit('{"is_relevant":"Yes","entities":['), F.array_join(F.transform(lines, entity), ","), F.lit("]}")
    )
    return spread(documents(spark, folder), "doc_id").select("doc_id", P.strict_object(text).alias("payload"))


_ENTITIES_SQL = """lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i
  FROM documents),
entities AS (
  SELECT doc_id, i, length(line) AS chars FROM lines),
codes AS (
  SELECT doc_id, i, unnest([
      CASE WHEN i % 5 = 4 THEN 'entities[' || i || '].entity|domain' END,
      CASE WHEN chars % 17 = 0 THEN 'entities[' || i || '].source_text|type' END,
      CASE WHEN i % 2 = 0 AND NOT (chars % 230 + 1890 BETWEEN 1900 AND 2100) THEN 'entities[' || i || '].year|range' END,
      CASE WHEN i % 3 <> 0 AND chars % 7 > 4 THEN 'entities[' || i || '].snippets|too_long' END]) AS e
  FROM entities)"""


@query(
    "nested_validation",
    f"""WITH {_ENTITIES_SQL},
    bad AS (SELECT doc_id, count(*) AS n FROM codes WHERE e IS NOT NULL GROUP BY doc_id)
    SELECT e.doc_id, coalesce(max(bad.n), 0) AS n_errors, max(bad.n) IS NULL AS is_valid,
      CASE WHEN max(bad.n) IS NULL THEN count(*) ELSE 0 END AS n_entities,
      CASE WHEN max(bad.n) IS NULL THEN sum(CASE WHEN i % 2 = 0 THEN chars % 230 + 1890 ELSE 0 END) ELSE 0 END AS sum_year,
      CASE WHEN max(bad.n) IS NULL THEN sum(CASE WHEN i % 3 <> 0 THEN chars % 7 ELSE 0 END) ELSE 0 END AS n_snippets
    FROM entities e LEFT JOIN bad ON e.doc_id = bad.doc_id GROUP BY e.doc_id""",
)
def nested_validation(spark: SparkSession, folder: str) -> DataFrame:
    """Validity and normalised contents of nested payloads."""
    checked = validate(_entity_payloads(spark, folder), "payload", ENTITY.root)
    entities = F.coalesce("output.entities", F.array().cast(ENTITY.spark_type()["entities"].dataType))
    total = lambda value: F.aggregate(entities, F.lit(0).cast("bigint"), lambda a, e: a + value(e))
    return checked.select(
        "doc_id",
        F.size("errors").cast("bigint").alias("n_errors"),
        "is_valid",
        F.size(entities).cast("bigint").alias("n_entities"),
        total(lambda e: F.coalesce(e["year"], F.lit(0))).alias("sum_year"),
        total(lambda e: F.size(e["snippets"]).cast("bigint")).alias("n_snippets"),
    )


@query(
    "nested_errors",
    f"""WITH {_ENTITIES_SQL} SELECT doc_id, string_split(e, '|')[1] AS path, string_split(e, '|')[2] AS code
    FROM codes WHERE e IS NOT NULL""",
)
def nested_errors(spark: SparkSession, folder: str) -> DataFrame:
    """Every error inside nested payloads, with its position."""
    checked = validate(_entity_payloads(spark, folder), "payload", ENTITY.root)
    return checked.select("doc_id", F.explode("errors").alias("e")).select("doc_id", "e.path", "e.code")
