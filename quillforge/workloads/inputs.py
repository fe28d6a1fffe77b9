"""Operator inputs derived from the given tables, on the Spark side and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillforge.workloads.registry import spread, table

# --- documents -------------------------------------------------------------

DOCUMENTS_SQL = """docs AS (
  SELECT doc_id, text AS content, source, source AS batch_name,
         CAST(substr(source, 4) AS INTEGER) AS batch_pos,
         'document_' || doc_id || '.json' AS file_name, n_chars
  FROM documents)"""


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """The documents table as documents: each source is a batch, in the order of its number."""
    return table(spark, folder, "documents").select(
        "doc_id",
        F.col("text").alias("content"),
        "source",
        F.col("source").alias("batch_name"),
        F.substring("source", 4, 10).cast("int").alias("batch_pos"),
        F.concat(F.lit("document_"), F.col("doc_id").cast("string"), F.lit(".json")).alias("file_name"),
        "n_chars",
    )


# --- replies ---------------------------------------------------------------

# The shapes a reply takes, chosen by event_id modulo their number. {b} is a good
# payload, {n} the event id; written once, used to build both sides' input.
REPLY_SHAPES = (
    "<output>\n{b}\n</output>",
    "{b}",
    "Here it is: {b} - done.",
    '<output>{"event_id": 1</output>\n{b}',
    '<output>{"event_id": {n}, "event_type": "VIEW", "value": 1, "k": 1}</output>',
    "There is nothing to report on {n}.",
    "<output>{}</output>",
    "[{b}]",
    '{"event_id": "{n}", "event_type": "click", "value": " 2.50 ", "k": 5.0}',
    '<output>{"event_id": {n}, "event_type": "error", "value": true}</output> {b}',
    '{"event_id": {n}, "event_type": "signup", "value": -1.5, "k": 100}',
    "{b} and then }",
    '<output>{"extra": [1, {"a": null}], "event_id": {n}, "event_type": "view", "value": 3, "k": "7"}</output>',
    "<output>junk</output>\n{b}",
    '<OUTPUT>{"event_id": 2.5, "event_type": 3, "value": null, "k": "x"}</OUTPUT>',
    " \n\t{b}\n ",
)


def replies(spark: SparkSession, folder: str) -> DataFrame:
    """One model reply per event."""
    k = F.regexp_extract("props", "([0-9]+)", 1)
    body = F.concat(
        F.lit('{"event_id": '),
        F.col("event_id").cast("string"),
        F.lit(', "event_type": "'),
        F.col("event_type"),
        F.lit('", "value": '),
        F.col("value").cast("string"),
        F.lit(', "k": '),
        k,
        F.lit("}"),
    )
    shape = F.element_at(
        F.array(*[F.lit(s) for s in REPLY_SHAPES]), (F.col("event_id") % len(REPLY_SHAPES) + 1).cast("int")
    )
    number = F.col("event_id").cast("string")
    reply = F.replace(F.replace(shape, F.lit("{b}"), body), F.lit("{n}"), number)
    return spread(table(spark, folder, "events"), "event_id").select("event_id", "event_type", reply.alias("reply"))


def _sql_text(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "''").replace("\n", "\\n").replace("\t", "\\t")
    return f"E'{escaped}'"


_SHAPE_LIST = "[" + ", ".join(_sql_text(s) for s in REPLY_SHAPES) + "]"

REPLIES_SQL = f"""replies AS (
  SELECT event_id, event_type,
    replace(replace({_SHAPE_LIST}[CAST(event_id % {len(REPLY_SHAPES)} AS INTEGER) + 1], '{{b}}',
      '{{"event_id": ' || event_id || ', "event_type": "' || event_type || '", "value": ' || CAST(value AS VARCHAR)
      || ', "k": ' || regexp_extract(props, '([0-9]+)', 1) || '}}'), '{{n}}', CAST(event_id AS VARCHAR)) AS reply
  FROM events)"""

_SPACES = "E' \\n\\t\\r'"


def _usable(text: str) -> str:
    return (
        f"(CASE WHEN json_valid({text}) THEN json_type({text}) = 'OBJECT' AND len(json_keys({text})) > 0 "
        f"ELSE FALSE END)"
    )


# Which JSON object a reply carries.
PAYLOADS_SQL = f"""{REPLIES_SQL},
candidates AS (
  SELECT *,
    CASE WHEN regexp_matches(reply, '(?s)<output>.*?</output>')
         THEN trim(regexp_extract(reply, '(?s)<output>(.*?)</output>', 1), {_SPACES}) END AS tagged,
    trim(reply, {_SPACES}) AS whole,
    nullif(regexp_extract(reply, '(?s)\\{{.*\\}}'), '') AS braces
  FROM replies),
payloads AS (
  SELECT event_id, event_type, reply, tagged, whole,
    CASE WHEN {_usable('tagged')} THEN tagged WHEN {_usable('whole')} THEN whole
         WHEN {_usable('braces')} THEN braces END AS payload
  FROM candidates)"""


def integer_sql(member: str, low: int | None = None, high: int | None = None) -> tuple[str, str]:
    """Coerced value and error code of an integer member."""
    kind, text = f"json_type(payload, '$.{member}')", f"json_extract_string(payload, '$.{member}')"
    number = f"TRY_CAST({text} AS DOUBLE)"
    value = (
        f"(CASE WHEN {kind} = 'BOOLEAN' THEN CAST({text} = 'true' AS BIGINT) "
        f"WHEN {kind} IN ('BIGINT', 'UBIGINT') THEN TRY_CAST({text} AS BIGINT) "
        f"WHEN {kind} = 'DOUBLE' AND {number} = floor({number}) THEN CAST({number} AS BIGINT) "
        f"WHEN {kind} = 'VARCHAR' AND regexp_matches(trim({text}), '^[+-]?[0-9]+([.]0+)?$') "
        f"THEN CAST(CAST(trim({text}) AS DOUBLE) AS BIGINT) END)"
    )
    return value, _code_sql(kind, value, low, high)


def number_sql(member: str, low: float | None = None) -> tuple[str, str]:
    """Coerced value and error code of a double member."""
    kind, text = f"json_type(payload, '$.{member}')", f"json_extract_string(payload, '$.{member}')"
    value = (
        f"(CASE WHEN {kind} = 'BOOLEAN' THEN CAST({text} = 'true' AS DOUBLE) "
        f"WHEN {kind} IN ('BIGINT', 'UBIGINT', 'DOUBLE', 'VARCHAR') THEN TRY_CAST(trim({text}) AS DOUBLE) END)"
    )
    return value, _code_sql(kind, value, low, None)


def choice_sql(member: str, values: tuple[str, ...]) -> tuple[str, str]:
    """Value and error code of a closed-vocabulary member."""
    kind, text = f"json_type(payload, '$.{member}')", f"json_extract_string(payload, '$.{member}')"
    value = f"(CASE WHEN {kind} = 'VARCHAR' THEN {text} END)"
    allowed = ", ".join(f"'{v}'" for v in values)
    code = (
        f"(CASE WHEN {kind} IS NULL THEN 'missing' WHEN {kind} = 'NULL' THEN 'null' "
        f"WHEN {value} IS NULL THEN 'type' WHEN {value} NOT IN ({allowed}) THEN 'domain' END)"
    )
    return value, code


def _code_sql(kind: str, value: str, low: float | None, high: float | None) -> str:
    outside = [f"{value} < {low}"] * (low is not None) + [f"{value} > {high}"] * (high is not None)
    out = f"WHEN {' OR '.join(outside)} THEN 'range' " if outside else ""
    return (
        f"(CASE WHEN {kind} IS NULL THEN 'missing' WHEN {kind} = 'NULL' THEN 'null' "
        f"WHEN {value} IS NULL THEN 'type' {out}END)"
    )


_MEMBERS = {
    "event_id": integer_sql("event_id"),
    "event_type": choice_sql("event_type", ("click", "view", "purchase", "signup", "error")),
    "value": number_sql("value", 0),
    "k": integer_sql("k", 0, 99),
}

CHECKED_SQL = f"""{PAYLOADS_SQL},
checked AS (
  SELECT event_id, reply, payload,
    {", ".join(f"{value} AS out_{name}, {code} AS code_{name}" for name, (value, code) in _MEMBERS.items())}
  FROM payloads),
routed AS (
  SELECT *, CASE WHEN payload IS NULL THEN 'no_json'
    WHEN {" AND ".join(f"code_{name} IS NULL" for name in _MEMBERS)} THEN 'valid'
    ELSE 'schema_invalid' END AS status
  FROM checked)"""

MEMBERS = tuple(_MEMBERS)
