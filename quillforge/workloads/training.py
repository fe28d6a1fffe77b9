"""Queries over prompts, chat samples and training batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillforge.functions import chat, prompts
from quillforge.functions import text as X
from quillforge.functions.payload import strip_tags
from quillforge.operators import audits, ordering
from quillforge.operators.turns import conversation_shape, conversation_tokens
from quillforge.plans.prepare import check_training_lines, exclude_overlong, prepare_training_data, with_token_counts
from quillforge.schema.samples import TWO_FIELD
from quillforge.sinks.training import training_line
from quillforge.workloads.inputs import documents
from quillforge.workloads.registry import query, spread, table

TOKEN_LIMIT = 1200
CONVERSATION_LIMIT = 300
SEED = 42


@query(
    "rendered_prompts",
    """SELECT doc_id, replace(replace('Use {SCHEMA} as in {EXAMPLE}.' || source, '{SCHEMA}', text), '{EXAMPLE}', lang || '{SCHEMA}') AS prompt
    FROM documents""",
)
def rendered_prompts(spark: SparkSession, folder: str) -> DataFrame:
    """A template per row with its placeholders filled one after the other."""
    template = F.concat(F.lit("Use {SCHEMA} as in {EXAMPLE}."), "source")
    prompt = prompts.render_prompt(
        template, {"SCHEMA": F.col("text"), "EXAMPLE": F.concat("lang", F.lit("{SCHEMA}"))}
    )
    return table(spark, folder, "documents").select("doc_id", prompt.alias("prompt"))


_REQUEST_SQL = """SELECT CAST(doc_id AS VARCHAR) AS record_id, to_json({'recordId': CAST(doc_id AS VARCHAR), 'modelInput': {
  'anthropic_version': 'bedrock-2023-05-31', %s'max_tokens': 8192,
  'messages': [{'role': 'user', 'content': [{'type': 'text', 'text': text}]}]}}) AS line FROM documents WHERE doc_id %% 2 = %d"""


@query(
    "batch_requests",
    _REQUEST_SQL % ("'system': 'Read ' || source, ", 0) + " UNION ALL " + _REQUEST_SQL % ("", 1),
)
def batch_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Request line of every document; half of them have no system prompt."""
    record_id = F.col("doc_id").cast("string")
    system = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("Read "), "source"))
    request = prompts.batch_request(record_id, F.col("content"), system)
    return documents(spark, folder).select(record_id.alias("record_id"), F.to_json(request).alias("line"))


_SYSTEM = "Describe the text.\nAnswer in JSON."
_ANSWER_SQL = "E'<output>\\n{\"foo\":\"' || source || '\",\"bar\":' || n_chars || E'}\\n</output>'"


def _payload_json():
    return F.concat(
        F.lit('{"foo":"'), F.col("source"), F.lit('","bar":'), F.col("n_chars").cast("string"), F.lit("}")
    )


@query(
    "chat_samples",
    f"""SELECT doc_id, to_json({{'messages': [
      {{'role': 'system', 'content': E'{_SYSTEM.replace(chr(10), chr(92) + "n")}', 'name': NULL}},
      {{'role': 'user', 'content': text, 'name': NULL}},
      {{'role': 'assistant', 'content': {_ANSWER_SQL}, 'name': NULL}}]}}) AS line FROM documents""",
)
def chat_samples(spark: SparkSession, folder: str) -> DataFrame:
    """Every document as a chat sample, as its JSON line."""
    messages = chat.chat_sample(_SYSTEM, F.col("content"), _payload_json())
    return documents(spark, folder).select("doc_id", training_line(messages).alias("line"))


_SHAPE_SQL = """shape AS (
  SELECT conv_id, count(*) AS n_turns, bool_and(role IN ('system', 'user', 'assistant')) AS roles_known,
    coalesce(max(role) FILTER (WHERE turn = 0), '') AS first_role, coalesce(max(role) FILTER (WHERE turn = 2), '') AS third_role
  FROM conversations GROUP BY conv_id)"""


@query("chat_shape", f"WITH {_SHAPE_SQL} SELECT *, n_turns >= 3 AND roles_known AS is_chat_sample FROM shape")
def chat_shape(spark: SparkSession, folder: str) -> DataFrame:
    """Which conversations have the shape of a chat sample."""
    shape = conversation_shape(table(spark, folder, "conversations"))
    return shape.na.fill("", ["first_role", "third_role"])


_PROMPT_SQL = """prompts AS (
  SELECT conv_id, turn, ['Read the text. ' || role, E'Read\\n the  text.' || role, E'Read\\tthe text.' || role, text,
    'Readthetext.user'][CAST((conv_id + turn) % 5 AS INTEGER) + 1] AS prompt FROM conversations)"""


@query(
    "prompt_match",
    f"""WITH {_PROMPT_SQL} SELECT conv_id, turn, replace(replace(prompt, E'\\n', ''), ' ', '') = 'Readthetext.user' AS matches
    FROM prompts""",
)
def prompt_match(spark: SparkSession, folder: str) -> DataFrame:
    """Prompts equal to the expected one apart from line feeds and spaces."""
    variants = F.array(
        F.concat(F.lit("Read the text. "), "role"),
        F.concat(F.lit("Read\n the  text."), "role"),
        F.concat(F.lit("Read\tthe text."), "role"),
        F.col("text"),
        F.lit("Readthetext.user"),
    )
    prompt = F.element_at(variants, ((F.col("conv_id") + F.col("turn")) % 5 + 1).cast("int"))
    return table(spark, folder, "conversations").select(
        "conv_id", "turn", chat.same_prompt(prompt, "Read the text.\nuser").alias("matches")
    )


@query(
    "tag_strip",
    """SELECT doc_id, trim('<out' || '<output>' || 'put>' || text || '</output>' || lang || '<output>', E' \\n\\t\\r') AS raw_text,
    md5(trim(replace(replace(E' \\n<output>' || text || '</output>' || lang || E'<output>\\t', '<output>', ''), '</output>', ''), E' \\n\\t\\r')) AS digest
    FROM documents""",
)
def tag_strip(spark: SparkSession, folder: str) -> DataFrame:
    """Texts with every output tag deleted."""
    text, lang = F.col("text"), F.col("lang")
    wrapped = F.concat(F.lit(" \n<output>"), text, F.lit("</output>"), lang, F.lit("<output>\t"))
    raw = F.concat(F.lit("<out<output>put>"), text, F.lit("</output>"), lang, F.lit("<output>"))
    return table(spark, folder, "documents").select(
        "doc_id", X.strip_ws(raw).alias("raw_text"), F.md5(strip_tags(wrapped)).alias("digest")
    )


_TOKENS_SQL = """tokens AS (
  SELECT conv_id, CAST(sum(len(regexp_extract_all('<|im_start|>' || role || E'\\n' || text || '<|im_end|>', '[^ \\t\\n\\r\\f\\v]+'))) AS BIGINT) AS n_tokens
  FROM conversations GROUP BY conv_id)"""


@query("conversation_tokens", f"WITH {_TOKENS_SQL} SELECT conv_id, n_tokens FROM tokens")
def conversation_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every conversation in the chat template."""
    return conversation_tokens(table(spark, folder, "conversations"))


@query(
    "rendered_turns",
    "SELECT conv_id, turn, '<|im_start|>' || role || E'\\n' || text || E'<|im_end|>\\n' AS rendered FROM conversations",
)
def rendered_turns(spark: SparkSession, folder: str) -> DataFrame:
    """Every turn in the chat template."""
    rendered = chat.render_turn(F.col("role"), F.col("text"))
    return table(spark, folder, "conversations").select("conv_id", "turn", rendered.alias("rendered"))


@query("within_length", f"WITH {_TOKENS_SQL} SELECT conv_id, n_tokens FROM tokens WHERE n_tokens < {CONVERSATION_LIMIT}")
def within_length(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations strictly below the token limit."""
    return exclude_overlong(conversation_tokens(table(spark, folder, "conversations")), CONVERSATION_LIMIT)


@query(
    "retention",
    f"""WITH {_TOKENS_SQL}, kept AS (SELECT count(*) FILTER (WHERE n_tokens < {CONVERSATION_LIMIT}) AS n_kept, count(*) AS n_total FROM tokens)
    SELECT *, n_kept < n_total / 2.0 AS too_few_kept FROM kept""",
)
def retention(spark: SparkSession, folder: str) -> DataFrame:
    """How many conversations fit, and whether that is fewer than half."""
    counts = conversation_tokens(table(spark, folder, "conversations"))
    return audits.retention(counts, F.col("n_tokens") < CONVERSATION_LIMIT)


@query(
    "mixture_shuffled",
    """SELECT doc_id, source, CAST(dense_rank() OVER (ORDER BY source) - 1 AS INTEGER) AS batch_pos,
      md5('42|' || doc_id) AS rank FROM documents ORDER BY rank""",
)
def mixture_shuffled(spark: SparkSession, folder: str) -> DataFrame:
    """All batches put together, in the order of their names, and shuffled."""
    docs = documents(spark, folder).select("doc_id", "source")
    # The list of batches is what a user passes in.
    names = sorted(r["source"] for r in docs.select("source").distinct().collect())
    mixed = ordering.shuffled(ordering.as_batches(docs, "source", names), SEED, "doc_id")
    return mixed.withColumn("rank", ordering.shuffle_key(SEED, F.col("doc_id")))


@query(
    "shuffled_documents",
    "SELECT doc_id, row_number() OVER (ORDER BY md5('42|' || doc_id), doc_id) - 1 AS position FROM documents",
)
def shuffled_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its place in the shuffled order."""
    docs = documents(spark, folder).select("doc_id").withColumn("rank", ordering.shuffle_key(SEED, F.col("doc_id")))
    return ordering.with_positions(docs, ["rank", "doc_id"]).select("doc_id", "position")


# --- training lines: one per document, some of them unusable ----------------

_LINE_KINDS = 10


def training_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Published lines derived from the documents; the kind of fault goes by document number."""
    kind = F.col("doc_id") % _LINE_KINDS
    payload = (
        F.when(kind == 6, F.replace(_payload_json(), F.lit('"bar":'), F.lit('"bar":"x')))
        .when(kind == 7, F.replace(_payload_json(), F.lit('"bar":'), F.lit('"baz":')))
        .when(kind == 4, F.concat(F.lit(" "), _payload_json(), F.lit("\n")))
        .otherwise(_payload_json())
    )
    system = F.when(kind == 5, "Another prompt").when(kind == 3, "Describe  the\ntext. AnswerinJSON.").otherwise(_SYSTEM)
    messages = chat.chat_sample(system, F.col("content"), payload)
    messages = F.when(kind == 8, F.slice(messages, 1, 2)).otherwise(messages)
    line = training_line(messages)
    return spread(documents(spark, folder), "doc_id").select(
        "batch_name",
        "batch_pos",
        F.col("doc_id").cast("string").alias("line_id"),
        F.when(kind == 9, F.substring(line, F.lit(1), F.length(line) - 1)).otherwise(line).alias("value"),
    )


_REASONS_SQL = """reasons AS (
  SELECT doc_id, source, text, n_chars, CASE doc_id % 10 WHEN 9 THEN 'bad_line' WHEN 8 THEN 'too_few_messages' WHEN 5 THEN 'prompt_mismatch'
    WHEN 6 THEN 'bad_payload' WHEN 7 THEN 'schema_invalid' ELSE '' END AS reject_reason FROM documents)"""

# words of the template and prompt: those of the system turn, the user text, and the answer turn
_LINE_TOKENS_SQL = f"""lines AS (
  SELECT doc_id, source, reject_reason,
    len(regexp_extract_all('<|im_start|>system' || E'\\n' ||
      CASE doc_id % 10 WHEN 3 THEN E'Describe  the\\ntext. AnswerinJSON.' ELSE E'{_SYSTEM.replace(chr(10), chr(92) + "n")}' END
      || E'<|im_end|>\\n<|im_start|>user\\n' || text || E'<|im_end|>\\n<|im_start|>assistant\\n' || {_ANSWER_SQL} || E'<|im_end|>\\n',
      '[^ \\t\\n\\r\\f\\v]+')) AS n_tokens, text
  FROM reasons)"""


@query("line_checks", f"WITH {_REASONS_SQL} SELECT CAST(doc_id AS VARCHAR) AS line_id, reject_reason FROM reasons")
def line_checks(spark: SparkSession, folder: str) -> DataFrame:
    """Whether every training line is usable, and if not, why."""
    checked = check_training_lines(training_lines(spark, folder), TWO_FIELD, _SYSTEM)
    return checked.select("line_id", F.coalesce("reject_reason", F.lit("")).alias("reject_reason"))


@query(
    "batch_validity",
    f"""WITH {_REASONS_SQL} SELECT source AS batch_name, count(*) FILTER (WHERE reject_reason = '') AS n_valid,
    count(*) FILTER (WHERE reject_reason <> '') AS n_invalid FROM reasons GROUP BY source""",
)
def batch_validity(spark: SparkSession, folder: str) -> DataFrame:
    """Usable and unusable lines per batch."""
    checked = check_training_lines(training_lines(spark, folder), TWO_FIELD, _SYSTEM)
    return audits.batch_validity(checked, F.col("reject_reason").isNull())


@query(
    "line_tokens",
    f"""WITH {_REASONS_SQL}, {_LINE_TOKENS_SQL} SELECT CAST(doc_id AS VARCHAR) AS line_id, n_tokens FROM lines
    WHERE reject_reason = ''""",
)
def line_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every usable training line."""
    checked = check_training_lines(training_lines(spark, folder), TWO_FIELD, _SYSTEM)
    counted = with_token_counts(checked).filter(F.col("reject_reason").isNull())
    return counted.select("line_id", "n_tokens")


@query(
    "prepared_corpus",
    f"""WITH {_REASONS_SQL}, {_LINE_TOKENS_SQL} SELECT source AS batch_name, CAST(doc_id AS VARCHAR) AS line_id, n_tokens,
      md5('42|' || doc_id) AS rank, md5(text) AS content_key FROM lines
    WHERE reject_reason = '' AND n_tokens < {TOKEN_LIMIT} ORDER BY rank""",
)
def prepared_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """The whole preparation: check, length filter, shuffle."""
    prepared = prepare_training_data(
        training_lines(spark, folder), TWO_FIELD, _SYSTEM, base_model="words", max_seq_length=TOKEN_LIMIT, seed=SEED
    )
    content = F.get(F.from_json("value", "messages array<struct<role string, content string>>")["messages"], F.lit(1))
    return prepared.table.orderBy("rank").select(
        "batch_name", "line_id", "n_tokens", "rank", F.md5(content["content"]).alias("content_key")
    )


@query(
    "preparation_report",
    f"""WITH {_REASONS_SQL}, {_LINE_TOKENS_SQL} SELECT source AS batch_name, reject_reason, count(*) AS n,
      count(*) FILTER (WHERE reject_reason = '' AND n_tokens < {TOKEN_LIMIT}) AS n_kept FROM lines GROUP BY ALL""",
)
def preparation_report(spark: SparkSession, folder: str) -> DataFrame:
    """What became of the lines of every batch."""
    prepared = prepare_training_data(
        training_lines(spark, folder), TWO_FIELD, _SYSTEM, base_model="words", max_seq_length=TOKEN_LIMIT, seed=SEED
    )
    return prepared.report.na.fill("", ["reject_reason"])
