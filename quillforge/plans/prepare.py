"""Combining published batches into a training table."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillforge.functions.chat import has_chat_shape, message_content, render_chat, same_prompt
from quillforge.functions.payload import TOO_LARGE, beyond_parser, strict_object, strip_tags
from quillforge.functions.text import fence
from quillforge.functions.tokens import TokenizerFactory, token_count
from quillforge.functions.validation import validate
from quillforge.operators.ordering import shuffle_key
from quillforge.schema.kinds import PayloadSchema
from quillforge.schema.samples import CHAT_SAMPLE
from quillforge.session import stage_counted
from quillforge.sinks.training import training_line, write_prepared

logger = logging.getLogger(__name__)

BAD_LINE, SHORT, PROMPT, BAD_PAYLOAD, SCHEMA = (
    "bad_line",
    "too_few_messages",
    "prompt_mismatch",
    "bad_payload",
    "schema_invalid",
)


def check_training_lines(lines: DataFrame, schema: PayloadSchema, system_prompt: str, line: str = "value") -> DataFrame:
    """Add ``messages``, ``output`` and ``reject_reason`` (null for usable lines) to JSON lines of chat samples."""
    parsed = validate(
        lines.withColumn("_line", strict_object(F.col(line))),
        "_line",
        CHAT_SAMPLE,
        errors="_line_errors",
        output="_sample",
        is_valid="_is_sample",
    ).withColumn("messages", F.col("_sample.messages"))
    answer = strip_tags(message_content(F.col("messages"), 2))
    checked = validate(
        parsed.withColumn("_answer", strict_object(answer)), "_answer", schema.root, errors="payload_errors", is_valid="_is_payload"
    )
    reason = (
        F.when(~F.col("_is_sample") & F.col("_line").isNull() & beyond_parser(F.col(line)), TOO_LARGE)
        .when(~F.col("_is_sample"), BAD_LINE)
        .when(~has_chat_shape(F.col("messages")), SHORT)
        .when(~same_prompt(message_content(F.col("messages"), 0), system_prompt), PROMPT)
        .when(F.col("_answer").isNull(), BAD_PAYLOAD)
        .when(~F.col("_is_payload"), SCHEMA)
    )
    return checked.withColumn("reject_reason", reason).select(
        *lines.columns, "messages", "output", "payload_errors", "reject_reason"
    )


def with_token_counts(
    checked: DataFrame, tokenizer: TokenizerFactory | None = None, render: Callable[[Column], Column] = render_chat
) -> DataFrame:
    """Add ``n_tokens`` of the chat as ``render`` writes it (messages to text); rejected lines are not tokenised."""
    text = F.when(F.col("reject_reason").isNull(), render(F.col("messages")))
    counted = checked.withColumn("_n", token_count(text, tokenizer))
    return fence(counted, {"n_tokens": F.col("_n")}).drop("_n")


def exclude_overlong(df: DataFrame, max_seq_length: int, tokens: str = "n_tokens") -> DataFrame:
    """Rows with strictly fewer tokens than the limit, each judged alone."""
    return df.filter(F.col(tokens) < max_seq_length)


@dataclass(frozen=True)
class Prepared:
    """A prepared training table and what happened on the way.

    ``table``: batch_name, line_id, n_tokens, rank, value, in rank order once written.
    ``report``: rows per batch and reject reason.
    """

    table: DataFrame
    report: DataFrame
    n_kept: int
    n_valid: int
    too_few_kept: bool

    def write(self, path: str) -> None:
        write_prepared(self.table, path)


def prepare_training_data(
    lines: DataFrame,
    schema: PayloadSchema,
    system_prompt: str,
    base_model: str | None = None,
    max_seq_length: int | None = None,
    tokenizer: TokenizerFactory | None = None,
    shuffle: bool = True,
    seed: int | str = 0,
    render: Callable[[Column], Column] = render_chat,
) -> Prepared:
    """Check lines, leave out overlong samples, fix the order.

    ``lines`` has batch_name, batch_pos, line_id and value, and line_at if their
    order in the files counts. Lengths are checked only if both ``base_model`` and
    ``max_seq_length`` are given, on what ``render`` makes of the messages: the
    chat template of the model. One pass parses,
    validates and counts tokens, and writes a stage table; the same job observes
    how many samples are valid and kept. The report and the final sort read the table.
    """
    limit = bool(base_model) and bool(max_seq_length)
    checked = check_training_lines(lines, schema, system_prompt)
    usable = F.col("reject_reason").isNull()
    measured = with_token_counts(checked, tokenizer, render) if limit else checked.withColumn("n_tokens", F.lit(None).cast("bigint"))
    fits = (usable & (F.col("n_tokens") < max_seq_length)) if limit else usable
    # The order comes from the line alone, so every run has the same; equal lines, which may change places, share a rank.
    place = F.col("line_at" if "line_at" in lines.columns else "line_id")
    rank = (
        shuffle_key(seed, F.col("line_id"))
        if shuffle
        else F.concat_ws("-", F.lpad(F.col("batch_pos").cast("string"), 10, "0"), place)
    )
    selected = measured.select(
        "batch_name",
        "line_id",
        "reject_reason",
        "n_tokens",
        fits.alias("fits"),
        rank.alias("rank"),
        F.when(fits, training_line(F.col("messages"))).alias("value"),
    )
    staged, counts = stage_counted(
        selected,
        n_kept=F.count_if(F.col("reject_reason").isNull() & F.coalesce("fits", F.lit(False))),
        n_valid=F.count_if(F.col("reject_reason").isNull()),
    )
    n_kept, n_valid = counts["n_kept"], counts["n_valid"]
    if n_valid == 0:
        raise ValueError("no valid training samples found")
    if too_few := 2 * n_kept < n_valid:
        logger.warning("fewer than half of the samples fit max_seq_length, consider raising it")
    report = staged.groupBy("batch_name", "reject_reason").agg(
        F.count("*").alias("n"), F.count_if("fits").alias("n_kept")
    )
    table = staged.filter("fits").select("batch_name", "line_id", "n_tokens", "rank", "value")
    return Prepared(table, report, n_kept, n_valid, too_few)
