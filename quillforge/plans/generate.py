"""Generation: documents to routed samples, in real time or through a batch job."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillforge.operators.dedupe import first_per_key, latest_per_key
from quillforge.operators.inference import REALTIME_MAX_TOKENS, Completer, Retry, infer
from quillforge.operators.ordering import DOCUMENT_ORDER, assign_record_id, stable_record_id, take_first
from quillforge.operators.pending import pending
from quillforge.operators.routing import BAD_REPLY, ORPHAN, UNANSWERED, extract_replies, key_columns
from quillforge.schema.kinds import PayloadSchema
from quillforge.session import stage
from quillforge.sinks.tables import request_lines


def with_keys(docs: DataFrame, schema: PayloadSchema) -> DataFrame:
    """Documents with the join key and file name of their sample."""
    return docs.withColumns(key_columns(schema, F.col("source"), F.col("content")))


def generate(
    docs: DataFrame,
    schema: PayloadSchema,
    make_completer: Callable[[], Completer],
    system: str,
    n: int | None = None,
    outputs: DataFrame | None = None,
    order_by: Sequence[str] = DOCUMENT_ORDER,
    max_tokens: int = REALTIME_MAX_TOKENS,
    retry: Retry | None = None,
    partitions: int | None = None,
    threads: int = 1,
) -> DataFrame:
    """Real-time path: cap, skip what is done, ask once per distinct document, extract and validate.

    Without ``n`` this is the backfill: every document without an output. Copies
    are reduced to the first of their key before anything is asked, so
    a much-copied document costs one call. Replies are
    written to a stage table before validation; nothing later repeats a call.
    """
    if n is None:
        # Documents that a filter of the finished keys excludes, in the scan, meet no join.
        chosen = with_keys(docs, schema)
        chosen = chosen if outputs is None else pending(chosen, outputs, spread_by=order_by, prefilter=True)
        todo = first_per_key(chosen, ["sample_key"], order_by)
    else:
        unique = first_per_key(with_keys(take_first(docs, n, order_by).drop("position"), schema), ["sample_key"], order_by)
        todo = unique if outputs is None else pending(unique, outputs)
    # Without a source or content there is no sample to make: such rows go on, unasked, to the quarantine.
    todo = todo.withColumn("_asked", F.when(F.col("sample_key").isNotNull(), F.col("content")))
    answered = infer(
        todo, make_completer, system, content="_asked", max_tokens=max_tokens, retry=retry, partitions=partitions, threads=threads
    )
    return extract_replies(stage(answered.drop("_asked")), schema)


def batch_requests(
    docs: DataFrame, system: str | None, n: int | None = None, order_by: Sequence[str] = DOCUMENT_ORDER
) -> tuple[DataFrame, DataFrame]:
    """Batch path, first half: documents with record ids, and their request lines.

    Record ids are positions if the set is capped, and else hashes of the
    document's place, which need no global order. ``order_by`` identifies a document.
    """
    numbered = stable_record_id(docs, order_by) if n is None else assign_record_id(docs, order_by, n)
    return numbered, request_lines(numbered, system)


def batch_results(
    numbered: DataFrame,
    replies: DataFrame,
    schema: PayloadSchema,
    unique: bool = False,
    order_by: Sequence[str] = DOCUMENT_ORDER,
) -> DataFrame:
    """Batch path, second half: pair by record id, extract and validate.

    Nothing is lost on the way. ``replies`` has record_id and reply, and is_valid if broken records are among
    them; beside the outcomes of extraction, status is ``unanswered`` for a document without a reply,
    ``bad_reply`` for one with a broken record, and ``orphan`` for a reply without a document.
    With ``unique``, the last document, in order, of every sample key and status counts.
    """
    marked = replies if "is_valid" in replies.columns else replies.withColumn("is_valid", F.lit(True))
    left = numbered.withColumn("_is_document", F.lit(True))
    right = marked.select("record_id", "reply", F.coalesce("is_valid", F.lit(False)).alias("_is_reply"))
    paired = left.join(right, "record_id", "full")
    outcome = (
        F.when(F.col("_is_document").isNull(), ORPHAN).when(F.col("_is_reply").isNull(), UNANSWERED).when(~F.col("_is_reply"), BAD_REPLY)
    )
    routed = extract_replies(paired.withColumn("_outcome", outcome), schema)
    routed = routed.withColumn("status", F.coalesce("_outcome", "status")).drop("_outcome", "_is_document", "_is_reply")
    if not unique:
        return routed
    # one row per key and outcome: a later failure does not erase an earlier sample
    return latest_per_key(with_keys(routed, schema), ["sample_key", "status"], order_by)
