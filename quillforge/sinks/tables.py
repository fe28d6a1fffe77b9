"""Sample, quarantine and request tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillforge.functions.prompts import BATCH_MAX_TOKENS, batch_request
from quillforge.operators.routing import to_quarantine, to_samples
from quillforge.schema.kinds import PayloadSchema


def write_samples(routed: DataFrame, schema: PayloadSchema, path: str, mode: str = "append") -> None:
    """Valid rows as Parquet, one folder per schema and version."""
    to_samples(routed, schema).write.mode(mode).partitionBy("schema_name", "schema_version").parquet(path)


def write_quarantine(routed: DataFrame, schema: PayloadSchema, path: str, mode: str = "append") -> None:
    """All other rows as Parquet, one folder per reason."""
    to_quarantine(routed, schema).write.mode(mode).partitionBy("status").parquet(path)


def request_lines(
    docs: DataFrame, system: Column | str | None, max_tokens: int = BATCH_MAX_TOKENS
) -> DataFrame:
    """One JSON request per document (columns ``record_id``, ``content``); absent members are left out."""
    request = batch_request(F.col("record_id"), F.col("content"), system, max_tokens)
    return docs.select(F.to_json(request).alias("value"))


def write_batch_requests(
    docs: DataFrame, system: Column | str | None, path: str, max_tokens: int = BATCH_MAX_TOKENS
) -> None:
    """Requests as JSON lines."""
    request_lines(docs, system, max_tokens).write.mode("overwrite").text(path)
