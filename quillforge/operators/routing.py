"""From reply text to a routed, normalised sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillforge.functions.chat import dump_json
from quillforge.functions.payload import payload
from quillforge.functions.text import fence, output_key, preview, sample_key
from quillforge.functions.validation import validate
from quillforge.schema.kinds import PayloadSchema

VALID, SCHEMA_INVALID, NO_JSON, ERROR = "valid", "schema_invalid", "no_json", "error"
# Outcomes of a batch job that never reach extraction.
UNANSWERED, BAD_REPLY, ORPHAN = "unanswered", "bad_reply", "orphan"


def extract_replies(df: DataFrame, schema: PayloadSchema, reply: str = "reply") -> DataFrame:
    """Add ``payload`` (raw JSON text), ``errors``, ``output`` (normalised) and ``status`` to every row."""
    found = fence(df, {"_found": payload(F.col(reply), schema.root.accepts_empty)})
    found = found.withColumns({"payload": F.col("_found.text"), "_object": F.col("_found.object")})
    checked = validate(found, "_object", schema.root, is_valid="_is_valid")
    status = (
        F.when(F.col(reply).isNull(), ERROR)
        .when(F.col("payload").isNull(), NO_JSON)
        .when(F.col("_is_valid"), VALID)
        .otherwise(SCHEMA_INVALID)
    )
    no_payload = F.array().cast(checked.schema["errors"].dataType)
    return (
        checked.withColumn("status", status)
        .withColumn("errors", F.when(F.col("payload").isNull(), no_payload).otherwise(F.col("errors")))
        .drop("_found", "_object", "_is_valid")
    )


def key_columns(schema: PayloadSchema, source: Column, content: Column) -> dict[str, Column]:
    """Join key (full hash) and display name (short hash) of a document's sample."""
    token = schema.version_token
    return {
        "sample_key": sample_key(schema.name, token, source, content),
        "output_key": output_key(schema.name, token, source, content),
    }


def to_samples(routed: DataFrame, schema: PayloadSchema) -> DataFrame:
    """Valid rows as samples: content, normalised and raw payload as JSON text, keys and schema version."""
    keys = key_columns(schema, F.col("source"), F.col("content"))
    return routed.filter(F.col("status") == VALID).select(
        *[c.alias(name) for name, c in keys.items()],
        "source",
        "content",
        dump_json(F.col("output")).alias("output_json"),
        F.col("payload").alias("raw_json"),
        F.lit(schema.name).alias("schema_name"),
        F.lit(schema.version_token).alias("schema_version"),
    )


def to_quarantine(routed: DataFrame, schema: PayloadSchema, reply: str = "reply") -> DataFrame:
    """Everything that is not a sample, with the reason and the start of the reply."""
    keys = key_columns(schema, F.col("source"), F.col("content"))
    return routed.filter(F.col("status") != VALID).select(
        *[c.alias(name) for name, c in keys.items()],
        "source",
        "content",
        F.col("payload").alias("raw_json"),
        "errors",
        preview(F.col(reply)).alias("reply_preview"),
        F.lit(schema.name).alias("schema_name"),
        F.lit(schema.version_token).alias("schema_version"),
        "status",
    )
