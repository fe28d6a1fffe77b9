"""Batch-inference replies (JSON lines)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillforge.functions.payload import strict_object
from quillforge.functions.validation import validate
from quillforge.schema.samples import BATCH_REPLY

LINE_ORDER = ("file", "block", "line")


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text lines with columns that put them in file order: file, start of the split, row within the split."""
    return spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )


def parse_batch_outputs(lines: DataFrame) -> DataFrame:
    """Checked replies: record_id, reply (first text part), errors, is_valid.

    Bad lines stay as invalid rows, with their record id if they are objects that have one.
    """
    checked = validate(lines.withColumn("_object", strict_object(F.col("value"))), "_object", BATCH_REPLY)
    first_part = F.get(F.col("output.modelOutput.content"), F.lit(0))["text"]
    return checked.select(
        *lines.columns,
        F.coalesce(F.col("output.recordId"), F.try_variant_get("_object", "$.recordId", "string")).alias("record_id"),
        first_part.alias("reply"),
        "errors",
        "is_valid",
    )


def read_batch_outputs(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Replies of a batch-inference job."""
    return parse_batch_outputs(numbered_lines(spark, path))
