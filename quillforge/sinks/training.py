"""Training batches: chat lines, manifest, sample export, prepared table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillforge.functions.chat import dump_json

MANIFEST_COLUMNS = (
    "schema string, schema_version string, short_description string, description string, "
    "num_samples bigint, created_at timestamp"
)


def training_line(messages: Column) -> Column:
    """One chat sample as a JSON line, null names included."""
    return dump_json(F.struct(messages.alias("messages")))


def write_training_jsonl(samples: DataFrame, path: str, messages: str = "messages") -> None:
    """Chat samples as JSON lines."""
    samples.select(training_line(F.col(messages)).alias("value")).write.mode("overwrite").text(path)


def export_sample_set(samples: DataFrame, path: str) -> None:
    """Samples as JSON lines ``{content, output}`` with their names, next to the training file."""
    # The payload goes in as it stands; a line break in valid JSON is only ever space between tokens.
    head = F.to_json(F.struct("output_key", "content"))
    payload = F.translate("raw_json", "\r\n", "  ")
    line = F.concat(F.substring(head, F.lit(1), F.length(head) - 1), F.lit(',"output":'), payload, F.lit("}"))
    samples.select(line.alias("value")).write.mode("overwrite").option("compression", "gzip").text(path)


def manifest_row(
    spark: SparkSession,
    schema: str,
    schema_version: str,
    short_description: str,
    num_samples: int,
    description: str | None = None,
    created_at: datetime | None = None,
) -> DataFrame:
    """The one manifest row of a batch; the description defaults to the short one."""
    row = (
        schema,
        schema_version,
        short_description,
        description or short_description,
        num_samples,
        created_at or datetime.now(),
    )
    return spark.createDataFrame([row], MANIFEST_COLUMNS)


def write_manifest(row: DataFrame, batch_path: str, table_path: str | None = None) -> None:
    """Manifest as ``metadata.yaml`` (one JSON object, which is YAML) in the batch and as a row of the manifest table."""
    row.coalesce(1).select(F.to_json(F.struct(*row.columns)).alias("value")).write.mode("overwrite").text(
        f"{batch_path}/metadata.yaml"
    )
    if table_path is not None:
        row.coalesce(1).write.mode("append").parquet(table_path)


def manifest_rows(
    counts: DataFrame, schema: str, schema_version: Column | str, short_description: Column, created_at: Column | None = None, description: Column | None = None
) -> DataFrame:
    """Manifest rows of many batches at once, from one row a batch with ``num_samples``; ``batch_name`` is kept in front."""
    return counts.select(
        "batch_name",
        F.lit(schema).alias("schema"),
        F.lit(schema_version).alias("schema_version"),
        short_description.alias("short_description"),
        (short_description if description is None else F.coalesce(description, short_description)).alias("description"),
        F.col("num_samples").cast("bigint").alias("num_samples"),
        (F.current_timestamp() if created_at is None else created_at).alias("created_at"),
    )


def write_manifests(rows: DataFrame, folder: str, table_path: str | None = None) -> None:
    """Manifests of many batches, in one job: ``metadata.yaml`` folders below ``folder``, by batch_name, and rows of the manifest table."""
    columns = [c for c in rows.columns if c != "batch_name"]
    one_line = F.to_json(F.struct(*columns)).alias("value")
    rows.select(one_line, "batch_name").write.mode("overwrite").partitionBy("batch_name").text(f"{folder}/metadata.yaml")
    if table_path is not None:
        rows.select(*columns).write.mode("append").parquet(table_path)


def write_prepared(df: DataFrame, path: str, rank: str = "rank", line: str = "value") -> None:
    """Lines in the order of a persisted rank column: part files, and lines in them, follow the rank.

    Rows of one rank are equal lines; a number of their own lets a much repeated one spread over several files.
    """
    numbered = df.select(rank, line, F.monotonically_increasing_id().alias("_own"))
    ordered = numbered.repartitionByRange(rank, "_own").sortWithinPartitions(rank, "_own")
    ordered.select(line).write.mode("overwrite").text(path)
