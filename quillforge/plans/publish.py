"""Publishing a training batch."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillforge.functions.chat import chat_sample, dump_json
from quillforge.schema.kinds import PayloadSchema
from quillforge.session import stage_counted
from quillforge.sinks.guard import write_if_absent
from quillforge.sinks.training import export_sample_set, manifest_row, write_manifest, write_training_jsonl


@dataclass(frozen=True)
class PublishedBatch:
    path: str
    num_samples: int
    written: bool


def chat_samples(examples: DataFrame, system_prompt: str, payload: str = "normalised") -> DataFrame:
    """Chat samples of valid examples, from the normalised or the raw payload."""
    if payload not in ("normalised", "raw"):
        raise ValueError("payload is 'normalised' or 'raw'")
    text = dump_json(F.col("output"), pretty=True) if payload == "normalised" else F.col("raw_json")
    return examples.withColumn("messages", chat_sample(system_prompt, F.col("content"), text))


def publish_batch(
    examples: DataFrame,
    schema: PayloadSchema,
    system_prompt: str,
    short_description: str,
    folder: str,
    description: str | None = None,
    now: datetime | None = None,
    payload: str = "normalised",
    manifest_table: str | None = None,
) -> PublishedBatch:
    """Write chat lines, manifest and sample export of the valid examples below ``folder/<run name>``.

    ``examples`` is what ``parse_training_examples`` gives; it is validated once,
    into a stage table that all three outputs read.
    """
    spark = examples.sparkSession
    keep = [c for c in ("output_key", "file_name") if c in examples.columns]
    name = F.coalesce(*[F.col(c) for c in keep]) if keep else F.lit(None).cast("string")
    rows = examples.filter("is_valid").select(name.alias("output_key"), "content", "raw_json", "output")
    valid, counts = stage_counted(rows, n=F.count("*"))
    count = counts["n"]
    if count == 0:
        raise ValueError("no valid samples found")
    now = now or datetime.now()
    path = f"{folder.rstrip('/')}/{now:%Y%m%d-%H%M%S}_{short_description}"
    written = write_if_absent(
        chat_samples(valid, system_prompt, payload), f"{path}/train_chat_{short_description}.jsonl", write_training_jsonl
    )
    row = manifest_row(spark, schema.name, schema.version_token, short_description, count, description, now)
    if written:
        write_manifest(row, path, manifest_table)
        export_sample_set(valid, f"{path}/train_chat_{short_description}_samples")
    return PublishedBatch(path, count, written)
