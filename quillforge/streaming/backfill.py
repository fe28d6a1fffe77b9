"""Incremental backfill: newly landed documents to samples."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillforge.operators.dedupe import latest_per_key
from quillforge.operators.inference import Completer
from quillforge.operators.pending import pending
from quillforge.operators.routing import to_quarantine, to_samples
from quillforge.plans.generate import generate
from quillforge.schema.kinds import PayloadSchema
from quillforge.sources.objects import path_exists

DOCUMENT_COLUMNS = "batch_name string, batch_pos int, file_name string, content string, source string, timestamp string"


def read_document_stream(
    spark: SparkSession, folder: str, file_format: str = "json", max_files: int | None = None
) -> DataFrame:
    """New document files in a folder, as a stream with a fixed schema."""
    reader = spark.readStream.format(file_format).schema(DOCUMENT_COLUMNS)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)


def _finished(spark: SparkSession, sink: str, batch_id: int) -> DataFrame | None:
    """Keys of samples from other micro-batches (a replayed batch must not see its own)."""
    path = f"{sink}/samples"
    if not path_exists(spark, path):
        return None
    table = spark.read.option("basePath", path).schema("sample_key string, batch_id bigint").parquet(path)
    return table.filter(F.col("batch_id") != batch_id).select("sample_key")


def backfill_stream(
    docs: DataFrame,
    sink: str,
    schema: PayloadSchema,
    make_completer: Callable[[], Completer],
    system: str,
    checkpoint: str,
    order_by: Sequence[str] = ("batch_pos", "batch_name", "file_name"),
    **inference,
) -> StreamingQuery:
    """Process everything that has landed, then stop.

    Each micro-batch writes folders of its own, replacing what an interrupted
    attempt left there, so a replay gives the same tables. Documents finished in
    other micro-batches are skipped; failed ones are tried again when they land again.
    """
    spark = docs.sparkSession

    def process(batch: DataFrame, batch_id: int) -> None:
        routed = generate(
            batch,
            schema,
            make_completer,
            system,
            outputs=_finished(spark, sink, batch_id),
            order_by=order_by,
            **inference,
        )
        to_samples(routed, schema).write.mode("overwrite").parquet(f"{sink}/samples/batch_id={batch_id}")
        to_quarantine(routed, schema).write.mode("overwrite").parquet(f"{sink}/quarantine/batch_id={batch_id}")

    return (
        docs.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def failed_documents(spark: SparkSession, sink: str) -> DataFrame:
    """Quarantined documents that have no sample since, one per key: what a retry (``generate``) should take up."""
    rejected = spark.read.parquet(f"{sink}/quarantine").select("sample_key", "source", "content", "batch_id")
    latest = latest_per_key(rejected, ["sample_key"], ["batch_id"])
    if path_exists(spark, f"{sink}/samples"):
        latest = pending(latest, spark.read.parquet(f"{sink}/samples"))
    return latest.select("source", "content")
