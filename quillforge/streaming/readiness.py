"""Jobs released as their outputs land."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quillforge.operators.pending import finished_jobs
from quillforge.sources.objects import file_path, relative_key

LISTING = "path string, modificationTime timestamp, length bigint, content binary"


def read_listing_stream(spark: SparkSession, folder: str, pattern: str, max_files: int | None = None) -> DataFrame:
    """New objects below a folder whose names match, as a stream of their keys. Contents are not read."""
    reader = spark.readStream.format("binaryFile").schema(LISTING).option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder).select(relative_key(file_path(), folder).alias("key"))


def release_jobs(
    spark: SparkSession,
    folder: str,
    jobs: DataFrame,
    batch_file: str,
    sink: str,
    checkpoint: str,
    job: str = "job_id",
    max_files: int | None = None,
) -> StreamingQuery:
    """Append every job of ``jobs`` to the Parquet folder ``sink`` once its output is below ``folder``, then stop.

    The checkpoint remembers which jobs were released, one key each, and which objects were seen, so a job is released exactly
    once however many outputs it has and however often this is started again; no earlier listing is read again.
    ``jobs`` is read anew by every micro-batch: a job must be listed there when its first output is seen.
    """
    keys = read_listing_stream(spark, folder, f"*{batch_file}.out", max_files)
    known = finished_jobs(keys, batch_file, job).join(jobs.select(job).distinct(), job, "left_semi")
    released = known.dropDuplicates([job])
    return released.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(sink)
