"""Session settings the operators rely on, and intermediate tables."""

from __future__ import annotations

import re
import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Observation, SparkSession

# Runtime-settable settings. Duplicate JSON keys must resolve to the last one
# (as in Python's json module), timestamps are compared in UTC, and AQE handles
# partition coalescing and skewed sort-merge joins. Generated methods beyond 8000
# bytes are never compiled by the JVM's JIT; wide schemas run faster in parts.
# Texts are long, so a batch for a Python worker holds fewer rows than usual.
RUNTIME_CONF = {
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it.

    Functions of this package are sent to Python workers by value, so executors
    need not have it installed.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__package__])
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("quillforge")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    session = configure(builder.getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    return session


def stage_folder(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the cluster's checkpoint folder.

    Only a local session without one gets a private temporary folder.
    """
    shared = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if re.match(r"local(\[|$)", spark.sparkContext.master) is None:
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="quillforge-stage-")
        spark.sparkContext.setCheckpointDir(shared)
    return shared


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later uses see exactly these rows even after losing executors, read only the
    columns they need, and do not repeat the work above.
    """
    path = f"{stage_folder(df.sparkSession)}/quillforge-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_counted(df: DataFrame, **counts: Column) -> tuple[DataFrame, dict[str, int]]:
    """``stage(df)`` and aggregates of its rows, observed by the job that writes them: the table is not read again.

    Only tasks that end count, so attempts that are lost change nothing.
    """
    seen = Observation()
    staged = stage(df.observe(seen, *[c.alias(name) for name, c in counts.items()]))
    return staged, seen.get
