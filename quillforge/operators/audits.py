"""Counts and checks over batches. All are partial aggregates; nothing is collected per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def document_count(df: DataFrame, batch: str = "batch_name") -> DataFrame:
    """Documents per batch."""
    return df.groupBy(batch).agg(F.count("*").alias("n_documents"))


def outcome_counts(df: DataFrame, status: str = "status") -> DataFrame:
    """Rows per status."""
    return df.groupBy(status).agg(F.count("*").alias("n"))


def success_and_failure(df: DataFrame, ok: Column) -> DataFrame:
    """One row: successful and failed."""
    good = F.coalesce(ok, F.lit(False))
    return df.agg(F.count_if(good).alias("successful"), F.count_if(~good).alias("failed"))


def batch_validity(df: DataFrame, ok: Column, batch: str = "batch_name") -> DataFrame:
    """Valid and invalid rows per batch."""
    good = F.coalesce(ok, F.lit(False))
    return df.groupBy(batch).agg(F.count_if(good).alias("n_valid"), F.count_if(~good).alias("n_invalid"))


def retention(df: DataFrame, fits: Column) -> DataFrame:
    """Kept and total rows, and whether fewer than half were kept."""
    kept = F.count_if(F.coalesce(fits, F.lit(False)))
    return df.agg(
        kept.alias("n_kept"),
        F.count("*").alias("n_total"),
        (kept < F.count("*") / 2).alias("too_few_kept"),
    )


def sample_count(lines: DataFrame, line: str = "value") -> DataFrame:
    """Lines that are not blank."""
    return lines.agg(F.count_if(F.col(line).rlike(r"(?U)[^\s\x1c-\x1f]")).alias("num_samples"))


def step_budget(
    counts: DataFrame,
    n: str,
    epochs: int,
    batch_size: int,
    accumulation: int = 1,
    warmup_ratio: float = 0.0,
    iters: int | None = None,
) -> DataFrame:
    """Training steps from sample counts: iterations, scheduled steps and warm-up (half-to-even rounding)."""
    own = F.ceil(F.col(n) / batch_size) * epochs
    with_iters = counts.withColumn("iters", (own if iters is None else F.lit(iters)).cast("bigint"))
    steps = F.floor(F.col("iters") / accumulation).cast("bigint")
    scheduled = with_iters.withColumn("schedule_steps", steps)
    return scheduled.withColumn("warmup", F.bround(F.lit(warmup_ratio) * F.col("schedule_steps")).cast("bigint"))


def files_per_batch(listing: DataFrame, requested: DataFrame, batch: str = "batch_name", key: str = "key") -> DataFrame:
    """Number of distinct training files (``….jsonl``, a file or a folder of parts) of every requested batch."""
    unit = F.regexp_extract(key, r"^(.*?\.jsonl)(?:/.*)?\z", 1)
    units = listing.withColumn("_unit", unit).filter(F.col("_unit") != "").select(batch, "_unit").distinct()
    counts = units.groupBy(batch).agg(F.count("*").alias("n_files"), F.min("_unit").alias("file"))
    return requested.select(batch).join(counts, batch, "left").na.fill(0, ["n_files"])


def require_single_file(listing: DataFrame, requested: Sequence[str], batch: str = "batch_name") -> dict[str, str]:
    """The one training file of every requested batch; raises if a batch has none or several."""
    spark = listing.sparkSession
    names = spark.createDataFrame([(name,) for name in dict.fromkeys(requested)], f"{batch} string")
    # One row per name the caller passed in.
    rows = files_per_batch(listing.join(F.broadcast(names), batch, "left_semi"), names, batch).collect()
    wrong = sorted((r[batch], r["n_files"]) for r in rows if r["n_files"] != 1)
    if wrong:
        raise ValueError("need exactly one .jsonl per batch: " + ", ".join(f"{b} has {n}" for b, n in wrong))
    return {r[batch]: r["file"] for r in rows}


def require_non_empty(df: DataFrame, message: str = "no valid samples found") -> DataFrame:
    """The frame itself; raises if it has no rows."""
    if df.isEmpty():
        raise ValueError(message)
    return df
