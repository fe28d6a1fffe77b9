"""Document order, capped selection, record positions and reproducible shuffling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillforge.session import stage

DOCUMENT_ORDER = ("batch_pos", "file_name")

_ROW_BITS = (1 << 33) - 1


def document_order(df: DataFrame, order_by: Sequence[str] = DOCUMENT_ORDER) -> DataFrame:
    """Caller's batch order, then file name (binary order: ``document_10`` before ``document_2``)."""
    return df.orderBy(*order_by)


def key_positions(df: DataFrame, order_by: Sequence[str], name: str) -> DataFrame:
    """The key columns of every row with its 0-based global position; null keys come first.

    Only the keys are range-partitioned and sorted. A row's position is its index
    in its partition plus the sizes of the partitions before, so no task ever holds
    more than one partition. Keys that do not identify a row raise an error: which
    of two equal rows comes first would be chance.
    """
    keys = stage(
        df.select(*order_by)
        .repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_row", F.monotonically_increasing_id().bitwiseAND(_ROW_BITS))
    )
    repeated = keys.groupBy(*order_by).agg(F.count("*").alias("_n")).filter("_n > 1").drop("_n").head(1)
    if repeated:
        raise ValueError(f"{', '.join(order_by)} must identify a row; repeated: {tuple(repeated[0])}")
    # One row per partition, so the global window and the broadcast are small.
    sizes = keys.groupBy("_part").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    position = (F.col("_offset") + F.col("_row")).alias(name)
    return keys.join(F.broadcast(offsets), "_part").select(*order_by, position)


def _with_keys(df: DataFrame, positions: DataFrame, order_by: Sequence[str], name: str) -> DataFrame:
    """``df`` with its rows' positions; nulls are equal. How the keys travel is left to their size."""
    renamed = positions.select(*[F.col(c).alias(f"_key_{c}") for c in order_by], name)
    on = [df[c].eqNullSafe(renamed[f"_key_{c}"]) for c in order_by]
    return df.join(renamed, on).select(*[df[c] for c in df.columns], name)


def with_positions(df: DataFrame, order_by: Sequence[str] = DOCUMENT_ORDER, name: str = "position") -> DataFrame:
    """Add the 0-based global position of every row; ``order_by`` must identify a row."""
    return _with_keys(df, key_positions(df, order_by, name), order_by, name)


def take_first(df: DataFrame, n: int, order_by: Sequence[str] = DOCUMENT_ORDER, name: str = "position") -> DataFrame:
    """First ``n`` rows in order (all, if there are fewer), each with its 0-based position.

    The content columns take no part in the selection, whatever ``n`` is; they are
    joined to the chosen keys.
    """
    if n < 0:
        raise ValueError("n must not be negative")
    return _with_keys(df, key_positions(df, order_by, name).filter(F.col(name) < n), order_by, name)


def assign_record_id(df: DataFrame, order_by: Sequence[str] = DOCUMENT_ORDER, n: int | None = None) -> DataFrame:
    """Add ``record_id``: the position in document order as text, after an optional cap."""
    numbered = with_positions(df, order_by) if n is None else take_first(df, n, order_by)
    return numbered.withColumn("record_id", F.col("position").cast("string")).drop("position")


def stable_record_id(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Add ``record_id`` from the columns that identify a row. Nothing is sorted or moved: the form for uncapped sets."""
    parts = [F.col(c).cast("string") for c in key]
    # Lengths keep the parts apart; a null is none of the texts.
    spelled = [F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts]
    return df.withColumn("record_id", F.md5(F.concat_ws("/", *spelled)))


def shuffle_key(seed: int | str, *key: Column) -> Column:
    """Pseudo-random sort key of a row, the same on every run."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in key]))


def shuffled(df: DataFrame, seed: int | str, *key: str) -> DataFrame:
    """Rows in a reproducible random order; ``key`` must identify a row."""
    columns = [F.col(k) for k in key]
    return df.orderBy(shuffle_key(seed, *columns), *columns)


def union_batches(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate batches, duplicates kept, adding their position in the given order as ``batch_pos``."""
    if not frames:
        raise ValueError("no batches given")
    out = frames[0].withColumn("batch_pos", F.lit(0))
    for i, frame in enumerate(frames[1:], start=1):
        out = out.unionByName(frame.withColumn("batch_pos", F.lit(i)))
    return out


def as_batches(df: DataFrame, batch: str, names: Sequence[str]) -> DataFrame:
    """The rows of the named batches of one table, in one scan, with their batch's position in ``names`` as ``batch_pos``."""
    if not names:
        raise ValueError("no batches given")
    place = F.array_position(F.array(*[F.lit(n) for n in names]), F.col(batch)).cast("int") - 1
    return df.withColumn("batch_pos", place).where(F.col("batch_pos") >= 0)


def first_match(listing: DataFrame, condition: Column, key: str = "key") -> DataFrame:
    """One row with the first key, in listing order, that satisfies the condition (null if none does)."""
    return listing.filter(condition).agg(F.min(key).alias(key))
