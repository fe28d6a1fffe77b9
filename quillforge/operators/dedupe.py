"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillforge.operators.bloom import divided, key_filter, unused
from quillforge.session import stage


def _pick(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    row = pick(F.struct(*rest), F.struct(*order_by)).alias("_row")
    # A null key equals no other: such rows are groups of their own.
    unknown = reduce(or_, [F.col(k).isNull() for k in keys])
    numbered = df.withColumn("_own", F.when(unknown, F.monotonically_increasing_id()))
    return numbered.groupBy(*keys, "_own").agg(row).select(*keys, "_row.*").select(*df.columns)


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The earliest row of every key; rows whose key has a null all stay.

    An aggregate rather than a window: each task first reduces its own copies
    to one, so a key that holds a large share of the rows is no burden.
    """
    return _pick(df, keys, order_by, F.min_by)


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The last row of every key; rows whose key has a null all stay."""
    return _pick(df, keys, order_by, F.max_by)


def _address() -> tuple[Column, Column]:
    """Where a row of a Parquet scan lies."""
    return F.col("_metadata.file_path"), F.col("_metadata.row_index")


def one_per_key_of_files(scan: DataFrame, keys: Sequence[Column | str], order_by: Sequence[str], last: bool = False) -> DataFrame:
    """``first_per_key`` (or the last) of a table of Parquet files, for rows that are much larger than their keys.

    Keys may be expressions, such as the hash of a content. Only keys, order and addresses are grouped and sorted: the rows that lose are told by file and number. A filter of
    their addresses then passes most rows straight through the second scan; what it holds back is joined with the list
    by hash. ``scan`` is a table as read, at most filtered. Which of rows with one key and one order stays is arbitrary but one does;
    rows whose key has a null all stay.
    """
    path, row, mine, best = (unused(n, scan) for n in ("_file", "_row", "_mine", "_best"))
    address = F.struct(*[a.alias(n) for a, n in zip(_address(), (path, row), strict=True)])
    named = [unused(f"_key{i}", scan) for i in range(len(keys))]
    exact = [(F.col(k) if isinstance(k, str) else k).alias(n) for k, n in zip(keys, named, strict=True)]
    known = reduce(and_, [F.col(n).isNotNull() for n in named])
    narrow = scan.select(*exact, F.struct(*order_by, address.alias("at")).alias(mine)).where(known)
    chosen = narrow.groupBy(*named).agg((F.max if last else F.min)(mine).alias(best), F.count("*").alias("n")).where("n > 1")
    losers = narrow.join(stage(chosen.drop("n")), named).where(F.col(f"{mine}.at") != F.col(f"{best}.at"))
    losers = stage(losers.select(f"{mine}.at.*"))
    placed = scan.select("*", *[a.alias(n) for a, n in zip(_address(), (path, row), strict=True)])
    maybe, rest = divided(placed, key_filter(losers, path, row), path, row)
    kept = maybe.join(losers.hint("shuffle_hash"), [path, row], "left_anti")
    kept = kept if rest is None else kept.unionByName(rest)
    return kept.select(*scan.columns)
