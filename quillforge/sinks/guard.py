"""Write-once guard."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from quillforge.sources.objects import path_exists

Writer = Callable[[DataFrame, str], None]


def write_if_absent(df: DataFrame, path: str, write: Writer, force: bool = False) -> bool:
    """Write unless the target exists (or ``force``). Returns whether anything was written."""
    if not force and path_exists(df.sparkSession, path):
        return False
    write(df, path)
    return True


def write_lines(df: DataFrame, path: str) -> None:
    """One-column text lines, replacing what is there."""
    df.write.mode("overwrite").text(path)
