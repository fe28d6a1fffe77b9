"""Write once, all or nothing, with several writers.

A writer writes to a folder of its own below the target and then creates the target's
marker, which only one can: the marker names the folder that counts. Readers follow the
marker, so a half-written folder, or that of a writer who came second, is never read.
"""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from quillforge.sinks.guard import Writer

MARKER, ATTEMPTS = "_committed", "_attempts"


class Unfinished(RuntimeError):
    """A marker without content: its writer died between creating and filling it, or is about to fill it."""


def _local(path: str) -> str | None:
    """A path on this machine's file system without its scheme; None for any other."""
    found = re.match(r"(?:file:/{1,3})?(/[^:]*|[^:/][^:]*)\Z", path)
    return None if found is None else ("/" + found[1].lstrip("/") if path.startswith("file:") else found[1])


def _hadoop(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with a text unless it exists; whether this call created it. Local files are exclusive by the operating system."""
    local = _local(path)
    if local is not None:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        try:
            with open(local, "x", encoding="utf-8") as out:
                out.write(text)
        except FileExistsError:
            return False
        return True
    place, store = _hadoop(spark, path)
    try:
        out = store.create(place, False)
    except Exception:
        if store.exists(place):
            return False
        raise
    out.write(bytearray(text, "utf-8"))
    out.close()
    return True


def _content(spark: SparkSession, path: str) -> str | None:
    place, store = _hadoop(spark, path)
    if not store.exists(place):
        return None
    stream = store.open(place)
    try:
        return bytes(stream.readNBytes(4096)).decode()
    finally:
        stream.close()


def committed_path(spark: SparkSession, path: str, version: int = 0) -> str | None:
    """The folder with what was committed at ``path``; None before that. Versions are commits of their own."""
    name = _content(spark, f"{path.rstrip('/')}/{MARKER}-{version}")
    if name == "":
        raise Unfinished(f"{path}: the marker is empty; remove it if its writer is gone")
    return name and f"{path.rstrip('/')}/{ATTEMPTS}/{name}"


def write_committed(df: DataFrame, path: str, write: Writer, version: int = 0) -> bool:
    """Write ``df`` as the given version of ``path`` unless it is committed; whether this call's rows are the ones that count.

    Of several writers at once all may write, but one commits. What a writer that failed left is never read;
    the folder of one that came second is removed by it.
    """
    spark, root = df.sparkSession, path.rstrip("/")
    marker = f"{root}/{MARKER}-{version}"
    if _content(spark, marker) is not None:
        return False
    name = uuid.uuid4().hex
    write(df, f"{root}/{ATTEMPTS}/{name}")
    if _create(spark, marker, name):
        return True
    own, store = _hadoop(spark, f"{root}/{ATTEMPTS}/{name}")
    store.delete(own, True)
    return False


def latest_version(spark: SparkSession, path: str) -> int | None:
    """The highest committed version of ``path``; None if there is none."""
    place, store = _hadoop(spark, path)
    if not store.exists(place):
        return None
    names = [s.getPath().getName() for s in store.listStatus(place)]
    found = [int(n.rpartition("-")[2]) for n in names if re.fullmatch(rf"{MARKER}-\d+", n)]
    return max(found, default=None)
