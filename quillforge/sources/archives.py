"""Document archives (``.tar`` and ``.tar.gz``) as rows.

A compressed archive can only be read front to back, by one task, as a stream.
A plain ``.tar`` is first indexed (headers only, skipping over the contents). The
index is a plan of byte ranges, runs of neighbouring members, which are dealt to as
many tasks as the archives' size calls for and fetched by one read each.
"""

from __future__ import annotations

import re
import tarfile
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillforge.functions.payload import TOO_LARGE, beyond_parser, strict_object
from quillforge.functions.text import DOCUMENT_MEMBER, base_name, batch_name, is_archive
from quillforge.functions.validation import validate
from quillforge.operators.dedupe import latest_per_key
from quillforge.schema.samples import DOCUMENT

BYTES_PER_TASK = 128 * 1024 * 1024
FLUSH_BYTES = 16 * 1024 * 1024
#: A run of members is fetched at once and has at most so many bytes (or one member); other contents between two members end it beyond GAP_BYTES.
RUN_BYTES, GAP_BYTES, RUN_MEMBERS = 64 * 1024 * 1024, 1024 * 1024, 20_000

# A scheme with the slashes behind it, or the slashes a plain path begins with.
PATH_SCHEME = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?/+"

_MEMBER_SCHEMA = "batch_pos int, path string, member string, member_pos long, raw string, error string"
_INDEX_SCHEMA = (
    "batch_pos int, path string, offset long, length long, "
    "members array<struct<member: string, member_pos: long, offset: long, size: long>>, error string"
)


def open_location(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path behind a Spark path."""
    uri = re.sub(r"^file:/+", "file:///", path)
    uri = re.sub(r"^s3[an]://", "s3://", uri)
    return pafs.FileSystem.from_uri(uri)


def _is_document(member: str) -> bool:
    """Python side of ``is_document_member``, so that other contents are never loaded."""
    return re.fullmatch(DOCUMENT_MEMBER, member.rsplit("/", 1)[-1], re.DOTALL) is not None


class _Rows:
    """Collects rows and hands out record batches of limited size."""

    def __init__(self, names: Sequence[str], types: Sequence[pa.DataType]):
        self._schema = pa.schema(list(zip(names, types)))
        self._rows: list[tuple] = []
        self._bytes = 0

    def add(self, *row) -> None:
        self._rows.append(row)
        self._bytes += 64 + sum(len(v) if isinstance(v, str) else 128 * len(v) for v in row if isinstance(v, (str, list)))

    @property
    def full(self) -> bool:
        return self._bytes >= FLUSH_BYTES or len(self._rows) >= 10_000

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self._rows)) or [()] * len(self._schema)
        batch = pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, self._schema)], schema=self._schema
        )
        self._rows, self._bytes = [], 0
        return batch


def _member_rows() -> _Rows:
    names = ["batch_pos", "path", "member", "member_pos", "raw", "error"]
    return _Rows(names, [pa.int32(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()])


def _per_path(make: Callable[[str], Iterator[tuple]], rows: Callable[[], _Rows]):
    """Arrow task that turns every path of its input into rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = rows()
        for batch in batches:
            for batch_pos, path in zip(batch.column("batch_pos").to_pylist(), batch.column("path").to_pylist()):
                for row in make(path):
                    out.add(batch_pos, *row)
                    if out.full:
                        yield out.take()
        yield out.take()

    return run


def _text_of(data: bytes, size: int) -> tuple[str | None, str | None]:
    """(text, error) of a member's bytes."""
    if len(data) != size:
        return None, f"short read: {len(data)} of {size} bytes"
    try:
        return data.decode(), None
    except UnicodeDecodeError as failure:
        return None, f"UnicodeDecodeError: {failure}"


def _read_stream(path: str) -> Iterator[tuple]:
    """Document members of an archive, read front to back."""
    try:
        filesystem, location = open_location(path)
        with filesystem.open_input_stream(location, compression=None) as source:
            mode = "r|gz" if path.endswith(".gz") else "r|"
            with tarfile.open(fileobj=source, mode=mode) as tar:
                for position, member in enumerate(tar):
                    if member.isreg() and _is_document(member.name):
                        yield path, member.name, position, *_text_of(tar.extractfile(member).read(), member.size)
    except (OSError, tarfile.TarError, EOFError) as failure:
        yield path, None, None, None, f"{type(failure).__name__}: {failure}"


def runs_of(members: Iterable[tuple[str, int, int, int]]) -> Iterator[tuple[int, int, list[tuple[str, int, int, int]]]]:
    """(offset, length, members) of the ranges to fetch, for members (name, position, offset, size) in the order of an archive."""
    held: list[tuple[str, int, int, int]] = []
    for member in members:
        _, _, offset, size = member
        if held:
            start, end = held[0][2], held[-1][2] + held[-1][3]
            if offset + size - start > RUN_BYTES or offset - end > GAP_BYTES or len(held) >= RUN_MEMBERS:
                yield start, end - start, held
                held = []
        held.append(member)
    if held:
        yield held[0][2], held[-1][2] + held[-1][3] - held[0][2], held


def _read_index(path: str) -> Iterator[tuple]:
    """The runs of the document members of a plain archive. What was indexed before an archive breaks off is kept."""
    broken: list[str] = []

    def listed() -> Iterator[tuple[str, int, int, int]]:
        try:
            filesystem, location = open_location(path)
            with filesystem.open_input_file(location) as source, tarfile.open(fileobj=source, mode="r:") as tar:
                for position, member in enumerate(tar):
                    if member.isreg() and _is_document(member.name):
                        yield member.name, position, member.offset_data, member.size
                # The reader takes a damaged header for the end, which is a block of zeros.
                if any(source.read_at(min(tarfile.BLOCKSIZE, max(source.size() - tar.offset, 0)), tar.offset)):
                    broken.append(f"damaged header at byte {tar.offset}")
        except (OSError, tarfile.TarError, EOFError) as failure:
            broken.append(f"{type(failure).__name__}: {failure}")

    names = ("member", "member_pos", "offset", "size")
    for offset, length, members in runs_of(listed()):
        yield path, offset, length, [dict(zip(names, m)) for m in members], None
    for error in broken:
        yield path, None, None, None, error


def read_run(source: Any, offset: int, length: int, members: Sequence[dict]) -> Iterator[tuple]:
    """(member, position, text, error) of the members of a run, after one read."""
    data = memoryview(source.read_at(length, offset))
    for m in members:
        start = m["offset"] - offset
        yield m["member"], m["member_pos"], *_text_of(bytes(data[start : start + m["size"]]), m["size"])


def _read_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contents of the runs of an index."""
    out = _member_rows()
    for batch in batches:
        opened: dict[str, pa.NativeFile] = {}
        for row in batch.to_pylist():
            batch_pos, path = row["batch_pos"], row["path"]
            if row["error"] is not None:
                out.add(batch_pos, path, None, None, None, row["error"])
                continue
            try:
                if path not in opened:
                    filesystem, location = open_location(path)
                    opened[path] = filesystem.open_input_file(location)
                for found in read_run(opened[path], row["offset"], row["length"], row["members"]):
                    out.add(batch_pos, path, *found)
                    if out.full:
                        yield out.take()
            except OSError as failure:
                for m in row["members"]:
                    out.add(batch_pos, path, m["member"], m["member_pos"], None, f"{type(failure).__name__}: {failure}")
        for handle in opened.values():
            handle.close()
    yield out.take()


def _tasks(n_files: int, n_bytes: int) -> int:
    return max(1, min(n_files, 10_000), n_bytes // BYTES_PER_TASK)


def untar(archives: DataFrame) -> DataFrame:
    """Document members of the archives (path, length, batch_pos): their position and raw text; an unreadable archive gives an error row.

    ``length`` (file size) is used to size the work. The number of tasks is set
    explicitly: path rows are tiny and would otherwise be merged into one task.
    """
    gz = F.endswith(F.col("path"), F.lit(".gz"))
    facts = archives.agg(
        F.count_if(gz).alias("n_gz"),
        F.count_if(~gz).alias("n_tar"),
        F.coalesce(F.sum(F.when(~gz, F.col("length"))), F.lit(0)).alias("tar_bytes"),
    ).first()
    streams = (
        archives.filter(gz)
        .select("batch_pos", "path")
        .repartition(_tasks(facts["n_gz"], 0))
        .mapInArrow(_per_path(_read_stream, _member_rows), _MEMBER_SCHEMA)
    )
    member = pa.struct([("member", pa.string()), ("member_pos", pa.int64()), ("offset", pa.int64()), ("size", pa.int64())])
    index_names = ["batch_pos", "path", "offset", "length", "members", "error"]
    index_types = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.list_(member), pa.string()]
    index = (
        archives.filter(~gz)
        .select("batch_pos", "path")
        .repartition(_tasks(facts["n_tar"], 0))
        .mapInArrow(_per_path(_read_index, lambda: _Rows(index_names, index_types)), _INDEX_SCHEMA)
    )
    ranges = index.repartition(_tasks(facts["n_tar"], facts["tar_bytes"])).mapInArrow(_read_ranges, _MEMBER_SCHEMA)
    return streams.unionByName(ranges)


def document_members(archives: DataFrame) -> DataFrame:
    """Every document member of the archives (columns path, length, batch_pos), checked.

    Columns: path, batch_name, batch_pos, file_name, member_pos, raw, content,
    source, timestamp, errors, archive_error, is_valid. Bad members (not UTF-8,
    cut short, too large to be parsed) and unreadable archives stay as invalid rows.
    """
    parsed = untar(archives).withColumn("_object", strict_object(F.col("raw")))
    too_large = F.when(F.col("_object").isNull() & beyond_parser(F.col("raw")), TOO_LARGE)
    checked = validate(parsed.withColumn("error", F.coalesce("error", too_large)), "_object", DOCUMENT)
    return checked.select(
        "path",
        batch_name(base_name(F.col("path"))).alias("batch_name"),
        "batch_pos",
        base_name(F.col("member")).alias("file_name"),
        "member_pos",
        "raw",
        "output.content",
        "output.source",
        "output.timestamp",
        "errors",
        F.col("error").alias("archive_error"),
        "is_valid",
    )


def documents_of(members: DataFrame) -> DataFrame:
    """Valid documents; of members with the same base name in an archive the last one counts."""
    unique = latest_per_key(members.filter("is_valid"), ["path", "file_name"], ["member_pos"])
    return unique.select("batch_name", "batch_pos", "file_name", "content", "source", "timestamp")


def plain_path(path: str) -> str:
    """A path without its scheme: archives are told apart by the whole of it."""
    return re.sub(PATH_SCHEME, "/", path)


def read_document_members(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Document members of the archives at ``paths``, whose order is the batch order."""
    listing = spark.read.format("binaryFile").load(list(paths)).select("path", "length")
    places = {plain_path(p): i for i, p in reversed(list(enumerate(paths)))}
    order = spark.createDataFrame(list(places.items()), "archive string, batch_pos int")
    plain = F.regexp_replace("path", PATH_SCHEME, "/")
    named = listing.filter(is_archive(F.col("path"))).withColumn("archive", plain)
    # ``order`` has one row per path the caller passed in
    return document_members(named.join(F.broadcast(order), "archive").select("path", "length", "batch_pos"))


def read_document_batches(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Valid documents of the archives at ``paths``."""
    return documents_of(read_document_members(spark, paths))
