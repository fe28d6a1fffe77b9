"""WARC archives in seekable Zstandard bundles.

A bundle is a run of independent frames, each holding whole WARC records, then two
skippable frames: an index of the records and the seek table of the frames. Any
Zstandard reader unpacks the whole; a reader of one record reads the two tables at
the end and the one frame that holds it.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillforge.llm.storage import new_folder, opened
from quillforge.session import stage

# Fixed values of the seekable Zstandard format.
SKIPPABLE, SEEK_TABLE, SEEK_FOOTER = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
ENTRY = np.dtype([("packed", "<u4"), ("size", "<u4")])
#: One record: identifier, frame, offset and length within the unpacked frame.
RECORD = np.dtype([("id", "<i8"), ("null", "u1"), ("frame", "<u4"), ("offset", "<u4"), ("length", "<u4")])
#: Bytes of archives that a task reads back.
READ_BYTES = 1 << 25
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EPOCH = "1970-01-01T00:00:00Z"  # the tables have no capture time


class BundleWriter:
    """Writes records to one bundle; memory is one frame and the index."""

    def __init__(self, stream: Any, frame_bytes: int, level: int):
        self.stream, self.frame_bytes = stream, frame_bytes
        self.packer = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.open, self.held, self.frames, self.records, self.written = [], 0, [], [], 0

    def add(self, record_id: int | None, *parts: bytes) -> None:
        length = sum(map(len, parts))
        self.records.append((record_id or 0, record_id is None, len(self.frames), self.held, length))
        self.open += parts
        self.held += length
        if self.held >= self.frame_bytes:
            self.flush()

    def flush(self) -> None:
        if self.open:
            packed = self.packer.compress(b"".join(self.open))
            self.stream.write(packed)
            self.frames.append((len(packed), self.held))
            self.written += len(packed)
            self.open, self.held = [], 0

    def close(self) -> None:
        self.flush()
        index = np.array(self.records, RECORD).tobytes()
        self.stream.write(struct.pack("<II", SKIPPABLE, len(index)) + index)
        table = np.array(self.frames, ENTRY).tobytes() + struct.pack("<IBI", len(self.frames), 0, SEEK_FOOTER)
        self.stream.write(struct.pack("<II", SEEK_TABLE, len(table)) + table)
        self.stream.close()


def read_tables(source: Any) -> tuple[np.ndarray, np.ndarray]:
    """(frames, records) of an open bundle, from its end; frames carry their start as well."""
    size = source.size()
    n, _, magic = struct.unpack("<IBI", source.read_at(9, size - 9))
    if magic != SEEK_FOOTER:
        raise ValueError("not a seekable Zstandard bundle")
    table_at = size - 9 - n * ENTRY.itemsize - 8
    frames = np.frombuffer(source.read_at(n * ENTRY.itemsize, table_at + 8), ENTRY)
    index_at = int(frames["packed"].astype("i8").sum())
    kind, length = struct.unpack("<II", source.read_at(8, index_at))
    if kind != SKIPPABLE or index_at + 8 + length != table_at:
        raise ValueError("the bundle has no record index")
    return frames, np.frombuffer(source.read_at(length, index_at + 8), RECORD)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def urn(record_id: int | None) -> str:
    return f"<urn:page:{'' if record_id is None else record_id}>"


def from_urn(text: str) -> int | None:
    inner = text.removeprefix("<urn:page:").removesuffix(">")
    return int(inner) if inner else None


def render(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> tuple[bytes, bytes, bytes]:
    """Head, payload (none for a revisit) and end of one record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = b"" if revisit else payload
    target = "".join(c if c > " " else f"%{ord(c):02X}" for c in url) if url else urn(page_id).strip("<>")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {urn(page_id)}",
        f"WARC-Date: {EPOCH}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        *([f"WARC-Refers-To: {urn(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"] if revisit else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(http) + len(body)}",
        "",
        "",
    ]
    return "\r\n".join(lines).encode() + http, body, b"\r\n\r\n"


def parse(record: bytes) -> tuple[dict[str, str], int, bytes]:
    """WARC headers, the payload's length as HTTP states it, and the payload as stored."""
    head, _, block = record.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines)
    length = int(headers["Content-Length"])
    if first != "WARC/1.1" or block[length:] != b"\r\n\r\n":
        raise ValueError("damaged WARC record")
    http, _, payload = block[:length].partition(b"\r\n\r\n")
    stated = next(int(x[15:]) for x in http.decode().split("\r\n") if x.lower().startswith("content-length:"))
    return headers, stated, payload


def with_responses(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, and refers_to and revisit by equal payloads of at least ``min_bytes``.

    Only digests and ids are grouped, and summed before the shuffle. Payloads that
    occur once need no partner, so the table that is joined has the repeated ones
    alone; it is broadcast only if its files are below Spark's threshold.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    repeated = rows.where(F.length("payload") >= min_bytes).groupBy("digest").agg(F.max("page_id").alias("response"), F.count("*").alias("n"))
    repeated = stage(repeated.where("n > 1").drop("n"))
    revisit = F.col("response").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("response")))
    return rows.join(repeated, "digest", "left").select(
        "page_id", "url", "payload", F.when(revisit, F.col("response")).alias("refers_to"), revisit.alias("revisit")
    )


def write_bundles(pages: DataFrame, folder: str | None = None, frame_bytes: int = 1 << 18, bundle_bytes: int = 1 << 27, level: int = 3, min_bytes: int = 0) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) and return the bundles: path, records.

    A task writes its bundles one after another under names of its own, and the staged
    list has only those of tasks that ended, so a lost executor leaves at most files
    that nothing refers to.
    """
    folder = folder or new_folder(pages.sparkSession, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = opened(folder)
        store.create_dir(root, recursive=True)
        bundle, done = None, []
        for batch in batches:
            for page_id, url, payload, refers_to, revisit in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bundle is None:
                    name = f"part-{uuid.uuid4().hex}.warc.zst"
                    bundle = BundleWriter(store.open_output_stream(f"{root}/{name}", compression=None), frame_bytes, level)
                bundle.add(page_id, *render(page_id, url, payload, refers_to, revisit))
                if bundle.written >= bundle_bytes:
                    bundle.close()
                    done.append((f"{folder}/{name}", len(bundle.records)))
                    bundle = None
        if bundle is not None:
            bundle.close()
            done.append((f"{folder}/{name}", len(bundle.records)))
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64())], ["path", "records"])

    return stage(with_responses(pages, min_bytes).mapInArrow(write, "path string, records long"))


def list_frames(bundles: DataFrame) -> DataFrame:
    """One row per frame: path, at, packed, and of its records ids, offsets and lengths. Reads only the bundles' ends."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, name = opened(path)
                with store.open_input_file(name) as source:
                    frames, records = read_tables(source)
                at = 0
                cuts = np.searchsorted(records["frame"], np.arange(len(frames) + 1))
                for k, packed in enumerate(frames["packed"].tolist()):
                    own = records[cuts[k] : cuts[k + 1]]
                    ids = [None if null else i for i, null in zip(own["id"].tolist(), own["null"].tolist(), strict=True)]
                    yield pa.RecordBatch.from_pylist([{"path": path, "at": at, "packed": packed, "ids": ids, "offsets": own["offset"].tolist(), "lengths": own["length"].tolist()}], schema)
                    at += packed

    schema = pa.schema({"path": pa.string(), "at": pa.int64(), "packed": pa.int64(), "ids": pa.list_(pa.int64()), "offsets": pa.list_(pa.int64()), "lengths": pa.list_(pa.int64())})
    return bundles.select("path").mapInArrow(index, "path string, at long, packed long, ids array<long>, offsets array<long>, lengths array<long>")


def read_records(frames: DataFrame) -> DataFrame:
    """The records of the frames: page_id, payload_bytes, payload_digest, record_type, refers_to, and the payload as stored.

    A payload that does not have the digest its record states raises an error.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker, held = zstandard.ZstdDecompressor(), (None, None)
        for batch in batches:
            for path, at, packed, offsets, lengths in zip(*(batch.column(n).to_pylist() for n in ("path", "at", "packed", "offsets", "lengths")), strict=True):
                if held[0] != path:
                    store, name = opened(path)
                    held = (path, store.open_input_file(name))
                text = unpacker.decompress(held[1].read_at(packed, at))
                rows = []
                for offset, length in zip(offsets, lengths, strict=True):
                    headers, stated, payload = parse(text[offset : offset + length])
                    revisit = headers["WARC-Type"] == "revisit"
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    if not revisit and (len(payload) != stated or payload_digest(payload) != digest):
                        raise ValueError(f"payload of {headers['WARC-Record-ID']} is damaged")
                    refers_to = from_urn(headers["WARC-Refers-To"]) if revisit else None
                    rows.append((from_urn(headers["WARC-Record-ID"]), stated, digest, headers["WARC-Type"], refers_to, None if revisit else payload))
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    schema = pa.schema({"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "payload": pa.binary()})
    return frames.mapInArrow(read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write ``pages`` (page_id, url, html) to bundles and read every record back through the seek tables.

    One row per page: page_id, payload_bytes, payload_digest, record_type, refers_to. Null html is an empty
    payload and a null url an address made from the id. Rows with equal id and payload are all responses;
    with a null id they refer to the largest id, if there is one. Payloads of any length are one record each; other
    columns are ignored. No rows give no archive and no rows.
    """
    bundles = write_bundles(pages)
    frames = stage(list_frames(bundles))
    # Rows of frames are small whatever they stand for, so the number of tasks comes from the archives' bytes.
    facts = frames.agg(F.countDistinct("path").alias("bundles"), F.coalesce(F.sum("packed"), F.lit(0)).alias("packed")).first()
    tasks = max(facts["bundles"], -(-facts["packed"] // READ_BYTES), 1)
    return read_records(frames.repartition(tasks, "path", "at")).drop("payload")
