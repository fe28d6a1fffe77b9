"""Token ids in files, by canonical length-limited Huffman codes of their counts over all documents.

A file is one stream of bits, most significant first, in which blocks of ids begin at
listed bit offsets, so that every block can be decoded by itself. Its end holds what a
reader needs: the lengths of the codes (canonical codes follow from them), the bit
offset of every block, and id and number of tokens of every document. Decoding looks
up whole codes in a table and advances all blocks of a window side by side.

Documents are tokenised once, into a staged table. The counts of the vocabulary are all
that the driver sees; a range partitioning brings the documents into ascending order,
each partition writes its own files, and each file is read back by a task of its own.
"""

from __future__ import annotations

import struct
import sys
import types
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillforge.llm.storage import new_folder, opened
from quillforge.llm.wordtable import WordTable, runs, split_all, sums
from quillforge.session import stage

# The file format: first and last bytes, and the numbers before the last ones.
MAGIC, END = b"QFTOKEN1", "<QQQQI8s"
DOCUMENT = np.dtype([("id", "<i8"), ("null", "u1"), ("n", "<i8")])
#: Ids of a block, blocks that are decoded side by side, and ids that a writer holds.
BLOCK, WINDOW_BLOCKS, HELD = 512, 2048, 1 << 20


def code_lengths(counts: np.ndarray, limit: int = 16) -> np.ndarray:
    """Lengths of the best prefix codes of at most ``limit`` bits (more only if there are over 2**limit symbols), by package merge.

    A symbol that does not occur has no code (0); a lone symbol has one bit.
    """
    lengths = np.zeros(len(counts), np.uint8)
    symbols = np.flatnonzero(counts)
    if len(symbols) < 2:
        lengths[symbols] = 1
        return lengths
    limit = max(limit, (len(symbols) - 1).bit_length())
    symbols = symbols[np.argsort(counts[symbols], kind="stable")]
    weights, packages, levels = counts[symbols].astype(np.int64), np.zeros(0, np.int64), []
    for _ in range(limit):
        items = np.concatenate([weights, packages])
        order = np.argsort(items, kind="stable")
        levels.append(order < len(weights))
        items = items[order]
        packages = items[: len(items) // 2 * 2].reshape(-1, 2).sum(axis=1)
    taken = 2 * len(symbols) - 2
    for is_symbol in reversed(levels):
        own = int(is_symbol[:taken].sum())
        lengths[symbols[:own]] += 1
        taken = 2 * (taken - own)
    return lengths


@dataclass(frozen=True)
class Code:
    """A canonical code: codes of the ids, and per ``bits`` leading bits of a stream the id and the length of its code."""

    lengths: np.ndarray
    codes: np.ndarray
    bits: int
    table_ids: np.ndarray
    table_lengths: np.ndarray

    @classmethod
    def of(cls, lengths: np.ndarray) -> Code:
        symbols = np.flatnonzero(lengths)
        symbols = symbols[np.argsort(lengths[symbols], kind="stable")]
        own = lengths[symbols].astype(np.int64)
        bits = int(own.max(initial=1))
        span = 1 << (bits - own)
        codes = np.zeros(len(lengths), np.uint64)
        codes[symbols] = (np.cumsum(span) - span) >> (bits - own)
        ids, sizes = np.zeros(1 << bits, np.uint32), np.ones(1 << bits, np.uint8)
        filled = int(span.sum())
        ids[:filled], sizes[:filled] = np.repeat(symbols, span), np.repeat(own, span)
        return cls(lengths, codes, bits, ids, sizes)

    def encode(self, ids: np.ndarray, at: int) -> tuple[np.ndarray, np.ndarray]:
        """(32-bit words, bit offset after each id) of ids that begin at bit ``at`` of the first word."""
        sizes = self.lengths[ids].astype(np.int64)
        if not sizes.all():
            raise ValueError("an id has no code")
        ends = at + np.cumsum(sizes)
        starts = ends - sizes
        shifted = self.codes[ids] << (np.uint64(64) - ((starts & 31) + sizes).astype(np.uint64))
        n = int(ends[-1] + 31) // 32 + 1
        # Codes share no bits, so sums, which stay below 2**33, are exact.
        words = np.bincount(starts >> 5, (shifted >> np.uint64(32)).astype(np.float64), n)
        words[1:] += np.bincount(starts >> 5, (shifted & np.uint64(0xFFFFFFFF)).astype(np.float64), n)[: n - 1]
        return words.astype(np.uint32), ends

    def decode(self, words: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
        """``n`` ids from each of the bit offsets ``starts``: one row a start. Beyond the stream's end the ids mean nothing."""
        stream = np.concatenate([words, np.zeros(2, np.uint32)]).astype(np.uint64)
        at, last, mask = starts.astype(np.int64), len(words), np.uint64((1 << self.bits) - 1)
        out = np.empty((n, len(starts)), np.uint32)
        for k in range(n):
            word = np.minimum(at >> 5, last)
            seen = (stream[word] << np.uint64(32)) | stream[word + 1]
            key = (seen >> (64 - self.bits - (at & 31)).astype(np.uint64)) & mask
            out[k] = self.table_ids[key]
            at = at + self.table_lengths[key]
        return out.T


class TokenWriter:
    """Writes documents to one file; memory is ``most`` ids, one document and the lists of the file's end."""

    def __init__(self, stream: Any, code: Code, most: int = HELD):
        self.stream, self.code, self.most = stream, code, most
        self.held, self.n_held, self.carry, self.bits, self.ids = [], 0, 0, 0, 0
        self.blocks, self.documents = [], []
        stream.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.documents.append((doc_id or 0, doc_id is None, len(ids)))
        for at in range(0, len(ids), self.most):
            self.held.append(ids[at : at + self.most])
            self.n_held += len(self.held[-1])
            if self.n_held >= self.most:
                self.flush()

    def flush(self) -> None:
        if not self.n_held:
            return
        ids = np.concatenate(self.held)
        base = self.bits // 32 * 32
        words, ends = self.code.encode(ids, self.bits - base)
        words[0] |= self.carry
        starts = np.concatenate([[self.bits], base + ends[:-1]])
        self.blocks.append(starts[-self.ids % BLOCK :: BLOCK])
        self.bits, self.ids = base + int(ends[-1]), self.ids + len(ids)
        whole = (self.bits - base) // 32
        self.stream.write(words[:whole].astype(">u4").tobytes())
        self.carry = words[whole]
        self.held, self.n_held = [], 0

    def close(self) -> None:
        self.flush()
        if self.bits % 32:
            self.stream.write(np.array([self.carry], ">u4").tobytes())
        lengths = zlib.compress(self.code.lengths.tobytes())
        blocks = np.concatenate([*self.blocks, np.zeros(0, np.int64)]).astype("<i8")
        documents = np.array(self.documents, DOCUMENT)
        for part in (lengths, blocks.tobytes(), documents.tobytes()):
            self.stream.write(part)
        self.stream.write(struct.pack(END, self.ids, len(lengths), len(blocks), len(documents), BLOCK, MAGIC))
        self.stream.close()



class TokenReader:
    """Reads one file: ``documents`` in their order, and any run of ids from the checkpoint before it."""

    def __init__(self, source: Any):
        size = source.size()
        self.n, packed, n_blocks, n_documents, self.block, magic = struct.unpack(END, source.read_at(struct.calcsize(END), size - struct.calcsize(END)))
        if magic != MAGIC or source.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError("not a file of token ids")
        documents_at = size - struct.calcsize(END) - n_documents * DOCUMENT.itemsize
        blocks_at = documents_at - 8 * n_blocks
        self.documents = np.frombuffer(source.read_at(n_documents * DOCUMENT.itemsize, documents_at), DOCUMENT)
        self.blocks = np.frombuffer(source.read_at(8 * n_blocks, blocks_at), "<i8")
        lengths = zlib.decompress(source.read_at(packed, blocks_at - packed))
        self.code, self.source = Code.of(np.frombuffer(lengths, np.uint8)), source
        self.body = blocks_at - packed - len(MAGIC)

    def windows(self, first: int = 0, last: int | None = None) -> Iterator[np.ndarray]:
        """The ids ``first`` to ``last`` - 1, some blocks at a time."""
        last = self.n if last is None else min(last, self.n)
        block = first // self.block
        while block * self.block < last:
            stop = min(block + WINDOW_BLOCKS, len(self.blocks), -(-last // self.block))
            begin = int(self.blocks[block]) // 32
            end = -(-int(self.blocks[stop]) // 32) if stop < len(self.blocks) else self.body // 4
            words = np.frombuffer(self.source.read_at(4 * (end - begin), len(MAGIC) + 4 * begin), ">u4").astype(np.uint32)
            ids = self.code.decode(words, self.blocks[block:stop] - 32 * begin, self.block).ravel()
            yield ids[max(first - block * self.block, 0) : last - block * self.block]
            block = stop

    def pieces(self) -> Iterator[tuple[int, np.ndarray]]:
        """(number of the document, its next ids) for every document; one without ids comes with none."""
        windows, ids = self.windows(), np.zeros(0, np.uint32)
        for k, n in enumerate(self.documents["n"].tolist()):
            if not n:
                yield k, ids[:0]
            while n:
                if not len(ids):
                    ids = next(windows)
                yield k, ids[:n]
                n, ids = n - len(ids[:n]), ids[n:]


class TextIds:
    """Ids of texts by the ids of the words between spaces and line ends.

    White space is dropped and no token, special ones included, reaches over it, so the ids of a
    text are those of its words one after another. The pre-tokens of a word of ASCII signs and
    common Latin letters are known; any other word is left to the tokenizer.
    """

    #: Letters whose small form is one letter and that never compose, and the tokenizer's pre-token pattern over them.
    LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f"
    PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^{LETTERS}0-9]+"

    def __init__(self, path: str):
        self.sure = rf"^[!-~{self.LETTERS}]*$"
        self.table = WordTable(path, self.pre_tokens)

    def pre_tokens(self, words: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        """(places of the words whose pre-tokens are known, the pre-tokens of these, number of each one's)."""
        sure = pc.and_not(pc.match_substring_regex(words, self.sure), pc.match_substring(words, "<|"))
        known = np.flatnonzero(sure.to_numpy(zero_copy_only=False))
        return known, *split_all(pc.utf8_lower(words.take(pa.array(known))), self.PATTERN)

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each text)."""
        # A full stop or comma behind a letter and before white space is a token of its own.
        apart = pc.replace_substring_regex(texts, r"(\pL)([.,])(\s|$)", r"\1 \2\3")
        words = pc.split_pattern(pc.replace_substring(apart, "\n", " "), " ")
        rows = self.table.rows(words.flatten())
        offsets = words.offsets.to_numpy()
        return self.table.ids.gather(rows), sums(self.table.ids.lengths(rows), offsets - offsets[0])


def id_type(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def text_ids(path: str) -> TextIds:
    """This worker's ids, kept from one task to the next."""
    kept = sys.modules.setdefault("_kept_by_worker", types.ModuleType("_kept_by_worker")).__dict__
    key = f"text ids {path}"
    if key not in kept:
        kept[key] = TextIds(path)
    return kept[key]


def tokenised(docs: DataFrame, tokenizer: str, end_id: int, kind: str) -> DataFrame:
    """doc_id, ids (little-endian, of type ``kind``, ``end_id`` last) and place, a number that no other row has."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, place = text_ids(tokenizer), TaskContext.get().partitionId() << 33
        for batch in runs(batches):
            ids, lengths = encoder.ids(pc.fill_null(batch.column(1), ""))
            ends = np.cumsum(lengths)
            ids = np.insert(ids.astype(kind), ends, end_id)
            bounds = np.concatenate([[0], ends + np.arange(1, len(ends) + 1)]) * ids.itemsize
            column = pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(ids)])
            places = np.arange(place, place + len(lengths))
            place += len(lengths)
            yield pa.RecordBatch.from_arrays([batch.column(0), column.cast(pa.binary()), pa.array(places)], ["doc_id", "ids", "place"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(encode, "doc_id long, ids binary, place long")


def count_ids(tokens: DataFrame, vocabulary: int, kind: str) -> np.ndarray:
    """How often each id occurs in all rows; tasks count first, so at most one row a task and id is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join([x.as_buffer() for x in batch.column(0)]), kind), minlength=vocabulary)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(total[found])], ["id", "n"])

    counts = np.zeros(vocabulary, np.int64)
    # One row for each id of the vocabulary at most.
    for row in tokens.select("ids").mapInArrow(count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[row["id"]] = row["n"]
    return counts


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int = 1, folder: str | None = None, max_bits: int = 16, file_bytes: int = 1 << 27) -> DataFrame:
    """Write the ids of ``docs`` (doc_id, text) to files, in ascending doc_id order, and list them: path, task, number, documents, ids.

    Rows without an id come first, rows of one id in the order of a hash of their ids. A task writes files under
    names of its own and the staged list has those of finished tasks only, so a lost executor leaves at most files
    that nothing refers to. Files are in order by task, then number. No rows give no files.
    """
    from tokenizers import Tokenizer

    vocabulary = max(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id + 1)
    kind = id_type(vocabulary)
    tokens = stage(tokenised(docs, tokenizer, end_id, kind))
    lengths = code_lengths(count_ids(tokens, vocabulary, kind), max_bits)
    folder = folder or new_folder(docs.sparkSession, "tokens")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = opened(folder)
        store.create_dir(root, recursive=True)
        code, task, writer, done = Code.of(lengths), TaskContext.get().partitionId(), None, []

        def close() -> None:
            writer.close()
            done.append((f"{folder}/{name}", task, len(done), len(writer.documents), writer.ids))

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if writer is None:
                    name = f"part-{uuid.uuid4().hex}.ids"
                    writer = TokenWriter(store.open_output_stream(f"{root}/{name}", compression=None), code, min(HELD, file_bytes))
                writer.add(doc_id, np.frombuffer(ids.as_buffer(), kind))
                if writer.bits >= 8 * file_bytes:
                    close()
                    writer = None
        if writer is not None:
            close()
        columns = zip(*done, strict=True) if done else [[]] * len(schema)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    schema = pa.schema({"path": pa.string(), "task": pa.int32(), "number": pa.int32(), "documents": pa.int64(), "ids": pa.int64()})
    # The place deals equal rows, however many, over several partitions.
    order = ["doc_id", "h", "place"]
    keyed = tokens.withColumn("h", F.xxhash64("ids"))
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "ids")
    return stage(ordered.mapInArrow(write, "path string, task int, number int, documents long, ids long"))


def read_token_files(files: DataFrame, with_ids: bool = False) -> DataFrame:
    """The documents of the listed files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, and on request
    ids (little-endian unsigned 32-bit). One task a file; without ids its memory is one window of blocks at any document length."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(*(batch.column(n).to_pylist() for n in ("path", "before")), strict=True):
                store, name = opened(path)
                with store.open_input_file(name) as source:
                    reader = TokenReader(source)
                    crc, kept = [0] * len(reader.documents), [[] for _ in reader.documents] if with_ids else None
                    for k, ids in reader.pieces():
                        data = ids.astype("<u4").tobytes()
                        crc[k] = zlib.crc32(data, crc[k])
                        if with_ids:
                            kept[k].append(data)
                own = reader.documents
                columns = [
                    pa.array(own["id"], pa.int64(), mask=own["null"].astype(bool)),
                    pa.array(start + np.cumsum(own["n"]) - own["n"], pa.int64()),
                    pa.array(own["n"], pa.int64()),
                    pa.array(crc, pa.int64()),
                    *([pa.array([b"".join(x) for x in kept], pa.binary())] if with_ids else []),
                ]
                yield from pa.Table.from_arrays(columns, [f.split()[0] for f in fields]).to_batches(1 << 14)

    fields = ["doc_id long", "start long", "n_tokens long", "ids_crc32 long", *(["ids binary"] if with_ids else [])]
    # One row a file: the list is as long as there are files, whatever they hold.
    before = Window.orderBy("task", "number").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.select("path", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before"))
    return placed.repartition(max(files.count(), 1), "path").mapInArrow(read, ", ".join(fields))


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Write the ids of ``docs`` (doc_id, text; other columns are ignored) and read them back: doc_id, start, n_tokens, ids_crc32 per row.

    Null and empty texts are the end id alone. Null ids come before all others; repeated rows are documents of their own.
    A text of any length is one document. No rows give no rows.
    """
    return read_token_files(write_token_files(docs, tokenizer, end_id))
