"""Alignment of two tokenizers over a corpus, by an inverted index of bitmaps per pair of ids.

Two tokenizers cut the same bytes; where both cut, a group ends, and every id of a group's
one side is linked with every id of its other side. Each task lists the links of a chunk of
documents by pair: a compressed bitmap of the chunk's documents that hold the pair linked,
and planes of bits for how often. Bitmaps of a chunk's batches are OR-ed; chunks share no
document, so the number of documents of a pair is the sum of its bitmaps' bits, and it is
numbers that are summed and ranked over the corpus. Then each pair's count goes to its
postings and is scattered from there to the documents, chunk by chunk.

Both tokenizers treat what lies between single spaces by itself, so each distinct word is
tokenised and aligned once per worker.
"""

from __future__ import annotations

import hashlib
import os
import re
import sys
import types
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillforge.llm.packing import TextIds
from quillforge.llm.wordtable import LONGEST, MARK, Rows, runs, sums
from quillforge.session import stage

#: A chunk ends with the batch in which it reaches so many documents (bitmaps have a 16-bit range) or postings.
CHUNK_DOCUMENTS, CHUNK_POSTINGS = 8192, 4_000_000
#: Words that a worker remembers the alignment of.
WORDS = 500_000
#: Groups of more pairs of places than this have their ids counted first.
MANY_PAIRS = 4096
#: A pair is one number: the id of the first tokenizer above that of the second.
SHIFT = 32


@dataclass(frozen=True)
class Side:
    """Ids of one tokenizer for some stretches of text, one stretch after another: how many each has, and how many bytes each id stands for."""

    ids: np.ndarray
    lengths: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray, lengths: np.ndarray, spelt: Rows) -> Side:
        ids = ids.astype(np.int64)
        return cls(ids, lengths, spelt.lengths(ids))

    def spells(self, spelt: Rows, text: bytes, bounds: np.ndarray) -> np.ndarray:
        """Which of the stretches, whose bytes in ``text`` lie between the bounds, the ids spell."""
        ends = np.concatenate([[0], np.cumsum(self.lengths)])
        right = sums(self.sizes, ends) == np.diff(bounds)
        own = np.repeat(right, self.lengths)
        wanted = np.frombuffer(text, np.uint8)[np.repeat(right, np.diff(bounds))]
        wrong = np.flatnonzero(spelt.gather(self.ids[own]) != wanted)
        places = np.concatenate([[0], np.cumsum(np.diff(bounds)[right])])
        right[np.flatnonzero(right)[np.searchsorted(places, wrong, "right") - 1]] = False
        return right

    def only(self, kept: np.ndarray) -> Side:
        own = np.repeat(kept, self.lengths)
        return Side(self.ids[own], np.where(kept, self.lengths, 0), self.sizes[own])


def align(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(cuts, group of every id of a, of b, and the groups' number per stretch) of two sides that spell the same stretches.

    A cut is a byte where ids of both sides end, so every stretch ends with one.
    """
    ends_a, ends_b = np.cumsum(a.sizes), np.cumsum(b.sizes)
    cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
    bytes_of = np.concatenate([[0], np.cumsum(sums(a.sizes, np.concatenate([[0], np.cumsum(a.lengths)])))])
    return cuts, np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b), np.diff(np.searchsorted(cuts, bytes_of, "right"))


def link(a: Side, b: Side, in_a: np.ndarray, in_b: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, pair, number of links) of all pairs of ids that share a group; only in groups of many ids are pairs told apart."""
    n_a, n_b = np.bincount(in_a, minlength=groups), np.bincount(in_b, minlength=groups)
    start_b = np.cumsum(n_b) - n_b
    small = n_a * n_b <= MANY_PAIRS
    own = np.flatnonzero(small[in_a])
    times = n_b[in_a[own]]
    nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    pairs = (np.repeat(a.ids[own], times) << SHIFT) | b.ids[np.repeat(start_b[in_a[own]], times) + nth]
    found = [(np.repeat(in_a[own], times), pairs, np.ones(len(pairs), np.int64))]
    start_a = np.cumsum(n_a) - n_a
    for g in np.flatnonzero(~small).tolist():
        x, n = np.unique(a.ids[start_a[g] : start_a[g] + n_a[g]], return_counts=True)
        y, m = np.unique(b.ids[start_b[g] : start_b[g] + n_b[g]], return_counts=True)
        found.append((np.full(len(x) * len(y), g), ((x << SHIFT)[:, None] | y).ravel(), (n[:, None] * m).ravel()))
    group, pairs, counts = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.argsort(group, kind="stable") if len(found) > 1 else slice(None)
    return group[order], pairs[order], counts[order]


class Aligner:
    """Two tokenizers side by side: a byte-level one, which gets a space before the text, and a sentence-piece one, which adds it.

    A stretch begins at every single space between two signs that are no white space: a token of the
    byte-level vocabulary starts there, and no piece reaches over it, as no piece has a space behind another sign.
    """

    #: What the pieces write for a space, and the form of pieces that are one byte.
    SPACE, BYTE = "▁", re.compile(r"<0x([0-9A-F]{2})>")

    def __init__(self, bytes_path: str, pieces_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task
        import sentencepiece

        self.table, self.b = TextIds(bytes_path).table, sentencepiece.SentencePieceProcessor(model_file=pieces_path)
        tokenizer = self.table.tokenizer
        tokenizer.encode_special_tokens = True
        # Fixed rule of byte-level vocabularies: printable signs of Latin-1 stand for their bytes, the other bytes for signs from 256 on.
        others = [x for x in range(256) if not (33 <= x <= 126 or 161 <= x <= 172 or 174 <= x <= 255)]
        byte_of = {chr(256 + k): x for k, x in enumerate(others)} | {chr(x): x for x in set(range(256)) - set(others)}
        spelt = [b""] * tokenizer.get_vocab_size()
        for token, k in tokenizer.get_vocab().items():
            spelt[k] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.a_bytes = self._bytes(spelt)
        self.b_bytes = self._bytes([bytes([int(m[1], 16)]) if (m := self.BYTE.fullmatch(p)) else p.replace(self.SPACE, " ").encode() for p in pieces])
        # The text of each id with what may follow it: another of its side, the other side, the next group.
        self.n_ids = max(len(spelt), len(pieces))
        self.shown_as = pa.array([f"{k}{end}" for end in ",|;" for k in range(self.n_ids)], pa.large_string())
        # Where a piece reached over the start of a word, texts would have to be taken whole.
        self.by_words = not any(re.search(f"[^{self.SPACE}]{self.SPACE}", p) for p in pieces)
        self.cut = re.compile(r"(?<=\S) (?=\S)").split
        # Where white space meets a space, signs on both sides decide.
        self.uneven = rf"[{TextIds.WHITE}] | [{TextIds.WHITE}]|^ | $|^$|{MARK}"
        self.clear()

    @staticmethod
    def _bytes(spelt: list[bytes]) -> Rows:
        rows = Rows("u1")
        rows.append(np.frombuffer(b"".join(spelt), np.uint8), np.array([len(x) for x in spelt], np.int64))
        return rows

    def clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.pairs, self.counts = Rows("i8"), Rows("i8")
        #: Per row the numbers of ids of both sides and of groups.
        self.numbers = np.zeros((3, 0), np.int64)
        #: Per row the groups as text, each with its end; null where the tokens do not spell the text.
        self.shown = pa.array([], pa.large_string())

    def _learn(self, stretches: pa.Array) -> np.ndarray:
        """Align stretches, each written without the space before it; their rows."""
        spaced, n = pc.binary_join_element_wise("", stretches, " "), len(stretches)
        text = "".join(spaced.to_pylist()).encode()
        bounds = np.concatenate([[0], np.cumsum(pc.binary_length(spaced).to_numpy().astype(np.int64))])
        a = Side.of(*self.table.encode(spaced), self.a_bytes)
        ids = self.b.encode(stretches.to_pylist(), num_threads=1)
        lengths = np.fromiter(map(len, ids), np.int64, n)
        b = Side.of(np.fromiter(chain.from_iterable(ids), np.int64, lengths.sum()), lengths, self.b_bytes)
        spelt = a.spells(self.a_bytes, text, bounds) & b.spells(self.b_bytes, text, bounds)
        a, b = a.only(spelt), b.only(spelt)
        cuts, in_a, in_b, groups = align(a, b)
        of_group, pairs, counts = link(a, b, in_a, in_b, len(cuts))
        lengths = np.bincount(np.repeat(np.arange(n), groups)[of_group], minlength=n)
        self.pairs.append(pairs, lengths)
        self.counts.append(counts, lengths)
        self.numbers = np.concatenate([self.numbers, [a.lengths, b.lengths, groups]], axis=1)
        # The ids of each group's first side, then of its second.
        order = np.argsort(np.concatenate([2 * in_a, 2 * in_b + 1]), kind="stable")
        last_a, last_b = (np.append(g[1:] != g[:-1], True)[: len(g)] for g in (in_a, in_b))
        parts = self.shown_as.take(pa.array((np.concatenate([last_a, 2 * last_b]) * self.n_ids + np.concatenate([a.ids, b.ids]))[order]))
        shown = joined(parts, a.lengths + b.lengths)
        rows = np.arange(len(self.shown), len(self.shown) + n)
        self.shown = pa.concat_arrays([self.shown, pc.if_else(pa.array(spelt), shown, pa.scalar(None, pa.large_string()))])
        kept = np.flatnonzero(pc.utf8_length(stretches).to_numpy() <= LONGEST)
        self.rows.update(zip(stretches.take(pa.array(kept)).to_numpy(zero_copy_only=False), rows[kept].tolist(), strict=True))
        return rows

    def stretches(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """(stretches of all texts, without the space before each, and the number of each text's)."""
        if not self.by_words:
            return texts.filter(pc.not_equal(texts, "")), pc.not_equal(texts, "").to_numpy(zero_copy_only=False).astype(np.int64)
        uneven = np.flatnonzero(pc.match_substring_regex(texts, self.uneven).to_numpy(zero_copy_only=False)).tolist()
        split = pc.split_pattern(pc.replace_substring(texts, " ", MARK), MARK)
        if uneven:
            lists = split.to_pylist()
            for k in uneven:
                lists[k] = self.cut(t) if (t := texts[k].as_py()) else []
            split = pa.array(lists, pa.list_(pa.string()))
        return split.flatten(), np.diff(split.offsets.to_numpy()).astype(np.int64)

    def documents(self, texts: pa.Array) -> Iterator[tuple[int, int, int, str, np.ndarray, np.ndarray]]:
        """n_a, n_b, n_groups, groups, pairs and their numbers of links, of each text."""
        if len(self.shown) > WORDS:
            self.clear()
        own, n = self.stretches(texts)
        coded = own.dictionary_encode()
        found = [*map(self.rows.get, coded.dictionary.to_numpy(zero_copy_only=False))]
        new = [k for k, row in enumerate(found) if row is None]
        if new:
            for k, row in zip(new, self._learn(coded.dictionary.take(pa.array(new))).tolist(), strict=True):
                found[k] = row
        rows = np.array(found, np.int64)[coded.indices.to_numpy()]
        bounds = np.concatenate([[0], np.cumsum(n)])
        shown = joined(self.shown.take(pa.array(rows)), n).to_pylist()
        numbers = np.array([sums(x[rows], bounds) for x in self.numbers]).T.tolist()
        for own_numbers, text, at, end in zip(numbers, shown, bounds.tolist(), bounds[1:].tolist(), strict=False):
            if not text:
                yield 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64)
                continue
            pairs, counts = self.pairs.gather(rows[at:end]), self.counts.gather(rows[at:end])
            order = np.argsort(pairs)
            pairs = pairs[order]
            first = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1]))
            yield *own_numbers, text[:-1], pairs[first], np.add.reduceat(counts[order], first)


def joined(texts: pa.Array, n: np.ndarray) -> pa.Array:
    """Consecutive texts put together, so many at a time; null if one of them is."""
    offsets = pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int64())
    return pc.binary_join(pa.LargeListArray.from_arrays(offsets, texts), pa.scalar("", pa.large_string()))


def aligner(bytes_path: str, pieces_path: str) -> Aligner:
    """This worker's tokenizers, kept from one task to the next."""
    kept = sys.modules.setdefault("_kept_by_worker", types.ModuleType("_kept_by_worker")).__dict__
    key = f"aligner {bytes_path} {pieces_path}"
    if key not in kept:
        kept[key] = Aligner(bytes_path, pieces_path)
    return kept[key]


def pack_postings(pairs: np.ndarray, documents: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, list[bytes], list[bytes]]:
    """Of postings sorted by pair and document: pairs, numbers of documents, bitmaps and planes.

    A bitmap has the bits of ``size`` documents, or where shorter the list of them in 16 bits each. Plane k has bit k of
    the multiplicity less one of each posting of the pair; planes end with the highest bit that is set.
    """
    first = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1])) if len(pairs) else np.zeros(0, np.int64)
    n = np.diff(np.append(first, len(pairs)))
    wide, listed, more = -(-size // 8), documents.astype("<u2"), counts - 1
    highest = np.maximum.reduceat(more, first) if len(first) else more
    bitmaps, planes = [], []
    for at, k, top in zip(first.tolist(), n.tolist(), highest.tolist()):
        if 2 * k < wide:
            bitmaps.append(listed[at : at + k].tobytes())
        else:
            bits = np.zeros(8 * wide, np.uint8)
            bits[documents[at : at + k]] = 1
            bitmaps.append(np.packbits(bits).tobytes())
        own = more[at : at + k]
        planes.append(b"".join([np.packbits((own >> p & 1).astype(np.uint8)).tobytes() for p in range(top.bit_length())]) if top else b"")
    return pairs[first], n, bitmaps, planes


def unpack_bitmap(bitmap: bytes, n: int, size: int) -> np.ndarray:
    """The documents of a bitmap of ``n`` bits."""
    if 2 * n < -(-size // 8):
        return np.frombuffer(bitmap, "<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(bitmap, np.uint8)))


def unpack_planes(planes: bytes, n: int) -> np.ndarray:
    """The multiplicities of ``n`` postings."""
    counts, wide = np.ones(n, np.int64), -(-n // 8)
    for p in range(len(planes) // wide):
        counts += np.unpackbits(np.frombuffer(planes, np.uint8, wide, p * wide), count=n).astype(np.int64) << p
    return counts


def pair_index(docs: DataFrame, bytes_path: str, pieces_path: str) -> DataFrame:
    """The inverted index, one row per chunk and pair: chunk, size (its documents), pair, n (documents), bitmap and planes.

    Each chunk has one more row, without a pair, that lists its documents: ids, numbers of tokens, groups and links, and the
    groups' digests. A chunk is held by the task that reads it, and bounded in documents and postings (a document more may be added).
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, task, chunk = aligner(bytes_path, pieces_path), TaskContext.get().partitionId() << 33, 0
        listed: list[tuple] = []
        parts: list[tuple[np.ndarray, ...]] = []
        postings = 0

        def flush() -> Iterator[pa.RecordBatch]:
            documents = np.concatenate([*(np.full(len(p), d) for d, p, _ in parts), np.zeros(0, np.int64)]).astype(np.int64)
            pairs = np.concatenate([*(p for _, p, _ in parts), np.zeros(0, np.int64)])
            counts = np.concatenate([*(c for _, _, c in parts), np.zeros(0, np.int64)])
            # Parts come in the order of documents, so a stable sort leaves those of a pair in it.
            order = np.argsort(pairs, kind="stable")
            found, n, bitmaps, planes = pack_postings(pairs[order], documents[order], counts[order], len(listed))
            for at in range(0, len(found), 1 << 16):
                cut = slice(at, at + (1 << 16))
                own = len(found[cut])
                columns = [np.full(own, task + chunk), np.full(own, len(listed)), found[cut], n[cut], bitmaps[cut], planes[cut], [None] * own]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
            rows = [dict(zip(names, row, strict=True)) for row in listed]
            columns = [[task + chunk], [len(listed)], [None], [None], [None], [None], [rows]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        for batch in runs(batches):
            own = both.documents(pc.fill_null(batch.column(1), ""))
            for doc_id, (n_a, n_b, n_groups, shown, pairs, counts) in zip(batch.column(0).to_pylist(), own, strict=True):
                parts.append((len(listed), pairs, counts))
                digest = hashlib.sha256(shown.encode()).hexdigest() if shown else ""
                listed.append((doc_id, n_a, n_b, n_groups, int(counts.sum()), digest))
                postings += len(pairs)
                if len(listed) >= CHUNK_DOCUMENTS or postings >= CHUNK_POSTINGS:
                    yield from flush()
                    chunk, listed, parts, postings = chunk + 1, [], [], 0
        if listed:
            yield from flush()

    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    kinds = [pa.int64()] * 5 + [pa.string()]
    documents = pa.list_(pa.struct(list(zip(names, kinds, strict=True))))
    schema = pa.schema({"chunk": pa.int64(), "size": pa.int32(), "pair": pa.int64(), "n": pa.int32(), "bitmap": pa.binary(), "planes": pa.binary(), "documents": documents})
    struct = "struct<doc_id: long, n_a: long, n_b: long, n_groups: long, n_links: long, groups_sha256: string>"
    declared = f"chunk long, size int, pair long, n int, bitmap binary, planes binary, documents array<{struct}>"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(read, declared)


def pair_counts(index: DataFrame) -> DataFrame:
    """pair, count (documents of all chunks) and best: whether no other pair of its first id has a higher count."""
    counts = index.where("pair is not null").groupBy("pair").agg(F.sum("n").alias("count"))
    of_a = Window.partitionBy(F.shiftright("pair", SHIFT))
    return counts.withColumn("best", F.col("count") == F.max("count").over(of_a))


def pair_table(index: DataFrame) -> DataFrame:
    """The alignment itself: a_id, b_id, documents, best."""
    b_id = F.col("pair").bitwiseAND(F.lit((1 << SHIFT) - 1))
    return pair_counts(index).select(F.shiftright("pair", SHIFT).alias("a_id"), b_id.alias("b_id"), F.col("count").alias("documents"), "best")


def document_scores(index: DataFrame) -> DataFrame:
    """Per document the tokens, groups and links, the links that are best for their first id, and the sum of the counts of all."""

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, best, total = None, np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            chunks = batch.column(0).to_numpy()
            cuts = np.flatnonzero(np.append(True, chunks[1:] != chunks[:-1])).tolist() if len(chunks) else []
            for at, end in zip(cuts, [*cuts[1:], len(chunks)], strict=True):
                part = batch.slice(at, end - at)
                if part.column(0)[0].as_py() != now:
                    now, size = part.column(0)[0].as_py(), part.column(1)[0].as_py()
                    best, total = np.zeros(size, np.int64), np.zeros(size, np.int64)
                own = part.filter(pc.is_valid(part.column(2)))
                numbers, listed, multiples = [], [], []
                for n, bitmap, planes in zip(*(own.column(c).to_pylist() for c in (2, 3, 4)), strict=True):
                    numbers.append(n)
                    listed.append(unpack_bitmap(bitmap, n, size))
                    multiples.append(unpack_planes(planes, n) if planes else np.ones(n, np.int64))
                if numbers:
                    places, links = np.concatenate(listed), np.concatenate(multiples)
                    np.add.at(total, places, links * np.repeat(own.column(6).to_numpy(), numbers))
                    np.add.at(best, places, links * np.repeat(own.column(7).to_numpy(zero_copy_only=False).astype(np.int64), numbers))
                # The row of the documents is the chunk's last.
                for rows in part.column(5).drop_null().to_pylist():
                    columns = [*([r[f] for r in rows] for f in kept[:5]), best, total, [r["groups_sha256"] for r in rows]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], kept)

    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    kinds = [pa.int64()] * 7 + [pa.string()]
    scored = index.where("pair is not null").join(pair_counts(index), "pair")
    listed = index.where("pair is null").withColumns({"count": F.lit(None).cast("long"), "best": F.lit(None).cast("boolean")})
    by_chunk = scored.unionByName(listed).repartition("chunk").sortWithinPartitions("chunk", F.col("documents").isNotNull())
    columns = by_chunk.select("chunk", "size", "n", "bitmap", "planes", "documents", "count", "best")
    return columns.mapInArrow(scatter, ", ".join(f"{n} long" for n in kept[:-1]) + ", groups_sha256 string")


def align_documents(docs: DataFrame, bytes_path: str, pieces_path: str) -> DataFrame:
    """Scores of the alignment of two tokenizers for every row of ``docs`` (doc_id, text; other columns are ignored).

    One row per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256. Null and empty texts, and texts whose
    tokens do not spell them, have zeros and an empty digest. Repeated rows and null ids are documents like others and count as such.
    A text of any length is one document. No rows give no rows.
    """
    return document_scores(stage(pair_index(docs, bytes_path, pieces_path)))
