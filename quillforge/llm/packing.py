"""Best-fit packing of tokenised documents into sequences of a fixed capacity.

Tokens are counted where the text is; what is packed is the histogram of piece
lengths, which has at most ``capacity`` entries at any corpus size. The
dominance reduction and best fit work on whole runs of equal lengths, so a plan
is a short table of runs. Pieces find their place in it by their rank among the
pieces of their length, which comes from per-task counters and a sum over tasks:
no piece is sorted, and no group of pieces meets in one task.
"""

from __future__ import annotations

import re
import sys
import types
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillforge.llm.wordtable import MARK, WordTable, runs, split_all, sums
from quillforge.session import stage

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@dataclass(frozen=True)
class Run:
    """Pieces of one length, ranks ``first`` to ``first + count - 1``: ``per_bin`` of them, from
    ``offset`` on, in each sequence from ``sequence`` on."""

    length: int
    first: int
    count: int
    sequence: int
    offset: int
    per_bin: int


class _Bins:
    """Open sequences, as runs of consecutive numbers with the same room left."""

    def __init__(self, capacity: int):
        self.capacity, self.next, self.by_room, self.rooms = capacity, 0, {}, []

    def open(self, n: int) -> int:
        first, self.next = self.next, self.next + n
        return first

    def put_back(self, room: int, first: int, n: int) -> None:
        if n and room:
            if room not in self.by_room:
                insort(self.rooms, room)
            self.by_room.setdefault(room, []).append((first, n))

    def take(self, at_least: int) -> tuple[int, int, int] | None:
        """The run with the least room that is enough: (room, first, n)."""
        k = bisect_left(self.rooms, at_least)
        if k == len(self.rooms):
            return None
        room = self.rooms[k]
        first, n = self.by_room[room].pop()
        if not self.by_room[room]:
            del self.by_room[room]
            self.rooms.pop(k)
        return room, first, n


def pack_histogram(histogram: dict[int, int], capacity: int) -> list[Run]:
    """Runs that place every piece of the histogram {length: count}.

    First Martello and Toth's dominance: with a largest piece L and room R beside it,
    L is final alone if nothing fits, with a piece of exactly R (a full sequence), and
    with the largest piece that fits if no two pieces do. Each decision is taken for
    all equal pieces at once and no packing of the same pieces needs fewer sequences.
    The pieces left are packed best-fit, longest first.
    """
    left = {k: n for k, n in histogram.items() if n > 0}
    lengths, used, runs, bins = sorted(left), dict.fromkeys(left, 0), [], _Bins(capacity)

    def place(length: int, n: int, sequence: int, offset: int, per_bin: int = 1) -> None:
        runs.append(Run(length, used[length], n, sequence, offset, per_bin))
        used[length] += n
        left[length] -= n
        if not left[length]:
            lengths.remove(length)

    def pair(a: int, b: int) -> None:
        n = left[a] // 2 if a == b else min(left[a], left[b])
        first = bins.open(n)
        place(a, n, first, 0)
        place(b, n, first, a)

    for longest in sorted(left, reverse=True):
        while left[longest]:
            room = capacity - longest
            others = [x for x in lengths if x != longest or left[x] > 1]
            if not others or others[0] > room:
                place(longest, n := left[longest], bins.open(n), 0)
                continue
            if room in others:
                pair(longest, room)
                continue
            own = left[others[0]] - (others[0] == longest)
            second = others[0] if own > 1 else others[1] if len(others) > 1 else capacity
            if others[0] + second <= room:
                break  # several pieces may fit: left for best fit
            pair(longest, max(x for x in others if x <= room))
    for length in sorted(lengths, reverse=True):
        while left[length]:
            n, found = left[length], bins.take(length)
            if found is None:
                per_bin = min(capacity // length, n)
                room, first, many = capacity, bins.open(n // per_bin), n // per_bin
            else:
                room, first, many = found
                per_bin = min(room // length, n)
            full = min(many, n // per_bin)
            place(length, full * per_bin, first, capacity - room, per_bin)
            bins.put_back(room - per_bin * length, first, full)
            bins.put_back(room, first + full, many - full)
    return runs


class TextIds:
    """Ids of texts by the ids of their words.

    A byte-level tokenizer splits a text into pre-tokens first, and a single space or line
    end between two signs that are no white space always begins one (a line end always is
    one), so texts are cut there. The pre-tokens of words of ASCII signs and common Latin
    letters are known; any other word is left to the tokenizer.
    """

    #: The classes of signs, the pre-token pattern of the byte-level tokenizer over them, and all white space.
    LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
    PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[0-9]+| ?[^\s{LETTERS}0-9]+|\s+(?!\S)|\s+"
    WHITE = "\t-\r\x1c-\x20\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
    def __init__(self, path: str):
        # The pipeline's other stages share the workers, so less is remembered than could be.
        self.table = WordTable(path, self.pre_tokens, words=250_000, pieces=250_000)
        added = [t.content for t in self.table.tokenizer.get_added_tokens_decoder().values()]
        self.special = "|".join(map(re.escape, added)) or None
        # Words with white space inside need the pattern's look-ahead, the others do not.
        self.plain, self.spaced = rf"^[ \n]?[!-~{self.LETTERS}]*$", rf"^[ -~\n{self.LETTERS}]*$"
        self.within, self.find = self.PATTERN.replace(r"\s+(?!\S)|\s+", r"\s"), re.compile(self.PATTERN).findall
        self.cut = re.compile(rf"(?<=[^{self.WHITE}])(?=[ \n][^{self.WHITE}])").split
        self.uneven = rf"[{self.WHITE}][ \n]|[ \n][{self.WHITE}]|^[ \n]|[ \n]$|{MARK}"

    def pre_tokens(self, words: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        """(places of the words whose pre-tokens are known, the pre-tokens of these, number of each one's)."""
        plain, sure = (pc.match_substring_regex(words, p) for p in (self.plain, self.spaced))
        if self.special:
            special = pc.match_substring_regex(words, self.special)
            plain, sure = pc.and_not(plain, special), pc.and_not(sure, special)
        known, spaced = (np.flatnonzero(x.to_numpy(zero_copy_only=False)) for x in (plain, pc.and_not(sure, plain)))
        flat, counts = split_all(words.take(pa.array(known)), self.within)
        lists = [self.find(w) for w in words.take(pa.array(spaced)).to_pylist()]
        flat = pa.concat_arrays([flat, pa.array([p for own in lists for p in own], pa.string())])
        return np.concatenate([known, spaced]), flat, np.concatenate([counts, np.array([len(own) for own in lists], np.int64)])

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each text)."""
        marked = texts
        for sign in " \n":
            marked = pc.replace_substring(marked, sign, MARK + sign)
        # Where white space meets a space or line end, signs on both sides decide.
        uneven = np.flatnonzero(pc.match_substring_regex(texts, self.uneven).to_numpy(zero_copy_only=False)).tolist()
        words = pc.split_pattern(marked, MARK)
        if uneven:
            lists = words.to_pylist()
            for k in uneven:
                lists[k] = self.cut(texts[k].as_py())
            words = pa.array(lists, pa.list_(pa.string()))
        rows = self.table.rows(words.flatten())
        offsets = words.offsets.to_numpy()
        return self.table.ids.gather(rows), sums(self.table.ids.lengths(rows), offsets - offsets[0])


def text_ids(path: str) -> TextIds:
    """This worker's ids, kept from one task to the next."""
    kept = sys.modules.setdefault("_kept_by_worker", types.ModuleType("_kept_by_worker")).__dict__
    key = f"byte-level ids {path}"
    if key not in kept:
        kept[key] = TextIds(path)
    return kept[key]


def pieces_of(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """The pieces that ``docs`` (doc_id, text) are cut into, each with its task and its number among the task's
    pieces of the same length. Null texts are empty; every row is a document of its own."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = text_ids(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in runs(batches):
            rows = []
            ids, lengths = encoder.ids(pc.fill_null(batch.column(1), ""))
            ends = np.cumsum(lengths)
            data = memoryview(np.insert(ids.astype("<u4"), ends, end_id).tobytes())
            at = 0
            for doc_id, n in zip(batch.column(0).to_pylist(), (lengths + 1).tolist(), strict=True):
                start, stop, piece = 0, n - (n - 1) // capacity * capacity, 0
                while start < n:
                    crc = zlib.crc32(data[4 * (at + start) : 4 * (at + stop)])
                    rows.append((doc_id, piece, start, stop - start, crc, task, int(seen[stop - start])))
                    seen[stop - start] += 1
                    start, stop, piece = stop, stop + capacity, piece + 1
                at += n
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types_, strict=True)], names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"]
    types_ = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, f"{PIECES}, task int, nth long")


def place_by_runs(ranked: DataFrame, runs: list[Run]) -> DataFrame:
    """Add sequence_id and offset to pieces that carry their rank among the pieces of their length."""
    by_length: dict[int, tuple[np.ndarray, ...]] = {}
    for length in {r.length for r in runs}:
        own = sorted((r.first, r.sequence, r.offset, r.per_bin) for r in runs if r.length == length)
        by_length[length] = tuple(np.array(c, np.int64) for c in zip(*own, strict=True))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("length", "rank"))
            sequence, offset = np.empty(len(ranks), np.int64), np.empty(len(ranks), np.int64)
            for length in np.unique(lengths):
                first, bins, at, per_bin = by_length[int(length)]
                rows = np.flatnonzero(lengths == length)
                run = np.searchsorted(first, ranks[rows], "right") - 1
                nth = ranks[rows] - first[run]
                sequence[rows] = bins[run] + nth // per_bin[run]
                offset[rows] = at[run] + nth % per_bin[run] * length
            kept = [batch.column(n.split()[0]) for n in PIECES.split(", ")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names)

    names = [n.split()[0] for n in PIECES.split(", ")] + ["sequence_id", "offset"]
    return ranked.mapInArrow(place, f"{PIECES}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = 1024) -> DataFrame:
    """Pack all documents into as few sequences of ``capacity`` tokens as dominance and best fit find.

    ``docs`` has doc_id and text; other columns are ignored. A document is its ids and ``end_id``;
    a longer one is cut into pieces of ``capacity``, of which the first may be shorter. One row per
    piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Null and empty texts are one
    piece of length 1, repeated rows and null ids are documents like others, no rows give no rows.
    """
    pieces = stage(pieces_of(docs, tokenizer, end_id, capacity))
    per_task = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    # At most ``capacity`` rows.
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    ranked = pieces.join(starts, ["task", "length"]).withColumn("rank", F.col("before") + F.col("nth"))
    return place_by_runs(ranked, pack_histogram(histogram, capacity))
