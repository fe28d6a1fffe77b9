"""Repeated passages of documents, by suffix automata of reference shards.

Documents are references to each other, and one automaton of them all would have to
be met by every document. The shards are therefore cut by content. Every window of
words has a least shingle, its anchor, and equal windows have equal anchors: windows
of one anchor form a shard. Consecutive windows with one anchor are a unit; equal
units settle by the smallest document that has them, and only different units of one
anchor need comparing. There each unit is streamed, in the order of documents,
through the automaton of those before it; where its matching statistics reach the
window's length, the window occurs earlier. An anchor with very many different units
(a frequent phrase in ever new company) is cut into finer shards by further content
anchors, the several least shingles of a window; equal units settle again, and so on.
At last a shard is one window, which has nothing left to compare.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillforge.llm.wordhash import BASE, mix, powers, run_hashes, word_hashes, word_spans
from quillforge.operators.bloom import divided, key_filter, possible, unused
from quillforge.session import stage

#: Words of an anchor.
ANCHOR = 8
#: An anchor with more units, or a unit of more words, is cut into finer shards.
SHARD_UNITS, UNIT_WORDS = 1000, 2048
#: How many least shingles make the anchors, step by step; then whole windows do.
DEPTHS = (1, 4, 16)
#: Windows whose shingles are sorted at once.
AT_ONCE = 4096


def sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    """The least of every ``n`` consecutive values."""
    have = 1
    while 2 * have <= n:
        x, have = np.minimum(x[:-have], x[have:]), 2 * have
    return x if have == n else np.minimum(x[: len(x) - (n - have)], x[n - have :])


def runs_of(anchors: np.ndarray, words: np.ndarray, window: int, at: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, windows, hash of the words) of the runs of equal anchors, of the windows from ``at`` on."""
    if not len(anchors):
        return (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))
    first = np.concatenate([[0], np.flatnonzero(anchors[1:] != anchors[:-1]) + 1])
    n = np.diff(np.append(first, len(anchors)))
    own, first = anchors[first], first + at
    up, down = powers(len(words) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * up[: len(words)])])
    return own, first, n, mix((sums[first + n - 1 + window] - sums[first]) * down[first] + n.astype(np.uint64))


def units(words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, windows, hash of the words) of every run of windows with one anchor."""
    if len(words) < window:
        return runs_of(np.zeros(0, np.uint64), words, window)
    k = min(ANCHOR, window)
    return runs_of(sliding_min(run_hashes(words, k), window - k + 1), words, window)


def finer_units(words: np.ndarray, window: int, start: int, n: int, depth: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The unit of ``n`` windows from ``start`` on cut by anchors of ``depth`` least shingles, or by whole windows, which are units each."""
    k = min(ANCHOR, window)
    if depth is None or depth > window - k:
        own, first, size, _ = runs_of(run_hashes(words[start : start + n - 1 + window], window), words, window, start)
        return own, first, size, own
    shingles = np.lib.stride_tricks.sliding_window_view(run_hashes(words[start : start + n - 1 + window], k), window - k + 1)
    anchors = np.zeros(n, np.uint64)
    for at in range(0, n, AT_ONCE):
        least = np.sort(np.partition(shingles[at : at + AT_ONCE], depth - 1, axis=1)[:, :depth], axis=1)
        for column in least.T:
            anchors[at : at + AT_ONCE] = mix(anchors[at : at + AT_ONCE] * BASE + column)
    return runs_of(anchors, words, window, start)


def encoded(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


class SuffixAutomaton:
    """Of several sequences of numbers; ``add`` appends one."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _copy(self, q: int, length: int) -> int:
        self.next.append(self.next[q].copy())
        self.link.append(self.link[q])
        self.length.append(length)
        return len(self.next) - 1

    def _redirect(self, p: int, c: int, q: int, to: int) -> None:
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = to
            p = self.link[p]

    def add(self, sequence: list[int]) -> None:
        nexts, link, length = self.next, self.link, self.length
        last = 0
        for c in sequence:
            q = nexts[last].get(c)
            if q is not None:  # another sequence has come this way
                if length[q] != length[last] + 1:
                    clone = self._copy(q, length[last] + 1)
                    link[q] = clone
                    self._redirect(last, c, q, clone)
                    q = clone
                last = q
                continue
            nexts.append({})
            link.append(0)
            length.append(length[last] + 1)
            new, p = len(nexts) - 1, last
            while p >= 0 and c not in nexts[p]:
                nexts[p][c] = new
                p = link[p]
            if p >= 0:
                q = nexts[p][c]
                if length[q] == length[p] + 1:
                    link[new] = q
                else:
                    clone = self._copy(q, length[p] + 1)
                    self._redirect(p, c, q, clone)
                    link[q] = link[new] = clone
            last = new

    def matches(self, sequence: list[int], least: int) -> list[int]:
        """Starts of the runs of ``least`` numbers that occur in what was added."""
        nexts, link, length = self.next, self.link, self.length
        state = matched = 0
        found = []
        for end, c in enumerate(sequence, 1):
            while state and c not in nexts[state]:
                state = link[state]
                matched = length[state]
            state = nexts[state].get(c, 0)
            matched = matched + 1 if state else 0
            if matched >= least:
                found.append(end - least)
        return found


def ranges(starts: list[int]) -> Iterator[tuple[int, int]]:
    """(first, number) of the runs of consecutive numbers."""
    first = None
    for k, s in enumerate(starts):
        if first is None:
            first = s
        if k + 1 == len(starts) or starts[k + 1] != s + 1:
            yield first, s + 1 - first
            first = None


def list_units(docs: DataFrame, window: int) -> DataFrame:
    """doc_id, text_hash, anchor, start, n, unit of every unit of every row."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 64):
                part = batch.slice(at, 64)
                found = [units(word_hashes(encoded(t)), window) for t in part.column(2).to_pylist()]
                anchor, start, n, unit = (np.concatenate(c) for c in zip(*found, strict=True))
                row = pa.array(np.repeat(np.arange(len(found)), [len(f[0]) for f in found]))
                columns = [part.column(0).take(row), part.column(1).take(row), pa.array(anchor.view(np.int64)), pa.array(start, pa.int32()), pa.array(n, pa.int32()), pa.array(unit.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "anchor", "start", "n", "unit"])

    return keyed(docs).mapInArrow(read, "doc_id long, text_hash long, anchor long, start int, n int, unit long")


def keyed(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def unit_words(docs: DataFrame, wanted: DataFrame, window: int, depth: int | None) -> DataFrame:
    """The wanted units (doc_id, text_hash, and per document a list of anchor, start, n, finer) with their words, or cut into finer ones."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text_hash, text, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = word_hashes(encoded(text))
                short = words.astype("<u4")
                for u in own:
                    start, n = u["start"], u["n"]
                    if u["finer"]:
                        parts = zip(*(x.view(np.int64).tolist() for x in finer_units(words, window, start, n, depth)), strict=True)
                        rows += ((doc_id, text_hash, *part, None) for part in parts)
                    else:
                        rows.append((doc_id, text_hash, u["anchor"], start, n, None, short[start : start + n - 1 + window].tobytes()))
            columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    schema = pa.schema({"doc_id": pa.int64(), "text_hash": pa.int64(), "anchor": pa.int64(), "start": pa.int32(), "n": pa.int32(), "unit": pa.int64(), "words": pa.binary()})
    # Only texts that have wanted units are shuffled.
    texts = possible(keyed(docs), key_filter(wanted, "doc_id", "text_hash"), "doc_id", "text_hash")
    joined = texts.join(wanted, ["doc_id", "text_hash"]).select("doc_id", "text_hash", "text", "own")
    return joined.mapInArrow(read, "doc_id long, text_hash long, anchor long, start int, n int, unit long, words binary")


def streamed(shards: DataFrame, window: int) -> DataFrame:
    """doc_id, text_hash, start, n of windows that an earlier document of their shard has, rows being sorted by anchor and document."""

    def settle(shard: list[tuple]) -> Iterator[tuple]:
        automaton, at = SuffixAutomaton(), 0
        while at < len(shard):
            end = at
            while end < len(shard) and shard[end][0] == shard[at][0]:
                end += 1
            own = [np.frombuffer(x[3], "<u4").tolist() for x in shard[at:end]]
            for (doc_id, text_hash, start, _), words in zip(shard[at:end], own, strict=True):
                for first, n in ranges(automaton.matches(words, window)) if at else ():
                    yield doc_id, text_hash, start + first, n
            for words in own if end < len(shard) else ():
                automaton.add(words)
            at = end

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, anchor = [], None
        for batch in batches:
            out: list[tuple] = []
            for own, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != anchor and held:
                    out += settle(held)
                    held = []
                anchor = own
                held.append(tuple(row))
            yield table(out)
        yield table(list(settle(held)))

    def table(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["doc_id", "text_hash", "start", "n"])

    return shards.select("anchor", "doc_id", "text_hash", "start", "words").mapInArrow(read, "doc_id long, text_hash long, start int, n int")


def settled(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of units (doc_id, text_hash, anchor, start, n, unit): those that an equal one of a smaller document settles, and, where an
    anchor has different units, each in its first document, with the number of units."""
    of_unit = found.groupBy("anchor", "unit").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    shared = of_unit.groupBy("anchor").agg(F.count("*").alias("units"), F.min("first").alias("first"), F.max("last").alias("last"))
    shared = stage(shared.where("first < last").select("anchor", "units"))
    rows = stage(found.join(shared, "anchor").where("doc_id is not null"))
    rows = stage(rows.join(rows.groupBy("anchor", "unit").agg(F.min("doc_id").alias("first")), ["anchor", "unit"]))
    return rows.where("doc_id > first").select("doc_id", "text_hash", "start", "n"), rows.where("units > 1 and doc_id = first")


def repeated_windows(docs: DataFrame, window: int) -> DataFrame:
    """doc_id, text_hash, start, n: runs of windows whose words a document with a smaller id has too."""
    found, out = stage(list_units(docs, window)), []
    for depth in (*DEPTHS[1:], None, None):
        whole, sole = settled(found)
        out.append(whole)
        # Long units and the rest of their anchor must meet, so either way is taken by the whole anchor.
        long_units = sole.where(F.col("n") > UNIT_WORDS).select("anchor").distinct().withColumn("long", F.lit(True))
        sole = sole.join(long_units, "anchor", "left").withColumn("finer", (F.col("units") > SHARD_UNITS) | F.coalesce("long", F.lit(False)))
        wanted = stage(sole.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("anchor", "start", "n", "finer")).alias("own")))
        compared = stage(unit_words(docs, wanted, window, depth).dropDuplicates(["anchor", "doc_id", "text_hash", "start"]))
        shards = compared.where("words is not null").repartition("anchor").sortWithinPartitions("anchor", "doc_id")
        out.append(streamed(shards, window))
        found = compared.where("words is null").drop("words")
        if found.isEmpty():
            break
    return reduce(DataFrame.unionByName, out)


def kept_words(text: str | None, own: list[dict] | None, window: int) -> tuple[int, int, bytes]:
    """(words, removed, kept words joined by one space)."""
    words = encoded(text).split()
    if not own:
        return len(words), 0, b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for r in own:
        edge[r["start"]] += 1
        edge[r["start"] + r["n"] - 1 + window] -= 1
    keep = np.cumsum(edge[:-1]) == 0
    return len(words), int(len(words) - keep.sum()), b" ".join([words[k] for k in np.flatnonzero(keep)])


def with_ranges(docs: DataFrame, window: int) -> tuple[DataFrame, str]:
    """``docs`` with one more column, and its name: the runs of repeated windows of each row.

    Rows that a filter of the documents with repeated windows excludes have none and take no part in the join.
    """
    removed = stage(repeated_windows(docs, window)).groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("start", "n")).alias("own"))
    removed = stage(removed)
    key = F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string"))
    maybe, rest = divided(docs, key_filter(removed, "doc_id", "text_hash"), *key)
    names = [unused(n, docs) for n in ("_id", "_hash", "_own")]
    found = removed.select(*(F.col(c).alias(n) for c, n in zip(removed.columns, names, strict=True)))
    joined = maybe.join(found, [k == F.col(n) for k, n in zip(key, names, strict=False)], "left").drop(*names[:2])
    if rest is not None:
        joined = joined.unionByName(rest.withColumn(names[2], F.lit(None).cast(removed.schema["own"].dataType)))
    return joined, names[2]


def deduplicated(docs: DataFrame, window: int = 50) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row of ``docs`` (doc_id, text; other columns are ignored).

    Words are runs of bytes other than space and 9 to 13. A word goes if a window of ``window`` words that covers
    it also starts in a document with a smaller id, as the input stands. Null and empty texts have no words; a row
    without an id is never a reference and loses nothing; rows with equal ids are no references to each other.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [kept_words(t, o, window) for t, o in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            sha = [hashlib.sha256(r[2]).hexdigest() for r in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array(sha, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    rows, own = with_ranges(docs.select("doc_id", "text"), window)
    return rows.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), own).mapInArrow(read, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def without_passages(docs: DataFrame, window: int = 50) -> DataFrame:
    """``docs``, with all its columns, the repeated passages cut out of text and n_chars set anew where something was cut.

    What lies between kept words stays as it is; a space is where a passage was. Documents that lose every word go.
    Null and empty texts, and rows without an id, stay as they are; rows of one id are no references to each other; texts may be of any length.
    """

    def cut(text: str, own: list[dict]) -> str | None:
        data = encoded(text)
        first, last = word_spans(data)
        edge = np.zeros(len(first) + 1, np.int64)
        for r in own:
            edge[r["start"]] += 1
            edge[r["start"] + r["n"] - 1 + window] -= 1
        keep = np.concatenate([[False], np.cumsum(edge[:-1]) == 0, [False]])
        begins, ends = (np.flatnonzero(x) for x in (keep[1:-1] & ~keep[:-2], keep[1:-1] & ~keep[2:]))
        parts = [data[first[a] : last[b]] for a, b in zip(begins, ends, strict=True)]
        return b" ".join(parts).decode("utf-8", "surrogatepass") if parts else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(batch.schema.get_field_index(name)).to_pylist()
            place = batch.schema.get_field_index("text")
            texts = batch.column(place).to_pylist()
            new = [cut(t, o) if o else t for t, o in zip(texts, own, strict=True)]
            columns = {n: batch.column(n) for n in batch.schema.names if n != name}
            columns["text"] = pa.array(new, batch.schema.field(place).type)
            if "n_chars" in columns:
                counts = [len(t) if o and t is not None else n for t, o, n in zip(new, own, columns["n_chars"].to_pylist(), strict=True)]
                columns["n_chars"] = pa.array(counts, batch.schema.field("n_chars").type)
            gone = pa.array([o is not None and t is None for t, o in zip(new, own, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns)).filter(pc.invert(gone))

    rows, name = with_ranges(docs, window)
    return rows.mapInArrow(read, docs.schema)
