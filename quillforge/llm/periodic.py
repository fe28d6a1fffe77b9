"""Periodic runs of words in documents, by grammar extensions of the points of harmonic grids.

A run of period q and of at least e periods repeats itself q words on over at least
(e - 1) q places, so one of every (e - 1) q places lies among them. These are the grid of
q; the grids of all periods together have about n log(n) / (e - 1) points. A point whose
word equals that q words on is a candidate, and the longest common extensions of both,
forward and back, give the stretch that has the period. The texts of a batch share one
grammar, with a separator of its own between any two, so that its levels and all queries
are few steps over long arrays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillforge.llm.recompression import Grammar

#: Words of texts that share a grammar (one more text may be added), and grid points and candidates that are looked at together.
TOGETHER, AT_ONCE = 1 << 18, 1 << 21
RUN = np.dtype([("text", "i8"), ("start", "i8"), ("length", "i8"), ("period", "i8")])


def grid(n: int, least: int, exponent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) such that every run of at least ``least`` words and ``exponent`` periods in n words has a place that repeats a period on."""
    first = 1
    while first <= n // exponent:
        # As many periods at once as make a bounded number of points.
        periods = np.arange(first, n // exponent + 1)
        step = np.maximum(least, exponent * periods) - periods
        points = np.maximum(-(-(n - periods) // step), 0)
        many = max(1, int(np.searchsorted(np.cumsum(points), AT_ONCE, "right")))
        periods, step, points = periods[:many], step[:many], points[:many]
        nth = np.arange(points.sum()) - np.repeat(np.cumsum(points) - points, points)
        yield nth * np.repeat(step, points), np.repeat(periods, points)
        first += many


def runs_of(texts: list[np.ndarray], least: int = 6, exponent: int = 4) -> np.ndarray:
    """The runs of sequences of numbers: text (its place in the list), start, length, period, by text, start and period.

    A run is a stretch of smallest period q, of at least ``least`` and ``exponent`` q numbers, that is as long as it can be.
    """
    if not sum(map(len, texts)):
        return np.zeros(0, RUN)
    highest = max(int(t.max(initial=0)) for t in texts) + 1
    parts, begins, at = [np.array([highest])], [], 1
    for k, text in enumerate(texts):
        begins.append(at)
        parts += [text, np.array([highest + 1 + k])]
        at += len(text) + 1
    words = np.concatenate(parts).astype(np.int64)
    found, held, n_held = [np.zeros(0, RUN)], [], 0
    grammar: Grammar | None = None

    def extend() -> None:
        nonlocal grammar, held, n_held
        if n_held:
            grammar = grammar or Grammar(words, len(texts) + 1)
            text, place, period = (np.concatenate(x) for x in zip(*held, strict=True))
            back = grammar.backward(place, place + period)
            length = back + grammar.forward(place, place + period) + period
            own = length >= np.maximum(least, exponent * period)
            runs = np.zeros(int(own.sum()), RUN)
            runs["text"], runs["start"], runs["length"], runs["period"] = text[own], (place - back)[own], length[own], period[own]
            found.append(np.unique(runs))
        held, n_held = [], 0

    for k, (text, begin) in enumerate(zip(texts, begins, strict=True)):
        for place, period in grid(len(text), least, exponent):
            place = place + begin
            equal = words[place] == words[place + period]
            if equal.any():
                held.append((np.full(int(equal.sum()), k), place[equal], period[equal]))
                n_held += len(held[-1][0])
                if n_held >= AT_ONCE:
                    extend()
    extend()
    runs = np.unique(np.concatenate(found))
    # A stretch that has several periods has the least one, of which the others are multiples.
    first = np.ones(len(runs), bool)
    first[1:] = (runs["text"][1:] != runs["text"][:-1]) | (runs["start"][1:] != runs["start"][:-1]) | (runs["length"][1:] != runs["length"][:-1])
    runs = runs[first]
    runs["start"] -= np.array(begins)[runs["text"]]
    return runs[np.lexsort((runs["period"], runs["start"], runs["text"]))]


def as_is(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    return words


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words with a periodic end where the checksum of the id says so; a null id has none."""
    h = 1 if doc_id is None else crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def numbered(texts: list[list[bytes]]) -> list[np.ndarray]:
    """The words of some texts as numbers, equal ones for equal words."""
    names: dict[bytes, int] = {}
    return [np.array([names.setdefault(w, len(names)) for w in words], np.int64) for words in texts]


def strongest(runs: np.ndarray) -> tuple[int, ...] | None:
    """start, length, period, and thousandths of the exponent, of the run with the greatest; ties to the smallest start, then period."""
    best = None
    for start, length, period in zip(*(runs[f].tolist() for f in ("start", "length", "period")), strict=True):
        if best is None or length * best[2] > best[1] * period:
            best = (start, length, period)
    return best and (*best, 1000 * best[1] // best[2])


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words outside of runs, and the first period of each run, joined by one space. What another run holds after its first period goes as well."""
    if not len(runs):
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs["start"] + runs["period"], 1)
    np.add.at(edge, runs["start"] + runs["length"], -1)
    return b" ".join([words[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0)])


def detect(docs: DataFrame, least: int = 6, exponent: int = 4, prepare: Callable[[int | None, list[bytes]], list[bytes]] = as_is, with_runs: bool = False) -> DataFrame:
    """Periodic runs of the words of ``docs`` (doc_id, text; other columns are ignored), a row per row, without any shuffle.

    Words are runs of bytes other than space and 9 to 13, as ``prepare`` leaves them. Columns: doc_id, n_runs; start, length,
    period and exponent_milli of the run with the greatest exponent (ties: least start, then period); runs_sha256 over
    `start,length,period` lines; collapsed_sha256 over the words that are left when of each run all but the first period goes.
    ``with_runs`` adds both in full: runs, an array of structs, and collapsed, the text. Null, empty and blank texts have no
    words and no runs, nulls in the four columns of the run; repeated rows and null ids are documents like others. A text of any length is taken whole.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int | None, list[bytes]]] = []
        size = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                words = prepare(doc_id, (text or b"").split())
                held.append((doc_id, words))
                size += len(words)
                if size >= TOGETHER:
                    yield rows(held)
                    held, size = [], 0
        yield rows(held)

    def rows(held: list[tuple[int | None, list[bytes]]]) -> pa.RecordBatch:
        runs = runs_of(numbered([words for _, words in held]), least, exponent)
        bounds = np.searchsorted(runs["text"], np.arange(len(held) + 1))
        out: list[tuple] = []
        for k, (doc_id, words) in enumerate(held):
            own = runs[bounds[k] : bounds[k + 1]]
            listed = list(zip(*(own[f].tolist() for f in ("start", "length", "period")), strict=True))
            lines = "".join(f"{s},{n},{q}\n" for s, n, q in listed)
            left = collapsed(words, own)
            row = (doc_id, len(own), *(strongest(own) or [None] * 4), hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left).hexdigest())
            named = [dict(zip(("start", "length", "period"), x, strict=True)) for x in listed]
            out.append((*row, named, left) if with_runs else row)
        columns = zip(*out, strict=True) if out else [[]] * len(schema)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    longs, texts = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli"], ["runs_sha256", "collapsed_sha256"]
    schema = pa.schema([*((n, pa.int64()) for n in longs), *((n, pa.string()) for n in texts)])
    declared = ", ".join([f"{n} long" for n in longs] + [f"{n} string" for n in texts])
    if with_runs:
        schema = schema.append(pa.field("runs", pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])))).append(pa.field("collapsed", pa.binary()))
        declared += ", runs array<struct<start: long, length: long, period: long>>, collapsed binary"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(read, declared)
