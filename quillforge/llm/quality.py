"""Quality score from two compression dictionaries.

One Zstandard dictionary holds pieces of good texts, the other of bad ones. A text
that is like the good ones packs smaller with the first. The difference of the
packed sizes, per byte of text, and the packed size itself are calibrated by a
logistic regression on labelled texts that neither dictionary has seen.
"""

from __future__ import annotations

import math
import random
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillforge.session import stage


@dataclass(frozen=True)
class Fit:
    """How the classifier is fitted. ``rows_per_label`` bounds the labelled rows that are used, which are those
    with the smallest hashes of their ids; half of them fill the dictionaries, half calibrate. Scoring has no bound."""

    rows_per_label: int = 4000
    pieces_per_row: int = 2
    piece_bytes: int = 256
    dictionary_bytes: int = 1 << 17
    chunk_bytes: int = 1024
    level: int = 5


@dataclass(frozen=True)
class Classifier:
    fit: Fit
    good: bytes
    bad: bytes
    centre: np.ndarray = field(default_factory=lambda: np.zeros(3))
    scale: np.ndarray = field(default_factory=lambda: np.ones(3))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(4))

    def packers(self) -> list[zstandard.ZstdCompressor]:
        raw = zstandard.DICT_TYPE_RAWCONTENT
        # Fewer than 8 bytes are no dictionary.
        dictionaries = [zstandard.ZstdCompressionDict(d.ljust(8), dict_type=raw) for d in (self.good, self.bad)]
        for d in dictionaries:
            d.precompute_compress(level=self.fit.level)
        return [zstandard.ZstdCompressor(level=self.fit.level, dict_data=d, write_content_size=False) for d in dictionaries]

    def features(self, texts: list[str]) -> np.ndarray:
        """Per text: difference of the packed sizes, packed size, and packed size where it is small, all per byte."""
        (good, bad), step = self.packers(), self.fit.chunk_bytes
        out = np.empty((len(texts), 3))
        for k, text in enumerate(texts):
            data = text.encode("utf-8", "surrogatepass")
            # Equal chunks: a dictionary counts as much at a text's end as at its start.
            chunks = [data[i : i + step] for i in range(0, len(data), step)] or [b""]
            packed = [sum(len(p.compress(c)) for c in chunks) for p in (good, bad)]
            size = len(data) + len(chunks)
            ratio = packed[0] / size
            out[k] = (packed[0] - packed[1]) / size, ratio, min(ratio, 0.3)
        return out

    def score(self, features: np.ndarray) -> np.ndarray:
        z = self.weights[0] + (features - self.centre) / self.scale @ self.weights[1:]
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether the id's fold is kept from learning; a null id's is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def logistic(features: np.ndarray, labels: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(centre, scale, weights) by Newton's method with a small ridge; each row counts ``counts`` times."""
    centre, scale = features.mean(0), features.std(0) + 1e-9
    x = np.c_[np.ones(len(features)), (features - centre) / scale]
    w, ridge = np.zeros(x.shape[1]), 1e-2 * np.eye(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (counts * p * (1 - p))[:, None]).T @ x + ridge
        move = np.linalg.solve(hessian, x.T @ (counts * (labels - p)) - ridge @ w)
        w += move * min(1.0, 5 / (1e-12 + np.abs(move).max()))
    return centre, scale, w


def pieces(rows: DataFrame, fit: Fit) -> DataFrame:
    """Up to ``pieces_per_row`` pieces of every text, at places drawn by its id."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = (text or "").encode("utf-8", "surrogatepass")
                places = max(1, len(data) // fit.piece_bytes)
                for k in random.Random(zlib.crc32(str(doc_id).encode())).sample(range(places), min(places, fit.pieces_per_row)):
                    found.append(data[k * fit.piece_bytes : (k + 1) * fit.piece_bytes])
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["piece"])

    return rows.select("doc_id", "text").mapInArrow(cut, "piece binary")


def learn(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> Classifier:
    """Fit on the labelled documents outside the held-out fold.

    ``docs`` has doc_id and text, ``labels`` doc_id and quality (1 good, 0 bad, others ignored). What
    reaches the driver is bounded by ``fit``: ids and labels, dictionary pieces, and three numbers a row.
    Null ids and texts are not learnt from, nor other columns; repeated rows count once a row; of texts of any length
    pieces are taken; without labels of both kinds the scores say nothing.
    """
    known = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int")).where("quality in (0, 1) and doc_id is not null")
    known = known.where(~held_out(F.col("doc_id"))).distinct()
    total = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    by_hash = F.xxhash64("doc_id")
    sample = None
    for quality in (0, 1):
        own = known.where(F.col("quality") == quality).orderBy(by_hash, "doc_id").limit(fit.rows_per_label)
        sample = own if sample is None else sample.unionByName(own)
    # At most 2 * rows_per_label narrow rows.
    texts = stage(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(F.broadcast(sample), "doc_id"))
    for_dictionary = F.xxhash64("doc_id", F.lit(1)) % 2 == 0
    first = texts.where(for_dictionary)
    dictionaries = []
    for quality in (1, 0):
        found = sorted(bytes(r["piece"]) for r in pieces(first.where(F.col("quality") == quality), fit).collect())
        random.Random(0).shuffle(found)
        dictionaries.append(b"".join(found)[: fit.dictionary_bytes])
    base = Classifier(fit, *dictionaries)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = base.features([t or "" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c) for c in x.T)], ["quality", "a", "b", "c"])

    rows = texts.where(~for_dictionary).select("quality", "text").mapInArrow(measure, "quality int, a double, b double, c double").collect()
    y = np.array([r[0] for r in rows], float)
    if len(set(y.tolist())) < 2:
        # One label or none: the score is how often label 1 occurs, by the rule of succession.
        share = (total.get(1, 0) + 1) / (sum(total.values()) + 2)
        return Classifier(fit, *dictionaries, weights=np.array([math.log(share / (1 - share)), 0, 0, 0]))
    x = np.array([list(r)[1:] for r in rows])
    # Each label counts as often as it occurs among all labelled rows.
    counts = np.where(y == 1, total[1] / y.sum(), total[0] / (len(y) - y.sum()))
    order = np.lexsort((*x.T, y))
    return Classifier(fit, *dictionaries, *logistic(x[order], y[order], (counts * len(y) / sum(total.values()))[order]))


def score_quality(docs: DataFrame, classifier: Classifier, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``; text is all that is looked at.

    Null and empty texts get the score of a text without bytes, repeated rows equal scores. Texts of any length are
    read whole; other columns are ignored; a null id is in no fold; no rows give no rows.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = classifier.score(classifier.features([t or "" for t in batch.column(2).to_pylist()]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score), pa.array((score >= threshold).astype("i4"))], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string"))
    return rows.mapInArrow(judge, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, classifier: Classifier, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score reaches the threshold.

    Null and empty texts are judged as a text without bytes, repeated rows alike, texts of any length whole, ids not at all.
    """

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            yield batch.filter(pa.array(classifier.score(classifier.features([t or "" for t in texts])) >= threshold))

    return docs.mapInArrow(keep, docs.schema)
