"""Scores of texts by masked pseudo-likelihood.

A small network sees the words on both sides of a place, not the word itself, and
gives a probability to every output: a common word, or a bucket of all words with one
hash. A word's share of its bucket is that of its count over the whole corpus, which
stays a table: frequent words are looked up, the texts' rare ones joined to it. The score of a text is the sum of the
logarithms of what its words get. The network is trained with numpy on every place of
every document, each task on its own part from common parameters, which are then averaged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillforge.llm.wordhash import mix, texts_word_hashes, word_hashes  # noqa: F401 (the tests take word_hashes from here)
from quillforge.llm.wordtable import runs
from quillforge.session import stage

#: Places scored at once.
AT_ONCE = 4096
#: Words that are at least one in so many are looked up by the tasks themselves; all others are joined to the table.
FREQUENT = 1 << 20
#: The exponentials of logits below this, and their sums, are finite and not 0 as single-precision numbers.
SAFE = 60.0


@dataclass(frozen=True)
class Shape:
    """``common`` words have outputs of their own, all others share ``shared`` by hash; outputs are in classes of
    ``slots``. Each of the ``rounds`` trains on its part of the places of each document, all together on every place once.
    ``smoothing`` is added to the count of every word of a bucket, and to one more that stands for all words not seen."""

    common: int = 1024
    shared: int = 1024
    slots: int = 32
    sides: int = 3
    width: int = 24
    rounds: int = 2
    batch: int = 4096
    rate: float = 0.1
    smoothing: float = 0.5

    @property
    def outputs(self) -> int:
        return self.common + self.shared

    @property
    def classes(self) -> int:
        return self.outputs // self.slots

    @property
    def offsets(self) -> list[int]:
        return [k for k in range(-self.sides, self.sides + 1) if k]


class Network:
    """Parameters, one array each; ``names`` fixes their order."""

    names = ("embed", "place", "bias", "to_class", "class_bias", "to_slot", "slot_bias")

    def __init__(self, shape: Shape, parts: list[np.ndarray] | None = None):
        self.shape = shape
        if parts is None:
            r, w = np.random.default_rng(0), shape.width
            sizes = [(shape.outputs + 1, w), (2 * shape.sides, w), (w,), (shape.classes, w), (shape.classes,), (shape.outputs, w), (shape.outputs,)]
            parts = [r.normal(0, 0.1, s).astype(np.float32) if len(s) > 1 else np.zeros(s, np.float32) for s in sizes]
            parts[1] += 1
        self.parts = dict(zip(self.names, parts, strict=True))

    def flat(self) -> np.ndarray:
        return np.concatenate([self.parts[n].ravel() for n in self.names])

    def filled(self, flat: np.ndarray) -> Network:
        cuts = np.cumsum([self.parts[n].size for n in self.names])[:-1]
        return Network(self.shape, [p.reshape(self.parts[n].shape) for n, p in zip(self.names, np.split(flat.astype(np.float32), cuts), strict=True)])

    def along(self, around: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(a line of outputs, places in it) in which every target has its own neighbours."""
        sides = self.shape.sides
        line = np.c_[around[:, :sides], target, around[:, sides:]]
        return line.ravel(), np.arange(len(target)) * line.shape[1] + sides

    def log_probability(self, around: np.ndarray, target: np.ndarray) -> np.ndarray:
        return self.log_probability_along(*self.along(around, target))

    def gradient(self, around: np.ndarray, target: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean negative log-probability."""
        return self.gradient_along(*self.along(around, target))

    def hidden(self, line: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the embeddings along the line, what is hidden at the places with a row of ones below); words are columns."""
        p, sides, width = self.parts, self.shape.sides, self.shape.width
        seen = p["embed"].T.take(line, axis=1)
        total = np.zeros((width, len(line) - 2 * sides), seen.dtype)
        part = np.empty_like(total)
        for place, near in zip(p["place"], self.near(seen), strict=True):
            total += np.multiply(near, place[:, None], out=part)
        h = np.ones((width + 1, len(places)), seen.dtype)
        np.tanh(total.take(places - sides, axis=1) + p["bias"][:, None], out=h[:width])
        return seen, h

    def near(self, along: np.ndarray) -> list[np.ndarray]:
        """What stands at each offset from the inner places of the line."""
        sides = self.shape.sides
        return [along[:, sides + k : along.shape[1] - sides + k] for k in self.shape.offsets]

    def logits(self, h: np.ndarray, runs: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
        """Of the classes, and of the slots of the places' own classes, which stand in ``runs`` of columns."""
        p, shape = self.parts, self.shape
        to_class, to_slot = np.c_[p["to_class"], p["class_bias"]], np.c_[p["to_slot"], p["slot_bias"]]
        classes, slots = to_class @ h, np.empty((shape.slots, h.shape[1]), h.dtype)
        for c, start, end in runs:
            np.matmul(to_slot[c * shape.slots : (c + 1) * shape.slots], h[:, start:end], out=slots[:, start:end])
        for logits, weights in ((classes, to_class), (slots, to_slot)):
            if not np.abs(weights).sum(1).max() < SAFE:
                logits -= logits.max(0)
        return classes, slots

    def by_class(self, line: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
        """(order of the places by class, their classes and slots in that order, class, first and last column of each run)."""
        target = line[places]
        order = np.argsort((target // self.shape.slots).astype(np.min_scalar_type(self.shape.classes)), kind="stable")
        cls, slot = np.divmod(target[order], self.shape.slots)
        bounds = np.searchsorted(cls, np.arange(self.shape.classes + 1)).tolist()
        return order, cls, slot, [(c, *x) for c, x in enumerate(zip(bounds, bounds[1:], strict=False)) if x[0] < x[1]]

    def log_probability_along(self, line: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Of what stands at the places of the line, each by its neighbours."""
        order, cls, slot, runs = self.by_class(line, places)
        column, out = np.arange(len(places)), np.zeros(len(places))
        for logits, own in zip(self.logits(self.hidden(line, places[order])[1], runs), (cls, slot), strict=True):
            picked = logits[own, column]
            out[order] += picked - np.log(np.ones(len(logits), logits.dtype) @ np.exp(logits, out=logits))
        return out

    def gradient_along(self, line: np.ndarray, places: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean negative log-probability of what stands at the places of the line."""
        p, shape, n = self.parts, self.shape, len(places)
        order, cls, slot, runs = self.by_class(line, places)
        places, column = places[order], np.arange(n)
        seen, h = self.hidden(line, places)
        errors = self.logits(h, runs)
        for d, own in zip(errors, (cls, slot), strict=True):
            np.exp(d, out=d)
            d *= 1 / (n * (np.ones(len(d), d.dtype) @ d))
            d[own, column] -= 1 / n
        of_class, of_slot = errors[0] @ h.T, np.zeros((shape.outputs, len(h)), h.dtype)
        back, to_slot = p["to_class"].T @ errors[0], p["to_slot"]
        for c, start, end in runs:
            rows, d = slice(c * shape.slots, (c + 1) * shape.slots), errors[1][:, start:end]
            np.matmul(d, h[:, start:end].T, out=of_slot[rows])
            back[:, start:end] += to_slot[rows].T @ d
        back *= 1 - h[:-1] * h[:-1]
        spread = np.zeros((shape.width, len(line) - 2 * shape.sides), h.dtype)
        for own, values in zip(spread, back, strict=True):
            own[places - shape.sides] = values
        into, part, of_place = np.zeros_like(seen), np.empty_like(spread), []
        for place, near, words in zip(p["place"], self.near(into), self.near(seen), strict=True):
            of_place.append(np.einsum("ij,ij->i", words, spread))
            near += np.multiply(spread, place[:, None], out=part)
        of_embed = np.array([np.bincount(line, weights=x, minlength=shape.outputs + 1) for x in into], h.dtype).T
        found = (of_embed, np.array(of_place), back.sum(1), of_class[:, :-1], of_class[:, -1], of_slot[:, :-1], of_slot[:, -1])
        return {k: np.ascontiguousarray(g) for k, g in zip(self.names, found, strict=True)}


@dataclass(frozen=True)
class Model:
    """Sorted hashes of the common words with their outputs, and the network; of every bucket the logarithm of its
    smoothed count, the table (word, n) of all words, and the hashes and counts of the frequent ones, at most ``FREQUENT``."""

    hashes: np.ndarray
    outputs: np.ndarray
    network: Network
    buckets: np.ndarray | None = None
    words: DataFrame | None = None
    frequent: tuple[np.ndarray, np.ndarray] | None = None

    def ids(self, words: np.ndarray) -> np.ndarray:
        shape = self.network.shape
        out = (shape.common + (mix(words) % np.uint64(shape.shared)).astype(np.int64)).astype(np.int64)
        at = _index(words, self.hashes)
        out[at >= 0] = self.outputs[at[at >= 0]]
        return out

    def line(self, ids: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(``ids`` of texts of ``n`` words each with an edge between texts, places of the words in it)."""
        shape = self.network.shape
        line = np.full(len(ids) + shape.sides * (len(n) + 1), shape.outputs)
        places = np.arange(len(ids)) + shape.sides * np.repeat(np.arange(1, len(n) + 1), n)
        line[places] = ids
        return line, places


def _index(words: np.ndarray, among: np.ndarray) -> np.ndarray:
    """The place of each word in ``among``, -1 if it is not there."""
    return pc.index_in(pa.array(words), value_set=pa.array(among)).fill_null(-1).to_numpy()


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the words of all texts, words of each); a null text has none."""
    return texts_word_hashes([t or b"" for t in texts.cast(pa.binary()).to_pylist()])


def count_words(docs: DataFrame) -> DataFrame:
    """word (its hash), n over all documents, summed over some million words before the shuffle."""

    def summed(found: list[np.ndarray]) -> pa.RecordBatch:
        word, n = np.unique(np.concatenate(found), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n)], ["word", "n"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in runs(batches, 0):
            held.append(_words(batch.column(0))[0])
            if sum(map(len, held)) >= 1 << 21:
                yield summed(held)
                held = []
        if held:
            yield summed(held)

    return docs.select(F.col("text").cast("string")).mapInArrow(read, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def train_round(docs: DataFrame, model: Model, number: int, piece: int = 4096) -> Network:
    """The average of what every task makes of the parameters on its own documents, weighted by places."""
    shape = model.network.shape

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = model.network.filled(model.network.flat())
        squares = {k: np.full_like(v, 1e-6) for k, v in network.parts.items()}
        line, places, seen = np.zeros(0, np.int64), np.zeros(0, np.int64), 0

        def step(own: np.ndarray) -> None:
            start = own[0] - shape.sides
            for k, g in network.gradient_along(line[start : own[-1] + shape.sides + 1], own - start).items():
                squares[k] += g * g
                network.parts[k] -= shape.rate * g / np.sqrt(squares[k])

        for batch in runs(batches, 0):
            words, n = _words(batch.column(0))
            added, at = model.line(model.ids(words), n)
            within, salt = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n), batch.column(1).to_numpy(zero_copy_only=False)
            at = at[(within + np.repeat(salt, n) + number) % shape.rounds == 0]
            places, line = np.concatenate([places, at + len(line)]), np.concatenate([line, added])
            whole = len(places) // shape.batch * shape.batch
            for k in range(0, whole, shape.batch):
                step(places[k : k + shape.batch])
            seen += whole
            rest = places[whole] - shape.sides if whole < len(places) else len(line)
            line, places = line[rest:], places[whole:] - rest
        if len(places):
            step(places)
            seen += len(places)
        flat = network.flat().astype(np.float64) * seen
        for k in range(0, len(flat) if seen else 0, piece):
            yield pa.RecordBatch.from_pydict({"piece": [k // piece], "seen": [seen], "sums": [flat[k : k + piece].tobytes()]}, schema=schema)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        seen: dict[int, int] = {}
        for batch in batches:
            for k, n, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sums[k] = sums.get(k, 0) + np.frombuffer(own)
                seen[k] = seen.get(k, 0) + n
        yield pa.RecordBatch.from_pydict({"piece": list(sums), "seen": list(seen.values()), "sums": [s.tobytes() for s in sums.values()]}, schema=schema)

    schema = pa.schema({"piece": pa.int32(), "seen": pa.int64(), "sums": pa.binary()})
    kinds = "piece int, seen long, sums binary"
    text = F.col("text").cast("string")
    rows = docs.select(text.alias("text"), F.pmod(F.xxhash64(text), F.lit(shape.rounds)).alias("salt"))
    # As many rows as the network has pieces, at any size of the corpus.
    pieces = sorted(rows.mapInArrow(train, kinds).repartition("piece").mapInArrow(total, kinds).collect())
    if not pieces:
        return model.network
    return model.network.filled(np.concatenate([np.frombuffer(bytes(p["sums"])) / p["seen"] for p in pieces]))


def count_buckets(words: DataFrame, model: Model) -> np.ndarray:
    """The logarithm of the smoothed count of every bucket."""
    shape = model.network.shape

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = model.ids(batch.column(0).to_numpy().view(np.uint64)) - shape.common
            yield pa.RecordBatch.from_arrays([pa.array(ids[ids >= 0]), batch.column(1).filter(pa.array(ids >= 0))], ["bucket", "n"])

    found = words.select("word", "n").mapInArrow(read, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"), F.count("*").alias("types"))
    total = np.full(shape.shared, shape.smoothing)
    for r in found.collect():
        total[r["bucket"]] += r["n"] + shape.smoothing * r["types"]
    return np.log(total)


def learn(docs: DataFrame, shape: Shape = Shape()) -> Model:
    """Count the words of all ``docs`` (text) and train on every place of each.

    Null and empty texts have no places, repeated rows are trained on as often as they occur, texts of any length whole;
    other columns are ignored; without rows the network stays as it starts.
    """
    counted = stage(count_words(docs))
    common = counted.orderBy(F.desc("n"), "word").limit(shape.common).collect()
    words = np.array([r["word"] for r in common], np.int64).view(np.uint64)
    order = np.argsort(words)
    model = Model(words[order], order.astype(np.int64), Network(shape))
    for number in range(shape.rounds):
        model = replace(model, network=train_round(docs, model, number))
    total = counted.agg(F.sum("n")).first()[0] or 0
    frequent = counted.where(F.col("n") * FREQUENT >= total).select("word", "n").toArrow()
    frequent = (frequent["word"].to_numpy().view(np.uint64), frequent["n"].to_numpy())
    return replace(model, buckets=count_buckets(counted, model), words=counted, frequent=frequent)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, log_probability (sum of their outputs'), per_token, word_log_probability (sum of the words') and
    per_word of every row of ``docs`` (doc_id, text).

    A token is a word between white space; one that shares an output gets,
    as a word, its share of that by its count over the corpus. Null and empty texts have no tokens, sum 0 and no mean;
    repeated rows get equal scores; every token counts, however long the text.
    """
    shape, counted = model.network.shape, model.words
    model = replace(model, words=None)
    # Of the whole count of its bucket; a rare word's own count is joined below.
    less = np.concatenate([np.zeros(shape.common), model.buckets])
    logs_of_frequent = np.log(model.frequent[1] + shape.smoothing)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, 2):
            words, n = _words(batch.column(2))
            ids, row = model.ids(words), np.repeat(np.arange(len(n)), n)
            line, places = model.line(ids, n)
            logs = [np.zeros(0)]
            for k in range(0, len(places), AT_ONCE):
                own = places[k : k + AT_ONCE]
                start = own[0] - shape.sides
                logs.append(model.network.log_probability_along(line[start : own[-1] + shape.sides + 1], own - start))
            shared = ids >= shape.common
            words, own = words[shared], row[shared]
            at = _index(words, model.frequent[0])
            known = at >= 0
            sums = ((row, np.concatenate(logs)), (row, less[ids]), (own[known], logs_of_frequent[at[known]]))
            rare = np.bincount(own[~known], minlength=len(n))
            # Of the copies of a text in a batch one has the words.
            first = np.zeros(len(n), bool)
            first[np.unique(batch.column(1).to_numpy(), return_index=True)[1]] = True
            bounds = np.concatenate([[0], np.cumsum(rare * first)])
            listed = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(words[~known & first[own]].view(np.int64)))
            columns = [batch.column(0), batch.column(1), pa.array(n), *(pa.array(np.bincount(r, x, len(n)).astype(float)) for r, x in sums), pa.array(rare), listed]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "n_tokens", "total", "buckets", "known", "rare", "words"])

    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    kinds = "doc_id long, text_hash long, n_tokens long, total double, buckets double, known double, rare long, words array<long>"
    scored = stage(rows.mapInArrow(read, kinds))
    own = scored.select("text_hash", F.explode("words").alias("word")).join(counted, "word", "left")
    # The mean is the same over any number of copies of a text.
    own = own.groupBy("text_hash").agg(F.avg(F.log(F.coalesce("n", F.lit(0)) + F.lit(shape.smoothing))).alias("own"))
    words = F.col("total") - F.col("buckets") + F.col("known") + F.col("rare") * F.coalesce("own", F.lit(0.0))
    mean = [F.when(F.col("n_tokens") > 0, total / F.col("n_tokens")) for total in (F.col("total"), words)]
    scored = scored.drop("words").join(own, "text_hash", "left")
    return scored.select("doc_id", "n_tokens", F.col("total").alias("log_probability"), mean[0].alias("per_token"), words.alias("word_log_probability"), mean[1].alias("per_word"))
