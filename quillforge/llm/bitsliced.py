"""Exact top-k by inner product over a bit-sliced index.

The index keeps the rows in blocks, and of a block's rows one bitmap per bit of each
attribute. An inner product is a sum of shifted bitmaps, one for each set bit of the
query's weights, added by carry-save adders; its own bitmaps are then read from the
most significant down, which leaves the rows that are surely in the top k and those
tied at its edge. Only these are looked up and scored by number.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



def bit_slices(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lowest value, bitmaps of bits x words) of one attribute's integers over all rows, less the lowest."""
    low = values.min()
    above = values.astype(np.uint64) - np.uint64(low.astype(np.uint64))
    bits = int(above.max()).bit_length()
    padded = np.zeros(-(-len(values) // 64) * 64, np.uint64)
    padded[: len(values)] = above
    planes = [np.packbits(((padded >> np.uint64(j)) & np.uint64(1)).astype(np.uint8), bitorder="little").view(np.uint64) for j in range(bits)]
    return low, np.array(planes, np.uint64).reshape(bits, len(padded) // 64)


def add_up(columns: dict[int, list[np.ndarray]]) -> list[np.ndarray]:
    """Bitmaps of the sum, least significant first, of bitmaps at given powers of two (each a stack of bitmaps)."""
    out: list[np.ndarray] = []
    at, last = min(columns, default=0), max(columns, default=-1)
    if columns:
        empty = np.zeros_like(next(iter(columns.values()))[0][0])
        out = [empty] * at
    while at <= last:
        stack = np.concatenate(columns.pop(at)) if at in columns else empty[None]
        while len(stack) > 1:
            if len(stack) == 2:
                carry, stack = (stack[0] & stack[1])[None], (stack[0] ^ stack[1])[None]
            else:
                k = len(stack) // 3
                x, y, z = stack[:k], stack[k : 2 * k], stack[2 * k : 3 * k]
                half = x ^ y
                carry = (x & y) | (half & z)
                stack = np.concatenate([half ^ z, stack[3 * k :]])
            columns.setdefault(at + 1, []).append(carry)
            last = max(last, at + 1)
        out.append(stack[0])
        at += 1
    return out


def count(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def select_top(planes: list[np.ndarray], rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(surely in the top k, tied at its edge) among ``rows``, from the most significant bitmap down."""
    sure, tied = np.zeros_like(rows), rows
    for plane in reversed(planes):
        high = tied & plane
        if count(sure | high) > k:
            tied = high
        else:
            sure, tied = sure | high, tied & ~plane
    return sure, tied


class Block:
    """Bit slices of a block of rows. ``values`` is rows x attributes, of integers."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.values = ids[order], values[order]
        sliced = [bit_slices(self.values[:, d]) for d in range(values.shape[1])]
        self.planes = np.concatenate([p for _, p in sliced]) if sliced else np.zeros((0, -(-len(ids) // 64)), np.uint64)
        self.planes = np.concatenate([self.planes, ~self.planes])  # the second half is for negative weights
        self.bits = [len(p) for _, p in sliced]
        self.first = np.concatenate([[0], np.cumsum(self.bits)]).astype(int)
        valid = np.zeros(-(-len(ids) // 64) * 64, np.uint8)
        valid[: len(ids)] = 1
        self.valid = np.packbits(valid, bitorder="little").view(np.uint64)

    def top(self, query: list[int], own_id: int, k: int) -> tuple[np.ndarray, list[int]]:
        """(ids, scores) of the k best rows but those with the query's id; ties to smaller ids."""
        half, wanted = int(self.first[-1]), {}
        for d, weight in enumerate(query):
            start = self.first[d] + half * (weight < 0)
            for i in range(abs(weight).bit_length()):
                if abs(weight) >> i & 1:
                    for j in range(self.bits[d]):
                        wanted.setdefault(i + j, []).append(start + j)
        planes = add_up({c: [self.planes[rows]] for c, rows in wanted.items()})
        rows = self.valid.copy()
        for r in range(*np.searchsorted(self.ids, [own_id, own_id + 1]) if own_id < np.iinfo(np.int64).max else (0, 0)):
            rows[r // 64] &= ~np.uint64(1 << r % 64)
        sure, tied = (self.positions(b) for b in select_top(planes, rows, k))
        # Rows are in the order of their ids, so the first ones tied are those with the smallest.
        found = np.concatenate([sure, tied[: k - len(sure)]])
        return self.ids[found], self.score(found, query)

    def positions(self, bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))

    def score(self, rows: np.ndarray, query: list[int]) -> list[int]:
        long = np.iinfo(np.int64)
        exact = (sum(a * b for a, b in zip(row, query, strict=True)) for row in self.values[rows].tolist())
        return [min(max(s, long.min), long.max) for s in exact]


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component; null for vectors that are null or have null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < math.inf))
    return F.when(vector.isNotNull() & finite, F.transform(vector, lambda x: F.floor(scale * x.cast("double")).cast("long")))


def search(vectors: DataFrame, k: int = 20, every: int = 20, scale: int = 64, block_rows: int = 16_384, queries_together: int = 512) -> DataFrame:
    """The ``k`` highest inner products of every query: query_id, rank, vec_id, score.

    ``vectors`` has vec_id and embedding. Queries are the rows whose id is divisible by ``every``; candidates of a
    query all rows with another id and as many components. Rows without an id, and vectors that are null or have
    null or non-finite components, take no part. Ties go to the smaller id; repeated rows are candidates each, and
    equal query rows one query; rows of one id with different vectors are queries each, with ranks of their own, whose
    results carry that id alike. Other columns are ignored. Fewer candidates than ``k`` are all returned. Scores beyond a long are its ends.

    Blocks are by hash of the id, about ``block_rows`` rows each at any size; every set of queries meets every block
    in a group of its own, and sends on its ``k`` best rows.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), quantised(F.col("embedding"), scale).alias("v"))
    rows = rows.where("vec_id is not null and v is not null").withColumn("dim", F.size("v"))
    sizes = rows.agg(F.count("*").alias("n"), F.count(F.when(F.col("vec_id") % every == 0, 1)).alias("q")).first()
    blocks, parts = max(1, -(-sizes["n"] // block_rows)), max(1, -(-sizes["q"] // queries_together))
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    block = F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).cast("int").alias("block")
    part = F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int").alias("part")
    queries = rows.where(F.col("vec_id") % every == 0).distinct().select("dim", "vec_id", "v", part, numbers(blocks).alias("block"))
    indexed = rows.select("dim", "vec_id", "v", block, numbers(parts).alias("part"))

    def run(_: tuple, own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found: list[pd.DataFrame] = []
        if len(own) and len(asked):
            index = Block(own["vec_id"].to_numpy(np.int64), np.array(own["v"].tolist(), np.int64).reshape(len(own), -1))
            for query_id, vector in zip(asked["vec_id"].tolist(), asked["v"], strict=True):
                query = [int(x) for x in vector]
                ids, scores = index.top(query, query_id, k)
                if len(ids):
                    found.append(pd.DataFrame({"query_id": query_id, "query": [query] * len(ids), "vec_id": ids, "score": scores}))
        return pd.concat(found) if found else pd.DataFrame({c: pd.Series(dtype=t) for c, t in (("query_id", "int64"), ("query", object), ("vec_id", "int64"), ("score", "int64"))})

    keys = ("dim", "block", "part")
    local = indexed.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(run, "query_id long, query array<long>, vec_id long, score long")
    best = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    ranked = local.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
