"""Similarity join on word n-grams, with Bayesian pruning of candidates.

Texts with the same shingles are one class. Classes that share a bucket of MinHash
values are candidates; they are brought together once, in blocks of their candidate
component, and there MinHash values are compared a few at a time. A pair is dropped
as soon as the posterior probability of its reaching the threshold is below the
tolerance, and what is left is verified on the whole shingle sets. Pairs stay in the
task: what comes out is the number of links of each class and a forest of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillforge.llm.components import connected
from quillforge.llm.wordhash import mix, shingles
from quillforge.operators.bloom import divided, key_filter, possible, unused
from quillforge.session import stage


@dataclass(frozen=True)
class Join:
    """``bands`` of ``rows`` MinHash values: at similarity 0.8, less than one pair in ten million shares no band.
    ``tolerance``: posterior probability below which a pair is dropped. ``together``: classes in a block."""

    words: int = 5
    threshold: float = 0.8
    bands: int = 32
    rows: int = 4
    step: int = 16
    tolerance: float = 1e-9
    together: int = 192

    @property
    def hashes(self) -> int:
        return self.bands * self.rows


def multipliers(n: int) -> np.ndarray:
    """Odd 64-bit multipliers from a fixed rule."""
    return mix(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)


def minhash(own: np.ndarray, n: int) -> np.ndarray:
    """The smallest of each of ``n`` hashes of the shingles, 32 bits each."""
    by = multipliers(n)[:, None]
    least = np.full(n, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(own), 4096):
        np.minimum(least, ((own[None, at : at + 4096] * by) >> np.uint64(32)).astype(np.uint32).min(1), out=least)
    return least


def class_key(own: np.ndarray) -> bytes:
    """128 bits that stand for a shingle set."""
    salted = mix(own + np.uint64(0x5851F42D4C957F2D))
    return int(own.sum(dtype=np.uint64) ^ np.uint64(len(own))).to_bytes(8, "big") + int(salted.sum(dtype=np.uint64)).to_bytes(8, "big")


def band_keys(least: np.ndarray, join: Join) -> np.ndarray:
    bands = least.reshape(join.bands, join.rows).astype(np.uint64)
    key = mix(np.arange(join.bands, dtype=np.uint64) + np.uint64(1))
    for r in range(join.rows):
        key = mix(key + bands[:, r])
    return key.view(np.int64)


def fewest_matches(join: Join) -> np.ndarray:
    """For n compared values, the fewest matches at which P(similarity >= threshold) is at least the tolerance (uniform prior)."""
    t, out = join.threshold, np.zeros(join.hashes + 1, np.int64)
    for n in range(1, join.hashes + 1):
        total = 0.0
        for m in range(n + 1):
            total += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if total >= join.tolerance:
                out[n] = m
                break
    return out


def describe(docs: DataFrame, join: Join) -> DataFrame:
    """doc_id, text_hash, cls, bands of every row; cls and bands are null for a text without words."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, bands = [], []
            for text in batch.column(2).to_pylist():
                own = shingles(text, join.words)
                keys.append(class_key(own) if len(own) else None)
                bands.append(band_keys(minhash(own, join.hashes), join) if len(own) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], ["doc_id", "text_hash", "cls", "bands"])

    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    return rows.mapInArrow(read, "doc_id long, text_hash long, cls binary, bands array<long>")


def candidate_edges(classes: DataFrame) -> DataFrame:
    """a, b: each class of a shared bucket and the bucket's smallest."""
    members = classes.select("cls", F.explode("bands").alias("bucket"))
    heads = members.groupBy("bucket").agg(F.min("cls").alias("head"), F.count("*").alias("n")).where("n > 1")
    return members.join(heads, "bucket").where("cls != head").select(F.col("cls").alias("a"), F.col("head").alias("b")).distinct()


def verified(first: int, sets: list[np.ndarray], join: Join) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of the sets that reach the threshold: within them all if ``first`` is 0, else of one before ``first`` with one from it on."""
    sketches = np.array([minhash(s, join.hashes) for s in sets])
    sizes = np.array([len(s) for s in sets])
    if first:
        i, j = (x.ravel() for x in np.meshgrid(np.arange(first), np.arange(first, len(sets)), indexing="ij"))
    else:
        i, j = np.triu_indices(len(sets), 1)
    # The larger set alone can rule a pair out.
    able = np.minimum(sizes[i], sizes[j]) >= join.threshold * np.maximum(sizes[i], sizes[j]) - 1e-9
    i, j = i[able], j[able]
    same, needed = np.zeros(len(i), np.int64), fewest_matches(join)
    for at in range(0, join.hashes, join.step):
        same += (sketches[i, at : at + join.step] == sketches[j, at : at + join.step]).sum(1)
        alive = same >= needed[min(at + join.step, join.hashes)]
        i, j, same = i[alive], j[alive], same[alive]
    keep = np.zeros(len(i), bool)
    cuts = np.searchsorted(i, np.arange(len(sets) + 1))
    for k in np.unique(i):
        rows = np.arange(cuts[k], cuts[k + 1])
        for part in np.array_split(rows, -(-len(rows) // 64)):
            others = np.concatenate([sets[x] for x in j[part]])
            at = np.minimum(np.searchsorted(sets[k], others), len(sets[k]) - 1)
            starts = np.concatenate([[0], np.cumsum(sizes[j[part]])[:-1]])
            common = np.add.reduceat((sets[k][at] == others).astype(np.int64), starts)
            keep[part] = common >= join.threshold * (sizes[k] + sizes[j[part]] - common) - 1e-9
    return i[keep], j[keep]


def links_of_blocks(rows: DataFrame, join: Join) -> DataFrame:
    """cls, links, root for every class of every pair of blocks, from rows sorted by comp, i, j within partitions."""

    def settle(group: list[dict]) -> Iterator[tuple]:
        low = group[0]["i"]
        group.sort(key=lambda r: (r["block"] != low, r["cls"]))
        first = sum(r["block"] == low for r in group) if group[0]["i"] != group[0]["j"] else 0
        if first == len(group):
            return
        i, j = verified(first, [np.frombuffer(r["own"], np.uint64) for r in group], join)
        links, root = np.zeros(len(group), np.int64), list(range(len(group)))
        n = np.array([r["n"] for r in group])
        np.add.at(links, i, n[j])
        np.add.at(links, j, n[i])

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for a, b in zip(i.tolist(), j.tolist(), strict=True):
            if (a := find(a)) != (b := find(b)):
                root[max(a, b)] = min(a, b)
        for k in np.flatnonzero(links):
            yield group[k]["cls"], int(links[k]), group[find(int(k))]["cls"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            out: list[tuple] = []
            for row in batch.to_pylist():
                if held and (row["comp"], row["i"], row["j"]) != (held[0]["comp"], held[0]["i"], held[0]["j"]):
                    out += settle(held)
                    held = []
                held.append(row)
            yield table(out)
        yield table(list(settle(held)) if held else [])

    def table(rows: list[tuple]) -> pa.RecordBatch:
        kinds = {"cls": pa.binary(), "links": pa.int64(), "root": pa.binary()}
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds.values())], list(kinds))

    return rows.mapInArrow(read, "cls binary, links long, root binary")


def shingle_rows(docs: DataFrame, members: DataFrame, join: Join) -> DataFrame:
    """The members (cls, rep, n, comp, block, blocks) with their shingles, read again from the representative's text."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            own = [shingles(t, join.words) for t in batch.column(at).to_pylist()]
            # Another text can have the same id; equal texts can be repeated.
            right = [class_key(s) == c for s, c in zip(own, batch.column(0).to_pylist(), strict=True)]
            kept = [batch.column(k) for k in range(at)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array([s.tobytes() for s in own], pa.binary())], names).filter(pa.array(right, pa.bool_()))

    names = ["cls", "n", "comp", "block", "blocks", "own"]
    # Only texts that may stand for a class are shuffled.
    texts = possible(docs.select("doc_id", "text"), key_filter(members, "rep", "rep_hash"), *text_key())
    texts = texts.select(F.col("doc_id").cast("long").alias("rep"), F.xxhash64(F.col("text").cast("string")).alias("rep_hash"), F.col("text").cast("string").alias("text"))
    wanted = members.withColumnsRenamed({"rep": "_rep", "rep_hash": "_hash"})
    on = [F.col("rep").eqNullSafe(F.col("_rep")), F.col("rep_hash") == F.col("_hash")]
    joined = texts.join(wanted, on).select("cls", "n", "comp", "block", "blocks", "text")
    return joined.mapInArrow(read, "cls binary, n long, comp binary, block int, blocks int, own binary")


def similarity_join(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """Near copies of every row of ``docs`` (doc_id, text; other columns are ignored).

    Words are runs of signs other than white space, unchanged; similarity is that of the sets of ``words``
    consecutive words, of which a shorter text with words has one. One row per row: doc_id, class_id (smallest
    doc_id of the documents that links connect), n_links (other rows that reach the threshold with this one),
    copy_of (smallest doc_id with the same shingles), n_copies, text_hash, kept (this is the class's row), and class_key. Null ids are
    smallest only where there is no other; class_key tells classes of nothing but null ids apart. A text without words, null too, links
    to nothing, is its own class and has no class_key. Repeated rows are copies of each other.
    """
    rows = stage(describe(docs, join))
    # A null id stands for its class only where no copy has another.
    representative = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("rep")
    classes = rows.where("cls is not null").groupBy("cls").agg(representative, F.count("*").alias("n"), F.first("bands").alias("bands"))
    classes = stage(classes.select("cls", F.col("rep.doc_id").alias("rep"), F.col("rep.text_hash").alias("rep_hash"), "n", "bands"))
    components = stage(connected(candidate_edges(classes)).select(F.col("node").alias("cls"), F.col("root").alias("comp")))
    blocks = components.groupBy("comp").agg(F.ceil(F.count("*") / join.together).cast("int").alias("blocks"))
    members = components.join(blocks, "comp").withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    members = stage(members.join(classes.drop("bands"), "cls").select("cls", "rep", "rep_hash", "n", "comp", "block", "blocks"))
    own = shingle_rows(docs, members, join).dropDuplicates(["cls"])
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    pairs = own.select("*", other).withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    pairs = pairs.select("comp", "i", "j", "block", "cls", "n", "own").repartition("comp", "i", "j").sortWithinPartitions("comp", "i", "j")
    found = stage(links_of_blocks(pairs, join))
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    groups = connected(found.select(F.col("cls").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "cls")
    groups = groups.join(classes.select("cls", F.struct(F.col("rep").isNull().alias("none"), "rep", "rep_hash").alias("rep")), "cls")
    smallest = groups.groupBy("root").agg(F.min("rep").alias("kept"))
    linked = groups.join(smallest, "root").join(links, "cls").select("cls", "root", "kept", "links")
    own = F.struct(F.col("rep").isNull().alias("none"), "rep", "rep_hash").alias("own")
    of_class = classes.select("cls", "rep", "n", own).join(linked, "cls", "left")
    of_class = stage(of_class.select("cls", "rep", "n", F.coalesce("root", "cls").alias("root"), F.coalesce("kept", "own").alias("kept"), "links"))
    joined = rows.select("doc_id", "text_hash", "cls").join(of_class, "cls", "left")
    kept = F.col("doc_id").eqNullSafe(F.col("kept.rep")) & (F.col("text_hash") == F.col("kept.rep_hash"))
    return joined.select(
        "doc_id",
        F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("kept.rep")).alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.coalesce("n", F.lit(1)) - 1).cast("long").alias("n_links"),
        F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("rep")).alias("copy_of"),
        F.coalesce("n", F.lit(1)).cast("long").alias("n_copies"),
        "text_hash",
        (F.col("cls").isNull() | kept).alias("kept"),
        F.hex("root").alias("class_key"),
    )


def text_key() -> tuple[Column, Column]:
    """What tells the rows of a table of documents apart, as far as they differ: id and hash of the text."""
    return F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string"))


def without(docs: DataFrame, keys: DataFrame, how: str = "left_anti") -> DataFrame:
    """The rows of ``docs`` whose doc_id and text are not among ``keys`` (doc_id, text_hash), or that are (left_semi).

    ``keys`` is a table. Rows that a filter of the keys excludes take no part in the join.
    """
    own = unused("_id", docs), unused("_hash", docs)
    maybe, rest = divided(docs, key_filter(keys, "doc_id", "text_hash"), *text_key())
    listed = keys.select(F.col("doc_id").alias(own[0]), F.col("text_hash").alias(own[1]))
    found = maybe.join(listed, [k.eqNullSafe(F.col(name)) for k, name in zip(text_key(), own, strict=True)], how)
    return found if rest is None or how == "left_semi" else found.unionByName(rest)


def one_of_each(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """``docs``, with all its columns, of each class the row with the smallest doc_id. Texts without words all stay."""
    found = stage(similarity_join(docs, join))
    left = without(docs, stage(found.where("not kept").select("doc_id", "text_hash").distinct()))
    repeated = found.where("kept and n_copies > 1").groupBy("doc_id", "text_hash").agg(F.count("*").alias("n")).where("n > 1")
    repeated = stage(repeated.select("doc_id", "text_hash"))
    if repeated.isEmpty():
        return left
    # Rows with one id and one text: any of them is the one.
    name = unused("_hash", docs)
    again = without(left, repeated, "left_semi").withColumn(name, text_key()[1])
    return without(left, repeated).unionByName(again.dropDuplicates(["doc_id", name]).drop(name))
