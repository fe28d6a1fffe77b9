"""The pipeline's stages on their own inputs against brute force."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quillforge.llm.quality import learn, score_quality
from quillforge.session import stage

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def inputs(spark):
    """Each stage's input and output: documents, and copies of some with a few words changed, or a passage of others in them."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    more = docs.where("doc_id % 9 = 0").withColumn("doc_id", F.col("doc_id") + 10_000)
    changed = docs.where("doc_id % 11 = 3").withColumns({"doc_id": F.col("doc_id") + 20_000, "text": F.concat("text", F.lit(" and more"))})
    now, found = docs.unionByName(more).unionByName(changed), {}
    for name, apply in corpus_pipeline.STAGES:
        after = stage(apply(spark, now, SMALL))
        found[name] = (now, after)
        now = after
    return found


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_quality(spark, inputs):
    before, after = inputs["quality"]
    scores = score_quality(before, learn(before, spark.read.parquet(f"{SMALL}/labels.parquet"))).collect()
    assert sorted(r["doc_id"] for r in scores if r["predicted"] == 1) == sorted(i for i, _ in rows(after))
    assert 0 < after.count() < before.count()


def test_near_duplicates(inputs):
    before, after = inputs["near_duplicates"]
    docs = rows(before)
    sets = []
    for _, text in docs:
        w = words(text)
        sets.append({tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))} if w else set())
    group = list(range(len(docs)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                group[find(a)] = find(b)
    kept = {}
    for k, (doc_id, _) in enumerate(docs):
        root = find(k)
        kept[root] = min(kept.get(root, doc_id), doc_id)
    assert sorted(i for i, _ in rows(after)) == sorted(kept.values())
    assert len(kept) < len(docs)


def test_repeated_passages(inputs):
    before, after = inputs["repeated_passages"]
    docs = sorted(rows(before))
    seen, want = {}, {}
    for doc_id, text in docs:
        w = words(text)
        for k in range(len(w) - 49):
            seen.setdefault(tuple(w[k : k + 50]), doc_id)
    for doc_id, text in docs:
        w = words(text)
        gone = {p for k in range(len(w) - 49) if seen[tuple(w[k : k + 50])] < doc_id for p in range(k, k + 50)}
        if not (gone and len(gone) == len(w)):
            want[doc_id] = [x for p, x in enumerate(w) if p not in gone]
    assert {i: words(t) for i, t in rows(after)} == want
    assert {i: r for i, r in rows(after)} == {i: t for i, t in docs if i in want and want[i] == words(t)} | {i: t for i, t in rows(after) if want[i] != words(dict(docs)[i])}


def test_decontamination(spark, inputs):
    before, after = inputs["decontamination"]
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = set()
    for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect():
        w = split(r["text"])
        windows |= {tuple(w[k : k + 13]) for k in range(max(len(w) - 12, 1))} if w else set()
    sizes, kept = {len(w) for w in windows}, []
    for doc_id, text in rows(before):
        w = split(text)
        hit = {p for n in sizes for k in range(len(w) - n + 1) if tuple(w[k : k + n]) in windows for p in range(k, k + n)}
        if not (hit and 20 * len(hit) >= len(w)):
            kept.append(doc_id)
    assert sorted(i for i, _ in rows(after)) == sorted(kept)


def test_packing(inputs):
    before, after = inputs["packing"]
    pieces = after.collect()
    assert {r["doc_id"] for r in pieces} == {i for i, _ in rows(before)}
    sequences = {}
    for r in pieces:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in sequences.values():
        place = 0
        for offset, length in sorted(own):
            assert offset == place
            place += length
        assert place <= 1024
    total = sum(r["length"] for r in pieces)
    assert -(-total // 1024) <= len(sequences) <= -(-total // 1024) + 2
