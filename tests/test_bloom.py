"""Filters of keys: no false negatives, few false positives, and joins that shuffle only what may match."""

import random

from pyspark.sql import functions as F

from quillforge.operators.bloom import BITS_PER_KEY, BLOCK_BITS, divided, key_filter, possible, probed, unused
from quillforge.operators.pending import pending


def test_all_keys_pass_and_few_others(spark):
    keys = spark.range(0, 40_000, 2).selectExpr("id", "cast(id as string) as name")
    found = key_filter(keys, "id", "name")
    assert found.blocks == -(-20_000 * BITS_PER_KEY // BLOCK_BITS)
    rows = spark.range(40_000).selectExpr("id", "cast(id as string) as name")
    passed = {r["id"] for r in possible(rows, found, "id", "name").collect()}
    assert passed >= set(range(0, 40_000, 2))
    assert len(passed) - 20_000 < 20_000 * 0.02
    maybe, rest = divided(rows, found, "id", "name")
    assert {r["id"] for r in maybe.collect()} == passed and rest.count() == 40_000 - len(passed)


def test_no_keys_one_key_nulls_and_too_many(spark):
    rows = spark.createDataFrame([(1, "a"), (None, "b"), (2, None), (None, None)], "k long, v string")
    none = key_filter(rows.limit(0), "k")
    assert possible(rows, none, "k").count() == 0 and divided(rows, none, "k")[1].count() == 4
    null = key_filter(rows.where("k is null").limit(1), "k")
    assert {r["k"] for r in possible(rows, null, "k").collect()} == {None}
    assert key_filter(rows, "k", most_blocks=0) is None
    assert possible(rows, None, "k") is rows and divided(rows, None, "k") == (rows, None)


def test_names_do_not_clash(spark):
    rows = spark.createDataFrame([(1, 2, 3, 4, 5)], "k long, _bloom_key long, _BLOOM_block long, _bloom_bitmap long, _bloom_maybe long")
    marked, maybe = probed(rows, key_filter(rows, "k"), "k")
    assert marked.columns == [*rows.columns, maybe] and marked.first()[maybe] is True
    assert unused("A", rows.withColumn("a", F.lit(1))) == "A_"


def test_pending_with_and_without_the_filter(spark):
    rng = random.Random(3)
    docs = [(rng.choice([None, *range(50)]), rng.randrange(3), f"text {i}") for i in range(400)] + [(7, 0, "hot")] * 200
    frame = spark.createDataFrame(docs, "key long, part long, content string").repartition(4)
    done = spark.createDataFrame([(k,) for k in (1, 7, 7, 30, None, 99)], "key long")
    want = sorted(c for k, _, c in docs if k not in (1, 7, 30))
    for spread_by in ((), ("content",)):
        left = pending(frame, done, ["key"], spread_by, prefilter=True)
        assert left.columns == frame.columns
        assert sorted(r["content"] for r in left.collect()) == want


def test_the_rest_is_not_shuffled(spark):
    docs = spark.range(1000).selectExpr("id as key", "repeat('x', 100) as content")
    done = spark.range(5).selectExpr("id as key")
    _, rest = divided(docs, key_filter(done, "key"), "key")
    plan = rest._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "Python" not in plan
