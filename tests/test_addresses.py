"""One row per key by the rows' addresses in their files, and counts observed by the writing job."""

import random

from pyspark.sql import functions as F

from quillforge.operators.dedupe import first_per_key, latest_per_key, one_per_key_of_files
from quillforge.session import stage, stage_counted


def test_agrees_with_the_aggregate(spark):
    rng = random.Random(5)
    rows = [(rng.choice([None, *range(40)]), rng.choice("ab"), i, f"content {i}") for i in range(600)] + [(3, "a", 1000 + i, "hot") for i in range(300)]
    table = stage(spark.createDataFrame(rows, "k long, part string, place long, content string").repartition(5))
    for last, by_aggregate in ((False, first_per_key), (True, latest_per_key)):
        got = one_per_key_of_files(table, ["k", "part"], ["place"], last)
        assert got.columns == table.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, by_aggregate(table, ["k", "part"], ["place"]).collect()))


def test_equal_orders_unique_keys_and_no_rows(spark):
    same = stage(spark.range(50).selectExpr("id % 5 as k", "1 as place", "id as content"))
    assert sorted(r["k"] for r in one_per_key_of_files(same, ["k"], ["place"]).collect()) == list(range(5))
    unique = stage(spark.range(20).selectExpr("id as k", "id as place"))
    assert one_per_key_of_files(unique, ["k"], ["place"]).count() == 20
    assert one_per_key_of_files(unique.where("k < 0"), ["k"], ["place"]).count() == 0


def test_contents_are_not_sorted(spark):
    table = stage(spark.range(100).selectExpr("id % 60 as k", "id as place", "repeat('x', 50) as content"))
    plan = one_per_key_of_files(table, ["k"], ["place"])._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Sort" not in plan and "content" in plan


def test_counts_observed_by_the_writing_job(spark):
    rows = spark.range(100, numPartitions=7)
    staged, seen = stage_counted(rows, n=F.count("*"), odd=F.count_if(F.col("id") % 2 == 1))
    assert seen == {"n": 100, "odd": 50} and staged.count() == 100
    assert stage_counted(rows.where("id < 0"), n=F.count("*"))[1] == {"n": 0}
