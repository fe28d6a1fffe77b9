"""Jobs released by a stream of their outputs, over several triggers, against the batch form."""

from quillforge.operators.pending import ready_jobs
from quillforge.sources.objects import list_objects
from quillforge.streaming.readiness import release_jobs


def test_each_job_is_released_once_across_restarts(spark, tmp_path):
    root, sink, checkpoint = tmp_path / "jobs", str(tmp_path / "sink"), str(tmp_path / "checkpoint")
    jobs = spark.createDataFrame([("a",), ("b",), ("deep/c",), ("d",), ("never",)], "job_id string")
    landed = [
        ["a/output/x/job.jsonl.out", "a/output/y/job.jsonl.out", "b/output/other.out", "b/input/job.jsonl.out"],
        ["a/output/z/job.jsonl.out", "deep/c/output/job.jsonl.out", "stranger/output/job.jsonl.out"],
        ["b/output/job.jsonl.out", "d/output/e/output/job.jsonl.out", "a b/output/job.jsonl.out"],
    ]
    root.mkdir()
    seen = []
    for names in landed:
        for name in names:
            (root / name).parent.mkdir(parents=True, exist_ok=True)
            (root / name).write_text("{}")
        release_jobs(spark, str(root), jobs, "job.jsonl", sink, checkpoint, max_files=2).awaitTermination()
        released = sorted(r["job_id"] for r in spark.read.parquet(sink).collect())
        ready = ready_jobs(jobs, list_objects(spark, str(root)), "job.jsonl")
        assert released == sorted(r["job_id"] for r in ready.collect())
        seen.append(released)
    assert seen == [["a"], ["a", "deep/c"], ["a", "b", "d", "deep/c"]]
    # Started again with nothing new, nothing is released again.
    release_jobs(spark, str(root), jobs, "job.jsonl", sink, checkpoint).awaitTermination()
    assert spark.read.parquet(sink).count() == 4
