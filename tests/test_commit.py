"""Commits: one of several writers wins, and nothing half-written is read."""

import threading
from concurrent.futures import ThreadPoolExecutor

import pytest

from quillforge.sinks.commit import ATTEMPTS, MARKER, Unfinished, _create, _local, committed_path, latest_version, write_committed


def parquet(df, path):
    df.write.parquet(path)


def test_one_of_two_writers_at_once_wins(spark, tmp_path):
    place, both = str(tmp_path / "out"), threading.Barrier(4)

    def write(df, path):
        parquet(df, path)
        both.wait(60)

    with ThreadPoolExecutor(4) as pool:
        won = list(pool.map(lambda n: write_committed(spark.range(n), place, write), (10, 20, 30, 40)))
    assert sum(won) == 1
    assert spark.read.parquet(committed_path(spark, place)).count() == (10, 20, 30, 40)[won.index(True)]
    assert len(list((tmp_path / "out" / ATTEMPTS).iterdir())) == 1


def test_failed_writers_leave_nothing_to_read(spark, tmp_path):
    place = f"file://{tmp_path}/out"

    def broken(df, path):
        parquet(df, path)
        raise OSError

    assert committed_path(spark, place) is None and latest_version(spark, place) is None
    with pytest.raises(OSError):
        write_committed(spark.range(3), place, broken)
    assert committed_path(spark, place) is None and latest_version(spark, place) is None
    assert write_committed(spark.range(4), place, parquet) and not write_committed(spark.range(5), place, parquet)
    assert spark.read.parquet(committed_path(spark, place)).count() == 4
    # Read as a plain folder there is nothing: all names begin with an underscore.
    assert [p.name for p in (tmp_path / "out").iterdir() if not p.name.startswith(("_", "."))] == []


def test_versions_and_an_empty_marker(spark, tmp_path):
    place = str(tmp_path / "out")
    for version in (0, 2):
        assert write_committed(spark.range(version + 1), place, parquet, version)
    assert latest_version(spark, place) == 2 and committed_path(spark, place, 1) is None
    (tmp_path / "out" / f"{MARKER}-1").write_text("")
    assert not write_committed(spark.range(9), place, parquet, 1)
    with pytest.raises(Unfinished):
        committed_path(spark, place, 1)


def test_where_files_lie(spark, tmp_path):
    assert _local("file:///a/b") == _local("file:/a/b") == _local("/a/b") == "/a/b"
    assert _local("hdfs://host/a") is None and _local("s3a://bucket/a") is None and _local("viewfs:///a") is None
    assert _create(spark, f"{tmp_path}/m", "x") and not _create(spark, f"file:{tmp_path}/m", "y") and (tmp_path / "m").read_text() == "x"
