"""Sources, sinks, composites and the stream, on temporary folders."""

import io
import json
import sys
import tarfile
from datetime import datetime

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from quillforge.functions.chat import chat_sample
from quillforge.operators.inference import Completion
from quillforge.plans.generate import batch_requests, batch_results
from quillforge.plans.prepare import check_training_lines, prepare_training_data
from quillforge.plans.publish import publish_batch
from quillforge.schema.samples import ONE_FIELD, TWO_FIELD
from quillforge.sinks.guard import write_if_absent, write_lines
from quillforge.sinks.training import training_line
from quillforge.sources import archives
from quillforge.sources.archives import read_document_batches, read_document_members, read_run, runs_of
from quillforge.sources.objects import list_document_batches, locate_output
from quillforge.sources.replies import read_batch_outputs
from quillforge.sources.training import read_training_batches, read_training_examples
from quillforge.streaming.backfill import backfill_stream, failed_documents, read_document_stream

# stand-in models and tokenizers go to the workers with the test
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _archive(path, members):
    with tarfile.open(path, "w:gz" if str(path).endswith(".gz") else "w") as tar:
        folder = tarfile.TarInfo("d/document_folder.json")
        folder.type = tarfile.DIRTYPE
        tar.addfile(folder)
        for name, text in members:
            info = tarfile.TarInfo(name)
            info.size = len(text.encode())
            tar.addfile(info, io.BytesIO(text.encode()))


def _document(content):
    return json.dumps({"content": content, "source": "s", "timestamp": "t", "extra": 1})


def test_runs_of_members():
    members = [("a", 0, 512, 100), ("b", 1, 1536, 0), ("c", 2, 2048, 50), ("far", 9, 2098 + archives.GAP_BYTES + 1, 10), ("huge", 10, 9 * 2**20, 2 * archives.RUN_BYTES), ("after", 11, 2**28, 1)]
    runs = list(runs_of(members))
    assert [[m[0] for m in r[2]] for r in runs] == [["a", "b", "c"], ["far"], ["huge"], ["after"]]
    assert [r[:2] for r in runs] == [(m[0][2], m[-1][2] + m[-1][3] - m[0][2]) for m in (r[2] for r in runs)]
    assert list(runs_of([])) == []


def test_each_run_is_one_read(tmp_path):
    texts = {f"document_{k}.json": "é" * (k * 37 % 900) for k in range(500)}
    _archive(tmp_path / "many.tar", [x for name, text in texts.items() for x in ((name, text), (f"other_{name}", "skipped" * 50))])
    rows = [r[1:] for r in archives._read_index(str(tmp_path / "many.tar"))]

    class Counted:
        reads = []

        def __init__(self, data):
            self.data = data

        def read_at(self, n, at):
            self.reads.append(n)
            return self.data[at : at + n]

    source = Counted((tmp_path / "many.tar").read_bytes())
    found = [x for offset, length, members, error in rows for x in read_run(source, offset, length, members)]
    assert {m: t for m, _, t, e in found if e is None} == texts
    assert len(source.reads) == len(rows) == 1
    cut = Counted(source.data[: rows[0][0] + rows[0][1] - 5])
    assert [e is not None for *_, e in read_run(cut, *rows[0][:3])] == [False] * 499 + [len(texts["document_499.json"]) > 0]


def test_a_broken_archive_keeps_what_it_has(spark, tmp_path):
    _archive(tmp_path / "b.tar", [(f"document_{k}.json", _document(str(k))) for k in range(3)])
    data = (tmp_path / "b.tar").read_bytes()
    at = data.index(b"document_2.json")
    (tmp_path / "b.tar").write_bytes(data[:at] + b"#" * 600)
    members = read_document_members(spark, [str(tmp_path / "b.tar")])
    assert sorted(r["content"] for r in members.where("is_valid").collect()) == ["0", "1"]
    assert members.where("archive_error is not null").count() == 1


def test_archives(spark, tmp_path):
    _archive(tmp_path / "one.tar.gz", [("a/document_1.json", _document("é1")), ("b/document_1.json", _document("later")), ("x.json", "{}")])
    _archive(tmp_path / "two.tar", [("document_2.json", _document("2")), ("document_3.json", '{"content": 5}'), ("document_4.json", "no")])
    (tmp_path / "bad.tar.gz").write_bytes(b"junk")
    (tmp_path / "note.txt").write_text("x")
    listed = {r["key"]: r["batch_name"] for r in list_document_batches(spark, str(tmp_path)).collect()}
    assert listed == {"one.tar.gz": "one", "two.tar": "two", "bad.tar.gz": "bad"}
    paths = [str(tmp_path / n) for n in ("two.tar", "one.tar.gz", "bad.tar.gz")]
    members = read_document_members(spark, paths)
    assert members.groupBy("batch_name", "is_valid").count().count() == 4
    assert {(r["batch_name"], r["n"]) for r in members.groupBy("batch_name").agg(F.count("*").alias("n")).collect()} == {("one", 2), ("two", 3), ("bad", 1)}
    assert "gzip" in members.filter("batch_name = 'bad'").first()["archive_error"]
    docs = {(r["batch_pos"], r["file_name"]): r["content"] for r in read_document_batches(spark, paths).collect()}
    assert docs == {(1, "document_1.json"): "later", (0, "document_2.json"): "2"}


def test_write_once(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([("a",)], "value string")
    assert write_if_absent(df, path, write_lines) is True
    assert write_if_absent(df.withColumn("value", F.lit("b")), path, write_lines) is False
    assert spark.read.text(path).first()[0] == "a"
    assert write_if_absent(df.withColumn("value", F.lit("b")), path, write_lines, force=True) is True
    assert spark.read.text(path).first()[0] == "b"


def test_locate_output(spark):
    listing = spark.createDataFrame([("j/output/b/f.out",), ("j/output/a/f.out",), ("j/output/a/f.err",)], "key string")
    assert locate_output(listing, "j/output/*/f.out").first()[0] == "j/output/a/f.out"
    assert locate_output(listing, "k/output/*/f.out").first()[0] is None


def _reply(record_id, text, **changes):
    part = [{"type": "text", "text": text}]
    entry = {
        "modelInput": {"anthropic_version": "v", "max_tokens": 1, "messages": [{"role": "user", "content": part}]},
        "modelOutput": {"model": "m", "id": "i", "type": "t", "role": "r", "content": part, "stop_reason": "s", "usage": {"n": 1}},
        "recordId": record_id,
    }
    return json.dumps({**entry, **changes})


def test_batch_replies(spark, tmp_path):
    path = tmp_path / "replies.jsonl"
    path.write_text("\n".join([_reply("1", '{"field": "b"}'), "broken", _reply("0", "none"), _reply("2", "x", modelOutput=None), _reply(3, "x")]))
    replies = read_batch_outputs(spark, str(path))
    assert replies.groupBy("is_valid").count().orderBy("is_valid").collect() == [(False, 3), (True, 2)]
    docs = spark.createDataFrame([(0, f"document_{i}.json", f"c{i}", "s") for i in range(3)], "batch_pos int, file_name string, content string, source string")
    numbered, lines = batch_requests(docs, "sys", n=2)
    assert sorted(json.loads(r[0])["recordId"] for r in lines.collect()) == ["0", "1"]
    routed = batch_results(numbered, replies.filter("is_valid").select("record_id", "reply"), ONE_FIELD, unique=True)
    assert {(r["content"], r["status"]) for r in routed.collect()} == {("c0", "no_json"), ("c1", "valid")}


def _line(system="f o\no", answer='<output>{"foo": "baz", "bar": 42}</output>', roles=("system", "user", "assistant"), keep=3):
    messages = [{"role": r, "content": c} for r, c in zip(roles, (system, "bar", answer))][:keep]
    return json.dumps({"messages": messages})


def test_line_checks(spark):
    lines = {
        _line(): None,
        _line(answer='{"foo": "a", "bar": "7"}'): None,
        _line(system="other"): "prompt_mismatch",
        _line(answer='{"foo": 1, "bar": 7}'): "schema_invalid",
        _line(answer="<output>junk</output>"): "bad_payload",
        _line(keep=2): "too_few_messages",
        _line(roles=("system", "user", "robot")): "bad_line",
        _line(roles=("user", "user", "user")): None,
        "": "bad_line",
    }
    df = spark.createDataFrame([(t,) for t in lines], "value string")
    got = {r["value"]: r["reject_reason"] for r in check_training_lines(df, TWO_FIELD, "foo").collect()}
    assert got == lines


def letters():
    return list


def test_prepare(spark, tmp_path, caplog):
    payload = F.lit('{"foo":"a","bar":1}')
    def lines(sizes):
        df = spark.createDataFrame([(i, "x " * n) for i, n in enumerate(sizes)], "i int, c string")
        line = training_line(chat_sample("p", F.col("c"), payload))
        return df.select(F.lit("b").alias("batch_name"), F.lit(0).alias("batch_pos"), F.lpad(F.col("i").cast("string"), 4, "0").alias("line_id"), line.alias("value"))

    fixed = 8  # words of template, prompt and answer
    prepared = prepare_training_data(lines([93 - fixed, 99 - fixed, 100 - fixed, 200, 1]), TWO_FIELD, "p", "m", 100)
    assert {r["line_id"] for r in prepared.table.collect()} == {"0000", "0001", "0004"}
    assert (prepared.n_kept, prepared.n_valid, prepared.too_few_kept) == (3, 5, False)
    none_fit = prepare_training_data(lines([50, 60]), TWO_FIELD, "p", "m", 10)
    assert none_fit.table.isEmpty() and none_fit.too_few_kept and "max_seq_length" in caplog.text
    none_fit.write(str(tmp_path / "empty"))
    assert prepare_training_data(lines([50]), TWO_FIELD, "p", None, 10).n_kept == 1
    assert prepare_training_data(lines([50]), TWO_FIELD, "p", "m", 100, tokenizer=letters).n_kept == 0
    with pytest.raises(ValueError):
        prepare_training_data(lines([5]), TWO_FIELD, "another prompt")
    plain = prepare_training_data(lines([1] * 30), TWO_FIELD, "p", shuffle=False)
    plain.write(str(tmp_path / "plain"))
    mixed = prepare_training_data(lines(range(30)), TWO_FIELD, "p", seed=1)
    mixed.write(str(tmp_path / "mixed"))
    texts = [r[0] for r in spark.read.text(str(tmp_path / "mixed")).collect()]
    assert len(set(texts)) == 30 and '"name":null' in texts[0]
    assert [r["line_id"] for r in plain.table.orderBy("rank").collect()] == [f"{i:04d}" for i in range(30)]
    assert [r["value"] for r in mixed.table.orderBy("rank").collect()] != [r["value"] for r in mixed.table.orderBy("line_id").collect()]


def test_publish_and_read_back(spark, tmp_path):
    folder = tmp_path / "samples"
    (folder / "invalid").mkdir(parents=True)
    for i, output in enumerate([{"foo": "a", "bar": "5", "x": 1}, {"foo": "b", "bar": 2}, {"foo": 3, "bar": 1}]):
        (folder / f"s{i}.json").write_text(json.dumps({"content": f"c{i}", "output": output}, indent=2))
    (folder / "bad.json").write_text("{")
    (folder / "invalid" / "s9.json").write_text(json.dumps({"content": "no", "output": {"foo": "a", "bar": 1}}))
    examples = read_training_examples(spark, str(folder), TWO_FIELD)
    assert examples.count() == 4 and examples.filter("is_valid").count() == 2
    out, when, table = str(tmp_path / "published"), datetime(2024, 1, 2, 3, 4, 5), str(tmp_path / "manifest")
    batch = publish_batch(examples, TWO_FIELD, "p", "demo", out, now=when, manifest_table=table)
    assert (batch.path, batch.num_samples, batch.written) == (f"{out}/20240102-030405_demo", 2, True)
    assert publish_batch(examples, TWO_FIELD, "p", "demo", out, now=when, manifest_table=table).written is False
    row = spark.read.parquet(table).collect()
    assert len(row) == 1 and (row[0]["description"], row[0]["num_samples"], row[0]["schema_version"]) == ("demo", 2, "1_0_0")
    lines = read_training_batches(spark, out, ["20240102-030405_demo"])
    answers = [json.loads(r["value"])["messages"][2]["content"] for r in lines.collect()]
    parsed = [json.loads(a.removeprefix("<output>\n").removesuffix("\n</output>")) for a in answers]
    assert sorted(p["bar"] for p in parsed) == [2, 5] and all(set(p) == {"foo", "bar"} for p in parsed)
    assert prepare_training_data(lines, TWO_FIELD, "p").n_valid == 2
    with pytest.raises(ValueError):
        publish_batch(examples.filter("not is_valid"), TWO_FIELD, "p", "none", out)
    with pytest.raises(ValueError):
        read_training_batches(spark, out, ["absent"])


def echo():
    def complete(request: Completion):
        return None if request.user == "bad" else json.dumps({"field": request.user})

    return complete


def test_backfill_stream_is_incremental_and_replayable(spark, tmp_path):
    def land(name, texts):
        (tmp_path / "in").mkdir(exist_ok=True)
        rows = [{"batch_name": name, "batch_pos": 0, "file_name": f"{i}", "content": t, "source": "s", "timestamp": ""} for i, t in enumerate(texts)]
        (tmp_path / "in" / f"{name}.json").write_text("\n".join(map(json.dumps, rows)))

    sink = str(tmp_path / "sink")

    def run(progress="progress"):
        docs = read_document_stream(spark, str(tmp_path / "in"))
        backfill_stream(docs, sink, ONE_FIELD, echo, "p", str(tmp_path / progress)).awaitTermination()
        samples = [r["content"] for r in spark.read.parquet(f"{sink}/samples").collect()]
        return sorted(samples), spark.read.parquet(f"{sink}/quarantine").count()

    land("one", ["a", "b", "a", "bad"])
    assert run() == (["a", "b"], 1)
    land("two", ["b", "c", "bad"])
    assert run() == (["a", "b", "c"], 2)
    assert [r["content"] for r in failed_documents(spark, sink).collect()] == ["bad"]
    # all files again as one batch 0, as after losing the progress of an interrupted run
    assert run("fresh")[0] == ["a", "b", "c"]
