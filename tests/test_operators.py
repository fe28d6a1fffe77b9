import random
import sys
from datetime import datetime

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from quillforge.functions import text as X
from quillforge.functions.chat import has_chat_shape, render_chat, same_prompt, wrap_output
from quillforge.functions.markup import markup_to_text
from quillforge.functions.payload import strip_tags
from quillforge.functions.prompts import batch_request, generation_prompt, main_prompt, render_prompt
from quillforge.functions.tokens import length_verdict, token_count, whitespace_tokens
from quillforge.operators import audits, dedupe, ordering, pairing, pending
from quillforge.operators.inference import Completion, RateLimited, Retry, infer, with_retry
from quillforge.schema.samples import EVENT

# stand-in models and tokenizers go to the workers with the test
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def values(spark, texts, function):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r[0] for r in df.orderBy("i").select(function(F.col("t"))).collect()]


def test_member_names(spark):
    digest = "0123456789abcdef0123456789abcdef"
    names = ["batch/document_001.json", f"batch/{digest}.json", f"{digest}.json\n", "document_.json"]
    others = ["other_001.json", "document_001.txt", "document_001", "metadata.json", "documentbatch.txt", f"{digest[:31]}.json", f"{digest}g.json", "document_1.json/x"]
    assert values(spark, names + others, X.is_document_member) == [True] * 4 + [False] * 8


def test_names_and_versions(spark):
    key = lambda c: X.output_key("foo_schema", "1_2_3", F.lit("bar"), c)
    assert values(spark, ["foo"], key) == ["foo_schema1_2_3_bar_acbd18db.json"]
    assert values(spark, ["1.2.3.4.5", "1.2"], X.version_token) == ["1_2_3", "1_2"]
    assert values(spark, ["MLX retrain - spike", "***", "a" * 60], X.slug) == ["mlx-retrain-spike", "", "a" * 40]
    assert values(spark, ["1.2.3", "1.2", "a.2.3", "1.2.3.4", "1..3"], lambda c: X.split_semver(c).isNotNull()) == [True] + [False] * 4
    when = F.lit(datetime(2024, 3, 5, 6, 7, 8)).cast("timestamp")
    assert values(spark, ["***", "a b"], lambda c: X.job_name(when, c)) == ["20240305-060708", "20240305-060708-a-b"]
    assert values(spark, ["d"], lambda c: X.run_name(when, c)) == ["20240305-060708_d"]
    assert values(spark, ["x.tar.gz", "x.tar.tar.gz.y"], X.batch_name) == ["x", "x.y"]


def test_prompts(spark):
    fill = lambda c: render_prompt(c, {"SCHEMA": F.lit("s{EXAMPLE}.*"), "EXAMPLE": F.lit("$1")})
    assert values(spark, ["a{SCHEMA}b{EXAMPLE}"], fill) == ["as$1.*b$1"]
    assert "{" + "SCHEMA}" not in generation_prompt(EVENT) and '"event_id": 1' in generation_prompt(EVENT)
    assert '"event_id": 1' not in main_prompt(EVENT) and "maximum" in main_prompt(EVENT)
    assert values(spark, ["f o\no", "fo\to"], lambda c: same_prompt(c, "foo")) == [True, False]
    line = values(spark, ["hi"], lambda c: F.to_json(batch_request(F.lit(7), c)))[0]
    assert '"recordId":"7"' in line and "system" not in line


def test_chat_text(spark):
    assert values(spark, ["{}"], wrap_output) == ["<output>\n{}\n</output>"]
    assert values(spark, [" <output>a<output></output>b "], strip_tags) == ["ab"]
    messages = "array<struct<role:string,content:string,name:string>>"
    df = spark.createDataFrame([([("system", "a", None), ("user", "b c", "n")],), (None,)], f"m {messages}")
    got = df.select(render_chat(F.col("m")).alias("r"), has_chat_shape(F.col("m")).alias("ok")).collect()
    assert got[0]["r"] == "<|im_start|>system\na<|im_end|>\n<|im_start|>user\nb c<|im_end|>\n"
    assert [r["ok"] for r in got] == [False, False]


def characters():
    return list


def test_tokens(spark):
    assert values(spark, ["", " a  b\nc ", None], whitespace_tokens) == [0, 3, None]
    assert values(spark, ["abc", None, ""], lambda c: token_count(c, characters)) == [3, None, 0]


def test_length_verdicts_equal_counting_all(spark):
    texts = [None, "", "a b", "abc def", "a b c d e f", "abcdefgh", " \n ", "aé" * 4, "a b c d", "x" * 5, "a b c"]
    limit = 5

    def words_and_one():
        return lambda text: [*text.split(), "end"] if len(text) > 1 else text

    got = values(spark, texts, lambda c: length_verdict(c, limit, words_and_one))
    for text, v in zip(texts, got, strict=True):
        if text is None:
            assert tuple(v) == (None, None, None)
            continue
        n = len(words_and_one()(text))
        assert v["fits"] == (n < limit), text
        assert v["decided_by"] == ("most" if len(text.encode()) < limit else "least" if len(text.split()) >= limit else "tokens")
        assert v["n_tokens"] == (n if v["decided_by"] == "tokens" else None)


def test_markup(spark):
    texts = ["# Title\n\nSome *emphasis* and **bold** `code` [link](http://x)\n\n## Sub\n- item\n", "```py\nx = 1 < 2\n```\nend",
             "<h1 class='a'>T</h1><!-- c --><style>p{}</style><p title=\"a>b\">x &amp; y</p>", "Head\n====\ntext &lt;b&gt;"]
    out = values(spark, texts, markup_to_text)
    assert out[0].split() == ["Some", "emphasis", "and", "bold", "code", "link", "Sub", "item"]
    assert out[1].split() == ["x", "=", "1", "<", "2", "end"]
    assert out[2] == "x & y"
    assert out[3].split() == ["text", "<b>"]
    assert "Title" in values(spark, texts[:1], lambda c: markup_to_text(c, remove_title=False))[0]


def _documents(spark, n=1000, seed=3):
    rng = random.Random(seed)
    rows = [(i % 3, f"document_{i}.json", f"c{i % 40}", i) for i in range(n)]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "batch_pos int, file_name string, content string, i int").repartition(5)


def test_positions_and_caps(spark):
    rows, df = _documents(spark)
    ordered = [r[3] for r in sorted(rows)]
    assert {r["i"]: r["position"] for r in ordering.with_positions(df).collect()} == {i: p for p, i in enumerate(ordered)}
    got = ordering.take_first(df, 25).collect()
    assert {(r["i"], r["position"]) for r in got} == {(i, p) for p, i in enumerate(ordered[:25])}
    assert ordering.take_first(df, 5000).count() == len(rows)
    assert [r["i"] for r in ordering.document_order(df).collect()] == ordered
    ids = ordering.assign_record_id(df, n=3).orderBy("record_id").collect()
    assert [(r["record_id"], r["i"]) for r in ids] == [(str(p), i) for p, i in enumerate(ordered[:3])]


def test_shuffle_is_a_reproducible_permutation(spark):
    _, df = _documents(spark, 200)
    one, again, other = ([r["i"] for r in ordering.shuffled(df, seed, "i").collect()] for seed in (1, 1, 2))
    assert one == again and one != other and sorted(one) == list(range(200)) and one != sorted(one)


def test_one_row_per_key_with_a_hot_key(spark):
    rows = [("hot" if i % 3 else f"k{i}", i, f"v{i}") for i in range(900)]
    df = spark.createDataFrame(rows, "k string, i int, v string").repartition(7)
    first, last = {}, {}
    for k, i, v in rows:
        first.setdefault(k, (i, v))
        last[k] = (i, v)
    assert {r["k"]: (r["i"], r["v"]) for r in dedupe.first_per_key(df, ["k"], ["i"]).collect()} == first
    assert {r["k"]: (r["i"], r["v"]) for r in dedupe.latest_per_key(df, ["k"], ["i"]).collect()} == last
    plan = dedupe.first_per_key(df, ["k"], ["i"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "Window" not in plan


def test_pending(spark):
    rows, df = _documents(spark, 300)
    done = spark.createDataFrame([(f"c{j}",) for j in range(0, 40, 2)] * 2, "content string")
    expected = {r[3] for r in rows if int(r[2][1:]) % 2}
    assert {r["i"] for r in pending.pending(df, done, ["content"]).collect()} == expected
    spread = pending.pending(df, done, ["content"], spread_by=["i"], salts=4)
    assert spread.columns == df.columns and {r["i"] for r in spread.collect()} == expected
    capped = {r[3] for r in sorted(rows)[:50]}
    got = pending.capped_then_pending(df, done, 50, ["content"])
    assert {r["i"] for r in got.collect()} == expected & capped
    nothing_left = spark.createDataFrame([(f"c{j}",) for j in range(40)], "content string")
    assert pending.pending(df, nothing_left, ["content"]).isEmpty()


def test_versions_and_ready_jobs(spark):
    manifest = spark.createDataFrame([("a", "1_0_10")], "name string, version string")
    wanted = spark.createDataFrame([("a", "1_0_1"), ("a", "1_0_10"), ("b", "1_0_10")], "name string, version string")
    assert {tuple(r) for r in pending.free_versions(wanted, manifest).collect()} == {("a", "1_0_1"), ("b", "1_0_10")}
    keys = ["x/a/output/1/j.jsonl.out", "x/ab/output/j.jsonl", "x/c/output/output/my-j.jsonl.out", "output/j.jsonl.out", "x/d/input/j.jsonl.out"]
    jobs = ["x/a", "x/ab", "x/c", "x/c/output", "x", "x/d"]
    listing = spark.createDataFrame([(k,) for k in keys], "key string")
    got = pending.ready_jobs(spark.createDataFrame([(j,) for j in jobs], "job_id string"), listing, "j.jsonl")
    assert {r[0] for r in got.collect()} == {j for j in jobs if any(k.startswith(j + "/output/") and k.endswith("j.jsonl.out") for k in keys)}


def test_pairing(spark):
    docs = spark.createDataFrame([(str(i), f"d{i}") for i in range(4)], "record_id string, content string")
    replies = spark.createDataFrame([("3", "r3"), ("0", "r0"), ("9", "r9"), ("1", "r1")], "record_id string, reply string")
    assert {(r["content"], r["reply"]) for r in pairing.attach_responses(docs, replies).collect()} == {("d3", "r3"), ("d0", "r0"), ("d1", "r1")}
    assert [r["record_id"] for r in pairing.orphan_replies(docs, replies).collect()] == ["9"]
    assert [r["record_id"] for r in pairing.unanswered(docs, replies).collect()] == ["2"]
    by_place = pairing.attach_by_position(docs.limit(3), replies, ["content"], ["reply"]).collect()
    assert {(r["content"], r["reply"]) for r in by_place} == {("d0", "r0"), ("d1", "r1"), ("d2", "r3"), (None, "r9")}


def test_audits(spark):
    ok = spark.createDataFrame([(s,) for s in (True, False, True, None)], "ok boolean")
    assert tuple(audits.success_and_failure(ok, F.col("ok")).first()) == (2, 2)
    for kept, total, warn in ((1, 3, True), (1, 2, False), (2, 3, False)):
        df = spark.range(total).withColumn("fits", F.col("id") < kept)
        assert audits.retention(df, F.col("fits")).first()["too_few_kept"] is warn
    budget = audits.step_budget(spark.createDataFrame([(10,)], "n long"), "n", epochs=2, batch_size=4, accumulation=4, warmup_ratio=0.5)
    assert tuple(budget.first()) == (10, 6, 1, 0)
    assert audits.step_budget(spark.createDataFrame([(10,)], "n long"), "n", 2, 4, iters=9).first()["iters"] == 9
    lines = spark.createDataFrame([("a",), ("  ",), ("",), ("b ",)], "value string")
    assert audits.sample_count(lines).first()[0] == 2
    listing = spark.createDataFrame(
        [("a", "a/x.jsonl/part-0"), ("a", "a/x.jsonl/part-1"), ("b", "b/x.jsonl"), ("b", "b/y.jsonl"), ("c", "c/x.yaml")],
        "batch_name string, key string",
    )
    assert audits.require_single_file(listing, ["a"]) == {"a": "a/x.jsonl"}
    for name in ("b", "c", "missing"):
        with pytest.raises(ValueError, match=name):
            audits.require_single_file(listing, ["a", name])
    with pytest.raises(ValueError):
        audits.require_non_empty(ok.limit(0))


def shaky():
    def complete(request: Completion):
        if request.user == "limit":
            raise RateLimited("slow down")
        if request.user == "boom":
            raise KeyError("x")
        return None if request.user == "none" else f"{request.system}:{request.user}"

    return complete


def test_infer(spark):
    df = spark.createDataFrame([(2**60 + i, t) for i, t in enumerate(["a", "none", "boom", "limit"])] + [(None, "b")], "id long, content string")
    retry = Retry(retries=2, sleep=lambda s: None)
    rows = {r["content"]: r for r in infer(df, shaky, "s", retry=retry, partitions=3, threads=2).collect()}
    assert rows["a"]["reply"] == "s:a" and rows["a"]["id"] == 2**60 and rows["b"]["id"] is None
    assert rows["none"]["error"] == "no reply" and rows["boom"]["error"].startswith("KeyError")
    assert (rows["limit"]["attempts"], rows["limit"]["reply"]) == (3, None) and "RateLimited" in rows["limit"]["error"]


def test_retry_backs_off_and_gives_up():
    waits, calls = [], []

    def complete(request):
        calls.append(1)
        if len(calls) < 4:
            raise RateLimited()
        return "ok"

    policy = Retry(sleep=waits.append, uniform=lambda low, high: high)
    assert with_retry(complete, policy)(Completion(None, "u")) == "ok" and waits == [1, 2, 4]
    with pytest.raises(RateLimited):
        policy.call(lambda r: (_ for _ in ()).throw(RateLimited()), Completion(None, "u"))
    assert len(waits) == 3 + 5 and Retry(max_delay=3, sleep=waits.append, uniform=lambda low, high: high).max_delay == 3
    assert Completion("s", "u").messages[0]["role"] == "system" and len(Completion(None, "u").messages) == 1
