import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillforge.functions import payload as P
from quillforge.functions.text import strip_ws
from quillforge.operators.routing import extract_replies
from quillforge.schema import Field, Integer, PayloadSchema, Record
from quillforge.schema.samples import ONE_FIELD

LADDER = [
    ('<output>{"field":"a"}</output>', "valid", {"field": "a"}),
    ('<output>{"qux":"a"}</output> {"field":"b"}', "schema_invalid", {"qux": "a"}),
    ('{"field":"a"}', "valid", {"field": "a"}),
    ('corge {"field":"a"} grault', "valid", {"field": "a"}),
    ('[{"field":"a"}]', "valid", {"field": "a"}),
    ('<output>junk</output>\n{"field":"b"}', "valid", {"field": "b"}),
    ("<output>{}</output>", "no_json", None),
    ('{"field":"a"} trailing', "valid", {"field": "a"}),
    ('<OUTPUT>{"qux":1}</OUTPUT>', "schema_invalid", {"qux": 1}),
    ('{"field":5}', "schema_invalid", {"field": 5}),
    ("foobar", "no_json", None),
    ("}{", "no_json", None),
    ("{'field':'a'}", "no_json", None),
    ('{"field":"a","field":"b"}', "valid", {"field": "b"}),
    ('<output>\n{"field":"a","x":NaN}</output>', "valid", None),
    ('<output>a <output>{"field":"x"}</output>', "valid", {"field": "x"}),
    (None, "error", None),
]


def test_ladder(spark):
    df = spark.createDataFrame([(i, r) for i, (r, _, _) in enumerate(LADDER)], "i int, reply string")
    for row in extract_replies(df, ONE_FIELD).orderBy("i").collect():
        _, status, payload = LADDER[row["i"]]
        assert row["status"] == status, row
        if payload is not None:
            assert json.loads(row["payload"]) == payload
        if status == "valid" and payload is not None:
            assert row["output"].asDict() == payload


def test_empty_object_counts_if_the_schema_accepts_it(spark):
    optional = PayloadSchema("optional", "1.0.0", Record(Field("n", Integer(), default=3)))
    df = spark.createDataFrame([('<output>{ }</output> {"n": 4}',)], "reply string")
    row = extract_replies(df, optional).first()
    assert (row["status"], row["output"]["n"]) == ("valid", 3)


TEXTS = [
    '{"a":1}', '{"a":1} junk', '{"a":1}}', '{"a":1},"x":2', '{"a":1},1', '{"a":1}],[2', ' {"a":1}\n', "[1]", "1", '"x"', "null",
    '{"a":01}', '{"a":.5}', '{"a":+1}', '{"a":1,}', "{a:1}", '{"a":"x\ty"}', '{"a":"\\q"}', '/*c*/{"a":1}', '{"a":INF}',
    '{"a":NaN}', '{"a":-Infinity}', '{"a":"NaN"}', '{"a":1}\x00', "\ufeff{}", "{}", "{", "", " ", '{"a":{"b":[1,{"c":null}]}}',
]


def _is_object(text):
    try:
        return isinstance(json.loads(text), dict)
    except ValueError:
        return False


def _objects(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = df.select("i", P.strict_object(F.col("t")).isNotNull().alias("ok")).collect()
    return {texts[r["i"]]: r["ok"] for r in got}


def test_strict_object_agrees_with_json_loads(spark):
    assert _objects(spark, TEXTS) == {t: _is_object(t) for t in TEXTS}


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.builds(
            lambda a, b, c: a + b + c,
            st.sampled_from(["", " ", "[", '{"k":', "x"]),
            st.recursive(
                st.none() | st.booleans() | st.integers(-99, 99) | st.text("ab\"\\{}[]:,é\n", max_size=4),
                lambda inner: st.lists(inner, max_size=2) | st.dictionaries(st.text("ab", max_size=2), inner, max_size=2),
                max_leaves=5,
            ).map(json.dumps),
            st.sampled_from(["", "\n", "]", "}", ",1", "],[1", " x"]),
        ),
        min_size=60,
        max_size=60,
    )
)
def test_strict_object_on_generated_texts(spark, texts):
    assert _objects(spark, texts) == {t: _is_object(t) for t in texts}


def test_strip_is_the_unicode_one(spark):
    texts = ["\x1c a\u2003", "\u3000b \x85", " \n\t", "c d", "", "\u200bx\u200b"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    assert [r[0] for r in df.orderBy("i").select(strip_ws(F.col("t"))).collect()] == [t.strip() for t in texts]


def test_tagged_or_all(spark):
    df = spark.createDataFrame([("x <output> ab </output>",), (" none ",)], "t string")
    found, missed = [r[0] for r in df.select(P.tagged_or_all(F.col("t"))).collect()]
    assert (found["found"], found["content"]) == (True, "ab") and "length=2 " in found["message"]
    assert (missed["found"], missed["content"]) == (False, "none")
