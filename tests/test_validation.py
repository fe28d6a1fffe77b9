import json
import math
from enum import Enum
from typing import List, Optional

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pydantic import BaseModel, Field as Limit, ValidationError
from pyspark.sql import functions as F

from quillforge.functions import validation
from quillforge.functions.payload import strict_object
from quillforge.functions.validation import validate
from quillforge.schema import AnyObject, Boolean, Choice, Field, Integer, Items, Number, PayloadSchema, Record, Text
from quillforge.schema import get_schema, register_schema, self_check
from quillforge.schema.samples import ENTITY, EVENT, REPORT


def check(spark, texts, kind):
    """(is_valid, normalised, errors) per text."""
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").withColumn("p", strict_object(F.col("t")))
    out = validate(df, "p", kind).orderBy("i").select(
        "is_valid", F.to_json("output", {"ignoreNullFields": "false"}).alias("o"), "errors"
    )
    return [(r["is_valid"], r["o"] and json.loads(r["o"]), [(e["path"], e["code"]) for e in r["errors"]]) for r in out.collect()]


class Colour(str, Enum):
    RED = "red"
    BLUE = "blue"


class Part(BaseModel):
    name: str
    size: Optional[float]
    tags: List[str] = Limit(default_factory=list, max_length=2)
    colours: List[Colour] = []


class Whole(BaseModel):
    n: int = Limit(ge=-5, le=2100)
    x: float = Limit(ge=0)
    flag: bool
    colour: Colour
    maybe: Optional[int] = None
    part: Optional[Part]
    parts: List[Part] = []


PART = Record(
    Field("name", Text()),
    Field("size", Number(), nullable=True),
    Field("tags", Items(Text(), max_length=2), default=[]),
    Field("colours", Items(Choice("red", "blue")), default=[]),
)
WHOLE = Record(
    Field("n", Integer(ge=-5, le=2100)),
    Field("x", Number(ge=0)),
    Field("flag", Boolean()),
    Field("colour", Choice("red", "blue")),
    Field("maybe", Integer(), nullable=True, default=None),
    Field("part", PART, nullable=True),
    Field("parts", Items(PART), default=[]),
)

SCALARS = st.sampled_from(
    [None, True, False, 0, 1, 2, -5, 2100, 2101, 5.0, 5.5, 1.0, 0.5, 1e3, -1.5, "", "5", " 5 ", "5.0", "5.", "+5", "-5", "1_000",
     "1__0", "x", "1e3", ".5", "nan", "-inf", "true", "T", "Yes", "off", "1", "0", " true ", "red", "RED", "blue", [], {}, ["a"]]
)


def _mostly(good, rate=4):
    return st.one_of(*[good] * rate, SCALARS)


def _drop(members):
    return st.fixed_dictionaries({}, optional=members) | st.fixed_dictionaries(members)


PARTS = _drop(
    {
        "name": _mostly(st.text("ab é", max_size=3)),
        "size": _mostly(st.none() | st.floats(-9, 9).map(lambda v: round(v, 3))),
        "tags": _mostly(st.lists(_mostly(st.sampled_from(["a", "b"]), 9), max_size=3)),
        "colours": _mostly(st.lists(st.sampled_from(["red", "blue", "green"]), max_size=2)),
    }
)
WHOLES = _drop(
    {
        "n": _mostly(st.integers(-9, 2200)),
        "x": _mostly(st.floats(0, 99).map(lambda v: round(v, 3))),
        "flag": _mostly(st.booleans()),
        "colour": _mostly(st.sampled_from(["red", "blue"])),
        "maybe": _mostly(st.integers() .filter(lambda v: abs(v) < 2**62)),
        "part": _mostly(PARTS | st.none()),
        "parts": _mostly(st.lists(_mostly(PARTS), max_size=2)),
        "extra": SCALARS,
    }
)


def _same(a, b):
    if isinstance(a, dict) and isinstance(b, dict):
        return a.keys() == b.keys() and all(_same(a[k], b[k]) for k in a)
    if isinstance(a, list) and isinstance(b, list):
        return len(a) == len(b) and all(map(_same, a, b))
    if isinstance(a, float) or isinstance(b, float):
        special = {"NaN": math.nan, "Infinity": math.inf, "-Infinity": -math.inf}
        a, b = special.get(a, a), special.get(b, b)
        return (a == b) or (isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b))
    return a == b


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(WHOLES, min_size=150, max_size=150))
def test_agrees_with_a_lax_data_class_validator(spark, payloads):
    for payload, (valid, output, errors) in zip(payloads, check(spark, [json.dumps(p) for p in payloads], WHOLE)):
        try:
            expected = Whole.model_validate(payload).model_dump()
            expected = {k: v.value if isinstance(v, Enum) else v for k, v in expected.items()}
            for part in [p for p in [expected["part"], *expected["parts"]] if p]:
                part["colours"] = [c.value for c in part["colours"]]
            assert valid and _same(output, expected), (payload, output, expected, errors)
        except ValidationError as failure:
            assert not valid, payload
            places = {
                "".join(f"[{p}]" if isinstance(p, int) else f".{p}" for p in e["loc"]).lstrip(".") for e in failure.errors()
            }
            assert {path for path, _ in errors} == places, (payload, errors, places)


@pytest.mark.parametrize("value, ok", [("5", 1), (" 5 ", 1), (5.0, 1), ("5.0", 1), (True, 1), (5.5, 0), ("x", 0), (None, 0), (2**70, 0)])
def test_integer(spark, value, ok):
    assert check(spark, [json.dumps({"v": value})], Record(Field("v", Integer())))[0][0] == bool(ok)


def test_missing_null_default(spark):
    kind = Record(Field("a", Items(Text()), default=[]), Field("b", Text(), nullable=True), Field("c", Text(), default="z"))
    texts = ['{"b":null}', '{"a":null,"b":"x"}', "{}", '{"b":"y","c":null}', '{"b":"y","q":1}']
    assert [r[2] for r in check(spark, texts, kind)] == [[], [("a", "null")], [("b", "missing")], [("c", "null")], []]
    assert check(spark, texts, kind)[0][1] == {"a": [], "b": None, "c": "z"}
    assert check(spark, texts, kind)[4][1] == {"a": [], "b": "y", "c": "z"}


def test_unknown_members_can_be_forbidden(spark):
    inner = Record(Field("a", Integer()), forbid_unknown=True)
    kind = Record(Field("r", inner), forbid_unknown=True)
    got = check(spark, ['{"r":{"a":1}}', '{"r":{"a":1,"b":2},"c":3}'], kind)
    assert got[0][2] == [] and sorted(got[1][2]) == [("c", "unknown"), ("r.b", "unknown")]


def test_case_folding_only_touches_own_plain_choices(spark):
    texts = [
        '{"status":"FINAL","finding":{"grade":"High","size":null}}',
        '{"status":"final","finding":{"grade":7,"size":1}}',
    ]
    good, bad = check(spark, texts, REPORT.root)
    assert good[1]["status"] == "final" and good[1]["finding"] == {"grade": "high", "size": None}
    assert bad[2] == [("finding.grade", "type")]
    folded = Record(Field("c", Choice("a"), nullable=True), Field("l", Items(Choice("a"))), fold_choices=True)
    assert check(spark, ['{"c":"A","l":["A"]}'], folded)[0][2] == [("c", "domain"), ("l[0]", "domain")]


def test_free_form_object_and_nested_lists(spark):
    kind = Record(Field("o", AnyObject()), Field("m", Items(Items(Integer(), max_length=1))))
    got = check(spark, ['{"o":{"k":[1]},"m":[[1],[2]]}', '{"o":[1],"m":[[1,2],["x"]]}'], kind)
    assert json.loads(got[0][1]["o"]) == {"k": [1]} and got[0][1]["m"] == [[1], [2]]
    assert got[1][2] == [("o", "type"), ("m[0]", "too_long"), ("m[1][0]", "type")]


def test_big_vocabulary(spark):
    kind = Record(Field("e", Choice(*[f"term {i}" for i in range(900)])))
    assert [r[0] for r in check(spark, ['{"e":"term 899"}', '{"e":"term 900"}'], kind)] == [True, False]


def test_registry_and_self_check(spark):
    for schema in (EVENT, ENTITY, REPORT):
        self_check(spark, schema)
    bad = PayloadSchema("bad", "1.0.0", Record(Field("a", Integer())), example={"a": "x"})
    with pytest.raises(ValueError):
        register_schema(bad, spark)
    assert get_schema("event_payload") is EVENT and EVENT.version_token == "1_2_0"
    with pytest.raises(KeyError):
        get_schema("bad")


def test_plan_has_no_shuffle_and_no_python(spark):
    df = spark.createDataFrame([("{}",)], "t string").withColumn("p", strict_object(F.col("t")))
    plan = validate(df, "p", WHOLE).filter("is_valid")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    # a filter must not repeat the validation
    assert plan.count("from_json") <= 2


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(WHOLES, min_size=150, max_size=150))
def test_cast_and_stages_agree(spark, payloads):
    """The same payloads by the cast, where it conforms, and by the stages alone: errors, their order, and values."""
    texts = [json.dumps(p) for p in payloads]
    kinds = [PART, WHOLE, Record(*[f for f in WHOLE.fields if f.name != "parts"], forbid_unknown=True)]
    for kind in kinds:
        with_cast = check(spark, texts, kind)
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(validation, "_cast", lambda kind: None)
            assert str(check(spark, texts, kind)) == str(with_cast)


def test_what_the_cast_takes(spark):
    one = Record(Field("a", Text()), Field("n", Number(ge=0)), Field("z", Integer(), nullable=True, default=None), Field("l", Items(Choice("x", ignore_case=True)), default=["x"]))
    cast = validation._cast(one)
    assert cast.ddl == "struct<`a`: string, `l`: array<string>, `n`: variant, `z`: bigint>" and cast.silent == ("z",)
    assert validation._cast(Items(Text())) is None and validation._cast(Record(Field("r", Items(one)))) is None
    assert validation._cast(Record(Field("o", AnyObject()))) is None and validation._cast(Record()) is None
    texts = ['{"a":"1","n":2}', '{"n":2.50,"z":null,"a":"","l":["X","y"]}', '{"a":1,"n":2}', '{"a":"1","n":"2"}', '{"a":"1","n":2,"b":0}', '{"a":null,"n":2}', '{"n":-1}']
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(F.parse_json("t").alias("p"))
    fits = rows.select(cast.conforms(F.col("p"), F.try_variant_get("p", "$", cast.ddl))).collect()
    assert [r[0] for r in fits] == [True, True, False, False, False, False, True]
