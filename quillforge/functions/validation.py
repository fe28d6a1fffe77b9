"""Schema validation and normalisation as Spark expressions over a VARIANT payload.

The rules are those of a lax data-class validator: numbers may come as text,
integers as integral floats, booleans as words, but text only as text; unknown
members are ignored unless forbidden; missing and null are different things.

A schema tree is compiled once into stages of columns, each reading only the
columns of the stages before:

1. the raw value of every declared member, by path;
2. its JSON type;
3. its text, if it is a scalar;
4. its coerced value;
5. its error code;
6. the list of errors and the normalised struct.

At the top level the stages are ordinary projections, so every intermediate
value is computed once and the whole chain stays in one code-generated stage.
For array elements the same stages are chained ``transform`` calls. Nothing is
shuffled and no Python runs.

Most payloads need none of this. A record of scalars (and of records and arrays of
scalars) is first cast as a whole to its declared struct; if the struct, written
as JSON, is the text of the payload, every member has its declared type and only
bounds are left to check. The stages are for the rest: at the top level their
raw values are null where the cast conforms, in arrays they are not evaluated.
Payloads are JSON: a VARIANT of dates or binaries is not told from one of texts.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillforge.functions.text import fence, let, strip_ws
from quillforge.schema.kinds import (
    AnyObject,
    Boolean,
    Choice,
    Field,
    Integer,
    Items,
    Kind,
    Number,
    Record,
    Text,
)

ERRORS_TYPE = "array<struct<path:string,code:string>>"

# Error codes
MISSING, NULL, TYPE, DOMAIN, RANGE, TOO_LONG, UNKNOWN = (
    "missing",
    "null",
    "type",
    "domain",
    "range",
    "too_long",
    "unknown",
)

# The words a lax boolean accepts.
TRUE_WORDS = ("true", "t", "yes", "y", "on", "1")
FALSE_WORDS = ("false", "f", "no", "n", "off", "0")

_INT_TEXT = r"^[+-]?[0-9]+(_[0-9]+)*(\.0+)?\z"
_FLOAT_TEXT = r"(?i)^[+-]?(nan|inf|infinity|([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?)\z"
_BAD_UNDERSCORE = r"^_|_\z|__"


@dataclass
class _Node:
    """One declared member (or the value itself, with an empty path)."""

    key: str
    path: tuple[str, ...]
    kind: Kind
    nullable: bool
    required: bool
    default: object
    fold: bool = False
    children: list[_Node] = field(default_factory=list)

    @property
    def dotted(self) -> str:
        return ".".join(self.path)

    def walk(self) -> list[_Node]:
        return [self] + [n for child in self.children for n in child.walk()]


def _tree(kind: Kind) -> _Node:
    counter = iter(range(1_000_000))

    def build(f: Field, path: tuple[str, ...], fold: bool) -> _Node:
        node = _Node(f"n{next(counter)}", path, f.kind, f.nullable, f.required, f.default, fold)
        if isinstance(f.kind, Record):
            for member in f.kind.fields:
                folds = f.kind.fold_choices and isinstance(member.kind, Choice) and not member.nullable
                node.children.append(build(member, (*path, member.name), folds))
        return node

    return build(Field("value", kind), (), False)


Get = Callable[[str], Column]


def _get_path(value: Column, path: tuple[str, ...]) -> Column:
    return F.try_variant_get(value, "$" + "".join(f'["{part}"]' for part in path), "variant")


def _raw_stage(root: _Node, value: Column) -> dict[str, Column]:
    return {f"{n.key}_x": _get_path(value, n.path) if n.path else value for n in root.walk()}


def _type_stage(root: _Node, get: Get) -> dict[str, Column]:
    out: dict[str, Column] = {}
    for n in root.walk():
        x = get(f"{n.key}_x")
        if isinstance(n.kind, Items):
            out[f"{n.key}_a"] = F.try_variant_get(x, "$", "array<variant>")
            out[f"{n.key}_t"] = F.when(F.is_variant_null(x), "VOID")
        elif isinstance(n.kind, (Record, AnyObject)):
            # Member names via a map: describing the type of an object would walk all of it.
            out[f"{n.key}_k"] = F.map_keys(F.try_variant_get(x, "$", "map<string,variant>"))
            out[f"{n.key}_t"] = F.when(F.is_variant_null(x), "VOID")
        else:
            out[f"{n.key}_t"] = F.schema_of_variant(x)
    return out


def _word_stage(root: _Node, get: Get) -> dict[str, Column]:
    """Text of every scalar member: strings as they are (stripped where a number is meant), numbers and booleans as written.

    Casting a VARIANT to a number builds a cast per value; casting its text is compiled code.
    """
    out: dict[str, Column] = {}
    for n in root.walk():
        if isinstance(n.kind, (Items, Record, AnyObject)):
            continue
        x, t = get(f"{n.key}_x"), get(f"{n.key}_t")
        text = F.try_variant_get(x, "$", "string")
        if isinstance(n.kind, (Text, Choice)):
            out[f"{n.key}_w"] = F.when(t == "STRING", text)
        else:
            if not isinstance(n.kind, Boolean):
                text = strip_ws(text)
            out[f"{n.key}_w"] = F.when(t == "STRING", text).when(_is_number(t) | (t == "BOOLEAN"), F.to_json(x))
    return out


def _is_number(t: Column) -> Column:
    return t.isin("BIGINT", "DOUBLE", "FLOAT") | F.startswith(t, F.lit("DECIMAL"))


def _integer(t: Column, w: Column) -> Column:
    number = w.try_cast("double")
    integral = (number == F.floor(number)) & (F.abs(number) < F.lit(2.0**63))
    digits = F.regexp_replace(w, r"_|\.0+\z", "")
    return (
        F.when(t == "BIGINT", w.try_cast("bigint"))
        .when(t == "BOOLEAN", (w == "true").cast("bigint"))
        .when(t == "STRING", F.when(w.rlike(_INT_TEXT), digits.try_cast("bigint")))
        .when(integral, number.try_cast("bigint"))
    )


def _double(x: Column, t: Column, w: Column) -> Column:
    digits = F.replace(w, F.lit("_"), F.lit(""))
    parsed = F.when(F.contains(F.lower(digits), F.lit("nan")), F.lit(float("nan"))).otherwise(
        digits.try_cast("double")
    )
    return (
        F.when(t == "STRING", F.when(~w.rlike(_BAD_UNDERSCORE) & digits.rlike(_FLOAT_TEXT), parsed))
        .when(t == "BOOLEAN", (w == "true").cast("double"))
        .when(t == "DOUBLE", F.try_variant_get(x, "$", "double"))
        .otherwise(w.try_cast("double"))
    )


def _boolean(t: Column, w: Column) -> Column:
    word = F.lower(w)
    number = w.try_cast("double")
    return (
        F.when(t == "BOOLEAN", w == "true")
        .when(t == "STRING", F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False))
        .when(number == 1.0, True)
        .when(number == 0.0, False)
    )


def _coerced(n: _Node, x: Column, t: Column, w: Column) -> Column:
    if isinstance(n.kind, Integer):
        return _integer(t, w)
    if isinstance(n.kind, Number):
        return _double(x, t, w)
    if isinstance(n.kind, Boolean):
        return _boolean(t, w)
    if isinstance(n.kind, Choice) and (n.fold or n.kind.ignore_case):
        return F.lower(w)
    return w


def _scalar_code(n: _Node, value: Column) -> Column:
    code = F.when(value.isNull(), TYPE)
    if isinstance(n.kind, (Integer, Number)):
        outside = F.lit(False)
        if n.kind.ge is not None:
            outside = outside | (value < F.lit(n.kind.ge))
        if n.kind.le is not None:
            outside = outside | (value > F.lit(n.kind.le))
        if isinstance(n.kind, Number) and (n.kind.ge, n.kind.le) != (None, None):
            outside = outside | F.isnan(value)
        code = code.when(outside, RANGE)
    elif isinstance(n.kind, Choice):
        code = code.when(~value.isin(*n.kind.values), DOMAIN)
    return code


def _empty_errors() -> Column:
    return F.array().cast(ERRORS_TYPE)


def _error(path: Column | str, code: Column | str) -> Column:
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.struct(as_col(path).alias("path"), as_col(code).alias("code"))


@dataclass(frozen=True)
class _Cast:
    """A kind that is cast as a whole: its nodes, the type of the cast, and the members whose null is as good as their absence."""

    root: _Node
    ddl: str
    silent: tuple[str, ...]

    def text(self, value: Column) -> Column:
        """The payload as JSON, without the nulls of silent members."""
        text = F.to_json(value)
        for name in self.silent:
            for pattern in (f',"{name}":null', f'"{name}":null,', f'"{name}":null'):
                text = F.replace(text, F.lit(pattern), F.lit(""))
        return text

    def conforms(self, value: Column, typed: Column) -> Column:
        """Whether the cast lost nothing, and every number that is kept as it was is one."""
        same = F.to_json(typed) == self.text(value)
        for n in self.root.walk():
            own = _member(typed, n)
            if isinstance(n.kind, Number):
                same = same & (own.isNull() | _is_number(F.schema_of_variant(own)))
            elif isinstance(n.kind, Items):
                same = same & (own.isNull() | ~F.exists(own, lambda x: x.isNull()))
        return F.coalesce(same, F.lit(False))

    def checked(self, typed: Column) -> tuple[Column, Column]:
        """(errors, value) of a cast that conforms, in which an absent member is a null. Errors are put together only if there is one."""
        wrong, listed = _cast_errors(self.root, typed)
        errors = F.when(wrong, listed).otherwise(_empty_errors()) if wrong is not None else _empty_errors()
        return errors, _cast_value(self.root, typed)


def _member(typed: Column, n: _Node) -> Column:
    for part in n.path:
        typed = typed.getField(part)
    return typed


def _folded(n: _Node, value: Column) -> Column:
    return F.lower(value) if isinstance(n.kind, Choice) and (n.fold or n.kind.ignore_case) else value


def _outside(n: _Node, value: Column) -> list[tuple[Column, str]]:
    """What of a value of the declared type, not null, can still be wrong, each with its code."""
    kind = n.kind
    if isinstance(kind, Choice):
        return [(~_folded(n, value).isin(*kind.values), DOMAIN)]
    if isinstance(kind, Items) and kind.max_length is not None:
        return [(F.size(value) > kind.max_length, TOO_LONG)]
    if not isinstance(kind, (Integer, Number)) or (kind.ge, kind.le) == (None, None):
        return []
    number = F.try_variant_get(value, "$", "double") if isinstance(kind, Number) else value
    inside = F.lit(True) if isinstance(kind, Integer) else ~F.isnan(number)
    if kind.ge is not None:
        inside = inside & (number >= F.lit(kind.ge))
    if kind.le is not None:
        inside = inside & (number <= F.lit(kind.le))
    return [(~inside, RANGE)]


def _any(tests: list[Column]) -> Column | None:
    return reduce(or_, tests) if tests else None


def _cast_errors(n: _Node, typed: Column) -> tuple[Column | None, Column]:
    """(whether anything is wrong at or below a node that is there, the errors then). None: nothing can be."""

    def own(c: _Node) -> list[tuple[Column, str]]:
        value = _member(typed, c)
        absent = [(value.isNull(), MISSING)] if c.required else []
        return absent + [(value.isNotNull() & F.coalesce(test, F.lit(False)), code) for test, code in _outside(c, value)]

    def error(c: _Node) -> Column | None:
        found = None
        for test, code in own(c):
            found = F.when(test, _error(c.dotted, code)) if found is None else found.when(test, _error(c.dotted, code))
        return found

    def inner(c: _Node) -> tuple[Column | None, Column]:
        value = _member(typed, c)
        if isinstance(c.kind, Record):
            wrong, listed = _cast_errors(c, typed)
            return (None if wrong is None else value.isNotNull() & wrong), listed
        element = _tree(c.kind.element)
        tests = _outside(element, F.lit(None).cast("string"))
        if not tests:
            return None, _empty_errors()
        bad = lambda x: _outside(element, x)[0][0]
        at = lambda x, i: F.when(bad(x), _error(F.concat(F.lit(f"{c.dotted}["), i.cast("string"), F.lit("]")), tests[0][1]))
        return value.isNotNull() & F.exists(value, bad), F.array_compact(F.transform(value, at))

    leaves = [c for c in n.children if not isinstance(c.kind, (Items, Record))]
    tests = [test for c in n.children for test, _ in own(c)]
    found = [e for c in leaves if (e := error(c)) is not None]
    groups = [F.array_compact(F.array(*found))] if found else []
    for c in n.children:
        if c in leaves:
            continue
        wrong, listed = inner(c)
        if wrong is not None:
            tests.append(wrong)
            listed = F.when(wrong, listed).otherwise(_empty_errors())
        at_node = error(c)
        if at_node is not None:
            listed = F.coalesce(F.when(at_node.isNotNull(), F.array(at_node)), listed)
        if at_node is not None or wrong is not None:
            groups.append(listed)
    return _any(tests), F.concat(*groups) if len(groups) > 1 else groups[0] if groups else _empty_errors()


def _cast_value(n: _Node, typed: Column) -> Column:
    """Normalised value of a node of a cast that conforms."""
    value = _member(typed, n)
    if isinstance(n.kind, Number):
        value = F.try_variant_get(value, "$", "double")
    elif isinstance(n.kind, Items) and isinstance(n.kind.element, Choice):
        element = _tree(n.kind.element)
        value = F.transform(value, lambda x: _folded(element, x)) if n.kind.element.ignore_case else value
    elif isinstance(n.kind, Record):
        members = F.struct(*[_cast_value(c, typed).alias(c.path[-1]) for c in n.children])
        value = F.when(value.isNotNull(), members) if n.path else members
    else:
        value = _folded(n, value)
    return value if n.required or n.default is None else F.coalesce(value, _default(n))


def _cast(kind: Kind) -> _Cast | None:
    """How the kind is cast as a whole; None for kinds that are not records, or hold more than scalars and arrays of them."""
    scalars = {Text: "string", Choice: "string", Integer: "bigint", Boolean: "boolean"}

    def ddl(k: Kind) -> str | None:
        if isinstance(k, Number):
            return "variant"
        if isinstance(k, Items):
            inner = scalars.get(type(k.element))
            return inner and f"array<{inner}>"
        if not isinstance(k, Record):
            return scalars.get(type(k))
        # A payload's text has its members in the order of their names.
        members = [(f.name, ddl(f.kind)) for f in sorted(k.fields, key=lambda f: f.name)]
        if not members or any(t is None or "`" in name for name, t in members):
            return None
        return f"struct<{', '.join(f'`{name}`: {t}' for name, t in members)}>"

    declared = ddl(kind) if isinstance(kind, Record) else None
    if declared is None:
        return None
    root = _tree(kind)
    silent: dict[str, bool] = {}
    for n in root.walk()[1:]:
        own = n.nullable and not n.required and n.default is None
        silent[n.path[-1]] = silent.get(n.path[-1], True) and own
    return _Cast(root, declared, tuple(name for name, own in silent.items() if own))


def _element_stage(kind: Kind, elements: Column) -> Column:
    """``array<struct<errors,value>>`` of the elements: by the cast where it conforms, else by the stages."""
    cast = _cast(kind)
    if cast is None:
        return _element_stages(kind, elements)

    def fast(t: Column) -> Column:
        errors, value = cast.checked(t)
        return F.struct(errors.alias("errors"), value.alias("value"))

    def checked(e: Column) -> Column:
        typed = F.try_variant_get(e, "$", cast.ddl)
        return let(typed, lambda t: F.when(cast.conforms(e, t), fast(t)).otherwise(F.get(_element_stages(kind, F.array(e)), F.lit(0))))

    return F.transform(elements, checked)


def _element_stages(kind: Kind, elements: Column) -> Column:
    """``array<struct<errors,value>>`` of the elements by the stages, error paths relative to the element."""
    root = _tree(kind)

    def fields(columns: dict[str, Column]) -> Column:
        return F.struct(*[c.alias(name) for name, c in columns.items()])

    raw = F.transform(elements, lambda x: fields(_raw_stage(root, x)))

    def with_types(s: Column) -> Column:
        get = s.getField
        return fields({**{k: get(k) for k in _raw_names(root)}, **_type_stage(root, get)})

    def with_words(s: Column) -> Column:
        get = s.getField
        kept = [*_raw_names(root), *_type_stage(root, get)]
        return fields({**{k: get(k) for k in kept}, **_word_stage(root, get)})

    typed = F.transform(raw, with_types)
    worded = F.transform(typed, with_words)
    coerced = F.transform(worded, lambda s: fields(_value_stage(root, s.getField)))
    coded = F.transform(coerced, lambda s: fields({**_passed(root, s.getField), **_code_stage(root, s.getField)}))
    return F.transform(
        coded, lambda s: F.struct(_errors(root, s.getField).alias("errors"), _value(root, s.getField).alias("value"))
    )


def _raw_names(root: _Node) -> list[str]:
    return [f"{n.key}_x" for n in root.walk()]


def _value_stage(root: _Node, get: Get) -> dict[str, Column]:
    """Coerced value of every member, and ``_s``: 'missing', 'null' or null when there is a value."""
    out: dict[str, Column] = {}
    for n in root.walk():
        x, t = get(f"{n.key}_x"), get(f"{n.key}_t")
        out[f"{n.key}_s"] = F.when(x.isNull(), MISSING).when(t == "VOID", NULL)
        if isinstance(n.kind, Items):
            elements = get(f"{n.key}_a")
            out[f"{n.key}_v"] = _element_stage(n.kind.element, elements)
        elif isinstance(n.kind, AnyObject):
            out[f"{n.key}_v"] = F.when(get(f"{n.key}_k").isNotNull(), F.to_json(x))
        elif isinstance(n.kind, Record):
            out[f"{n.key}_v"] = get(f"{n.key}_k")
        else:
            out[f"{n.key}_v"] = _coerced(n, x, t, get(f"{n.key}_w"))
    return out


def _passed(root: _Node, get: Get) -> dict[str, Column]:
    return {f"{n.key}_{part}": get(f"{n.key}_{part}") for n in root.walk() for part in ("s", "v")}


def _code_stage(root: _Node, get: Get) -> dict[str, Column]:
    """Error code of every member itself (not of what it contains)."""
    out: dict[str, Column] = {}
    for n in root.walk():
        s, v = get(f"{n.key}_s"), get(f"{n.key}_v")
        if isinstance(n.kind, (Items, Record, AnyObject)):
            own = F.when(v.isNull(), TYPE)
            if isinstance(n.kind, Items) and n.kind.max_length is not None:
                own = own.when(F.size(v) > n.kind.max_length, TOO_LONG)
        else:
            own = _scalar_code(n, v)
        missing = F.lit(MISSING if n.required else None).cast("string")
        null = F.lit(None if n.nullable else NULL).cast("string")
        out[f"{n.key}_c"] = F.when(s == MISSING, missing).when(s == NULL, null).otherwise(own)
    return out


def _own_error(n: _Node, get: Get) -> Column:
    code = get(f"{n.key}_c")
    return F.when(code.isNotNull(), _error(n.dotted, code))


def _indexed(n: _Node, chunks: Column) -> Column:
    """Errors of array elements with their position put in front of the element-relative path."""

    def place(err: Column, i: Column) -> Column:
        joint = F.when((err["path"] == "") | F.startswith(err["path"], F.lit("[")), "]").otherwise("].")
        return _error(F.concat(F.lit(f"{n.dotted}["), i.cast("string"), joint, err["path"]), err["code"])

    return F.flatten(F.transform(chunks, lambda e, i: F.transform(e["errors"], lambda err: place(err, i))))


def _errors(n: _Node, get: Get) -> Column:
    """All errors at or below a node. Contents are looked at only if the node itself is sound."""
    own = F.array_compact(F.array(_own_error(n, get)))
    if isinstance(n.kind, Items):
        inner = _indexed(n, get(f"{n.key}_v"))
    elif isinstance(n.kind, Record):
        leaves = [c for c in n.children if not isinstance(c.kind, (Items, Record))]
        groups = []
        if leaves:
            groups.append(F.array_compact(F.array(*[_own_error(c, get) for c in leaves])))
        groups += [_errors(c, get) for c in n.children if c not in leaves]
        if n.kind.forbid_unknown:
            declared = F.array(*[F.lit(c.path[-1]) for c in n.children]).cast("array<string>")
            base = n.dotted + "." if n.path else ""
            extra = F.array_except(get(f"{n.key}_v"), declared)
            groups.append(F.transform(extra, lambda k: _error(F.concat(F.lit(base), k), UNKNOWN)))
        inner = F.concat(*groups) if groups else _empty_errors()
    else:
        return own
    sound = get(f"{n.key}_s").isNull() & get(f"{n.key}_c").isNull()
    return F.when(sound, inner).otherwise(own)


def _default(n: _Node) -> Column:
    spark_type = n.kind.spark_type()
    if n.required or n.default is None:
        return F.lit(None).cast(spark_type)
    if isinstance(n.kind, AnyObject):
        return F.lit(json.dumps(n.default))
    if isinstance(n.kind, (Items, Record)):
        return F.from_json(F.lit(json.dumps(n.default)), spark_type)
    return F.lit(n.default).cast(spark_type)


def _value(n: _Node, get: Get) -> Column:
    """Normalised value of a node: coerced, defaulted, declared members only."""
    v, s = get(f"{n.key}_v"), get(f"{n.key}_s")
    if isinstance(n.kind, Items):
        v = v["value"]
    elif isinstance(n.kind, Record):
        v = F.struct(*[_value(c, get).alias(c.path[-1]) for c in n.children])
    null = F.lit(None).cast(n.kind.spark_type())
    return F.when(s == MISSING, _default(n)).when(s == NULL, null).otherwise(v)


def validate(
    df: DataFrame,
    payload: str,
    kind: Kind,
    errors: str = "errors",
    output: str = "output",
    is_valid: str = "is_valid",
) -> DataFrame:
    """Add ``errors`` (array of path and code), ``is_valid`` and the normalised ``output``.

    ``payload`` names a VARIANT column. A SQL null payload is reported as a
    missing value; ``output`` is null for invalid rows.
    """
    root = _tree(kind)
    get = lambda name: F.col(f"__{name}")
    temporary: list[str] = []

    def add(frame: DataFrame, columns: dict[str, Column]) -> DataFrame:
        temporary.extend(f"__{name}" for name in columns)
        return frame.withColumns({f"__{name}": column for name, column in columns.items()})

    cast = _cast(kind)
    if cast is None:
        staged = add(df, _raw_stage(root, F.col(payload)))
    else:
        staged = add(df, {"typed": F.try_variant_get(F.col(payload), "$", cast.ddl)})
        staged = add(staged, {"fits": cast.conforms(F.col(payload), get("typed"))})
        staged = add(staged, {name: F.when(~get("fits"), x) for name, x in _raw_stage(root, F.col(payload)).items()})
    staged = add(staged, _type_stage(root, get))
    staged = add(staged, _word_stage(root, get))
    staged = add(staged, _value_stage(root, get))
    staged = add(staged, _code_stage(root, get))
    found, value = _errors(root, get), _value(root, get)
    if cast is not None:
        own = cast.checked(get("typed"))
        found, value = (F.when(get("fits"), fast).otherwise(slow) for fast, slow in zip(own, (found, value), strict=True))
    staged = add(staged, {"errors": found})
    found = get("errors")
    sound = F.size(found) == 0
    fenced = fence(staged, {errors: found, is_valid: sound, output: F.when(sound, value)})
    return fenced.drop(*temporary)
