"""Declarative payload schemas.

A payload schema is a tree of *kinds*. It fixes three things at once: the Spark
type of the normalised payload, the validation rules, and the text description
that goes into a prompt.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import types as T


class _Required:
    def __repr__(self) -> str:
        return "REQUIRED"


REQUIRED: Any = _Required()


@dataclass(frozen=True)
class Kind:
    """One JSON value shape."""

    def spark_type(self) -> T.DataType:
        raise NotImplementedError

    def describe(self) -> dict[str, Any]:
        raise NotImplementedError


@dataclass(frozen=True)
class Text(Kind):
    """A JSON string; numbers are not turned into text."""

    def spark_type(self) -> T.DataType:
        return T.StringType()

    def describe(self) -> dict[str, Any]:
        return {"type": "string"}


@dataclass(frozen=True)
class _Bounded(Kind):
    ge: float | None = None
    le: float | None = None

    def _bounds(self) -> dict[str, Any]:
        limits = {"minimum": self.ge, "maximum": self.le}
        return {name: limit for name, limit in limits.items() if limit is not None}


@dataclass(frozen=True)
class Integer(_Bounded):
    """A whole number, also given as ``5.0``, ``"5"`` or a boolean."""

    def spark_type(self) -> T.DataType:
        return T.LongType()

    def describe(self) -> dict[str, Any]:
        return {"type": "integer", **self._bounds()}


@dataclass(frozen=True)
class Number(_Bounded):
    """A double, also given as a numeric string or a boolean."""

    def spark_type(self) -> T.DataType:
        return T.DoubleType()

    def describe(self) -> dict[str, Any]:
        return {"type": "number", **self._bounds()}


@dataclass(frozen=True)
class Boolean(Kind):
    """true/false, also given as 0/1 or one of the usual words."""

    def spark_type(self) -> T.DataType:
        return T.BooleanType()

    def describe(self) -> dict[str, Any]:
        return {"type": "boolean"}


@dataclass(frozen=True)
class Choice(Kind):
    """A closed vocabulary of strings, matched exactly (or after lower-casing the input)."""

    values: tuple[str, ...]
    ignore_case: bool = False

    def __init__(self, *values: str, ignore_case: bool = False):
        object.__setattr__(self, "values", tuple(values))
        object.__setattr__(self, "ignore_case", ignore_case)

    def spark_type(self) -> T.DataType:
        return T.StringType()

    def describe(self) -> dict[str, Any]:
        return {"type": "string", "enum": list(self.values)}


@dataclass(frozen=True)
class AnyObject(Kind):
    """A free-form JSON object, carried as JSON text."""

    def spark_type(self) -> T.DataType:
        return T.StringType()

    def describe(self) -> dict[str, Any]:
        return {"type": "object"}


@dataclass(frozen=True)
class Items(Kind):
    """A JSON array of one element kind, optionally limited in length."""

    element: Kind
    max_length: int | None = None

    def spark_type(self) -> T.DataType:
        return T.ArrayType(self.element.spark_type())

    def describe(self) -> dict[str, Any]:
        limit = {} if self.max_length is None else {"maxItems": self.max_length}
        return {"type": "array", "items": self.element.describe(), **limit}


@dataclass(frozen=True)
class Field:
    """A named member of a record.

    ``nullable`` and ``default`` are independent: a nullable field without a
    default must be present but may be null; a field with a default may be
    missing but, unless nullable, not null.
    """

    name: str
    kind: Kind
    nullable: bool = False
    default: Any = REQUIRED
    description: str = ""

    def __post_init__(self) -> None:
        if not self.name or any(ch in self.name for ch in "'\"[]"):
            raise ValueError(f"unsupported field name: {self.name!r}")

    @property
    def required(self) -> bool:
        return self.default is REQUIRED


@dataclass(frozen=True)
class Record(Kind):
    """A JSON object with declared members.

    ``fold_choices`` lower-cases the input of the record's own, non-nullable
    ``Choice`` members before matching (not nullable ones, not arrays of them).
    """

    fields: tuple[Field, ...]
    forbid_unknown: bool = False
    fold_choices: bool = False

    def __init__(self, *fields: Field, forbid_unknown: bool = False, fold_choices: bool = False):
        names = [f.name for f in fields]
        if len(set(names)) != len(names):
            raise ValueError("duplicate field names")
        object.__setattr__(self, "fields", tuple(fields))
        object.__setattr__(self, "forbid_unknown", forbid_unknown)
        object.__setattr__(self, "fold_choices", fold_choices)

    def spark_type(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.kind.spark_type(), True) for f in self.fields])

    def describe(self) -> dict[str, Any]:
        members: dict[str, Any] = {}
        for f in self.fields:
            text = {**f.kind.describe()}
            if f.nullable:
                text["nullable"] = True
            if not f.required:
                text["default"] = f.default
            if f.description:
                text["description"] = f.description
            members[f.name] = text
        return {
            "type": "object",
            "properties": members,
            "required": [f.name for f in self.fields if f.required],
            "additionalProperties": not self.forbid_unknown,
        }

    @property
    def accepts_empty(self) -> bool:
        """Whether ``{}`` is a valid value."""
        return not any(f.required for f in self.fields)


@dataclass(frozen=True)
class PayloadSchema:
    """A named, versioned payload schema with its prompt templates and canonical example."""

    name: str
    version: str
    root: Record
    generation_template: str = "{SCHEMA}\n\n{EXAMPLE}"
    main_template: str = "{SCHEMA}"
    example: dict[str, Any] = field(default_factory=dict)

    @property
    def version_token(self) -> str:
        return "_".join(self.version.split(".")[:3])

    def spark_type(self) -> T.StructType:
        return self.root.spark_type()

    def describe(self) -> str:
        return json.dumps(self.root.describe(), indent=2, ensure_ascii=False)

    def example_json(self) -> str:
        return json.dumps(self.example, indent=2, ensure_ascii=False)
