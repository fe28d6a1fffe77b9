"""Registry of payload schemas by (name, version)."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quillforge.schema.kinds import PayloadSchema

_SCHEMAS: dict[tuple[str, str], PayloadSchema] = {}


def register_schema(schema: PayloadSchema, spark: SparkSession | None = None) -> PayloadSchema:
    """Register a schema; with a session, its canonical example must validate first."""
    known = _SCHEMAS.get((schema.name, schema.version))
    if known is not None and known != schema:
        raise ValueError(f"{schema.name} {schema.version} is already registered with other content")
    if spark is not None:
        self_check(spark, schema)
    _SCHEMAS[(schema.name, schema.version)] = schema
    return schema


def get_schema(name: str, version: str | None = None) -> PayloadSchema:
    """Look a schema up; without a version, the highest registered one."""
    found = [s for (n, v), s in _SCHEMAS.items() if n == name and version in (None, v)]
    if not found:
        raise KeyError(f"no schema registered as {name} {version or ''}".strip())
    return max(found, key=lambda s: [int(p) if p.isdigit() else -1 for p in s.version.split(".")])


def self_check(spark: SparkSession, schema: PayloadSchema) -> None:
    """Raise unless the schema's canonical example passes its own validation."""
    from quillforge.functions.payload import strict_object
    from quillforge.functions.validation import validate

    text = json.dumps(schema.example)
    one = spark.range(1).select(strict_object(F.lit(text)).alias("payload"))
    errors = validate(one, "payload", schema.root).select("errors").first()[0]
    if errors:
        raise ValueError(f"example of {schema.name} {schema.version} is invalid: {errors}")
