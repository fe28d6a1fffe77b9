"""Prompt rendering and inference requests."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillforge.schema.kinds import PayloadSchema

# Fixed values of the request format.
REQUEST_FORMAT_VERSION = "bedrock-2023-05-31"
BATCH_MAX_TOKENS = 8192


def render_prompt(template: Column, values: Mapping[str, Column]) -> Column:
    """Literal replacement of ``{NAME}`` placeholders, one name after the other."""
    rendered = template
    for name, value in values.items():
        rendered = F.replace(rendered, F.lit("{" + name + "}"), value)
    return rendered


def _fill(template: str, values: Mapping[str, str]) -> str:
    for name, value in values.items():
        template = template.replace("{" + name + "}", value)
    return template


def generation_prompt(schema: PayloadSchema) -> str:
    """Prompt for making training data: schema and example filled in."""
    return _fill(schema.generation_template, {"SCHEMA": schema.describe(), "EXAMPLE": schema.example_json()})


def main_prompt(schema: PayloadSchema) -> str:
    """Prompt the trained model will see: schema only."""
    return _fill(schema.main_template, {"SCHEMA": schema.describe()})


def batch_request(record_id: Column, content: Column, system: Column | str | None = None,
                  max_tokens: int = BATCH_MAX_TOKENS) -> Column:
    """One request ``struct(recordId, modelInput)``; a null system prompt is left out when written as JSON."""
    if not isinstance(system, Column):
        system = F.lit(system).cast("string")
    message = F.struct(
        F.lit("user").alias("role"),
        F.array(F.struct(F.lit("text").alias("type"), content.alias("text"))).alias("content"),
    )
    model_input = F.struct(
        F.lit(REQUEST_FORMAT_VERSION).alias("anthropic_version"),
        system.alias("system"),
        F.lit(max_tokens).alias("max_tokens"),
        F.array(message).alias("messages"),
    )
    return F.struct(record_id.cast("string").alias("recordId"), model_input.alias("modelInput"))
