"""Chat-format samples: building, rendering and checking them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillforge.functions.payload import CLOSE_TAG, OPEN_TAG

KEEP_NULLS = {"ignoreNullFields": "false"}
TURN_OPEN = "<|im_start|>"
TURN_CLOSE = "<|im_end|>\n"


def dump_json(value: Column, pretty: bool = False) -> Column:
    """JSON text of a struct with null members kept."""
    return F.to_json(value, {**KEEP_NULLS, "pretty": "true"} if pretty else KEEP_NULLS)


def wrap_output(json_text: Column) -> Column:
    """Assistant text: the payload between output tags, on lines of its own."""
    return F.concat(F.lit(OPEN_TAG + "\n"), json_text, F.lit("\n" + CLOSE_TAG))


def _message(role: str, content: Column) -> Column:
    return F.struct(
        F.lit(role).alias("role"), content.alias("content"), F.lit(None).cast("string").alias("name")
    )


def chat_sample(system: Column | str, content: Column, json_text: Column) -> Column:
    """Three messages: system prompt, document, wrapped payload."""
    system = system if isinstance(system, Column) else F.lit(system)
    return F.array(_message("system", system), _message("user", content), _message("assistant", wrap_output(json_text)))


def render_turn(role: Column, content: Column) -> Column:
    """One message in the default chat template."""
    return F.concat(F.lit(TURN_OPEN), role, F.lit("\n"), content, F.lit(TURN_CLOSE))


def render_chat(messages: Column) -> Column:
    """Messages flattened with the default chat template, without a generation prompt."""
    return F.array_join(F.transform(messages, lambda m: render_turn(m["role"], m["content"])), "")


def same_prompt(prompt: Column, expected: str) -> Column:
    """Equality after deleting line feeds and spaces (only those)."""
    return F.translate(prompt, "\n ", "") == F.lit(expected.replace("\n", "").replace(" ", ""))


def has_chat_shape(messages: Column) -> Column:
    """At least three messages: the first is read as system prompt, the third as answer."""
    return F.coalesce(F.size(messages) >= 3, F.lit(False))


def message_content(messages: Column, position: int) -> Column:
    """Content of the message at a 0-based position; null if there is none."""
    return F.get(messages, F.lit(position))["content"]
