"""Getting a JSON object out of a free-form reply.

``strict_object`` parses a text as one JSON object and nothing else. Spark's own
parsers stop after the first complete value and ignore what follows, so the text
is wrapped as ``[<text>,<hash of text>]``: only a text that is exactly one value
leaves its own hash at index 1 and nothing at index 2.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillforge.functions.text import let, strip_ws

OPEN_TAG = "<output>"
CLOSE_TAG = "</output>"

# Texts beyond this can be more than one VARIANT holds; such a text is told from one that is no JSON.
PARSED_BYTES = 16 * 1024 * 1024
TOO_LARGE = "too_large"

_OBJECT_START = r"^[ \t\n\r]*\{"
_EMPTY_OBJECT = r"^[ \t\n\r]*\{[ \t\n\r]*\}[ \t\n\r]*\z"


def tagged_text(reply: Column) -> Column:
    """Stripped text of the first ``<output>`` pair; null when there is none."""
    start = F.locate(OPEN_TAG, reply)
    after = F.substring(reply, start + len(OPEN_TAG), F.length(reply))
    inner = F.substring_index(after, CLOSE_TAG, 1)
    return F.when((start > 0) & F.contains(after, F.lit(CLOSE_TAG)), strip_ws(inner))


def tagged_or_all(reply: Column) -> Column:
    """``struct(found, message, content)``: the tagged text, else the whole stripped reply."""
    inner = tagged_text(reply)
    content = F.coalesce(inner, strip_ws(reply))
    # Status texts users of the operator match on.
    hit = F.concat(
        F.lit("Successfully extracted content from <output> tags (length="),
        F.length(content).cast("string"),
        F.lit(" chars)"),
    )
    miss = F.lit("No <output> tags found in response, using full response text")
    found = inner.isNotNull()
    return F.struct(found.alias("found"), F.when(found, hit).otherwise(miss).alias("message"), content.alias("content"))


def outermost_braces(reply: Column) -> Column:
    """Text from the first ``{`` to the last ``}``; null when there is no such span.

    Found by position: a greedy regular expression would backtrack over the whole reply.
    """
    start = F.locate("{", reply)
    span = F.length(reply) - F.length(F.substring_index(reply, "}", -1)) - start + 1
    return F.when((start > 0) & F.contains(reply, F.lit("}")) & (span > 0), F.substring(reply, start, span))


def strip_tags(text: Column) -> Column:
    """Delete every output tag, wherever it stands, then strip."""
    without = F.replace(F.replace(text, F.lit(OPEN_TAG), F.lit("")), F.lit(CLOSE_TAG), F.lit(""))
    return strip_ws(without)


def strict_object(text: Column) -> Column:
    """The text as a VARIANT object; null unless the whole text is one JSON object.

    NaN and the infinities are accepted as numbers. With the session settings of
    ``quillforge.configure``, a repeated key keeps its last value.
    """
    def checked(t: Column) -> Column:
        mark = F.xxhash64(t)
        wrapped = F.concat(F.lit("["), t, F.lit(","), mark.cast("string"), F.lit("]"))
        # Only texts with such tokens are read with non-numeric numbers allowed: the reader knows more spellings.
        strict, lenient = (
            F.from_json(wrapped, "array<variant>", {"allowSingleQuotes": "false", "allowNonNumericNumbers": flag})
            for flag in ("false", "true")
        )
        parsed = F.when(t.rlike("NaN|Infinity"), lenient).otherwise(strict)
        return let(
            parsed,
            lambda w: F.when(
                (F.size(w) == 2) & (F.to_json(F.get(w, F.lit(1))) == mark.cast("string")),
                F.get(w, F.lit(0)),
            ),
        )

    return let(text, lambda t: F.when(t.rlike(_OBJECT_START), checked(t)))


def beyond_parser(text: Column) -> Column:
    """Whether a text that looks like an object may be too large for :func:`strict_object`."""
    return (F.octet_length(text) > PARSED_BYTES) & text.rlike(_OBJECT_START)


def payload(reply: Column, accepts_empty: bool = False) -> Column:
    """``struct(text, object)`` of the JSON object a reply carries, or null.

    Tried in order: the tagged text, the whole reply, the outermost braces. The
    first that is an object wins, whether or not it later validates; an empty
    object counts only if the schema accepts ``{}``.
    """

    def rung(candidate: Column) -> Column:
        parsed = let(candidate, lambda t: F.struct(t.alias("text"), strict_object(t).alias("object")))
        keep = lambda p: p["object"].isNotNull()
        if not accepts_empty:
            keep = lambda p: p["object"].isNotNull() & ~p["text"].rlike(_EMPTY_OBJECT)
        return F.get(F.filter(F.array(parsed), keep), F.lit(0))

    return F.coalesce(rung(tagged_text(reply)), rung(strip_ws(reply)), rung(outermost_braces(reply)))
