"""Markup to plain text.

Markdown is turned into HTML with native string functions, titles are dropped,
tags and comments removed; only character references (whose table is long) are
resolved in an Arrow batch function, which gets only the texts that contain any.
"""

from __future__ import annotations

import html
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FENCE = r"(?m)^(`{3,}|~{3,})[^\n`]*\n([\s\S]*?)^\1[ \t]*$"
_FIRST_H1 = r"(?is)\A(.*?)<h1\b[^>]*>.*?</h1\s*>"
# What is not closed is hidden to the end, so that no second search for a missing end begins. Possessive, so
# that a tag with very many attributes is matched in a loop, not by recursion.
_HIDDEN = r"(?is)<!--(?:.*?-->|.*+\z)|<(script|style|template)\b[^>]*+>(?:.*?</\1\s*+>|.*+\z)"
_TAG = r"(?s)<[/!?]?[A-Za-z][^<>\"']*+(?:(?:\"[^\"]*+\"|'[^']*+')[^<>\"']*+)*+>"


def markdown_to_html(text: Column) -> Column:
    """The Markdown constructs that affect plain text: fenced code, headings, emphasis, code, links, lists."""
    steps = [
        (r"\r\n?", "\n"),
        (_FENCE, "<pre><code>$2</code></pre>"),
        (r"(?m)^#[ \t]+(.*?)[ \t]*#*[ \t]*$", "<h1>$1</h1>"),
        (r"(?m)^(#{2,6})[ \t]+(.*?)[ \t]*#*[ \t]*$", "<h2>$2</h2>"),
        (r"(?m)^([^\s<].*)\n=+[ \t]*$", "<h1>$1</h1>"),
        (r"(?m)^([^\s<].*)\n-+[ \t]*$", "<h2>$1</h2>"),
        (r"!\[([^\]\n]*)\]\([^)\n]*\)", "<img>"),
        (r"\[([^\]\n]+)\]\([^)\n]*\)", "<a>$1</a>"),
        (r"(\*\*|__)(?=\S)([^\n]*?\S)\1", "<strong>$2</strong>"),
        (r"(?<![\w*])\*(?=[^\s*])([^*\n]*[^\s*])\*(?![\w*])", "<em>$1</em>"),
        (r"`([^`\n]+)`", "<code>$1</code>"),
        (r"(?m)^[ \t]*(?:[-+*]|[0-9]+\.)[ \t]+", ""),
        (r"(?m)^>[ \t]?", ""),
    ]
    for pattern, replacement in steps:
        text = F.regexp_replace(text, pattern, replacement)
    return text


@F.pandas_udf(T.StringType())
def _resolve_references(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        yield batch.map(html.unescape, na_action="ignore")


def html_to_text(text: Column, remove_title: bool = True) -> Column:
    """Text of an HTML document: first ``<h1>`` dropped, scripts, styles, comments and tags removed."""
    bare = F.regexp_replace(text, _HIDDEN, "")
    if remove_title:
        bare = F.regexp_replace(bare, _FIRST_H1, "$1")
    return F.regexp_replace(bare, _TAG, "")


def resolve_references(text: Column) -> Column:
    """Replace character references such as ``&amp;`` and ``&#233;``."""
    return F.coalesce(_resolve_references(F.when(F.contains(text, F.lit("&")), text)), text)


def markup_to_text(text: Column, remove_title: bool = True) -> Column:
    """Plain text of Markdown (with embedded HTML)."""
    return resolve_references(html_to_text(markdown_to_html(text), remove_title))

