"""Token counts: a native default, and user-supplied tokenizers in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

TokenizerFactory = Callable[[], Callable[[str], Sequence]]


def whitespace_tokens(text: Column) -> Column:
    """Number of whitespace-separated words; 0 for blank text."""
    return F.regexp_count(text, F.lit(r"[^ \t\n\r\f\x0B]+")).cast("bigint")


def token_count(text: Column, tokenizer: TokenizerFactory | None = None) -> Column:
    """Tokens of a text. ``tokenizer`` is a picklable factory of an encode function,
    called once per Python worker task; without it words are counted natively."""
    if tokenizer is None:
        return whitespace_tokens(text)

    @F.pandas_udf(T.LongType())
    def encoded_length(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = tokenizer()
        for batch in batches:
            yield batch.map(lambda t: len(encode(t)), na_action="ignore").astype("Int64")

    return encoded_length(text)


def length_verdict(
    text: Column,
    limit: int,
    tokenizer: TokenizerFactory,
    least: Callable[[Column], Column] = whitespace_tokens,
    most: Callable[[Column], Column] = F.octet_length,
) -> Column:
    """``struct(fits, decided_by, n_tokens)``: whether a text has fewer than ``limit`` tokens, tokenising it only if bounds cannot tell.

    ``least`` and ``most`` are sound bounds of the tokenizer's count, native expressions; by default no token reaches over
    white space between two words, and each has a byte at least. ``decided_by`` is ``most``, ``least`` or ``tokens``, and
    only then there is a count. A null text has no verdict.
    """
    known = F.when(most(text) < limit, "most").when(least(text) >= limit, "least")
    counted = token_count(F.when(known.isNull(), text), tokenizer)
    fits = F.when(known == "most", True).when(known == "least", False).otherwise(counted < limit)
    by = F.when(text.isNotNull(), F.coalesce(known, F.lit("tokens")))
    return F.struct(fits.alias("fits"), by.alias("decided_by"), counted.alias("n_tokens"))
