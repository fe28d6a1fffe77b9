"""Chat checks on long-format conversations (one row per turn).

Messages are never gathered into one row: everything asked of a conversation is
an aggregate with a map-side part, so one very long conversation is no burden.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillforge.functions.chat import render_turn
from quillforge.functions.tokens import TokenizerFactory, token_count
from quillforge.schema.samples import ROLES


def conversation_shape(turns: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Per conversation: number of turns, whether all roles are known, and whether it has a chat sample's shape.

    ``turns`` has ``turn`` (0-based position), ``role`` and ``text``.
    """
    known = F.col("role").isin(*ROLES) & F.col("text").isNotNull()
    at = lambda i: F.max(F.when(F.col("turn") == i, F.col("role")))
    return turns.groupBy(conv).agg(
        F.count("*").alias("n_turns"),
        F.bool_and(F.coalesce(known, F.lit(False))).alias("roles_known"),
        at(0).alias("first_role"),
        at(2).alias("third_role"),
        ((F.count("*") >= 3) & F.bool_and(F.coalesce(known, F.lit(False)))).alias("is_chat_sample"),
    )


def conversation_tokens(turns: DataFrame, conv: str = "conv_id", tokenizer: TokenizerFactory | None = None) -> DataFrame:
    """Tokens of every conversation in the default chat template.

    A rendered turn ends in a line feed, so word counts of turns add up.
    A custom tokenizer must be additive over turns in the same way.
    """
    tokens = token_count(render_turn(F.col("role"), F.col("text")), tokenizer)
    return turns.withColumn("_tokens", tokens).groupBy(conv).agg(F.sum("_tokens").alias("n_tokens"))
