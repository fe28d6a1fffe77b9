"""Pairing replies with their documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillforge.operators.ordering import with_positions


def attach_responses(docs: DataFrame, replies: DataFrame, on: str = "record_id") -> DataFrame:
    """Documents with the reply of the same record id."""
    return docs.join(replies, on, "inner")


def attach_by_position(
    docs: DataFrame, replies: DataFrame, docs_order: Sequence[str], replies_order: Sequence[str]
) -> DataFrame:
    """Pair the i-th reply with the i-th document, ignoring record ids. Replies beyond the last document stay, unpaired."""
    left = with_positions(docs.drop("record_id"), docs_order)
    right = with_positions(replies.drop("record_id"), replies_order)
    return right.join(left, "position", "left").withColumn("record_id", F.col("position").cast("string"))


def orphan_replies(docs: DataFrame, replies: DataFrame, on: str = "record_id") -> DataFrame:
    """Replies that belong to no document."""
    return replies.join(docs.select(on), on, "left_anti")


def unanswered(docs: DataFrame, replies: DataFrame, on: str = "record_id") -> DataFrame:
    """Documents without a reply."""
    return docs.join(replies.select(on), on, "left_anti")
