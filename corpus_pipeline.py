"""From raw documents to packed training sequences: five stages, each over all that the one before kept.

All but the last return the columns they get, whatever else is among them. Null and empty texts pass every stage but the
first, which judges them like a text without bytes; rows with equal or null ids are documents of their own except as
copies; texts may be of any length, and no rows give no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quillforge.llm.decontaminate import uncontaminated
from quillforge.llm.neardup import one_of_each
from quillforge.llm.packing import pack_documents
from quillforge.llm.quality import keep_good, learn
from quillforge.llm.substring import without_passages
from quillforge.session import configure, stage


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learnt from the labelled ones, does not reject."""
    configure(spark)
    return keep_good(docs, learn(docs, _table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id; a null id only where there is no other."""
    return one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 words and more that ones with smaller ids have; those that lose every word go."""
    return without_passages(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which no word, or less than one in twenty, lies in a benchmark passage."""
    return uncontaminated(docs, _table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences of 1024 tokens; a null text is one piece."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: SQL can express neither the classifier nor the packing; tests/llm/test_pipeline_by_hand.py compares each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the documents, each result written out and read again."""
    docs = _table(configure(spark), sf_dir, "documents")
    for name, apply in STAGES:
        docs = apply(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stage(docs)
    return docs
