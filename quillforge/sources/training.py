"""Published training batches and single training examples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillforge.functions.payload import strict_object
from quillforge.functions.text import fence, let
from quillforge.functions.validation import validate
from quillforge.operators.audits import require_single_file
from quillforge.schema.kinds import PayloadSchema
from quillforge.schema.samples import TRAINING_EXAMPLE
from quillforge.sources.objects import file_path, list_objects, path_exists, relative_key


def read_training_batches(spark: SparkSession, folder: str, names: Sequence[str]) -> DataFrame:
    """Lines of the one training file of every named batch folder, in one scan for all batches.

    Columns: batch_name, batch_pos (order of ``names``), line_id, line_at, value. ``line_id`` comes from the batch's
    name and the line alone, so it is the same wherever the files lie and however they are split; equal lines of a
    batch share it. ``line_at`` is the place in file order.
    """
    root = folder.rstrip("/")
    # Only the named folders are listed, however many there are beside them.
    present = [f"{root}/{name}" for name in dict.fromkeys(names) if path_exists(spark, f"{root}/{name}")]
    if not present:
        raise ValueError("none of the batches exists: " + ", ".join(names))
    listing = list_objects(spark, folder, "*", paths=present)
    listing = listing.withColumn("batch_name", F.substring_index("key", "/", 1))
    files = require_single_file(listing, names)
    lines = spark.read.text([f"{root}/{files[name]}" for name in files])
    batch = F.substring_index(relative_key(file_path(), folder), "/", 1)
    placed = lines.select(
        batch.alias("batch_name"),
        "value",
        file_path().alias("_file"),
        F.format_string("%019d-%019d", F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("_at"),
    )
    order = spark.createDataFrame([(name, i) for i, name in enumerate(files)], "batch_name string, batch_pos int")
    # ``order`` has one row per name the caller passed in
    return placed.join(F.broadcast(order), "batch_name").select(
        "batch_name",
        "batch_pos",
        F.md5(F.concat("batch_name", F.lit("/"), "value")).alias("line_id"),
        F.concat_ws("-", F.col("_file"), F.col("_at")).alias("line_at"),
        "value",
    )


_CONTENT = r'"content"\s*+:\s*+"(?:[^"\\]++|\\.)*+"'
_OUTPUT_LAST = rf'(?s)\A\s*+\{{\s*+{_CONTENT}\s*+,\s*+"output"\s*+:\s*+(\{{.*\}})\s*\}}\s*\z'
_OUTPUT_FIRST = rf'(?s)\A\s*+\{{\s*+"output"\s*+:\s*+(\{{.*\}})\s*,\s*+{_CONTENT}\s*+\}}\s*+\z'


def written_output(text: Column) -> Column:
    """The output object as it stands in an example of just content and output: order of keys, digits, spaces and all.

    A parsed value would spell its numbers anew. The text must be a valid example; null if it has other members,
    whose place a pattern cannot tell.
    """
    cut = [F.regexp_extract(text, pattern, 1) for pattern in (_OUTPUT_LAST, _OUTPUT_FIRST)]
    found = F.coalesce(*[F.when(c != "", c) for c in cut])
    return let(found, lambda t: F.when(strict_object(t).isNotNull(), t))


def parse_training_examples(files: DataFrame, schema: PayloadSchema, text: str = "value") -> DataFrame:
    """Examples ``{content, output}`` with their payload checked: content, raw_json, output, errors, is_valid."""
    envelope = validate(
        files.withColumn("_object", strict_object(F.col(text))),
        "_object",
        TRAINING_EXAMPLE,
        errors="_envelope_errors",
        output="_example",
        is_valid="_has_envelope",
    )
    raw = F.when(F.col("_example.output").isNotNull(), F.coalesce(written_output(F.col(text)), F.col("_example.output")))
    named = fence(envelope.withColumn("content", F.col("_example.content")), {"raw_json": raw})
    checked = validate(named.withColumn("_payload", strict_object(F.col("raw_json"))), "_payload", schema.root)
    errors = F.when(F.col("_has_envelope"), F.col("errors")).otherwise(F.col("_envelope_errors"))
    return checked.withColumn("errors", errors).select(*files.columns, "content", "raw_json", "output", "errors", "is_valid")


def read_training_examples(spark: SparkSession, folder: str, schema: PayloadSchema) -> DataFrame:
    """The ``*.json`` files directly in a folder (sub-folders such as ``invalid/`` are left out)."""
    files = spark.read.option("pathGlobFilter", "*.json").text(f"{folder.rstrip('/')}/*.json", wholetext=True)
    named = files.select("value", F.substring_index(file_path(), "/", -1).alias("file_name"))
    return parse_training_examples(named, schema)
