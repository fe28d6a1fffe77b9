"""Object listings."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillforge.functions.text import base_name, batch_name, is_archive
from quillforge.operators.ordering import first_match


def relative_key(path: Column, folder: str) -> Column:
    """Part of a path below a folder, however the two spell the file system."""
    root = re.sub(r"^file:/+", "/", folder.rstrip("/")).split("://")[-1] + "/"
    return F.substring_index(path, root, -1)


def file_path() -> Column:
    """Path of the file a row was read from, percent-encoding undone."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def list_objects(
    spark: SparkSession,
    folder: str,
    pattern: str | None = None,
    recursive: bool = True,
    paths: list[str] | None = None,
) -> DataFrame:
    """Complete listing below a folder (or only below some ``paths`` in it): full path, key relative to the
    folder, size and time. Contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    listing = reader.load(folder if paths is None else paths).drop("content")
    return listing.select("path", relative_key(F.col("path"), folder).alias("key"), "length", "modificationTime")


def list_document_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Document archives below a folder with the name of the batch each holds."""
    archives = list_objects(spark, folder, "*.tar*").filter(is_archive(F.col("key")))
    return archives.withColumn("batch_name", batch_name(base_name(F.col("key"))))


def locate_output(listing: DataFrame, pattern: str, key: str = "key") -> DataFrame:
    """First key between the two sides of a ``…/*/…`` pattern: starts with the left part, ends with the right part."""
    prefix, star, suffix = pattern.partition("*/")
    if not star:
        raise ValueError("pattern needs a */ part")
    hit = F.startswith(F.col(key), F.lit(prefix)) & F.endswith(F.col(key), F.lit(suffix))
    return first_match(listing, hit, key)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists on any file system Spark can reach."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)
