"""Files in the shared folder, as executors reach them."""

from __future__ import annotations

import re
import uuid

from pyarrow import fs
from pyspark.sql import SparkSession

from quillforge.session import stage_folder


def new_folder(spark: SparkSession, kind: str) -> str:
    """Location of a folder that does not exist yet, below the cluster's shared folder."""
    return f"{stage_folder(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def opened(location: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a location; locations without a scheme are local paths."""
    if re.match(r"file:/(?!//)", location) or location.startswith("/"):
        return fs.LocalFileSystem(), "/" + location.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(location)
