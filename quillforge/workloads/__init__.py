"""Named queries over the given tables, one or more per operator."""

from quillforge.workloads import batches, extraction, outcomes, roundtrips, selection, training  # noqa: F401
from quillforge.workloads.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
