"""What is still to be done: anti and semi joins against outputs, versions and listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillforge.operators.bloom import divided, key_filter
from quillforge.operators.ordering import DOCUMENT_ORDER, take_first
from quillforge.session import stage


def pending(
    docs: DataFrame,
    outputs: DataFrame,
    keys: Sequence[str] = ("sample_key",),
    spread_by: Sequence[str] = (),
    salts: int = 16,
    prefilter: bool = False,
) -> DataFrame:
    """Documents whose key has no output yet; failed ones have none, so they come again.

    Copies of one document share a key. With ``spread_by`` (columns that tell
    copies apart) they are spread over ``salts`` tasks, against as many copies
    of the short output keys.

    With ``prefilter``, documents whose key a Bloom filter of the outputs' keys
    excludes are not shuffled at all; ``docs`` is then read twice, so it should
    be a scan. Key columns must have the same types on both sides.
    """
    done = outputs.select(*keys).distinct()
    if prefilter:
        done = stage(done)
        maybe, rest = divided(docs, key_filter(done, *keys), *keys)
        left = pending(maybe, done, keys, spread_by, salts)
        return left if rest is None else left.unionByName(rest)
    if not spread_by:
        return docs.join(done, list(keys), "left_anti")
    salted = docs.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)))
    spread = done.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
    return salted.join(spread, [*keys, "_salt"], "left_anti").select(*docs.columns)


def capped_then_pending(
    docs: DataFrame,
    outputs: DataFrame,
    n: int,
    keys: Sequence[str] = ("sample_key",),
    order_by: Sequence[str] = DOCUMENT_ORDER,
) -> DataFrame:
    """The cap comes first: finished documents use up slots of the first ``n``."""
    return pending(take_first(docs, n, order_by).drop("position"), outputs, keys)


def free_versions(candidates: DataFrame, manifest: DataFrame, keys: Sequence[str] = ("name", "version")) -> DataFrame:
    """Candidates whose exact name and version is not in the manifest."""
    return candidates.join(manifest.select(*keys).distinct(), list(keys), "left_anti")


def ready_jobs(jobs: DataFrame, listing: DataFrame, batch_file: str, job: str = "job_id", key: str = "key") -> DataFrame:
    """Jobs with an object below ``<job>/output/`` whose key ends in ``<batch_file>.out``.

    Every place where a key has an ``output`` folder names one possible job, so
    the prefix test becomes an equality join.
    """
    return jobs.join(finished_jobs(listing, batch_file, job, key).distinct(), job, "left_semi")


def finished_jobs(listing: DataFrame, batch_file: str, job: str = "job_id", key: str = "key") -> DataFrame:
    """The jobs that each key ending in ``<batch_file>.out`` can belong to, one row each, repeated ones too; of streams as of tables."""
    parts = F.split(F.col(key), "/")
    inner = F.sequence(F.lit(2), F.size(parts) - 1)
    owners = F.when(
        F.size(parts) >= 3,
        F.transform(
            F.filter(inner, lambda i: F.element_at(parts, i) == "output"),
            lambda i: F.array_join(F.slice(parts, 1, i - 1), "/"),
        ),
    )
    return listing.filter(F.endswith(F.col(key), F.lit(f"{batch_file}.out"))).select(F.explode(owners).alias(job))
