"""Scalar text functions: hashes, keys, names, versions, slugs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREVIEW_CHARS = 500
SLUG_CHARS = 40

# Fixed value: every character that counts as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Fixed value: base names of document members, old and new style.
DOCUMENT_MEMBER = r"document_.*\.json|[0-9a-f]{32}\.json\n?"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fence(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add costly columns so that later filters use their values.

    The optimizer moves a filter below a projection by putting the projected
    expressions into it, which would compute them again - over a chain of
    projections, exponentially often. It does not do so across a generator, so
    the columns are handed through one that yields exactly one row.
    """
    computed = df.withColumns({f"_fenced_{name}": column for name, column in columns.items()})
    named = F.struct(*[F.col(f"_fenced_{name}").alias(name) for name in columns])
    return computed.select(*df.columns, F.inline(F.array(named)))


def strip_ws(text: Column) -> Column:
    """Strip Unicode whitespace (and the four ASCII separator controls) from both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def content_hash(content: Column) -> Column:
    """Full md5 of a text, the join key for content."""
    return F.md5(content)


def content_hash8(content: Column) -> Column:
    """First eight hex digits of the md5, the short form shown in names."""
    return F.substring(F.md5(content), 1, 8)


def _key(schema_name: Column | str, version_token: Column | str, source: Column, digest: Column) -> Column:
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.concat(as_col(schema_name), as_col(version_token), F.lit("_"), source, F.lit("_"), digest)


def output_key(schema_name: Column | str, version_token: Column | str, source: Column, content: Column) -> Column:
    """File name of a document's sample: ``{schema}{version}_{source}_{hash8}.json``."""
    return F.concat(_key(schema_name, version_token, source, content_hash8(content)), F.lit(".json"))


def sample_key(schema_name: Column | str, version_token: Column | str, source: Column, content: Column) -> Column:
    """Like :func:`output_key` but with the full hash: safe as a join key at any scale."""
    return _key(schema_name, version_token, source, content_hash(content))


def base_name(path: Column) -> Column:
    """Part after the last slash."""
    return F.substring_index(path, "/", -1)


def is_document_member(name: Column) -> Column:
    """Archive members that are documents, by base name."""
    return base_name(name).rlike(f"(?s)^(?:{DOCUMENT_MEMBER})\\z")


def is_archive(key: Column) -> Column:
    """Keys of document archives."""
    return F.endswith(key, F.lit(".tar")) | F.endswith(key, F.lit(".tar.gz"))


def batch_name(file_name: Column) -> Column:
    """Archive file name without its extensions (removed wherever they occur)."""
    return F.replace(F.replace(file_name, F.lit(".tar.gz"), F.lit("")), F.lit(".tar"), F.lit(""))


def remove_prefix(text: Column, prefix: str) -> Column:
    """Drop a leading literal prefix if present."""
    return F.when(F.startswith(text, F.lit(prefix)), F.substring(text, len(prefix) + 1, 2**31 - 1)).otherwise(text)


def version_token(version: Column) -> Column:
    """First three dot-separated parts joined by underscores."""
    return F.array_join(F.slice(F.split(version, r"\."), 1, 3), "_")


def split_semver(version: Column) -> Column:
    """``struct(major, minor, patch)``; null unless the text is exactly three digit groups."""
    parts = F.split(version, r"\.")
    number = lambda i: F.get(parts, F.lit(i)).try_cast("int")
    well_formed = version.rlike(r"^[0-9]+\.[0-9]+\.[0-9]+$")
    return F.when(well_formed, F.struct(number(0).alias("major"), number(1).alias("minor"), number(2).alias("patch")))


def join_semver(major: Column, minor: Column, patch: Column, separator: str = ".") -> Column:
    """Inverse of :func:`split_semver`."""
    return F.concat_ws(separator, *(c.cast("string") for c in (major, minor, patch)))


def _trim_dashes(text: Column) -> Column:
    return F.regexp_replace(text, "^-+|-+$", "")


def slug(text: Column) -> Column:
    """Lower-case words joined by dashes, at most 40 characters."""
    dashed = F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-")
    return F.substring(_trim_dashes(dashed), 1, SLUG_CHARS)


def run_name(ts: Column, description: Column) -> Column:
    """Batch folder name: ``YYYYmmdd-HHMMSS_<description>``."""
    return F.concat(F.date_format(ts, "yyyyMMdd-HHmmss"), F.lit("_"), description)


def job_name(ts: Column, description: Column) -> Column:
    """Job identifier: ``YYYYmmdd-HHMMSS-<slug>``, without dangling dashes."""
    return _trim_dashes(F.concat(F.date_format(ts, "yyyyMMdd-HHmmss"), F.lit("-"), slug(description)))


def batch_job_id(ts: Column, folder: str = "generation") -> Column:
    """Identifier of a batch-inference job: ``<folder>/YYYY-mm-dd-HHMM``."""
    return F.concat(F.lit(f"{folder}/"), F.date_format(ts, "yyyy-MM-dd-HHmm"))


def preview(text: Column) -> Column:
    """First characters of a rejected reply, for the reject table."""
    return F.substring(text, 1, PREVIEW_CHARS)
