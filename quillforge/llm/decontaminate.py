"""Benchmark passages in documents, by a positional inverted index.

Only DataFrame functions. For every window of test words the corpus counts name its
rarest term. The index holds the postings of those terms: document, position, and
the words around it, which are the other terms' postings at adjusted offsets. A
window occurs where the lists of all its terms meet, so from the rarest term's few
postings everything else is a comparison within the posting.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillforge.operators.bloom import unused
from quillforge.session import stage

# What separates words, after A-Z are lower-cased.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Up to so many terms also go into the plan as a set, which spares the other words their way to the join.
LISTED_TERMS = 50_000


def words_of(text: Column) -> Column:
    """Words of the text in order; none for null. Only A-Z change case."""
    ascii_only = F.octet_length(text) == F.length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.filter(F.split(F.coalesce(lowered, F.lit("")), BETWEEN_WORDS), lambda w: w != "")


def windows_of(items: DataFrame, n: int) -> DataFrame:
    """item_id, words of every window of ``n`` words; an item of fewer, but not none, is one window."""
    found = items.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text").cast("string")).alias("words"))
    found = found.where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - n + 1, F.lit(1)))
    exploded = found.select("item_id", "words", F.explode(starts).alias("start"))
    return exploded.select("item_id", F.slice("words", F.col("start"), n).alias("words")).distinct()


def term_counts(docs: DataFrame, windows: DataFrame, listed: list[str] | None) -> DataFrame:
    """term, n: how often the corpus has each term of the windows (0 if it has not)."""
    vocabulary = windows.select(F.explode("words").alias("term")).distinct()
    words = words_of(F.col("text").cast("string"))
    if listed is not None:
        words = F.filter(words, lambda w: w.isin(listed))
    counted = docs.select(F.explode(words).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    return vocabulary.join(counted, "term", "left").select("term", F.coalesce("n", F.lit(0)).alias("n"))


def anchored(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """Windows with their rarest term and its offset; the first place and smaller term on ties."""
    placed = windows.select("item_id", "words", F.posexplode("words").alias("offset", "term")).join(counts, "term")
    best = F.min(F.struct("n", "term", "offset")).alias("best")
    return placed.groupBy("item_id", "words").agg(best).select("item_id", "words", "best.term", "best.offset")


def listed_terms(terms: DataFrame) -> list[str] | None:
    """The terms, if they are at most LISTED_TERMS."""
    found = [r[0] for r in terms.distinct().limit(LISTED_TERMS + 1).collect()]
    return found if 0 < len(found) <= LISTED_TERMS else None


def build_index(docs: DataFrame, terms: list[str] | None, reach: int) -> DataFrame:
    """One row per row of ``docs``: doc_id, key, n_words, and the postings of the terms with ``reach`` words on either side.

    ``key`` tells rows with equal ids and different texts apart. Without a list of terms, all words get postings.
    """
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), words_of(text).alias("words"))
    places = F.filter(
        F.transform("words", lambda w, i: F.when(w.isin(terms) if terms is not None else F.lit(True), i + 1)), lambda i: i.isNotNull()
    )
    posting = F.transform(
        places,
        lambda i: F.struct(
            F.get("words", i - 1).alias("term"),
            i.alias("pos"),
            F.least(i - 1, F.lit(reach)).alias("before"),
            F.slice("words", F.greatest(i - reach, F.lit(1)), F.least(i - 1, F.lit(reach)) + reach + 1).alias("around"),
        ),
    )
    return rows.select("doc_id", "key", F.size("words").alias("n_words"), posting.alias("postings"))


def matches(index: DataFrame, windows: DataFrame) -> DataFrame:
    """doc_id, key, item_id, start, length of windows that occur, and of those (start null) whose words all occur within reach of the rarest.

    The join is on the rarest term; Spark broadcasts the windows if their table is small, and splits frequent terms if it is not.
    """
    postings = index.select("doc_id", "key", F.explode("postings").alias("p")).select("doc_id", "key", "p.*")
    pairs = postings.join(windows, "term")
    first = F.col("before") - F.col("offset") + 1
    phrase = (first >= 1) & (F.slice("around", F.greatest(first, F.lit(1)), F.size("words")) == F.col("words"))
    near = F.size(F.array_except("words", "around")) == 0
    found = pairs.where(phrase | near).withColumn("phrase", phrase)
    return found.select(
        "doc_id", "key", "item_id", F.when(F.col("phrase"), F.col("pos") - F.col("offset")).alias("start"), F.size("words").alias("length")
    ).distinct()


def contamination(docs: DataFrame, items: DataFrame, n: int = 13, share: int = 20) -> DataFrame:
    """What of every document occurs in the benchmark.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are ignored. One row per document:
    doc_id, key, n_words, n_hit (words inside an occurring window of ``n`` words), n_items, items_sha256, contaminated
    (any hit, and at least one word in ``share``), near_items (items of which all words of a window lie within ``n``
    words of its rarest). Null texts have no words; repeated rows are repeated in the result; without items nothing is hit.
    """
    windows = stage(windows_of(items, n))
    vocabulary = listed_terms(windows.select(F.explode("words")))
    windows = stage(anchored(windows, stage(term_counts(docs, windows, vocabulary))))
    index = stage(build_index(docs, listed_terms(windows.select("term")) if vocabulary else vocabulary, n - 1))
    hits = matches(index, windows)
    # A document's own hits: at most its words times the window.
    covered = F.flatten(F.collect_set(F.when(F.col("start").isNotNull(), F.sequence("start", F.col("start") + F.col("length") - 1))))
    phrase_items = F.collect_set(F.when(F.col("start").isNotNull(), F.col("item_id")))
    by_document = hits.groupBy("doc_id", "key").agg(
        F.size(F.array_distinct(covered)).cast("long").alias("n_hit"), F.array_sort(phrase_items).alias("items"), F.countDistinct("item_id").alias("near_items")
    )
    found = index.select("doc_id", "key", F.col("n_words").cast("long")).alias("d")
    on = [F.col("d.doc_id").eqNullSafe(F.col("h.doc_id")), F.col("d.key") == F.col("h.key")]
    joined = found.join(by_document.alias("h"), on, "left")
    n_hit, listed = F.coalesce("n_hit", F.lit(0).cast("long")), F.coalesce("items", F.array().cast("array<string>"))
    return joined.select("d.doc_id", "d.key", "n_words", n_hit.alias("n_hit"), listed.alias("items"), F.coalesce("near_items", F.lit(0).cast("long")).alias("near_items")).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        "near_items",
        "key",
    )


def uncontaminated(docs: DataFrame, items: DataFrame, n: int = 13, share: int = 20) -> DataFrame:
    """``docs``, with all its columns, without the contaminated documents.

    Null and empty texts have no words and stay; repeated rows and null ids are judged by their text like others, of any length.
    """
    names = unused("_id", docs), unused("_key", docs)
    found = stage(contamination(docs, items, n, share).where("contaminated").select(F.col("doc_id").alias(names[0]), F.col("key").alias(names[1])).distinct())
    on = [F.col("doc_id").cast("long").eqNullSafe(F.col(names[0])), F.xxhash64(F.col("text").cast("string")) == F.col(names[1])]
    return docs.join(found, on, "left_anti")
