"""Operators on pages and vectors against brute force."""

import base64
import hashlib
import random
import re
import time

import numpy as np
import pytest
import zstandard
from pyarrow import fs
from pyspark.sql import functions as F

from quillforge.llm.bitsliced import Block, search
from quillforge.llm.html import best_paths, extract_main_text, judge, read_page, text_on, winning_paths
from quillforge.llm.warc import archive_pages, list_frames, read_records, write_bundles

PAGES = "page_id long, url string, html string"


# Archives


def web_pages():
    r = random.Random(1)
    html = [None, "", "x", "<p>é\r\n\r\n</p>", "y" * 3000, "z" * 400_000]
    rows = [(1000 + k, None if k % 3 else "http://a b\r\nc", r.choice(html)) for k in range(60)]
    return rows + [(None, "u", "x"), (None, "u", "alone"), (5000, "u", "same"), (5000, "u", "same")]


def test_archives_give_back_every_page(spark):
    rows = web_pages()
    largest = {}
    for i, _, h in rows:
        largest[h or ""] = max(largest.get(h or "", -1), -1 if i is None else i)
    expected = []
    for i, _, h in rows:
        data, best = (h or "").encode(), largest[h or ""]
        revisit = best >= 0 and best != i
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        expected.append((i, len(data), digest, "revisit" if revisit else "response", best if revisit else None))
    got = archive_pages(spark.createDataFrame(rows, PAGES).repartition(3))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)
    assert archive_pages(spark.createDataFrame([], PAGES)).count() == 0


def test_small_payloads_are_all_responses(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")]
    bundles = write_bundles(spark.createDataFrame(rows, PAGES), min_bytes=3)
    got = read_records(list_frames(bundles)).select("page_id", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got)) == [(1, "response", None), (2, "response", None), (3, "revisit", 4), (4, "response", None)]


def test_bundles_are_plain_zstandard_and_roll(spark):
    rows = [(k, "http://h/", f"{k} " * 2000) for k in range(50)]
    bundles = write_bundles(spark.createDataFrame(rows, PAGES).coalesce(1), frame_bytes=20_000, bundle_bytes=4_000)
    assert bundles.count() > 1 and sum(b["records"] for b in bundles.collect()) == 50
    whole = b""
    for b in bundles.collect():
        store, path = fs.FileSystem.from_uri(b["path"]) if "://" in b["path"] else (fs.LocalFileSystem(), b["path"].removeprefix("file:"))
        with store.open_input_file(path) as source:
            whole += zstandard.ZstdDecompressor().stream_reader(source.read(), read_across_frames=True).read()
    assert whole.count(b"WARC/1.1\r\n") == 50
    frames = list_frames(bundles).collect()
    assert len(frames) > 10 and sorted(i for f in frames for i in f["ids"]) == list(range(50))


# Main text


def page(body, host="a.example", k=0):
    return (k, f"https://{host}/x{k}", f"<!DOCTYPE html><html><head><title>no</title><style>p{{}}</style></head><body>{body}</body></html>")


NOISE = (
    '<header><h1>Site name</h1></header><nav><ul><li><a href="/">Home</a></ul></nav><div id="cookie-notice">We use cookies here</div>'
    '<aside class="sidebar"><p>Side text that is long enough to matter, with commas, and more words.</p></aside>'
)
AFTER = '<section class="comments"><p>I disagree, said a reader, at some length and with many words.</p></section><form><p>Search</p></form><footer>Legal words</footer>'


def test_text_without_what_stands_around(spark):
    rows = [page(f'{NOISE}<div class="post-{k}"><h2>Title {k} &amp; more</h2><p>First   part<br>of a text, number {k}.<p>Second <b>part</b>, longer than the first one, &lt;tag&gt;.<script>no()</script></div>{AFTER}', k=k) for k in range(4)]
    got = {r["page_id"]: r["text"] for r in extract_main_text(spark.createDataFrame(rows, PAGES)).collect()}
    for k in range(4):
        assert got[k] == f"Title {k} & more\nFirst part of a text, number {k}.\nSecond part, longer than the first one, <tag>."


def test_archives_are_read_back_by_as_many_tasks_as_wrote_them(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").repartition(6)
    tasks = archive_pages(pages).groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) >= 4 and sum(r["count"] for r in tasks) == pages.count()


def test_the_host_outvotes_a_page(spark):
    article = '<div class="story"><p>A story of some length, told at ease, with commas.</p></div>'
    rows = [page(article + '<div class="links-42"><p>short</p></div>', k=k) for k in range(5)]
    rows.append(page('<div class="story"><p>Brief.</p></div><div class="links-7"><p>This box, for once, has far more words than the story itself has.</p></div>', k=9))
    rows.append((10, None, rows[-1][2]))
    got = {r["page_id"]: r["text"] for r in extract_main_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert got[9] == "Brief." and got[10].startswith("This box")


STORY = "".join(f"<p>Sentence {k} of a long story, told at ease, with many words and commas.</p>" for k in range(30))
SECOND = STORY.replace("Sentence", "Part")[: len(STORY) // 2 - 7] + "</p>"


@pytest.mark.parametrize(
    ("html", "first", "kept", "gone"),
    [
        # A heading and a lead beside the container that holds nearly everything.
        (f"<article><h1>Title</h1><p>The lead.</p><div class=body>{STORY}</div></article>", "Title\nThe lead.\nSentence 0", [], []),
        (f"<div class=wrap><h1>Title</h1><p>The lead.</p><div class=body>{STORY}</div></div>", "Title\nThe lead.\nSentence 0", [], []),
        # Unequal siblings under no article.
        (f"<div class=a>{SECOND}</div><div class=b>{STORY}</div><div class=c>Small box.</div>", "Part 0", ["Sentence 29"], ["Small box"]),
        # An article in several sections, one of them short.
        (f"<main><section class=x>{SECOND}</section><section class=y><p>Short one.</p></section><section class=z>{STORY}</section></main>", "Part 0", ["Short one.", "Sentence 29"], []),
        # Names on paragraphs of the article, and on boxes within it.
        (f"<article>{STORY}<p id=notice>The notice was posted.</p><div class=share>Share this</div><p class=advert>Buy now</p></article>", "Sentence 0", ["The notice was posted."], ["Share", "Buy"]),
        # Links around the story are not part of it.
        (f"<div class=wrap><a href=/a>One</a> <a href=/b>Two</a> <a href=/c>Three</a><div class=body>{STORY}</div></div>", "Sentence 0", [], ["One", "Three"]),
    ],
)
def test_what_belongs_to_the_article(spark, html, first, kept, gone):
    around = "<header><h2>Site</h2></header><nav><a href=/>Home</a></nav>{}<footer>Imprint</footer>"
    rows = [(k, f"http://host.example/{k}", f"<html><body>{around.format(html)}</body></html>") for k in range(3)]
    for r in extract_main_text(spark.createDataFrame(rows, PAGES)).collect():
        assert r["text"].startswith(first) and "Sentence 29" in r["text"]
        assert all(x in r["text"] for x in kept) and not any(x in r["text"] for x in [*gone, "Site", "Home", "Imprint"])


def test_paths_that_win_are_few(spark):
    rows = [(k, "http://host.example/", f"<body><div class='{chr(97 + k % 26)}{chr(97 + k // 26)}'>{STORY}</div></body>") for k in range(200)]
    pages = spark.createDataFrame(rows, PAGES)
    assert [len(r["paths"]) for r in winning_paths(pages).collect()] == [1]
    assert {r["text"].count("\n") for r in extract_main_text(pages).collect()} == {29}


def test_pages_of_the_tables(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r["page_id"]: r for r in extract_main_text(pages).collect()}
    assert len(got) == pages.count()
    for p in pages.collect():
        article = re.search(r"<article>(.*)</article>", p["html"], re.DOTALL)[1]
        assert got[p["page_id"]]["n_chars"] == len(got[p["page_id"]]["text"])
        assert "".join(re.sub(r"<[^>]*>", "", article).replace("&amp;", "&").replace("&quot;", '"').split()) == "".join(got[p["page_id"]]["text"].split())


def test_awkward_pages(spark):
    rows = [(1, None, None), (2, "", ""), (3, "//h", "just text"), (None, "http://h", "<p>a"), (3, "//h", "just text"), (4, "http://h", "<!-- <p>x</p> -->"), (5, "x", "<p class='a>b'>c &eacute;</p")]
    got = sorted((tuple(r) for r in extract_main_text(spark.createDataFrame(rows, PAGES)).select("page_id", "text", "n_chars").collect()), key=str)
    assert got == sorted([(1, "", 0), (2, "", 0), (3, "just text", 9), (None, "a", 1), (3, "just text", 9), (4, "", 0), (5, "c é", 3)], key=str)
    assert extract_main_text(spark.createDataFrame([], PAGES)).count() == 0


@pytest.mark.parametrize("hostile", ["<script>" * 40_000, '<a "' * 40_000, "<div>" * 40_000, "<!--" * 50_000, "<p><b>" * 20_000, "</p>" * 40_000, "<div " + "a=b " * 100_000 + ">x", "<b>" + "<div>" * 20_000 + "</b>" * 20_000])
def test_hostile_pages_take_linear_time(hostile):
    began = time.process_time()
    nodes, runs = read_page(hostile)
    judge(nodes, runs)
    text_on([p for p, _ in best_paths(nodes, 1)] or None, nodes, runs)
    assert time.process_time() - began < 5


# Vectors


def brute_top(rows, k=20, every=20):
    kept = [(i, [int(np.floor(64 * float(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in {(i, tuple(v)) for i, v in kept if i % every == 0}:
        scored = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in kept if i != q and len(b) == len(a))
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def test_top_k_against_brute_force(spark):
    r = random.Random(2)
    common = [0.5, -0.25, 0.0]
    rows = [(k, common if r.random() < 0.4 else [r.uniform(-1, 1) for _ in range(3)]) for k in range(400)]
    rows += [(1000, None), (1001, [None, 1.0, 1.0]), (1020, [float("nan"), 1.0, 1.0]), (1040, [float("inf"), 0.0, 0.0]), (None, common)]
    rows += [(1060, [1.0, 2.0]), (1061, [-1.0, 1.0]), (1080, []), (1081, []), (40, rows[40][1]), (7, rows[7][1]), (-20, [1000.0, -3000.5, 7.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = sorted(map(tuple, search(df, block_rows=100, queries_together=7).collect()))
    assert got == brute_top([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows])
    assert search(df.limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 63, 64, 65, 500])
def test_block_selects_the_best_rows(n):
    r = np.random.default_rng(n)
    values, ids = r.integers(-9, 9, (n, 6)), r.permutation(n).astype(np.int64)
    block = Block(ids, values)
    for k in range(min(n, 10)):
        query = values[k].tolist()
        found, scores = block.top(query, int(ids[k]), 5)
        best = sorted((-int(np.dot(values[j], query)), int(ids[j])) for j in range(n) if j != k)[:5]
        assert sorted((-s, i) for s, i in zip(scores, found.tolist(), strict=True)) == best
