"""Alignment of two tokenizers against whole texts taken by the letter of the definition."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from quillforge.llm import alignment, wordtable
from quillforge.llm.alignment import align_documents, document_scores, pack_postings, pair_index, pair_table, unpack_bitmap, unpack_planes

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def tokens():
    """Functions from a text to [(id, bytes)] on both sides."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = {chr(x): x for x in printable}
    signs |= {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in printable)}

    def left(text):
        return [(k, bytes(signs[c] for c in a.id_to_token(k))) for k in a.encode(" " + text, add_special_tokens=False).ids]

    def right(text):
        out = []
        for k in b.encode(text):
            piece = b.id_to_piece(k)
            out.append((k, bytes([b_of(piece)]) if b.is_byte(k) else piece.replace("▁", " ").encode()))
        return out

    def b_of(piece):
        return int(piece[3:5], 16)

    return left, right


def expected(rows):
    left, right = tokens()
    found = []
    for doc_id, text in rows:
        a, b = (left(text), right(text)) if text else ([], [])
        want = b" " + (text or "").encode()
        if b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
            found.append((doc_id, 0, 0, [], Counter()))
            continue
        ends_a, ends_b = np.cumsum([len(x) for _, x in a]), np.cumsum([len(x) for _, x in b])
        cuts = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
        groups, links, i, j = [], Counter(), 0, 0
        for up_to_a, up_to_b in zip(np.searchsorted(ends_a, cuts, "right"), np.searchsorted(ends_b, cuts, "right"), strict=True):
            own = [[k for k, _ in a[i:up_to_a]], [k for k, _ in b[j:up_to_b]]]
            groups.append(own)
            links.update((x, y) for x in own[0] for y in own[1])
            i, j = up_to_a, up_to_b
        found.append((doc_id, len(a), len(b), groups, links))
    counts = Counter(pair for *_, links in found for pair in links)
    highest = Counter()
    for (x, _), n in counts.items():
        highest[x] = max(highest[x], n)
    out = []
    for doc_id, n_a, n_b, groups, links in found:
        shown = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        best = sum(n for p, n in links.items() if counts[p] == highest[p[0]])
        total = sum(n * counts[p] for p, n in links.items())
        out.append((doc_id, n_a, n_b, len(groups), sum(links.values()), best, total, hashlib.sha256(shown.encode()).hexdigest() if shown else ""))
    return out, counts, highest


TEXTS = [
    "Plain words, don't split (much) at 1234.5 or a_b-c; the end.",
    "  two  spaces   and\n\nlines \n then\ttabs \r\n end  ",
    "École naïve Überraß   nbsp x  em \x1cfs \x00nul",
    "日本語 のテキスト한국어 🙂🙂 ﬁ ﻿​ é́",
    "<|endoftext|> <s> </s> <unk> <0x41> ▁ a▁b",
    "the the the the cat cat the",
    "x" * 300 + " " + "ab" * 200 + "  ",
    " leading",
    "\n",
    " ",
]


def same(got, rows):
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(expected(rows)[0], key=key)


def test_texts_by_the_letter(spark):
    rows = [*enumerate(TEXTS), (3, TEXTS[0]), (3, TEXTS[0]), (None, TEXTS[0]), (None, None), (20, ""), (21, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    same(align_documents(docs, A, B).collect(), rows)
    want, counts, highest = expected(rows)
    # A text with the sign for a space is spelt otherwise by the pieces.
    assert [r[1] for r in want if r[0] == 4] == [0]
    table = {(r["a_id"], r["b_id"]): (r["documents"], r["best"]) for r in pair_table(pair_index(docs, A, B)).collect()}
    assert table == {p: (n, n == highest[p[0]]) for p, n in counts.items()}


def test_documents_of_the_smallest_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    same(align_documents(docs, A, B).collect(), [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])


def test_several_chunks_a_task(spark, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK_DOCUMENTS", 16)
    rows = [(k, f"common words {'and more ' * (k % 40)} of {k % 11}") for k in range(100)]
    index = pair_index(spark.createDataFrame(rows, "doc_id long, text string").repartition(2), A, B).cache()
    assert index.select("chunk").distinct().count() > 5
    same(document_scores(index).collect(), rows)
    index.unpersist()


@pytest.mark.parametrize("size", [1, 9, 700])
def test_postings_unpack_to_what_was_packed(size):
    rng = np.random.default_rng(size)
    held = {(int(p), int(d)): int(rng.zipf(1.5) % 100_000 + 1) for p, d in rng.integers(0, [12, size], (3 * size, 2))}
    keys = sorted(held)
    pairs, documents = (np.array(x) for x in zip(*keys, strict=True))
    got = {}
    for pair, n, bitmap, planes in zip(*pack_postings(pairs, documents, np.array([held[k] for k in keys]), size), strict=True):
        for d, c in zip(unpack_bitmap(bitmap, n, size).tolist(), unpack_planes(planes, n).tolist(), strict=True):
            got[int(pair), d] = c
    assert got == held


def test_awkward_rows(spark, awkward):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect() if r["doc_id"] not in (7, 8)]
    got = align_documents(awkward, A, B).collect()
    assert len(got) == awkward.count()
    by_id = lambda x: Counter((r[0], *r[1:5], r[7]) for r in x)
    assert by_id(map(tuple, (r for r in got if r["doc_id"] not in (7, 8)))) == by_id(expected(rows)[0])
    assert align_documents(awkward.limit(0), A, B).count() == 0


def test_runs_of_short_batches_with_odd_spaces(monkeypatch):
    monkeypatch.setattr(alignment, "WORDS", 40)
    monkeypatch.setattr(wordtable, "TOGETHER", 300)
    r = random.Random(5)
    bits = [" ", " ", "  ", "\n", " \n", " ", "　", "\x01", "\x1c", "a", "don't", "The", "日本", "é", "<|endoftext|>", "▁", "x" * 70, "42"]
    texts = [*TEXTS, "", *("".join(r.choice(bits) for _ in range(r.randint(0, 15))) for _ in range(400))]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[k : k + 2], pa.string())], ["text"]) for k in range(0, len(texts), 2)]
    both = alignment.Aligner(A, B)
    got = [x for run in wordtable.runs(iter(batches), 0) for x in both.documents(run.column(0))]
    found, *_ = expected(list(enumerate(texts)))
    shown = [hashlib.sha256(s.encode()).hexdigest() if s else "" for *_, s, _, _ in got]
    assert [(*x[:3], int(x[5].sum()), d) for x, d in zip(got, shown, strict=True)] == [(*x[1:5], x[7]) for x in found]
    both.by_words = False  # as where a piece reaches over a space
    both.clear()
    assert [x[:4] for x in both.documents(pa.array(texts))] == [x[:4] for x in got]
