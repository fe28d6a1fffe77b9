"""Huffman-coded token files: codes against brute force, texts against the tokenizer, files against what went in."""

import io
import itertools
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quillforge.llm import tokenfile
from quillforge.llm.tokenfile import Code, TokenReader, TokenWriter, code_lengths, read_token_files, round_trip, write_token_files

PATH = public_tokenizers.path("word_bpe_49k.json")


class Memory(io.BytesIO):
    def close(self):
        pass

    def size(self):
        return len(self.getvalue())

    def read_at(self, n, at):
        return self.getvalue()[at : at + n]


def cheapest(counts, limit):
    """The least total length of prefix codes, by trying all lengths that Kraft's inequality allows."""
    fitting = (x for x in itertools.product(range(1, limit + 1), repeat=len(counts)) if sum(2.0**-k for k in x) <= 1)
    return min(sum(n * k for n, k in zip(counts, x, strict=True)) for x in fitting)


@pytest.mark.parametrize("counts", [[1, 1], [5, 1, 1], [1, 2, 4, 8, 16], [7, 7, 7, 7, 7], [100, 1, 1, 1, 1, 1]])
def test_code_lengths_are_the_best_within_the_limit(counts):
    for limit in (3, 4):
        lengths = code_lengths(np.array(counts), limit)
        assert lengths.max() <= limit and sum(2.0 ** -lengths.astype(float)) == 1
        assert (lengths * counts).sum() == cheapest(counts, limit)


def test_code_lengths_at_the_edges():
    assert code_lengths(np.zeros(4, np.int64)).tolist() == [0, 0, 0, 0]
    assert code_lengths(np.array([0, 3, 0])).tolist() == [0, 1, 0]
    assert code_lengths(np.ones(16, np.int64), 2).tolist() == [4] * 16  # more symbols than two bits can tell apart


def test_stream_of_any_lengths_and_any_range():
    rng = np.random.default_rng(1)
    docs = [rng.zipf(1.2, n) % 300 for n in (0, 1, 511, 512, 513, 0, 5000, 1, 699, 700, 701, 0)]
    everything = np.concatenate(docs)
    code = Code.of(code_lengths(np.bincount(everything, minlength=300), 11))
    stream = Memory()
    writer = TokenWriter(stream, code, 700)
    for k, d in enumerate(docs):
        writer.add(None if k == 3 else k, d)
    writer.close()
    reader = TokenReader(stream)
    assert reader.documents["n"].tolist() == [len(d) for d in docs] and reader.documents["null"].tolist() == [k == 3 for k in range(len(docs))]
    assert (np.concatenate(list(reader.windows())) == everything).all()
    for first, last in ((0, 1), (511, 513), (512, 1024), (1000, 4321), (len(everything) - 1, len(everything))):
        assert np.concatenate(list(reader.windows(first, last))).tolist() == everything[first:last].tolist()
    got = [[] for _ in docs]
    for k, ids in reader.pieces():
        got[k] += ids.tolist()
    assert got == [d.tolist() for d in docs]


def test_stream_of_one_symbol():
    stream = Memory()
    writer = TokenWriter(stream, Code.of(code_lengths(np.array([0, 9]))))
    writer.add(1, np.ones(9, np.int64))
    writer.close()
    assert np.concatenate(list(TokenReader(stream).windows())).tolist() == [1] * 9


TEXTS = [
    "Plain words, don't THEY'LL 'sabotage' it's 1234 a1b2",
    "École Überraß ÿ Ÿ İstanbul ŉ ĸ Ωμέγας ΣΑΣ ",
    "éclair ́alone a b c\u0085d\x1ce\tf\r\n\n  g",
    "<|endoftext|> x<|startoftext|>y <|endof <| |>",
    "日本語のテキスト 한국어 🙂🙂 ﬁ ﻿​ \x00 ￿",
    "- -- ... '' 's' 're're",
    "x" * 3000 + " " + "9" * 200,
]


def test_ids_are_those_of_the_tokenizer():
    import pyarrow as pa

    want = [x.ids for x in Tokenizer.from_file(PATH).encode_batch(TEXTS, add_special_tokens=False)]
    encoder = tokenfile.text_ids(PATH)
    for _ in range(2):
        ids, lengths = encoder.ids(pa.array(TEXTS))
        assert [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])] == want


def expected(rows):
    encode = Tokenizer.from_file(PATH).encode
    ids = [(i, encode(t or "", add_special_tokens=False).ids + [1]) for i, t in rows]
    return [(i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in ids]


def test_awkward_rows(awkward):
    got = round_trip(awkward, PATH).collect()
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    assert sorted((r["doc_id"] or -1, r["n_tokens"], r["ids_crc32"]) for r in got) == sorted((i or -1, n, c) for i, n, c in expected(rows))
    place = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == place
        place += r["n_tokens"]
    ids = [r["doc_id"] or 0 for r in sorted(got, key=lambda r: r["start"])]
    assert ids == sorted(ids)
    assert round_trip(awkward.limit(0), PATH).count() == 0


def test_several_files_a_task_and_their_ids(spark):
    rows = [(k % 7, "words of " + "many kinds " * (k % 5) + str(k)) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    files = write_token_files(docs, PATH, file_bytes=100)
    assert files.count() > 3
    got = read_token_files(files, with_ids=True).collect()
    want = sorted((i, zlib.crc32(t)) for i, t in ((r["doc_id"], bytes(r["ids"])) for r in got))
    assert want == sorted((i, c) for i, _, c in expected(rows))
