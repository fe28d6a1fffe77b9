"""Words of many texts at a time: which texts are taken together, and ids against the tokenizers."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from quillforge.llm import packing, tokenfile, wordtable
from quillforge.llm.wordtable import runs


def test_short_batches_are_taken_together(monkeypatch):
    monkeypatch.setattr(wordtable, "TOGETHER", 100)
    texts = [None if k % 7 == 0 else "x" * (k % 40) for k in range(300)] + ["y" * 5000, "", None]
    column = pa.array(texts, pa.string())
    batches = [pa.RecordBatch.from_arrays([pa.array(range(k, min(k + 3, len(texts)))), column.slice(k, 3)], ["doc_id", "text"]) for k in range(0, len(texts), 3)]
    got = list(runs(iter(batches)))
    assert [x for r in got for x in r.column(0).to_pylist()] == list(range(len(texts)))
    assert [x for r in got for x in r.column(1).to_pylist()] == texts
    sizes = [[len(t or "") for t in r.column(1).to_pylist()] for r in got]
    assert all(sum(s) >= 100 > sum(s[:-1]) for s in sizes[:-1]) and len(got) < len(batches) / 1.5
    assert not list(runs(iter([])))


BITS = ["a", "The", "don't", "'s", "'", " ", "  ", "\n", "\t", "1", "23", "é", "Ā", "日本", "🙂", "\x01", "<|endoftext|>", "<|", ".", "!?", "$", "^", "\\1", "x" * 70, "\x1c", "\u0085"]


@pytest.mark.parametrize(("module", "name"), [(packing, "byte_bpe_50k.json"), (tokenfile, "word_bpe_49k.json")])
def test_odd_words_get_the_tokenizers_ids(module, name):
    path, r = public_tokenizers.path(name), random.Random(3)
    texts = ["".join(r.choice(BITS) for _ in range(r.randint(0, 12))) for _ in range(2000)] + ["", " "]
    encoder, tokenizer = module.TextIds(path), Tokenizer.from_file(path)
    encoder.table.most_words = encoder.table.most_pieces = 300  # starts again between the calls
    for at in range(0, len(texts), 250):
        ids, lengths = encoder.ids(pa.array(texts[at : at + 250], pa.string()))
        want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts[at : at + 250]]
        assert lengths.tolist() == [len(x) for x in want]
        assert ids.tolist() == [k for x in want for k in x]


def test_the_model_gets_each_pre_token_once(monkeypatch):
    encoder, asked = packing.TextIds(public_tokenizers.path("byte_bpe_50k.json")), []
    encode = encoder.table.model.encode
    monkeypatch.setattr(encoder.table.model, "encode", lambda pieces: asked.extend(pieces) or encode(pieces))
    for n in (1, 200):  # more than go to the model in one text
        encoder.ids(pa.array([" ".join(f"w{k}y ({k}" for k in range(n))] * 3))
    assert len(asked) == len(set(asked)) and {"w", " w", "y", " (", "199"} <= set(asked)
    assert np.array_equal(encoder.ids(pa.array(["w7y (7"]))[0], encoder.table.tokenizer.encode("w7y (7").ids)
