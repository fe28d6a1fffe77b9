"""Grammar extensions and periodic runs against brute force."""

import hashlib
import re
from zlib import crc32

import numpy as np
import pytest

from quillforge.llm.periodic import detect, planted, runs_of
from quillforge.llm.recompression import Grammar


def sequences(rng, n):
    """Random, periodic, and periodic but for one place, over small alphabets."""
    kind = rng.integers(3)
    if kind == 0:
        return rng.integers(0, rng.integers(1, 5), n)
    t = np.tile(rng.integers(0, 3, rng.integers(1, 8)), n)[:n]
    if kind == 2 and n:
        t[rng.integers(n)] = 7
    return t


@pytest.mark.parametrize("seed", range(20))
def test_extensions_of_all_pairs(seed):
    rng = np.random.default_rng(seed)
    inner = sequences(rng, int(rng.integers(1, 90)))
    words = np.concatenate([[90], inner, [91]])
    a, b = np.triu_indices(len(inner), 1)
    a, b = a + 1, b + 1
    grammar = Grammar(words, 2)

    def common(x, y, way):
        n = 0
        while words[x + way * n] == words[y + way * n]:
            n += 1
        return n

    assert grammar.forward(a, b).tolist() == [common(x, y, 1) for x, y in zip(a, b, strict=True)]
    assert grammar.backward(a, b).tolist() == [common(x - 1, y - 1, -1) for x, y in zip(a, b, strict=True)]


def test_grammar_is_small_where_the_sequence_repeats():
    grammar = Grammar(np.concatenate([np.tile([1, 2, 3], 100_000), [4]]))
    assert len(grammar.levels) < 40 and sum(len(x.symbols) for x in grammar.levels) < 10 * 300_001


def brute(words, least, exponent):
    """Every stretch with a period that neither side extends, by trying all periods."""
    n, found = len(words), {}
    for q in range(1, n + 1):
        at = 0
        while at + q < n:
            end = at
            while end + q < n and words[end] == words[end + q]:
                end += 1
            if end > at and end - at + q >= max(least, exponent * q):
                found.setdefault((at, end - at + q), q)
            at = end + 1
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("seed", range(30))
def test_runs_of_several_sequences(seed):
    rng = np.random.default_rng(seed)
    texts = [sequences(rng, int(rng.integers(0, 70))) for _ in range(rng.integers(1, 8))]
    for least, exponent in ((6, 4), (2, 2), (1, 3)):
        want = [(k, *r) for k, t in enumerate(texts) for r in brute(t.tolist(), least, exponent)]
        assert runs_of(texts, least, exponent).tolist() == want


def expected(doc_id, text):
    """The result's row by the letter of its definition."""
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    n = len(words)
    h = None if doc_id is None else crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words, 6, 4)
    gone = {k for s, length, q in runs for k in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else None
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
    strongest = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *strongest, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_documents_by_the_letter(spark):
    rng = np.random.default_rng(5)
    rows = [(k, " ".join(f"w{x}" for x in sequences(rng, int(rng.integers(0, 120)))) + "\n\t x") for k in range(150)]
    rows += [(k, None) for k in (10, 11)] + [(k, "") for k in range(200, 240)] + [(7, "ha " * 9), (7, "ha " * 9), (None, "a b " * 8)]
    got = detect(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), prepare=planted).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted((expected(*r) for r in rows), key=key)
    assert sum(r["n_runs"] for r in got) > 100


def test_awkward_rows(spark, awkward):
    got = detect(awkward, prepare=planted, with_runs=True).collect()
    assert len(got) == awkward.count()
    # The sequence of one repeated word, unless its id plants another period, is one run of period 1 at any length.
    long = next(r for r in got if r["doc_id"] == 7)
    assert (long["n_runs"], long["start"], long["length"], long["period"], long["exponent_milli"]) == (1, 0, 20_000, 1, 20_000_000)
    assert long["collapsed"] == b"word" and [tuple(r) for r in long["runs"]] == [(0, 20_000, 1)]
    none = hashlib.sha256(b"").hexdigest()
    for r in got:
        if r["doc_id"] in (1, 2, 3):
            assert tuple(r)[1:8] == (0, None, None, None, None, none, none)
    assert detect(awkward.limit(0)).count() == 0
