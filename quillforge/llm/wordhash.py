"""Hashes of the words of a text and of runs of words, a whole text at a time."""

from __future__ import annotations

import numpy as np

# Odd multipliers of the polynomial hashes and of the final mix.
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
MIX_1, MIX_2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
#: Bytes hashed at once; a text is cut between words.
AT_ONCE = 1 << 18
#: Bytes of short texts hashed together.
TOGETHER = 1 << 16

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_powers = np.ones((2, 1), np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * MIX_1
    x = (x ^ (x >> np.uint64(33))) * MIX_2
    return x ^ (x >> np.uint64(33))


def powers(n: int) -> np.ndarray:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of them."""
    global _powers
    if _powers.shape[1] < n:
        steps = np.ones((2, max(n, AT_ONCE + 2)), np.uint64)
        steps[0, 1:], steps[1, 1:] = BASE, BASE_INVERSE
        _powers = np.cumprod(steps, axis=1, dtype=np.uint64)
    return _powers


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words, which are runs of bytes other than space and 9 to 13."""
    space = np.ones(len(data) + 2, bool)
    space[1:-1] = _SPACE[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(space[1:] != space[:-1])
    return edges[::2], edges[1::2]


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of every word, in order."""
    parts, start = [], 0
    while start < len(data):
        end = min(len(data), start + AT_ONCE)
        if end < len(data):
            spaces = np.flatnonzero(_SPACE[np.frombuffer(data, np.uint8, end - start, start)])
            if len(spaces):
                end = start + int(spaces[-1]) + 1
            else:  # one long word
                rest = np.flatnonzero(_SPACE[np.frombuffer(data, np.uint8, offset=end)])
                end = end + int(rest[0]) if len(rest) else len(data)
        parts.append(_hashes(data[start:end]))
        start = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def texts_word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``word_hashes`` of all texts one after the other, and how many words each has; short texts are hashed together."""
    parts, counts, start = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    sizes = np.array([len(t) for t in texts], np.int64)
    while start < len(texts):
        end = start + max(1, int(np.searchsorted(np.cumsum(sizes[start : start + TOGETHER] + 1), TOGETHER, "right")))
        if sizes[start] > TOGETHER:
            parts.append(word_hashes(texts[start]))
            counts.append(np.array([len(parts[-1])]))
        else:  # white space between them, so that no word reaches over
            data = b" ".join(texts[start:end])
            first, last = word_spans(data)
            parts.append(_span_hashes(data, first, last))
            counts.append(np.diff(np.searchsorted(first, np.cumsum(sizes[start:end] + 1)), prepend=0))
        start = end
    return np.concatenate(parts), np.concatenate(counts)


def _hashes(data: bytes) -> np.ndarray:
    return _span_hashes(data, *word_spans(data))


def _span_hashes(data: bytes, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((np.frombuffer(data, np.uint8) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return mix((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64))


def run_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of every run of ``n`` consecutive words; none if there are fewer."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    up, down = powers(len(words) + 1)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up[: len(words)], out=sums[1:])
    return mix((sums[n:] - sums[:-n]) * down[: len(words) - n + 1] + np.uint64(n))


def shingles(text: str | None, n: int) -> np.ndarray:
    """The distinct hashes of the runs of ``n`` words, sorted; a shorter text that has words is one shingle."""
    words = word_hashes((text or "").encode("utf-8", "surrogatepass"))
    return np.unique(run_hashes(words, min(n, len(words)) or 1))
