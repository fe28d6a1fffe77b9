"""Token ids of texts by a table of the words they are made of, for byte-level vocabularies.

The words of many texts are told apart by Arrow, each different one is looked up once, and
the ids of the texts are gathered from one array. New words fall into pre-tokens, and those
not met before go to the tokenizer's model, many in one call.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Characters of the longest word that is remembered, and bytes of texts that are split at once.
LONGEST, TOGETHER = 64, 1 << 21
#: Stands between pre-tokens; it is in none of them.
BETWEEN = "￿"
#: Marks cuts; a word that has it is not split here.
MARK = "\x01"
#: Pre-tokens in a text for the model, which takes long texts more slowly.
IN_A_TEXT = 64


class Rows:
    """Rows of numbers, one after another in a growing array."""

    def __init__(self, kind: str):
        self.clear(kind)

    def clear(self, kind: str | None = None) -> None:
        self.values, self.bounds = np.zeros(1 << 10, kind or self.values.dtype), np.zeros(1 << 10, np.int64)
        self.n = 0

    def append(self, values: np.ndarray, lengths: np.ndarray) -> None:
        at = int(self.bounds[self.n])
        for name, array, need in (("values", self.values, at + len(values)), ("bounds", self.bounds, self.n + len(lengths) + 1)):
            if need > len(array):
                grown = np.zeros(max(need, 2 * len(array)), array.dtype)
                grown[: len(array)] = array
                setattr(self, name, grown)
        self.values[at : at + len(values)] = values
        self.bounds[self.n + 1 : self.n + 1 + len(lengths)] = at + np.cumsum(lengths)
        self.n += len(lengths)

    def lengths(self, rows: np.ndarray) -> np.ndarray:
        return self.bounds[rows + 1] - self.bounds[rows]

    def gather(self, rows: np.ndarray) -> np.ndarray:
        """The values of the rows, one row after another."""
        lengths = self.lengths(rows)
        ends = np.cumsum(lengths)
        shift = np.repeat(self.bounds[rows] - (ends - lengths), lengths)
        return self.values[shift + np.arange(len(shift))]


def sums(lengths: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of the lengths between consecutive bounds."""
    total = np.concatenate([[0], np.cumsum(lengths)])
    return total[bounds[1:]] - total[bounds[:-1]]


class BytePieces:
    """The model of a byte-level tokenizer: ids of pre-tokens, many at once."""

    def __init__(self, tokenizer: object):
        from tokenizers import Tokenizer, pre_tokenizers

        self.plain = Tokenizer(tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        # Fixed rule of byte-level vocabularies: printable signs of Latin-1 stand for their bytes, the other bytes for signs from 256 on.
        others = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
        self.signs = np.arange(256, dtype="<u4")
        self.signs[others] = 256 + np.arange(len(others))
        self.between = self.mapped(BETWEEN)

    def mapped(self, text: str) -> str:
        return self.signs[np.frombuffer(text.encode(), np.uint8)].tobytes().decode("utf-32-le")

    def encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each piece); no piece is empty."""
        mapped, ids, n = self.mapped(BETWEEN.join(pieces)).split(self.between), [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        # What the tokenizer returns is large, so it is for some texts only.
        for start in range(0, len(mapped), 64 * IN_A_TEXT):
            own = mapped[start : start + 64 * IN_A_TEXT]
            for x in self.plain.encode_batch([" ".join(own[k : k + IN_A_TEXT]) for k in range(0, len(own), IN_A_TEXT)], add_special_tokens=False):
                ids.append(np.array(x.ids, np.uint32))
                n.append(np.bincount(np.array(x.word_ids, np.int64), minlength=IN_A_TEXT))
        return np.concatenate(ids), np.concatenate(n)[: len(pieces)]


def split_all(words: pa.Array, pattern: str) -> tuple[pa.Array, np.ndarray]:
    """(pre-tokens of all words, number of each word's); the words are without ``MARK`` and the pattern leaves out no sign."""
    lists = pc.split_pattern(pc.replace_substring_regex(words, f"({pattern})", rf"{MARK}\1"), MARK)
    # What is before the first mark is empty.
    first, flat = lists.offsets.to_numpy() - lists.offsets[0].as_py(), lists.flatten()
    kept = np.ones(len(flat), bool)
    kept[first[:-1]] = False
    return flat.filter(pa.array(kept)), np.diff(first) - 1


class WordTable:
    """Ids of words. ``decompose`` gives, of an array of words, the places of those whose pre-tokens are known, all their
    pre-tokens, and the number of each one's; the others only the tokenizer itself knows.

    At most about ``words`` words and ``pieces`` pre-tokens are remembered, some 150 bytes each; then it starts again.
    """

    def __init__(self, path: str, decompose: Callable[[pa.Array], tuple[np.ndarray, pa.Array, np.ndarray]], words: int = 600_000, pieces: int = 400_000):
        self.most_words, self.most_pieces = words, pieces
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task
        from tokenizers import Tokenizer

        # What a worker's earlier tasks of other stages left with Arrow is not needed any more.
        pa.default_memory_pool().release_unused()
        self.tokenizer, self.decompose = Tokenizer.from_file(path), decompose
        self.model = BytePieces(self.tokenizer)
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.words, self.ids = {}, Rows(self.kind)
        self.pieces, self.piece_ids = {}, Rows(self.kind)

    def whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each text), by the tokenizer itself."""
        found = [np.array(x.ids, self.kind) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate([*found, np.zeros(0, self.kind)]), np.array([len(x) for x in found], np.int64)

    def _piece_rows(self, pieces: pa.Array) -> np.ndarray:
        """The row of each pre-token, in ``piece_ids``."""
        coded = pieces.dictionary_encode()
        different = coded.dictionary.to_numpy(zero_copy_only=False)
        found = [*map(self.pieces.get, different)]
        new = [k for k, row in enumerate(found) if row is None]
        if new:
            for row, k in enumerate(new, self.piece_ids.n):
                found[k] = row
            own = different[new].tolist()
            self.pieces.update(zip(own, range(self.piece_ids.n, self.piece_ids.n + len(own)), strict=True))
            self.piece_ids.append(*self.model.encode(own))
        return np.array(found, np.int64)[coded.indices.to_numpy()]

    def encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each word), without remembering the words."""
        if len(self.pieces) > self.most_pieces:
            self.pieces.clear()
            self.piece_ids.clear()
        known, flat, counts = self.decompose(words)
        unknown = np.ones(len(words), bool)
        unknown[known] = False
        rest, pieces, found = np.flatnonzero(unknown), self._piece_rows(flat), Rows(self.kind)
        found.append(self.piece_ids.gather(pieces), sums(self.piece_ids.lengths(pieces), np.concatenate([[0], np.cumsum(counts)])))
        found.append(*self.whole(words.take(pa.array(rest)).to_pylist()))
        rows = np.argsort(np.concatenate([known, rest]))
        return found.gather(rows), found.lengths(rows)

    def _learn(self, words: pa.Array) -> np.ndarray:
        """The row of each word, none of which is in the table."""
        rows = np.arange(self.ids.n, self.ids.n + len(words))
        self.ids.append(*self.encode(words))
        kept = np.flatnonzero(pc.utf8_length(words).to_numpy() <= LONGEST)
        self.words.update(zip(words.take(pa.array(kept)).to_numpy(zero_copy_only=False), rows[kept].tolist(), strict=True))
        return rows

    def rows(self, words: pa.Array) -> np.ndarray:
        """The row of each word, in ``ids``. Rows hold until the next call."""
        if len(self.words) > self.most_words:
            self.words.clear()
            self.ids.clear()
        coded = words.dictionary_encode()
        found = [*map(self.words.get, coded.dictionary.to_numpy(zero_copy_only=False))]
        new = [k for k, row in enumerate(found) if row is None]
        if new:
            for k, row in zip(new, self._learn(coded.dictionary.take(pa.array(new))).tolist(), strict=True):
                found[k] = row
        return np.array(found, np.int64)[coded.indices.to_numpy()]


def runs(batches: Iterator[pa.RecordBatch], column: int = 1) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in their order, as many at a time as have ``TOGETHER`` bytes of text (one more row may pass that)."""
    held, size = [], 0
    for batch in batches:
        start = 0
        for k, n in enumerate(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()):
            size += n
            if size >= TOGETHER:
                yield pa.concat_batches([*held, batch.slice(start, k + 1 - start)])
                held, size, start = [], 0, k + 1
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if held:
        yield pa.concat_batches(held)
