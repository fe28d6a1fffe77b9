"""Token counts by a unigram vocabulary, without making the tokens.

Aho-Corasick lists every piece of the vocabulary that ends at a sign; dynamic
programming carries the best score and the number of pieces on the way to it. The
result is the number of tokens of the exact tokenizer, ties included: of two ways
with equal scores the one whose last piece starts earlier wins, an unknown sign
costs ten more than the worst piece, and unknown signs in a row are one token, or the
bytes that they are made of where the vocabulary has pieces for bytes.

No piece of the usual vocabularies has a space behind another sign, so a text's words,
each with the spaces before it, are counted by themselves and remembered.
"""

from __future__ import annotations

import math
import re
import sys
import types
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the tokenizer: the sign that stands for a space, and what an unknown sign costs beyond the worst piece.
SPACE, UNKNOWN_PENALTY = "▁", 10.0
#: Scores are multiples of this, so that their sums are exact in any order.
GRAIN = 2.0**-16
#: Distinct words whose counts a worker remembers.
REMEMBERED = 700_000


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with their scores; ``unknown`` is the piece, if any, that stands for unknown signs, unless ``bytes`` do."""

    pieces: tuple[tuple[str, float], ...]
    unknown: str | None = None
    bytes: bool = False


def vocabulary_of(path: str) -> Vocabulary:
    """The pieces of a sentence-piece model that are text, in their order, with scores by Zipf's law.

    The rank of a piece in the file is all that is used: its score is the logarithm of
    1 / (rank + 1), rounded to ``GRAIN``.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = [model.id_to_piece(k) for k in range(model.get_piece_size()) if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k))]
    has_bytes = any(model.is_byte(k) for k in range(model.get_piece_size()))
    return Vocabulary(tuple((t, -round(math.log(rank + 2) / GRAIN) * GRAIN) for rank, t in enumerate(texts)), bytes=has_bytes)


class Counts(dict):
    """Number of tokens of words, each counted when it is first asked for."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces:
            self.automaton.add_word(piece, (len(piece), score, piece == vocabulary.unknown))
        self.automaton.make_automaton()
        self.unknown = min(s for _, s in vocabulary.pieces) - UNKNOWN_PENALTY
        self.bytes = vocabulary.bytes
        pieces = [p for p, _ in vocabulary.pieces]
        # Otherwise a piece, or a run of unknown signs, can reach over the start of a word.
        self.by_words = SPACE in pieces and not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces)

    def __missing__(self, word: str) -> int:
        n = self[word] = self.count(SPACE + word)
        return n

    def count(self, text: str) -> int:
        ends: list[list[tuple[int, float, bool]]] = [[] for _ in text]
        for end, found in self.automaton.iter(text):
            ends[end].append(found)
        best, pieces, unknown = [0.0], [0], [False]
        for end, found in enumerate(ends):
            # Longest piece first: it starts earliest and keeps its place on a tie.
            score, start, is_unknown, single = -math.inf, end, False, False
            for length, own, stands in found:
                single |= length == 1
                if (at := best[end + 1 - length] + own) > score:
                    score, start, is_unknown = at, end + 1 - length, stands
            if not single and (at := best[end] + self.unknown) > score:
                score, start, is_unknown = at, end, True
            best.append(score)
            if is_unknown and self.bytes:
                pieces.append(pieces[start] + len(text[start : end + 1].encode("utf-8", "surrogatepass")))
            else:
                pieces.append(pieces[start] + (not (is_unknown and unknown[start])))
            unknown.append(is_unknown)
        return pieces[-1]

    def tokens(self, text: str) -> int:
        """Tokens of a text: a word is what follows a space and the spaces before it; a text that starts without a space gets one."""
        if not text:
            return 0
        text = text.replace(" ", SPACE)
        if not text.startswith(SPACE):
            text = SPACE + text
        if not self.by_words:
            return self.count(text)
        if len(self) > REMEMBERED:
            self.clear()
        # The first space of each word is left out, as all have it.
        words = text.split(SPACE)[1:] if SPACE + SPACE not in text else [w[1:] for w in self.starts(text)]
        return sum(map(self.__getitem__, words))

    starts = staticmethod(re.compile(f"(?<=[^{SPACE}])(?={SPACE})").split)


def counts_of(path: str) -> Counts:
    """This worker's counts, kept from one task to the next."""
    kept = sys.modules.setdefault("_kept_by_worker", types.ModuleType("_kept_by_worker")).__dict__
    key = f"counts {path}"
    if key not in kept:
        kept[key] = Counts(vocabulary_of(path))
    return kept[key]


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_chars, n_tokens of every row of ``docs`` (doc_id, text; other columns are ignored).

    n_tokens is the exact number by a unigram model of the file's pieces; as no file with trained scores is at hand,
    the scores are those of ``vocabulary_of``, Zipf's law of the pieces' ranks. Null and empty texts have no tokens;
    repeated rows are repeated; texts of any length are taken whole.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counts_of(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            columns = [batch.column(0), pa.array(map(len, texts), pa.int64()), pa.array(map(counts.tokens, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_chars", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(count, "doc_id long, n_chars long, n_tokens long")
