"""Token counts of a unigram tokenizer without its tokens.

An Aho-Corasick automaton enumerates the vocabulary matches of a word by their ends;
dynamic programming carries, for each end, the best score and the number of pieces of the
path that has it. Rules of the tokenizer: of equal scores the path found first stays, which
is the one whose last piece is longest; a character without a piece of its own is unknown,
scores ten below the least piece and becomes as many pieces as it has bytes in UTF-8; a
space opens a word and is its first character.

Defined cases: a null or empty text has no pieces and score 0; text without spaces is one
word, whatever its length; every row is counted, also equal ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galley.llm.common import as_text, distinct_words, schema_of, slices

SPACE = "▁"  # U+2581
UNKNOWN_PENALTY = 10.0


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with their scores; the one numbered ``unknown`` stands for no text."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    unknown: int

    @property
    def unknown_score(self) -> float:
        return min(self.scores) - UNKNOWN_PENALTY


def vocabulary(path: str) -> Vocabulary:
    """Pieces and scores of a SentencePiece file, read as a unigram vocabulary."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    numbers = range(model.get_piece_size())
    return Vocabulary(tuple(map(model.id_to_piece, numbers)), tuple(map(model.get_score, numbers)), model.unk_id())


class Counter:
    """Best score and piece count of words."""

    def __init__(self, words: Vocabulary):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in zip(words.pieces, words.scores, strict=True):
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = words.unknown_score

    def count(self, word: str) -> tuple[float, int]:
        size = len(word)
        best, pieces = [0.0] * (size + 1), [0] * (size + 1)
        at, alone, reached = 0, True, True  # the end in work, and what is known of it

        def close(upto: int) -> None:
            """Finish ends before ``upto``: unknown characters take part last."""
            nonlocal at, alone, reached
            while True:
                if at and not alone:
                    score = best[at - 1] + self.unknown
                    if not reached or score > best[at]:
                        best[at], pieces[at] = score, pieces[at - 1] + len(word[at - 1].encode("utf-8", "surrogatepass"))
                if at + 1 > upto:
                    return
                at, alone, reached = at + 1, False, False

        for last, (length, score) in self.automaton.iter(word):
            end = last + 1
            if end != at:
                close(end)
            start = end - length
            total = best[start] + score
            if not reached or total > best[end]:
                best[end], pieces[end], reached = total, pieces[start] + 1, True
            if length == 1:
                alone = True
        close(size)
        return best[size], pieces[size]


def opened_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Words without the space that opens them; offsets of each text into them."""
    spaced = pc.replace_substring(texts, SPACE, " ")
    parts = pc.split_pattern(spaced, " ")
    offsets, words = parts.offsets.to_numpy(), parts.values
    first = offsets[:-1]
    keep = np.ones(len(words), bool)
    # what stands before a leading space is no word, nor is an empty text
    keep[first] = pc.greater(pc.binary_length(words.take(pa.array(first))), 0).to_numpy(zero_copy_only=False)
    return np.concatenate(([0], np.cumsum(keep)))[offsets], words.filter(pa.array(keep))


def _counted(words: Vocabulary, remembered: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(words)
        memo: dict[str, tuple[float, int]] = {}
        for batch in slices(batches, "__llm_text"):
            if len(memo) > remembered:
                memo.clear()
            offsets, flat = opened_words(as_text(batch.column("__llm_text")))
            numbers, names = distinct_words(flat)
            for name in names:
                if name not in memo:
                    memo[name] = counter.count(SPACE + name)
            values = np.array([memo[name] for name in names]).reshape(-1, 2)[numbers]
            sums = np.concatenate((np.zeros((1, 2)), np.cumsum(values, axis=0)))
            found = sums[offsets[1:]] - sums[offsets[:-1]]
            kept = [n for n in batch.schema.names if n != "__llm_text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in kept), pa.array(found[:, 1].astype(np.int64)), pa.array(found[:, 0])],
                names=[*kept, "n_pieces", "score"],
            )

    return count


def count_pieces(docs: DataFrame, keep: list[str], words: Vocabulary, text: str = "text", remembered: int = 250_000) -> DataFrame:
    """The columns ``keep`` of every document with n_pieces and score (of its best path)."""
    source = docs.select(*keep, F.col(f"`{text}`").cast("string").alias("__llm_text"))
    head = ", ".join([schema_of(source, keep)] * bool(keep) + ["n_pieces long", "score double"])
    return source.mapInArrow(_counted(words, remembered), head)
