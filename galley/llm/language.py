"""Language identification by words first, by ever shorter character n-grams for the rest.

Training counts words per language on a bounded sample of labelled documents and n-grams
over the distinct words. A known word scores its log frequency in each language; a word the
model has not seen is scored at each of its positions by the longest n-gram the model
knows there, with a penalty for every character given up.

Defined cases: a text that is null or has no letter is ``und`` with score 0; with no
labelled document everything is ``und``; equal scores go to the alphabetically first
language; every row, repeated or without id, gets its own answer.
"""

from __future__ import annotations

import math
import re
import sys
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galley.llm.common import as_text, distinct_words, slices, stored, white_space_words

# numerals that are no digits, such as superscripts and fractions: \w takes them for letters
_NUMERALS = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isalnum() and not (c.isalpha() or c.isdecimal()))
LETTERS = re.compile(rf"[^\W\d_{_NUMERALS}]+")
UNDETERMINED = "und"
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    """``docs_per_language`` bounds the training sample, the ``most_`` values the model."""

    docs_per_language: int = 1500
    longest_gram: int = 5
    most_words: int = 120_000
    most_grams: int = 60_000
    step_back: float = math.log(0.4)
    gram_weight: float = 1.0


def sampled(labelled: DataFrame, key: Column, settings: Settings) -> DataFrame:
    """About ``docs_per_language`` documents of each language, the same at every run."""
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    place = F.xxhash64(key).bitwiseAND(F.lit((1 << 32) - 1)) / F.lit(float(1 << 32))
    wanted = F.lit(False)
    for language, n in sorted(counts.items()):
        wanted = wanted | ((F.col("lang") == F.lit(language)) & (place < F.lit(settings.docs_per_language / n)))
    return labelled.filter(wanted)


def _word_counts(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(rows, "text"):
        langs = batch.column("lang").to_pylist()
        offsets, words = white_space_words(as_text(batch.column("text")))
        numbers, names = distinct_words(words)
        parts = [LETTERS.findall(name.lower()) for name in names]
        by_lang: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(names), np.int64))
        for k, lang in enumerate(langs):
            np.add.at(by_lang[lang], numbers[offsets[k] : offsets[k + 1]], 1)
        for lang, found in by_lang.items():
            counts: Counter[str] = Counter()
            for k in np.flatnonzero(found):
                for word in parts[k]:
                    counts[word] += int(found[k])
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(counts), pa.string()), pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                names=["lang", "word", "n"],
            )


def gram_hashes(words: list[str], longest: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Hashes of all n-grams of words with a space at both ends.

    Returns the word of each position, then per length the hashes (0 where none starts),
    and the positions' count per word. A position is a place where an n-gram may begin.
    """
    text = " " + " ".join(words) + " "
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    space = codes == 32
    owner = np.cumsum(space) - 1  # a space belongs to the word after it
    size = len(codes)
    value, known, out = np.zeros(size, np.uint64), np.ones(size, bool), []
    for n in range(1, longest + 1):
        last = np.arange(size) + n - 1
        inside = last < size
        value = value * MULTIPLIER
        value[inside] += codes[last[inside]] + np.uint64(1)
        if n > 2:  # no space between the first and the last character
            middle = last - 1
            known &= inside & ~space[np.minimum(middle, size - 1)]
        elif n == 2:
            known &= inside & ~(space & space[np.minimum(last, size - 1)])
        hashes = np.where(known & inside, value, np.uint64(0))
        out.append(hashes)
    valid = owner < len(words)
    return owner[valid], [h[valid] for h in out], np.bincount(owner[valid], minlength=len(words))


def _gram_counts(longest: int):
    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(rows, "word", 1 << 19):
            langs, words = np.array(batch.column("lang").to_pylist(), object), batch.column("word").to_pylist()
            owner, grams, _ = gram_hashes(words, longest)
            for n, hashes in enumerate(grams, 1):
                for lang in sorted(set(langs)):
                    values, counts = np.unique(hashes[(hashes != 0) & (langs[owner] == lang)], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * len(values), pa.string()),
                            pa.array([n] * len(values), pa.int32()),
                            pa.array(values.view(np.int64)),
                            pa.array(counts),
                        ],
                        names=["lang", "length", "gram", "n"],
                    )

    return count


@dataclass
class Model:
    """Languages in order, log frequencies per word and per n-gram length."""

    languages: list[str]
    words: dict[str, int]
    word_scores: np.ndarray
    grams: list[np.ndarray] = field(default_factory=list)
    gram_scores: list[np.ndarray] = field(default_factory=list)
    settings: Settings = field(default_factory=Settings)

    def of_words(self, words: list[str]) -> np.ndarray:
        """Scores of distinct words, a row each."""
        out = np.zeros((len(words), len(self.languages)))
        where = np.array([self.words.get(w, -1) for w in words], np.int64)
        known = where >= 0
        out[known] = self.word_scores[where[known]]
        if known.all() or not self.grams:
            return out
        rest = np.flatnonzero(~known)
        owner, hashes, positions = gram_hashes([words[k] for k in rest], len(self.grams))
        total = np.zeros((len(rest), len(self.languages)))
        open_ = np.ones(len(owner), bool)
        for n in range(len(self.grams), 0, -1):
            own, model = hashes[n - 1], self.grams[n - 1]
            if not len(model):
                continue
            at = np.minimum(np.searchsorted(model, own), len(model) - 1)
            hit = open_ & (own != 0) & (model[at] == own)
            penalty = self.settings.step_back * (len(self.grams) - n)
            scores = self.gram_scores[n - 1][at[hit]] + penalty
            for k in range(len(self.languages)):
                total[:, k] += np.bincount(owner[hit], scores[:, k], len(rest))
            open_ &= ~hit
        out[rest] = self.settings.gram_weight * total / np.maximum(positions, 1)[:, None]
        return out


def fit(labelled: DataFrame, key: Column, settings: Settings = Settings()) -> Model:
    """Learn from ``text`` and ``lang``; ``key`` chooses the sample.

    What reaches the driver is the model: at most ``most_words`` and, for each length,
    ``most_grams`` counts, however large the corpus is.
    """
    named = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sample = sampled(named, key, settings).select("text", "lang")
    counted = sample.mapInArrow(_word_counts, "lang string, word string, n long")
    words = stored(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")), "language-words")
    totals = {r["lang"]: r["n"] for r in words.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = sorted(totals)
    if not languages:
        return Model([], {}, np.zeros((0, 0)), settings=settings)
    number = {lang: k for k, lang in enumerate(languages)}
    best = words.orderBy(F.desc("n"), "word", "lang").limit(settings.most_words).collect()
    index: dict[str, int] = {}
    for row in best:
        index.setdefault(row["word"], len(index))
    counts = np.zeros((len(index), len(languages)))
    for row in best:
        counts[index[row["word"]], number[row["lang"]]] = row["n"]
    size = np.array([totals[lang] for lang in languages], float)
    model = Model(languages, index, np.log((counts + 0.5) / (size + 0.5 * (len(index) + 1))), settings=settings)
    grams = stored(
        words.mapInArrow(_gram_counts(settings.longest_gram), "lang string, length int, gram long, n long")
        .groupBy("lang", "length", "gram")
        .agg(F.sum("n").alias("n")),
        "language-grams",
    )
    for n in range(1, settings.longest_gram + 1):
        mine = grams.filter(F.col("length") == n)
        rows = mine.orderBy(F.desc("n"), "gram", "lang").limit(settings.most_grams).collect()
        keys = np.unique(np.array([r["gram"] for r in rows], np.int64).view(np.uint64))
        table = np.zeros((len(keys), len(languages)))
        for r in rows:
            table[np.searchsorted(keys, np.uint64(r["gram"] % (1 << 64))), number[r["lang"]]] = r["n"]
        total = table.sum(axis=0)
        model.grams.append(keys)
        model.gram_scores.append(np.log((table + 0.5) / (total + 0.5 * (len(keys) + 1))))
    return model


def _scores(model: Model, texts: pa.Array, memo: dict[str, int], rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Summed scores of each text, and its number of words with letters."""
    offsets, pieces = white_space_words(texts)
    numbers, names = distinct_words(pieces)
    fresh = [name for name in names if name not in memo]
    if fresh:
        parts = [LETTERS.findall(name.lower()) for name in fresh]
        flat = list(dict.fromkeys(w for p in parts for w in p))
        place = {w: k for k, w in enumerate(flat)}
        scored = model.of_words(flat)
        owner = np.repeat(np.arange(len(fresh)), [len(p) for p in parts])
        member = np.array([place[w] for p in parts for w in p], np.int64)
        block = np.zeros((len(fresh), len(model.languages) + 1))
        for k in range(len(model.languages)):
            block[:, k] = np.bincount(owner, scored[member, k] if len(member) else None, len(fresh))
        block[:, -1] = np.bincount(owner, minlength=len(fresh))
        start = sum(map(len, rows))
        rows.append(block)
        for k, name in enumerate(fresh):
            memo[name] = start + k
    if len(rows) > 1:
        rows[:] = [np.concatenate(rows)]
    if not names:
        return np.zeros((len(texts), len(model.languages))), np.zeros(len(texts))
    lines = rows[0][np.array([memo[name] for name in names], np.int64)]
    out = np.zeros((len(texts), lines.shape[1]))
    doc = np.repeat(np.arange(len(texts)), np.diff(offsets))
    for k in range(lines.shape[1]):
        out[:, k] = np.bincount(doc, lines[numbers, k], len(texts))
    return out[:, :-1], out[:, -1]


def predictor(model: Model, remembered: int = 250_000):
    """A function for ``mapInArrow`` over (row fields…, text) that adds lang_pred and score."""

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, int] = {}
        rows: list[np.ndarray] = []
        names = np.array([*model.languages, UNDETERMINED], object)
        for batch in slices(batches, "__llm_text"):
            kept = [n for n in batch.schema.names if n != "__llm_text"]
            if model.languages:
                if len(memo) > remembered:
                    memo.clear()
                    rows.clear()
                total, words = _scores(model, as_text(batch.column("__llm_text")), memo, rows)
                best = total.argmax(axis=1)
                top = total.max(axis=1, keepdims=True)
                share = 1 / np.exp(np.maximum(total - top, -700)).sum(axis=1)
                has = words > 0
            else:
                best, share = np.zeros(batch.num_rows, int), np.zeros(batch.num_rows)
                has = np.zeros(batch.num_rows, bool)
            found = names[np.where(has, best, len(model.languages))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in kept), pa.array(found.tolist(), pa.string()), pa.array(np.where(has, share, 0.0))],
                names=[*kept, "lang_pred", "score"],
            )

    return predict


def identify(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` of every document with ``lang_pred`` and ``score``."""
    source = docs.select(*keep, F.col(text).cast("string").alias("__llm_text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name != "__llm_text")
    return source.mapInArrow(predictor(model), f"{fields}, lang_pred string, score double")


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether a document is kept out of training: crc32 of its id as text divides."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))
