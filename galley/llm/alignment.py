"""Cross-tokenizer alignment by diagonal run skipping.

A text is encoded by a byte-level tokenizer A (as space and text) and by a piece tokenizer B
(which puts the space itself). Both give ends of tokens in bytes. Where the tokens number i
of A and j of B end together, the ends after them are compared at the current shift j - i
by exponential probing: stretches of 1, 2, 4, … ends are compared at once while they are
equal, then ever shorter ones, so one-to-one stretches are jumped. At the first difference an
irregular group begins; its ends are merged one by one until two of them meet, which sets
the new shift.

Groups are the tokens between two ends that both tokenizers have; links are the pairs of
tokens that share bytes, so a one-to-one group has one and an irregular group has those met
while merging. `align` gives ids and groups of every document; `agreement` counts, for every
pair of ids, the documents that link it, and tells each document how its links stand among
all.

Neither tokenizer joins over a space that has a character other than white space on one of
its sides. Texts are cut there, and every task encodes a piece it has met only once. Pieces
with characters whose class may depend on the version of Unicode are given to tokenizer A
whole. Documents of a batch are aligned side by side, each at a shift of its own.

Counts of pairs are kept apart by frequency: pairs of so many documents that at most
``frequent`` pairs are as frequent are looked up inside the tasks (a table of bounded size,
whatever the corpus); the rest, of which no single one is frequent, meets its counts in a
join.

Defined cases: a null or empty text, or one whose tokens do not spell it (it contains
U+2581, which B reads as a space), has no tokens; equal rows are documents of their own; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galley.llm.common import as_text, kept_names, map_rows, numbered, quoted, ranges, slices, stored

SPACE = "▁"  # U+2581
#: How tokenizer A parts a text (a fixed value, published with its vocabulary).
PARTS_A = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters beyond these are looked up in an old version of Unicode.
UNUSUAL = regex.compile("[^\t\n\r -\x7e\xa1-ɏ]")


@dataclass(frozen=True)
class Settings:
    #: pairs looked up inside the tasks, at most
    frequent: int = 200_000
    #: pieces of texts a task remembers
    remembered: int = 400_000
    #: with fewer documents left than this, each of them is aligned by itself
    few: int = 24


@lru_cache(maxsize=100_000)
def _settled(character: str) -> bool:
    """Whether a character had a class long ago, which has not changed since."""
    old = unicodedata.ucd_3_2_0.category(character)
    return old != "Cn" and old == unicodedata.category(character)


def settled(text: str) -> bool:
    return UNUSUAL.search(text) is None or all(map(_settled, set(UNUSUAL.findall(text))))


#: Spaces that stand beside others, or at the start, or between other white space.
INNER_SPACE = regex.compile("[\\s\u180e] [\\s\u180e]|  |^ ")


class Remembered:
    """Ids of pieces of texts by both tokenizers, each encoded once."""

    def __init__(self, tokenizer_json: str, model: bytes, remembered: int):
        self.one, self.other, self.remembered = ByteTokens(tokenizer_json), PieceTokens(model), remembered
        self.clear()

    def clear(self) -> None:
        self.memo: dict[str, int] = {}
        #: whether B's tokens spell the piece
        self.spelled = np.zeros(0, bool)
        self.starts = [np.zeros(0, np.int64)] * 2
        self.lengths = [np.zeros(0, np.int64)] * 2
        self.ids = [np.zeros(0, np.int32)] * 2

    def _add(self, pieces: list[str], ids: list[np.ndarray], lengths: list[np.ndarray], spelled: np.ndarray) -> None:
        self.memo.update(zip(pieces, range(len(self.memo), len(self.memo) + len(pieces)), strict=True))
        for side in (0, 1):
            starts = len(self.ids[side]) + np.cumsum(lengths[side]) - lengths[side]
            self.starts[side] = np.concatenate((self.starts[side], starts))
            self.lengths[side] = np.concatenate((self.lengths[side], lengths[side]))
            self.ids[side] = np.concatenate((self.ids[side], ids[side]))
        self.spelled = np.concatenate((self.spelled, spelled))

    def _learn(self, pieces: list[str]) -> None:
        """Words at once; words with full stops or commas from both; the rest piece by piece."""
        words, ended, others = [], [], []
        usual = UNUSUAL.search(" ".join(pieces)) is None
        for p in pieces:
            stem = p.rstrip(".,")
            if not stem.isalpha() or not (usual or settled(stem)):
                others.append(p)
            elif stem == p:
                words.append(p)
            elif (stem[-1] + p[len(stem)]) not in self.other.bigrams:
                ended.append((p, stem, p[len(stem) :]))
            else:
                others.append(p)
        words += {stem for _, stem, _ in ended if stem not in self.memo}.difference(words)
        for k in range(0, len(words), 20_000):
            some = words[k : k + 20_000]
            found = [self.one.words(some), self.other.words(some)]
            self._add(some, *([f[n] for f in found] for n in (0, 1)), self._spelled(some, *found[1]))
        if ended:
            stems = np.fromiter((self.memo[stem] for _, stem, _ in ended), np.int64, len(ended))
            tails = list({tail for _, _, tail in ended})
            which = {tail: k for k, tail in enumerate(tails)}
            tail = np.fromiter((which[t] for _, _, t in ended), np.int64, len(ended))
            ids, lengths = [], []
            for side, tokenizer in enumerate((self.one, self.other)):
                more, sizes = tokenizer.encoded(tails)
                both = np.concatenate((self.ids[side], more))
                starts = np.stack((self.starts[side][stems], len(self.ids[side]) + (np.cumsum(sizes) - sizes)[tail]), axis=1)
                counts = np.stack((self.lengths[side][stems], sizes[tail]), axis=1)
                ids.append(both[ranges(starts.reshape(-1), counts.reshape(-1))])
                lengths.append(counts.sum(axis=1))
            names = [p for p, _, _ in ended]
            self._add(names, ids, lengths, self._spelled(names, ids[1], lengths[1]))
        for k in range(0, len(others), 20_000):
            some = others[k : k + 20_000]
            found = [self.one.encode(some), self.other.encode(some)]
            self._add(some, *([f[n] for f in found] for n in (0, 1)), self._spelled(some, *found[1]))

    def _spelled(self, pieces: list[str], ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        sizes = np.add.reduceat(self.other.sizes[ids], np.cumsum(lengths) - lengths)
        if self.other.spells(ids.tolist(), " ".join(pieces)) and sizes.tolist() == [len(p.encode()) + 1 for p in pieces]:
            return np.ones(len(pieces), bool)
        stops = np.cumsum(lengths).tolist()
        return np.array([self.other.spells(ids[x:y].tolist(), p) for x, y, p in zip([0, *stops], stops, pieces, strict=False)], bool)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """Which texts B's tokens spell; ids of these, one after another, and the number of each text, for A and B.

        Texts that are empty or not spelled have no ids.
        """
        pieces, counts = [], np.zeros(len(texts), np.int64)
        for k, text in enumerate(texts):
            if text and SPACE not in text:
                found = [text] if INNER_SPACE.search(text) else text.split(" ")
                pieces += found
                counts[k] = len(found)
        if len(self.memo) > self.remembered:
            self.clear()
        fresh = set(pieces).difference(self.memo)
        if fresh:
            self._learn(fresh)
        numbers = np.fromiter(map(self.memo.__getitem__, pieces), np.int64, len(pieces))
        ends = np.cumsum(counts)
        wrong = np.concatenate(([0], np.cumsum(~self.spelled[numbers])))
        good = (counts > 0) & (wrong[ends] == wrong[ends - counts])
        numbers = numbers[ranges((ends - counts)[good], counts[good])]
        counts = np.where(good, counts, 0)
        ends = np.cumsum(counts)
        ids, sizes = [], []
        for side in (0, 1):
            lengths = self.lengths[side][numbers]
            ids.append(self.ids[side][ranges(self.starts[side][numbers], lengths)])
            sums = np.concatenate(([0], np.cumsum(lengths)))
            sizes.append(sums[ends] - sums[ends - counts])
        return good, ids, sizes


def byte_alphabet() -> dict[int, str]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(others)}


class ByteTokens:
    """Tokenizer A: byte-level BPE."""

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer, pre_tokenizers

        # a task has one core; threads of the library would each keep memory of their own
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.whole = Tokenizer.from_str(tokenizer_json)
        self.whole.encode_special_tokens = True
        self.bare = Tokenizer(self.whole.model)
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        alphabet = byte_alphabet()
        self.table = str.maketrans({chr(b): c for b, c in alphabet.items()})
        back = {c: b for b, c in alphabet.items()}
        vocabulary = self.whole.get_vocab(with_added_tokens=False)
        self.sizes = np.zeros(max(self.whole.get_vocab().values()) + 1, np.int64)
        for piece, k in vocabulary.items():
            self.sizes[k] = sum(c in back for c in piece)
        self.parts = regex.compile(PARTS_A)

    def _of_lines(self, lines: list[str], counts: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of lines of so many parts in the byte alphabet, which has no white space."""
        ids, lengths = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for k in range(0, len(lines), 16):
            found = self.bare.encode_batch(lines[k : k + 16], add_special_tokens=False)
            for one, count in zip(found, counts[k : k + 16], strict=True):
                ids.append(np.array(one.ids, np.int32))
                lengths.append(np.bincount(np.array(one.word_ids, np.int64), minlength=count))
        return np.concatenate(ids), np.concatenate(lengths)

    def _bytes(self, text: str) -> str:
        return text.encode().decode("latin-1").translate(self.table)

    def encoded(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts, and the number of each."""
        some = [parts[k : k + 500] for k in range(0, len(parts), 500)]
        return self._of_lines([" ".join(map(self._bytes, s)) for s in some], [len(s) for s in some])

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of letters, with a space before each."""
        some = [words[k : k + 500] for k in range(0, len(words), 500)]
        space = self.table[32]
        return self._of_lines([self._bytes(" " + " ".join(s)).replace(space, " " + space) for s in some], [len(s) for s in some])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of space and text, for all texts one after another, and the number of each."""
        parts, counts, whole = [], np.zeros(len(texts), np.int64), []
        for k, text in enumerate(texts):
            if settled(text):
                found = self.parts.findall(" " + text)
                parts += found
                counts[k] = len(found)
            else:
                whole.append(k)
        ids, lengths = self.encoded(parts)
        sums = np.concatenate(([0], np.cumsum(lengths)))
        ends = np.cumsum(counts)
        sizes = sums[ends] - sums[ends - counts]
        if not whole:
            return ids, sizes
        given = self.whole.encode_batch_fast([" " + texts[k] for k in whole], add_special_tokens=False)
        pieces = np.split(ids, np.cumsum(sizes)[:-1])
        for k, one in zip(whole, given, strict=True):
            pieces[k] = np.array(one.ids, np.int32)
            sizes[k] = len(one.ids)
        return np.concatenate(pieces), sizes


class PieceTokens:
    """Tokenizer B: BPE of pieces with bytes for unknown characters."""

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_proto=model)
        count = self.model.get_piece_size()
        names = [self.model.id_to_piece(k) for k in range(count)]
        bytes_of = [bytes([int(n[3:5], 16)]) if self.model.is_byte(k) else n.replace(SPACE, " ").encode() for k, n in enumerate(names)]
        self.bytes_of = bytes_of
        self.sizes = np.array([len(b) for b in bytes_of], np.int64)
        # characters that no longer piece holds are never joined with others
        joined = {c for k, n in enumerate(names) if len(n) > 1 and not self.model.is_byte(k) and not self.model.is_control(k) and not self.model.is_unknown(k) for c in n}
        self.bigrams = {n[k : k + 2] for j, n in enumerate(names) if not self.model.is_byte(j) for k in range(len(n) - 1)}
        self.line = self.model.piece_to_id("<0x0A>")
        if "\n" in joined or any(n.find(SPACE, len(n) - len(n.lstrip(SPACE))) >= 0 for n in names):
            raise ValueError("the vocabulary joins over spaces or lines")
        alone = "".join(c for c in map(chr, range(1, 128)) if c != " " and c not in joined)
        alone = regex.escape(alone, special_only=False) if alone else "\n"
        self.parts = regex.compile(f"[{alone}]| *[^ {alone}]+| +")

    def encoded(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts, and the number of each: they are one text, with lines between them: a line break is a token by itself."""
        ids = np.array(self.model.encode("\n" + "\n".join("" if p == "\n" else p for p in parts) + "\n"), np.int32)
        breaks = np.flatnonzero(ids == self.line)
        lengths = np.diff(breaks) - 1
        inner = np.ones(len(ids), bool)
        inner[: breaks[0]] = False
        inner[breaks] = False
        own = np.flatnonzero([p == "\n" for p in parts])  # the line break stands for itself
        lengths[own] = 1
        inner[breaks[own]] = True
        return ids[inner], lengths

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts one after another, and the number of each."""
        parts, counts = [], np.zeros(len(texts), np.int64)
        for k, text in enumerate(texts):
            found = self.parts.findall(" " + text)
            parts += found
            counts[k] = len(found)
        ids, lengths = self.encoded(parts)
        sums = np.concatenate(([0], np.cumsum(lengths)))
        ends = np.cumsum(counts)
        return ids, sums[ends] - sums[ends - counts]

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of letters, with a space before each."""
        ids = np.array(self.model.encode("\n " + "\n ".join(words) + "\n"), np.int32)
        breaks = np.flatnonzero(ids == self.line)
        inner = np.ones(len(ids), bool)
        inner[: breaks[0]] = False
        inner[breaks] = False
        return ids[inner], np.diff(breaks) - 1

    def spells(self, ids: list[int], text: str) -> bool:
        return b"".join(map(self.bytes_of.__getitem__, ids)) == b" " + text.encode()


def groups(a: list[int], b: list[int]) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int, int]], list[tuple[int, int]]]:
    """One-to-one stretches (i, j, length), irregular groups (i, i end, j, j end) and their links.

    ``a`` and ``b`` are rising ends with the same last one.
    """
    i, j, n = 0, 0, len(a)
    stretches, irregular, links = [], [], []
    while i < n:
        first, step = i, 1
        while i < n and a[i : i + step] == b[j : j + step]:
            taken = min(step, n - i)
            i += taken
            j += taken
            step += step
        while step > 1 and i < n:  # the difference lies within the stretch last tried
            step >>= 1
            if a[i : i + step] == b[j : j + step]:
                taken = min(step, n - i)
                i += taken
                j += taken
        if i > first:
            stretches.append((first, j - (i - first), i - first))
        if i < n:
            x, y = i, j
            p, q = a[i], b[j]
            links.append((i, j))
            while p != q:
                if p < q:
                    i += 1
                    p = a[i]
                else:
                    j += 1
                    q = b[j]
                links.append((i, j))
            i += 1
            j += 1
            irregular.append((x, i, y, j))
    return stretches, irregular, links


def side_by_side(
    a: np.ndarray, b: np.ndarray, first_a: np.ndarray, last_a: np.ndarray, first_b: np.ndarray, last_b: np.ndarray, few: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`groups` of many documents, whose ends lie one after another: stretches, irregular groups and links as rows."""
    i, j = first_a.copy(), first_b.copy()
    stretches, irregular, links = [np.zeros((0, 3), np.int64)], [np.zeros((0, 4), np.int64)], [np.zeros((0, 2), np.int64)]
    at_work = np.flatnonzero(first_a < last_a)
    while len(at_work) >= few:
        from_i, from_j = i[at_work], j[at_work]
        probing, step = at_work, 1
        while len(probing):
            ahead = np.arange(step)
            here_i, here_j = i[probing], j[probing]
            room = last_a[probing] - here_i
            left = a[np.minimum(here_i[:, None] + ahead, len(a) - 1)]
            same = (left == b[np.minimum(here_j[:, None] + ahead, len(b) - 1)]) & (ahead < room[:, None])
            taken = np.where(same.all(axis=1), step, same.argmin(axis=1))
            i[probing] = here_i + taken
            j[probing] = here_j + taken
            probing = probing[(taken == step) & (room > step)]
            step *= 2
        length = i[at_work] - from_i
        stretches.append(np.stack((from_i, from_j, length), axis=1)[length > 0])
        at_work = at_work[i[at_work] < last_a[at_work]]
        from_i, from_j = i[at_work], j[at_work]
        merging = at_work
        while len(merging):
            here_i, here_j = i[merging], j[merging]
            links.append(np.stack((here_i, here_j), axis=1))
            p, q = a[here_i], b[here_j]
            i[merging] = here_i + (p < q)
            j[merging] = here_j + (p > q)
            merging = merging[p != q]
        i[at_work] += 1
        j[at_work] += 1
        irregular.append(np.stack((from_i, i[at_work], from_j, j[at_work]), axis=1))
        at_work = at_work[i[at_work] < last_a[at_work]]
    for k in at_work.tolist():
        x, y = int(i[k]), int(j[k])
        alone = groups(a[x : last_a[k]].tolist(), b[y : last_b[k]].tolist())
        for out, found, base in zip((stretches, irregular, links), alone, ([x, y, 0], [x, x, y, y], [x, y]), strict=True):
            if found:
                out.append(np.array(found, np.int64) + base)
    return np.concatenate(stretches), np.concatenate(irregular), np.concatenate(links)


def in_order(ids_a: np.ndarray, ids_b: np.ndarray, stretches: np.ndarray, irregular: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of all groups in order, A's before B's: numbers of the texts of `names`; and the ends of groups.

    The second array counts, for each group, the tokens of A and B up to its end.
    """
    single = ranges(stretches[:, 0], stretches[:, 2]), ranges(stretches[:, 1], stretches[:, 2])
    closes_a, closes_b = np.zeros(len(ids_a), bool), np.zeros(len(ids_b), bool)
    closes_a[single[0]] = closes_b[single[1]] = True
    closes_a[irregular[:, 1] - 1] = closes_b[irregular[:, 3] - 1] = True
    upto_a, upto_b = np.flatnonzero(closes_a) + 1, np.flatnonzero(closes_b) + 1
    group_a, group_b = np.cumsum(closes_a) - closes_a, np.cumsum(closes_b) - closes_b
    out = np.zeros(len(ids_a) + len(ids_b), np.int64)
    out[np.arange(len(ids_a)) + np.concatenate(([0], upto_b))[group_a]] = 2 * ids_a + closes_a
    out[np.arange(len(ids_b)) + upto_a[group_b]] = 2 * (width + ids_b.astype(np.int64)) + closes_b
    return out, upto_a


def names(width_a: int, width_b: int) -> list[str]:
    """Ids with what stands behind them: a comma inside a group, a bar after A's tokens, a semicolon after B's."""
    return [f"{k}{mark}" for k in range(width_a) for mark in ",|"] + [f"{k}{mark}" for k in range(width_b) for mark in ",;"]


RESULTS = {
    "n_a": "long",
    "n_b": "long",
    "n_groups": "long",
    "n_links": "long",
    "ids_a": "array<int>",
    "ids_b": "array<int>",
    "groups": "string",
    "pairs": "array<long>",
    "times": "array<int>",
}


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _aligned(tokenizer_json: str, model: bytes, settings: Settings, results: dict[str, str], digest: bool):
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remembered = Remembered(tokenizer_json, model, settings.remembered)
        bytes_a, bytes_b = remembered.one.sizes, remembered.other.sizes
        texts_of = names(len(bytes_a), len(bytes_b))
        width = len(bytes_b)
        for batch in slices(batches, "__llm_text", 2 << 20):
            good, (ids_a, ids_b), (sizes_a, sizes_b) = remembered.encode(as_text(batch.column("__llm_text")).to_pylist())
            ends_a, ends_b = np.cumsum(bytes_a[ids_a]), np.cumsum(bytes_b[ids_b])
            last_a, last_b = np.cumsum(sizes_a), np.cumsum(sizes_b)
            if not np.array_equal(ends_a[last_a[good] - 1], ends_b[last_b[good] - 1]):
                raise ValueError("the tokens of a text do not spell it")
            stretches, irregular, links = side_by_side(ends_a, ends_b, last_a - sizes_a, last_a, last_b - sizes_b, last_b, settings.few)
            order, upto_a = in_order(ids_a, ids_b, stretches, irregular, len(bytes_a))
            n_groups = np.diff(np.searchsorted(upto_a, np.concatenate(([0], last_a)), "right"))
            link_a = np.concatenate((ranges(stretches[:, 0], stretches[:, 2]), links[:, 0]))
            link_b = np.concatenate((ranges(stretches[:, 1], stretches[:, 2]), links[:, 1]))
            document = np.searchsorted(last_a, link_a, "right")
            n_links = np.bincount(document, minlength=len(good))
            columns = {
                "n_a": pa.array(sizes_a),
                "n_b": pa.array(sizes_b),
                "n_groups": pa.array(n_groups, pa.int64()),
                "n_links": pa.array(n_links, pa.int64()),
            }
            if "ids_a" in results:
                columns |= {"ids_a": _lists(ids_a, sizes_a, pa.int32()), "ids_b": _lists(ids_b, sizes_b, pa.int32())}
            if "groups" in results:
                written = []
                for k, stop in enumerate((last_a + last_b).tolist()):
                    some = order[stop - sizes_a[k] - sizes_b[k] : stop].tolist()
                    text = "".join(map(texts_of.__getitem__, some))[:-1]
                    written.append(hashlib.sha256(text.encode()).hexdigest() if digest and good[k] else text)
                columns["groups"] = pa.array(written, pa.string())
            if "pairs" in results:
                space = len(bytes_a) * width
                coded, times = np.unique(document * space + ids_a[link_a].astype(np.int64) * width + ids_b[link_b], return_counts=True)
                distinct = np.bincount(coded // space, minlength=len(good))
                columns |= {"pairs": _lists(coded % space, distinct, pa.int64()), "times": _lists(times, distinct, pa.int32())}
            kept = kept_names(batch)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *(columns[c] for c in results)], names=[*kept, *results])

    return align


def align(
    docs: DataFrame,
    keep: list[str],
    tokenizer_json: str,
    model: bytes,
    text: str = "text",
    settings: Settings | None = None,
    columns: tuple[str, ...] = ("n_a", "n_b", "n_groups", "n_links", "ids_a", "ids_b", "groups"),
    digest: bool = False,
) -> DataFrame:
    """The columns ``keep`` of every document with those of ``columns``.

    ``pairs`` are the distinct linked ids (A's times the size of B's vocabulary, plus B's)
    and ``times`` the links of each. With ``digest``, ``groups`` is the SHA-256 of the
    groups, in lower-case hexadecimal digits, and empty where there are no tokens.
    """
    results = {name: RESULTS[name] for name in columns}
    function = _aligned(tokenizer_json, model, settings or Settings(), results, digest)
    return map_rows(docs, keep, [F.col(quoted(text)).cast("string").alias("__llm_text")], function, results)


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """``pair``, ``n`` (documents that link it) and whether no pair of its A id has more."""
    counts = stored(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "pair-counts")
    best = counts.groupBy(F.floor(F.col("pair") / width).cast("long").alias("a")).agg(F.max("n").alias("most"))
    named = counts.withColumn("a", F.floor(F.col("pair") / width).cast("long"))
    return stored(named.join(best, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pair-counts")


def frequent_limit(counts: DataFrame, most: int) -> int:
    """The least number of documents that at most ``most`` pairs reach, by steps of an eighth."""
    step = F.floor(F.log2("n") * 8)
    rows = counts.groupBy(step.alias("step")).agg(F.count("*").alias("pairs"), F.min("n").alias("least")).collect()
    limit, pairs = 1 << 62, 0
    for row in sorted(rows, key=lambda r: -r["step"]):
        pairs += row["pairs"]
        if pairs > most:
            break
        limit = row["least"]
    return limit


def _looked_up(pairs: np.ndarray, n: np.ndarray, best: np.ndarray):
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("pairs")
            asked = column.flatten().to_numpy(zero_copy_only=False)
            times = batch.column("times").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(np.diff(column.offsets.to_numpy()))
            if len(pairs):
                place = np.minimum(np.searchsorted(pairs, asked), len(pairs) - 1)
                known = pairs[place] == asked
                n_best, total = np.where(known & best[place], times, 0), np.where(known, times * n[place], 0)
            else:
                known = np.zeros(len(asked), bool)
                n_best, total = np.zeros(len(asked), np.int64), np.zeros(len(asked), np.int64)

            def summed(values: np.ndarray, ends: np.ndarray = ends) -> np.ndarray:
                sums = np.concatenate(([0], np.cumsum(values)))[ends]
                return np.diff(sums, prepend=0)

            left = np.concatenate(([0], np.cumsum(~known)))[np.concatenate(([0], ends))].astype(np.int32)
            rest = [pa.ListArray.from_arrays(pa.array(left), pa.array(values[~known])) for values in (asked, times)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("__llm_row"), pa.array(summed(n_best)), pa.array(summed(total)), *rest],
                names=["__llm_row", "__llm_best", "__llm_sum", "pairs", "times"],
            )

    return look


def agreement(
    docs: DataFrame, keep: list[str], tokenizer_json: str, model: bytes, text: str = "text", settings: Settings | None = None, digest: bool = True
) -> DataFrame:
    """`align` with n_best and count_sum: links whose pair is its A id's most frequent one, and the sum of counts."""
    from sentencepiece import SentencePieceProcessor

    settings = settings or Settings()
    width = SentencePieceProcessor(model_proto=model).get_piece_size()
    shown = ["n_a", "n_b", "n_groups", "n_links", "groups"]
    clashes = [c for c in keep if c.lower() in (*shown, "n_best", "count_sum")]
    if clashes:
        raise ValueError(f"names of results: {clashes}")
    given = docs.select(*(F.col(quoted(c)).alias(f"__kept_{k}") for k, c in enumerate(keep)), F.col(quoted(text)).alias("__text"))
    inner = [f"__kept_{k}" for k in range(len(keep))]
    aligned = stored(
        numbered(align(given, inner, tokenizer_json, model, "__text", settings, (*shown, "pairs", "times"), digest), "__llm_row"), "aligned"
    )
    counts = pair_counts(aligned, width)
    limit = frequent_limit(counts, settings.frequent)
    known = counts.filter(F.col("n") >= limit).toPandas().sort_values("pair")  # ``frequent`` rows at most
    look = _looked_up(known["pair"].to_numpy(np.int64), known["n"].to_numpy(np.int64), known["best"].to_numpy(bool))
    parts = stored(
        aligned.select("__llm_row", "pairs", "times").mapInArrow(
            look, "__llm_row long, __llm_best long, __llm_sum long, pairs array<long>, times array<long>"
        ),
        "frequent-links",
    )
    rare = parts.select("__llm_row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("__llm_row", "p.pairs", "p.times")
    joined = rare.join(counts.filter(F.col("n") < limit), F.col("pairs") == F.col("pair"))
    sums = joined.select("__llm_row", F.when(F.col("best"), F.col("times")).otherwise(0).alias("__llm_best"), (F.col("times") * F.col("n")).alias("__llm_sum"))
    totals = (
        parts.select("__llm_row", "__llm_best", "__llm_sum")
        .unionByName(sums)
        .groupBy("__llm_row")
        .agg(F.sum("__llm_best").alias("n_best"), F.sum("__llm_sum").alias("count_sum"))
    )
    found = aligned.select(*inner, *shown, "__llm_row").join(totals, "__llm_row").drop("__llm_row")
    return found.toDF(*keep, *shown, "n_best", "count_sum")
