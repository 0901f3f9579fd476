"""Encoding with a piece vocabulary as a relational lattice, and decoding.

Distinct words explode into their substrings up to the longest piece; an equal join with
the piece table leaves the lattice's edges, which are sorted by word and end and folded,
many words side by side, into the best paths. Documents then take their words' ids from
dictionaries, one for each part of the input, which hold what the lattice found for the
words of that part. A word that a dictionary lacks (one longer than ``longest_word``, or
one of a part that was cut differently when it was read again) is solved where it is met
by the same rules, so a dictionary is never what a result depends on.

Rules: a space opens a word and is its first character, and the text gets one in front; of
equal scores the path whose last piece is longest stays; a character without a piece is
unknown, scores ten below the least piece and is written as its UTF-8 bytes.

Defined cases: a null or empty text has no ids and decodes to the empty text; equal rows
are encoded each; decoding gives the text back, but for U+2581 (a space) and unpaired
surrogates; ids outside the vocabulary raise.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galley.llm.common import as_text, ranges, schema_of, shared_path, slices
from galley.llm.jaccard import word_hashes
from galley.llm.unigram import SPACE, Vocabulary

#: Bytes of text that are cut into words at once; words and ids take some 40 times that.
SLICE = 1 << 20
BYTE = re.compile(r"<0x([0-9A-F]{2})>")


@dataclass(frozen=True)
class Settings:
    longest_word: int = 64


def byte_ids(words: Vocabulary) -> list[int]:
    """The piece of each byte."""
    found = {int(m[1], 16): k for k, p in enumerate(words.pieces) if (m := BYTE.fullmatch(p))}
    return [found[b] for b in range(256)]


class Solver:
    """The lattice of one word, without tables."""

    def __init__(self, words: Vocabulary):
        self.index = {p: (k, s) for k, (p, s) in enumerate(zip(words.pieces, words.scores, strict=True)) if p}
        self.longest = max(map(len, self.index))
        self.unknown, self.bytes = words.unknown_score, byte_ids(words)

    def ids(self, word: str) -> list[int]:
        size = len(word)
        best: list[tuple[float, int, list[int]]] = [(0.0, 0, [])]
        for stop in range(1, size + 1):
            top = None
            for start in range(max(0, stop - self.longest), stop):
                piece = self.index.get(word[start:stop])
                if piece is None:
                    if stop - start > 1:
                        continue
                    own = [self.bytes[b] for b in word[start].encode("utf-8", "surrogatepass")]
                    score = self.unknown
                else:
                    own, score = [piece[0]], piece[1]
                score += best[start][0]
                if top is None or score > top[0]:
                    top = (score, start, own)
            best.append(top)
        out, at = [], size
        while at:
            _, start, own = best[at]
            out.append(own)
            at = start
        return [k for own in reversed(out) for k in own]


def words_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Words without the space that opens them, empty ones too; offsets of the texts."""
    parts = pc.split_pattern(pc.replace_substring(texts, SPACE, " "), " ")
    offsets, words = parts.offsets.to_numpy(), parts.values
    keep = np.repeat(pc.greater(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), np.diff(offsets))
    return np.concatenate(([0], np.cumsum(keep)))[offsets], words.filter(pa.array(keep))


def hashed(words: pa.Array, at_once: int = 1 << 15) -> np.ndarray:
    """Hashes of words that stand without their space, empty ones too."""
    space, none = pa.scalar(SPACE, pa.large_string()), pa.scalar("", pa.large_string())
    parts = (words.slice(k, at_once) for k in range(0, len(words), at_once))
    return np.concatenate([np.zeros(0, np.uint64), *(word_hashes(pc.binary_join_element_wise(space, p, none)) for p in parts)])


def _words_by_part(longest: int):
    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # hashes of the words given out: one that shares its hash is solved where it is met
        part, seen = TaskContext.get().partitionId(), np.zeros(0, np.uint64)
        for batch in slices(batches, "__llm_text", SLICE):
            names = pc.unique(words_of(as_text(batch.column("__llm_text")))[1])
            names = names.filter(pc.less(pc.utf8_length(names), longest))
            if not len(names):
                continue
            hashes, words = hashed(names), pc.binary_join_element_wise(pa.scalar(SPACE), names.cast(pa.string()), "")
            fresh = np.ones(len(hashes), bool)
            if len(seen):
                fresh = seen[np.minimum(np.searchsorted(seen, hashes), len(seen) - 1)] != hashes
            words, seen = words.filter(pa.array(fresh)), np.sort(np.concatenate((seen, hashes[fresh])))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(words), part, np.int32)), words], names=["part", "word"])

    return collect


def piece_table(spark, words: Vocabulary) -> DataFrame:
    return spark.createDataFrame([(p, k) for k, p in enumerate(words.pieces) if p], "piece string, id int")


def edges(words: DataFrame, pieces: DataFrame, vocabulary: Vocabulary, longest_word: int) -> DataFrame:
    """``key`` and ``id`` of the edges of words, sorted by key; ``words`` has distinct ones of bounded length.

    A key is a number (word in its partition, end, start). Every word's first edge, the one
    that ends after a character, has the ``word`` and its ``parts``. The piece of an unknown
    character is one past the vocabulary.
    """
    longest, unknown, bits = max(map(len, vocabulary.pieces)), len(vocabulary.pieces), longest_word.bit_length()
    number = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    starts = words.select(number.alias("number"), "word", "parts").select(
        "*", F.explode(F.sequence(F.lit(0), F.length("word") - 1)).alias("start")
    )
    starts = starts.select("number", "start", F.when(F.col("start") == 0, F.col("parts")).alias("parts"), "word")
    last = F.least(F.length("word"), F.col("start") + longest)
    spans = starts.select("*", F.explode(F.sequence(F.col("start") + 1, last)).alias("stop"))
    spans = spans.withColumn("piece", F.col("word").substr(F.col("start") + 1, F.col("stop") - F.col("start")))
    key = F.shiftleft("number", 2 * bits) + F.shiftleft(F.col("stop").cast("long"), bits) + F.col("start")
    first = F.col("stop") == 1
    # the piece table is a tokenizer's vocabulary, whatever the corpus
    return (
        spans.join(F.broadcast(pieces), "piece", "left")
        .filter(F.col("id").isNotNull() | (F.col("stop") - F.col("start") == 1))
        .select(
            key.alias("key"),
            F.coalesce("id", F.lit(unknown)).alias("id"),
            F.when(first, F.col("word")).alias("word"),
            F.when(first, F.col("parts")).alias("parts"),
        )
        .sortWithinPartitions("key")
    )


class Folder:
    """Best paths of words from their edges."""

    def __init__(self, vocabulary: Vocabulary, longest_word: int):
        self.bits, self.unknown = longest_word.bit_length(), len(vocabulary.pieces)
        self.scores = np.array([*vocabulary.scores, vocabulary.unknown_score])
        self.bytes = byte_ids(vocabulary)

    def paths(self, keys: np.ndarray, ids: np.ndarray, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each word, and the ids; edges are sorted and ``words`` in their order."""
        mask = (1 << self.bits) - 1
        start, stop = keys & mask, (keys >> self.bits) & mask
        new = np.concatenate(([True], np.diff(keys >> 2 * self.bits) != 0))
        word = np.cumsum(new) - 1
        size = stop[np.concatenate((np.flatnonzero(new)[1:], [len(keys)])) - 1]
        base = np.cumsum(size + 1) - (size + 1)
        best, through = np.zeros(int((size + 1).sum())), np.zeros(int((size + 1).sum()), np.int64)
        score, source, target = self.scores[ids], base[word] + start, base[word] + stop
        by_stop = np.argsort(stop, kind="stable")
        cuts = np.searchsorted(stop[by_stop], np.arange(1, int(size.max()) + 2))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):  # all edges that end at the same place of their words
            mine = by_stop[a:b]
            total, group = best[source[mine]] + score[mine], target[mine]
            heads = np.flatnonzero(np.concatenate(([True], np.diff(group) != 0)))
            top = np.maximum.reduceat(total, heads)
            best[group[heads]] = top
            winners = np.flatnonzero(total == np.repeat(top, np.diff(np.concatenate((heads, [len(mine)])))))
            # of equal scores the edge that starts first, which is the longest one
            ends, at = np.unique(group[winners], return_index=True)
            through[ends] = mine[winners[at]]
        steps, place = [], base + size
        while len(place := place[place > base[self._owner(base, place)]]):
            steps.append(through[place])
            place = source[steps[-1]]
        taken = np.sort(np.concatenate(steps))  # edges of a path ascend with its ends
        found, counts = ids[taken], np.ones(len(taken), np.int64)
        odd = np.flatnonzero(found == self.unknown)
        own = [[self.bytes[b] for b in words[int(word[e])].as_py()[int(start[e])].encode("utf-8", "surrogatepass")] for e in taken[odd]]
        counts[odd] = [len(x) for x in own]
        out = np.repeat(found, counts)
        out[np.repeat(found == self.unknown, counts)] = [k for x in own for k in x]
        return np.bincount(word[taken], counts, len(size)).astype(np.int64), out

    @staticmethod
    def _owner(base: np.ndarray, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(base, place, "right") - 1


def id_type(vocabulary: Vocabulary) -> type:
    return np.uint16 if len(vocabulary.pieces) <= 1 << 16 else np.int32


def _packed(vocabulary: Vocabulary, longest_word: int, at_once: int = 1 << 18):
    """Sorted edges as one compressed dictionary for each part and ``at_once`` edges or so."""
    folder, dtype = Folder(vocabulary, longest_word), id_type(vocabulary)
    schema = pa.schema([("part", pa.int32()), ("words", pa.binary()), ("lengths", pa.binary()), ("ids", pa.binary())])

    def pack(edges: pa.Table, press: zstandard.ZstdCompressor) -> pa.RecordBatch:
        edges = edges.combine_chunks()
        named = edges.filter(pc.is_valid(edges.column("word"))).combine_chunks()
        words, parts = (named.column(c).combine_chunks() for c in ("word", "parts"))
        lengths, ids = folder.paths(edges.column("key").to_numpy(), edges.column("id").to_numpy(), words)
        starts = np.cumsum(lengths) - lengths
        words = pc.utf8_slice_codeunits(words, 1)
        rank = np.empty(len(words), np.int64)
        rank[pc.sort_indices(words).to_numpy()] = np.arange(len(words))
        owner = np.repeat(np.arange(len(words)), pc.list_value_length(parts).to_numpy())
        part = parts.flatten().to_numpy()
        order = np.lexsort((rank[owner], part))
        cuts = [*np.flatnonzero(np.concatenate(([True], np.diff(part[order]) != 0))), len(order)]
        rows: dict[str, list] = {"part": [], "words": [], "lengths": [], "ids": []}
        for a, b in zip(cuts, cuts[1:], strict=False):
            mine = owner[order[a:b]]
            rows["part"].append(int(part[order[a]]))
            rows["words"].append(press.compress(" ".join(words.take(pa.array(mine)).to_pylist()).encode("utf-8", "surrogatepass")))
            rows["lengths"].append(press.compress(lengths[mine].astype(np.uint16).tobytes()))
            rows["ids"].append(press.compress(ids[ranges(starts[mine], lengths[mine])].astype(dtype).tobytes()))
        return pa.RecordBatch.from_pydict(rows, schema)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=5)
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) >= at_once:
                rows = pa.Table.from_batches(held)
                number = rows.column("key").to_numpy() >> 2 * folder.bits
                cut = int(np.searchsorted(number, number[-1], "left"))
                held = rows.slice(cut).to_batches()
                if cut:
                    yield pack(rows.slice(0, cut), press)
        if sum(map(len, held)):
            yield pack(pa.Table.from_batches(held), press)

    return packed


class Dictionary:
    """Ids of words; those it lacks are solved."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.solver = vocabulary, None
        self.keep(pa.array([], pa.large_string()), np.zeros(0, np.int64), np.zeros(0, np.int32))

    def keep(self, words: pa.Array, lengths: np.ndarray, ids: np.ndarray) -> None:
        """Know these words only, in the order of their hashes."""
        hashes = hashed(words)
        order = np.argsort(hashes)
        self.hashes, self.words = hashes[order], words.take(pa.array(order))
        self.lengths, self.starts, self.ids = lengths[order], (np.cumsum(lengths) - lengths)[order], ids

    def places(self, words: pa.Array) -> np.ndarray:
        """Where distinct words are kept, or -1; a hash finds a word, its text decides."""
        if not len(self.words) or not len(words):
            return np.full(len(words), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashed(words)), len(self.words) - 1)
        return np.where(pc.equal(self.words.take(pa.array(at)), words).to_numpy(zero_copy_only=False), at, -1)

    def load(self, folder: str, part: int) -> None:
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(folder)
        there = system.get_file_info(fs.FileSelector(f"{root}/part={part}", allow_not_found=True))
        words, lengths, ids = [self.words], [self.lengths], [self.ids]  # none yet
        for info in there:
            if info.path.endswith(".parquet"):
                with system.open_input_file(info.path) as file:
                    table = pq.read_table(file, columns=["words", "lengths", "ids"])
                for row in table.to_pylist():
                    text = pa.array([zstandard.decompress(row["words"])], pa.large_binary()).cast(pa.large_string())
                    words.append(pc.split_pattern(text, " ").flatten())
                    lengths.append(np.frombuffer(zstandard.decompress(row["lengths"]), np.uint16).astype(np.int64))
                    ids.append(np.frombuffer(zstandard.decompress(row["ids"]), id_type(self.vocabulary)).astype(np.int32))
        self.keep(pa.concat_arrays(words), np.concatenate(lengths), np.concatenate(ids))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Offsets of texts into the ids, and the ids."""
        offsets, words = words_of(texts)
        coded = words.dictionary_encode()
        numbers = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        at = self.places(coded.dictionary)
        missing = np.flatnonzero(at < 0)
        starts, lengths, ids = self.starts, self.lengths, self.ids
        if len(missing):
            self.solver = self.solver or Solver(self.vocabulary)
            found = [self.solver.ids(SPACE + coded.dictionary[int(k)].as_py()) for k in missing]
            at[missing] = len(lengths) + np.arange(len(missing))
            more = np.array([len(f) for f in found], np.int64)
            starts = np.concatenate((starts, len(ids) + np.cumsum(more) - more))
            lengths, ids = np.concatenate((lengths, more)), np.concatenate((ids, np.array([k for f in found for k in f], np.int32)))
        at = at[numbers]
        return np.concatenate(([0], np.cumsum(lengths[at])))[offsets], ids[ranges(starts[at], lengths[at])]


def _encoded(folder: str, vocabulary: Vocabulary):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionary = Dictionary(vocabulary)
        dictionary.load(folder, TaskContext.get().partitionId())
        for batch in slices(batches, "__llm_text", SLICE):
            offsets, ids = dictionary.encode(as_text(batch.column("__llm_text")))
            kept = [n for n in batch.schema.names if n != "__llm_text"]
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), lists], names=[*kept, "ids"])

    return encode


def _with_texts(folder: str, vocabulary: Vocabulary):
    encode, decode = _encoded(folder, vocabulary), _decoded(vocabulary)
    return lambda batches: decode(encode(batches))


def encode(
    docs: DataFrame, keep: list[str], vocabulary: Vocabulary, text: str = "text", settings: Settings = Settings(), with_decoded: bool = False
) -> DataFrame:
    """The columns ``keep`` of every document with the ``ids`` of its pieces.

    ``with_decoded`` adds what ``decode`` would, in the same pass over the documents.
    """
    spark = docs.sparkSession
    source = docs.select(*keep, F.col(f"`{text}`").cast("string").alias("__llm_text"))
    uses = source.select("__llm_text").mapInArrow(_words_by_part(settings.longest_word), "part int, word string")
    words = uses.groupBy("word").agg(F.collect_list("part").alias("parts"))
    found = edges(words, piece_table(spark, vocabulary), vocabulary, settings.longest_word)
    folder = shared_path(spark, "lattice-dictionaries")
    folder = folder if "://" in folder else f"file://{folder.removeprefix('file:')}"
    packed = found.mapInArrow(_packed(vocabulary, settings.longest_word), "part int, words binary, lengths binary, ids binary")
    packed.repartition("part").write.partitionBy("part").parquet(folder)
    head = ", ".join([schema_of(source, keep)] * bool(keep) + ["ids array<int>"] + ["decoded string"] * with_decoded)
    return source.mapInArrow((_with_texts if with_decoded else _encoded)(folder, vocabulary), head)


def decoded(ids: np.ndarray, pieces: np.ndarray, bytes_of: np.ndarray) -> str:
    """The text of ids; ``bytes_of`` has the byte of each piece, or -1."""
    found = bytes_of[ids]
    if (found >= 0).any():
        out, run = [], bytearray()
        for k, byte in zip(ids.tolist(), found.tolist(), strict=True):
            if byte >= 0:
                run.append(byte)
            else:
                out += [run.decode("utf-8", "replace"), pieces[k]]
                run = bytearray()
        text = "".join([*out, run.decode("utf-8", "replace")])
    else:
        text = "".join(pieces[ids].tolist())
    return text.replace(SPACE, " ")[1:]


def _decoded(vocabulary: Vocabulary):
    pieces, bytes_of = np.array(vocabulary.pieces, object), np.full(len(vocabulary.pieces), -1)
    bytes_of[byte_ids(vocabulary)] = np.arange(256)
    raw = pa.array([bytes([b]) if b >= 0 else p.encode() for p, b in zip(vocabulary.pieces, bytes_of.tolist(), strict=True)], pa.large_binary())

    def texts_of(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """Texts of all rows together: the bytes of their pieces, one after another, cut where rows end."""
        if (flat < 0).any():
            raise IndexError("ids outside the vocabulary")
        joined = raw.take(pa.array(flat))
        ends = np.frombuffer(joined.buffers()[1], np.int64)[: len(flat) + 1]
        texts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(ends[offsets]), joined.buffers()[2]])
        try:
            texts = texts.cast(pa.large_string())
        except pa.ArrowInvalid:  # bytes that are no text
            return pa.array([decoded(flat[a:b], pieces, bytes_of) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], pa.string())
        return pc.utf8_slice_codeunits(pc.replace_substring(texts, SPACE, " "), 1).cast(pa.string())

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("ids")
            offsets = column.offsets.to_numpy().astype(np.int64)
            flat = column.values.to_numpy()[offsets[0] : offsets[-1]] if len(offsets) else np.zeros(0, np.int32)
            texts = texts_of(flat, offsets - offsets[:1])
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, "decoded"])

    return decode


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """All columns with ``decoded``, the text of ``ids``."""
    return encoded.mapInArrow(_decoded(vocabulary), f"{schema_of(encoded, encoded.columns)}, decoded string")
