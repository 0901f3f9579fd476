"""Best-fit packing of token pieces by a grouping genetic algorithm.

Documents are tokenized once, cut only where they are longer than a sequence, and packed by
length. A plan is a multiset of patterns (the lengths that share a sequence, with how often
the pattern is used), so a plan for any number of documents has a size bounded by the
sequence length, and islands evolve whole plans: crossover injects well-filled sequences
of one parent, drops sequences of the other that would use a piece twice and best-fits the
displaced pieces; elites migrate between islands after each epoch. Pieces then take the
places of their length by a distributed numbering.

Defined cases: a null text is empty, and an empty text is the end token alone; equal rows
are packed once each; an empty table gives no pieces; ties between plans go to the first
island and member.
"""

from __future__ import annotations

import json
import os
import random
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from galley.llm.common import (
    as_text,
    distinct_words,
    ranges,
    schema_of,
    slices,
    stored,
    white_space_words,
)

#: Letters that lower-case to one letter and have no other normal form (a-z and Latin-1).
PLAIN = re.compile("[a-zA-ZÀ-ÖØ-öø-ÿ]+")
WORD_END = "</w>"

Pattern = tuple[int, ...]
Plan = dict[Pattern, int]


@dataclass(frozen=True)
class Settings:
    capacity: int = 2048
    end_token: int = 0
    islands: int = 4
    members: int = 4
    generations: int = 4
    epochs: int = 2
    well_filled: float = 0.98
    seed: int = 7


class WordEncoder:
    """Token ids of whole texts from remembered ids of their words.

    The tokenizer drops white space and never joins what it parts, so a text's ids are its
    words' ids one after another; full stops and commas at the end of a word are split off
    by it too, and A-Z are lower-cased. Words are therefore encoded once per task, and a word
    seen before costs one look-up for each slice of text that holds it.
    """

    def __init__(self, tokenizer_json: str, remembered: int = 800_000):
        from tokenizers import Tokenizer, pre_tokenizers

        # a task has one core; threads of the library would each keep memory of their own
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        # plain words need no normalizing or splitting: the model and its byte alphabet do
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[k for piece, k in vocabulary.items() if piece.endswith(WORD_END)]] = True
        self.remembered = remembered
        self.clear()

    def clear(self) -> None:
        self.memo: dict[str, int] = {}
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, words: list[str]) -> None:
        plain = [w for w in words if PLAIN.fullmatch(w)]
        others = [w for w in words if not PLAIN.fullmatch(w)]
        lines = [" ".join(plain[k : k + 256]).lower() for k in range(0, len(plain), 256)]
        ids = []
        for k in range(0, len(lines), 32):
            found = self.plain.encode_batch_fast(lines[k : k + 32], add_special_tokens=False)
            ids += [np.array(one.ids, np.uint32) for one in found]
        ends = np.flatnonzero(self.last[np.concatenate(ids)]) + 1 if ids else np.zeros(0, np.int64)
        if len(ends) != len(plain):
            raise ValueError("the vocabulary has no single word end per word")
        lengths = np.diff(ends, prepend=0)
        if others:
            rest = []
            for k in range(0, len(others), 4096):
                found = self.tokenizer.encode_batch_fast(others[k : k + 4096], add_special_tokens=False)
                rest += [one.ids for one in found]
            ids.append(np.array([k for one in rest for k in one], np.uint32))
            lengths = np.concatenate((lengths, [len(one) for one in rest])).astype(np.int64)
        self._remember(plain + others, np.concatenate(ids), lengths)

    @staticmethod
    def _parts(word: str) -> tuple[str, str]:
        if word[-1] not in ".,":
            return word, ""
        stem = word.rstrip(".,")
        return (stem, word[len(stem) :]) if stem and PLAIN.fullmatch(stem[-1]) else (word, "")

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Offsets of texts into the ids, and the ids."""
        if len(self.memo) > self.remembered:
            self.clear()
        offsets, words = white_space_words(texts)
        special = pc.match_substring(words, "<|")  # special tokens are told by their case
        numbers, names = distinct_words(pc.if_else(special, words, pc.ascii_lower(words)))
        at = np.fromiter(map(self.memo.get, names, repeat(-1)), np.int64, len(names))
        unknown = np.flatnonzero(at < 0)
        if len(unknown):
            at[unknown] = self._whole([names[k] for k in unknown])
        lengths = self.lengths[at][numbers]
        before = np.concatenate(([0], np.cumsum(lengths)))
        return before[offsets], self.ids[ranges(self.starts[at][numbers], lengths)]

    def _whole(self, words: list[str]) -> list[int]:
        """Places of words not seen before, after learning their parts and themselves."""
        parts = [self._parts(word) for word in words]
        fresh = dict.fromkeys(p for pair in parts for p in pair if p and p not in self.memo)
        if fresh:
            self._learn(list(fresh))
        joined = [(word, pair) for word, pair in zip(words, parts, strict=True) if pair[1]]
        flat = np.array([self.memo[p] for _, pair in joined for p in pair], np.int64)
        lengths = self.lengths[flat]
        ids = self.ids[ranges(self.starts[flat], lengths)]
        self._remember([word for word, _ in joined], ids, lengths.reshape(-1, 2).sum(axis=1))
        return [self.memo[word] for word in words]

    def _remember(self, words: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        """Words with their ids one after another, ``lengths`` of them each."""
        self.memo.update(zip(words, range(len(self.lengths), len(self.lengths) + len(words)), strict=True))
        self.starts = np.concatenate((self.starts, len(self.ids) + np.cumsum(lengths) - lengths))
        self.lengths = np.concatenate((self.lengths, lengths))
        self.ids = np.concatenate((self.ids, ids))


def _cut(tokenizer_json: str, settings: Settings, with_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = WordEncoder(tokenizer_json), TaskContext.get().partitionId()
        seen = np.zeros(settings.capacity + 1, np.int64)
        end = np.array([settings.end_token], "<u4")
        for batch in slices(batches, "__llm_text", 4 << 20):
            offsets, ids = encoder.encode(as_text(batch.column("__llm_text")))
            row, piece, start, length, crc, nth, pieces = [], [], [], [], [], [], []
            for k in range(batch.num_rows):
                own = np.concatenate((ids[offsets[k] : offsets[k + 1]].astype("<u4"), end))
                for n, a in enumerate(range(0, len(own), settings.capacity)):
                    part = own[a : a + settings.capacity]
                    row.append(k)
                    piece.append(n)
                    start.append(a)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
                    nth.append(seen[len(part)])
                    seen[len(part)] += 1
                    if with_ids:
                        pieces.append(part.view(np.int32))
            kept = [n for n in batch.schema.names if n != "__llm_text"]
            columns = [batch.column(n).take(pa.array(row)) for n in kept]
            columns += [pa.array(piece, pa.int32())]
            columns += [pa.array(x, pa.int64()) for x in (start, length, crc)]
            columns += [pa.array(pieces, pa.list_(pa.int32()))] * with_ids
            columns += [pa.array([task] * len(row), pa.int32()), pa.array(nth, pa.int64())]
            names = [*kept, "piece", "start", "length", "ids_crc32", *["ids"] * with_ids, "__llm_task", "__llm_nth"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return cut


def best_fit(free: Counter[int], bins: Plan, capacity: int, order: list[int] | None = None) -> Plan:
    """Put the free pieces, longest first, where they leave least room; ``bins`` are open."""
    by_room: dict[int, Counter[Pattern]] = defaultdict(Counter)
    rooms = 0
    for pattern, times in bins.items():
        room = capacity - sum(pattern)
        by_room[room][pattern] += times
        rooms |= 1 << room
    for length in order or sorted(free, reverse=True):
        left = free[length]
        while left > 0:
            fitting = rooms >> length
            if not fitting:
                per_bin = min(capacity // length, left)
                times = left // per_bin
                pattern, room = (length,) * per_bin, capacity - length * per_bin
                left -= times * per_bin
                by_room[room][pattern] += times
                rooms |= 1 << room
                continue
            room = length + (fitting & -fitting).bit_length() - 1
            here = by_room[room]
            pattern, there = here.popitem()
            times = min(there, left)
            if there > times:
                here[pattern] = there - times
            elif not here:
                rooms &= ~(1 << room)
            left -= times
            rest = room - length
            by_room[rest][tuple(sorted((*pattern, length), reverse=True))] += times
            rooms |= 1 << rest
    plan: Plan = Counter()
    for found in by_room.values():
        for pattern, times in found.items():
            if times:
                plan[pattern] += times
    return plan


def cost(plan: Plan, capacity: int) -> tuple[int, float]:
    """Sequences used, then how evenly (worse) or unevenly (better) they are filled."""
    used = sum(plan.values())
    squares = sum(times * (sum(p) / capacity) ** 2 for p, times in plan.items())
    return used, -squares / max(used, 1)


def crossover(one: Plan, other: Plan, lengths: Counter[int], settings: Settings, rng: random.Random) -> Plan:
    """Well-filled sequences of one plan, what still fits of the other, the rest by best fit."""
    left = Counter(lengths)
    child: Plan = Counter()
    good = sorted(p for p in one if sum(p) >= settings.well_filled * settings.capacity)
    for pattern in good:
        times = rng.randint(0, one[pattern])
        if times:
            child[pattern] += times
            for length in pattern:
                left[length] -= times
    for pattern in sorted(other, key=lambda p: (-sum(p), p)):
        need = Counter(pattern)
        times = min(other[pattern], *(left[length] // n for length, n in need.items()))
        if times > 0:
            child[pattern] += times
            for length, n in need.items():
                left[length] -= n * times
    return best_fit(+left, child, settings.capacity)


def mutated(plan: Plan, lengths: Counter[int], settings: Settings, rng: random.Random) -> Plan:
    """Empty a share of the worst-filled sequences and best-fit their pieces anew."""
    ordered = sorted(plan, key=lambda p: (sum(p), p))
    kept, free = Counter(plan), Counter()
    for pattern in ordered[: max(1, len(ordered) // 10)]:
        times = rng.randint(0, kept[pattern])
        kept[pattern] -= times
        for length in pattern:
            free[length] += times
    order = sorted(free, key=lambda n: n * rng.uniform(0.9, 1.1), reverse=True)
    return best_fit(+free, +kept, settings.capacity, order)


def _to_text(plan: Plan) -> str:
    return json.dumps([[list(p), n] for p, n in sorted(plan.items())])


def _from_text(text: str) -> Plan:
    return {tuple(p): n for p, n in json.loads(text)}


def _evolve(lengths: Counter[int], settings: Settings, epoch: int):
    least = -(-sum(k * n for k, n in lengths.items()) // settings.capacity)

    def evolve(group: pd.DataFrame) -> pd.DataFrame:
        island = int(group["island"].iloc[0])
        rng = random.Random(settings.seed * 1_000_003 + island * 1009 + epoch)
        people = [_from_text(t) for t in group.sort_values(["member", "plan"])["plan"] if t]
        while len(people) < settings.members:
            noise = 0.0 if not people and island == 0 else 0.15
            order = sorted(lengths, key=lambda n: n * rng.uniform(1 - noise, 1 + noise), reverse=True)
            people.append(best_fit(lengths, {}, settings.capacity, order))
        rank = lambda plan: cost(plan, settings.capacity)
        people.sort(key=rank)
        for _ in range(settings.generations):
            if rank(people[0])[0] <= least:
                break
            one, other = rng.sample(people, 2)
            child = mutated(crossover(one, other, lengths, settings, rng), lengths, settings, rng)
            people = sorted([*people, child], key=rank)[: settings.members]
        people = people[: settings.members]
        return pd.DataFrame(
            {
                "island": island,
                "member": range(len(people)),
                "used": [rank(p)[0] for p in people],
                "uneven": [rank(p)[1] for p in people],
                "plan": [_to_text(p) for p in people],
            }
        )

    return evolve


def evolved(spark, lengths: Counter[int], settings: Settings) -> Plan:
    """The best plan of all islands for a histogram of lengths."""
    schema = "island int, member int, used long, uneven double, plan string"
    people = spark.range(settings.islands, numPartitions=settings.islands).select(
        F.col("id").cast("int").alias("island"),
        F.lit(0).alias("member"),
        F.lit(0).cast("long").alias("used"),
        F.lit(0.0).alias("uneven"),
        F.lit("").alias("plan"),
    )
    least = -(-sum(k * n for k, n in lengths.items()) // settings.capacity)
    for epoch in range(settings.epochs):
        people = stored(people.groupBy("island").applyInPandas(_evolve(lengths, settings, epoch), schema), "packing-plans")
        best = people.orderBy("used", "uneven", "island", "member").limit(1)
        if best.first()["used"] <= least:
            break
        # the elite of each island also joins the next island
        elite = people.filter(F.col("member") == 0).withColumn("island", (F.col("island") + 1) % settings.islands)
        people = people.unionByName(elite)
    return _from_text(best.first()["plan"])


def places(plan: Plan) -> dict[str, np.ndarray]:
    """Runs of places per length: length, first index, first sequence, offset, by length and index."""
    rows, base, used = [], 0, Counter()
    for pattern, times in sorted(plan.items()):
        offset = 0
        for length in pattern:
            rows.append((length, used[length], base, offset))
            used[length] += times
            offset += length
        base += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return dict(zip(("length", "first", "sequence", "offset"), table.T, strict=True))


def _seated(table: dict[str, np.ndarray]):
    # one number orders (length, index): lengths are below 2^20, indexes below 2^43
    keys = (table["length"] << 43) | table["first"]

    def seat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            index = batch.column("__llm_nth").to_numpy() + batch.column("__llm_before").to_numpy()
            at = np.searchsorted(keys, (length << 43) | index, "right") - 1
            sequence = table["sequence"][at] + index - table["first"][at]
            kept = [n for n in batch.schema.names if not n.startswith("__llm_")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in kept), pa.array(sequence), pa.array(table["offset"][at])],
                names=[*kept, "sequence_id", "offset"],
            )

    return seat


def pack(
    docs: DataFrame,
    keep: list[str],
    tokenizer: str,
    text: str = "text",
    settings: Settings = Settings(),
    with_ids: bool = True,
) -> DataFrame:
    """A row per piece: ``keep``, piece, start, length, ids_crc32, ids, sequence_id, offset.

    ``tokenizer`` is the path of a tokenizer file on the driver. The driver receives the
    histogram of lengths and a plan, both bounded by the sequence length.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as file:
        definition = file.read()
    source = docs.select(*keep, F.col(text).cast("string").alias("__llm_text"))
    names = "piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    head = ", ".join([schema_of(source, keep)] * bool(keep) + [names])
    pieces = stored(
        source.mapInArrow(_cut(definition, settings, with_ids), f"{head}, __llm_task int, __llm_nth long"), "packing-pieces"
    )
    cells = pieces.groupBy("length", "__llm_task").agg(F.count("*").alias("n"))
    cells = stored(
        cells.select(
            "length",
            "__llm_task",
            "n",
            (F.sum("n").over(Window.partitionBy("length").orderBy("__llm_task")) - F.col("n")).alias("__llm_before"),
        ),
        "packing-cells",
    )
    histogram = cells.groupBy("length").agg(F.sum("n").alias("n")).collect()
    lengths = Counter({r["length"]: r["n"] for r in histogram})
    plan = evolved(spark, lengths, settings) if lengths else {}
    numbered = pieces.join(cells.drop("n"), ["length", "__llm_task"])
    out = [*keep, "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
    return numbered.select(*(F.col(f"`{c}`") for c in out), "__llm_nth", "__llm_before").mapInArrow(
        _seated(places(plan)), f"{head}, sequence_id long, offset long"
    )
