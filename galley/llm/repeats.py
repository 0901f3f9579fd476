"""Removal of long repeated byte strings by run-compressed Burrows-Wheeler transforms.

A byte is removed if a string of ``length`` bytes that covers it also starts anywhere else in
the corpus, the same text included; matches never leave a text.

* **Anchors.** Of every window of ``length`` bytes the gram of ``gram`` bytes with the least
  hash is an anchor, so two equal windows have it at the same offset. An anchor's context are
  the bytes that a window around it may reach; an anchor whose gram occurs once needs no more
  work. Contexts that occur as a whole more than once are repeated in full, and from here on
  one of them stands for all.
* **Index.** The distinct contexts of an anchor are sorted by what follows its start. Going to
  the left, the bytes before the sorted suffixes are a column of their Burrows-Wheeler
  transform. Inside a run of equal bytes neighbours stay neighbours and their match grows by
  one; only at the ends of runs a suffix gets another neighbour, and its match is the least
  of those sampled in between. So the columns are streamed run by run, the longer of both
  neighbours' matches is a suffix's matching statistic, and where it reaches ``length`` the
  window that starts there is marked.
* **Hot anchors.** Where an anchor has more than ``contexts`` distinct contexts, its windows
  are parted by how many bytes they have before the anchor, half and half. All windows of a
  half share the bytes around the anchor that each of them covers, so these bytes are the
  key of a smaller class, and contexts cut to what the half can reach fall together. After
  at most log2(length) rounds a class is one window, so no task ever holds a group whose size
  grows with the corpus, and nothing is left out.

Contexts are told apart by the 64-bit hash of the anchor's gram and 64 bits of BLAKE2b;
windows of an index are compared byte by byte.

Defined cases: a null text is empty; texts below ``length`` bytes are kept; equal rows repeat
each other; an empty table gives no rows. Whatever the index marks is a repeated window, so
the result does not depend on which of equal contexts stands for the others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galley.llm.common import Shelf, kept_names, map_rows, numbered, quoted, ranges, slices

RESULTS = {"n_bytes": "long", "n_removed": "long", "n_spans": "long", "kept": "binary"}
MARK = "row long, start int, stop int"


@dataclass(frozen=True)
class Settings:
    length: int = 200
    #: bytes of an anchor, a power of two
    gram: int = 64
    #: distinct contexts of one anchor that are indexed together
    contexts: int = 256
    #: contexts whose columns are streamed side by side
    side_by_side: int = 20_000

    @property
    def reach(self) -> int:
        """Bytes that a window may have before its anchor."""
        return self.length - self.gram


# ---- anchors


def gram_hashes(raw: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes (a power of two) from each position on."""
    h = (raw.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    size, factor = 1, 0xD6E8FEB86659FD93
    while size < gram:
        h = h[: len(h) - size] * np.uint64(factor) + h[size:]
        factor = factor * factor % (1 << 64)
        size *= 2
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def anchors_of(raw: np.ndarray, bounds: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors of texts that lie one after another."""
    windows = np.maximum(np.diff(bounds) - settings.length + 1, 0)
    if not windows.any():
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = gram_hashes(raw, settings.gram)
    # of equal hashes the leftmost counts
    least = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    size, grams = 1, settings.reach + 1
    while 2 * size <= grams:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if grams > size:
        least = np.minimum(least[: size - grams], least[grams - size :])
    chosen = least[ranges(bounds[:-1], windows)] & np.uint64(0xFFFFFFFF)
    at = np.unique(chosen).astype(np.int64)
    return at, h[at]


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column without nulls, and where each row begins."""
    column = column.cast(pa.large_binary())
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(column.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    return raw, bounds - bounds[0]


def _anchors(settings: Settings):
    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            raw, bounds = flat_bytes(batch.column("text"))
            at, h = anchors_of(raw, bounds, settings)
            of = np.searchsorted(bounds, at, "right") - 1
            start = np.maximum(at - settings.reach, bounds[of])
            stop = np.minimum(at + settings.length, bounds[of + 1])
            view = memoryview(raw)
            contexts = [hashlib.blake2b(view[x:y], digest_size=8).digest() for x, y in zip(start.tolist(), stop.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(h.view(np.int64)),
                    pa.array(np.frombuffer(b"".join(contexts), np.int64)),
                    batch.column("row").take(pa.array(of)),
                    pa.array((at - bounds[of]).astype(np.int32)),
                    pa.array((at - start).astype(np.int32)),
                    pa.array((stop - start).astype(np.int32)),
                ],
                names=["key", "context", "row", "at", "before", "size"],
            )

    return anchors


# ---- the index


def matched_windows(
    group: np.ndarray, raw: np.ndarray, bounds: np.ndarray, before: np.ndarray, low: np.ndarray, high: np.ndarray, settings: Settings
) -> np.ndarray:
    """For each context and offset, whether the window with so many bytes before the anchor is another context's too.

    Contexts are sorted by group and by the bytes from their anchor on, which lies ``before``
    bytes behind their start; windows count from ``low`` to ``high`` bytes before it.
    """
    n, reach, length = len(group), settings.reach, settings.length
    sizes = np.diff(bounds)
    table = np.zeros((n, reach + length), np.uint8)
    table.reshape(-1)[ranges(np.arange(n) * (reach + length) + reach - before, sizes)] = raw
    hits = np.zeros((n, reach + 1), bool)
    order = np.arange(n)
    after = sizes - before
    # match[i]: bytes that the suffixes i - 1 and i have in common; below 0 between groups
    match = np.full(n + 1, -1, np.int64)
    differ = table[1:, reach:] != table[:-1, reach:]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), length)
    common = np.minimum(common, np.minimum(after[1:], after[:-1]))
    match[1:n] = np.where(group[1:] == group[:-1], common, -1)
    for offset in range(int(high.max(initial=-1)) + 1):
        if offset:
            rows = np.flatnonzero((before[order] >= offset) & (high[order] >= offset))
            members = order[rows]
            column = group[members] * 256 + table[members, reach - offset]
            turn = np.argsort(column, kind="stable")
            rows, members, column = rows[turn], members[turn], column[turn]
            same = np.flatnonzero(column[1:] == column[:-1])
            fresh = np.full(len(rows) + 1, -1, np.int64)
            inner = np.flatnonzero(group[members[1:]] == group[members[:-1]]) + 1
            fresh[inner] = 0
            first, last = rows[same] + 1, rows[same + 1]
            grown = match[last]
            ends = np.flatnonzero(first != last)  # neighbours of which a run has come between
            if len(ends):
                pairs = np.stack((first[ends], last[ends] + 1), axis=1).reshape(-1)
                grown[ends] = np.minimum.reduceat(match, pairs)[::2]
            fresh[same + 1] = grown + 1
            order, match = members, fresh
        long = match >= length
        found = order[long[:-1] | long[1:]]
        found = found[(low[found] <= offset) & (offset <= high[found])]
        hits[found, offset] = True
    return hits


def _marks(settings: Settings):
    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done(table: pa.Table) -> pa.RecordBatch:
            keys = table.column("key").combine_chunks()
            group = keys.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
            raw, bounds = flat_bytes(table.column("data").combine_chunks())
            numbers = {c: table.column(c).to_numpy().astype(np.int64) for c in ("before", "low", "high", "at")}
            hits = matched_windows(group, raw, bounds, numbers["before"], numbers["low"], numbers["high"], settings)
            edges = np.diff(np.pad(hits, ((0, 0), (1, 1))).astype(np.int8), axis=1)
            row, low = np.nonzero(edges == 1)
            high = np.nonzero(edges == -1)[1] - 1  # both row by row, so they belong together
            return pa.RecordBatch.from_arrays(
                [
                    table.column("row").combine_chunks().take(pa.array(row)),
                    pa.array((numbers["at"][row] - high).astype(np.int32)),
                    pa.array((numbers["at"][row] - low + settings.length).astype(np.int32)),
                ],
                names=["row", "start", "stop"],
            )

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= settings.side_by_side:
                table = pa.Table.from_batches(held)
                keys = table.column("key").combine_chunks()
                last = keys.index(keys[-1]).as_py()  # the last group may go on
                if last:
                    yield done(table.slice(0, last))
                held = table.slice(last).to_batches()
        if held:
            yield done(pa.Table.from_batches(held))

    return marks


def indexed(contexts: DataFrame, settings: Settings) -> DataFrame:
    """Marks of the windows that distinct contexts of a key share."""
    rows = contexts.select("key", "row", "at", "before", "low", "high", "data", F.expr("substring(data, before + 1)").alias("tail"))
    return rows.repartition("key").sortWithinPartitions("key", "tail").drop("tail").mapInArrow(_marks(settings), MARK)


# ---- classes of contexts


def classes(shelf: Shelf, members: DataFrame) -> DataFrame:
    """Distinct contexts by key: one member that stands for them, how often they occur, and how many the key has."""
    each = members.groupBy("key", "context").agg(F.count("*").alias("n"), F.min("row").alias("row"), F.min_by("at", "row").alias("at"))
    each = shelf.put(each, "contexts")
    kinds = shelf.put(each.groupBy("key").agg(F.count("*").alias("kinds"), F.sum("n").alias("total")).filter("total > 1"), "kinds")
    found = shelf.put(each.join(kinds.drop("total"), "key"), "classes")
    shelf.drop(each, kinds)
    return found


def whole(members: DataFrame, found: DataFrame, start: Column, stop: Column) -> DataFrame:
    """Marks of all members whose context occurs more than once, in full."""
    twice = found.filter("n > 1").select("key", "context")
    return members.join(twice, ["key", "context"]).select("row", start.cast("int").alias("start"), stop.cast("int").alias("stop"))


def _cut(settings: Settings):
    """Bytes of the wanted contexts of each text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            out: dict[str, list] = {c: [] for c in ("key", "row", "at", "before", "data", "kinds")}
            texts, rows = batch.column("text"), batch.column("row").to_pylist()
            for k, wanted in enumerate(batch.column("wanted").to_pylist()):
                text = texts[k].as_py()
                for w in wanted:
                    at = w["at"]
                    before = min(at, settings.reach)
                    out["key"].append(f"{w['key']:016x}")
                    out["row"].append(rows[k])
                    out["at"].append(at)
                    out["before"].append(before)
                    out["data"].append(text[at - before : at + settings.length])
                    out["kinds"].append(w["kinds"])
            kinds = {"key": pa.string(), "row": pa.int64(), "data": pa.binary(), "kinds": pa.int64()}
            yield pa.RecordBatch.from_arrays([pa.array(v, kinds.get(c, pa.int32())) for c, v in out.items()], names=list(out))

    return cut


def halves(contexts: DataFrame, settings: Settings) -> DataFrame:
    """Contexts of hot keys, dealt to the lower and the upper half of their offsets.

    The bytes that all windows of a half cover are its key; contexts that lack some of them
    have no such window.
    """
    middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
    both = F.array(F.struct(F.col("low"), middle.alias("high")), F.struct((middle + 1).alias("low"), F.col("high")))
    dealt = contexts.withColumn("half", F.explode(F.when(F.col("low") < F.col("high"), both))).select(
        "key", "row", "at", "before", "data", F.col("half.low").alias("low"), F.col("half.high").alias("high")
    )
    core = f"substring(data, before - low + 1, low + {settings.length} - high)"
    dealt = dealt.filter(f"before >= low AND length(data) - before >= {settings.length} - high")
    dealt = dealt.withColumn("key", F.sha2(F.concat_ws(":", "key", "low", "high", F.base64(F.expr(core))), 256))
    start = "greatest(before - high, 0)"
    dealt = dealt.withColumn("data", F.expr(f"substring(data, {start} + 1, before - {start} + {settings.length} - low)"))
    dealt = dealt.withColumn("before", F.expr("least(before, high)"))
    return dealt.withColumn("context", F.sha2("data", 256))


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", 2 << 20):
        texts, spans = batch.column("text"), batch.column("spans").to_pylist()
        size, removed, count, kept = [], [], [], []
        for k, found in enumerate(spans):
            text, parts, at, runs = texts[k].as_py(), [], 0, 0
            stop = -1
            for s in sorted((s["start"], s["stop"]) for s in found or ()):
                if s[0] > stop:  # spans that touch are one
                    runs += 1
                    parts.append(text[at : s[0]])
                stop = max(stop, s[1])
                at = stop
            parts.append(text[at:])
            left = b"".join(parts)
            size.append(len(text))
            removed.append(len(text) - len(left))
            count.append(runs)
            kept.append(left)
        names = kept_names(batch)
        columns = [pa.array(c, pa.int64()) for c in (size, removed, count)] + [pa.array(kept, pa.binary())]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *columns], names=[*names, *RESULTS])


def without_repeats(docs: DataFrame, keep: list[str], text: str = "text", settings: Settings | None = None) -> DataFrame:
    """The columns ``keep`` of every document with n_bytes, n_removed, n_spans and the bytes kept.

    ``n_spans`` counts maximal removed runs.
    """
    clashes = [c for c in keep if c.lower() in RESULTS]
    if clashes:
        raise ValueError(f"names of results: {clashes}")
    settings, spark = settings or Settings(), docs.sparkSession
    shelf = Shelf(spark, "repeats")
    source = docs.select(
        *(F.col(quoted(c)).alias(f"__kept_{k}") for k, c in enumerate(keep)),
        F.coalesce(F.col(quoted(text)).cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    copy = shelf.put(numbered(source, "row"), "texts")
    anchors = shelf.put(
        copy.select("row", "text").mapInArrow(_anchors(settings), "key long, context long, row long, at int, before int, size int"), "anchors"
    )
    repeated = shelf.put(anchors.groupBy("key").count().filter("count > 1").select("key"), "repeated")
    members = shelf.put(anchors.join(repeated, "key"), "members")
    shelf.drop(anchors, repeated)

    found = classes(shelf, members)
    marks = [shelf.put(whole(members, found, F.expr("at - before"), F.expr("at - before + size")), "marks")]
    shelf.drop(members)
    wanted = found.filter("kinds > 1").groupBy("row").agg(F.collect_list(F.struct("key", "at", "kinds")).alias("wanted"))
    contexts = copy.select("row", "text").join(wanted, "row").mapInArrow(
        _cut(settings), "key string, row long, at int, before int, data binary, kinds long"
    )
    contexts = shelf.put(contexts.withColumn("low", F.lit(0)).withColumn("high", F.lit(settings.reach)), "index")
    shelf.drop(found)
    while True:
        marks.append(shelf.put(indexed(contexts.filter(F.col("kinds") <= settings.contexts), settings), "marks"))
        hot = contexts.filter(F.col("kinds") > settings.contexts)
        if hot.isEmpty():
            break
        members = shelf.put(halves(hot, settings), "members")
        shelf.drop(contexts)
        found = classes(shelf, members)
        marks.append(shelf.put(whole(members, found, F.expr("at - before"), F.expr("at - before + length(data)")), "marks"))
        standing = found.filter("kinds > 1").select("key", "context", "row", "at", "kinds")
        contexts = shelf.put(members.join(standing, ["key", "context", "row", "at"]).drop("context"), "index")
        shelf.drop(members, found)
    shelf.drop(contexts)

    every = marks[0]
    for more in marks[1:]:
        every = every.unionByName(more)
    spans = every.filter(F.col("stop") - F.col("start") >= settings.length).groupBy("row").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    joined = copy.join(spans, "row", "left")
    inner = [f"__kept_{k}" for k in range(len(keep))]
    return map_rows(joined, inner, ["text", "spans"], _kept, RESULTS).toDF(*keep, *RESULTS)
