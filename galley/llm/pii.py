"""Personal data: fixed patterns first, contexts learned from their finds second.

Emails, addresses, card and phone numbers found by fixed rules are the seeds. The words
around them induce lexical patterns; Spark scores the graph of patterns and instances in
rounds until no score rises any more (a pattern by the share of its distinct instances that are believed, an instance by
the patterns it occurs in), and instances of high-confidence patterns that no fixed rule
found become spans of the pattern's kind.

Instances of the graph are runs with a digit of ``SHORTEST_CANDIDATE`` characters or more
and groups of digits parted by blanks, dots, slashes, hyphens or brackets; they are spans
wherever they occur. Shorter runs and runs without a digit are too common elsewhere for
that: they are spans in the slots of high-confidence patterns only, where the pattern still
has its confidence with them among its instances, and vouch for no other pattern.

Defined cases: a null text is empty; a text without finds has no spans; equal finds in
copies count once as instances but give a span in each copy; rows with null or repeated
ids are kept apart by an internal number; offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galley.llm.common import Shelf, as_text, distinct_words, numbered, schema_of, slices, stored, white_space_words
from galley.llm.graph import BITS, bit_set, maybe_in

# fixed values of the contract: kinds in order of output, and their patterns
KINDS = ("email", "ip", "card", "phone")
LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++((?:\.[0-9]++){3})")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

DIGITS = re.compile(r"[0-9]+")
RUN = re.compile(r"[\w.+@-]*")
LEXICAL = re.compile(r"\w+|[^\w\s]")
GROUPS = re.compile(r"(?<![\w.+@-])\(?[0-9]++(?:[\x20().\/-]{1,2}+[0-9]++)++(?![\w@])")
RUN_CHARACTERS = frozenset(".+@-_")
SHORTEST_CANDIDATE = 5
REMEMBERED_WORDS = 1 << 18
ROW = "__llm_row"

SPAN = "struct<kind:int,start:int,stop:int>"
CANDIDATE = "struct<instance:long,kind:int,patterns:array<string>,start:int,stop:int>"


@dataclass(frozen=True)
class Settings:
    #: Rounds end when no pattern's score rises by more than this.
    tolerance: float = 1e-3
    least_instances: int = 3
    smoothing: float = 1.0
    confidence: float = 0.75


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from their @ signs so that long words cost no more than once."""
    ended = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > ended and text[start - 1] in LOCAL_PART:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            ended = at = domain.end()
            yield start, ended
        else:
            at += 1


def addresses(text: str) -> Iterator[tuple[int, int]]:
    for m in IP.finditer(text):
        parts = (p.lstrip("0") for p in m[0].split("."))
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            yield m.span()


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            yield m.span()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind as listed, then start."""
    finders = (emails if "@" in text else None, None, None, phones if "+" in text else None)
    if DIGITS.search(text):
        finders = (finders[0], addresses, cards, finders[3])
    return [(k, *span) for k, find in enumerate(finders) if find for span in find(text)]


def words_before(text: str, stop: int, n: int) -> list[str]:
    """The last ``n`` words that end at or before ``stop``, whole however long they are."""
    reach = 80
    while True:
        start = max(0, stop - reach)
        words = LEXICAL.findall(text, start, stop)
        if len(words) > n or not start:
            return words[-n:]
        reach *= 4


def lexical(word: str) -> str:
    """A word as patterns hold it: in lower case, digits as one 0."""
    return DIGITS.sub("0", word.lower())


def contexts(text: str, start: int, stop: int) -> list[str]:
    """Lexical patterns of a place: two words before it, and one word on either side."""
    before = [lexical(w) for w in words_before(text, start, 2)]
    following = LEXICAL.search(text, stop)
    after = [lexical(following[0])] if following else []
    out = []
    if len(before) == 2:
        out.append(f"{before[0]} {before[1]} _")
    if before and after:
        out.append(f"{before[-1]} _ {after[0]}")
    return out


def free(places: Iterator[tuple[int, int]], taken: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Those of ascending places that no base span touches."""
    blocked = sorted((a, b) for _, a, b in taken)
    k = 0
    for start, stop in places:
        while k < len(blocked) and blocked[k][1] <= start:
            k += 1
        if k == len(blocked) or blocked[k][0] >= stop:
            yield start, stop


def runs(text: str) -> Iterator[tuple[int, int]]:
    """Runs of word characters with a digit."""
    done = 0
    for m in DIGITS.finditer(text):
        if m.start() < done:
            continue
        start = m.start()
        while start > done and (text[start - 1].isalnum() or text[start - 1] in RUN_CHARACTERS):
            start -= 1
        done = stop = RUN.match(text, m.end()).end()
        while stop > start and text[stop - 1] in ".+@-":
            stop -= 1
        if stop - start >= SHORTEST_CANDIDATE:
            yield start, stop


def identifiers(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Runs with a digit and groups of digits that no base span touches.

    A run inside a group is a place of its own, as a group may only be numbers in a row.
    """
    groups = (m.span() for m in GROUPS.finditer(text))
    return sorted({*free(runs(text), taken), *free(groups, taken)})


def fillers(text: str, opens, begin: int = 0, end: int | None = None) -> Iterator[tuple[int, int]]:
    """Runs that are no ``identifiers``, after words for which ``opens`` holds, in a part of a text."""
    done, before = begin, (words_before(text, begin, 1) or [None])[0]
    for m in LEXICAL.finditer(text, begin, len(text) if end is None else end):
        start = m.start()
        if start >= done and before is not None and opens(before) and (run := RUN.match(text, start)).end() > start:
            done = stop = run.end()
            while stop > start and text[stop - 1] in ".+@-":
                stop -= 1
            value = text[start:stop]
            if (len(value) < SHORTEST_CANDIDATE or not DIGITS.search(value)) and any(c.isalnum() for c in value):
                yield start, stop
        before = m[0]


def word_places(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends, in code points of their text, of what ``white_space_words`` gives."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.zeros(len(data), bool)  # a text's first byte begins a word of its own
    edge[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = np.flatnonzero(~blank & (edge | np.concatenate(([True], blank[:-1]))))
    stops = np.flatnonzero(~blank & np.concatenate((edge[1:] | blank[1:], [True]))) + 1
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    base = points[offsets[np.searchsorted(offsets, starts, "right") - 1]]
    return points[starts] - base, points[stops] - base


def instance(value: str) -> int:
    digest = hashlib.blake2b(value.encode("utf-8", "surrogatepass"), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base_type = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32())]))
    candidate_type = pa.list_(
        pa.struct(
            [
                ("instance", pa.int64()),
                ("kind", pa.int32()),
                ("patterns", pa.list_(pa.string())),
                ("start", pa.int32()),
                ("stop", pa.int32()),
            ]
        )
    )
    for batch in batches:
        base, candidates = [], []
        for text in as_text(batch.column("__llm_text")):
            text = text.as_py()
            spans = base_spans(text)
            places = [(None, a, b) for a, b in identifiers(text, spans)] + spans
            base.append([{"kind": k, "start": a, "stop": b} for k, a, b in spans])
            candidates.append(
                [
                    {"instance": instance(text[a:b]), "kind": k, "patterns": contexts(text, a, b), "start": a, "stop": b}
                    for k, a, b in places
                ]
            )
        kept = batch.schema.names
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in kept), pa.array(base, base_type), pa.array(candidates, candidate_type)],
            names=[*kept, "__llm_base", "__llm_candidates"],
        )


def crc(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass"))


def place_of(x: int) -> int:
    """``graph.places_of`` of one number, without an array for it."""
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & 0xFFFFFFFFFFFFFFFF
    return (x ^ (x >> 31)) >> (64 - BITS)


#: Parts of a pattern, in the order of ``_pattern_marks``: of "a b _" the first and second, of "a _ b" the left and right.
ROLES = range(4)
MARKS = 16


def _pattern_marks(patterns: DataFrame) -> np.ndarray:
    """For each role and place of a word's crc, the patterns that have such a word there, as bits of their hashes.

    512 kB a role, whatever the number of patterns.
    """
    part = F.split("pattern", " ")
    two, around = part[2] == "_", part[1] == "_"  # both if "_" is a word of the text as well
    roles = [(two, part[0]), (two, part[1]), (around, part[0]), (around, part[2])]
    words = F.explode(F.array(*(F.struct(F.lit(k).alias("role"), F.when(when, word).alias("word")) for k, (when, word) in zip(ROLES, roles, strict=True))))
    bit = F.expr("shiftleft(1L, cast(pmod(xxhash64(pattern), 64) as int))")
    rows = patterns.select(words.alias("w"), bit.alias("bit")).filter("w.word is not null")
    place = F.crc32(F.col("w.word").cast("binary")) % (1 << MARKS)
    found = rows.groupBy(F.col("w.role").alias("role"), place.alias("place")).agg(F.bit_or("bit").alias("bits")).collect()
    marks = np.zeros((len(ROLES), 1 << MARKS), np.int64)
    for r in found:
        marks[r["role"], r["place"]] = r["bits"]
    return marks.view(np.uint64)


def _word_marks(marks: np.ndarray, names: list[str]) -> np.ndarray:
    """``_pattern_marks`` of all lexical parts of each word, by role; every bit of a word without any."""
    plain = np.fromiter((w.isascii() and "\0" not in w for w in names), bool, len(names))
    # one pass over all words of plain characters; the character between them is a part by itself
    parts = LEXICAL.findall(DIGITS.sub("0", "\0".join(w for w, ok in zip(names, plain, strict=True) if ok).lower()))
    between = np.fromiter((x == "\0" for x in parts), bool, len(parts))
    owners = np.flatnonzero(plain)[np.cumsum(between)[~between]] if len(parts) else np.zeros(0, np.int64)
    codes = np.fromiter((zlib.crc32(x.encode()) for x in parts), np.int64, len(parts))[~between]
    others = [(k, crc(lexical(x))) for k in np.flatnonzero(~plain).tolist() for x in LEXICAL.findall(names[k])]
    if others:
        more = np.array(others, np.int64)
        owners, codes = np.concatenate((owners, more[:, 0])), np.concatenate((codes, more[:, 1]))
    found = np.zeros((len(ROLES), len(names)), np.uint64)
    for role in ROLES:
        bits = marks[role, codes & ((1 << MARKS) - 1)]
        there = np.flatnonzero(bits)
        np.bitwise_or.at(found[role], owners[there], bits[there])
    found[:, np.bincount(owners, minlength=len(names)) == 0] = ~np.uint64(0)
    return found


def _standing(openers: np.ndarray, strong: np.ndarray, marks: np.ndarray | None = None):
    """Fillers in slots of patterns that may be strong, a row for each pattern.

    Distinct words of a slice of texts are tested first; only stretches of words are walked
    where the other word of an opener's pattern stands near enough (all without ``marks``).
    """

    marks = np.full((len(ROLES), 1 << MARKS), ~np.uint64(0)) if marks is None else marks
    first, whole = openers.tobytes(), strong.tobytes()

    def has(bits: bytes, word: str) -> bool:
        at = place_of(crc(word))
        return bool(bits[at >> 3] >> (at & 7) & 1)

    def standing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, bool] = {}

        def opens(word: str) -> bool:
            found = known.get(word)
            if found is None:
                if len(known) >= REMEMBERED_WORDS:
                    known.clear()
                found = known[word] = has(first, lexical(word))
            return found

        def stretches(texts: pa.Array) -> Iterator[tuple[int, int, int]]:
            """Text, begin and end of words in which a slot may open, each with the word after it.

            What is filled stands in the opener's word or the next one, a pattern's word before
            the opener in its word or the one before, a word after the slot two words on at
            most. A word without any lexical part carries on what stands before it, and words
            of other texts may only add to what is walked.
            """
            offsets, words = white_space_words(texts)
            numbers, names = distinct_words(words)
            before, opener, left, right = _word_marks(marks, names)[:, numbers]
            none = np.zeros(2, np.uint64)
            before |= np.concatenate((none[:1], before[:-1]))
            right = right | np.concatenate((right[1:], none))[: len(right)] | np.concatenate((right[2:], none))[: len(right)]
            opening = (opener & before | left & right) != 0
            begins = np.zeros(len(opening), bool)
            begins[offsets[:-1][offsets[:-1] < len(opening)]] = True
            # also words after those, within a text
            walked = opening | (np.concatenate(([False], opening[:-1])) & ~begins)
            earlier = np.concatenate(([False], walked[:-1])) & ~begins
            heads = np.flatnonzero(walked & ~earlier)
            tails = np.flatnonzero(walked & ~np.concatenate((earlier[1:] & walked[1:], [False])))
            starts, stops = word_places(texts)
            owners = np.searchsorted(offsets, heads, "right") - 1
            return zip(owners.tolist(), starts[heads].tolist(), stops[tails].tolist(), strict=True)

        for batch in slices(batches, "__llm_text"):
            rows = []
            texts = as_text(batch.column("__llm_text"))
            ids, bases = batch.column(ROW), batch.column("__llm_base")
            for k, parts in groupby(stretches(texts), itemgetter(0)):
                text = texts[k].as_py()
                places = [place for _, begin, end in parts for place in fillers(text, opens, begin, end)]
                if not places:
                    continue
                spans = [(s["kind"], s["start"], s["stop"]) for s in bases[k].as_py()]
                for a, b in free(places, spans):
                    for pattern in contexts(text, a, b):
                        if has(whole, pattern):
                            rows.append((ids[k].as_py(), instance(text[a:b]), pattern, a, b))
            if rows:
                types = (pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                    names=[ROW, "instance", "pattern", "start", "stop"],
                )

    return standing


def standing_in(found: DataFrame, strong: DataFrame, settings: Settings) -> DataFrame:
    """Fillers of slots of strong patterns that stay so with them: row, kind, start, stop."""
    parts = F.split("pattern", " ")
    # one of the first two parts is the word before the slot, as "_" is a word as well
    openers = bit_set(strong.select(F.explode(F.array(parts[0], parts[1])).alias("w")).select(F.crc32(F.col("w").cast("binary"))))
    patterns = bit_set(strong.select(F.crc32(F.col("pattern").cast("binary"))))
    marks = _pattern_marks(strong.select("pattern").distinct())
    schema = f"{ROW} long, instance long, pattern string, start int, stop int"
    slots = found.select(ROW, "__llm_text", "__llm_base").mapInArrow(_standing(openers, patterns, marks), schema)
    slots = stored(slots.join(strong.select("pattern").distinct(), "pattern", "left_semi"), "pii-slots")
    more = slots.select("pattern", "instance").distinct().groupBy("pattern").agg(F.count("*").alias("fillers"))
    smoothed = F.col("instances") + F.lit(settings.smoothing)
    strong = strong.join(more, "pattern").withColumn("score", F.col("score") * smoothed / (smoothed + F.col("fillers")))
    strong = strong.filter(F.col("score") >= settings.confidence)
    return (
        slots.join(strong.select("pattern", "kind", "score"), "pattern")
        .groupBy(ROW, "start", "stop")
        .agg(F.min_by("kind", F.struct(-F.col("score"), F.col("kind"))).alias("kind"))
        .select(ROW, "kind", "start", "stop")
    )


def learned(candidates: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """Instances without a fixed rule that patterns vouch for: ``instance``, ``kind``.

    Also the patterns of high confidence: ``pattern``, ``kind``, ``instances``, ``score``.

    ``candidates`` has instance, kind (null: not a seed), patterns. Counts are of distinct
    instances, so copies of a document vouch for nothing.
    """
    spark = candidates.sparkSession
    edges = stored(
        candidates.select("instance", "kind", F.explode("patterns").alias("pattern"))
        .groupBy("pattern", "instance")
        .agg(F.max("kind").alias("kind")),
        "pii-edges",
    )
    sizes = edges.groupBy("pattern").agg(F.count("*").alias("instances"))
    # patterns without a seed stay: instances believed in one round vouch for them in the next
    useful = sizes.filter(F.col("instances") >= settings.least_instances)
    graph = stored(edges.join(useful, "pattern"), "pii-graph")
    unseen = graph.filter(F.col("kind").isNull()).drop("kind")
    seeds = (
        graph.filter(F.col("kind").isNotNull())
        .groupBy("pattern", "kind", "instances")
        .agg(F.count("*").cast("double").alias("belief"))
    )
    believed = spark.createDataFrame([], "instance long, kind int, belief double")
    patterns = spark.createDataFrame([], "pattern string, kind int, instances long, score double")
    # scores only rise from round to round and stay below 1, so the rounds end
    while True:
        more = (
            unseen.join(believed, "instance")
            .groupBy("pattern", "kind", "instances")
            .agg(F.sum("belief").alias("belief"))
        )
        earlier, patterns = patterns.select("pattern", "kind", F.col("score").alias("earlier")), stored(
            seeds.unionByName(more)
            .groupBy("pattern", "kind", "instances")
            .agg((F.sum("belief") / (F.col("instances") + F.lit(settings.smoothing))).alias("score")),
            "pii-patterns",
        )
        rise = F.col("score") - F.coalesce("earlier", F.lit(0.0))
        if patterns.join(earlier, ["pattern", "kind"], "left").filter(rise > settings.tolerance).isEmpty():
            break
        believed = stored(
            unseen.join(patterns.select("pattern", "kind", "score"), "pattern")
            .groupBy("instance", "kind")
            .agg((1 - F.exp(F.sum(F.log1p(-F.least(F.col("score"), F.lit(0.999)))))).alias("belief")),
            "pii-believed",
        )
    strong = stored(patterns.filter(F.col("score") >= settings.confidence), "pii-strong")
    instances = (
        unseen.join(strong.select("pattern", "kind", "score"), "pattern")
        .groupBy("instance")
        .agg(F.min_by("kind", F.struct(-F.col("score"), F.col("kind"))).alias("kind"))
    )
    return instances, strong


def find(docs: DataFrame, keep: list[str], text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """The columns ``keep`` of every row with ``base`` and ``added`` spans (kind, start, stop).

    Kinds are places in ``KINDS``.
    """
    found, added = _searched(docs, keep, text, settings)
    return (
        found.join(added, ROW, "left")
        .withColumn("added", F.coalesce("added", F.array().cast(f"array<{SPAN}>")))
        .select(*(F.col(f"`{c}`") for c in keep), F.col("__llm_base").alias("base"), "added")
    )


def _searched(docs: DataFrame, keep: list[str], text: str, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """Numbered rows with ``keep``, ``__llm_text`` and ``__llm_base``; ``added`` spans of the numbers that have any."""
    source = numbered(docs.select(*keep, F.col(f"`{text}`").cast("string").alias("__llm_text")), ROW)
    names = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema]
    schema = ", ".join([*names, f"__llm_base array<{SPAN}>", f"__llm_candidates array<{CANDIDATE}>"])
    found = Shelf(docs.sparkSession, "pii").put(source.mapInArrow(_found, schema), "found")
    places = found.select(ROW, F.explode("__llm_candidates").alias("c")).select(ROW, "c.*")
    new, strong = learned(places, settings)
    spans = places.filter(F.col("kind").isNull()).drop("kind").join(new, "instance").select(ROW, "kind", "start", "stop")
    if not strong.isEmpty():
        spans = spans.unionByName(standing_in(found, strong, settings))
    added = (
        spans.groupBy(ROW)
        .agg(F.sort_array(F.collect_list(F.struct("kind", "start", "stop"))).alias("added"))
    )
    return found, added


def written(spans):
    """``kind:start:end`` of spans, comma-joined in the order they have."""
    kinds = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", kinds[s["kind"]], s["start"], s["stop"])), ","
    )


def _redacted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, spans in zip(batch.column("__llm_text").to_pylist(), batch.column("__llm_spans").to_pylist(), strict=True):
            if spans:
                parts, done = [], 0
                for s in sorted(spans, key=lambda s: (s["start"], s["stop"])):
                    if s["start"] >= done:
                        parts += [text[done : s["start"]], f"[{KINDS[s['kind']].upper()}]"]
                    done = max(done, s["stop"])
                text = "".join([*parts, text[done:]])
            out.append(text)
        kept = [n for n in batch.schema.names if n not in ("__llm_text", "__llm_spans")]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in kept), pa.array(out, pa.string())], names=[*kept, "__llm_text"]
        )


def redact(docs: DataFrame, text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """All columns, with every span in the text replaced by its kind in brackets.

    Overlapping spans become one mark, named after the first. Texts are stored once, and only
    rows that may have added spans go through a join.
    """
    others = [c for c in docs.columns if c != text]
    found, added = _searched(docs, others, text, settings)
    added = stored(added.withColumnRenamed("added", "__llm_added"), "pii-added")
    bits, rows = bit_set(added.select(ROW)), found.drop("__llm_candidates")
    none = F.array().cast(f"array<{SPAN}>")
    some = maybe_in(rows, ROW, bits).join(added, ROW, "left").withColumn("__llm_added", F.coalesce("__llm_added", none))
    spans = some.unionByName(maybe_in(rows, ROW, bits, inside=False).withColumn("__llm_added", none))
    spans = spans.select(*(F.col(f"`{c}`") for c in others), "__llm_text", F.concat("__llm_base", "__llm_added").alias("__llm_spans"))
    return spans.mapInArrow(_redacted, ", ".join([*([schema_of(docs, others)] if others else []), "__llm_text string"])).select(
        *(F.col("__llm_text").alias(text) if c == text else F.col(f"`{c}`") for c in docs.columns)
    )
