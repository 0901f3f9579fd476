"""Exact Jaccard self-join of documents on word shingles.

A document's set of shingle hashes has a band of sizes; only bands that are close can
link. Tiles are the documents that share a token among the first ones of a global
order of tokens (a pair above the threshold always does). Inside a tile hashed bitmaps
bound the overlap of two documents from above by their bit counts; what passes is decided
by intersecting the sorted arrays.

Equal sets are one node. Tokens in more than ``light`` nodes are moved to the end of the
order and only the documents that used them are tiled again, so common passages make no
pairs. Nodes are first linked to one pivot each, and afterwards a tile only looks at pairs
from different components. What passes its bitmaps there connects nodes to groups, and a tile
gives out a row for each node at most, not its pairs; the sorted arrays of a group's nodes
then decide, in tiles as well, which give out as many links as connect its components. Tiles
are two chunks of bounded size each, however large a run or group is.

Shingles are known by 64-bit hashes, sets by 56 bits and their band: two shingles of a
document share a hash with a chance of 10^-11, any two of 10^8 sets in one band with 0.1.

Defined cases: a null text and a text without words have an empty set and link with
nothing; rows with null ids take part, a component's id is its smallest non-null one; equal
ids stay separate rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galley.llm.common import (
    Shelf,
    as_text,
    mixed,
    numbered,
    ranges,
    schema_of,
    slices,
    white_space_words,
)
from galley.llm.graph import bit_set, components, in_set, maybe_in

ROW = "__llm_row"
BAND_BITS = 8
#: A little above 4/3 to the power 1/4: sizes at the threshold are at most four bands apart.
BAND_RATIO = 1.34**0.25
BANDS_APART = 4
#: A chunk of a common token's nodes, and one of nodes whose sets are compared; a tile has two.
TILE_USES, TILE_NODES, TILE_BYTES = 2048, 512, 4 << 20


@dataclass(frozen=True)
class Settings:
    words: int = 5
    percent: int = 75
    light: int = 16
    rounds: int = 3


def word_hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes of words: sums of a scrambled number for each byte and its place."""
    if not len(words):
        return np.zeros(0, np.uint64)
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].astype(np.uint64)
    lengths = np.diff(offsets)
    places = ranges(np.zeros(len(words), np.int64), lengths).astype(np.uint64)
    values = mixed((places << np.uint64(8) | data) + np.uint64(1))
    return mixed(np.add.reduceat(values, offsets[:-1] - offsets[0]) + lengths.astype(np.uint64))


def shingle_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    offsets, flat = white_space_words(pc.ascii_lower(texts))
    coded = flat.dictionary_encode()
    hashes = word_hashes(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)]
    factors = mixed(np.arange(1, words + 1, dtype=np.uint64)) | np.uint64(1)
    size = len(hashes)
    rolled = np.zeros(max(size - words + 1, 0), np.uint64)
    for k in range(words):
        rolled += hashes[k : k + len(rolled)] * factors[k]
    rolled = mixed(rolled)
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        if b - a >= words:
            yield np.unique(rolled[a : b - words + 1])
        elif b > a:  # the whole sequence is one shingle; its length keeps it apart
            short = (hashes[a:b] * factors[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            yield mixed(np.array([short], np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def band(n: int) -> int:
    return min(int(math.log(n) / math.log(BAND_RATIO)), (1 << BAND_BITS) - 1)


def node_of(tokens: np.ndarray) -> int:
    """Hash of a set with its band in the low bits, as a signed number."""
    digest = int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)
    return (digest >> BAND_BITS << BAND_BITS) | band(len(tokens))


def _features(settings: Settings):
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # of this task's documents; a copy elsewhere is harmless
        for batch in slices(batches, "__llm_text", 2 << 20):
            sizes, nodes, sets, bits = [], [], [], []
            for tokens in shingle_sets(as_text(batch.column("__llm_text")), settings.words):
                node = node_of(tokens) if len(tokens) else None
                sizes.append(len(tokens))
                nodes.append(node)
                first = node is not None and node not in seen
                sets.append(tokens.tobytes() if first else None)
                bits.append(signature(tokens) if first else None)
                seen.add(node)
            kept = [n for n in batch.schema.names if n != "__llm_text"]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(n) for n in kept),
                    pa.array(sizes, pa.int64()),
                    pa.array(nodes, pa.int64()),
                    pa.array(bits, pa.binary()),
                    pa.array(sets, pa.binary()),
                ],
                names=[*kept, "__llm_n", "__llm_node", "__llm_bits", "__llm_set"],
            )

    return features


def _postings(settings: Settings, late: np.ndarray | None, only: np.ndarray | None):
    """Tokens of each set's prefix, those in ``late`` last in the order; of all sets or ``only`` some."""

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, nodes = [], []
            if only is not None:
                batch = batch.filter(pa.array(in_set(only, batch.column("node").to_numpy())))
            for node, data in zip(batch.column("node").to_pylist(), batch.column("tokens"), strict=True):
                own = np.frombuffer(data.as_buffer(), np.uint64)
                n = len(own)
                prefix = n - -(-settings.percent * n // 100) + 1
                if late is not None:
                    behind = in_set(late, own)
                    own = np.concatenate((own[~behind], own[behind]))
                tokens.append(own[:prefix])
                nodes.append(np.full(min(prefix, n), node, np.int64))
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.concatenate(nodes))],
                    names=["token", "node"],
                )

    return post


def near_bands(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    mask = (1 << BAND_BITS) - 1
    return np.abs((a & mask) - (b & mask)) <= BANDS_APART


def _pairs_of(tokens: np.ndarray, nodes: np.ndarray, light: int) -> list[np.ndarray]:
    """Rows (0, node, node), (1, token, node) and (2, token, node) of runs of equal tokens.

    A light run gives its pairs with its first node (0) and, if it has more, its nodes (2);
    any other run gives its nodes (1).
    """
    if not len(tokens):
        return []
    new = np.ones(len(tokens), bool)
    new[1:] = (tokens[1:] != tokens[:-1]) | (nodes[1:] != nodes[:-1])
    tokens, nodes = tokens[new], nodes[new]
    starts = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
    lengths = np.diff(np.concatenate((starts, [len(tokens)])))
    out = []
    for length in np.unique(lengths[(lengths > 1) & (lengths <= light)]):
        here = starts[lengths == length]
        b = nodes[here[:, None] + np.arange(1, length)].ravel()
        a = np.repeat(nodes[here], length - 1)
        ok = near_bands(a, b)
        if ok.any():
            both = np.unique(np.stack((a[ok], b[ok]), 1), axis=0)
            out.append(np.column_stack((np.zeros(len(both), np.int64), both)))
    several = np.repeat((lengths > 2) & (lengths <= light), lengths)
    if several.any():
        out.append(np.column_stack((np.full(several.sum(), 2), tokens[several], nodes[several])))
    heavy = np.repeat(lengths > light, lengths)
    if heavy.any():
        out.append(np.column_stack((np.ones(heavy.sum(), np.int64), tokens[heavy], nodes[heavy])))
    return out


def _as_batches(found: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    for rows in found:
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows[:, 0].astype(np.int32)), pa.array(rows[:, 1]), pa.array(rows[:, 2])], names=["kind", "a", "b"]
        )


def _runs(light: int):
    """Runs of equal tokens in sorted rows; a long run passes through without being kept."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = nodes = np.zeros(0, np.int64)
        passing = None
        for batch in batches:
            t, n = (batch.column(k).to_numpy() for k in range(2))
            if passing is not None:
                k = int(np.searchsorted(t, passing, "right"))
                yield from _as_batches([np.column_stack((np.ones(k, np.int64), t[:k], n[:k]))] if k else [])
                t, n = t[k:], n[k:]
            if not len(t):
                continue
            passing = None
            tokens, nodes = np.concatenate((tokens, t)), np.concatenate((nodes, n))
            cut = int(np.searchsorted(tokens, tokens[-1], "left"))
            yield from _as_batches(_pairs_of(tokens[:cut], nodes[:cut], light))
            tokens, nodes = tokens[cut:], nodes[cut:]
            if len(np.unique(nodes)) > light:
                yield from _as_batches(_pairs_of(tokens, nodes, light))
                passing, tokens, nodes = tokens[0], tokens[:0], nodes[:0]
        yield from _as_batches(_pairs_of(tokens, nodes, light))

    return runs


def tiled(shelf: Shelf, sets: DataFrame, settings: Settings, late: np.ndarray | None = None, only: np.ndarray | None = None) -> DataFrame:
    """Pairs of nodes (kind 0), uses of common (kind 1) and of light tokens (kind 2), as ``_pairs_of``."""
    posted = sets.mapInArrow(_postings(settings, late, only), "token long, node long")
    ordered = posted.repartition("token").sortWithinPartitions("token", "node")
    runs = shelf.put(ordered.mapInArrow(_runs(settings.light), "kind int, a long, b long"), "runs")
    shelf.drop()  # the shuffled tokens, before those of a next round
    return runs


def signature(tokens: np.ndarray) -> bytes:
    """A bitmap of about two bits per token; its width is a power of two set by the size."""
    width = max(64, 1 << (2 * len(tokens) - 1).bit_length())
    bits = np.zeros(width, bool)
    bits[(tokens & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def most_common(a: bytes, na: int, b: bytes, nb: int) -> int:
    """Upper bound of the overlap: every token not shared flips at most one bit."""
    if len(a) > len(b):
        a, na, b, nb = b, nb, a, na
    width, x, y = 8 * len(a), int.from_bytes(a, "little"), int.from_bytes(b, "little")
    size = 8 * len(b)
    while size > width:  # fold the wider one
        size //= 2
        y = (y >> size) | (y & ((1 << size) - 1))
    return (na + nb - (x ^ y).bit_count()) // 2


def _possible(percent: int):
    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(k) for k in ("bits_a", "n_a", "bits_b", "n_b")]
            ok = []
            for x, n, y, m in zip(*(c.to_pylist() for c in columns), strict=True):
                most = most_common(x, n, y, m)
                ok.append(100 * most >= percent * (n + m - most))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return possible


def _linked(percent: int):
    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("tokens_a"), batch.column("tokens_b"), strict=True):
                one, two = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common = len(np.intersect1d(one, two, assume_unique=True))
                ok.append(100 * common >= percent * (len(one) + len(two) - common))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return linked


def _with_both(pairs: DataFrame, of: DataFrame, columns: list[str]) -> DataFrame:
    for side in ("a", "b"):
        pairs = pairs.join(of.select(F.col("node").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in columns)), side)
    return pairs


class Tile:
    """Nodes with their components and bitmaps, in ascending order; pairs are those of different chunks, if it has two."""

    def __init__(self, nodes: np.ndarray, roots: np.ndarray, chunks: np.ndarray, n: np.ndarray, bits: list[bytes]):
        self.nodes, self.roots, self.chunks, self.n = nodes, roots, chunks, n
        self.words = np.array([len(x) // 8 for x in bits])
        self.place = np.zeros(len(bits), np.int64)
        self.maps: dict[int, np.ndarray] = {}
        for words in np.unique(self.words):
            mine = np.flatnonzero(self.words == words)
            self.place[mine] = np.arange(len(mine))
            self.maps[words] = np.frombuffer(b"".join(bits[k] for k in mine), np.uint64).reshape(len(mine), words)

    def _bits(self, rows: np.ndarray, words: int, own: int) -> np.ndarray:
        """Bitmaps of rows that are ``own`` words wide, folded to ``words``."""
        found = self.maps[own][self.place[rows]]
        while own > words:
            own //= 2
            found = found[:, :own] | found[:, own:]
        return found

    def most_common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Upper bounds of the overlaps of pairs of rows, as ``most_common`` of two bitmaps."""
        flips = np.zeros(len(i), np.int64)
        wide = self.words[i], self.words[j]
        for one, two in {*zip(*(w.tolist() for w in wide), strict=True)}:
            mine = np.flatnonzero((wide[0] == one) & (wide[1] == two))
            for at in range(0, len(mine), 1 << 15):
                part, words = mine[at : at + (1 << 15)], min(one, two)
                differ = self._bits(i[part], words, one) ^ self._bits(j[part], words, two)
                flips[part] = np.bitwise_count(differ).sum(axis=1)
        return (self.n[i] + self.n[j] - flips) // 2

    def possible(self, percent: int, label: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Rows with later rows of other components and labels that may link; labels may be joined meanwhile."""
        rows, two = np.arange(len(self.nodes)), len(np.unique(self.chunks)) > 1
        for at in range(0, len(rows), 256):
            own = rows[at : at + 256, None]
            apart = (own < rows) & (label[own] != label) & (self.roots[own] != self.roots) & near_bands(self.nodes[own], self.nodes)
            if two:
                apart &= self.chunks[own] != self.chunks
            i, j = np.nonzero(apart)
            i = i + at
            most = self.most_common(i, j)
            ok = 100 * most >= percent * (self.n[i] + self.n[j] - most)
            i, j = i[ok], j[ok]
            heads = np.flatnonzero(np.concatenate(([True], np.diff(i) != 0))) if len(i) else []
            for row, partners in zip(i[heads].tolist(), np.split(j, heads[1:]), strict=False):
                partners = partners[label[partners] != label[row]]
                if len(partners):
                    yield row, partners


def _joined(label: np.ndarray, row: int, others: np.ndarray) -> None:
    """Give a row, others and all that have their labels the smallest of these."""
    these = np.unique(label[np.append(others, row)])
    label[np.isin(label, these)] = these[0]


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of equal ``group`` and ``tile`` from rows sorted by them."""
    held: list[pa.RecordBatch] = []

    def cut(last: bool) -> Iterator[pa.Table]:
        rows = pa.Table.from_batches(held).combine_chunks()
        new = [np.diff(rows.column(c).to_numpy()) != 0 for c in ("group", "tile")]
        cuts = [0, *(np.flatnonzero(new[0] | new[1]) + 1), *[len(rows)] * last]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield rows.slice(a, b - a).combine_chunks()
        held[:] = rows.slice(cuts[-1]).to_batches()

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            if any(held[0].column(c)[0] != batch.column(c)[-1] for c in ("group", "tile")):
                yield from cut(False)
    if held:
        yield from cut(True)


def _pairs(a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
    if len(a):
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _crossing(percent: int):
    """What possible pairs of different components connect in a tile: each node with the smallest one it is connected to."""

    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _tiles(batches):
            tile = Tile(*(rows.column(c).to_numpy() for c in ("node", "root", "chunk", "n")), rows.column("bits").to_pylist())
            label = np.arange(len(rows))
            for row, partners in tile.possible(percent, label):
                _joined(label, row, partners)
            others = np.flatnonzero(label != np.arange(len(rows)))
            yield from _pairs(tile.nodes[label[others]], tile.nodes[others])

    return cross


def _linking(percent: int):
    """Links of a tile's nodes, found by their arrays, as many as connect its components."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _tiles(batches):
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows.column("tokens").chunk(0)]
            n = np.array([len(x) for x in sets])
            tile = Tile(*(rows.column(c).to_numpy() for c in ("node", "root", "chunk")), n, [signature(x) for x in sets])
            names, tokens = np.unique(np.concatenate(sets), return_inverse=True)
            starts, own = np.cumsum(n) - n, np.zeros(len(names), bool)
            label = np.unique(tile.roots, return_inverse=True)[1]
            found: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
            for row, partners in tile.possible(percent, label):
                mine, theirs = tokens[starts[row] : starts[row] + n[row]], n[partners]
                own[mine] = True
                common = np.add.reduceat(own[tokens[ranges(starts[partners], theirs)]], np.cumsum(theirs) - theirs, dtype=np.int64)
                own[mine] = False
                linked = partners[100 * common >= percent * (n[row] + theirs - common)]
                if len(linked):
                    linked = linked[np.unique(label[linked], return_index=True)[1]]
                    found.append((np.full(len(linked), tile.nodes[row]), tile.nodes[linked]))
                    _joined(label, row, linked)
            yield from _pairs(*(np.concatenate(x) for x in zip(*found, strict=True)))

    return link


def dealt(rows: DataFrame) -> DataFrame:
    """Rows of a group in ``chunks`` chunks by their nodes, each once in every tile of two chunks, sorted by group and tile."""
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("other"))
    tile = F.least("chunk", "other") * F.col("chunks") + F.greatest("chunk", "other")
    rows = rows.withColumn("tile", tile).drop("other", "chunks")
    return rows.repartition("group", "tile").sortWithinPartitions("group", "tile", "node")


def node_components(shelf: Shelf, features: DataFrame, settings: Settings) -> DataFrame:
    """``node``, ``root`` of all nodes that link with another one."""
    sets = features.filter(F.col("__llm_set").isNotNull()).select(
        F.col("__llm_node").alias("node"), F.col("__llm_set").alias("tokens")
    )
    runs = tiled(shelf, sets, settings)
    made, light, late = [runs], [runs.filter("kind <> 1")], None
    heavy = runs.filter("kind = 1").select(F.col("a").alias("token"), F.col("b").alias("node"))
    left = heavy.select("node").distinct().count()
    for _ in range(settings.rounds - 1):
        if not left:
            break
        more = bit_set(heavy.select("token"))
        late = more if late is None else more | late
        runs = tiled(shelf, sets, settings, late, bit_set(heavy.select("node")))
        made.append(runs)
        light.append(runs.filter("kind <> 1"))
        heavy = runs.filter("kind = 1").select(F.col("a").alias("token"), F.col("b").alias("node"))
        before, left = left, heavy.select("node").distinct().count()
        if left > 0.9 * before:
            break
    signed = features.filter(F.col("__llm_set").isNotNull()).groupBy(F.col("__llm_node").alias("node"))
    signed = shelf.put(signed.agg(F.first("__llm_n").alias("n"), F.first("__llm_bits").alias("bits")), "signatures")
    found = light[0]
    for more in light[1:]:
        found = found.unionByName(more)
    pairs = found.filter("kind = 0").select("a", "b")
    uses = found.filter("kind = 2").select(F.col("a").alias("token"), F.col("b").alias("node")).unionByName(heavy)

    def passing(some: DataFrame) -> DataFrame:
        return _with_both(some, signed, ["bits", "n"]).mapInArrow(_possible(settings.percent), "a long, b long")

    def verified(some: DataFrame) -> DataFrame:
        """Pairs (stored ones) that link, stored; only the arrays of their nodes are moved, each once."""
        nodes = bit_set(some.select("a").unionByName(some.select(F.col("b").alias("a"))))
        arrays = maybe_in(sets, "node", nodes).groupBy("node").agg(F.first("tokens").alias("tokens"))
        arrays = shelf.put(arrays, "sets")
        linked = shelf.put(_with_both(some, arrays, ["tokens"]).mapInArrow(_linked(settings.percent), "a long, b long"), "links")
        shelf.drop(arrays)
        return linked

    pairs = shelf.put(passing(pairs.distinct()), "pairs")
    # first one partner for each node: its smallest, or the pivot it shares most tokens with
    first = pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    if left:
        pivots = heavy.groupBy("token").agg(F.min("node").alias("pivot"))
        shared = heavy.join(pivots, "token").filter("node <> pivot").groupBy("node", "pivot").agg(F.count("*").alias("n"))
        star = shared.groupBy("node").agg(F.max_by("pivot", F.struct("n", "pivot")).alias("a"))
        first = first.unionByName(star.select("a", F.col("node").alias("b"))).distinct()
    first = shelf.put(first, "first")
    links = verified(first)
    known = shelf.put(components(links), "components")
    # then what other pairs could still join, as groups of nodes
    rest = pairs.join(first, ["a", "b"], "left_anti")
    for side in ("a", "b"):
        rest = rest.join(known.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}")), side, "left")
    roots = [F.coalesce(f"root_{side}", side) for side in ("a", "b")]
    rest = rest.filter(roots[0] != roots[1]).select("a", "b")
    if not uses.isEmpty():
        labelled = uses.join(known, "node", "left").select("token", "node", F.coalesce("root", "node").alias("root"))
        mixed_ = labelled.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("uses"))
        mixed_ = mixed_.filter("low <> high").select("token", F.ceil(F.col("uses") / TILE_USES).alias("chunks"))
        runs = labelled.join(mixed_, "token").distinct().join(signed, "node").withColumnRenamed("token", "group")
        rest = rest.unionByName(dealt(runs).mapInArrow(_crossing(settings.percent), "a long, b long"))
    rest = shelf.put(rest.distinct(), "rest")
    shelf.drop(pairs, first, signed, *made)
    if rest.isEmpty():
        return known
    groups = shelf.put(components(rest).withColumnRenamed("root", "group"), "groups")
    arrays = maybe_in(sets, "node", bit_set(groups.select("node"))).groupBy("node").agg(F.first("tokens").alias("tokens"))
    members = groups.join(known, "node", "left").select("node", "group", F.coalesce("root", "node").alias("root"))
    members = shelf.put(members.join(arrays, "node"), "sets")
    sizes = members.groupBy("group").agg(F.count("*").alias("nodes"), F.sum(F.octet_length("tokens")).alias("bytes"))
    chunks = F.greatest(F.ceil(F.col("nodes") / TILE_NODES), F.ceil(F.col("bytes") / TILE_BYTES))
    tiles = dealt(members.join(sizes.select("group", chunks.alias("chunks")), "group"))
    more = shelf.put(tiles.mapInArrow(_linking(settings.percent), "a long, b long"), "links")
    return known if more.isEmpty() else components(links.unionByName(more))


def join(docs: DataFrame, keep: list[str], doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """The columns ``keep`` of every row with n_shingles, component_id and kept.

    ``kept`` is true for one row of each component: its smallest id, its first row. The
    result also has the row numbers of ``numbered(docs)`` where ``keep`` names them.
    """
    return _join(Shelf(docs.sparkSession, "jaccard"), docs, keep, doc_id, text, settings)


def _join(shelf: Shelf, docs: DataFrame, keep: list[str], doc_id: str, text: str, settings: Settings) -> DataFrame:
    source = docs if ROW in docs.columns else numbered(docs, ROW)
    source = source.select(
        *keep, *[ROW] * (ROW not in keep), F.col(f"`{doc_id}`").alias("__llm_id"), F.col(f"`{text}`").cast("string").alias("__llm_text")
    )
    head = schema_of(source, [c for c in source.columns if c != "__llm_text"])
    features = shelf.put(  # hashes, which hardly shrink
        source.mapInArrow(_features(settings), f"{head}, __llm_n long, __llm_node long, __llm_bits binary, __llm_set binary"), "features", "snappy"
    )
    roots = node_components(shelf, features, settings)
    first = F.min(F.struct(F.col("__llm_id").isNull().alias("no_id"), "__llm_id", ROW))
    nodes = features.filter(F.col("__llm_node").isNotNull()).groupBy("__llm_node").agg(first.alias("first"))
    nodes = nodes.join(roots, nodes["__llm_node"] == roots["node"], "left").select(
        "__llm_node", "first", F.coalesce("root", "__llm_node").alias("root")
    )
    nodes = shelf.put(nodes, "nodes")
    best = nodes.groupBy("root").agg(F.min("first").alias("best"))
    named = nodes.join(best, "root").select("__llm_node", "best")
    return features.drop("__llm_set", "__llm_bits").join(named, "__llm_node", "left").select(
        *(F.col(f"`{c}`") for c in keep),
        F.col("__llm_n").alias("n_shingles"),
        F.when(F.col("best").isNull(), F.col("__llm_id")).otherwise(F.col("best")["__llm_id"]).alias("component_id"),
        (F.col("best").isNull() | (F.col("best")[ROW] == F.col(ROW))).alias("kept"),
    )


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` that ``join`` keeps, with all their columns.

    Rows are written with their numbers first. Those that may be among the dropped ones go
    through a join; all others pass without a shuffle of their texts. Of what is stored, only
    the rows and the numbers of the dropped ones are left then.
    """
    shelf = Shelf(docs.sparkSession, "jaccard")
    rows = shelf.put(numbered(docs, ROW), "documents")
    dropped = shelf.put(_join(shelf, rows, [ROW], doc_id, text, settings).filter(~F.col("kept")).select(ROW), "dropped")
    shelf.clear(rows, dropped)
    bits = bit_set(dropped)
    doubtful = maybe_in(rows, ROW, bits).join(dropped, ROW, "left_anti")
    sure = maybe_in(rows, ROW, bits, inside=False)
    return sure.unionByName(doubtful).drop(ROW)
