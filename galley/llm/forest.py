"""Approximate nearest neighbours by a forest of sorted hash strings.

Every tree hashes a vector to a string of signs against random directions and keeps its
rows sorted by it. A query finds the place of its longest matching prefix in every tree and
ascends in all trees at once, one character after another, until the prefixes' ranges hold
enough rows; these candidates are scored exactly. Rows are indexed in blocks of bounded
size, each a forest of its own, all queries visit every block, and the best of all blocks
are merged. No sample is involved: every row is indexed.

``share`` is the number of entries (of all trees together) to look at, in units of a
block's rows. Vectors without structure need a large one for a recall of 0.9; clustered
ones would do with much less.

Defined cases: unusable vectors (null, zero, with null or non-finite parts) take no part;
only vectors of equal length meet; a query never finds its own row, but others with an
equal id or vector; ties go to the smaller id, null ids last; fewer than k candidates are
all returned.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from galley.llm.common import numbered, stored
from galley.llm.vectors import matrix, prepared

ROW = "__llm_row"


@dataclass(frozen=True)
class Settings:
    trees: int = 48
    length: int = 32
    share: float = 1.5
    block_rows: int = 16_384
    seed: int = 11


def hash_strings(vectors: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Sign strings as unsigned numbers, first character highest."""
    signs = vectors @ directions > 0
    weights = np.uint64(1) << np.arange(directions.shape[1] - 1, -1, -1, dtype=np.uint64)
    return (signs * weights).sum(axis=1, dtype=np.uint64)


class Forest:
    """Sorted hash strings of some rows, per tree."""

    def __init__(self, vectors: np.ndarray, settings: Settings):
        self.settings, rng = settings, np.random.default_rng(settings.seed)
        self.directions = [rng.standard_normal((vectors.shape[1], settings.length)) for _ in range(settings.trees)]
        self.orders, self.strings = [], []
        for directions in self.directions:
            keys = hash_strings(vectors, directions)
            order = np.argsort(keys, kind="stable")
            self.orders.append(order)
            self.strings.append(keys[order])

    def _ranges(self, keys: list[np.ndarray], level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last place of the rows that share ``level`` characters, per tree and query."""
        shift = (self.settings.length - level).astype(np.uint64)
        low, high = [], []
        for strings, key in zip(self.strings, keys, strict=True):
            first = key >> shift << shift
            last = first | ((np.uint64(1) << shift) - np.uint64(1))
            low.append(np.searchsorted(strings, first, "left"))
            high.append(np.searchsorted(strings, last, "right"))
        return np.array(low), np.array(high)

    def candidates(self, queries: np.ndarray, enough: float):
        """For each query the rows its synchronous ascent has met when there are enough."""
        keys = [hash_strings(queries, d) for d in self.directions]
        # the ascent stops at the longest prefix with enough rows; fewer characters, more rows
        deep = np.full(len(queries), self.settings.length)
        shallow = np.zeros(len(queries), np.int64)
        while (shallow < deep).any():
            middle = (shallow + deep + 1) // 2
            low, high = self._ranges(keys, middle)
            holds = (high - low).sum(axis=0) >= enough
            shallow, deep = np.where(holds, middle, shallow), np.where(holds, deep, middle - 1)
        low, high = self._ranges(keys, shallow)
        # the last step is taken tree by tree; the others stay one character deeper
        deeper_low, deeper_high = self._ranges(keys, np.minimum(shallow + 1, self.settings.length))
        gain = np.cumsum((high - low) - (deeper_high - deeper_low), axis=0) + (deeper_high - deeper_low).sum(axis=0)
        wide = np.concatenate((np.ones((1, len(queries)), bool), gain[:-1] < enough))
        low, high = np.where(wide, low, deeper_low), np.where(wide, high, deeper_high)
        met = np.zeros(len(self.orders[0]), bool)
        for k in range(len(queries)):
            met[:] = False
            for order, a, b in zip(self.orders, low[:, k], high[:, k], strict=True):
                met[order[a:b]] = True
            yield np.flatnonzero(met)


def _best(vectors: np.ndarray, ids: np.ndarray, query: np.ndarray, found: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of the found rows and their inner products."""
    rough = vectors[found] @ query
    if len(found) > k:
        bar = np.partition(rough, len(rough) - k)[len(rough) - k]
        found = found[rough >= bar - 1e-9 * max(1.0, abs(bar))]
    # extended precision, so that equal vectors have equal scores
    scores = (vectors[found].astype(np.longdouble) * query).sum(axis=1).astype(np.float64)
    order = np.lexsort((ids[found], -scores))[:k]
    return found[order], scores[order]


def _searched(k: int, settings: Settings):
    def search(group: pa.Table) -> pa.Table:
        dims = group.column("dims")[0].as_py()
        asks = group.column("asks").to_numpy()
        rows, ids = group.column(ROW).to_numpy(), group.column("id").to_pylist()
        vectors = matrix(group.column("vector"), dims)
        index, queries = np.flatnonzero(~asks), np.flatnonzero(asks)
        own, own_rows = vectors[index], rows[index]
        order = np.array([np.iinfo(np.int64).max if ids[i] is None else ids[i] for i in index], np.int64)
        out: dict[str, list] = {"ask": [], "query_id": [], "vec_id": [], "score": [], ROW: []}
        if len(index):
            forest = Forest(own, settings)
            # a row gives at most an entry per tree, so these are over k rows, or all
            enough = max(settings.share * len(index), (k + 1) * settings.trees)
            for at in range(0, len(queries), 512):
                part = queries[at : at + 512]
                for q, found in zip(part, forest.candidates(vectors[part], enough), strict=True):
                    found = found[own_rows[found] != rows[q]]
                    best, scores = _best(own, order, vectors[q], found, k)
                    out["ask"] += [rows[q]] * len(best)
                    out["query_id"] += [ids[q]] * len(best)
                    out["vec_id"] += [ids[i] for i in index[best]]
                    out["score"] += scores.tolist()
                    out[ROW] += own_rows[best].tolist()
        return pa.table(
            out,
            schema=pa.schema(
                [("ask", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()), (ROW, pa.int64())]
            ),
        )

    return search


def nearest(
    rows: DataFrame,
    asks: Callable[[Column], Column],
    k: int = 20,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    settings: Settings = Settings(),
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest of every row whose id ``asks`` selects."""
    source = numbered(rows.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{vector}`").alias("vector")), ROW)
    ready = stored(prepared(source, ["id", ROW], "vector").filter(F.col("vector").isNotNull()), "forest-vectors")
    sizes = {r["dims"]: r["n"] for r in ready.groupBy("dims").agg(F.count("*").alias("n")).collect()}
    schema = f"ask long, query_id long, vec_id long, score double, {ROW} long"
    found = rows.sparkSession.createDataFrame([], schema)
    for dims, n in sorted(sizes.items()):  # lengths of vectors, in practice one
        mine, blocks = ready.filter(F.col("dims") == dims), -(-n // settings.block_rows)
        index = mine.withColumn("block", F.pmod(F.xxhash64(ROW), F.lit(blocks)).cast("int")).withColumn("asks", F.lit(False))
        queries = mine.filter(asks(F.col("id"))).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        both = index.unionByName(queries.withColumn("asks", F.lit(True)))
        found = found.unionByName(both.groupBy("block").applyInArrow(_searched(k, settings), schema))
    order = Window.partitionBy("ask").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), ROW)
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
