"""Connected components of links that need not fit one machine, and fixed-size bit sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galley.llm.common import mixed, stored

#: Bits of the sets that are sent to tasks: 1 MB, whatever the input.
BITS = 23


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.xxhash64("a", "b") % 1_000_003), F.lit(0)).alias("s")).first()
    return row["n"], row["s"]


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` (its component's smallest node) for every node with a link.

    Alternating stars: every node links its larger neighbours to the smallest one it
    knows, then its smaller ones. Smallest neighbours are aggregates, so a hub with any
    number of links is never gathered.
    """
    links = stored(
        edges.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    state = _state(links)
    while state[0]:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.filter(F.col("b") > F.col("a")).join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # a node that is the largest around keeps its link to the smallest
        top = low.filter(F.col("m") < F.col("a")).select("a", F.col("m").alias("b"))
        large = large.unionByName(top).filter("a <> b")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        links = stored(
            small.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(small.select("a", F.col("m").alias("b")))
            .filter("a <> b")
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            .distinct(),
            "links",
        )
        before, state = state, _state(links)
        if state == before:
            break
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def places_of(values: np.ndarray) -> np.ndarray:
    return (mixed(values) >> np.uint64(64 - BITS)).astype(np.int64)


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits = np.zeros(1 << BITS, bool)
    for batch in batches:
        bits[places_of(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))] = True
    words = np.packbits(bits, bitorder="little").view(np.int64)
    there = np.flatnonzero(words)
    if len(there):
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(words[there])], names=["word", "bits"])


def bit_set(values: DataFrame) -> np.ndarray:
    """A set of fixed size that has all values of the one long column, and few others."""
    rows = (
        values.mapInArrow(_words, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).collect()
    )
    words = np.zeros(1 << (BITS - 6), np.int64)
    if rows:
        words[[r["word"] for r in rows]] = [r["bits"] for r in rows]
    return words


def in_set(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = places_of(values.view(np.uint64))
    return (bits.view(np.uint64)[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0


def maybe_in(df: DataFrame, column: str, bits: np.ndarray, inside: bool = True) -> DataFrame:
    """Rows whose ``column`` may be in the set, or those for which it surely is not."""

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = in_set(bits, batch.column(column).to_numpy(zero_copy_only=False))
            yield batch.filter(pa.array(found == inside))

    return df.mapInArrow(chosen, df.schema)
