"""Near-duplicate vectors: every pair with a cosine at or above a threshold.

Unit vectors are turned so that leading dimensions hold most of their variation. Vectors
whose first two turned components differ by more than the threshold allows cannot link, so
they are kept in cells and only meet their own and neighbouring cells, in tiles of two
chunks of bounded size. A tile adds up products dimension block by dimension block; what is
left of a product is at most the product of the two suffix norms, and a pair is given up as
soon as it cannot reach the threshold. What remains is decided on the original vectors.

A chunk lies in the shared folder once and is opened by the tasks whose tiles it is in, so
what is stored and shuffled grows with the vectors, and not with the tiles, whose number
grows with their square.

Equal vectors are one node with a count. A tile returns link counts and links that span
its components, never its pairs.

Defined cases: unusable vectors (null, zero, with null or non-finite parts) link with
nothing and are their own component; only vectors of equal length meet; null ids take part,
a component's id is its smallest non-null one; rows with equal ids stay rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galley.llm.common import Shelf, discard, mixed, numbered, shared_path, small_batches
from galley.llm.graph import components
from galley.llm.vectors import packed, prepared, unpacked
from galley.sources.file_systems import opened, settings_of

ROW = "__llm_row"
#: Rounding of sums that decide what is worth an exact look.
SLACK = 1e-9
#: Tiles of a task, and the most tasks they are dealt to.
TASK_TILES, MOST_TASKS = 8, 4096
#: Tiles of one chunk that are compared before its counts are given back.
RUN_TILES = 64


@dataclass(frozen=True)
class Settings:
    cosine: float = 0.95
    tile_rows: int = 4096
    step: int = 16


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        if batch.num_rows:
            vectors = unpacked(batch.column("vector"), batch.column("dims")[0].as_py())
            unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
            total = unit.T @ unit + (0 if total is None else total)
    if total is not None:
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())], names=["i", "j", "x"])


def principal(nodes: DataFrame, dims: int) -> np.ndarray:
    """Directions in order of the variation they hold; the driver gets dims x dims sums."""
    rows = nodes.mapInArrow(_moments, "i long, j long, x double").groupBy("i", "j").agg(F.sum("x").alias("x")).collect()
    total = np.zeros((dims, dims))
    for r in rows:
        total[r["i"], r["j"]] = r["x"]
    return np.linalg.eigh(total)[1][:, ::-1]


def _units(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _placed(directions: np.ndarray, width: float):
    """The cell of each node, by its two leading components."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lead = np.floor(_units(unpacked(batch.column("vector"), len(directions))) @ directions[:, :2] / width).astype(np.int32)
            y = lead[:, 1] if lead.shape[1] > 1 else np.zeros(len(lead), np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.select(["node", "copies", "vector"]).columns, pa.array(lead[:, 0]), pa.array(y)],
                names=["node", "copies", "vector", "x", "y"],
            )

    return place


@dataclass(frozen=True)
class Chunks:
    """The parts of all cells, numbered through: a cell's are ``first[cell]`` and those after it."""

    sizes: dict[tuple[int, int], int]
    first: dict[tuple[int, int], int]
    cells: list[tuple[int, int]]

    def partners(self, chunk: int) -> list[int]:
        """The chunks that this one is compared with. Of two chunks one has the other, in turn, so all have as many."""
        x, y = self.cells[chunk]
        near = [(x + dx, y + dy) for dx in (-1, 0, 1) for dy in (-1, 0, 1)]
        others = [self.first[c] + k for c in near for k in range(self.sizes.get(c, 0))]
        return [o for o in sorted(others) if o == chunk or (o < chunk) == bool((o + chunk) % 2)]


def chunks_of(cells: dict[tuple[int, int], int], rows: int) -> Chunks:
    sizes = {cell: -(-n // rows) for cell, n in sorted(cells.items())}
    numbered_cells = [cell for cell, n in sizes.items() for _ in range(n)]
    return Chunks(sizes, {cell: numbered_cells.index(cell) for cell in sizes}, numbered_cells)


def _dealt(chunks: Chunks):
    """The chunk of each node of a cell."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [*zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True)]
            first, sizes = (np.array([part[c] for c in cells], np.int64) for part in (chunks.first, chunks.sizes))
            part = mixed(batch.column("node").to_numpy()).view(np.int64) & np.int64(2**62 - 1)
            mine = first + part % np.maximum(sizes, 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.select(["node", "copies", "vector"]).columns, pa.array(mine)], names=["node", "copies", "vector", "chunk"]
            )

    return deal


@dataclass
class Chunk:
    nodes: np.ndarray
    copies: np.ndarray
    exact: np.ndarray
    norms: np.ndarray
    turned: np.ndarray


def _opened_chunk(folder: str, settings: dict[str, str], chunk: int, directions: np.ndarray) -> Chunk:
    from pyarrow import fs

    system, root = opened(folder, settings)
    found = system.get_file_info(fs.FileSelector(f"{root}/chunk={chunk}"))  # a chunk that is missing is an error
    tables = []
    for info in sorted(found, key=lambda i: i.path):
        if info.path.endswith(".parquet"):
            with system.open_input_file(info.path) as file:
                tables.append(pq.read_table(file, columns=["node", "copies", "vector"]))
    table = pa.concat_tables(tables)
    exact = unpacked(table.column("vector"), len(directions))
    turned = _units(exact) @ directions
    return Chunk(table.column("node").to_numpy(), table.column("copies").to_numpy(), exact, np.linalg.norm(exact, axis=1), turned)


def _leading(turned: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Norms of what follows each dimension, and the leading ones with the norm of the rest.

    The products of the latter are the most that products of the whole can come to.
    """
    suffix = np.sqrt(np.maximum((turned[:, ::-1] ** 2).cumsum(axis=1)[:, ::-1], 0))
    done = min(step, turned.shape[1])
    rest = suffix[:, done : done + 1] if done < turned.shape[1] else np.zeros((len(turned), 1))
    return suffix, np.ascontiguousarray(np.hstack((turned[:, :done], rest)), np.float32)


def reaching(a: np.ndarray, b: np.ndarray, cosine: float, step: int, leading=None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of turned unit vectors that may reach the cosine, by leading dimensions first."""
    dims = a.shape[1]
    (suffix_a, lead_a), (suffix_b, lead_b) = leading or (_leading(a, step), _leading(b, step))
    done = min(step, dims)
    # single precision: a sum of products of unit vectors is off by less than its length in units of rounding
    slack = (lead_a.shape[1] + 8) * 2.0**-23
    i, j = np.divmod(np.flatnonzero(lead_a @ lead_b.T >= np.float32(cosine - SLACK - slack)), max(len(b), 1))
    part = np.einsum("ij,ij->i", a[i, :done], b[j, :done])
    while len(i):
        left = suffix_a[i, done] * suffix_b[j, done] if done < dims else 0.0
        ok = part + left >= cosine - SLACK
        i, j, part = i[ok], j[ok], part[ok]
        if done == dims:
            break
        more = min(done + step, dims)
        part = part + np.einsum("ij,ij->i", a[i, done:more], b[j, done:more])
        done = more
    return i, j


def _spanning(i: np.ndarray, j: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Fewer than n links of n rows that connect what the given ones do."""
    labels = np.arange(n)
    while True:
        low = np.minimum(labels[i], labels[j])
        new = labels.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == labels).all():
            break
        labels = new
    moved = np.flatnonzero(labels != np.arange(n))
    return moved, labels[moved]


def _linked(a: Chunk, b: Chunk, settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a tile: links of the rows of ``a``, those of ``b``, and links that span its components."""
    counts_a, counts_b = np.zeros(len(a.nodes), np.int64), np.zeros(len(b.nodes), np.int64)
    parts = [[(c.turned[p : p + 1024], _leading(c.turned[p : p + 1024], settings.step)) for p in range(0, len(c.nodes), 1024)] for c in (a, b)]
    spans = []
    for p, (one, first) in enumerate(parts[0]):
        for q, (two, second) in enumerate(parts[1]):
            if a is b and q < p:
                continue
            i, j = reaching(one, two, settings.cosine, settings.step, (first, second))
            if a is b and p == q:
                i, j = i[i < j], j[i < j]
            if not len(i):
                continue
            i, j = i + p * 1024, j + q * 1024
            ok = np.concatenate(
                [
                    np.einsum("ij,ij->i", a.exact[i[s : s + 65536]], b.exact[j[s : s + 65536]])
                    >= settings.cosine * a.norms[i[s : s + 65536]] * b.norms[j[s : s + 65536]]
                    for s in range(0, len(i), 65536)
                ]
            )
            i, j = i[ok], j[ok]
            if len(i):
                np.add.at(counts_a, i, b.copies[j])
                np.add.at(counts_b, j, a.copies[i])
                spans.append(_spanning(i, j if a is b else j + len(a.nodes), len(a.nodes) + len(b.nodes)))
    if not spans:
        return counts_a, counts_b, np.zeros(0, np.int64), np.zeros(0, np.int64)
    moved, low = _spanning(np.concatenate([s[0] for s in spans]), np.concatenate([s[1] for s in spans]), len(a.nodes) + len(b.nodes))
    nodes = np.concatenate((a.nodes, b.nodes))
    return counts_a, counts_b, nodes[moved], nodes[low]


def _compared(settings: Settings, directions: np.ndarray, chunks: Chunks, folder: str, opening: dict[str, str], runs: int):
    """Links of the runs of tiles that are asked for: row k is run k % runs of chunk k // runs."""

    def batch_of(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, n)], names=["a", "b", "n"])

    def counted(chunk: Chunk, counts: np.ndarray) -> pa.RecordBatch:
        there = np.flatnonzero(counts)
        return batch_of(chunk.nodes[there], chunk.nodes[there], counts[there])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, chunk = None, None
        for batch in batches:
            for k in batch.column("id").to_pylist():
                mine = chunks.partners(k // runs)[(k % runs) * RUN_TILES :][:RUN_TILES]
                if not mine:
                    continue
                if number != k // runs:
                    number = k // runs
                    chunk = _opened_chunk(folder, opening, number, directions)
                counts = np.zeros(len(chunk.nodes), np.int64)
                for other in mine:
                    met = chunk if other == number else _opened_chunk(folder, opening, other, directions)
                    counts_a, counts_b, a, b = _linked(chunk, met, settings)
                    counts += counts_a
                    if met is chunk:
                        counts += counts_b
                    elif counts_b.any():
                        yield counted(met, counts_b)
                    if len(a):
                        yield batch_of(a, b, np.zeros(len(a), np.int64))
                if counts.any():
                    yield counted(chunk, counts)

    return compare


def _tiles(spark: SparkSession, chunks: Chunks) -> tuple[DataFrame, int]:
    """A row for each run of tiles, and the runs of a chunk."""
    tiles = [len(chunks.partners(k)) for k in range(len(chunks.cells))]
    runs = -(-max(tiles) // RUN_TILES)
    tasks = min(MOST_TASKS, len(tiles) * runs, max(1, sum(tiles) // TASK_TILES))
    return spark.range(0, len(tiles) * runs, 1, tasks), runs


def link(rows: DataFrame, keep: list[str], vec_id: str = "vec_id", vector: str = "embedding", settings: Settings = Settings()) -> DataFrame:
    """The columns ``keep`` of every row with n_links, component_id and kept."""
    spark = rows.sparkSession
    shelf = Shelf(spark, "neardup")
    source = numbered(rows, ROW).select(
        *keep, ROW, F.col(f"`{vec_id}`").cast("long").alias("__llm_id"), F.col(f"`{vector}`").alias("__llm_in")
    )
    given = prepared(source, [*keep, ROW, "__llm_id"], "__llm_in", packed)
    given = shelf.put(given.withColumn("__llm_key", F.unhex(F.sha2("vector", 256))), "vectors")
    first = F.min(F.struct(F.col("__llm_id").isNull().alias("no_id"), "__llm_id", ROW))
    nodes = shelf.put(
        given.filter(F.col("vector").isNotNull())
        .groupBy("__llm_key", "dims")
        .agg(F.min(ROW).alias("node"), F.count("*").alias("copies"), F.first("vector").alias("vector"), first.alias("first")),
        "nodes",
    )
    ready = shelf.put(given.drop("vector"), "rows")
    shelf.drop(given)
    names = shelf.put(nodes.drop("vector"), "names")
    width = math.sqrt(2 - 2 * settings.cosine) + 1e-6
    found = [spark.createDataFrame([], "a long, b long, n long")]
    for r in sorted(nodes.groupBy("dims").agg(F.count("*").alias("n")).collect(), key=lambda r: r["dims"]):
        mine = nodes.filter(F.col("dims") == r["dims"])
        directions = principal(mine, r["dims"])
        placed = shelf.put(mine.mapInArrow(_placed(directions, width), "node long, copies long, vector binary, x int, y int"), "cells")
        # unit vectors: at most (2 / width + 2)^2 cells, whatever the input
        cells = {(c["x"], c["y"]): c["n"] for c in placed.groupBy("x", "y").agg(F.count("*").alias("n")).collect()}
        chunks = chunks_of(cells, settings.tile_rows)
        folder = shared_path(spark, "neardup-chunks")
        dealt = placed.mapInArrow(_dealt(chunks), "node long, copies long, vector binary, chunk long")
        with small_batches(spark):
            dealt.repartition("chunk").write.option("compression", "zstd").partitionBy("chunk").parquet(folder)
        shelf.drop(placed)
        tiles, runs = _tiles(spark, chunks)
        compare = _compared(settings, directions, chunks, folder, settings_of(spark), runs)
        found.append(shelf.put(tiles.mapInArrow(compare, "a long, b long, n long"), "links"))
        discard(spark, folder)
    shelf.drop(nodes)
    links = reduce(DataFrame.unionByName, found)
    counts = links.filter("a = b").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    roots = components(links.filter("a <> b").select("a", "b"))
    named = shelf.put(
        names.join(counts, "node", "left")
        .join(roots, "node", "left")
        .select("__llm_key", "dims", "first", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node").alias("root")),
        "named",
    )
    shelf.clear(ready, named)
    best = named.groupBy("root").agg(F.min("first").alias("best"))
    answers = named.join(best, "root").select("__llm_key", "dims", "n_links", "best")
    component = F.when(F.col("best").isNull(), F.col("__llm_id")).otherwise(F.col("best")["__llm_id"])
    return ready.join(answers, ["__llm_key", "dims"], "left").select(
        *(F.col(f"`{c}`") for c in keep),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("__llm_id") == component, F.lit(True)).alias("kept"),
    )
