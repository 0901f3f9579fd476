"""Files that hold one JSON array each, split at the borders of their records.

A file is read as text whose lines end at ``}``, which Spark splits into blocks like any
text. Whether a ``}`` ends a record depends on everything before it: on the brackets that
are open, and on whether it stands inside a string. So

1. every block is scanned for both cases, that it begins outside and inside of a string:
   where it ends then, and by how much brackets are deeper (an escape never crosses a
   ``}``, so it is settled within a line);
2. the blocks of a file are joined in order, which gives each the state it really begins
   with: one narrow row per block of the input;
3. every block is scanned again from its state and gives out its records; what lies before
   its first and after its last border is put together with its neighbours' ends.

Records that are not parted by one comma, values that are no objects and whatever is left at
the end of a file come out as text too, so that the parser finds them malformed. A file of
single objects, one after another, is taken as well. Text is UTF-8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from galley.operators.durable import pin

#: Parts of a block: up to its first border, whole records, from its last border on, or all of it.
HEAD, WHOLE, TAIL, MIDDLE = range(4)
_STATE = (
    "file string, block bigint, quotes boolean, outside bigint, inside bigint, opens string, "
    "lines bigint, bytes bigint, size bigint"
)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.option("lineSep", "}").option("recursiveFileLookup", True).text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"),
        "value",
    )


class _Lines:
    """Lines of a batch with their ``}``: whether quotes change sides, and how brackets change the depth on either side."""

    def __init__(self, values: pa.Array):
        closed = pc.binary_join_element_wise(
            values.cast(pa.large_string()), *(pa.scalar(x, pa.large_string()) for x in ("}", ""))
        ).cast(pa.large_binary())
        self.bounds = np.frombuffer(closed.buffers()[1], np.int64)[closed.offset : closed.offset + len(closed) + 1]
        self.raw = np.frombuffer(closed.buffers()[2], np.uint8)
        first, last = self.bounds[0], self.bounds[-1]
        part, bounds = self.raw[first:last], self.bounds - first
        quote = np.flatnonzero(part == ord('"'))
        back = np.flatnonzero(part != ord("\\"))  # the nearest of these before a quote tells its backslashes
        before = np.searchsorted(back, quote) - 1
        run = quote - 1 - np.where(before >= 0, back[before], -1)
        quote = quote[run % 2 == 0]
        at = np.flatnonzero(np.isin(part, np.frombuffer(b"{}[]", np.uint8)))
        line = np.searchsorted(bounds, at, "right") - 1
        passed = np.searchsorted(quote, at) - np.searchsorted(quote, bounds[line])
        change = np.where(np.isin(part[at], np.frombuffer(b"{[", np.uint8)), 1, -1)
        n = len(values)
        self.depths = [np.bincount(line[passed % 2 == side], change[passed % 2 == side], n).astype(np.int64) for side in (0, 1)]
        self.quotes = np.diff(np.searchsorted(quote, bounds)) % 2 == 1

    def text(self, first: int, last: int) -> bytes:
        return self.raw[self.bounds[first] : self.bounds[last]].tobytes()


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[str, int, int, int]]:
    """File, block and rows of each block of a batch, in order."""
    files, starts = batch.column("file"), batch.column("block").to_numpy()
    coded = files.dictionary_encode()
    names = coded.indices.to_numpy()
    cuts = np.flatnonzero((np.diff(names) != 0) | (np.diff(starts) != 0)) + 1
    edges = [0, *cuts.tolist(), batch.num_rows]
    for first, last in zip(edges, edges[1:], strict=False):
        if last > first:
            yield files[first].as_py(), int(starts[first]), first, last


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block: what it does to a state it may begin with."""
    found: dict[tuple[str, int], dict] = {}
    for batch in batches:
        lines = _Lines(batch.column("value"))
        for file, block, first, last in _blocks(batch):
            row = found.setdefault(
                (file, block),
                {"file": file, "block": block, "quotes": False, "outside": 0, "inside": 0, "opens": "", "lines": 0, "bytes": 0},
            )
            row["size"] = batch.column("size")[first].as_py()
            quotes = lines.quotes[first:last]
            side = (np.cumsum(quotes) - quotes) % 2  # of each line, if this part begins outside
            one, other = lines.depths[0][first:last], lines.depths[1][first:last]
            deeper = int(np.where(side, other, one).sum()), int(np.where(side, one, other).sum())
            row["outside"] += deeper[row["quotes"]]
            row["inside"] += deeper[not row["quotes"]]
            row["quotes"] ^= bool(quotes.sum() % 2)
            row["lines"] += last - first
            row["bytes"] += int(lines.bounds[last] - lines.bounds[first]) - (last - first)
            if not row["opens"]:
                row["opens"] = lines.text(first, last).removeprefix(b"\xef\xbb\xbf").lstrip()[:1].decode("latin-1")
    if found:
        yield pa.RecordBatch.from_pylist(
            list(found.values()),
            pa.schema([(n, {"string": pa.string(), "boolean": pa.bool_()}.get(k, pa.int64())) for n, k in (c.split() for c in _STATE.split(", "))]),
        )


def block_states(spark: SparkSession, path: str) -> DataFrame:
    """What each block of the files begins with: inside of a string or not, depth, and depth of its file's records.

    ``open`` says that the last line of the block has no ``}``, as it ends the file.
    """
    blocks = pin(_lines(spark, path).mapInArrow(_scanned, _STATE))
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sided = blocks.withColumn("in_string", F.coalesce(F.sum(F.col("quotes").cast("int")).over(before), F.lit(0)) % 2 == 1)
    deeper = F.when(F.col("in_string"), F.col("inside")).otherwise(F.col("outside"))
    # with a } at the end, lines and their ends are all bytes of a file; a byte order mark may be missing
    missing = F.sum(F.col("bytes") + F.col("lines")).over(whole) - F.col("size")
    base = F.first(F.nullif("opens", F.lit("")), ignorenulls=True).over(whole) == "["
    last = F.lead("block").over(order).isNull()
    return pin(
        sided.select(
            "file",
            "block",
            "in_string",
            F.coalesce(F.sum(deeper).over(before), F.lit(0)).alias("depth"),
            F.when(base, 1).otherwise(0).alias("base"),
            (last & (base | missing.isin(1, -2))).alias("open"),
        )
    )


_PART = "file string, block bigint, kind int, base int, text string"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records and ends of blocks, of which the state at the beginning is known."""
    at = None  # file, block, side, depth of the line to come
    rest, bordered, base, is_open = b"", False, 0, False
    waiting = False  # the rest is a record if the line it ends with is not the last of an open block

    def finish(out: list) -> None:
        if at is not None:
            text = rest[:-1] if is_open else rest
            out.append((at[0], at[1], TAIL if bordered else MIDDLE, base, text.decode("utf-8", "replace")))

    for batch in batches:
        lines, out = _Lines(batch.column("value")), []
        for file, block, first, last in _blocks(batch):
            if at is None or at[:2] != (file, block):
                finish(out)
                side, depth = batch.column("in_string")[first].as_py(), batch.column("depth")[first].as_py()
                if depth is None:
                    raise ValueError(f"{file} has been cut otherwise at {block}")
                base, is_open = batch.column("base")[first].as_py(), batch.column("open")[first].as_py()
                at, rest, bordered, waiting = (file, block, side, depth), b"", False, False
            if waiting:
                out.append((file, block, WHOLE if bordered else HEAD, base, rest.decode("utf-8", "replace")))
                rest, bordered, waiting = b"", True, False
            quotes = lines.quotes[first:last]
            sides = (np.cumsum(quotes) + at[2]) % 2  # after each line
            begun = sides ^ quotes
            deep = at[3] + np.cumsum(np.where(begun, lines.depths[1][first:last], lines.depths[0][first:last]))
            from_line = first
            for k in (np.flatnonzero((sides == 0) & (deep == base)) + first + 1).tolist():
                if is_open and k == last:
                    waiting = True
                    break
                text = rest + lines.text(from_line, k)
                out.append((file, block, WHOLE if bordered else HEAD, base, text.decode("utf-8", "replace")))
                rest, bordered, from_line = b"", True, k
            rest += lines.text(from_line, last)
            at = (file, block, int(sides[-1]), int(deep[-1]))
        yield _parts(out)
    out = []
    finish(out)
    yield _parts(out)


def _parts(rows: list) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.string()]
    columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(columns, names=["file", "block", "kind", "base", "text"])


def array_records(spark: SparkSession, path: str) -> DataFrame:
    """``value``: the text of every record of the files below a path, in no order.

    Scans the files once when called and once when its rows are asked for. What is sent to
    all tasks is a row of some 100 bytes per block of 128 MB.
    """
    states = block_states(spark, path)
    parts = pin(_lines(spark, path).drop("size").join(F.broadcast(states), ["file", "block"], "left").mapInArrow(_cut, _PART))
    whole = parts.where(F.col("kind") == WHOLE).select("base", F.lit(False).alias("first"), F.lit(True).alias("ended"), "text")
    # a block's head ends what the tails and blocks before it have begun
    order = Window.partitionBy("file").orderBy("block", "kind")
    ends = parts.where(F.col("kind") != WHOLE).withColumn(
        "nth", F.coalesce(F.sum((F.col("kind") == HEAD).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    piece = F.struct("block", "kind", "text")
    joined = ends.groupBy("file", "nth", "base").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(piece)), lambda p: p["text"]), "").alias("text"),
        F.bool_or(F.col("kind") == HEAD).alias("ended"),
    )
    every = whole.unionByName(joined.select("base", (F.col("nth") == 0).alias("first"), "ended", "text"))
    array = F.col("base") == 1
    parted = F.when(F.col("text").rlike(r"^\s*,"), F.regexp_replace("text", r"^\s*,\s*", ""))
    parted = parted.otherwise(F.concat(F.lit("no comma: "), "text"))
    opening = F.when(F.col("first"), F.regexp_replace("text", r"^\s*\[\s*", "")).otherwise(parted)
    left = F.when(F.col("first"), F.col("text").rlike(r"^\s*\[\s*\]\s*$")).otherwise(F.col("text").rlike(r"^\s*\]\s*$"))
    value = F.when(F.col("ended"), F.when(array, opening).otherwise(F.ltrim("text"))).when(~array, F.trim("text")).when(~left, F.col("text"))
    return every.select(value.alias("value")).where(F.col("value").rlike(r"\S"))

# tasks run these functions without the package
cloudpickle.register_pickle_by_value(__import__("sys").modules[__name__])
