"""Helpers the operators of this subpackage share: stored intermediates and Arrow texts."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galley.operators.durable import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, kind: str) -> str:
    """A new path below the folder that all executors share."""
    return f"{shared_folder(spark)}/llm/{spark.sparkContext.applicationId}/{kind}-{uuid.uuid4().hex}"


#: Rows that go to Python at once while something is stored. Texts and sets are a few kB
#: each, and JVM and worker both hold a batch.
BATCH_ROWS = "2000"


@contextmanager
def small_batches(spark: SparkSession):
    """Smaller Arrow batches for the jobs run inside."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, BATCH_ROWS)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stored(df: DataFrame, kind: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later stages, retries and lost executors then see the same rows, whatever numbers or
    partitions they were given when they were made.
    """
    path = shared_path(df.sparkSession, kind)
    with small_batches(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder of intermediates."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


class Shelf:
    """Stored intermediates, removed once nothing reads them any more."""

    def __init__(self, spark: SparkSession, kind: str):
        self.spark, self.kind, self.paths = spark, kind, {}

    def put(self, df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
        path = shared_path(self.spark, f"{self.kind}-{name}")
        with small_batches(self.spark):
            df.write.option("compression", compression).parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(back)] = (back, path)
        return back

    def drop(self, *frames: DataFrame) -> None:
        for frame in frames:
            _, path = self.paths.pop(id(frame))
            discard(self.spark, path)
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()  # shuffle files go with the plans that wrote them

    def clear(self, *but: DataFrame) -> None:
        """Drop all that is left, but for some."""
        self.drop(*(frame for frame, _ in list(self.paths.values()) if all(frame is not b for b in but)))


def numbered(df: DataFrame, row_id: str) -> DataFrame:
    """Give rows a number that is theirs alone, also where ids are null or repeated."""
    return df.withColumn(row_id, F.monotonically_increasing_id())


def as_text(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """Texts as one array with 64-bit offsets, null as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    # a copy whose offsets begin at 0: ascii_lower misreads others
    return pa.concat_arrays([pc.fill_null(column.cast(pa.large_string()), "")])


def white_space_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Split at ASCII white space; offsets of each text into the flat words, none empty."""
    parts = pc.ascii_split_whitespace(texts)
    words = parts.values
    full = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    before = np.concatenate(([0], np.cumsum(full)))
    return before[parts.offsets.to_numpy()], words.filter(pa.array(full))


def distinct_words(words: pa.Array) -> tuple[np.ndarray, list[str]]:
    """Number of each word in the list of distinct words."""
    if not len(words):
        return np.zeros(0, np.int64), []
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_pylist()


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, … of all ranges, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def mixed(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers (the finishing steps of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of batches with about ``limit`` bytes of text each, a row at least.

    What a task holds at a time is then bounded by its longest text.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes.astype(np.int64)) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]
        for start, stop in zip(cuts, cuts[1:], strict=False):
            if stop > start:
                yield batch.slice(start, stop - start)


def schema_of(df: DataFrame, names: Iterable[str]) -> str:
    """DDL of some columns of ``df``."""
    return ", ".join(f"`{n}` {df.schema[n].dataType.simpleString()}" for n in names)


def map_rows(docs: DataFrame, keep: list[str], inputs: list, function, results: dict[str, str]) -> DataFrame:
    """``docs.mapInArrow`` that carries the columns ``keep``, whatever their names.

    ``function`` sees the columns ``inputs`` and, under reserved names, those carried; it
    gives back the latter (`kept_names`) and ``results`` (names and types). Names carried that
    clash with results are refused.
    """
    clashes = [c for c in keep if c.lower() in map(str.lower, results)]
    if clashes:
        raise ValueError(f"names of results: {clashes}")
    source = docs.select(*(F.col(quoted(c)).alias(f"__keep_{k}") for k, c in enumerate(keep)), *inputs)
    carried = [f"__keep_{k} {source.schema[k].dataType.simpleString()}" for k in range(len(keep))]
    head = ", ".join([*carried, *(f"{name} {kind}" for name, kind in results.items())])
    return source.mapInArrow(function, head).toDF(*keep, *results)


def kept_names(batch: pa.RecordBatch) -> list[str]:
    return [c for c in batch.schema.names if c.startswith("__keep_")]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
