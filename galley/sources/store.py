"""Parquet tables of the warehouse: one folder per layer and table, versions below it."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from galley.sources.entry_log import EntryLog

_FAILED_AFTER = 86_400  # seconds after which an unpublished folder is taken for a failed run's


class TableStore:
    """Tables below one root folder on any Hadoop file system.

    A write adds a version, which counts once Spark has committed it (``_SUCCESS``). A
    write that fails leaves the version before it in force, and no version is touched
    while it is read: the one before the newest is kept for readers that have begun.

    Tables replaced within a ``release`` count together, by one entry of a log; from then on
    that entry says which folder a table is. Of a partitioned table it names the folder of
    every partition and the schema, so a release may write some of them and keep the others.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def replace(self, layer: str, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        """Write the next version of a table.

        With partitions, rows are first brought together by them, and Spark sizes the
        tasks, so that no task writes a file to every partition. A table that has been
        released is released by itself.
        """
        if f"{layer}/{name}" in self._released():
            with self.release() as alone:
                return alone.replace(layer, name, df, partition_by)
        if partition_by:
            df = df.hint("rebalance", *partition_by)
        self._add_version(self.path(layer, name), df, partition_by)
        return self.read(layer, name)

    def advance(self, layer: str, name: str, df: DataFrame) -> DataFrame:
        """``replace`` for a table that is derived from its version before."""
        return self.replace(layer, name, df)

    def read(self, layer: str, name: str) -> DataFrame:
        """The newest version; an error if there is none."""
        current = self._current(layer, name)
        if not isinstance(current, dict):
            return self.spark.read.parquet(current or self.path(layer, name))
        schema = T.StructType.fromJson(current["schema"])
        leaves = sorted(current["leaves"].values())
        if not leaves:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", self.path(layer, name))
        return reader.parquet(*leaves).drop("release")

    def partitions(self, layer: str, name: str) -> dict[str, str] | None:
        """Folders of a released table's partitions, by ``column=value``; None if it has none."""
        current = self._current(layer, name)
        return dict(current["leaves"]) if isinstance(current, dict) else None

    def replace_partitions(
        self, layer: str, name: str, df: DataFrame, column: str, values: Iterable[Any]
    ) -> DataFrame:
        """Write ``df`` in place of the partitions of ``values``; the other ones stay.

        The table has been released with partitions. A value without rows in ``df`` has no
        partition afterwards; rows of other values are an error.
        """
        with self.release() as alone:
            return alone.replace_partitions(layer, name, df, column, values)

    def latest(self, layer: str, name: str) -> DataFrame | None:
        """The newest version, or None."""
        return self.read(layer, name) if self.exists(layer, name) else None

    def exists(self, layer: str, name: str) -> bool:
        """Whether a table, or any partition of one, has been written."""
        partitions = "*=*/version=*/_SUCCESS"
        return self._current(layer, name) is not None or bool(self._found(self.path(layer, name), partitions))

    def write_partition(self, layer: str, name: str, df: DataFrame, column: str, value: str) -> None:
        """Write one partition (a run, a date, a batch); writing it again replaces it.

        A rerun without rows leaves none behind.
        """
        self._add_version(self.leaf(layer, name, column, value), df)

    def leaf(self, layer: str, name: str, column: str, value: str) -> str:
        escape = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
        return f"{self.path(layer, name)}/{column}={escape.escapePathName(value)}"

    def write_load(self, entity: str, df: DataFrame, load_date: str) -> str:
        """Typed Parquet of one entity and load date."""
        self.write_partition("typed", entity, df, "load_date", load_date)
        return self._newest(self.leaf("typed", entity, "load_date", load_date))

    def read_all(self, layer: str, name: str, column: str) -> DataFrame:
        """All partitions, unioned by column name; a column absent from one is NULL there.

        ``column`` is the partition column; its values are read as the text they are.
        """
        path = self.path(layer, name)
        leaves = self._leaves(path, column) or [path]
        reader = self.spark.read.option("basePath", path)
        merged = reader.option("mergeSchema", True).parquet(*leaves).schema
        fields = [T.StructField(f.name, T.StringType() if f.name == column else f.dataType) for f in merged]
        return reader.schema(T.StructType(fields)).parquet(*leaves).drop("version")

    def read_loads(self, entity: str) -> DataFrame:
        return self.read_all("typed", entity, "load_date")

    def load_leaves(self, entity: str) -> list[str]:
        """The folders of the newest version of each load of an entity."""
        return self._leaves(self.path("typed", entity), "load_date")

    def _leaves(self, path: str, column: str) -> list[str]:
        newest: dict[str, int] = {}
        for mark in self._found(path, f"{column}=*/version=*/_SUCCESS"):
            leaf, _, version = mark.rsplit("/", 1)[0].rpartition("/version=")
            newest[leaf] = max(newest.get(leaf, 0), int(version))
        return [f"{leaf}/version={n}" for leaf, n in sorted(newest.items())]

    def pinned(self, layer: str, name: str, df: DataFrame) -> DataFrame:
        """Write rows that must not be made twice, and read them back."""
        path = f"{self.path(layer, '_' + name)}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def attempt(self, layer: str, name: str, df: DataFrame) -> str:
        """Write rows aside: they do not count until ``keep_load`` moves them."""
        path = f"{self.path(layer, '_attempts')}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return path

    def keep_load(self, entity: str, attempt: str, load_date: str) -> str:
        """Make an attempt the newest version of an entity's load."""
        folder = self.leaf("typed", entity, "load_date", load_date)
        files, number = self._files(folder), self._next(folder)
        files.mkdirs(self._path(folder))
        files.delete(self._path(f"{folder}/version={number}"), True)
        if not files.rename(self._path(attempt), self._path(f"{folder}/version={number}")):
            raise OSError(f"{attempt} could not be moved below {folder}")
        self._forget(folder, number)
        return f"{folder}/version={number}"

    def discard(self, path: str) -> None:
        self._files(path).delete(self._path(path), True)

    # releases ------------------------------------------------------------------------

    @contextmanager
    def release(self) -> Iterator[Release]:
        """A store whose replaced tables count together when the block ends, or not at all.

        `WriterConflict` if another release has been published in the meantime.
        """
        release = Release(self)
        yield release
        release.publish()

    def snapshot(self) -> Snapshot:
        """A store for readers: its released tables stay those of one release."""
        return Snapshot(self)

    def _log(self) -> EntryLog:
        return EntryLog(self, f"{self.root}/_releases")

    def _released(self) -> dict[str, Any]:
        return self._log().newest()[1].get("tables", {})

    def _current(self, layer: str, name: str) -> str | dict[str, Any] | None:
        return self._released().get(f"{layer}/{name}") or self._newest(self.path(layer, name))

    # versions ------------------------------------------------------------------------

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _files(self, folder: str):
        return self._path(folder).getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _found(self, folder: str, pattern: str) -> list[str]:
        jvm = self.spark._jvm
        glob = jvm.org.apache.hadoop.fs.Path(self._path(folder), pattern)
        return [s.getPath().toString() for s in self._files(folder).globStatus(glob) or []]

    def _numbers(self, folder: str) -> list[int]:
        marks = self._found(folder, "version=*/_SUCCESS")
        return [int(m.rsplit("/", 2)[1].removeprefix("version=")) for m in marks]

    def _next(self, folder: str) -> int:
        return max(self._numbers(folder), default=0) + 1

    def _newest(self, folder: str) -> str | None:
        numbers = self._numbers(folder)
        return f"{folder}/version={max(numbers)}" if numbers else None

    def _add_version(self, folder: str, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        number = self._next(folder)
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{folder}/version={number}")
        self._forget(folder, number)

    def _forget(self, folder: str, newest: int) -> None:
        """Remove versions that no reader can still be at."""
        for number in self._numbers(folder):
            if number < newest - 1:
                self.discard(f"{folder}/version={number}")


class Snapshot(TableStore):
    """The released tables as of one entry."""

    def __init__(self, store: TableStore):
        super().__init__(store.spark, store.root)
        self.number, entry = self._log().newest()
        self.before: dict[str, Any] = entry.get("tables", {})

    def _released(self) -> dict[str, Any]:
        return self.before

    def replace(self, layer: str, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        raise TypeError("a snapshot is for reading; replace tables in a release")

    def replace_partitions(self, layer, name, df, column, values) -> DataFrame:
        raise TypeError("a snapshot is for reading; replace partitions in a release")


def _folders(tables: dict[str, Any]) -> set[str]:
    """All folders that an entry names."""
    return {f for t in tables.values() for f in (t["leaves"].values() if isinstance(t, dict) else [t])}


class Release(Snapshot):
    """Tables written aside until `publish`. It reads its own, and others as of its begin."""

    def __init__(self, store: TableStore):
        super().__init__(store)
        self.written: dict[str, Any] = {}

    def _released(self) -> dict[str, Any]:
        return self.before | self.written

    def replace(self, layer: str, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        folder, leaves = self._write(layer, name, df, partition_by)
        named = {"leaves": leaves, "schema": _laid_out(df, partition_by)} if partition_by else folder
        self.written[f"{layer}/{name}"] = named
        return self.read(layer, name)

    def replace_partitions(self, layer, name, df, column, values) -> DataFrame:
        before = self.partitions(layer, name)
        if before is None:
            raise ValueError(f"{layer}/{name} has not been released with partitions")
        name_of = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
        replaced = {name_of(column, None if v is None else str(v)) for v in values}
        _, leaves = self._write(layer, name, df, [column])
        if strange := leaves.keys() - replaced:
            raise ValueError(f"{layer}/{name}: rows of partitions that are not replaced: {sorted(strange)}")
        stay = {part: leaf for part, leaf in before.items() if part not in replaced}
        self.written[f"{layer}/{name}"] = {"leaves": stay | leaves, "schema": _laid_out(df, [column])}
        return self.read(layer, name)

    def _write(self, layer: str, name: str, df: DataFrame, partition_by: Sequence[str]) -> tuple[str, dict[str, str]]:
        """A new folder, and the folders of its partitions."""
        if partition_by:
            df = df.hint("rebalance", *partition_by)
        folder = f"{self.path(layer, name)}/release={int(time.time())}-{uuid.uuid4().hex}"
        df.write.partitionBy(*partition_by).parquet(folder)
        depth = len(partition_by)
        found = self._found(folder, "/".join(f"{c}=*" for c in partition_by)) if depth else []
        return folder, {"/".join(leaf.split("/")[-depth:]): leaf for leaf in found}

    def publish(self) -> None:
        if not self.written:
            return
        log, tables = self._log(), self._released()
        log.publish(self.number, {"tables": tables})
        kept = _folders(tables) | _folders(self.before)
        older = log.read(self.number - 1)["tables"] if self.number - 1 in log.numbers() else {}
        for folder in _folders(older) - kept:
            self.discard(folder)
        names = {part for f in kept for part in f.split("/") if part.startswith("release=")}
        for table in self.written:  # what failed runs have left
            for folder in self._found(f"{self.root}/{table}", "release=*"):
                name = folder.rpartition("/")[2]
                begun = int(name.removeprefix("release=").partition("-")[0])
                if name not in names and time.time() - begun > _FAILED_AFTER:
                    self.discard(folder)


def _laid_out(df: DataFrame, partition_by: Sequence[str]) -> dict[str, Any]:
    """Schema of a partitioned table as it is read: partition columns last."""
    fields = [f for f in df.schema if f.name not in partition_by]
    return json.loads(T.StructType([*fields, *[df.schema[c] for c in partition_by]]).json())
