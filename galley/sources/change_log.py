"""A keyed table as levels of folded batches.

A batch is appended as a run of level 0. As soon as a level has ``fanout`` runs they are
folded into one run of the next level, together with the levels above that would be full
then. So after n batches there are fewer than ``fanout`` runs in each of log(n) levels, a
row is written again once per level, and neither the batches that were folded nor their
footers are read any more. Runs from level 1 on are cut into parts by key ranges, so a
reading of a key range opens only parts that can hold it.

Which parts make up the table is one entry of an `EntryLog`. It is published after the
append and its folding are written, so a failed batch leaves nothing behind that counts,
and of two writers one is refused and tries again from what the other has published. A
source (a stream) numbers its batches; one that has been taken in is not taken in again.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from galley.sources.entry_log import EntryLog, WriterConflict
from galley.sources.store import TableStore

_FIRST, _LAST, _PART = "_first_batch", "_last_batch", "_part"
_ATTEMPTS = 5


def levels_to_fold(runs: Mapping[int, int], fanout: int) -> int:
    """How many of the lowest levels are folded into one run of the level after them."""
    depth = 0
    while runs.get(depth, 0) + (depth > 0) >= fanout:
        depth += 1
    return depth


class ChangeLog:
    """``key`` names a text column; ``updates`` what a later row changes, ``version`` its time.

    All other columns stay what they were in the batch that a key was first seen in. On
    equal versions the later batch counts. Folders that are no longer named are removed
    after ``grace_seconds``, which has to exceed the longest reading or folding.
    """

    def __init__(
        self,
        store: TableStore,
        layer: str,
        name: str,
        key: str,
        updates: Sequence[str],
        version: str,
        fanout: int = 16,
        part_rows: int = 8_000_000,
        grace_seconds: int = 86_400,
    ):
        self.store, self.key, self.updates, self.version = store, key, [*updates], version
        self.fanout, self.part_rows, self.grace_seconds = fanout, part_rows, grace_seconds
        self.folder = store.path(layer, f"{name}_runs")
        self.log = EntryLog(store, store.path(layer, f"{name}_log"))

    # writing ---------------------------------------------------------------------------

    def append(self, rows: DataFrame, source: str, batch: int) -> bool:
        """Take in a batch, one row per key, rows without a key left out; False if it has been.

        A batch without rows adds no run, but counts as taken in.
        """
        rows = rows.where(F.col(self.key).isNotNull())

        def next_state(state: dict[str, Any]) -> dict[str, Any] | None:
            if batch <= state["sources"].get(source, -1):
                return None
            sequence = state["sequence"] + 1
            schema = state["schema"] or json.loads(rows.schema.json())
            numbered = rows.select(*self._names(schema)).withColumns({_FIRST: F.lit(sequence).cast("bigint"), _LAST: F.lit(sequence).cast("bigint")})
            folder = self._new_folder()
            numbered.write.parquet(folder)
            run = self._described(numbered.schema, folder, 0, None)
            parts = self._folded(state["parts"] + run, schema)
            sources = {**state["sources"], source: batch}
            return {**state, "sequence": sequence, "schema": schema, "parts": parts, "sources": sources}

        return self._publish(next_state)

    def compact(self) -> bool:
        """Fold all runs into one; False if there is nothing to fold."""

        def next_state(state: dict[str, Any]) -> dict[str, Any] | None:
            parts = state["parts"]
            if len({p["run"] for p in parts}) < 2:
                return None
            return {**state, "parts": self._fold_into(parts, 1 + max(p["level"] for p in parts), state["schema"])}

        return self._publish(next_state)

    def _publish(self, step: Callable[[dict[str, Any]], dict[str, Any] | None]) -> bool:
        for attempt in range(_ATTEMPTS):
            number, state = self._state()
            after = step(state)
            if after is None:
                return False
            after["dropped"] = self._dropped(state, after)
            try:
                self.log.publish(number, after)
            except WriterConflict:
                if attempt + 1 == _ATTEMPTS:
                    raise
                continue
            self._forget(after)
            return True

    def _folded(self, parts: list[dict[str, Any]], schema: dict[str, Any]) -> list[dict[str, Any]]:
        runs: dict[int, set[str]] = {}
        for p in parts:
            runs.setdefault(p["level"], set()).add(p["run"])
        depth = levels_to_fold({level: len(names) for level, names in runs.items()}, self.fanout)
        if not depth:
            return parts
        low = [p for p in parts if p["level"] < depth]
        return [p for p in parts if p["level"] >= depth] + self._fold_into(low, depth, schema)

    def _fold_into(self, parts: list[dict[str, Any]], level: int, schema: dict[str, Any]) -> list[dict[str, Any]]:
        """One run of what the parts hold. Its key ranges serve the aggregation too: one shuffle."""
        rows = self._rows(parts, schema)
        cut = max(1, -(-sum(p["rows"] for p in parts) // self.part_rows))
        folded = self._fold(rows.repartitionByRange(cut, self.key), schema)
        folder = self._new_folder()
        folded.withColumn(_PART, F.spark_partition_id()).write.partitionBy(_PART).parquet(folder)
        return self._described(folded.schema, folder, level, _PART)

    def _described(self, schema: T.StructType, folder: str, level: int, part: str | None) -> list[dict[str, Any]]:
        """Key range and number of rows of each part of a run; only keys are read."""
        columns = T.StructType([f for f in schema if f.name == self.key])
        if part:
            columns = columns.add(part, T.IntegerType())
        keys = self.store.spark.read.schema(columns).parquet(folder)
        found = keys.groupBy(F.col(part) if part else F.lit(0).alias(_PART)).agg(
            F.min(self.key).alias("low"), F.max(self.key).alias("high"), F.count("*").alias("rows")
        )
        return [
            {
                "level": level,
                "run": folder,
                "folder": f"{folder}/{part}={r[_PART]}" if part else folder,
                "low": r["low"],
                "high": r["high"],
                "rows": r["rows"],
            }
            for r in sorted(found.collect(), key=lambda r: r[_PART])  # a row per part
        ]

    # reading ---------------------------------------------------------------------------

    def read(self, low: str | None = None, high: str | None = None) -> DataFrame | None:
        """The table as of now, or its keys from ``low`` to ``high``; None if there is none."""
        state = self._state()[1]
        if not state["schema"]:
            return None
        parts = [
            p for p in state["parts"]
            if (low is None or p["high"] >= low) and (high is None or p["low"] <= high)
        ]
        rows = self._rows(parts, state["schema"])
        if low is not None:
            rows = rows.where(F.col(self.key) >= low)
        if high is not None:
            rows = rows.where(F.col(self.key) <= high)
        return self._fold(rows, state["schema"]).select(*self._names(state["schema"]))

    def taken_in(self, source: str) -> int:
        """The last batch of a source that counts; -1 if none does."""
        return self._state()[1]["sources"].get(source, -1)

    def parts(self) -> list[dict[str, Any]]:
        """Level, folder, key range and rows of each part of the table as of now."""
        return self._state()[1]["parts"]

    def _fold(self, rows: DataFrame, schema: dict[str, Any]) -> DataFrame:
        """A row per key. Folding what has been folded gives the same as folding all at once."""
        kept = [c for c in self._names(schema) if c != self.key and c not in self.updates]
        first = F.min_by(F.struct(*kept, _FIRST), F.col(_FIRST)).alias("_kept")
        last = F.max_by(F.struct(*self.updates, _LAST), F.struct(self.version, _LAST)).alias("_newest")
        folded = rows.groupBy(self.key).agg(first, last).select(self.key, "_kept.*", "_newest.*")
        return folded.select(*self._names(schema), _FIRST, _LAST)

    def _rows(self, parts: list[dict[str, Any]], schema: dict[str, Any]) -> DataFrame:
        stored = T.StructType.fromJson(schema).add(_FIRST, T.LongType()).add(_LAST, T.LongType())
        if not parts:
            return self.store.spark.createDataFrame([], stored)
        return self.store.spark.read.schema(stored).parquet(*[p["folder"] for p in parts])

    @staticmethod
    def _names(schema: dict[str, Any]) -> list[str]:
        return [f["name"] for f in schema["fields"]]

    # state and folders -----------------------------------------------------------------

    def _state(self) -> tuple[int, dict[str, Any]]:
        number, found = self.log.newest()
        return number, {"sequence": 0, "schema": None, "parts": [], "sources": {}, "dropped": {}, **found}

    def _new_folder(self) -> str:
        return f"{self.folder}/run={int(time.time())}-{uuid.uuid4().hex}"

    def _dropped(self, before: dict[str, Any], after: dict[str, Any]) -> dict[str, int]:
        """Runs that readers may still be at, with the time since which no entry names them."""
        now = int(time.time())
        gone = {_name(p) for p in before["parts"]} - {_name(p) for p in after["parts"]}
        waiting = {run: at for run, at in before["dropped"].items() if now - at <= self.grace_seconds}
        return waiting | dict.fromkeys(gone, now)

    def _forget(self, state: dict[str, Any]) -> None:
        """Remove runs whose time of grace is over, and old ones of attempts that failed.

        A run's name tells when it was begun.
        """
        kept = {_name(p) for p in state["parts"]} | state["dropped"].keys()
        for folder in self.store._found(self.folder, "run=*"):
            name = folder.rpartition("/")[2]
            begun = int(name.removeprefix("run=").partition("-")[0])
            if name not in kept and time.time() - begun > self.grace_seconds:
                self.store.discard(folder)


def _name(part: dict[str, Any]) -> str:
    return part["run"].rpartition("/")[2]
