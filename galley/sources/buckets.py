"""A keyed table in hash buckets, of which an upsert rewrites only those it changes.

Every bucket is a folder that is written once; a manifest (a versioned table of one row per
bucket) says which folders make up the table. An upsert finds out which rows of the changes
really change something, reading the compared columns of the buckets they fall into, writes
those buckets anew and publishes the next manifest. Readers that have begun with the
manifest before keep its folders; older ones are removed. An upsert that fails before its
manifest is published leaves the table as it was.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from galley.operators.durable import scratch
from galley.operators.upsert import upsert
from galley.sources.digests import LIMBS, LIMBS_DDL, content_digest
from galley.sources.store import TableStore

_BUCKET = "_bucket"


class BucketTable:
    """``buckets`` counts for a table that is begun; later it is what the manifest says.

    A bucket should be some million rows: `resize` deals a table that has grown anew.
    """

    def __init__(self, store: TableStore, layer: str, name: str, key: str, buckets: int = 16):
        self.store, self.layer, self.name, self.key, self.buckets = store, layer, name, key, buckets
        self.folder = store.path(layer, f"{name}_buckets")

    def _manifest(self) -> dict[int, str]:
        """Folder of each bucket; there are never more rows than buckets."""
        found = self.store.latest(self.layer, f"{self.name}_manifest")
        rows = found.collect() if found is not None else []
        if rows:
            self.buckets, self.schema = rows[0]["buckets"], T.StructType.fromJson(json.loads(rows[0]["columns"]))
        return {r["bucket"]: r["folder"] for r in rows}

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(self.buckets)).cast("int")

    def _read(self, folders: Sequence[str]) -> DataFrame:
        reader = self.store.spark.read.schema(self.schema)
        return reader.parquet(*folders) if folders else self.store.spark.createDataFrame([], self.schema)

    def read(self, buckets: Collection[int] | None = None) -> DataFrame | None:
        """The table as of now, or some of its buckets alone; None if there is none."""
        folders = self._manifest()
        chosen = [f for b, f in sorted(folders.items()) if buckets is None or b in buckets]
        return self._read(chosen) if folders else None

    def digests(self, columns: Sequence[str]) -> DataFrame:
        """The content digest of some columns of each bucket, kept with its folder: only folders without one are read."""
        name, wanted = f"{self.name}_digests", ",".join(columns)
        folders = self._manifest()
        kept = self.store.latest(self.layer, name)
        if kept is None:
            kept = self.store.spark.createDataFrame([], f"columns string, bucket int, folder string, n bigint, {LIMBS_DDL}")
        kept = kept.where((F.col("columns") == wanted) & F.col("folder").isin([*folders.values()]))
        known = {r["folder"] for r in kept.select("folder").collect()}  # one row per bucket
        fresh = {b: f for b, f in folders.items() if f not in known}
        if fresh:
            rows = self._read(sorted(fresh.values())).withColumn(_BUCKET, self._bucket())
            named = self.store.spark.createDataFrame([*fresh.items()], "bucket int, folder string")
            found = content_digest(rows.select(_BUCKET, *columns), _BUCKET).withColumnRenamed(_BUCKET, "bucket")
            found = found.join(named, "bucket").withColumn("columns", F.lit(wanted)).select(kept.columns)
            kept = self.store.advance(self.layer, name, kept.unionByName(found).coalesce(1))
        return kept.drop("columns", "folder")

    def differences(self, theirs: DataFrame, columns: Sequence[str]) -> DataFrame:
        """``key, difference`` of every key that this table and another source do not agree on.

        The other source has one row per key. Digests of the buckets are compared first;
        only rows of buckets whose digests differ are read and joined.
        """
        compared = [self.key, *columns]
        mine = self.digests(compared)
        theirs = theirs.select(*compared).withColumn(_BUCKET, self._bucket())
        other = content_digest(theirs, _BUCKET).withColumnRenamed(_BUCKET, "bucket")
        agreed = mine.join(other, ["bucket", "n", *LIMBS], "left_semi")
        every = mine.select("bucket").union(other.select("bucket")).distinct()
        differing = {r["bucket"] for r in every.join(agreed, "bucket", "left_anti").collect()}  # numbers of buckets
        left = self._read([]) if not differing else self.read(differing)
        left = left.select(F.col(self.key).alias("_key"), *[F.col(c).alias(f"_own_{c}") for c in columns])
        met = theirs.where(F.col(_BUCKET).isin([*differing])).join(left, F.col(self.key) == F.col("_key"), "full_outer")
        differs = F.lit(False)
        for c in columns:
            differs = differs | ~F.col(c).eqNullSafe(F.col(f"_own_{c}"))
        kind = F.when(F.col("_key").isNull(), "missing here").when(F.col(self.key).isNull(), "missing there").when(differs, "differs")
        return met.select(F.coalesce(self.key, "_key").alias(self.key), kind.alias("difference")).where("difference IS NOT NULL")

    def upsert(self, changes: DataFrame, updates: Sequence[str], version: str | None = None) -> list[int]:
        """Apply `upsert` and return the buckets that were written.

        ``changes`` has one row per key and all columns. Rows without a key, and rows that
        would leave the table as it is, touch no bucket.
        """
        with scratch(self.store.spark) as pin:
            return self._upsert(changes, updates, version, pin)

    def _upsert(
        self,
        changes: DataFrame,
        updates: Sequence[str],
        version: str | None,
        pin: Callable[[DataFrame], DataFrame],
    ) -> list[int]:
        before = self._manifest()
        changes = pin(changes.where(F.col(self.key).isNotNull()).withColumn(_BUCKET, self._bucket()))
        if not before:
            self.schema = T.StructType([T.StructField(f.name, f.dataType) for f in changes.drop(_BUCKET).schema])
        asked = {r[0] for r in changes.select(_BUCKET).distinct().collect()}  # numbers of buckets
        met = [before[b] for b in sorted(asked & set(before))]
        if met:
            changes = pin(self._effective(self._read(met), changes, updates, version))
            touched = sorted(r[0] for r in changes.select(_BUCKET).distinct().collect())
        else:
            touched = sorted(asked)
        if not touched:
            return []
        kept = self._read([before[b] for b in touched if b in before])
        rows = upsert(kept, changes.drop(_BUCKET), self.key, updates, version)
        self._publish(before, rows, touched)
        return touched

    def _effective(self, there: DataFrame, changes: DataFrame, updates: Sequence[str], version: str | None) -> DataFrame:
        compared = [*updates, *([version] if version and version not in updates else [])]
        known = there.select(F.col(self.key).alias("_known"), *[F.col(c).alias(f"_old_{c}") for c in compared])
        met = changes.join(known, F.col(self.key) == F.col("_known"), "left")
        differs = F.lit(False)
        for c in updates:
            differs = differs | ~F.col(c).eqNullSafe(F.col(f"_old_{c}"))
        if version:
            differs = differs & ~F.coalesce(F.col(version) < F.col(f"_old_{version}"), F.lit(False))
        return met.where(F.col("_known").isNull() | differs).select(*changes.columns)

    def resize(self, buckets: int) -> None:
        """Deal all rows to another number of buckets."""
        before = self._manifest()
        rows = self._read(sorted(before.values()))
        self.buckets = buckets
        self._publish({}, rows, None, before)

    def _publish(self, before: dict[int, str], rows: DataFrame, touched: list[int] | None, old: dict[int, str] | None = None) -> None:
        attempt = f"{self.folder}/attempt={uuid.uuid4().hex}"
        dealt = rows.withColumn(_BUCKET, self._bucket()).hint("rebalance", _BUCKET)
        dealt.write.partitionBy(_BUCKET).parquet(attempt)
        if touched is None:
            found = self.store._found(attempt, f"{_BUCKET}=*")
            touched = sorted(int(f.rpartition("=")[2]) for f in found)
        after = before | {b: f"{attempt}/{_BUCKET}={b}" for b in touched}
        entries = [(b, f, self.buckets, self.schema.json()) for b, f in sorted(after.items())]
        manifest = self.store.spark.createDataFrame(entries, "bucket int, folder string, buckets int, columns string")
        self.store.advance(self.layer, f"{self.name}_manifest", manifest.coalesce(1))
        self._forget({*after.values(), *(old or before).values()})

    def _forget(self, needed: set[str]) -> None:
        """Remove folders that neither this manifest nor the one before names."""
        kept = {f.rpartition("/attempt=")[2] for f in needed}
        for folder in self.store._found(self.folder, f"attempt=*/{_BUCKET}=*"):
            if folder.rpartition("/attempt=")[2] not in kept:
                self.store.discard(folder)
