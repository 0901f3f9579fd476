"""What is known of each landed page file: its records and the times they were updated in.

A run of the feed opens files that are new (or were landed again) and known ones that hold a
record newer than its watermark; a replay opens those that can hold its interval. All others
are listed, but not read. Zones lie in a change log, one for each name a run goes by, so what
a run reads of them does not grow with the number of runs.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galley.functions import utc_literal
from galley.operators.durable import pin
from galley.sources.change_log import ChangeLog
from galley.sources.contracts import FEED_PAGE
from galley.sources.feed_pages import flatten
from galley.sources.store import TableStore

_FACTS = ["modified", "size", "records", "low", "high"]
_FILE = "_file"


class PageZones:
    """Zones of the page files of a path, which may be a folder or a glob.

    ``keep_rows`` is how the list of files and parsed records are written aside.
    """

    def __init__(self, store: TableStore, name: str, path: str, keep_rows: Callable[[DataFrame], DataFrame] = pin):
        self.store, self.name, self.path, self.keep_rows = store, name, path, keep_rows
        self.log = ChangeLog(store, "state", f"page_zones_{name}", "file", _FACTS, "modified")

    def next_run(self) -> int:
        """Number of the run that has begun and not been kept yet."""
        return self.log.taken_in(self.name) + 1

    def listed(self) -> DataFrame:
        """A row per file there is: ``file, path, modified, size, known, low, high``.

        ``known`` is false for a file without zone and for one that has changed since. The
        list is written once, so files that are landed later are left to the next run.
        """
        files = self.store.spark.read.format("binaryFile").load(self.path).select(
            F.col("_metadata.file_path").alias("file"),
            "path",
            F.col("modificationTime").cast("timestamp_ntz").alias("modified"),
            F.col("length").alias("size"),
        )
        zones = self.log.read()
        if zones is None:
            known = [F.lit(False).alias("known"), *[F.lit(None).cast("timestamp_ntz").alias(c) for c in ("low", "high")]]
            return self.keep_rows(files.select("*", *known))
        zones = zones.select("file", "modified", "size", "low", "high", F.lit(True).alias("known"))
        return self.keep_rows(files.join(zones, ["file", "modified", "size"], "left").fillna(False, ["known"]))

    def records(self, files: DataFrame) -> DataFrame:
        """The records of some of the files, parsed once, with the file they are from in ``_file``."""
        spark = self.store.spark
        paths = [r["path"] for r in files.select("path").toLocalIterator()]  # names, not data
        pages = spark.read.schema(FEED_PAGE).json(paths) if paths else spark.createDataFrame([], FEED_PAGE)
        source = F.col("_metadata.file_path") if paths else F.lit("")
        return self.keep_rows(flatten(pages.select("data", source.alias(_FILE)), _FILE))

    def keep(self, files: DataFrame, records: DataFrame) -> None:
        """Keep the zones of files that a run has taken in, also of those without records."""
        found = records.groupBy(F.col(_FILE).alias("file")).agg(
            F.count("*").alias("records"), F.min("updated_at").alias("low"), F.max("updated_at").alias("high")
        )
        rows = files.drop("low", "high").join(found, "file", "left").fillna(0, ["records"])
        self.log.append(rows.select("file", *_FACTS), self.name, self.next_run())

    def meets(self, start: dt.datetime, end: dt.datetime) -> Column:
        """Condition on `listed`: the file can hold records of ``[start, end)``."""
        inside = (F.col("high") >= utc_literal(start)) & (F.col("low") < utc_literal(end))
        return ~F.col("known") | F.coalesce(inside, F.lit(False))

    def newer(self, mark: dt.datetime) -> Column:
        """Condition on `listed`: the file can hold records updated after ``mark``, or is new."""
        return ~F.col("known") | F.coalesce(F.col("high") > utc_literal(mark), F.lit(False))
