"""Landed pages as a stream of changes to the delivery table.

Each micro-batch appends its newest record per delivery to a change log, which folds its
batches into levels as they come in, so what a reading opens stays bounded however many
batches there were. A repeated batch is taken in once. Late records must win over older
state, so no event-time watermark drops any.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from galley.plans.feed import latest_records
from galley.sources.change_log import ChangeLog
from galley.sources.contracts import FEED_PAGE, FEED_TABLE_COLUMNS, FEED_UPDATES
from galley.sources.feed_pages import flatten
from galley.sources.store import TableStore


def page_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    return (
        spark.readStream.schema(FEED_PAGE).option("maxFilesPerTrigger", files_per_batch).json(path)
    )


def change_log(store: TableStore, fanout: int = 16) -> ChangeLog:
    return ChangeLog(store, "feed", "changes", "delivery_id", FEED_UPDATES, "updated_at", fanout)


def append_changes(store: TableStore, records: DataFrame, batch: int, source: str = "", fanout: int = 16) -> None:
    """Keep what a micro-batch changes. ``source`` is the stream that numbers the batches."""
    rows = latest_records(records).select(*FEED_TABLE_COLUMNS)
    change_log(store, fanout).append(rows, source, batch)


def start_feed(
    store: TableStore, path: str, checkpoint: str, files_per_batch: int = 1000, fanout: int = 16
) -> StreamingQuery:
    """Process everything landed since the last start, then stop.

    A stream keeps its id as long as its checkpoint; with a new checkpoint it reads all
    pages again as another source, which changes nothing in the table.
    """
    records = flatten(page_stream(store.spark, path, files_per_batch))

    def append(rows: DataFrame, batch: int) -> None:
        stream = store.spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        append_changes(store, rows, batch, stream, fanout)

    return (
        records.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current_state(store: TableStore, low: str | None = None, high: str | None = None) -> DataFrame:
    """The delivery table as of now, or its deliveries with ids from ``low`` to ``high``.

    Status, fee and update time come from the newest record, the later batch on equal
    times; everything else from the batch a delivery was first seen in.
    """
    found = change_log(store).read(low, high)
    if found is None:
        raise ValueError(f"no changes have been kept below {store.root}")
    return found


def compact(store: TableStore) -> DataFrame:
    """Fold all changes into one run; does nothing if they are one."""
    change_log(store).compact()
    return current_state(store)
