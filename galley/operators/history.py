"""Slowly changing dimension, type 2."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from galley.functions import fingerprint
from galley.operators.numbering import dense_number

BEGINNING = dt.date(1900, 1, 1)
OPEN_END = dt.date(9999, 12, 31)


def version_columns(key: str, tracked: Sequence[str], number: str) -> list[str]:
    return [number, key, *tracked, "row_hash", "effective_from", "effective_to", "is_current"]


def snapshot_with_hash(snapshot: DataFrame, key: str, tracked: Sequence[str]) -> DataFrame:
    """Key, tracked attributes and their hash. Rows without a key cannot be versioned."""
    attributes = [F.col(c).cast("string") for c in (key, *tracked)]
    return snapshot.where(F.col(key).isNotNull()).select(
        key, *tracked, fingerprint(*attributes).alias("row_hash")
    )


def first_versions(
    snapshot: DataFrame, key: str, tracked: Sequence[str], number: str
) -> DataFrame:
    """The first load: every version starts in the open past, so old facts find it."""
    rows = snapshot_with_hash(snapshot, key, tracked).withColumns(
        {
            "effective_from": F.lit(BEGINNING),
            "effective_to": F.lit(OPEN_END),
            "is_current": F.lit(True),
        }
    )
    return dense_number(rows, [F.col(key).asc()], number).select(
        *version_columns(key, tracked, number)
    )


def next_versions(
    dimension: DataFrame,
    snapshot: DataFrame,
    load_date: dt.date,
    key: str,
    tracked: Sequence[str],
    number: str,
) -> DataFrame:
    """Bring a versioned dimension up to ``snapshot`` as of ``load_date``.

    Unchanged keys keep their row; a changed key has its open version closed on the day
    before and gets a new one; a new key gets its first version. Numbers already given
    out never change. A second change on the day a version began replaces that version
    in place, as an interval cannot end before it starts. Keys absent from the snapshot
    stay current.
    """
    if dimension.isEmpty():
        return first_versions(snapshot, key, tracked, number)

    columns = version_columns(key, tracked, number)
    day = F.lit(load_date)
    incoming = snapshot_with_hash(snapshot, key, tracked).select(
        F.col(key).alias("_in_key"),
        *[F.col(c).alias(f"_in_{c}") for c in tracked],
        F.col("row_hash").alias("_in_hash"),
    )
    open_rows = dimension.where("is_current")
    met = open_rows.join(incoming, F.col(key) == F.col("_in_key"), "full_outer")
    is_new = F.col(number).isNull()
    changed = ~is_new & F.coalesce(F.col("row_hash") != F.col("_in_hash"), F.lit(False))
    same_day = changed & (F.col("effective_from") >= day)
    closed = changed & ~same_day

    stays = met.where(~is_new).select(
        number,
        key,
        *[F.when(same_day, F.col(f"_in_{c}")).otherwise(F.col(c)).alias(c) for c in tracked],
        F.when(same_day, F.col("_in_hash")).otherwise(F.col("row_hash")).alias("row_hash"),
        "effective_from",
        F.when(closed, F.date_sub(day, 1)).otherwise(F.col("effective_to")).alias("effective_to"),
        (~closed).alias("is_current"),
    )
    added = met.where(is_new | closed).select(
        F.col("_in_key").alias(key),
        *[F.col(f"_in_{c}").alias(c) for c in tracked],
        F.col("_in_hash").alias("row_hash"),
        day.alias("effective_from"),
        F.lit(OPEN_END).alias("effective_to"),
        F.lit(True).alias("is_current"),
        closed.alias("_was_known"),
    )
    highest = dimension.agg(F.max(number)).first()[0]
    numbered = dense_number(
        added, [F.col("_was_known").asc(), F.col(key).asc()], number, start=highest + 1
    )
    return (
        dimension.where("NOT is_current")
        .select(*columns)
        .unionByName(stays)
        .unionByName(numbered.select(*columns))
        .withColumn(number, F.col(number).cast(T.LongType()))
    )


def covers(day: str, start: str = "effective_from", end: str = "effective_to"):
    """Residual of the as-of join: the version valid on ``day`` (both ends included)."""
    return (F.col(day) >= F.col(start)) & (F.col(day) <= F.col(end))
