"""Filters and ordered pages over delivery records."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from galley.functions import utc_literal


def matching(
    df: DataFrame,
    updated_after: dt.datetime | None = None,
    updated_before: dt.datetime | None = None,
    brand: str | None = None,
    store_id: str | None = None,
    city: str | None = None,
    delivery_status: str | None = None,
) -> DataFrame:
    """Apply the filters that were given; an empty value is no filter."""
    if updated_after:
        df = df.where(F.col("updated_at") > utc_literal(updated_after))
    if updated_before:
        df = df.where(F.col("updated_at") <= utc_literal(updated_before))
    wanted = {
        "brand": brand,
        "store_id": store_id,
        "city": city,
        "delivery_status": delivery_status,
    }
    for column, value in wanted.items():
        if value:
            df = df.where(F.col(column) == value)
    return df


Cursor = tuple[dt.datetime | None, str | None]


def _after(updated_at: dt.datetime | None, delivery_id: str | None) -> Column:
    """What follows a row in the order of pages, NULLs first."""
    same = F.col("updated_at").isNull()
    later = F.col("updated_at").isNotNull()
    if updated_at is not None:
        same, later = (F.col("updated_at") == utc_literal(updated_at)), (F.col("updated_at") > utc_literal(updated_at))
    greater = F.col("delivery_id").isNotNull() if delivery_id is None else F.col("delivery_id") > delivery_id
    return later | (same & greater)


def page(
    df: DataFrame, limit: int, after: Cursor | None = None
) -> DataFrame:
    """One page in (``updated_at``, ``delivery_id``) order with ``has_more``.

    The next page starts after ``next_cursor`` of this one, so no page has to skip over the
    rows before it. Rows without a time or id come first. ``df`` needs one row per (``updated_at``, ``delivery_id``).
    """
    rest = df if after is None else df.where(_after(*after))
    order = [F.col("updated_at").asc_nulls_first(), F.col("delivery_id").asc_nulls_first()]
    # only limit + 1 rows are left here, so a global window is no bottleneck
    place = F.row_number().over(W.orderBy(*order))
    last = F.max("_place").over(W.partitionBy())
    return (
        rest.orderBy(*order)
        .limit(limit + 1)
        .withColumn("_place", place)
        .withColumn("has_more", last > limit)
        .where(F.col("_place") <= limit)
        .drop("_place")
    )


def next_cursor(one_page: DataFrame) -> Cursor | None:
    """Where the page after a page starts; None after the last one, an empty one included."""
    order = [F.col("updated_at").desc_nulls_last(), F.col("delivery_id").desc_nulls_last()]
    last = one_page.orderBy(*order).select("updated_at", "delivery_id", "has_more").first()
    return (last["updated_at"], last["delivery_id"]) if last is not None and last["has_more"] else None


def latest_version(df: DataFrame, delivery_id: str, source_order: str | None = None) -> DataFrame:
    """The newest row of one delivery."""
    order = [F.col("updated_at").desc_nulls_last()]
    if source_order:
        order.append(F.col(source_order).desc_nulls_last())
    return df.where(F.col("delivery_id") == delivery_id).orderBy(*order).limit(1)
