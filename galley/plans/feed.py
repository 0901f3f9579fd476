"""The provider feed in batch: latest state, upsert, summary, reconciliation, watermark."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galley.functions import iso_utc, minutes_between, utc_literal
from galley.operators.durable import scratch
from galley.operators.latest import latest_per_key
from galley.operators.pages import matching
from galley.operators.upsert import upsert
from galley.sources.buckets import BucketTable
from galley.sources.contracts import FEED_TABLE_COLUMNS, FEED_UPDATES
from galley.sources.page_zones import PageZones
from galley.sources.store import TableStore

FIRST_WATERMARK = "2026-05-01T00:00:00Z"

# States counted by the provider's summary.
ENDED = ("delivered", "failed", "cancelled")


def latest_records(records: DataFrame, tie_break: Sequence[str] = ()) -> DataFrame:
    """Newest record per delivery; replays and corrections fall together."""
    return latest_per_key(records, ["delivery_id"], ["updated_at", *tie_break])


def apply_records(table: DataFrame, records: DataFrame) -> DataFrame:
    """The delivery table after the records.

    A known delivery takes status, fee and update time of a record that is not older; a
    new one takes all columns. Records without an id are left to ``violations``.
    """
    changes = latest_records(records).select(*FEED_TABLE_COLUMNS)
    return upsert(table, changes, "delivery_id", FEED_UPDATES, version="updated_at")


def delivery_table(store: TableStore) -> BucketTable:
    """The stored delivery table, of which a run rewrites the buckets it changes."""
    return BucketTable(store, "feed", "deliveries", "delivery_id")


def empty_table(records: DataFrame) -> DataFrame:
    return records.select(*FEED_TABLE_COLUMNS).limit(0)


# watermark ---------------------------------------------------------------------------


def read_watermark(store: TableStore, name: str) -> str:
    marks = store.latest("state", "watermarks")
    found = [] if marks is None else marks.where(F.col("name") == name).collect()
    return found[0]["last_watermark"] if found else FIRST_WATERMARK


def write_watermark(store: TableStore, name: str, value: str) -> None:
    columns = "name string, last_watermark string"
    change = store.spark.createDataFrame([(name, value)], columns).withColumn(
        "updated_at", F.current_timestamp()
    )
    before = store.latest("state", "watermarks")
    if before is None:
        before = change.limit(0)
    store.advance(
        "state", "watermarks", upsert(before, change, "name", ["last_watermark", "updated_at"])
    )


def mark_text(reached: dt.datetime) -> str:
    """A time as a watermark: to the microsecond, without zeros that end its fraction."""
    text = reached.isoformat()
    return (text.rstrip("0") if reached.microsecond else text) + "Z"


def newer_than(records: DataFrame, watermark: str) -> DataFrame:
    """Records updated after the watermark."""
    return matching(records, updated_after=_naive_utc(watermark))


def _naive_utc(text: str) -> dt.datetime:
    when = dt.datetime.fromisoformat(text.replace("Z", "+00:00"))
    return when.astimezone(dt.UTC).replace(tzinfo=None) if when.tzinfo else when


# summary and reconciliation ----------------------------------------------------------


def _latest_fields(
    records: DataFrame, after: dt.datetime | None, before: dt.datetime | None
) -> DataFrame:
    """Per delivery: number of records, time range, and the fields of the newest one.

    One aggregation gives them all, and it starts before the shuffle.
    """
    kept = matching(records, updated_after=after, updated_before=before)
    fields = ["delivery_status", "delivery_fee", "brand", "store_id"]
    newest = F.struct(
        F.col("updated_at"), F.xxhash64(*[F.col(c) for c in records.columns]).alias("tie")
    )
    return kept.groupBy("delivery_id").agg(
        F.count("*").alias("_n"),
        F.min("updated_at").alias("_first"),
        F.max("updated_at").alias("_last"),
        F.max_by(F.struct(*fields), newest).alias("_newest"),
    ).select("delivery_id", "_n", "_first", "_last", "_newest.*")


def provider_summary(
    records: DataFrame,
    updated_after: dt.datetime | None = None,
    updated_before: dt.datetime | None = None,
) -> DataFrame:
    """The provider's control totals as one row.

    The maps have an entry per brand and per store; ``counts_by`` gives the same as rows.
    """
    latest = _latest_fields(records, updated_after, updated_before)
    groups = latest.groupBy("brand", "store_id").agg(
        F.sum("_n").alias("records"),
        F.count("delivery_id").alias("deliveries"),
        F.count("*").alias("latest"),
        F.min("_first").alias("first"),
        F.max("_last").alias("last"),
        F.sum("delivery_fee").alias("fees"),
        *[F.expr(f"count_if(delivery_status = '{s}') AS {s}") for s in ENDED],
    )
    # every group counts towards its brand, its store and the total
    sums = ["records", "deliveries", "latest", "fees", *ENDED]
    kinds = "stack(3, 'brand', brand, 'store', store_id, 'total', NULL) AS (kind, key)"
    per_key = (
        groups.selectExpr(kinds, "first", "last", *sums)
        .groupBy("kind", "key")
        .agg(*[F.sum(c).alias(c) for c in sums], F.min("first").alias("first"), F.max("last").alias("last"))
    )

    def total(column: str) -> str:
        return f"CAST(coalesce(max(IF(kind = 'total', {column}, NULL)), 0) AS BIGINT)"

    def counts(kind: str) -> str:
        # a map has no NULL key, so that group is left out
        entry = f"IF(kind = '{kind}' AND key IS NOT NULL, struct(key, latest), NULL)"
        return f"map_from_entries(array_sort(collect_list({entry})))"

    columns = {
        "source_record_count": total("records"),
        "distinct_delivery_count": total("deliveries"),
        "delivered_count": total("delivered"),
        "failed_count": total("failed"),
        "cancelled_count": total("cancelled"),
        "total_delivery_fees": total("fees"),
        "minimum_updated_at": "min(first)",
        "maximum_updated_at": "max(last)",
        "delivery_count_by_brand": counts("brand"),
        "delivery_count_by_store": counts("store"),
    }
    return per_key.agg(*[F.expr(f"{sql} AS {name}") for name, sql in columns.items()])


def counts_by(records: DataFrame, column: str) -> DataFrame:
    """Deliveries per value of a column of their newest record."""
    return _latest_fields(records, None, None).groupBy(column).agg(F.count("*").alias("count"))


def reconcile_feed(table: DataFrame, summary: DataFrame) -> DataFrame:
    """Deliveries and fees of the table against the provider's totals.

    Having fewer deliveries than the provider fails; fees are reported.
    """

    def values(df: DataFrame, side: str, count: str, fees: str) -> DataFrame:
        return df.selectExpr(
            f"'{side}' AS side",
            f"stack(2, 'distinct_delivery_count', CAST({count} AS DOUBLE), "
            f"'total_delivery_fees', CAST({fees} AS DOUBLE)) AS (metric, value)",
        )

    here = table.agg(
        F.count_distinct("delivery_id").alias("n"),
        F.coalesce(F.sum("delivery_fee"), F.lit(0)).alias("fees"),
    )
    sides = values(here, "target", "n", "fees").union(
        values(summary, "source", "distinct_delivery_count", "total_delivery_fees")
    )
    compared = sides.groupBy("metric").agg(
        F.expr("max(IF(side = 'source', value, NULL)) AS source_value"),
        F.expr("max(IF(side = 'target', value, NULL)) AS target_value"),
    )
    status = """CASE
        WHEN metric = 'distinct_delivery_count' THEN IF(target_value < source_value, 'FAIL', 'PASS')
        WHEN target_value = source_value THEN 'PASS' ELSE 'DIFFERS' END"""
    return compared.withColumn("status", F.expr(status))


def listed_totals(provider: DataFrame) -> DataFrame:
    """The control totals of a provider's list of deliveries."""
    return provider.agg(
        F.count_distinct("delivery_id").alias("distinct_delivery_count"),
        F.coalesce(F.sum("delivery_fee"), F.lit(0)).alias("total_delivery_fees"),
    )


class FeedReconciliationFailed(RuntimeError):
    pass


def ingest_pages(
    store: TableStore,
    pages_path: str,
    name: str,
    reconcile: Callable[[DataFrame, DataFrame], DataFrame] = reconcile_feed,
    brands: Sequence[str] | None = None,
    now: dt.datetime | None = None,
    provider: DataFrame | None = None,
) -> str:
    """Load landed pages, reconcile, and only then move the watermark.

    Only files that no run of this ``name`` has taken in are opened, and known ones that
    hold something newer than the watermark (`PageZones`); they are parsed once. A late file,
    whose records are all older than the watermark, is taken in like any other.

    What the opened files hold is also kept in the columns of the deliveries source and,
    where the known ``brands`` are given, held against the rules of `violations` (by default
    as of the present time). Both are kept by the number of the run, and a run that fails
    keeps its number, so a run that is tried again replaces its own.

    ``provider`` is the provider's own list of deliveries, one row each with status, fee and
    update time. Where it is given, its totals are what the table is reconciled with, and
    the deliveries on which both sides differ are kept, also of a run that fails.

    The watermark is the newest update time seen, so records changed while the job ran
    are not skipped. Returns the watermark in force afterwards.
    """
    with scratch(store.spark) as keep_rows:
        zones = PageZones(store, name, pages_path, keep_rows)
        return _ingest(store, zones, name, reconcile, brands, now, provider)


def _ingest(
    store: TableStore,
    zones: PageZones,
    name: str,
    reconcile: Callable[[DataFrame, DataFrame], DataFrame],
    brands: Sequence[str] | None,
    now: dt.datetime | None,
    provider: DataFrame | None,
) -> str:
    watermark = read_watermark(store, name)
    files = zones.listed().where(zones.newer(_naive_utc(watermark)))
    if files.isEmpty():
        return watermark
    run, fresh = f"{zones.next_run():012d}", zones.records(files)
    records = fresh.drop("_file")
    store.write_partition("feed", "normalised", as_deliveries(records), "run", run)
    if brands is not None:
        now = now or dt.datetime.now(dt.UTC).replace(tzinfo=None)
        store.write_partition("feed", "violations", violations(records, brands, now), "run", run)
    deliveries = delivery_table(store)
    deliveries.upsert(latest_records(records).select(*FEED_TABLE_COLUMNS), FEED_UPDATES, version="updated_at")
    if provider is None:
        totals = provider_summary(records, _naive_utc(watermark))
    else:
        totals = listed_totals(provider)
        differing = deliveries.differences(provider, FEED_UPDATES)
        store.write_partition("feed", "differences", differing, "run", run)
    table = deliveries.read()
    if table is None:  # pages without any delivery
        table = empty_table(records)
    check = reconcile(table, totals)
    failed = check.where("status = 'FAIL'").collect()  # at most two rows
    if failed:
        raise FeedReconciliationFailed(str([r.asDict() for r in failed]))
    # if the job ends between these two, the files are opened again: they are newer than the mark
    zones.keep(files, fresh)
    reached = records.agg(F.max("updated_at")).first()[0]
    if reached is None or reached <= _naive_utc(watermark):
        return watermark
    # to the microsecond: a mark cut to seconds would make its newest record newer for ever
    write_watermark(store, name, mark_text(reached))
    return mark_text(reached)


def replay_records(
    store: TableStore, pages_path: str, name: str, start: dt.datetime, end: dt.datetime, rewind_minutes: int = 10
) -> DataFrame:
    """All landed records updated in ``[start - rewind, end)``.

    Of the files that runs of this ``name`` have taken in, only those that can hold such
    records are opened.
    """
    begin = start - dt.timedelta(minutes=rewind_minutes)
    zones = PageZones(store, name, pages_path)
    found = zones.records(zones.listed().where(zones.meets(begin, end))).drop("_file")
    return found.where((F.col("updated_at") >= utc_literal(begin)) & (F.col("updated_at") < utc_literal(end)))


# contract, validity, replay ----------------------------------------------------------


def as_deliveries(records: DataFrame) -> DataFrame:
    """Provider records in the columns of the deliveries source."""
    promised = minutes_between(F.col("assigned_at"), F.col("promised_delivery_at"))
    actual = minutes_between(F.col("assigned_at"), F.col("delivered_at"))
    return records.select(
        "order_id",
        "store_id",
        F.col("assigned_at").alias("order_ts"),
        promised.alias("promised_delivery_minutes"),
        actual.alias("actual_delivery_minutes"),
        (actual <= promised).cast("bigint").alias("delivered_within_sla"),
    )


def violations(records: DataFrame, brands: Sequence[str], now: dt.datetime) -> DataFrame:
    """One row per invalid record and rule."""
    rules = {
        "null_delivery_id": F.col("delivery_id").isNull(),
        "negative_delivery_fee": F.col("delivery_fee") < 0,
        "negative_distance": F.col("distance_km") < 0,
        "unknown_brand": ~F.col("brand").isin(*brands) | F.col("brand").isNull(),
        "future_updated_at": F.col("updated_at") > utc_literal(now),
    }
    broken = F.array_compact(F.array(*[F.when(fails, F.lit(name)) for name, fails in rules.items()]))
    return records.select(F.explode(broken).alias("rule"), "delivery_id", "order_id", "updated_at")


def interval_plan(
    start: Column, end: Column, chunk_minutes: int = 60, rewind_minutes: int = 10
) -> Column:
    """Array of half-open chunks covering ``[start - rewind, end)``."""
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(chunk_minutes))
    begin = start - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(rewind_minutes))
    starts = F.filter(F.sequence(begin, end, step), lambda s: s < end)
    return F.transform(
        starts,
        lambda s: F.struct(s.alias("chunk_start"), F.least(s + step, end).alias("chunk_end")),
    )


def in_chunks(
    records: DataFrame,
    start: dt.datetime,
    end: dt.datetime,
    chunk_minutes: int = 60,
    rewind_minutes: int = 10,
) -> DataFrame:
    """Records of ``[start - rewind, end)`` with the chunk they are replayed in.

    The chunk follows from the update time by arithmetic; nothing is joined.
    """
    begin = utc_literal(start - dt.timedelta(minutes=rewind_minutes))
    updated = F.col("updated_at")
    kept = records.where((updated >= begin) & (updated < utc_literal(end)))
    passed = F.floor(F.timestamp_diff("SECOND", begin, updated) / (60 * chunk_minutes))
    minutes = (passed * chunk_minutes).cast("int")
    return kept.withColumn("chunk_start", F.timestamp_add("MINUTE", minutes, begin))
