"""Provider feed: pages, latest state, upsert, watermark, stream, summary."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from checks import mapping
from checks.feed_source import (
    LANDED,
    PROVIDER,
    SOURCE,
    loaded_twice,
    pages_path,
    records,
)
from checks.lake import lake
from checks.registry import query, register
from galley.functions import remap, utc_literal
from galley.operators.joins import remap_from
from galley.operators.pages import latest_version, matching, next_cursor, page
from galley.plans import feed as plan
from galley.sources.contracts import FEED_TABLE_COLUMNS, FEED_UPDATES
from galley.sources.feed_pages import land_pages, pages_glob
from galley.sources.store import TableStore
from galley.streaming.feed_stream import compact, current_state, start_feed

CUT = dt.datetime.fromisoformat(mapping.FEED_CUT)
NOW = dt.datetime(2024, 1, 29)
STREAM_FILES = 6


def _own_store(spark, sf, name) -> TableStore:
    """A store of its own for a query that keeps state, so every run starts empty."""
    return TableStore(spark, f"{lake(spark, sf).store.root}/{name}_{uuid.uuid4().hex}")


register("src5_feed_records", records, "SELECT * FROM feed_records")


@query(
    "snk3_landed_pages",
    f"""SELECT '{PROVIDER}' AS provider, '{SOURCE}' AS source, '{LANDED}' AS landed,
               count(DISTINCT event_id // 100) AS pages, count(*) AS records FROM events""",
)
def landed(spark, sf):
    """A landing that is tried again changes nothing."""
    root = _own_store(spark, sf, "landed_pages").path("landing", "pages")
    for _ in range(2):
        land_pages(mapping.feed_pages(spark, sf), root, PROVIDER, SOURCE, LANDED, pages_per_file=250)
    found = spark.read.json(root)
    return found.groupBy("provider", "source", F.col("ingestion_date").cast("string").alias("landed")).agg(
        F.count("*").alias("pages"), F.sum(F.size("data")).alias("records")
    )


@query("win2_latest_delivery", "SELECT * FROM feed_latest")
def latest(spark, sf):
    return plan.latest_records(records(spark, sf))


@query("ups1_upsert", "SELECT * FROM feed_table")
def upserted(spark, sf):
    """The records up to the cut, then all of them, into the bucketed table."""
    everything = records(spark, sf)
    table = plan.delivery_table(_own_store(spark, sf, "upsert"))
    for some in (everything.where(f"updated_at < TIMESTAMP_NTZ '{mapping.FEED_CUT}'"), everything):
        table.upsert(plan.latest_records(some).select(*FEED_TABLE_COLUMNS), FEED_UPDATES, version="updated_at")
    return table.read()


@query(
    "ups2_watermark",
    """SELECT 'before' AS step, '2026-05-01T00:00:00Z' AS watermark
       UNION ALL SELECT 'after', rtrim(rtrim(strftime(max(ts), '%Y-%m-%dT%H:%M:%S.%f'), '0'), '.') || 'Z' FROM events""",
)
def watermark(spark, sf):
    store = _own_store(spark, sf, "watermark")
    rows = [("before", plan.read_watermark(store, "riders"))]
    plan.write_watermark(store, "riders", "2023-12-01T00:00:00Z")
    plan.ingest_pages(store, pages_path(spark, sf), "riders")
    rows.append(("after", plan.read_watermark(store, "riders")))
    return spark.createDataFrame(rows, "step string, watermark string")


@query("inc4_newer_than_watermark", f"SELECT * FROM feed_records WHERE updated_at > '{mapping.FEED_CUT}'")
def newer(spark, sf):
    return plan.newer_than(records(spark, sf), mapping.FEED_CUT.replace(" ", "T") + "Z")


@query("inc5_6_stream_upsert", "SELECT * FROM feed_table")
def streamed(spark, sf):
    """The records up to the cut, a file per micro-batch, compacted; then all others likewise."""
    store = _own_store(spark, sf, "stream")
    root, updated = store.path("landing", "pages"), F.col("updated_at")
    cut = f"{mapping.FEED_CUT.replace(' ', 'T')}.000000Z"
    for request, where in (("early", updated < cut), ("late", updated >= cut)):
        pages = mapping.feed_pages(spark, sf, STREAM_FILES, where)
        land_pages(pages, root, PROVIDER, SOURCE, LANDED, request)
        start_feed(store, pages_glob(root, PROVIDER), store.path("state", "checkpoint"), 1, fanout=3).awaitTermination()
        if request == "early":
            compact(store)
    return current_state(store)


@query(
    "inc7_watermark_after_success",
    """SELECT 'failed run' AS run, '2023-12-01T00:00:00Z' AS watermark
       UNION ALL SELECT 'good run', rtrim(rtrim(strftime(max(ts), '%Y-%m-%dT%H:%M:%S.%f'), '0'), '.') || 'Z' FROM events""",
)
def after_success(spark, sf):
    store = _own_store(spark, sf, "advance")
    path = pages_path(spark, sf)
    plan.write_watermark(store, "riders", "2023-12-01T00:00:00Z")

    def one_more_reported(table, totals):
        """A provider that reports one delivery more than it sent."""
        more = F.col("distinct_delivery_count") + 1
        return plan.reconcile_feed(table, totals.withColumn("distinct_delivery_count", more))

    try:
        plan.ingest_pages(store, path, "riders", reconcile=one_more_reported)
    except plan.FeedReconciliationFailed:
        pass
    rows = [("failed run", plan.read_watermark(store, "riders"))]
    rows.append(("good run", plan.ingest_pages(store, path, "riders")))
    return spark.createDataFrame(rows, "run string, watermark string")


_CHUNKS = """SELECT s AS chunk_start, least(s + INTERVAL 60 MINUTE, TIMESTAMP '2024-01-20') AS chunk_end, count(ts) AS records
       FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-09 23:50:00', TIMESTAMP '2024-01-19 23:59:59', INTERVAL 60 MINUTE)) AS s)
       LEFT JOIN events ON ts >= s AND ts < least(s + INTERVAL 60 MINUTE, TIMESTAMP '2024-01-20') GROUP BY s"""
REPLAYED = dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 20)


def _per_chunk(spark, found):
    per_chunk = plan.in_chunks(found, *REPLAYED).groupBy("chunk_start").agg(F.count("*").alias("_records"))
    planned = spark.range(1).select(F.inline(plan.interval_plan(*[utc_literal(t) for t in REPLAYED])))
    return planned.join(per_chunk, "chunk_start", "left").select(
        "chunk_start", "chunk_end", F.coalesce("_records", F.lit(0)).alias("records")
    )


@query("inc8_replay_chunks", _CHUNKS)
def chunks(spark, sf):
    return _per_chunk(spark, records(spark, sf))


@query("inc8_replay_pages", _CHUNKS)
def replayed(spark, sf):
    """The same of pages that a run has taken in: only files whose zone meets the interval are read."""
    store, path = _own_store(spark, sf, "replay"), pages_path(spark, sf)
    plan.ingest_pages(store, path, "riders")
    return _per_chunk(spark, plan.replay_records(store, path, "riders", *REPLAYED))


@query(
    "inc10_late_updates_win",
    """SELECT l.delivery_id, f.created_at, l.updated_at, l.delivery_fee FROM feed_latest l JOIN feed_table f USING (delivery_id)
       WHERE l.updated_at - f.created_at > INTERVAL 5 DAY""",
)
def late(spark, sf):
    table = loaded_twice(spark, sf)
    age = F.timestamp_diff("SECOND", F.col("created_at"), F.col("updated_at"))
    return table.where(age > 5 * 86400).select("delivery_id", "created_at", "updated_at", "delivery_fee")


@query(
    "inc11_provider_summary",
    f"""WITH kept AS (SELECT * FROM feed_records WHERE updated_at > '{mapping.FEED_CUT}'),
             newest AS (SELECT k.* FROM kept k JOIN (SELECT delivery_id, max(updated_at) AS at FROM kept GROUP BY 1) m
                        ON m.delivery_id = k.delivery_id AND m.at = k.updated_at)
        SELECT (SELECT count(*) FROM kept) AS source_record_count, count(*) AS distinct_delivery_count,
               count(*) FILTER (delivery_status = 'delivered') AS delivered_count,
               count(*) FILTER (delivery_status = 'failed') AS failed_count,
               count(*) FILTER (delivery_status = 'cancelled') AS cancelled_count,
               CAST(sum(delivery_fee) AS BIGINT) AS total_delivery_fees,
               (SELECT min(updated_at) FROM kept) AS minimum_updated_at,
               (SELECT max(updated_at) FROM kept) AS maximum_updated_at FROM newest""",
)
def summary(spark, sf):
    return plan.provider_summary(records(spark, sf), updated_after=CUT).drop(
        "delivery_count_by_brand", "delivery_count_by_store"
    )


@query(
    "agg10_counts_by_brand",
    "SELECT brand AS entry, count(*) AS deliveries FROM feed_latest WHERE brand IS NOT NULL GROUP BY 1",
)
def by_brand(spark, sf):
    """The map of the summary, one row per entry."""
    one = plan.provider_summary(records(spark, sf))
    return one.select(F.explode("delivery_count_by_brand").alias("entry", "deliveries"))


@query(
    "agg10_counts_by_store",
    "SELECT store_id AS entry, count(*) AS deliveries FROM feed_latest GROUP BY 1",
)
def by_store(spark, sf):
    one = plan.provider_summary(records(spark, sf))
    return one.select(F.explode("delivery_count_by_store").alias("entry", "deliveries"))


_AS_DELIVERIES = """SELECT order_id, store_id, assigned_at AS order_ts,
       date_diff('minute', date_trunc('minute', assigned_at), date_trunc('minute', promised_delivery_at)) AS promised_delivery_minutes,
       date_diff('minute', date_trunc('minute', assigned_at), date_trunc('minute', delivered_at)) AS actual_delivery_minutes
       FROM feed_records"""


@query(
    "inc12_as_deliveries",
    f"SELECT *, CAST(actual_delivery_minutes <= promised_delivery_minutes AS BIGINT) AS delivered_within_sla FROM ({_AS_DELIVERIES})",
)
def normalised(spark, sf):
    return plan.as_deliveries(records(spark, sf))


@query(
    "inc13_feed_violations",
    f"""SELECT 'unknown_brand' AS rule, delivery_id, order_id, updated_at FROM feed_records
        WHERE brand NOT IN ('Harbour Grill', 'Corner Bakery', 'Noodle Stop')
        UNION ALL SELECT 'future_updated_at', delivery_id, order_id, updated_at FROM feed_records WHERE updated_at > '{NOW}'
        UNION ALL SELECT 'negative_delivery_fee', delivery_id, order_id, updated_at FROM feed_records WHERE delivery_fee < 0
        UNION ALL SELECT 'negative_distance', delivery_id, order_id, updated_at FROM feed_records WHERE distance_km < 0
        UNION ALL SELECT 'null_delivery_id', delivery_id, order_id, updated_at FROM feed_records WHERE delivery_id IS NULL""",
)
def invalid(spark, sf):
    return plan.violations(records(spark, sf), mapping.BRANDS, NOW)


@query(
    "rec16_feed_differences",
    """WITH l AS (SELECT delivery_id, CAST(substr(delivery_id, 2) AS BIGINT) AS n FROM feed_latest)
       SELECT delivery_id, 'missing there' AS difference FROM l WHERE n % 10 = 0
       UNION ALL SELECT delivery_id, 'differs' FROM l WHERE n % 10 <> 0 AND n % 11 = 0
       UNION ALL SELECT 'X' || n, 'missing here' FROM l WHERE n % 7 = 0""",
)
def differing(spark, sf):
    """A provider that lists some deliveries of its own, leaves some out and has other fees."""
    table = plan.delivery_table(_own_store(spark, sf, "differences"))
    ours = plan.latest_records(records(spark, sf))
    table.upsert(ours.select(*FEED_TABLE_COLUMNS), FEED_UPDATES, version="updated_at")
    n = F.substring("delivery_id", 2, 20).cast("bigint")
    listed = ours.where(n % 10 != 0).withColumn("delivery_fee", F.when(n % 11 == 0, F.col("delivery_fee") + 1).otherwise(F.col("delivery_fee")))
    own = ours.where(n % 7 == 0).withColumn("delivery_id", F.concat(F.lit("X"), n.cast("string")))
    return table.differences(listed.unionByName(own), FEED_UPDATES)


@query(
    "rec16_feed_reconciliation",
    """SELECT 'distinct_delivery_count' AS metric, CAST(count(*) AS DOUBLE) AS source_value,
              CAST(count(*) AS DOUBLE) AS target_value, 'PASS' AS status FROM feed_latest
       UNION ALL SELECT 'total_delivery_fees', CAST(sum(delivery_fee) AS DOUBLE), CAST(sum(delivery_fee) AS DOUBLE), 'PASS' FROM feed_latest""",
)
def reconciled(spark, sf):
    return plan.reconcile_feed(loaded_twice(spark, sf), plan.provider_summary(records(spark, sf)))


@query(
    "flt7_optional_filters",
    f"""SELECT * FROM feed_records WHERE updated_at > '{mapping.FEED_CUT}' AND updated_at <= '{NOW}'
        AND brand = 'Corner Bakery' AND store_id = 'S6' AND city = 'City 1' AND delivery_status = 'purchase'""",
)
def filtered(spark, sf):
    return matching(
        records(spark, sf), CUT, NOW, "Corner Bakery", "S6", "City 1", "purchase"
    )


_PAGE = "SELECT * FROM feed_records WHERE updated_at > '2024-01-16' ORDER BY updated_at, delivery_id"


@query(
    "srt3_page",
    f"SELECT *, (SELECT count(*) FROM ({_PAGE}) WHERE (updated_at, delivery_id) > (SELECT (updated_at, delivery_id) FROM ({_PAGE}) LIMIT 1 OFFSET 99)) > 100 AS has_more "
    f"FROM ({_PAGE}) LIMIT 100 OFFSET 100",
)
def second_page(spark, sf):
    """The page after the first hundred."""
    rest = matching(records(spark, sf), updated_after=CUT)
    return page(rest, 100, after=next_cursor(page(rest, 100)))


@query("srt4_latest_version", "SELECT * FROM feed_latest WHERE delivery_id = 'D7'")
def newest_of_one(spark, sf):
    return latest_version(records(spark, sf), "D7")


_RENAMED = """SELECT delivery_id, order_id, CASE brand WHEN 'Legacy Grill' THEN 'Harbour Grill' ELSE brand END AS brand
              FROM feed_records"""


@query("fn19_remap", _RENAMED)
def renamed(spark, sf):
    rows = records(spark, sf)
    return rows.select("delivery_id", "order_id", remap(F.col("brand"), mapping.BRAND_RENAMES).alias("brand"))


@query("fn19_remap_from_table", _RENAMED)
def renamed_from(spark, sf):
    renames = spark.createDataFrame(list(mapping.BRAND_RENAMES.items()), "old_value string, new_value string")
    return remap_from(records(spark, sf).select("delivery_id", "order_id", "brand"), "brand", renames)
