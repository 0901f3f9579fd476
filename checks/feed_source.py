"""The mapped provider feed, landed once per test folder, and its oracle tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from checks import mapping
from checks.lake import lake
from checks.oracle_tables import TABLES
from galley.plans.feed import apply_records, empty_table
from galley.sources.feed_pages import flatten, land_pages, pages_glob, read_pages

PROVIDER, SOURCE, LANDED = "riders", "deliveries", "2024-02-01"

_LANDED: dict[str, str] = {}


def landed_root(spark, sf) -> str:
    store = lake(spark, sf).store
    if store.root not in _LANDED:
        root = store.path("landing", "pages")
        _LANDED[store.root] = land_pages(mapping.feed_pages(spark, sf), root, PROVIDER, SOURCE, LANDED, pages_per_file=250)
    return _LANDED[store.root]


def pages_path(spark, sf) -> str:
    return pages_glob(landed_root(spark, sf), PROVIDER)


def records(spark, sf) -> DataFrame:
    return flatten(read_pages(spark, pages_path(spark, sf)))


def loaded_twice(spark, sf) -> DataFrame:
    """The delivery table after the records up to the cut, and then all of them."""
    everything = records(spark, sf)
    first = apply_records(
        empty_table(everything), everything.where(f"updated_at < TIMESTAMP_NTZ '{mapping.FEED_CUT}'")
    )
    return apply_records(first, everything)


_brands = ", ".join("'" + b + "'" for b in (*mapping.BRANDS, "Legacy Grill", "Unlisted Diner"))
TABLES["feed_records"] = f"""
    SELECT 'D' || user_id AS delivery_id, 'O' || event_id AS order_id,
           ([{_brands}])[1 + (user_id % 20) % 5] AS brand,
           'S' || (user_id % 20) AS store_id, 'Store ' || (user_id % 20) AS store_name,
           'City ' || (user_id % 5) AS city, 'Rider Co' AS delivery_partner,
           event_type AS delivery_status, ts - INTERVAL 60 MINUTE AS assigned_at,
           NULL::TIMESTAMP AS picked_up_at,
           ts + to_minutes(-30 + 10 * (k % 3)) AS promised_delivery_at,
           CASE WHEN event_type = 'purchase' THEN ts + to_minutes(k % 60 - 60) END AS delivered_at,
           NULL::TIMESTAMP AS cancelled_at, NULL::VARCHAR AS failure_reason,
           CAST(CAST(value AS DECIMAL(18,2)) * 100 AS INTEGER) AS delivery_fee, value AS distance_km,
           ts - INTERVAL 65 MINUTE AS created_at, ts AS updated_at
    FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events)"""
TABLES["feed_latest"] = """
    SELECT r.* FROM feed_records r JOIN
      (SELECT delivery_id, max(updated_at) AS updated_at FROM feed_records GROUP BY 1) m
      ON m.delivery_id = r.delivery_id AND m.updated_at = r.updated_at"""
TABLES["feed_table"] = f"""
    SELECT f.delivery_id, f.order_id, f.brand, f.store_id, f.store_name, f.city, f.delivery_partner,
           l.delivery_status, l.delivery_fee, f.distance_km, f.created_at, l.updated_at
    FROM feed_latest l JOIN (
        SELECT r.* FROM feed_records r JOIN
          (SELECT delivery_id, ifnull(max(updated_at) FILTER (updated_at < '{mapping.FEED_CUT}'), max(updated_at)) AS at
           FROM feed_records GROUP BY 1) m
          ON m.delivery_id = r.delivery_id AND m.at = r.updated_at) f ON f.delivery_id = l.delivery_id"""
