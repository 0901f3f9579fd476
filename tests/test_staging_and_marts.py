"""Staging and marts on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from galley.plans import marts, staging, views

ORDER = (
    "order_id string, order_ts timestamp_ntz, store_id string, customer_id string, channel string, "
    "payment_method string, promo_code string, items_count bigint, qty_total bigint, subtotal_ngn double, "
    "discount_ngn double, tax_ngn double, delivery_fee_ngn bigint, total_amount_ngn double, "
    "_source_file string, _loaded_at timestamp_ntz, _batch_id string"
)
LOAD = dt.datetime(2024, 5, 1)


def order(order_id, at, customer="c1", store="s1", promo=None, loaded=LOAD, subtotal=100.0):
    return (
        order_id, at, store, customer, "Delivery", "Card", promo, 1, 1, subtotal, 0.0, 0.0, 0, subtotal,
        "orders.json", loaded, "b",
    )


def at(day, hour=12):
    return dt.datetime(2024, 3, day, hour)


@pytest.fixture
def staged(spark):
    raw = spark.createDataFrame(
        [
            order("o1", at(2), promo=""),
            order("o2", at(1), promo="X", subtotal=1.0),
            order("o2", at(1), promo="X", subtotal=2.5, loaded=dt.datetime(2024, 5, 2)),
            order("o3", at(1)),
            order("o4", None, customer="c2"),
            order("o5", at(3), customer="c2"),
            order(None, at(4), customer="c3"),
            order(None, at(5), customer="c3", loaded=dt.datetime(2024, 5, 3)),
            order("o6", at(6), customer=None),
            order("o7", at(5), customer=None),
        ],
        ORDER,
    )
    return staging.int_orders(raw, "batch")


def test_first_orders_by_time_then_id_with_nulls_last(staged):
    flags = {r["order_id"]: r["new_vs_returning_customer_flag"] for r in staged.collect()}
    assert flags == {
        "o1": "Returning", "o2": "New", "o3": "Returning", "o4": "Returning", "o5": "New",
        None: "New", "o6": "Returning", "o7": "New",
    }


def test_later_load_wins_and_null_ids_fall_together(staged):
    assert staged.where("order_id = 'o2'").first()["subtotal_ngn"] == 2.5
    assert staged.where("order_id IS NULL").count() == 1
    assert {r["order_id"]: r["promo_flag"] for r in staged.collect()}["o1"] == 0


def test_orders_of_a_customer_never_meet_in_one_window(staged):
    plan = staged._jdf.queryExecution().executedPlan().toString()
    # the window over versions ran once, before the deduplicated orders were stored
    assert "windowspecdefinition(" not in plan and "FileScan parquet" in plan


def test_calendar_parts(staged):
    row = staged.where("order_id = 'o5'").first()  # Sunday 3 March 2024
    parts = [row[c] for c in ("order_year", "order_month", "order_week", "order_day_of_week", "order_hour")]
    assert parts == [2024, 3, 9, 0, 12]


def test_new_columns_of_a_source_are_kept_and_load_date_is_not(spark):
    raw = spark.createDataFrame(
        [("s1", " Lagos ", 40, LOAD, "f", "b", "2024-05-01")],
        "store_id string, city string, seats int, _loaded_at timestamp_ntz, _source_file string, _batch_id string, load_date string",
    )
    row = staging.int_stores(raw, "now").first().asDict()
    assert row["clean_city"] == "Lagos" and row["seats"] == 40 and row["_batch_id"] == "now"
    assert "load_date" not in row


def test_no_orders_give_no_days(staged):
    assert marts.dim_date(staged.where("false")).count() == 0


def test_promo_dimension_has_the_sentinel(staged):
    found = [tuple(r) for r in marts.dim_promo(staged).orderBy("promo_sk").collect()]
    assert found == [(0, None, False), (1, "X", True)]


def test_order_without_lines_keeps_zero_items_and_no_revenue(spark, staged):
    facts = staged.select(
        "order_id", F.to_date("order_timestamp").alias("date_sk"), F.lit(1).alias("store_sk"), F.lit(1).alias("channel_sk")
    )
    items = spark.createDataFrame(
        [("o1", 1, 2.5), ("o1", None, 1.0)], "order_id string, product_sk int, product_revenue double"
    )
    found = {r["order_id"]: (r["items_per_order"], r["order_revenue"]) for r in marts.rpt_order_summary(facts, items).collect()}
    assert found["o1"] == (1, 3.5) and found["o2"] == (0, None) and found[None] == (0, None)


def test_reports_leave_out_unresolved_keys(spark):
    days = spark.createDataFrame([(dt.date(2024, 3, 1), dt.date(2024, 3, 1), 2024, 3)], "date_sk date, full_date date, year int, month int")
    places = spark.createDataFrame([(1, "s1", "Lagos")], "store_sk bigint, store_id string, clean_city string")
    sent = spark.createDataFrame(
        [("o1", 1, dt.date(2024, 3, 1), 30, 31, 1, 0), ("o2", None, dt.date(2024, 3, 1), 30, 20, -10, 1), ("o3", 1, dt.date(2024, 3, 1), 30, 26, -4, 1)],
        "order_id string, store_sk bigint, date_sk date, promised_delivery_minutes bigint, "
        "actual_delivery_minutes bigint, delay_minutes bigint, delivery_sla_met_flag bigint",
    )
    row = views.vw_delivery_performance(sent, days, places).first()
    assert (row["delivery_count"], row["sla_met_count"], row["sla_compliance_pct"]) == (2, 1, 50.0)
    assert (row["avg_delivery_minutes"], row["avg_delay_minutes"]) == (28.5, -1.5)
