"""Staging: the current row of every business record, with derived attributes."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galley.functions import (
    blank_to_null,
    day_of_week,
    hour_of,
    iso_week,
    money,
    month_of,
    whole,
    year_of,
)
from galley.operators.durable import pin
from galley.operators.joins import lookup, may_have_hot_keys
from galley.operators.latest import latest_per_key

# Stands for a missing order id while orders are matched with themselves.
_NO_ID = "\u0000"


def run_batch_id(stage: str, run_date: dt.date | str) -> str:
    """The same id for every attempt of a stage on a run date."""
    return str(uuid.uuid5(uuid.NAMESPACE_URL, f"galley/{stage}/{run_date}"))


def _current(raw: DataFrame, *keys: str) -> DataFrame:
    return latest_per_key(raw.drop("load_date"), keys)


def int_customers(raw: DataFrame, batch_id: str) -> DataFrame:
    return _current(raw, "customer_id").withColumn("_batch_id", F.lit(batch_id))


def int_stores(raw: DataFrame, batch_id: str) -> DataFrame:
    return _current(raw, "store_id").withColumns(
        {"clean_city": F.trim("city"), "_batch_id": F.lit(batch_id)}
    )


def int_products(raw: DataFrame, batch_id: str) -> DataFrame:
    return _current(raw, "product_id").withColumns(
        {
            "unified_category": F.coalesce("category", F.lit("Uncategorized")),
            "_batch_id": F.lit(batch_id),
        }
    )


def opening_orders(orders: DataFrame) -> DataFrame:
    """``_key`` of the first order of every customer, by time and order id, NULLs last.

    The minimum is taken before the shuffle, so a customer with very many orders costs
    no more than one with few.
    """
    place = F.struct(
        F.col("order_ts").isNull().alias("a"),
        F.col("order_ts").alias("b"),
        F.col("order_id").isNull().alias("c"),
        F.col("order_id").alias("d"),
        F.col("_key").alias("key"),
    )
    return orders.groupBy("customer_id").agg(F.min(place).alias("_first")).select(
        F.col("_first.key").alias("_key"), F.lit(True).alias("_opens")
    )


def int_orders(raw: DataFrame, batch_id: str) -> DataFrame:
    keyed = raw.drop("load_date").withColumns(
        {
            "_key": F.coalesce("order_id", F.lit(_NO_ID)),
            "order_ts": F.col("order_ts").cast("timestamp_ntz"),
        }
    )
    # stored, so that the raw loads are read and shuffled once; both sides have a row per _key
    orders = pin(latest_per_key(keyed, ["_key"]))
    flagged = orders.join(opening_orders(orders), "_key", "left")
    when = F.col("order_ts")
    is_first = F.col("_opens").isNotNull()
    has_promo = blank_to_null(F.col("promo_code")).isNotNull()
    return flagged.select(
        "order_id",
        "customer_id",
        "store_id",
        "channel",
        "payment_method",
        "promo_code",
        when.alias("order_timestamp"),
        "items_count",
        "qty_total",
        money(F.col("subtotal_ngn")).alias("subtotal_ngn"),
        money(F.col("discount_ngn")).alias("discount_ngn"),
        money(F.col("tax_ngn")).alias("tax_ngn"),
        "delivery_fee_ngn",
        money(F.col("total_amount_ngn")).alias("total_amount_ngn"),
        year_of(when).alias("order_year"),
        month_of(when).alias("order_month"),
        iso_week(when).alias("order_week"),
        day_of_week(when).alias("order_day_of_week"),
        hour_of(when).alias("order_hour"),
        F.when(has_promo, 1).otherwise(0).cast("bigint").alias("promo_flag"),
        F.when(is_first, "New").otherwise("Returning").alias("new_vs_returning_customer_flag"),
        F.when(is_first, "First-Time Buyer").otherwise("Loyal Customer").alias("customer_type"),
        "_source_file",
        "_loaded_at",
        F.lit(batch_id).alias("_batch_id"),
    )


def int_deliveries(raw: DataFrame, batch_id: str) -> DataFrame:
    return _current(raw, "order_id").select(
        "order_id",
        "store_id",
        F.col("order_ts").cast("timestamp_ntz").alias("order_timestamp"),
        "promised_delivery_minutes",
        "actual_delivery_minutes",
        (F.col("actual_delivery_minutes") - F.col("promised_delivery_minutes")).alias(
            "delay_minutes"
        ),
        F.col("delivered_within_sla").alias("delivery_sla_met_flag"),
        "_source_file",
        "_loaded_at",
        F.lit(batch_id).alias("_batch_id"),
    )


def int_order_items(raw: DataFrame, orders: DataFrame, batch_id: str) -> DataFrame:
    """Current lines with the store, channel, time and promotion flag of their order.

    ``orders`` is the staged order table. Without hot orders the lines are shuffled once, by
    order: their current versions and the join with the orders follow that layout.
    """
    laid_out = raw if may_have_hot_keys(raw, ["order_id"]) else raw.repartition("order_id")
    lines = _current(laid_out, "order_id", "product_id").select(
        "order_id",
        "product_id",
        "product_name",
        "category",
        whole(F.col("qty")).alias("quantity"),
        F.col("unit_price_ngn").alias("unit_price"),
        money(F.col("line_total_ngn")).alias("product_revenue"),
        "_source_file",
        "_loaded_at",
    )
    header = orders.select("order_id", "store_id", "channel", "order_timestamp", "promo_flag")
    return lookup(lines, header, ["order_id"], hot_from=raw).select(
        "order_id",
        "product_id",
        "product_name",
        "category",
        "quantity",
        "unit_price",
        "product_revenue",
        "store_id",
        "channel",
        "order_timestamp",
        "promo_flag",
        "_source_file",
        "_loaded_at",
        F.lit(batch_id).alias("_batch_id"),
    )
