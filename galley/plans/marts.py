"""Dimensions, facts and the order summary."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galley.functions import (
    blank_to_null,
    day_name,
    day_of_week,
    is_weekend,
    iso_week,
    month_of,
    year_of,
)
from galley.operators.history import covers, first_versions, next_versions
from galley.operators.joins import lookup
from galley.operators.numbering import dense_number

STORE_TRACKED = ("clean_city",)


def dim_date(orders: DataFrame) -> DataFrame:
    """Every day from the first to the last order date."""
    day = F.col("order_timestamp").cast("date")
    span = orders.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    days = span.select(
        F.explode(F.expr("sequence(first, last, interval 1 day)")).alias("full_date")
    )
    d = F.col("full_date")
    return days.select(
        d.alias("date_sk"),
        d,
        year_of(d).alias("year"),
        month_of(d).alias("month"),
        iso_week(d).alias("week"),
        day_of_week(d).alias("day_of_week"),
        day_name(d).alias("day_name"),
        is_weekend(d).alias("is_weekend"),
    )


def dim_customer(customers: DataFrame) -> DataFrame:
    rows = customers.select("customer_id", "signup_date", "city", "phone", "is_business")
    numbered = dense_number(rows, [F.col("customer_id").asc_nulls_last()], "customer_sk")
    return numbered.select("customer_sk", *rows.columns)


def dim_product(products: DataFrame) -> DataFrame:
    rows = products.select("product_id", "product_name", "unified_category", "base_price_ngn")
    numbered = dense_number(rows, [F.col("product_id").asc_nulls_last()], "product_sk")
    return numbered.select("product_sk", *rows.columns)


def _distinct_numbered(orders: DataFrame, column: str, number: str) -> DataFrame:
    values = orders.select(column).where(F.col(column).isNotNull()).distinct()
    return dense_number(values, [F.col(column).asc()], number).select(number, column)


def dim_channel(orders: DataFrame) -> DataFrame:
    return _distinct_numbered(orders, "channel", "channel_sk")


def dim_payment_method(orders: DataFrame) -> DataFrame:
    return _distinct_numbered(orders, "payment_method", "payment_method_sk")


def no_promo_row(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(0, None, False)], "promo_sk bigint, promo_code string, is_promo boolean"
    )


def dim_promo(orders: DataFrame) -> DataFrame:
    """Key 0 stands for no promotion; codes are numbered from 1."""
    codes = orders.withColumn("promo_code", blank_to_null(F.col("promo_code")))
    numbered = _distinct_numbered(codes, "promo_code", "promo_sk")
    return no_promo_row(orders.sparkSession).union(numbered.withColumn("is_promo", F.lit(True)))


def dim_store(stores: DataFrame, previous: DataFrame | None, load_date: dt.date) -> DataFrame:
    """Store versions after this load; ``previous`` is the table so far, if any."""
    if previous is None:
        return first_versions(stores, "store_id", STORE_TRACKED, "store_sk")
    return next_versions(previous, stores, load_date, "store_id", STORE_TRACKED, "store_sk")


def _with_store(facts: DataFrame, stores: DataFrame, source: DataFrame) -> DataFrame:
    """Key of the store version valid on the day of the fact."""
    versions = stores.select("store_id", "store_sk", "effective_from", "effective_to")
    found = lookup(facts, versions, ["store_id"], residual=covers("date_sk"), hot_from=source)
    return found.drop("effective_from", "effective_to")


def fact_orders(
    orders: DataFrame,
    customers: DataFrame,
    stores: DataFrame,
    channels: DataFrame,
    payment_methods: DataFrame,
    promos: DataFrame,
) -> DataFrame:
    facts = orders.withColumn("date_sk", F.col("order_timestamp").cast("date"))
    keys = {
        "customer_id": customers.select("customer_id", "customer_sk"),
        "channel": channels,
        "payment_method": payment_methods,
        "promo_code": promos.select("promo_code", "promo_sk"),
    }
    for key, dimension in keys.items():
        facts = lookup(facts, dimension, [key], hot_from=orders)
    facts = _with_store(facts, stores, orders)
    return facts.select(
        "order_id",
        "customer_sk",
        "store_sk",
        "channel_sk",
        "payment_method_sk",
        F.coalesce("promo_sk", F.lit(0)).cast("bigint").alias("promo_sk"),
        "date_sk",
        "order_timestamp",
        "order_hour",
        "promo_flag",
        "new_vs_returning_customer_flag",
        "customer_type",
        "items_count",
        "qty_total",
        "subtotal_ngn",
        "discount_ngn",
        "tax_ngn",
        "delivery_fee_ngn",
        "total_amount_ngn",
        F.lit(1).alias("order_count"),
        "_source_file",
        "_loaded_at",
        "_batch_id",
    )


def fact_order_items(
    items: DataFrame, products: DataFrame, stores: DataFrame, channels: DataFrame
) -> DataFrame:
    facts = items.withColumn("date_sk", F.col("order_timestamp").cast("date"))
    goods = products.select("product_id", "product_sk")
    facts = lookup(facts, goods, ["product_id"], hot_from=items)
    facts = lookup(facts, channels, ["channel"], hot_from=items)
    facts = _with_store(facts, stores, items)
    return facts.select(
        "order_id",
        "product_id",
        "product_sk",
        "date_sk",
        "store_sk",
        "channel_sk",
        "order_timestamp",
        "promo_flag",
        "quantity",
        "unit_price",
        "product_revenue",
        "_source_file",
        "_loaded_at",
        "_batch_id",
    )


def fact_deliveries(deliveries: DataFrame, stores: DataFrame) -> DataFrame:
    facts = deliveries.withColumn("date_sk", F.col("order_timestamp").cast("date"))
    return _with_store(facts, stores, deliveries).select(
        "order_id",
        "store_sk",
        "date_sk",
        "promised_delivery_minutes",
        "actual_delivery_minutes",
        "delay_minutes",
        "delivery_sla_met_flag",
        "_source_file",
        "_loaded_at",
        "_batch_id",
    )


def line_totals(fact_items: DataFrame) -> DataFrame:
    """Lines and revenue per order, summed before the shuffle."""
    return fact_items.groupBy("order_id").agg(
        F.count("product_sk").alias("_lines"), F.sum("product_revenue").alias("order_revenue")
    )


def rpt_order_summary(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Items and revenue of every order; lines of unknown products do not count as items."""
    totals = line_totals(items).withColumnRenamed("order_id", "_order")
    joined = orders.join(totals, F.col("order_id") == F.col("_order"), "left")
    return joined.select(
        "order_id",
        "date_sk",
        "store_sk",
        "channel_sk",
        F.coalesce("_lines", F.lit(0)).alias("items_per_order"),
        "order_revenue",
    )


def order_sales(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Order facts with their items and revenue, the base of all sales reports.

    Stored once, it saves every report from joining the two fact tables again.
    ``fact_orders`` holds an order once, so the totals of its lines are joined straight to
    it. An order without an id has no totals.
    """
    totals = line_totals(items).withColumnRenamed("order_id", "_order")
    lines = F.when(F.col("order_id").isNotNull(), F.coalesce("_lines", F.lit(0)))
    return orders.join(totals, F.col("order_id") == F.col("_order"), "left").select(
        "order_id",
        "date_sk",
        "order_timestamp",
        "customer_sk",
        "store_sk",
        "channel_sk",
        "promo_sk",
        "promo_flag",
        "new_vs_returning_customer_flag",
        "customer_type",
        lines.alias("items_per_order"),
        "order_revenue",
    )
