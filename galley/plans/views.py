"""Report views over the marts. None of them stores anything.

Facts are summed by their surrogate keys first and named afterwards, so only the summed
rows meet the dimensions. A surrogate key has one name, and on one day a store has one
version, so no second grouping is needed. ``sales`` is ``marts.order_sales``, which holds
an order once; counting orders therefore needs no distinct.

Each view is its sums and their names, so that sums may be stored by month and only the
months that have changed are summed again (`plans.refresh`).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galley.functions import exact_ratio
from galley.operators.joins import lookup


def _resolved(facts: DataFrame, *keys: str) -> DataFrame:
    """Facts whose keys are known; the others appear in the audit, not in reports."""
    return facts.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))


def _named_store(summed: DataFrame, stores: DataFrame) -> DataFrame:
    names = stores.select("store_sk", "store_id", F.col("clean_city").alias("city"))
    return lookup(summed, names, ["store_sk"], "inner")


def _named_day(summed: DataFrame, dates: DataFrame, *parts: str) -> DataFrame:
    return lookup(summed, dates.select("date_sk", "full_date", *parts), ["date_sk"], "inner")


def sales_sums(sales: DataFrame) -> DataFrame:
    """Orders, revenue and items per day, store and channel, by key."""
    keys = ["date_sk", "store_sk", "channel_sk"]
    customer = F.col("new_vs_returning_customer_flag")
    return _resolved(sales, *keys).groupBy(*keys).agg(
        F.count("order_id").alias("order_count"),
        F.sum("order_revenue").alias("_revenue"),
        F.sum("items_per_order").alias("total_items"),
        F.count_if(F.col("promo_flag") == 1).alias("promo_order_count"),
        F.count_if(customer == "New").alias("new_customer_orders"),
        F.count_if(customer == "Returning").alias("returning_customer_orders"),
    )


def vw_sales_performance(
    sales: DataFrame, dates: DataFrame, stores: DataFrame, channels: DataFrame
) -> DataFrame:
    """Sales per day, store and channel. Orders with an unresolved key are left out."""
    return named_sales(sales_sums(sales), dates, stores, channels)


def named_sales(
    summed: DataFrame, dates: DataFrame, stores: DataFrame, channels: DataFrame
) -> DataFrame:
    named = _named_day(summed, dates, "year", "month", "week", "day_name", "is_weekend")
    named = lookup(_named_store(named, stores), channels, ["channel_sk"], "inner")
    orders_n = F.col("order_count")
    return named.select(
        "full_date",
        "year",
        "month",
        "week",
        "day_name",
        "is_weekend",
        "store_id",
        "city",
        "channel",
        "order_count",
        F.col("_revenue").cast("double").alias("total_revenue"),
        exact_ratio(F.col("_revenue"), orders_n, 2).alias("avg_order_value"),
        "total_items",
        exact_ratio(F.col("total_items"), orders_n, 2).alias("avg_items_per_order"),
        "promo_order_count",
        "new_customer_orders",
        "returning_customer_orders",
    )


def delivery_sums(deliveries: DataFrame) -> DataFrame:
    """Deliveries and minutes per day and store, by key."""
    keys = ["date_sk", "store_sk"]
    actual, delay = "actual_delivery_minutes", "delay_minutes"
    return _resolved(deliveries, *keys).groupBy(*keys).agg(
        F.count("*").alias("delivery_count"),
        F.sum("delivery_sla_met_flag").alias("sla_met_count"),
        F.sum(actual).alias("_actual"),
        F.count(actual).alias("_actual_n"),
        F.sum(delay).alias("_delay"),
        F.count(delay).alias("_delay_n"),
    )


def vw_delivery_performance(
    deliveries: DataFrame, dates: DataFrame, stores: DataFrame
) -> DataFrame:
    """Deliveries per day and store."""
    return named_deliveries(delivery_sums(deliveries), dates, stores)


def named_deliveries(summed: DataFrame, dates: DataFrame, stores: DataFrame) -> DataFrame:
    named = _named_store(_named_day(summed, dates, "year", "month"), stores)
    met = F.col("sla_met_count")
    return named.select(
        "full_date",
        "year",
        "month",
        "store_id",
        "city",
        "delivery_count",
        "sla_met_count",
        exact_ratio(met * 100, F.col("delivery_count"), 1).alias("sla_compliance_pct"),
        exact_ratio(F.col("_actual"), F.col("_actual_n"), 1).alias("avg_delivery_minutes"),
        exact_ratio(F.col("_delay"), F.col("_delay_n"), 1).alias("avg_delay_minutes"),
    )


def product_sums(items: DataFrame) -> DataFrame:
    """Units and revenue per day, store, channel and product, by key."""
    keys = ["date_sk", "store_sk", "channel_sk", "product_sk"]
    return _resolved(items, *keys).groupBy(*keys).agg(
        F.sum("quantity").alias("units_sold"), F.sum("product_revenue").alias("_revenue")
    )


def vw_product_performance(
    items: DataFrame, dates: DataFrame, stores: DataFrame, channels: DataFrame, products: DataFrame
) -> DataFrame:
    """Units and revenue per day, store, channel and product, at line grain."""
    return named_products(product_sums(items), dates, stores, channels, products)


def named_products(
    summed: DataFrame, dates: DataFrame, stores: DataFrame, channels: DataFrame, products: DataFrame
) -> DataFrame:
    named = _named_store(_named_day(summed, dates, "year", "month"), stores)
    named = lookup(named, channels, ["channel_sk"], "inner")
    goods = products.select(
        "product_sk", "product_id", F.col("unified_category").alias("category")
    )
    return lookup(named, goods, ["product_sk"], "inner").select(
        "full_date",
        "year",
        "month",
        "store_id",
        "city",
        "channel",
        "product_id",
        "category",
        "units_sold",
        F.col("_revenue").cast("double").alias("product_revenue"),
    )


def customer_sums(sales: DataFrame, *by: str) -> DataFrame:
    """Orders, revenue and times per customer and type (and ``by``), by key.

    By type, as the text maximum is then taken over few rows per customer and the pass over
    all orders stays a hash aggregation.
    """
    return _resolved(sales, "customer_sk").groupBy("customer_sk", "customer_type", *by).agg(
        F.count("order_id").alias("_orders"),
        F.sum("order_revenue").alias("_revenue"),
        F.min("order_timestamp").alias("_first"),
        F.max("order_timestamp").alias("_last"),
    )


def vw_customer_summary(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Lifetime totals per customer. The type is the alphabetically last one."""
    return named_customers(customer_sums(sales), customers)


def named_customers(summed: DataFrame, customers: DataFrame) -> DataFrame:
    totals = summed.groupBy("customer_sk").agg(
        F.sum("_orders").alias("lifetime_order_count"),
        F.sum("_revenue").cast("double").alias("lifetime_revenue"),
        F.min("_first").alias("first_order_at"),
        F.max("_last").alias("most_recent_order_at"),
        F.max("customer_type").alias("latest_customer_type"),
    )
    named = customers.select(F.col("customer_sk").alias("_sk"), "customer_id")
    return totals.join(named, F.col("customer_sk") == F.col("_sk")).select(
        "customer_id",
        "lifetime_order_count",
        "lifetime_revenue",
        "first_order_at",
        "most_recent_order_at",
        "latest_customer_type",
    )
