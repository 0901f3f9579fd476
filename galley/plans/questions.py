"""Business questions over the report views and facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from galley.functions import exact_ratio
from galley.operators.joins import lookup
from galley.operators.latest import latest_per_key
from galley.operators.quantiles import exact_quantiles


def _money(column: str) -> Column:
    return F.sum(F.col(column).cast("decimal(28,4)"))


def revenue_by(sales: DataFrame, *columns: str) -> DataFrame:
    """Orders, revenue and average order value of the sales view, by any of its columns."""
    summed = sales.groupBy(*columns).agg(
        F.sum("order_count").alias("order_count"), _money("total_revenue").alias("_revenue")
    )
    return summed.select(
        *columns,
        "order_count",
        F.col("_revenue").cast("double").alias("total_revenue"),
        exact_ratio(F.col("_revenue"), F.col("order_count"), 2).alias("avg_order_value"),
    )


def daily_revenue(sales: DataFrame) -> DataFrame:
    return revenue_by(sales, "full_date")


def channel_revenue(sales: DataFrame) -> DataFrame:
    return revenue_by(sales, "channel")


def best_stores(sales: DataFrame, limit: int = 10) -> DataFrame:
    ranked = revenue_by(sales, "store_id")
    return ranked.orderBy(F.col("total_revenue").desc_nulls_last(), "store_id").limit(limit)


def best_brands(records: DataFrame) -> DataFrame:
    """Deliveries and fees per brand, from the latest state of the provider feed."""
    newest = latest_per_key(records, ["delivery_id"], ["updated_at", "order_id"])
    return newest.groupBy("brand").agg(
        F.count("*").alias("deliveries"), F.sum("delivery_fee").alias("delivery_fees")
    )


def promo_effect(orders: DataFrame, promos: DataFrame) -> DataFrame:
    """Orders, discount and order value per promotion; no promotion is a row of its own."""
    summed = orders.groupBy("promo_sk").agg(
        F.count("*").alias("order_count"),
        F.sum("discount_ngn").alias("_discount"),
        F.sum("subtotal_ngn").alias("_subtotal"),
    )
    named = lookup(summed, promos, ["promo_sk"], "inner")
    return named.select(
        "promo_code",
        "is_promo",
        "order_count",
        F.col("_discount").cast("double").alias("total_discount"),
        exact_ratio(F.col("_subtotal"), F.col("order_count"), 2).alias("avg_order_value"),
    )


def best_customers(summary: DataFrame, limit: int = 10) -> DataFrame:
    ranked = summary.orderBy(F.col("lifetime_revenue").desc_nulls_last(), "customer_id")
    return ranked.select("customer_id", "lifetime_order_count", "lifetime_revenue").limit(limit)


def purchase_frequency(summary: DataFrame) -> DataFrame:
    """Orders per customer and the mean gap between them in days.

    The gaps of a customer add up to the span from first to last order, so no order has
    to be compared with the one before.
    """
    span = F.timestamp_diff("SECOND", F.col("first_order_at"), F.col("most_recent_order_at"))
    gaps = F.nullif(F.col("lifetime_order_count") - 1, F.lit(0))
    return summary.select(
        "customer_id",
        "lifetime_order_count",
        "first_order_at",
        "most_recent_order_at",
        exact_ratio(span, gaps * 86400, 2).alias("mean_gap_days"),
    )


def frequency_distribution(summary: DataFrame) -> DataFrame:
    """How many customers placed how many orders."""
    return summary.groupBy("lifetime_order_count").agg(F.count("*").alias("customers"))


def spend_quantiles(
    summary: DataFrame, percents: Sequence[int] = (25, 50, 75, 90)
) -> DataFrame:
    """Exact spend percentiles: the spend of the customer at each rank, found by narrowing ranges."""
    return exact_quantiles(summary, "lifetime_revenue", percents, "spend")


def channel_mix(sales: DataFrame, customers: DataFrame, channels: DataFrame) -> DataFrame:
    """Orders and revenue per customer and channel."""
    known = sales.where(F.col("customer_sk").isNotNull() & F.col("channel_sk").isNotNull())
    summed = known.groupBy("customer_sk", "channel_sk").agg(
        F.count("order_id").alias("order_count"),
        F.sum("order_revenue").cast("double").alias("revenue"),
    )
    named = lookup(summed, channels, ["channel_sk"], "inner")
    # a row per channel is left of every customer, so no key is hot here
    ids = customers.select("customer_sk", "customer_id")
    return named.join(ids, "customer_sk").select("customer_id", "channel", "order_count", "revenue")


def best_products(products: DataFrame, limit: int = 10) -> DataFrame:
    ranked = _product_totals(products, "product_id", "category")
    return ranked.orderBy(F.col("product_revenue").desc_nulls_last(), "product_id").limit(limit)


def best_categories(products: DataFrame) -> DataFrame:
    return _product_totals(products, "category")


def _product_totals(products: DataFrame, *columns: str) -> DataFrame:
    return products.groupBy(*columns).agg(
        F.sum("units_sold").alias("units_sold"),
        _money("product_revenue").cast("double").alias("product_revenue"),
    )


def declining_products(products: DataFrame) -> DataFrame:
    """Months in which a product earned less than in its previous month with sales.

    ``lag`` runs over one row per product and month.
    """
    monthly = products.groupBy("product_id", "year", "month").agg(
        _money("product_revenue").alias("_revenue")
    )
    before = F.lag("_revenue").over(W.partitionBy("product_id").orderBy("year", "month"))
    return (
        monthly.withColumn("_before", before)
        .where(F.col("_revenue") < F.col("_before"))
        .select(
            "product_id",
            "year",
            "month",
            F.col("_revenue").cast("double").alias("revenue"),
            F.col("_before").cast("double").alias("previous_revenue"),
        )
    )


def store_delays(deliveries: DataFrame, stores: DataFrame) -> DataFrame:
    """SLA compliance and mean delay per store."""
    summed = deliveries.where(F.col("store_sk").isNotNull()).groupBy("store_sk").agg(
        F.count("*").alias("_n"),
        F.sum("delivery_sla_met_flag").alias("_met"),
        F.sum("delay_minutes").alias("_delay"),
        F.count("delay_minutes").alias("_delay_n"),
    )
    named = lookup(summed, stores.select("store_sk", "store_id"), ["store_sk"], "inner")
    per_store = named.groupBy("store_id").agg(
        F.sum("_n").alias("delivery_count"),
        F.sum("_met").alias("sla_met_count"),
        F.sum("_delay").alias("_delay"),
        F.sum("_delay_n").alias("_delay_n"),
    )
    return per_store.select(
        "store_id",
        "delivery_count",
        "sla_met_count",
        exact_ratio(F.col("sla_met_count") * 100, F.col("delivery_count"), 1).alias("sla_compliance_pct"),
        exact_ratio(F.col("_delay"), F.col("_delay_n"), 1).alias("avg_delay_minutes"),
    )
