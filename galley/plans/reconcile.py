"""Source-to-report reconciliation."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galley.functions import blank_to_null
from galley.operators.durable import pin
from galley.operators.joins import full_compare, lookup
from galley.operators.together import together
from galley.plans.quality import AuditRun

NO_PROMO = "NO_PROMO"
UNKNOWN = "UNKNOWN"


def _total(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0)).cast("double").alias(column)


def _overall(source: DataFrame, report: DataFrame, metrics: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Rows for totals; ``metrics`` maps a metric to its columns in the two frames."""

    def side(df: DataFrame, which: int, name: str) -> DataFrame:
        columns = {m: pair[which] for m, pair in metrics.items()}
        one = df.agg(*[_total(c) for c in dict.fromkeys(columns.values())])
        pairs = [F.struct(F.lit(m).alias("metric"), F.col(c).alias(name)) for m, c in columns.items()]
        return one.select(F.inline(F.array(*pairs)))

    both = side(source, 0, "source_value").join(side(report, 1, "reporting_value"), "metric")
    return both.select(
        F.lit("overall").alias("reconciliation_level"),
        "metric",
        F.lit("ALL").alias("dimension_key"),
        "source_value",
        "reporting_value",
    )


def _by_key(
    source: DataFrame, report: DataFrame, level: str, key: str, metrics: Mapping[str, str]
) -> DataFrame:
    """Rows per key; ``metrics`` maps a metric to the column both frames have it in."""
    columns = list(metrics.values())
    summed = [df.groupBy(key).agg(*[_total(c) for c in columns]) for df in (source, report)]
    compared = full_compare(*summed, key, columns)
    rows = [
        F.struct(
            F.lit(metric).alias("metric"),
            F.col(f"source_{c}").alias("source_value"),
            F.col(f"report_{c}").alias("reporting_value"),
        )
        for metric, c in metrics.items()
    ]
    return compared.select(
        F.lit(level).alias("reconciliation_level"),
        F.coalesce(F.col(key), F.lit(UNKNOWN)).alias("dimension_key"),
        F.inline(F.array(*rows)),
    ).select("reconciliation_level", "metric", "dimension_key", "source_value", "reporting_value")


def reconciliation(tables: Mapping[str, DataFrame], run: AuditRun) -> DataFrame:
    """Compare staged sources with facts: totals, and by store, channel, product and promo.

    Each table is summed once by all the keys it is compared on, and the sums are pinned;
    the comparisons roll them up, so no table is read once per metric.
    """
    t = tables
    promo = F.coalesce(blank_to_null(F.col("promo_code")), F.lit(NO_PROMO))
    stores = t["dim_store"].select("store_sk", "store_id")

    def placed() -> DataFrame:
        return t["int_orders"].groupBy("store_id", "channel", promo.alias("promo_key")).agg(
            F.count("*").alias("orders"),
            F.sum("subtotal_ngn").alias("revenue"),
            F.count_if(blank_to_null(F.col("promo_code")).isNotNull()).alias("promo_orders"),
        )

    def sold() -> DataFrame:
        sales = t["order_sales"]
        summed = sales.groupBy("store_sk", "channel_sk", "promo_sk").agg(
            F.count("*").alias("orders"),
            F.sum("order_revenue").alias("revenue"),
            F.sum("promo_flag").alias("promo_orders"),
        )
        promos = t["dim_promo"].select("promo_sk", "promo_code")
        named = lookup(summed, stores, ["store_sk"])
        named = lookup(named, t["dim_channel"], ["channel_sk"])
        named = lookup(named, promos, ["promo_sk"])
        return named.withColumn("promo_key", F.coalesce("promo_code", F.lit(NO_PROMO)))

    def lines(name: str) -> DataFrame:
        return t[name].groupBy("product_id").agg(
            F.count("*").alias("lines"), F.sum("product_revenue").alias("revenue")
        )

    def drops(name: str, key: str) -> DataFrame:
        return t[name].groupBy(key).agg(
            F.count("*").alias("deliveries"), F.sum("delivery_sla_met_flag").alias("met")
        )

    sums = {
        "placed": placed,
        "sold": sold,
        "items": lambda: lines("int_order_items"),
        "item_facts": lambda: lines("fact_order_items"),
        "sent": lambda: drops("int_deliveries", "store_id"),
        "reported": lambda: lookup(drops("fact_deliveries", "store_sk"), stores, ["store_sk"]),
    }
    pinned = together({name: lambda build=build: pin(build()) for name, build in sums.items()})
    placed, sold, items, item_facts, sent, reported = (pinned[name] for name in sums)
    order_metrics = {"orders_count": "orders", "order_subtotal_ngn": "revenue"}
    rows = [
        _overall(
            placed,
            sold,
            {
                "orders_count": ("orders", "orders"),
                "order_subtotal_ngn": ("revenue", "revenue"),
                "promo_order_count": ("promo_orders", "promo_orders"),
            },
        ),
        _overall(
            items,
            item_facts,
            {"order_items_count": ("lines", "lines"), "product_revenue_ngn": ("revenue", "revenue")},
        ),
        _overall(
            sent,
            reported,
            {"deliveries_count": ("deliveries", "deliveries"), "delivery_sla_met_count": ("met", "met")},
        ),
        _by_key(placed, sold, "store", "store_id", order_metrics),
        _by_key(placed, sold, "channel", "channel", order_metrics),
        _by_key(items, item_facts, "product", "product_id", {"product_revenue_ngn": "revenue"}),
        _by_key(placed, sold, "promo", "promo_key", {"orders_count": "orders"}),
        _by_key(sent, reported, "delivery_store", "store_id", {"deliveries_count": "deliveries"}),
    ]
    variance = F.col("reporting_value") - F.col("source_value")
    return reduce(DataFrame.union, rows).select(
        F.lit(run.run_id).alias("run_id"),
        F.lit(run.execution_date).alias("execution_date"),
        F.current_timestamp().alias("reconciled_at"),
        "reconciliation_level",
        "metric",
        "dimension_key",
        "source_value",
        "reporting_value",
        variance.alias("variance"),
        F.when(F.abs(variance) < 0.01, "PASS").otherwise("FAIL").alias("status"),
    )
