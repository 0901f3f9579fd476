"""Freshness, completeness and variance of what was reported, and the run summary."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from galley.functions import exact_ratio
from galley.plans.quality import exception_summary


def freshness(tables: Mapping[str, DataFrame], run_date: dt.date, max_age_days: int = 1) -> DataFrame:
    """Newest load per table and whether it is within the expected window."""
    parts = [
        df.agg(F.max("_loaded_at").alias("last_loaded_at")).select(
            F.lit(name).alias("table_name"), "last_loaded_at"
        )
        for name, df in tables.items()
    ]
    age = F.date_diff(F.lit(run_date), F.col("last_loaded_at").cast("date"))
    return reduce(DataFrame.union, parts).select(
        "table_name",
        "last_loaded_at",
        age.alias("age_days"),
        (F.coalesce(age, F.lit(max_age_days + 1)) > max_age_days).alias("is_stale"),
    )


def missing_store_days(sales: DataFrame, dates: DataFrame) -> DataFrame:
    """Days without sales for stores that have sold before.

    Only the gaps are made into days: those between two consecutive sale days of a store,
    and the one from its last sale to the end of the calendar.
    """
    last = dates.agg(F.max("full_date")).first()[0]
    seen = sales.select("store_id", "full_date").distinct()
    following = F.lead("full_date").over(W.partitionBy("store_id").orderBy("full_date"))
    start, stop = F.date_add("full_date", 1), F.date_sub("_next", 1)
    gaps = seen.withColumn("_next", F.coalesce(following, F.date_add(F.lit(last), 1))).where(start <= stop)
    return gaps.select("store_id", F.explode(F.sequence(start, stop)).alias("full_date"))


def daily_variance(sales: DataFrame) -> DataFrame:
    """Orders and revenue per day with the change against the previous day on record."""
    daily = sales.groupBy("full_date").agg(
        F.sum("order_count").alias("order_count"),
        F.sum(F.col("total_revenue").cast("decimal(28,4)")).alias("_revenue"),
    )
    by_day = W.orderBy("full_date")  # one row per calendar day
    return daily.withColumns(
        {
            "_orders_before": F.lag("order_count").over(by_day),
            "_before": F.lag("_revenue").over(by_day),
        }
    ).select(
        "full_date",
        "order_count",
        F.col("_revenue").cast("double").alias("total_revenue"),
        (F.col("order_count") - F.col("_orders_before")).alias("order_count_change"),
        (F.col("_revenue") - F.col("_before")).cast("double").alias("revenue_change"),
        exact_ratio((F.col("_revenue") - F.col("_before")) * 100, F.col("_before"), 1).alias(
            "revenue_change_pct"
        ),
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    parts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.union, parts)


def run_summary(
    tables: Mapping[str, DataFrame],
    results: DataFrame,
    reconciliation: DataFrame,
    exceptions: DataFrame,
    top: int = 10,
) -> DataFrame:
    """Row counts, check and reconciliation statuses and the first exceptions, in long form."""

    def section(name: str, df: DataFrame, key: str, value: str, detail: str | None = None) -> DataFrame:
        text = F.col(detail) if detail else F.lit(None).cast("string")
        return df.select(
            F.lit(name).alias("section"),
            F.col(key).alias("item"),
            text.alias("detail"),
            F.col(value).alias("total"),
        )

    def statuses(df: DataFrame) -> DataFrame:
        return df.groupBy("status").agg(F.count("*").alias("total"))

    listed = exception_summary(exceptions).orderBy("severity", "check_name").limit(top)
    return (
        section("row_counts", row_counts(tables), "table_name", "row_count")
        .union(section("quality", statuses(results), "status", "total"))
        .union(section("reconciliation", statuses(reconciliation), "status", "total"))
        .union(section("exceptions", listed, "check_name", "exception_count", "severity"))
    )
