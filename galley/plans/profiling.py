"""Profiles of the source tables before staging."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galley.functions import blank_to_null, join_all
from galley.operators.joins import lookup, orphan_count
from galley.operators.latest import latest_per_key

_PAIR = ("order_id", "product_id")

# entity -> key columns, columns that must not be NULL, business date
PROFILED: Mapping[str, tuple[Sequence[str], Sequence[str], str | None]] = {
    "customers": (("customer_id",), ("customer_id",), "signup_date"),
    "stores": (("store_id",), ("store_id",), None),
    "products": (("product_id",), ("product_id",), None),
    "orders": (("order_id",), ("order_id", "customer_id", "store_id"), "order_ts"),
    "order_items": (_PAIR, _PAIR, None),
    "deliveries": (("order_id",), ("order_id", "store_id"), "order_ts"),
}


def key_profile(df: DataFrame, entity: str) -> DataFrame:
    """Rows, distinct and duplicate keys, NULL keys and date range of one source.

    Rows are summed per key before the shuffle, which also makes the distinct count exact
    without expanding the rows.
    """
    keys, critical, date = PROFILED[entity]
    key = F.col(keys[0]) if len(keys) == 1 else join_all(*_with_bars(keys))
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in critical])
    day = F.col(date).cast("date") if date else F.lit(None).cast("date")
    per_key = df.groupBy(key.alias("_key")).agg(
        F.count("*").alias("_n"),
        F.count_if(missing).alias("_missing"),
        F.min(day).alias("_first"),
        F.max(day).alias("_last"),
    )
    total, distinct = F.coalesce(F.sum("_n"), F.lit(0)), F.count("_key")
    return per_key.agg(
        total.cast("bigint").alias("record_count"),
        distinct.alias("distinct_business_keys"),
        (total - distinct).cast("bigint").alias("duplicate_business_keys"),
        F.sum("_missing").cast("bigint").alias("null_critical_keys"),
        F.min("_first").alias("min_business_date"),
        F.max("_last").alias("max_business_date"),
    ).select(F.lit(f"{entity}.json").alias("source_file"), "*")


def _with_bars(keys: Sequence[str]) -> list[Column]:
    parts: list[Column] = []
    for k in keys:
        parts += [F.lit("|"), F.col(k)]
    return parts[1:]


def source_profile(sources: Mapping[str, DataFrame]) -> DataFrame:
    parts = [key_profile(sources[entity], entity) for entity in PROFILED]
    return reduce(DataFrame.union, parts).orderBy("source_file")


# child, key, parent
RELATIONSHIPS = (
    ("orders", "customer_id", "customers"),
    ("orders", "store_id", "stores"),
    ("order_items", "order_id", "orders"),
    ("order_items", "product_id", "products"),
    ("deliveries", "order_id", "orders"),
)


def relationship_profile(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Orphan rows per foreign key."""
    parts = [
        orphan_count(sources[child], sources[parent], key).select(
            F.lit(f"{child}.{key} -> {parent}.{key}").alias("relationship"), "orphan_count"
        )
        for child, key, parent in RELATIONSHIPS
    ]
    return reduce(DataFrame.union, parts).orderBy("relationship")


def exact_duplicates(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Rows that repeat another row in all columns. Copies are merged before the shuffle."""
    parts = []
    for entity, df in sources.items():
        per_row = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
        parts.append(
            per_row.agg(
                F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows")
            ).select(F.lit(entity).alias("source"), "duplicate_rows")
        )
    return reduce(DataFrame.union, parts)


def outside_opening_hours(orders: DataFrame, stores: DataFrame) -> DataFrame:
    """Orders placed before opening or after closing, per store.

    A closing time before the opening time means the store closes after midnight. Times of
    day are compared in seconds, both ends included; an order loaded again counts once.
    """
    orders = latest_per_key(orders, ["order_id"])
    sites = latest_per_key(stores, ["store_id"])

    def second(i: int):
        clock = F.split(F.trim(F.element_at(F.split("opening_hours", "-"), i)), ":")
        return clock[0].cast("int") * 3600 + clock[1].cast("int") * 60

    opens, closes = second(1), second(2)
    hours = sites.select("store_id", opens.alias("_opens"), closes.alias("_closes"))
    placed = orders.select("order_id", F.col("store_id").alias("store"), "order_ts")
    found = lookup(placed, hours, {"store": "store_id"}, "inner")
    at = F.hour("order_ts") * 3600 + F.minute("order_ts") * 60 + F.second("order_ts")
    after, before = at >= F.col("_opens"), at <= F.col("_closes")
    inside = F.when(F.col("_opens") <= F.col("_closes"), after & before).otherwise(after | before)
    return (
        found.where(~inside)
        .groupBy(F.col("store").alias("store_id"))
        .agg(F.count("*").alias("orders_outside_hours"))
    )


def price_differences(items: DataFrame, products: DataFrame) -> DataFrame:
    """Lines sold at another price than the current list price, as one row; the latest of each line."""
    items = latest_per_key(items, _PAIR)
    current = latest_per_key(products, ["product_id"])
    listed = current.select("product_id", F.col("base_price_ngn").cast("double").alias("_listed"))
    priced = lookup(items.select(*_PAIR, "unit_price_ngn"), listed, ["product_id"], "inner")
    return priced.agg(
        F.count("*").alias("lines"),
        F.count_if(F.col("unit_price_ngn") != F.col("_listed")).alias("lines_off_list_price"),
    )


def timing_agreement(orders: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Whether orders and deliveries state the same delivery minutes, as one row.

    The latest row of an order on either side; rows without an id have no counterpart.
    """
    orders = latest_per_key(orders.where("order_id IS NOT NULL"), ["order_id"])
    deliveries = latest_per_key(deliveries.where("order_id IS NOT NULL"), ["order_id"])
    stated = deliveries.select(
        F.col("order_id").alias("_order"),
        F.col("promised_delivery_minutes").alias("_promised"),
        F.col("actual_delivery_minutes").alias("_actual"),
    )
    both = orders.join(stated, F.col("order_id") == F.col("_order"))
    promised = F.col("promised_delivery_minutes").eqNullSafe(F.col("_promised"))
    actual = F.col("actual_delivery_minutes").eqNullSafe(F.col("_actual"))
    return both.agg(
        F.count("*").alias("compared"),
        F.count_if(promised & actual).alias("agreeing"),
        F.count_if(~(promised & actual)).alias("differing"),
    )


def promos_without_discount(orders: DataFrame) -> DataFrame:
    """Orders with a promotion code and no discount, per code."""
    odd = orders.where(blank_to_null(F.col("promo_code")).isNotNull() & (F.col("discount_ngn") == 0))
    return odd.groupBy("promo_code").agg(F.count("*").alias("orders_without_discount"))
