"""Test tables seen as restaurant sources.

Every entity comes with its lineage columns, as if it had been loaded from a drop. Stores
come as two snapshots: the second moves every tenth store and adds those left out of the
first.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from galley.operators.latest import LINEAGE, latest_per_key

FIRST_LOAD = dt.date(1995, 1, 1)
SECOND_LOAD = dt.date(1998, 6, 1)
RUN_DATE = dt.date(2001, 8, 2)
EARLIEST_ORDER = dt.date(1995, 2, 1)
FEED_CUT = "2024-01-16 00:00:00"

BRAND_RENAMES = {"Legacy Grill": "Harbour Grill"}
BRANDS = ("Harbour Grill", "Corner Bakery", "Noodle Stop")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lineage(df: DataFrame, source: str, loaded_at: Column | str, batch: str) -> DataFrame:
    when = F.lit(loaded_at).cast("timestamp_ntz") if isinstance(loaded_at, str) else loaded_at
    return df.withColumns(
        {
            "_source_file": F.lit(f"{source}.json"),
            "_loaded_at": when,
            "_batch_id": F.lit(batch),
        }
    )


def _id(letter: str, key: str) -> Column:
    return F.concat(F.lit(letter), F.col(key).cast("string"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation")
    days = (F.col("c_custkey") % 365).cast("int")
    rows = people.join(nations, people.c_nationkey == nations.n_nationkey).select(
        _id("C", "c_custkey").alias("customer_id"),
        F.date_add(F.lit(dt.date(1994, 1, 1)), days).alias("signup_date"),
        F.col("n_name").alias("city"),
        F.col("c_name").alias("phone"),
        F.col("c_mktsegment").isin("MACHINERY", "BUILDING").cast("bigint").alias("is_business"),
    )
    return _lineage(rows, "customers", "2001-08-02 00:00:00", "b1")


def stores(spark: SparkSession, sf_dir: str, snapshot: int) -> DataFrame:
    sites = table(spark, sf_dir, "supplier")
    nations = table(spark, sf_dir, "nation")
    city = F.concat(F.lit(" "), F.col("n_name"), F.lit(" "))
    if snapshot == 1:
        sites = sites.where("s_suppkey % 7 <> 3")
        loaded = f"{FIRST_LOAD} 00:00:00"
    else:
        city = F.when(F.col("s_suppkey") % 10 == 0, "MOVED").otherwise(city)
        loaded = f"{SECOND_LOAD} 00:00:00"
    rows = sites.join(nations, sites.s_nationkey == nations.n_nationkey).select(
        _id("S", "s_suppkey").alias("store_id"),
        F.col("s_name").alias("store_name"),
        city.alias("city"),
        F.lit("09:00-23:00").alias("opening_hours"),
        (F.lit(30) + F.lit(10) * (F.col("s_nationkey") % 2)).cast("bigint").alias("delivery_sla_minutes"),
    )
    return _lineage(rows, "stores", loaded, f"b{snapshot}")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select(
        _id("P", "p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.nullif("p_type", F.lit("ECONOMY")).alias("category"),
        F.col("p_retailprice").alias("base_price_ngn"),
    )
    return _lineage(rows, "products", "2001-08-02 00:00:00", "b1")


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_order_items(table(spark, sf_dir, "lineitem"))


def _as_order_items(lines: DataFrame, *kept: str) -> DataFrame:
    """Lines as the source has them, with columns of the table that are to be kept."""
    quantity = F.col("l_quantity").cast("bigint")
    total = F.col("l_extendedprice").cast("decimal(18,2)").cast("double")
    rows = lines.select(
        _id("O", "l_orderkey").alias("order_id"),
        _id("P", "l_partkey").alias("product_id"),
        F.lit(None).cast("string").alias("product_name"),
        F.lit(None).cast("string").alias("category"),
        quantity.alias("qty"),
        (total / quantity).alias("unit_price_ngn"),
        total.alias("line_total_ngn"),
        F.col("l_shipdate").alias("_loaded_at"),
        F.col("l_suppkey").alias("_supplier"),
        *kept,
    )
    return _lineage(rows, "order_items", F.col("_loaded_at"), "b1")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the lines are shuffled once, as the table has them and by order: their latest versions,
    # the totals and the join with the heads all follow that layout
    keys = ["l_orderkey", "l_partkey"]
    needed = [*keys, "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]
    items = _as_order_items(table(spark, sf_dir, "lineitem").select(*needed).repartition("l_orderkey"), *keys)
    tie = F.xxhash64(*[F.col(c) for c in items.columns if c not in keys])
    lines = latest_per_key(items, keys, [*LINEAGE, tie])
    totals = lines.groupBy("l_orderkey").agg(
        F.min(_id("S", "_supplier")).alias("store_id"),
        F.count("*").alias("_lines"),
        F.sum("qty").alias("qty_total"),
        F.sum(F.col("line_total_ngn").cast("decimal(18,2)")).cast("double").alias("subtotal_ngn"),
    )
    k = F.col("o_orderkey")
    priority = F.col("o_orderpriority")
    slow = F.when((priority == "5-LOW") & (k % 50 == 0), "Kiosk").otherwise("Dine-in")
    channel = (
        F.when(priority == "1-URGENT", "Delivery")
        .when(priority == "2-HIGH", "Online App")
        .when(priority == "4-NOT SPECIFIED", "Takeaway")
        .otherwise(slow)
    )
    promo = (
        F.when(k % 10 == 0, "WKND20").when(k % 10 == 1, "MIDWEEK15").when(k % 10 == 2, "")
    )
    heads = table(spark, sf_dir, "orders")
    extra = F.when(k % 101 == 0, 1).otherwise(0)
    rows = heads.join(totals, heads.o_orderkey == totals.l_orderkey, "left").select(
        _id("O", "o_orderkey").alias("order_id"),
        (F.col("o_orderdate") + F.make_dt_interval(F.lit(0), (k % 24).cast("int"))).alias("order_ts"),
        "store_id",
        _id("C", "o_custkey").alias("customer_id"),
        channel.alias("channel"),
        F.col("o_orderstatus").alias("payment_method"),
        promo.alias("promo_code"),
        (F.coalesce("_lines", F.lit(0)) + extra).cast("bigint").alias("items_count"),
        F.coalesce("qty_total", F.lit(0)).cast("bigint").alias("qty_total"),
        F.coalesce("subtotal_ngn", F.lit(0.0)).alias("subtotal_ngn"),
        F.when(k % 20 == 0, 100.0).otherwise(0.0).alias("discount_ngn"),
        F.lit(0.0).alias("tax_ngn"),
        F.lit(0).cast("bigint").alias("delivery_fee_ngn"),
        F.col("o_totalprice").alias("total_amount_ngn"),
        promised_minutes(k).alias("promised_delivery_minutes"),
        actual_minutes(k).alias("actual_delivery_minutes"),
    )
    return _lineage(rows, "orders", "2001-08-02 00:00:00", "b1")


def promised_minutes(k: Column) -> Column:
    return (F.lit(30) + F.lit(10) * (k % 2)).cast("bigint")


def actual_minutes(k: Column) -> Column:
    return (F.lit(20) + (k * 7) % 40).cast("bigint")


def deliveries(placed: DataFrame) -> DataFrame:
    """Deliveries of the mapped orders."""
    k = F.substring("order_id", 2, 20).cast("bigint")
    rows = (
        placed.where(F.col("channel").isin("Delivery", "Online App"))
        .where(k % 13 != 0)
        .select(
            "order_id",
            "store_id",
            "order_ts",
            "promised_delivery_minutes",
            "actual_delivery_minutes",
            (F.col("actual_delivery_minutes") <= F.col("promised_delivery_minutes"))
            .cast("bigint")
            .alias("delivered_within_sla"),
        )
    )
    return _lineage(rows, "deliveries", "2001-08-02 00:00:00", "b1")


def feed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provider records: many versions per delivery, times as ISO text."""
    return _as_feed_records(table(spark, sf_dir, "events"))


def _as_feed_records(events: DataFrame, *kept: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")

    def iso(when: Column) -> Column:
        return F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")

    def plus(minutes: Column) -> Column:
        return F.timestamp_add("MINUTE", minutes, F.col("ts"))

    site = F.col("user_id") % 20
    brand = F.element_at(
        F.array(*[F.lit(b) for b in (*BRANDS, "Legacy Grill", "Unlisted Diner")]),
        (site % 5 + 1).cast("int"),
    )
    promised = F.lit(-60) + F.lit(30) + F.lit(10) * (k % 3)
    none = F.lit(None).cast("string")
    return events.select(
        _id("D", "user_id").alias("delivery_id"),
        _id("O", "event_id").alias("order_id"),
        brand.alias("brand"),
        F.concat(F.lit("S"), site.cast("string")).alias("store_id"),
        F.concat(F.lit("Store "), site.cast("string")).alias("store_name"),
        F.concat(F.lit("City "), (F.col("user_id") % 5).cast("string")).alias("city"),
        F.lit("Rider Co").alias("delivery_partner"),
        F.col("event_type").alias("delivery_status"),
        iso(plus(F.lit(-60))).alias("assigned_at"),
        none.alias("picked_up_at"),
        iso(plus(promised)).alias("promised_delivery_at"),
        F.when(F.col("event_type") == "purchase", iso(plus(k % 60 - F.lit(60)))).alias("delivered_at"),
        none.alias("cancelled_at"),
        none.alias("failure_reason"),
        (F.col("value").cast("decimal(18,2)") * 100).cast("int").alias("delivery_fee"),
        F.col("value").alias("distance_km"),
        iso(plus(F.lit(-65))).alias("created_at"),
        iso(F.col("ts")).alias("updated_at"),
        *kept,
    )


def feed_pages(spark: SparkSession, sf_dir: str, groups: int = 1, where: Column | None = None) -> DataFrame:
    """The records in response envelopes of about one hundred.

    With ``groups``, all records of a delivery are in envelopes of the same ``_group``, and
    in the same file. The events are shuffled once and before their times become text.
    """
    events = table(spark, sf_dir, "events").withColumns(
        {
            "_group": F.pmod(F.xxhash64(_id("D", "user_id")), F.lit(groups)),
            "_page": (F.col("event_id") / (100 * groups)).cast("bigint"),
        }
    )
    events = events.repartition(groups, "_group") if groups > 1 else events.repartition("_page")
    records = _as_feed_records(events, "_group", "_page")
    if where is not None:
        records = records.where(where)
    columns = [c for c in records.columns if c not in ("_group", "_page")]
    pages = records.groupBy("_group", "_page").agg(F.collect_list(F.struct(*columns)).alias("data"))
    return pages.select(
        "data",
        F.struct(
            F.lit(None).cast("string").alias("next_cursor"),
            F.lit(True).alias("has_more"),
            F.lit(100).alias("limit"),
        ).alias("pagination"),
        F.struct(
            F.concat(F.lit("r"), F.col("_page").cast("string")).alias("request_id"),
            F.size("data").alias("record_count"),
            F.lit("2024-02-01T00:00:00Z").alias("generated_at"),
        ).alias("metadata"),
    )
