"""Operators and functions one by one."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from checks import mapping
from checks.lake import BATCH, lake
from checks.models import view
from checks.registry import query
from galley import functions as fn
from galley.operators import joins
from galley.operators.history import covers, next_versions, snapshot_with_hash
from galley.operators.latest import latest_per_key
from galley.operators.numbering import dense_number, rank_within
from galley.plans import marts, staging
from galley.plans.quality import daily_jumps
from galley.sources.contracts import CHANNELS

_TODAY = mapping.RUN_DATE


def _t(spark, sf, name):
    return lake(spark, sf).any(name)


# filters -----------------------------------------------------------------------------


@query("flt1_predicates", "SELECT order_id FROM int_orders WHERE (store_id IS NULL OR customer_id IS NULL) AND items_count < 1")
def predicates(spark, sf):
    orders = _t(spark, sf, "int_orders")
    return orders.where("(store_id IS NULL OR customer_id IS NULL) AND items_count < 1").select("order_id")


@query("flt2_not_in", "SELECT order_id, channel FROM int_orders WHERE channel = 'Kiosk' OR channel IS NULL")
def not_in(spark, sf):
    outside = ~F.col("channel").isin(*CHANNELS) | F.col("channel").isNull()
    return _t(spark, sf, "int_orders").where(outside).select("order_id", "channel")


@query("flt3_like", "SELECT product_id, product_name FROM int_products WHERE product_name LIKE '%r_ng' AND product_name NOT LIKE 'blue%'")
def like(spark, sf):
    name = F.col("product_name")
    kept = name.like("%r_ng") & ~name.like("blue%")
    return _t(spark, sf, "int_products").where(kept).select("product_id", "product_name")


@query(
    "flt4_scalar_subquery",
    "SELECT order_id FROM int_orders WHERE order_timestamp::DATE = (SELECT max(order_timestamp)::DATE FROM int_orders)",
)
def scalar(spark, sf):
    _t(spark, sf, "int_orders").createOrReplaceTempView("flt4_orders")
    return spark.sql(
        """SELECT order_id FROM flt4_orders WHERE CAST(order_timestamp AS DATE) =
           (SELECT CAST(max(order_timestamp) AS DATE) FROM flt4_orders)"""
    )


@query(
    "flt5_having",
    "SELECT order_id, count(*) AS lines, CAST(sum(quantity) AS BIGINT) AS units FROM int_order_items GROUP BY order_id HAVING count(*) > 7 AND sum(quantity) > 200",
)
def having(spark, sf):
    grouped = _t(spark, sf, "int_order_items").groupBy("order_id").agg(
        F.count("*").alias("lines"), F.sum("quantity").alias("units")
    )
    return grouped.where("lines > 7 AND units > 200")


@query(
    "flt6_qualify",
    "SELECT customer_id, order_id, order_timestamp FROM int_orders QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY order_timestamp DESC, order_id DESC) = 1",
)
def qualify(spark, sf):
    orders = _t(spark, sf, "int_orders").select("customer_id", "order_id", "order_timestamp")
    return latest_per_key(orders, ["customer_id"], ["order_timestamp", "order_id"])


@query(
    "flt8_date_window",
    f"SELECT order_id FROM int_orders WHERE order_timestamp::DATE BETWEEN DATE '{_TODAY}' - 30 AND DATE '{_TODAY}' + 1",
)
def date_window(spark, sf):
    day = F.col("order_timestamp").cast("date")
    today = F.lit(_TODAY)
    return _t(spark, sf, "int_orders").where(day.between(F.date_sub(today, 30), F.date_add(today, 1))).select("order_id")


# joins -------------------------------------------------------------------------------


@query(
    "jn1_inner_dimension",
    "SELECT o.order_id, h.channel FROM fact_orders o JOIN dim_channel h ON h.channel_sk = o.channel_sk",
)
def inner(spark, sf):
    facts = _t(spark, sf, "fact_orders").select("order_id", "channel_sk")
    return joins.lookup(facts, _t(spark, sf, "dim_channel"), ["channel_sk"], "inner").select("order_id", "channel")


@query(
    "jn2_left_dimension",
    "SELECT i.order_id, i.product_id, p.product_sk FROM int_order_items i LEFT JOIN dim_product p USING (product_id)",
)
def left(spark, sf):
    items = _t(spark, sf, "int_order_items").select("order_id", "product_id")
    goods = _t(spark, sf, "dim_product").select("product_id", "product_sk")
    return joins.lookup(items, goods, ["product_id"])


@query(
    "jn3_as_of_version",
    """SELECT o.order_id, o.store_id, s.store_sk, s.clean_city FROM int_orders o LEFT JOIN dim_store s
       ON s.store_id = o.store_id AND o.order_timestamp::DATE BETWEEN s.effective_from AND s.effective_to""",
)
def as_of(spark, sf):
    """The shuffled form, with hot stores spread, whatever the size of the dimension."""
    orders = _t(spark, sf, "int_orders").select(
        "order_id", "store_id", F.col("order_timestamp").cast("date").alias("day")
    )
    versions = _t(spark, sf, "dim_store").select(
        "store_id", "store_sk", "clean_city", "effective_from", "effective_to"
    )
    found = joins.lookup(
        orders, versions, ["store_id"], residual=covers("day"), broadcast_bytes=-1, hot_rows=100
    )
    return found.select("order_id", "store_id", "store_sk", "clean_city")


@query(
    "jn4_orphans",
    "SELECT order_id, store_id FROM int_orders o WHERE NOT EXISTS (FROM src_stores_1 s WHERE s.store_id = o.store_id)",
)
def orphan_rows(spark, sf):
    orders = _t(spark, sf, "int_orders").select("order_id", "store_id")
    return joins.orphans(orders, mapping.stores(spark, sf, 1), ["store_id"])


@query(
    "jn5_full_outer",
    """SELECT ifnull(a.store_id, b.store_id) AS store_id, ifnull(a.n, 0) AS source_n, ifnull(b.n, 0) AS report_n
       FROM (SELECT store_id, count(*) AS n FROM int_orders GROUP BY 1) a
       FULL JOIN (SELECT store_id, count(*) AS n FROM fact_orders LEFT JOIN dim_store USING (store_sk) GROUP BY 1) b
       ON a.store_id = b.store_id""",
)
def full(spark, sf):
    count = F.count("*").alias("n")
    here = _t(spark, sf, "int_orders").groupBy("store_id").agg(count)
    facts = _t(spark, sf, "fact_orders").groupBy("store_sk").agg(count)
    named = joins.lookup(facts, _t(spark, sf, "dim_store").select("store_sk", "store_id"), ["store_sk"])
    return joins.full_compare(here, named.groupBy("store_id").agg(F.sum("n").alias("n")), "store_id", ["n"])


@query(
    "jn6_header_to_lines",
    """SELECT o.order_id, count(i.product_id) AS lines, CAST(sum(i.product_revenue) AS DOUBLE) AS revenue
       FROM fact_orders o LEFT JOIN fact_order_items i ON i.order_id = o.order_id GROUP BY 1""",
)
def header_lines(spark, sf):
    lines = _t(spark, sf, "fact_order_items").groupBy(F.col("order_id").alias("_order")).agg(
        F.count("product_id").alias("_lines"), F.sum("product_revenue").cast("double").alias("revenue")
    )
    orders = _t(spark, sf, "fact_orders").select("order_id")
    joined = orders.join(lines, F.col("order_id") == F.col("_order"), "left")
    return joined.select("order_id", F.coalesce("_lines", F.lit(0)).alias("lines"), "revenue")


@query(
    "jn7_header_line_mismatch",
    """SELECT o.order_id FROM int_orders o JOIN int_order_items i ON i.order_id = o.order_id
       GROUP BY o.order_id, o.items_count HAVING count(*) <> o.items_count""",
)
def mismatch(spark, sf):
    lines = _t(spark, sf, "int_order_items").groupBy("order_id").agg(F.count("*").alias("lines"))
    joined = _t(spark, sf, "int_orders").select("order_id", "items_count").join(lines, "order_id")
    return joined.where("lines <> items_count").select("order_id")


@query(
    "jn8_enriched_lines",
    """SELECT i.order_id, i.product_id, o.channel, o.promo_flag FROM kept_lines i
       LEFT JOIN int_orders o ON o.order_id = i.order_id""",
)
def enriched(spark, sf):
    """Shuffled, with lines of hot orders spread."""
    lines = latest_per_key(lake(spark, sf).typed("order_items"), ["order_id", "product_id"])
    header = _t(spark, sf, "int_orders").select("order_id", "channel", "promo_flag")
    found = joins.lookup(
        lines.select("order_id", "product_id"), header, ["order_id"],
        hot_from=lake(spark, sf).typed("order_items"), broadcast_bytes=-1, hot_rows=8,
    )
    return found.select("order_id", "product_id", "channel", "promo_flag")


@query(
    "jn9_view_in_view",
    """SELECT s.channel, CAST(sum(s.total_items) AS BIGINT) AS items, c.n AS orders FROM vw_sales_performance s
       JOIN (SELECT channel, count(*) AS n FROM int_orders GROUP BY 1) c ON c.channel = s.channel GROUP BY 1, 3""",
)
def composed(spark, sf):
    counts = _t(spark, sf, "int_orders").groupBy("channel").agg(F.count("*").alias("orders"))
    items = view(spark, sf, "vw_sales_performance").groupBy("channel").agg(F.sum("total_items").alias("items"))
    return items.join(counts, "channel")


# aggregates --------------------------------------------------------------------------


@query(
    "agg1_counts",
    "SELECT count(*) AS lines, count(store_sk) AS placed_lines, count(product_sk) AS known_lines FROM fact_order_items",
)
def counts(spark, sf):
    return _t(spark, sf, "fact_order_items").agg(
        F.count("*").alias("lines"), F.count("store_sk").alias("placed_lines"), F.count("product_sk").alias("known_lines")
    )


@query("agg2_count_distinct", "SELECT channel, count(DISTINCT customer_id) AS customers FROM int_orders GROUP BY 1")
def distinct(spark, sf):
    return _t(spark, sf, "int_orders").groupBy("channel").agg(F.count_distinct("customer_id").alias("customers"))


@query(
    "agg3_distinct_composite",
    "SELECT count(DISTINCT concat(order_id, '|', product_id)) AS pairs FROM src_order_items",
)
def composite(spark, sf):
    pair = fn.join_any(F.col("order_id"), F.lit("|"), F.col("product_id"))
    return lake(spark, sf).typed("order_items").agg(F.count_distinct(pair).alias("pairs"))


@query(
    "agg4_duplicates",
    "SELECT count(*) - count(DISTINCT order_id || '|' || product_id) AS duplicates FROM src_order_items",
)
def duplicates(spark, sf):
    pair = fn.join_all(F.col("order_id"), F.lit("|"), F.col("product_id"))
    return lake(spark, sf).typed("order_items").agg((F.count("*") - F.count_distinct(pair)).alias("duplicates"))


@query(
    "agg5_sum_avg_min_max",
    """SELECT channel, CAST(sum(subtotal_ngn) AS DOUBLE) AS total, avg(qty_total) AS mean_units,
              min(order_timestamp) AS first_at, max(order_timestamp) AS last_at FROM int_orders GROUP BY 1""",
)
def basic(spark, sf):
    return _t(spark, sf, "int_orders").groupBy("channel").agg(
        F.sum("subtotal_ngn").cast("double").alias("total"),
        F.avg("qty_total").alias("mean_units"),
        F.min("order_timestamp").alias("first_at"),
        F.max("order_timestamp").alias("last_at"),
    )


@query(
    "agg6_conditional_sums",
    """SELECT store_id, count(*) FILTER (promo_flag = 1) AS promos,
              count(*) FILTER (new_vs_returning_customer_flag = 'New') AS newcomers FROM int_orders GROUP BY 1""",
)
def conditional(spark, sf):
    return _t(spark, sf, "int_orders").groupBy("store_id").agg(
        F.count_if(F.col("promo_flag") == 1).alias("promos"),
        F.count_if(F.col("new_vs_returning_customer_flag") == "New").alias("newcomers"),
    )


@query(
    "agg7_safe_ratio",
    """SELECT store_id, CASE WHEN d = 0 THEN NULL ELSE CAST((2000 * m + d) // (2 * d) AS DOUBLE) / 10 END AS sla_pct
       FROM (SELECT o.store_id, count(f.order_id) AS d, CAST(ifnull(sum(f.delivery_sla_met_flag), 0) AS BIGINT) AS m
             FROM int_orders o LEFT JOIN int_deliveries f ON f.order_id = o.order_id GROUP BY 1)""",
)
def ratio(spark, sf):
    """Stores without deliveries get NULL rather than an error."""
    orders = _t(spark, sf, "int_orders").groupBy("store_id").agg(F.count("*").alias("_n"))
    sent = _t(spark, sf, "int_deliveries").groupBy(F.col("store_id").alias("_s")).agg(
        F.count("*").alias("_d"), F.sum("delivery_sla_met_flag").alias("_m")
    )
    joined = orders.join(sent, F.col("store_id").eqNullSafe(F.col("_s")), "left")
    met, all_sent = F.coalesce("_m", F.lit(0)), F.coalesce("_d", F.lit(0))
    return joined.select("store_id", fn.exact_ratio(met * 100, all_sent, 1).alias("sla_pct"))


@query(
    "agg8_global",
    """SELECT count(*) AS order_total, CAST(coalesce(sum(subtotal_ngn), 0) AS DOUBLE) AS revenue,
              CAST(coalesce(sum(qty_total) FILTER (channel = 'Nowhere'), 0) AS BIGINT) AS none FROM int_orders""",
)
def overall(spark, sf):
    return _t(spark, sf, "int_orders").agg(
        F.count("*").alias("order_total"),
        F.coalesce(F.sum("subtotal_ngn"), F.lit(0)).cast("double").alias("revenue"),
        F.coalesce(F.sum(F.when(F.col("channel") == "Nowhere", F.col("qty_total"))), F.lit(0)).alias("none"),
    )


@query(
    "agg9_by_expression",
    "SELECT coalesce(nullif(promo_code, ''), 'NO_PROMO') AS promo_key, order_timestamp::DATE AS day, count(*) AS order_total FROM int_orders GROUP BY 1, 2",
)
def by_expression(spark, sf):
    promo = F.coalesce(fn.blank_to_null(F.col("promo_code")), F.lit("NO_PROMO")).alias("promo_key")
    day = F.col("order_timestamp").cast("date").alias("day")
    return _t(spark, sf, "int_orders").groupBy(promo, day).agg(F.count("*").alias("order_total"))


@query(
    "agg11_daily_measures",
    """SELECT full_date, store_id, channel, order_count, CAST(total_revenue AS DOUBLE) AS total_revenue, avg_order_value,
              total_items, avg_items_per_order, promo_order_count, new_customer_orders, returning_customer_orders
       FROM vw_sales_performance""",
)
def measures(spark, sf):
    return view(spark, sf, "vw_sales_performance").select(
        "full_date",
        "store_id",
        "channel",
        "order_count",
        "total_revenue",
        "avg_order_value",
        "total_items",
        "avg_items_per_order",
        "promo_order_count",
        "new_customer_orders",
        "returning_customer_orders",
    )


# windows -----------------------------------------------------------------------------


@query("win1_latest_per_key", "SELECT * EXCLUDE (supplier_key) FROM kept_lines")
def newest(spark, sf):
    return latest_per_key(lake(spark, sf).typed("order_items"), ["order_id", "product_id"])


@query(
    "win3_customer_order_rank",
    """SELECT order_id, customer_id, order_timestamp,
              row_number() OVER (PARTITION BY customer_id ORDER BY order_timestamp, order_id) AS order_rank FROM int_orders""",
)
def order_rank(spark, sf):
    orders = _t(spark, sf, "int_orders").select("order_id", "customer_id", "order_timestamp")
    order = [F.col("order_timestamp").asc_nulls_last(), F.col("order_id").asc_nulls_last()]
    return rank_within(orders, ["customer_id"], order, "order_rank")


@query(
    "win4_dense_key",
    "SELECT order_id, row_number() OVER (ORDER BY order_id) AS order_sk FROM int_orders",
)
def dense(spark, sf):
    orders = _t(spark, sf, "int_orders").select("order_id")
    return dense_number(orders, [F.col("order_id").asc_nulls_last()], "order_sk")


@query(
    "win5_daily_lag",
    "SELECT d AS order_date, n AS order_count, n_before AS previous_order_count FROM day_counts WHERE n_before >= 10 AND abs(n - n_before) / n_before > 0.5",
)
def jumps(spark, sf):
    return daily_jumps(_t(spark, sf, "int_orders"))


# sorts and sets ----------------------------------------------------------------------


@query("srt1_order_by", "SELECT channel, count(*) AS order_total FROM int_orders GROUP BY 1 ORDER BY 1")
def ordered(spark, sf):
    return _t(spark, sf, "int_orders").groupBy("channel").agg(F.count("*").alias("order_total")).orderBy("channel")


@query(
    "srt2_top_ten",
    "SELECT order_id, CAST(subtotal_ngn AS DOUBLE) AS subtotal_ngn FROM int_orders ORDER BY int_orders.subtotal_ngn DESC, order_id LIMIT 10",
)
def top_ten(spark, sf):
    ranked = _t(spark, sf, "int_orders").orderBy(F.col("subtotal_ngn").desc_nulls_last(), "order_id").limit(10)
    return ranked.select("order_id", F.col("subtotal_ngn").cast("double").alias("subtotal_ngn"))


@query(
    "set1_union_all",
    "SELECT store_id AS id, 'order' AS kind FROM int_orders UNION ALL SELECT store_id, 'delivery' FROM int_deliveries",
)
def union_all(spark, sf):
    placed = _t(spark, sf, "int_orders").select(F.col("store_id").alias("id"), F.lit("order").alias("kind"))
    sent = _t(spark, sf, "int_deliveries").select("store_id", F.lit("delivery"))
    return placed.union(sent)


@query("set2_distinct", "SELECT DISTINCT channel, payment_method FROM int_orders")
def distinct_rows(spark, sf):
    return _t(spark, sf, "int_orders").select("channel", "payment_method").distinct()


@query("set3_sentinel_row", "SELECT promo_sk, is_promo, promo_code FROM dim_promo")
def sentinel(spark, sf):
    return marts.dim_promo(_t(spark, sf, "int_orders")).select("promo_sk", "is_promo", "promo_code")


# functions ---------------------------------------------------------------------------


@query(
    "fn1_3_date_parts",
    """SELECT order_id, CAST(year(t) AS INTEGER) AS y, CAST(month(t) AS INTEGER) AS m, CAST(hour(t) AS INTEGER) AS h,
              CAST(weekofyear(t) AS INTEGER) AS w, CAST(dayofweek(t) AS INTEGER) AS d
       FROM (SELECT order_id, order_ts AS t FROM src_orders)""",
)
def date_parts(spark, sf):
    t = F.col("order_ts")
    return lake(spark, sf).typed("orders").select(
        "order_id",
        fn.year_of(t).alias("y"),
        fn.month_of(t).alias("m"),
        fn.hour_of(t).alias("h"),
        fn.iso_week(t).alias("w"),
        fn.day_of_week(t).alias("d"),
    )


@query(
    "fn4_5_day_names",
    "SELECT DISTINCT order_ts::DATE AS day, dayname(order_ts) AS name, dayofweek(order_ts) IN (0, 6) AS weekend FROM src_orders",
)
def day_names(spark, sf):
    day = F.col("order_ts").cast("date")
    return lake(spark, sf).typed("orders").select(
        day.alias("day"), fn.day_name(day).alias("name"), fn.is_weekend(day).alias("weekend")
    ).distinct()


@query(
    "fn6_casts",
    "SELECT order_id, order_ts::DATE AS day, CAST(items_count AS DOUBLE) AS items, CAST(qty_total AS VARCHAR) AS units FROM src_orders",
)
def casts(spark, sf):
    return lake(spark, sf).typed("orders").select(
        "order_id",
        F.col("order_ts").cast("date").alias("day"),
        F.col("items_count").cast("double").alias("items"),
        F.col("qty_total").cast("string").alias("units"),
    )


@query(
    "fn7_try_cast",
    "SELECT p_partkey AS part, try_cast(p_brand AS BIGINT) AS brand, try_cast(replace(p_brand, 'Brand#', '') AS BIGINT) AS number FROM part",
)
def try_casts(spark, sf):
    brand = F.col("p_brand")
    return mapping.table(spark, sf, "part").select(
        F.col("p_partkey").alias("part"),
        brand.try_cast("bigint").alias("brand"),
        F.regexp_replace(brand, "Brand#", "").try_cast("bigint").alias("number"),
    )


@query(
    "fn8_date_series",
    "SELECT store_id, CAST(unnest(generate_series(min(order_timestamp)::DATE, max(order_timestamp)::DATE, INTERVAL 1 DAY)) AS DATE) AS day FROM int_orders GROUP BY 1",
)
def series(spark, sf):
    """Every day from a store's first order to its last."""
    day = F.col("order_timestamp").cast("date")
    spans = _t(spark, sf, "int_orders").groupBy("store_id").agg(F.min(day).alias("first"), F.max(day).alias("last"))
    return spans.select("store_id", F.explode(F.sequence("first", "last")).alias("day"))


@query(
    "fn9_date_arithmetic",
    "SELECT customer_id, CAST(signup_date + INTERVAL 1 DAY AS DATE) AS next_day, CAST(signup_date - INTERVAL 30 DAY AS DATE) AS month_ago FROM src_customers",
)
def arithmetic(spark, sf):
    return lake(spark, sf).typed("customers").select(
        "customer_id", F.date_add("signup_date", 1).alias("next_day"), F.date_sub("signup_date", 30).alias("month_ago")
    )


@query(
    "fn10_11_nulls_and_cases",
    """SELECT order_id, coalesce(nullif(promo_code, ''), 'none') AS promo,
              CASE WHEN qty_total > 150 THEN 'large' WHEN qty_total > 50 THEN 'medium' ELSE 'small' END AS size FROM src_orders""",
)
def cases(spark, sf):
    units = F.col("qty_total")
    return lake(spark, sf).typed("orders").select(
        "order_id",
        F.coalesce(fn.blank_to_null(F.col("promo_code")), F.lit("none")).alias("promo"),
        F.when(units > 150, "large").when(units > 50, "medium").otherwise("small").alias("size"),
    )


@query("fn12_trim", "SELECT store_id, trim(city) AS city FROM src_stores")
def trimmed(spark, sf):
    return lake(spark, sf).typed("stores").select("store_id", F.trim("city").alias("city"))


@query(
    "fn13_14_concatenation",
    "SELECT order_id, concat(order_id, '|', promo_code) AS lenient, order_id || '|' || promo_code AS strict FROM src_orders",
)
def concatenation(spark, sf):
    parts = [F.col("order_id"), F.lit("|"), F.col("promo_code")]
    return lake(spark, sf).typed("orders").select(
        "order_id", fn.join_any(*parts).alias("lenient"), fn.join_all(*parts).alias("strict")
    )


@query(
    "fn15_row_hash",
    "SELECT product_id, md5(concat_ws('|', product_id, product_name, category)) AS row_hash FROM src_products",
)
def row_hash(spark, sf):
    goods = lake(spark, sf).typed("products")
    attributes = [F.col(c) for c in ("product_id", "product_name", "category")]
    return goods.select("product_id", fn.fingerprint(*attributes).alias("row_hash"))


@query(
    "fn16_round_abs",
    "SELECT order_id, CAST(round(total_amount_ngn, 1) AS DOUBLE) AS rounded, CAST(abs(subtotal_ngn - total_amount_ngn) AS DOUBLE) AS gap FROM int_orders",
)
def rounding(spark, sf):
    gap = F.abs(F.col("subtotal_ngn") - F.col("total_amount_ngn"))
    return _t(spark, sf, "int_orders").select(
        "order_id", F.round("total_amount_ngn", 1).cast("double").alias("rounded"), gap.cast("double").alias("gap")
    )


@query(
    "fn17_json_path",
    "SELECT event_id, regexp_extract(props, '([0-9]+)', 1) AS k, 'fallback' AS missing FROM events",
)
def json_path(spark, sf):
    return mapping.table(spark, sf, "events").select(
        "event_id",
        fn.json_field(F.col("props"), "k").alias("k"),
        fn.json_field(F.col("props"), "k.deeper", "fallback").alias("missing"),
    )


@query(
    "fn18_minutes_between",
    "SELECT event_id, CAST(floor(epoch(ts - TIMESTAMP '2024-01-01') / 60) AS BIGINT) AS minutes FROM events",
)
def minutes(spark, sf):
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return mapping.table(spark, sf, "events").select(
        "event_id", fn.minutes_between(start, F.col("ts")).alias("minutes")
    )


@query(
    "fn20_iso_times",
    "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS text, date_trunc('second', ts) AS parsed, date_trunc('second', ts) - INTERVAL 1 HOUR AS shifted FROM events",
)
def iso_times(spark, sf):
    text = fn.iso_utc(F.col("ts"))
    eastern = F.replace(text, F.lit("Z"), F.lit("+01:00"))
    return mapping.table(spark, sf, "events").select(
        "event_id", text.alias("text"), fn.parse_utc(text).alias("parsed"), fn.parse_utc(eastern).alias("shifted")
    )


@query("fn21_sha256", "SELECT order_id, sha256(order_id) AS digest FROM src_orders")
def digests(spark, sf):
    return lake(spark, sf).typed("orders").select("order_id", F.sha2("order_id", 256).alias("digest"))


@query("fn22_exclude", "SELECT * EXCLUDE (_batch_id, _source_file, _loaded_at) FROM int_stores")
def exclude(spark, sf):
    return _t(spark, sf, "int_stores").drop("_batch_id", "_source_file", "_loaded_at")


# versions of stores ------------------------------------------------------------------


def _snapshot(spark, sf, number):
    return lake(spark, sf).store_snapshot(number)


@query("scd1_row_hash", "SELECT store_id, trim(city) AS clean_city, md5(store_id || '|' || trim(city)) AS row_hash FROM src_stores_2")
def hashes(spark, sf):
    return snapshot_with_hash(_snapshot(spark, sf, 2), "store_id", ["clean_city"])


@query("scd2_closed_versions", "SELECT * FROM dim_store WHERE NOT is_current")
def closed(spark, sf):
    return lake(spark, sf).build_mart("dim_store").where("NOT is_current")


@query("scd3_first_load", "SELECT * FROM dim_store_v1")
def first_load(spark, sf):
    return marts.dim_store(_snapshot(spark, sf, 1), None, mapping.FIRST_LOAD)


@query("scd4_new_versions", f"SELECT * FROM dim_store WHERE effective_from = DATE '{mapping.SECOND_LOAD}'")
def added(spark, sf):
    return lake(spark, sf).build_mart("dim_store").where(F.col("effective_from") == F.lit(mapping.SECOND_LOAD))


@query("scd5_stable_keys", "SELECT a.store_sk, a.store_id FROM dim_store a JOIN dim_store_v1 b USING (store_sk, store_id)")
def stable(spark, sf):
    before = _t(spark, sf, "dim_store_v1").select("store_sk", "store_id")
    return lake(spark, sf).build_mart("dim_store").select("store_sk", "store_id").join(before, ["store_sk", "store_id"])


@query("scd6_rerun", "SELECT * FROM dim_store")
def rerun(spark, sf):
    """The same snapshot once more, on the same and on a later day, changes nothing."""
    versions = _t(spark, sf, "dim_store")
    for day in (mapping.SECOND_LOAD, mapping.RUN_DATE):
        versions = next_versions(versions, _snapshot(spark, sf, 2), day, "store_id", ["clean_city"], "store_sk")
    return versions


@query(
    "scd7_load_date",
    "SELECT store_id, store_sk, DATE '1999-09-09' AS effective_from FROM dim_store WHERE effective_from > DATE '1900-01-01'",
)
def dated(spark, sf):
    versions = marts.dim_store(_snapshot(spark, sf, 2), _t(spark, sf, "dim_store_v1"), dt.date(1999, 9, 9))
    return versions.where("effective_from > DATE '1900-01-01'").select("store_id", "store_sk", "effective_from")


@query("stg_batch_id", f"SELECT '{BATCH}' AS batch_id, count(*) AS row_total FROM int_orders")
def batch_ids(spark, sf):
    staged = staging.int_orders(lake(spark, sf).typed("orders"), staging.run_batch_id("staging", mapping.RUN_DATE))
    return staged.groupBy(F.col("_batch_id").alias("batch_id")).agg(F.count("*").alias("row_total"))
