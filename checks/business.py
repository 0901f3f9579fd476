"""Business questions."""

from __future__ import annotations

from checks import feed_source
from checks.lake import lake
from checks.models import view
from checks.registry import query
from galley.plans import questions as ask


def _sales(spark, sf):
    return view(spark, sf, "vw_sales_performance")


def _half_up(total: str, count: str, digits: int) -> str:
    """``total / count`` rounded half away from zero, in integers; total has four decimals."""
    scale = 10**digits
    n = f"CAST(abs({total}) * 10000 AS HUGEINT)"
    return (
        f"CAST(sign({total}) * ((2 * {scale} * {n} + 10000 * {count}) // (20000 * {count})) AS DOUBLE) / {scale}"
    )


def _revenue_sql(column: str) -> str:
    return f"""SELECT {column}, order_count, CAST(revenue AS DOUBLE) AS total_revenue,
                      {_half_up('revenue', 'order_count', 2)} AS avg_order_value
               FROM (SELECT {column}, CAST(sum(order_count) AS BIGINT) AS order_count,
                            sum(CAST(total_revenue AS DECIMAL(28,4))) AS revenue
                     FROM vw_sales_performance GROUP BY {column})"""


@query("bq1_daily_revenue", _revenue_sql("full_date"))
def daily(spark, sf):
    return ask.daily_revenue(_sales(spark, sf))


@query("bq2_best_stores", f"FROM ({_revenue_sql('store_id')}) ORDER BY total_revenue DESC, store_id LIMIT 10")
def stores(spark, sf):
    return ask.best_stores(_sales(spark, sf))


@query(
    "bq2_best_brands",
    """SELECT brand, count(*) AS deliveries, CAST(sum(delivery_fee) AS BIGINT) AS delivery_fees
       FROM feed_latest GROUP BY brand""",
)
def brands(spark, sf):
    return ask.best_brands(feed_source.records(spark, sf))


@query("bq3_channel_revenue", _revenue_sql("channel"))
def channels(spark, sf):
    return ask.channel_revenue(_sales(spark, sf))


@query(
    "bq4_promo_effect",
    f"""SELECT promo_code, is_promo, n AS order_count, CAST(discount AS DOUBLE) AS total_discount,
               {_half_up('subtotal', 'n', 2)} AS avg_order_value
        FROM dim_promo JOIN (SELECT promo_sk, count(*) AS n, sum(discount_ngn) AS discount,
                                    sum(subtotal_ngn) AS subtotal FROM fact_orders GROUP BY 1) USING (promo_sk)""",
)
def promos(spark, sf):
    return ask.promo_effect(*lake(spark, sf).many("fact_orders", "dim_promo"))


@query(
    "bq5_best_customers",
    """SELECT customer_id, lifetime_order_count, lifetime_revenue FROM vw_customer_summary
       ORDER BY lifetime_revenue DESC NULLS LAST, customer_id LIMIT 10""",
)
def customers(spark, sf):
    return ask.best_customers(view(spark, sf, "vw_customer_summary"))


_GAPS = """SELECT customer_id, order_timestamp,
                  epoch(order_timestamp) - epoch(lag(order_timestamp) OVER (PARTITION BY customer_id ORDER BY order_timestamp)) AS gap
           FROM int_orders"""


@query(
    "bq6_purchase_frequency",
    f"""SELECT customer_id, count(*) AS lifetime_order_count, min(order_timestamp) AS first_order_at,
               max(order_timestamp) AS most_recent_order_at,
               CASE WHEN count(gap) > 0 THEN
                 CAST((200 * CAST(sum(gap) AS HUGEINT) + 86400 * count(gap)) // (172800 * count(gap)) AS DOUBLE) / 100
               END AS mean_gap_days
        FROM ({_GAPS}) GROUP BY customer_id""",
)
def frequency(spark, sf):
    return ask.purchase_frequency(view(spark, sf, "vw_customer_summary"))


@query(
    "bq6_frequency_distribution",
    """SELECT n AS lifetime_order_count, count(*) AS customers
       FROM (SELECT customer_id, count(*) AS n FROM int_orders GROUP BY 1) GROUP BY 1""",
)
def distribution(spark, sf):
    return ask.frequency_distribution(view(spark, sf, "vw_customer_summary"))


@query(
    "bq7_spend_quantiles",
    """SELECT p AS percentile, min(lifetime_revenue) AS spend
       FROM (SELECT lifetime_revenue, cume_dist() OVER (ORDER BY lifetime_revenue) AS c FROM vw_customer_summary
             WHERE lifetime_revenue IS NOT NULL),
            (VALUES (25), (50), (75), (90)) t(p)
       WHERE c >= p / 100 - 1e-12 GROUP BY p""",
)
def quantiles(spark, sf):
    return ask.spend_quantiles(view(spark, sf, "vw_customer_summary"))


@query(
    "bq7_channel_mix",
    """SELECT c.customer_id, s.channel, count(*) AS order_count, CAST(sum(s.order_revenue) AS DOUBLE) AS revenue
       FROM sold s JOIN dim_customer c ON c.customer_sk = s.customer_sk
       WHERE s.channel IS NOT NULL GROUP BY 1, 2""",
)
def mix(spark, sf):
    return ask.channel_mix(
        *lake(spark, sf).many("order_sales", "dim_customer", "dim_channel")
    )


_GOODS = """SELECT {c}, CAST(sum(units_sold) AS BIGINT) AS units_sold,
                   CAST(sum(CAST(product_revenue AS DECIMAL(28,4))) AS DOUBLE) AS product_revenue
            FROM vw_product_performance GROUP BY {c}"""


@query(
    "bq8_best_products",
    f"FROM ({_GOODS.format(c='product_id, category')}) ORDER BY product_revenue DESC, product_id LIMIT 10",
)
def products(spark, sf):
    return ask.best_products(view(spark, sf, "vw_product_performance"))


@query("bq8_best_categories", _GOODS.format(c="category"))
def categories(spark, sf):
    return ask.best_categories(view(spark, sf, "vw_product_performance"))


@query(
    "bq9_declining_products",
    """WITH monthly AS (
           SELECT product_id, year, month, sum(CAST(product_revenue AS DECIMAL(28,4))) AS revenue,
                  row_number() OVER (PARTITION BY product_id ORDER BY year, month) AS i
           FROM vw_product_performance GROUP BY product_id, year, month)
       SELECT a.product_id, a.year, a.month, CAST(a.revenue AS DOUBLE) AS revenue,
              CAST(b.revenue AS DOUBLE) AS previous_revenue
       FROM monthly a JOIN monthly b ON b.product_id = a.product_id AND b.i = a.i - 1
       WHERE a.revenue < b.revenue""",
)
def declining(spark, sf):
    return ask.declining_products(view(spark, sf, "vw_product_performance"))


@query(
    "bq10_store_delays",
    f"""SELECT store_id, n AS delivery_count, met AS sla_met_count,
               {_half_up('CAST(100 * met AS DECIMAL(28,4))', 'n', 1)} AS sla_compliance_pct,
               {_half_up('CAST(delay AS DECIMAL(28,4))', 'n', 1)} AS avg_delay_minutes
        FROM (SELECT s.store_id, count(*) AS n, CAST(sum(f.delivery_sla_met_flag) AS BIGINT) AS met,
                     CAST(sum(f.delay_minutes) AS BIGINT) AS delay
              FROM fact_deliveries f JOIN dim_store s ON s.store_sk = f.store_sk GROUP BY 1)""",
)
def delays(spark, sf):
    return ask.store_delays(*lake(spark, sf).many("fact_deliveries", "dim_store"))
