"""DuckDB definitions of the mapped sources and of every warehouse table.

They are written from the definitions of the tables, not from the Spark code, and serve
as common table expressions of the oracle queries.
"""

from __future__ import annotations

import re

from checks import mapping
from checks.lake import BATCH

TABLES: dict[str, str] = {
    "src_customers": """
        SELECT 'C' || c_custkey AS customer_id,
               (DATE '1994-01-01' + CAST(c_custkey % 365 AS INTEGER)) AS signup_date,
               n_name AS city, c_name AS phone,
               CAST(c_mktsegment IN ('MACHINERY', 'BUILDING') AS BIGINT) AS is_business,
               'customers.json' AS _source_file, TIMESTAMP '2001-08-02' AS _loaded_at, 'b1' AS _batch_id
        FROM customer, nation WHERE n_nationkey = c_nationkey""",
    "src_stores_1": f"""
        SELECT 'S' || s_suppkey AS store_id, s_name AS store_name, ' ' || n_name || ' ' AS city,
               '09:00-23:00' AS opening_hours,
               CAST(30 + 10 * (s_nationkey % 2) AS BIGINT) AS delivery_sla_minutes,
               'stores.json' AS _source_file, TIMESTAMP '{mapping.FIRST_LOAD}' AS _loaded_at, 'b1' AS _batch_id
        FROM supplier, nation WHERE n_nationkey = s_nationkey AND s_suppkey % 7 <> 3""",
    "src_stores_2": f"""
        SELECT 'S' || s_suppkey AS store_id, s_name AS store_name,
               CASE WHEN s_suppkey % 10 = 0 THEN 'MOVED' ELSE ' ' || n_name || ' ' END AS city,
               '09:00-23:00' AS opening_hours,
               CAST(30 + 10 * (s_nationkey % 2) AS BIGINT) AS delivery_sla_minutes,
               'stores.json' AS _source_file, TIMESTAMP '{mapping.SECOND_LOAD}' AS _loaded_at, 'b2' AS _batch_id
        FROM supplier, nation WHERE n_nationkey = s_nationkey""",
    "src_stores": "SELECT * FROM src_stores_1 UNION ALL SELECT * FROM src_stores_2",
    "src_products": """
        SELECT 'P' || p_partkey AS product_id, p_name AS product_name,
               CASE WHEN p_type = 'ECONOMY' THEN NULL ELSE p_type END AS category,
               p_retailprice AS base_price_ngn,
               'products.json' AS _source_file, TIMESTAMP '2001-08-02' AS _loaded_at, 'b1' AS _batch_id
        FROM part""",
    "src_order_items": """
        SELECT 'O' || l_orderkey AS order_id, 'P' || l_partkey AS product_id,
               NULL::VARCHAR AS product_name, NULL::VARCHAR AS category,
               CAST(l_quantity AS BIGINT) AS qty,
               CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) / CAST(l_quantity AS BIGINT) AS unit_price_ngn,
               CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS line_total_ngn,
               'order_items.json' AS _source_file, l_shipdate AS _loaded_at, 'b1' AS _batch_id,
               l_suppkey AS supplier_key
        FROM lineitem""",
    "kept_lines": """
        SELECT a.* FROM src_order_items a
        JOIN (SELECT order_id, product_id, max(_loaded_at) AS newest
              FROM src_order_items GROUP BY ALL) b
          ON a.order_id = b.order_id AND a.product_id = b.product_id AND a._loaded_at = b.newest""",
    "src_orders": """
        SELECT 'O' || o_orderkey AS order_id,
               o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS order_ts,
               t.store_id, 'C' || o_custkey AS customer_id,
               CASE o_orderpriority
                    WHEN '1-URGENT' THEN 'Delivery' WHEN '2-HIGH' THEN 'Online App'
                    WHEN '3-MEDIUM' THEN 'Dine-in' WHEN '4-NOT SPECIFIED' THEN 'Takeaway'
                    ELSE CASE WHEN o_orderkey % 50 = 0 THEN 'Kiosk' ELSE 'Dine-in' END END AS channel,
               o_orderstatus AS payment_method,
               CASE o_orderkey % 10 WHEN 0 THEN 'WKND20' WHEN 1 THEN 'MIDWEEK15' WHEN 2 THEN '' END AS promo_code,
               CAST(ifnull(t.n, 0) + (CASE WHEN o_orderkey % 101 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS items_count,
               CAST(ifnull(t.units, 0) AS BIGINT) AS qty_total,
               ifnull(t.revenue, 0) AS subtotal_ngn,
               CASE WHEN o_orderkey % 20 = 0 THEN 100 ELSE 0 END AS discount_ngn,
               0 AS tax_ngn, CAST(0 AS BIGINT) AS delivery_fee_ngn,
               CAST(o_totalprice AS DECIMAL(18,4)) AS total_amount_ngn,
               CAST(30 + 10 * (o_orderkey % 2) AS BIGINT) AS promised_delivery_minutes,
               CAST(20 + (7 * o_orderkey) % 40 AS BIGINT) AS actual_delivery_minutes,
               'orders.json' AS _source_file, TIMESTAMP '2001-08-02' AS _loaded_at, 'b1' AS _batch_id
        FROM orders LEFT JOIN (
            SELECT order_id, min('S' || supplier_key) AS store_id, count(*) AS n, sum(qty) AS units,
                   sum(CAST(line_total_ngn AS DECIMAL(18,4))) AS revenue
            FROM kept_lines GROUP BY order_id) t ON t.order_id = 'O' || o_orderkey""",
    "src_deliveries": """
        SELECT order_id, store_id, order_ts, promised_delivery_minutes, actual_delivery_minutes,
               CAST(actual_delivery_minutes <= promised_delivery_minutes AS BIGINT) AS delivered_within_sla,
               'deliveries.json' AS _source_file, TIMESTAMP '2001-08-02' AS _loaded_at, 'b1' AS _batch_id
        FROM src_orders
        WHERE (channel = 'Delivery' OR channel = 'Online App') AND CAST(order_id[2:] AS BIGINT) % 13 <> 0""",
    "int_customers": f"SELECT * REPLACE ('{BATCH}' AS _batch_id) FROM src_customers",
    "int_stores": f"""
        SELECT * REPLACE ('{BATCH}' AS _batch_id), trim(city) AS clean_city FROM src_stores_2""",
    "int_products": f"""
        SELECT * REPLACE ('{BATCH}' AS _batch_id), ifnull(category, 'Uncategorized') AS unified_category
        FROM src_products""",
    "first_orders": """
        SELECT customer_id, arg_min(order_id, (order_ts, order_id)) AS order_id
        FROM src_orders GROUP BY customer_id""",
    "int_orders": f"""
        SELECT o.order_id, o.customer_id, store_id, channel, payment_method, promo_code,
               order_ts AS order_timestamp, items_count, qty_total,
               CAST(subtotal_ngn AS DECIMAL(18,4)) AS subtotal_ngn,
               CAST(discount_ngn AS DECIMAL(18,4)) AS discount_ngn,
               CAST(tax_ngn AS DECIMAL(18,4)) AS tax_ngn, delivery_fee_ngn, total_amount_ngn,
               CAST(date_part('year', order_ts) AS INTEGER) AS order_year,
               CAST(date_part('month', order_ts) AS INTEGER) AS order_month,
               CAST(date_part('week', order_ts) AS INTEGER) AS order_week,
               CAST(date_part('dow', order_ts) AS INTEGER) AS order_day_of_week,
               CAST(date_part('hour', order_ts) AS INTEGER) AS order_hour,
               CAST(length(ifnull(promo_code, '')) > 0 AS BIGINT) AS promo_flag,
               CASE WHEN f.order_id IS NULL THEN 'Returning' ELSE 'New' END AS new_vs_returning_customer_flag,
               CASE WHEN f.order_id IS NULL THEN 'Loyal Customer' ELSE 'First-Time Buyer' END AS customer_type,
               _source_file, _loaded_at, '{BATCH}' AS _batch_id
        FROM src_orders o LEFT JOIN first_orders f ON f.order_id = o.order_id""",
    "int_deliveries": f"""
        SELECT order_id, store_id, order_ts AS order_timestamp, promised_delivery_minutes,
               actual_delivery_minutes,
               actual_delivery_minutes - promised_delivery_minutes AS delay_minutes,
               delivered_within_sla AS delivery_sla_met_flag,
               _source_file, _loaded_at, '{BATCH}' AS _batch_id
        FROM src_deliveries""",
    "int_order_items": f"""
        SELECT l.order_id, l.product_id, l.product_name, l.category, l.qty AS quantity,
               l.unit_price_ngn AS unit_price,
               CAST(l.line_total_ngn AS DECIMAL(18,4)) AS product_revenue,
               h.store_id, h.channel, h.order_timestamp, h.promo_flag,
               l._source_file, l._loaded_at, '{BATCH}' AS _batch_id
        FROM kept_lines l LEFT JOIN int_orders h ON h.order_id = l.order_id""",
    "dim_date": """
        SELECT d AS date_sk, d AS full_date,
               CAST(date_part('year', d) AS INTEGER) AS year, CAST(date_part('month', d) AS INTEGER) AS month,
               CAST(date_part('week', d) AS INTEGER) AS week, CAST(date_part('dow', d) AS INTEGER) AS day_of_week,
               strftime(d, '%A') AS day_name, date_part('isodow', d) > 5 AS is_weekend
        FROM (SELECT CAST(unnest(range(min(order_timestamp)::DATE::TIMESTAMP,
                                       max(order_timestamp)::DATE::TIMESTAMP + INTERVAL 1 DAY,
                                       INTERVAL 1 DAY)) AS DATE) AS d FROM int_orders)""",
    "dim_customer": """
        SELECT rank() OVER (ORDER BY customer_id) AS customer_sk, customer_id, signup_date, city, phone, is_business
        FROM int_customers""",
    "dim_product": """
        SELECT rank() OVER (ORDER BY product_id) AS product_sk, product_id, product_name, unified_category,
               base_price_ngn FROM int_products""",
    "dim_channel": """
        SELECT dense_rank() OVER (ORDER BY channel) AS channel_sk, channel
        FROM (SELECT channel FROM int_orders WHERE channel IS NOT NULL GROUP BY 1)""",
    "dim_payment_method": """
        SELECT dense_rank() OVER (ORDER BY payment_method) AS payment_method_sk, payment_method
        FROM (SELECT payment_method FROM int_orders WHERE payment_method IS NOT NULL GROUP BY 1)""",
    "dim_promo": """
        SELECT CAST(0 AS BIGINT) AS promo_sk, NULL::VARCHAR AS promo_code, FALSE AS is_promo
        UNION ALL
        SELECT dense_rank() OVER (ORDER BY promo_code), promo_code, TRUE
        FROM (SELECT promo_code FROM int_orders WHERE length(promo_code) > 0 GROUP BY 1)""",
    "dim_store_v1": """
        SELECT rank() OVER (ORDER BY store_id) AS store_sk, store_id, trim(city) AS clean_city,
               md5(store_id || '|' || trim(city)) AS row_hash,
               DATE '1900-01-01' AS effective_from, DATE '9999-12-31' AS effective_to, TRUE AS is_current
        FROM src_stores_1""",
    "store_moves": f"""
        SELECT n.store_id, trim(n.city) AS clean_city, o.store_id IS NOT NULL AS was_known
        FROM src_stores_2 n LEFT JOIN dim_store_v1 o ON o.store_id = n.store_id
        WHERE o.store_id IS NULL OR o.clean_city <> trim(n.city)""",
    "dim_store": f"""
        SELECT v.store_sk, v.store_id, v.clean_city, v.row_hash, v.effective_from,
               CASE WHEN m.store_id IS NULL THEN v.effective_to
                    ELSE CAST(DATE '{mapping.SECOND_LOAD}' - 1 AS DATE) END AS effective_to,
               m.store_id IS NULL AS is_current
        FROM dim_store_v1 v LEFT JOIN store_moves m ON m.store_id = v.store_id
        UNION ALL
        SELECT (SELECT max(store_sk) FROM dim_store_v1) + rank() OVER (ORDER BY was_known, store_id),
               store_id, clean_city, md5(store_id || '|' || clean_city),
               DATE '{mapping.SECOND_LOAD}', DATE '9999-12-31', TRUE
        FROM store_moves""",
    "fact_orders": """
        SELECT o.order_id, c.customer_sk, s.store_sk, h.channel_sk, m.payment_method_sk,
               ifnull(p.promo_sk, 0) AS promo_sk, o.order_timestamp::DATE AS date_sk, o.order_timestamp,
               o.order_hour, o.promo_flag, o.new_vs_returning_customer_flag, o.customer_type,
               o.items_count, o.qty_total, o.subtotal_ngn, o.discount_ngn, o.tax_ngn, o.delivery_fee_ngn,
               o.total_amount_ngn, 1 AS order_count, o._source_file, o._loaded_at, o._batch_id
        FROM int_orders o
        LEFT JOIN dim_customer c ON c.customer_id = o.customer_id
        LEFT JOIN dim_store s ON s.store_id = o.store_id
             AND o.order_timestamp::DATE BETWEEN s.effective_from AND s.effective_to
        LEFT JOIN dim_channel h ON h.channel = o.channel
        LEFT JOIN dim_payment_method m ON m.payment_method = o.payment_method
        LEFT JOIN dim_promo p ON p.promo_code = o.promo_code""",
    "fact_order_items": """
        SELECT i.order_id, i.product_id, p.product_sk, i.order_timestamp::DATE AS date_sk, s.store_sk,
               h.channel_sk, i.order_timestamp, i.promo_flag, i.quantity, i.unit_price, i.product_revenue,
               i._source_file, i._loaded_at, i._batch_id
        FROM int_order_items i
        LEFT JOIN dim_product p ON p.product_id = i.product_id
        LEFT JOIN dim_store s ON s.store_id = i.store_id
             AND i.order_timestamp::DATE BETWEEN s.effective_from AND s.effective_to
        LEFT JOIN dim_channel h ON h.channel = i.channel""",
    "fact_deliveries": """
        SELECT d.order_id, s.store_sk, d.order_timestamp::DATE AS date_sk, d.promised_delivery_minutes,
               d.actual_delivery_minutes, d.delay_minutes, d.delivery_sla_met_flag,
               d._source_file, d._loaded_at, d._batch_id
        FROM int_deliveries d
        LEFT JOIN dim_store s ON s.store_id = d.store_id
             AND d.order_timestamp::DATE BETWEEN s.effective_from AND s.effective_to""",
    "rpt_order_summary": """
        SELECT order_id, any_value(date_sk) AS date_sk, any_value(store_sk) AS store_sk,
               any_value(channel_sk) AS channel_sk, count(line_product) AS items_per_order,
               sum(revenue) AS order_revenue
        FROM (SELECT o.order_id, o.date_sk, o.store_sk, o.channel_sk,
                     i.product_sk AS line_product, i.product_revenue AS revenue
              FROM fact_orders o LEFT JOIN fact_order_items i ON i.order_id = o.order_id)
        GROUP BY order_id""",
    "sold": """
        SELECT o.*, r.order_revenue, r.items_per_order, s.store_id, s.clean_city AS city, h.channel
        FROM fact_orders o JOIN rpt_order_summary r ON r.order_id = o.order_id
        LEFT JOIN dim_store s ON s.store_sk = o.store_sk
        LEFT JOIN dim_channel h ON h.channel_sk = o.channel_sk""",
    "vw_sales_performance": """
        SELECT d.full_date, d.year, d.month, d.week, d.day_name, d.is_weekend, x.store_id, x.city, x.channel,
               x.order_count, CAST(x.revenue AS DOUBLE) AS total_revenue,
               CAST((2 * CAST(x.revenue * 10000 AS HUGEINT) + 100 * x.order_count)
                    // (200 * x.order_count) AS DOUBLE) / 100 AS avg_order_value,
               x.total_items,
               CAST((200 * x.total_items + x.order_count) // (2 * x.order_count) AS DOUBLE) / 100 AS avg_items_per_order,
               x.promo_order_count, x.new_customer_orders, x.returning_customer_orders
        FROM (SELECT date_sk, store_id, city, channel, count(DISTINCT order_id) AS order_count,
                     sum(order_revenue) AS revenue, CAST(sum(items_per_order) AS BIGINT) AS total_items,
                     count(*) FILTER (promo_flag = 1) AS promo_order_count,
                     count(*) FILTER (new_vs_returning_customer_flag = 'New') AS new_customer_orders,
                     count(*) FILTER (new_vs_returning_customer_flag = 'Returning') AS returning_customer_orders
              FROM sold WHERE store_sk IS NOT NULL AND channel_sk IS NOT NULL
              GROUP BY date_sk, store_id, city, channel) x
        JOIN dim_date d ON d.date_sk = x.date_sk""",
    "vw_delivery_performance": """
        SELECT d.full_date, d.year, d.month, x.store_id, x.city, x.delivery_count, x.sla_met_count,
               CAST((2000 * x.sla_met_count + x.delivery_count) // (2 * x.delivery_count) AS DOUBLE) / 10 AS sla_compliance_pct,
               CAST((20 * x.minutes + x.delivery_count) // (2 * x.delivery_count) AS DOUBLE) / 10 AS avg_delivery_minutes,
               CAST(sign(x.delay) * ((20 * abs(x.delay) + x.delivery_count) // (2 * x.delivery_count)) AS DOUBLE) / 10 AS avg_delay_minutes
        FROM (SELECT f.date_sk, s.store_id, s.clean_city AS city, count(*) AS delivery_count,
                     CAST(sum(f.delivery_sla_met_flag) AS BIGINT) AS sla_met_count,
                     CAST(sum(f.actual_delivery_minutes) AS BIGINT) AS minutes,
                     CAST(sum(f.delay_minutes) AS BIGINT) AS delay
              FROM fact_deliveries f JOIN dim_store s ON s.store_sk = f.store_sk
              GROUP BY 1, 2, 3) x
        JOIN dim_date d ON d.date_sk = x.date_sk""",
    "vw_product_performance": """
        SELECT d.full_date, d.year, d.month, s.store_id, s.clean_city AS city, h.channel, p.product_id,
               p.unified_category AS category, CAST(sum(i.quantity) AS BIGINT) AS units_sold,
               CAST(sum(i.product_revenue) AS DOUBLE) AS product_revenue
        FROM fact_order_items i
        JOIN dim_product p ON p.product_sk = i.product_sk
        JOIN dim_channel h ON h.channel_sk = i.channel_sk
        JOIN dim_store s ON s.store_sk = i.store_sk
        JOIN dim_date d ON d.date_sk = i.date_sk
        GROUP BY ALL""",
    "vw_customer_summary": """
        SELECT c.customer_id, count(DISTINCT o.order_id) AS lifetime_order_count,
               CAST(sum(o.order_revenue) AS DOUBLE) AS lifetime_revenue,
               min(o.order_timestamp) AS first_order_at, max(o.order_timestamp) AS most_recent_order_at,
               max(o.customer_type) AS latest_customer_type
        FROM dim_customer c JOIN sold o ON o.customer_sk = c.customer_sk
        GROUP BY c.customer_id""",
}


def with_tables(select: str) -> str:
    """The query preceded by the definitions it needs, in order."""
    needed: set[str] = set()
    ordered: list[str] = []

    def visit(sql: str) -> None:
        for word in dict.fromkeys(re.findall(r"[a-z_][a-z_0-9]*", sql)):
            if word in TABLES and word not in needed:
                needed.add(word)
                visit(TABLES[word])
                ordered.append(word)

    visit(select)
    if not needed:
        return select
    # definitions may have been added in any order; names are visited before their users
    parts = [f"{n} AS MATERIALIZED ({TABLES[n]})" for n in ordered]
    head, body = "WITH " + ",\n".join(parts), select.strip()
    return f"{head},\n{body[5:]}" if body.startswith("WITH ") else f"{head}\n{body}"
