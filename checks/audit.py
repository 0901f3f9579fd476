"""Quality checks, exceptions, reconciliation, profiles and monitoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import mapping
from checks.lake import lake
from checks.models import view
from checks.oracle_tables import TABLES
from checks.registry import query, register
from galley.plans import monitoring, profiling
from galley.plans.quality import (
    AuditFailed,
    QualityAudit,
    exception_summary,
    manual_run,
    require_passed,
    rulebook,
)
from galley.plans.quality_texts import CHECKS, RULEBOOK
from galley.plans.reconcile import reconciliation
from galley.sources.contracts import ENTITIES

RUN = manual_run(mapping.RUN_DATE, earliest_order=mapping.EARLIEST_ORDER)

STAGED = [f"int_{e}" for e in ENTITIES]
FACTS = ["fact_orders", "fact_order_items", "fact_deliveries"]
AUDITED = [
    *STAGED,
    *FACTS,
    "order_sales",
    "dim_customer",
    "dim_product",
    "dim_store",
    "dim_channel",
    "dim_promo",
]


def tables(spark, sf):
    return {n: lake(spark, sf).any(n) for n in AUDITED}


def audit(spark, sf) -> QualityAudit:
    return QualityAudit(tables(spark, sf), RUN)


def _shared_audit(spark, sf) -> QualityAudit:
    """The one audit behind the stored results and exceptions, so that tables are tagged once."""

    def prepared() -> QualityAudit:
        found = audit(spark, sf)
        found.prepare()
        return found

    return lake(spark, sf).shared("audit", prepared)


# oracles -----------------------------------------------------------------------------

_EARLIEST, _TODAY = mapping.EARLIEST_ORDER, mapping.RUN_DATE

TABLES["line_sums"] = """
    SELECT order_id, count(*) AS n, sum(quantity) AS units, sum(product_revenue) AS revenue
    FROM int_order_items GROUP BY order_id"""
TABLES["day_counts"] = """
    SELECT b.d, b.n, a.n AS n_before FROM
      (SELECT *, row_number() OVER (ORDER BY d) AS i FROM
          (SELECT order_timestamp::DATE AS d, count(*) AS n FROM int_orders GROUP BY 1)) b
      JOIN (SELECT *, row_number() OVER (ORDER BY d) AS i FROM
          (SELECT order_timestamp::DATE AS d, count(*) AS n FROM int_orders GROUP BY 1)) a
      ON a.i + 1 = b.i"""

_LINE = "x.order_id || '|' || x.product_id"
# check -> table, condition, key
_ROW_CHECKS = {
    "orphan_order_customer": ("int_orders", "NOT EXISTS (FROM int_customers c WHERE c.customer_id = x.customer_id)", "x.order_id"),
    "orphan_order_store": ("int_orders", "NOT EXISTS (FROM int_stores s WHERE s.store_id = x.store_id)", "x.order_id"),
    "orphan_item_order": ("int_order_items", "NOT EXISTS (FROM int_orders o WHERE o.order_id = x.order_id)", _LINE),
    "orphan_item_product": ("int_order_items", "NOT EXISTS (FROM int_products p WHERE p.product_id = x.product_id)", _LINE),
    "orphan_delivery_order": ("int_deliveries", "NOT EXISTS (FROM int_orders o WHERE o.order_id = x.order_id)", "x.order_id"),
    "null_critical_order_fields": ("int_orders", "(x.order_id || x.customer_id || x.store_id || x.order_timestamp::VARCHAR) IS NULL", "x.order_id"),
    "negative_order_amount": ("int_orders", "least(x.subtotal_ngn, x.total_amount_ngn) < 0", "x.order_id"),
    "negative_item_revenue": ("int_order_items", "x.product_revenue < 0 OR x.quantity < 1", _LINE),
    "invalid_channel": ("int_orders", "ifnull(x.channel, '') NOT IN ('Delivery', 'Dine-in', 'Online App', 'Takeaway')", "x.order_id"),
    "missing_delivery_for_delivery_order": ("int_orders", "x.channel IN ('Online App', 'Delivery') AND NOT EXISTS (FROM int_deliveries d WHERE d.order_id = x.order_id)", "x.order_id"),
    "invalid_delivery_sla_flag": ("int_deliveries", "ifnull(x.delivery_sla_met_flag, -1) NOT BETWEEN 0 AND 1", "x.order_id"),
    "invalid_delivery_time": ("int_deliveries", "ifnull(x.promised_delivery_minutes, 0) < 1 OR ifnull(x.actual_delivery_minutes, 0) < 1", "x.order_id"),
    "invalid_order_timestamp": ("int_orders", f"x.order_timestamp IS NULL OR x.order_timestamp < '{_EARLIEST}' OR x.order_timestamp >= DATE '{_TODAY}' + 2", "x.order_id"),
    "discount_exceeds_subtotal": ("int_orders", "x.subtotal_ngn < x.discount_ngn", "x.order_id"),
    "order_total_formula_mismatch": ("int_orders", "NOT (x.subtotal_ngn + x.tax_ngn + x.delivery_fee_ngn - x.discount_ngn - x.total_amount_ngn BETWEEN -0.05 AND 0.05)", "x.order_id"),
    "order_items_count_mismatch": ("int_orders", "x.items_count <> (SELECT n FROM line_sums t WHERE t.order_id = x.order_id)", "x.order_id"),
    "order_quantity_total_mismatch": ("int_orders", "x.qty_total <> (SELECT units FROM line_sums t WHERE t.order_id = x.order_id)", "x.order_id"),
    "missing_fact_store_mapping": ("fact_orders", "x.store_sk IS NULL", "x.order_id"),
    "missing_fact_product_mapping": ("fact_order_items", "x.product_sk IS NULL", _LINE),
    "fact_orders_null_foreign_key": ("fact_orders", "(x.customer_sk + x.store_sk + x.channel_sk + x.payment_method_sk + x.promo_sk) IS NULL OR x.date_sk IS NULL", "x.order_id"),
    "fact_order_items_null_foreign_key": ("fact_order_items", "(x.product_sk + x.store_sk + x.channel_sk) IS NULL OR x.date_sk IS NULL", _LINE),
    "fact_deliveries_null_foreign_key": ("fact_deliveries", "x.store_sk IS NULL OR x.date_sk IS NULL", "x.order_id"),
    "promo_with_zero_discount": ("int_orders", "length(x.promo_code) > 0 AND x.discount_ngn = 0", "x.order_id"),
    "late_arriving_order_records": ("int_orders", f"x._loaded_at::DATE - x.order_timestamp::DATE > 1 AND DATE '{_TODAY}' - x.order_timestamp::DATE <= 30", "x.order_id"),
    "order_item_subtotal_mismatch": ("int_orders", "abs(x.subtotal_ngn - (SELECT revenue FROM line_sums t WHERE t.order_id = x.order_id)) > 0.01", "x.order_id"),
}
_DUPLICATES = {
    "duplicate_customer_id": ("int_customers", "customer_id"),
    "duplicate_store_id": ("int_stores", "store_id"),
    "duplicate_product_id": ("int_products", "product_id"),
    "duplicate_order_id": ("int_orders", "order_id"),
    "duplicate_order_item_key": ("int_order_items", "concat(order_id, '|', product_id)"),
    "duplicate_dim_customer_sk": ("dim_customer", "customer_sk"),
    "duplicate_dim_product_sk": ("dim_product", "product_sk"),
    "duplicate_dim_store_current_row": ("(FROM dim_store WHERE is_current)", "store_id"),
    "duplicate_fact_order_item_grain": ("fact_order_items", "order_id || '|' || product_id"),
}
_NO_FILE = ("missing_fact_store_mapping", "missing_fact_product_mapping")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_branches = [
    f"SELECT '{check}' AS check_name, {key} AS record_key, "
    + ("NULL AS source_file, NULL AS loaded_at" if check in _NO_FILE else "x._source_file AS source_file, x._loaded_at AS loaded_at")
    + f" FROM {table} x WHERE {condition}"
    for check, (table, condition, key) in _ROW_CHECKS.items()
]
_branches.append(
    "SELECT 'unusual_daily_order_volume_change', d::VARCHAR, NULL, NULL FROM day_counts "
    "WHERE n_before > 9 AND (n > 1.5 * n_before OR n < 0.5 * n_before)"
)
TABLES["dq_failing"] = "\nUNION ALL\n".join(_branches)
TABLES["dq_observed"] = "\nUNION ALL\n".join(
    ["SELECT check_name, count(*) AS observed_value FROM dq_failing GROUP BY 1"]
    + [
        f"SELECT '{check}', count(*) - count(DISTINCT {key}) FROM {table}"
        for check, (table, key) in _DUPLICATES.items()
    ]
    + [f"SELECT '{e}_record_count', count(*) FROM int_{e}" for e in ENTITIES]
)
TABLES["dq_listed"] = "SELECT * FROM (VALUES " + ", ".join(
    f"({_quoted(c.name)}, {_quoted(c.severity)}, {c.minimum}, {_quoted(c.source_table)}, "
    f"{_quoted(c.issue) if c.issue else 'NULL'}, {_quoted(c.action) if c.action else 'NULL'})"
    for c in CHECKS
) + ") t(check_name, severity, expected_minimum, source_table, issue, recommended_action)"
TABLES["dq_results"] = f"""
    SELECT '{RUN.run_id}' AS run_id, DATE '{RUN.execution_date}' AS execution_date, check_name, severity,
           ifnull(observed_value, 0) AS observed_value, expected_minimum,
           CASE WHEN check_name LIKE '%record_count'
                THEN (CASE WHEN ifnull(observed_value, 0) < expected_minimum THEN 'FAIL' ELSE 'PASS' END)
                WHEN ifnull(observed_value, 0) <= expected_minimum THEN 'PASS'
                WHEN severity = 'ERROR' THEN 'FAIL' ELSE 'WARN' END AS status
    FROM dq_listed LEFT JOIN dq_observed USING (check_name)"""
TABLES["dq_exceptions"] = f"""
    SELECT '{RUN.run_id}' AS run_id, DATE '{RUN.execution_date}' AS execution_date, check_name, severity,
           source_table, record_key, issue, recommended_action, source_file, loaded_at
    FROM dq_failing JOIN dq_listed USING (check_name) WHERE issue IS NOT NULL"""


def _pairs(level, key, metric, source, report):
    """Both sides in one list, summed per key: a full join without a join."""
    both = f"""
        SELECT key, CAST(sum(s) AS DOUBLE) AS source_value, CAST(sum(r) AS DOUBLE) AS reporting_value
        FROM (SELECT {key} AS key, {source[0]} AS s, 0 AS r, 's' AS side FROM {source[1]}
              UNION ALL SELECT {report[2] if len(report) > 2 else key}, 0, {report[0]}, 'r' FROM {report[1]})
        GROUP BY key, CASE WHEN key IS NULL THEN side END"""
    return f"""SELECT '{level}' AS reconciliation_level, '{metric}' AS metric,
        ifnull(key, '{'ALL' if level == 'overall' else 'UNKNOWN'}') AS dimension_key, source_value, reporting_value FROM ({both})"""


_ALL = "'ALL'"
TABLES["fact_revenue"] = """
    SELECT f.*, r.order_revenue, s.store_id, h.channel, p.promo_code
    FROM fact_orders f LEFT JOIN rpt_order_summary r ON r.order_id = f.order_id
    LEFT JOIN dim_store s ON s.store_sk = f.store_sk
    LEFT JOIN dim_channel h ON h.channel_sk = f.channel_sk
    LEFT JOIN dim_promo p ON p.promo_sk = f.promo_sk"""
TABLES["delivery_site"] = """
    SELECT f.*, s.store_id FROM fact_deliveries f LEFT JOIN dim_store s ON s.store_sk = f.store_sk"""
_RECON = [
    ("overall", _ALL, "orders_count", ("1", "int_orders"), ("1", "fact_orders")),
    ("overall", _ALL, "deliveries_count", ("1", "int_deliveries"), ("1", "fact_deliveries")),
    ("overall", _ALL, "order_items_count", ("1", "int_order_items"), ("1", "fact_order_items")),
    ("overall", _ALL, "order_subtotal_ngn", ("subtotal_ngn", "int_orders"), ("order_revenue", "rpt_order_summary")),
    ("overall", _ALL, "product_revenue_ngn", ("product_revenue", "int_order_items"), ("product_revenue", "fact_order_items")),
    ("overall", _ALL, "delivery_sla_met_count", ("delivery_sla_met_flag", "int_deliveries"), ("delivery_sla_met_flag", "fact_deliveries")),
    ("overall", _ALL, "promo_order_count", ("CASE WHEN length(promo_code) > 0 THEN 1 ELSE 0 END", "int_orders"), ("promo_flag", "fact_orders")),
    ("store", "store_id", "orders_count", ("1", "int_orders"), ("1", "fact_revenue")),
    ("store", "store_id", "order_subtotal_ngn", ("subtotal_ngn", "int_orders"), ("order_revenue", "fact_revenue")),
    ("channel", "channel", "orders_count", ("1", "int_orders"), ("1", "fact_revenue")),
    ("channel", "channel", "order_subtotal_ngn", ("subtotal_ngn", "int_orders"), ("order_revenue", "fact_revenue")),
    ("product", "product_id", "product_revenue_ngn", ("product_revenue", "int_order_items"), ("product_revenue", "fact_order_items")),
    ("promo", "CASE WHEN length(promo_code) > 0 THEN promo_code ELSE 'NO_PROMO' END", "orders_count", ("1", "int_orders"), ("1", "fact_revenue", "ifnull(promo_code, 'NO_PROMO')")),
    ("delivery_store", "store_id", "deliveries_count", ("1", "int_deliveries"), ("1", "delivery_site")),
]
TABLES["recon"] = f"""
    SELECT '{RUN.run_id}' AS run_id, DATE '{RUN.execution_date}' AS execution_date, *,
           reporting_value - source_value AS variance,
           CASE WHEN abs(reporting_value - source_value) < 0.01 THEN 'PASS' ELSE 'FAIL' END AS status
    FROM (""" + "\nUNION ALL\n".join(_pairs(*r) for r in _RECON) + ")"


# queries -----------------------------------------------------------------------------


def _stored_results(spark, sf):
    return lake(spark, sf).audited("data_quality_results", lambda: _shared_audit(spark, sf).results())


def _stored_exceptions(spark, sf):
    return lake(spark, sf).audited("data_quality_exceptions", lambda: _shared_audit(spark, sf).exceptions())


def _stored_recon(spark, sf):
    return lake(spark, sf).audited("reconciliation", lambda: reconciliation(tables(spark, sf), RUN))


@query("dq1_41_results", "SELECT * FROM dq_results")
def results(spark, sf):
    return audit(spark, sf).results().drop("checked_at")


@query("exc1_exceptions", "SELECT * FROM dq_exceptions")
def exceptions(spark, sf):
    return audit(spark, sf).exceptions().drop("detected_at")


register(
    "exc2_rulebook",
    lambda spark, sf: rulebook(spark).join(
        _stored_exceptions(spark, sf).groupBy("severity").agg(F.count("*").alias("exception_count")),
        "severity",
    ),
    "SELECT severity, handling_action, handling_notes, exception_count FROM (VALUES "
    + ", ".join("(" + ", ".join(_quoted(v) for v in row) + ")" for row in RULEBOOK)
    + ") t(severity, handling_action, handling_notes) JOIN "
    "(SELECT severity, count(*) AS exception_count FROM dq_exceptions GROUP BY 1) USING (severity)",
)


def _history(spark, sf, name, rows, runs):
    """A history in which some run was written twice."""
    store = lake(spark, sf).store
    for run in runs:
        store.write_partition("audit", name, rows.drop("run_id"), "run_id", run)
    return store.read_all("audit", name, "run_id")


@query(
    "exc3_history",
    "SELECT * REPLACE ('first' AS run_id) FROM dq_results UNION ALL SELECT * REPLACE ('second' AS run_id) FROM dq_results",
)
def history(spark, sf):
    rows = _stored_results(spark, sf).drop("checked_at")
    return _history(spark, sf, "data_quality_results_history", rows, ("first", "second", "second"))


@query(
    "exc3_exception_history",
    "SELECT * REPLACE ('2001:a' AS run_id) FROM dq_exceptions",
)
def exception_history(spark, sf):
    """A run whose rerun finds nothing keeps no rows."""
    rows = _stored_exceptions(spark, sf).drop("detected_at")
    store = lake(spark, sf).store
    for run, found in (("2001:a", rows), ("2001:b", rows), ("2001:b", rows.where("false"))):
        store.write_partition("audit", "exceptions_history", found.drop("run_id"), "run_id", run)
    return store.read_all("audit", "exceptions_history", "run_id")


@query(
    "vw6_exception_summary",
    "SELECT check_name, severity, source_table, count(*) AS exception_count FROM dq_exceptions GROUP BY ALL",
)
def summary(spark, sf):
    found = exception_summary(_stored_exceptions(spark, sf))
    return found.drop("first_detected_at", "last_detected_at")


_COUNTED = ["int_orders", "int_order_items", "int_deliveries", *FACTS]


def _layer(name):
    return f"staging.{name}" if name.startswith("int_") else f"marts.{name}"


@query(
    "vw7_run_summary",
    "\nUNION ALL\n".join(
        [
            f"SELECT 'row_counts' AS section, '{_layer(n)}' AS item, NULL AS detail, count(*) AS total FROM {n}"
            for n in _COUNTED
        ]
        + [
            "SELECT 'quality', status, NULL, count(*) FROM dq_results GROUP BY status",
            "SELECT 'reconciliation', status, NULL, count(*) FROM recon GROUP BY status",
            "SELECT * FROM (SELECT 'exceptions', check_name, severity, count(*) FROM dq_exceptions "
            "GROUP BY check_name, severity, source_table ORDER BY severity, check_name LIMIT 10)",
        ]
    ),
)
def run_summary(spark, sf):
    here = tables(spark, sf)
    return monitoring.run_summary(
        {_layer(n): here[n] for n in _COUNTED},
        _stored_results(spark, sf),
        _stored_recon(spark, sf),
        _stored_exceptions(spark, sf),
    )


@query(
    "gate1_audit_gate",
    """SELECT 'quality_checks' AS kind, check_name AS name, 1 AS failures FROM dq_results WHERE status = 'FAIL'
       UNION ALL SELECT 'reconciliation_metrics', metric, count(*) FROM recon WHERE status = 'FAIL' GROUP BY metric
       UNION ALL SELECT 'error_exception_counts', check_name, count(*) FROM dq_exceptions
       WHERE severity = 'ERROR' GROUP BY check_name""",
)
def gate(spark, sf):
    kinds = {"check": "quality_checks", "metric": "reconciliation_metrics", "exception": "error_exception_counts"}
    found = []
    try:
        require_passed(_stored_results(spark, sf), _stored_recon(spark, sf), _stored_exceptions(spark, sf))
    except AuditFailed as failure:
        found = [(kinds[b["kind"]], b["name"], b["failures"]) for b in failure.blockers]
    return spark.createDataFrame(found, "kind string, name string, failures bigint")


@query("rec1_14_reconciliation", "SELECT * FROM recon")
def recon(spark, sf):
    return reconciliation(tables(spark, sf), RUN).drop("reconciled_at")


@query("rec15_history", "SELECT * REPLACE ('one' AS run_id) FROM recon UNION ALL SELECT * REPLACE ('two' AS run_id) FROM recon")
def recon_history(spark, sf):
    rows = _stored_recon(spark, sf).drop("reconciled_at")
    return _history(spark, sf, "reconciliation_history", rows, ("one", "two", "one"))


# profiles ----------------------------------------------------------------------------


def sources(spark, sf):
    return {e: lake(spark, sf).typed(e) for e in ENTITIES}


def _profile_sql(entity):
    keys, critical, date = profiling.PROFILED[entity]
    key = " || '|' || ".join(keys)
    day = f"{date}::DATE" if date else "NULL::DATE"
    missing = " OR ".join(f"{c} IS NULL" for c in critical)
    return f"""SELECT '{entity}.json' AS source_file, count(*) AS record_count,
        count(DISTINCT {key}) AS distinct_business_keys, count(*) - count(DISTINCT {key}) AS duplicate_business_keys,
        count(*) FILTER ({missing}) AS null_critical_keys, min({day}) AS min_business_date,
        max({day}) AS max_business_date FROM src_{entity}"""


register(
    "prf1_source_profile",
    lambda spark, sf: profiling.source_profile(sources(spark, sf)),
    "\nUNION ALL\n".join(_profile_sql(e) for e in ENTITIES),
)
register(
    "prf2_relationship_profile",
    lambda spark, sf: profiling.relationship_profile(sources(spark, sf)),
    "\nUNION ALL\n".join(
        f"SELECT '{c}.{k} -> {p}.{k}' AS relationship, count(*) AS orphan_count FROM src_{c} c "
        f"WHERE NOT EXISTS (FROM src_{p} p WHERE p.{k} = c.{k})"
        for c, k, p in profiling.RELATIONSHIPS
    ),
)
register(
    "prf3_exact_duplicates",
    lambda spark, sf: profiling.exact_duplicates(sources(spark, sf)),
    "\nUNION ALL\n".join(
        f"SELECT '{e}' AS source, (SELECT count(*) FROM src_{e}) - (SELECT count(*) FROM "
        f"(SELECT DISTINCT {'* EXCLUDE (supplier_key)' if e == 'order_items' else '*'} FROM src_{e})) AS duplicate_rows"
        for e in ENTITIES
    ),
)
register(
    "prf4_outside_opening_hours",
    lambda spark, sf: profiling.outside_opening_hours(
        lake(spark, sf).typed("orders"), lake(spark, sf).typed("stores")
    ),
    """SELECT o.store_id, count(*) AS orders_outside_hours FROM src_orders o JOIN src_stores_2 s USING (store_id)
       WHERE o.order_ts::TIME < split_part(s.opening_hours, '-', 1)::TIME
          OR o.order_ts::TIME > split_part(s.opening_hours, '-', 2)::TIME GROUP BY 1""",
)
register(
    "prf5_price_differences",
    lambda spark, sf: profiling.price_differences(
        lake(spark, sf).typed("order_items"), lake(spark, sf).typed("products")
    ),
    """SELECT count(*) AS lines, count(*) FILTER (i.unit_price_ngn <> p.base_price_ngn) AS lines_off_list_price
       FROM kept_lines i JOIN src_products p USING (product_id)""",
)
register(
    "prf6_timing_agreement",
    lambda spark, sf: profiling.timing_agreement(
        lake(spark, sf).typed("orders"), lake(spark, sf).typed("deliveries")
    ),
    """SELECT count(*) AS compared,
              count(*) FILTER (same) AS agreeing, count(*) FILTER (NOT same) AS differing
       FROM (SELECT o.promised_delivery_minutes IS NOT DISTINCT FROM d.promised_delivery_minutes
                AND o.actual_delivery_minutes IS NOT DISTINCT FROM d.actual_delivery_minutes AS same
             FROM src_orders o JOIN src_deliveries d USING (order_id))""",
)
register(
    "prf7_promos_without_discount",
    lambda spark, sf: profiling.promos_without_discount(lake(spark, sf).typed("orders")),
    """SELECT promo_code, count(*) AS orders_without_discount FROM src_orders
       WHERE promo_code <> '' AND discount_ngn = 0 GROUP BY 1""",
)

# monitoring --------------------------------------------------------------------------

_WATCHED = STAGED


@query(
    "mon1_freshness",
    "\nUNION ALL\n".join(
        f"SELECT '{n}' AS table_name, max(_loaded_at) AS last_loaded_at, "
        f"CAST(DATE '{_TODAY}' - max(_loaded_at)::DATE AS INTEGER) AS age_days, "
        f"DATE '{_TODAY}' - max(_loaded_at)::DATE > 1 AS is_stale FROM {n}"
        for n in _WATCHED
    ),
)
def fresh(spark, sf):
    return monitoring.freshness({n: lake(spark, sf).staged(n) for n in _WATCHED}, mapping.RUN_DATE)


@query(
    "mon2_missing_store_days",
    """SELECT store_id, full_date FROM
         (SELECT store_id, min(full_date) AS first FROM vw_sales_performance GROUP BY 1) s
         JOIN dim_date d ON d.full_date >= s.first
       EXCEPT SELECT store_id, full_date FROM vw_sales_performance""",
)
def missing_days(spark, sf):
    return monitoring.missing_store_days(
        view(spark, sf, "vw_sales_performance"), lake(spark, sf).mart("dim_date")
    )


@query(
    "mon3_daily_variance",
    """SELECT full_date, order_count, CAST(revenue AS DOUBLE) AS total_revenue,
              order_count - lag(order_count) OVER d AS order_count_change,
              CAST(revenue - lag(revenue) OVER d AS DOUBLE) AS revenue_change,
              CASE WHEN lag(revenue) OVER d <> 0 THEN sign(units - lag(units) OVER d) * sign(lag(units) OVER d) * CAST((2000 * abs(units - lag(units) OVER d) + abs(lag(units) OVER d)) // (2 * abs(lag(units) OVER d)) AS DOUBLE) / 10 END AS revenue_change_pct
       FROM (SELECT full_date, CAST(sum(order_count) AS BIGINT) AS order_count,
                    sum(CAST(total_revenue AS DECIMAL(28,4))) AS revenue,
                    CAST(sum(CAST(total_revenue AS DECIMAL(28,4))) * 10000 AS HUGEINT) AS units
             FROM vw_sales_performance GROUP BY full_date)
       WINDOW d AS (ORDER BY full_date)""",
)
def variance(spark, sf):
    return monitoring.daily_variance(view(spark, sf, "vw_sales_performance"))
