"""The data-quality checks: names, severities and the wording of their exceptions."""

from __future__ import annotations

from typing import NamedTuple


class Check(NamedTuple):
    name: str
    severity: str
    minimum: int
    source_table: str
    issue: str | None = None
    action: str | None = None


# Check names, severities, tables, issues and recommended actions. Checks
# without an issue report a number only.
CHECKS = (
    Check("customers_record_count", "ERROR", 1, "staging.int_customers"),
    Check("stores_record_count", "ERROR", 1, "staging.int_stores"),
    Check("products_record_count", "ERROR", 1, "staging.int_products"),
    Check("orders_record_count", "ERROR", 1, "staging.int_orders"),
    Check("order_items_record_count", "ERROR", 1, "staging.int_order_items"),
    Check("deliveries_record_count", "ERROR", 1, "staging.int_deliveries"),
    Check("duplicate_customer_id", "ERROR", 0, "staging.int_customers"),
    Check("duplicate_store_id", "ERROR", 0, "staging.int_stores"),
    Check("duplicate_product_id", "ERROR", 0, "staging.int_products"),
    Check(
        "duplicate_order_id", "ERROR", 0, "staging.int_orders",
        "Duplicate order_id remains after staging",
        "Investigate source replay/correction logic and keep only the latest valid business record.",
    ),
    Check(
        "duplicate_order_item_key", "ERROR", 0, "staging.int_order_items",
        "Duplicate order/product line key remains after staging",
        "Investigate duplicated line items and reconcile with order subtotal before reporting product mix.",
    ),
    Check(
        "orphan_order_customer", "ERROR", 0, "staging.int_orders",
        "Order customer_id does not exist in customer master",
        "Hold affected order from trusted reporting until customer master is corrected or mapping is supplied.",
    ),
    Check(
        "orphan_order_store", "ERROR", 0, "staging.int_orders",
        "Order store_id does not exist in store master",
        "Hold affected order from trusted reporting until store master is corrected or mapping is supplied.",
    ),
    Check(
        "orphan_item_order", "ERROR", 0, "staging.int_order_items",
        "Order item has no matching order header",
        "Quarantine affected line item and request source-system replay or order-header correction.",
    ),
    Check(
        "orphan_item_product", "ERROR", 0, "staging.int_order_items",
        "Order item product_id does not exist in product master",
        "Hold product-level reporting for affected line until product master mapping is supplied.",
    ),
    Check(
        "orphan_delivery_order", "ERROR", 0, "staging.int_deliveries",
        "Delivery record has no matching order header",
        "Quarantine affected delivery record and request source-system replay or order-header correction.",
    ),
    Check(
        "null_critical_order_fields", "ERROR", 0, "staging.int_orders",
        "Order has a null critical key or timestamp",
        "Reject affected order from reporting until required key fields and timestamp are supplied.",
    ),
    Check(
        "negative_order_amount", "ERROR", 0, "staging.int_orders",
        "Negative subtotal or total amount",
        "Reject affected order from financial reporting until source amount is corrected.",
    ),
    Check(
        "negative_item_revenue", "ERROR", 0, "staging.int_order_items",
        "Negative product revenue or non-positive quantity",
        "Reject affected line item from product reporting until source amount or quantity is corrected.",
    ),
    Check(
        "invalid_channel", "ERROR", 0, "staging.int_orders",
        "Order channel is null or outside the accepted channel set",
        "Map the channel to an approved reporting value or correct the source feed.",
    ),
    Check(
        "missing_delivery_for_delivery_order", "ERROR", 0, "staging.int_orders",
        "Delivery or Online App order has no delivery record",
        "Hold delivery SLA reporting for affected order and request missing delivery feed record.",
    ),
    Check(
        "invalid_delivery_sla_flag", "ERROR", 0, "staging.int_deliveries",
        "Delivery SLA flag is null or outside 0/1",
        "Recompute or correct SLA flag before reporting SLA compliance.",
    ),
    Check(
        "invalid_delivery_time", "ERROR", 0, "staging.int_deliveries",
        "Delivery timing fields are null or non-positive",
        "Exclude from SLA metrics until delivery timing is corrected.",
    ),
    Check("invalid_order_timestamp", "ERROR", 0, "staging.int_orders"),
    Check("discount_exceeds_subtotal", "ERROR", 0, "staging.int_orders"),
    Check(
        "order_total_formula_mismatch", "ERROR", 0, "staging.int_orders",
        "Order total does not equal subtotal minus discount plus tax and delivery fee",
        "Reject from financial reporting if variance exceeds tolerance; otherwise document rounding rule.",
    ),
    Check(
        "order_items_count_mismatch", "ERROR", 0, "staging.int_orders",
        "Order items_count does not match the number of order item rows",
        "Reconcile order header and line-item feed before using item count metrics.",
    ),
    Check(
        "order_quantity_total_mismatch", "ERROR", 0, "staging.int_orders",
        "Order qty_total does not match summed item quantity",
        "Reconcile order header and line-item feed before using quantity metrics.",
    ),
    Check(
        "missing_fact_store_mapping", "ERROR", 0, "marts.fact_orders",
        "Fact order did not resolve to a store surrogate key",
        "Fix store SCD effective dating or source store mapping before BI refresh.",
    ),
    Check(
        "missing_fact_product_mapping", "ERROR", 0, "marts.fact_order_items",
        "Fact order item did not resolve to a product surrogate key",
        "Fix product dimension mapping before BI product reporting.",
    ),
    Check("duplicate_dim_customer_sk", "ERROR", 0, "marts.dim_customer"),
    Check("duplicate_dim_product_sk", "ERROR", 0, "marts.dim_product"),
    Check("duplicate_dim_store_current_row", "ERROR", 0, "marts.dim_store"),
    Check(
        "duplicate_fact_order_item_grain", "ERROR", 0, "marts.fact_order_items",
        "Fact order item has more than one row at its declared order/product grain",
        "Deduplicate line items or introduce a true line-item identifier before product reporting.",
    ),
    Check(
        "fact_orders_null_foreign_key", "ERROR", 0, "marts.fact_orders",
        "Fact order contains a null dimensional foreign key",
        "Fix the upstream dimension mapping before publishing the BI semantic layer.",
    ),
    Check(
        "fact_order_items_null_foreign_key", "ERROR", 0, "marts.fact_order_items",
        "Fact order item contains a null dimensional foreign key",
        "Fix product, store, channel, or date mapping before publishing product BI metrics.",
    ),
    Check(
        "fact_deliveries_null_foreign_key", "ERROR", 0, "marts.fact_deliveries",
        "Fact delivery contains a null dimensional foreign key",
        "Fix store or date mapping before publishing delivery BI metrics.",
    ),
    Check(
        "promo_with_zero_discount", "WARN", 0, "staging.int_orders",
        "Promo code supplied with zero discount",
        "Load order, but ask commercial team to confirm whether promo code was informational or discount was missed.",
    ),
    Check(
        "late_arriving_order_records", "WARN", 0, "staging.int_orders",
        "Order business date is more than one day before its load date",
        "Load record and preserve raw audit trail; review whether it is a correction/backfill and rerun impacted reporting date.",
    ),
    Check(
        "unusual_daily_order_volume_change", "WARN", 0, "staging.int_orders",
        "Daily order volume changed by more than 50 percent versus the prior day",
        "Load data, but compare to source-system control totals and confirm no missing file/store/channel before dashboard sign-off.",
    ),
    Check(
        "order_item_subtotal_mismatch", "ERROR", 0, "staging.int_orders",
        "Order item revenue does not reconcile to order subtotal",
        "Reject affected order from product/revenue reporting until order lines or order header are corrected.",
    ),
)

# How each severity is handled.
RULEBOOK = (
    (
        "ERROR",
        "reject_or_fix_before_reporting",
        "Breaks completeness, key integrity, financial correctness, or BI joins.",
    ),
    (
        "WARN",
        "load_but_review",
        "Does not block reporting, but should be reviewed by data owner or operations.",
    ),
)
