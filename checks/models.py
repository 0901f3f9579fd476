"""Staging, dimension, fact and view models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.lake import lake
from checks.registry import register
from galley.plans import marts, views


def money_out(df: DataFrame) -> DataFrame:
    """Decimal money as double, the form reports hand out."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


_MONEY = {
    "int_orders": ["subtotal_ngn", "discount_ngn", "tax_ngn", "total_amount_ngn"],
    "int_order_items": ["product_revenue"],
    "fact_orders": ["subtotal_ngn", "discount_ngn", "tax_ngn", "total_amount_ngn"],
    "fact_order_items": ["product_revenue"],
    "rpt_order_summary": ["order_revenue"],
}


def table_sql(name: str) -> str:
    replaced = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _MONEY.get(name, []))
    return f"SELECT * {f'REPLACE ({replaced}) ' if replaced else ''}FROM {name}"


_STAGED = {
    "stg1_int_customers": "int_customers",
    "stg2_int_stores": "int_stores",
    "stg3_int_products": "int_products",
    "stg4_int_orders": "int_orders",
    "stg5_int_deliveries": "int_deliveries",
    "stg6_int_order_items": "int_order_items",
}
_MARTS = {
    "dim1_dim_date": "dim_date",
    "dim2_dim_customer": "dim_customer",
    "dim3_dim_product": "dim_product",
    "dim4_dim_channel": "dim_channel",
    "dim5_dim_payment_method": "dim_payment_method",
    "dim6_dim_promo": "dim_promo",
    "dim7_dim_store": "dim_store",
    "fct1_fact_orders": "fact_orders",
    "fct2_fact_order_items": "fact_order_items",
    "fct3_fact_deliveries": "fact_deliveries",
}


def _staged(name):
    return lambda spark, sf: money_out(lake(spark, sf).build_staged(name))


def _mart(name):
    return lambda spark, sf: money_out(lake(spark, sf).build_mart(name))


for key, name in _STAGED.items():
    register(key, _staged(name), table_sql(name))
for key, name in _MARTS.items():
    register(key, _mart(name), table_sql(name))

VIEW_INPUTS = {
    "rpt_order_summary": (marts.rpt_order_summary, ["fact_orders", "fact_order_items"]),
    "vw_sales_performance": (
        views.vw_sales_performance,
        ["order_sales", "dim_date", "dim_store", "dim_channel"],
    ),
    "vw_delivery_performance": (
        views.vw_delivery_performance,
        ["fact_deliveries", "dim_date", "dim_store"],
    ),
    "vw_product_performance": (
        views.vw_product_performance,
        ["fact_order_items", "dim_date", "dim_store", "dim_channel", "dim_product"],
    ),
    "vw_customer_summary": (
        views.vw_customer_summary,
        ["order_sales", "dim_customer"],
    ),
}


def view(spark, sf, name) -> DataFrame:
    build, inputs = VIEW_INPUTS[name]
    return build(*lake(spark, sf).many(*inputs))


def _view(name):
    return lambda spark, sf: money_out(view(spark, sf, name))


for number, name in enumerate(VIEW_INPUTS, start=1):
    register(f"vw{number}_{name.removeprefix('vw_')}", _view(name), table_sql(name))
