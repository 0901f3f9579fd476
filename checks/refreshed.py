"""The report views from sums by month, after a first state and a refresh to all rows.

A store is refreshed for one view, and holds only what that view is made from. The first state lacks the last year of orders and the delivery orders of the second month;
lines of the first month carry twice their revenue, and stores are as of their first
snapshot. The refresh then meets late, corrected and new rows and moved stores, and its
views have to equal those of the whole tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import mapping
from checks.lake import lake
from checks.models import money_out, table_sql
from checks.registry import register
from galley.operators.durable import shared_folder
from galley.plans import refresh
from galley.plans.quality import AuditRun
from galley.sources.store import TableStore

_STORES: dict[tuple[str, str, str], TableStore] = {}
_TABLES = ("int_orders", "int_customers", "int_products")
_SALES = (*_TABLES, "int_order_items")
_NEEDED = {
    "vw_sales_performance": _SALES,
    "vw_delivery_performance": (*_TABLES, "int_deliveries"),
    "vw_product_performance": _SALES,
    "vw_customer_summary": _SALES,
}


def _first_state(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    orders = tables["int_orders"]
    first, last = orders.agg(F.min("order_timestamp"), F.max("order_timestamp")).first()
    corrected = dt.datetime(first.year, first.month, 1)
    late = (corrected + dt.timedelta(days=32)).replace(day=1)
    after_late = (late + dt.timedelta(days=32)).replace(day=1)
    when = F.col("order_timestamp")

    def within(a: dt.datetime, b: dt.datetime):
        return (when >= F.lit(a)) & (when < F.lit(b))

    there = F.coalesce(when < F.lit(dt.datetime(last.year, 1, 1)), F.lit(True))
    missing = F.coalesce(within(late, after_late) & (F.col("channel") == "Delivery"), F.lit(False))
    first_state = tables | {"int_orders": orders.where(there & ~missing)}
    if lines := tables.get("int_order_items"):
        kind = lines.schema["product_revenue"].dataType
        twice = F.when(within(corrected, late), 2).otherwise(1)
        first_state["int_order_items"] = lines.where(there & ~missing).withColumn(
            "product_revenue", (F.col("product_revenue") * twice).cast(kind)
        )
    if deliveries := tables.get("int_deliveries"):
        first_state["int_deliveries"] = deliveries.where(there)
    return first_state


def _run(day: dt.date) -> AuditRun:
    return AuditRun(f"refresh-{day}", day, day)


def refreshed(spark, sf_dir, view) -> TableStore:
    key = (spark.sparkContext.applicationId, sf_dir, view)
    if key not in _STORES:
        whole = lake(spark, sf_dir)
        # deliveries are made from the orders as they come
        tables = {n: whole.staged(n, again="int_deliveries" in _NEEDED[view]) for n in _NEEDED[view]}
        store = TableStore(
            spark, f"{shared_folder(spark)}/refreshed/{key[0]}/{sf_dir.strip('/').replace('/', '_')}/{view}"
        )
        sums = refresh.VIEWS[view][1][:1]
        states = (
            (mapping.FIRST_LOAD, _first_state(tables), 1),
            (mapping.SECOND_LOAD, tables, 2),
        )
        for day, state, snapshot in states:
            with store.release() as release:
                refresh.refresh_marts(release, state | {"int_stores": whole.store_snapshot(snapshot)}, _run(day), sums)
        _STORES[key] = store
    return _STORES[key]


def _view(name: str):
    return lambda spark, sf: money_out(refresh.stored_views(refreshed(spark, sf, name).snapshot(), [name])[name])


for number, name in enumerate(
    ("vw_sales_performance", "vw_delivery_performance", "vw_product_performance", "vw_customer_summary"), start=2
):
    register(f"vw{number}_refreshed_{name.removeprefix('vw_')}", _view(name), table_sql(name))
