"""One run over a source drop: land, convert, stage, model, audit, and mark as done.

Tables are stored at the end of every layer, so a failed run can be repeated from the
start at any time: each step replaces what an earlier attempt has written. Staging, marts
and audit tables of a run are published at once, so readers never meet tables of two runs.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from galley.operators.together import together
from galley.plans import marts, staging
from galley.plans.quality import AuditRun, QualityAudit, require_passed, rulebook
from galley.plans.reconcile import reconciliation
from galley.plans.refresh import MONTH, by_month, refresh_marts
from galley.sources import convert, drops
from galley.sources.contracts import ENTITIES
from galley.sources.store import TableStore

Tables = dict[str, DataFrame]


def build_staging(store: TableStore, run: AuditRun, partition_facts: bool = False) -> Tables:
    """Stage all loads of every source; lines come last, as they take over order columns.

    ``partition_facts`` lays orders, lines and deliveries out by month.
    """
    batch = staging.run_batch_id("staging", run.execution_date)

    def stage(entity: str, *parents: DataFrame) -> DataFrame:
        name = f"int_{entity}"
        build = getattr(staging, name)
        rows = build(store.read_loads(entity), *parents, batch)
        if partition_facts and "order_timestamp" in rows.columns:
            return store.replace("staging", name, by_month(rows), [MONTH])
        return store.replace("staging", name, rows)

    staged = together(
        {f"int_{e}": lambda e=e: stage(e) for e in ENTITIES if e != "order_items"}
    )
    staged["int_order_items"] = stage("order_items", staged["int_orders"])
    return staged


def build_marts(
    store: TableStore, t: Mapping[str, DataFrame], run: AuditRun, partition_facts: bool = False
) -> Tables:
    """Bring the store versions up to date and rebuild all other dimensions and facts.

    ``partition_facts`` lays the facts out by month and rebuilds months that have changed
    only, which is meant for large warehouses.
    """
    if partition_facts:
        return refresh_marts(store, t, run)[0]

    def keep(name: str, df: DataFrame) -> DataFrame:
        return store.replace("marts", name, df)

    def stores() -> DataFrame:
        before = store.latest("marts", "dim_store")
        after = marts.dim_store(t["int_stores"], before, run.execution_date)
        return store.advance("marts", "dim_store", after)

    from_orders = ("dim_date", "dim_channel", "dim_payment_method", "dim_promo")
    built = together(
        {
            "dim_store": stores,
            "dim_customer": lambda: keep("dim_customer", marts.dim_customer(t["int_customers"])),
            "dim_product": lambda: keep("dim_product", marts.dim_product(t["int_products"])),
            **{n: lambda n=n: keep(n, getattr(marts, n)(t["int_orders"])) for n in from_orders},
        }
    )
    dims = built.copy()
    places, channels = dims["dim_store"], dims["dim_channel"]
    built |= together(
        {
            "fact_orders": lambda: keep(
                "fact_orders",
                marts.fact_orders(
                    t["int_orders"],
                    dims["dim_customer"],
                    places,
                    channels,
                    dims["dim_payment_method"],
                    dims["dim_promo"],
                ),
            ),
            "fact_order_items": lambda: keep(
                "fact_order_items",
                marts.fact_order_items(t["int_order_items"], dims["dim_product"], places, channels),
            ),
            "fact_deliveries": lambda: keep(
                "fact_deliveries", marts.fact_deliveries(t["int_deliveries"], places)
            ),
        }
    )
    sales = marts.order_sales(built["fact_orders"], built["fact_order_items"])
    built["order_sales"] = keep("order_sales", sales)
    return built


def audit(store: TableStore, t: Mapping[str, DataFrame], run: AuditRun) -> Tables:
    """Store the audit tables of the run and its part of their histories."""
    checks = QualityAudit(t, run)
    checks.prepare()
    found = {
        "data_quality_results": checks.results,
        "data_quality_exceptions": checks.exceptions,
        "reconciliation_summary": lambda: reconciliation(t, run),
    }

    def keep(name: str) -> DataFrame:
        kept = store.replace("audit", name, found[name]())
        store.write_partition("audit", f"{name}_history", kept.drop("run_id"), "run_id", run.run_id)
        return kept

    store.replace("audit", "data_quality_rulebook", rulebook(store.spark))
    return together({name: lambda name=name: keep(name) for name in found})


def process_drop(
    store: TableStore,
    folder: str,
    run: AuditRun,
    arrays: bool = True,
    partition_facts: bool = False,
) -> str:
    """Process a drop if it is new. Returns its status; raises when conversion or audit fail.

    The drop is marked only at the very end, so a failed run is taken up again.
    """
    inspection = drops.inspect_drop(store.spark, folder, drops.last_fingerprint(store))
    if inspection.status != drops.READY:
        return inspection.status
    day = str(run.execution_date)
    landed = drops.by_file(drops.land_drop(store, folder, day))
    if drops.fingerprint_of(landed) != inspection.fingerprint:
        raise RuntimeError(f"{folder} changed while it was landed; the next run takes it up again")
    copies = drops.landed_folder(store, day)
    paths = {entity: f"{copies}/{entity}.json" for entity in ENTITIES}
    convert.convert_drop(store, paths, day, staging.run_batch_id("raw", day), arrays)
    with store.release() as release:
        tables = build_staging(release, run, partition_facts)
        tables |= build_marts(release, tables, run, partition_facts)
        found = audit(release, tables, run)
    require_passed(
        found["data_quality_results"],
        found["reconciliation_summary"],
        found["data_quality_exceptions"],
    )
    drops.mark_processed(store, inspection, day, run.run_id)
    return inspection.status
