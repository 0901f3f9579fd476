"""A drop from JSON to audited reports, with a correction, a moved store and a bad drop."""

import datetime as dt
import json

import pytest

from galley.plans import daily_run, views
from galley.plans.quality import AuditFailed, AuditRun
from galley.sources import drops

STORES = [
    {"store_id": f"S{n}", "store_name": f"Store {n}", "city": " Lagos ", "opening_hours": "09:00-23:00", "delivery_sla_minutes": 30}
    for n in (1, 2)
]
CUSTOMERS = [{"customer_id": f"C{n}", "signup_date": "2024-01-31", "city": "Jos", "phone": "1", "is_business": 0} for n in (1, 2)]
PRODUCTS = [{"product_id": f"P{n}", "product_name": "Pie", "category": "Pizza" if n == 1 else None, "base_price_ngn": 500} for n in (1, 2)]


def order(n, day, price=10.0, channel="Delivery"):
    return {
        "order_id": f"O{n}", "order_ts": f"2024-05-{day:02d}T12:00:00", "store_id": f"S{n % 2 + 1}", "customer_id": f"C{n % 2 + 1}",
        "channel": channel, "payment_method": "Card", "promo_code": None, "items_count": 1, "qty_total": 2, "subtotal_ngn": price,
        "discount_ngn": 0.0, "tax_ngn": 0.5, "delivery_fee_ngn": 3, "total_amount_ngn": price + 3.5,
        "promised_delivery_minutes": 30, "actual_delivery_minutes": 25,
    }


def write(folder, orders, stores=STORES):
    folder.mkdir(exist_ok=True)
    lines = [
        {"order_id": o["order_id"], "product_id": "P1", "product_name": "Pie", "category": "Pizza", "qty": 2,
         "unit_price_ngn": o["subtotal_ngn"] / 2, "line_total_ngn": o["subtotal_ngn"]}
        for o in orders
    ]
    sent = [
        {"order_id": o["order_id"], "store_id": o["store_id"], "order_ts": o["order_ts"], "promised_delivery_minutes": 30,
         "actual_delivery_minutes": 25, "delivered_within_sla": 1}
        for o in orders
    ]
    promo = [{**o, "promo_code": "X", "discount_ngn": 1.0, "total_amount_ngn": o["total_amount_ngn"] - 1} if i == 0 else o for i, o in enumerate(orders)]
    content = {"customers": CUSTOMERS, "stores": stores, "products": PRODUCTS, "orders": promo, "order_items": lines, "deliveries": sent}
    for entity, records in content.items():
        (folder / f"{entity}.json").write_text(json.dumps(records))
    return f"file://{folder}"


def run_on(day):
    date = dt.date(2024, 5, day)
    return AuditRun(f"scheduled__{date}T00:00:00", date, date)


def sales(store):
    t = {n: store.read("marts", n) for n in ("order_sales", "dim_date", "dim_channel")}
    view = views.vw_sales_performance(t["order_sales"], t["dim_date"], store.latest("marts", "dim_store"), t["dim_channel"])
    return sorted((r["full_date"].day, r["store_id"], r["city"], r["order_count"], r["total_revenue"], r["avg_order_value"]) for r in view.collect())


def test_two_days_and_a_bad_drop(store, tmp_path):
    folder = tmp_path / "drop"
    assert daily_run.process_drop(store, f"file://{folder}", run_on(3)) == drops.MISSING
    url = write(folder, [order(1, 1), order(2, 2), order(4, 2)])
    assert daily_run.process_drop(store, url, run_on(3)) == drops.READY
    assert sales(store) == [(1, "S2", "Lagos", 1, 10.0, 10.0), (2, "S1", "Lagos", 2, 20.0, 10.0)]
    assert daily_run.process_drop(store, url, run_on(4)) == drops.UNCHANGED

    # the next drop corrects an order, brings a new one, and a store has moved
    moved = [{**STORES[0], "city": "Abuja"}, STORES[1]]
    write(folder, [order(2, 2, price=15.0), order(6, 10)], moved)
    assert daily_run.process_drop(store, url, run_on(9), partition_facts=True) == drops.READY
    assert sales(store) == [
        (1, "S2", "Lagos", 1, 10.0, 10.0), (2, "S1", "Lagos", 2, 25.0, 12.5), (10, "S1", "Abuja", 1, 10.0, 10.0),
    ]
    history = store.read_all("audit", "data_quality_results_history", "run_id")
    assert {r["run_id"]: r["count"] for r in history.groupBy("run_id").count().collect()} == {
        "scheduled__2024-05-03T00:00:00": 41, "scheduled__2024-05-09T00:00:00": 41,
    }

    # a drop that fails the audit is not marked and comes up again
    write(folder, [order(7, 11, channel="Kiosk")])
    for _ in range(2):
        with pytest.raises(AuditFailed) as failure:
            daily_run.process_drop(store, url, run_on(12))
        assert [b["name"] for b in failure.value.blockers if b["kind"] == "check"] == ["invalid_channel"]
