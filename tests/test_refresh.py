"""Months that have changed are rebuilt, the others keep their files."""

import datetime as dt

import pytest

from galley.plans import refresh, views
from galley.plans.quality import AuditRun

MAY, JUNE, JULY = (dt.date(2024, m, 1) for m in (5, 6, 7))
ORDER = (
    "order_id string, customer_id string, store_id string, channel string, payment_method string, promo_code string, "
    "order_timestamp timestamp_ntz, items_count bigint, qty_total bigint, subtotal_ngn decimal(18,4), discount_ngn decimal(18,4), "
    "tax_ngn decimal(18,4), delivery_fee_ngn bigint, total_amount_ngn decimal(18,4), order_hour int, promo_flag bigint, "
    "new_vs_returning_customer_flag string, customer_type string, _source_file string, _loaded_at timestamp_ntz, _batch_id string"
)
LINE = (
    "order_id string, product_id string, store_id string, channel string, order_timestamp timestamp_ntz, promo_flag bigint, "
    "quantity bigint, unit_price double, product_revenue decimal(18,4), _source_file string, _loaded_at timestamp_ntz, _batch_id string"
)
SENT = (
    "order_id string, store_id string, order_timestamp timestamp_ntz, promised_delivery_minutes bigint, actual_delivery_minutes bigint, "
    "delay_minutes bigint, delivery_sla_met_flag bigint, _source_file string, _loaded_at timestamp_ntz, _batch_id string"
)


def staged(spark, orders, customers=("C2", "C3"), products=("P1",), cities=("Lagos", "Jos"), run=1):
    """``orders``: (number, time or None, customer, price)."""
    seen = (f"f{run}", dt.datetime(2024, 8, run), f"b{run}")
    heads, lines, sent = [], [], []
    for n, when, who, price in orders:
        time = dt.datetime.fromisoformat(when) if when else None
        place, way = f"S{n % 2 + 1}", ("Delivery", "Pickup")[n % 2]
        code = "X" if n == 3 else None
        heads.append((f"O{n}", who, place, way, "Card", code, time, 1, 2, price, 0, 0, 1, price, 12, int(n == 3), "New", "A", *seen))
        lines.append((f"O{n}", f"P{n % 2 + 1}", place, way, time, 0, 2, price / 2.0, price, *seen))
        sent.append((f"O{n}", place, time, 30, 25, -5, 1, *seen))

    def money(rows, schema):
        fields = [f.strip().split(" ")[1] for f in schema.split(", ")]
        from decimal import Decimal
        return [tuple(Decimal(v) if t.startswith("decimal") else v for v, t in zip(r, fields)) for r in rows]

    return {
        "int_orders": spark.createDataFrame(money(heads, ORDER), ORDER),
        "int_order_items": spark.createDataFrame(money(lines, LINE), LINE),
        "int_deliveries": spark.createDataFrame(sent, SENT),
        "int_customers": spark.createDataFrame(
            [(c, dt.date(2024, 1, 1), "Jos", "1", 0) for c in customers],
            "customer_id string, signup_date date, city string, phone string, is_business bigint",
        ),
        "int_products": spark.createDataFrame(
            [(p, "Pie", "Pizza", 5) for p in products],
            "product_id string, product_name string, unified_category string, base_price_ngn bigint",
        ),
        "int_stores": spark.createDataFrame([(f"S{k}", c) for k, c in enumerate(cities, 1)], "store_id string, clean_city string"),
    }


def run_on(day):
    return AuditRun(str(day), day, day)


def go(store, tables, day):
    with store.release() as release:
        return refresh.refresh_marts(release, tables, run_on(day))[1]


def reports(found):
    return {n: sorted(map(repr, df.collect())) for n, df in found.items()}


def rebuilt(spark, tables, store):
    """The views from facts made anew over all months with the store versions there are."""
    from galley.plans import marts as m
    o, i = tables["int_orders"], tables["int_order_items"]
    days, customers, products = m.dim_date(o), m.dim_customer(tables["int_customers"]), m.dim_product(tables["int_products"])
    channels, stores = m.dim_channel(o), store.read("marts", "dim_store")
    facts = m.fact_orders(o, customers, stores, channels, m.dim_payment_method(o), m.dim_promo(o))
    lines = m.fact_order_items(i, products, stores, channels)
    sales = m.order_sales(facts, lines)
    return {
        "vw_sales_performance": views.vw_sales_performance(sales, days, stores, channels),
        "vw_delivery_performance": views.vw_delivery_performance(m.fact_deliveries(tables["int_deliveries"], stores), days, stores),
        "vw_product_performance": views.vw_product_performance(lines, days, stores, channels, products),
        "vw_customer_summary": views.vw_customer_summary(sales, customers),
    }


FIRST = [(1, "2024-05-03T10:00", "C2", 10), (2, "2024-06-04T10:00", "C3", 20), (3, "2024-07-05T10:00", "C2", 30), (4, None, "C3", 5)]


def test_only_changed_months_are_written_and_reports_equal_a_full_rebuild(spark, store):
    tables = staged(spark, FIRST)
    months = go(store, tables, dt.date(2024, 7, 31))
    assert set(months.values()) == {None}
    assert reports(refresh.stored_views(store)) == reports(rebuilt(spark, tables, store))
    files = store.partitions("marts", "fact_orders")
    assert set(files) == {"date_month=2024-05-01", "date_month=2024-06-01", "date_month=2024-07-01", "date_month=__HIVE_DEFAULT_PARTITION__"}

    # delivered again as it was: nothing is written but the dimensions
    months = go(store, staged(spark, FIRST, run=2), dt.date(2024, 8, 1))
    assert set(map(frozenset, months.values())) == {frozenset()}
    assert store.partitions("marts", "fact_orders") == files

    # a late order of May, a corrected one of July
    late = [*FIRST[:2], (3, "2024-07-05T10:00", "C2", 31), FIRST[3], (5, "2024-05-09T10:00", "C3", 7)]
    tables = staged(spark, late, run=3)
    months = go(store, tables, dt.date(2024, 8, 2))
    assert months["fact_orders"] == months["order_sales"] == months["customer_sums"] == {MAY, JULY}
    assert months["fact_deliveries"] == {MAY}
    now = store.partitions("marts", "fact_orders")
    assert {p for p in now if now[p] != files[p]} == {"date_month=2024-05-01", "date_month=2024-07-01"}
    assert reports(refresh.stored_views(store)) == reports(rebuilt(spark, tables, store))

    # the only order of June moves to August, the one without a time gets one
    moved = [FIRST[0], (2, "2024-08-04T10:00", "C3", 20), late[2], (4, "2024-05-30T10:00", "C3", 5), late[4]]
    tables = staged(spark, moved, run=4)
    months = go(store, tables, dt.date(2024, 8, 3))
    assert months["fact_orders"] == {MAY, JUNE, dt.date(2024, 8, 1), None}
    assert set(store.partitions("marts", "order_sales")) == {f"date_month=2024-0{m}-01" for m in (5, 7, 8)}
    assert reports(refresh.stored_views(store)) == reports(rebuilt(spark, tables, store))


def test_new_keys_touch_their_months_and_renumber_nothing(spark, store):
    go(store, staged(spark, [*FIRST, (6, "2024-06-06T10:00", "C1", 9)]), dt.date(2024, 7, 31))
    numbers = {r["customer_id"]: r["customer_sk"] for r in store.read("marts", "dim_customer").collect()}
    # C1 sorts before the others; P2 is sold in May and July
    tables = staged(spark, [*FIRST, (6, "2024-06-06T10:00", "C1", 9)], customers=("C1", "C2", "C3"), products=("P1", "P2"))
    months = go(store, tables, dt.date(2024, 8, 1))
    assert months["fact_orders"] == {JUNE} and months["fact_order_items"] == {MAY, JULY} and months["fact_deliveries"] == set()
    assert months["order_sales"] == {MAY, JUNE, JULY}
    after = {r["customer_id"]: r["customer_sk"] for r in store.read("marts", "dim_customer").collect()}
    assert after == {**numbers, "C1": 3}
    assert reports(refresh.stored_views(store)) == reports(rebuilt(spark, tables, store))


def test_a_moved_store_touches_the_months_of_its_new_version(spark, store):
    go(store, staged(spark, FIRST), dt.date(2024, 5, 1))
    tables = staged(spark, FIRST, cities=("Abuja", "Jos"))
    months = go(store, tables, dt.date(2024, 6, 2))  # S1 has the even orders: June, and one without a time
    assert months["fact_orders"] == months["fact_deliveries"] == months["sales_sums"] == {JUNE}
    assert reports(refresh.stored_views(store)) == reports(rebuilt(spark, tables, store))


def test_plans_read_changed_months_only(spark, store):
    go(store, staged(spark, FIRST), dt.date(2024, 7, 31))
    rows = refresh.only(store.read("marts", "fact_orders"), {MAY, None})
    assert sorted(r["order_id"] for r in rows.collect()) == ["O1", "O4"]
    picked = rows.select("order_id")
    assert picked.count() == 2 and len(picked.collect()) == 2
    scan = picked._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert "date_month" in scan.partitionFilters().mkString(" ")
    assert scan.metrics().apply("numPartitions").value() == 2  # of four


def test_empty_tables(spark, store):
    tables = staged(spark, [])
    go(store, tables, dt.date(2024, 7, 31))
    assert store.read("marts", "fact_orders").count() == 0
    tables = staged(spark, FIRST)
    months = go(store, tables, dt.date(2024, 8, 1))
    assert months["fact_orders"] == {MAY, JUNE, JULY, None}
    assert reports(refresh.stored_views(store)) == reports(rebuilt(spark, tables, store))
    go(store, staged(spark, []), dt.date(2024, 8, 2))
    assert store.partitions("marts", "order_sales") == {}
    assert all(not rows for rows in reports(refresh.stored_views(store)).values())


def test_partitions_are_replaced_by_value(spark, store):
    def rows(*values):
        return spark.createDataFrame(list(values), "v int, p string")

    with pytest.raises(ValueError):
        store.replace_partitions("marts", "f", rows((1, "a")), "p", ["a"])
    with store.release() as run:
        run.replace("marts", "f", rows((1, "a"), (2, "b"), (3, None)), ["p"])
    reader = store.snapshot()
    store.replace_partitions("marts", "f", rows((4, "a")), "p", ["a", None])
    assert sorted(map(tuple, store.read("marts", "f").collect())) == [(2, "b"), (4, "a")]
    assert reader.read("marts", "f").count() == 3  # the folders of its release are still there
    with pytest.raises(ValueError):
        store.replace_partitions("marts", "f", rows((5, "c")), "p", ["a"])
