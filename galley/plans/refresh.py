"""Marts by month: a run rebuilds the months that have changed, and no others.

Facts, ``order_sales`` and the sums of the views lie in a partition per month of the order.
A run takes a digest of every month of the staged tables and compares it with the one kept
from the run before: late, corrected and withdrawn rows change it, a row delivered again as
it was does not (lineage is left out). Months in which a key of a dimension resolves
differently are found from the keys that have changed. Only these months are read from the
layer below and written; one entry of the store's log names them together with the months
that stay.

Numbers of dimension rows stay what they were, and new keys are numbered on, so a new
customer or product does not renumber the facts. The rows of unchanged months keep the
lineage of the run that wrote them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Collection, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galley.operators.history import covers
from galley.operators.joins import lookup
from galley.operators.numbering import dense_number
from galley.operators.together import together
from galley.plans import marts, views
from galley.plans.quality import AuditRun
from galley.sources.digests import content_digest
from galley.sources.store import TableStore

MONTH = "date_month"
Tables = dict[str, DataFrame]
# None stands for all months, for a table that is not laid out by month yet
Months = set[dt.date | None] | None

_STAGED = {
    "fact_orders": "int_orders",
    "fact_order_items": "int_order_items",
    "fact_deliveries": "int_deliveries",
}
# dimensions that follow from other sources than the fact's own rows
_LOOKED_UP = {
    "fact_orders": {"customer_id": ("dim_customer", "customer_sk")},
    "fact_order_items": {"product_id": ("dim_product", "product_sk")},
    "fact_deliveries": {},
}
_SUMS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "sales_sums": ("order_sales", views.sales_sums),
    "delivery_sums": ("fact_deliveries", views.delivery_sums),
    "product_sums": ("fact_order_items", views.product_sums),
    "customer_sums": ("order_sales", lambda sales: views.customer_sums(sales, MONTH)),
}
_SALES_FACTS = ("fact_orders", "fact_order_items")


def by_month(df: DataFrame) -> DataFrame:
    """``df`` with the month of its day; a row without a day has none."""
    if MONTH in df.columns:
        return df
    day = "date_sk" if "date_sk" in df.columns else "order_timestamp"
    return df.withColumn(MONTH, F.trunc(F.col(day).cast("date"), "month"))


def only(df: DataFrame, months: Months) -> DataFrame:
    """Rows of some months. The condition reaches the partitions of a table laid out by month."""
    if months is None:
        return df
    wanted = F.col(MONTH).isin([m for m in months if m is not None])
    return df.where(wanted | F.col(MONTH).isNull() if None in months else wanted)


def numbered_on(rows: DataFrame, before: DataFrame | None, key: str, number: str) -> DataFrame:
    """Rows (one per key) with the numbers their keys had; new keys are numbered on in order."""
    order = [F.col(key).asc_nulls_last()]
    if before is None:
        return dense_number(rows, order, number).select(number, *rows.columns)
    known = before.select(F.col(key).alias("_known"), number)
    met = rows.join(known, F.col(key).eqNullSafe(F.col("_known")), "left").drop("_known")
    start = before.agg(F.coalesce(F.max(number), F.lit(0))).first()[0] + 1
    fresh = dense_number(met.where(F.col(number).isNull()).drop(number), order, number, start)
    stay = met.where(F.col(number).isNotNull())
    return stay.select(number, *rows.columns).union(fresh.select(number, *rows.columns))


def month_digests(staged: Mapping[str, DataFrame]) -> DataFrame:
    """A row per staged table and month: number of rows and digest of their content."""
    digests = [
        content_digest(by_month(df), MONTH).withColumn("staged", F.lit(name))
        for name, df in staged.items()
    ]
    return reduce(DataFrame.unionByName, digests)


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.subtract(b).union(b.subtract(a))


def shifted_spans(before: DataFrame, after: DataFrame) -> DataFrame:
    """``store_id, _first, _last``: days on which a store has another version than before.

    A version's number is given once, so only the ends of its interval can have moved, or
    it is there on one side only.
    """
    old = before.select(
        F.col("store_sk").alias("_sk"), F.col("store_id").alias("_id"),
        F.col("effective_from").alias("_from"), F.col("effective_to").alias("_to"),
    )
    met = after.join(old, F.col("store_sk") == F.col("_sk"), "full_outer")
    start, end = F.col("effective_from"), F.col("effective_to")
    alone = F.col("_sk").isNull() | F.col("store_sk").isNull()

    def span(first, last):
        return F.struct(first.alias("_first"), last.alias("_last"))

    whole = F.array(span(F.coalesce(start, "_from"), F.coalesce(end, "_to")))
    ends = F.array(
        span(F.least(start, "_from"), F.date_sub(F.greatest(start, "_from"), 1)),
        span(F.date_add(F.least(end, "_to"), 1), F.greatest(end, "_to")),
    )
    spans = met.select(
        F.coalesce("store_id", "_id").alias("_store"), F.explode(F.when(alone, whole).otherwise(ends)).alias("_span")
    )
    return spans.select("_store", "_span.*").where("_first <= _last")


def _set(months: DataFrame) -> set[dt.date | None]:
    return {r[MONTH] for r in months.select(MONTH).distinct().collect()}  # calendar months


def touched_months(
    staged: Mapping[str, DataFrame], digests: DataFrame, before: Mapping[str, DataFrame | None], dims: Tables
) -> dict[str, Months]:
    """The months of each fact that a full rebuild would make otherwise; None for all."""
    facts = [fact for fact in _STAGED if _STAGED[fact] in staged]
    if any(before[n] is None for n in ("month_digests", "dim_store", "dim_customer", "dim_product")):
        return dict.fromkeys(facts)
    differing = _differing(digests, before["month_digests"].select(digests.columns))
    by_rows = differing.select("staged", MONTH).distinct().collect()  # a row per calendar month
    spans = shifted_spans(before["dim_store"], dims["dim_store"])
    stores_moved = not spans.isEmpty()

    def of(fact: str) -> set[dt.date | None]:
        rows = staged[_STAGED[fact]]
        months = {r[MONTH] for r in by_rows if r["staged"] == _STAGED[fact]}
        for key, (dim, number) in _LOOKED_UP[fact].items():
            changed = _differing(dims[dim].select(key, number), before[dim].select(key, number))
            changed = changed.select(F.col(key).alias("_changed")).distinct()
            if not changed.isEmpty():
                months |= _set(lookup(rows.select(key, MONTH), changed, {key: "_changed"}, "left_semi"))
        if stores_moved:
            dated = rows.select("store_id", F.col("order_timestamp").cast("date").alias("_day"), MONTH)
            inside = covers("_day", "_first", "_last")
            months |= _set(lookup(dated, spans, {"store_id": "_store"}, "left_semi", residual=inside))
        return months

    return together({fact: lambda fact=fact: of(fact) for fact in facts})


def _dimensions(store: TableStore, t: Mapping[str, DataFrame], before: Mapping[str, DataFrame | None], run: AuditRun) -> Tables:
    orders = t["int_orders"]

    def values(column: str, rows: DataFrame) -> DataFrame:
        return rows.select(column).where(F.col(column).isNotNull()).distinct()

    def promos() -> DataFrame:
        codes = orders.select(marts.blank_to_null(F.col("promo_code")).alias("promo_code"))
        earlier = before["dim_promo"]
        earlier = None if earlier is None else earlier.where("promo_sk > 0")
        numbered = numbered_on(values("promo_code", codes), earlier, "promo_code", "promo_sk")
        return marts.no_promo_row(orders.sparkSession).union(numbered.withColumn("is_promo", F.lit(True)))

    def numbered(rows: DataFrame, dim: str, key: str, number: str) -> DataFrame:
        return numbered_on(rows, before[dim], key, number)

    customers = t["int_customers"].select("customer_id", "signup_date", "city", "phone", "is_business")
    products = t["int_products"].select("product_id", "product_name", "unified_category", "base_price_ngn")
    builds: dict[str, Callable[[], DataFrame]] = {
        "dim_date": lambda: marts.dim_date(orders),
        "dim_customer": lambda: numbered(customers, "dim_customer", "customer_id", "customer_sk"),
        "dim_product": lambda: numbered(products, "dim_product", "product_id", "product_sk"),
        "dim_channel": lambda: numbered(values("channel", orders), "dim_channel", "channel", "channel_sk"),
        "dim_payment_method": lambda: numbered(
            values("payment_method", orders), "dim_payment_method", "payment_method", "payment_method_sk"
        ),
        "dim_promo": promos,
        "dim_store": lambda: marts.dim_store(t["int_stores"], before["dim_store"], run.execution_date),
    }
    return together({n: lambda n=n, b=b: store.replace("marts", n, b()) for n, b in builds.items()})


def _facts_of(sums: Collection[str]) -> list[str]:
    """The facts that sums are made from."""
    sources = {_SUMS[name][0] for name in sums}
    return [fact for fact in _STAGED if fact in sources or (fact in _SALES_FACTS and "order_sales" in sources)]


def refresh_marts(
    store: TableStore, t: Mapping[str, DataFrame], run: AuditRun, sums: Collection[str] = tuple(_SUMS)
) -> tuple[Tables, dict[str, Months]]:
    """Bring all marts and the sums of the views up to the staged tables.

    A store that serves some views only names their ``sums``, the same ones on every run:
    facts that none of them is made from are not built, and their staged tables not needed.

    Returns the marts and the months written of each table laid out by month (None: all, as
    on the first run). Run it in a release, so that all tables count together.
    """
    names = ("dim_store", "dim_customer", "dim_product", "dim_channel", "dim_payment_method", "dim_promo")
    before = {n: store.latest("marts", n) for n in (*names, "month_digests")}
    facts = _facts_of(sums)
    staged = {_STAGED[fact]: by_month(t[_STAGED[fact]]) for fact in facts}
    built = _dimensions(store, t, before, run)
    digests = store.replace("marts", "month_digests", month_digests(staged).coalesce(1))
    months = touched_months(staged, digests, before, built)

    def put(name: str, build: Callable[[], DataFrame], touched: Months) -> DataFrame:
        months[name] = touched
        if touched is None:
            return store.replace("marts", name, by_month(build()), [MONTH])
        if touched:
            return store.replace_partitions("marts", name, by_month(build()), MONTH, touched)
        return store.read("marts", name)

    def due(name: str, *sources: str) -> Months:
        """All months for a table that has none yet, else those of what it is made from."""
        from_sources = [months[s] for s in sources]
        if store.partitions("marts", name) is None or None in from_sources:
            return None
        return set().union(*from_sources)

    places, channels = built["dim_store"], built["dim_channel"]
    extra: dict[str, Sequence[DataFrame]] = {
        "fact_orders": (built["dim_customer"], places, channels, built["dim_payment_method"], built["dim_promo"]),
        "fact_order_items": (built["dim_product"], places, channels),
        "fact_deliveries": (places,),
    }

    def fact(name: str) -> DataFrame:
        touched = due(name, name)
        rows = only(staged[_STAGED[name]], touched)
        return put(name, lambda: getattr(marts, name)(rows, *extra[name]), touched)

    built |= together({name: lambda name=name: fact(name) for name in facts})

    if any(_SUMS[name][0] == "order_sales" for name in sums):
        # an order and its lines share the order's time, so they lie in the same month
        touched = due("order_sales", *_SALES_FACTS)
        parts = [only(built[n], touched) for n in _SALES_FACTS]
        built["order_sales"] = put("order_sales", lambda: marts.order_sales(*parts), touched)

    def summed(name: str) -> DataFrame:
        source, build = _SUMS[name]
        touched = due(name, source)
        return put(name, lambda: build(only(built[source], touched)), touched)

    built |= together({name: lambda name=name: summed(name) for name in sums})
    return built, months


VIEWS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "vw_sales_performance": (views.named_sales, ("sales_sums", "dim_date", "dim_store", "dim_channel")),
    "vw_delivery_performance": (views.named_deliveries, ("delivery_sums", "dim_date", "dim_store")),
    "vw_product_performance": (
        views.named_products, ("product_sums", "dim_date", "dim_store", "dim_channel", "dim_product")
    ),
    "vw_customer_summary": (views.named_customers, ("customer_sums", "dim_customer")),
}


def stored_views(store: TableStore, names: Collection[str] = tuple(VIEWS)) -> Tables:
    """The report views from their stored sums. Give it a snapshot for one release."""
    return {name: VIEWS[name][0](*[store.read("marts", table) for table in VIEWS[name][1]]) for name in names}
