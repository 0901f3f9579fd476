"""Column contracts of the sources and of the provider feed."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _D = T.StringType(), T.LongType(), T.DoubleType()
_DAY, _TS = T.DateType(), T.TimestampNTZType()


def _columns(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Names and types of the source columns.
CONTRACTS: dict[str, T.StructType] = {
    "customers": _columns(customer_id=_S, signup_date=_DAY, city=_S, phone=_S, is_business=_L),
    "stores": _columns(
        store_id=_S, store_name=_S, city=_S, opening_hours=_S, delivery_sla_minutes=_L
    ),
    "products": _columns(product_id=_S, product_name=_S, category=_S, base_price_ngn=_L),
    "orders": _columns(
        order_id=_S,
        order_ts=_TS,
        store_id=_S,
        customer_id=_S,
        channel=_S,
        payment_method=_S,
        promo_code=_S,
        items_count=_L,
        qty_total=_L,
        subtotal_ngn=_D,
        discount_ngn=_D,
        tax_ngn=_D,
        delivery_fee_ngn=_L,
        total_amount_ngn=_D,
        promised_delivery_minutes=_L,
        actual_delivery_minutes=_L,
    ),
    "order_items": _columns(
        order_id=_S,
        product_id=_S,
        product_name=_S,
        category=_S,
        qty=_L,
        unit_price_ngn=_D,
        line_total_ngn=_D,
    ),
    "deliveries": _columns(
        order_id=_S,
        store_id=_S,
        order_ts=_TS,
        promised_delivery_minutes=_L,
        actual_delivery_minutes=_L,
        delivered_within_sla=_L,
    ),
}

ENTITIES = tuple(CONTRACTS)

KEYS = {
    "customers": ("customer_id",),
    "stores": ("store_id",),
    "products": ("product_id",),
    "orders": ("order_id",),
    "order_items": ("order_id", "product_id"),
    "deliveries": ("order_id",),
}

# Columns cast with a NULL for malformed text.
TIMESTAMP_COLUMNS = {"orders": ("order_ts",), "deliveries": ("order_ts",)}

CHANNELS = ("Dine-in", "Takeaway", "Delivery", "Online App")
DELIVERED_CHANNELS = ("Delivery", "Online App")

FEED_STATUSES = (
    "pending",
    "assigned",
    "picked_up",
    "in_transit",
    "delivered",
    "failed",
    "cancelled",
)

FEED_TIMES = (
    "assigned_at",
    "picked_up_at",
    "promised_delivery_at",
    "delivered_at",
    "cancelled_at",
    "created_at",
    "updated_at",
)

# Times travel as ISO-8601 text.
FEED_RECORD = _columns(
    delivery_id=_S,
    order_id=_S,
    brand=_S,
    store_id=_S,
    store_name=_S,
    city=_S,
    delivery_partner=_S,
    delivery_status=_S,
    assigned_at=_S,
    picked_up_at=_S,
    promised_delivery_at=_S,
    delivered_at=_S,
    cancelled_at=_S,
    failure_reason=_S,
    delivery_fee=T.IntegerType(),
    distance_km=_D,
    created_at=_S,
    updated_at=_S,
)

FEED_PAGE = _columns(
    data=T.ArrayType(FEED_RECORD),
    pagination=_columns(next_cursor=_S, has_more=T.BooleanType(), limit=T.IntegerType()),
    metadata=_columns(request_id=_S, record_count=T.IntegerType(), generated_at=_S),
)

# Columns of the upserted delivery table, and those a later record may change.
FEED_TABLE_COLUMNS = (
    "delivery_id",
    "order_id",
    "brand",
    "store_id",
    "store_name",
    "city",
    "delivery_partner",
    "delivery_status",
    "delivery_fee",
    "distance_km",
    "created_at",
    "updated_at",
)
FEED_UPDATES = ("delivery_status", "delivery_fee", "updated_at")
