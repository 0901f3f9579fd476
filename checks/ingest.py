"""Source drops: reading, hashing, drift, conversion, landing."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import mapping
from checks.feed import _own_store
from checks.lake import lake
from checks.registry import query, register
from galley.functions import iso_utc
from galley.plans import staging
from galley.sources import convert, digests, drops
from galley.sources.contracts import CONTRACTS, ENTITIES
from galley.sources.entity_json import (
    drift,
    null_counts,
    observe_schema,
    read_entity,
    read_json,
    typed,
    with_lineage,
)

_DROPS: dict[str, set[str]] = {}
LINEAGE = ("_source_file", "_loaded_at", "_batch_id")


def as_json(spark, sf, entity):
    """A mapped source in the form a drop has it: no lineage, times as text."""
    rows = mapping.stores(spark, sf, 2) if entity == "stores" else lake(spark, sf).source(entity)
    rows = rows.drop(*LINEAGE)
    if "order_ts" in rows.columns:
        rows = rows.withColumn("order_ts", iso_utc(F.col("order_ts")))
    return rows


def write_drop(rows, path) -> None:
    """JSON lines in compressed parts; one part is read by one task, so its rows are bounded."""
    writer = rows.write.mode("overwrite").option("ignoreNullFields", False).option("maxRecordsPerFile", 500_000)
    writer.json(path, compression="gzip")


def drop_folder(spark, sf, entities=ENTITIES) -> str:
    """The mapped sources as JSON lines, one folder of parts per file name, each written when first asked for."""
    store = lake(spark, sf).store
    written = _DROPS.setdefault(store.root, set())
    for entity in entities:
        if entity not in written:
            write_drop(as_json(spark, sf, entity), f"{store.path('drop', entity)}.json")
            written.add(entity)
    return store.path("drop", "").rstrip("/")


def _path(spark, sf, entity):
    return f"{drop_folder(spark, sf, [entity])}/{entity}.json"


def _contract_sql(entity):
    source = "src_stores_2" if entity == "stores" else f"src_{entity}"
    types = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}
    columns = ", ".join(
        # list prices of the test parts have cents, which a load keeps
        f"CAST({f.name} AS DOUBLE) AS {f.name}" if f.name == "base_price_ngn"
        else f"CAST({f.name} AS {types[f.dataType.simpleString()]}) AS {f.name}"
        for f in CONTRACTS[entity].fields
    )
    return f"SELECT {columns} FROM {source}"


def _read(entity):
    return lambda spark, sf: read_entity(spark, _path(spark, sf, entity), entity, arrays=False)


for _entity in ENTITIES:
    register(f"src1_{_entity}_json", _read(_entity), _contract_sql(_entity))


@query(
    "src2_no_path_columns",
    "SELECT count(*) AS row_total, 'category,order_id,product_id,product_name,qty,line_total_ngn,unit_price_ngn' AS found FROM src_order_items",
)
def no_path_columns(spark, sf):
    """A folder named like a partition adds no column."""
    root = f"{_own_store(spark, sf, 'plain').root}/ingestion_date=2001-08-02"
    as_json(spark, sf, "order_items").write.option("ignoreNullFields", False).json(root)
    rows = read_json(spark, root.rsplit("/", 1)[0], arrays=False)
    expected = ["category", "order_id", "product_id", "product_name", "qty", "line_total_ngn", "unit_price_ngn"]
    found = ",".join([c for c in expected if c in rows.columns] + [c for c in rows.columns if c not in expected])
    return rows.agg(F.count("*").alias("row_total")).withColumn("found", F.lit(found))


def _two_loads(spark, sf, name):
    store = _own_store(spark, sf, name)
    store.write_load("stores", mapping.stores(spark, sf, 1), str(mapping.FIRST_LOAD))
    second = mapping.stores(spark, sf, 2).withColumn("seats", F.length("store_name").cast("bigint"))
    store.write_load("stores", second, str(mapping.SECOND_LOAD))
    store.write_load("stores", second, str(mapping.SECOND_LOAD))  # a replayed load replaces itself
    return store


_LOADS = f"""SELECT '{mapping.FIRST_LOAD}' AS load_date, count(*) AS row_total FROM src_stores_1
             UNION ALL SELECT '{mapping.SECOND_LOAD}', count(*) FROM src_stores_2"""


@query("src3_all_loads", _LOADS)
def all_loads(spark, sf):
    return _two_loads(spark, sf, "loads").read_loads("stores").groupBy("load_date").agg(F.count("*").alias("row_total"))


@query(
    "src4_union_by_name",
    """SELECT store_id, NULL::BIGINT AS seats FROM src_stores_1
       UNION ALL SELECT store_id, length(store_name) FROM src_stores_2""",
)
def by_name(spark, sf):
    return _two_loads(spark, sf, "named").read_loads("stores").select("store_id", "seats")


@query(
    "src6_table_scan",
    "SELECT order_id, CAST(total_amount_ngn AS DOUBLE) AS total_amount_ngn FROM fact_orders",
)
def scan(spark, sf):
    lake(spark, sf).mart("fact_orders")
    facts = lake(spark, sf).store.read("marts", "fact_orders")
    return facts.select(
        "order_id", F.col("total_amount_ngn").cast("double").alias("total_amount_ngn")
    )


@query(
    "src7_hashed_files",
    """SELECT 'range=' || (c_custkey // 500) || '.json' AS file, sha256(string_agg(line, '' ORDER BY c_custkey)) AS sha256,
              CAST(sum(strlen(line)) AS BIGINT) AS size_bytes
       FROM (SELECT c_custkey, '{"key":' || c_custkey || ',"name":"' || c_name || '"}' || chr(10) AS line FROM customer)
       GROUP BY 1""",
)
def hashed(spark, sf):
    """Bytes whose text follows from a table: its rows in key order, a line each, a file per range of keys."""
    folder = _own_store(spark, sf, "hashed").path("drop", "lines")
    line = F.concat(F.lit('{"key":'), "c_custkey", F.lit(',"name":"'), "c_name", F.lit('"}'))
    within = F.concat(F.floor(F.col("c_custkey") / 500).cast("string"), F.lit(".json"))
    rows = spark.read.parquet(f"{sf}/customer.parquet").select(within.alias("range"), "c_custkey", line.alias("value"))
    rows = rows.repartition("range").sortWithinPartitions("range", "c_custkey").drop("c_custkey")
    rows.write.partitionBy("range").text(folder)
    return drops.drop_files(spark, folder)


register("snk1_write_load", lambda spark, sf: _two_loads(spark, sf, "sink").read_loads("stores").select(
    "store_id", "load_date"
), f"SELECT store_id, '{mapping.FIRST_LOAD}' AS load_date FROM src_stores_1 UNION ALL SELECT store_id, '{mapping.SECOND_LOAD}' FROM src_stores_2")

_LINES = "\nUNION ALL\n".join(
    f"SELECT '{e}.json' AS file, count(*) AS records FROM {'src_stores_2' if e == 'stores' else 'src_' + e}"
    for e in ENTITIES
)


@query("snk2_landed_files", _LINES)
def landed_files(spark, sf):
    """Records of the landed bytes; every copy has the hash its source file has."""
    store = _own_store(spark, sf, "landed")
    drops.land_drop(store, drop_folder(spark, sf), "2001-08-02")
    copies = drops.landed_folder(store, "2001-08-02")
    whole = drops.drop_files(spark, drop_folder(spark, sf)).join(drops.drop_files(spark, copies), ["file", "sha256", "size_bytes"])
    lines = spark.read.option("recursiveFileLookup", True).text(copies)
    name = F.regexp_extract("_metadata.file_path", r"/([^/]+\.json)/[^/]*$", 1)
    return lines.groupBy(name.alias("file")).agg(F.count("*").alias("records")).join(whole.select("file"), "file", "left_semi")


@query(
    "snk4_landing_manifest",
    "SELECT DISTINCT file, 'success' AS status, 'success' AS run_status, TRUE AS same_size FROM (" + _LINES + ")",
)
def landing_manifest(spark, sf):
    """File, size, status and run status; sizes are those the source has."""
    store = _own_store(spark, sf, "manifest")
    manifest = drops.land_drop(store, drop_folder(spark, sf), "2001-08-02")
    sources = drops.listing(spark, drop_folder(spark, sf)).select("name", "length")
    return (
        manifest.join(sources, "name", "left")
        .groupBy("file", "status", "run_status")
        .agg(F.every(F.col("size_bytes").eqNullSafe(F.col("length"))).alias("same_size"))
    )


def _converted(spark, sf, name, **changed):
    """Convert the drop; ``changed`` replaces the frames of some entities."""
    store = _own_store(spark, sf, name)
    paths = {e: _path(spark, sf, e) for e in ENTITIES if e not in changed}
    for entity, rows in changed.items():
        paths[entity] = f"{store.path('drop', entity)}.json"
        write_drop(rows, paths[entity])
    try:
        convert.convert_drop(store, paths, "2001-08-02", "batch", arrays=False)
    except convert.ConversionFailed:
        pass
    return store


@query(
    "snk5_conversion_manifest",
    """SELECT * FROM (VALUES ('customers', 'success', 'partial_failure'), ('stores', 'success', 'partial_failure'),
       ('products', 'success', 'partial_failure'), ('orders', 'success', 'partial_failure'),
       ('order_items', 'success', 'partial_failure'), ('deliveries', 'halted_schema_drift', 'partial_failure'))
       t(source, status, run_status)""",
)
def conversion_manifest(spark, sf):
    """Deliveries without their SLA flag are halted; everything else is converted."""
    short = as_json(spark, sf, "deliveries").drop("delivered_within_sla")
    goods = as_json(spark, sf, "order_items").withColumns({"product_name": F.lit("dish"), "category": F.lit("food")})
    store = _converted(spark, sf, "convert", deliveries=short, order_items=goods)
    return convert.conversion_manifest(store, "2001-08-02").select("source", "status", "run_status")


def _spoilt_drop(spark, sf, name):
    """A load, one with a bad line, a bad date and a fraction, and a clean one after it."""
    store = _own_store(spark, sf, name)
    paths = {e: _path(spark, sf, e) for e in ENTITIES}
    spoilt = {e: f"{store.path('drop', e)}.json" for e in ("customers", "stores", "products")}
    bad_line = as_json(spark, sf, "stores").select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
    bad_line.unionByName(spark.createDataFrame([("{broken",)], "value string")).write.text(spoilt["stores"])
    bad_date = F.when(F.col("signup_date") == F.col("first_day"), "31/12/2024").otherwise(F.col("signup_date").cast("string"))
    customers = as_json(spark, sf, "customers")
    first = customers.agg(F.min("signup_date").alias("first_day"))
    customers.join(F.broadcast(first)).withColumn("signup_date", bad_date).drop("first_day").write.option("ignoreNullFields", False).json(spoilt["customers"])
    cents = as_json(spark, sf, "products").withColumn("base_price_ngn", F.lit(12.5))
    cents.write.option("ignoreNullFields", False).json(spoilt["products"])
    for date, drop in (("2001-08-01", paths), ("2001-08-02", paths | spoilt), ("2001-08-03", paths)):
        try:
            convert.convert_drop(store, drop, date, "batch", arrays=False)
        except convert.ConversionFailed:
            pass
    return store


_SPOILT_SOURCES = [
    (day, e, {"customers": "halted_schema_drift", "stores": "error"}.get(e, "success") if day == 2 else "success")
    for day in (1, 2, 3)
    for e in ("customers", "stores", "products", "orders", "order_items", "deliveries")
]


@query(
    "snk5_spoilt_sources",
    "SELECT '2001-08-0' || day AS load_date, source, status, CASE WHEN day = 2 AND source = 'stores' THEN 1 ELSE 0 END AS malformed_records, "
    "day = 2 AND source = 'stores' AS has_error FROM (VALUES "
    + ", ".join(f"({d}, '{e}', '{s}')" for d, e, s in _SPOILT_SOURCES)
    + ") t(day, source, status)",
)
def spoilt_sources(spark, sf):
    """A bad line is an error, a bad date halts, a fraction passes; the next clean load succeeds."""
    rows = _spoilt_drop(spark, sf, "spoilt").read_all("typed", "manifest", "load_date")
    return rows.select("load_date", "source", "status", "malformed_records", F.col("error").isNotNull().alias("has_error"))


@query("snk6_replace_table", "SELECT store_id, city FROM src_stores_2")
def replaced(spark, sf):
    store = _own_store(spark, sf, "replace")
    for snapshot in (1, 2):
        kept = store.replace("staging", "stores", mapping.stores(spark, sf, snapshot).select("store_id", "city"))
    return kept


@query(
    "snk7_append_run",
    "SELECT store_id, 'r1' AS run_id FROM src_stores_1 UNION ALL SELECT store_id, 'r2' FROM src_stores_2",
)
def appended(spark, sf):
    store = _own_store(spark, sf, "runs")
    for run, snapshot in (("r1", 2), ("r2", 2), ("r1", 1)):
        rows = mapping.stores(spark, sf, snapshot).select("store_id")
        store.write_partition("audit", "stores_seen", rows, "run_id", run)
    return store.read_all("audit", "stores_seen", "run_id")


# drift -------------------------------------------------------------------------------


def _changed_orders(spark, sf):
    """Orders with a column less, one more, a number as text and a wider number."""
    return as_json(spark, sf, "orders").drop("promo_code").withColumns(
        {
            "tip_ngn": F.lit(1.5),
            "qty_total": F.col("qty_total").cast("string"),
            "items_count": F.col("items_count") + F.lit(0.5),
        }
    )


def _changed_path(spark, sf, name):
    path = f"{_own_store(spark, sf, name).root}/orders.json"
    write_drop(_changed_orders(spark, sf), path)
    return path


_OBSERVED = ", ".join(
    f"('{f.name}', '{'string' if f.dataType.simpleString() in ('date', 'timestamp_ntz') else f.dataType.simpleString()}')"
    for f in CONTRACTS["orders"].fields
)


@query("drf1_observed_schema", f"SELECT * FROM (VALUES {_OBSERVED}) t(column_name, column_type)")
def observed(spark, sf):
    found = observe_schema(spark, _path(spark, sf, "orders"), arrays=False)
    return spark.createDataFrame(
        [(f.name, f.dataType.simpleString()) for f in found.fields], "column_name string, column_type string"
    )


@query(
    "drf2_drift",
    """SELECT * FROM (VALUES ('orders', 'promo_code', 'missing', 'string', NULL, TRUE),
       ('orders', 'items_count', 'type', 'bigint', 'double', FALSE), ('orders', 'qty_total', 'type', 'bigint', 'string', TRUE),
       ('orders', 'tip_ngn', 'new', NULL, 'double', FALSE)) t("source", "column", change, expected, actual, breaking)""",
)
def drifted(spark, sf):
    found = observe_schema(spark, _changed_path(spark, sf, "drift"), arrays=False)
    return drift(spark, "orders", CONTRACTS["orders"], found)


@query(
    "drf3_accepted_contract",
    """SELECT * FROM (VALUES ('store_id', 'string'), ('store_name', 'string'), ('city', 'string'),
       ('opening_hours', 'string'), ('delivery_sla_minutes', 'double'), ('seats', 'bigint')) t(column_name, column_type)""",
)
def accepted(spark, sf):
    """A new column and a wider number are taken into the contract of the next load."""
    wider = as_json(spark, sf, "stores").withColumns(
        {"seats": F.lit(40), "delivery_sla_minutes": F.col("delivery_sla_minutes") + F.lit(0.5)}
    )
    store = _converted(spark, sf, "accept", stores=wider)
    contract = convert.load_contracts(store)["stores"]
    return spark.createDataFrame(
        [(f.name, f.dataType.simpleString()) for f in contract.fields], "column_name string, column_type string"
    )


def _spoilt(spark, sf):
    number = F.substring("order_id", 2, 20).cast("bigint")
    rows = as_json(spark, sf, "orders")
    return rows.withColumn("order_ts", F.when(number % 37 == 0, "not a time").otherwise(F.col("order_ts")))


_SPOILT = "CASE WHEN CAST(order_id[2:] AS BIGINT) % 37 = 0 THEN NULL ELSE order_ts END"


@query("drf4_safe_casts", f"SELECT order_id, {_SPOILT} AS order_ts FROM src_orders")
def safe(spark, sf):
    return typed(_spoilt(spark, sf), CONTRACTS["orders"]).select("order_id", "order_ts")


@query("drf5_null_counts", f"SELECT 'order_ts' AS \"column\", count(*) AS null_count FROM src_orders WHERE ({_SPOILT}) IS NULL")
def nulls(spark, sf):
    return null_counts(typed(_spoilt(spark, sf), CONTRACTS["orders"]), ["order_ts"])


@query(
    "drf6_lineage",
    f"SELECT store_id, 'stores.json' AS _source_file, '{staging.run_batch_id('raw', '2001-08-02')}' AS _batch_id, TRUE AS is_loaded FROM src_stores_2",
)
def lineage(spark, sf):
    rows = read_entity(spark, _path(spark, sf, "stores"), "stores", arrays=False)
    stamped = with_lineage(rows, "stores", staging.run_batch_id("raw", "2001-08-02"))
    return stamped.select("store_id", "_source_file", "_batch_id", F.col("_loaded_at").isNotNull().alias("is_loaded"))


# state of drops ----------------------------------------------------------------------


@query(
    "inc1_3_drop_states",
    """SELECT * FROM (VALUES (1, 'missing'), (2, 'ready'), (3, 'unchanged'), (4, 'ready')) t(step, status)""",
)
def drop_states(spark, sf):
    """Absent, first seen, marked as processed, and changed."""
    store = _own_store(spark, sf, "state")
    folder = store.path("drop", "").rstrip("/")
    seen = [drops.inspect_drop(spark, folder).status]
    for entity in ENTITIES:
        as_json(spark, sf, entity).write.json(f"{folder}/{entity}.json", compression="gzip")
    ready = drops.inspect_drop(spark, folder, drops.last_fingerprint(store))
    seen.append(ready.status)
    drops.mark_processed(store, ready, "2001-08-02", "run")
    seen.append(drops.inspect_drop(spark, folder, drops.last_fingerprint(store)).status)
    as_json(spark, sf, "stores").write.mode("append").json(f"{folder}/stores.json")
    seen.append(drops.inspect_drop(spark, folder, drops.last_fingerprint(store)).status)
    return spark.createDataFrame(list(enumerate(seen, start=1)), "step int, status string")


_DIGESTED = sorted(f.name for f in CONTRACTS["stores"].fields)
_DIGEST_TEXT = " || ".join(f"coalesce('{c}=' || length({c}::VARCHAR) || ':' || {c}::VARCHAR || ';', '')" for c in sorted([*_DIGESTED, "seats"]))
_LIMBS = ", ".join(f"sum(('0x' || substr(h, {8 * k + 1}, 8))::UBIGINT)::DECIMAL(38,0) AS limb{k}" for k in range(8))


@query(
    "inc2_table_fingerprint",
    f"""SELECT count(*) AS n, {_LIMBS}, 1 AS loads_read, true AS same
        FROM (SELECT sha256({_DIGEST_TEXT}) AS h FROM (
            SELECT *, NULL::BIGINT AS seats FROM src_stores_1
            UNION ALL SELECT *, length(store_name) AS seats FROM src_stores_2))""",
)
def fingerprints(spark, sf):
    """The digest of two loads, the first of which had been read before; the same as that of all rows in another order."""
    store = _own_store(spark, sf, "digest")
    store.write_load("stores", mapping.stores(spark, sf, 1), str(mapping.FIRST_LOAD))
    digests.load_digests(store, "stores")
    second = mapping.stores(spark, sf, 2).withColumn("seats", F.length("store_name").cast("bigint"))
    store.write_load("stores", second, str(mapping.SECOND_LOAD))
    kept, read = digests.load_digests(store, "stores")
    total = digests.added(kept)
    whole = digests.content_digest(store.read_loads("stores").drop("load_date").repartition(5)).first()
    same = digests.fingerprint(whole) == digests.fingerprint(total.first())
    return total.withColumns({"loads_read": F.lit(len(read)), "same": F.lit(same)})


@query(
    "inc9_late_file_supersedes",
    "SELECT store_id, city, trim(city) AS clean_city FROM src_stores_2",
)
def superseded(spark, sf):
    loads = _two_loads(spark, sf, "late").read_loads("stores")
    return staging.int_stores(loads, "batch").select("store_id", "city", "clean_city")
