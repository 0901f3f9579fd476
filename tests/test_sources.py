"""Drops, drift, conversion and landing."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from galley.sources import convert, drops
from galley.sources.contracts import CONTRACTS, ENTITIES
from galley.sources.entity_json import drift_rows, read_entity

STORE = {"store_id": "S1", "store_name": "One", "city": " Lagos ", "opening_hours": "09:00-23:00", "delivery_sla_minutes": 30}
RECORDS = {
    "customers": [{"customer_id": "C1", "signup_date": "2024-01-31", "city": "Jos", "phone": "1", "is_business": 0}],
    "stores": [STORE],
    "products": [{"product_id": "P1", "product_name": "Pie", "category": "Pizza", "base_price_ngn": 500}],
    "orders": [
        {
            "order_id": f"O{i}", "order_ts": ts, "store_id": "S1", "customer_id": "C1", "channel": "Dine-in",
            "payment_method": "Card", "promo_code": "X", "items_count": 1, "qty_total": 1, "subtotal_ngn": 5.5,
            "discount_ngn": 0.5, "tax_ngn": 0.5, "delivery_fee_ngn": 0, "total_amount_ngn": 5.5,
            "promised_delivery_minutes": 30, "actual_delivery_minutes": 31,
        }
        for i, ts in enumerate(["2024-05-01T10:00:00", "2024-05-01 11:30:00", "never"])
    ],
    "order_items": [
        {"order_id": "O0", "product_id": "P1", "product_name": "Pie", "category": "Pizza", "qty": 1, "unit_price_ngn": 5.5, "line_total_ngn": 5.5}
    ],
    "deliveries": [
        {"order_id": "O0", "store_id": "S1", "order_ts": "2024-05-01T10:00:00", "promised_delivery_minutes": 30, "actual_delivery_minutes": 31, "delivered_within_sla": 0}
    ],
}


def write_drop(folder, **changed):
    folder.mkdir(exist_ok=True)
    for entity, records in {**RECORDS, **changed}.items():
        (folder / f"{entity}.json").write_text(json.dumps(records, indent=2), encoding="utf-8")
    return folder


@pytest.fixture
def drop(tmp_path):
    return write_drop(tmp_path / "drop")


def paths(folder):
    return {e: f"file://{folder}/{e}.json" for e in ENTITIES}


# state -------------------------------------------------------------------------------


def test_drop_is_unchanged_after_mark_and_ready_after_a_change(spark, store, drop):
    url = f"file://{drop}"
    first = drops.inspect_drop(spark, url, drops.last_fingerprint(store))
    assert first.status == drops.READY
    drops.mark_processed(store, first, "2024-05-01", "run")
    second = drops.inspect_drop(spark, url, drops.last_fingerprint(store))
    assert second.status == drops.UNCHANGED and second.fingerprint == first.fingerprint
    with pytest.raises(RuntimeError):
        drops.mark_processed(store, second, "2024-05-01", "run")
    write_drop(drop, stores=[{**STORE, "city": "Abuja"}])
    assert drops.inspect_drop(spark, url, drops.last_fingerprint(store)).status == drops.READY


def test_fingerprint_is_the_hash_of_compact_json(spark, drop):
    entries = []
    for name in drops.REQUIRED_FILES:
        data = (drop / name).read_bytes()
        entries.append({"file": name, "size_bytes": len(data), "sha256": hashlib.sha256(data).hexdigest()})
    text = json.dumps(entries, sort_keys=True, separators=(",", ":"))
    assert drops.inspect_drop(spark, f"file://{drop}").fingerprint == hashlib.sha256(text.encode()).hexdigest()


def test_missing_empty_and_incomplete_drops(spark, tmp_path):
    assert drops.inspect_drop(spark, f"file://{tmp_path}/none").status == drops.MISSING
    folder = tmp_path / "some"
    folder.mkdir()
    (folder / ".hidden.json").write_text("[]")
    (folder / "notes.txt").write_text("x")
    assert drops.inspect_drop(spark, f"file://{folder}").status == drops.EMPTY
    (folder / "orders.json").write_text("[]")
    with pytest.raises(FileNotFoundError, match="it lacks customers.json"):
        drops.inspect_drop(spark, f"file://{folder}")


def test_landed_files_keep_their_bytes(store, drop):
    url = f"file://{drop}"
    (drop / "stores.json").write_bytes(b"\xef\xbb\xbf[]\r\n\xff")
    first = drops.land_drop(store, url, "2024-05-01")
    write_drop(drop, stores=[{**STORE, "city": "Abuja"}])
    again = drops.land_drop(store, url, "2024-05-01")  # replaces the first
    assert {(r["file"], r["status"], r["run_status"]) for r in again.collect()} == {(f, "success", "success") for f in drops.REQUIRED_FILES}
    assert {r["landed_in"] for r in first.collect()} != {r["landed_in"] for r in again.collect()}
    assert drops.landed_folder(store, "2024-05-01") == again.first()["landed_in"]
    for r in again.collect():
        data = (drop / r["name"]).read_bytes()
        with open(r["object_path"].removeprefix("file:"), "rb") as kept:
            assert kept.read() == data
        assert (r["size_bytes"], r["sha256"]) == (len(data), hashlib.sha256(data).hexdigest())


def test_files_are_streamed_in_blocks_whatever_their_size(spark, store, drop, monkeypatch):
    monkeypatch.setattr(drops, "BLOCK_BYTES", 7)
    small = {r["file"]: r["sha256"] for r in drops.drop_files(spark, f"file://{drop}").collect()}
    assert small == {f: hashlib.sha256((drop / f).read_bytes()).hexdigest() for f in drops.REQUIRED_FILES}


def test_swapped_values_change_a_drop(spark, store, tmp_path):
    one = [{**STORE, "store_id": "S1", "city": "A"}, {**STORE, "store_id": "S2", "city": "B"}]
    two = [{**STORE, "store_id": "S1", "city": "B"}, {**STORE, "store_id": "S2", "city": "A"}]
    drop = write_drop(tmp_path / "drop", stores=one)
    seen = drops.inspect_drop(spark, f"file://{drop}")
    drops.mark_processed(store, seen, "2024-05-01", "run")
    write_drop(drop, stores=two)
    assert drops.inspect_drop(spark, f"file://{drop}", drops.last_fingerprint(store)).status == drops.READY


def test_landing_reports_files_it_could_not_copy(store, drop):
    blocked = store.path("landing", "files").removeprefix("file://")
    files = drops.listing(store.spark, f"file://{drop}")
    gone = files.withColumn("path", F.when(F.col("file") == "stores.json", "file:/none/stores.json").otherwise(F.col("path")))
    found = {r["file"]: r["error"] for r in drops.streamed_files(gone, f"file://{blocked}").collect()}
    assert found["stores.json"] and [f for f, e in found.items() if e] == ["stores.json"]


# drift -------------------------------------------------------------------------------


def schema(**kinds):
    names = {"b": T.LongType(), "d": T.DoubleType(), "s": T.StringType(), "t": T.TimestampNTZType(), "m": T.DecimalType(9, 2)}
    return T.StructType([T.StructField(k, names[v]) for k, v in kinds.items()])


@pytest.mark.parametrize(
    "expected, actual, change, breaking",
    [
        (schema(a="b"), schema(a="b", x="s"), ("x", "new"), False),
        (schema(a="b", x="s"), schema(a="b"), ("x", "missing"), True),
        (schema(a="b"), schema(a="d"), ("a", "type"), False),
        (schema(a="d"), schema(a="b"), ("a", "type"), False),
        (schema(a="m"), schema(a="d"), ("a", "type"), False),
        (schema(a="s"), schema(a="b"), ("a", "type"), True),
        (schema(a="b"), schema(a="s"), ("a", "type"), True),
        (schema(a="t"), schema(a="b"), ("a", "type"), True),
    ],
)
def test_drift_is_classified(expected, actual, change, breaking):
    (row,) = drift_rows("x", expected, actual)
    assert (row[1], row[2]) == change and row[5] is breaking


def test_text_is_how_json_carries_times():
    assert drift_rows("x", schema(a="t"), schema(a="s")) == []


# conversion --------------------------------------------------------------------------


def test_conversion_writes_typed_loads_and_a_manifest(spark, store, drop):
    manifest = convert.convert_drop(store, paths(drop), "2024-05-01", "batch")
    assert {r["source"]: r["status"] for r in manifest.collect()} == dict.fromkeys(ENTITIES, "success")
    orders = store.read_loads("orders")
    assert orders.schema["order_ts"].dataType == T.TimestampNTZType()
    assert orders.where("order_ts IS NULL").count() == 1
    assert manifest.where("source = 'orders'").selectExpr("timestamp_nulls.order_ts").first()[0] == 1
    row = store.read_loads("customers").first()
    assert str(row["signup_date"]) == "2024-01-31" and row["_source_file"] == "customers.json" and row["_batch_id"] == "batch"
    convert.convert_drop(store, paths(drop), "2024-05-01", "batch")  # a replay replaces
    assert store.read_loads("orders").count() == 3


def test_breaking_drift_halts_one_source_and_is_reported_last(store, tmp_path):
    bad = [{k: v for k, v in STORE.items() if k != "city"}]
    drop = write_drop(tmp_path / "drop", stores=bad)
    with pytest.raises(convert.ConversionFailed) as failure:
        convert.convert_drop(store, paths(drop), "2024-05-01", "batch")
    assert failure.value.failures == [("stores", "halted_schema_drift")]
    assert not store.exists("typed", "stores") and store.exists("typed", "deliveries")


def test_unreadable_source_is_an_error_and_others_go_on(store, drop):
    wrong = {**paths(drop), "customers": f"file://{drop}/absent.json"}
    with pytest.raises(convert.ConversionFailed) as failure:
        convert.convert_drop(store, wrong, "2024-05-01", "batch")
    assert failure.value.failures == [("customers", "error")]


def test_accepted_drift_becomes_the_contract_and_old_loads_read_null(store, tmp_path):
    drop = write_drop(tmp_path / "drop")
    convert.convert_drop(store, paths(drop), "2024-05-01", "b1")
    write_drop(drop, stores=[{**STORE, "seats": 12}])
    convert.convert_drop(store, paths(drop), "2024-05-02", "b2")
    seats = {r["load_date"]: r["seats"] for r in store.read_loads("stores").collect()}
    assert seats == {"2024-05-01": None, "2024-05-02": 12}
    assert "seats" in convert.load_contracts(store)["stores"].names
    write_drop(drop)  # the column is now part of the contract
    with pytest.raises(convert.ConversionFailed):
        convert.convert_drop(store, paths(drop), "2024-05-03", "b3")


def test_a_malformed_line_fails_its_source_and_nothing_else(store, tmp_path):
    drop = write_drop(tmp_path / "drop")
    lines = lambda records: "\n".join(json.dumps(r) for r in records) + "\n"
    for entity, records in RECORDS.items():
        (drop / f"{entity}.json").write_text(lines(records))
    convert.convert_drop(store, paths(drop), "2024-05-01", "b1", arrays=False)
    (drop / "stores.json").write_text(lines([{**STORE, "store_id": "S9"}]) + "{broken\n")
    with pytest.raises(convert.ConversionFailed) as failure:
        convert.convert_drop(store, paths(drop), "2024-05-01", "b2", arrays=False)
    assert failure.value.failures == [("stores", "error")]
    row = convert.conversion_manifest(store, "2024-05-01").where("source = 'stores'").first()
    assert (row["status"], row["malformed_records"], row["run_status"]) == ("error", 1, "partial_failure")
    assert [r["store_id"] for r in store.read_loads("stores").collect()] == ["S1"]  # the load before is left
    (drop / "stores.json").write_text(lines([{**STORE, "store_id": "S2"}]))
    convert.convert_drop(store, paths(drop), "2024-05-02", "b3", arrays=False)
    assert convert.load_contracts(store)["stores"] == CONTRACTS["stores"]


def test_text_that_is_no_date_halts_its_source(store, tmp_path):
    bad = [{**RECORDS["customers"][0], "signup_date": d} for d in ("2024-01-31", "31/12/2024", None)]
    drop = write_drop(tmp_path / "drop", customers=bad)
    with pytest.raises(convert.ConversionFailed) as failure:
        convert.convert_drop(store, paths(drop), "2024-05-01", "b1")
    assert failure.value.failures == [("customers", "halted_schema_drift")]
    row = convert.conversion_manifest(store, "2024-05-01").where("source = 'customers'").first()
    assert [(d["column"], d["expected"], d["actual"], d["breaking"]) for d in row["drift"]] == [("signup_date", "date", "string", True)]
    assert not store.exists("typed", "customers")


def test_a_fraction_is_kept(spark, tmp_path):
    drop = write_drop(tmp_path / "drop", products=[{**RECORDS["products"][0], "base_price_ngn": 12.5}])
    assert read_entity(spark, paths(drop)["products"], "products").first()["base_price_ngn"] == 12.5


def test_a_write_that_fails_leaves_the_table(spark, store):
    store.replace("marts", "t", spark.range(3))
    broken = spark.range(10).selectExpr("if(id = 7, raise_error('no'), id) AS id")
    with pytest.raises(Exception, match="no"):
        store.replace("marts", "t", broken)
    assert store.read("marts", "t").count() == 3
    for n in (4, 5, 6):
        kept = store.read("marts", "t")
        store.replace("marts", "t", spark.range(n))
        assert kept.count() in (3, 4, 5)  # one who has begun to read goes on
    assert len(store._numbers(store.path("marts", "t"))) == 2
    store.write_partition("marts", "p", spark.range(2), "day", "a")
    with pytest.raises(Exception, match="no"):
        store.write_partition("marts", "p", broken, "day", "a")
    assert store.read_all("marts", "p", "day").count() == 2


def test_unknown_source_is_refused(store):
    with pytest.raises(ValueError):
        convert.convert_drop(store, {"menus": "x"}, "2024-05-01", "b")


def test_contract_read_turns_bad_times_into_null(spark, drop):
    rows = read_entity(spark, paths(drop)["orders"], "orders")
    assert rows.columns == CONTRACTS["orders"].names
    assert sorted(str(r["order_ts"]) for r in rows.collect()) == ["2024-05-01 10:00:00", "2024-05-01 11:30:00", "None"]
