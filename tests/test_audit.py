"""Quality rules, exceptions, gate and histories on hand-made rows."""

import datetime as dt
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from checks import audit as stored_audits
from galley.plans import quality
from galley.plans.quality_texts import CHECKS

RUN = quality.AuditRun("run", dt.date(2024, 5, 1), dt.date(2024, 5, 1))
LOADED = dt.datetime(2024, 5, 1)

ORDER = (
    "order_id string, customer_id string, store_id string, channel string, promo_code string, "
    "order_timestamp timestamp_ntz, items_count bigint, qty_total bigint, subtotal_ngn decimal(18,4), "
    "discount_ngn decimal(18,4), tax_ngn decimal(18,4), delivery_fee_ngn bigint, total_amount_ngn decimal(18,4), "
    "_source_file string, _loaded_at timestamp_ntz"
)


def order(order_id, **changes):
    row = dict(
        customer_id="c", store_id="s", channel="Dine-in", promo_code=None, order_timestamp=dt.datetime(2024, 4, 30),
        items_count=1, qty_total=2, subtotal_ngn=10, discount_ngn=0, tax_ngn=0, delivery_fee_ngn=0, total_amount_ngn=10,
    )
    row.update(changes)
    values = [Decimal(str(v)) if k.endswith(("subtotal_ngn", "discount_ngn", "tax_ngn", "total_amount_ngn")) else v for k, v in row.items()]
    return (order_id, *values, "orders.json", LOADED)


CASES = {
    "good": ({}, set()),
    "no customer": ({"customer_id": "nobody"}, {"orphan_order_customer"}),
    "null store": ({"store_id": None}, {"orphan_order_store", "null_critical_order_fields"}),
    "channel": ({"channel": "Kiosk"}, {"invalid_channel"}),
    "null channel": ({"channel": None}, {"invalid_channel"}),
    "undelivered": ({"channel": "Online App"}, {"missing_delivery_for_delivery_order"}),
    "negative": ({"subtotal_ngn": -1, "total_amount_ngn": -1}, {"negative_order_amount", "discount_exceeds_subtotal", "order_item_subtotal_mismatch"}),
    "no time": ({"order_timestamp": None}, {"null_critical_order_fields", "invalid_order_timestamp"}),
    "too early": ({"order_timestamp": dt.datetime(2019, 12, 31)}, {"invalid_order_timestamp"}),
    "tomorrow": ({"order_timestamp": dt.datetime(2024, 5, 2, 23)}, set()),
    "too late": ({"order_timestamp": dt.datetime(2024, 5, 3)}, {"invalid_order_timestamp"}),
    "discount": ({"discount_ngn": 11, "total_amount_ngn": -1}, {"discount_exceeds_subtotal", "negative_order_amount"}),
    "formula": ({"total_amount_ngn": 10.06}, {"order_total_formula_mismatch"}),
    "tolerated": ({"total_amount_ngn": 10.05}, set()),
    "count": ({"items_count": 2}, {"order_items_count_mismatch"}),
    "units": ({"qty_total": 3}, {"order_quantity_total_mismatch"}),
    "subtotal": ({"subtotal_ngn": 9.98, "total_amount_ngn": 9.98}, {"order_item_subtotal_mismatch"}),
    "promo": ({"promo_code": "X"}, {"promo_with_zero_discount"}),
    "blank promo": ({"promo_code": ""}, set()),
    "late": ({"order_timestamp": dt.datetime(2024, 4, 29)}, {"late_arriving_order_records"}),
    "long ago": ({"order_timestamp": dt.datetime(2024, 3, 31)}, set()),
}


@pytest.fixture(scope="module")
def failed(spark):
    orders = spark.createDataFrame([order(name, **changes) for name, (changes, _) in CASES.items()], ORDER)
    items = orders.select(
        "order_id", F.lit("p").alias("product_id"), F.lit(2).cast("bigint").alias("quantity"),
        F.lit(10).cast("decimal(18,4)").alias("product_revenue"), "_source_file", "_loaded_at",
    )
    one = lambda column, value: spark.createDataFrame([(value,)], f"{column} string")
    tagged = quality.tag_orders(
        orders, one("customer_id", "c"), one("store_id", "s"), one("order_id", "elsewhere"), items
    )
    rules = quality.order_rules(RUN)
    found: dict[str, set] = {name: set() for name in CASES}
    for r in quality.failing_rows(tagged, rules, "order_id").collect():
        found[r["record_key"]].add(r["check_name"])
    return found


@pytest.mark.parametrize("name", CASES)
def test_order_rules(failed, name):
    assert failed[name] == CASES[name][1]


def counted(df, rules, key):
    lineage = df.withColumn("_source_file", F.lit("f")).withColumn("_loaded_at", F.lit(LOADED))
    return dict(Counter(r["check_name"] for r in quality.failing_rows(lineage, rules, key).collect()))


def test_line_and_delivery_rules(spark):
    items = spark.createDataFrame(
        [("o", "p", 1, 5, True, True), ("o", "q", 0, 5, True, False), ("x", None, 1, -1, False, False)],
        "order_id string, product_id string, quantity int, product_revenue int, _has_order boolean, _has_product boolean",
    )
    counts = counted(items, quality.ITEM_RULES, "order_id")
    assert counts == {"orphan_item_order": 1, "orphan_item_product": 2, "negative_item_revenue": 2}
    sent = spark.createDataFrame(
        [(0, 10, 10, True), (2, 10, 10, True), (None, 0, None, False)],
        "delivery_sla_met_flag int, promised_delivery_minutes int, actual_delivery_minutes int, _has_order boolean",
    )
    counts = counted(sent, quality.DELIVERY_RULES, "'x'")
    assert counts == {"orphan_delivery_order": 1, "invalid_delivery_sla_flag": 2, "invalid_delivery_time": 1}


def test_texts_of_unique_keys_are_not_grouped(spark, monkeypatch):
    pins, pin = [], quality.pin
    monkeypatch.setattr(quality, "pin", lambda df: pins.append(pin(df)) or pins[-1])
    df = spark.range(100).selectExpr("IF(id < 3, 'twice', CAST(id AS STRING)) AS k", "IF(id = 9, NULL, 'p') AS l", "CAST(id AS STRING) AS _source_file")
    found = quality.repeated_keys({"x": (df, ["k", "l"]), "y": (df, ["k"])}).collect()
    assert pins[0].columns == ["_hash"] and pins[0].count() == 3
    assert {(r["check_name"], r["key_1"], r["key_2"], r["n"], r["source_file"], r["has_null"]) for r in found} == {
        ("x", "twice", "p", 3, "0", False), ("x", "9", None, 1, "9", True), ("y", "twice", None, 3, "0", False)
    }


def test_duplicates_count_null_keys_like_rows_minus_distinct(spark):
    df = spark.createDataFrame([("a", "f", LOADED), ("a", "e", LOADED), ("b", "f", LOADED), (None, "f", LOADED), (None, "f", LOADED)],
                               "k string, _source_file string, _loaded_at timestamp_ntz")
    found = quality.repeated_keys({"x": (df, ["k"]), "none": (df.where("false"), ["k"])})
    assert {(r["check_name"], r["key_1"], r["n"], r["source_file"]) for r in found.collect()} == {("x", "a", 2, "e"), ("x", None, 2, "f")}
    assert [tuple(r) for r in found.groupBy("check_name").agg(F.expr(quality.DUPLICATES)).collect()] == [("x", 3)]


def test_pairs_with_a_null_part_are_not_mixed_up(spark):
    df = spark.createDataFrame([(None, "p"), (None, "q"), ("o", "p"), ("o", "p")], "order_id string, product_id string")
    df = df.withColumn("_source_file", F.lit("f")).withColumn("_loaded_at", F.lit(LOADED))
    found = quality.repeated_keys({"x": (df, ["order_id", "product_id"])}).where("n > 1").collect()
    assert [(r["key_1"], r["key_2"]) for r in found] == [("o", "p")]


def test_volume_jumps_need_ten_orders_the_day_before(spark):
    days = [(1, 9), (2, 20), (3, 30), (4, 14), (6, 22)]
    rows = [(dt.datetime(2024, 1, d),) for d, n in days for _ in range(n)]
    df = spark.createDataFrame(rows, "order_timestamp timestamp_ntz")
    assert sorted(r["order_date"].day for r in quality.daily_jumps(df).collect()) == [4, 6]


def test_every_check_is_listed_once():
    assert len(CHECKS) == 41 and len({c.name for c in CHECKS}) == 41
    assert sum(c.issue is not None for c in CHECKS) == 27


def gate_frames(spark, result="PASS", recon="PASS", severity="WARN"):
    return (
        spark.createDataFrame([("c1", result)], "check_name string, status string"),
        spark.createDataFrame([("m1", recon), ("m1", recon)], "metric string, status string"),
        spark.createDataFrame([("c1", severity)], "check_name string, severity string"),
    )


def test_gate_passes_on_warnings(spark):
    quality.require_passed(*gate_frames(spark, result="WARN"))


@pytest.mark.parametrize(
    "change, blocker", [({"result": "FAIL"}, ("check", "c1", 1)), ({"recon": "FAIL"}, ("metric", "m1", 2)), ({"severity": "ERROR"}, ("exception", "c1", 1))]
)
def test_gate_names_what_blocks(spark, change, blocker):
    with pytest.raises(quality.AuditFailed) as failure:
        quality.require_passed(*gate_frames(spark, **change))
    assert [tuple(b) for b in failure.value.blockers] == [blocker] and blocker[1] in str(failure.value)


def test_history_replaces_a_run_even_by_nothing(spark, store):
    df = spark.createDataFrame([(1,), (2,)], "n int")
    for run, rows in (("manual__2024-05-01T00:00:00+00:00", df), ("b", df), ("b", df.where("n = 1")), ("b", df.where("false"))):
        store.write_partition("audit", "history", rows, "run_id", run)
    kept = store.read_all("audit", "history", "run_id").collect()
    assert sorted((r["run_id"], r["n"]) for r in kept) == [
        ("manual__2024-05-01T00:00:00+00:00", 1), ("manual__2024-05-01T00:00:00+00:00", 2),
    ]


def test_stored_results_and_exceptions_share_one_audit(spark, tmp_path, monkeypatch):
    (tmp_path / "sf").symlink_to("/root/testdata/sf0.001")  # a warehouse of its own
    runs, original = [], quality.tag_items
    monkeypatch.setattr(quality, "tag_items", lambda *tables: (runs.append(1), original(*tables))[1])
    sf = f"{tmp_path}/sf"
    results, exceptions = stored_audits._stored_results(spark, sf), stored_audits._stored_exceptions(spark, sf)
    counts = {r["check_name"]: r["n"] for r in exceptions.groupBy("check_name").agg(F.count("*").alias("n")).collect()}
    observed = {r["check_name"]: r["observed_value"] for r in results.collect()}
    assert counts and all(observed[name] == n for name, n in counts.items() if not name.startswith("duplicate"))
    assert len(runs) == 1
