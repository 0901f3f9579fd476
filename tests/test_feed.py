"""Provider feed: replays, corrections, late and invalid records, in batch and as a stream."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from galley.functions import json_field, parse_utc, remap, utc_literal
from galley.operators.durable import shared_folder
from galley.plans import feed
from galley.sources.contracts import FEED_RECORD
from galley.sources.feed_pages import flatten, read_pages
from galley.sources.page_zones import PageZones
from galley.streaming.feed_stream import append_changes, change_log, compact, current_state, start_feed


def record(number, updated, **changes):
    row = dict.fromkeys(FEED_RECORD.names)
    row.update(
        delivery_id=f"D{number}", order_id=f"O{number}", brand="Corner Bakery", store_id="S1", store_name="One", city="Jos",
        delivery_status="assigned", assigned_at="2026-05-01T10:00:00Z", promised_delivery_at="2026-05-01T10:45:00Z",
        delivery_fee=50000, distance_km=2.5, created_at="2026-05-01T09:55:00Z", updated_at=updated,
    )
    row.update(changes)
    return row


FIRST = [record(n, f"2026-05-02T10:{n:02d}:00Z") for n in range(1, 7)]
SECOND = [
    FIRST[0],  # exact replay
    record(2, "2026-05-04T10:00:00Z", delivery_status="delivered", delivery_fee=55000, city="Kano"),  # correction
    record(3, "2026-05-13T09:55:00Z", delivery_status="failed"),  # late update of an old record
    record(4, "2026-05-01T12:00:00Z", delivery_status="pending"),  # older than what is known
    record(9, "2026-05-05T10:00:00Z"),
    record(1, "2026-12-31T00:00:00Z", delivery_id=None, delivery_fee=-100, distance_km=-1.0, brand="Unexpected"),
]


def write_page(folder, name, records):
    folder.mkdir(exist_ok=True)
    envelope = {"data": records, "pagination": {"next_cursor": None, "has_more": False, "limit": 100},
                "metadata": {"request_id": name, "record_count": len(records), "generated_at": "2026-05-06T00:00:00Z"}}
    (folder / f"{name}.json").write_text(json.dumps(envelope))


@pytest.fixture
def pages(tmp_path):
    folder = tmp_path / "pages"
    write_page(folder, "p1", FIRST)
    return folder


def state(df):
    return {r["delivery_id"]: (r["delivery_status"], r["delivery_fee"], r["city"], str(r["updated_at"])) for r in df.collect()}


EXPECTED = {
    "D1": ("assigned", 50000, "Jos", "2026-05-02 10:01:00"),
    "D2": ("delivered", 55000, "Jos", "2026-05-04 10:00:00"),
    "D3": ("failed", 50000, "Jos", "2026-05-13 09:55:00"),
    "D4": ("assigned", 50000, "Jos", "2026-05-02 10:04:00"),
    "D5": ("assigned", 50000, "Jos", "2026-05-02 10:05:00"),
    "D6": ("assigned", 50000, "Jos", "2026-05-02 10:06:00"),
    "D9": ("assigned", 50000, "Jos", "2026-05-05 10:00:00"),
}


def test_batch_ingest_moves_the_watermark_and_keeps_first_columns(store, pages):
    path = f"file://{pages}"
    assert feed.read_watermark(store, "riders") == feed.FIRST_WATERMARK
    assert feed.ingest_pages(store, path, "riders") == "2026-05-02T10:06:00Z"
    write_page(pages, "p2", SECOND[:-1])
    assert feed.ingest_pages(store, path, "riders") == "2026-05-13T09:55:00Z"
    assert state(feed.delivery_table(store).read()) == EXPECTED
    assert feed.ingest_pages(store, path, "riders") == "2026-05-13T09:55:00Z"  # nothing newer
    assert feed.read_watermark(store, "other") == feed.FIRST_WATERMARK


def test_a_watermark_has_no_zeros_at_the_end_of_its_fraction(store, pages):
    path = f"file://{pages}"
    write_page(pages, "p2", [record(30, "2026-05-14T10:00:00.120000Z")])
    assert feed.ingest_pages(store, path, "riders") == "2026-05-14T10:00:00.12Z"
    assert feed.read_watermark(store, "riders") == "2026-05-14T10:00:00.12Z"
    write_page(pages, "p3", [record(31, "2026-05-14T10:00:00.120001Z")])
    assert feed.ingest_pages(store, path, "riders") == "2026-05-14T10:00:00.120001Z"
    write_page(pages, "p4", [record(32, "2026-05-14T10:00:10Z")])
    assert feed.ingest_pages(store, path, "riders") == "2026-05-14T10:00:10Z"


def test_rows_kept_for_a_run_go_with_it(spark, store, pages):
    feed.ingest_pages(store, f"file://{pages}", "riders")
    root = f"{shared_folder(spark)}/scratch/{spark.sparkContext.applicationId}"
    assert not store._found(root, "*/*")


def test_watermark_stays_when_reconciliation_fails(store, pages):
    def short(table, summary):
        return feed.reconcile_feed(table.where("delivery_id <> 'D1'"), summary)

    with pytest.raises(feed.FeedReconciliationFailed):
        feed.ingest_pages(store, f"file://{pages}", "riders", reconcile=short)
    assert feed.read_watermark(store, "riders") == feed.FIRST_WATERMARK


def test_stream_equals_batch_also_after_replays_and_compaction(spark, store, pages, tmp_path):
    path, checkpoint = f"file://{pages}", f"file://{tmp_path}/checkpoint"
    start_feed(store, path, checkpoint).awaitTermination()
    write_page(pages, "p2", SECOND)
    start_feed(store, path, checkpoint).awaitTermination()
    assert state(current_state(store)) == EXPECTED
    compact(store)
    assert state(current_state(store)) == EXPECTED
    again = spark.read.json([f"file://{pages}/p2.json"], schema=read_pages(spark, path).schema)
    append_changes(store, flatten(again), 1)  # the records come again
    append_changes(store, flatten(again), 1)  # in a batch that is repeated
    start_feed(store, path, f"{checkpoint}-lost").awaitTermination()  # and from a new stream
    sources = change_log(store).log.newest()[1]["sources"]
    assert sorted(sources.values()) == [0, 1, 1] and "None" not in sources and len(sources) == 3
    assert state(current_state(store)) == EXPECTED
    assert state(compact(store)) == EXPECTED


def test_violations_name_each_broken_rule(spark, pages):
    write_page(pages, "p2", SECOND)
    found = feed.violations(flatten(read_pages(spark, f"file://{pages}")), ["Corner Bakery"], dt.datetime(2026, 6, 1))
    assert sorted(r["rule"] for r in found.collect()) == [
        "future_updated_at", "negative_delivery_fee", "negative_distance", "null_delivery_id", "unknown_brand",
    ]


def test_summary_counts_latest_states(spark, pages):
    write_page(pages, "p2", SECOND)
    records = flatten(read_pages(spark, f"file://{pages}"))
    row = feed.provider_summary(records).first()
    assert (row["source_record_count"], row["distinct_delivery_count"]) == (12, 7)
    assert (row["delivered_count"], row["failed_count"], row["cancelled_count"]) == (1, 1, 0)
    assert row["total_delivery_fees"] == 6 * 50000 + 55000 - 100
    assert row["delivery_count_by_brand"] == {"Corner Bakery": 7, "Unexpected": 1}
    assert row["delivery_count_by_store"] == {"S1": 8}
    nothing = feed.provider_summary(records, updated_after=dt.datetime(2030, 1, 1)).first()
    assert nothing["source_record_count"] == 0 and nothing["delivery_count_by_store"] == {}


def test_reconciliation_fails_only_when_deliveries_are_missing(spark):
    table = spark.createDataFrame([("a", 5), ("b", 5)], "delivery_id string, delivery_fee int")
    for theirs, status in ((2, "PASS"), (1, "PASS"), (3, "FAIL")):
        summary = spark.createDataFrame([(theirs, 11)], "distinct_delivery_count bigint, total_delivery_fees bigint")
        found = {r["metric"]: r["status"] for r in feed.reconcile_feed(table, summary).collect()}
        assert found == {"distinct_delivery_count": status, "total_delivery_fees": "DIFFERS"}


def test_records_take_the_deliveries_contract(spark, pages):
    write_page(pages, "p2", [record(7, "2026-05-02T11:00:00Z", delivered_at="2026-05-01T10:40:00Z")])
    rows = feed.as_deliveries(flatten(read_pages(spark, f"file://{pages}/p2.json")))
    assert tuple(rows.first()) == ("O7", "S1", dt.datetime(2026, 5, 1, 10), 45, 40, 1)


def test_replay_chunks_are_rewound_and_clipped(spark):
    start, end = dt.datetime(2026, 5, 1), dt.datetime(2026, 5, 1, 2, 30)
    plan = spark.range(1).select(F.inline(feed.interval_plan(utc_literal(start), utc_literal(end)))).collect()
    assert [(str(r[0])[11:16], str(r[1])[11:16]) for r in plan] == [("23:50", "00:50"), ("00:50", "01:50"), ("01:50", "02:30")]
    times = [(dt.datetime(2026, 4, 30, 23, 49),), (dt.datetime(2026, 4, 30, 23, 50),), (dt.datetime(2026, 5, 1, 0, 50),), (end,)]
    records = spark.createDataFrame(times, "updated_at timestamp_ntz")
    found = feed.in_chunks(records, start, end).collect()
    assert {str(r["updated_at"])[11:16]: str(r["chunk_start"])[11:16] for r in found} == {"23:50": "23:50", "00:50": "00:50"}


def test_times_paths_and_renames(spark):
    row = spark.createDataFrame(
        [("2026-05-01T10:00:00Z", "2026-05-01T11:00:00+01:00", "2026-05-01 10:00:00", "soon", '{"pagination": {"has_more": true}}', "Old")],
        "a string, b string, c string, d string, doc string, brand string",
    ).select(
        *[parse_utc(F.col(c)).alias(c) for c in "abcd"],
        json_field(F.col("doc"), "pagination.has_more").alias("more"),
        json_field(F.col("doc"), "pagination.missing", "fallback").alias("missing"),
        remap(F.col("brand"), {"Old": "New"}).alias("brand"),
    ).first()
    ten = dt.datetime(2026, 5, 1, 10)
    assert tuple(row) == (ten, ten, ten, None, "true", "fallback", "New")


def test_a_run_keeps_violations_and_normalised_deliveries(store, pages):
    path = f"file://{pages}"
    found = flatten(read_pages(store.spark, path))
    brands = [r[0] for r in found.select("brand").distinct().collect()]
    now = dt.datetime(2026, 5, 2, 10, 3)
    expected = sorted(map(tuple, feed.violations(found, brands[1:], now).collect()), key=str)

    def failing(table, summary):
        return feed.reconcile_feed(table.limit(0), summary)

    for _ in range(2):  # a run that is tried again replaces its own rows
        with pytest.raises(feed.FeedReconciliationFailed):
            feed.ingest_pages(store, path, "riders", failing, brands[1:], now)
    feed.ingest_pages(store, path, "riders", brands=brands[1:], now=now)
    kept = store.read_all("feed", "violations", "run")
    assert sorted((tuple(r)[:4] for r in kept.select("rule", "delivery_id", "order_id", "updated_at").collect()), key=str) == expected and expected
    assert {r["run"] for r in kept.collect()} == {"000000000000"}
    normalised = store.read_all("feed", "normalised", "run").drop("run")
    assert sorted(map(str, normalised.collect())) == sorted(map(str, feed.as_deliveries(found).collect()))
    write_page(pages, "p2", SECOND[:-1])
    feed.ingest_pages(store, path, "riders", brands=brands, now=now)
    assert store.read_all("feed", "normalised", "run").select("run").distinct().count() == 2


def test_a_delivery_more_at_the_provider_fails_and_is_named(store, pages):
    path = f"file://{pages}"
    listed = feed.latest_records(flatten(read_pages(store.spark, path))).select("delivery_id", "delivery_status", "delivery_fee", "updated_at")
    more = listed.limit(1).withColumn("delivery_id", F.lit("lost"))
    with pytest.raises(feed.FeedReconciliationFailed):
        feed.ingest_pages(store, path, "riders", provider=listed.unionByName(more))
    named = store.read_all("feed", "differences", "run").select("delivery_id", "difference").collect()
    assert [tuple(r) for r in named] == [("lost", "missing here")]
    assert feed.read_watermark(store, "riders") == feed.FIRST_WATERMARK
    feed.ingest_pages(store, path, "riders", provider=listed)
    assert store.read_all("feed", "differences", "run").isEmpty()
    assert feed.read_watermark(store, "riders") != feed.FIRST_WATERMARK


def test_a_run_opens_new_files_only(store, pages, monkeypatch):
    opened = []
    parse = PageZones.records

    def watched(self, files):
        opened.append(sorted(r["path"].rpartition("/")[2] for r in files.collect()))
        return parse(self, files)

    monkeypatch.setattr(PageZones, "records", watched)
    path = f"file://{pages}"
    write_page(pages, "empty", [])
    feed.ingest_pages(store, path, "riders")
    write_page(pages, "p2", SECOND[:-1])
    mark = feed.ingest_pages(store, path, "riders")
    write_page(pages, "late", [record(20, "2026-05-02T09:00:00Z")])  # nothing newer than the watermark
    assert feed.ingest_pages(store, path, "riders") == mark == feed.ingest_pages(store, path, "riders")
    assert opened == [["empty.json", "p1.json"], ["p2.json"], ["late.json"]]
    expected = EXPECTED | {"D20": ("assigned", 50000, "Jos", "2026-05-02 09:00:00")}
    assert state(feed.delivery_table(store).read()) == expected
    write_page(pages, "late", [record(20, "2026-05-02T09:00:00Z"), record(21, "2026-05-02T09:00:00Z")])  # landed again
    feed.ingest_pages(store, path, "riders")
    feed.write_watermark(store, "riders", "2026-05-03T00:00:00Z")  # set back by hand
    assert feed.ingest_pages(store, path, "riders") == mark
    assert opened[3:] == [["late.json"], ["p2.json"]]
    assert set(state(feed.delivery_table(store).read())) == set(expected) | {"D21"}
    assert store.read_all("feed", "normalised", "run").groupBy("run").count().count() == 5
    assert feed.ingest_pages(store, path, "others") == mark and opened[5] == ["empty.json", "late.json", "p1.json", "p2.json"]


def test_a_replay_opens_files_that_can_hold_its_interval(store, pages):
    path = f"file://{pages}"
    write_page(pages, "p2", SECOND)
    feed.ingest_pages(store, path, "riders")
    zones = PageZones(store, "riders", path)

    def opened(start, end):
        return sorted(r["path"].rpartition("/")[2] for r in zones.listed().where(zones.meets(start, end)).collect())

    at = dt.datetime
    assert opened(at(2026, 5, 2, 10, 3), at(2026, 5, 2, 10, 4)) == ["p1.json", "p2.json"]
    assert opened(at(2026, 5, 3), at(2026, 5, 6)) == ["p2.json"]
    assert opened(at(2026, 5, 1), at(2026, 5, 1, 12)) == []
    write_page(pages, "p3", [record(30, "2026-05-05T11:00:00Z")])  # known to no run yet
    assert opened(at(2026, 5, 3), at(2026, 5, 6)) == ["p2.json", "p3.json"]
    found = feed.replay_records(store, path, "riders", at(2026, 5, 5, 10, 5), at(2026, 5, 5, 12))
    assert sorted(r["delivery_id"] for r in found.collect()) == ["D30", "D9"]  # one of them by the rewind
    assert feed.replay_records(store, path, "riders", at(2020, 1, 1), at(2020, 1, 2)).where("updated_at IS NOT NULL").isEmpty()


def test_a_run_that_ended_before_its_watermark_is_made_good(store, pages, monkeypatch):
    def ends(*_):
        raise RuntimeError("driver lost")

    path = f"file://{pages}"
    with monkeypatch.context() as m:
        m.setattr(feed, "write_watermark", ends)
        with pytest.raises(RuntimeError):
            feed.ingest_pages(store, path, "riders")
    assert feed.read_watermark(store, "riders") == feed.FIRST_WATERMARK
    assert feed.ingest_pages(store, path, "riders") == "2026-05-02T10:06:00Z"
