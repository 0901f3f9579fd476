"""Operators against brute force, with hot keys, NULL keys and ties."""

import datetime as dt
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from galley.operators.history import covers, first_versions, next_versions
from galley.operators.joins import full_compare, lookup, mark_known, orphan_count, orphans
from galley.operators.latest import latest_per_key
from galley.operators.numbering import dense_number, rank_within
from galley.operators.pages import latest_version, page
from galley.operators.upsert import upsert


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def test_latest_keeps_newest_and_joins_null_keys(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 3, "y"), ("a", None, "z"), (None, 1, "n"), (None, 2, "m"), ("b", None, "q")],
        "k string, at int, v string",
    )
    assert rows(latest_per_key(df, ["k"], ["at"]), "k", "v") == [("a", "y"), ("b", "q"), (None, "m")]


def test_latest_decides_ties_the_same_way_whatever_the_partitions(spark):
    df = spark.createDataFrame([("a", 1, str(i)) for i in range(50)], "k string, at int, v string")
    winners = {latest_per_key(df.repartition(n), ["k"], ["at"]).first()["v"] for n in (1, 3, 7)}
    assert len(winners) == 1


def test_latest_trims_groups_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("at"))
    plan = latest_per_key(df, ["k"], ["at"])._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_dense_number_is_the_sorted_position(spark):
    values = [f"k{i * 7919 % 1000}" for i in range(1000)] + [None]
    df = spark.createDataFrame([(v,) for v in values], "k string").repartition(5)
    found = dense_number(df, [F.col("k").asc_nulls_last()], "n", start=11)
    expected = sorted(v for v in values if v is not None) + [None]
    assert [r["k"] for r in found.orderBy("n").collect()] == expected
    assert [r["n"] for r in found.orderBy("n").collect()] == list(range(11, 11 + len(values)))


def test_rank_within_a_key_that_spans_many_partitions(spark):
    data = [("hot" if i % 3 else (None if i % 2 else f"c{i % 5}"), i * 31 % 997, i) for i in range(3000)]
    df = spark.createDataFrame(data, "k string, at int, id int").repartition(6)
    order = [F.col("at").asc_nulls_last(), F.col("id").asc()]
    groups = defaultdict(list)
    for k, at, i in data:
        groups[k].append((at, i))
    expected = {(k, i): n for k, g in groups.items() for n, (_, i) in enumerate(sorted(g), 1)}
    found = rank_within(df, ["k"], order, "n").collect()
    assert {(r["k"], r["id"]): r["n"] for r in found} == expected


@pytest.mark.parametrize("how", ["left", "inner", "left_anti"])
def test_shuffled_lookup_equals_plain_join(spark, how):
    facts = spark.createDataFrame(
        [("hot" if i % 3 == 0 else None if i % 7 == 0 else f"k{i % 11}", i) for i in range(2000)],
        "k string, id int",
    )
    dim = spark.createDataFrame(
        [("hot", "1"), ("hot", "2")] + [(f"k{i}", "x") for i in range(8)] + [(None, "n")], "key string, name string"
    )
    plain = facts.join(dim, facts.k == dim.key, how).drop("key")
    spread = lookup(facts, dim, {"k": "key"}, how, broadcast_bytes=-1, hot_rows=50)
    small = lookup(facts, dim, {"k": "key"}, how)
    assert rows(spread, *plain.columns) == rows(plain) == rows(small, *plain.columns)


def test_hot_key_is_spread_over_salts(spark):
    facts = spark.createDataFrame([("hot", i) for i in range(1000)], "k string, id int")
    dim = spark.createDataFrame([("hot", "1")], "k string, name string")
    joined = lookup(facts, dim, ["k"], broadcast_bytes=-1, hot_rows=100)
    assert "_salt" in joined._jdf.queryExecution().optimizedPlan().toString()
    assert joined.count() == 1000


def test_residual_condition_on_the_shuffled_side(spark):
    facts = spark.createDataFrame([("s", dt.date(2024, 1, d)) for d in range(1, 11)], "store string, day date")
    versions = spark.createDataFrame(
        [("s", 1, dt.date(1900, 1, 1), dt.date(2024, 1, 5)), ("s", 2, dt.date(2024, 1, 6), dt.date(9999, 12, 31))],
        "store string, sk int, effective_from date, effective_to date",
    )
    found = lookup(facts, versions, ["store"], residual=covers("day"), broadcast_bytes=-1, hot_rows=2)
    assert {r["day"].day: r["sk"] for r in found.collect()} == {d: 1 if d < 6 else 2 for d in range(1, 11)}


def test_orphans_count_null_keys(spark):
    child = spark.createDataFrame([("a", 1), ("z", 2), ("z", 3), (None, 4)], "k string, id int")
    parent = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert rows(orphans(child, parent, ["k"]), "id") == [(2,), (3,), (4,)]
    assert orphan_count(child, parent, "k").first()[0] == 3
    assert rows(mark_known(child, parent, ["k"], "ok"), "id", "ok") == [(1, True), (2, False), (3, False), (4, False)]


def test_full_compare_keeps_null_keys_apart(spark):
    left = spark.createDataFrame([("a", 1), (None, 2)], "k string, n int")
    right = spark.createDataFrame([("b", 5), (None, 7)], "k string, n int")
    found = rows(full_compare(left, right, "k", ["n"]), "k", "source_n", "report_n")
    assert found == [("a", 1, 0), ("b", 0, 5), (None, 0, 7), (None, 2, 0)]


def test_upsert_updates_named_columns_and_ignores_older_rows(spark):
    schema = "id string, status string, city string, at int"
    table = spark.createDataFrame([("1", "new", "Lagos", 5), ("2", "new", "Abuja", 5)], schema)
    changes = spark.createDataFrame(
        [("1", "done", "Ibadan", 6), ("2", "old", "Ibadan", 4), ("3", "new", "Jos", 1), (None, "bad", "x", 9)], schema
    )
    found = upsert(table, changes, "id", ["status", "at"], version="at")
    expected = [("1", "done", "Lagos", 6), ("2", "new", "Abuja", 5), ("3", "new", "Jos", 1)]
    assert rows(found) == expected
    assert rows(upsert(found, changes, "id", ["status", "at"], version="at")) == expected


# versions ----------------------------------------------------------------------------

DAY1, DAY2, DAY3 = dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 3, 1)


def stores(spark, *pairs):
    return spark.createDataFrame(list(pairs), "store_id string, clean_city string")


def load(dim, snapshot, day):
    return next_versions(dim, snapshot, day, "store_id", ["clean_city"], "store_sk")


def versions(df):
    return [
        (r["store_sk"], r["store_id"], r["clean_city"], r["effective_from"], r["effective_to"], r["is_current"])
        for r in df.orderBy("store_sk").collect()
    ]


OPEN, PAST = dt.date(9999, 12, 31), dt.date(1900, 1, 1)


@pytest.fixture
def two_stores(spark):
    return first_versions(stores(spark, ("a", "Lagos"), ("b", "Jos"), (None, "x")), "store_id", ["clean_city"], "store_sk")


def test_first_load_starts_in_the_past_and_skips_null_keys(two_stores):
    assert versions(two_stores) == [(1, "a", "Lagos", PAST, OPEN, True), (2, "b", "Jos", PAST, OPEN, True)]


def test_an_empty_dimension_is_a_first_load(spark, two_stores):
    again = load(two_stores.limit(0), stores(spark, ("a", "Lagos")), DAY2)
    assert versions(again) == [(1, "a", "Lagos", PAST, OPEN, True)]


def test_change_new_store_missing_store_and_rerun(spark, two_stores):
    snapshot = stores(spark, ("a", "Abuja"), ("c", "Ibadan"))
    after = load(two_stores, snapshot, DAY2)
    expected = [
        (1, "a", "Lagos", PAST, dt.date(2024, 1, 31), False),
        (2, "b", "Jos", PAST, OPEN, True),
        (3, "c", "Ibadan", DAY2, OPEN, True),
        (4, "a", "Abuja", DAY2, OPEN, True),
    ]
    assert versions(after) == expected
    assert versions(load(after, snapshot, DAY2)) == expected
    assert versions(load(after, snapshot, DAY3)) == expected


def test_same_day_change_replaces_the_version(spark, two_stores):
    once = load(two_stores, stores(spark, ("a", "Abuja")), DAY2)
    twice = load(once, stores(spark, ("a", "Kano")), DAY2)
    assert versions(twice) == [
        (1, "a", "Lagos", PAST, dt.date(2024, 1, 31), False),
        (2, "b", "Jos", PAST, OPEN, True),
        (3, "a", "Kano", DAY2, OPEN, True),
    ]


def test_return_to_an_old_value_is_a_new_version(spark, two_stores):
    away = load(two_stores, stores(spark, ("a", "Abuja")), DAY2)
    back = load(away, stores(spark, ("a", "Lagos")), DAY3)
    assert [v[:3] for v in versions(back) if v[1] == "a"] == [(1, "a", "Lagos"), (3, "a", "Abuja"), (4, "a", "Lagos")]


def test_empty_text_and_null_are_different_attributes(spark):
    dim = first_versions(stores(spark, ("a", None)), "store_id", ["clean_city"], "store_sk")
    assert len(versions(load(dim, stores(spark, ("a", "")), DAY2))) == 2


# pages -------------------------------------------------------------------------------


def test_pages_cover_all_rows_once_in_order(spark):
    start = dt.datetime(2024, 1, 1)
    data = [(f"d{i:02d}", start + dt.timedelta(minutes=i // 4)) for i in range(23)]
    df = spark.createDataFrame(data, "delivery_id string, updated_at timestamp_ntz")
    seen, after, more = [], None, True
    while more:
        got = sorted(page(df, 5, after).collect(), key=lambda r: (r["updated_at"], r["delivery_id"]))
        seen += [r["delivery_id"] for r in got]
        more = got[0]["has_more"]
        after = (got[-1]["updated_at"], got[-1]["delivery_id"])
    assert seen == [d for d, _ in data]


def test_latest_version_breaks_ties_on_source_order(spark):
    at = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame(
        [("d", at, 1), ("d", at, 2), ("e", at, 3)], "delivery_id string, updated_at timestamp_ntz, row_id int"
    )
    assert latest_version(df, "d", "row_id").first()["row_id"] == 2
