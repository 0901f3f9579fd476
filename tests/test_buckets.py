"""The bucketed table against the plain upsert, and which of its files a batch touches."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from galley.operators.upsert import upsert
from galley.sources.buckets import BucketTable

COLUMNS = "id string, a int, b string, at timestamp_ntz"
FIRST = dt.datetime(2024, 1, 1)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def some(rng, n, keys=60):
    picked = rng.sample(range(keys), n)
    return [(f"k{k}", rng.choice([None, 1, 2]), rng.choice("xyz"), FIRST + dt.timedelta(hours=rng.randrange(5))) for k in picked]


@pytest.fixture
def table(store):
    return BucketTable(store, "feed", "t", "id", buckets=8)


def test_batches_give_what_the_plain_upsert_gives(spark, table):
    rng = random.Random(6)
    plain = spark.createDataFrame([], COLUMNS)
    for n in (30, 1, 12, 40):
        changes = spark.createDataFrame([*some(rng, n), (None, 1, "x", FIRST)], COLUMNS)
        table.upsert(changes, ["a", "at"], "at")
        plain = spark.createDataFrame(upsert(plain, changes, "id", ["a", "at"], "at").collect(), COLUMNS)
        assert rows(table.read()) == rows(plain)
    table.resize(3)
    assert rows(table.read()) == rows(plain) and len(table._manifest()) <= 3
    assert table.read().columns == ["id", "a", "b", "at"]


def test_one_changed_key_rewrites_one_bucket(spark, table):
    assert table.read() is None
    first = [(f"k{k}", 1, "x", FIRST) for k in range(200)]
    table.upsert(spark.createDataFrame(first, COLUMNS), ["a", "at"], "at")
    before = table._manifest()
    assert len(before) == 8
    later = FIRST + dt.timedelta(days=1)
    batch = [("k7", 5, "other", later), *first[20:30], ("k9", 9, "x", FIRST - dt.timedelta(days=1))]
    touched = table.upsert(spark.createDataFrame(batch, COLUMNS), ["a", "at"], "at")
    after = table._manifest()
    assert len(touched) == 1 and {b for b in before if before[b] != after[b]} == set(touched)
    assert ("k7", 5, "x", later) in rows(table.read()) and ("k9", 1, "x", FIRST) in rows(table.read())
    assert table.upsert(spark.createDataFrame(batch, COLUMNS), ["a", "at"], "at") == []
    assert table._manifest() == after


def test_readers_keep_the_version_they_began_with(spark, table):
    for k in range(4):
        table.upsert(spark.createDataFrame([("k", k, "x", FIRST)], COLUMNS), ["a"])
        if k == 2:
            begun = table.read()
    assert rows(begun) == [("k", 2, "x", FIRST)] and rows(table.read()) == [("k", 3, "x", FIRST)]
    assert len(table.store._found(table.folder, "attempt=*/_bucket=*")) == 2


def test_only_buckets_with_other_digests_are_read(spark, table, monkeypatch):
    first = [(f"k{k}", k, "x", FIRST) for k in range(100)]
    table.upsert(spark.createDataFrame(first, COLUMNS), ["a", "at"], "at")
    theirs = spark.createDataFrame([*first[:40], ("k40", -1, "x", FIRST), *first[41:99], ("new", 1, "x", FIRST)], COLUMNS)
    read = []
    plain = BucketTable.read
    monkeypatch.setattr(BucketTable, "read", lambda self, buckets=None: (read.append(buckets), plain(self, buckets))[1])
    assert rows(table.differences(theirs, ["a", "at"])) == [("k40", "differs"), ("k99", "missing there"), ("new", "missing here")]
    assert 1 <= len(read[0]) <= 3
    assert table.differences(spark.createDataFrame(first[::-1], COLUMNS), ["a", "at"]).isEmpty() and len(read) == 1
