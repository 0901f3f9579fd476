"""Digests that add up."""

from __future__ import annotations

import hashlib
import re

import pytest

from galley.sources import digests

ROWS = [(1, "a", 2.5), (2, None, None), (3, "bé;b=1:x;", 0.0)]
COLUMNS = "k bigint, b string, c double"


def of(df):
    return digests.fingerprint(digests.content_digest(df).first())


@pytest.mark.parametrize(
    "rows",
    [
        [*ROWS, ROWS[0]],
        ROWS[:2],
        [(1, "a", 2.5), (2, "", None), ROWS[2]],
        [(1, "a", 2.5), (2, None, 0.0), ROWS[2]],
        [(1, "bé;b=1:x;", 2.5), ROWS[1], (3, "a", 0.0)],
        [],
    ],
)
def test_any_change_of_content_shows(spark, rows):
    assert of(spark.createDataFrame(rows, COLUMNS)) != of(spark.createDataFrame(ROWS, COLUMNS))


def test_order_and_columns_without_values_do_not_show(spark):
    df = spark.createDataFrame(ROWS, COLUMNS)
    moved = spark.createDataFrame(ROWS[::-1], COLUMNS).repartition(3).selectExpr("c", "b", "k", "CAST(NULL AS INT) AS d", "'x' AS _batch_id")
    assert of(moved) == of(df)


def test_only_loads_without_a_digest_are_read(spark, store):
    df = spark.createDataFrame(ROWS, COLUMNS)
    store.write_load("stores", df, "2024-05-01")
    first, read = digests.load_digests(store, "stores")
    assert len(read) == 1 and digests.fingerprint(digests.added(first).first()) == of(df)
    store.write_load("stores", df.limit(1), "2024-05-02")
    assert [r.split("load_date=")[1] for r in digests.load_digests(store, "stores")[1]] == ["2024-05-02/version=1"]
    assert digests.loads_fingerprint(store, "stores") == of(df.union(df.limit(1)))
    store.write_load("stores", df.limit(2), "2024-05-01")  # written again: another version
    assert len(digests.load_digests(store, "stores")[1]) == 1
    assert digests.loads_fingerprint(store, "stores") == of(df.limit(2).union(df.limit(1)))
    assert digests.load_digests(store, "stores")[1] == []


def test_limbs_are_added_as_whole_numbers_within_a_task(spark):
    df = spark.range(50).selectExpr("id % 3 AS k", "id AS v", "IF(id = 4, NULL, 'x') AS w", "id AS _seen").repartition(4)
    found = {r["k"]: r for r in digests.content_digest(df, "k").collect()}
    for k in range(3):
        texts = [f"v={len(str(n))}:{n};" + ("" if n == 4 else "w=1:x;") for n in range(50) if n % 3 == k]
        sums = [sum(int(hashlib.sha256(t.encode()).hexdigest()[8 * i : 8 * i + 8], 16) for t in texts) for i in range(8)]
        assert found[k]["n"] == len(texts) and [int(found[k][limb]) for limb in digests.LIMBS] == sums
    plan = digests.content_digest(df, "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "conv(" in plan and not re.search(r"conv\([^()]*(\([^()]*\))?[^()]*\) as decimal", plan)
