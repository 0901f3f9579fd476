"""Array files read by many tasks, against the reader that takes a file at once."""

from __future__ import annotations

import json
import random
from collections import Counter

import pytest
from pyspark.sql import types as T

from galley.sources.array_files import array_records, block_states
from galley.sources.entity_json import MALFORMED, observe_schema, read_json

SCHEMA = f"id BIGINT, text STRING, inner STRUCT<a: BIGINT, list: ARRAY<STRING>>, {MALFORMED} STRING"


@pytest.fixture
def blocks(spark):
    """Blocks of a few bytes."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum") if spark.conf.get(k, None)}

    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        spark.conf.set("spark.sql.files.minPartitionNum", "1")

    yield use
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum"):
        spark.conf.set(key, before[key]) if key in before else spark.conf.unset(key)


def records(n, seed=4):
    rng = random.Random(seed)
    bits = ["}", "{", '"', "\\", "]", "[", ",", "é", "日", "\n", " ", "x", '\\"', "}}", '"}', "\\\\"]

    def text():
        return "".join(rng.choice(bits) for _ in range(rng.randrange(12)))

    return [{"id": k, "text": text(), "inner": {"a": k % 3, "list": [text() for _ in range(k % 4)]} if k % 5 else None} for k in range(n)]


def rows(df):
    return Counter(json.dumps(r.asDict(recursive=True), sort_keys=True) for r in df.collect())


@pytest.mark.parametrize("size, n, indent", [(7, 3, None), (33, 12, 1), (250, 60, None), (100_000, 120, 1)])
def test_any_cut_gives_the_records_of_the_whole_file(spark, tmp_path, blocks, size, n, indent):
    some = records(n)
    folder = tmp_path / "orders.json"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps(some, indent=indent, ensure_ascii=size == 33), encoding="utf-8")
    (folder / "b.json").write_text("  [ ]\n")
    (folder / "c.json").write_text('[{"id": 900}]')
    blocks(size)
    found = read_json(spark, str(folder), SCHEMA)
    want = Counter(json.dumps({**r, MALFORMED: None}, sort_keys=True) for r in some)
    want[json.dumps({"id": 900, "text": None, "inner": None, MALFORMED: None}, sort_keys=True)] += 1
    assert rows(found) == want
    if size == 250:  # one file, many tasks
        states = block_states(spark, str(folder)).where("file LIKE '%a.json'")
        assert states.count() > 15 and states.where("in_string").count() > 0


@pytest.mark.parametrize(
    "text, good, bad",
    [
        ('[{"id": 1}, {"id": 2}', 1, 1),  # never closed
        ('[{"id": 1}, {"id": 2', 1, 1),
        ('[{"id": 1} {"id": 2}]', 1, 1),  # no comma
        ('[{"id": 1},, {"id": 2}]', 1, 1),
        ('[{"id": 1}, 7]', 1, 1),
        ('[7]', 0, 1),
        ('[{"id": 1}] and more', 1, 1),
        ('{"id": 1}', 1, 0),  # single objects
        ('{"id": 1}\n{"id": 2}\n', 2, 0),
        ('{"id": 1}\n{"id": 2', 1, 1),
        ('﻿[{"id": 1}]', 1, 0),
        ("", 0, 0),
        ("[]", 0, 0),
    ],
)
def test_what_is_no_array_of_records_is_malformed(spark, tmp_path, blocks, text, good, bad):
    path = tmp_path / "x.json"
    path.write_text(text, encoding="utf-8")
    blocks(9)
    found = read_json(spark, str(path), SCHEMA).collect()
    assert (sum(r.id is not None for r in found), sum(r[MALFORMED] is not None for r in found)) == (good, bad)


def test_schema_is_that_of_all_records(spark, tmp_path):
    path = tmp_path / "x.json"
    path.write_text(json.dumps([{"a": 1}, {"a": 2.5, "b": "x"}]))
    assert observe_schema(spark, str(path)) == T.StructType.fromDDL("a DOUBLE, b STRING")
    assert {r.value for r in array_records(spark, str(path)).collect()} == {'{"a": 1}', '{"a": 2.5, "b": "x"}'}
