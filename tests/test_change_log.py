"""Levels of folded batches, refused writers."""

import datetime as dt
import random

import pytest

from galley.sources.change_log import ChangeLog, levels_to_fold
from galley.sources.entry_log import EntryLog, WriterConflict
from galley.sources.store import TableStore

SCHEMA = "id string, kept string, fee int, at timestamp_ntz"


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, f"file://{tmp_path}/warehouse")


def log_of(store, fanout=3, part_rows=4, grace=3600):
    return ChangeLog(store, "feed", "changes", "id", ["fee", "at"], "at", fanout, part_rows, grace)


def rows_of(df):
    return {r["id"]: (r["kept"], r["fee"], r["at"]) for r in df.collect()}


def expected(batches):
    """The table by the rule, batch after batch."""
    table = {}
    for batch in batches:
        for key, kept, fee, at in batch:
            if key is None:
                continue
            if key not in table:
                table[key] = (kept, fee, at)
            elif at is not None and (table[key][2] is None or at >= table[key][2]):
                table[key] = (table[key][0], fee, at)
            elif at is None and table[key][2] is None:
                table[key] = (table[key][0], fee, at)
    return table


def made_up(n, seed=7):
    chance = random.Random(seed)
    start = dt.datetime(2024, 5, 1)
    batches = []
    for b in range(n):
        keys = chance.sample(["ä", "Z", "z", "", *[f"k{i}" for i in range(12)]], 6)
        times = [None if chance.random() < 0.1 else start + dt.timedelta(minutes=chance.randrange(6)) for _ in keys]
        batch = [(k, f"{k}-{b}", b, t) for k, t in zip(keys, times)]
        batches.append([*batch, (None, "lost", 0, start)])
    return batches


def test_levels_stay_bounded_over_a_thousand_batches():
    for fanout in (2, 3, 16):
        runs = {}
        for _ in range(1000):
            runs[0] = runs.get(0, 0) + 1
            depth = levels_to_fold(runs, fanout)
            if depth:
                for level in range(depth):
                    runs[level] = 0
                runs[depth] = runs.get(depth, 0) + 1
            assert all(n < fanout for n in runs.values())
        assert fanout ** len(runs) <= 1000 * fanout * fanout


def test_table_follows_the_rule_at_every_step(spark, store):
    log, batches = log_of(store), made_up(11)
    assert log.read() is None
    for b, batch in enumerate(batches):
        assert log.append(spark.createDataFrame(batch, SCHEMA), "s", b)
        if b in (1, 2, 5, 10):
            assert rows_of(log.read()) == expected(batches[: b + 1])
    runs = {}
    for p in log.parts():
        runs.setdefault(p["level"], set()).add(p["run"])
    assert {level: len(names) for level, names in runs.items()} == {0: 2, 2: 1}
    live = {p["run"].rpartition("/")[2] for p in log.parts()}
    assert all(any(run in f for run in live) for f in log.read().inputFiles())


def test_parts_have_key_ranges_and_a_range_opens_only_those(spark, store):
    log = log_of(store)
    rows = [(f"k{i:03d}", "x", i, dt.datetime(2024, 5, 1)) for i in range(40)]
    for b in range(3):
        log.append(spark.createDataFrame(rows, SCHEMA), "s", b)
    parts = sorted(log.parts(), key=lambda p: p["low"])
    assert len(parts) > 3 and sum(p["rows"] for p in parts) == 40
    assert all(a["high"] < b["low"] for a, b in zip(parts, parts[1:]))
    some = log.read("k005", "k006")
    assert set(rows_of(some)) == {"k005", "k006"}
    assert len(some.inputFiles()) < len(log.read().inputFiles())
    assert rows_of(log.read("x", "y")) == {}


def test_a_repeated_batch_counts_once_and_sources_number_for_themselves(spark, store):
    log, at = log_of(store), dt.datetime(2024, 5, 1)
    one = spark.createDataFrame([("a", "first", 1, at)], SCHEMA)
    two = spark.createDataFrame([("a", "second", 2, at)], SCHEMA)
    assert log.append(one, "s", 0)
    assert not log.append(two, "s", 0)
    assert rows_of(log.read()) == {"a": ("first", 1, at)}
    assert log.append(two, "t", 0)
    assert rows_of(log.read()) == {"a": ("first", 2, at)}  # the later batch on equal times
    assert log.append(one.limit(0), "t", 1) and not log.append(two, "t", 1)
    assert rows_of(log.read()) == {"a": ("first", 2, at)}


def test_compaction_leaves_one_run_and_later_batches_go_on(spark, store):
    log, batches = log_of(store), made_up(4, seed=3)
    for b, batch in enumerate(batches[:2]):
        log.append(spark.createDataFrame(batch, SCHEMA), "s", b)
    assert log.compact() and not log.compact()
    assert len({p["run"] for p in log.parts()}) == 1
    for b, batch in enumerate(batches[2:], 2):
        log.append(spark.createDataFrame(batch, SCHEMA), "s", b)
    assert rows_of(log.read()) == expected(batches)


def test_folded_folders_go_after_the_time_of_grace(spark, store, tmp_path):
    batches = made_up(4)

    def folders():
        return {p.name for p in (tmp_path / "warehouse/feed/changes_runs").glob("run=*")}

    patient = log_of(store)
    for b, batch in enumerate(batches[:3]):
        patient.append(spark.createDataFrame(batch, SCHEMA), "s", b)
    assert len(folders()) == 4  # three folded ones are kept for readers
    hasty = log_of(store, grace=-1)
    hasty.append(spark.createDataFrame(batches[3], SCHEMA), "s", 3)
    assert folders() == {p["run"].rpartition("/")[2] for p in hasty.parts()}
    assert rows_of(hasty.read()) == expected(batches)


def test_a_second_writer_is_refused_and_tries_again(spark, store, monkeypatch):
    at = dt.datetime(2024, 5, 1)
    log, other = log_of(store), log_of(store)
    log.append(spark.createDataFrame([("a", "x", 1, at)], SCHEMA), "s", 0)
    publish, met = EntryLog.publish, []

    def late(self, after, content):
        if not met:  # another writer comes in between reading and publishing
            met.append(after)
            other.append(spark.createDataFrame([("b", "y", 2, at)], SCHEMA), "t", 0)
        return publish(self, after, content)

    monkeypatch.setattr(EntryLog, "publish", late)
    log.append(spark.createDataFrame([("c", "z", 3, at)], SCHEMA), "s", 1)
    assert set(rows_of(log.read())) == {"a", "b", "c"}


def test_entries_are_never_replaced(spark, store, tmp_path, monkeypatch):
    log = EntryLog(store, store.path("feed", "log"))
    assert log.newest() == (0, {})
    assert log.publish(0, {"ä": 1}) == 1
    with pytest.raises(WriterConflict):
        log.publish(0, {"other": 1})
    with monkeypatch.context() as m:  # the number was free when it was looked at
        m.setattr(EntryLog, "numbers", lambda self: [])
        with pytest.raises(WriterConflict):
            log.publish(0, {"other": 1})
    assert log.newest() == (1, {"ä": 1})
    left = [p.name for p in (tmp_path / "warehouse/feed/log").iterdir() if not p.name.endswith(".crc")]
    assert left == ["000000000001.json"]
