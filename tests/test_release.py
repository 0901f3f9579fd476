"""Tables that count together, readers of one release, refused writers."""

import pytest

from galley.sources import store as store_module
from galley.sources.entry_log import WriterConflict


def put(store, name, value):
    return store.replace("marts", name, store.spark.createDataFrame([(value,)], "v int"))


def value(store, name):
    return store.read("marts", name).first()["v"]


def folders(tmp_store, name):
    return tmp_store._found(tmp_store.path("marts", name), "release=*")


def test_tables_of_a_release_count_together(store):
    put(store, "a", 1)  # as it was before there were releases
    with store.release() as run:
        put(run, "a", 2)
        put(run, "b", 2)
        assert (value(run, "a"), value(run, "b")) == (2, 2)
        assert value(store, "a") == 1 and not store.exists("marts", "b")
    assert (value(store, "a"), value(store, "b")) == (2, 2)
    assert store.latest("marts", "none") is None
    put(store, "a", 3)  # released by itself from now on
    assert (value(store, "a"), value(store, "b")) == (3, 2)


def test_a_failed_release_leaves_nothing_that_counts(store):
    with store.release() as run:
        put(run, "a", 1)
    with pytest.raises(RuntimeError), store.release() as run:
        put(run, "a", 2)
        raise RuntimeError("executors lost")
    assert value(store, "a") == 1


def test_of_two_writers_the_second_is_refused(store):
    with store.release() as run:
        put(run, "a", 1)
    with pytest.raises(WriterConflict), store.release() as slow:
        put(slow, "a", 2)
        with store.release() as quick:
            put(quick, "b", 3)
    assert (value(store, "a"), value(store, "b")) == (1, 3)


def test_a_reader_never_meets_tables_of_two_runs(store):
    for n in (1, 2):
        with store.release() as run:
            put(run, "a", n)
            put(run, "b", n)
        if n == 1:
            reader = store.snapshot()
            first = value(reader, "a")
    assert (first, value(reader, "b")) == (1, 1)
    assert (value(store, "a"), value(store.snapshot(), "b")) == (2, 2)
    with pytest.raises(TypeError):
        put(reader, "a", 5)


def test_folders_of_older_releases_go(store, monkeypatch):
    for n in range(4):
        with store.release() as run:
            put(run, "a", n)
            if n == 0:
                put(run, "b", n)
    assert len(folders(store, "a")) == 2 and (value(store, "a"), value(store, "b")) == (3, 0)
    with pytest.raises(RuntimeError), store.release() as run:
        put(run, "a", 9)
        raise RuntimeError
    put(store, "a", 4)
    assert len(folders(store, "a")) == 3  # the failed one may still be running
    monkeypatch.setattr(store_module, "_FAILED_AFTER", -1)
    put(store, "a", 5)
    assert len(folders(store, "a")) == 2 and value(store, "a") == 5


def test_partitions_lie_below_the_folder_of_a_release(store):
    rows = store.spark.createDataFrame([(1, "x"), (2, "y")], "v int, p string")
    with store.release() as run:
        run.replace("marts", "f", rows, ["p"])
    found = store.read("marts", "f").where("p = 'y'")
    assert found.columns == ["v", "p"] and found.first()["v"] == 2
