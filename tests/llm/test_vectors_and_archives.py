"""Vector, archive, list and graph operators against brute force, and their edge cases."""

from __future__ import annotations

import datetime as dt
import hashlib
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from checks import compare
from galley.llm import forest, graph, neardup, unigram, url_lists, warc
from galley.llm import vectors as vector_rows
from galley.llm.queries import ORACLES, QUERIES, tokenizer_file

SF_DIR = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int, node string, x int"


def vectors(spark, rows):
    plain = [(k, None if v is None else [None if c is None else float(c) for c in v], 0, "clash", 1) for k, v in rows]
    return spark.createDataFrame(plain, VECTORS)


ODD = [(901, None), (902, [0.0] * 8), (903, [1.0] * 7 + [None]), (904, [float("nan")] * 8), (905, []), (906, [1.0] * 7 + [float("inf")]), (907, [1.0, 0.0])]


# ---- components


@pytest.mark.parametrize("kind", ["path", "star", "random"])
def test_components(spark, kind):
    rng = random.Random(4)
    edges = {
        "path": [(k, k + 1) for k in range(60)] + [(100, 101), (200, 200)],
        "star": [(7, k) for k in range(8, 60)] + [(3, 7)],
        "random": [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(60)],
    }[kind]
    root = {k: k for e in edges for k in e}
    for _ in root:
        for a, b in edges:
            low = min(root[a], root[b])
            root[a] = root[b] = low
    found = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {k: r for k, r in root.items() if any(k in e and e[0] != e[1] for e in edges)}
    assert graph.components(spark.createDataFrame([], "a long, b long")).isEmpty()


def test_bit_sets_have_no_false_negatives(spark):
    rng = random.Random(1)
    numbers = [rng.randint(-(2**63), 2**63 - 1) for _ in range(500)]
    df = spark.createDataFrame([(n,) for n in numbers[:250]], "a long")
    bits = graph.bit_set(df)
    assert graph.in_set(bits, np.array(numbers[:250])).all()
    assert graph.in_set(bits, np.array(numbers[250:])).mean() < 0.02
    every = spark.createDataFrame([(n, "x") for n in numbers], "a long, b string")
    inside, outside = graph.maybe_in(every, "a", bits), graph.maybe_in(every, "a", bits, inside=False)
    assert inside.count() + outside.count() == 500 and inside.count() >= 250


# ---- nearest neighbours


def test_forest_recall_and_scores(spark):
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").orderBy("vec_id").toPandas()
    x, ids = np.stack(table.embedding).astype(float), table.vec_id.to_numpy()
    found = QUERIES["op3_forest"](spark, SF_DIR).toPandas()
    recalls = []
    for query, mine in found.groupby("query_id"):
        scores = x @ x[ids == query][0]
        scores[ids == query] = -np.inf
        best = ids[np.lexsort((ids, -scores))[:20]]
        mine = mine.sort_values("rank")
        assert mine["rank"].tolist() == list(range(1, len(mine) + 1)) and len(mine) == min(20, len(ids) - 1)
        assert np.allclose(mine.score, [scores[ids == v][0] for v in mine.vec_id], rtol=0, atol=1e-12)
        assert mine.score.is_monotonic_decreasing
        recalls.append(np.isin(best, mine.vec_id).mean())
    assert len(recalls) == (ids % 20 == 0).sum() and np.mean(recalls) >= 0.9


def test_forest_blocks_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((40, 8))
    rows = [(k, base[k]) for k in range(40)] + [(100 + k, base[0]) for k in range(4)] + [(0, base[1]), (None, base[0])] + ODD
    found = forest.nearest(vectors(spark, rows), lambda v: v == 0, 4, settings=forest.Settings(block_rows=10, share=50.0)).toPandas()
    assert sorted(found["rank"]) == [1, 1, 2, 2, 3, 3, 4, 4]  # two rows have the id 0
    tied = [list(g.sort_values("rank").vec_id) for _, g in found.groupby(found.score.rank(method="dense") > 0)]
    assert tied
    one = found[np.isclose(found.score, (base[0].astype(np.float32).astype(float) ** 2).sum())].sort_values("rank")
    assert list(one.vec_id) == [100, 101, 102, 103]
    assert not set(found.vec_id) & {k for k, _ in ODD}
    few = forest.nearest(vectors(spark, [(0, [1, 0]), (1, [0, 1])]), lambda v: v == 0).collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in few] == [(0, 1, 1, 0.0)]
    assert forest.nearest(vectors(spark, []), lambda v: v == 0).isEmpty()


def test_forest_ascends_to_enough_rows():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((300, 8))
    wood = forest.Forest(x, forest.Settings(trees=3, length=16))
    few = [len(c) for c in wood.candidates(x[:20], 10)]
    many = [len(c) for c in wood.candidates(x[:20], 600)]
    assert all(a <= b for a, b in zip(few, many, strict=True)) and min(many) >= 200
    assert all(k in c for k, c in enumerate(wood.candidates(x[:20], 10)))


# ---- near duplicates of vectors


def brute_links(x, cosine=0.95):
    norms = np.linalg.norm(x, axis=1)
    close = (x @ x.T) / np.outer(norms, norms) >= cosine
    np.fill_diagonal(close, False)
    label = np.arange(len(x))
    while True:
        new = np.minimum(label, np.where(close, label[None, :], len(x)).min(axis=1))
        if (new == label).all():
            return close.sum(axis=1), label
        label = new


def test_neardup_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    centers = rng.standard_normal((30, 16))
    x = np.concatenate([c + rng.standard_normal((12, 16)) * rng.uniform(0.05, 0.3) for c in centers] + [centers[:5]] * 3)
    x = x.astype(np.float32).astype(float)
    links, label = brute_links(x)
    rows = [(k, v) for k, v in enumerate(x)]
    found = neardup.link(vectors(spark, rows + ODD), ["vec_id"], settings=neardup.Settings(tile_rows=40, step=4)).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found} == {
        **{k: (links[k], label[k], k == label[k]) for k in range(len(x))},
        **{k: (0, k, True) for k, _ in ODD},
    }
    assert links.sum() > 300


def test_neardup_repeated_and_null_ids(spark):
    rows = [(5, [1, 0]), (5, [1, 0]), (None, [1, 0.01]), (3, [0, 1]), (None, None)]
    found = sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in neardup.link(vectors(spark, rows), ["vec_id"]).collect())
    assert found == [("3", 0, "3", True), ("5", 2, "5", True), ("5", 2, "5", True), ("None", 0, "None", True), ("None", 2, "5", True)]
    assert neardup.link(vectors(spark, []), ["vec_id"]).isEmpty()


def test_neardup_keeps_each_vector_in_one_chunk(spark, monkeypatch):
    """What is stored grows with the vectors and not with the tiles they are compared in."""
    rng = np.random.default_rng(8)
    x = np.concatenate((rng.standard_normal((300, 12)), rng.standard_normal((1, 12)) + rng.standard_normal((100, 12)) / 20))
    x[:50] = x[:50].astype(np.float32)
    stored, remove = [], neardup.discard
    monkeypatch.setattr(neardup, "discard", lambda s, path: (stored.append(s.read.parquet(path).select("node", "chunk").collect()), remove(s, path)))
    rows = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    links, label = brute_links(x)
    found = neardup.link(rows, ["vec_id"], settings=neardup.Settings(tile_rows=30, step=4)).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in found} == {k: (links[k], label[k]) for k in range(len(x))} and links.sum() > 1000
    assert len(stored) == 1 and len(stored[0]) == len({r.node for r in stored[0]}) == len(x)
    assert len({r.chunk for r in stored[0]}) >= len(x) / 30


def test_neardup_compares_neighbouring_chunks_once():
    sizes = {(0, 0): 95, (0, 1): 10, (1, 1): 41, (2, 2): 30, (5, 5): 20}
    chunks = neardup.chunks_of(sizes, 10)
    found = sorted(tuple(sorted((k, other))) for k in range(len(chunks.cells)) for other in chunks.partners(k))
    near = lambda a, b: max(abs(p - q) for p, q in zip(chunks.cells[a], chunks.cells[b], strict=True)) < 2
    assert found == [(a, b) for a in range(len(chunks.cells)) for b in range(a, len(chunks.cells)) if near(a, b)]
    assert len(chunks.cells) == 10 + 1 + 5 + 3 + 2


def test_packed_vectors_come_back():
    for v in ([0.5, -0.0, 3.0], [0.1, 1e300, 2.0], [float(np.float32(0.1)), 0.25, 1.0]):
        assert vector_rows.unpacked(pa.array([vector_rows.packed(np.array(v))] * 2, pa.binary()), 3).tolist() == [v, v]
    assert len(vector_rows.packed(np.array([0.5, 0.25]))) == 8 and len(vector_rows.packed(np.array([0.5, 0.1]))) == 16


# ---- archives

PAGES = "page_id long, url string, html string, digest string, bytes int"


def pages(spark, rows):
    return spark.createDataFrame([(k, u, h, "clash", 1) for k, u, h in rows], PAGES)


def test_archives_round_trip_and_revisits(spark, tmp_path):
    big, other = "<p>é" * 400, "x" * 1000
    rows = [(1, "http://a/1", big), (9, "http://a/9", big), (4, None, big), (2, "http://b\r\nX: y", "small"), (3, "u", "small"), (5, "u", None), (None, "u", big), (7, "u", other), (7, "u", other), (6, "u", "🙂" * 30_000), (8, "u", "x" * 999), (10, "u", "x" * 999)]
    rows += [(1000 + k, f"http://h/{k}", f"<html>{'word ' * k}</html>") for k in range(60)]
    folder = f"file://{tmp_path}/archives"
    found = warc.archived(pages(spark, rows), warc.Settings(archive_bytes=2000), folder).collect()
    assert len(found) == len(rows)
    by_id = {(r.page_id, r.uri): r for r in found}
    for k, uri, html in rows:
        payload = (html or "").encode()
        r = by_id[k, warc.safe(uri)]
        assert (r.bytes, r.digest) == (len(payload), hashlib.sha1(payload).hexdigest())
        revisits = html == big and k != 9
        assert (r.kind, r.refers_to) == (("revisit", 9) if revisits else ("response", None))
        assert r.payload == (None if revisits else payload)
    assert len(list(tmp_path.glob("archives/*.warc.zst"))) > 3
    assert warc.archived(pages(spark, [])).isEmpty()


def test_reader_refuses_broken_archives():
    record = warc.record("response", "n", 1, "http://a", b"payload", hashlib.sha1(b"payload").hexdigest(), None, "2024-01-01T00:00:00Z")
    headers, block = warc.parsed(record, "here")
    assert headers["WARC-Type"] == "response" and block.endswith(b"payload")
    for broken in (record[:-1], record.replace(b"WARC/1.1", b"WARC/9"), record.replace(b"Content-Length: ", b"Content-Length: 9"), record.replace(b"WARC-Date", b"X-Date")):
        with pytest.raises(warc.BrokenArchive):
            warc.parsed(broken, "here")
    samples = [bytes([k % 7 + 65]) * 50 + b"common text of every sample" * 5 + str(k).encode() * 20 for k in range(200)]
    dictionary = zstandard.train_dictionary(2000, samples).as_bytes()
    encoder = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    for held in (dictionary, zstandard.compress(dictionary)):
        archive = warc.opening_frame(held) + encoder.compress(record) + encoder.compress(record)
        assert list(warc.frames(archive, "here")) == [record, record]
    for broken in (archive[:-3], archive[8:], archive + b"rest", b""):
        with pytest.raises(warc.BrokenArchive):
            list(warc.frames(broken, "here"))


# ---- URL lists


def test_url_lists_edges(spark):
    day = dt.datetime(2024, 1, 1)
    at = lambda n: day + dt.timedelta(days=n)
    events = spark.createDataFrame(
        [
            ("spam", "domain", "b.c", "add", at(10)), ("spam", "domain", "b.c", "add", at(20)), ("spam", "domain", "b.c", "remove", at(40)),
            ("adult", "prefix", "x.y/p/q", "add", at(0)), ("adult", "domain", "t.u", "add", at(5)), ("adult", "domain", "t.u", "remove", at(5)),
            (None, "domain", "b.c", "add", at(0)), ("spam", "domain", None, "add", at(0)), ("spam", "domain", "b.c", "add", None),
        ],
        "list string, kind string, value string, action string, at timestamp",
    )
    spans = sorted(map(tuple, url_lists.intervals(events).select("list", "value", "since", "until").collect()))
    assert spans == [("adult", "x.y/p/q", at(0), None), ("spam", "b.c", at(10), at(40))]
    captures = spark.createDataFrame(
        [
            (1, "http://A.b.c:80/z?q", at(10)), (2, "http://b.c", at(9)), (3, "http://user@b.c./", at(39)), (4, "http://b.c", at(40)), (5, "http://ab.c", at(20)),
            (6, "https://x.y/p/q/r", at(400)), (7, "https://x.y/p/qq", at(400)), (8, None, at(1)), (9, "b.c", at(20)), (10, "http://b.c", None), (1, "http://A.b.c:80/z?q", at(10)), (11, "http://t.u", at(6)),
        ],
        "page_id long, url string, fetched_at timestamp",
    )
    found = sorted((r.page_id, r.n_entries, r.lists) for r in url_lists.evaluate(captures, events, ["page_id"]).collect())
    hits = {1: (1, "spam"), 3: (1, "spam"), 6: (1, "adult")}
    assert found == sorted([(k, *hits.get(k, (0, ""))) for k in [1, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11]])
    assert url_lists.evaluate(captures.filter("false"), events, ["page_id"]).isEmpty()
    assert url_lists.evaluate(captures, events.filter("false"), ["page_id"]).filter("n_entries > 0").isEmpty()


# ---- queries


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con: duckdb.DuckDBPyConnection = compare.connect(SF_DIR)
    assert compare.differences(con, QUERIES[name](spark, SF_DIR), ORACLES[name]) is None


def test_queries_cover_all_operators_and_rows(spark):
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))
    rows = {t: spark.read.parquet(f"{SF_DIR}/{t}.parquet").count() for t in ("documents", "embeddings", "pages")}
    for name, table in {"op6_token_counts": "documents", "op9_neardup": "embeddings", "op10_lattice": "documents"}.items():
        assert QUERIES[name](spark, SF_DIR).count() == rows[table]
    counts = QUERIES["op6_token_counts"](spark, SF_DIR).agg(F.sum("n_pieces")).first()[0]
    assert counts > 0 and len(unigram.vocabulary(tokenizer_file("piece_bpe_32k.model")).pieces) == 32_000
