"""Removal of long repeats against a plain version, and its edge cases."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from galley.llm import repeats
from galley.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plain_version(texts, length=200):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[k : k + length] for t in raw for k in range(len(t) - length + 1))
    rows = []
    for t in raw:
        gone = np.zeros(len(t) + 1, bool)
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                gone[k : k + length] = True
        runs = int((np.diff(np.concatenate(([False], gone)).astype(int)) == 1).sum())
        kept = bytes(b for b, g in zip(t, gone, strict=False) if not g)
        rows.append((len(t), len(t) - len(kept), runs, kept))
    return rows


def words(rng, n):
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def texts():
    rng = random.Random(8)
    passage, other = words(rng, 90), words(rng, 45)
    out = [words(rng, rng.randrange(5, 120)) for _ in range(60)]
    out += [words(rng, rng.randrange(0, 30)) + passage + words(rng, rng.randrange(0, 30)) for _ in range(40)]
    out += [other[k : k + 230] + "x" * (k % 3) + words(rng, 3) for k in range(60)]
    base = words(rng, 300)
    for _ in range(25):  # near copies
        parts = base.split(" ")
        parts[rng.randrange(300)] = "edit"
        out.append(" ".join(parts))
    exact = words(rng, 80)
    within = words(rng, 70)
    out += [exact, exact, within + " and again " + within, "a" * 3_000, "ab" * 400, "é" * 150, "e" * 199, "q" * 200, "z" * 201]
    out += [None, "", "short", "short", passage[:200], passage[1:200]]
    return out


@pytest.mark.parametrize("contexts", [256, 4])
def test_repeats_are_the_plain_version(spark, contexts):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame([(k, t, "clash", 9) for k, t in rows], "doc_id long, text string, row string, `a.b` int").repartition(6)
    settings = repeats.Settings(contexts=contexts, side_by_side=300)
    found = repeats.without_repeats(docs, ["doc_id", "row", "a.b"], settings=settings).collect()
    want = plain_version([t for _, t in rows])
    assert sorted(r.doc_id for r in found) == [k for k, _ in rows]
    wrong = [r.doc_id for r in found if (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) != want[r.doc_id]]
    assert not wrong
    assert {(r.row, r["a.b"]) for r in found} == {("clash", 9)}


def test_index_finds_all_common_windows():
    rng = random.Random(2)
    settings = repeats.Settings(length=12, gram=4)
    for _ in range(60):
        contexts = []
        for g in range(4):
            for _ in range(rng.randrange(1, 9)):
                left = bytes(rng.choice(b"ab") for _ in range(rng.randrange(0, 9)))
                right = b"GRAM" + bytes(rng.choice(b"ab") for _ in range(rng.randrange(0, 9)))
                contexts.append((g, right, left))
        contexts = sorted(set(contexts))
        data = [left + right for _, right, left in contexts]
        group = np.array([g for g, _, _ in contexts])
        before = np.array([len(left) for _, _, left in contexts])
        bounds = np.concatenate(([0], np.cumsum([len(d) for d in data])))
        zero = np.zeros(len(data), np.int64)
        hits = repeats.matched_windows(group, np.frombuffer(b"".join(data), np.uint8), bounds, before, zero, zero + 8, settings)
        windows = Counter((g, o, d[b - o : b - o + 12]) for g, d, b in zip(group, data, before, strict=True) for o in range(min(8, b) + 1) if len(d) - b + o >= 12)
        for k, d in enumerate(data):
            for o in range(9):
                valid = o <= before[k] and len(d) - before[k] + o >= 12
                assert hits[k, o] == (valid and windows[group[k], o, d[before[k] - o : before[k] - o + 12]] > 1)


def test_empty_tables_and_clashes(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, kept string")
    assert repeats.without_repeats(docs, ["doc_id"]).isEmpty()
    with pytest.raises(ValueError):
        repeats.without_repeats(docs, ["doc_id", "kept"])


def test_query_on_the_whole_table(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    want = {r.doc_id: (*w[:3], hashlib.sha256(w[3]).hexdigest()) for r, w in zip(rows, plain_version([r.text for r in rows]), strict=True)}
    found = QUERIES["op13_repeats"](spark, SF_DIR).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == want
    assert sum(w[1] for w in want.values())
