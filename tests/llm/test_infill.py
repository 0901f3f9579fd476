"""Fill-in-middle against a plain version, and its edge cases."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from checks import compare
from pyspark.sql import functions as F

from galley.llm import infill
from galley.llm.common import as_text
from galley.llm.queries import ORACLES, QUERIES

import pyarrow as pa

SF_DIR = "/root/testdata/sf0.001"
UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def plain_version(key, text):
    text = text or ""
    units = UNIT.findall(text)
    digits = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digits[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    prefix, middle, suffix = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, None)))
    if h[3] % 100 < 20:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def texts():
    rng = random.Random(5)
    some = ["".join(rng.choice(["ab", "Z", " ", "é", "日", "𝒳", "\n", "1", "<", "ſ", "K"]) for _ in range(rng.randrange(60))) for _ in range(150)]
    long = " ".join("w" * (k % 7 + 1) for k in range(40_000))
    return [*some, None, "", "", "one", "a<P>b", "<M>", "<S", "P>", "<S<S", long, "x" * 90_000, "é" * 30_000, "same", "same"]


def test_transform_is_the_plain_version_and_restores(spark):
    rows = list(enumerate(texts())) + [(None, "no key"), (3, "key again")]
    docs = spark.createDataFrame([(k, t, "clash", 9) for k, t in rows], "doc_id long, text string, h1 string, `a.b` int")
    found = infill.transform(docs, ["doc_id", "text", "h1", "a.b"])
    found = found.withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()
    assert len(found) == len(rows) and {(r.h1, r["a.b"]) for r in found} == {("clash", 9)}
    for r in found:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_version(r.doc_id, r.text)
        assert r.back == (r.text or "")
    assert {r.form for r in found} == {"plain", "psm", "spm"}


def test_every_rank_is_reached():
    some = ["", "ab cd", "é日x", "word " * 700, ""]
    lanes = infill.SkipList(as_text(pa.array(some)))
    assert len(lanes.units) > 3 and all(len(x) < len(y) for x, y in zip(lanes.units[1:], lanes.units, strict=False))
    for k, text in enumerate(some):
        units = UNIT.findall(text)
        want = np.concatenate(([0], np.cumsum([len(u) for u in units]))).tolist()
        ranks = np.arange(len(units) + 1)
        assert lanes.code_points(np.full(len(ranks), k), ranks).tolist() == want


def test_empty_tables_and_clashes(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, form string")
    assert infill.transform(docs, ["doc_id"]).isEmpty()
    with pytest.raises(ValueError):
        infill.transform(docs, ["doc_id", "form"])


def test_query_matches_sql(spark):
    found = QUERIES["op11_infill"](spark, SF_DIR)
    assert compare.differences(compare.connect(SF_DIR), found, ORACLES["op11_infill"]) is None
