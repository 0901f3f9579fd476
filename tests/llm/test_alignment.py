"""Alignment of two tokenizers against a plain version, and its edge cases."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import pytest

from galley.llm import alignment
from galley.llm.queries import QUERIES, tokenizer_file

SF_DIR = "/root/testdata/sf0.001"


@cache
def tokenizers():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    one = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    one.encode_special_tokens = True
    other = SentencePieceProcessor(model_file=tokenizer_file("piece_bpe_32k.model"))
    back = {c: b for b, c in alignment.byte_alphabet().items()}
    bytes_a = {k: bytes(back[c] for c in piece) for piece, k in one.get_vocab(with_added_tokens=False).items()}

    def of_b(k):
        name = other.id_to_piece(k)
        return bytes([int(name[3:5], 16)]) if other.is_byte(k) else name.replace("▁", " ").encode()

    return one, other, bytes_a, of_b


def encoded(text):
    one, other, bytes_a, of_b = tokenizers()
    if not text:
        return [], [], [], []
    a, b = one.encode(" " + text, add_special_tokens=False).ids, other.encode(text)
    parts_a, parts_b = [bytes_a[k] for k in a], [of_b(k) for k in b]
    if not b"".join(parts_a) == b"".join(parts_b) == (" " + text).encode():
        return [], [], [], []
    return a, b, parts_a, parts_b


def ends(parts):
    out, at = [], 0
    for p in parts:
        at += len(p)
        out.append(at)
    return out


def plain_version(texts):
    per_text, documents = [], Counter()
    for text in texts:
        a, b, parts_a, parts_b = encoded(text)
        ea, eb = ends(parts_a), ends(parts_b)
        groups, i, j = [], 0, 0
        for stop in sorted(set(ea) & set(eb)):
            x, y = ea.index(stop, i) + 1, eb.index(stop, j) + 1
            groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
            i, j = x, y
        links, j = [], 0
        for i, e in enumerate(ea):
            start = e - len(parts_a[i])
            while eb[j] <= start:
                j += 1
            k = j
            while k < len(b) and eb[k] - len(parts_b[k]) < e:
                links.append((a[i], b[k]))
                k += 1
        per_text.append((len(a), len(b), groups, links))
        documents.update(set(links))
    most = defaultdict(int)
    for (x, _), n in documents.items():
        most[x] = max(most[x], n)
    return [
        (
            n_a,
            n_b,
            len(groups),
            len(links),
            sum(documents[x] == most[x[0]] for x in links),
            sum(documents[x] for x in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "",
        )
        for n_a, n_b, groups, links in per_text
    ]


def texts():
    rng = random.Random(11)
    bits = ["the", " ", "  ", "Ing", "é", "\n", "\n\n", "\t", "日本", "𝒳", "　", "\x1c", "\x0b", "\x85", " ", "​", "᠎", "'s", "'ll", "12", "3", ".", "...", "<s>", "<0x0A>", "<|endoftext|>", "ß", "Ǆ", "\x00", "\U0001fae0", "ꟃ", "²", "½", "-", "_", "]", "^", "\\", "   ", " \n ", "\n \n", "a", "b"]
    some = ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 50))) for _ in range(300)]
    long = " ".join(rng.choice(["thing", "ation", "word", "über", "qxz"]) + rng.choice(["", ".", ",", "\n"]) for _ in range(700))
    return [*some, None, "", " ", "\n", "a▁b", long, "x" * 2_000, "same text", "same text", "日" * 300]


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


@pytest.mark.parametrize("frequent", [200_000, 40, 0])
def test_agreement_is_the_plain_version(spark, frequent):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame([(k, t, "clash", 9) for k, t in rows], "doc_id long, text string, pairs string, `a.b` int").repartition(5)
    settings = alignment.Settings(frequent=frequent, remembered=500, few=2 if frequent else 50)
    with open(tokenizer_file("byte_bpe_50k.json")) as one, open(tokenizer_file("piece_bpe_32k.model"), "rb") as other:
        found = alignment.agreement(docs, ["doc_id", "pairs", "a.b"], one.read(), other.read(), settings=settings).collect()
    want = plain_version([t for _, t in rows])
    assert sorted(r.doc_id for r in found) == [k for k, _ in rows]
    for r in found:
        assert tuple(r[c] for c in COLUMNS) == want[r.doc_id], rows[r.doc_id]
    assert {(r.pairs, r["a.b"]) for r in found} == {("clash", 9)}


def test_groups_of_any_ends():
    rng = random.Random(3)
    for _ in range(500):
        size = rng.randrange(1, 60)
        a, b = (sorted({*rng.sample(range(1, size + 1), rng.randrange(1, size + 1)), size}) for _ in "ab")
        if rng.random() < 0.3:
            a = b
        stretches, irregular, links = alignment.groups(a, b)
        n = np.arange(3)  # three documents of these ends side by side
        many = alignment.side_by_side(
            *(np.concatenate([np.array(e) + size * k for k in range(3)]) for e in (a, b)), n * len(a), (n + 1) * len(a), n * len(b), (n + 1) * len(b), 1
        )
        for alone, found, base in zip((stretches, irregular, links), many, ((len(a), len(b), 0), (len(a),) * 2 + (len(b),) * 2, (len(a), len(b))), strict=True):
            want = {tuple(x + k * y for x, y in zip(row, base, strict=True)) for row in alone for k in range(3)}
            assert set(map(tuple, found.tolist())) == want and len(found) == len(want)
        told = [(i + k, i + k + 1, j + k, j + k + 1) for i, j, n in stretches for k in range(n)] + irregular
        common = sorted(set(a) & set(b))
        assert sorted((a[x - 1], b[y - 1]) for _, x, _, y in told) == [(c, c) for c in common]
        all_links = {(i + k, j + k) for i, j, n in stretches for k in range(n)} | set(links)
        assert len(all_links) == len(a) + len(b) - len(common)
        spans = [list(zip([0, *e], e, strict=False)) for e in (a, b)]
        assert all_links == {(x, y) for x, s in enumerate(spans[0]) for y, t in enumerate(spans[1]) if max(s[0], t[0]) < min(s[1], t[1])}


def test_empty_tables_and_clashes(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, n_best string")
    with open(tokenizer_file("byte_bpe_50k.json")) as one, open(tokenizer_file("piece_bpe_32k.model"), "rb") as other:
        files = one.read(), other.read()
    assert alignment.agreement(docs, ["doc_id"], *files).isEmpty()
    with pytest.raises(ValueError):
        alignment.agreement(docs, ["doc_id", "n_best"], *files)


def test_parts_are_those_of_the_published_pattern():
    import public_tokenizers

    assert alignment.PARTS_A == public_tokenizers.PATTERN


def test_query_on_the_whole_table(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    want = dict(zip([r.doc_id for r in rows], plain_version([r.text for r in rows]), strict=True))
    found = QUERIES["op12_alignment"](spark, SF_DIR).collect()
    assert {r.doc_id: (*(r[c] for c in COLUMNS[:-1]), r.groups_sha256) for r in found} == want
