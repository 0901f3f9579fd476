"""Text operators against brute force, and their edge cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from galley.llm import jaccard, language, lattice, packing, pii, unigram
from galley.llm.common import as_text, slices
from galley.llm.graph import BITS
from galley.llm.queries import QUERIES, tokenizer_file
from galley.operators.durable import shared_folder

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, component_id string"


def documents(spark, texts, langs=None):
    rows = [(k, t, (langs or {}).get(k), "s", None, "clash") for k, t in texts]
    return spark.createDataFrame(rows, DOCS)


# ---- helpers


def test_slices_and_texts_keep_every_character():
    texts = ["Ab é" * 50, None, "", "ÇĐ ß" * 400] * 5
    batch = pa.RecordBatch.from_pydict({"t": pa.array(texts)}).slice(3, 14)
    parts = list(slices([batch], "t", 500))
    assert len(parts) > 3
    import pyarrow.compute as pc

    lowered = [x for p in parts for x in pc.ascii_lower(as_text(p.column("t"))).to_pylist()]
    ascii_low = str.maketrans({chr(k): chr(k + 32) for k in range(65, 91)})
    assert lowered == [(t or "").translate(ascii_low) for t in texts[3:17]]


# ---- language


def test_language_held_out_accuracy(spark):
    answers = QUERIES["op4_language"](spark, SF_DIR).toPandas()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang").toPandas()
    both = answers.merge(docs, on="doc_id")
    assert len(answers) == len(docs)
    held = both[both.held_out & both.lang.notna()]
    assert list(both.held_out) == [zlib.crc32(str(k).encode()) % 5 == 0 for k in both.doc_id]
    assert (held.lang == held.lang_pred).mean() > 0.95
    assert both.score.between(0, 1).all()


def test_numerals_are_no_letters(spark):
    train = spark.createDataFrame([(1, "ein Wort", "de"), (2, "a word", "en")], "doc_id long, text string, lang string")
    model = language.fit(train, F.col("doc_id"))
    asked = spark.createDataFrame([(1, "\u00b2"), (2, "\u00bd 12 \u2167 \u2462"), (3, "\u00b2 word"), (4, "\u4e00")], "doc_id long, text string")
    found = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(asked, model, ["doc_id"]).collect()}
    assert found[1] == found[2] == ("und", 0.0)
    assert found[3][0] == "en" and found[4][0] != "und"


def test_language_edges(spark):
    train = documents(spark, [(1, "the cat and the dog"), (2, "der hund und die katze"), (3, None)], {1: "en", 2: "de", 3: "en"})
    model = language.fit(train, F.col("doc_id"))
    asked = documents(spark, [(1, None), (2, ""), (3, "12 !!"), (4, "the the dog"), (4, "UND DER HUND"), (None, "katzen"), (6, "the " * 30_000)])
    found = sorted((str(r.doc_id), r.lang_pred) for r in language.identify(asked, model, ["doc_id"]).collect())
    assert found == [("1", "und"), ("2", "und"), ("3", "und"), ("4", "de"), ("4", "en"), ("6", "en"), ("None", "de")]
    nothing = language.fit(train.filter("false"), F.col("doc_id"))
    assert {r.lang_pred for r in language.identify(asked, nothing, ["doc_id"]).collect()} == {"und"}
    assert language.identify(asked.filter("false"), model, ["doc_id"]).isEmpty()


def test_unseen_words_back_off_to_ever_shorter_grams():
    grams = [np.sort(h[0][h[0] != 0]) for h in [language.gram_hashes(["ab"], 3)[1][k : k + 1] for k in range(3)]]
    scores = [np.full((len(g), 1), -float(n)) for n, g in enumerate(grams, 1)]
    model = language.Model(["x"], {}, np.zeros((0, 1)), grams, scores)
    known, longer = model.of_words(["ab", "abq"])
    assert known[0] != longer[0]
    assert model.of_words([]).shape == (0, 1)


# ---- personal data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    def luhn(d):
        return sum(int(c) if k % 2 == 0 else sum(map(int, str(2 * int(c)))) for k, c in enumerate(reversed(d))) % 10 == 0

    out = [(0, *m.span()) for m in EMAIL.finditer(text)]
    out += [(1, *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    return out + [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def test_base_spans_are_the_patterns():
    rng = random.Random(3)
    alphabet = "ab.@-+ 0123456789()%é\n"
    pieces = ["a@b.c", "1.2.3.4", "4111 1111 1111 1111", "+1 (800) 555-1212", "@@", "..", "256.1.1.1"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) if rng.random() < 0.2 else rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_base_spans_of_long_runs_take_linear_time():
    assert pii.base_spans("a" * 400_000 + "@") == []
    assert pii.base_spans("1" * 400_000) == []


def test_contexts_find_what_no_pattern_does(spark):
    mails = [(k, f"please write to mail box u{k}@x.example.com today") for k in range(12)]
    hidden = [(100, "please write to mail box user77(at)x today"), (101, "call 4471abc now")]
    rows = documents(spark, mails + hidden + [(102, None), (None, ""), (100, hidden[0][1])])
    found = {(r.doc_id, tuple((s.kind, s.start, s.stop) for s in r.added)) for r in pii.find(rows, ["doc_id"]).collect()}
    start = hidden[0][1].index("user77")
    assert (100, ((0, start, start + 6),)) in found
    assert (101, ()) in found and (102, ()) in found and (None, ()) in found
    clean = {r.doc_id: r.text for r in pii.redact(rows).collect()}
    assert clean[0] == "please write to mail box [EMAIL] today"
    assert clean[101] == hidden[1][1] and clean[102] is None
    assert pii.redact(rows).columns == rows.columns
    assert pii.find(rows.filter("false"), ["doc_id"]).isEmpty()


def test_belief_reaches_patterns_without_a_seed(spark):
    seeded = [f"please write to mail box u{k}@x.example.com today" for k in range(30)]
    both = [f"please write to mail box acct{k}no today" for k in range(4)]
    second = [f"the member badge shows acct{k}no here" for k in range(4)] + ["the member badge shows acct9no here"]
    third = [f"lost near gate acct{k}no again" for k in range(2)]
    texts = [*seeded, *both, *second, *third]
    found = {r.doc_id: [(s.kind, s.start, s.stop) for s in r.added] for r in pii.find(documents(spark, list(enumerate(texts))), ["doc_id"], settings=pii.Settings(confidence=0.6)).collect()}
    for k, text in enumerate(texts):
        at = text.find("acct")
        assert found[k] == ([(0, at, text.index("no", at) + 2)] if at >= 0 else []), text


def test_what_stands_in_a_slot_is_found_whatever_its_shape(spark):
    texts = [f"please write to mail box u{k}@x.example.com today" for k in range(20)]
    texts += [f"ring the office on +44 20 7946 {1000 + k} please" for k in range(20)]
    texts += [f"charge the card 4111 1111 1111 1111 now {k}" for k in range(3)]
    texts += [f"only the number is +1 800 555 {2000 + k} ok" for k in range(4)] + [f"only the number is {w} ok" for w in ("large", "small", "odd")]
    hidden = [
        ("please write to mail box jane.doe@intranet today", "jane.doe@intranet", 0),
        ("please write to mail box jdoe today", "jdoe", 0),
        ("ring the office on 020 7946 0958 please", "020 7946 0958", 3),
        ("ring the office on (555) 123-4567 please", "(555) 123-4567", 3),
        ("ring the office on 4112 please", "4112", 3),
    ]
    docs = documents(spark, list(enumerate([*texts, *(t for t, _, _ in hidden), "we saw jdoe and 4112 there"])))
    found = {r.doc_id: [(s.kind, s.start, s.stop) for s in r.added] for r in pii.find(docs, ["doc_id"]).collect()}
    for k, (text, value, kind) in enumerate(hidden, len(texts)):
        start = text.index(value)
        assert (kind, start, start + len(value)) in found[k], (text, found[k])
    assert all(not found[k] for k in range(len(texts))), found
    assert found[len(texts) + len(hidden)] == []


def test_digit_groups_take_linear_time():
    assert pii.identifiers("1" * 400_000, []) == [(0, 400_000)]
    assert len(pii.identifiers("1 " * 100_000, [])) == 1


def _letters(n):
    return "q" + "".join("abcdefghij"[int(d)] for d in str(n))


def test_pii_belief_spreads_until_nothing_changes(spark):
    sizes = [40, 20, 10, 6, 4, 3]  # seeds, then identifiers each of which stands in two contexts
    groups = [[f"user{k}@mail{_letters(k)}.org" for k in range(40)]]
    groups += [[f"id{g}{k:03d}zz" for k in range(n)] for g, n in enumerate(sizes[1:], 1)]
    texts = []
    for context, (before, after) in enumerate(zip(groups, groups[1:])):
        for value in before + after:
            texts.append(f"the first{_letters(context)} second{_letters(context)} {value} {_letters(len(texts))}")
    docs = documents(spark, list(enumerate(texts)))
    found = pii.find(docs, ["doc_id"], settings=pii.Settings(confidence=0.3)).collect()
    got = {texts[r.doc_id][s.start : s.stop] for r in found for s in r.added}
    assert got >= {v for group in groups[1:] for v in group}


def test_slots_of_stretches_are_those_of_whole_texts():
    rng = random.Random(5)
    parts = ["mail", "to", "box", "a.b", "x1", "\u00a0", "é", "to-day", "(box", "box:", "𝒳", "12345", "@", "no."]
    texts = ["".join(rng.choice(parts) + rng.choice([" ", "  ", "\n", ""]) for _ in range(rng.randrange(25))) for _ in range(400)]

    def bits(*words):
        found = np.zeros(1 << (BITS - 3), np.uint8)
        for word in words:
            at = pii.place_of(pii.crc(word))
            found[at >> 3] |= 1 << (at & 7)
        return found

    strong = {p for t in texts[:200] for a, b in pii.fillers(t, lambda w: w in ("box", "mail")) for p in pii.contexts(t, a, b)}
    batch = pa.RecordBatch.from_pydict(
        {pii.ROW: list(range(400)), "__llm_text": texts, "__llm_base": [[] for _ in texts]}
    )
    run = pii._standing(bits("box", "mail"), bits(*strong))
    got = {(r["__llm_row"], r["pattern"], r["start"], r["stop"]) for out in run([batch]) for r in out.to_pylist()}
    want = {
        (k, p, a, b) for k, t in enumerate(texts) for a, b in pii.fillers(t, lambda w: w in ("box", "mail"))
        for p in pii.contexts(t, a, b) if p in strong
    }
    assert got == want and len(want) > 100


def test_only_words_near_both_words_of_a_pattern_are_walked(spark, monkeypatch):
    texts = ["mail in the box " * 50, "than the x1 than\u00a0the y", "see: a THE, b are", "than é the z", None] * 4
    patterns = ["than the _", ", _ are", "_ _ x"]
    marks = pii._pattern_marks(spark.createDataFrame([(p,) for p in patterns], "pattern string"))
    bits = {kind: np.zeros(1 << (BITS - 3), np.uint8) for kind in ("openers", "whole")}
    for kind, words in (("openers", ["than", "the", ",", "_"]), ("whole", patterns)):
        for at in (pii.place_of(pii.crc(w)) for w in words):
            bits[kind][at >> 3] |= 1 << (at & 7)
    batch = pa.RecordBatch.from_pydict({pii.ROW: list(range(len(texts))), "__llm_text": texts, "__llm_base": [[] for _ in texts]})
    got = [[r for out in pii._standing(bits["openers"], bits["whole"], m)([batch]) for r in out.to_pylist()] for m in (None, marks)]
    assert got[0] == got[1] and {r["pattern"] for r in got[1]} == {"than the _", ", _ are"}
    walked, plain = [], pii.fillers
    monkeypatch.setattr(pii, "fillers", lambda text, *rest: walked.append(text) or plain(text, *rest))
    list(pii._standing(bits["openers"], bits["whole"], marks)([batch]))
    assert walked and texts[0] not in walked  # it opens slots a hundred times, none of a pattern


def test_pii_contexts_hold_whole_words():
    long = "x" * 120
    text = f"{long} {long} ab12345 {long}z"
    assert pii.contexts(text, 242, 249) == [f"{long} {long} _", f"{long} _ {long}z"]
    assert pii.words_before("a b" + " " * 5000, 5003, 2) == ["a", "b"]
    assert pii.words_before("", 0, 2) == [] and pii.contexts("12345", 0, 5) == []



def test_pii_query_digest(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    for r in QUERIES["op2_pii"](spark, SF_DIR).collect():
        want = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in plain_spans(docs[r.doc_id]))
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [want.count(f"{k}:") for k in pii.KINDS]


# ---- packing


def test_word_encoder_is_the_tokenizer():
    from tokenizers import Tokenizer

    with open(tokenizer_file("word_bpe_49k.json"), encoding="utf-8") as file:
        definition = file.read()
    plain, encoder = Tokenizer.from_str(definition), packing.WordEncoder(definition, remembered=50)
    rng, alphabet = random.Random(1), "aAzZéÉßñÇıİΣςσ'’.,;<|>endoftext \n\t\x1c ́K12٣ㄱ中ǅﬁ𝒜\x85"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["", "<|endoftext|> <|ENDOFTEXT|>", "İ. don't we'LL.", "...", "x" * 5000]
    offsets, ids = encoder.encode(pa.array(texts, pa.large_string()))
    for k, text in enumerate(texts):
        assert ids[offsets[k] : offsets[k + 1]].tolist() == plain.encode(text, add_special_tokens=False).ids, text


def test_packing_places_every_piece_once(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = QUERIES["op7_packing"](spark, SF_DIR).toPandas()
    want = {}
    for k, text in docs.items():
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        for n, a in enumerate(range(0, len(ids), 2048)):
            part = ids[a : a + 2048]
            want[k, n] = (a, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows.itertuples()} == want
    for _, one in rows.sort_values("offset").groupby("sequence_id"):
        assert (one.offset == one.length.cumsum() - one.length).all() and one.length.sum() <= 2048
    least = -(-rows.length.sum() // 2048)
    assert rows.sequence_id.nunique() <= least + 1


def test_packing_edges(spark):
    docs = documents(spark, [(1, None), (1, None), (None, ""), (2, "word " * 5000), (3, "a b")])
    rows = packing.pack(docs, ["doc_id"], tokenizer_file("word_bpe_49k.json")).collect()
    assert sorted((str(r.doc_id), r.piece, r.length) for r in rows) == [
        ("1", 0, 1), ("1", 0, 1), ("2", 0, 2048), ("2", 1, 2048), ("2", 2, 905), ("3", 0, 3), ("None", 0, 1),
    ]
    assert all(len(r.ids) == r.length for r in rows)
    assert packing.pack(docs.filter("false"), ["doc_id"], tokenizer_file("word_bpe_49k.json")).isEmpty()


def test_plans_keep_every_piece_through_crossover_and_mutation():
    from collections import Counter

    rng, settings = random.Random(5), packing.Settings(capacity=100)
    lengths = Counter(rng.randint(1, 70) for _ in range(600))
    one = packing.best_fit(lengths, {}, 100)
    other = packing.best_fit(lengths, {}, 100, rng.sample(sorted(lengths), len(lengths)))
    for plan in (one, other, packing.crossover(one, other, lengths, settings, rng), packing.mutated(other, lengths, settings, rng)):
        used = Counter()
        for pattern, times in plan.items():
            assert sum(pattern) <= 100
            for n in pattern:
                used[n] += times
        assert used == lengths


# ---- Jaccard


def shingles(text):
    low = text.translate(str.maketrans({chr(k): chr(k + 32) for k in range(65, 91)}))
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def brute_components(docs):
    sets = {k: shingles(t or "") for k, t in docs}
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            if a < b and common and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: (len(sets[k]), find(k)) for k in sets}


def near_copies(n_groups, group, seed, shared=0):
    """Groups of edited copies; a passage of ``shared`` words opens every document."""
    rng = random.Random(seed)
    passage = " ".join(f"p{k}" for k in range(shared))
    docs = []
    for g in range(n_groups):
        base = [f"w{rng.randint(0, 10**6)}" for _ in range(rng.randint(20, 120))]
        for _ in range(group):
            words = list(base)
            for _ in range(rng.randint(0, max(1, len(words) // 18))):
                words[rng.randrange(len(words))] = f"e{rng.randint(0, 10**6)}"
            docs.append(f"{passage} {' '.join(words)}")
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize(("groups", "group", "shared"), [(40, 3, 0), (3, 45, 0), (60, 2, 30), (2, 40, 60)])
def test_jaccard_equals_brute_force(spark, groups, group, shared):
    docs = near_copies(groups, group, groups, shared)
    settings = jaccard.Settings(light=4)  # small, so that common tokens and large groups take their own ways
    found = jaccard.join(documents(spark, docs), ["doc_id"], settings=settings).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_components(docs)


@pytest.mark.parametrize(("groups", "group", "shared"), [(3, 45, 0), (2, 40, 60)])
def test_jaccard_tiles_of_bounded_size_lose_nothing(spark, monkeypatch, groups, group, shared):
    for name, size in (("TILE_USES", 8), ("TILE_NODES", 8), ("TILE_BYTES", 4096)):
        monkeypatch.setattr(jaccard, name, size)
    docs = near_copies(groups, group, groups, shared)
    found = jaccard.join(documents(spark, docs), ["doc_id"], settings=jaccard.Settings(light=4)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_components(docs)


def test_jaccard_tiles_give_a_row_for_a_node_and_no_pairs():
    rng = np.random.default_rng(4)
    base = np.unique(rng.integers(0, 2**63, 100, dtype=np.uint64))
    sets = [np.unique(np.concatenate((base[rng.permutation(len(base))[:88]], rng.integers(0, 2**63, 12, dtype=np.uint64)))) for _ in range(300)]
    nodes = np.sort([jaccard.node_of(x) for x in sets])
    sets = sorted(sets, key=jaccard.node_of)
    rows = {"group": [1] * 300, "tile": [0] * 300, "chunk": [0] * 300, "node": nodes, "root": nodes}
    shown = pa.RecordBatch.from_pydict(rows | {"n": [len(x) for x in sets], "bits": [jaccard.signature(x) for x in sets]})
    whole = pa.RecordBatch.from_pydict(rows | {"tokens": [x.tobytes() for x in sets]})
    some = {(int(a), int(b)) for out in jaccard._crossing(75)([shown]) for a, b in zip(out["a"].to_numpy(), out["b"].to_numpy())}
    links = {(int(a), int(b)) for out in jaccard._linking(75)([whole]) for a, b in zip(out["a"].to_numpy(), out["b"].to_numpy())}
    assert 200 < len(some) < 300 and len(links) < 300
    known = dict(zip(nodes.tolist(), sets))
    linked = lambda a, b: 100 * len(np.intersect1d(a, b)) >= 75 * len(np.union1d(a, b))
    assert all(linked(known[a], known[b]) for a, b in links)
    together = [{n} for n in nodes.tolist()]
    for a, b in links:
        x, y = (next(g for g in together if n in g) for n in (a, b))
        if x is not y:
            together.remove(y)
            x |= y
    group = {n: k for k, g in enumerate(together) for n in g}
    assert all(group[a] == group[b] or not linked(known[a], known[b]) for a in known for b in known if a < b)


def test_jaccard_edges(spark):
    long = " ".join(f"w{k}" for k in range(30_000))
    texts = [(5, "A b C d E f"), (3, "a B c D e f"), (3, "a b c d e f"), (7, None), (8, ""), (9, " \t "), (10, "one two"), (11, "ONE two"), (None, "one two"), (12, long), (13, long + " x")]
    docs = documents(spark, texts)
    found = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in jaccard.join(docs, ["doc_id"]).collect())
    assert found == sorted(
        [("5", 2, 3), ("3", 2, 3), ("3", 2, 3), ("7", 0, 7), ("8", 0, 8), ("9", 0, 9), ("10", 1, 10), ("11", 1, 10), ("None", 1, 10), ("12", 29_996, 12), ("13", 29_997, 12)]
    )
    kept = jaccard.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 7, 8, 9, 10, 12]
    assert jaccard.join(docs.filter("false"), ["doc_id"]).isEmpty()


def test_deduplicated_and_redacted_rows_keep_texts_stored_once(spark):
    folder = Path(shared_folder(spark).removeprefix("file:")) / "llm" / spark.sparkContext.applicationId

    def kinds():
        return {p for p in folder.glob("*-*")}

    texts = [(k, f"mail box u{k % 7}@x.example.com of a b c d e f g h {k % 7}") for k in range(20)]
    before = kinds()
    kept = jaccard.deduplicated(documents(spark, texts))
    left = {p.name.rpartition("-")[0] for p in kinds() - before}
    assert left <= {"jaccard-documents", "jaccard-dropped", "links"} and len(kept.collect()) == 7
    before = kinds()
    clean = pii.redact(documents(spark, texts).withColumn("added", F.lit(1)))
    [stored] = [p for p in kinds() - before if p.name.startswith("pii-found-")]
    assert "__llm_plain" not in spark.read.parquet(str(stored)).columns
    assert {(r.added, r.text[:16]) for r in clean.collect()} == {(1, "mail box [EMAIL]")}


def test_bitmap_bound_is_never_below_the_overlap():
    rng = np.random.default_rng(2)
    for _ in range(300):
        a = np.unique(rng.integers(0, 2**63, rng.integers(1, 300), dtype=np.uint64))
        b = np.unique(np.concatenate((rng.choice(a, rng.integers(0, len(a) + 1)), rng.integers(0, 2**63, rng.integers(1, 300), dtype=np.uint64))))
        most = jaccard.most_common(jaccard.signature(a), len(a), jaccard.signature(b), len(b))
        assert most >= len(np.intersect1d(a, b))


# ---- unigram counts and lattice


@pytest.fixture(scope="module")
def pieces():
    return unigram.vocabulary(tokenizer_file("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def exact(pieces):
    from tokenizers import Tokenizer, models, pre_tokenizers

    tokenizer = Tokenizer(models.Unigram(list(zip(pieces.pieces, pieces.scores, strict=True)), unk_id=pieces.unknown, byte_fallback=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace("▁", prepend_scheme="always", split=True)
    return tokenizer


def some_texts():
    rng, alphabet = random.Random(1), "aAzZéß  \n▁'.,<s>unk0x41中ㄱ𝒜\x0b"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(500)]
    return [*texts, "", " ", "  a", "a ", "<s> <unk> <0x41>", "the " * 3000, "x" * 300 + "é中" * 40]


def test_token_counts_are_the_tokenizers(spark, pieces, exact):
    texts = some_texts()
    rows = unigram.count_pieces(documents(spark, list(enumerate(texts))), ["doc_id"], pieces).collect()
    for r in rows:
        assert r.n_pieces == len(exact.encode(texts[r.doc_id], add_special_tokens=False).ids), texts[r.doc_id]
    edges = documents(spark, [(1, None), (None, "a"), (1, None)])
    assert sorted((str(r.doc_id), r.n_pieces) for r in unigram.count_pieces(edges, ["doc_id"], pieces).collect()) == [("1", 0), ("1", 0), ("None", 1)]
    assert unigram.count_pieces(edges.filter("false"), ["doc_id"], pieces).isEmpty()


def test_lattice_encodes_as_the_tokenizer_and_decodes_back(spark, pieces, exact):
    texts = some_texts()
    docs = documents(spark, [*enumerate(texts), (None, None), (0, texts[0])])
    rows = lattice.decode(lattice.encode(docs, ["doc_id"], pieces), pieces).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        text = texts[r.doc_id] if r.doc_id is not None else ""
        spaced = text.replace("▁", " ")
        opened = " " + spaced if spaced.startswith(" ") else spaced
        assert r.ids == exact.encode(opened, add_special_tokens=False).ids, text
        assert r.decoded == spaced
    assert lattice.encode(docs.filter("false"), ["doc_id"], pieces).isEmpty()


def test_lattice_folds_many_words_at_once_into_their_best_paths(spark, pieces):
    solver = lattice.Solver(pieces)
    words = sorted({"▁" + w for t in some_texts() for w in t.replace("▁", " ").split(" ") if len(w) < 64})
    table = spark.createDataFrame([(w, [0, 1]) for w in words], "word string, parts array<int>")
    rows = lattice.edges(table.repartition(2), lattice.piece_table(spark, pieces), pieces, 64).mapInArrow(
        lattice._packed(pieces, 64, at_once=50), "part int, words binary, lengths binary, ids binary"
    ).collect()
    found = {0: {}, 1: {}}
    for r in rows:
        names = zstandard.decompress(r.words).decode().split(" ")
        lengths = np.frombuffer(zstandard.decompress(r.lengths), np.uint16)
        ids = np.frombuffer(zstandard.decompress(r.ids), lattice.id_type(pieces)).tolist()
        for name, n in zip(names, lengths.tolist(), strict=True):
            found[r.part][name], ids = ids[:n], ids[n:]
    assert found[0] == found[1] == {w[1:]: solver.ids(w) for w in words}


def test_lattice_decodes_in_the_pass_that_encodes(spark, pieces):
    docs = documents(spark, [*enumerate(some_texts()[:40]), (None, None)])
    both = lattice.encode(docs, ["doc_id"], pieces, with_decoded=True).collect()
    assert both == lattice.decode(lattice.encode(docs, ["doc_id"], pieces), pieces).collect()


def test_rows_are_decoded_together_unless_bytes_are_no_text(pieces, monkeypatch):
    rng, calls, plain = np.random.default_rng(1), [], lattice.decoded
    names, bytes_of = np.array(pieces.pieces, object), np.full(len(pieces.pieces), -1)
    bytes_of[lattice.byte_ids(pieces)] = np.arange(256)
    monkeypatch.setattr(lattice, "decoded", lambda *x: calls.append(x) or plain(*x))
    solver = lattice.Solver(pieces)
    whole = [solver.ids("▁" + t.replace(" ", "▁")) for t in some_texts()[:60]]
    broken = [rng.choice([*lattice.byte_ids(pieces), *range(300, 500)], rng.integers(0, 20)).tolist() for _ in range(60)]
    for rows, slow in ((whole, False), (broken, True), ([[], []], False)):
        batch = pa.RecordBatch.from_pydict({"ids": pa.array([[5], *rows], pa.list_(pa.int32()))}).slice(1)
        calls.clear()
        [out] = lattice._decoded(pieces)([batch])
        assert out.column("decoded").to_pylist() == [plain(np.array(r, np.int32), names, bytes_of) for r in rows]
        assert bool(calls) == slow
    with pytest.raises(IndexError):
        list(lattice._decoded(pieces)([pa.RecordBatch.from_pydict({"ids": pa.array([[-1]], pa.list_(pa.int32()))})]))


def test_dictionaries_hold_no_python_strings(pieces):
    # some 150 bytes a word as a dictionary of strings
    import tracemalloc

    names = pa.array([f"word{k}" for k in range(20_000)], pa.large_string())
    known = lattice.Dictionary(pieces)
    known.keep(names, np.ones(20_000, np.int64), np.arange(20_000, dtype=np.int32))
    tracemalloc.start()
    offsets, ids = known.encode(pa.array(["word7 word19999 word7", ""], pa.large_string()))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (offsets.tolist(), ids.tolist()) == ([0, 3, 3], [7, 19999, 7]) and peak < 200_000
