"""Canonical forms, leaks, tokenizer and nearest vectors."""

from __future__ import annotations

import random
import unicodedata

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemill.llm import bpe, leaks, lookalike, neighbours

SAME = [("ｆｕｌｌ １", "full 1"), ("café", "café"), ("соrаl", "coral"), ("ﬁn", "fin"), ("a​b­", "ab"), ("a b　c", "a b c"), ("re‐ef", "re-ef"), ("e‍́", "é"), ("ё", "ë"), ("ΑΒ", "AB"), ("ό", "ό"), ("－", "-")]
OTHER = [("Coral", "coral"), ("é", "e"), ("m²", "m2"), ("a  b", "a b"), ("a\nb", "a b"), ("a\tb", "a b"), ("a.b", "a,b"), ("O", "0"), ("l", "1"), ("½", "1/2")]


@pytest.mark.parametrize("a, b", SAME)
def test_same(a, b):
    assert lookalike.one_form(a) == lookalike.one_form(b)


@pytest.mark.parametrize("a, b", OTHER)
def test_other(a, b):
    assert lookalike.one_form(a) != lookalike.one_form(b)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aeéöсеоΑό̈​­ ﬁｆ각각й"), max_size=12))
def test_segments_equal_the_whole(s):
    """Splicing canonical segments gives what normalizing the whole text gives, and doing it again changes nothing."""
    to = lookalike._tables()[0]
    whole = unicodedata.normalize("NFC", unicodedata.normalize("NFD", s.translate(to)).translate(to))
    assert lookalike.one_form(s) == whole == lookalike.one_form(whole)


def test_composed_and_separate_spellings_are_equal():
    """For every assigned character, also between two others: composed, decomposed and as it is."""
    for cp in range(0x110000):
        c = chr(cp)
        if unicodedata.category(c) in ("Cs", "Cn", "Co"):
            continue
        parts = unicodedata.normalize("NFD", c)
        if parts != c or cp in lookalike.joins_before():
            form = lookalike.one_form(c)
            assert lookalike.one_form(parts) == form == lookalike.one_form(unicodedata.normalize("NFC", parts)), hex(cp)
            assert lookalike.one_form(f"x{parts}y") == lookalike.one_form(f"x{c}y"), hex(cp)
    for a, b in (("\u09c7\u09be", "\u09cb"), ("\u0bc6\u0bbe", "\u0bca"), ("\u0d46\u0d3e", "\u0d4a"), ("\u1025\u102e", "\u1026")):
        assert lookalike.one_form(a) == lookalike.one_form(b)


def test_every_look_alike_pair():
    for latin, others in lookalike.ALIKE.items():
        for c in others:
            assert lookalike.one_form(f"a{c}b") == lookalike.one_form(f"a{latin}b") and lookalike.one_form(c + "\u0301") == lookalike.one_form(latin + "\u0301")
    for joined, letters in lookalike.JOINED.items():
        assert lookalike.one_form(joined) == lookalike.one_form(letters)


def test_alike(spark):
    rows = [(1, "coral reef"), (2, "соral reef"), (3, "coral reef"), (4, None), (5, ""), (6, "​"), (7, " "), (8, " "), (9, "Coral reef"), (10, "x" * 200_000 + "а"), (11, "x" * 200_000 + "a"), (None, "coral reef")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"t": F.lit(1), "f": F.lit(2), "form": F.lit("z")})
    assert {tuple(r) for r in lookalike.alike(spark, df).collect()} == {(1, 2), (2, 3), (10, 11)}
    assert lookalike.alike(spark, df.limit(0)).count() == 0
    forms = {r.doc_id: r.form2 for r in lookalike.with_form(df.select("doc_id", "text"), out="form2").collect()}
    assert forms[2] == "coral reef" and forms[4] is None and forms[5] == ""


WORDS = "the reef lies near a wide channel where coral cover fell from forty to nine percent after the warm year of bleaching".split()


def test_leaks(spark):
    rng = random.Random(2)
    w = [f"w{i}" for i in range(400)]
    items, docs = [(1, " ".join(WORDS)), (2, " ".join(WORDS)), (3, "Is it pale at 4.7 m?"), (4, None), (5, ""), (6, "?!"), (None, "x y")], []
    docs.append((1, "Before. " + " ".join(WORDS[3:15]).upper() + "! after"))  # twelve words
    docs.append((2, " ".join(WORDS[3:14]) + " other words follow"))  # eleven
    docs.append((3, "he asked: is it pale at 4,7 m"))
    docs.append((4, "is it pale at 4 m 7"))
    docs.append((5, " ".join(WORDS).replace("coral", "соrаl").replace(" ", " ")))
    docs += [(6, None), (7, ""), (8, " ".join(rng.choices(w, k=30_000)) + " " + " ".join(WORDS)), (None, " ".join(WORDS))]
    edited = WORDS[:9] + ["entirely"] + WORDS[9:]
    docs.append((9, " ".join(edited)))
    docs += [(100 + i, "the reef lies near a wide channel") for i in range(300)]  # boilerplate
    d = spark.createDataFrame(docs, "doc_id bigint, text string").withColumns({"gram": F.lit(1), "item": F.lit("q"), "doc": F.lit(0)})
    i = spark.createDataFrame(items, "item_id bigint, text string").withColumns({"gram": F.lit(1), "df": F.lit(1)})
    found = leaks.leaks(spark, d, i)
    assert {tuple(r) for r in leaks.exact(found).collect()} == {(1, 1), (1, 2), (3, 3), (5, 1), (5, 2), (8, 1), (8, 2), (9, 1), (9, 2)}
    assert (9, 1) in {(r.doc_id, r.item_id) for r in leaks.edited(leaks.leaks(spark, d, i, rare=0.05)).collect()}
    assert leaks.leaks(spark, d.limit(0), i).count() == 0 and leaks.leaks(spark, d, i.limit(0)).count() == 0


def test_near_finds_edited_copies_of_common_passages(spark):
    rng = random.Random(3)
    every_third = [v for k, v in enumerate(WORDS, 1) for v in ([v, f"x{k}"] if k % 3 == 0 else [v])]  # no four words in a row are left
    docs = [(k, " ".join(every_third)) for k in range(40)] + [(k, " ".join(rng.choices(WORDS, k=rng.randrange(1, 60)))) for k in range(40, 120)]
    docs += [(200, None), (201, ""), (None, " ".join(WORDS)), (202, " ".join(rng.choices(WORDS[:3], k=3000)) + " " + " ".join(WORDS[:10]))]
    items = [(1, " ".join(WORDS)), (2, "is it pale near coral"), (3, None), (4, "?!"), (None, "x y"), (5, " ".join(WORDS[5:17]))]
    d, i = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    got = {tuple(r) for r in leaks.edited(leaks.near(spark, d, i)).collect()}
    want = set()
    for k, t in docs:
        for n, x in items:
            own = leaks.words(x)
            if k is not None and n is not None and own:
                run, score = leaks.align(own, leaks.words(t))
                if score >= 0.8 * leaks.MATCH * min(leaks.PASSAGE, len(own)):
                    want.add((k, n, run, score))
    assert got == want and {(k, 1) for k in range(40)} <= {r[:2] for r in got}
    assert not {(k, 1) for k in range(40)} & {(r.doc_id, r.item_id) for r in leaks.edited(leaks.leaks(spark, d, i, rare=0.001)).collect()}
    assert leaks.near(spark, d.limit(0), i).count() == 0 and leaks.near(spark, d, i.limit(0)).count() == 0


def test_leaks_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(leaks, "BROADCAST_GRAMS", 2)
    d = spark.createDataFrame([(1, " ".join(WORDS)), (2, "no")], "doc_id bigint, text string")
    i = spark.createDataFrame([(7, " ".join(WORDS[2:]))], "item_id bigint, text string")
    assert [tuple(r) for r in leaks.exact(leaks.leaks(spark, d, i)).collect()] == [(1, 7)]


def test_align_against_full_matrix():
    rng = random.Random(1)
    for _ in range(50):
        a, b = ([rng.choice("abcde") for _ in range(rng.randrange(1, 12))] for _ in range(2))
        h = np.zeros((len(a) + 1, len(b) + 1), int)
        run, longest = np.zeros_like(h), 0
        for i, x in enumerate(a, 1):
            for j, y in enumerate(b, 1):
                h[i, j] = max(0, h[i - 1, j - 1] + (2 if x == y else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
                run[i, j] = run[i - 1, j - 1] + 1 if x == y else 0
        assert leaks.align(a, b) == (run.max(), h.max())
    texts = [[rng.choice("abcdefg") for _ in range(rng.randrange(40))] for _ in range(120)]
    number = {c: i for i, c in enumerate("abcdef")}  # g is in no item
    items, docs = [[w for w in t if w != "g"] for t in texts[:60]], texts[60:]
    got = leaks.align_pairs(*([np.array([number.get(w, -2) for w in t], np.int32) for t in side] for side in (items, docs)))
    assert list(zip(*(x.tolist() for x in got), strict=True)) == [leaks.align(a, b) for a, b in zip(items, docs, strict=True)]


def library():
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


TEXTS = ["", " ", "a", "Hello  world\n\n x", "<|endoftext|>", "naïve café 123,456", "日本語 русский ελληνικά", "\x00\x1f​�", "🐠🐟 reef's don't", "a" * 5000, " " * 300 + "x", "ab" * 4000]


def test_encode_equals_the_library(spark):
    t = library()
    own = bpe.tokenizer(f"{bpe.FOLDER}/{bpe.VOCABULARY}")
    for x in TEXTS:
        assert own.encode(x) == t.encode(x, add_special_tokens=False).ids
        assert own.decode(own.encode(x)) == x
    rows = [(i, x) for i, x in enumerate(TEXTS)] + [(99, None), (None, "x"), (99, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("ids", F.lit("clash"))
    out = [(r.doc_id, r.ids) for r in bpe.encode(df).collect()]
    assert len(out) == len(rows) and out.count((99, [])) == 2 and (0, []) in out and (None, own.encode("x")) in out
    assert {(r.doc_id, r.text) for r in bpe.decode(bpe.encode(df)).collect()} == {(i, x or "") for i, x in rows}
    assert bpe.encode(df.limit(0)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_encode_any_text(s):
    own = bpe.tokenizer(f"{bpe.FOLDER}/{bpe.VOCABULARY}")
    assert own.encode(s) == library().encode(s, add_special_tokens=False).ids and own.decode(own.encode(s)) == s


def vectors(n, seed):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n // 3, 64))
    v = np.concatenate([base, base + 0.25 * rng.standard_normal(base.shape), base + 0.5 * rng.standard_normal(base.shape)])
    return v / np.linalg.norm(v, axis=1, keepdims=True)


@pytest.mark.parametrize("rows, depth", [(1 << 17, 1), (40, 1), (1 << 17, 2), (1 << 17, 3)])
def test_recall(spark, monkeypatch, rows, depth):
    """Against brute force at every number of joined hashes, and with all buckets cut into pieces."""
    monkeypatch.setattr(neighbours, "BUCKET_ROWS", rows)
    v = np.float32(vectors(1500 if depth == 1 else 450, 3))
    df = spark.createDataFrame([(f"{i:04d}", [float(y) for y in x]) for i, x in enumerate(v)], "key string, vec array<float>")
    got = {(r.key, r.other): r.cos for r in neighbours.nearest(spark, df, depth=depth).collect()}
    cos = v.astype(float) @ v.T.astype(float)
    np.fill_diagonal(cos, -2)
    best = np.argsort(-cos, axis=1)[:, :5]
    want = {(f"{i:04d}", f"{j:04d}") for i in range(len(v)) for j in best[i] if cos[i, j] >= 0.85}
    assert len(want & set(got)) / len(want) >= 0.97
    assert all(abs(c - cos[int(a), int(b)]) < 1e-5 for (a, b), c in got.items())
    close = {(r.key, r.other) for r in neighbours.nearest(spark, df, least=0.85, depth=depth).collect() if r.cos >= 0.85}
    assert close == {p for p, c in got.items() if c >= 0.85}


@pytest.mark.parametrize("depth", [1, 2, 3])
@pytest.mark.parametrize("cos", [0.85, 0.9])
def test_pairs_at_the_bound_meet(cos, depth):
    rng = np.random.default_rng(7)
    a, r = rng.standard_normal((2, 600, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    r -= (r * a).sum(1, keepdims=True) * a
    b = cos * a + np.sqrt(1 - cos * cos) * r / np.linalg.norm(r, axis=1, keepdims=True)
    met: set[int] = set()
    for t in range(neighbours.TABLES[depth]):
        (i, x, own), (j, y, other) = (neighbours.buckets(v.astype(np.float32), t, depth) for v in (a, b))
        met |= {k for k, _ in set(zip(i, x, strict=True)) & set(zip(j[other], y[other], strict=True))}
        met |= {k for k, _ in set(zip(i[own], x[own], strict=True)) & set(zip(j, y, strict=True))}
    assert len(met) / 600 >= 0.95


def test_copies_ties_and_unusable(spark):
    rng = np.random.default_rng(0)
    a, b = rng.standard_normal(64), rng.standard_normal(64)
    rows = [(f"a{i:03d}", [float(x) * (i + 1) for x in a]) for i in range(300)] + [("b", [float(x) for x in b]), ("c", [float(x) for x in b + 0.01 * a])]
    rows += [("n", None), ("e", []), ("s", [1.0] * 32), ("z", [0.0] * 64), ("q", [float("nan")] * 64), (None, [1.0] * 64)]
    df = spark.createDataFrame(rows, "key string, vec array<float>").withColumns({"id": F.lit(1), "bucket": F.lit(2)})
    got = {}
    for r in neighbours.nearest(spark, df).collect():
        got.setdefault(r.key, []).append((r["rank"], r.other))
    assert {o for _, o in got["a000"]} == {f"a{i:03d}" for i in range(1, 6)} and {o for _, o in got["a200"]} == {f"a{i:03d}" for i in range(5)}
    assert sorted(got["b"])[0] == (1, "c") and not {"n", "e", "s", "z", "q"} & set(got)
    assert neighbours.nearest(spark, df.limit(0)).count() == 0


def test_similar_pairs(spark):
    s = lambda i: f"{i:064x}"
    v = [1.0] + [0.0] * 63
    w = [0.9, 0.43588989] + [0.0] * 62
    e = spark.createDataFrame([(s(1), v), (f"SHA256:{s(1)}", [2 * x for x in v]), (s(2), w), (s(3), [0.0, 0.0, 1.0] + [0.0] * 61), ("junk", v)], "key string, vec array<float>")
    assert [tuple(r) for r in neighbours.similar_pairs(spark, e).collect()] == [(s(1), s(2))]
