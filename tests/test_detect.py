"""Average precision, confident labels, answers and samples against plain Python."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.operators import columns as C
from tidemill.operators import detect, measure, relate, sample


def iou(a, b):
    w, h = min(a[0] + a[2], b[0] + b[2]) - max(a[0], b[0]), min(a[1] + a[3], b[1] + b[3]) - max(a[1], b[1])
    both = max(0, w) * max(0, h)
    return both / (a[2] * a[3] + b[2] * b[3] - both)


def plain_ap(truth, found, label, least):
    rows, total = [], sum(t[1] == label for t in truth)
    for image in {t[0] for t in truth} | {f[0] for f in found}:
        free = [t[2:] for t in truth if t[:2] == (image, label)]
        own = sorted((f for f in found if f[:2] == (image, label)), key=lambda f: (-f[6], f[7]))[: detect.MOST]
        for f in own:
            fit = [(iou(f[2:6], t), i) for i, t in enumerate(free)]
            best = max(fit, default=(0, 0))
            hit = bool(fit) and best[0] >= least
            if hit:
                free.pop(best[1])
            rows.append((-f[6], str(f[7]), hit))
    tp, points = 0, []
    for n, (_, _, hit) in enumerate(sorted(rows), 1):
        tp += hit
        points.append((tp / total, tp / n))
    return sum(max((p for r, p in points if r >= s / 100 - 1e-9), default=0) for s in range(101)) / 101


def test_average_precision_against_plain_python(spark):
    rng = random.Random(4)
    box = lambda: (rng.uniform(0, 60), rng.uniform(0, 60), rng.uniform(5, 30), rng.uniform(5, 30))
    truth = [(f"i{rng.randrange(6)}", rng.choice("ab"), *box()) for _ in range(50)] + [("i0", "never found", *box())]
    found = []
    for t in truth[:-1]:
        for _ in range(rng.randrange(3)):
            found.append((t[0], rng.choice([t[1], "c"]), *(v + rng.uniform(-3, 3) for v in t[2:]), round(rng.random(), 2), len(found)))
    g = spark.createDataFrame(truth + [(None, "a", 0.0, 0.0, 1.0, 1.0)], "image string, label string, x double, y double, w double, h double").withColumn("hit", F.lit(3))
    f = spark.createDataFrame(found + [("i0", "a", None, 0.0, 1.0, 1.0, 0.9, 999)], "image string, label string, x double, y double, w double, h double, score double, id int").withColumn("tp", F.lit(1))
    got = {(r.label, r.threshold): r.ap for r in detect.average_precision(g, f, [0.5, 0.75]).collect()}
    assert set(got) == {(x, t) for x in ("a", "b", "never found") for t in (0.5, 0.75)}
    for (label, least), ap in got.items():
        assert abs(ap - plain_ap(truth, found, label, least)) < 1e-9, (label, least)
    assert detect.average_precision(g.limit(0), f).count() == 0
    assert {r.ap for r in detect.average_precision(g, f.limit(0), [0.5]).collect()} == {0.0}


def test_confident_labels(spark):
    rng = np.random.default_rng(0)
    centre = rng.standard_normal((3, 8))
    given = rng.integers(0, 3, 120)
    v = centre[given] + 0.3 * rng.standard_normal((120, 8))
    given[:9] = (given[:9] + 1) % 3  # wrong labels
    rows = [(i, int(g), [float(x) for x in r]) for i, (g, r) in enumerate(zip(given, v, strict=True))]
    df = spark.createDataFrame([*rows, (900, None, rows[0][2]), (901, 1, None), (902, 1, [0.0] * 8), (None, 1, rows[0][2]), (903, 1, [1.0, None] + [0.0] * 6)], "k int, y int, v array<double>").withColumn("p", F.lit("x"))
    p = measure.class_probabilities(df, "k", "y", "v")
    table = {}
    for r in p.collect():
        table.setdefault((r.key, r.label), {})[r["class"]] = r.p
    assert len(table) == 120 and all(abs(sum(x.values()) - 1) < 1e-5 for x in table.values())
    assert {(r.key, r.guess) for r in measure.guesses(p).collect()} == {(k, max(x, key=lambda c: (x[c], -c))) for (k, _), x in table.items()}
    cut = {c: round(np.mean([x[c] for (_, y), x in table.items() if y == c]), 9) for c in range(3)}
    want = {}
    for (k, y), x in table.items():
        able = [c for c in range(3) if x[c] >= cut[c]]
        want[k] = (y, max(able, key=lambda c: (x[c], -c)) if able else None)
    a = measure.confident(p)
    assert {r.key: (r.label, r.likely) for r in a.collect()} == want
    joint = {(r.label, r.likely): (r.n, r.joint) for r in measure.confident_joint(a).collect()}
    for label in range(3):
        own = [x for y, x in want.values() if y == label]
        assert abs(sum(j for (y, _), (_, j) in joint.items() if y == label) - len(own)) < 1e-4
    assert {k for k, (y, x) in want.items() if x is not None and x != y} >= set(range(7))
    assert measure.class_probabilities(df.limit(0), "k", "y", "v").count() == 0


def test_right_answer(spark):
    rows = [("The Two corals!", ["2 coral", "two corals"], None, True), ("B) sand", ["rock"], "b", True), ("b", ["rock"], "c", False), ("rock", ["Rock."], "c", True), (None, ["x"], None, False), ("x", None, None, False), ("x", [], "x", True)]
    df = spark.createDataFrame([r[:3] for r in rows], "a string, r array<string>, o string")
    assert [r[0] for r in df.select(measure.right_answer(F.col("a"), F.col("r"), F.col("o"))).collect()] == [r[3] for r in rows]


def test_caption_flags(spark):
    rows = [("Bleached hard coral on sand", "SD", None), ("Hard coral and sponge", "SD", "g:caption=HC,SP!=label=SD"), ("nothing", "SD", None), (None, "SD", None), ("sand", None, None), ("sand", "", None)]
    df = spark.createDataFrame([r[:2] for r in rows], "c string, l string")
    assert [r[0] for r in df.select(C.caption_flag(F.col("c"), F.col("l"), C.GROUND, "g")).collect()] == [r[2] for r in rows]
    u = "0A1b2c3d-0000-1111-2222-333344445555"
    df = spark.createDataFrame([(None, f"x/{u}.png"), (u, f"y{u[::-1]}"), ("a", None)], "a string, b string")
    assert [r[0] for r in df.select(C.uuid_in(F.col("a"), F.col("b"))).collect()] == [u.lower(), u.lower(), None]


def test_half_equal(spark):
    for sizes, n in (({"a": 100, "b": 3, "c": 10}, 40), ({"a": 5, "b": 5}, 40), ({"a": 1000, "b": 1}, 7), ({}, 5), ({"a": 3}, 0)):
        got = sample.half_equal(sizes, n)
        assert sum(got.values()) == min(n, sum(sizes.values())) and all(0 <= got[k] <= sizes[k] for k in sizes)
    assert sample.half_equal({"a": 80, "b": 20}, 20) == {"a": 13, "b": 7}
    df = spark.createDataFrame([(i, "a" if i % 5 else "b") for i in range(100)] + [(200, None)], "k int, s string")
    out = sample.half_equal_sample(df, "s", "k", 20).groupBy("s").agg(F.count("*").alias("n"), F.round(F.sum("weight"), 6).alias("w")).collect()
    assert {(r.s, r.n, r.w) for r in out} == {("a", 13, 80.0), ("b", 7, 20.0)}


@pytest.mark.parametrize("parts", [1, 7])
def test_lagged_and_links(spark, parts):
    rng = random.Random(parts)
    rows = [(rng.choice("aaaab"), i) for i in range(200)] + [(None, 7)]
    df = spark.createDataFrame(rows, "k string, i int").repartition(parts)
    got = {(r.a, r.b) for r in relate.run_links(df, "k", "i").collect()}
    want = set()
    for k in "ab":
        own = sorted(i for x, i in rows if x == k)
        want |= set(zip(own, own[1:], strict=False))
    assert got == want
    assert relate.run_links(df.limit(0), "k", "i").count() == 0


def test_fingerprint_counts_rows_in_any_order(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "k int, v string")
    same = relate.fingerprint(df.repartition(3), ["k", "v"]).first()
    assert same == relate.fingerprint(df.orderBy(F.desc("k")), ["k", "v"]).first() and same["rows"] == 3
    assert same != relate.fingerprint(df.distinct(), ["k", "v"]).first()
    assert relate.fingerprint(df.limit(0), ["k", "v"]).first()["rows"] == 0


def test_endings_padding_and_classes(spark):
    keys = ["a/B.PNG", "x.tar.GZ", "http://h/p.jpg?x=1.gif#y", ".hidden", "none", None, "a.b/c"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    assert [r[0] for r in df.select(C.suffix_of(F.col("k"))).collect()] == ["png", "tar.gz", "jpg", None, None, None, None]
    low, high = C.padded_box(F.lit(2.5), F.lit(10.0), 0.1, F.lit(13))
    assert tuple(df.select(low, high).first()) == (2, 13)
    low, high = C.padded_box(F.lit(0.2), F.lit(1.0), 0.3, F.lit(9))
    assert tuple(df.select(low, high).first()) == (0, 2)
    df = spark.createDataFrame([("b", [0, 1, 7]), ("z", None), (None, [])], "l string, p array<int>")
    assert [tuple(r) for r in df.select(C.class_id(F.col("l"), ["a", "b"]), C.remapped(F.col("p"), [5, 6])).collect()] == [(1, [5, 6, 255]), (255, None), (255, [])]
