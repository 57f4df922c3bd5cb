"""Components, bundles and splits."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemill.llm import groups, splits


def union(edges):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
    return {x: find(x) for x in up}


@pytest.mark.parametrize("kind", ["chain", "star", "random", "two chains", "giant"])
def test_components(spark, kind):
    rng = random.Random(kind)
    if kind == "chain":
        n = [f"{x:05d}" for x in rng.sample(range(99999), 400)]
        edges = list(zip(n, n[1:]))
    elif kind == "star":
        edges = [("m", f"x{i}") for i in range(300)] + [("a", "b")]
    elif kind == "two chains":
        n = [f"{i:03d}" for i in range(200)]
        edges = list(zip(n[:100], n[1:100])) + list(zip(n[100:], n[101:]))
    elif kind == "giant":
        edges = [(f"{i}", f"{rng.randrange(i)}") for i in range(1, 500)] + [(f"p{i}", f"q{i}") for i in range(50)]
    else:
        edges = [(f"{rng.randrange(500)}", f"{rng.randrange(500)}") for _ in range(300)]
    edges += [(None, "z"), ("z", None), ("y", "y"), edges[0], edges[0][::-1]]
    df = spark.createDataFrame(edges, "a string, b string")
    assert {r.v: r.root for r in groups.components(spark, df).collect()} == union(edges)


def test_no_edges(spark):
    df = spark.createDataFrame([("a", "a"), (None, "b")], "a string, b string")
    assert groups.components(spark, df).count() == 0


def test_match_groups(spark):
    s = lambda i: f"{i:064x}"
    ph = spark.createDataFrame([(s(1), "x"), (f" SHA256:{s(2).upper()}", None), (None, "y"), (s(9), None)], "sha256 string, phash string")
    dh = spark.createDataFrame([(s(3), "00ab"), (s(4), " 0XAB"), (s(5), "0"), (s(6), "0"), (s(7), "zz"), (s(8), None), (s(8), "ab"), (s(3), "00ab")], "sha256 string, dhash string").withColumn("code", F.lit(1))
    pr = spark.createDataFrame([(s(1), s(2), True), (s(2), s(1), True), (s(2), s(9), None), (s(5), s(5), True), (s(2), s(77), True), (s(77), s(5), True), (s(1), s(3), False)], "sha_a string, sha_b string, confirmed boolean")
    got = {r.sha256: r.group_id for r in groups.match_groups(spark, ph, dh, pr).collect()}
    assert got == {s(1): s(1), s(2): s(1), s(3): s(3), s(4): s(3), s(8): s(3)}
    assert groups.match_groups(spark, ph.limit(0), dh.limit(0), pr).count() == 0


FRAMES = [
    ("HVW-D1911-20120709-0000010648_aug2", "hvwd1911|20120709|10648"),
    ("thumb_hvw_d1911 2012_07_09 frame0010648.JPG", "hvwd1911|20120709|10648"),
    ("copy of HVW D1911__2012-07-09__f10648_jpg.rf.46935a21021d817b", "hvwd1911|20120709|10648"),
    ("IMG_GKN_2257 2012-07-09 010231", "gkn2257|20120709|10231"),
    ("PJT-5752_20060620_0", "pjt5752|20060620|"),
    ("NRD-B4840_20201215", None), ("NRD-B4840_20201215_crop-3", None), ("IMG_8714", None), ("GOPR6524", None), ("frame993", None),
    ("28151d3624f46c9e7d69", None), ("MFT-B5212_overview", None), ("ABC-1234_20201399_0001", None), ("", None), (None, None),
]


def test_frames(spark):
    df = spark.createDataFrame([(s,) for s, _ in FRAMES], "stem string")
    assert [r[0] for r in df.select(splits.frame_key(F.col("stem"))).collect()] == [k for _, k in FRAMES]


def staged(spark):
    rows = [
        (1, "ABC-1234_20200101_0001", " G1 ", "train"), (2, "abc 1234.2020-01-01.f1", None, "TEST"),  # torn by frame
        (3, "x", "g1", "training"), (4, None, "G2", "val"), (5, "y", "g2", "dev"), (6, "z", "none", "train"), (7, "q", "-", "test"),
        (8, "w", "g3", "train"), (9, "w", "g3", "probe"), (10, None, None, None), (11, "ABC-1234_20200101_0002", "g3", "train"),
    ]
    return spark.createDataFrame(rows, "staged_id bigint, stem string, split_group string, upstream_split string").withColumns({"bundle": F.lit(1), "key": F.lit("k"), "w": F.lit(0)})


def test_torn(spark):
    assert sorted(r[0] for r in splits.torn(spark, staged(spark)).collect()) == [1, 2, 3]
    assert splits.torn(spark, staged(spark).limit(0)).count() == 0


def test_assign(spark):
    out = splits.assign(spark, staged(spark)).collect()
    assert len(out) == 11 and len({r.bundle for r in out}) == len({(r.bundle, r.split) for r in out})
    assert splits.assign(spark, staged(spark).limit(0)).count() == 0
    rng = random.Random(4)
    rows = [(i, None, f"g{min(int(rng.paretovariate(0.7)), 900)}-{rng.randrange(40)}" if i > 400 else "hot", "train") for i in range(4000)]
    big = spark.createDataFrame(rows, "staged_id bigint, stem string, split_group string, upstream_split string")
    out = splits.assign(spark, big).collect()
    where = defaultdict(set)
    for r in out:
        where[r.bundle].add(r.split)
    assert len(out) == 4000 and all(len(s) == 1 for s in where.values())
    share = Counter(r.split for r in out)
    assert abs(share["train"] / 4000 - 0.7) < 0.03 and abs(share["val"] / 4000 - 0.15) < 0.03


def test_differencing_balances():
    rng = random.Random(1)
    w = [rng.randrange(1, 1000) for _ in range(300)]
    load = Counter()
    for x, b in zip(w, splits.differencing(w, 7), strict=True):
        load[b] += x
    assert len(load) == 7 and max(load.values()) - min(load.values()) < 20
    assert splits.differencing([], 3) == [] and len(splits.differencing([5], 3)) == 1


def test_chain_guard_sees_chains_of_different_codes(spark):
    sha = lambda i: f"{i:064x}"
    chain = [(sha(i), f"{(1 << 4 * i) - 1 ^ 0x123456789ABCDEF0:016x}") for i in range(1, 16)]  # 4 bits a step, no two equal
    far = [(sha(100 + i), f"{random.Random(i).getrandbits(64):016x}") for i in range(30)]
    d = spark.createDataFrame([*chain, *far, (sha(100), far[1][1]), (None, "1" * 16), (sha(500), "0" * 16)], "sha256 string, dhash string")
    p = spark.createDataFrame([(sha(1), sha(102), True), (sha(1), sha(103), False), (sha(1), sha(104), None), (sha(2), sha(999), True)], "sha_a string, sha_b string, confirmed boolean")
    assert [tuple(r) for r in groups.chain_guard(spark, d, p).collect()] == [(16, 45, False)]
    assert [tuple(r) for r in groups.chain_guard(spark, d, p, most=0.5).collect()] == [(16, 45, True)]
    assert [tuple(r) for r in groups.chain_guard(spark, d.limit(0), p).collect()] == [(None, 0, True)]
