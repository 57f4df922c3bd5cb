"""Spatial joins against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.operators import nearby as N


def hav(a, b, c, d):
    a, b, c, d = map(math.radians, (a, b, c, d))
    h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
    return 2 * N.EARTH * math.asin(math.sqrt(min(1, h)))


def spots(n, seed):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        lat, lon = rng.choice([(0, 0.5), (60, 179.9999), (89.9999, 10), (-89.9998, -100), (-45, -180), (90, 0), (10, 359.9999)])
        out.append((max(-90.0, min(90.0, lat + rng.gauss(0, 2e-4))), (lon + rng.gauss(0, 3e-4) / max(0.001, math.cos(math.radians(lat))) + 180) % 360 - 180))
    return out + out[: n // 10]


@pytest.mark.parametrize("radius", [20, 300])
def test_within(spark, radius):
    p = spots(250, radius)
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(p)], "i int, lat double, lon double")
    got = {(r[0], r[1]) for r in N.within(df, df, radius).select("l.i", "r.i").collect()}
    want = {(i, j) for i in range(len(p)) for j in range(len(p)) if hav(*p[i], *p[j]) <= radius}
    assert {x for x in got ^ want if abs(hav(*p[x[0]], *p[x[1]]) - radius) > 1e-6} == set()
    assert N.within(df, df, radius).count() == len(got)  # each pair in one cell only


def star(rng, k):
    a = np.sort(rng.uniform(0, 2 * np.pi, k))
    r = rng.uniform(0.3, 1, k)
    return np.stack([r * np.cos(a), r * np.sin(a)], 1) * 5


def test_ear_clip_covers_the_ring():
    rng = np.random.default_rng(1)
    for k in (3, 4, 7, 20, 60):
        ring = star(rng, k)
        area = abs((ring[:, 0] * np.roll(ring[:, 1], -1) - np.roll(ring[:, 0], -1) * ring[:, 1]).sum()) / 2
        for r in (ring, ring[::-1], np.r_[ring, ring[:1]]):
            t, sure = N.ear_clip(r)
            assert sure
            u, v = t[:, 1] - t[:, 0], t[:, 2] - t[:, 0]
            assert abs(np.abs(u[:, 0] * v[:, 1] - u[:, 1] * v[:, 0]).sum() / 2 - area) < 1e-9
    assert len(N.ear_clip(np.array([[0, 0], [1, 1], [0, 0]]))[0]) == 0 and len(N.ear_clip(np.array([[0, 0], [1, 0], [2, 0], [3, 0]]))[0]) == 0


def test_ear_clip_of_a_long_coast():
    """20,000 corners: far from quadratic, and the area is kept."""
    a = np.linspace(0, 2 * np.pi, 20_000, endpoint=False)
    r = 5 + 0.5 * np.sin(37 * a) + 0.2 * np.random.default_rng(3).uniform(-1, 1, len(a))
    ring = np.stack([r * np.cos(a), r * np.sin(a)], 1)
    t, sure = N.ear_clip(ring)
    u, v = t[:, 1] - t[:, 0], t[:, 2] - t[:, 0]
    area = abs((ring[:, 0] * np.roll(ring[:, 1], -1) - np.roll(ring[:, 0], -1) * ring[:, 1]).sum()) / 2
    assert sure and abs((u[:, 0] * v[:, 1] - u[:, 1] * v[:, 0]).sum() / 2 - area) < 1e-6 and len(t) <= 19_998


def test_self_crossing_rings_are_settled_by_even_odd():
    rng = np.random.default_rng(8)
    p = rng.uniform(-1, 11, (3000, 2))
    for k in (4, 5, 8, 15):
        ring = rng.uniform(0, 10, (k, 2))
        assert (place([(5, ring)], p) == np.where(N.even_odd(p, ring), 5, -1)).all()


def place(rings, p):
    clipped = [N.ear_clip(r) for _, r in rings]
    owner = np.concatenate([np.full(len(t), i) for i, (t, _) in enumerate(clipped)]) if rings else np.empty(0, int)
    corners = np.concatenate([t for t, _ in clipped]) if rings else np.empty((0, 3, 2))
    known = N.Regions(corners, owner, np.array([o for o, _ in rings], np.int64), np.array([s for _, s in clipped], bool))
    return known.locate(p, [r for _, r in rings])


def test_locate_equals_even_odd():
    rng = np.random.default_rng(2)
    rings = [(int(rng.integers(0, 9)), star(rng, int(rng.integers(3, 40))) + rng.uniform(-6, 6, 2)) for _ in range(25)]
    rings.append((4, np.array([[0, 0], [2, 0], [2, 2], [0, 2]], float)))
    rings.append((3, np.array([[2, 0], [4, 0], [4, 2], [2, 2]], float)))  # shares an edge
    grid = np.stack(np.meshgrid(np.arange(-1, 5, 0.5), np.arange(-1, 3, 0.5)), -1).reshape(-1, 2)
    p = np.concatenate([rng.uniform(-12, 12, (4000, 2)), grid, *[r for _, r in rings]])
    best = np.full(len(p), 99)
    for o, r in rings:
        best = np.where(N.even_odd(p, r), np.minimum(best, o), best)
    assert (place(rings, p) == np.where(best == 99, -1, best)).all()
    assert (place([], p) == -1).all()


def test_locate_by_cell_equals_the_broadcast(spark, monkeypatch):
    """The same rows from one hierarchy and from one per grid cell, whose positions are cut into pieces."""
    monkeypatch.setattr(N, "CELL_POINTS", 20)
    rng = np.random.default_rng(12)
    rings = [(int(rng.integers(0, 9)), star(rng, int(rng.integers(3, 40))) + rng.uniform(-6, 6, 2)) for _ in range(12)]
    rings += [(3, rng.uniform(-3, 3, (9, 2))), (2, np.array([[0, 0], [2, 0], [2, 2], [0, 2]], float)), (2, np.array([[2, 0], [4, 0], [4, 2], [2, 2]], float))]
    grid = np.stack(np.meshgrid(np.arange(-1, 5, 0.5), np.arange(-1, 3, 0.5)), -1).reshape(-1, 2)
    p = np.concatenate([rng.uniform(-12, 12, (1500, 2)), grid, grid[:40], *[r for _, r in rings]])
    o = spark.createDataFrame([(o, [(float(x), float(y)) for x, y in r]) for o, r in rings], "feature_ord int, ring array<struct<lon double, lat double>>")
    df = spark.createDataFrame([(i, float(y), float(x)) for i, (x, y) in enumerate(p)], "i int, lat double, lon double")
    one, many = ({(r.i, r.feature_ord) for r in N.locate(spark, df, o, most).collect()} for most in (None, 0))
    own = place(rings, p)
    assert one == many == {(i, int(f)) for i, f in enumerate(own) if f >= 0}


def outlines(spark):
    sq = lambda x, y: [(x, y), (x + 2.0, y), (x + 2.0, y + 2.0), (x, y + 2.0)]
    rows = [(1, 0, sq(0.0, 0.0)), (0, 0, sq(1.0, 1.0)), (0, 0, sq(1.0, 1.0)), (2, 0, sq(178.0, 0.0)), (2, 1, sq(-180.0, 0.0)), (None, 0, sq(5.0, 5.0)), (7, 0, None), (8, 0, [(0.0, 0.0)])]
    return spark.createDataFrame(rows, "feature_ord int, part_no int, ring array<struct<lon double, lat double>>")


META = [
    (1, "a", 0.5, 0.5, False), (2, "b", 0.5, 0.5001, None), (3, "a", 0.5, 0.5001, False), (4, "b", 1.5, 1.5, True), (5, "c", 1.0, 359.99999, False), (6, "d", 1.0, -0.00001, False),
    (7, "a", 0.0, 0.0, False), (8, "a", float("nan"), 1.0, False), (9, "a", None, 1.0, False), (10, "a", -9999.0, -9999.0, False), (11, "a", 1.0, 180.0, False), (12, None, 0.5, 0.5, False),
]


def test_found(spark, monkeypatch):
    m = spark.createDataFrame(META, "row_id bigint, source_id string, lat double, lon double, location_generalized boolean").withColumns({"cell": F.lit("x"), "place": F.lit(1), "vague": F.lit(2)})
    s = spark.createDataFrame([("S1", 0.5005, 0.5), ("S1", 0.5005, 0.5), ("S2", None, 0.5), (None, 0.5, 0.5), ("S3", 0.0, 0.0), ("S4", 1.0, 180.0001)], "site_id string, lat double, lon double")
    want = {("site", r, "S1") for r in (1, 2, 3, 12)} | {("site", 11, "S4"), ("image", 1, "2"), ("image", 2, "3"), ("image", 5, "6")}
    want |= {("region", r, "1") for r in (1, 2, 3, 12)} | {("region", 4, "0"), ("region", 11, "2")}
    got = [tuple(r) for r in N.found(spark, m, s, outlines(spark)).collect()]
    assert set(got) == want and len(got) == len(set(got))
    monkeypatch.setattr(N, "BROADCAST_CORNERS", 3)  # the way without broadcast
    assert {tuple(r) for r in N.found(spark, m, s, outlines(spark)).collect()} == set(got)
    assert N.found(spark, m.limit(0), s.limit(0), outlines(spark).limit(0)).count() == 0
