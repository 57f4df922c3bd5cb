"""Codes, quality and rules of images and masks; split maps; files of bounded bytes."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.operators import pixels as P
from tidemill.operators import splitmap
from tidemill.sources import sinks


def test_shrinking_keeps_the_mean():
    rng = np.random.default_rng(0)
    x = rng.uniform(0, 255, (37, 53))
    assert abs(P.shrunk(x, 8, 9).mean() - x.mean()) < 1e-9 and P.shrunk(x, 37, 53) == pytest.approx(x)
    assert P.shrunk(np.arange(16.0).reshape(4, 4), 2, 2).tolist() == [[2.5, 4.5], [10.5, 12.5]]


def test_codes():
    rng = np.random.default_rng(1)
    ramp = np.tile(np.arange(90.0), (80, 1))
    assert P.gradient_code(ramp) == "f" * 16 and P.gradient_code(ramp[:, ::-1]) == "0" * 16
    x = rng.uniform(0, 255, (64, 72)).cumsum(1) % 255
    bits = lambda c: int(c, 16)
    near = x + rng.normal(0, 2, x.shape)
    for code in (P.gradient_code, P.frequency_code):
        assert (bits(code(x)) ^ bits(code(near))).bit_count() <= 10 and (bits(code(x)) ^ bits(code(rng.uniform(0, 255, x.shape)))).bit_count() > 10
        assert code(x) == code(np.kron(x, np.ones((2, 2))))  # twice as large, the same picture
    assert bits(P.frequency_code(x)).bit_count() in (31, 32, 33) and bits(P.frequency_code(x, constant=True)).bit_count() == 32


def test_quality():
    flat, mixed = np.full((5, 5), 7.0), np.arange(256.0).reshape(16, 16)
    assert P.entropy(flat) == 0 and P.entropy(mixed) == 8 and P.sharpness(flat) == 0 and P.sharpness(np.ones((2, 9))) == 0
    assert P.sharpness((np.indices((8, 8)).sum(0) % 2) * 255.0) > P.sharpness(mixed)


def test_described(spark):
    rows = [(1, [0.0, 255.0, 1.0, 2.0], 2), (2, None, 2), (3, [], 2), (4, [1.0, 2.0, 3.0], 2), (5, [1.0, None], 2), (6, [1.0, float("nan")], 2), (7, [1.0], None), (8, [1.0], 0), (None, [5.0], 1)]
    df = spark.createDataFrame(rows, "i int, g array<double>, w int").withColumn("key", F.lit("x"))
    got = {r.i: (r.clipped, r.entropy) for r in P.described(df, "i", "g", F.col("w"), ["clipped", "entropy"]).collect()}
    assert got == {1: (0.5, 2.0), **dict.fromkeys(range(2, 9), (None, None)), None: (0.0, 0.0)}
    assert P.described(df.limit(0), "i", "g", F.col("w"), ["dhash"]).count() == 0
    assert [r[0] for r in df.limit(1).select(P.featureless(F.lit(None).cast("double")), P.featureless(F.lit(1.9)), P.featureless(F.lit(2.0))).collect()[0:1]] == [True]


def test_mask_rules(spark):
    rows = [
        ("ok", 2, 3, 2, 3, [0, 1, 255], [1, 2], [1, 2], [0, 1, 2]), ("size", 2, 3, 3, 2, [1], [1], None, None), ("nulls", None, 3, None, 3, None, None, None, None),
        ("class", 1, 1, 1, 1, [9], [1], [], []), ("ignore", 1, 1, 1, 1, [1], [1, 255], [], []), ("gap", 1, 1, 1, 1, [1], [1], [1, 3], [1]), ("twice", 1, 1, 1, 1, [1], [1], [1, 1], [1]), ("stray", 1, 1, 1, 1, [1], [1], [1], [2]),
    ]
    df = spark.createDataFrame(rows, "image string, width int, height int, mask_width int, mask_height int, values array<int>, classes array<int>, instances array<int>, seen array<int>")
    got = {}
    for r in P.mask_faults(df).collect():
        got.setdefault(r.image, set()).add(r.fault)
    assert got == {"size": {"size"}, "nulls": {"size", "empty"}, "class": {"class"}, "ignore": {"ignore listed"}, "gap": {"numbers"}, "twice": {"numbers"}, "stray": {"stray"}}


def test_split_maps(spark, tmp_path):
    g = spark.createDataFrame([("a", None), ("b", "1"), ("c", "1"), ("d", "2"), ("e", "2"), ("f", None), (None, "1"), ("b", "1")], "group string, component string").withColumn("split", F.lit("z"))
    known = spark.createDataFrame([("a", "val"), ("b", "test"), ("gone", "train")], "group string, split string")
    forced = spark.createDataFrame([("f", "val"), ("c", "train"), ("d", "test")], "group string, split string")
    got = {r.group: (r.split, r.rule) for r in splitmap.resolved(g, known, {"train": 0.8, "test": 0.2}, forced).collect()}
    assert got.pop("e")[1] == "hashed"
    assert got == {"a": ("val", "kept"), "b": ("test", "kept"), "c": ("test", "inherited"), "d": ("test", "forced"), "f": ("val", "forced")}
    assert {r.rule for r in splitmap.resolved(g.filter("group = 'a'"), known, {"train": 1.0}, frozen=True).collect()} == {"kept"}
    with pytest.raises(ValueError):
        splitmap.resolved(g, known, {"train": 1.0}, frozen=True)
    with pytest.raises(splitmap.SplitConflict):
        splitmap.resolved(g, known.union(spark.createDataFrame([("c", "train")], known.schema)), {"train": 1.0})
    rows = known.select("group", "split")
    head = splitmap.save_map(rows, str(tmp_path / "m"), {"by": "site"})
    again, back = splitmap.load_map(spark, str(tmp_path / "m"))
    assert again == head and {tuple(r) for r in back.collect()} == {tuple(r) for r in rows.collect()} and head["groups"] == 3
    assert splitmap.save_map(rows.orderBy("split"), str(tmp_path / "n"), {"by": "site"}) == head
    back.filter("group = 'a'").write.mode("overwrite").json(str(tmp_path / "n" / "assignments"))
    with pytest.raises(ValueError):
        splitmap.load_map(spark, str(tmp_path / "n"))
    with pytest.raises(ValueError):
        splitmap.save_map(rows.union(spark.createDataFrame([("a", "test")], rows.schema)), str(tmp_path / "o"), {})


def test_files_of_bounded_bytes(spark, tmp_path):
    rows = [(i, "x" * (i * 37 % 900), "a" if i % 3 else None) for i in range(300)] + [(999, "y" * 5000, "a"), (1000, None, "a")]
    df = spark.createDataFrame(rows, "i int, t string, p string")
    manifest = {(r.value, r.shard): (r["rows"], r["bytes"]) for r in sinks.write_bounded(df, str(tmp_path / "w"), "p", "i", 4000).collect()}
    names = sorted(f.name for f in (tmp_path / "w" / "p").glob("*.parquet"))
    count = {v: sum(1 for x, _ in manifest if x == v) for v in ("a", "none")}
    assert names == sorted(f"{v}-{k:05d}-of-{count[v]:05d}.parquet" for v, k in manifest) and count["a"] > 10
    seen = []
    for v in ("a", "none"):
        for k in range(count[v]):
            own = spark.read.parquet(str(tmp_path / "w" / "p" / f"{v}-{k:05d}-of-{count[v]:05d}.parquet")).collect()
            ids = [r.i for r in own]
            assert ids == sorted(ids) and len(ids) == manifest[v, k][0] and manifest[v, k][1] < 4000 + 5100
            seen += ids
    assert sorted(seen) == sorted(r[0] for r in rows)
    assert {(r.label, r.number) for r in sinks.label_index(df, "p").collect()} == {("a", 0)}
