"""Generic operators on small frames: nulls, ties, repeats, empty tables, clashing names; one test per trap of semantics."""

from __future__ import annotations

import math
import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemill.functions import geo, text
from tidemill.functions import identity as I
from tidemill.operators import allocate as A
from tidemill.operators import checks as Q
from tidemill.operators import columns as C
from tidemill.operators import curate as K
from tidemill.operators import harmonise as H
from tidemill.operators import measure as M
from tidemill.operators import relate as R
from tidemill.operators import sample as S
from tidemill.session import Scratch
from tidemill.streaming import counters as T


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first()[0]


def col(spark, values, kind):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


@pytest.mark.parametrize("raw, want", [("a" * 64, "a" * 64), (" SHA256:" + "AB" * 32 + "\t", "ab" * 32), (" " + "0" * 64 + "﻿", "0" * 64), ("md5 : " + "1" * 64, "1" * 64), ("a" * 63, None), ("g" * 64, None), ("", None), (None, None)])
def test_digest(spark, raw, want):
    assert col(spark, [raw], "string").select(I.digest(F.col("v"))).first()[0] == want


@pytest.mark.parametrize("raw, want", [(" 0XAB", "00000000000000ab"), ("0", None), ("f" * 16, None), ("0" * 16, None), ("1" * 17, None), ("e2~", None), ("", None), (None, None), ("E" * 16, "e" * 16)])
def test_code(spark, raw, want):
    assert col(spark, [raw], "string").select(I.code(F.col("v"), 16, pad=True)).first()[0] == want


def test_hamming(spark):
    a, b = "f" * 64, "0" * 63 + "1"
    df = spark.createDataFrame([(a, b), (a, a)], "a string, b string")
    assert [r[0] for r in df.select(I.hamming(F.col("a"), F.col("b"), 64)).collect()] == [255, 0]


def test_predicates_on_null(spark):
    df = col(spark, [None, "x", "y"], "string")
    got = lambda op, v: [r[0] for r in df.select(C.predicate(F.col("v"), op, v)).collect()]
    assert got("eq", "x") == [False, True, False] and got("ne", "x") == [True, False, True]
    assert got("in", ["x"]) == [False, True, False] and got("not_in", ["x"]) == [True, False, True]
    with pytest.raises(ValueError):
        C.predicate(F.col("v"), "like", "x")


def test_zones_names_dates(spark):
    z = [r[0] for r in col(spark, [-3.0, -1.0, 9.99, 10.0, 150.0, float("nan"), None, 99999.0], "double").select(C.depth_zone(F.col("v"))).collect()]
    assert z == [None, "shallow", "shallow", "upper", "deep", None, None, None]
    assert [r[0] for r in col(spark, [" Training", "DEV", "probe", None, ""], "string").select(C.split_name(F.col("v"))).collect()] == ["train", "val", None, None, None]
    d = [str(r[0]) for r in col(spark, ["x_2020-02-30", "x_20200229_1", "none", None], "string").select(C.calendar_date(F.col("v"))).collect()]
    assert d == ["None", "2020-02-29", "None", "None"]
    assert [r[0] for r in col(spark, [999, 1000, 5_000_000], "bigint").select(C.size_band(F.col("v"))).collect()] == ["n<1K", "1K<n<10K", "n>1M"]


def test_provenance_units_rounding(spark):
    v, o = C.first_present({"a": F.lit(" "), "b": F.lit(None).cast("string"), "c": F.lit(" x ")})
    assert (one(spark, v), one(spark, o)) == ("x", "c")
    assert one(spark, C.as_unit(F.lit(91.0), F.lit(0.0))) is None and one(spark, C.as_unit(F.lit(1.0), F.lit(None).cast("double"))) is None
    assert one(spark, C.generalised(F.lit(0.25), F.lit(True))) == 0.2 and one(spark, C.generalised(F.lit(0.25), F.lit(False))) == 0.25
    assert one(spark, C.violations({"a": F.lit(True), "b": F.lit(None).cast("boolean"), "c": F.lit(False)})) == ["a"]


def test_repeats_keep_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), ("a", 1)], "k string, n int")
    assert sorted(r.repeats for r in C.with_repeats(df, ["k", "n"]).collect()) == [1, 2, 2]


def test_wilson(spark):
    low, high = C.wilson(F.lit(0), F.lit(0))
    assert (one(spark, low), one(spark, high)) == (0.0, 0.0)
    low, high = C.wilson(F.lit(8), F.lit(10))
    assert abs(one(spark, low) - 0.4902) < 1e-3 and abs(one(spark, high) - 0.9433) < 1e-3


def test_text(spark):
    got = [r[0] for r in col(spark, ["The Two reefs, and an eel!", None, "", "CAFÉ  zero"], "string").select(text.normal_answer(F.col("v"))).collect()]
    assert got == ["2 reefs and eel", "", "", "café 0"]
    assert one(spark, text.stems(F.lit("The sponges of anemones and species, grass families"))) == ["sponge", "anemone", "specy", "grass", "family"]
    assert [one(spark, text.licence_class(F.lit(x))) for x in ("cc by-nc 4.0", " CC BY 4.0", "CC0-1.0", "", "x", "CC-BY-SA-4.0")] == ["noncommercial", "attribution", "open", "unknown", "unknown", "sharealike"]
    assert one(spark, text.caption([F.lit(None).cast("string")])) == "" and one(spark, text.caption([F.lit("a b"), F.lit("c")])) == "A b, c."


def test_boxes(spark):
    low, high, cut = geo.unit_span(F.lit(-5.0), F.lit(5.0), F.lit(10))
    assert (one(spark, low), one(spark, high), one(spark, cut)) == (0.0, 0.5, True)
    low, high, _ = geo.unit_span(F.lit(11.0), F.lit(12.0), F.lit(10))
    assert one(spark, low) is None and one(spark, high) is None


def roll(spark, counts, **more):
    df = spark.createDataFrame([("g", k) for k, n in counts.items() for _ in range(n)], "grp string, label string")
    got = R.rollup(df, "grp", "label", **more).collect()
    return (got[0].dominant, got[0].present) if got else None


def test_rollup_traps(spark):
    assert roll(spark, {"HC": 5, "ALGAE": 3, "SC": 2})[0] == "HC"
    assert roll(spark, {"HC": 4, "ALGAE": 4, "SC": 2})[0] == "mixed"
    assert roll(spark, {"HC": 50, "ALGAE": 10, "SC": 9, "ABIOTIC": 31})[1] == ["ABIOTIC", "ALGAE", "HC"]
    assert roll(spark, {"HC": 5, "unknown": 5}) == (None, None)  # exactly half unknown is kept, too few known
    assert roll(spark, {"HC": 2, "unknown": 8}) is None
    assert roll(spark, {"A": 5, "B": 5})[0] == "A"  # ties by name
    assert roll(spark, {"A": 1, "unknown": 1}, floor=0, least_known=0.5)[0] == "A"


def test_relations(spark):
    n = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "x"), ("c", "y")], "s string, i string")
    assert {tuple(r) for r in R.overlaps(n, "s", "i").collect()} == {("a", "a", 1), ("a", "b", 1), ("b", "a", 1)}
    links = R.run_links(spark.createDataFrame([("k", 3), ("k", 1), ("k", 2), ("q", 9)], "k string, i int"), "k", "i")
    assert {tuple(r) for r in links.collect()} == {(1, 2), (2, 3)}
    old, new = (spark.createDataFrame(x, "k string, v string") for x in ([("a", None), ("b", "1"), ("c", "1")], [("a", None), ("b", "2"), ("d", "1")]))
    assert {tuple(r) for r in R.difference(old, new, "k", "v").collect()} == {("a", "kept"), ("b", "changed"), ("c", "removed"), ("d", "added")}
    c = R.coverage(spark.createDataFrame([("a", 1), ("a", None)], "g string, v int"), ["v", "gone"], "g")
    assert {tuple(r) for r in c.collect()} == {("a", "v", 50.0), ("a", "gone", 0.0), (None, "v", 50.0), (None, "gone", 0.0)}
    m = R.join_misses({"t": spark.createDataFrame([("a",), (None,), ("z",)], "k string")}, spark.createDataFrame([("a",), (None,)], "k string"))
    assert [tuple(r) for r in m.collect()] == [("t", 3, 1, 1)]


def test_fingerprint_ignores_order_not_repeats(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (2, None)], "i int, s string")
    f = lambda df: R.fingerprint(df, ["i", "s"]).first()
    assert f(a) == f(a.orderBy(F.desc("i")).repartition(3)) and f(a) != f(a.distinct())


def test_hamming_pairs_against_brute_force(spark):
    import random

    rng = random.Random(1)
    codes = [rng.getrandbits(64) for _ in range(60)]
    codes += [c ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for c in codes] + codes[:5]
    df = spark.createDataFrame([(f"{i:03d}", f"{c:016x}") for i, c in enumerate(codes)], "digest string, code string")
    for r in (0, 1, 3):
        want = {(f"{i:03d}", f"{j:03d}") for i in range(len(codes)) for j in range(i + 1, len(codes)) if (codes[i] ^ codes[j]).bit_count() <= r}
        assert {(x.sha_a, x.sha_b) for x in R.hamming_pairs(df, "digest", "code", r).collect()} == want


def test_sampling(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 7).alias("g"))
    a = {r.id for r in S.lowest(df, ["g"], "id", 5).collect()}
    assert len(a) == 35 and a == {r.id for r in S.lowest(df.repartition(9), ["g"], "id", 5, buckets=3).collect()}
    assert sorted(r.i for r in S.positions(df, "id").collect()) == list(range(1000))
    assert [r.id for r in S.stride(df, "id", 4).orderBy("id").collect()] == [0, 250, 500, 750] and S.stride(df, "id", 5000).count() == 1000
    assert {r.g: r.first for r in S.first_of(df, "g", "id", 2).collect()}[3] == [3, 10]
    assert S.lowest(df.limit(0), ["g"], "id", 5).count() == 0 and S.stratified(df.limit(0), "g", "id", 5).count() == 0


def test_packing(spark):
    df = spark.createDataFrame([("a", i, n) for i, n in enumerate([3, 3, 5, 9, 1, 1])] + [("b", 0, 4)], "lane string, i int, n int")
    got = {(r.lane, r.i): r.chunk for r in S.packed(df, "lane", "i", "n", 6).collect()}
    assert [got["a", i] for i in range(6)] == [0, 0, 1, 2, 3, 3] and got["b", 0] == 0
    f = spark.createDataFrame([("c", 0, "0"), ("c", 1, "1"), ("c", 2, None), ("c", 3, "7"), ("d", 0, "0")], "clip string, frame int, code string")
    assert sorted(tuple(r) for r in S.kept_frames(f, "clip", "frame", "code", 1).collect()) == [("c", 0), ("c", 2), ("c", 3), ("d", 0)]


def test_measures(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "x"), ("b", "b"), ("b", "a"), (None, "a")], "t string, g string")
    s = {r.label: r for r in M.class_scores(df, "t", "g").collect()}
    assert set(s) == {"a", "b"} and s["a"].f1 == 0.5 and abs(s["b"].f1 - 2 / 3) < 1e-12  # a guess outside only costs recall
    same = spark.createDataFrame([("a", "a")] * 3, "t string, g string")
    assert M.kappa(same, "t", "g").first().kappa is None
    k = spark.createDataFrame([("y", "y")] * 20 + [("y", "n")] * 5 + [("n", "y")] * 10 + [("n", "n")] * 15, "t string, g string")
    assert M.kappa(k, "t", "g").first().kappa == 0.4
    e = spark.createDataFrame([(1.0, True), (0.0, False)], "c double, r boolean")
    assert M.calibration_error(e, F.col("c"), F.col("r")).first()[0] == 0.0  # the last bin is closed
    r = M.recall_threshold(spark.createDataFrame([(0.9, True), (0.8, False), (0.8, True), (0.1, True)], "s double, p boolean"), "s", "p", 0.6).first()
    assert (r.threshold, r.recall, r.precision) == (0.8, 0.666667, 0.666667)


def test_allocation_traps(spark):
    # ties of deficit go to the last name: val before train before test
    assert A.fill({"a": 1, "b": 1, "c": 1}, {"train": 1 / 3, "val": 1 / 3, "test": 1 / 3}).__len__() == 3
    first = A.order_of({"a": 1, "b": 1, "c": 1}, "0")[0]
    assert A.fill({"a": 1, "b": 1, "c": 1}, {"train": 1 / 3, "val": 1 / 3, "test": 1 / 3})[first] == "val"
    assert set(A.repaired({"a": 9, "b": 1}, {"a": "train", "b": "train"}, {"train": 0.9, "test": 0.1}).values()) == {"train", "test"}
    df = spark.createDataFrame([(None,), ("a",), ("a",)], "g string")
    assert [tuple(r) for r in A.greedy(df, "g", {"train": 1.0}).collect()] == [("a", 2, "train")]
    assert A.greedy(df.limit(0), "g", {"train": 1.0}).count() == 0
    rows = spark.createDataFrame([("a", None), ("a", True), ("b", None), ("c", False)], "g string, x boolean")
    assert [tuple(r) for r in A.held_out(rows, "g", {"rule": F.col("x")}).collect()] == [("a", "rule", 2)]
    known = spark.createDataFrame([("a", "test")], "g string, split string")
    got = {r.g: r.split for r in A.grown(known, rows, "g", {"train": 0.5, "val": 0.5}).collect()}
    assert got["a"] == "test" and set(got) == {"a", "b", "c"}


def test_many_groups_are_dealt_out_by_size(spark, monkeypatch):
    """Beyond the bound every split gets as many groups of each size as one by one."""
    rng = random.Random(6)
    sizes = [rng.choice([1, 1, 1, 2, 5, 40]) for _ in range(120)]
    df = spark.createDataFrame([(f"g{i}",) for i, n in enumerate(sizes) for _ in range(n)] + [(None,)], "g string")
    ratios = {"train": 0.7, "val": 0.15, "test": 0.15}
    tally = lambda rows, c: Counter((r.n, r[c]) for r in rows.collect())
    want = tally(A.greedy(df, "g", ratios), "split"), tally(A.folds(df, "g", 4), "fold")
    monkeypatch.setattr(A, "MAX_GROUPS", 2)
    got = A.greedy(df, "g", ratios)
    assert (tally(got, "split"), tally(A.folds(df, "g", 4), "fold")) == want and got.select("g").distinct().count() == got.count() == 120
    for many in (5000, 40_000):
        lack, own = {"a": 50_000.0, "b": 20_000.0, "c": -10.0}, dict(a=50_000.0, b=20_000.0, c=-10.0)
        monkeypatch.setattr(A, "ONE_BY_ONE", 100)
        quick = A.deal(3, many, lack)
        monkeypatch.setattr(A, "ONE_BY_ONE", 1 << 30)
        assert quick == A.deal(3, many, own) and sum(quick.values()) == many


def test_harmonise(spark):
    nodes = spark.createDataFrame([("r", None), ("a", "r"), ("b", "a"), ("x", "y"), ("y", "x"), ("s", "s")], "node string, parent string")
    c = H.ancestors(nodes, Scratch(spark, "t"))
    assert {(r.node, r.ancestor, r.distance) for r in c.collect()} >= {("b", "r", 2), ("b", "b", 0), ("x", "y", 1)}
    labels = spark.createDataFrame([("b",), ("a",), ("r",), ("q",), (None,)], "label string")
    got = {r.label: (r["class"], r.reason) for r in H.project(labels, c, spark.createDataFrame([("a",)], "t string"), "label", "t").collect()}
    assert got == {"b": ("a", "rolled up"), "a": ("a", "exact"), "r": (None, "coarser"), "q": (None, "outside"), None: (None, "outside")}
    m = H.label_map(spark.createDataFrame([("l", "t")], "l string, t string"), spark.createDataFrame([("l",), ("z",), (None,)], "l string"), "l", "t")
    assert {tuple(r) for r in m.collect()} == {("l", "t", True), ("z", None, False)}


def test_checks(spark):
    df = spark.createDataFrame([(1, None), (1, "a"), (2, "b")], "k int, v string")
    found = Q.together([Q.rule_counts("g", df, {"null": F.col("v").isNull(), "never": F.lit(None).cast("boolean")}), Q.repeated("g", "twice", df, ["k"]), Q.unmatched("h", "lost", df, df.filter("k = 1"), "k")])
    assert {tuple(r) for r in found.collect()} == {("g", "null", 1), ("g", "twice", 1), ("h", "lost", 1)}
    assert {tuple(r) for r in Q.verdict(found, ["g", "h", "i"]).collect()} == {("g", "failed", 2), ("h", "failed", 1), ("i", "passed", 0)}


def events(spark, tmp_path, batches):
    t0 = datetime(2024, 1, 1)
    for n, rows in enumerate(batches):
        df = spark.createDataFrame([(i, t0 + timedelta(minutes=m), u, "view", 1.0) for i, m, u in rows], "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double")
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "events.parquet"))
    return T.follow(spark, str(tmp_path), "events", files_per_trigger=1)


def test_streams_equal_batches(spark, tmp_path):
    s = events(spark, tmp_path, [[(1, 0, 1), (2, 10, 1)], [(3, 100, 1), (1, 0, 1)], [(4, 3000, 2)]])
    b = spark.read.parquet(str(tmp_path / "events.parquet"))
    assert [tuple(r) for r in T.drain(T.counts(s), "update", ["event_type"]).collect()] == [tuple(r) for r in T.counts(b).collect()] == [("view", 5, 5.0)]
    assert sorted(r.event_id for r in T.drain(T.first_seen(s, "9 days")).collect()) == [1, 2, 3, 4]
    assert {(r.user_id, r.n) for r in T.sessions(b).collect()} == {(1, 3), (1, 1), (2, 1)}
    closed = T.drain(T.tumbling(s, "1 minute", "1 hour")).collect()  # append: only windows the watermark has passed
    assert {r.n for r in closed} <= {1, 2, 3} and len(closed) >= 2


def test_map_grows_and_never_moves(spark, tmp_path):
    p = str(tmp_path / "m")
    T.grow_map(spark, spark.createDataFrame([("a", 2), ("a", 1)], "k string, v int"), p, "k", "v")
    T.grow_map(spark, spark.createDataFrame([("a", 0), ("b", 5)], "k string, v int"), p, "k", "v")
    assert {tuple(r) for r in spark.read.parquet(p).collect()} == {("a", 1), ("b", 5)}


def test_haversine(spark):
    d = one(spark, geo.haversine(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0)))
    assert abs(d - math.pi * 6371008.8) < 1e-3


@pytest.mark.parametrize("radius", [0, 1, 4, 8])
def test_near_items_beyond_three_bits(spark, radius):
    rng = random.Random(radius)
    codes = [rng.getrandbits(64) for _ in range(12)] + [0x8000000000000001, (1 << 64) - 1]
    for base in codes[:12]:
        codes += [base ^ sum(1 << k for k in rng.sample(range(64), n)) for n in range(10)]
    rows = [(f"d{i:03d}", f"{c:016x}") for i, c in enumerate(codes)]
    want = {(a, b, (int(x, 16) ^ int(y, 16)).bit_count()) for a, x in rows for b, y in rows if a < b and (int(x, 16) ^ int(y, 16)).bit_count() <= radius}
    df = spark.createDataFrame([*rows, (None, "0" * 16), ("e", None)], "digest string, code string")
    got = [tuple(r) for r in R.near_items(df, "digest", "code", radius).collect()]
    assert set(got) == want and len(got) == len(want) and (radius < 4 or max(w[2] for w in want) == radius)


def test_stratified_allocation_gives_every_stratum_its_ratios(spark):
    ratios = {"train": 0.7, "val": 0.15, "test": 0.15}
    big, low = {f"b{i:02d}": 100 for i in range(20)}, {f"s{i:02d}": 2 for i in range(20)}
    counts = {"big": big, "low": low, "tiny": {"t1": 9, "t2": 1}}
    got = A.fill_strata(counts, ratios)
    for members in (big, low):
        assert {s: sum(got[g] == s for g in members) for s in ratios} == {"train": 14, "val": 3, "test": 3}
    assert got["t1"] == got["t2"] == "train"
    plain = A.fill(big | low | counts["tiny"], ratios)
    assert [sum(plain[g] == s for g in low) for s in ratios] != [14, 3, 3]
    # three groups: by shares 0.6, 0.3, 0.1 alone two go to train; the repair leaves no split empty, and a shared group goes once
    assert set(A.fill_strata({"x": {"a": 98, "b": 1, "c": 1}}, ratios).values()) == set(ratios)
    assert A.fill_strata({"x": {"a": 5, "b": 5, "c": 5}, "y": {"a": 1}}, ratios).keys() == {"a", "b", "c"}
    df = spark.createDataFrame([(k, g) for k, m in counts.items() for g, n in m.items() for _ in range(n)] + [(None, "z"), ("big", None)], "s string, g string")
    assert {r.g: (r.n, r.split) for r in A.stratified(df, "s", "g", ratios).collect()} == {g: (n, got[g]) for m in counts.values() for g, n in m.items()}
    assert A.stratified(df.limit(0), "s", "g", ratios).count() == 0


def test_flipped_codes_are_those_of_flipped_pictures(spark):
    rng = random.Random(4)
    rows = []
    for _ in range(20):
        picture = [rng.sample(range(256), 9) for _ in range(8)]
        of = lambda p: "".join(f"{sum((r[i + 1] > r[i]) << 7 - i for i in range(8)):02x}" for r in p)
        rows.append((of(picture), of([r[::-1] for r in picture]), of(picture[::-1])))
    df = spark.createDataFrame(rows, "c string, h string, v string")
    across, down = K.flipped(F.col("c"))
    assert [tuple(r) for r in df.select("c", across, down).collect()] == rows
    best = K.least_of(F.lit(5), F.lit(3), F.lit(3))
    assert tuple(df.select(*best).first()) == (3, "left-right")


def test_nearest_vectors_cross_labels_and_batches(spark):
    rng = random.Random(6)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(300)]
    rows[7] = (7, [2 * x for x in rows[20][1]])  # the nearest of 20, whatever its label
    df = spark.createDataFrame([*rows, (None, rows[0][1]), (900, None), (901, [0.0] * 8), (902, [float("nan")] * 8), (903, [1.0])], "id bigint, v array<float>").repartition(3)
    cos = lambda a, b: round(sum(x * y for x, y in zip(a, b, strict=True)) / math.hypot(*a) / math.hypot(*b), 5)
    got = R.nearest_vectors(spark, df, "id", "v", F.col("id") % 20 == 0, 4, block=32).collect()
    want = {(q, n): v for q in range(0, 300, 20) for v, n in sorted(((cos(rows[q][1], w), i) for i, w in rows if i != q), reverse=True)[:4]}
    assert {(r.query, r.other) for r in got} == set(want) and (20, 7) in want and len(got) == 60
    assert all(abs(r.cos - want[r.query, r.other]) < 1e-4 for r in got)
    assert R.nearest_vectors(spark, df.limit(0), "id", "v", F.col("id") % 20 == 0, 4).count() == 0
