"""Resolution operators against plain Python."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidemill.operators import curate as K
from tidemill.operators import resolve as V


def sequential(edges, safe):
    live = {frozenset(e) for e in edges if None not in e and e[0] != e[1] and not (e[0] in safe and e[1] in safe)}
    out = set()
    while live:
        n = {}
        for e in live:
            for v in e:
                n[v] = n.get(v, 0) + 1
        v = min((x for x in n if x not in safe), key=lambda x: (-n[x], x))
        out.add(v)
        live = {e for e in live if v not in e}
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_greedy_exclusion_is_the_sequential_rule(spark, seed):
    rng = random.Random(seed)
    edges = [(f"{rng.randrange(60):02d}", f"{rng.randrange(60):02d}") for _ in range(120)] + [("hub", f"{i:02d}") for i in range(30)] + [(None, "x"), ("y", "y")]
    safe = {f"{i:02d}" for i in range(0, 60, 7)}
    df = spark.createDataFrame(edges, "a string, b string").withColumn("n", F.lit(1))
    assert {r.v for r in V.greedy_exclusion(spark, df, spark.createDataFrame([(s,) for s in safe], "v string")).collect()} == sequential(edges, safe)
    assert {r.v for r in V.greedy_exclusion(spark, df).collect()} == sequential(edges, set())
    assert V.greedy_exclusion(spark, df.limit(0)).count() == 0


def test_best_match_and_names(spark):
    left = spark.createDataFrame([(1, "a", "x"), (2, "a", None), (3, None, None), (4, "q", "x")], "id int, s string, l string")
    right = spark.createDataFrame([("a", "x", 9), ("a", "x", 7), ("a", "y", 5)], "s string, l string, m int")
    assert {(r.id, r.m, r.level) for r in V.best_match(left, right, [["s", "l"], ["s"]], "m").collect()} == {(1, 7, 1), (2, 5, 2), (3, None, None), (4, None, None)}
    pool = spark.createDataFrame([("Ray ", "k2", True), ("ray", "k1", False), ("eel", "k3", None)], "name string, key string, ok boolean")
    got = {r.name: (r.key, r.matches) for r in V.resolved_names(spark.createDataFrame([("RAY",), ("eel",), ("cod",), (None,)], "name string"), pool, "name", "key", F.col("ok"), F.lit(False)).collect()}
    assert got == {"RAY": ("k2", 2), "eel": ("k3", 1), "cod": (None, 0), None: (None, 0)}


@pytest.mark.parametrize("text, want", [
    ("Which?\nA) reef\nB) sand\nC) mud", ["reef", "sand", "mud"]), ("A. reef\nC. mud", []), ("A) plan B is C) fine B) sand", ["plan B is C) fine", "sand"]), ("A) only", []), ("", []), (None, []), ("no options", []),
])
def test_choices(text, want):
    assert V.choices(text) == want


def test_choices_frame_and_html(spark):
    df = spark.createDataFrame([(1, "A) x\nB) y"), (2, None)], "k int, t string")
    assert {r.k: r.options for r in V.with_choices(df, "k", "t").collect()} == {1: ["x", "y"], 2: []}
    page = "<table><TR><th>Site</th><td class='x'>A&nbsp;<b>1</b></td></TR><tr><td></td></tr></table>"
    assert spark.createDataFrame([(page,), (None,)], "h string").select(V.html_rows(F.col("h"))).collect()[0][0] == [["Site", "A 1"], [""]]


def test_curate(spark, tmp_path):
    s = spark.createDataFrame([("a", ["x"], ["global"], 5), ("b", None, ["q"], None)], "k string, p array<string>, r array<string>, n int")
    got = {r.k: (r.match, r.reasons) for r in K.facets(s, {"p": "x"}, {"r": ["pacific"]}, at_least={"n": 1}).collect()}
    assert got == {"a": (True, []), "b": (False, ["p: no x", "r: none of pacific", "n: below 1"])}
    assert all(r.match for r in K.facets(s).collect())
    c = spark.createDataFrame([("8040201008040201",), ("ff00000000000001",)], "c string").select(K.mirrored(F.col("c"))).collect()
    assert [r[0] for r in c] == ["0102040810204080", "ff00000000000080"]
    p = spark.createDataFrame([("g", 0.9, True), ("g", 0.8, False), ("g", 0.7, True), ("h", 0.5, False), ("g", None, True)], "g string, s double, h boolean")
    ap = {r.g: r.ap for r in K.average_precision(p, "g", "s", "h").collect()}
    assert set(ap) == {"g"} and abs(ap["g"] - (51 * 1 + 50 * 2 / 3) / 101) < 1e-9
    seen = []
    def compute(keys):
        seen.append(sorted(r.k for r in keys.collect()))
        return keys.withColumn("v", F.upper("k"))

    want = lambda *ks: spark.createDataFrame([(k,) for k in ks], "k string")
    K.cached(spark, str(tmp_path / "c"), want("a", "b", None), "k", compute)
    assert {r.v for r in K.cached(spark, str(tmp_path / "c"), want("b", "c"), "k", compute).collect()} == {"B", "C"} and seen == [["a", "b"], ["c"]]
