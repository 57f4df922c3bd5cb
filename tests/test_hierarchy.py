"""Hierarchies against a walk up every node."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidemill.operators import hierarchy as H

SCHEMA = "kind string, key string, name string, parent string, rank string, aphia_id bigint, taxonomy_version string"


def table(spark, parents, extra=()):
    rows = [("node", k, None, p, "r", 1, "1.0") for k, p in parents.items()]
    return spark.createDataFrame(rows + list(extra), SCHEMA).withColumns({"node": F.lit(1), "size": F.lit(2), "root": F.lit("z")})


def walk(parents):
    out = {}
    for k in parents:
        path, at = [k], k
        while parents.get(at) in parents and parents[at] is not None:
            at = parents[at]
            if at in path:
                break
            path.append(at)
        top = parents.get(at)
        if top in parents and top is not None and at in path[:-1] or (top == at):
            ring, x = [], at
            while x not in ring:
                ring.append(x)
                x = parents[x]
            out[k] = (min(ring), -1, None)
        else:
            out[k] = (at, len(path) - 1, " > ".join(reversed(path)))
    return out


def shapes():
    rng = random.Random(3)
    yield "chain", {f"n{i:04d}": f"n{i - 1:04d}" if i else None for i in range(300)}
    yield "star", {"hub": None} | {f"k{i}": "hub" for i in range(200)}
    yield "random", {f"{i}": f"{rng.randrange(i)}" if i > 3 else None for i in range(300)}
    yield "broom", {f"n{i:03d}": f"n{i - 1:03d}" if i else None for i in range(60)} | {f"m{i:03d}": f"n{i % 60:03d}" for i in range(100)}
    yield "cycles", {"a": "b", "b": "c", "c": "a", "t1": "a", "t2": "t1", "t3": "t2", "s": "s", "u": "s", "root": "", "x": "root", "lost": "nowhere"} | {f"l{i}": f"l{(i + 1) % 37}" for i in range(37)}


@pytest.mark.parametrize("name, parents", list(shapes()))
def test_shapes(spark, name, parents):
    parents = {k: p or None for k, p in parents.items()}
    want = walk(parents)
    got = {r.node_key: r for r in H.paths(spark, table(spark, parents)).collect()}
    assert {k: (r.root_key, r.depth, r.path) for k, r in got.items()} == want
    under = {k: {x for x, r in want.items() if r[2] and f" > {k} > " in f" > {r[2]} > "} for k, r in want.items() if r[1] >= 0}
    for k, r in got.items():
        if r.depth >= 0:
            assert {x for x, s in got.items() if s.depth >= 0 and s.root_key == r.root_key and r["first"] <= s["first"] <= r["last"]} == under[k]
    pairs = [(r.ancestor, r.descendant, r.steps) for r in H.descendants(spark, table(spark, parents)).collect()]
    levels = {k: want[k][1] for k in want}
    assert len(pairs) == len(set(pairs)) and {p[:2] for p in pairs} == {(k, x) for k, u in under.items() for x in u if x != k}
    assert all(n == levels[x] - levels[k] for k, x, n in pairs)
    assert {r.node_key: (r.root_key, r.depth) for r in H.hierarchy(spark, table(spark, parents)).collect()} == {k: v[:2] for k, v in want.items()}


def test_versions_spellings_and_nulls(spark):
    rows = [
        ("node", " A ", None, None, "Genus", 1, "3.9.0"), ("node", "a", None, "b", "genus", 1, "3.10.0"), ("node", "B", None, " ", None, None, "3.2"), ("node", "b", None, "a", None, None, None),
        ("edge", "c", None, "a", None, None, "9"), ("node", None, None, "a", None, None, "1"), ("node", " ", None, "a", None, None, "1"), ("node", "d", None, "c", "x", None, "1"), ("node", "b", None, " ", None, None, "3.2"),
    ]
    got = {r.node_key: (r.root_key, r.depth, r.ranks) for r in H.paths(spark, spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {"a": ("b", 1, "- > genus"), "b": ("b", 0, "-"), "d": ("d", 0, "x")}


def test_empty(spark):
    assert H.hierarchy(spark, spark.createDataFrame([], SCHEMA)).count() == 0 and H.paths(spark, spark.createDataFrame([], SCHEMA)).count() == 0
    assert H.descendants(spark, spark.createDataFrame([], SCHEMA)).count() == 0
