"""Cross-split overlaps, history and the Hamming join against brute force, with nulls, ties, repeats and empty tables."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.llm import cross_split, hamming, history
from tidemill.session import Scratch

META = "row_id bigint, image_sha256 string, source_id string, batch int, bytes_config string, split string, code string"


def sha(i: int) -> str:
    return f"{i:064x}"


def flip(code: int, n: int, rng: random.Random) -> int:
    for b in rng.sample(range(256), n):
        code ^= 1 << b
    return code


def corpus(n: int, seed: int, hot: float = 0.0) -> list[int]:
    """Codes with planted neighbours at 0 to 30 bits; a share of them repeats one code's first half."""
    rng = random.Random(seed)
    out = [rng.getrandbits(256) for _ in range(n)]
    for i in range(0, n - 1, 3):
        out[i + 1] = flip(out[i], rng.randrange(31), rng)
    for i in range(int(hot * n)):
        out[i] = (out[0] >> 128 << 128) | (out[i] & ((1 << 128) - 1))
    return out


def near(codes: list[int], r: int) -> set[tuple[int, int]]:
    return {(i, j) for i in range(len(codes)) for j in range(i + 1, len(codes)) if (codes[i] ^ codes[j]).bit_count() <= r and codes[i] != codes[j]}


@pytest.mark.parametrize("radius, rows, hot, h", [(24, 1 << 20, 0.0, 0), (24, 100, 0.0, 3), (24, 60, 0.34, 2), (7, 1 << 20, 0.0, 1), (3, 50, 0.5, 0), (1, 1 << 20, 0.0, 0), (0, 40, 0.3, 0)])
def test_matching_is_exact(spark, monkeypatch, radius, rows, hot, h):
    monkeypatch.setattr(hamming, "HOT", 8 if hot else 1 << 11)
    codes = corpus(400, radius, hot)
    rng = random.Random(radius)
    side = [rng.choice([hamming.INDEX, hamming.PROBE, hamming.INDEX + hamming.PROBE]) for _ in codes]
    df = spark.createDataFrame([(i, sha(c), side[i]) for i, c in enumerate(codes)], "id bigint, code string, side int")
    layout, runs = hamming.runs_of(F.col("code"), 64, radius)
    found = hamming.matching(df.select("id", runs.alias("runs"), "side"), layout, len(codes), rows, h)
    got = {(r.a, r.b) for r in found.collect() if codes[r.a] != codes[r.b] and (codes[r.a] ^ codes[r.b]).bit_count() <= radius}
    both = near(codes, radius)
    assert got == {(a, b) for i, j in both for a, b in ((i, j), (j, i)) if side[a] & hamming.INDEX and side[b] & hamming.PROBE}


def test_layout_keeps_the_ring_rule():
    rng = random.Random(5)
    for radius in (0, 1, 3, 7, 12, 24):
        layout, runs = hamming.Layout.ring(64, radius)
        for _ in range(300):
            x = flip(0, radius, rng)
            twice = f"{x:064x}" * 2
            ok = False
            for (at, n), (one, two, three) in zip(runs, layout.bits, strict=True):
                v = int(twice[at : at + n], 16)
                ok |= all((v >> (three - k)).bit_count() <= m for k, m in zip((one, two, three), layout.limits, strict=True))
            assert ok


def test_radius_too_large():
    with pytest.raises(ValueError):
        hamming.Layout.ring(16, 64)


def tables(spark, seed=1):
    rng = random.Random(seed)
    codes = corpus(120, seed)
    meta, ph = [], []
    for i, c in enumerate(codes):
        for _ in range(rng.choice([1, 1, 2])):
            spelled = rng.choice([sha(i), f" SHA256:{sha(i).upper()}", sha(i) + "\t"])
            meta.append((len(meta), spelled, f"s{i % 5}", rng.randrange(4), rng.choice(["images", " Withheld", None, "", "x"]), rng.choice(["train", " Training", "TEST", "val", None, "probe"])))
        ph.append((sha(i), rng.choice([f"{c:064x}", f"0x{c:064X}"])))
        ph.append((sha(i), rng.choice([None, "n/a", "0" * 64, "f" * 64, "12"])))
    meta += [(len(meta), None, "s", 1, "images", "train"), (len(meta) + 1, sha(3), "s", None, "images", None)]
    m = spark.createDataFrame(meta, "row_id bigint, image_sha256 string, source_id string, batch int, bytes_config string, split string")
    # extra columns with names that clash with those used inside
    m = m.withColumns({"digest": F.lit("x"), "lo": F.lit(3), "hi": F.lit("h"), "code": F.lit(1), "id": F.lit(2)})
    p = spark.createDataFrame(ph, "sha256 string, phash string").withColumns({"id": F.lit(1), "digest": F.lit("q"), "code": F.lit("z")})
    return m, p, codes, meta


def test_overlaps_against_brute_force(spark):
    m, p, codes, meta = tables(spark)
    rng = np.random.default_rng(3)
    base = rng.standard_normal((40, 64))
    vec = np.concatenate([base, base + 0.1 * rng.standard_normal((40, 64)), base * 3])
    rows = [(sha(i), [float(x) for x in v]) for i, v in enumerate(vec[:120])] + [(sha(0), None), (sha(1), [0.0] * 64), (sha(2), [float("nan")] * 64), (sha(3), [1.0] * 32), (sha(4), []), (None, [1.0] * 64)]
    e = spark.createDataFrame(rows, "key string, vec array<float>").withColumn("id", F.lit(9))
    got = {(r.sha_a, r.sha_b) for r in cross_split.overlaps(spark, m, p, e).collect()}
    side = {}
    for _, s, _, _, _, split in meta:
        if s:
            k, w = s.strip().lower().split(":")[-1], (split or "").strip().lower()
            side.setdefault(k, set()).add("t" if w in ("train", "training") else "e" if w in ("test", "val") else "-")
    v = np.float32(vec[:120]).astype(float)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    cos = v @ v.T
    want = {(k, k) for k, x in side.items() if {"t", "e"} <= x}
    for i in range(120):
        for j in range(i + 1, 120):
            a, b = side.get(sha(i), set()), side.get(sha(j), set())
            if ((codes[i] ^ codes[j]).bit_count() <= 24 or cos[i, j] >= 0.95) and (("t" in a and "e" in b) or ("t" in b and "e" in a)):
                want.add((sha(i), sha(j)))
    assert got == want and len(want) > 20
    n = cross_split.overlap_report(spark, m, p, e)
    report = {(r.split, r.source_id): (r.images, r.exact, r.near) for r in n.collect()}
    train = {k for k, x in side.items() if "t" in x}
    close = lambda i, j: (codes[i] ^ codes[j]).bit_count() <= 24 or cos[i, j] >= 0.95
    images = {}
    for _, s, source, _, _, split in meta:
        w = (split or "").strip().lower()
        if s and w in ("test", "val"):
            k = s.strip().lower().split(":")[-1]
            exact, partner = k in train, any(close(int(k, 16), int(t, 16)) for t in train if t != k)
            if exact or partner:
                images.setdefault((w, source), {})[k] = (exact, partner)
    assert report == {g: (len(x), sum(e for e, _ in x.values()), sum(p for _, p in x.values())) for g, x in images.items()}


def test_report_counts_only_train_copies(spark):
    """A is in train and in test, B in test only and near A: A has no near copy in train, B has one."""
    a, b = random.Random(1).getrandbits(256), 0
    b = a ^ 0b111
    m = spark.createDataFrame([(1, sha(1), "s", "train"), (2, sha(1), "s", "test"), (3, sha(2), "s", "test")], "row_id bigint, image_sha256 string, source_id string, split string")
    p = spark.createDataFrame([(sha(1), f"{a:064x}"), (sha(2), f"{b:064x}")], "sha256 string, phash string")
    e = spark.createDataFrame([], "key string, vec array<float>")
    assert [tuple(r) for r in cross_split.overlap_report(spark, m, p, e).collect()] == [("test", "s", 2, 1, 1)]


def history_truth(meta, codes):
    rows = [(r, s.strip().lower().split(":")[-1], b, (c or "").strip().lower() not in ("", "withheld")) for r, s, _, b, c, _ in meta if s and b is not None]
    out = set()
    for r1, k1, b1, a1 in rows:
        for r2, k2, b2, _ in rows:
            if b1 < b2 and a1 and (k1 == k2 or (codes[int(k1, 16)] ^ codes[int(k2, 16)]).bit_count() <= 24):
                out.add((min(r1, r2), max(r1, r2)))
    return out


def test_backfill_and_increments_agree(spark):
    m, p, codes, meta = tables(spark, 2)
    want = history_truth(meta, codes)
    assert {tuple(r) for r in history.backfill(spark, m, p).collect()} == want and len(want) > 20
    rows = history.deliveries(m, p)
    path = f"{Scratch(spark, 'test').root}/h"
    got = set()
    for b in range(4):
        h = history.History(spark, path)  # opened again for each batch
        batch = rows.filter(F.col("batch") == b)
        if b:
            got |= {tuple(r) for r in h.check(batch).collect()}
        h.append(batch)
    assert got == want
    last = max(b for _, _, _, b, _, _ in meta if b is not None)
    late = {r for r, _, _, b, _, _ in meta if b == last}
    assert {tuple(r) for r in history.last_batch(spark, m, p).collect()} == {x for x in want if set(x) & late}


def test_probes_that_are_not_broadcast(spark, monkeypatch):
    """Beyond the bound the probes are shuffled to the keys, which stay in their buckets; groups larger than a cell are cut."""
    m, p, codes, meta = tables(spark, 5)
    monkeypatch.setattr(history, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(history, "CELL_ROWS", 40)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert {tuple(r) for r in history.backfill(spark, m, p).collect()} == history_truth(meta, codes)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_empty_tables(spark):
    m, p, _, _ = tables(spark)
    e = spark.createDataFrame([], "key string, vec array<float>")
    assert cross_split.overlaps(spark, m.limit(0), p.limit(0), e).count() == 0
    assert history.backfill(spark, m.limit(0), p.limit(0)).count() == 0
    assert history.backfill(spark, m, p.limit(0)).count() > 0  # equal digests need no code
