"""Similarity join of bit codes by segments: an index side, and a side that probes it.

A code is cut into ``m`` segments. If two codes differ in at most ``r`` bits, then on the ring of segments there is one
from which on every run of ``l`` segments holds at most ``r*l/m`` differences (cycle lemma). So two codes can only match
if, for some segment, the segment itself differs in at most ``r//m`` bits (0 or 1 here), and the runs of two and three
segments that begin with it stay below their limits. Per code and segment 17 bytes are shuffled: the 60 bits of the run, an
id and the side, packed per task and group into one row. Inside a group the segment is a table index of the index side; the
probing side looks itself and its one-bit neighbours up, and the runs leave practically only true matches, which are verified
on the whole codes by the caller. Codes of one side never meet each other.

No pair within ``r`` bits is lost, whatever the data; there is no cap.

Groups: the leading ``h`` bits of the segment are part of the group key, so that groups hold about ``GROUP_ROWS`` codes and
there are more groups than cores (a probe also visits the groups whose leading bits differ in one bit). A group that is still
larger is cut into cells, in which each piece of one side meets each piece of the other. Where more than ``HOT`` codes share
one value of a segment, the key is extended: the rest of the run is cut so that in every pair below the limit one part
differs in at most one bit, and these parts are looked up in turn.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.session import Scratch

#: Codes of a group aimed at, and codes of one side in memory at once (25 bytes each).
GROUP_ROWS, CELL_ROWS = 1 << 16, 1 << 20
#: Codes of one segment value from which on the key is extended.
HOT = 1 << 11
#: Ids of matched codes are broadcast up to this many (8 bytes each), to read only their rows; beyond it they are joined.
BROADCAST_IDS = 1 << 19
#: Candidate pairs expanded at once inside a group; codes packed at once in a task.
CHUNK, PACK_ROWS = 1 << 19, 1 << 16
#: A run holds at most so many bits, to fit a bigint.
RUN_BITS = 60
#: Bits of a segment up to which its values are an array index (else they are searched for in sorted order).
TABLE_BITS = 22
#: Sides of a code, as bits.
INDEX, PROBE = 1, 2

class Layout:
    """How segments lie in a run: bits of the first segment, of two and of three, and their limits."""

    def __init__(self, bits: list[int], limits: tuple[int, int, int]):
        self.bits, self.limits = bits, limits

    @classmethod
    def ring(cls, digits: int, radius: int) -> tuple[Layout, list[tuple[int, int]]]:
        """Layout for codes of so many hex digits, and (first digit, digits) of each run in the doubled code."""
        m = radius // 2 + 1
        if m > digits:
            raise ValueError(f"radius {radius} is too large for {digits} hex digits")
        sizes = [digits // m + (i < digits % m) for i in range(m)]
        starts = np.cumsum([0, *sizes]).tolist()
        limits = tuple(radius * n // m for n in (1, 2, 3))
        bits, runs = [], []
        for i in range(m):
            own = [4 * sizes[(i + j) % m] for j in range(min(3, m))]
            ends = [min(RUN_BITS, sum(own[: j + 1])) for j in range(len(own))]
            ends += [ends[-1]] * (3 - len(ends))
            bits.append(tuple(ends))
            runs.append((starts[i], ends[-1] // 4))
        return cls(bits, limits), runs


def runs_of(code: Column, digits: int, radius: int) -> tuple[Layout, Column]:
    """The layout, and an array with the run (a bigint) of every segment of a hex code."""
    layout, runs = Layout.ring(digits, radius)
    twice = F.concat(code, code)
    return layout, F.array(*(F.conv(F.substring(twice, at + 1, n), 16, 10).cast("bigint") for at, n in runs))


def _expand(left: np.ndarray, begin: np.ndarray, count: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(left row, right position) of every candidate, about CHUNK at a time."""
    keep = count > 0
    left, begin, count = left[keep], begin[keep], count[keep]
    total = np.cumsum(count)
    at = 0
    while at < len(left):
        base = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, base + CHUNK, "right")))
        c, b, rows = count[at:to], begin[at:to], left[at:to]
        if len(c) == 1 and c[0] > CHUNK:
            for k in range(0, int(c[0]), CHUNK):
                many = min(CHUNK, int(c[0]) - k)
                yield np.repeat(rows, many), b[0] + k + np.arange(many)
        else:
            first = np.repeat(np.cumsum(c) - c, c)
            yield np.repeat(rows, c), np.arange(int(c.sum())) - first + np.repeat(b, c)
        at = to


class _Index:
    """Rows by the value of a key of so many bits: the rows of a value are order[begin : begin + count]."""

    def __init__(self, key: np.ndarray, bits: int):
        self.order = np.argsort(key, kind="stable")
        if bits <= TABLE_BITS:
            self.keys, self.start = None, np.zeros((1 << bits) + 1, np.int64)
            np.cumsum(np.bincount(key, minlength=1 << bits), out=self.start[1:])
        else:
            self.keys = key[self.order]

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.keys is None:
            return self.start[wanted], self.start[wanted + 1] - self.start[wanted]
        begin = np.searchsorted(self.keys, wanted, "left")
        return begin, np.searchsorted(self.keys, wanted, "right") - begin


def _within_hot(index: np.ndarray, probe: np.ndarray, bits: int, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(position in index, position in probe) of pairs whose ``bits`` low bits may differ in at most ``most``: of most // 2 + 1
    parts one differs in at most one bit. A pair may come several times."""
    parts = min(most // 2 + 1, max(1, bits))
    at = 0
    for i in range(parts):
        n = bits // parts + (i < bits % parts)
        part = lambda v: (v >> at) & ((1 << n) - 1)  # noqa: B023, E731
        table, own = _Index(part(index), n), part(probe)
        for flip in [0, *(1 << b for b in range(n))] if most else [0]:
            begin, count = table.find(own ^ flip)
            for p, spot in _expand(np.arange(len(probe)), begin, count):
                yield table.order[spot], p
        at += n


def match(index: tuple[np.ndarray, np.ndarray], probe: tuple[np.ndarray, np.ndarray], layout: Layout, seg: int, prefix: int, h: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(id of the index side, id of the probing side) of the pairs of one group that pass every limit. index, probe: ids and
    runs; probes whose leading ``h`` bits are not the group's ``prefix`` are visitors, which have used their one difference."""
    (ids, run), (other, want) = index, probe
    if not len(ids) or not len(other):
        return
    one, two, three = layout.bits[seg]
    most1, most2, most3 = layout.limits
    free = one - h
    low = (1 << free) - 1
    key = run >> (three - one)
    table = _Index(key & low, free)
    order = np.argsort(want, kind="stable")  # neighbours in the table are looked up one after the other
    other, want = other[order], want[order]
    asked = want >> (three - one)
    home = (asked >> free) == prefix

    def passing(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = run[a] ^ want[b]
        ok = np.bitwise_count(x) <= most3
        a, b, x = a[ok], b[ok], x[ok]
        ok = np.bitwise_count(x >> (three - two)) <= most2
        return ids[a[ok]], other[b[ok]]

    for flip in [0, *(1 << bit for bit in range(free))] if most1 else [0]:
        rows = np.flatnonzero(home) if flip else np.arange(len(other))
        begin, count = table.find((asked[rows] & low) ^ flip)
        hot = count > HOT
        for p, spot in _expand(rows[~hot], begin[~hot], count[~hot]):
            a, b = passing(table.order[spot], p)
            if len(a):
                yield a, b
        spots = np.flatnonzero(hot)
        spots = spots[np.argsort(begin[spots], kind="stable")]
        for mine in np.split(spots, np.flatnonzero(np.diff(begin[spots])) + 1) if len(spots) else ():
            at = begin[mine[0]]
            members, probes = table.order[at : at + count[mine[0]]], rows[mine]
            for i, j in _within_hot(run[members], want[probes], three - one, most3):
                a, b = passing(members[i], probes[j])
                if len(a):
                    yield a, b


def packed(codes: DataFrame, layout: Layout, h: int, cut: dict[int, tuple[int, int]] | None = None) -> DataFrame:
    """(grp, cell, body): the codes (id, runs, side) of each segment and prefix, packed per task. ``cut`` names groups of which
    the index side is cut into the first, the probing side into the second number of pieces."""
    shared = codes.sparkSession.sparkContext.broadcast(cut or {})
    schema = pa.schema([("grp", pa.int64()), ("cell", pa.int32()), ("body", pa.binary())])

    def send(part: pa.Table) -> Iterator[pa.RecordBatch]:
        ids, side = (part.column(c).to_numpy() for c in ("id", "side"))
        runs = part.column("runs").combine_chunks().flatten().to_numpy().reshape(len(part), -1)
        for seg, (one, _, three) in enumerate(layout.bits):
            run = runs[:, seg]
            prefix = run >> (three - h)
            rows, group, flag = [np.arange(len(ids))], [prefix], [side]
            if layout.limits[0]:
                asks = np.flatnonzero(side & PROBE)
                for bit in range(h):
                    rows.append(asks)
                    group.append(prefix[asks] ^ (1 << bit))
                    flag.append(np.full(len(asks), PROBE, side.dtype))
            row, at, flag = np.concatenate(rows), np.concatenate(group), np.concatenate(flag)
            order = np.argsort(at, kind="stable")
            row, at, flag = row[order], at[order], flag[order]
            edges = np.r_[np.flatnonzero(np.r_[True, at[1:] != at[:-1]]), len(at)]
            out: tuple[list, list, list] = ([], [], [])
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                grp = (seg << h) | int(at[lo])
                r, f = row[lo:hi], flag[lo:hi]
                left, right = shared.value.get(grp, (1, 1))
                for p in range(left):
                    for q in range(right):
                        keep = f & np.where(ids[r] % left == p, INDEX, 0) | f & np.where(ids[r] // left % right == q, PROBE, 0)
                        x = np.flatnonzero(keep)
                        if len(x):
                            for c, v in zip(out, (grp, p * right + q, pack(ids[r[x]], run[r[x]], keep[x])), strict=True):
                                c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(out, schema, strict=True)], schema=schema)

    def run_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for b in batches:
            held.append(b)
            rows += len(b)
            if rows >= PACK_ROWS:
                yield from send(pa.Table.from_batches(held))
                held, rows = [], 0
        if rows:
            yield from send(pa.Table.from_batches(held))

    return codes.select("id", "runs", F.col("side").cast("int").alias("side")).mapInArrow(run_all, "grp bigint, cell int, body binary")


def pack(ids: np.ndarray, run: np.ndarray, side: np.ndarray) -> bytes:
    return ids.astype(np.int64).tobytes() + run.astype(np.int64).tobytes() + side.astype(np.uint8).tobytes()


def unpack(bodies: list[bytes]) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """(ids, runs) of the index side and of the probing side."""
    ids, run, side = [], [], []
    for b in bodies:
        n = len(b) // 17
        ids.append(np.frombuffer(b, np.int64, n))
        run.append(np.frombuffer(b, np.int64, n, 8 * n))
        side.append(np.frombuffer(b, np.uint8, n, 16 * n))
    i, r, s = np.concatenate(ids), np.concatenate(run), np.concatenate(side)
    left, right = (s & INDEX) > 0, (s & PROBE) > 0
    return (i[left], r[left]), (i[right], r[right])


def leading_bits(layout: Layout, n: int, cores: int) -> int:
    """Bits of a segment in the group key: groups of about GROUP_ROWS of n codes, and (of large inputs) two for each core."""
    for_size = math.log2(max(1, n) / GROUP_ROWS) if n else 0
    for_cores = math.log2(2 * cores / len(layout.bits)) if n > GROUP_ROWS // 8 else 0
    return max(0, min(16, math.ceil(max(for_size, for_cores)), *(b[0] - 1 for b in layout.bits)))


def matching(codes: DataFrame, layout: Layout, n: int, cell_rows: int = CELL_ROWS, h: int | None = None) -> DataFrame:
    """Pairs (a, b) of ids, a of the index side and b of the probing side, that pass the limits of some segment; verify them
    on the codes. A code on both sides is paired with itself.

    codes: id bigint, runs array<bigint> (one run per segment), side int (INDEX, PROBE or both added); n: how many they are.
    """
    h = leading_bits(layout, n, codes.sparkSession.sparkContext.defaultParallelism) if h is None else h
    cut = {}
    if n > cell_rows:
        # how many codes each group holds: segments times 2**h numbers
        tops = F.array(*(F.lit(b[2] - h) for b in layout.bits))
        spread = codes.select("side", F.posexplode("runs").alias("seg", "run"))
        grp = F.col("seg").cast("bigint") * (1 << h) + F.call_function("shiftright", "run", F.element_at(tops, F.col("seg") + 1))
        size = lambda bit: F.count_if(F.col("side").bitwiseAND(F.lit(bit)) > 0)
        sizes = spread.groupBy(grp.alias("grp")).agg(size(INDEX).alias("i"), size(PROBE).alias("p"))
        held = {r["grp"]: (r["i"], r["p"]) for r in sizes.toLocalIterator()}
        around = lambda g: sum(held.get(g ^ (1 << b), (0, 0))[1] for b in range(h)) if layout.limits[0] else 0
        cut = {g: (-(-i // cell_rows) or 1, -(-(p + around(g)) // cell_rows) or 1) for g, (i, p) in held.items()}
        cut = {g: c for g, c in cut.items() if c != (1, 1)}

    def join(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bodies = [x for b in batches for x in b.column("body").to_pylist()]
        index, probe = unpack(bodies)
        grp = key[0].as_py()
        for a, b in match(index, probe, layout, grp >> h, grp & ((1 << h) - 1), h):  # pairs leave chunk by chunk
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    found = packed(codes, layout, h, cut).groupBy("grp", "cell").applyInArrow(join, "a bigint, b bigint")
    return found.distinct()


def touched(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """The rows whose id is in some pair, so that verification doesn't move the rest. pairs: a written table (a, b)."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    few = 2 * pairs.count() <= BROADCAST_IDS
    return rows.join(F.broadcast(ids) if few else ids, "id", "left_semi")


def verified(rows: DataFrame, pairs: DataFrame, scratch: Scratch) -> DataFrame:
    """Every pair of rows (as a.*, b.*) whose ids are a pair."""
    pairs = scratch.keep(pairs)
    own = touched(rows, pairs)
    p, a, b = pairs.alias("p"), own.alias("a"), own.alias("b")
    return p.join(a, F.col("p.a") == F.col("a.id")).join(b, F.col("p.b") == F.col("b.id"))
