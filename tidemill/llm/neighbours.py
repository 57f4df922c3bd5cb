"""Problem 5: the most similar vectors for every vector, by cross-polytope hashing.

A unit vector is turned by pseudo-rotations (random signs, then the fast Hadamard transform, three times) and hashed to
the nearest signed axis: one of 2*d values per rotation. A table is one such hash, or two or three of them joined, chosen
from the number of vectors so that a bucket holds at most about ``AIM`` (``depth``). A vector lies in its own bucket and
visits every bucket whose axes fall behind its best ones by no more than ``REACH`` in all: a vector halfway between two axes
visits both, one on an axis visits nobody. Pairs count both ways. More joined hashes need more tables; measured on random
pairs of 64 numbers, the share of pairs that meet in some bucket, and the buckets a vector enters:

    depth   vectors up to   tables   buckets entered   cosine 0.85   0.90    0.95
    1       2.1 million     3        9                 0.996         0.999   1.000
    2       268 million     5        41                0.985         0.998   1.000
    3       34 billion      10       198               0.990         1.000   1.000

Vectors travel as 16-bit fixed-point numbers, packed per task and bucket into one row. Inside a bucket all inner products are
one blocked matrix product, which collects candidates; these are reranked by the exact cosine of the vectors as given.

Equal directions are one row until the end (copies would fill each other's lists): of each only the k+1 smallest keys can
be among anyone's k nearest, so hot groups of copies cost one row and no pairs. A bucket that is still larger than
``BUCKET_ROWS`` is cut into pieces of which every two meet in one cell: nothing is dropped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.functions.identity import digest
from tidemill.llm.cross_split import cosine, usable_vector
from tidemill.session import Scratch

#: Tables by the number of joined hashes.
TABLES = {1: 3, 2: 5, 3: 10}
#: How far (root of the summed squares, times the root of the dimension) a visited bucket's axes may fall behind the best.
REACH = 0.48
#: Axes looked at per hash; more than these are within REACH only in vectors without any direction among the axes.
AXES = 16
#: Vectors of a bucket aimed at; rows (visitors too) of a bucket that are multiplied in one cell.
AIM, BUCKET_ROWS = 1 << 14, 1 << 17
#: Vectors packed at once in a task.
PACK_ROWS = 1 << 15
#: Candidates kept beyond k until the exact cosine has ranked them.
SLACK = 3
#: Units of the fixed-point form, and how much an inner product of two such vectors of 64 numbers may be off.
UNITS, OFF = 32767, 3e-4
#: Ids broadcast at most (8 to 80 bytes each); beyond it they are joined.
BROADCAST_IDS = 1 << 18


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows (their length a power of two), scaled to keep lengths."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], 2)
        h *= 2
    return x.reshape(n, d) / np.sqrt(np.float32(d))


def rotate(x: np.ndarray, signs: np.ndarray) -> np.ndarray:
    for s in signs:
        x = hadamard(x * s)
    return x


def axes(x: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The n nearest signed axes of each row, best first, and how far each falls behind the best."""
    both = np.concatenate([x, -x], 1)
    n = min(n, both.shape[1])
    top = np.argpartition(-both, n - 1, axis=1)[:, :n]
    value = np.take_along_axis(both, top, 1)
    order = np.argsort(-value, axis=1, kind="stable")
    top, value = np.take_along_axis(top, order, 1), np.take_along_axis(value, order, 1)
    return top, value[:, :1] - value


def buckets(v: np.ndarray, table: int, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, home) of every bucket that the rows enter in a table; home says that it is the row's own."""
    d = 1 << max(1, v.shape[1] - 1).bit_length()
    if d > v.shape[1]:
        v = np.concatenate([v, np.zeros((len(v), d - v.shape[1]), v.dtype)], 1)
    signs = np.random.default_rng([77, table]).choice(np.array([-1, 1], np.float32), (depth, 3, d))
    row, number, cost, home = np.arange(len(v)), np.zeros(len(v), np.int64), np.zeros(len(v)), np.ones(len(v), bool)
    for s in signs:
        best, behind = axes(rotate(v, s), AXES)
        total = cost[:, None] + behind[row].astype(float) ** 2
        at, which = np.nonzero(total <= REACH * REACH / v.shape[1])
        number = number[at] * (2 * d) + best[row[at], which]
        cost, home, row = total[at, which], home[at] & (which == 0), row[at]
    return row, number, home


def _top(score: np.ndarray, k: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k largest of each row that are at least ``least``."""
    good = score >= least
    many = good.sum(1)
    row, at = np.nonzero(good & (many <= k)[:, None])
    over = np.flatnonzero(many > k)
    if len(over):
        part = np.argpartition(-score[over], k - 1, axis=1)[:, :k]
        row, at = np.concatenate([row, np.repeat(over, k)]), np.concatenate([at, part.ravel()])
    return row, at


def _bucket(bodies: list[bytes], width: int, pieces: int, split: bool, k: int, least: float) -> Iterator[pa.RecordBatch]:
    """The k best partners within one cell: of all rows among those at home, and of those at home among the visitors."""
    ident, home, code = (np.concatenate(x) for x in zip(*(_unpack(b, width) for b in bodies), strict=True))
    v = code.astype(np.float32) / np.float32(UNITS)
    piece = ident % pieces
    base, away = np.flatnonzero(home), np.flatnonzero(~home)
    for left, right in ((np.arange(len(v)), base), (base, away)):
        step = max(16, (1 << 22) // max(1, len(right)))
        for at in range(0, len(left) if len(right) else 0, step):
            mine = left[at : at + step]
            score = v[mine] @ v[right].T
            if split:
                score[piece[mine, None] == piece[None, right]] = -2
            r, c = _top(score, k + 1, least)  # a row is once in a cell, so that it can only meet itself once
            other = ident[mine[r]] != ident[right[c]]
            r, c = r[other], c[other]
            if len(r):
                yield pa.RecordBatch.from_arrays([pa.array(ident[mine[r]]), pa.array(ident[right[c]]), pa.array(score[r, c])], ["q", "n", "s"])


def _packed(ident: np.ndarray, home: np.ndarray, code: np.ndarray) -> bytes:
    return ident.astype(np.int64).tobytes() + code.tobytes() + home.tobytes()


def _unpack(body: bytes, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(body) // (9 + 2 * width)
    code = np.frombuffer(body, np.int16, n * width, 8 * n).reshape(n, width)
    return np.frombuffer(body, np.int64, n), np.frombuffer(body, bool, n, (8 + 2 * width) * n), code


def _semi(rows: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    """Rows whose key is among the ids (a written table); broadcast only up to BROADCAST_IDS of them."""
    return rows.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, on, "left_semi")


def _hashed(spark: SparkSession, vectors: DataFrame, size: int, depth: int, scratch: Scratch) -> DataFrame:
    """(key, id, code, cells) of every usable vector: cells holds the buckets of all tables, negative (-1 - bucket) where it
    visits; id is the same for equal directions."""
    tables = TABLES[depth]

    def unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column("vec").flatten().to_numpy().reshape(len(b), -1).astype(np.float64)
            v = v / np.abs(v).max(1, keepdims=True)
            v = np.round(v / np.linalg.norm(v, axis=1, keepdims=True) * UNITS).astype(np.int16)
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array([x.tobytes() for x in v], pa.binary())], ["key", "code"])

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            v = np.frombuffer(b"".join(b.column("code").to_pylist()), np.int16).reshape(len(b), -1).astype(np.float32) / np.float32(UNITS)
            v /= np.linalg.norm(v, axis=1, keepdims=True)
            row, cell = [], []
            for t in range(tables):
                r, number, home = buckets(v, t, depth)
                number = number * tables + t
                row.append(r)
                cell.append(np.where(home, number, -1 - number))
            row, cell = np.concatenate(row), np.concatenate(cell)
            order = np.argsort(row, kind="stable")
            at = np.zeros(len(b) + 1, np.int32)
            np.cumsum(np.bincount(row, minlength=len(b)), out=at[1:])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(at, cell[order])], ["key", "id", "code", "cells"])

    usable = vectors.filter(F.col("key").isNotNull() & usable_vector(F.col("vec"), size)).select("key", "vec")
    units = usable.mapInArrow(unit, "key string, code binary").groupBy("key").agg(F.max("code").alias("code"))
    units = units.select("key", F.xxhash64("code").alias("id"), "code")
    return scratch.keep(units.mapInArrow(enter, "key string, id bigint, code binary, cells array<bigint>"))


def _candidates(spark: SparkSession, reps: DataFrame, n: int, size: int, k: int, least: float, scratch: Scratch) -> DataFrame:
    """(q, n): the best k + SLACK partners found of every direction. reps: id, code, cells; a written table or cheap to read."""
    hot: dict[int, int] = {}
    if n > BUCKET_ROWS:
        cell = F.explode(F.transform("cells", lambda c: F.when(c < 0, -1 - c).otherwise(c)))
        count = reps.select(cell.alias("cell")).groupBy("cell").count().filter(F.col("count") > 2 * BUCKET_ROWS)
        # at most one of 2 * BUCKET_ROWS entries: the numbers of the large buckets, not what lies in them
        hot = {r["cell"]: -(-r["count"] // BUCKET_ROWS) for r in count.toLocalIterator()}
    shared = spark.sparkContext.broadcast(hot)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        large = shared.value

        def send(part: pa.Table) -> Iterator[pa.RecordBatch]:
            ident = part.column("id").to_numpy()
            code = np.frombuffer(b"".join(part.column("code").to_pylist()), np.int16).reshape(len(part), size)
            cells = part.column("cells").combine_chunks()
            row, cell = np.repeat(np.arange(len(part)), np.diff(cells.offsets.to_numpy())), cells.flatten().to_numpy()
            home = cell >= 0
            cell = np.where(home, cell, -1 - cell)
            order = np.argsort(cell, kind="stable")
            row, cell, home = row[order], cell[order], home[order]
            edges = np.r_[np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]), len(cell)]
            out = []
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                r, h, c = row[lo:hi], home[lo:hi], int(cell[lo])
                pieces = large.get(c, 1)
                own = ident[r] % pieces
                for a in range(pieces):
                    for b in range(a, pieces):
                        x = (own == a) | (own == b)
                        if x.any():
                            out.append((c, a, b, pieces, _packed(ident[r[x]], h[x], code[r[x]])))
                if len(out) >= 256:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, o, strict=True)) for o in out], schema)
                    out = []
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(names, o, strict=True)) for o in out], schema)

        names = ["cell", "low", "high", "pieces", "body"]
        schema = pa.schema([("cell", pa.int64()), ("low", pa.int32()), ("high", pa.int32()), ("pieces", pa.int32()), ("body", pa.binary())])
        held, rows = [], 0
        for b in batches:
            held.append(b)
            rows += len(b)
            if rows >= PACK_ROWS:
                yield from send(pa.Table.from_batches(held))
                held, rows = [], 0
        if rows:
            yield from send(pa.Table.from_batches(held))

    def meet(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bodies, pieces = [], 1
        for b in batches:
            bodies += b.column("body").to_pylist()
            pieces = b.column("pieces")[0].as_py() if len(b) else pieces
        yield from _bucket(bodies, size, pieces, key[1].as_py() != key[2].as_py(), k + SLACK, least)

    spread = reps.select("id", "code", "cells").mapInArrow(pack, "cell bigint, low int, high int, pieces int, body binary")
    near = spread.groupBy("cell", "low", "high").applyInArrow(meet, "q bigint, n bigint, s float")
    best = near.repartition("q").groupBy("q", "n").agg(F.max("s").alias("s"))
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("s"), "n"))
    return scratch.keep(best.withColumn("place", place).filter(F.col("place") <= k + SLACK).select("q", "n"))


def nearest(spark: SparkSession, vectors: DataFrame, k: int = 5, least: float | None = None, scratch: Scratch | None = None, size: int = 64, depth: int | None = None) -> DataFrame:
    """(key, other, cos, rank): the k most similar other keys of every key, ranked by cosine, then key.

    vectors: key, vec; a repeated key holds one direction (else one of its vectors is taken). Unusable vectors (null, of another
    length than ``size``, with NaN, all zero) are left out; every other one is indexed. A few neighbours may be missed, more the
    farther they are: the module's table gives the share found. ``least`` drops partners of lower cosine early. ``depth``
    overrides the number of joined hashes. Copies of one direction to 3e-5 in each component share one cosine.
    """
    scratch = scratch or Scratch(spark, "nearest")
    n = vectors.count()
    depth = depth or min(3, max(1, math.ceil(math.log(max(2, n) / AIM, 2 * size))))
    units = _hashed(spark, vectors, size, depth, scratch)
    copies = scratch.keep(units.groupBy("id").agg(F.count("*").alias("n"), F.min("key").alias("low")).filter("n > 1").select("id", "low"))
    few = copies.count() <= BROADCAST_IDS
    reps = units.join(F.broadcast(copies) if few else copies, "id", "left").filter("low is null or low = key")
    pairs = _candidates(spark, reps, n, size, k, -1.5 if least is None else least - OFF, scratch)

    # exact cosines of the candidates, on the vectors as given
    ids = scratch.keep(pairs.select(F.explode(F.array("q", "n")).alias("id")).union(copies.select("id")).distinct())
    there = scratch.keep(_semi(units.select("id", "key"), ids, "id"))
    low = there.groupBy("id").agg(F.min("key").alias("key"))
    wanted = scratch.keep(low.select("key"))
    raw = _semi(vectors.filter(F.col("key").isNotNull() & usable_vector(F.col("vec"), size)).select("key", "vec"), wanted, "key")
    raw = scratch.keep(raw.groupBy("key").agg(F.max("vec").alias("vec")).join(low, "key").select("id", "vec"))
    a, b = raw.select(F.col("id").alias("q"), F.col("vec").alias("va")), raw.select(F.col("id").alias("n"), F.col("vec").alias("vb"))
    scored = pairs.join(a, "q").join(b, "n").select("q", "n", cosine(F.col("va"), F.col("vb")).alias("s"))
    top = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("s"), "n"))
    near = scored.withColumn("top", top).filter(F.col("top") <= k).select("q", "n", "s")

    # partners of a direction: the copies of the others near it, and its own copies
    some = F.row_number().over(Window.partitionBy("id").orderBy("key"))
    some = scratch.keep(there.withColumn("p", some).filter(F.col("p") <= k + 1).select("id", F.col("key").alias("other")))
    other = near.join(some.select(F.col("id").alias("n"), "other"), "n").select(F.col("q").alias("id"), "s", "other")
    own = some.join(F.broadcast(copies) if few else copies, "id", "left_semi").select("id", F.lit(1.0).alias("s"), "other")
    flat = other.union(own)
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("s"), "other"))
    lists = flat.withColumn("i", rank).filter(F.col("i") <= 2 * k + 1)
    lists = lists.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("i", "s", "other"))).alias("l"))
    mine = there.join(lists, "id").select("key", F.slice(F.filter("l", lambda x: x["other"] != F.col("key")), 1, k).alias("l"))
    out = mine.select("key", F.posexplode("l").alias("i", "x"))
    return out.select("key", F.col("x.other").alias("other"), F.col("x.s").alias("cos"), (F.col("i") + 1).alias("rank"))


def similar_pairs(spark: SparkSession, emb: DataFrame, k: int = 5, least: float = 0.85, depth: int | None = None) -> DataFrame:
    """(key_a, key_b), key_a < key_b: keys of which one is among the k most similar of the other, at cosine ``least`` or
    more. Keys are digests, each once; repeated keys hold one vector, perhaps scaled, and the greatest is taken."""
    scratch = Scratch(spark, "similar")
    own = emb.select(digest(F.col("key")).alias("key"), "vec")
    near = nearest(spark, own, k, least, scratch, depth=depth).filter(F.col("cos") >= least - OFF)
    near = scratch.keep(near.select(F.least("key", "other").alias("key_a"), F.greatest("key", "other").alias("key_b")).distinct())
    # the bound itself is tested on the vectors of the two keys as given
    keys = scratch.keep(near.select(F.explode(F.array("key_a", "key_b")).alias("key")).distinct())
    raw = _semi(own.filter(F.col("key").isNotNull() & usable_vector(F.col("vec"))), keys, "key").groupBy("key").agg(F.max("vec").alias("vec"))
    raw = scratch.keep(raw)
    a, b = raw.select(F.col("key").alias("key_a"), F.col("vec").alias("va")), raw.select(F.col("key").alias("key_b"), F.col("vec").alias("vb"))
    return near.join(a, "key_a").join(b, "key_b").filter(cosine(F.col("va"), F.col("vb")) >= least).select("key_a", "key_b")
