"""Problem 2: the same or nearly the same records across splits."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.identity import code, digest, hamming, word
from tidemill.llm.hamming import INDEX, PROBE, Layout, matching, runs_of, verified
from tidemill.session import Scratch

#: The spellings of the two sides, after lower-casing and trimming.
TRAIN = ["train", "training"]
EVALUATION = ["val", "validation", "test", "test_ood"]

#: Bits of a random-plane fingerprint: segments of 20 bits. Two vectors of cosine 0.95 differ in a bit with probability
#: 0.101, so a segment differs in at most one bit with probability 0.386, and all 20 segments fail with 6e-5.
PLANES, SEGMENT = 20, 20
#: Where the first segment differs in at most one bit, the other 40 bits of the run differ in 4 on average at cosine 0.95
#: (more than 10: 2e-3, and each of the 20 segments is a chance of its own), those of unrelated vectors in 20 (10 or fewer:
#: 1e-3). A wider limit would verify many times more unrelated pairs.
RUN_LIMIT = 11


def usable_vector(c: Column, size: int = 64) -> Column:
    """Not null, of full length, without NaN or infinity, and not all zero."""
    bad = F.exists(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (F.size(c) == size) & ~bad & F.exists(c, lambda x: x != 0)


def sides(rows: DataFrame, split: str = "split", key: str = "digest") -> DataFrame:
    """(digest, side): INDEX if the digest has a train row, PROBE if it has an evaluation row, or both added. Rows of neither
    side are dropped."""
    s = word(F.col(split))
    rows = rows.select(key, s.isin(TRAIN).alias("t"), s.isin(EVALUATION).alias("e")).filter("t or e")
    return rows.groupBy(key).agg((F.max("t").cast("int") * INDEX + F.max("e").cast("int") * PROBE).alias("side"))


def plane_runs(vectors: DataFrame, seed: int = 20) -> tuple[DataFrame, Layout]:
    """Sign bits of random projections of (id, vec, side), as runs of three 20-bit segments, all in one matrix product."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = np.random.default_rng(seed).standard_normal((64, PLANES * SEGMENT)).astype(np.float32)
        for b in batches:
            if not len(b):
                continue
            v = b.column("vec").flatten().to_numpy().reshape(len(b), -1)
            sign = (v @ planes[: v.shape[1]] > 0).reshape(len(b), PLANES, SEGMENT)
            segment = sign.astype(np.int64) @ (1 << np.arange(SEGMENT, dtype=np.int64))
            run = segment << 2 * SEGMENT | np.roll(segment, -1, 1) << SEGMENT | np.roll(segment, -2, 1)
            runs = pa.ListArray.from_arrays(np.arange(0, run.size + 1, PLANES, dtype=np.int32), run.ravel())
            yield pa.RecordBatch.from_arrays([b.column("id"), runs, b.column("side")], ["id", "runs", "side"])

    layout = Layout([(SEGMENT, 2 * SEGMENT, 3 * SEGMENT)] * PLANES, (1, 2 * SEGMENT, RUN_LIMIT))
    return vectors.select("id", "vec", "side").mapInArrow(bits, "id bigint, runs array<bigint>, side int"), layout


def _facing(met: DataFrame) -> DataFrame:
    """Of pairs of an index and a probing row, those of different digests of which the first is in train, the second in
    evaluation (a code may be on both sides by different digests)."""
    one, two = (F.col(f"{x}.side").bitwiseAND(F.lit(bit)) > 0 for x, bit in (("a", INDEX), ("b", PROBE)))
    return met.filter(one & two & (F.col("a.digest") != F.col("b.digest")))


def code_overlaps(own: DataFrame, radius: int, scratch: Scratch) -> DataFrame:
    """(train, evaluation): different digests of the two sides whose codes differ in at most ``radius`` bits. own: digest, code
    (64 hex digits), side."""
    own = scratch.keep(own.withColumn("id", F.xxhash64("code")))
    codes = own.groupBy("id", "code").agg(F.bit_or("side").alias("side"))
    layout, runs = runs_of(F.col("code"), 64, radius)
    met = _facing(verified(own, matching(codes.select("id", runs.alias("runs"), "side"), layout, own.count()), scratch))
    met = met.filter(hamming(F.col("a.code"), F.col("b.code"), 64) <= radius)
    return met.select(F.col("a.digest").alias("train"), F.col("b.digest").alias("evaluation"))


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, t: s + t)
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def vector_overlaps(own: DataFrame, least: float, scratch: Scratch) -> DataFrame:
    """The same for vectors of cosine ``least`` or more. own: digest, vec, side; one row per digest."""
    own = scratch.keep(own.withColumn("id", F.xxhash64("digest")))
    segments, layout = plane_runs(own)
    met = _facing(verified(own, matching(segments, layout, own.count()), scratch))
    met = met.filter(cosine(F.col("a.vec"), F.col("b.vec")) >= least)
    return met.select(F.col("a.digest").alias("train"), F.col("b.digest").alias("evaluation"))


def directed_overlaps(spark: SparkSession, metadata: DataFrame, phash: DataFrame, emb: DataFrame, radius: int = 24, least: float = 0.95) -> DataFrame:
    """(train, evaluation): digests of the two sides that are equal or near; a pair may come from code and vector.

    Null and unknown splits are neither side; digests without a usable code or vector can only match as themselves; a digest
    with several codes matches by any of them, one with several vectors by the greatest (they are copies). Empty tables give
    an empty result; other columns are ignored.
    """
    scratch = Scratch(spark, "cross-split")
    side = sides(metadata.select(digest(F.col("image_sha256")).alias("digest"), "split").filter("digest is not null"))
    side = scratch.keep(side)
    codes = phash.select(digest(F.col("sha256")).alias("digest"), code(F.col("phash"), 64).alias("code")).dropna().distinct()
    vecs = emb.select(digest(F.col("key")).alias("digest"), "vec").filter(F.col("digest").isNotNull() & usable_vector(F.col("vec")))
    vecs = vecs.groupBy("digest").agg(F.max("vec").alias("vec"))
    same = side.filter(F.col("side") == INDEX + PROBE).select(F.col("digest").alias("train"), F.col("digest").alias("evaluation"))
    by_code = code_overlaps(codes.join(side, "digest"), radius, scratch)
    by_vec = vector_overlaps(vecs.join(side, "digest"), least, scratch)
    return by_code.union(by_vec).union(same)


def overlaps(spark: SparkSession, metadata: DataFrame, phash: DataFrame, emb: DataFrame, radius: int = 24, least: float = 0.95) -> DataFrame:
    """(sha_a, sha_b), sha_a <= sha_b: digests of which one is in train and the other in evaluation, equal or near.

    A digest with rows on both sides comes out with itself. See ``directed_overlaps`` for nulls, repeats and empty tables.
    """
    pairs = directed_overlaps(spark, metadata, phash, emb, radius, least)
    return pairs.select(F.least("train", "evaluation").alias("sha_a"), F.greatest("train", "evaluation").alias("sha_b")).distinct()


def overlap_report(spark: SparkSession, metadata: DataFrame, phash: DataFrame, emb: DataFrame) -> DataFrame:
    """(split, source_id, images, exact, near): evaluation images that are also in train, per split and source of the evaluation
    row: all, those in train as the same digest, and those with a near copy of another digest in train. Digests count once per
    split and source; a null source is a source of its own."""
    pairs = directed_overlaps(spark, metadata, phash, emb)
    hit = pairs.groupBy(F.col("evaluation").alias("digest")).agg(F.max(F.col("train") == F.col("evaluation")).alias("exact"), F.max(F.col("train") != F.col("evaluation")).alias("near"))
    rows = metadata.select(digest(F.col("image_sha256")).alias("digest"), word(F.col("split")).alias("split"), "source_id")
    rows = rows.filter(F.col("split").isin(EVALUATION)).distinct().join(hit, "digest")
    return rows.groupBy("split", "source_id").agg(F.count("*").alias("images"), F.count_if("exact").alias("exact"), F.count_if("near").alias("near"))
