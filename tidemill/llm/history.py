"""Problem 7: new batches deduplicated against everything accepted before.

A code is the set of its 256 features (position, bit). Minwise signatures whose bins are random find two codes 24 bits apart
only with some probability, and every pair is asked for here, so random bins are replaced by exact ones: with one bin for each
position the least feature of a bin is the one that the code holds there, a signature is 256 values of one bit, and two codes
that differ in at most 24 bits differ in at most 24 values. The signature is cut into 13 bands; one of them then differs in at
most one value, so a band is looked up as it is and with each value changed, and no pair is lost (the README gives the recall
of random bins beside it).

What is persisted (``History``) are the band keys of accepted codes, each with the values of the next two bands as signature and
the code's id, bucketed by the hash of the key's group (band and leading values) and packed into one row per group and append.
A batch is packed the same way and meets only the groups its keys fall in; keys stay where they lie. Signatures leave almost
only true matches; these are verified on whole codes, and then the keys of the batch's accepted codes are appended.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.identity import code, digest, hamming, word
from tidemill.llm.hamming import CELL_ROWS, INDEX, PROBE, leading_bits, match, packed, runs_of, touched, unpack, verified
from tidemill.llm.hamming import pack as pack_rows
from tidemill.session import Scratch

#: Bits in which two codes may differ.
RADIUS = 24
#: Files over which one append spreads the persisted keys at most, by the hash of their group.
MOST_BUCKETS = 2048
#: Bytes of packed probes that are broadcast to the persisted keys; more are shuffled to where these lie.
BROADCAST_BYTES = 32 << 20


def accepted(bytes_config: Column) -> Column:
    """Not null, blank or withheld."""
    return F.coalesce(word(bytes_config) != "withheld", F.lit(False))


def deliveries(metadata: DataFrame, phash: DataFrame) -> DataFrame:
    """row_id, batch, ok (accepted), digest, code (null where there is no usable one); rows without digest or batch drop out,
    as they can be equal to nothing and are earlier than nothing."""
    rows = metadata.select("row_id", "batch", accepted(F.col("bytes_config")).alias("ok"), digest(F.col("image_sha256")).alias("digest"))
    rows = rows.filter("digest is not null and batch is not null")
    codes = phash.select(digest(F.col("sha256")).alias("digest"), code(F.col("phash"), 64).alias("code")).dropna().distinct()
    return rows.join(codes, "digest", "left")


def _rows(a: str = "a", b: str = "b") -> list[Column]:
    x, y = F.col(f"{a}.row_id"), F.col(f"{b}.row_id")
    return [F.least(x, y).alias("row_a"), F.greatest(x, y).alias("row_b")]


class History:
    """The codes accepted so far, persisted under ``path`` (a folder all executors share).

    ``keys``: (grp, body), one packed row per group of band keys and append, bucketed by grp. ``rows``: the accepted rows.
    ``layout``: how many leading values are part of a group, chosen from the first append, so that a group holds about as many
    codes as fit one task; ``append`` only adds files. Rows of a group are limited to CELL_ROWS codes, so a group that a third
    of all codes fall in is several rows, each met on its own.
    """

    def __init__(self, spark: SparkSession, path: str, radius: int = RADIUS):
        self.spark, self.path, self.radius = spark, path.rstrip("/"), radius
        self.layout, _ = runs_of(F.lit(""), 64, radius)
        self.h: int | None = None
        self.table = f"history_{blake2b(self.path.encode(), digest_size=8).hexdigest()}"
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/layout")
        if place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
            self._open(spark.read.parquet(f"{self.path}/layout").first()[0])

    def _open(self, h: int) -> None:
        self.h = h
        buckets = min(len(self.layout.bits) << h, MOST_BUCKETS)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} (grp BIGINT, body BINARY) USING parquet CLUSTERED BY (grp) INTO {buckets} BUCKETS LOCATION '{self.path}/keys'")

    def _packed(self, codes: DataFrame, side: int) -> DataFrame:
        """(grp, body): the band keys of codes (id, code), one row per group and task, at most CELL_ROWS codes each."""
        _, runs = runs_of(F.col("code"), 64, self.radius)

        def merge(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, rows = [], 0

            def row() -> pa.RecordBatch:
                index, probe = unpack(held)
                ids, run = index if side == INDEX else probe
                body = pack_rows(ids, run, (ids * 0 + side))
                return pa.RecordBatch.from_arrays([pa.array([key[0].as_py()]), pa.array([body], pa.binary())], ["grp", "body"])

            for b in batches:
                for body in b.column("body").to_pylist():
                    if rows and rows + len(body) // 17 > CELL_ROWS:
                        yield row()
                        held, rows = [], 0
                    held.append(body)
                    rows += len(body) // 17
            if rows:
                yield row()

        return packed(codes.select("id", runs.alias("runs"), F.lit(side).alias("side")), self.layout, self.h).groupBy("grp").applyInArrow(merge, "grp bigint, body binary")

    def append_codes(self, codes: DataFrame) -> None:
        """Adds the keys of accepted codes (id, code); a code that is there already does no harm."""
        if self.h is None:
            h = leading_bits(self.layout, codes.count(), self.spark.sparkContext.defaultParallelism)
            self.spark.createDataFrame([(h,)], "h int").coalesce(1).write.parquet(f"{self.path}/layout")
            self._open(h)
        self._packed(codes, INDEX).write.insertInto(self.table)

    def probe(self, codes: DataFrame) -> DataFrame:
        """(a, b): ids of persisted codes and of the given ones (id, code) whose signatures allow at most the radius; verify
        them on the codes."""
        layout, h = self.layout, self.h
        if h is None:
            return self.spark.createDataFrame([], "a bigint, b bigint")

        def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for grp, old, new in zip(*(b.column(c).to_pylist() for c in ("grp", "old", "new")), strict=True):
                    for x, y in match(unpack([old])[0], unpack([new])[1], layout, grp >> h, grp & ((1 << h) - 1), h):
                        yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["a", "b"])

        probes = self._packed(codes, PROBE).withColumnRenamed("body", "new")
        keys = self.spark.table(self.table).withColumnRenamed("body", "old")
        bytes_ = codes.count() * len(layout.bits) * (1 + h) * 17
        if bytes_ <= BROADCAST_BYTES:
            probes = F.broadcast(probes)
        return keys.join(probes, "grp").mapInArrow(meet, "a bigint, b bigint").distinct()

    def append(self, rows: DataFrame) -> None:
        """Adds the accepted rows of a batch (row_id, batch, ok, digest, code) and the keys of their codes."""
        rows = rows.filter("ok").select("row_id", "batch", "ok", "digest", "code", F.xxhash64("code").alias("id"))
        rows.write.mode("append").parquet(f"{self.path}/rows")
        self.append_codes(rows.filter("code is not null").select("id", "code").distinct())

    def check(self, batch: DataFrame) -> DataFrame:
        """(row_a, row_b): rows of the batch and earlier accepted rows with the same digest or a code within the radius."""
        scratch = Scratch(self.spark, "check")
        new = scratch.keep(batch.select("row_id", "batch", "digest", "code", F.xxhash64("code").alias("id")))
        old = self.spark.read.parquet(f"{self.path}/rows")
        links = scratch.keep(self.probe(new.filter("code is not null").select("id", "code").distinct()))
        o, n, p = touched(old, links).alias("o"), new.alias("n"), links.alias("p")
        near = p.join(o, F.col("p.a") == F.col("o.id")).join(n, F.col("p.b") == F.col("n.id"))
        near = near.filter((F.col("o.batch") < F.col("n.batch")) & (hamming(F.col("o.code"), F.col("n.code"), 64) <= self.radius)).select(*_rows("o", "n"))
        o = old.select("row_id", "batch", "digest").distinct().alias("o")
        same = o.join(new.select("row_id", "batch", "digest").distinct().alias("n"), (F.col("o.digest") == F.col("n.digest")) & (F.col("o.batch") < F.col("n.batch")))
        return near.union(same.select(*_rows("o", "n"))).distinct()


def backfill(spark: SparkSession, metadata: DataFrame, phash: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(row_a, row_b) of different batches, with the same digest or with codes at most ``radius`` bits apart, of which the
    row of the earlier batch is accepted: the batches in their order, each checked against the history of those before it and
    then appended to it.

    Every code is probed once per batch that holds it and appended once, with the first batch that accepts it. Rows with null
    digest or batch match nothing, with unusable code only by digest; copies within a batch are no pair.
    """
    scratch = Scratch(spark, "history")
    rows = scratch.keep(deliveries(metadata, phash).withColumn("id", F.xxhash64("code")))
    codes = rows.filter("code is not null").groupBy("id", "code").agg(F.collect_set("batch").alias("batches"), F.min(F.when(F.col("ok"), F.col("batch"))).alias("first"))
    codes = codes.select("id", "code", "first", F.explode("batches").alias("batch"))
    codes = scratch.keep(codes.repartitionByRange("batch", "id").sortWithinPartitions("batch"))  # so that a batch reads its files
    history, found = History(spark, f"{scratch.root}/index", radius), None
    for b in sorted(r[0] for r in codes.select("batch").distinct().collect()):  # one entry per delivery
        part = codes.filter(F.col("batch") == F.lit(b))
        near = scratch.keep(history.probe(part.select("id", "code")))
        found = near if found is None else found.union(near)
        history.append_codes(part.filter("first = batch").select("id", "code"))
    slim = rows.select("row_id", "batch", "ok", F.unhex("digest").alias("digest")).distinct()
    a, b = slim.alias("a"), slim.alias("b")
    by_digest = a.join(b, (F.col("a.digest") == F.col("b.digest")) & (F.col("a.batch") < F.col("b.batch")) & F.col("a.ok")).select(*_rows())
    if found is None:
        return by_digest.distinct()
    by_code = verified(rows, found.distinct(), scratch)
    by_code = by_code.filter((F.col("a.batch") < F.col("b.batch")) & F.col("a.ok") & (F.col("a.digest") != F.col("b.digest")))
    by_code = by_code.filter(hamming(F.col("a.code"), F.col("b.code"), 64) <= radius).select(*_rows())
    return by_code.union(by_digest).distinct()


def last_batch(spark: SparkSession, metadata: DataFrame, phash: DataFrame) -> DataFrame:
    """The newest batch checked against a persisted history of all earlier ones."""
    scratch = Scratch(spark, "history")
    rows = scratch.keep(deliveries(metadata, phash))
    newest = rows.agg(F.max("batch")).first()[0]
    history = History(spark, f"{scratch.root}/index")
    history.append(rows.filter(F.col("batch") < F.lit(newest)))
    return history.check(rows.filter(F.col("batch") == F.lit(newest)))
