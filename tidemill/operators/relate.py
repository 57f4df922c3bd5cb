"""Joins and aggregations that take column names, so that they serve any table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.functions.identity import hamming
from tidemill.operators.sample import lagged


def coverage(df: DataFrame, fields: list[str], group: str) -> DataFrame:
    """(group, field, percent): non-null share of each field, per group and (group null) overall, in one aggregation.

    A missing column counts as all null. Null groups are reported with the overall rows as a group of their own.
    """
    there = [c if c in df.columns else None for c in fields]
    flags = [F.count(c).alias(f"_{f}") if c else F.lit(0).cast("bigint").alias(f"_{f}") for f, c in zip(fields, there, strict=True)]
    by = df.rollup(group).agg(F.count("*").alias("_n"), *flags)
    stack = ", ".join(f"'{f}', `_{f}`" for f in fields)
    out = by.select(group, "_n", F.expr(f"stack({len(fields)}, {stack}) as (field, has)"))
    return out.select(group, "field", F.round(100.0 * F.col("has") / F.col("_n"), 1).alias("percent"))


def rollup(rows: DataFrame, group: str, label: str, floor: int = 10, unknown: str = "unknown", dominant: float = 0.5, present: float = 0.1, least_known: float | None = None) -> DataFrame:
    """(group, known, unknown, dominant, present): the dominant class of each group and the classes present.

    Groups of which more than half is unknown drop out (with ``least_known``, those of which a smaller share is known).
    Below ``floor`` known rows dominant and present are null. dominant is the class with at least that share, else
    "mixed"; ties go to the first name. present lists classes of at least that share. Two aggregations, no window: a group
    of a third of all rows is combined before the shuffle, and only its classes are gathered.
    """
    n = rows.groupBy(group, label).agg(F.count("*").alias("n"))
    is_known = F.col(label) != unknown
    by = n.groupBy(group).agg(
        F.coalesce(F.sum(F.when(is_known, F.col("n"))), F.lit(0)).alias("known"),
        F.coalesce(F.sum(F.when(~is_known, F.col("n"))), F.lit(0)).alias("unknown"),
        F.array_sort(F.collect_list(F.when(is_known, F.struct((-F.col("n")).alias("m"), F.col(label).alias("l"))))).alias("c"),
    )
    total = F.col("known") + F.col("unknown")
    by = by.filter(F.col("known") >= least_known * total if least_known is not None else F.col("unknown") <= 0.5 * total)
    first = F.get("c", F.lit(0))
    enough = (F.col("known") >= floor) & (F.col("known") > 0)
    top = F.when(-first["m"] >= dominant * F.col("known"), first["l"]).otherwise("mixed")
    names = F.array_sort(F.transform(F.filter("c", lambda x: -x["m"] >= present * F.col("known")), lambda x: x["l"]))
    return by.select(group, "known", "unknown", F.when(enough, top).alias("dominant"), F.when(F.col("known") >= floor, names).alias("present"))


def overlaps(rows: DataFrame, group: str, item: str) -> DataFrame:
    """(group_a, group_b, images): items of a that b also has; on the diagonal those it has more than once."""
    n = rows.groupBy(group, item).agg(F.count("*").alias("n"))
    a, b = n.alias("a"), n.alias("b")
    on = (F.col(f"a.{item}") == F.col(f"b.{item}")) & ((F.col(f"a.{group}") != F.col(f"b.{group}")) | (F.col("a.n") > 1))
    return a.join(b, on).groupBy(F.col(f"a.{group}").alias("source_a"), F.col(f"b.{group}").alias("source_b")).agg(F.count("*").alias("images"))


def agreement(rows: DataFrame, item: str, rater: str, label: str) -> DataFrame:
    """(source_a, source_b, pairs, agree) over items that two raters labelled."""
    m = rows.select(item, rater, label).distinct()
    a, b = m.alias("a"), m.alias("b")
    on = (F.col(f"a.{item}") == F.col(f"b.{item}")) & (F.col(f"a.{rater}") < F.col(f"b.{rater}"))
    both = a.join(b, on).groupBy(F.col(f"a.{rater}").alias("source_a"), F.col(f"b.{rater}").alias("source_b"))
    return both.agg(F.count("*").alias("pairs"), F.count_if(F.col(f"a.{label}") == F.col(f"b.{label}")).alias("agree"))


def join_misses(tables: dict[str, DataFrame], base: DataFrame) -> DataFrame:
    """(tbl, rows, no_key, no_match) of each table's key k against the keys of base; a null key is a miss of its own."""
    keys = base.select("k").filter("k is not null").distinct().withColumn("hit", F.lit(True))
    all_ = reduce(DataFrame.union, (df.select(F.lit(n).alias("tbl"), "k") for n, df in tables.items()))
    j = all_.join(keys, "k", "left")
    return j.groupBy("tbl").agg(F.count("*").alias("rows"), F.count_if(F.col("k").isNull()).alias("no_key"), F.count_if(F.col("k").isNotNull() & F.col("hit").isNull()).alias("no_match"))


def by_number_then_name(left: DataFrame, target: DataFrame, number: str, name: str, out: str) -> DataFrame:
    """left with ``out`` of the target that has its number, else its name (smallest first), and how it was found."""
    i = target.filter(F.col(number).isNotNull()).groupBy(number).agg(F.min(out).alias("_i"))
    n = target.filter(F.col(name).isNotNull()).groupBy(name).agg(F.min(out).alias("_n"))
    j = left.join(i, number, "left").join(n, name, "left")
    how = F.when(F.col("_i").isNotNull(), "number").when(F.col("_n").isNotNull(), "name")
    return j.select("*", F.coalesce("_i", "_n").alias(out), how.alias("how")).drop("_i", "_n")


def run_links(rows: DataFrame, key: str, item: str) -> DataFrame:
    """(a, b): neighbours in item order among equal keys; a key that a third of all rows share is no single task."""
    x = lagged(rows.select(key, item).filter(F.col(key).isNotNull()), [key, item], [key, item])
    return x.filter(F.col(f"{key}_before") == F.col(key)).select(F.col(f"{item}_before").alias("a"), F.col(item).alias("b"))


def hamming_pairs(rows: DataFrame, item: str, bits: str, radius: int, digits: int = 16) -> DataFrame:
    """(sha_a, sha_b, distance) of all pairs of hex codes at most ``radius`` bits apart: with radius + 1 bands at least one
    is equal, so bands are joined and candidates verified. Equal codes are one row until the end."""
    sizes = [digits // (radius + 1) + (i < digits % (radius + 1)) for i in range(radius + 1)]
    starts = [sum(sizes[:i]) for i in range(len(sizes))]
    distinct = rows.select(F.col(bits).alias("code")).distinct()
    bands = F.array(*(F.concat(F.lit(f"{i}:"), F.substring("code", s + 1, n)) for i, (s, n) in enumerate(zip(starts, sizes, strict=True))))
    keyed = distinct.select("code", F.explode(bands).alias("band"))
    a, b = keyed.alias("a"), keyed.alias("b")
    near = a.join(b, (F.col("a.band") == F.col("b.band")) & (F.col("a.code") < F.col("b.code")))
    near = near.select(F.col("a.code").alias("ca"), F.col("b.code").alias("cb"), hamming(F.col("a.code"), F.col("b.code"), digits).cast("int").alias("distance"))
    near = near.filter(F.col("distance") <= radius).distinct()
    many = rows.groupBy(F.col(bits).alias("ca")).agg(F.count("*").alias("n")).filter("n > 1").select("ca", F.col("ca").alias("cb"), F.lit(0).alias("distance"))
    pairs = near.union(many)
    x, y = rows.select(F.col(bits).alias("ca"), F.col(item).alias("x")), rows.select(F.col(bits).alias("cb"), F.col(item).alias("y"))
    met = pairs.join(x, "ca").join(y, "cb").filter("x <> y")
    return met.select(F.least("x", "y").alias("sha_a"), F.greatest("x", "y").alias("sha_b"), "distance").distinct()


def near_codes(left: DataFrame, radius: int, right: DataFrame | None = None) -> DataFrame:
    """(ca, cb, distance) of 64-bit hex codes at most ``radius`` bits apart, each pair once: within left (ca < cb), or of left
    and right, equal codes too. left, right: code.

    A code is cut into radius // 2 + 1 segments, of which one differs in at most one bit in every such pair; codes of one side
    probe each segment as it is and with each bit flipped. No pair is lost.
    """
    m = radius // 2 + 1
    sizes = [64 // m + (i < 64 % m) for i in range(m)]
    half = lambda at: F.conv(F.substring("code", at, 8), 16, 10).cast("bigint")
    as_bits = lambda df: df.select("code").dropna().distinct().select("code", F.shiftleft(half(1), 32).bitwiseOR(half(9)).alias("v"))
    homes, probes = [], []
    for i, n in enumerate(sizes):
        own = F.shiftrightunsigned(F.col("v"), sum(sizes[:i])).bitwiseAND(F.lit((1 << n) - 1)) if n < 64 else F.col("v")
        homes.append(F.struct(F.lit(i).alias("seg"), own.alias("key")))
        flips = [0] + [1 << k for k in range(n)]
        flips = [x - (1 << 64) if x >= 1 << 63 else x for x in flips]
        probes.append(F.array(*(F.struct(F.lit(i).alias("seg"), own.bitwiseXOR(F.lit(x).cast("bigint")).alias("key")) for x in flips)))
    a = as_bits(left).select(F.col("code").alias("ca"), F.col("v").alias("va"), F.explode(F.flatten(F.array(*probes))).alias("s")).select("ca", "va", "s.*")
    b = as_bits(left if right is None else right).select(F.col("code").alias("cb"), F.col("v").alias("vb"), F.explode(F.array(*homes)).alias("s")).select("cb", "vb", "s.*")
    distance = F.bit_count(F.col("va").bitwiseXOR(F.col("vb")))
    met = a.join(b, ["seg", "key"]).filter(distance <= radius)
    if right is None:
        met = met.filter("ca < cb")
    return met.select("ca", "cb", distance.cast("int").alias("distance")).distinct()


def near_items(rows: DataFrame, item: str, bits: str, radius: int) -> DataFrame:
    """(sha_a, sha_b, distance) of all pairs of items with codes at most ``radius`` bits apart, by ``near_codes``; the least
    distance of items with several codes."""
    rows = rows.select(F.col(item).alias("x"), F.col(bits).alias("code")).dropna().distinct()
    many = rows.groupBy("code").count().filter("count > 1").select(F.col("code").alias("ca"), F.col("code").alias("cb"), F.lit(0).alias("distance"))
    pairs = near_codes(rows.select("code"), radius).union(many)
    met = pairs.join(rows.withColumnRenamed("code", "ca"), "ca").join(rows.select(F.col("code").alias("cb"), F.col("x").alias("y")), "cb").filter("x <> y")
    return met.groupBy(F.least("x", "y").alias("sha_a"), F.greatest("x", "y").alias("sha_b")).agg(F.min("distance").alias("distance"))


def nearest_vectors(spark: SparkSession, rows: DataFrame, key: str, vector: str, wanted: Column, k: int, block: int = 512) -> DataFrame:
    """(query, other, cos, place) of the k rows of greatest cosine to each row that is ``wanted``, among all others, exactly.

    Queries are broadcast; each task keeps a running k for every query over its blocks of rows, and these are merged. Cosines
    are rounded to 6 places, ties go to the smaller key. Null keys, null, zero and non-finite vectors, and those of another
    length than the first query's, are no rows.
    """
    import numpy as np
    import pyarrow as pa

    ok = rows.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"), F.coalesce(wanted, F.lit(False)).alias("w"))
    ok = ok.filter(F.col("id").isNotNull() & F.exists("v", lambda x: x != 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    got = ok.filter("w").select("id", "v").orderBy("id").collect()
    width = len(got[0]["v"]) if got else 0
    got = [r for r in got if len(r["v"]) == width]
    unit = lambda a: a / np.linalg.norm(a, axis=1, keepdims=True)
    shared = spark.sparkContext.broadcast((np.array([r["id"] for r in got], np.int64), unit(np.array([r["v"] for r in got], np.float64).reshape(len(got), width)) if got else None))

    def run(batches):
        ids, q = shared.value
        top = np.full((len(ids), k), -2.0), np.full((len(ids), k), np.iinfo(np.int64).max)
        for b in batches:
            for at in range(0, len(b) if len(ids) else 0, block):
                part = b.slice(at, block)
                other = part.column("id").to_numpy()
                v = unit(part.column("v").flatten().to_numpy().reshape(len(other), width))
                for lo in range(0, len(ids), block):
                    s = slice(lo, lo + block)
                    cos = np.round(q[s] @ v.T, 6)
                    cos[ids[s, None] == other[None]] = -2
                    cos, name = np.concatenate([top[0][s], cos], 1), np.concatenate([top[1][s], np.broadcast_to(other, cos.shape)], 1)
                    best = np.lexsort((name, -cos), axis=1)[:, :k]
                    top[0][s], top[1][s] = np.take_along_axis(cos, best, 1), np.take_along_axis(name, best, 1)
        x, y = np.nonzero(top[0] > -2)
        yield pa.RecordBatch.from_arrays([pa.array(ids[x]), pa.array(top[1][x, y]), pa.array(top[0][x, y])], ["query", "other", "cos"])

    part = ok.filter(F.size("v") == width).select("id", "v").mapInArrow(run, "query bigint, other bigint, cos double")
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("cos"), "other"))
    return part.withColumn("place", place).filter(F.col("place") <= k)


def difference(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """(key, change): added, removed, changed or kept; null values are equal to each other."""
    j = old.alias("o").join(new.alias("n"), F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    change = F.when(F.col(f"o.{key}").isNull(), "added").when(F.col(f"n.{key}").isNull(), "removed").when(~F.col(f"o.{value}").eqNullSafe(F.col(f"n.{value}")), "changed").otherwise("kept")
    return j.select(F.coalesce(f"o.{key}", f"n.{key}").alias(key), change.alias("change"))


def fingerprint(df: DataFrame, columns: list[str]) -> DataFrame:
    """(rows, digest): a content hash that doesn't depend on the order of rows or partitions, repeated rows counted: the hashes
    of the rows, in four numbers each, are added up, so nothing is gathered."""
    row = F.sha2(F.to_json(F.struct(*(F.col(c).cast("string").alias(c) for c in columns)), {"ignoreNullFields": "false"}), 256)
    part = lambda i: F.conv(F.substring("h", 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)")
    sums = df.select(row.alias("h")).agg(F.count("*").alias("rows"), *(F.coalesce(F.sum(part(i)), F.lit(0)).cast("string").alias(f"s{i}") for i in range(4)))
    return sums.select("rows", F.sha2(F.concat_ws(":", F.col("rows").cast("string"), "s0", "s1", "s2", "s3"), 256).alias("digest"))
