"""Problem 4: splits that keep related records together."""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.identity import word
from tidemill.llm.groups import components
from tidemill.session import Scratch

#: The spellings of the three splits, lower case.
SPLITS = {"train": "train", "training": "train", "val": "val", "valid": "val", "validation": "val", "dev": "val", "test": "test", "testing": "test"}
#: Words that stand for "no group"; signs without a letter or digit stand for it as well.
NONE_WORDS = ["none", "null", "nil", "na", "n/a", "n.a.", "n.a", "nan", "unknown", "unk", "unspecified", "undefined", "missing", "not available", "not applicable", "no group", "ungrouped", "tbd", "<na>", "<none>", "<null>", "(none)", "(null)", "[none]", "#n/a"]
#: Target proportions, and equal bins that are dealt out to them.
PROPORTIONS = {"train": 0.70, "val": 0.15, "test": 0.15}
BINS = 40
#: A site code, a date and a frame number, in this order; marks before the number are letters or signs.
FRAME = r"(?<![a-z0-9])([a-z]{3})[^a-z0-9]*([a-z]?)[^a-z0-9]*(\d{3,4})[^a-z0-9]+(\d{4})[^a-z0-9]?(\d{2})[^a-z0-9]?(\d{2})(?:[^a-z0-9]+(?:frame|frm|fr|f|img|image|no|nr|num|n|seq|s|shot|pic|photo|p)?[^a-z0-9]*|(?:frame|frm|fr|f|img|image|no|nr|num|n|seq|s|shot|pic|photo|p)[^a-z0-9]*)(\d+)"


def split_name(c: Column) -> Column:
    """train, val or test; null for everything else."""
    w = word(c)
    return F.create_map(*(F.lit(x) for kv in SPLITS.items() for x in kv))[w]


def group_key(c: Column) -> Column:
    """The split group without case and outer blanks; null where the value names none."""
    w = word(c)
    return F.when(~w.isin(NONE_WORDS) & w.rlike(r"[\p{L}\p{N}]"), w)


def frame_key(stem: Column) -> Column:
    """site|date|number of the frame a stem names, or null. Separators, case, leading zeros of the number, marks before it
    and what stands around the three carry no meaning; the date must have a possible month and day."""
    low = F.lower(stem)
    part = lambda i: F.regexp_extract(low, FRAME, i)
    number = F.ltrim(part(7), F.lit("0"))
    real = low.rlike(FRAME) & part(5).between("01", "12") & part(6).between("01", "31")
    return F.when(real, F.concat_ws("|", F.concat(part(1), part(2), part(3)), F.concat(part(4), part(5), part(6)), number))


def bundles(spark: SparkSession, staged: DataFrame, scratch: Scratch) -> DataFrame:
    """(staged_id, split, bundle): rows that share a split group or a frame, directly or through others, have one bundle.

    The graph is that of the keys, not of the rows: a row that has both a group and a frame links the two, equal links
    count once, so a group of a third of all rows is one vertex. A row without either key is its own bundle; null stems
    and groups link nothing.
    """
    rows = staged.select(
        "staged_id",
        split_name(F.col("upstream_split")).alias("split"),
        F.concat(F.lit("g:"), group_key(F.col("split_group"))).alias("g"),
        F.concat(F.lit("f:"), frame_key(F.col("stem"))).alias("f"),
    )
    rows = scratch.keep(rows)
    links = rows.filter("g is not null and f is not null").select(F.col("g").alias("a"), F.col("f").alias("b")).distinct()
    root = components(spark, links, scratch).select(F.col("v").alias("key"), "root")
    rows = rows.withColumn("key", F.coalesce("g", "f", F.concat(F.lit("r:"), F.col("staged_id").cast("string"))))
    return rows.join(root, "key", "left").select("staged_id", "split", F.coalesce("root", "key").alias("bundle"))


def torn(spark: SparkSession, staged: DataFrame) -> DataFrame:
    """staged_id of every row of a bundle whose rows are in two or more of the upstream splits train, val and test."""
    scratch = Scratch(spark, "splits")
    rows = scratch.keep(bundles(spark, staged, scratch))
    bad = rows.filter("split is not null").groupBy("bundle").agg(F.min("split").alias("a"), F.max("split").alias("b")).filter("a <> b")
    return rows.join(bad, "bundle", "left_semi").select("staged_id")


def differencing(weights: list[int], bins: int = BINS) -> list[int]:
    """Bin of each weight: the two partial solutions with the widest spread are combined, largest bin with smallest,
    until one is left (Karmarkar and Karp's largest differencing)."""
    heap = [(-w, i, [(w, [i])] + [(0, [])] * (bins - 1)) for i, w in enumerate(weights)]
    heapq.heapify(heap)
    n = len(weights)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        both = sorted(((x[0] + y[0], x[1] + y[1]) for x, y in zip(a, reversed(b), strict=True)), key=lambda t: -t[0])
        heapq.heappush(heap, (both[-1][0] - both[0][0], n, both))
        n += 1
    out = [0] * len(weights)
    for k, (_, items) in enumerate(heap[0][2] if heap else []):
        for i in items:
            out[i] = k
    return out


def deal(sizes: list[int], proportions: dict[str, float]) -> list[str]:
    """Split of each bin: largest bins first, each to the split that lacks most of its share."""
    total, lack, out = sum(sizes), {}, [""] * len(sizes)
    lack = {k: p * total for k, p in proportions.items()}
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        to = max(lack, key=lambda k: lack[k])
        out[i] = to
        lack[to] -= sizes[i]
    return out


def assign(spark: SparkSession, staged: DataFrame, proportions: dict[str, float] | None = None, bins: int = BINS) -> DataFrame:
    """(staged_id, bundle, split): every bundle whole in one split, splits near their proportions.

    Bundles of equal weight are interchangeable, so only the counts per weight reach the driver (distinct weights of n
    rows are fewer than sqrt(2n)). Of ``m`` bundles of a weight, ``m // bins`` go to each bin by their rank, and the rest,
    fewer than ``bins`` per weight, are balanced by largest differencing; then whole bins are dealt out.
    """
    proportions = proportions or PROPORTIONS
    scratch = Scratch(spark, "splits")
    rows = scratch.keep(bundles(spark, staged, scratch))
    sizes = scratch.keep(rows.groupBy("bundle").agg(F.count("*").alias("w")).repartitionByRange("w", "bundle").sortWithinPartitions("w", "bundle").withColumn("at", F.monotonically_increasing_id()))
    # rank within a weight without one task per weight: position in the sorted partition, plus what earlier ones hold
    sizes = sizes.withColumn("part", F.call_function("shiftright", "at", F.lit(33)))
    held = sizes.groupBy("w", "part").agg(F.count("*").alias("n"), F.min("at").alias("first")).collect()
    held.sort(key=lambda r: (r["w"], r["part"]))
    count: dict[int, int] = {}
    offsets = []
    for r in held:
        offsets.append((r["w"], r["part"], r["first"], count.get(r["w"], 0)))
        count[r["w"]] = count.get(r["w"], 0) + r["n"]
    rest = [w for w in sorted(count, reverse=True) for _ in range(count[w] % bins)]
    place = differencing(rest, bins)
    load = [sum(w * (m // bins) for w, m in count.items())] * bins
    for w, b in zip(rest, place, strict=True):
        load[b] += w
    names = deal(load, proportions)
    extra: dict[int, list[int]] = {}
    for w, b in zip(rest, place, strict=True):
        extra.setdefault(w, []).append(b)
    start = spark.createDataFrame(offsets, "w bigint, part bigint, first bigint, before bigint")
    table = spark.createDataFrame([(w, m - m % bins, extra.get(w, [])) for w, m in count.items()], "w bigint, even bigint, extra array<int>")
    ranked = sizes.join(start, ["w", "part"]).withColumn("rank", F.col("before") + F.col("at") - F.col("first")).join(table, "w")
    bin_of = F.when(F.col("rank") < F.col("even"), F.pmod("rank", F.lit(bins))).otherwise(F.get("extra", (F.col("rank") - F.col("even")).cast("int")))
    dealt = F.element_at(F.array(*(F.lit(n) for n in names)), bin_of.cast("int") + 1)
    return rows.select("staged_id", "bundle").join(ranked.select("bundle", dealt.alias("split")), "bundle").select("staged_id", "bundle", "split")


def balance(spark: SparkSession, staged: DataFrame, proportions: dict[str, float] | None = None) -> DataFrame:
    """(split, target, rows, share, torn, within) of the assignment: rows and their share, the bundles that lie in more than
    one split (none may), and whether the share is off by no more than one bin and one bundle of the largest: whole bundles
    cannot be dealt out closer in general. A split that gets no rows has share 0; without rows every share is 0 and within."""
    proportions = proportions or PROPORTIONS
    scratch = Scratch(spark, "balance")
    given = scratch.keep(assign(spark, staged, proportions).select("bundle", "split"))
    torn = given.distinct().groupBy("bundle").count().filter("count > 1").count()
    largest = given.groupBy("bundle").count().agg(F.max("count")).first()[0] or 0
    total = given.count()
    targets = spark.createDataFrame(list(proportions.items()), "split string, target double")
    rows = targets.join(given.groupBy("split").agg(F.count("*").alias("rows")), "split", "left").withColumn("rows", F.coalesce("rows", F.lit(0).cast("bigint")))
    share = F.col("rows") / F.lit(max(1, total))
    off = F.lit(largest / max(1, total) + 1 / BINS)
    within = (F.abs(share - F.col("target")) <= off) | F.lit(total == 0)
    return rows.select("split", "target", "rows", share.alias("share"), F.lit(torn).cast("bigint").alias("torn"), within.alias("within"))
