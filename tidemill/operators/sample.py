"""Deterministic sampling, ranking and packing. Every choice is a function of keys, never of arrival order."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.session import Scratch


def draw(*parts: Column | str, seed: str = "0") -> Column:
    """A hash that orders rows at random: sha-256 of seed and keys."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.sha2(F.concat_ws(":", F.lit(seed), *(c.cast("string") for c in cols)), 256)


def unit(*parts: Column | str, seed: str = "0") -> Column:
    """A uniform number in [0, 1) from the first 52 bits of the hash."""
    return F.conv(F.substring(draw(*parts, seed=seed), 1, 13), 16, 10).cast("double") / float(1 << 52)


def first_rows(df: DataFrame, group: list[str], order: list[Column], cap: int | Column, spread: Column, buckets: int = 64) -> DataFrame:
    """The first ``cap`` rows of each group in an order. First within ``buckets`` pieces of a group, by the hash of ``spread``,
    then among the survivors, so that a group of a third of all rows is ranked in pieces. ``cap`` may be a column."""
    x = df.withColumn("_b", F.pmod(F.xxhash64(spread), F.lit(buckets)))
    for part in ([*group, "_b"], group):
        x = x.withColumn("_r", F.row_number().over(Window.partitionBy(*part).orderBy(*order))).filter(F.col("_r") <= cap)
    return x.drop("_b", "_r")


def lowest(df: DataFrame, group: list[str], key: str, cap: int, seed: str = "0", buckets: int = 64) -> DataFrame:
    """The ``cap`` rows of each group with the lowest draws; ties by key."""
    return first_rows(df.withColumn("_d", draw(key, seed=seed)), group, [F.col("_d"), F.col(key)], cap, F.col(key), buckets).drop("_d")


def running(df: DataFrame, order: list[str], totals: dict[str, Column]) -> DataFrame:
    """Adds totals over all rows before each one in the total order of the columns, without one task for it: what stands
    before it in its sorted partition, plus what the partitions before hold (a row per partition).

    The sorted rows are written first, as both are read from the same partitions.
    """
    x = df.select("*", *(c.alias(f"_v_{k}") for k, c in totals.items()))
    x = x.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    x = Scratch(df.sparkSession, "running").keep(x).withColumn("_p", F.call_function("shiftright", "_at", F.lit(33)))
    here, parts = Window.partitionBy("_p").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1), Window.orderBy("_p")
    sums = x.groupBy("_p").agg(*(F.sum(f"_v_{k}").alias(f"_s_{k}") for k in totals))
    sums = sums.select("_p", *((F.sum(f"_s_{k}").over(parts) - F.col(f"_s_{k}")).alias(f"_b_{k}") for k in totals))
    x = x.select("*", *(F.coalesce(F.sum(f"_v_{k}").over(here), F.lit(0)).alias(f"_h_{k}") for k in totals)).join(F.broadcast(sums), "_p")
    return x.select(*df.columns, *((F.col(f"_b_{k}") + F.col(f"_h_{k}")).alias(k) for k in totals))


def positions(df: DataFrame, *order: str, out: str = "i") -> DataFrame:
    """Adds the 0-based position in the total order of the columns."""
    return running(df, list(order), {out: F.lit(1).cast("bigint")})


def ranked(df: DataFrame, group: str, order: str, out: str = "i") -> DataFrame:
    """Adds the 1-based rank within a group, by the position in the order of all rows and the first one of the group, so that a
    group of a third of all rows is no single task. Null groups drop out."""
    x = positions(df.filter(F.col(group).isNotNull()), group, order, out="_i")
    first = x.groupBy(group).agg(F.min("_i").alias("_first"))
    return x.join(first, group).withColumn(out, (F.col("_i") - F.col("_first") + 1)).drop("_i", "_first")


def stride(df: DataFrame, order: str, n: int) -> DataFrame:
    """n rows spread evenly over the sorted rows: those at floor(i * rows / n)."""
    x = positions(df, order, out="_i").withColumn("_total", df.agg(F.count("*")).scalar())
    step = F.floor((F.col("_i") * n + F.col("_total") - 1) / F.col("_total"))
    first = (F.floor(step * F.col("_total") / n) == F.col("_i")) & (step < n)
    return x.filter(first | (F.col("_total") <= n)).drop("_i", "_total")


def quotas(df: DataFrame, stratum: str, n: int) -> DataFrame:
    """(stratum, size, quota): proportional, at least one, never more than there are."""
    by = df.groupBy(stratum).agg(F.count("*").alias("size"))
    total = df.count()
    return by.withColumn("quota", F.least("size", F.greatest(F.lit(1), F.round(F.lit(float(n)) * F.col("size") / total, 0).cast("bigint"))))


def stratified(df: DataFrame, stratum: str, key: str, n: int, seed: str = "0") -> DataFrame:
    """A proportional sample: each stratum's quota of rows with the lowest draws."""
    x = df.join(quotas(df, stratum, n), stratum)
    return first_rows(x, [stratum], [draw(key, seed=seed), F.col(key)], F.col("quota"), F.col(key)).drop("size", "quota")


def whole_groups(df: DataFrame, group: str, cap: int, seed: str = "0") -> DataFrame:
    """Whole groups in random order until their sizes reach ``cap``; the last may overshoot."""
    sizes = df.groupBy(group).agg(F.count("*").alias("n")).withColumn("d", draw(group, seed=seed))
    first = running(sizes, ["d", group], {"before": F.col("n")}).filter(F.col("before") < cap)
    return df.join(first.select(group), group, "left_semi")


def packed(df: DataFrame, lane: str, order: str, size: str, target: int) -> DataFrame:
    """(lane, order, chunk): rows packed in order into chunks of at most ``target``; a larger row has its own. The sum starts
    anew with each chunk, which no window frame expresses, so each lane is walked once, batch by batch."""

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, chunk, held = None, 0, 0
        for b in batches:
            out = []
            for k, n in zip(b[lane], b[size], strict=True):
                if k != at:
                    at, chunk, held = k, 0, 0
                elif held and held + n > target:
                    chunk, held = chunk + 1, 0
                held += n
                out.append(chunk)
            yield pd.DataFrame({lane: b[lane], order: b[order], "chunk": out})

    x = df.select(lane, order, size).repartition(lane).sortWithinPartitions(lane, order)
    kinds = {f.name: f.dataType.simpleString() for f in x.schema.fields}
    return x.mapInPandas(walk, f"`{lane}` {kinds[lane]}, `{order}` {kinds[order]}, chunk int")


def kept_frames(df: DataFrame, clip: str, frame: str, code: str, radius: int) -> DataFrame:
    """Frames of a clip without those within ``radius`` bits of the last frame kept; a null code is kept and changes
    nothing. State runs along a clip, batch by batch."""

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, last = object(), None
        for b in batches:
            keep = []
            for k, c in zip(b[clip], b[code], strict=True):
                if k != at:
                    at, last = k, None
                if c is None or pd.isna(c):
                    keep.append(True)
                    continue
                bits = int(c, 16)
                keep.append(last is None or (bits ^ last).bit_count() > radius)
                if keep[-1]:
                    last = bits
            yield b.loc[keep, [clip, frame]]

    x = df.select(clip, frame, code).repartition(clip).sortWithinPartitions(clip, frame)
    kinds = {f.name: f.dataType.simpleString() for f in x.schema.fields}
    return x.mapInPandas(walk, f"`{clip}` {kinds[clip]}, `{frame}` {kinds[frame]}")


def first_of(df: DataFrame, group: str, key: str, n: int, buckets: int = 64) -> DataFrame:
    """(group, first): the n smallest keys of each group, never holding more than ``buckets * n`` of a group at once."""
    w = Window.partitionBy(group, "b").orderBy(key)
    x = df.select(group, key, F.pmod(F.xxhash64(key), F.lit(buckets)).alias("b")).withColumn("r", F.row_number().over(w)).filter(F.col("r") <= n)
    return x.groupBy(group).agg(F.slice(F.array_sort(F.collect_list(key)), 1, n).alias("first"))


def lagged(df: DataFrame, order: list[str], taken: list[str], suffix: str = "_before") -> DataFrame:
    """Adds the values that the columns ``taken`` have in the row before, in the total order of the columns, without one task for
    it or for a hot key: within sorted partitions by a window, across them by the last row of each partition."""
    x = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    x = Scratch(df.sparkSession, "lagged").keep(x).withColumn("_p", F.call_function("shiftright", "_at", F.lit(33)))
    last = x.groupBy("_p").agg(F.max_by(F.struct(*taken), "_at").alias("_l"))
    last = last.select("_p", F.lag("_l").over(Window.orderBy("_p")).alias("_l"))  # a row per partition
    here = Window.partitionBy("_p").orderBy("_at")
    x = x.withColumns({"_r": F.row_number().over(here), "_h": F.lag(F.struct(*taken)).over(here)}).join(F.broadcast(last), "_p")
    before = F.when(F.col("_r") == 1, F.col("_l")).otherwise(F.col("_h"))
    return x.select(*df.columns, *(before[c].alias(f"{c}{suffix}") for c in taken))


def half_equal(sizes: dict[str, int], n: int) -> dict[str, int]:
    """How many of ``n`` rows each stratum gives: half of them shared equally, half by size, none more than it has; what is then
    missing comes one by one from the stratum with most rows left, what is too much is taken from the largest share (ties: the
    last name). Works on the driver on one number per stratum."""
    if not sizes:
        return {}
    total = sum(sizes.values())
    share = {k: min(size, int(n / 2 / len(sizes)) + round(n / 2 * size / max(1, total))) for k, size in sizes.items()}
    while sum(share.values()) < min(n, total):
        share[max((k for k in sizes if share[k] < sizes[k]), key=lambda k: (sizes[k] - share[k], k))] += 1
    while sum(share.values()) > n:
        share[max(share, key=lambda k: (share[k], k))] -= 1
    return share


def half_equal_sample(df: DataFrame, stratum: str, key: str, n: int, seed: str = "0") -> DataFrame:
    """A sample of ``n`` rows by ``half_equal``, with ``weight``: the rows that each one stands for. Null strata are left out."""
    df = df.filter(F.col(stratum).isNotNull())
    sizes = {str(r[0]): r[1] for r in df.groupBy(F.col(stratum).cast("string")).count().collect()}  # one number per stratum
    share = half_equal(sizes, n)
    table = df.sparkSession.createDataFrame([(k, m, sizes[k] / m if m else None) for k, m in share.items()], "_k string, quota int, weight double")
    x = df.join(table, F.col(stratum).cast("string") == F.col("_k")).drop("_k")
    return first_rows(x, [stratum], [draw(key, seed=seed), F.col(key)], F.col("quota"), F.col(key)).drop("quota")
