"""Curation operators: facets, projections of codes, confirmation, place groups, precision curves, caches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.functions.identity import trimmed


def facets(sources: DataFrame, has: dict[str, str] | None = None, any_of: dict[str, list[str]] | None = None, wildcard: str = "global", at_least: dict[str, int] | None = None) -> DataFrame:
    """sources with ``match`` and ``reasons``: the conjunction of optional facets over array columns, and which ones fail.

    ``has``: array column holds a value. ``any_of``: array column overlaps a list, or holds the wildcard. ``at_least``: number
    column, null as 0. No facet matches all; a null array holds nothing.
    """
    bad = [F.when(~F.coalesce(F.array_contains(c, v), F.lit(False)), f"{c}: no {v}") for c, v in (has or {}).items()]
    for c, v in (any_of or {}).items():
        ok = F.arrays_overlap(c, F.array(*(F.lit(x) for x in [*v, wildcard])))
        bad.append(F.when(~F.coalesce(ok, F.lit(False)), f"{c}: none of {', '.join(v)}"))
    bad += [F.when(F.coalesce(c, F.lit(0)) < n, f"{c}: below {n}") for c, n in (at_least or {}).items()]
    reasons = F.array_compact(F.array(*bad)) if bad else F.array().cast("array<string>")
    return sources.withColumn("reasons", reasons).withColumn("match", F.size("reasons") == 0)


def gradient_bits(v: Column, n: int) -> Column:
    """Bit string of n - 1 comparisons of neighbours: 1 where the next is greater."""
    return F.array_join(F.transform(F.sequence(F.lit(1), F.lit(n - 1)), lambda i: F.when(F.element_at(v, i + 1) > F.element_at(v, i), "1").otherwise("0")), "")


def mirrored(code: Column) -> Column:
    """A 64-bit hex code with every row of 8 bits reversed (the code of the mirrored picture)."""
    swap = F.translate(code, "0123456789abcdef", "084c2a6e195d3b7f")
    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.reverse(F.substring(swap, i * 2 + 1, F.lit(2)))), "")


def flipped(code: Column) -> tuple[Column, Column]:
    """The 64-bit gradient codes of the picture flipped from left to right and upside down. A bit says that the next pixel
    of a row is brighter, so left to right each row of 8 bits is reversed and inverted (pixels equal to their neighbours
    differ by that, as they have no order); upside down the rows change places."""
    across = F.translate(mirrored(code), "0123456789abcdef", "fedcba9876543210")
    down = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.substring(code, 15 - i * 2, F.lit(2))), "")
    return across, down


def least_of(as_is: Column, across: Column, down: Column) -> tuple[Column, Column]:
    """The least of three distances, and of what orientation it is; the first of equals."""
    best = F.least(as_is, across, down)
    return best, F.when(as_is == best, "as is").when(across == best, "left-right").otherwise("upside down")


def confirm_kind(distance: Column, far: Column, cosine: Column, exact: Column) -> Column:
    """Why a pair is confirmed, the strongest reason first: exact, copy, agree; null if by nothing."""
    return F.when(exact, "exact").when((distance <= 2) & (far <= 24), "copy").when((distance <= 6) & (cosine >= 0.9), "agree")


def place_group(rules: list[tuple[str, Column]]) -> Column:
    """struct<group, rule> of the first rule that gives a non-blank value."""
    out = F.lit(None).cast("struct<grp:string,rule:string>")
    for name, value in reversed(rules):
        v = F.nullif(trimmed(value), F.lit(""))
        out = F.when(v.isNotNull(), F.struct(v.alias("grp"), F.lit(name).alias("rule"))).otherwise(out)
    return out


def cell(lat: Column, lon: Column, day: Column) -> Column:
    """A place of 0.01 degrees and a day; null unless all three are there. Minus zero is zero."""
    two = lambda c: F.regexp_replace(F.format_string("%.2f", c), r"^-0\.00$", "0.00")
    ok = lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon) & day.isNotNull()
    return F.when(ok, F.concat_ws(":", two(F.bround(lat, 2)), two(F.bround(lon, 2)), day.cast("string")))


def average_precision(df: DataFrame, group: str, score: str, hit: str) -> DataFrame:
    """(group, ap): precision at 101 recall levels, each the best at that recall or beyond, averaged. Rows are ranked by
    score, ties as one step, so the result doesn't depend on row order; groups without hits have none."""
    by = df.filter(F.col(score).isNotNull()).groupBy(group, score).agg(F.count("*").alias("n"), F.sum(F.coalesce(F.col(hit), F.lit(False)).cast("int")).alias("k"))
    w = Window.partitionBy(group).orderBy(F.desc(score)).rowsBetween(Window.unboundedPreceding, 0)
    run = by.select(group, F.sum("k").over(w).alias("tp"), F.sum("n").over(w).alias("n"), F.sum("k").over(Window.partitionBy(group)).alias("all")).filter("all > 0")
    pts = run.select(group, F.floor(F.col("tp") * 100 / F.col("all")).cast("int").alias("level"), (F.col("tp") / F.col("n")).alias("p"))
    best = pts.groupBy(group, "level").agg(F.max("p").alias("p"))
    grid = best.withColumn("l", F.explode(F.sequence(F.lit(0), F.col("level")))).groupBy(group, "l").agg(F.max("p").alias("p"))
    return grid.groupBy(group).agg((F.sum("p") / 101).alias("ap"))


def cached(spark: SparkSession, path: str, wanted: DataFrame, key: str, compute) -> DataFrame:
    """Values of all wanted keys: those in the table at ``path``, and the rest computed and appended to it."""
    keys = wanted.select(key).filter(F.col(key).isNotNull()).distinct()
    try:
        known = spark.read.parquet(path)
    except Exception:  # nothing cached yet
        known = None
    compute(keys if known is None else keys.join(known.select(key), key, "left_anti")).write.mode("append").parquet(path)
    return spark.read.parquet(path).join(keys, key, "left_semi")
