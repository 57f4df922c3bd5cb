"""Resolution: greedy exclusion, best matches, names, choices and tables in text."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.identity import word
from tidemill.session import Scratch


def greedy_exclusion(spark: SparkSession, pairs: DataFrame, protected: DataFrame | None = None) -> DataFrame:
    """(v): vertices to drop so that no pair (a, b) is left, as when again and again the unprotected vertex with the most
    partners is dropped, ties to the smallest.

    In each round every vertex that comes before all its partners in that order is dropped at once. Degrees only fall, so
    none of its partners could have been dropped earlier, and the result is that of the sequential rule, in a few rounds
    instead of one per vertex. Pairs of two protected vertices stay. Loops and null ends are no pairs.
    """
    scratch = Scratch(spark, "exclusion")
    p = pairs.select("a", "b").filter("a is not null and b is not null and a <> b")
    both = p.union(p.select(F.col("b"), F.col("a"))).distinct()
    if protected is not None:
        safe = protected.select(F.col("v")).distinct()
        mark = lambda df, c: df.join(safe.select(F.col("v").alias(c), F.lit(True).alias(f"safe_{c}")), c, "left")
        both = mark(mark(both, "a"), "b").select("a", "b", F.coalesce("safe_a", F.lit(False)).alias("safe_a"), F.coalesce("safe_b", F.lit(False)).alias("safe_b"))
    else:
        both = both.select("a", "b", F.lit(False).alias("safe_a"), F.lit(False).alias("safe_b"))
    live = scratch.keep(both.filter("not (safe_a and safe_b)"))
    dropped: DataFrame | None = None
    while not live.isEmpty():
        degree = scratch.keep(live.groupBy("a").agg(F.count("*").alias("n"), F.max("safe_a").alias("safe")))
        rank = lambda c: degree.select(F.col("a").alias(c), F.col("n").alias(f"n_{c}"))  # noqa: E731, B023
        edges = live.join(rank("a"), "a").join(rank("b"), "b").filter("not safe_a")
        beaten = ~F.col("safe_b") & ((F.col("n_b") > F.col("n_a")) | ((F.col("n_b") == F.col("n_a")) & (F.col("b") < F.col("a"))))
        out = scratch.keep(edges.groupBy("a").agg(F.max(beaten).alias("beaten")).filter("not beaten").select("a"))
        dropped = out if dropped is None else dropped.union(out)
        left = live.join(out, "a", "left_anti").join(out.select(F.col("a").alias("b")), "b", "left_anti").select("a", "b", "safe_a", "safe_b")
        left = scratch.keep(left)
        scratch.drop(live)
        scratch.drop(degree)
        live = left
    if dropped is None:
        return both.select(F.col("a").alias("v")).limit(0)
    return dropped.select(F.col("a").alias("v"))


def best_match(left: DataFrame, right: DataFrame, keys: list[list[str]], out: str) -> DataFrame:
    """left with ``out`` of the first key list that matches (the smallest of several), and ``level``, the position of that
    list from 1; null and null where none does. Null parts of a key match nothing."""
    x = left
    for i, key in enumerate(keys):
        r = right.groupBy(*key).agg(F.min(out).alias(f"_m{i}"))
        x = x.join(r, key, "left")
    found = F.coalesce(*(F.when(F.col(f"_m{i}").isNotNull(), F.lit(i + 1)) for i in range(len(keys))))
    return x.select(*left.columns, F.coalesce(*(F.col(f"_m{i}") for i in range(len(keys)))).alias(out), found.alias("level"))


def resolved_names(names: DataFrame, pool: DataFrame, name: str, key: str, accepted: Column, preferred: Column) -> DataFrame:
    """(name, key, matches): of the pool's rows with the same name (without case and outer blanks) an accepted one first,
    then a preferred one, then the smallest key; a name without match has null and 0."""
    p = pool.select(word(F.col(name)).alias("_n"), F.col(key).alias("_k"), F.struct(~F.coalesce(accepted, F.lit(False)), ~F.coalesce(preferred, F.lit(False)), F.col(key)).alias("_o")).filter("_n is not null")
    best = p.groupBy("_n").agg(F.min_by("_k", "_o").alias("_k"), F.countDistinct("_k").alias("matches"))
    x = names.select(name).distinct()
    return x.join(best, word(F.col(name)) == F.col("_n"), "left").select(name, F.col("_k").alias(key), F.coalesce("matches", F.lit(0)).alias("matches"))


LETTER = re.compile(r"^\s*\(?([A-Z])[).:]\s*(.+?)\s*$")


def choices(text: str | None) -> list[str]:
    """The options of a multiple-choice question, in order; none if there are fewer than two.

    Either one per line, lettered A, B, C, ... without a gap; or in one line that opens with A, where only the next letter in
    turn is a marker, so that other single letters stay part of an option.
    """
    if not text:
        return []
    lines = [m.groups() for m in map(LETTER.match, text.splitlines()) if m]
    if len(lines) >= 2:
        return [t for _, t in lines] if "".join(k for k, _ in lines) == "ABCDEFGHIJKLMNOPQRSTUVWXYZ"[: len(lines)] else []
    for line in text.splitlines():
        if not re.match(r"^\s*\(?A[).:]\s", line):
            continue
        out, at, letter = [], 0, "A"
        while m := re.compile(rf"(?:^|\s)\(?{letter}[).:]\s").search(line, at):
            if letter != "A":
                out.append(line[at : m.start()].strip())
            at, letter = m.end(), chr(ord(letter) + 1)
        out.append(line[at:].strip())
        if len(out) >= 2:
            return out
    return []


def with_choices(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, options) of every row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({key: b[key], "options": [choices(t) for t in b[text]]})

    return df.select(key, text).mapInPandas(run, f"`{key}` {df.schema[key].dataType.simpleString()}, options array<string>")


def html_rows(html: Column) -> Column:
    """array<array<string>>: the cells of every table row of a page, tags and entities for blanks removed."""
    clean = lambda c: F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "(?s)<[^>]*>", " "), "&nbsp;", " "), r"\s+", " "))
    rows = F.regexp_extract_all(html, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))
    return F.transform(rows, lambda r: F.transform(F.regexp_extract_all(r, F.lit(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"), F.lit(1)), clean))
