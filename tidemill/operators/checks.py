"""Data-quality checks as queries: each gives (gate, kind, n), exact counts of what is wrong, and nothing if all is well."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rule_counts(gate: str, df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Row rules counted in one pass over the table."""
    by = df.agg(*(F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in rules.items()))
    stack = ", ".join(f"'{k}', `{k}`" for k in rules)
    out = by.select(F.expr(f"stack({len(rules)}, {stack}) as (kind, n)"))
    return out.filter("n > 0").select(F.lit(gate).alias("gate"), "kind", "n")


def repeated(gate: str, kind: str, df: DataFrame, keys: list[str]) -> DataFrame:
    """How many keys occur more than once."""
    n = df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1").agg(F.count("*").alias("n"))
    return n.filter("n > 0").select(F.lit(gate).alias("gate"), F.lit(kind).alias("kind"), "n")


def unmatched(gate: str, kind: str, df: DataFrame, base: DataFrame, key: str) -> DataFrame:
    """Rows whose key is null or not in base."""
    n = df.join(base.select(key).distinct(), key, "left_anti").agg(F.count("*").alias("n"))
    return n.filter("n > 0").select(F.lit(gate).alias("gate"), F.lit(kind).alias("kind"), "n")


def together(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def verdict(found: DataFrame, gates: list[str]) -> DataFrame:
    """(gate, status, n) of every gate asked for; one without findings has passed."""
    all_ = found.sparkSession.createDataFrame([(g,) for g in gates], "gate string")
    n = found.groupBy("gate").agg(F.sum("n").alias("n"))
    return all_.join(n, "gate", "left").select("gate", F.when(F.col("n") > 0, "failed").otherwise("passed").alias("status"), F.coalesce("n", F.lit(0)).alias("n"))
