"""Typed tables whose schema grew over time."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def conformed(df: DataFrame, schema: str | StructType) -> DataFrame:
    """The columns of a schema in its order: missing ones null, others dropped, values that don't fit a type null."""
    want = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    have = set(df.columns)
    one = lambda f: (F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
    return df.select(*(one(f) for f in want.fields))


def load_versions(spark: SparkSession, paths: list[str], schema: str | StructType) -> DataFrame:
    """Parquet tables of several versions of a schema as one; each is read with its own columns, so pruning still works."""
    return reduce(DataFrame.unionByName, (conformed(spark.read.parquet(p), schema) for p in paths))


def schema_faults(df: DataFrame, schema: str | StructType) -> list[str]:
    """What a table's schema lacks, has besides, or types otherwise; empty if it conforms."""
    want = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    have = {f.name: f.dataType for f in df.schema.fields}
    out = [f"missing {f.name}" for f in want.fields if f.name not in have]
    out += [f"{f.name} is {have[f.name].simpleString()}, not {f.dataType.simpleString()}" for f in want.fields if f.name in have and have[f.name] != f.dataType]
    return out + [f"unknown {n}" for n in have if n not in want.fieldNames()]
