"""All queries of the core package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemill.plans import curation, grouping, layouts, measures, ordering, problems, quality, relations, resolution, scalars, storage, streams

Query = Callable[[SparkSession, str], DataFrame]
MODULES = [problems, layouts, scalars, relations, ordering, measures, quality, streams, grouping, storage, curation, resolution]


def queries() -> dict[str, Query]:
    return {k: v for m in MODULES for k, v in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in MODULES for k, v in m.SQL.items()}
