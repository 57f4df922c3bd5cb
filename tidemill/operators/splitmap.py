"""Split maps that only grow: which split a group has been given, kept for ever, and how new groups get theirs."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.allocate import by_hash
from tidemill.operators.relate import fingerprint


class SplitConflict(ValueError):
    """Groups that were merged have been given different splits."""


def resolved(groups: DataFrame, known: DataFrame, ratios: dict[str, float], forced: DataFrame | None = None, frozen: bool = False, seed: str = "0") -> DataFrame:
    """(group, split, rule) of every group. groups: group, component (null where it was merged with no other); known, forced:
    group, split.

    kept: the map knows the group. inherited: the map knows others of its component, which agree. forced: a rule says so. hashed:
    neither; the whole component goes by the hash of its name. Components whose known groups disagree raise SplitConflict, and
    with ``frozen`` a group that is not kept raises. Null groups drop out; a group listed twice counts once, with its smallest
    component.
    """
    g = groups.filter("group is not null").groupBy("group").agg(F.min("component").alias("component"))
    j = g.join(known.select("group", F.col("split").alias("old")), "group", "left")
    agreed = j.filter("component is not null and old is not null").groupBy("component").agg(F.min("old").alias("theirs"), F.max("old").alias("other"))
    clash = agreed.filter("theirs <> other").select("component").limit(5).collect()  # examples for the message
    if clash:
        raise SplitConflict(f"merged groups have different splits: {', '.join(str(r[0]) for r in clash)}")
    j = j.join(agreed.select("component", "theirs"), "component", "left")
    if frozen and not j.filter("old is null").isEmpty():
        raise ValueError("the map is frozen, and there are groups that it doesn't know")
    none = F.lit(None).cast("string")
    if forced is not None:
        j = j.join(forced.select("group", F.col("split").alias("must")), "group", "left")
    must = F.col("must") if forced is not None else none
    rule = F.when(F.col("old").isNotNull(), "kept").when(F.col("theirs").isNotNull(), "inherited").when(must.isNotNull(), "forced").otherwise("hashed")
    free = by_hash(F.coalesce(F.concat(F.lit("component:"), F.col("component")), F.col("group")), ratios, seed)
    return j.select("group", F.coalesce("old", "theirs", must, free).alias("split"), rule.alias("rule"))


def save_map(assignments: DataFrame, path: str, header: dict) -> dict:
    """Writes (group, split) as JSON lines in the order of the groups, and a header with their number and content hash. The same
    assignments give the same header, whatever their order. A group with two splits is an error."""
    rows = assignments.select("group", "split").distinct()
    if not rows.groupBy("group").count().filter("count > 1").isEmpty():
        raise ValueError("a group has two splits")
    mark = fingerprint(rows, ["group", "split"]).first()
    head = {**header, "groups": mark["rows"], "digest": mark["digest"]}
    rows.repartitionByRange("group").sortWithinPartitions("group").write.mode("overwrite").json(f"{path}/assignments")
    spark = assignments.sparkSession
    spark.createDataFrame([(json.dumps(head, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/header")
    return head


def load_map(spark: SparkSession, path: str) -> tuple[dict, DataFrame]:
    """The header and (group, split) of a saved map; assignments that don't have the header's content hash are an error."""
    head = json.loads(spark.read.text(f"{path}/header").first()[0])
    rows = spark.read.schema("group string, split string").json(f"{path}/assignments")
    if fingerprint(rows, ["group", "split"]).first()["digest"] != head["digest"]:
        raise ValueError(f"{path}: the assignments are not those of the header")
    return head, rows
