"""Labels mapped to a shared hierarchy: closure, projection to the classes of a task, coverage, label maps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.session import Scratch


def ancestors(nodes: DataFrame, scratch: Scratch, node: str = "node", parent: str = "parent") -> DataFrame:
    """(node, ancestor, distance): each node with itself and everything above it, by doubling; for vocabularies, whose
    depth is small (closures grow with nodes times depth; use intervals for deep trees). Nodes on cycles are cut off after
    as many steps as there are nodes."""
    up = nodes.select(F.col(node).alias("node"), F.col(parent).alias("ancestor"), F.lit(1).alias("distance")).filter("ancestor is not null and node <> ancestor")
    closure = scratch.keep(up)
    limit, reach = nodes.count(), 1
    while reach < limit:
        a, b = closure.alias("a"), closure.alias("b")
        more = a.join(b, F.col("a.ancestor") == F.col("b.node")).filter("a.node <> b.ancestor")
        more = more.select("a.node", "b.ancestor", (F.col("a.distance") + F.col("b.distance")).alias("distance"))
        new = scratch.keep(closure.union(more).groupBy("node", "ancestor").agg(F.min("distance").alias("distance")))
        grew = new.count() > closure.count()
        scratch.drop(closure)
        closure, reach = new, reach * 2
        if not grew:
            break
    own = nodes.select(F.col(node).alias("node"), F.col(node).alias("ancestor"), F.lit(0).alias("distance"))
    return closure.union(own)


def project(labels: DataFrame, closure: DataFrame, targets: DataFrame, label: str, target: str) -> DataFrame:
    """(label, class, reason): exact if the label is a class of the task, rolled up to the nearest class above it, coarser if
    only classes below it exist, outside otherwise; unknown labels (null or not in the hierarchy) are outside too."""
    t = targets.select(F.col(target).alias("t")).distinct()
    above = closure.join(t, F.col("ancestor") == F.col("t")).groupBy("node").agg(F.min_by("t", F.struct("distance", "t")).alias("class"), F.min("distance").alias("distance"))
    below = closure.filter("distance > 0").join(t, F.col("node") == F.col("t")).select(F.col("ancestor").alias("node"), F.lit(True).alias("coarse")).distinct()
    x = labels.select(F.col(label).alias("node")).distinct().join(above, "node", "left").join(below, "node", "left")
    reason = F.when(F.col("distance") == 0, "exact").when(F.col("distance") > 0, "rolled up").when(F.col("coarse"), "coarser").otherwise("outside")
    return x.select(F.col("node").alias(label), "class", reason.alias("reason"))


def label_map(edges: DataFrame, observed: DataFrame, label: str, target: str) -> DataFrame:
    """(label, target, mapped): every edge, and every observed label without one as unmapped."""
    e = edges.select(label, target).filter(F.col(label).isNotNull()).distinct()
    lost = observed.select(label).filter(F.col(label).isNotNull()).distinct().join(e, label, "left_anti")
    return e.select(label, target, F.lit(True).alias("mapped")).union(lost.select(label, F.lit(None).cast("string"), F.lit(False)))
