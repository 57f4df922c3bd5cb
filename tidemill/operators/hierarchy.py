"""Problem 6: parent-child links to full hierarchies, by heavy-path decomposition.

Every round is a join or an aggregation on the node table; the number of rounds is logarithmic in the deepest chain, so
the depth is not assumed, and nothing but counts reaches the driver.

1. Pointer doubling follows each node ``2**k`` steps up. Nodes from which no root is ever reached are on a cycle or below
   one and are set apart; the smallest key of their cycle comes from further jumps.
2. The same jumps add up subtree sizes: the nodes less than ``2**(k+1)`` below a node are those less than ``2**k`` below
   it, and the like of every node exactly ``2**k`` below.
3. The child with the largest subtree continues its parent's chain (ties: smallest key), the others begin chains. The
   head of a node's chain, and its place on it, are found by doubling along chains only.
4. A path crosses at most ``log2(n)`` chains. So the chains, a far smaller tree, get depth, root and path in few rounds,
   and a node adds its place on its own chain. Numbers are pre-order: the descendants of a node are the nodes numbered
   above its own number up to its last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.functions.identity import word
from tidemill.session import Scratch

#: Pieces in which the children of one parent are numbered.
SIBLING_BUCKETS = 1024


def current_nodes(rows: DataFrame) -> DataFrame:
    """(node, parent, rank): of each key's node rows the one of the highest version, its numbers compared one by one.

    Rows of equal version are settled by the smallest parent, then rank, present before null. Keys are lower-cased and
    trimmed; null and blank keys are no nodes. A parent that is blank or names no node comes out null.
    """
    numbers = F.transform(F.regexp_extract_all("taxonomy_version", F.lit("([0-9]+)"), F.lit(1)), lambda x: F.lpad(F.ltrim(x, F.lit("0")), 12, "0"))
    rows = rows.filter(word(F.col("kind")) == "node").select(
        word(F.col("key")).alias("node"),
        word(F.col("parent")).alias("parent"),
        word(F.col("rank")).alias("rank"),
        F.coalesce(numbers, F.array().cast("array<string>")).alias("version"),
    )
    rows = rows.filter("node is not null")
    newest = rows.groupBy("node").agg(F.max("version").alias("version"))
    order = F.struct(F.col("parent").isNull(), "parent", F.col("rank").isNull(), "rank")
    nodes = rows.join(newest, ["node", "version"]).groupBy("node").agg(F.min_by(F.struct("parent", "rank"), order).alias("v"))
    nodes = nodes.select("node", "v.parent", "v.rank")
    known = nodes.select(F.col("node").alias("parent"), F.lit(True).alias("known"))
    return nodes.join(known, "parent", "left").select("node", F.when(F.col("known"), F.col("parent")).alias("parent"), "rank")


def _climb(nodes: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(node, size) of the nodes that reach a root, and (node, root_key) of those that don't."""
    # up: the node 2**k above (null beyond the root); near: nodes less than 2**k below, the node itself included;
    # low: the smallest key among the node and those less than 2**k above
    state = scratch.keep(nodes.select("node", F.col("parent").alias("up"), F.lit(1).cast("bigint").alias("near"), F.col("node").alias("low")))
    steps, left, before = 1, nodes.filter("parent is not null").count(), -1
    # a tree holds nodes of every depth down to its deepest, so a round in which nobody reaches a root was the last one
    while left and left != before:
        above = state.select(F.col("node").alias("up"), F.col("up").alias("up2"), F.col("low").alias("low2"))
        below = state.filter("up is not null").groupBy("up").agg(F.sum("near").alias("more")).withColumnRenamed("up", "node")
        new = state.join(above, "up", "left").join(below, "node", "left")
        new = new.select("node", F.col("up2").alias("up"), (F.col("near") + F.coalesce("more", F.lit(0))).alias("near"), F.least("low", "low2").alias("low"))
        new = scratch.keep(new)
        scratch.drop(state)
        state, steps, before = new, steps * 2, left
        left = state.filter("up is not null").count()
    trees = state.filter("up is null").select("node", F.col("near").alias("size"))
    state = scratch.keep(state.filter("up is not null").select("node", "up", "low"))
    while steps <= left:
        above = state.select(F.col("node").alias("up"), F.col("up").alias("up2"), F.col("low").alias("low2"))
        new = scratch.keep(state.join(above, "up").select("node", F.col("up2").alias("up"), F.least("low", "low2").alias("low")))
        scratch.drop(state)
        state, steps = new, steps * 2
    # after at least as many steps as there are nodes, up is on the cycle, and from there low is the least of all of it
    turn = state.select(F.col("node").alias("up"), F.col("low").alias("root_key"))
    cycles = state.select("node", "up").join(turn, "up").select("node", "root_key")
    return trees, cycles


def chains(nodes: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(node, parent, rank, size, head, place) of the nodes that reach a root, and (node, root_key) of those that don't."""
    trees, cycles = _climb(nodes, scratch)
    tree = scratch.keep(nodes.join(trees, "node"))
    heavy = tree.filter("parent is not null").groupBy("parent").agg(F.max(F.struct("size", F.lit(0))).alias("m"))
    heavy = tree.join(heavy.select("parent", F.col("m.size").alias("size")), ["parent", "size"]).groupBy("parent").agg(F.min("node").alias("node"))
    on = heavy.select("node", F.lit(True).alias("heavy"))
    walk = tree.join(on, "node", "left").select("node", F.when(F.col("heavy"), F.col("parent")).alias("up"))
    walk = scratch.keep(walk.select("node", F.coalesce("up", "node").alias("head"), F.when(F.col("up").isNotNull(), 1).otherwise(0).alias("place")))
    while True:  # three jumps a round: what is known reaches four times as far, for one table written
        new = walk.select("node", F.col("head").alias("h0"), F.col("place").alias("p0"))
        for i in range(3):
            step = walk.select(F.col("node").alias(f"h{i}"), F.col("head").alias(f"h{i + 1}"), F.col("place").alias("more"))
            new = new.join(step, f"h{i}").select("node", f"h{i + 1}", (F.col(f"p{i}") + F.col("more")).alias(f"p{i + 1}"), (F.col("more") > 0).alias("moved"))
        new = scratch.keep(new.select("node", F.col("h3").alias("head"), F.col("p3").alias("place"), "moved"))
        scratch.drop(walk)
        walk = new.drop("moved")
        walk._scratch_path = new._scratch_path
        if new.filter("moved").isEmpty():
            break
    return tree.join(walk, "node"), cycles


def hierarchy(spark: SparkSession, rows: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(node_key, root_key, depth, parent, rank, size, head, place) of every node of a taxonomy table.

    A node without parent, or whose parent is no node, is a root of depth 0. A node that never reaches a root has depth
    -1, as root_key the smallest key of the cycle it is on or leads to, and null size, head and place. head and place
    name the heavy chain a node lies on and its position there. No rows give no rows; other columns are ignored.
    """
    scratch = scratch or Scratch(spark, "hierarchy")
    nodes = scratch.keep(current_nodes(rows))
    tree, cycles = chains(nodes, scratch)
    tree = scratch.keep(tree)
    heads = tree.filter("place = 0").select("head", F.col("parent").alias("hang"))
    at = tree.select(F.col("node").alias("hang"), F.col("head").alias("above"), (F.col("place") + 1).alias("step"))
    # of each chain the depth and root, from the chain it hangs on
    links = scratch.keep(heads.join(at, "hang", "left").select("head", "above", "step"))
    known = scratch.keep(links.filter("above is null").select("head", F.col("head").alias("root"), F.lit(0).alias("start")))
    fresh = known
    while True:
        base = fresh.select(F.col("head").alias("above"), "root", "start")
        fresh = scratch.keep(links.join(base, "above").select("head", "root", (F.col("start") + F.col("step")).alias("start")))
        if fresh.isEmpty():
            break
        known = known.union(fresh)
    good = tree.join(known, "head").select(
        F.col("node").alias("node_key"),
        F.col("root").alias("root_key"),
        (F.col("start") + F.col("place")).cast("int").alias("depth"),
        "parent", "rank", "size", "head", "place",
    )
    bad = nodes.join(cycles, "node").select(
        F.col("node").alias("node_key"), "root_key", F.lit(-1).alias("depth"), "parent", "rank",
        F.lit(None).cast("bigint").alias("size"), F.lit(None).cast("string").alias("head"), F.lit(None).cast("int").alias("place"),
    )
    return good.union(bad)


def paths(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """(node_key, root_key, depth, path, ranks, first, last): full paths from the root, joined by " > ", and pre-order
    numbers within the root's tree, so that the descendants of a node are those of its root with first < number <= last.

    A chain's segment is concatenated once and each node takes its beginning; the prefix comes from the chain it hangs
    on. Nodes on or below a cycle have null path, ranks and numbers. A null rank shows as "-".
    """
    scratch = Scratch(spark, "paths")
    tree = scratch.keep(hierarchy(spark, rows, scratch))
    good = tree.filter("depth >= 0").select("*", F.coalesce("rank", F.lit("-")).alias("r"))
    # a sibling's numbers begin after the parent's and those of the siblings before it: the heavy child first, the others
    # by a hash bucket and key, so that a parent of a third of all nodes is summed in SIBLING_BUCKETS pieces
    kids = good.filter("parent is not null").select("node_key", "parent", "size", F.when(F.col("place") > 0, -1).otherwise(F.pmod(F.xxhash64("node_key"), F.lit(SIBLING_BUCKETS))).alias("bucket"))
    earlier = lambda w: F.coalesce(F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    pieces = kids.groupBy("parent", "bucket").agg(F.sum("size").alias("size"))
    pieces = pieces.select("parent", "bucket", earlier(Window.partitionBy("parent").orderBy("bucket")).alias("offset"))
    shift = kids.select("node_key", "parent", "bucket", earlier(Window.partitionBy("parent", "bucket").orderBy("node_key")).alias("own"))
    shift = shift.join(pieces, ["parent", "bucket"]).select("node_key", (F.col("offset") + F.col("own") + 1).alias("shift"))
    good = scratch.keep(good.join(shift, "node_key", "left").withColumn("shift", F.coalesce("shift", F.lit(0).cast("bigint"))))
    segment = F.array_sort(F.collect_list(F.struct("place", "node_key", "r", "shift")))
    whole = good.groupBy("head").agg(segment.alias("s"))
    # along a chain every shift is 1, so a node's number is the head's number plus its place
    hang = good.filter("place = 0").select("head", F.col("parent").alias("hang"), "shift")
    at = good.select(F.col("node_key").alias("hang"), F.col("head").alias("above"), F.col("place").alias("step"))
    links = hang.join(at, "hang", "left").join(whole, "head").select("head", "above", "step", "shift", "s")
    links = scratch.keep(links)
    taken = lambda field: F.transform("s", lambda x: x[field])
    known = scratch.keep(links.filter("above is null").select("head", F.array().cast("array<string>").alias("path"), F.array().cast("array<string>").alias("ranks"), F.lit(0).cast("bigint").alias("base"), "s"))
    fresh = known
    while True:
        base = fresh.select(
            F.col("head").alias("above"), F.concat("path", taken("node_key")).alias("path"), F.concat("ranks", taken("r")).alias("ranks"), "base", F.size("path").alias("own"),
        )
        cut = F.col("own") + F.col("step") + 1
        fresh = links.join(base, "above").select(
            "head", F.slice("path", F.lit(1), cut).alias("path"), F.slice("ranks", F.lit(1), cut).alias("ranks"), (F.col("base") + F.col("step") + F.col("shift")).alias("base"), "s",
        )
        fresh = scratch.keep(fresh)
        if fresh.isEmpty():
            break
        known = known.union(fresh)
    each = good.select("node_key", "root_key", "depth", "head", "place", "size").join(known, "head")
    upto = F.slice("s", F.lit(1), F.col("place") + 1)
    each = each.select(
        "node_key", "root_key", "depth",
        F.concat_ws(" > ", F.concat("path", F.transform(upto, lambda x: x["node_key"]))).alias("path"),
        F.concat_ws(" > ", F.concat("ranks", F.transform(upto, lambda x: x["r"]))).alias("ranks"),
        (F.col("base") + F.col("place")).alias("first"),
        (F.col("base") + F.col("place") + F.col("size") - 1).alias("last"),
    )
    none = lambda n, t: F.lit(None).cast(t).alias(n)
    bad = tree.filter("depth < 0").select("node_key", "root_key", "depth", none("path", "string"), none("ranks", "string"), none("first", "bigint"), none("last", "bigint"))
    return each.union(bad)


def descendants(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """(ancestor, descendant, steps) of every node that reaches a root and every node above it; steps are the levels between.

    The nodes above a node are the beginnings of at most log2(n) chains: its own up to its place, and each chain that one hangs
    on up to where it does. These intervals go down the tree of chains; then one join by chain and place lists the pairs, whose
    number is the sum of all depths. Nodes on or below a cycle have no pairs.
    """
    scratch = Scratch(spark, "descendants")
    tree = scratch.keep(hierarchy(spark, rows, scratch).filter("depth >= 0").select("node_key", "parent", "depth", "head", "place"))
    hang = tree.filter("place = 0").select("head", F.col("parent").alias("hang"))
    at = tree.select(F.col("node_key").alias("hang"), F.col("head").alias("above"), F.col("place").alias("upto"))
    links = scratch.keep(hang.join(at, "hang", "left").select("head", "above", "upto"))
    known = fresh = scratch.keep(links.filter("above is null").select("head", F.expr("cast(array() as array<struct<above: string, upto: int>>)").alias("spans")))
    while True:
        base = fresh.select(F.col("head").alias("above"), "spans")
        fresh = links.join(base, "above").select("head", F.concat("spans", F.array(F.struct("above", "upto"))).alias("spans"))
        fresh = scratch.keep(fresh)
        if fresh.isEmpty():
            break
        known = known.union(fresh)
    own = F.array(F.struct(F.col("head").alias("above"), (F.col("place") - 1).cast("int").alias("upto")))
    spans = tree.join(known, "head").select(F.col("node_key").alias("descendant"), F.col("depth").alias("deep"), F.explode(F.concat("spans", own)).alias("s"))
    spans = spans.select("descendant", "deep", F.col("s.above").alias("head"), F.col("s.upto").alias("upto")).filter("upto >= 0")
    met = spans.join(tree.select(F.col("node_key").alias("ancestor"), "depth", "head", "place"), "head").filter("place <= upto")
    return met.select("ancestor", "descendant", (F.col("deep") - F.col("depth")).cast("int").alias("steps"))


def nearest_of_rank(spark: SparkSession, rows: DataFrame, ranks: list[str]) -> DataFrame:
    """(node_key, rank, code): every node with its rank and the nearest node of one of the ranks, itself or above it; null where
    there is none and on or below a cycle."""
    scratch = Scratch(spark, "facts")
    nodes = scratch.keep(current_nodes(rows))
    wanted = nodes.filter(F.col("rank").isin(ranks)).select(F.col("node").alias("ancestor"))
    pairs = descendants(spark, rows).select("ancestor", "descendant", "steps").union(nodes.select("node", "node", F.lit(0)))
    near = pairs.join(wanted, "ancestor", "left_semi").groupBy(F.col("descendant").alias("node")).agg(F.min_by("ancestor", "steps").alias("code"))
    return nodes.join(near, "node", "left").select(F.col("node").alias("node_key"), "rank", "code")
