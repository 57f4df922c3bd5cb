"""Problem 3: pairwise matches consolidated into groups (connected components)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.functions.identity import code, digest
from tidemill.operators.relate import near_codes
from tidemill.session import Scratch

#: Rounds of breadth-first search before what was reached is contracted instead of awaited (a chain has no small diameter).
FRONTIER_ROUNDS = 8


def numbered(vertices: DataFrame, scratch: Scratch) -> DataFrame:
    """(v, id): distinct vertices with dense numbers in their order: the position in a sorted partition plus the sizes of
    the partitions before it, a row per partition."""
    table = scratch.keep(vertices.repartitionByRange("v").sortWithinPartitions("v").withColumn("at", F.monotonically_increasing_id()))
    table = table.withColumn("part", F.call_function("shiftright", "at", F.lit(33)))
    sizes = table.groupBy("part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("part")) - F.col("n")
    start = sizes.select("part", before.alias("start"))
    return table.join(F.broadcast(start), "part").select("v", (F.col("start") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).alias("id"))


def components(spark: SparkSession, edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(v, root) for every vertex of the undirected edges (a, b): root is the smallest vertex linked to v.

    Vertices are numbered in their order, so that every round moves 8 byte numbers. First the component of the vertex of
    highest degree is peeled: a frontier grows by joins with the edges until it is empty, and the component is anti-joined
    away, so that a giant component costs rounds by its (small) diameter and its edges never enter the rounds that follow.
    If the frontier is not empty after FRONTIER_ROUNDS, the vertices reached are contracted to one. What is left is
    labelled by minimum propagation that contracts what it has labelled, in a number of rounds that is logarithmic in the
    longest chain. Only one vertex and counts ever reach the driver.

    Null ends and loops link nothing; repeated edges and either order count once; no edges give no rows.
    """
    scratch = scratch or Scratch(spark, "components")
    e = scratch.keep(edges.select("a", "b").filter("a is not null and b is not null and a <> b"))
    names = scratch.keep(numbered(e.select(F.explode(F.array("a", "b")).alias("v")).distinct(), scratch))
    of = lambda c: names.select(F.col("v").alias(c), F.col("id").alias(f"i{c}"))
    ids = e.join(of("a"), "a").join(of("b"), "b").select(F.col("ia").alias("a"), F.col("ib").alias("b"))
    root = component_ids(spark, ids, scratch)
    roots = names.select(F.col("v").alias("final"), F.col("id").alias("root"))
    return names.join(root, "id").join(roots, "root").select("v", F.col("final").alias("root"))


def component_ids(spark: SparkSession, edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, root) of every numbered vertex of the edges (a, b)."""
    both = scratch.keep(edges.union(edges.select(F.col("b"), F.col("a"))).distinct())
    top = both.groupBy("a").count().orderBy(F.desc("count"), "a").limit(1).collect()
    if not top:
        return both.select(F.col("a").alias("id"), F.col("b").alias("root")).limit(0)
    seen = scratch.keep(both.filter(F.col("a") == top[0]["a"]).select("a").limit(1))
    frontier, rounds, done = seen, 0, False
    while not done and rounds < FRONTIER_ROUNDS:
        step = both.join(frontier.select("a"), "a").select(F.col("b").alias("a")).distinct()
        fresh = scratch.keep(step.join(seen, "a", "left_anti"))
        done = fresh.isEmpty()
        if not done:
            wider = scratch.keep(seen.union(fresh))
            scratch.drop(seen)
            seen, frontier = wider, fresh
        rounds += 1
    least = F.lit(seen.agg(F.min("a")).first()[0]).cast("bigint")
    peeled = seen.select(F.col("a").alias("id"), least.alias("root"))
    if done:
        rest = both.join(seen, "a", "left_anti")
    else:
        mark = lambda c: seen.select(F.col("a").alias(c), F.lit(True).alias("in"))
        to = lambda c: F.when(F.col("in"), least).otherwise(F.col(c)).alias(c)
        rest = both.join(mark("a"), "a", "left").select(to("a"), "b").join(mark("b"), "b", "left").select("a", to("b")).filter("a <> b").distinct()

    # Every vertex takes the smallest number around it, twice over, and what took the same number becomes one vertex. Small
    # components are one vertex after a round and leave; a chain shrinks several-fold each round, whatever its length.
    live, maps = scratch.keep(rest), []
    while not live.isEmpty():
        near = scratch.keep(live.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("near")))
        again = near.select(F.col("a").alias("near"), F.col("near").alias("root"))
        maps.append(scratch.keep(near.join(again, "near").select(F.col("a").alias("id"), "root")))
        end = lambda c: maps[-1].select(F.col("id").alias(c), F.col("root").alias(f"r{c}"))  # noqa: E731, B023
        shrunk = live.join(end("a"), "a").join(end("b"), "b").filter("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct()
        shrunk = scratch.keep(shrunk)
        scratch.drop(live)
        scratch.drop(near)
        live = shrunk
    if not maps:
        return peeled
    label = maps[-1]
    for earlier in reversed(maps[:-1]):
        later = label.select(F.col("id").alias("root"), F.col("root").alias("final"))
        label = scratch.keep(earlier.join(later, "root", "left").select("id", F.coalesce("final", "root").alias("root")))
    if done:
        return label.union(peeled)
    whole = label.select(F.col("id").alias("root"), F.col("root").alias("final"))
    peeled = peeled.join(whole, "root", "left").select("id", F.coalesce("final", "root").alias("root"))
    return label.join(peeled.select("id"), "id", "left_anti").union(peeled)


def equal_code_edges(codes: DataFrame) -> DataFrame:
    """(a, b) linking every digest to the smallest digest of equal code: a star, not all pairs, so that a code that a third
    of the records share costs one row per record. codes: digest, code."""
    root = codes.groupBy("code").agg(F.min("digest").alias("b"), F.max("digest").alias("most")).filter("b <> most")
    return codes.join(root, "code").filter("digest <> b").select(F.col("digest").alias("a"), "b")


def match_groups(spark: SparkSession, phash: DataFrame, dhash: DataFrame, pairs: DataFrame) -> DataFrame:
    """(sha256, group_id) of every digest of phash and dhash in a group of two or more; group_id is its smallest digest.

    Links are pairs with confirmed true whose ends are both records, and equal usable dhash. Null or malformed digests are
    no records, a null ``confirmed`` confirms nothing, a record with several dhash codes links by each.
    """
    scratch = Scratch(spark, "match-groups")
    as_digest = lambda df, c: df.select(digest(F.col(c)).alias("digest"))
    known = as_digest(phash, "sha256").union(as_digest(dhash, "sha256")).filter("digest is not null")
    ends = pairs.filter("confirmed").select(digest(F.col("sha_a")).alias("a"), digest(F.col("sha_b")).alias("b"))
    ends = ends.filter("a is not null and b is not null and a <> b").distinct()
    known = scratch.keep(known.join(ends.select(F.explode(F.array("a", "b")).alias("digest")).distinct(), "digest", "left_semi").distinct())
    confirmed = ends.join(known.select(F.col("digest").alias("a")), "a", "left_semi").join(known.select(F.col("digest").alias("b")), "b", "left_semi")
    codes = dhash.select(digest(F.col("sha256")).alias("digest"), code(F.col("dhash"), 16, pad=True).alias("code")).dropna().distinct()
    found = components(spark, equal_code_edges(codes).union(confirmed.select("a", "b")), scratch)
    return found.select(F.col("v").alias("sha256"), F.col("root").alias("group_id"))


def chain_guard(spark: SparkSession, dhash: DataFrame, pairs: DataFrame, radius: int = 4, most: float = 0.01) -> DataFrame:
    """(largest, images, passed): the largest component of near copies, against ``most`` of the images with a code.

    Links are codes at most ``radius`` bits apart, equal codes too, and confirmed pairs of images with a code. Codes are
    vertices of their own, so that equal ones need no pairs. Without images there is no size, and it is passed.
    """
    scratch = Scratch(spark, "chain-guard")
    codes = scratch.keep(dhash.select(digest(F.col("sha256")).alias("digest"), code(F.col("dhash"), 16, pad=True).alias("code")).dropna().distinct())
    known = codes.select("digest").distinct()
    as_code = lambda c: F.concat(F.lit("code:"), c)
    links = codes.select(F.col("digest").alias("a"), as_code("code").alias("b"))
    links = links.union(near_codes(codes.select("code"), radius).select(as_code("ca"), as_code("cb")))
    ends = pairs.filter("confirmed").select(digest(F.col("sha_a")).alias("a"), digest(F.col("sha_b")).alias("b"))
    links = links.union(ends.join(known.withColumnRenamed("digest", "a"), "a", "left_semi").join(known.withColumnRenamed("digest", "b"), "b", "left_semi").select("a", "b"))
    found = components(spark, links, scratch)
    size = found.filter("v not like 'code:%'").groupBy("root").agg(F.count("*").alias("n"))
    out = size.agg(F.max("n").alias("largest"), F.coalesce(F.sum("n"), F.lit(0)).alias("images"))
    return out.select("largest", "images", F.coalesce(F.col("largest") <= most * F.col("images"), F.lit(True)).alias("passed"))
