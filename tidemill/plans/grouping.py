"""Allocation and harmonisation on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.identity import word
from tidemill.operators import allocate as A
from tidemill.operators import columns as C
from tidemill.operators import harmonise as H
from tidemill.operators.hierarchy import current_nodes
from tidemill.plans.problems import NODES
from tidemill.plans.relations import D64, images
from tidemill.plans.scalars import SPLIT, WORD, t
from tidemill.session import Scratch

RATIOS = {"train": 0.7, "val": 0.15, "test": 0.15}


def group_allocation(spark: SparkSession, d: str) -> DataFrame:
    return A.greedy(t(spark, d, "metadata"), "source_id", RATIOS)


def stratum_allocation(spark: SparkSession, d: str) -> DataFrame:
    return A.greedy(t(spark, d, "documents"), "source", {"train": 0.8, "test": 0.2}, seed="7")


def stratified_allocation(spark: SparkSession, d: str) -> DataFrame:
    """Sites to splits so that every source gets the ratios; a site of several sources goes once."""
    m = t(spark, d, "metadata").select("source_id", F.nullif(F.trim("site_id"), F.lit("")).alias("site_id"))
    return A.stratified(m, "source_id", "site_id", RATIOS)


def grouped_folds(spark: SparkSession, d: str) -> DataFrame:
    return A.folds(t(spark, d, "documents"), "source", 5)


def hash_splits(spark: SparkSession, d: str) -> DataFrame:
    s = t(spark, d, "metadata").select("row_id", A.by_hash(F.col("source_id"), RATIOS).alias("split"))
    return s.groupBy("split").agg(F.count("*").alias("n"))


def map_growth(spark: SparkSession, d: str) -> DataFrame:
    """Sources of the first batch keep their greedy split; those of later batches are hashed."""
    m = t(spark, d, "metadata")
    known = A.greedy(m.filter("batch = 0"), "source_id", RATIOS)
    return A.grown(known, m, "source_id", RATIOS)


def ood_holdouts(spark: SparkSession, d: str) -> DataFrame:
    m = t(spark, d, "metadata")
    deep = F.col("depth_m").isNotNull() & ~F.isnan("depth_m") & (F.col("depth_m") > 38)
    return A.held_out(m, "site_id", {"deep": deep, "late": F.col("capture_datetime") >= F.lit("2023-06-01").cast("timestamp_ntz"), "towed": F.col("platform") == "towed"})


def upstream_test(spark: SparkSession, d: str) -> DataFrame:
    """Groups with any row that its writer meant for testing."""
    s = t(spark, d, "staged_images").select(word(F.col("split_group")).alias("grp"), C.split_name(F.col("upstream_split")).alias("split")).filter("grp is not null")
    return s.groupBy("grp").agg(F.max(F.coalesce(F.col("split") == "test", F.lit(False))).alias("forced"), F.count("*").alias("n"))


def pins(spark: SparkSession, d: str) -> DataFrame:
    """The split an image is pinned to: test before val before train, over all its rows."""
    m = images(spark, d).select("digest", C.split_name(F.col("split")).alias("split")).dropna()
    rank = F.when(F.col("split") == "test", 0).when(F.col("split") == "val", 1).otherwise(2)
    return m.groupBy("digest").agg(F.min_by("split", rank).alias("pin"))


def inherited(spark: SparkSession, d: str) -> DataFrame:
    """Sites whose batches before the newest agree on a split inherit it; those that disagree are withheld."""
    m = t(spark, d, "metadata").select("site_id", "batch", C.split_name(F.col("split")).alias("split")).filter("site_id is not null and split is not null")
    early = F.when(F.col("batch") < t(spark, d, "metadata").agg(F.max("batch")).scalar(), F.col("split"))
    by = m.groupBy("site_id").agg(F.countDistinct(early).alias("n"), F.min(early).alias("s"))
    return by.select("site_id", F.when(F.col("n") == 1, F.col("s")).alias("split"), F.when(F.col("n") == 1, "inherited").when(F.col("n") > 1, "withheld").otherwise("new").alias("rule"))


def province_choice(spark: SparkSession, d: str) -> DataFrame:
    """The island whose share of survey sites is nearest to a target; ties by name."""
    s = t(spark, d, "noaa_esd").select("island", "site_id").distinct().groupBy("island").agg(F.count("*").alias("n"))
    x = s.withColumn("far", F.abs(F.col("n") - 0.05 * s.agg(F.sum("n")).scalar()))
    return x.agg(F.min_by("island", F.struct("far", "island")).alias("island"))


def hierarchy_closure(spark: SparkSession, d: str) -> DataFrame:
    """How many nodes have how many ancestors."""
    n = H.ancestors(current_nodes(t(spark, d, "taxonomy")), Scratch(spark, "closure"))
    by = n.filter("distance > 0").groupBy("node").agg(F.count("*").alias("above"))
    return by.groupBy("above").agg(F.count("*").alias("nodes"))


def task_projection(spark: SparkSession, d: str) -> DataFrame:
    """Every key projected to the genus nodes; keys off the hierarchy are outside."""
    nodes = current_nodes(t(spark, d, "taxonomy"))
    scratch = Scratch(spark, "project")
    nodes = scratch.keep(nodes)
    labels = t(spark, d, "taxonomy").select(word(F.col("key")).alias("label")).filter("label is not null")
    return H.project(labels, H.ancestors(nodes, scratch), nodes.filter("rank = 'genus'"), "label", "node")


def label_map(spark: SparkSession, d: str) -> DataFrame:
    tax = t(spark, d, "taxonomy")
    edges = tax.filter("kind = 'edge'").select(word(F.col("key")).alias("label"), word(F.col("parent")).alias("target"))
    return H.label_map(edges, tax.filter("kind = 'node'").select(word(F.col("key")).alias("label")), "label", "target")


def hierarchy_faults(spark: SparkSession, d: str) -> DataFrame:
    """Keys with several nodes of one version, parents unknown, own parents."""
    n = t(spark, d, "taxonomy").filter("kind = 'node'").select(word(F.col("key")).alias("k"), word(F.col("parent")).alias("p"), "taxonomy_version")
    known = n.select(F.col("k").alias("p"), F.lit(True).alias("known")).distinct()
    x = n.distinct().join(known, "p", "left")
    return x.agg(F.count_if(F.col("p").isNotNull() & F.col("known").isNull()).alias("unknown_parent"), F.count_if(F.col("k") == F.col("p")).alias("own_parent"), F.countDistinct("k").alias("keys"))


QUERIES = {f.__name__: f for f in (group_allocation, stratum_allocation, stratified_allocation, grouped_folds, hash_splits, map_growth, ood_holdouts, upstream_test, pins, inherited, province_choice, hierarchy_closure, task_projection, label_map, hierarchy_faults)}


def fold_sql(table: str, key: str, ratios: dict[str, float], seed: str) -> str:
    """The greedy rule as a recursive fold: groups in order, each to the split with the largest deficit, ties to the last name."""
    cols = ", ".join(f"0::bigint as {s}" for s in ratios)
    lack = ", ".join(f"{{'d': {r}::double * total - {s}, 's': '{s}'}}" for s, r in ratios.items())
    step = ", ".join(f"w.{s} + case when c.s = '{s}' then o.n else 0 end" for s in ratios)
    return f"""g as (select {key} as k, count(*) as n from {table} where {key} is not null group by 1), o as (select k, n, row_number() over (order by n desc, sha256('{seed}:' || k)) as i, sum(n) over () as total from g),
 w as (select 0::bigint as i, null::varchar as k, 0::bigint as n, null::varchar as split, {cols} union all select o.i, o.k, o.n, c.s, {step} from w join o on o.i = w.i + 1, lateral (select list_max([{lack}]).s as s) c)"""


UNIT = "('0x' || substr(sha256('0:' || source_id), 1, 13))::bigint / 4503599627370496.0"
HASHED = f"case when {UNIT} < 0.7 then 'train' when {UNIT} < 0.85 then 'val' else 'test' end"
SQL = {
    "group_allocation": f"with recursive {fold_sql('metadata', 'source_id', RATIOS, '0')} select k as source_id, n, split from w where k is not null",
    "stratum_allocation": f"with recursive {fold_sql('documents', 'source', {'train': 0.8, 'test': 0.2}, '7')} select k as source, n, split from w where k is not null",
    "grouped_folds": """with recursive g as (select source as k, count(*) as n from documents where source is not null group by 1), o as (select k, n, row_number() over (order by n desc, sha256('0:' || k)) as i from g),
 w as (select 0::bigint as i, null::varchar as k, 0::bigint as n, -1 as fold, [0, 0, 0, 0, 0]::bigint[] as load union all
  select o.i, o.k, o.n, c.f - 1, list_concat(list_concat(list_slice(w.load, 1, c.f - 1), [w.load[c.f] + o.n]), list_slice(w.load, c.f + 1, 5)) from w join o on o.i = w.i + 1, lateral (select list_position(w.load, list_min(w.load)) as f) c)
 select k as source, n, fold::int as fold from w where k is not null""",
    "hash_splits": f"select {HASHED} as split, count(*) as n from metadata group by 1",
    "map_growth": f"with recursive {fold_sql('(select * from metadata where batch = 0)', 'source_id', RATIOS, '0')} select k as source_id, split from w where k is not null union all select source_id, {HASHED} from (select distinct source_id from metadata where source_id is not null) where source_id not in (select k from w where k is not null)",
    "ood_holdouts": "with b as (select site_id, count(*) as n, bool_or(depth_m is not null and not isnan(depth_m) and depth_m > 38) as a, bool_or(coalesce(capture_datetime >= timestamp '2023-06-01', false)) as l, bool_or(coalesce(platform = 'towed', false)) as t from metadata where site_id is not null group by 1) select site_id, case when a then 'deep' when l then 'late' when t then 'towed' end as rule, n from b where a or l or t",
    "upstream_test": f"select {WORD('split_group')} as grp, bool_or(coalesce({SPLIT('upstream_split')} = 'test', false)) as forced, count(*) as n from staged_images where {WORD('split_group')} is not null group by 1",
    "pins": f"with m as (select {D64('image_sha256')} as digest, {SPLIT('split')} as s from metadata) select digest, case min(case s when 'test' then 0 when 'val' then 1 else 2 end) when 0 then 'test' when 1 then 'val' else 'train' end as pin from m where digest is not null and s is not null group by 1",
    "inherited": f"with m as (select site_id, batch, {SPLIT('split')} as s from metadata where site_id is not null), b as (select site_id, count(distinct s) filter (batch < (select max(batch) from metadata)) as n, min(s) filter (batch < (select max(batch) from metadata)) as s from m where s is not null group by 1) select site_id, case when n = 1 then s end as split, case when n = 1 then 'inherited' when n > 1 then 'withheld' else 'new' end as rule from b",
    "province_choice": "with s as (select island, count(distinct site_id) as n from (select distinct island, site_id from noaa_esd) group by 1) select island from s order by abs(n - 0.05 * (select sum(n) from s)), island limit 1",
    "label_map": f"with e as (select distinct {WORD('key')} as label, {WORD('parent')} as target from taxonomy where kind = 'edge'), o as (select distinct {WORD('key')} as label from taxonomy where kind = 'node') select label, target, true as mapped from e where label is not null union all select label, null, false from o where label is not null and label not in (select label from e where label is not null)",
    "hierarchy_faults": f"with n as (select distinct {WORD('key')} as k, {WORD('parent')} as p, taxonomy_version from taxonomy where kind = 'node') select count(*) filter (p is not null and p not in (select k from n where k is not null)) as unknown_parent, count(*) filter (k = p) as own_parent, count(distinct k) as keys from n",
    "hierarchy_closure": f"with recursive {NODES}, c as (select node, parent as up from n where parent is not null and parent <> node union select c.node, n.parent from c join n on c.up = n.node where n.parent is not null), u as (select node, count(*) as above from c where up <> node group by 1) select above, count(*) as nodes from u group by 1",
    "task_projection": f"""with recursive {NODES}, c as (select node, parent as up, 1 as distance from n where parent is not null and parent <> node union select c.node, n.parent, c.distance + 1 from c join n on c.up = n.node where n.parent is not null and c.distance < 100),
 a as (select node, up, min(distance) as distance from c where up <> node group by 1, 2 union all select node, node, 0 from n), tg as (select node as t from n where rank = 'genus'),
 best as (select a.node, a.up as class, a.distance from a join tg on a.up = tg.t qualify row_number() over (partition by a.node order by a.distance, a.up) = 1), below as (select distinct up as node from a join tg on a.node = tg.t where distance > 0)
 select l.label, b.class, case when b.distance = 0 then 'exact' when b.distance > 0 then 'rolled up' when w.node is not null then 'coarser' else 'outside' end as reason
 from (select distinct {WORD('key')} as label from taxonomy where {WORD('key')} is not null) l left join best b on l.label = b.node left join below w on l.label = w.node""",
}
