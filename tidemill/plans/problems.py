"""Queries p1 and p6 on the test tables, with SQL where it can express them on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemill.operators import hierarchy, nearby


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return nearby.found(spark, *(spark.read.parquet(f"{d}/{t}.parquet") for t in ("metadata", "noaa_esd", "meow")))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return hierarchy.hierarchy(spark, spark.read.parquet(f"{d}/taxonomy.parquet")).select("node_key", "root_key", "depth")


def p6_paths(spark: SparkSession, d: str) -> DataFrame:
    return hierarchy.paths(spark, spark.read.parquet(f"{d}/taxonomy.parquet")).select("node_key", "root_key", "depth", "path", "ranks")


def p6_descendants(spark: SparkSession, d: str) -> DataFrame:
    """Number of descendants of each node, from its interval."""
    t = hierarchy.paths(spark, spark.read.parquet(f"{d}/taxonomy.parquet"))
    return t.filter("depth >= 0").selectExpr("node_key", "root_key", "last - first as descendants")


def p6_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Every node with every node above it, from chain intervals."""
    return hierarchy.descendants(spark, spark.read.parquet(f"{d}/taxonomy.parquet"))


NODES = """
n0 as (
  select lower(trim(key)) as node, nullif(lower(trim(parent)), '') as parent, nullif(lower(trim(rank)), '') as rank,
    list_transform(string_split(taxonomy_version, '.'), lambda x: x::int) as version
  from taxonomy where lower(trim(kind)) = 'node' and trim(key) <> ''),
n1 as (select *, row_number() over (partition by node order by version desc nulls last, parent nulls last, rank nulls last) as i from n0),
n as (select a.node, b.node as parent, a.rank from n1 a left join (select distinct node from n0) b on a.parent = b.node where a.i = 1)
"""
TREE = """
t as (
  select node, node as root, 0 as depth, node as path, coalesce(rank, '-') as ranks from n where parent is null
  union all
  select n.node, t.root, t.depth + 1, t.path || ' > ' || n.node, t.ranks || ' > ' || coalesce(n.rank, '-') from n join t on n.parent = t.node)
"""
ROUND = """
bad as (select node, parent from n where node not in (select node from t)),
walk as (select node, parent as spot from bad union select w.node, b.parent from walk w join bad b on w.spot = b.node),
ring as (select node from walk where node = spot),
bad_root as (select w.node, min(w.spot) as root from walk w join ring r on w.spot = r.node group by 1)
"""
POS = lambda t: f"lat between -90 and 90 and lon between -180 and 360 and not isnan(lat) and not isnan(lon) and not (lat = 0 and lon = 0)"
FAR = lambda a, b: f"2 * 6371008.8 * asin(sqrt(least(1.0, pow(sin(radians({b}.lat - {a}.lat) / 2), 2) + cos(radians({a}.lat)) * cos(radians({b}.lat)) * pow(sin(radians({b}.lon - {a}.lon) / 2), 2))))"  # noqa: E731, E501
NEAR = f"""with m as (select row_id, source_id, coalesce(location_generalized, false) as vague, lat, case when lon >= 180 then lon - 360 else lon end as lon from metadata where {POS('metadata')}),
 s as (select distinct trim(site_id) as site_id, lat, case when lon >= 180 then lon - 360 else lon end as lon from noaa_esd where {POS('noaa_esd')} and trim(site_id) <> ''),
 e as (select distinct feature_ord, ring, unnest(range(1, len(ring) + 1)) as i from meow where feature_ord is not null),
 g as (select feature_ord, hash(ring) as r, ring[i::int].lon as ax, ring[i::int].lat as ay, ring[(i % len(ring) + 1)::int].lon as bx, ring[(i % len(ring) + 1)::int].lat as by from e),
 x as (select m.row_id, g.feature_ord, g.r, count(*) as n from m join g on (g.ay > m.lat) <> (g.by > m.lat) and m.lon < g.ax + (m.lat - g.ay) * (g.bx - g.ax) / (g.by - g.ay) group by 1, 2, 3)
 select distinct 'site' as kind, m.row_id, s.site_id as other from m join s on abs(m.lat - s.lat) < 0.01 and {FAR('m', 's')} <= 300 where not m.vague
 union all select 'image', least(a.row_id, b.row_id), greatest(a.row_id, b.row_id)::varchar from m a join m b on a.row_id < b.row_id and a.source_id <> b.source_id and abs(a.lat - b.lat) < 0.001 and {FAR('a', 'b')} <= 20 where not a.vague and not b.vague
 union all select 'region', row_id, min(feature_ord)::varchar from x where n % 2 = 1 group by 2"""
QUERIES = {"p1_found": p1_found, "p6_found": p6_found, "p6_paths": p6_paths, "p6_descendants": p6_descendants, "p6_pairs": p6_pairs}
SQL = {
    "p1_found": NEAR,
    "p6_found": f"with recursive {NODES}, {TREE}, {ROUND} select node as node_key, root as root_key, depth from t union all select node, root, -1 from bad_root",
    "p6_paths": f"with recursive {NODES}, {TREE}, {ROUND} select node as node_key, root as root_key, depth, path, ranks from t union all select node, root, -1, null, null from bad_root",
    "p6_descendants": f"""with recursive {NODES}, {TREE},
up as (select node, parent as above from n where node in (select node from t) and parent is not null
  union all select u.node, n.parent from up u join n on u.above = n.node where n.parent is not null)
select t.node as node_key, t.root as root_key, count(u.node) as descendants from t left join up u on u.above = t.node group by 1, 2""",
    "p6_pairs": f"""with recursive {NODES}, {TREE},
up as (select node, parent as above, 1 as steps from n where node in (select node from t) and parent is not null
  union all select u.node, n.parent, u.steps + 1 from up u join n on u.above = n.node where n.parent is not null)
select above as ancestor, node as descendant, steps from up""",
}
