"""Release checks as assertion queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.identity import digest, word
from tidemill.operators import checks as Q
from tidemill.operators import columns as C
from tidemill.plans.relations import D64, images
from tidemill.plans.scalars import SPLIT, WORD, t


def gate_join(spark: SparkSession, d: str) -> DataFrame:
    base = images(spark, d).filter("digest is not null")
    key = lambda n, c: t(spark, d, n).select(digest(F.col(c)).alias("digest"))
    return Q.together([Q.unmatched("join", n, key(n, c), base, "digest") for n, c in (("phash", "sha256"), ("dhash", "sha256"), ("emb", "key"), ("documents", "image_sha256"))])


def gate_bytes_once(spark: SparkSession, d: str) -> DataFrame:
    m = images(spark, d)
    return Q.together([
        Q.repeated("bytes", "digest in two configs", m.filter("digest is not null").select("digest", word(F.col("bytes_config")).alias("c")).dropna().distinct(), ["digest"]),
        Q.repeated("bytes", "row key twice", m, ["row_id"]),
        Q.rule_counts("bytes", m, {"no digest": F.col("digest").isNull()}),
    ])


def gate_splits(spark: SparkSession, d: str) -> DataFrame:
    """Images in two splits, sources whose train share is far from the target, rows without split."""
    m = images(spark, d).withColumn("s", C.split_name(F.col("split")))
    both = m.filter("digest is not null and s is not null").select("digest", "s").distinct()
    by = m.filter("s is not null").groupBy("source_id").agg(F.count("*").alias("n"), F.count_if(F.col("s") == "train").alias("k"))
    far = by.filter((F.col("n") >= 20) & (F.abs(F.col("k") / F.col("n") - 0.7) > 0.05)).agg(F.count("*").alias("n")).filter("n > 0")
    return Q.together([
        Q.repeated("splits", "image in two splits", both, ["digest"]),
        far.select(F.lit("splits").alias("gate"), F.lit("ratio").alias("kind"), "n"),
        Q.rule_counts("splits", m, {"unsplit": F.col("s").isNull()}),
    ])


def gate_metadata(spark: SparkSession, d: str) -> DataFrame:
    m = images(spark, d)
    return Q.rule_counts("metadata", m, {
        "no licence": word(F.col("license")).isNull(), "half a position": F.col("lat").isNull() != F.col("lon").isNull(), "no source": word(F.col("source_id")).isNull(),
        "position without number": F.isnan("lat") | F.isnan("lon"), "placeholder": (F.col("lat") == 0) & (F.col("lon") == 0), "no platform": word(F.col("platform")).isNull(),
    })


def gate_series(spark: SparkSession, d: str) -> DataFrame:
    """Batches that are missing from the run of batch numbers, and orders without lines."""
    b = t(spark, d, "metadata").select("batch").filter("batch is not null").distinct()
    gap = b.agg((F.max("batch") - F.min("batch") + 1 - F.count("*")).cast("bigint").alias("n")).filter("n > 0")
    return Q.together([gap.select(F.lit("series").alias("gate"), F.lit("missing batch").alias("kind"), "n"), Q.unmatched("series", "order without lines", t(spark, d, "orders").select(F.col("o_orderkey").alias("k")), t(spark, d, "lineitem").select(F.col("l_orderkey").alias("k")), "k")])


def gate_labelmap(spark: SparkSession, d: str) -> DataFrame:
    n = t(spark, d, "taxonomy").filter("kind = 'node'").select(word(F.col("key")).alias("k"), word(F.col("parent")).alias("p"), word(F.col("rank")).alias("r"), "taxonomy_version")
    lost = Q.unmatched("labelmap", "parent names no node", n.filter("p is not null").select(F.col("p").alias("k")), n, "k")
    return Q.together([lost, Q.repeated("labelmap", "key in several versions", n.select("k", "taxonomy_version").distinct(), ["k"]), Q.rule_counts("labelmap", n, {"no rank": F.col("r").isNull(), "own parent": F.col("k") == F.col("p")})])


def gate_frozen(spark: SparkSession, d: str) -> DataFrame:
    """Digests that two rows give different codes (a frozen table must not)."""
    p = t(spark, d, "dhash").select(digest(F.col("sha256")).alias("k"), word(F.col("dhash")).alias("c")).dropna().distinct()
    return Q.repeated("frozen", "digest with two codes as written", p, ["k"])


GATES = {"join": gate_join, "bytes": gate_bytes_once, "splits": gate_splits, "metadata": gate_metadata, "series": gate_series, "labelmap": gate_labelmap, "frozen": gate_frozen}


def gate_verdict(spark: SparkSession, d: str) -> DataFrame:
    return Q.verdict(Q.together([f(spark, d) for f in GATES.values()]), list(GATES))


QUERIES = {f.__name__: f for f in (*GATES.values(), gate_verdict)}
IMG = f"img as (select *, {D64('image_sha256')} as digest, {SPLIT('split')} as s from metadata)"
N = f"n as (select {WORD('key')} as k, {WORD('parent')} as p, {WORD('rank')} as r, taxonomy_version as v from taxonomy where kind = 'node')"
PARTS = {
    "gate_join": " union all ".join(f"select 'join' as gate, '{n}' as kind, count(*) as n from (select {D64(c)} as k from {n}) x where k is null or k not in (select digest from img where digest is not null)" for n, c in (("phash", "sha256"), ("dhash", "sha256"), ("emb", "key"), ("documents", "image_sha256"))),
    "gate_bytes_once": f"select 'bytes' as gate, 'digest in two configs' as kind, count(*) as n from (select digest from img where digest is not null and {WORD('bytes_config')} is not null group by 1 having count(distinct {WORD('bytes_config')}) > 1) union all select 'bytes', 'row key twice', count(*) from (select row_id from img group by 1 having count(*) > 1) union all select 'bytes', 'no digest', count(*) from img where digest is null",
    "gate_splits": "select 'splits' as gate, 'image in two splits' as kind, count(*) as n from (select digest from img where digest is not null and s is not null group by 1 having count(distinct s) > 1) union all select 'splits', 'ratio', count(*) from (select source_id from img where s is not null group by 1 having count(*) >= 20 and abs(count(*) filter (s = 'train') / count(*) - 0.7) > 0.05) union all select 'splits', 'unsplit', count(*) from img where s is null",
    "gate_metadata": "select 'metadata' as gate, k.kind as kind, count(*) as n from img, unnest([{'kind': 'no licence', 'x': " + WORD("license") + " is null}, {'kind': 'half a position', 'x': (lat is null) <> (lon is null)}, {'kind': 'no source', 'x': " + WORD("source_id") + " is null}, {'kind': 'position without number', 'x': isnan(lat) or isnan(lon)}, {'kind': 'placeholder', 'x': lat = 0 and lon = 0}, {'kind': 'no platform', 'x': " + WORD("platform") + " is null}]) as u(k) where k.x group by 1, 2",
    "gate_series": "select 'series' as gate, 'missing batch' as kind, (max(batch) - min(batch) + 1 - count(distinct batch))::bigint as n from img union all select 'series', 'order without lines', count(*) from orders where o_orderkey not in (select l_orderkey from lineitem)",
    "gate_labelmap": "select 'labelmap' as gate, 'parent names no node' as kind, count(*) as n from n where p is not null and p not in (select k from n where k is not null) union all select 'labelmap', 'key in several versions', count(*) from (select k from n group by 1 having count(distinct v) > 1) union all select 'labelmap', 'no rank', count(*) from n where r is null union all select 'labelmap', 'own parent', count(*) from n where k = p",
    "gate_frozen": f"select 'frozen' as gate, 'digest with two codes as written' as kind, count(*) as n from (select {D64('sha256')} as k from dhash where {WORD('dhash')} is not null and {D64('sha256')} is not null group by 1 having count(distinct {WORD('dhash')}) > 1)",
}
SQL = {k: f"with {IMG}, {N} select gate, kind, n from ({v}) x where n > 0" for k, v in PARTS.items()}
SQL["gate_verdict"] = f"with {IMG}, {N}, a as (" + " union all ".join(f"select gate, kind, n from ({v}) x" for v in PARTS.values()) + "), g as (select unnest(['" + "', '".join(GATES) + "']) as gate) select g.gate, case when coalesce(sum(n), 0) > 0 then 'failed' else 'passed' end as status, coalesce(sum(n), 0)::bigint as n from g left join a using (gate) group by 1"
