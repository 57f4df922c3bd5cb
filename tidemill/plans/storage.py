"""Round trips through sinks and sources."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.plans.scalars import t
from tidemill.session import shared_dir
from tidemill.sources import annotations, sinks


def roundtrip_partitioned(spark: SparkSession, d: str) -> DataFrame:
    """Written by status in order, in files of bounded rows, and read back."""
    path = f"{shared_dir(spark)}/roundtrip-{uuid.uuid4().hex}"
    sinks.write_sharded(t(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), path, ["o_orderstatus"], ["o_orderkey"], 2000)
    back = spark.read.parquet(path)
    return back.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 1).alias("total"), F.min("o_orderkey").alias("first"))


def roundtrip_formats(spark: SparkSession, d: str) -> DataFrame:
    """The same rows through JSON, CSV, ORC and text."""
    root = f"{shared_dir(spark)}/formats-{uuid.uuid4().hex}"
    n = t(spark, d, "nation")
    parts = []
    for kind in ("json", "csv", "orc", "parquet"):
        n.write.format(kind).save(f"{root}/{kind}")
        parts.append(spark.read.schema(n.schema).format(kind).load(f"{root}/{kind}").withColumn("format", F.lit(kind)))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy("format").agg(F.count("*").alias("n"), F.sum("n_nationkey").alias("keys"), F.min("n_name").alias("first"))


def tar_members(spark: SparkSession, d: str) -> DataFrame:
    docs = t(spark, d, "documents").select("doc_id", "text", "lang", "kind")
    return sinks.read_tars(spark, sinks.tar_shards(docs, "doc_id", "text", "txt", max(8, docs.count() // 1000))).select("name", F.sha2("content", 256).alias("sha256")).filter("name like '%.txt'")


def mask_pixels(spark: SparkSession, d: str) -> DataFrame:
    """Masks from run lengths, and their set pixels."""
    s = t(spark, d, "staged_images").select("staged_id", F.array(*(F.pmod(F.col("staged_id") * k, F.lit(7)).cast("int") for k in (3, 5, 2, 4))).alias("runs"))
    m = annotations.run_length(F.col("runs"))
    return s.select("staged_id", F.size(m).alias("pixels"), F.aggregate(m, F.lit(0), lambda a, x: a + x).alias("set_pixels"))


def byte_shards(spark: SparkSession, d: str) -> DataFrame:
    """Documents written by kind in files of bounded bytes, and read back from the files."""
    path = f"{shared_dir(spark)}/shards-{uuid.uuid4().hex}"
    sinks.write_bounded(t(spark, d, "documents").select("doc_id", "text", "kind"), path, "kind", "doc_id", 20_000)
    back = spark.read.parquet(f"{path}/kind").withColumn("file", F.regexp_extract(F.col("_metadata.file_name"), r"-(\d+)-of", 1).cast("int"))
    return back.groupBy("kind", "file").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))


def map_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Splits of sites saved as a map and loaded again, checked by its content hash."""
    from tidemill.operators.allocate import by_hash
    from tidemill.operators.splitmap import load_map, save_map

    path = f"{shared_dir(spark)}/map-{uuid.uuid4().hex}"
    sites = t(spark, d, "noaa_esd").filter("site_id is not null").select(F.col("site_id").alias("group")).distinct()
    save_map(sites.withColumn("split", by_hash(F.col("group"), {"train": 0.8, "test": 0.2})), path, {"by": "site"})
    head, rows = load_map(spark, path)
    return rows.groupBy("split").agg(F.count("*").alias("groups"), F.min("group").alias("first")).withColumn("all", F.lit(head["groups"]).cast("bigint"))


def map_resolution(spark: SparkSession, d: str) -> DataFrame:
    """Sources resolved against the map of batch 0: kept, inherited by a merged component, forced, or hashed."""
    from tidemill.operators.splitmap import resolved
    from tidemill.plans.grouping import RATIOS

    m = t(spark, d, "metadata").filter("source_id is not null")
    number = F.regexp_extract("source_id", "([0-9]+)$", 1).try_cast("int")
    known = m.filter("batch = 0").select(F.col("source_id").alias("group")).distinct().withColumn("split", F.lit("train"))
    component = F.when(number % 2 == 0, F.concat(F.lit("c"), (number / 4).cast("int").cast("string")))
    groups = m.select(F.col("source_id").alias("group"), component.alias("component"))
    forced = groups.filter("component is null").select("group").distinct().withColumn("split", F.lit("test"))
    return resolved(groups, known, RATIOS, forced).filter("rule <> 'hashed'")


QUERIES = {f.__name__: f for f in (roundtrip_partitioned, roundtrip_formats, tar_members, mask_pixels, byte_shards, map_roundtrip, map_resolution)}
SQL = {
    "roundtrip_partitioned": "select o_orderstatus, count(*) as n, round(sum(o_totalprice), 1) as total, min(o_orderkey) as first from orders group by 1",
    "roundtrip_formats": "select f as format, count(*) as n, sum(n_nationkey)::bigint as keys, min(n_name) as first from nation, (select unnest(['json', 'csv', 'orc', 'parquet']) as f) group by 1",
    "tar_members": "select doc_id || '.txt' as name, sha256(coalesce(text, '')) as sha256 from documents",
    "mask_pixels": "select staged_id, (staged_id * 3 % 7 + staged_id * 5 % 7 + staged_id * 2 % 7 + staged_id * 4 % 7)::int as pixels, (staged_id * 5 % 7 + staged_id * 4 % 7)::int as set_pixels from staged_images",
    "byte_shards": """with d as (select doc_id, kind, coalesce(kind, 'none') as v, 8 + coalesce(strlen(text), 1) + coalesce(strlen(kind), 1) as b from documents),
 r as (select *, coalesce(sum(b) over (partition by v order by doc_id rows between unbounded preceding and 1 preceding), 0) // 20000 as s from d), q as (select *, (dense_rank() over (partition by v order by s) - 1)::int as file from r)
 select kind, file, count(*) as n, min(doc_id) as first, max(doc_id) as last from q group by 1, 2""",
    "map_roundtrip": "with s as (select distinct site_id as g from noaa_esd where site_id is not null), u as (select g, ('0x' || substr(sha256('0:' || g), 1, 13))::bigint / 4503599627370496.0 as u from s) select case when u < 0.8 then 'train' else 'test' end as split, count(*) as groups, min(g) as first, (select count(*) from s) as \"all\" from u group by 1",
    "map_resolution": """with m as (select source_id as g, batch, try_cast(nullif(regexp_extract(source_id, '([0-9]+)$', 1), '') as int) as k from metadata where source_id is not null),
 c as (select g, case when any_value(k) % 2 = 0 then 'c' || (any_value(k) // 4) end as component, bool_or(coalesce(batch = 0, false)) as known from m group by 1), i as (select component from c where known and component is not null group by 1)
 select g as "group", case when known or component in (select component from i) then 'train' else 'test' end as split, case when known then 'kept' when component in (select component from i) then 'inherited' else 'forced' end as rule from c where known or component is null or component in (select component from i)""",
}
