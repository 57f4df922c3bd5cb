"""Resolution queries on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.identity import digest, word
from tidemill.operators import columns as C
from tidemill.operators import resolve as V
from tidemill.plans.grouping import SQL as GROUPING
from tidemill.plans.grouping import task_projection
from tidemill.plans.relations import D64, images
from tidemill.plans.scalars import SPLIT, WORD, t


def greedy_exclusion(spark: SparkSession, d: str) -> DataFrame:
    """Images to drop so that no confirmed pair is left; evaluation images are kept."""
    p = t(spark, d, "pairs").filter("confirmed").select(digest(F.col("sha_a")).alias("a"), digest(F.col("sha_b")).alias("b"))
    keep = images(spark, d).filter(C.split_name(F.col("split")) == "test").select(F.col("digest").alias("v")).filter("v is not null")
    return V.greedy_exclusion(spark, p, keep)


def best_match(spark: SparkSession, d: str) -> DataFrame:
    """Staged rows matched to a delivery by source and licence, else by licence and day, else by source."""
    s = t(spark, d, "staged_images").select("staged_id", "source_id", "license", "fetch_date")
    m = t(spark, d, "metadata").select("row_id", "source_id", "license", "fetch_date")
    return V.best_match(s, m, [["source_id", "license"], ["license", "fetch_date"], ["source_id"]], "row_id").select("staged_id", "row_id", "level")


def name_resolution(spark: SparkSession, d: str) -> DataFrame:
    """Names of the taxonomy resolved to one key: numbered rows first, then species, then the smallest key."""
    tax = t(spark, d, "taxonomy").filter("kind = 'node'").select("name", word(F.col("key")).alias("key"), "aphia_id", word(F.col("rank")).alias("rank"))
    return V.resolved_names(tax, tax, "name", "key", F.col("aphia_id").isNotNull(), F.col("rank") == "species")


def task_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Labels by how they fit the task, reasons without any included."""
    reasons = spark.createDataFrame([(r,) for r in ("exact", "rolled up", "coarser", "outside")], "reason string")
    n = task_projection(spark, d).groupBy("reason").agg(F.count("*").alias("n"))
    return reasons.join(n, "reason", "left").select("reason", F.coalesce("n", F.lit(0)).alias("labels"))


def release_counts(spark: SparkSession, d: str) -> DataFrame:
    """Rows, images and unsplit rows by configuration, withheld ones apart."""
    m = images(spark, d).select(word(F.col("bytes_config")).alias("c"), "digest", C.split_name(F.col("split")).alias("s"))
    c = F.coalesce("c", F.lit("none"))
    return m.groupBy(c.alias("config"), (c == "withheld").alias("withheld")).agg(F.count("*").alias("rows"), F.countDistinct("digest").alias("images"), F.count_if(F.col("s").isNull()).alias("unsplit"))


QUERIES = {f.__name__: f for f in (greedy_exclusion, best_match, name_resolution, task_coverage, release_counts)}
SQL = {
    "best_match": "with a as (select source_id, license, min(row_id) as m from metadata group by 1, 2), b as (select license, fetch_date, min(row_id) as m from metadata group by 1, 2), c as (select source_id, min(row_id) as m from metadata group by 1) select staged_id, coalesce(a.m, b.m, c.m) as row_id, case when a.m is not null then 1 when b.m is not null then 2 when c.m is not null then 3 end as level from staged_images s left join a on s.source_id = a.source_id and s.license = a.license left join b on s.license = b.license and s.fetch_date = b.fetch_date left join c on s.source_id = c.source_id",
    "name_resolution": f"with x as (select name, {WORD('name')} as n, {WORD('key')} as k, aphia_id, {WORD('rank')} as r from taxonomy where kind = 'node'), b as (select n, k, row_number() over (partition by n order by aphia_id is null, coalesce(r, '') <> 'species', k) as i from x where n is not null), m as (select n, count(distinct k) as matches from x where n is not null group by 1) select q.name, b.k as key, coalesce(m.matches, 0) as matches from (select distinct name, n from x) q left join b on q.n = b.n and b.i = 1 left join m on q.n = m.n",
    "task_coverage": f"with p as ({GROUPING['task_projection']}), r as (select unnest(['exact', 'rolled up', 'coarser', 'outside']) as reason) select r.reason, count(p.label) as labels from r left join p on p.reason = r.reason group by 1",
    "release_counts": f"with m as (select coalesce({WORD('bytes_config')}, 'none') as c, {D64('image_sha256')} as digest, {SPLIT('split')} as s from metadata) select c as config, c = 'withheld' as withheld, count(*) as rows, count(distinct digest) as images, count(*) filter (s is null) as unsplit from m group by 1, 2",
}
