"""Windows, ranking, sampling and packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.functions.identity import word
from tidemill.operators import columns as C
from tidemill.operators import measure as M
from tidemill.operators import relate as R
from tidemill.operators import sample as S
from tidemill.plans.relations import DH, D64, codes, images
from tidemill.plans.scalars import SPLIT, WORD, t


def bottom_k_by_hash(spark: SparkSession, d: str) -> DataFrame:
    return S.lowest(t(spark, d, "documents").select("doc_id", "source"), ["source"], "doc_id", 3).select("source", "doc_id")


def first_photo(spark: SparkSession, d: str) -> DataFrame:
    """The first delivery of each image: by batch, then row."""
    m = images(spark, d).filter("digest is not null")
    return m.groupBy("digest").agg(F.min(F.struct("batch", "row_id")).alias("f")).select("digest", "f.batch", "f.row_id")


def capped_admission(spark: SparkSession, d: str) -> DataFrame:
    """Filter, thin by hash, then the first rows of each stratum in arrival order."""
    m = t(spark, d, "metadata").filter(C.predicate(F.col("platform"), "ne", "towed") & (S.unit("row_id") < 0.5))
    return S.first_rows(m.select("row_id", "source_id", "ingested_at"), ["source_id"], [F.col("ingested_at"), F.col("row_id")], 5, F.col("row_id")).select("row_id", "source_id")


def stratified_sample(spark: SparkSession, d: str) -> DataFrame:
    return S.stratified(t(spark, d, "documents").select("doc_id", "source"), "source", "doc_id", 200)


def stratum_quotas(spark: SparkSession, d: str) -> DataFrame:
    return S.quotas(t(spark, d, "documents"), "source", 200)


def stride_sample(spark: SparkSession, d: str) -> DataFrame:
    return S.stride(t(spark, d, "orders").select("o_orderkey"), "o_orderkey", 97)


def whole_group_sample(spark: SparkSession, d: str) -> DataFrame:
    return S.whole_groups(t(spark, d, "documents").select("doc_id", "source"), "source", 300)


def capped_total(spark: SparkSession, d: str) -> DataFrame:
    n = t(spark, d, "metadata").groupBy("source_id").agg(F.count("*").alias("n"))
    return n.agg(F.sum(F.least("n", F.lit(50))).alias("expected"))


def greedy_chunks(spark: SparkSession, d: str) -> DataFrame:
    p = S.packed(t(spark, d, "documents").select("source", "doc_id", F.coalesce("n_chars", F.lit(0)).alias("n")), "source", "doc_id", "n", 5000)
    return p.groupBy("source").agg((F.max("chunk") + 1).alias("chunks"))


def kept_frames(spark: SparkSession, d: str) -> DataFrame:
    """Staged frames of a folder that differ from the last one kept, by a code of their stem."""
    s = t(spark, d, "staged_images").select("partition_name", "staged_id", F.substring(F.md5("stem"), 1, 4).alias("code"))
    return S.kept_frames(s, "partition_name", "staged_id", "code", 6).groupBy("partition_name").agg(F.count("*").alias("kept"))


def nearest_earlier(spark: SparkSession, d: str) -> DataFrame:
    """For each event the user's event before it and the seconds between."""
    e = t(spark, d, "events").select("event_id", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    x = S.lagged(e, ["user_id", "at", "event_id"], ["user_id", "event_id", "at"])
    own = F.col("user_id_before").eqNullSafe(F.col("user_id")) & F.col("at_before").isNotNull()
    gap = F.round((F.col("at") - F.col("at_before")) / 1e6, 6)
    return x.select("event_id", F.when(own, F.col("event_id_before")).alias("earlier"), F.when(own, gap).alias("seconds"))


def series_completeness(spark: SparkSession, d: str) -> DataFrame:
    """Whether the line numbers of an order are exactly 1 to their number."""
    by = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.min("l_linenumber").alias("a"), F.max("l_linenumber").alias("b"), F.countDistinct("l_linenumber").alias("n"), F.count("*").alias("m"))
    ok = (F.col("a") == 1) & (F.col("b") == F.col("n")) & (F.col("n") == F.col("m"))
    return by.groupBy(ok.alias("complete")).agg(F.count("*").alias("orders"))


def percentile_threshold(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "orders").groupBy("o_orderpriority").agg(*(F.round(F.percentile("o_totalprice", F.lit(q)), 4).alias(n) for n, q in (("p01", 0.01), ("p50", 0.5), ("p99", 0.99))))


def recall_threshold(spark: SparkSession, d: str) -> DataFrame:
    p = t(spark, d, "pairs").filter("cos is not null and not isnan(cos) and confirmed is not null").select(F.col("cos").cast("double").alias("cos"), "confirmed")
    r = M.recall_threshold(p, "cos", "confirmed", 0.9)
    return r.select(F.round("threshold", 6).alias("threshold"), "recall", "precision")


def positional_join(spark: SparkSession, d: str) -> DataFrame:
    """Two lists aligned by rank within a key: staged rows and deliveries of a source; surplus rows drop out."""
    a = S.ranked(t(spark, d, "staged_images").select("source_id", "staged_id"), "source_id", "staged_id")
    b = S.ranked(t(spark, d, "metadata").select("source_id", "row_id"), "source_id", "row_id")
    return a.join(b, ["source_id", "i"]).select("staged_id", "row_id")


def stem_twins(spark: SparkSession, d: str) -> DataFrame:
    """Normalised stems that two or more sources staged."""
    key = F.regexp_replace(F.lower("stem"), "[^a-z0-9]+", "")
    return t(spark, d, "staged_images").groupBy(key.alias("key")).agg(F.countDistinct("source_id").alias("sources"), F.count("*").alias("n")).filter("sources > 1")


def capped_failures(spark: SparkSession, d: str) -> DataFrame:
    """Exact counts of each violation with the first three rows as examples."""
    m = t(spark, d, "metadata")
    v = m.select("row_id", F.explode(C.violations({"no split": word(F.col("split")).isNull(), "no site": word(F.col("site_id")).isNull()})).alias("what"))
    first = S.first_of(v, "what", "row_id", 3)
    return v.groupBy("what").agg(F.count("*").alias("n")).join(first, "what").select("what", "n", F.array_join(F.col("first").cast("array<string>"), ",").alias("examples"))


def top_similar(spark: SparkSession, d: str) -> DataFrame:
    """Three most similar of each class's vectors to the class's first vector, by exact products."""
    e = t(spark, d, "embeddings")
    hub = e.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("h"), F.min("vec_id").alias("hub"))
    dot = F.aggregate(F.zip_with("embedding", "h", lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    x = e.join(F.broadcast(hub), "label").filter("vec_id <> hub").select("hub", "vec_id", F.round(dot, 5).alias("cos"))
    best = x.groupBy("hub").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("cos")).alias("m"), "vec_id"))), 1, 3).alias("l"))
    return best.select("hub", F.explode("l").alias("x")).select("hub", "x.vec_id", (-F.col("x.m")).alias("cos"))


def nearest_vectors(spark: SparkSession, d: str) -> DataFrame:
    """Ten vectors of greatest cosine, of any label, to each vector whose id is divisible by 20."""
    x = R.nearest_vectors(spark, t(spark, d, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 20 == 0, 10)
    return x.select(F.col("query").alias("hub"), F.col("other").alias("vec_id"), "cos")


def grid_search(spark: SparkSession, d: str) -> DataFrame:
    """The pair of thresholds with the best precision among those that keep a recall; ties to the smaller thresholds."""
    p = t(spark, d, "pairs").filter("confirmed is not null and d_phash is not null and d_dhash is not null")
    steps = F.sequence(F.lit(4), F.lit(116), F.lit(16))  # 64 fixed settings
    j = p.withColumn("tp", F.explode(steps)).withColumn("td", F.explode(steps))
    hit = (F.col("d_phash") <= F.col("tp")) & (F.col("d_dhash") <= F.col("td"))
    g = j.groupBy("tp", "td").agg(F.count_if(hit).alias("n"), F.count_if(hit & F.col("confirmed")).alias("k"), F.count_if("confirmed").alias("m"))
    g = g.select("tp", "td", F.round(F.col("k") / F.nullif("n", F.lit(0)), 6).alias("precision"), F.round(F.col("k") / F.nullif("m", F.lit(0)), 6).alias("recall"))
    return g.filter("recall >= 0.2").orderBy(F.desc("precision"), F.desc("recall"), "tp", "td").limit(1)


QUERIES = {f.__name__: f for f in (bottom_k_by_hash, first_photo, capped_admission, stratified_sample, stratum_quotas, stride_sample, whole_group_sample, capped_total, greedy_chunks, kept_frames, nearest_earlier, series_completeness, percentile_threshold, recall_threshold, positional_join, stem_twins, capped_failures, top_similar, nearest_vectors, grid_search)}
IMG = f"img as (select *, {D64('image_sha256')} as digest from metadata)"
SQL = {
    "bottom_k_by_hash": "select source, doc_id from documents qualify row_number() over (partition by source order by sha256('0:' || doc_id), doc_id) <= 3",
    "first_photo": f"with {IMG} select digest, batch, row_id from img where digest is not null qualify row_number() over (partition by digest order by batch, row_id) = 1",
    "capped_admission": "select row_id, source_id from metadata where platform is distinct from 'towed' and ('0x' || substr(sha256('0:' || row_id), 1, 13))::bigint / 4503599627370496.0 < 0.5 qualify row_number() over (partition by source_id order by ingested_at, row_id) <= 5",
    "stratified_sample": "with q as (select source, least(count(*), greatest(1, round(200.0 * count(*) / (select count(*) from documents))::bigint)) as quota from documents group by 1) select doc_id, source from documents join q using (source) qualify row_number() over (partition by source order by sha256('0:' || doc_id), doc_id) <= quota",
    "stratum_quotas": "select source, count(*) as size, least(count(*), greatest(1, round(200.0 * count(*) / (select count(*) from documents))::bigint)) as quota from documents group by 1",
    "stride_sample": "with o as (select o_orderkey, row_number() over (order by o_orderkey) - 1 as i, count(*) over () as n from orders) select o_orderkey from o where i in (select (g.i * o2.n) // 97 from (select unnest(range(0, 97)) as i) g, (select count(*) as n from orders) o2)",
    "whole_group_sample": "with s as (select source, count(*) as n from documents group by 1), r as (select source, coalesce(sum(n) over (order by sha256('0:' || source), source rows between unbounded preceding and 1 preceding), 0) as before from s) select doc_id, source from documents where source in (select source from r where before < 300)",
    "capped_total": "select sum(least(n, 50))::bigint as expected from (select count(*) as n from metadata group by source_id)",
    "greedy_chunks": """with recursive o as (select source, coalesce(n_chars, 0) as n, row_number() over (partition by source order by doc_id) as i from documents),
 w as (select source, i, n as held, 0 as chunk from o where i = 1 union all select o.source, o.i, case when held > 0 and held + n > 5000 then n else held + n end, chunk + (held > 0 and held + n > 5000)::int from w join o on o.source = w.source and o.i = w.i + 1)
 select source, max(chunk) + 1 as chunks from w group by 1""",
    "kept_frames": """with recursive o as (select partition_name, ('0x' || substr(md5(stem), 1, 4))::bigint as c, row_number() over (partition by partition_name order by staged_id) as i from staged_images),
 w as (select partition_name, i, c as last, 1 as kept from o where i = 1 union all select o.partition_name, o.i, case when bit_count(xor(o.c, w.last)) > 6 then o.c else w.last end, kept + (bit_count(xor(o.c, w.last)) > 6)::int from w join o on o.partition_name = w.partition_name and o.i = w.i + 1)
 select partition_name, max(kept)::bigint as kept from w group by 1""",
    "nearest_earlier": "select event_id, lag(event_id) over w as earlier, round((epoch_us(ts) - epoch_us(lag(ts) over w)) / 1e6, 6) as seconds from events window w as (partition by user_id order by ts, event_id)",
    "series_completeness": "with b as (select l_orderkey, min(l_linenumber) = 1 and max(l_linenumber) = count(distinct l_linenumber) and count(*) = count(distinct l_linenumber) as complete from lineitem group by 1) select complete, count(*) as orders from b group by 1",
    "percentile_threshold": "select o_orderpriority, round(quantile_cont(o_totalprice, 0.01), 4) as p01, round(quantile_cont(o_totalprice, 0.5), 4) as p50, round(quantile_cont(o_totalprice, 0.99), 4) as p99 from orders group by 1",
    "recall_threshold": "with b as (select cos::double as c, count(*) as n, count(*) filter (confirmed) as k from pairs where cos is not null and not isnan(cos) and confirmed is not null group by 1), r as (select c, sum(n) over (order by c desc) as n, sum(k) over (order by c desc) as k, sum(k) over () as m from b) select round(c, 6) as threshold, round(k / m, 6) as recall, round(k / n, 6) as precision from r where k >= 0.9 * m order by c desc limit 1",
    "positional_join": "with a as (select source_id, staged_id, row_number() over (partition by source_id order by staged_id) as i from staged_images), b as (select source_id, row_id, row_number() over (partition by source_id order by row_id) as i from metadata) select staged_id, row_id from a join b using (source_id, i)",
    "stem_twins": "select regexp_replace(lower(stem), '[^a-z0-9]+', '', 'g') as key, count(distinct source_id) as sources, count(*) as n from staged_images group by 1 having count(distinct source_id) > 1",
    "capped_failures": f"with v as (select row_id, unnest([case when {WORD('split')} is null then 'no split' end, case when {WORD('site_id')} is null then 'no site' end]) as what from metadata) select what, count(*) as n, array_to_string(list_slice(list_sort(list(row_id)), 1, 3), ',') as examples from v where what is not null group by 1",
    "top_similar": "with h as (select label, arg_min(embedding, vec_id) as h, min(vec_id) as hub from embeddings group by 1), x as (select hub, vec_id, round(list_dot_product(embedding::double[], h::double[]), 5) as cos from embeddings join h using (label) where vec_id <> hub) select hub, vec_id, cos from x qualify row_number() over (partition by hub order by cos desc, vec_id) <= 3",
    "nearest_vectors": "with x as (select a.vec_id as hub, b.vec_id, round(list_cosine_similarity(a.embedding::double[], b.embedding::double[]), 6) as cos from embeddings a join embeddings b on a.vec_id <> b.vec_id where a.vec_id % 20 = 0) select hub, vec_id, cos from x qualify row_number() over (partition by hub order by cos desc, vec_id) <= 10",
    "grid_search": "with g as (select tp::int as tp, td::int as td from (select unnest(range(4, 132, 16)) as tp), (select unnest(range(4, 132, 16)) as td)), s as (select tp, td, count(*) filter (d_phash <= tp and d_dhash <= td) as n, count(*) filter (d_phash <= tp and d_dhash <= td and confirmed) as k, count(*) filter (confirmed) as m from pairs, g where confirmed is not null and d_phash is not null and d_dhash is not null group by 1, 2) select tp, td, round(k / nullif(n, 0), 6) as precision, round(k / nullif(m, 0), 6) as recall from s where round(k / nullif(m, 0), 6) >= 0.2 order by precision desc nulls last, recall desc, tp, td limit 1",
}
