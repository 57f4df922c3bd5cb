"""Joins, aggregations and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.identity import code, digest, word
from tidemill.operators import columns as C
from tidemill.operators import relate as R
from tidemill.plans.scalars import SPLIT, WORD, t

D64 = lambda c: f"case when regexp_matches(lower(trim(split_part({c}, ':', -1), ' ' || chr(9) || chr(10) || chr(13))), '^[0-9a-f]{{64}}$') then lower(trim(split_part({c}, ':', -1), ' ' || chr(9) || chr(10) || chr(13))) end"
DCODE = "lpad(regexp_replace(lower(trim(dhash, ' ' || chr(9) || chr(10) || chr(13))), '^0x', ''), 16, '0')"
DH = f"dh as (select distinct {D64('sha256')} as digest, {DCODE} as code from dhash where regexp_matches(lower(trim(dhash, ' ' || chr(9) || chr(10) || chr(13))), '^(0x)?[0-9a-f]{{1,16}}$') and {DCODE} not in (repeat('0', 16), repeat('f', 16)))"


#: Bits within which two codes make one component; bits of the gate and of the band between batches.
UNION_BITS, BAND_BITS = 4, 8


def images(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "metadata").withColumn("digest", digest(F.col("image_sha256")))


def codes(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "dhash").select(digest(F.col("sha256")).alias("digest"), code(F.col("dhash"), 16, pad=True).alias("code")).dropna().distinct()


def corpus_counters(spark: SparkSession, d: str) -> DataFrame:
    """All counters of the corpus in one pass: in total, by source, by split, by source and split."""
    m = images(spark, d).select("source_id", C.split_name(F.col("split")).alias("split"), "digest")
    m.createOrReplaceTempView("counted")
    return spark.sql("select source_id, split, cast(grouping_id() as int) as grain, count(*) as rows, count(distinct digest) as images from counted group by grouping sets ((), (source_id), (split), (source_id, split))")


def class_histogram(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity")).orderBy(F.desc("n"))


def field_coverage(spark: SparkSession, d: str) -> DataFrame:
    return R.coverage(t(spark, d, "metadata"), ["split", "license", "lat", "lon", "site_id", "platform", "capture_datetime"], "source_id")


def point_rollup(spark: SparkSession, d: str) -> DataFrame:
    rows = t(spark, d, "lineitem").select("l_partkey", F.concat("l_returnflag", "l_linestatus").alias("label"))
    rows = rows.withColumn("label", F.when(F.col("label") == "NF", F.lit("unknown")).otherwise(F.col("label")))
    r = R.rollup(rows, "l_partkey", "label", floor=10)
    return r.select("l_partkey", "known", "unknown", "dominant", F.array_join("present", ",").alias("present"))


def fact_rollup(spark: SparkSession, d: str) -> DataFrame:
    rows = t(spark, d, "documents").select("source", F.coalesce("lang", F.lit("unknown")).alias("label"))
    r = R.rollup(rows, "source", "label", floor=0, least_known=0.5)
    return r.select("source", "known", "unknown", "dominant", F.array_join("present", ",").alias("present"))


def group_counts(spark: SparkSession, d: str) -> DataFrame:
    """Images per source, each image once: in the smallest source that has it."""
    first = images(spark, d).filter("digest is not null").groupBy("digest").agg(F.min("source_id").alias("source_id"))
    return first.groupBy("source_id").agg(F.count("*").alias("images"))


def strata_shares(spark: SparkSession, d: str) -> DataFrame:
    m = images(spark, d).select("source_id", C.split_name(F.col("split")).alias("split"), "digest").filter("split is not null and digest is not null").distinct()
    by = m.groupBy("source_id").agg(F.count("*").alias("n"), *(F.count_if(F.col("split") == s).alias(s) for s in ("train", "val", "test")))
    return by.select("source_id", "n", *(F.round(100.0 * F.col(s) / F.col("n"), 1).alias(s) for s in ("train", "val", "test")))


def group_straddle(spark: SparkSession, d: str) -> DataFrame:
    s = t(spark, d, "staged_images").select(word(F.col("split_group")).alias("grp"), C.split_name(F.col("upstream_split")).alias("split")).dropna()
    by = s.groupBy("grp").agg(F.countDistinct("split").alias("splits"), *(F.count_if(F.col("split") == x).alias(x) for x in ("train", "val", "test")))
    return by.filter("splits > 1")


def overlap_matrix(spark: SparkSession, d: str) -> DataFrame:
    return R.overlaps(images(spark, d).select("source_id", "digest").dropna(), "source_id", "digest")


def agreement_pairs(spark: SparkSession, d: str) -> DataFrame:
    """How often two sources of one image name the same split, by pair of sources."""
    m = images(spark, d).select("digest", "source_id", C.split_name(F.col("split")).alias("label")).dropna()
    return R.agreement(m, "digest", "source_id", "label")


def label_conflicts(spark: SparkSession, d: str) -> DataFrame:
    m = images(spark, d).select("digest", C.split_name(F.col("split")).alias("label")).dropna()
    c = m.groupBy("digest").agg(F.array_sort(F.collect_set("label")).alias("labels")).filter("size(labels) > 1")
    return c.select("digest", F.array_join("labels", "|").alias("labels"))


def label_status(spark: SparkSession, d: str) -> DataFrame:
    """The gravest status of each image: conflict, ambiguous, vague, ok."""
    m = images(spark, d).filter("digest is not null").select("digest", C.split_name(F.col("split")).alias("s"), word(F.col("split")).alias("w"), "location_generalized")
    by = m.groupBy("digest").agg(F.countDistinct("s").alias("n"), F.max(F.col("w").isNotNull() & F.col("s").isNull()).alias("odd"), F.max(F.coalesce("location_generalized", F.lit(False))).alias("vague"))
    status = F.when(F.col("n") > 1, "conflict").when(F.col("odd"), "ambiguous").when(F.col("vague"), "vague").otherwise("ok")
    return by.groupBy(status.alias("status")).agg(F.count("*").alias("n"))


def join_coverage(spark: SparkSession, d: str) -> DataFrame:
    return R.join_misses({"phash": t(spark, d, "phash").select(digest(F.col("sha256")).alias("k")), "dhash": t(spark, d, "dhash").select(digest(F.col("sha256")).alias("k")), "emb": t(spark, d, "emb").select(digest(F.col("key")).alias("k"))}, images(spark, d).select(F.col("digest").alias("k")))


def digest_join(spark: SparkSession, d: str) -> DataFrame:
    """Deliveries with the number of codes known of their image, zero where there is none."""
    n = codes(spark, d).groupBy("digest").agg(F.count("*").alias("n"))
    m = images(spark, d).select("row_id", "digest").join(n, "digest", "left")
    return m.select("row_id", F.coalesce("n", F.lit(0)).alias("codes"))


def crosswalk_join(spark: SparkSession, d: str) -> DataFrame:
    """Taxonomy rows linked to a target by number when they have one, else by name; the first target wins."""
    tax = t(spark, d, "taxonomy").filter("kind = 'node'").select(word(F.col("key")).alias("key"), "name", "aphia_id").distinct()
    target = t(spark, d, "taxonomy").filter("kind = 'node' and rank is not null").select(word(F.col("key")).alias("target"), "name", "aphia_id")
    return R.by_number_then_name(tax, target, "aphia_id", "name", "target").select("key", "target", "how").distinct()


def exact_dups(spark: SparkSession, d: str) -> DataFrame:
    """Neighbours in each run of equal codes: enough links for components, without all pairs."""
    return R.run_links(codes(spark, d), "code", "digest").select(F.col("a").alias("sha_a"), F.col("b").alias("sha_b"))


def identical_codes(spark: SparkSession, d: str) -> DataFrame:
    return codes(spark, d).groupBy("code").agg(F.countDistinct("digest").alias("images"), F.min("digest").alias("first")).filter("images > 1")


def hamming_pairs(spark: SparkSession, d: str) -> DataFrame:
    return R.hamming_pairs(codes(spark, d), "digest", "code", 3).select("sha_a", "sha_b", "distance")


def distance_band(spark: SparkSession, d: str) -> DataFrame:
    return R.hamming_pairs(codes(spark, d), "digest", "code", 3).filter("distance > 1").select("sha_a", "sha_b", "distance")


def union_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Images of which the codes make one component."""
    return R.near_items(codes(spark, d), "digest", "code", UNION_BITS)


def gate_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Images that the gate holds for near copies."""
    return R.near_items(codes(spark, d), "digest", "code", BAND_BITS)


def prior_band(spark: SparkSession, d: str) -> DataFrame:
    """Images of a later first batch beside images of an earlier one, beyond one component but inside the band."""
    first = images(spark, d).filter("digest is not null and batch is not null").groupBy("digest").agg(F.min("batch").alias("batch"))
    p = gate_pairs(spark, d).filter(F.col("distance") > UNION_BITS)
    p = p.join(first.selectExpr("digest as sha_a", "batch as batch_a"), "sha_a").join(first.selectExpr("digest as sha_b", "batch as batch_b"), "sha_b").filter("batch_a <> batch_b")
    later = F.col("batch_a") > F.col("batch_b")
    return p.select(F.when(later, F.col("sha_a")).otherwise(F.col("sha_b")).alias("new"), F.when(later, F.col("sha_b")).otherwise(F.col("sha_a")).alias("prior"), "distance")


def nearest_in_band(spark: SparkSession, d: str) -> DataFrame:
    """For each image of a later batch the nearest earlier one in the band; ties by digest."""
    best = prior_band(spark, d).groupBy("new").agg(F.min(F.struct("distance", "prior")).alias("m"))
    return best.select("new", "m.prior", "m.distance")


def channel_union(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of all channels with a bit for each that proposed them, in either order once."""
    p = t(spark, d, "pairs").select(digest(F.col("sha_a")).alias("x"), digest(F.col("sha_b")).alias("y"), word(F.col("channels")).alias("c")).filter("x is not null and y is not null and x <> y")
    bit = F.when(F.col("c") == "dhash", 1).when(F.col("c") == "phash64", 2).when(F.col("c") == "embed", 4).otherwise(8)
    p = p.select(F.least("x", "y").alias("sha_a"), F.greatest("x", "y").alias("sha_b"), bit.alias("bit"))
    return p.groupBy("sha_a", "sha_b").agg(F.bit_or("bit").cast("int").alias("bits"))


def digest_sets(spark: SparkSession, d: str) -> DataFrame:
    """Images by which of the three tables hold them."""
    def held(name: str, c: str) -> DataFrame:
        return t(spark, d, name).select(digest(F.col(c)).alias("k")).filter("k is not null").select("k", F.lit(name).alias("held"))

    u = held("metadata", "image_sha256").union(held("phash", "sha256")).union(held("emb", "key"))
    by = u.groupBy("k").agg(F.array_join(F.array_sort(F.collect_set("held")), "+").alias("held"))
    return by.groupBy("held").agg(F.count("*").alias("n"))


def schema_union(spark: SparkSession, d: str) -> DataFrame:
    """Staged and delivered rows in one table, columns of one side null on the other."""
    a = t(spark, d, "metadata").select("source_id", "license", "lat").withColumn("origin", F.lit("metadata"))
    b = t(spark, d, "staged_images").select("source_id", "license", "width").withColumn("origin", F.lit("staged"))
    u = a.unionByName(b, allowMissingColumns=True)
    return u.groupBy("origin").agg(F.count("*").alias("n"), F.count("lat").alias("lats"), F.count("width").alias("widths"), F.countDistinct("source_id").alias("sources"))


def manifest_diff(spark: SparkSession, d: str) -> DataFrame:
    """Keys added, removed, changed and kept between the first and the last taxonomy version, whose numbers are compared one by
    one."""
    number = F.transform(F.split("taxonomy_version", r"\."), lambda x: x.try_cast("int"))
    v = t(spark, d, "taxonomy").filter("kind = 'node' and taxonomy_version is not null").select(word(F.col("key")).alias("k"), word(F.col("parent")).alias("p"), number.alias("v"))
    old, new = (v.filter(F.col("v") == v.agg(f("v")).scalar()).groupBy("k").agg(F.min("p").alias("p")) for f in (F.min, F.max))
    return R.difference(old, new, "k", "p").groupBy("change").agg(F.count("*").alias("n"))


def alias_collapse(spark: SparkSession, d: str) -> DataFrame:
    """Nodes whose lower-cased name another, smaller key already bears, folded into that key."""
    n = t(spark, d, "taxonomy").filter("kind = 'node'").select(word(F.col("key")).alias("k"), word(F.col("name")).alias("name")).dropna().distinct()
    return n.join(n.groupBy("name").agg(F.min("k").alias("into")), "name").filter("k <> into").select("k", "into").groupBy("k").agg(F.min("into").alias("into"))


def per_config_counts(spark: SparkSession, d: str) -> DataFrame:
    m = images(spark, d).select(word(F.col("bytes_config")).alias("config"), C.split_name(F.col("split")).alias("split"), "digest").filter("config is not null")
    p = m.groupBy("config").pivot("split", ["train", "val", "test"]).agg(F.countDistinct("digest"))
    return p.select("config", *(F.coalesce(s, F.lit(0)).alias(s) for s in ("train", "val", "test")))


def manifest_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Share of each source's images that have a vector."""
    e = t(spark, d, "emb").select(digest(F.col("key")).alias("digest")).filter("digest is not null").distinct().withColumn("has", F.lit(1))
    m = images(spark, d).filter("digest is not null").select("source_id", "digest").distinct().join(e, "digest", "left")
    return m.groupBy("source_id").agg(F.count("has").alias("covered"), F.count("*").alias("images"), F.round(F.count("has") / F.count("*"), 6).alias("share"))


def vocabulary_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Ranks of nodes against the ranks that edges map: mapped, unmapped and unused."""
    rows = t(spark, d, "taxonomy").select("kind", word(F.col("rank")).alias("rank")).filter("rank is not null")
    known = rows.filter("kind = 'edge'").select("rank").distinct()
    seen = rows.filter("kind = 'node'").groupBy("rank").agg(F.count("*").alias("n"))
    j = seen.alias("s").join(known.alias("k"), F.col("s.rank") == F.col("k.rank"), "full_outer")
    kind = F.when(F.col("k.rank").isNull(), "unmapped").when(F.col("s.rank").isNull(), "unused").otherwise("mapped")
    return j.select(F.coalesce("s.rank", "k.rank").alias("rank"), kind.alias("kind"), F.coalesce("n", F.lit(0)).alias("n"))


def node_reach(spark: SparkSession, d: str) -> DataFrame:
    """Documents' kinds used by more than one source, with the number of sources."""
    return t(spark, d, "documents").groupBy("kind", "lang").agg(F.countDistinct("source").alias("sources"), F.count("*").alias("n")).filter("sources > 1")


def table_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    """Order-free content hash of a table."""
    return R.fingerprint(t(spark, d, "nation"), ["n_nationkey", "n_name", "n_regionkey"])


QUERIES = {f.__name__: f for f in (corpus_counters, class_histogram, field_coverage, point_rollup, fact_rollup, group_counts, strata_shares, group_straddle, overlap_matrix, agreement_pairs, label_conflicts, label_status, join_coverage, digest_join, crosswalk_join, exact_dups, identical_codes, hamming_pairs, distance_band, union_pairs, gate_pairs, prior_band, nearest_in_band, channel_union, digest_sets, schema_union, manifest_diff, alias_collapse, per_config_counts, manifest_coverage, vocabulary_coverage, node_reach, table_fingerprint)}

IMG = f"img as (select *, {D64('image_sha256')} as digest, {SPLIT('split')} as s from metadata)"
ROLL = """k as (select {g}, label, count(*) as n from r group by 1, 2),
 s as (select {g}, sum(n) filter (label <> 'unknown') as known, sum(n) filter (label = 'unknown') as unknown from k group by 1),
 q as (select {g}, coalesce(known, 0)::bigint as known, coalesce(unknown, 0)::bigint as unknown from s where {keep}),
 f as (select k.{g}, label, n / known as share from k join q using ({g}) where label <> 'unknown' and known > 0),
 o as (select {g}, arg_max(label, share) as top, max(share) as best, string_agg(label, ',' order by label) filter (share >= 0.1) as present, count(*) as classes from (select * from f order by {g}, share desc, label) group by 1)"""
HAM = f"{DH}, pr as (select a.digest as sha_a, b.digest as sha_b, bit_count(xor(('0x' || substr(a.code, 1, 8))::bigint, ('0x' || substr(b.code, 1, 8))::bigint)) + bit_count(xor(('0x' || substr(a.code, 9))::bigint, ('0x' || substr(b.code, 9))::bigint)) as distance from dh a join dh b on a.digest < b.digest)"  # noqa: E501
PRIOR = f"""{HAM}, near as (select sha_a, sha_b, min(distance)::int as distance from pr where distance <= 8 group by 1, 2), fb as (select {D64('image_sha256')} as digest, min(batch) as batch from metadata where batch is not null group by 1),
 band as (select case when x.batch > y.batch then sha_a else sha_b end as new, case when x.batch > y.batch then sha_b else sha_a end as prior, distance from near join fb x on x.digest = sha_a join fb y on y.digest = sha_b where x.batch <> y.batch and distance > 4)"""
SQL = {
    "corpus_counters": f"with {IMG} select source_id, s as split, grouping(source_id, s)::int as grain, count(*) as rows, count(distinct digest) as images from img group by grouping sets ((), (source_id), (s), (source_id, s))",
    "class_histogram": "select l_returnflag, l_linestatus, count(*) as n, round(sum(l_quantity), 2) as quantity from lineitem group by 1, 2",
    "field_coverage": "with u as (select source_id, f.unnest.field as field, f.unnest.has as has from metadata, unnest([{'field': 'split', 'has': split is not null}, {'field': 'license', 'has': license is not null}, {'field': 'lat', 'has': lat is not null}, {'field': 'lon', 'has': lon is not null}, {'field': 'site_id', 'has': site_id is not null}, {'field': 'platform', 'has': platform is not null}, {'field': 'capture_datetime', 'has': capture_datetime is not null}]) f) select source_id, field, round(100.0 * count(*) filter (has) / count(*), 1) as percent from u group by grouping sets ((field), (source_id, field))",
    "point_rollup": "with r as (select l_partkey, case when l_returnflag || l_linestatus = 'NF' then 'unknown' else l_returnflag || l_linestatus end as label from lineitem), " + ROLL.format(g="l_partkey", keep="coalesce(unknown, 0) <= 0.5 * (coalesce(known, 0) + coalesce(unknown, 0))") + " select l_partkey, known, unknown, case when known < 10 then null when best >= 0.5 then top else 'mixed' end as dominant, case when known < 10 then null else coalesce(present, '') end as present from q left join o using (l_partkey)",
    "fact_rollup": "with r as (select source, coalesce(lang, 'unknown') as label from documents), " + ROLL.format(g="source", keep="coalesce(known, 0) >= 0.5 * (coalesce(known, 0) + coalesce(unknown, 0))") + " select source, known, unknown, case when best >= 0.5 then top when best is not null then 'mixed' end as dominant, coalesce(present, '') as present from q left join o using (source)",
    "group_counts": f"with {IMG}, f as (select digest, min(source_id) as source_id from img where digest is not null group by 1) select source_id, count(*) as images from f group by 1",
    "strata_shares": f"with {IMG}, m as (select distinct source_id, s, digest from img where s is not null and digest is not null) select source_id, count(*) as n, round(100.0 * count(*) filter (s = 'train') / count(*), 1) as train, round(100.0 * count(*) filter (s = 'val') / count(*), 1) as val, round(100.0 * count(*) filter (s = 'test') / count(*), 1) as test from m group by 1",
    "group_straddle": f"with g as (select {WORD('split_group')} as grp, {SPLIT('upstream_split')} as s from staged_images) select grp, count(distinct s) as splits, count(*) filter (s = 'train') as train, count(*) filter (s = 'val') as val, count(*) filter (s = 'test') as test from g where grp is not null and s is not null group by 1 having count(distinct s) > 1",
    "overlap_matrix": f"with {IMG}, m as (select source_id, digest, count(*) as n from img where digest is not null group by 1, 2) select a.source_id as source_a, b.source_id as source_b, count(*) as images from m a join m b on a.digest = b.digest and (a.source_id <> b.source_id or a.n > 1) group by 1, 2",
    "agreement_pairs": f"with {IMG}, m as (select distinct digest, source_id, s from img where digest is not null and s is not null) select a.source_id as source_a, b.source_id as source_b, count(*) as pairs, count(*) filter (a.s = b.s) as agree from m a join m b on a.digest = b.digest and a.source_id < b.source_id group by 1, 2",
    "label_conflicts": f"with {IMG} select digest, string_agg(distinct s, '|' order by s) as labels from img where digest is not null and s is not null group by 1 having count(distinct s) > 1",
    "label_status": f"with {IMG}, b as (select digest, count(distinct s) as n, bool_or({WORD('split')} is not null and s is null) as odd, bool_or(coalesce(location_generalized, false)) as vague from img where digest is not null group by 1) select case when n > 1 then 'conflict' when odd then 'ambiguous' when vague then 'vague' else 'ok' end as status, count(*) as n from b group by 1",
    "join_coverage": f"with {IMG}, x as (select 'phash' as tbl, {D64('sha256')} as k from phash union all select 'dhash', {D64('sha256')} from dhash union all select 'emb', {D64('key')} from emb) select tbl, count(*) as rows, count(*) filter (k is null) as no_key, count(*) filter (k is not null and k not in (select digest from img where digest is not null)) as no_match from x group by 1",
    "digest_join": f"with {IMG}, {DH}, n as (select digest, count(*) as n from dh group by 1) select row_id, coalesce(n, 0) as codes from img left join n using (digest)",
    "crosswalk_join": f"with x as (select distinct {WORD('key')} as key, name, aphia_id from taxonomy where kind = 'node'), g as (select {WORD('key')} as target, name, aphia_id from taxonomy where kind = 'node' and rank is not null), i as (select aphia_id, min(target) as target from g where aphia_id is not null group by 1), n as (select name, min(target) as target from g where name is not null group by 1) select distinct key, coalesce(i.target, n.target) as target, case when i.target is not null then 'number' when n.target is not null then 'name' end as how from x left join i using (aphia_id) left join n on x.name = n.name",
    "exact_dups": f"with {DH}, l as (select digest as b, lag(digest) over (partition by code order by digest) as a from dh) select a as sha_a, b as sha_b from l where a is not null",
    "identical_codes": f"with {DH} select code, count(distinct digest) as images, min(digest) as first from dh group by 1 having count(distinct digest) > 1",
    "union_pairs": f"with {HAM} select sha_a, sha_b, min(distance)::int as distance from pr where distance <= 4 group by 1, 2",
    "gate_pairs": f"with {PRIOR} select * from near",
    "prior_band": f"with {PRIOR} select * from band",
    "nearest_in_band": f"with {PRIOR} select new, prior, distance from band qualify row_number() over (partition by new order by distance, prior) = 1",
    "hamming_pairs": f"with {HAM} select sha_a, sha_b, distance::int as distance from pr where distance <= 3",
    "distance_band": f"with {HAM} select sha_a, sha_b, distance::int as distance from pr where distance > 1 and distance <= 3",
    "channel_union": f"with p as (select {D64('sha_a')} as x, {D64('sha_b')} as y, {WORD('channels')} as c from pairs) select least(x, y) as sha_a, greatest(x, y) as sha_b, bit_or(case when c = 'dhash' then 1 when c = 'phash64' then 2 when c = 'embed' then 4 else 8 end)::int as bits from p where x is not null and y is not null and x <> y group by 1, 2",
    "digest_sets": f"with u as (select {D64('image_sha256')} as k, 'metadata' as held from metadata union all select {D64('sha256')}, 'phash' from phash union all select {D64('key')}, 'emb' from emb), b as (select k, string_agg(distinct held, '+' order by held) as held from u where k is not null group by 1) select held, count(*) as n from b group by 1",
    "schema_union": "select 'metadata' as origin, count(*) as n, count(lat) as lats, 0 as widths, count(distinct source_id) as sources from metadata union all select 'staged', count(*), 0, count(width), count(distinct source_id) from staged_images",
    "manifest_diff": f"with v as (select {WORD('key')} as k, {WORD('parent')} as p, list_transform(string_split(taxonomy_version, '.'), lambda x: x::int) as v from taxonomy where kind = 'node' and taxonomy_version is not null), o as (select k, min(p) as p from v where v = (select min(v) from v) group by 1), n as (select k, min(p) as p from v where v = (select max(v) from v) group by 1) select case when o.k is null then 'added' when n.k is null then 'removed' when o.p is distinct from n.p then 'changed' else 'kept' end as change, count(*) as n from o full join n on o.k = n.k group by 1",
    "alias_collapse": f"with n as (select distinct {WORD('key')} as k, {WORD('name')} as name from taxonomy where kind = 'node'), m as (select name, min(k) as t from n where name is not null and k is not null group by 1) select k, min(t) as \"into\" from n join m using (name) where k <> t group by 1",
    "per_config_counts": f"with {IMG}, m as (select {WORD('bytes_config')} as config, s, digest from img) select config, count(distinct digest) filter (s = 'train') as train, count(distinct digest) filter (s = 'val') as val, count(distinct digest) filter (s = 'test') as test from m where config is not null group by 1",
    "manifest_coverage": f"with {IMG}, e as (select distinct {D64('key')} as digest, 1 as has from emb), m as (select distinct source_id, digest from img where digest is not null) select source_id, count(has) as covered, count(*) as images, round(count(has) / count(*), 6) as share from m left join e using (digest) group by 1",
    "vocabulary_coverage": f"with r as (select kind, {WORD('rank')} as rank from taxonomy), k as (select distinct rank from r where kind = 'edge' and rank is not null), s as (select rank, count(*) as n from r where kind = 'node' and rank is not null group by 1) select coalesce(s.rank, k.rank) as rank, case when k.rank is null then 'unmapped' when s.rank is null then 'unused' else 'mapped' end as kind, coalesce(n, 0) as n from s full join k on s.rank = k.rank",
    "table_fingerprint": """with h as (select sha256('{"n_nationkey":"' || n_nationkey || '","n_name":"' || n_name || '","n_regionkey":"' || n_regionkey || '"}') as h from nation),
 s as (select count(*) as rows, sum(('0x' || substr(h, 1, 15))::bigint)::varchar as a, sum(('0x' || substr(h, 16, 15))::bigint)::varchar as b, sum(('0x' || substr(h, 31, 15))::bigint)::varchar as c, sum(('0x' || substr(h, 46, 15))::bigint)::varchar as d from h)
 select rows, sha256(concat_ws(':', rows, a, b, c, d)) as digest from s""",
    "node_reach": "select kind, lang, count(distinct source) as sources, count(*) as n from documents group by 1, 2 having count(distinct source) > 1",
}
