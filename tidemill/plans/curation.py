"""Curation queries on the test tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.identity import digest, hamming, trimmed, word
from tidemill.operators import columns as C
from tidemill.operators import curate as K
from tidemill.operators import relate as R
from tidemill.operators import sample as S
from tidemill.plans.measures import CONF, SCO, scored
from tidemill.plans.problems import NODES
from tidemill.plans.relations import DH, D64, HAM, codes, images
from tidemill.plans.scalars import LICENCE, SPLIT, WORD, t
from tidemill.session import shared_dir


def source_facets(spark: SparkSession, d: str) -> DataFrame:
    """Sources with divers, an open licence and at least 30 rows, and the first reason why others don't match."""
    from tidemill.functions.text import licence_id

    m = t(spark, d, "metadata")
    s = m.groupBy("source_id").agg(F.collect_set(word(F.col("platform"))).alias("platforms"), F.collect_set(licence_id(F.col("license"))).alias("licences"), F.count("*").alias("n"))
    f = K.facets(s, has={"platforms": "diver"}, any_of={"licences": ["CC0-1.0", "CC-BY-NC-4.0"]}, at_least={"n": 30})
    return f.select("source_id", "n", "match", F.get("reasons", F.lit(0)).alias("reason"))


def hidden_drop(spark: SparkSession, d: str) -> DataFrame:
    """Rows left when listed images are dropped, except those already published; counts of both."""
    m = images(spark, d).filter("digest is not null").select("row_id", "digest", "batch")
    listed = t(spark, d, "emb").select(digest(F.col("key")).alias("digest")).filter("digest is not null").distinct()
    out = m.filter("batch = 0").select("digest").distinct()
    hidden = listed.join(out, "digest", "left_anti")
    kept = m.join(hidden, "digest", "left_anti")
    return kept.groupBy("batch").agg(F.count("*").alias("kept"))


def score_bands(spark: SparkSession, d: str) -> DataFrame:
    """Vectors by the probability of their likeliest class: certain, to be looked at, or open."""
    top = F.col("score")
    return scored(spark, d).groupBy(F.when(top >= 0.2, "certain").when(top >= 0.13, "look").otherwise("open").alias("band")).agg(F.count("*").alias("n"))


# What may point at a person, by kind.
PERSONAL = {
    "person": r"(?i)(^|[^\p{L}])(diver|observer|team|annotator|author|surveyor|photographer|plongeur|buceador|taucher)(e?s|in|innen|es)?([^\p{L}]|$)",
    "mail": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z]",
    "phone": r"(^|[^0-9.])\+?[0-9]{2,3}[ /-][0-9]{3,4}[ /-][0-9]{3,5}([^0-9]|$)",
    "link": r"(?i)(https?://|www\.)[a-z0-9]",
    "position": r"-?[0-9]{1,3}\.[0-9]{3,}[ ,;/]+-?[0-9]{1,3}\.[0-9]{3,}",
}


def people_scan(spark: SparkSession, d: str) -> DataFrame:
    """Documents that may point at a person, by kind of text and of finding."""
    found = F.array_compact(F.array(*(F.when(F.col("text").rlike(p), k) for k, p in PERSONAL.items())))
    x = t(spark, d, "documents").select("kind", "source", F.explode(found).alias("finding"))
    return x.groupBy("kind", "finding").agg(F.count("*").alias("rows"), F.countDistinct("source").alias("sources"))


def resolved_splits(spark: SparkSession, d: str) -> DataFrame:
    """The split a row names, else the one a folder of its path is named after, else all."""
    s = t(spark, d, "staged_images")
    dirs = F.split(F.lower("upstream_path"), "/")
    folder = F.coalesce(*(F.when(F.exists(dirs, lambda x: (x == n) | ((F.length(x) >= 3) & F.lit(n).startswith(x))), n) for n in ("train", "val", "test")))
    split = C.split_name(F.col("upstream_split"))
    how = F.when(split.isNotNull(), "named").when(folder.isNotNull(), "folder").otherwise("all")
    return s.groupBy(F.coalesce(split, folder, F.lit("all")).alias("split"), how.alias("how")).agg(F.count("*").alias("n"))


def verified_boxes(spark: SparkSession, d: str) -> DataFrame:
    """Classes of a vector that are likely enough, all of them for vectors that confidently belong to another class than theirs."""
    from tidemill.operators.measure import confident
    from tidemill.plans.measures import probabilities

    p = probabilities(spark, d)
    audited = confident(p).filter("likely <> label").select("key", F.lit(True).alias("audited"))
    kept = p.join(audited, "key", "left").filter((F.col("p") >= 0.12) | F.col("audited"))
    return kept.groupBy(F.col("key").alias("vec_id")).agg(F.array_join(F.array_sort(F.collect_list(F.col("class"))).cast("array<string>"), ",").alias("kept"))


def schema_report(spark: SparkSession, d: str) -> DataFrame:
    """Nulls per column that should have none."""
    m = t(spark, d, "metadata")
    cols = ["row_id", "image_sha256", "source_id", "batch", "location_generalized", "ingested_at"]
    by = m.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in cols))
    return by.select(F.expr(f"stack({len(cols)}, {', '.join(f'\'{c}\', {c}' for c in cols)}) as (field, nulls)"))


def stamped_config(spark: SparkSession, d: str) -> DataFrame:
    """The configuration that holds an image: its own, else the first by name of its copies, else images."""
    m = images(spark, d).filter("digest is not null").select("row_id", "digest", word(F.col("bytes_config")).alias("c"))
    real = m.withColumn("c", F.when(F.col("c") != "withheld", F.col("c")))
    by = real.groupBy("digest").agg(F.min("c").alias("first"))
    return real.join(by, "digest").groupBy(F.coalesce("c", "first", F.lit("images")).alias("config")).agg(F.count("*").alias("n"))


def site_mentions(spark: SparkSession, d: str) -> DataFrame:
    """Documents by the survey site their text names first, and whether that is a known one."""
    code = F.nullif(F.regexp_extract("text", r"\b([A-Z]{3}-[A-Z]?[0-9]{3,4})\b", 1), F.lit(""))
    docs = t(spark, d, "documents").select("doc_id", code.alias("site_id")).filter("site_id is not null")
    sites = t(spark, d, "noaa_esd").select("site_id", F.lit(True).alias("known")).distinct()
    return docs.join(sites, "site_id", "left").select("doc_id", "site_id", F.coalesce("known", F.lit(False)).alias("known"))


def prefix_join(spark: SparkSession, d: str) -> DataFrame:
    """Deliveries joined to staged rows whose source begins with the letters of the delivery's id; counts."""
    m = t(spark, d, "metadata").filter("upstream_id is not null").groupBy(F.substring("upstream_id", 1, 3).alias("p")).agg(F.count("*").alias("deliveries"))
    s = t(spark, d, "staged_images").groupBy(F.substring("source_id", 1, 3).alias("p")).agg(F.count("*").alias("staged"))
    return m.join(s, "p", "left").select("p", "deliveries", F.coalesce("staged", F.lit(0)).alias("staged"))


def cover_json(spark: SparkSession, d: str) -> DataFrame:
    """Class counts of each part as canonical JSON, keys sorted, and the class projected to two coarse ones."""
    n = t(spark, d, "lineitem").groupBy("l_partkey", F.concat("l_returnflag", "l_linestatus").alias("c")).agg(F.count("*").alias("n"))
    coarse = F.sum(F.when(F.col("c").startswith("N"), F.col("n")).otherwise(0))
    by = n.groupBy("l_partkey").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("c", "n"))))).alias("cover"), coarse.alias("kept"), F.sum("n").alias("total"))
    return by.select("l_partkey", "cover", "kept", "total")


def code_histogram(spark: SparkSession, d: str) -> DataFrame:
    """How often each hex digit stands in the codes: an explode-free histogram."""
    digits = "0123456789abcdef"
    by = codes(spark, d).agg(*(F.sum(F.length("code") - F.length(F.replace("code", F.lit(x), F.lit("")))).cast("bigint").alias(x) for x in digits))
    return by.select(F.expr(f"stack(16, {', '.join(f'\'{x}\', `{x}`' for x in digits)}) as (digit, n)"))


def lineage_record(spark: SparkSession, d: str) -> DataFrame:
    """Rows, images and licences per source with a hash over them that doesn't depend on order."""
    from tidemill.functions.text import licence_id

    m = images(spark, d).groupBy("source_id").agg(F.count("*").alias("rows"), F.countDistinct("digest").alias("images"), F.array_join(F.array_sort(F.collect_set(licence_id(F.col("license")))), "|").alias("licences"))
    return m.select("source_id", "rows", "images", F.sha2(F.concat_ws(";", "source_id", "rows", "images", "licences"), 256).alias("hash"))


def band_sample(spark: SparkSession, d: str) -> DataFrame:
    """Pairs drawn from bands of distance and confirmation, ten of each."""
    p = t(spark, d, "pairs").filter("d_phash is not null").select("sha_a", "sha_b", F.floor(F.col("d_phash") / 32).alias("band"), F.coalesce("confirmed", F.lit(False)).alias("ok")).distinct()
    x = S.lowest(p.withColumn("k", F.concat_ws("|", "sha_a", "sha_b")), ["band", "ok"], "k", 10)
    return x.select("band", "ok", "k")


def nearest_prior(spark: SparkSession, d: str) -> DataFrame:
    """For each image, the nearest other one by code within three bits; ties by digest."""
    p = R.hamming_pairs(codes(spark, d), "digest", "code", 3)
    both = p.select(F.col("sha_a").alias("own"), F.col("sha_b").alias("other"), "distance").union(p.select("sha_b", "sha_a", "distance"))
    best = both.groupBy("own").agg(F.min(F.struct("distance", "other")).alias("m"))
    return best.select("own", "m.other", "m.distance")


def audit_sample(spark: SparkSession, d: str) -> DataFrame:
    """Per source and kind at least two documents, with the weight each stands for."""
    x = t(spark, d, "documents").select("doc_id", "source", "kind")
    n = x.groupBy("source", "kind").agg(F.count("*").alias("size"))
    s = S.lowest(x, ["source", "kind"], "doc_id", 2).join(n, ["source", "kind"])
    return s.select("doc_id", F.round(F.col("size") / F.least("size", F.lit(2)), 6).alias("weight"))


def place_groups(spark: SparkSession, d: str) -> DataFrame:
    """The group of a delivery by the first rule that gives one: its site, place and day, its image, its own id."""
    m = images(spark, d)
    ok = F.col("lat").between(-90, 90) & F.col("lon").between(-180, 360) & ~((F.col("lat") == 0) & (F.col("lon") == 0))
    place = F.when(ok, K.cell(F.col("lat"), F.col("lon"), F.to_date("capture_datetime")))
    g = K.place_group([("site", F.col("site_id")), ("place", place), ("image", F.col("digest")), ("row", F.col("row_id").cast("string"))])
    return m.groupBy(g["rule"].alias("rule")).agg(F.count("*").alias("n"), F.countDistinct(g["grp"]).alias("groups"))


def gradient_codes(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "embeddings").select("vec_id", K.gradient_bits(F.col("embedding"), 64).alias("bits"))


def mirrored_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Distance of each code to its group's first, the smaller of as it is and mirrored."""
    c = codes(spark, d).withColumn("g", F.substring("digest", 1, 2))
    first = c.groupBy("g").agg(F.min_by("code", "digest").alias("first"))
    a, b = hamming(F.col("code"), F.col("first"), 16), hamming(K.mirrored(F.col("code")), F.col("first"), 16)
    x = c.join(first, "g").withColumns({"a": a, "b": b})
    return x.select("digest", "code", F.least("a", "b").cast("int").alias("distance"), F.when(F.col("a") <= F.col("b"), "as is").otherwise("mirrored").alias("how"))


def oriented_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Every candidate pair of images with codes: the least distance of the second to the first as it is, flipped from left
    to right and upside down, and which; the least over all codes of images with several."""
    p = t(spark, d, "pairs").select(digest(F.col("sha_a")).alias("sha_a"), digest(F.col("sha_b")).alias("sha_b")).dropna().distinct()
    c = codes(spark, d)
    x = p.join(c.select(F.col("digest").alias("sha_a"), F.col("code").alias("ca")), "sha_a").join(c.select(F.col("digest").alias("sha_b"), F.col("code").alias("cb")), "sha_b")
    across, down = K.flipped(F.col("ca"))
    far = [F.min(hamming(c, F.col("cb"), 16)).cast("int").alias(n) for c, n in ((F.col("ca"), "d0"), (across, "d1"), (down, "d2"))]
    best, how = K.least_of(F.col("d0"), F.col("d1"), F.col("d2"))
    return x.groupBy("sha_a", "sha_b").agg(*far).select("sha_a", "sha_b", best.alias("distance"), how.alias("how"))


def confirm_kinds(spark: SparkSession, d: str) -> DataFrame:
    p = t(spark, d, "pairs")
    same = digest(F.col("sha_a")) == digest(F.col("sha_b"))
    k = K.confirm_kind(F.col("d_dhash"), F.col("d_phash"), F.col("cos"), F.coalesce(same, F.lit(False)))
    return p.groupBy(k.alias("reason"), F.coalesce("confirmed", F.lit(False)).alias("confirmed")).agg(F.count("*").alias("n"))


def instance_codes(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("l_orderkey") * 7 + F.col("l_linenumber")
    return t(spark, d, "lineitem").groupBy(F.expr("(l_orderkey * 7 + l_linenumber) div 2000").alias("class")).agg(F.countDistinct(v % 2000).alias("instances"))


def star_links(spark: SparkSession, d: str) -> DataFrame:
    """Each member of a split group linked to the group's first row: a star, however large the group."""
    s = t(spark, d, "staged_images").select("staged_id", word(F.col("split_group")).alias("g")).filter("g is not null")
    return s.join(s.groupBy("g").agg(F.min("staged_id").alias("first")), "g").filter("staged_id <> first").select("first", "staged_id")


def largest_cluster(spark: SparkSession, d: str) -> DataFrame:
    """The largest run of equal codes as a share of all images: refused above a bound."""
    c = codes(spark, d)
    n = c.groupBy("code").agg(F.count("*").alias("n"))
    return n.agg(F.max("n").alias("largest"), F.sum("n").alias("images")).select("largest", "images", (F.col("largest") <= 0.01 * F.col("images")).alias("passed"))


def twin_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Stems staged with different splits."""
    s = t(spark, d, "staged_images").select(F.regexp_replace(F.lower("stem"), "[^a-z0-9]+", "").alias("key"), C.split_name(F.col("upstream_split")).alias("split")).dropna()
    return s.groupBy("key").agg(F.array_join(F.array_sort(F.collect_set("split")), "|").alias("splits")).filter("splits like '%|%'")


def qa_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Questions and answers of texts written as Q: ... A: ..."""
    b = t(spark, d, "bench_items").select("item_id", trimmed(F.regexp_extract("text", r"(?s)^Q:\s*(.*?)\s*A:\s*(.*)$", 1)).alias("question"), trimmed(F.regexp_extract("text", r"(?s)^Q:\s*(.*?)\s*A:\s*(.*)$", 2)).alias("answer"))
    return b.filter("question <> ''")


def presence_rows(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "lineitem").select("l_partkey", F.concat("l_returnflag", "l_linestatus").alias("class")).distinct().groupBy("class").agg(F.count("*").alias("parts"))


def mean_precision(spark: SparkSession, d: str) -> DataFrame:
    s = scored(spark, d)
    ap = K.average_precision(s.withColumn("hit", F.col("label") == F.col("guess")), "guess", "score", "hit")
    return ap.select("guess", F.round("ap", 6).alias("ap"))


def logistic_probe(spark: SparkSession, d: str) -> DataFrame:
    """Out-of-fold accuracy of a linear probe on the vectors, three folds by key."""
    from functools import reduce

    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    e = t(spark, d, "embeddings").select("vec_id", array_to_vector("embedding").alias("features"), F.col("label").cast("double").alias("label"), F.pmod(F.xxhash64("vec_id"), F.lit(3)).cast("int").alias("fold"))
    parts = []
    for f in range(3):
        model = LogisticRegression(maxIter=30, regParam=0.01).fit(e.filter(F.col("fold") != f))
        parts.append(model.transform(e.filter(F.col("fold") == f)).select("fold", (F.col("label") == F.col("prediction")).alias("right")))
    return reduce(DataFrame.union, parts).groupBy("fold").agg(F.count("*").alias("n"), F.round(F.avg(F.col("right").cast("int")), 4).alias("accuracy"))


def value_cache(spark: SparkSession, d: str) -> DataFrame:
    """Text hashes through a cache: the second pass computes only what the first has not."""
    path = f"{shared_dir(spark)}/cache-{uuid.uuid4().hex}"
    docs = t(spark, d, "documents")
    def compute(keys: DataFrame) -> DataFrame:
        return docs.join(keys, "doc_id").select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("h"))

    K.cached(spark, path, docs.filter("kind = 'caption'"), "doc_id", compute)
    return K.cached(spark, path, docs, "doc_id", compute)


def caption_flags(spark: SparkSession, d: str) -> DataFrame:
    """Captions that name other ground than what the label note of the same image names, where that is one class."""
    from tidemill.functions.identity import digest as as_digest
    from tidemill.operators.columns import GROUND, caption_flag, named_states

    docs = t(spark, d, "documents").select("doc_id", "text", "kind", as_digest(F.col("image_sha256")).alias("digest")).filter("digest is not null")
    notes = docs.filter("kind <> 'caption'").select("digest", F.explode(named_states(F.col("text"), GROUND)).alias("state"))
    label = notes.groupBy("digest").agg(F.min("state").alias("label"), F.max("state").alias("last")).filter("label = last").select("digest", "label")
    flagged = docs.filter("kind = 'caption'").join(label, "digest").select("doc_id", caption_flag(F.col("text"), F.col("label"), GROUND, "benthic").alias("flag"))
    return flagged.filter("flag is not null")


def allowed_rows(spark: SparkSession, d: str) -> DataFrame:
    """Deliveries under one of the licences on a list."""
    from tidemill.operators.columns import allowed

    return t(spark, d, "metadata").filter(allowed(F.col("license"), ["CC-BY-4.0", "CC0-1.0"])).groupBy("license").agg(F.count("*").alias("n"))


def uuid_licences(spark: SparkSession, d: str) -> DataFrame:
    """Images found again by the uuid in a file name, with the licence of the first delivery; the others unmatched."""
    from tidemill.operators.columns import uuid_in

    cut = lambda at, n: F.substring("digest", at, n)
    m = t(spark, d, "metadata").select("row_id", "batch", "license", digest(F.col("image_sha256")).alias("digest")).filter("digest is not null")
    m = m.withColumn("name", F.concat(F.lit("img/"), F.upper(F.concat_ws("-", cut(1, 8), cut(9, 4), cut(13, 4), cut(17, 4), cut(21, 12))), F.lit(".png")))
    known = m.filter("batch = 0").groupBy(uuid_in(F.col("name")).alias("uuid")).agg(F.min_by("license", "row_id").alias("licence"))
    j = m.withColumn("uuid", uuid_in(F.lit(None).cast("string"), F.col("name"))).join(known.withColumn("hit", F.lit(True)), "uuid", "left")
    return j.groupBy(F.when(F.col("hit"), "matched").otherwise("unmatched").alias("status"), "licence").agg(F.count("*").alias("n"))


def node_facts(spark: SparkSession, d: str) -> DataFrame:
    """Every node with its rank and the nearest family or order, itself or above it."""
    from tidemill.operators.hierarchy import nearest_of_rank

    return nearest_of_rank(spark, t(spark, d, "taxonomy"), ["family", "order"])


def grey_images(spark: SparkSession, d: str) -> DataFrame:
    """Vectors of 64 numbers as grey images of 8 x 8."""
    return t(spark, d, "embeddings").select("vec_id", F.transform("embedding", lambda v: F.floor(F.least(F.lit(255.0), F.greatest(F.lit(0.0), v.cast("double") * 60 + 128)))).alias("grey"))


def image_quality(spark: SparkSession, d: str) -> DataFrame:
    """Entropy, sharpness and clipping of every image, and whether its code means anything."""
    from tidemill.operators.pixels import described, featureless

    q = described(grey_images(spark, d), "vec_id", "grey", F.lit(8), ["entropy", "sharpness", "clipped", "spread"])
    return q.select("vec_id", *(F.round(c, 6).alias(c) for c in ("entropy", "sharpness", "clipped", "spread")), featureless(F.col("entropy")).alias("featureless"))


def image_codes(spark: SparkSession, d: str) -> DataFrame:
    """Difference codes of 9 x 8 images, as they are and mirrored."""
    from tidemill.operators.pixels import described

    wide = grey_images(spark, d).select("vec_id", F.concat("grey", F.slice("grey", 1, 8)).alias("grey"))  # 72 numbers
    return described(wide, "vec_id", "grey", F.lit(9), ["dhash", "dhash_mirrored"])


def mask_gate(spark: SparkSession, d: str) -> DataFrame:
    """Rules that masks made from rows of staged images break, and how many of each."""
    from tidemill.operators.pixels import mask_faults

    n = F.col("staged_id")
    s = t(spark, d, "staged_images").select(
        n.alias("image"), "width", "height", F.when(n % 7 == 0, F.col("height")).otherwise(F.col("width")).alias("mask_width"), F.col("height").alias("mask_height"),
        F.array((n % 5).cast("int"), F.lit(255)).alias("values"), F.when(n % 11 == 0, F.array(F.lit(1), F.lit(2), F.lit(255))).otherwise(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("classes"),
        F.sequence(F.lit(1), (n % 3 + 1).cast("int")).alias("instances"), F.array(F.lit(0), (n % 4).cast("int")).alias("seen"),
    )
    return mask_faults(s).groupBy("fault").agg(F.count("*").alias("n"))


def class_ids(spark: SparkSession, d: str) -> DataFrame:
    """Labels of edges by the class of their target: the nearest family above it, numbered in the order of names; else 255."""
    from tidemill.operators.hierarchy import nearest_of_rank

    tax = t(spark, d, "taxonomy")
    facts = nearest_of_rank(spark, tax, ["family"]).select(F.col("node_key").alias("target"), "code")
    edges = tax.filter("kind = 'edge'").select(word(F.col("key")).alias("label"), word(F.col("parent")).alias("target")).filter("label is not null").distinct()
    names = sorted(r[0] for r in facts.select("code").dropna().distinct().collect())[:255]  # one id a class
    return edges.join(facts, "target", "left").select("label", "target", C.class_id(F.col("code"), names).alias("id"))


def path_endings(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "staged_images").groupBy(C.suffix_of(F.col("upstream_path")).alias("suffix")).agg(F.count("*").alias("n"))


def check_totals(spark: SparkSession, d: str) -> DataFrame:
    """Deliveries by the outcome of their checks: passed, failed, or nothing to check."""
    m = t(spark, d, "metadata")
    bad = (F.col("lat").isNull() != F.col("lon").isNull()) | (F.col("capture_datetime").cast("date") > F.col("fetch_date"))
    status = F.when(digest(F.col("image_sha256")).isNull(), "nothing").when(F.coalesce(bad, F.lit(False)), "failed").otherwise("passed")
    return m.groupBy(status.alias("status")).agg(F.count("*").alias("n"), F.countDistinct("source_id").alias("sources"))


def half_equal_quotas(spark: SparkSession, d: str) -> DataFrame:
    """Rows a source gives to a sample that is shared half equally, half by size, and what each row stands for."""
    from tidemill.operators.sample import half_equal_sample

    s = half_equal_sample(t(spark, d, "documents").select("doc_id", "source"), "source", "doc_id", 200)
    return s.groupBy("source").agg(F.count("*").alias("n"), F.round(F.sum("weight"), 6).alias("stands_for"))


QUERIES = {f.__name__: f for f in (caption_flags, allowed_rows, uuid_licences, node_facts, class_ids, path_endings, check_totals, half_equal_quotas, image_quality, image_codes, mask_gate, source_facets, hidden_drop, score_bands, people_scan, resolved_splits, verified_boxes, schema_report, stamped_config, site_mentions, prefix_join, cover_json, code_histogram, lineage_record, band_sample, nearest_prior, audit_sample, place_groups, gradient_codes, mirrored_pairs, oriented_pairs, confirm_kinds, instance_codes, star_links, largest_cluster, twin_conflicts, qa_pairs, presence_rows, mean_precision, logistic_probe, value_cache)}
GREY = "gr as (select vec_id, list_transform(embedding, lambda v: floor(least(255.0, greatest(0.0, v::double * 60 + 128)))) as g from embeddings where embedding is not null), px as (select vec_id, unnest(g) as v from gr)"
IMG = f"img as (select *, {D64('image_sha256')} as digest from metadata)"
HEX = lambda c: f"('0x' || {c})::bigint"
BITS = lambda a, b: f"bit_count(xor({HEX(f'substr({a}, 1, 8)')}, {HEX(f'substr({b}, 1, 8)')})) + bit_count(xor({HEX(f'substr({a}, 9)')}, {HEX(f'substr({b}, 9)')}))"
MIRROR = "array_to_string(list_transform(range(0, 8), lambda i: reverse(substr(translate(code, '0123456789abcdef', '084c2a6e195d3b7f'), (i * 2 + 1)::int, 2))), '')"
SQL = {
    "source_facets": f"with s as (select source_id, list(distinct {WORD('platform')}) as p, list(distinct {LICENCE}) as l, count(*) as n from metadata group by 1), r as (select source_id, n, list_filter([case when not coalesce(list_contains(p, 'diver'), false) then 'platforms: no diver' end, case when not list_has_any(l, ['CC0-1.0', 'CC-BY-NC-4.0', 'global']) then 'licences: none of CC0-1.0, CC-BY-NC-4.0' end, case when n < 30 then 'n: below 30' end], lambda x: x is not null) as r from s) select source_id, n, len(r) = 0 as match, r[1] as reason from r",
    "hidden_drop": f"with {IMG}, h as (select distinct {D64('key')} as k from emb) select batch, count(*) as kept from img where digest is not null and not (digest in (select k from h where k is not null) and digest not in (select digest from img where batch = 0 and digest is not null)) group by 1",
    "score_bands": f"with {SCO} select case when score >= 0.2 then 'certain' when score >= 0.13 then 'look' else 'open' end as band, count(*) as n from s group by 1",
    "people_scan": "select kind, finding, count(*) as rows, count(distinct source) as sources from (select kind, source, unnest([" + ", ".join(f"case when regexp_matches(text, '{p}') then '{k}' end" for k, p in PERSONAL.items()) + "]) as finding from documents) where finding is not null group by 1, 2",
    "resolved_splits": f"with s as (select {SPLIT('upstream_split')} as s, string_split(lower(upstream_path), '/') as d from staged_images), f as (select s, case when len(list_filter(d, lambda x: x = 'train' or (length(x) >= 3 and starts_with('train', x)))) > 0 then 'train' when len(list_filter(d, lambda x: x = 'val' or (length(x) >= 3 and starts_with('val', x)))) > 0 then 'val' when len(list_filter(d, lambda x: x = 'test' or (length(x) >= 3 and starts_with('test', x)))) > 0 then 'test' end as f from s) select coalesce(s, f, 'all') as split, case when s is not null then 'named' when f is not null then 'folder' else 'all' end as how, count(*) as n from f group by 1, 2",
    "verified_boxes": f"with {CONF}, a as (select vec_id from cf where likely <> label) select vec_id, string_agg(c::varchar, ',' order by c) as kept from pr where p >= 0.12 or vec_id in (select vec_id from a) group by 1",
    "schema_report": " union all ".join(f"select '{c}' as field, count(*) filter ({c} is null) as nulls from metadata" for c in ("row_id", "image_sha256", "source_id", "batch", "location_generalized", "ingested_at")),
    "stamped_config": f"with {IMG}, r as (select digest, nullif({WORD('bytes_config')}, 'withheld') as c from img where digest is not null), b as (select digest, min(c) as f from r group by 1) select coalesce(c, f, 'images') as config, count(*) as n from r join b using (digest) group by 1",
    "site_mentions": r"with x as (select doc_id, nullif(regexp_extract(text, '\b([A-Z]{3}-[A-Z]?[0-9]{3,4})\b', 1), '') as site_id from documents) select doc_id, site_id, site_id in (select site_id from noaa_esd) as known from x where site_id is not null",
    "prefix_join": "with m as (select substr(upstream_id, 1, 3) as p, count(*) as deliveries from metadata where upstream_id is not null group by 1), s as (select substr(source_id, 1, 3) as p, count(*) as staged from staged_images group by 1) select p, deliveries, coalesce(staged, 0) as staged from m left join s using (p)",
    "cover_json": "with n as (select l_partkey, l_returnflag || l_linestatus as c, count(*) as n from lineitem group by 1, 2) select l_partkey, '{' || string_agg('\"' || c || '\":' || n, ',' order by c) || '}' as cover, coalesce(sum(n) filter (c like 'N%'), 0)::bigint as kept, sum(n)::bigint as total from n group by 1",
    "code_histogram": f"with {DH}, x as (select unnest(string_split(code, '')) as digit from dh) select digit, count(*) as n from x group by 1",
    "lineage_record": f"with {IMG}, m as (select source_id, count(*) as rows, count(distinct digest) as images, string_agg(distinct {LICENCE}, '|' order by {LICENCE}) as l from img group by 1) select source_id, rows, images, sha256(source_id || ';' || rows || ';' || images || ';' || l) as hash from m",
    "band_sample": "with p as (select distinct sha_a || '|' || sha_b as k, (d_phash // 32)::bigint as band, coalesce(confirmed, false) as ok from pairs where d_phash is not null) select band, ok, k from p qualify row_number() over (partition by band, ok order by sha256('0:' || k), k) <= 10",
    "nearest_prior": f"with {HAM}, b as (select sha_a as own, sha_b as other, distance from pr where distance <= 3 union all select sha_b, sha_a, distance from pr where distance <= 3) select own, other, distance::int as distance from b qualify row_number() over (partition by own order by distance, other) = 1",
    "audit_sample": "with x as (select doc_id, count(*) over (partition by source, kind) as size, row_number() over (partition by source, kind order by sha256('0:' || doc_id), doc_id) as r from documents) select doc_id, round(size / least(size, 2), 6) as weight from x where r <= 2",
    "place_groups": f"with {IMG}, g as (select case when lat between -90 and 90 and lon between -180 and 360 and not (lat = 0 and lon = 0) and capture_datetime is not null then round_even(lat, 2) || ':' || round_even(lon, 2) || ':' || capture_datetime::date end as place, nullif(trim(site_id), '') as site, digest, row_id from img) select case when site is not null then 'site' when place is not null then 'place' when digest is not null then 'image' else 'row' end as rule, count(*) as n, count(distinct coalesce(site, place, digest, row_id::varchar)) as \"groups\" from g group by 1",
    "gradient_codes": "select vec_id, array_to_string(list_transform(range(1, 64), lambda i: case when embedding[(i + 1)::int] > embedding[i::int] then '1' else '0' end), '') as bits from embeddings",
    "oriented_pairs": f"""with {DH}, p as (select distinct {D64('sha_a')} as sha_a, {D64('sha_b')} as sha_b from pairs), c as (select sha_a, sha_b, a.code as ca, b.code as cb from p join dh a on a.digest = sha_a join dh b on b.digest = sha_b),
 f as (select *, translate({MIRROR.replace('code', 'ca')}, '0123456789abcdef', 'fedcba9876543210') as ch, array_to_string([substr(ca, 15 - 2 * i, 2) for i in range(8)], '') as cv from c),
 d as (select sha_a, sha_b, min({BITS('ca', 'cb')})::int as d0, min({BITS('ch', 'cb')})::int as d1, min({BITS('cv', 'cb')})::int as d2 from f group by 1, 2)
 select sha_a, sha_b, least(d0, d1, d2) as distance, case when d0 <= d1 and d0 <= d2 then 'as is' when d1 <= d2 then 'left-right' else 'upside down' end as how from d""",
    "mirrored_pairs": f"with {DH}, f as (select substr(digest, 1, 2) as g, arg_min(code, digest) as first from dh group by 1), x as (select digest, code, {BITS('code', 'first')} as a, {BITS(MIRROR, 'first')} as b from dh join f on substr(digest, 1, 2) = g) select digest, code, least(a, b)::int as distance, case when a <= b then 'as is' else 'mirrored' end as how from x",
    "confirm_kinds": f"select case when coalesce({D64('sha_a')} = {D64('sha_b')}, false) then 'exact' when d_dhash <= 2 and d_phash <= 24 then 'copy' when d_dhash <= 6 and cos >= 0.9 then 'agree' end as reason, coalesce(confirmed, false) as confirmed, count(*) as n from pairs group by 1, 2",
    "instance_codes": "select (l_orderkey * 7 + l_linenumber) // 2000 as class, count(distinct (l_orderkey * 7 + l_linenumber) % 2000) as instances from lineitem group by 1",
    "star_links": f"with s as (select staged_id, {WORD('split_group')} as g from staged_images), f as (select g, min(staged_id) as first from s where g is not null group by 1) select first, staged_id from s join f using (g) where staged_id <> first",
    "largest_cluster": f"with {DH}, n as (select count(*) as n from dh group by code) select max(n) as largest, sum(n)::bigint as images, max(n) <= 0.01 * sum(n) as passed from n",
    "twin_conflicts": f"with s as (select regexp_replace(lower(stem), '[^a-z0-9]+', '', 'g') as key, {SPLIT('upstream_split')} as s from staged_images) select key, string_agg(distinct s, '|' order by s) as splits from s where key is not null and s is not null group by 1 having count(distinct s) > 1",
    "qa_pairs": r"select item_id, trim(regexp_extract(text, '(?s)^Q:\s*(.*?)\s*A:\s*(.*)$', 1)) as question, trim(regexp_extract(text, '(?s)^Q:\s*(.*?)\s*A:\s*(.*)$', 2)) as answer from bench_items where regexp_extract(text, '(?s)^Q:\s*(.*?)\s*A:\s*(.*)$', 1) <> ''",
    "presence_rows": "select class, count(*) as parts from (select distinct l_partkey, l_returnflag || l_linestatus as class from lineitem) group by 1",
    "mean_precision": f"with {SCO}, b as (select guess, score, count(*) as n, count(*) filter (label = guess) as k from s group by 1, 2), r as (select guess, sum(k) over w as tp, sum(n) over w as n, sum(k) over (partition by guess) as m from b window w as (partition by guess order by score desc)), p as (select guess, floor(tp * 100 / m)::int as level, tp / n as p from r where m > 0), g as (select guess, l, max(p) as p from p, (select unnest(range(0, 101)) as l) where level >= l group by 1, 2) select guess, round(sum(p) / 101, 6) as ap from g group by 1",
    "value_cache": "select doc_id, sha256(coalesce(text, '')) as h from documents",
    "caption_flags": f"""with d as (select doc_id, kind, {D64('image_sha256')} as digest, list_sort(list_filter([case when contains(lower(coalesce(text, '')), 'hard coral') then 'HC' end, case when contains(lower(coalesce(text, '')), 'soft coral') then 'SC' end, case when contains(lower(coalesce(text, '')), 'coral rubble') then 'RB' end, case when contains(lower(coalesce(text, '')), 'sand') then 'SD' end, case when contains(lower(coalesce(text, '')), 'algae') then 'ALG' end, case when contains(lower(coalesce(text, '')), 'rock') then 'RCK' end, case when contains(lower(coalesce(text, '')), 'sponge') then 'SP' end], lambda x: x is not null)) as named from documents), n as (select digest, unnest(named) as state from d where kind <> 'caption' and digest is not null),
 l as (select digest, min(state) as label from n group by 1 having min(state) = max(state))
 select doc_id, 'benthic:caption=' || array_to_string(named, ',') || '!=label=' || label as flag from d join l using (digest) where kind = 'caption' and len(named) > 0 and not list_contains(named, label)""",
    "image_quality": f"""with {GREY}, h as (select vec_id, v, count(*) as n from px group by 1, 2), en as (select vec_id, greatest(0, -sum(n / 64 * log2(n / 64))) as entropy from h group by 1),
 la as (select vec_id, g[k - 8] + g[k + 8] + g[k - 1] + g[k + 1] - 4 * g[k] as l from gr, (select i * 8 + j + 1 as k from (select unnest(range(1, 7)) as i), (select unnest(range(1, 7)) as j))), sh as (select vec_id, var_pop(l) as sharpness from la group by 1),
 o as (select vec_id, avg((v <= 0 or v >= 255)::int) as clipped, stddev_pop(v) as spread from px group by 1)
 select vec_id, round(entropy, 6) as entropy, round(sharpness, 6) as sharpness, round(clipped, 6) as clipped, round(spread, 6) as spread, entropy < 2 as featureless from en join sh using (vec_id) join o using (vec_id)""",
    "image_codes": f"""with {GREY}, w as (select vec_id, list_concat(g, g[1:8]) as g from gr), k as (select r, c, 63 - (r * 8 + c) as bit from (select unnest(range(0, 8)) as r), (select unnest(range(0, 8)) as c)),
 b as (select vec_id, sum(case when g[r * 9 + c + 2] > g[r * 9 + c + 1] then 1::ubigint << bit else 0 end) as a, sum(case when g[r * 9 + 8 - c] > g[r * 9 + 9 - c] then 1::ubigint << bit else 0 end) as m from w, k group by 1)
 select vec_id, printf('%016x', a::ubigint) as dhash, printf('%016x', m::ubigint) as dhash_mirrored from b""",
    "mask_gate": """with s as (select staged_id as n, width, height, case when staged_id % 7 = 0 then height else width end as mw from staged_images),
 f as (select n, unnest([case when coalesce(width = mw and height = height, false) then null else 'size' end, case when n % 5 = 4 or (n % 5 = 3 and n % 11 = 0) then 'class' end, case when n % 11 = 0 then 'ignore listed' end, case when n % 4 > n % 3 + 1 then 'stray' end, case when n % 5 = 0 then 'empty' end]) as fault from s)
 select fault, count(*) as n from f where fault is not null group by 1""",
    "class_ids": f"""with recursive {NODES}, up as (select node, node as above, 0 as steps from n union all select u.node, n.parent, u.steps + 1 from up u join n on u.above = n.node where n.parent is not null and u.steps < 100),
 t as (select node from n where parent is null union all select n.node from n join t on n.parent = t.node), r as (select u.node, u.above, u.steps from up u join n on n.node = u.above where n.rank = 'family' and (u.node in (select node from t) or u.steps = 0)),
 f as (select node, above from r qualify row_number() over (partition by node order by steps) = 1), c as (select above, row_number() over (order by above) - 1 as i from (select distinct above from f)),
 e as (select distinct {WORD('key')} as label, {WORD('parent')} as target from taxonomy where kind = 'edge') select label, target, coalesce(case when i < 255 then i end, 255)::int as id from e left join f on f.node = target left join c on c.above = f.above where label is not null""",
    "path_endings": r"select nullif(regexp_extract(regexp_replace(regexp_replace(lower(upstream_path), '[?#].*$', ''), '^.*/', ''), '[^.]\.((?:tar\.)?[a-z0-9]+)$', 1), '') as suffix, count(*) as n from staged_images group by 1",
    "check_totals": f"select case when {D64('image_sha256')} is null then 'nothing' when coalesce((lat is null) <> (lon is null) or capture_datetime::date > fetch_date, false) then 'failed' else 'passed' end as status, count(*) as n, count(distinct source_id) as sources from metadata group by 1",
    "allowed_rows": "select license, count(*) as n from metadata where license in ('CC-BY-4.0', 'CC0-1.0') group by 1",
    "uuid_licences": f"with m as (select row_id, batch, license, substr({D64('image_sha256')}, 1, 32) as u from metadata where {D64('image_sha256')} is not null), k as (select u, arg_min_null(license, row_id) as licence from m where batch = 0 group by 1) select case when k.u is not null then 'matched' else 'unmatched' end as status, licence, count(*) as n from m left join k using (u) group by 1, 2",
    "node_facts": f"""with recursive {NODES}, up as (select node, node as above, 0 as steps from n union all select u.node, n.parent, u.steps + 1 from up u join n on u.above = n.node where n.parent is not null and u.steps < 100),
 t as (select node from n where parent is null union all select n.node from n join t on n.parent = t.node), r as (select u.node, u.above, u.steps from up u join n on n.node = u.above where n.rank in ('family', 'order') and (u.node in (select node from t) or u.steps = 0))
 select n.node as node_key, n.rank, f.above as code from n left join (select * from r qualify row_number() over (partition by node order by steps) = 1) f on f.node = n.node""",
}
