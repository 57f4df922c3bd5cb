"""Row-level queries: predicates, zones, provenance, positions, stems, licences, text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions import geo, text
from tidemill.functions.identity import trimmed, word
from tidemill.operators import columns as C


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def predicate_nulls(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("platform")
    ops = {"eq": ("eq", "diver"), "ne": ("ne", "diver"), "inside": ("in", ["diver", "towed"]), "outside": ("not_in", ["diver", "towed"])}
    return t(spark, d, "metadata").agg(*(F.count_if(C.predicate(c, *v)).alias(k) for k, v in ops.items()))


def depth_zones(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "metadata").groupBy(C.depth_zone(F.col("depth_m")).alias("zone")).agg(F.count("*").alias("n"))


def split_names(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "metadata").groupBy(word(F.col("split")).alias("written"), C.split_name(F.col("split")).alias("split")).agg(F.count("*").alias("n"))


def row_violations(spark: SparkSession, d: str) -> DataFrame:
    m = t(spark, d, "metadata")
    rules = {
        "no digest": word(F.col("image_sha256")).isNull(),
        "no licence": word(F.col("license")).isNull(),
        "half a position": F.col("lat").isNull() != F.col("lon").isNull(),
        "latitude": ~F.isnan("lat") & ~F.col("lat").between(-90, 90),
        "captured after fetch": F.to_date("capture_datetime") > F.col("fetch_date"),
        "ingested before fetch": F.to_date("ingested_at") < F.col("fetch_date"),
    }
    found = m.select("row_id", F.explode(C.violations(rules)).alias("violation"))
    return found.groupBy("violation").agg(F.count("*").alias("n"), F.min("row_id").alias("first_row"))


def repeated_digests(spark: SparkSession, d: str) -> DataFrame:
    m = t(spark, d, "metadata").select("row_id", "image_sha256", "source_id")
    return C.with_repeats(m, ["image_sha256", "source_id"]).filter("repeats > 1").select("row_id", "repeats")


def null_fill(spark: SparkSession, d: str) -> DataFrame:
    """Positions and depth of staged rows filled, as a unit, from the site their metadata names."""
    m = t(spark, d, "metadata")
    sites = t(spark, d, "noaa_esd").groupBy("site_id").agg(F.min(F.struct("lat", "lon")).alias("s"))
    own = C.as_unit(F.col("lat"), F.col("lon"))
    theirs = C.as_unit(F.col("s.lat"), F.when(F.col("s.lon") > 180, F.col("s.lon") - 360).otherwise(F.col("s.lon")))
    place = F.when(own.isNotNull(), own).otherwise(theirs)
    origin = F.when(own.isNotNull(), "row").when(theirs.isNotNull(), "site")
    joined = m.select("row_id", "lat", "lon", "site_id").join(sites, "site_id", "left")
    return joined.select("row_id", F.round(place["lat"], 6).alias("lat"), F.round(place["lon"], 6).alias("lon"), origin.alias("origin"))


def generalised_positions(spark: SparkSession, d: str) -> DataFrame:
    m = t(spark, d, "metadata").filter(F.col("lat").between(-90, 90) & F.col("lon").between(-180, 360))
    vague = F.coalesce("location_generalized", F.lit(False))
    cell = [F.bround(F.col(c), 0).cast("int").alias(f"{c}_cell") for c in ("lat", "lon")]
    return m.select(vague.alias("vague"), *cell).groupBy("vague", "lat_cell", "lon_cell").agg(F.count("*").alias("n"))


def quality_flags(spark: SparkSession, d: str) -> DataFrame:
    """Texts far shorter than the corpus, or of odd make-up; the thresholds are percentiles over all documents."""
    docs = t(spark, d, "documents").filter("text is not null")
    cut = lambda q: docs.agg(F.percentile("n_chars", F.lit(q))).scalar()
    rules = {"short": F.col("n_chars") < cut(0.01), "long": F.col("n_chars") > cut(0.99), "blank": word(F.col("text")).isNull(), "digits": F.length(F.regexp_replace("text", "[^0-9]", "")) * 4 > F.col("n_chars")}
    flagged = docs.select("doc_id", C.violations(rules).alias("flags")).filter("size(flags) > 0")
    return flagged.select("doc_id", F.array_join("flags", ",").alias("flags"))


def first_non_blank(spark: SparkSession, d: str) -> DataFrame:
    m = t(spark, d, "metadata")
    value, origin = C.first_present({"site_id": F.col("site_id"), "platform": F.col("platform"), "upstream_id": F.col("upstream_id")})
    return m.select("row_id", value.alias("value"), origin.alias("origin"))


def stem_parts(spark: SparkSession, d: str) -> DataFrame:
    s = t(spark, d, "staged_images")
    day = C.calendar_date(F.col("stem"))
    return s.select("staged_id", day.alias("day"), F.year(day).alias("year"), F.when(day.isNull(), "no date").alias("reason"))


def licence_classes(spark: SparkSession, d: str) -> DataFrame:
    m = t(spark, d, "metadata")
    return m.groupBy(text.licence_id(F.col("license")).alias("licence"), text.licence_class(F.col("license")).alias("class")).agg(F.count("*").alias("n"))


def joined_licences(spark: SparkSession, d: str) -> DataFrame:
    m = t(spark, d, "metadata")
    parts = F.array_join(F.array_sort(F.collect_set(text.licence_id(F.col("license")))), "; ")
    return m.groupBy("source_id").agg(parts.alias("licences"))


def answer_normalise(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "bench_items").select("item_id", text.normal_answer(F.col("text")).alias("answer"))


def number_words(spark: SparkSession, d: str) -> DataFrame:
    docs = t(spark, d, "documents")
    toks = docs.select(F.explode(F.split(text.normal_answer(F.col("text")), " ")).alias("w"))
    return toks.filter("w rlike '^[0-9]+$'").groupBy(F.length("w").alias("digits")).agg(F.count("*").alias("n"))


def stem_words(spark: SparkSession, d: str) -> DataFrame:
    tax = t(spark, d, "taxonomy").filter("name is not null")
    return tax.select(F.explode(text.stems(F.col("name"))).alias("stem")).groupBy("stem").agg(F.count("*").alias("n")).filter("n > 1")


def caption_template(spark: SparkSession, d: str) -> DataFrame:
    m = t(spark, d, "metadata")
    depth = F.when(F.col("depth_m").isNotNull() & ~F.isnan("depth_m"), F.concat(F.lit("at "), F.format_string("%.1f", F.col("depth_m").cast("double")), F.lit(" m")))
    clauses = [F.concat(F.lit("taken by "), word(F.col("platform"))), depth, F.concat(F.lit("near site "), trimmed(F.col("site_id"))), F.concat(F.lit("in "), F.year("capture_datetime").cast("string"))]
    return m.select("row_id", text.caption(clauses).alias("caption"), text.facts(clauses).alias("facts"))


def box_geometry(spark: SparkSession, d: str) -> DataFrame:
    """Unit boxes from pixel boxes: normalised, clipped, degenerate ones null, and back to pixels."""
    s = t(spark, d, "staged_images")
    x = (F.pmod(F.col("staged_id") * 37, F.lit(5000)) - 400).cast("double")
    w = (F.pmod(F.col("staged_id") * 53, F.lit(1500))).cast("double")
    low, high, clipped = geo.unit_span(x, x + w, F.col("width"))
    a, b = geo.pixel_span(low, high, F.col("width"))
    return s.select("staged_id", F.floor(low * 1_000_000).alias("x_min_ppm"), F.floor(high * 1_000_000).alias("x_max_ppm"), clipped.alias("clipped"), a.alias("px_min"), b.alias("px_max"))


def site_extents(spark: SparkSession, d: str) -> DataFrame:
    """Greatest distance between the positions of each island, and its centre where that is small."""
    s = t(spark, d, "noaa_esd").filter("lat between -90 and 90 and lon between -180 and 360").select("island", "lat", "lon").distinct()
    a, b = s.alias("a"), s.alias("b")
    far = geo.haversine(F.col("a.lat"), F.col("a.lon"), F.col("b.lat"), F.col("b.lon"))
    ext = a.join(b, "island").groupBy("island").agg(F.max(far).alias("m"))
    mid = s.groupBy("island").agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon"), F.count("*").alias("n"))
    small = F.col("m") <= 50_000
    return ext.join(mid, "island").select("island", F.round("m", 3).alias("extent_m"), "n", F.when(small, F.round("lat", 5)).alias("lat"), F.when(small, F.round("lon", 5)).alias("lon"))


def json_attrs(spark: SparkSession, d: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    return t(spark, d, "events").groupBy("event_type").agg(F.sum(k).cast("bigint").alias("k"), F.count_if(k.isNull()).alias("missing"))


def size_bands(spark: SparkSession, d: str) -> DataFrame:
    n = t(spark, d, "metadata").groupBy("source_id").agg(F.count("*").alias("n"))
    return n.select("source_id", "n", C.size_band(F.col("n")).alias("band"))


def wilson_by_source(spark: SparkSession, d: str) -> DataFrame:
    n = t(spark, d, "metadata").groupBy("source_id").agg(F.count_if(F.col("lat").isNotNull()).alias("k"), F.count("*").alias("n"))
    low, high = C.wilson(F.col("k"), F.col("n"))
    return n.select("source_id", "k", "n", F.round(low, 6).alias("low"), F.round(high, 6).alias("high"))


def leak_scan(spark: SparkSession, d: str) -> DataFrame:
    """Identifiers of sites and sources that stand as whole words in a text column of the documents."""
    m, e = t(spark, d, "metadata"), t(spark, d, "noaa_esd")
    known = e.select(F.trim("site_id").alias("name")).union(m.select(F.trim("site_id"))).union(m.select(F.trim("source_id"))).filter("name <> ''").distinct()
    docs = t(spark, d, "documents")
    words = lambda c: docs.select("doc_id", F.lit(c).alias("column"), F.explode(F.array_distinct(F.regexp_extract_all(c, F.lit("[A-Za-z0-9_-]+"), F.lit(0)))).alias("name"))
    found = words("text").union(words("kind")).join(known, "name", "left_semi")
    return found.groupBy("column", "name").agg(F.count("*").alias("n"))


def frame_steps(spark: SparkSession, d: str) -> DataFrame:
    """Every n-th frame of a clip, the step raised so that the rate stays below a bound."""
    s = t(spark, d, "staged_images").select("staged_id", (F.pmod("staged_id", F.lit(90)) + 10).cast("int").alias("frames"), F.lit(25.0).alias("fps"))
    step = F.greatest(F.lit(10), F.ceil(F.col("fps") / 1.0).cast("int"))
    return s.select("staged_id", F.explode(F.sequence(F.lit(0), F.col("frames") - 1, step)).alias("frame"))


QUERIES = {f.__name__: f for f in (predicate_nulls, depth_zones, split_names, row_violations, repeated_digests, null_fill, generalised_positions, quality_flags, first_non_blank, stem_parts, licence_classes, joined_licences, answer_normalise, number_words, stem_words, caption_template, box_geometry, site_extents, json_attrs, size_bands, wilson_by_source, leak_scan, frame_steps)}

BLANK = r"' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12) || chr(160) || chr(65279)"
WORD = lambda c: f"nullif(lower(trim({c}, {BLANK})), '')"
SPLIT = lambda c: f"case when {WORD(c)} in ('train','training') then 'train' when {WORD(c)} in ('val','valid','validation','dev') then 'val' when {WORD(c)} in ('test','testing','test_ood') then 'test' end"
HAV = lambda a, b, c, d: f"2*6371008.8*asin(sqrt(least(1.0, pow(sin(radians({c}-{a})/2),2)+cos(radians({a}))*cos(radians({c}))*pow(sin(radians({d}-{b})/2),2))))"
LICENCE = f"coalesce(upper(regexp_replace({WORD('license')}, '[ _]+', '-', 'g')), 'UNKNOWN')"
ANSWER = r"""trim(regexp_replace(list_aggregate(list_filter(string_split(trim(regexp_replace(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}\s]', ' ', 'g'), '\s+', ' ', 'g')), ' '), lambda w: w not in ('a','an','the')), 'string_agg', ' '), '\s+', ' ', 'g'))"""
NUM = {"zero": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9, "ten": 10}
TOKENS = "list_transform(list_filter(string_split(trim(regexp_replace(regexp_replace(lower(coalesce(text, '')), '[^\\p{L}\\p{N}\\s]', ' ', 'g'), '\\s+', ' ', 'g')), ' '), lambda w: w not in ('a','an','the')), lambda w: coalesce(map {" + ", ".join(f"'{k}': '{v}'" for k, v in NUM.items()) + "}[w], w))"  # noqa: E501
SQL = {
    "predicate_nulls": "select count(*) filter (platform is not distinct from 'diver') as eq, count(*) filter (platform is distinct from 'diver') as ne, count(*) filter (coalesce(platform in ('diver','towed'), false)) as inside, count(*) filter (not coalesce(platform in ('diver','towed'), false)) as outside from metadata",
    "depth_zones": "select case when isnan(depth_m) then null when depth_m >= -2 and depth_m < 10 then 'shallow' when depth_m >= 10 and depth_m < 30 then 'upper' when depth_m >= 30 and depth_m < 150 then 'mesophotic' when depth_m >= 150 and depth_m < 11000 then 'deep' end as zone, count(*) as n from metadata group by 1",
    "split_names": f"select {WORD('split')} as written, {SPLIT('split')} as split, count(*) as n from metadata group by 1, 2",
    "row_violations": f"""with v as (select row_id, unnest([case when {WORD('image_sha256')} is null then 'no digest' end, case when {WORD('license')} is null then 'no licence' end,
 case when (lat is null) <> (lon is null) then 'half a position' end, case when not isnan(lat) and not (lat between -90 and 90) then 'latitude' end,
 case when capture_datetime::date > fetch_date then 'captured after fetch' end, case when ingested_at::date < fetch_date then 'ingested before fetch' end]) as violation from metadata)
 select violation, count(*) as n, min(row_id) as first_row from v where violation is not null group by 1""",
    "repeated_digests": "select row_id, count(*) over (partition by image_sha256, source_id) as repeats from metadata qualify repeats > 1",
    "null_fill": """with s as (select site_id, min({'lat': lat, 'lon': lon}) as s from noaa_esd group by 1),
 j as (select m.row_id, case when m.lat between -90 and 90 and m.lon between -180 and 180 and not isnan(m.lat) and not isnan(m.lon) then {'lat': m.lat, 'lon': m.lon} end as own,
  s.s.lat as slat, case when s.s.lon > 180 then s.s.lon - 360 else s.s.lon end as slon from metadata m left join s using (site_id)),
 k as (select row_id, own, case when slat between -90 and 90 and slon between -180 and 180 then {'lat': slat, 'lon': slon} end as theirs from j)
 select row_id, round(coalesce(own, theirs).lat, 6) as lat, round(coalesce(own, theirs).lon, 6) as lon, case when own is not null then 'row' when theirs is not null then 'site' end as origin from k""",
    "generalised_positions": "select coalesce(location_generalized, false) as vague, round_even(lat, 0)::int as lat_cell, round_even(lon, 0)::int as lon_cell, count(*) as n from metadata where lat between -90 and 90 and lon between -180 and 360 group by 1, 2, 3",
    "quality_flags": f"""with c as (select quantile_cont(n_chars, 0.01) as low, quantile_cont(n_chars, 0.99) as high from documents where text is not null),
 f as (select doc_id, list_filter([case when n_chars < low then 'short' end, case when n_chars > high then 'long' end, case when {WORD('text')} is null then 'blank' end, case when length(regexp_replace(text, '[^0-9]', '', 'g')) * 4 > n_chars then 'digits' end], lambda x: x is not null) as flags from documents, c where text is not null)
 select doc_id, array_to_string(flags, ',') as flags from f where len(flags) > 0""",
    "first_non_blank": "select row_id, coalesce(nullif(trim(site_id), ''), nullif(trim(platform), ''), nullif(trim(upstream_id), '')) as value, case when nullif(trim(site_id), '') is not null then 'site_id' when nullif(trim(platform), '') is not null then 'platform' when nullif(trim(upstream_id), '') is not null then 'upstream_id' end as origin from metadata",
    "stem_parts": r"with s as (select staged_id, try_strptime(regexp_replace(regexp_extract(stem, '(\d{4})[-_.]?(\d{2})[-_.]?(\d{2})'), '[-_.]', '', 'g'), '%Y%m%d')::date as day from staged_images) select staged_id, day, year(day)::int as year, case when day is null then 'no date' end as reason from s",
    "licence_classes": f"select {LICENCE} as licence, case when {LICENCE} like '%-NC%' then 'noncommercial' when {LICENCE} like '%-ND%' then 'noderivatives' when {LICENCE} like '%-SA%' then 'sharealike' when {LICENCE} like 'CC-BY%' then 'attribution' when {LICENCE} like 'CC0%' or {LICENCE} like 'PUBLIC-DOMAIN%' then 'open' else 'unknown' end as class, count(*) as n from metadata group by 1, 2",
    "joined_licences": f"select source_id, string_agg(distinct {LICENCE}, '; ' order by {LICENCE}) as licences from metadata group by 1",
    "answer_normalise": f"select item_id, coalesce(array_to_string({TOKENS}, ' '), '') as answer from bench_items",
    "number_words": f"select length(w) as digits, count(*) as n from (select unnest({TOKENS}) as w from documents) where regexp_matches(w, '^[0-9]+$') group by 1",
    "stem_words": r"""with w as (select unnest(string_split(trim(regexp_replace(lower(name), '[^a-z0-9]+', ' ', 'g')), ' ')) as w from taxonomy where name is not null)
 select case when w like '%ies' and length(w) > 4 then substr(w, 1, length(w) - 3) || 'y' when w like '%s' and not w like '%ss' and not w like '%us' and not w like '%is' and length(w) > 3 then substr(w, 1, length(w) - 1) else w end as stem, count(*) as n
 from w where w <> '' and w not in ('a','an','and','for','in','of','on','the','to','with') group by 1 having count(*) > 1""",
    "caption_template": f"""with c as (select row_id, list_filter(['taken by ' || {WORD('platform')}, case when not isnan(depth_m) then 'at ' || printf('%.1f', round_even(depth_m::double, 1)) || ' m' end, 'near site ' || trim(site_id), 'in ' || year(capture_datetime)::varchar], lambda x: x is not null) as l from metadata)
 select row_id, case when len(l) = 0 then '' else upper(substr(array_to_string(l, ', '), 1, 1)) || substr(array_to_string(l, ', '), 2) || '.' end as caption, len(l)::int as facts from c""",
    "box_geometry": """with b as (select staged_id, width, ((staged_id * 37) % 5000 - 400)::double as x, ((staged_id * 53) % 1500)::double as w from staged_images),
 u as (select *, greatest(0.0, least(1.0, x / width)) as low, greatest(0.0, least(1.0, (x + w) / width)) as high, (x < 0 or x + w > width) as clipped from b)
 select staged_id, case when high > low then floor(low * 1000000)::bigint end as x_min_ppm, case when high > low then floor(high * 1000000)::bigint end as x_max_ppm, clipped,
  case when high > low then floor(low * width + 1e-6)::int end as px_min, case when high > low then ceil(high * width - 1e-6)::int end as px_max from u""",
    "site_extents": f"""with s as (select distinct island, lat, lon from noaa_esd where lat between -90 and 90 and lon between -180 and 360),
 e as (select a.island, max({HAV('a.lat', 'a.lon', 'b.lat', 'b.lon')}) as m from s a join s b on a.island = b.island group by 1),
 c as (select island, avg(lat) as lat, avg(lon) as lon, count(*) as n from s group by 1)
 select e.island, round(m, 3) as extent_m, n, case when m <= 50000 then round(lat, 5) end as lat, case when m <= 50000 then round(lon, 5) end as lon from e join c using (island)""",
    "json_attrs": "select event_type, sum((props::json->>'$.k')::int)::bigint as k, count(*) filter ((props::json->>'$.k') is null) as missing from events group by 1",
    "size_bands": "select source_id, count(*) as n, case when count(*) < 1000 then 'n<1K' when count(*) < 10000 then '1K<n<10K' when count(*) < 100000 then '10K<n<100K' when count(*) < 1000000 then '100K<n<1M' else 'n>1M' end as band from metadata group by 1",
    "wilson_by_source": "with a as (select source_id, count(lat) as k, count(*) as n, 1.959963984540054 as z from metadata group by 1) select source_id, k, n, round(greatest(0, (k/n + z*z/(2*n) - z*sqrt((k/n)*(1-k/n)/n + z*z/(4*n*n))) / (1 + z*z/n)), 6) as low, round(least(1, (k/n + z*z/(2*n) + z*sqrt((k/n)*(1-k/n)/n + z*z/(4*n*n))) / (1 + z*z/n)), 6) as high from a",
    "leak_scan": "with k as (select trim(site_id) as name from noaa_esd union select trim(site_id) from metadata union select trim(source_id) from metadata), w as (select distinct doc_id, 'text' as c, unnest(regexp_extract_all(text, '[A-Za-z0-9_-]+')) as name from documents union all select distinct doc_id, 'kind', unnest(regexp_extract_all(kind, '[A-Za-z0-9_-]+')) from documents) select c as \"column\", name, count(*) as n from w where name in (select name from k where name <> '') group by 1, 2",
    "frame_steps": "select staged_id, unnest(range(0, (staged_id % 90 + 10)::int, 25))::int as frame from staged_images",
}
