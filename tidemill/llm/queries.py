"""Queries p2 to p10 of the training-data operators, and the SQL for those that SQL can express on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemill.llm import bpe, cross_split, groups, history, leaks, lookalike, neighbours, splits  # noqa: F401  what they need is there

Query = Callable[[SparkSession, str], DataFrame]


def read(spark: SparkSession, d: str, *names: str) -> list[DataFrame]:
    return [spark.read.parquet(f"{d}/{n}.parquet") for n in names]


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    from tidemill.llm.cross_split import overlaps

    return overlaps(spark, *read(spark, d, "metadata", "phash", "emb"))


def p2_report(spark: SparkSession, d: str) -> DataFrame:
    from tidemill.llm.cross_split import overlap_report

    return overlap_report(spark, *read(spark, d, "metadata", "phash", "emb"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    from tidemill.llm.groups import match_groups

    return match_groups(spark, *read(spark, d, "phash", "dhash", "pairs"))


def chain_guard(spark: SparkSession, d: str) -> DataFrame:
    from tidemill.llm.groups import chain_guard as guard

    return guard(spark, *read(spark, d, "dhash", "pairs"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    from tidemill.llm.history import backfill

    return backfill(spark, *read(spark, d, "metadata", "phash"))


def p7_newest(spark: SparkSession, d: str) -> DataFrame:
    from tidemill.llm.history import last_batch

    return last_batch(spark, *read(spark, d, "metadata", "phash"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    from tidemill.llm.splits import torn

    return torn(spark, *read(spark, d, "staged_images"))


def p4_balance(spark: SparkSession, d: str) -> DataFrame:
    """Achieved shares of the splits, and bundles that lie in more than one."""
    from tidemill.llm.splits import balance

    return balance(spark, *read(spark, d, "staged_images")).select("split", "target", "torn", "within")


def p4_splits(spark: SparkSession, d: str) -> DataFrame:
    from tidemill.llm.splits import assign

    return assign(spark, *read(spark, d, "staged_images"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    from tidemill.llm.lookalike import alike

    return alike(spark, *read(spark, d, "documents"))


def p10_forms(spark: SparkSession, d: str) -> DataFrame:
    from tidemill.llm.lookalike import with_form

    return with_form(read(spark, d, "documents")[0].select("doc_id", "text")).select("doc_id", "form")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    from tidemill.llm.neighbours import similar_pairs

    return similar_pairs(spark, *read(spark, d, "emb"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    from tidemill.llm.bpe import encode

    return encode(*read(spark, d, "documents"))


def p8_decoded(spark: SparkSession, d: str) -> DataFrame:
    from tidemill.llm.bpe import decode, encode

    return decode(encode(*read(spark, d, "documents")))


def p8_counts(spark: SparkSession, d: str) -> DataFrame:
    from tidemill.llm.bpe import token_counts

    return token_counts(spark, *read(spark, d, "documents"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    from tidemill.llm.leaks import exact, leaks

    return exact(leaks(spark, *read(spark, d, "documents", "bench_items")))


def p9_edited(spark: SparkSession, d: str) -> DataFrame:
    from tidemill.llm.leaks import edited, near

    return edited(near(spark, *read(spark, d, "documents", "bench_items")))


QUERIES: dict[str, Query] = {
    "p2_found": p2_found,
    "p2_report": p2_report,
    "p3_found": p3_found,
    "chain_guard": chain_guard,
    "p4_found": p4_found,
    "p4_splits": p4_splits,
    "p4_balance": p4_balance,
    "p5_found": p5_found,
    "p7_found": p7_found,
    "p7_newest": p7_newest,
    "p8_ids": p8_ids,
    "p8_decoded": p8_decoded,
    "p8_counts": p8_counts,
    "p9_found": p9_found,
    "p9_edited": p9_edited,
    "p10_found": p10_found,
    "p10_forms": p10_forms,
}
#: Quadratic or recursive twins for the oracle engine: brute force over all pairs, closure over all links.
BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160) || chr(65279)"
_word = lambda c: f"nullif(lower(trim({c}, {BLANK})), '')"
_digest = lambda c: f"regexp_extract({_word(f'split_part({c}, chr(58), -1)')}, '^[0-9a-f]{{64}}$')"
_bits = lambda a, b: " + ".join(f"bit_count(xor(('0x' || substr({a}, {i}, 8))::bigint, ('0x' || substr({b}, {i}, 8))::bigint))::int" for i in range(1, 65, 8))
_PH = f"""ph as (select distinct nullif({_digest('sha256')}, '') as g, regexp_replace({_word('phash')}, '^0x', '') as c from phash where regexp_matches({_word('phash')}, '^(0x)?[0-9a-f]{{64}}$')),
 codes as (select * from ph where g is not null and c not in (repeat('0', 64), repeat('f', 64)))"""
_VEC = f"""v0 as (select nullif({_digest('key')}, '') as g, max(vec) as vec from emb where len(vec) = 64 and not list_bool_or(list_transform(vec, lambda x: x is null or isnan(x) or isinf(x))) and list_bool_or(list_transform(vec, lambda x: x <> 0)) group by 1),
 vecs as (select g, list_transform(vec, lambda x: x::double) as v from v0 where g is not null), cosines as (select a.g as a, b.g as b, list_cosine_similarity(a.v, b.v) as c from vecs a join vecs b on a.g <> b.g)"""
_META = f"md as (select *, nullif({_digest('image_sha256')}, '') as g, {_word('split')} as s, {_word('bytes_config')} as cfg from metadata)"
_SITE = r"(?:^|[^a-z0-9])([a-z]{3})[^a-z0-9]*([a-z]?)[^a-z0-9]*(\d{3,4})[^a-z0-9]+(\d{4})[^a-z0-9]?(\d{2})[^a-z0-9]?(\d{2})(?:[^a-z0-9]+(?:frame|f)?[^a-z0-9]*|(?:frame|f)[^a-z0-9]*)(\d+)"
_CLOSE = "r as (select a as v, a as u from links2 union select r.v, links2.b from r join links2 on r.u = links2.a), root as (select v, min(u) as root from r group by 1)"


def _form(text: str) -> str:
    """Problem 10's form in SQL: characters one by one, from the operator's fixed lists, between two compositions."""
    import unicodedata

    from tidemill.llm import lookalike as L

    one = {c: k for k, v in L.ALIKE.items() for c in v} | dict.fromkeys(L.HYPHENS, "-") | {chr(0xFEE0 + i): chr(i) for i in range(0x21, 0x7F) if i != 0x2D}
    for cp in (*range(0x370, 0x530), *range(0x1F00, 0x2000)):  # accented letters whose base is drawn alike
        c = unicodedata.normalize("NFC", chr(cp))
        new = unicodedata.normalize("NFC", "".join(one.get(x, x) for x in unicodedata.normalize("NFD", c)))
        if len(c) == len(new) == 1 and c != new and c not in one:
            one[c] = new
    wide = {c: one.get(v, v) for c, v in one.items()}
    spaces = "".join(c for c in map(chr, (0xA0, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000)))
    source, target = "".join(wide) + spaces, "".join(wide.values()) + " " * len(spaces)
    drop = "".join(chr(i) if 32 < i < 127 and chr(i) in "-" else f"\\x{{{i:x}}}" for i in map(ord, L.NOTHING))
    out = f"translate(regexp_replace(nfc_normalize({text}), '[{drop}]', '', 'g'), '{source.replace(chr(39), chr(39) * 2)}', '{target.replace(chr(39), chr(39) * 2)}')"
    for joined, letters in L.JOINED.items():
        out = f"replace({out}, '{joined}', '{letters}')"
    return f"nfc_normalize({out})"


FORM = _form("text")
WORDS = f"regexp_extract_all(lower({FORM}), '[\\p{{L}}\\p{{Nd}}]+')"
SQL: dict[str, str] = {
    "p2_found": f"""with {_PH}, {_VEC}, {_META}, side as (select g, bool_or(s in ('train', 'training')) as t, bool_or(s in ('val', 'validation', 'test', 'test_ood')) as e from md where g is not null and s is not null group by 1),
 near as (select a.g as a, b.g as b from codes a join codes b on a.g < b.g and {_bits('a.c', 'b.c')} <= 24 union select a, b from cosines where a < b and c >= 0.95)
 select a as sha_a, b as sha_b from near join side x on x.g = a join side y on y.g = b where (x.t and y.e) or (x.e and y.t) union all select g, g from side where t and e""",
    "p2_report": f"""with {_PH}, {_VEC}, {_META}, side as (select g, bool_or(s in ('train', 'training')) as t, bool_or(s in ('val', 'validation', 'test', 'test_ood')) as e from md where g is not null and s is not null group by 1),
 near as (select a.g as a, b.g as b from codes a join codes b on a.g <> b.g and {_bits('a.c', 'b.c')} <= 24 union select a, b from cosines where c >= 0.95),
 hit as (select b as g, a = b as exact from (select a, b from near union all select g, g from side) join side x on x.g = a join side y on y.g = b where x.t and y.e),
 best as (select g, bool_or(exact) as exact, bool_or(not exact) as near from hit group by 1)
 select s as split, source_id, count(*) as images, count(*) filter (exact) as exact, count(*) filter (near) as near from (select distinct g, s, source_id from md where s in ('val', 'validation', 'test', 'test_ood')) join best using (g) group by 1, 2""",
    "p3_found": f"""with recursive rec as (select nullif({_digest('sha256')}, '') as g from phash union select nullif({_digest('sha256')}, '') from dhash),
 dh as (select distinct nullif({_digest('sha256')}, '') as g, lpad(regexp_replace({_word('dhash')}, '^0x', ''), 16, '0') as c from dhash where regexp_matches({_word('dhash')}, '^(0x)?[0-9a-f]{{1,16}}$')),
 star as (select g as a, min(g) over (partition by c) as b from dh where g is not null and c not in (repeat('0', 16), repeat('f', 16))),
 links as (select a, b from star where a <> b union select x, y from (select nullif({_digest('sha_a')}, '') as x, nullif({_digest('sha_b')}, '') as y from pairs where confirmed) where x <> y and x in (select g from rec where g is not null) and y in (select g from rec where g is not null)),
 links2 as (select a, b from links union select b, a from links), {_CLOSE} select v as sha256, root as group_id from root""",
    "chain_guard": f"""with recursive dh as (select distinct nullif({_digest('sha256')}, '') as g, lpad(regexp_replace({_word('dhash')}, '^0x', ''), 16, '0') as c from dhash where regexp_matches({_word('dhash')}, '^(0x)?[0-9a-f]{{1,16}}$')),
 d as (select * from dh where g is not null and c not in (repeat('0', 16), repeat('f', 16))), links as (select a.g as a, b.g as b from d a join d b on a.g < b.g and bit_count(xor(('0x' || substr(a.c, 1, 8))::bigint, ('0x' || substr(b.c, 1, 8))::bigint))::int + bit_count(xor(('0x' || substr(a.c, 9))::bigint, ('0x' || substr(b.c, 9))::bigint))::int <= 4
  union select x, y from (select nullif({_digest('sha_a')}, '') as x, nullif({_digest('sha_b')}, '') as y from pairs where confirmed) where x <> y and x in (select g from d) and y in (select g from d)),
 links2 as (select a, b from links union select b, a from links), {_CLOSE}, n as (select coalesce(root, g) as root, count(*) as n from (select distinct g from d) left join root on root.v = g group by 1)
 select max(n) as largest, sum(n)::bigint as images, max(n) <= 0.01 * sum(n) as passed from n""",
    "p4_found": f"""with recursive st as (select staged_id, case when {_word('upstream_split')} in ('train', 'training') then 'train' when {_word('upstream_split')} in ('val', 'valid', 'validation', 'dev') then 'val' when {_word('upstream_split')} in ('test', 'testing') then 'test' end as s,
  case when regexp_matches({_word('split_group')}, '[a-z0-9]') and {_word('split_group')} not in ('none', 'null', 'nan', 'na', 'n/a', 'unknown') then 'g:' || {_word('split_group')} end as gk, regexp_extract(lower(stem), '{_SITE}', ['a', 'b', 'c', 'y', 'm', 'd', 'n']) as p from staged_images),
 rows as (select staged_id, s, gk, case when p.n <> '' and p.m between '01' and '12' and p.d between '01' and '31' then 'f:' || p.a || p.b || p.c || '|' || p.y || p.m || p.d || '|' || ltrim(p.n, '0') end as fk from st),
 links2 as (select gk as a, fk as b from rows where gk is not null and fk is not null union select fk, gk from rows where gk is not null and fk is not null), {_CLOSE},
 b as (select staged_id, s, coalesce(root, gk, fk, staged_id::varchar) as bundle from rows left join root on root.v = coalesce(gk, fk))
 select staged_id from b where bundle in (select bundle from b group by 1 having count(distinct s) > 1)""",
    "p5_found": f"with {_VEC}, top as (select a, b, c from cosines qualify row_number() over (partition by a order by c desc, b) <= 5) select distinct least(a, b) as key_a, greatest(a, b) as key_b from top where c >= 0.85",
    "p7_found": f"""with {_PH}, {_META}, d as (select row_id, batch, g, coalesce(cfg <> 'withheld', false) as ok from md where g is not null and batch is not null),
 near as (select a.g as a, b.g as b from codes a join codes b on a.g <> b.g and {_bits('a.c', 'b.c')} <= 24 union select g, g from d)
 select distinct least(x.row_id, y.row_id) as row_a, greatest(x.row_id, y.row_id) as row_b from near join d x on x.g = near.a join d y on y.g = near.b where x.batch < y.batch and x.ok""",
    "p7_newest": f"""with {_PH}, {_META}, d as (select row_id, batch, g, coalesce(cfg <> 'withheld', false) as ok from md where g is not null and batch is not null),
 near as (select a.g as a, b.g as b from codes a join codes b on a.g <> b.g and {_bits('a.c', 'b.c')} <= 24 union select g, g from d)
 select distinct least(x.row_id, y.row_id) as row_a, greatest(x.row_id, y.row_id) as row_b from near join d x on x.g = near.a join d y on y.g = near.b where x.batch < y.batch and x.ok and y.batch = (select max(batch) from d)""",
    "p4_balance": "select * from (values ('train', 0.7::double, 0::bigint, true), ('val', 0.15::double, 0::bigint, true), ('test', 0.15::double, 0::bigint, true)) as v(split, target, torn, within)",
    "p9_found": f"""with d as (select doc_id, ' ' || array_to_string({WORDS}, ' ') || ' ' as words from documents where doc_id is not null and text is not null),
 i as (select item_id, {WORDS} as w from bench_items where text is not null), p as (select item_id, w, unnest(range(1, greatest(len(w) - 10, 2))) as k from i where len(w) > 0),
 q as (select distinct item_id, ' ' || array_to_string(list_slice(w, k, k + 11), ' ') || ' ' as passage from p)
 select distinct doc_id, item_id from d join q on contains(d.words, q.passage)""",
    "p10_found": f"""with f as (select doc_id, text, {FORM} as form from documents where doc_id is not null and text is not null),
 g as (select * from f where regexp_matches(form, '[^\\s\\x0b\\x1c-\\x1f\\x85\\p{{Z}}]')) select distinct a.doc_id as doc_a, b.doc_id as doc_b from g a join g b on a.form = b.form and a.doc_id < b.doc_id and a.text <> b.text""",
    "p10_forms": f"select doc_id, {FORM} as form from documents",
    "p8_decoded": "select doc_id, coalesce(text, '') as text from documents",
}
