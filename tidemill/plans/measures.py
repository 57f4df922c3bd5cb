"""Evaluation and agreement statistics on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators import columns as C
from tidemill.operators import measure as M
from tidemill.plans.relations import D64, images
from tidemill.plans.scalars import SPLIT, TOKENS, t


def raters(spark: SparkSession, d: str) -> DataFrame:
    """Two views of one image: the split of its smallest and of its greatest source."""
    m = images(spark, d).select("digest", "source_id", C.split_name(F.col("split")).alias("s")).dropna()
    by = m.groupBy("digest").agg(F.min(F.struct("source_id", "s")).alias("lo"), F.max(F.struct("source_id", "s")).alias("hi"))
    return by.filter("lo.source_id <> hi.source_id").select("digest", F.col("lo.source_id").alias("source"), F.col("lo.s").alias("a"), F.col("hi.s").alias("b"))


def cohen_kappa(spark: SparkSession, d: str) -> DataFrame:
    return M.kappa(raters(spark, d), "a", "b")


def scott_pi(spark: SparkSession, d: str) -> DataFrame:
    return M.kappa(raters(spark, d), "a", "b", pooled=True)


def probabilities(spark: SparkSession, d: str) -> DataFrame:
    return M.class_probabilities(t(spark, d, "embeddings"), "vec_id", "label", "embedding")


def scored(spark: SparkSession, d: str) -> DataFrame:
    """Each vector with the label of its most similar class mean as a guess, and the probability of it."""
    return M.guesses(probabilities(spark, d)).withColumnRenamed("key", "vec_id")


def label_probabilities(spark: SparkSession, d: str) -> DataFrame:
    return probabilities(spark, d).select(F.col("key").alias("vec_id"), F.col("class").alias("label"), "p")


def macro_f1(spark: SparkSession, d: str) -> DataFrame:
    return M.class_scores(scored(spark, d), "label", "guess").agg(F.round(F.avg("f1"), 6).alias("macro_f1"), F.round(F.avg("recall"), 6).alias("macro_recall"), F.round(F.avg("iou"), 6).alias("mean_iou"))


def class_report(spark: SparkSession, d: str) -> DataFrame:
    s = M.class_scores(scored(spark, d), "label", "guess")
    return s.select("label", "support", *(F.round(c, 6).alias(c) for c in ("f1", "recall", "iou")))


def confusion_counts(spark: SparkSession, d: str) -> DataFrame:
    return M.confusion(scored(spark, d), "label", "guess")


def calibration(spark: SparkSession, d: str) -> DataFrame:
    return M.calibration_error(scored(spark, d), F.col("score"), F.col("label") == F.col("guess"))


def bootstrap_accuracy(spark: SparkSession, d: str) -> DataFrame:
    g = scored(spark, d).groupBy(F.pmod("vec_id", F.lit(50)).alias("g")).agg(F.count_if(F.col("label") == F.col("guess")).alias("k"), F.count("*").alias("n"))
    return M.bootstrap(g, "g", "k", "n", 200)


def class_weights(spark: SparkSession, d: str) -> DataFrame:
    """Inverse-frequency weights of classes, mean 1."""
    n = t(spark, d, "embeddings").groupBy("label").agg(F.count("*").alias("n"))
    mean = n.agg(F.avg(1 / F.col("n"))).scalar()
    return n.select("label", "n", F.round(1 / F.col("n") / mean, 6).alias("weight"))


def label_index(spark: SparkSession, d: str) -> DataFrame:
    """Position of each rank in the sorted list of those with enough rows; -100 for the others."""
    from pyspark.sql import Window

    from tidemill.functions.identity import word

    n = t(spark, d, "taxonomy").groupBy(word(F.col("rank")).alias("rank")).agg(F.count("*").alias("n")).filter("rank is not null")
    enough = n.filter("n >= 50").select("rank", (F.row_number().over(Window.orderBy("rank")) - 1).alias("index"))  # a row per class
    return n.join(enough, "rank", "left").select("rank", "n", F.coalesce("index", F.lit(-100)).alias("index"))


def noise_joint(spark: SparkSession, d: str) -> DataFrame:
    """Rows by given and confident label, and the calibrated joint of the two."""
    return M.confident_joint(M.confident(probabilities(spark, d)))


def label_issues(spark: SparkSession, d: str) -> DataFrame:
    """Vectors that confidently belong to another label than theirs."""
    return M.confident(probabilities(spark, d)).filter("likely <> label").select(F.col("key").alias("vec_id"), "label", "likely")


def answer_accuracy(spark: SparkSession, d: str) -> DataFrame:
    """Answers given in documents, held against the answers that other sources give to the same question."""
    from tidemill.functions.text import normal_answer

    part = lambda i: F.regexp_extract("text", r"(?s)Q:\s*(.+?)\s*A:\s*(.+?)\s*$", i)
    q = t(spark, d, "documents").select("doc_id", "source", normal_answer(part(1)).alias("question"), part(2).alias("answer")).filter("answer <> ''")
    given = q.groupBy("question").agg(F.collect_set(F.struct("source", "answer")).alias("given"))  # the distinct answers to one question
    q = q.join(given, "question")
    others = F.transform(F.filter("given", lambda g: ~g["source"].eqNullSafe(F.col("source"))), lambda g: g["answer"])
    return q.groupBy("source").agg(F.count("*").alias("answers"), F.count_if(M.right_answer(F.col("answer"), others)).alias("right"))


def box_precision(spark: SparkSession, d: str) -> DataFrame:
    """Average precision of boxes made from rows of staged images: eight true boxes an image far apart, found shifted."""
    from tidemill.operators.detect import average_precision

    n = F.col("staged_id")
    s = t(spark, d, "staged_images").select(n, F.floor(n / 8).alias("image"), (n % 5).alias("label"), (n % 8 * 100).alias("x"), F.lit(0).alias("y"), (20 + n % 10).alias("w"), F.lit(20).alias("h"))
    found = s.filter(n % 11 > 0).withColumns({"x": F.col("x") + n % 7, "score": n * 37 % 1000 / 1000.0, "id": n})
    return average_precision(s, found).select("label", "threshold", "truths", F.round("ap", 6).alias("ap"))


def qa_accuracy(spark: SparkSession, d: str) -> DataFrame:
    """Answers equal after normalisation: each item's text against the other items of its benchmark."""
    from tidemill.functions.text import normal_answer

    b = t(spark, d, "bench_items").select("bench", normal_answer(F.col("text")).alias("a"))
    n = b.groupBy("bench", "a").agg(F.count("*").alias("n"))
    return n.groupBy("bench").agg(F.sum("n").alias("items"), F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("matched"))


def stratified_rate(spark: SparkSession, d: str) -> DataFrame:
    """A rate extrapolated from strata to the corpus with summed Wilson bounds; empty strata add nothing."""
    m = images(spark, d).groupBy("source_id").agg(F.count_if(F.col("site_id").isNotNull()).alias("k"), F.count_if(F.col("lat").isNotNull()).alias("n"), F.count("*").alias("population"))
    low, high = C.wilson(F.least("k", "n"), F.col("n"))
    m = m.filter("n > 0").withColumns({"low": low, "high": high})
    return m.agg(F.round(F.sum(F.least("k", "n") / F.col("n") * F.col("population")), 3).alias("estimate"), F.round(F.sum(F.col("low") * F.col("population")), 3).alias("low"), F.round(F.sum(F.col("high") * F.col("population")), 3).alias("high"))


QUERIES = {f.__name__: f for f in (cohen_kappa, scott_pi, macro_f1, class_report, confusion_counts, calibration, bootstrap_accuracy, class_weights, label_index, label_probabilities, noise_joint, label_issues, answer_accuracy, box_precision, qa_accuracy, stratified_rate)}
RAT = f"m as (select {D64('image_sha256')} as digest, source_id, {SPLIT('split')} as s from metadata), f as (select * from m where digest is not null and source_id is not null and s is not null), r as (select digest, arg_min(s, source_id || '|' || s) as a, arg_max(s, source_id || '|' || s) as b, min(source_id) as x, max(source_id) as y from f group by 1 having min(source_id) <> max(source_id))"
PRB = """e0 as (select vec_id, label, list_transform(embedding, lambda x: x::double) as v from embeddings where vec_id is not null and label is not null and embedding is not null),
 m0 as (select label as c, i, avg(v[i]) as m from e0, (select unnest(range(1, (select max(len(v)) + 1 from e0))) as i) group by 1, 2), m as (select c, list(m order by i) as m from m0 group by 1),
 cs as (select vec_id, label, c, exp(8 * round(list_cosine_similarity(v, m), 9)) as e from e0, m), pr as (select vec_id, label, c, round(e / sum(e) over (partition by vec_id), 6) as p from cs)"""
SCO = f"{PRB}, s as (select vec_id, label, c as guess, p as score from pr qualify row_number() over (partition by vec_id order by p desc, c) = 1)"
CONF = f"{PRB}, cut as (select c, round(avg(p), 9) as cut from pr where label = c group by 1), li as (select vec_id, c as likely from pr join cut using (c) where p >= cut qualify row_number() over (partition by vec_id order by p desc, c) = 1), cf as (select vec_id, label, likely from e0 left join li using (vec_id))"
CLS = f"{SCO}, tr as (select label, count(*) as support, count(*) filter (label = guess) as tp from s group by 1), gu as (select guess as label, count(*) as guessed from s group by 1), c as (select label, support, 2.0 * tp / (support + coalesce(guessed, 0)) as f1, tp / support as recall, tp / (support + coalesce(guessed, 0) - tp) as iou from tr left join gu using (label))"
KAP = lambda e: f"with {RAT}, n as (select count(*) as n, count(*) filter (a = b) as same from r), pa as (select a as l, count(*) as x from r group by 1), pb as (select b as l, count(*) as y from r group by 1), e as (select sum({e})::double / pow((select n from n), 2) as pe from (select coalesce(x, 0) as x, coalesce(y, 0) as y from pa full join pb using (l))) select n, round(same / n, 6) as observed, round(pe, 6) as expected, round((same / n - pe) / nullif(1 - pe, 0), 6) as kappa from n, e"  # noqa: E731, E501
SQL = {
    "cohen_kappa": KAP("x * y"),
    "scott_pi": KAP("(x + y) * (x + y) / 4.0"),
    "macro_f1": f"with {CLS} select round(avg(f1), 6) as macro_f1, round(avg(recall), 6) as macro_recall, round(avg(iou), 6) as mean_iou from c",
    "class_report": f"with {CLS} select label, support, round(f1, 6) as f1, round(recall, 6) as recall, round(iou, 6) as iou from c",
    "confusion_counts": f"with {SCO} select label as truth, guess, count(*) as n from s group by 1, 2",
    "calibration": f"with {SCO}, b as (select least(floor(score * 15), 14) as b, count(*) as n, avg(score) as c, avg((label = guess)::int) as r from s group by 1) select round(sum(n * abs(c - r)) / sum(n), 6) as ece from b",
    "bootstrap_accuracy": f"""with {SCO}, g as (select vec_id % 50 as g, count(*) filter (label = guess) as k, count(*) as n from s group by 1),
 u as (select g, k, n, r, ('0x' || substr(md5('b:' || r || ':' || g), 1, 12))::bigint / 281474976710656.0 as u from g, (select unnest(range(0, 200)) as r)),
 w as (select *, (u >= 0.36787944117144233)::int + (u >= 0.7357588823428847)::int + (u >= 0.9196986029286058)::int + (u >= 0.9810118431238462)::int + (u >= 0.9963401531726563)::int + (u >= 0.9994058151824183)::int + (u >= 0.9999167588507119)::int + (u >= 0.9999897508033253)::int as m from u),
 v as (select r, sum(m * k) / nullif(sum(m * n), 0) as v from w group by 1) select round(quantile_cont(v, 0.025), 6) as low, round(quantile_cont(v, 0.5), 6) as middle, round(quantile_cont(v, 0.975), 6) as high from v""",
    "class_weights": "with n as (select label, count(*) as n from embeddings group by 1) select label, n, round(1.0 / n / (select avg(1.0 / n) from n), 6) as weight from n",
    "label_index": "with n as (select nullif(lower(trim(rank)), '') as rank, count(*) as n from taxonomy group by 1), e as (select rank, (row_number() over (order by rank) - 1)::int as i from n where rank is not null and n >= 50) select n.rank, n, coalesce(i, -100) as \"index\" from n left join e using (rank) where n.rank is not null",
    "label_probabilities": f"with {PRB} select vec_id, c as label, p from pr",
    "noise_joint": f"with {CONF}, g as (select label, count(*) as given, count(likely) as total from cf group by 1) select label, likely, count(*) as n, round(count(*) / any_value(total) * any_value(given), 6) as joint from cf join g using (label) where likely is not null group by 1, 2",
    "label_issues": f"with {CONF} select vec_id, label, likely from cf where likely <> label",
    "answer_accuracy": f"""with q0 as (select doc_id, source, regexp_extract(text, '(?s)Q:\\s*(.+?)\\s*A:\\s*(.+?)\\s*$', 1) as text, regexp_extract(text, '(?s)Q:\\s*(.+?)\\s*A:\\s*(.+?)\\s*$', 2) as answer from documents),
 q1 as (select doc_id, source, coalesce(array_to_string({TOKENS}, ' '), '') as question, answer as text from q0 where answer <> ''), q as (select doc_id, source, question, coalesce(array_to_string({TOKENS}, ' '), '') as answer from q1)
 select source, count(*) as answers, count(*) filter (exists (select 1 from q o where o.question = q.question and o.source is distinct from q.source and o.answer = q.answer)) as right from q group by 1""",
    "box_precision": """with s as (select staged_id as n, staged_id % 5 as label, 20 + staged_id % 10 as w, staged_id % 7 as dx, (staged_id * 37 % 1000) / 1000.0::double as score from staged_images),
 tr as (select label, count(*) as truths from s group by 1), th as (select round(0.5 + 0.05 * i, 2) as threshold from (select unnest(range(0, 10)) as i)),
 r as (select label, threshold, row_number() over w as k, sum(((w - dx)::double / (w + dx) >= threshold)::int) over w as tp, ((w - dx)::double / (w + dx) >= threshold) as hit from s, th where n % 11 > 0 window w as (partition by label, threshold order by score desc, n::varchar rows unbounded preceding)),
 b as (select label, threshold, floor(100 * tp / truths + 1e-9)::int as step, max(tp::double / k) as p from r join tr using (label) where hit group by 1, 2, 3),
 g as (select label, truths, threshold, i as step from tr, th, (select unnest(range(0, 101)) as i)),
 v as (select g.label, g.threshold, g.truths, g.step, coalesce(max(p), 0) as p from g left join b on b.label = g.label and b.threshold = g.threshold and b.step >= g.step group by 1, 2, 3, 4)
 select label::varchar as label, threshold::double as threshold, truths, round(sum(p) / 101, 6) as ap from v group by 1, 2, 3""",
    "qa_accuracy": f"with b as (select bench, coalesce(array_to_string({TOKENS}, ' '), '') as a from bench_items), n as (select bench, a, count(*) as n from b group by 1, 2) select bench, sum(n)::bigint as items, coalesce(sum(n) filter (n > 1), 0)::bigint as matched from n group by 1",
    "stratified_rate": "with a as (select source_id, count(*) filter (site_id is not null) as k0, count(lat) as n, count(*) as p, 1.959963984540054 as z from metadata group by 1), b as (select *, least(k0, n) as k from a where n > 0), w as (select p, k / n as r, greatest(0, (k/n + z*z/(2*n) - z*sqrt((k/n)*(1-k/n)/n + z*z/(4*n*n))) / (1 + z*z/n)) as low, least(1, (k/n + z*z/(2*n) + z*sqrt((k/n)*(1-k/n)/n + z*z/(4*n*n))) / (1 + z*z/n)) as high from b) select round(sum(r * p), 3) as estimate, round(sum(low * p), 3) as low, round(sum(high * p), 3) as high from w",
}
