"""Evaluation and agreement statistics as aggregations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.sample import running


def confusion(df: DataFrame, truth: str, guess: str) -> DataFrame:
    return df.groupBy(F.col(truth).alias("truth"), F.col(guess).alias("guess")).agg(F.count("*").alias("n"))


def class_scores(df: DataFrame, truth: str, guess: str) -> DataFrame:
    """(label, support, f1, recall, iou) of every class of the truth; a guess outside them only costs recall."""
    c = confusion(df.filter(F.col(truth).isNotNull()), truth, guess)
    t = c.groupBy(F.col("truth").alias("label")).agg(F.sum("n").alias("support"), F.sum(F.when(F.col("truth") == F.col("guess"), F.col("n")).otherwise(0)).alias("tp"))
    g = c.groupBy(F.col("guess").alias("label")).agg(F.sum("n").alias("guessed"))
    j = t.join(g, "label", "left").withColumn("guessed", F.coalesce("guessed", F.lit(0)))
    return j.select("label", "support", (2 * F.col("tp") / (F.col("support") + F.col("guessed"))).alias("f1"), (F.col("tp") / F.col("support")).alias("recall"), (F.col("tp") / (F.col("support") + F.col("guessed") - F.col("tp"))).alias("iou"))


def kappa(df: DataFrame, a: str, b: str, pooled: bool = False) -> DataFrame:
    """(n, observed, expected, kappa): Cohen's, or with ``pooled`` margins Scott's pi; null where chance agreement is 1."""
    c = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count("*").alias("n"))
    total = c.agg(F.sum("n").alias("n"), F.sum(F.when(F.col("a") == F.col("b"), F.col("n")).otherwise(0)).alias("same"))
    pa = c.groupBy(F.col("a").alias("l")).agg(F.sum("n").alias("x"))
    pb = c.groupBy(F.col("b").alias("l")).agg(F.sum("n").alias("y"))
    m = pa.join(pb, "l", "full_outer").select(F.coalesce("x", F.lit(0)).alias("x"), F.coalesce("y", F.lit(0)).alias("y"))
    prod = (F.col("x") + F.col("y")) * (F.col("x") + F.col("y")) / 4.0 if pooled else F.col("x").cast("double") * F.col("y")
    e = m.agg(F.sum(prod).alias("e")).withColumns({k: total.select(k).scalar() for k in ("n", "same")})
    po, pe = F.col("same") / F.col("n"), F.col("e") / (F.col("n").cast("double") * F.col("n"))
    return e.select("n", F.round(po, 6).alias("observed"), F.round(pe, 6).alias("expected"), F.round((po - pe) / F.nullif(1 - pe, F.lit(0.0)), 6).alias("kappa"))


def calibration_error(df: DataFrame, confidence: Column, right: Column, bins: int = 15) -> DataFrame:
    """(ece): mean gap between confidence and accuracy over equal bins, the last one closed."""
    b = F.least(F.floor(confidence * bins), F.lit(bins - 1))
    by = df.select(b.alias("b"), confidence.alias("c"), right.cast("int").alias("r")).groupBy("b").agg(F.count("*").alias("n"), F.avg("c").alias("c"), F.avg("r").alias("r"))
    return by.agg(F.round(F.sum(F.col("n") * F.abs(F.col("c") - F.col("r"))) / F.sum("n"), 6).alias("ece"))


def recall_threshold(df: DataFrame, score: str, positive: str, recall: float) -> DataFrame:
    """(threshold, recall, precision): the highest score at which recall is reached. Ties of score are one step; counts per
    distinct score are summed in order."""
    by = df.groupBy(score).agg(F.count("*").alias("n"), F.sum(F.col(positive).cast("bigint")).alias("k"))
    by = by.withColumn("_down", -F.col(score))
    run = running(by, ["_down"], {"n0": F.col("n"), "k0": F.col("k")})
    run = run.select(score, (F.col("n0") + F.col("n")).alias("n"), (F.col("k0") + F.col("k")).alias("k")).withColumn("all", by.agg(F.sum("k")).scalar())
    ok = run.filter(F.col("k") >= recall * F.col("all"))
    best = ok.agg(F.max(score).alias("threshold"), F.max_by("k", score).alias("k"), F.max_by("n", score).alias("n"), F.max("all").alias("all"))
    return best.select("threshold", F.round(F.col("k") / F.col("all"), 6).alias("recall"), F.round(F.col("k") / F.col("n"), 6).alias("precision"))


def bootstrap(groups: DataFrame, key: str, top: str, bottom: str, replicates: int, seed: str = "b") -> DataFrame:
    """(low, middle, high) percentiles of sum(top)/sum(bottom) when whole groups are drawn with replacement.

    Poisson bootstrap: each replicate counts a group 0, 1, 2, ... times by a draw from its key, so no group index has to be
    known and each row is read once, whatever the number of groups.
    """
    u = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.col("r").cast("string"), F.col(key).cast("string"))), 1, 12), 16, 10).cast("double") / float(1 << 48)
    steps, total, p = [], 0.0, 2.718281828459045**-1
    for k in range(1, 9):
        total += p
        steps.append(F.when(F.col("u") >= total, 1).otherwise(0))
        p /= k
    times = sum(steps[1:], steps[0])
    x = groups.withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1)))).withColumn("u", u).withColumn("m", times)
    by = x.groupBy("r").agg((F.sum(F.col("m") * F.col(top)) / F.nullif(F.sum(F.col("m") * F.col(bottom)), F.lit(0))).alias("v"))
    return by.agg(*(F.round(F.percentile("v", F.lit(q)), 6).alias(n) for n, q in (("low", 0.025), ("middle", 0.5), ("high", 0.975))))


#: Classes whose means are broadcast (a vector each).
MOST_CLASSES = 10_000


def class_probabilities(rows: DataFrame, key: str, label: str, vector: str, sharpness: float = 8.0) -> DataFrame:
    """(key, label, class, p): how likely each class is for each vector: a softmax over its cosines to the means of the classes.

    Rows with null key, label or vector, vectors of another length than the class means, and those that are all zero or hold null
    or NaN are left out. Means are an aggregation over all rows; a vector meets the broadcast means in one narrow pass. Cosines
    are rounded to 9 places, probabilities to 6.
    """
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x)) | ~F.exists(vector, lambda x: x != 0)
    good = rows.select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v"), bad.alias("bad"))
    good = good.filter("key is not null and label is not null and not bad").drop("bad")
    spots = good.select("label", F.posexplode("v").alias("i", "x")).groupBy("label", "i").agg(F.avg("x").alias("m"))
    found = spots.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "m"))).alias("m")).orderBy("label").limit(MOST_CLASSES + 1).collect()
    if len(found) > MOST_CLASSES:
        raise ValueError(f"more than {MOST_CLASSES} classes")
    width = max((len(r["m"]) for r in found), default=0)
    if not width:
        return good.filter("false").select("key", "label", F.col("label").alias("class"), F.lit(0.0).alias("p"))
    means = np.array([[e["m"] for e in r["m"]] for r in found if len(r["m"]) == width]).reshape(-1, width)
    means = means / np.maximum(np.linalg.norm(means, axis=1, keepdims=True), 1e-300)
    shared = rows.sparkSession.sparkContext.broadcast(([r["label"] for r in found if len(r["m"]) == width], means))
    kinds = {f.name: f.dataType.simpleString() for f in good.schema.fields}

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, mean = shared.value
        for b in batches:
            if not len(b):
                continue
            v = b.column("v").flatten().to_numpy().reshape(len(b), -1)
            cos = np.round(v @ mean.T / np.linalg.norm(v, axis=1, keepdims=True), 9)
            e = np.exp(sharpness * cos)
            at = pa.array(np.repeat(np.arange(len(b)), len(names)))
            p = np.round(e / e.sum(1, keepdims=True), 6)
            classes = pa.array(names * len(b), b.column("label").type)
            yield pa.RecordBatch.from_arrays([b.column("key").take(at), b.column("label").take(at), classes, pa.array(p.ravel())], ["key", "label", "class", "p"])

    same = good.filter(F.size("v") == width)
    return same.mapInArrow(score, f"key {kinds['key']}, label {kinds['label']}, class {kinds['label']}, p double")


def guesses(probabilities: DataFrame) -> DataFrame:
    """(key, label, guess, score): the likeliest class of each row (ties to the first) and its probability."""
    best = F.max_by(F.struct("class", "p"), F.struct("p", -F.col("class"))) if dict(probabilities.dtypes)["class"] != "string" else F.min_by(F.struct("class", "p"), F.struct(-F.col("p"), "class"))
    return probabilities.groupBy("key", "label").agg(best.alias("b")).select("key", "label", F.col("b.class").alias("guess"), F.col("b.p").alias("score"))


def confident(probabilities: DataFrame) -> DataFrame:
    """(key, label, likely): the class that each row confidently belongs to: the likeliest of those whose probability reaches the
    mean of the rows given that class; null where none does. A class that no row is given needs probability 1."""
    own = probabilities.filter(F.col("label") == F.col("class")).groupBy("class").agg(F.round(F.avg("p"), 9).alias("cut"))
    met = probabilities.join(own, "class", "left").filter(F.col("p") >= F.coalesce("cut", F.lit(1.0)))
    best = met.groupBy("key").agg(F.min_by("class", F.struct(-F.col("p"), "class")).alias("likely"))
    return probabilities.select("key", "label").distinct().join(best, "key", "left").select("key", "label", "likely")


def confident_joint(assigned: DataFrame) -> DataFrame:
    """(label, likely, n, joint): rows by given and confident class, and these calibrated so that each given class sums to its
    rows (rows without a confident class are spread like the others)."""
    counts = assigned.groupBy("label").agg(F.count("*").alias("given"))
    cells = assigned.filter("likely is not null").groupBy("label", "likely").agg(F.count("*").alias("n"))
    sums = cells.groupBy("label").agg(F.sum("n").alias("total"))
    return cells.join(sums, "label").join(counts, "label").select("label", "likely", "n", F.round(F.col("n") / F.col("total") * F.col("given"), 6).alias("joint"))


def right_answer(guess: Column, references: Column, letter: Column | None = None) -> Column:
    """Whether an answer is right: after normalisation it equals any reference, or it begins with the letter of the right option.
    A null answer is the empty text; no references make it wrong; a null letter asks for none."""
    from tidemill.functions.text import normal_answer

    own = normal_answer(guess)
    by_text = F.coalesce(F.exists(references, lambda r: normal_answer(r) == own), F.lit(False))
    if letter is None:
        return by_text
    return by_text | F.coalesce(F.lower(F.substring(F.trim(guess), 1, 1)) == F.lower(F.trim(letter)), F.lit(False))
