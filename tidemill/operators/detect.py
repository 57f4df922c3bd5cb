"""Average precision of boxes: greedy matching by overlap, then precision over recall."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.sample import running

#: Overlaps at which a box counts as found, and boxes looked at per image and label.
THRESHOLDS, MOST = [round(0.5 + 0.05 * i, 2) for i in range(10)], 100


def overlap(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Intersection over union of every box of a with every one of b; boxes are x, y, w, h."""
    low, high = np.maximum(a[:, None, :2], b[None, :, :2]), np.minimum(a[:, None, :2] + a[:, None, 2:], b[None, :, :2] + b[None, :, 2:])
    both = np.clip(high - low, 0, None).prod(2)
    whole = a[:, None, 2:].prod(2) + b[None, :, 2:].prod(2) - both
    return np.divide(both, whole, out=np.zeros_like(both), where=whole > 0)


def matched(score: np.ndarray, found: np.ndarray, truth: np.ndarray, thresholds: list[float]) -> np.ndarray:
    """(threshold, box): whether each box, by falling score, takes the best of the true boxes that are still free."""
    iou = overlap(found, truth) if len(truth) else np.zeros((len(found), 0))
    out = np.zeros((len(thresholds), len(found)), bool)
    for t, least in enumerate(thresholds):
        free = np.ones(len(truth), bool)
        for i in np.argsort(-score, kind="stable"):
            fit = np.where(free, iou[i], -1)
            if len(fit) and fit.max() >= least:
                best = len(fit) - 1 - int(np.argmax(fit[::-1]))
                free[best], out[t, i] = False, True
    return out


def average_precision(truth: DataFrame, found: DataFrame, thresholds: list[float] | None = None, most: int = MOST) -> DataFrame:
    """(label, threshold, truths, ap): average precision over 101 steps of recall for each label and overlap.

    truth: image, label, x, y, w, h; found: the same with score and a unique id. Within an image and label the ``most`` boxes of
    highest score (ties by id) each take the true box of greatest overlap that no better one took. Labels without true boxes
    have no row, labels of which nothing is found have 0. Null images, labels, sides and scores are no boxes. Precision over
    recall is summed up in score order without one task per label.
    """
    thresholds = thresholds or THRESHOLDS
    sides = ["x", "y", "w", "h"]
    good = lambda df, more: df.select("image", "label", *more, *(F.col(c).cast("double").alias(c) for c in sides)).dropna()
    truth, found = good(truth, []), good(found, ["id", "score"])
    place = F.row_number().over(Window.partitionBy("image", "label").orderBy(F.desc("score"), "id"))
    found = found.withColumn("place", place).filter(F.col("place") <= most)
    box = F.array(*sides)
    t = truth.groupBy("image", "label").agg(F.collect_list(box).alias("truth"))  # of one image
    f = found.groupBy("image", "label").agg(F.array_sort(F.collect_list(F.struct("place", "id", "score", box.alias("box")))).alias("found"))
    j = f.join(t, ["image", "label"], "left").select(F.col("label").cast("string").alias("label"), "found", "truth")

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["label", "threshold", "score", "id", "hit"]
        kinds = [pa.string(), pa.float64(), pa.float64(), pa.string(), pa.int64()]
        for b in batches:
            out = []
            for label, own, true in zip(*(b.column(c).to_pylist() for c in ("label", "found", "truth")), strict=True):
                score = np.array([o["score"] for o in own])
                hits = matched(score, np.array([o["box"] for o in own], float), np.array(true or [], float).reshape(-1, 4), thresholds)
                out += [(label, t, o["score"], str(o["id"]), int(h)) for t, row in zip(thresholds, hits, strict=True) for o, h in zip(own, row, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True) if out else [[]] * 5, kinds, strict=True)], names)

    hits = j.mapInArrow(match, "label string, threshold double, score double, id string, hit bigint").withColumn("down", -F.col("score"))
    ranked = running(hits, ["label", "threshold", "down", "id"], {"hits": F.col("hit"), "all": F.lit(1).cast("bigint")})
    start = ranked.groupBy("label", "threshold").agg(F.min("hits").alias("h0"), F.min("all").alias("a0"))
    support = truth.groupBy(F.col("label").cast("string").alias("label")).agg(F.count("*").alias("truths"))
    x = ranked.join(start, ["label", "threshold"]).join(support, "label")
    x = x.withColumns({"tp": F.col("hits") - F.col("h0") + F.col("hit"), "n": F.col("all") - F.col("a0") + 1})
    step = F.floor(100 * F.col("tp") / F.col("truths") + 1e-9).cast("int")
    best = x.filter("hit = 1").groupBy("label", "threshold", step.alias("step")).agg(F.max(F.col("tp") / F.col("n")).alias("p"))
    # at each step of recall the greatest precision at that recall or above: at most 101 numbers a label and threshold
    by = best.groupBy("label", "threshold").agg(F.map_from_entries(F.collect_list(F.struct("step", "p"))).alias("m"))
    above = lambda s: F.coalesce(F.array_max(F.map_values(F.map_filter("m", lambda k, _: k >= s))), F.lit(0.0))
    ap = F.aggregate(F.transform(F.sequence(F.lit(0), F.lit(100)), above), F.lit(0.0), lambda a, v: a + v) / 101
    grid = support.select("label", "truths", F.explode(F.array(*(F.lit(t) for t in thresholds))).alias("threshold"))
    return grid.join(by.select("label", "threshold", ap.alias("ap")), ["label", "threshold"], "left").select("label", "threshold", "truths", F.coalesce("ap", F.lit(0.0)).alias("ap"))
