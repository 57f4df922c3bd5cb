"""Readers of predictions, one per task, each with an explicit shape and its required columns checked."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns that a task's files must have, and those that may be missing (null then).
SHAPES = {
    "classes": (["image_sha256"], {"pred_label": "int", "pred_probs": "array<double>"}),
    "points": (["image_sha256", "point_id"], {"pred_label": "int", "pred_probs": "array<double>"}),
    "masks": (["image_sha256", "pred_mask_png"], {}),
    "answers": (["image_sha256", "pred_answer"], {}),
}


def read_predictions(spark: SparkSession, path: str, task: str) -> DataFrame:
    """Predictions of a task: parquet for classes, points, masks and answers, a JSON list for boxes.

    classes and points need a label or probabilities; where a row has only probabilities the label is the first greatest. An
    unknown task and missing columns are errors, an empty file gives no rows.
    """
    if task == "boxes":
        schema = "image_id bigint, category_id bigint, bbox array<double>, score double"
        t = spark.read.schema(schema).option("multiLine", True).json(path)
        if not t.filter("image_id is null or category_id is null or score is null").isEmpty():
            raise ValueError(f"{path}: boxes need image_id, category_id and score")
        return t
    if task not in SHAPES:
        raise ValueError(f"unknown task {task}; known: boxes, {', '.join(SHAPES)}")
    needed, extra = SHAPES[task]
    t = spark.read.parquet(path)
    missing = [c for c in needed if c not in t.columns]
    if missing or (extra and not set(extra) & set(t.columns)):
        raise ValueError(f"{path}: {task} need {', '.join(missing or extra)}")
    out = t.select(*needed, *((F.col(c).cast(k) if c in t.columns else F.lit(None).cast(k)).alias(c) for c, k in extra.items()))
    if extra:
        best = F.array_position("pred_probs", F.array_max("pred_probs")).cast("int") - 1
        out = out.withColumn("pred_label", F.coalesce("pred_label", F.when(F.size("pred_probs") > 0, best)))
    return out
