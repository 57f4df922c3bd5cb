"""Readers of annotation layouts: staged images are written in a layout with a box each, and read back by its reader.

Boxes are made from numbers of the row, as the test tables hold none; what is tested is that every row comes back as it was.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.plans.scalars import t
from tidemill.session import shared_dir
from tidemill.sources import annotations as A
from tidemill.sources import predictions

#: Rows of one document of a layout that holds many images.
DOCUMENT = 500
COLUMNS = ["image", "label", "x", "y", "w", "h"]


def boxes(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("staged_id")
    side = lambda m, low: (n % m + low).cast("int")
    s = t(spark, d, "staged_images").select(n, F.concat(F.lit("i"), n).alias("image"), F.concat(F.lit("c"), n % 5).alias("label"), (n % 5).cast("int").alias("k"), side(50, 0).alias("x"), side(40, 0).alias("y"), side(30, 1).alias("w"), side(20, 1).alias("h"))
    return s.withColumns({"width": F.lit(120), "height": F.lit(80)})


def folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/layout-{uuid.uuid4().hex}"


def lines(rows: DataFrame, text: Column, path: str) -> str:
    rows.select(text.alias("value")).write.text(path)
    return path


def documents(rows: DataFrame, path: str, *parts: Column) -> str:
    """One file per DOCUMENT rows, holding what the parts make of them."""
    by = rows.groupBy(F.floor(F.col("staged_id") / DOCUMENT)).agg(F.concat(*parts).alias("value"))
    by.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return path


def layout_coco(spark: SparkSession, d: str) -> DataFrame:
    names = ", ".join(f'{{"id": {i}, "name": "c{i}"}}' for i in range(5))
    images = F.to_json(F.collect_list(F.struct(F.col("staged_id").alias("id"), F.col("image").alias("file_name"), "width", "height")))
    marks = F.to_json(F.collect_list(F.struct(F.col("staged_id").alias("image_id"), F.col("k").alias("category_id"), F.array("x", "y", "w", "h").alias("bbox"))))
    path = documents(boxes(spark, d), folder(spark), F.lit('{"images": '), images, F.lit(', "annotations": '), marks, F.lit(f', "categories": [{names}]}}'))
    return A.load(spark, "coco", path).select(*COLUMNS)


def layout_voc(spark: SparkSession, d: str) -> DataFrame:
    body = F.format_string(
        "<annotation><filename>%s</filename><size><width>120</width><height>80</height></size><object><name>%s</name><bndbox><xmin>%d</xmin><ymin>%d</ymin><xmax>%d</xmax><ymax>%d</ymax></bndbox></object></annotation>",
        "image", "label", "x", "y", F.col("x") + F.col("w"), F.col("y") + F.col("h"),
    )
    path = documents(boxes(spark, d), folder(spark), F.lit("<annotations>"), F.array_join(F.collect_list(body), ""), F.lit("</annotations>"))
    return A.load(spark, "voc", path).select(*COLUMNS)


def layout_csv(spark: SparkSession, d: str) -> DataFrame:
    path = folder(spark)
    boxes(spark, d).select("image", F.col("label").alias("class"), "x", "y", "w", "h").write.option("header", True).csv(path)
    return A.load(spark, "csv", path, columns={c: {"label": "class"}.get(c, c) for c in COLUMNS}).select(*COLUMNS)


def layout_labelme(spark: SparkSession, d: str) -> DataFrame:
    right, low = F.col("x") + F.col("w"), F.col("y") + F.col("h")
    points = F.array(F.array("x", "y"), F.array(right, F.col("y")), F.array(right, low))
    one = F.struct(F.col("image").alias("imagePath"), F.array(F.struct("label", points.alias("points"))).alias("shapes"))
    return A.load(spark, "labelme", documents(boxes(spark, d), folder(spark), F.to_json(F.collect_list(one)))).select(*COLUMNS)


def layout_cascade(spark: SparkSession, d: str) -> DataFrame:
    body = F.concat_ws(" ", "image", F.lit("1"), "x", "y", "w", "h")
    return A.load(spark, "cascade", lines(boxes(spark, d), body, folder(spark))).select("image", "x", "y", "w", "h")


def layout_ndjson(spark: SparkSession, d: str) -> DataFrame:
    box = F.struct(F.col("y").alias("top"), F.col("x").alias("left"), F.col("h").alias("height"), F.col("w").alias("width"))
    labels = F.array(F.struct(F.struct(F.array(F.struct(F.col("label").alias("name"), box.alias("bounding_box"))).alias("objects")).alias("annotations")))
    one = F.struct(F.struct(F.col("image").alias("external_id")).alias("data_row"), F.create_map(F.lit("p"), F.struct(labels.alias("labels"))).alias("projects"))
    return A.load(spark, "ndjson", lines(boxes(spark, d), F.to_json(one), folder(spark))).select(*COLUMNS)


def layout_bounding_boxes(spark: SparkSession, d: str) -> DataFrame:
    box = F.struct(F.col("label").alias("concept"), "x", "y", F.col("w").alias("width"), F.col("h").alias("height"), (F.col("k") == 0).alias("groupOf"))
    one = F.struct(F.col("image").alias("uuid"), "width", "height", F.array(box).alias("boundingBoxes"))
    return A.load(spark, "bounding boxes json", lines(boxes(spark, d), F.to_json(one), folder(spark))).select(*COLUMNS, "crowd")


def layout_placed_objects(spark: SparkSession, d: str) -> DataFrame:
    obj = F.struct(F.col("label").alias("class"), F.array(F.col("x"), F.col("y"), F.col("x") + F.col("w"), F.col("y") + F.col("h")).alias("box"))
    none = F.filter(F.array(obj), lambda _: F.lit(False))
    one = F.struct("image", F.when(F.col("k") > 0, F.array(obj)).otherwise(none).alias("placed"), F.when(F.col("k") == 0, F.array(obj)).otherwise(none).alias("fauna"))
    return A.load(spark, "placed objects json", lines(boxes(spark, d), F.to_json(one), folder(spark))).select(*COLUMNS, "layer")


def layout_run_lengths(spark: SparkSession, d: str) -> DataFrame:
    """Two masks an image, column by column: a run of w pixels after x, and one of h after y; the union's pixels come back."""
    mask = lambda at, n: F.struct(F.struct(F.array(F.lit(80), F.lit(120)).alias("size"), F.to_json(F.array(F.col(at), F.col(n), 9600 - F.col(at) - F.col(n))).alias("counts")).alias("segmentation"))
    one = F.struct(F.struct(F.col("image").alias("file_name"), "width", "height").alias("image"), F.array(mask("x", "w"), mask("y", "h")).alias("annotations"))
    return A.load(spark, "run-length masks", lines(boxes(spark, d), F.to_json(one), folder(spark))).select("image", "masks", "pixels")


def layout_instances(spark: SparkSession, d: str) -> DataFrame:
    """Masks of 12 x 8 pixels with instance 1 in the top left corner, and one whose class is not listed."""
    at = F.sequence(F.lit(0), F.lit(95))
    own = F.transform(at, lambda i: F.when((i % 12 < F.col("k") + 1) & (i < 24), 1).when(i == 95, 2).otherwise(0))
    one = F.struct("image", F.lit(12).alias("width"), own.alias("pixels"), F.array(F.struct(F.lit(1).alias("id"), F.col("label").alias("class"))).alias("instances"))
    return A.load(spark, "instance masks", lines(boxes(spark, d), F.to_json(one), folder(spark))).select("image", "id", "label", "x", "y", "w", "h", "pixels")


def layout_label_manifest(spark: SparkSession, d: str) -> DataFrame:
    one = F.struct(F.col("image").alias("file_name"), "label")
    return A.load(spark, "label manifest", documents(boxes(spark, d), folder(spark), F.to_json(F.collect_list(one)))).select("image", "label")


def layout_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    n = t(spark, d, "taxonomy").filter("rank is not null and trim(rank) <> ''").groupBy(F.lower(F.trim("rank")).alias("label")).count()
    path = folder(spark)
    rows = F.array_join(F.array_sort(F.collect_list(F.concat_ws("\t", "label", "count", F.lit("ranks")))), "\n")  # one row per rank
    n.agg(F.concat(F.lit("# version: 1\nlabel\tcount\tdescription\n"), rows).alias("value")).write.text(path)
    return A.load(spark, "vocabulary", path)


def layout_task_manifest(spark: SparkSession, d: str) -> DataFrame:
    path = folder(spark)
    t(spark, d, "metadata").select("image_sha256", "split").filter("image_sha256 is not null and split in ('train', 'val', 'test', 'probe')").distinct().write.option("sep", "\t").option("header", True).csv(path)
    return A.load(spark, "manifest", path).groupBy("split").agg(F.count("*").alias("n"))


def predictions_read(spark: SparkSession, d: str) -> DataFrame:
    """Probabilities written as predictions: the reader takes the first greatest as label."""
    path = folder(spark)
    n = F.col("vec_id")
    t(spark, d, "embeddings").select(n.cast("string").alias("image_sha256"), F.array(*((n * k % 7 / 7.0).alias(f"p{k}") for k in (3, 5, 1))).alias("pred_probs")).write.parquet(path)
    return predictions.read_predictions(spark, path, "classes").select("image_sha256", "pred_label")


FUNCTIONS = (layout_coco, layout_voc, layout_csv, layout_labelme, layout_cascade, layout_ndjson, layout_bounding_boxes, layout_placed_objects, layout_run_lengths, layout_instances, layout_label_manifest, layout_vocabulary, layout_task_manifest, predictions_read)
QUERIES = {f.__name__: f for f in FUNCTIONS}
N = "staged_id"
XYWH = f"({N} % 50)::double as x, ({N} % 40)::double as y, ({N} % 30 + 1)::double as w, ({N} % 20 + 1)::double as h"
BOX = f"select 'i' || {N} as image, 'c' || ({N} % 5) as label, {XYWH}"
SQL = dict.fromkeys(("layout_coco", "layout_voc", "layout_csv", "layout_labelme", "layout_ndjson"), f"{BOX} from staged_images") | {
    "layout_cascade": f"select 'i' || {N} as image, {XYWH} from staged_images",
    "layout_bounding_boxes": f"{BOX}, {N} % 5 = 0 as crowd from staged_images",
    "layout_placed_objects": f"{BOX}, case when {N} % 5 = 0 then 'fauna' else 'placed' end as layer from staged_images",
    "layout_run_lengths": f"with b as (select {N}, {N} % 50 as x, {N} % 40 as y, {N} % 30 + 1 as w, {N} % 20 + 1 as h from staged_images) select 'i' || {N} as image, 2 as masks, w + h - greatest(0, least(x + w, y + h) - greatest(x, y)) as pixels from b",
    "layout_instances": f"select 'i' || {N} as image, 1 as id, 'c' || ({N} % 5) as label, 0.0::double as x, 0.0::double as y, ({N} % 5 + 1)::double as w, 2.0::double as h, 2 * ({N} % 5 + 1) as pixels from staged_images union all select 'i' || {N}, 2, null, 11.0, 7.0, 1.0, 1.0, 1 from staged_images",
    "layout_label_manifest": f"select 'i' || {N} as image, 'c' || ({N} % 5) as label from staged_images",
    "layout_vocabulary": "select lower(trim(rank)) as label, count(*) as count, 'ranks' as description from taxonomy where rank is not null and trim(rank) <> '' group by 1",
    "layout_task_manifest": "select case when split = 'probe' then 'val' else split end as split, count(*) as n from (select distinct image_sha256, split from metadata where image_sha256 is not null and split in ('train', 'val', 'test', 'probe')) group by 1",
    "predictions_read": "with p as (select vec_id, vec_id * 3 % 7 as a, vec_id * 5 % 7 as b, vec_id % 7 as c from embeddings) select vec_id::varchar as image_sha256, case when a >= b and a >= c then 0 when b >= c then 1 else 2 end as pred_label from p",
}
