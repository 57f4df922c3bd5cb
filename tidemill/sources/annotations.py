"""Readers of annotation formats, each from path (or glob) to a DataFrame with an explicit schema.

Boxes come out as (image, label, x, y, w, h, confidence) in pixels, or in units of the side where the format has no pixels
(the docstring says so). Files are read in parallel; nothing is inferred from data, and a file's own errors give null rows
rather than a failed job.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

READERS: dict[str, Callable[..., DataFrame]] = {}


def reader(name: str):
    """Registers a reader under a layout name."""

    def keep(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        READERS[name] = f
        return f

    return keep


def load(spark: SparkSession, layout: str, path: str, **options) -> DataFrame:
    """Reads a layout by name; an unknown name and an empty result are errors."""
    if layout not in READERS:
        raise KeyError(f"unknown layout {layout}; known: {', '.join(sorted(READERS))}")
    df = READERS[layout](spark, path, **options)
    if layout != "metadata only" and df.isEmpty():
        raise ValueError(f"{layout} at {path} has no rows")
    return df


def stem(c: Column) -> Column:
    """File name without folders and the last extension."""
    return F.regexp_replace(F.regexp_replace(c, "^.*/", ""), r"\.[^.]*$", "")


def _box(label: Column, x: Column, y: Column, w: Column, h: Column, confidence: Column | None = None) -> list[Column]:
    cast = [c.cast("double").alias(n) for n, c in (("x", x), ("y", y), ("w", w), ("h", h))]
    conf = (confidence if confidence is not None else F.lit(None)).cast("double").alias("confidence")
    return [label.cast("string").alias("label"), *cast, conf]


@reader("coco")
def coco(spark: SparkSession, path: str) -> DataFrame:
    """A COCO document; images without annotations keep one row with null label."""
    schema = "images array<struct<id bigint, file_name string, width int, height int>>, annotations array<struct<image_id bigint, category_id bigint, bbox array<double>, score double>>, categories array<struct<id bigint, name string>>"
    doc = spark.read.schema(schema).option("multiLine", True).json(path).withColumn("doc", F.col("_metadata.file_path"))
    images = doc.select("doc", F.explode("images").alias("i")).select("doc", "i.*")
    marks = doc.select("doc", F.explode("annotations").alias("a")).select("doc", F.col("a.image_id").alias("id"), "a.category_id", "a.bbox", "a.score")
    names = doc.select("doc", F.explode("categories").alias("c")).select("doc", F.col("c.id").alias("category_id"), F.col("c.name").alias("name"))
    j = images.join(marks, ["doc", "id"], "left").join(names, ["doc", "category_id"], "left")
    b = [F.get("bbox", F.lit(i)) for i in range(4)]
    return j.select(F.col("file_name").alias("image"), *_box(F.col("name"), *b, F.col("score")), "width", "height")


@reader("yolo")
def yolo(spark: SparkSession, path: str) -> DataFrame:
    """One text file per image: class, centre and size in units of the side, optionally a confidence; a longer line is a
    polygon and gives its bounding box."""
    t = spark.read.text(path).select(stem(F.col("_metadata.file_path")).alias("image"), F.split(F.trim("value"), r"\s+").alias("v")).filter("size(v) >= 5")
    n = F.transform(F.slice("v", F.lit(2), F.size("v") - 1), lambda s: s.try_cast("double"))
    t = t.select("image", F.get("v", F.lit(0)).alias("label"), n.alias("n"))
    at = lambda k: F.filter("n", lambda _, i: i % 2 == k)
    lo = [F.array_min(at(k)) for k in (0, 1)]
    hi = [F.array_max(at(k)) for k in (0, 1)]
    c = [F.get("n", F.lit(i)) for i in range(5)]
    plain = F.size("n") <= 5
    return t.select("image", *_box(
        F.col("label"),
        F.when(plain, c[0] - c[2] / 2).otherwise(lo[0]), F.when(plain, c[1] - c[3] / 2).otherwise(lo[1]),
        F.when(plain, c[2]).otherwise(hi[0] - lo[0]), F.when(plain, c[3]).otherwise(hi[1] - lo[1]),
        F.when(F.size("n") == 5, c[4]),
    ))


@reader("voc")
def voc(spark: SparkSession, path: str) -> DataFrame:
    """Pascal VOC: one annotation element per image."""
    box = "struct<xmin double, ymin double, xmax double, ymax double>"
    schema = f"filename string, size struct<width int, height int>, object array<struct<name string, bndbox {box}>>"
    t = spark.read.format("xml").option("rowTag", "annotation").schema(schema).load(path).select("filename", "size", F.explode_outer("object").alias("o"))
    b = F.col("o.bndbox")
    return t.select(F.col("filename").alias("image"), *_box(F.col("o.name"), b["xmin"], b["ymin"], b["xmax"] - b["xmin"], b["ymax"] - b["ymin"]), F.col("size.width").alias("width"), F.col("size.height").alias("height"))


@reader("csv")
def table(spark: SparkSession, path: str, columns: dict[str, str], header: bool = True, sep: str = ",") -> DataFrame:
    """A delimited file with named columns: ``columns`` maps ours (image, label, x, y, w, h, confidence) to the file's
    (or, without header, to _c0, _c1, ...). Missing ones are null."""
    t = spark.read.option("header", header).option("sep", sep).csv(path)
    pick = lambda n: F.col(columns[n]) if n in columns else F.lit(None)
    num = [pick(n).try_cast("double") for n in ("x", "y", "w", "h", "confidence")]
    return t.select(pick("image").cast("string").alias("image"), *_box(pick("label"), *num))


@reader("mot")
def mot(spark: SparkSession, path: str) -> DataFrame:
    """Tracks: frame (from 1, here from 0), track, box, confidence; the video is the file's folder."""
    t = spark.read.text(path).select(F.regexp_extract("_metadata.file_path", r"([^/]+)/[^/]+(?:/[^/]+)?$", 1).alias("video"), F.split("value", ",").alias("v")).filter("size(v) >= 6")
    c = [F.get("v", F.lit(i)).try_cast("double") for i in range(7)]
    return t.select("video", (c[0].cast("int") - 1).alias("frame"), c[1].cast("int").alias("track"), *_box(F.lit(None), *c[2:6], c[6]))


@reader("labelme")
def labelme(spark: SparkSession, path: str) -> DataFrame:
    """One JSON per image with polygons, as their bounding boxes."""
    schema = "imagePath string, imageWidth int, imageHeight int, shapes array<struct<label string, points array<array<double>>>>"
    t = spark.read.schema(schema).option("multiLine", True).json(path).select("imagePath", F.explode_outer("shapes").alias("s"))
    x, y = (F.transform("s.points", lambda p: F.get(p, F.lit(k))) for k in (0, 1))
    return t.select(F.col("imagePath").alias("image"), *_box(F.col("s.label"), F.array_min(x), F.array_min(y), F.array_max(x) - F.array_min(x), F.array_max(y) - F.array_min(y)))


@reader("cascade")
def cascade(spark: SparkSession, path: str) -> DataFrame:
    """Lines of ``path n x y w h ...``."""
    t = spark.read.text(path).select(F.split(F.trim("value"), r"\s+").alias("v")).filter("size(v) >= 2")
    n = F.greatest(F.lit(0), F.least(F.get("v", F.lit(1)).try_cast("int"), F.floor((F.size("v") - 2) / 4).cast("int")))
    at = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    t = t.select(F.get("v", F.lit(0)).alias("image"), "v", F.explode(at).alias("i"))
    return t.select("image", *_box(F.lit(None), *(F.get("v", 2 + F.col("i") * 4 + k).try_cast("double") for k in range(4))))


@reader("ndjson")
def ndjson(spark: SparkSession, path: str) -> DataFrame:
    """Export rows with projects, labels and objects nested; one row per object with its box."""
    obj = "struct<name string, bounding_box struct<top double, left double, height double, width double>>"
    label = f"struct<annotations struct<objects array<{obj}>>>"
    schema = f"data_row struct<external_id string>, media_attributes struct<width int, height int>, projects map<string, struct<labels array<{label}>>>"
    t = spark.read.schema(schema).json(path)
    t = t.select("data_row", "media_attributes", F.explode(F.map_values("projects")).alias("p")).select("data_row", "media_attributes", F.explode("p.labels").alias("l"))
    t = t.select("data_row", "media_attributes", F.explode("l.annotations.objects").alias("o"))
    b = F.col("o.bounding_box")
    return t.select(F.col("data_row.external_id").alias("image"), *_box(F.col("o.name"), b["left"], b["top"], b["width"], b["height"]), F.col("media_attributes.width").alias("width"), F.col("media_attributes.height").alias("height"))


@reader("folders")
def folders(spark: SparkSession, path: str) -> DataFrame:
    """Files whose folder is their class: (image, label, bytes, sha256)."""
    t = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return t.select(F.regexp_replace("path", "^.*/", "").alias("image"), F.regexp_extract("path", "([^/]+)/[^/]+$", 1).alias("label"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


@reader("mask pairs")
def mask_pairs(spark: SparkSession, path: str, masks: str) -> DataFrame:
    """Images and masks of equal stem in two folders; what has no partner is kept with null."""
    files = lambda p: spark.read.format("binaryFile").load(p).select(stem(F.col("path")).alias("stem"), F.sha2("content", 256).alias("sha256"))
    a, b = files(path).withColumnRenamed("sha256", "image_sha256"), files(masks).withColumnRenamed("sha256", "mask_sha256")
    return a.join(b, "stem", "full_outer")


@reader("vocabulary")
def vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated label, count, description under ``# key: value`` comments; a missing count is null."""
    t = spark.read.option("comment", "#").option("sep", "\t").option("header", True).csv(path)
    there = lambda n: F.col(n) if n in t.columns else F.lit(None)
    return t.select(there("label").alias("label"), there("count").try_cast("bigint").alias("count"), there("description").cast("string").alias("description"))


@reader("manifest")
def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated (image_sha256, split) of all files of a glob; probe counts as val."""
    t = spark.read.option("sep", "\t").option("header", True).schema("image_sha256 string, split string").csv(path)
    return t.select("image_sha256", F.when(F.col("split") == "probe", "val").otherwise(F.col("split")).alias("split"))


def run_length(counts: Column) -> Column:
    """A mask from run lengths that alternate from 0: array<int> of pixels."""
    return F.flatten(F.transform(counts, lambda n, i: F.array_repeat(i.bitwiseAND(F.lit(1)), n)))


@reader("bounding boxes json")
def bounding_boxes(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object per image (a line, or with one per file the whole file) with ``boundingBoxes``: one row per box, with the
    image's uuid, digest and licence, and the box's crowd flag and licence. Images without boxes keep one row with null label."""
    box = "struct<concept string, x double, y double, width double, height double, groupOf boolean, occluded boolean, truncated boolean, reviewState string, altConcept string, annotationLicense string>"
    schema = f"uuid string, sha256 string, width int, height int, imageLicense string, boundingBoxes array<{box}>"
    t = spark.read.schema(schema).json(path).select("*", F.explode_outer("boundingBoxes").alias("b"))
    b = F.col("b")
    more = [F.coalesce(b["groupOf"], F.lit(False)).alias("crowd"), b["occluded"].alias("occluded"), b["truncated"].alias("truncated"), b["reviewState"].alias("review"), b["altConcept"].alias("also"), b["annotationLicense"].alias("box_licence")]
    return t.select(F.lower("uuid").alias("image"), *_box(b["concept"], b["x"], b["y"], b["width"], b["height"]), "width", "height", "sha256", F.col("imageLicense").alias("licence"), *more)


@reader("placed objects json")
def placed_objects(spark: SparkSession, path: str, unnamed: str = "fauna") -> DataFrame:
    """One JSON object per composed image, whose lists ``placed`` and ``fauna`` hold objects with a box of two corners: one row
    per box with its list as ``layer``. A box that is not four numbers comes out with null sides; a missing class is ``unnamed``."""
    obj = "array<struct<class string, box array<double>>>"
    t = spark.read.schema(f"image string, placed {obj}, fauna {obj}").json(path).withColumn("file", stem(F.col("_metadata.file_path")))
    layer = lambda name: F.transform(F.coalesce(F.col(name), F.array().cast(obj)), lambda o: F.struct(F.lit(name).alias("layer"), o.alias("o")))
    layers = F.concat(layer("placed"), layer("fauna"))
    t = t.select(F.coalesce("image", "file").alias("image"), F.explode(layers).alias("e"))
    c = F.when(F.size("e.o.box") == 4, F.col("e.o.box"))
    return t.select("image", *_box(F.coalesce("e.o.class", F.lit(unnamed)), c[0], c[1], c[2] - c[0], c[3] - c[1]), F.col("e.layer").alias("layer"))


def _lengths(counts: str | None) -> list[int]:
    """Run lengths of a COCO mask: a JSON list of numbers, or the compressed text, whose characters carry five bits each (and a
    sixth for "more"), as differences from the length two before."""
    if not counts:
        return []
    if counts.lstrip().startswith("["):
        return [int(x) for x in json.loads(counts)]
    out: list[int] = []
    value = shift = 0
    for c in counts:
        bits = ord(c) - 48
        value |= (bits & 31) << shift
        shift += 5
        if not bits & 32:
            if bits & 16:
                value -= 1 << shift
            out.append(value + (out[-2] if len(out) > 2 else 0))
            value = shift = 0
    return out


def union_lengths(masks: list[list[int]], size: int) -> list[int]:
    """Run lengths (from 0) of the union of masks given by theirs, each of ``size`` pixels; a shorter mask ends in 0."""
    steps: dict[int, int] = {}
    for runs in masks:
        at = 0
        for i, n in enumerate(runs):
            if i % 2 and n > 0:
                steps[at] = steps.get(at, 0) + 1
                steps[at + n] = steps.get(at + n, 0) - 1
            at += n
    out, at, depth = [], 0, 0
    for spot in sorted(steps):
        deeper = depth + steps[spot]
        if (depth > 0) != (deeper > 0):
            out.append(spot - at)
            at = spot
        depth = deeper
    return [*out, size - at] if out else [size]


@reader("run-length masks")
def run_length_masks(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object per image with masks as COCO run lengths (a list or the compressed text): (image, width, height, masks,
    runs, pixels), runs and pixels of the union of all masks, column by column. A mask of another size than the image, and
    lengths that don't add up to it, make runs and pixels null; an image without masks is empty."""
    mark = "struct<segmentation struct<size array<int>, counts string>>"
    t = spark.read.schema(f"image struct<file_name string, width int, height int>, annotations array<{mark}>").json(path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for image, marks in zip(b.column("image").to_pylist(), b.column("annotations").to_pylist(), strict=True):
                image, marks = image or {}, marks or []
                w, h = image.get("width"), image.get("height")
                runs = None
                if w is not None and h is not None:
                    segments = [(m or {}).get("segmentation") or {} for m in marks]
                    lengths = [_lengths(s.get("counts")) for s in segments]
                    fits = all(s.get("size") in (None, [h, w]) and sum(n) == h * w and min(n, default=0) >= 0 for s, n in zip(segments, lengths, strict=True))
                    runs = union_lengths(lengths, h * w) if fits else None
                out.append((image.get("file_name"), w, h, len(marks), runs, None if runs is None else sum(runs[1::2])))
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.int64()]
            columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)] if out else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays(columns, ["image", "width", "height", "masks", "runs", "pixels"])

    return t.mapInArrow(decode, "image string, width int, height int, masks int, runs array<bigint>, pixels bigint")


@reader("instance masks")
def instance_masks(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object per image with its instance ids pixel by pixel (0 is none) and the class of each id: one row per instance
    that has pixels, with its box, pixels and class (null where the list has none)."""
    t = spark.read.schema("image string, width int, pixels array<int>, instances array<struct<id int, class string>>").json(path)
    spots = t.select("image", "width", F.posexplode("pixels").alias("at", "id")).filter("id > 0")
    x, y = F.pmod("at", "width"), F.floor(F.col("at") / F.col("width"))
    area = spots.groupBy("image", "id").agg(F.count("*").alias("pixels"), F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1"))
    names = t.select("image", F.explode("instances").alias("i")).select("image", F.col("i.id").alias("id"), F.col("i.class").alias("name"))
    names = names.groupBy("image", "id").agg(F.min("name").alias("name"))
    j = area.join(names, ["image", "id"], "left")
    return j.select("image", "id", *_box(F.col("name"), F.col("x0"), F.col("y0"), F.col("x1") - F.col("x0") + 1, F.col("y1") - F.col("y0") + 1), "pixels")


@reader("label manifest")
def label_manifest(spark: SparkSession, path: str, name: str = "file_name", label: str = "label", files: str | None = None) -> DataFrame:
    """A JSON list of objects that give each file's label: (image, label). With ``files``, a folder, also whether the file is
    there; a record without a name keeps null and is nowhere."""
    t = spark.read.schema(f"`{name}` string, `{label}` string").option("multiLine", True).json(path)
    t = t.select(F.col(name).alias("image"), F.col(label).alias("label"))
    if files is None:
        return t
    there = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(files).select(F.regexp_replace("path", "^.*/", "").alias("image")).distinct()
    return t.join(there.withColumn("there", F.lit(True)), "image", "left").withColumn("there", F.coalesce("there", F.lit(False)))


# What an audio file's name may end in.
AUDIO = ["wav", "mp3", "flac", "ogg", "aif", "aiff", "m4a"]


@reader("audio folders")
def audio_folders(spark: SparkSession, path: str) -> DataFrame:
    """Audio files under one folder per class, at any depth: (image, label, bytes, sha256), the class being the first folder below
    ``path``; other files are left out."""
    t = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    below = F.substring_index("path", path.rstrip("/") + "/", -1)
    t = t.select(below.alias("below"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    t = t.filter(F.lower(F.substring_index("below", ".", -1)).isin(AUDIO) & F.col("below").contains("/"))
    return t.select(F.regexp_replace("below", "^.*/", "").alias("image"), F.substring_index("below", "/", 1).alias("label"), "bytes", "sha256")


@reader("metadata only")
def metadata_only(spark: SparkSession, path: str) -> DataFrame:
    """A source that is only referred to: it has the columns of the others and no rows."""
    return spark.createDataFrame([], "image string, label string, x double, y double, w double, h double, confidence double")
