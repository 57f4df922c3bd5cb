"""Readers on small files of each format, and sinks read back."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tidemill.sources import annotations as A
from tidemill.sources import sinks as S


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def boxes(df, *more):
    return sorted([tuple(r) for r in df.select("image", "label", "x", "y", "w", "h", *more).collect()], key=str)


def test_coco(spark, tmp_path):
    doc = {"images": [{"id": 1, "file_name": "a.jpg", "width": 10, "height": 8}, {"id": 2, "file_name": "b.jpg"}], "annotations": [{"image_id": 1, "category_id": 7, "bbox": [1, 2, 3, 4]}], "categories": [{"id": 7, "name": "fish"}]}
    p = put(tmp_path / "c.json", json.dumps(doc, indent=1))
    assert boxes(A.load(spark, "coco", p)) == [("a.jpg", "fish", 1, 2, 3, 4), ("b.jpg", None, None, None, None, None)]


def test_yolo(spark, tmp_path):
    put(tmp_path / "y/a.txt", "3 0.5 0.5 0.2 0.4\n3 0.5 0.5 0.2 0.4 0.9\n1 0.1 0.1 0.3 0.1 0.3 0.4 0.1 0.4\n\n")
    got = boxes(A.yolo(spark, str(tmp_path / "y")), "confidence")
    assert [(r[1], *(round(x, 6) for x in r[2:6]), r[6]) for r in got] == [("1", 0.1, 0.1, 0.2, 0.3, None), ("3", 0.4, 0.3, 0.2, 0.4, 0.9), ("3", 0.4, 0.3, 0.2, 0.4, None)]


def test_voc(spark, tmp_path):
    put(tmp_path / "v/a.xml", "<annotation><filename>a.jpg</filename><size><width>9</width><height>8</height></size><object><name>ray</name><bndbox><xmin>1</xmin><ymin>2</ymin><xmax>4</xmax><ymax>6</ymax></bndbox></object></annotation>")
    assert boxes(A.voc(spark, str(tmp_path / "v")), "width") == [("a.jpg", "ray", 1, 2, 3, 4, 9)]


def test_csv_mot_cascade(spark, tmp_path):
    p = put(tmp_path / "t.csv", "file,class,left,top\na.jpg,crab,1,2\nb.jpg,,x,3\n")
    assert boxes(A.table(spark, p, {"image": "file", "label": "class", "x": "left", "y": "top"})) == [("a.jpg", "crab", 1, 2, None, None), ("b.jpg", None, None, 3, None, None)]
    put(tmp_path / "seq/gt/gt.txt", "1,4,10,20,5,6,1\n2,4,11,20,5,6,0\n")
    assert sorted(tuple(r) for r in A.mot(spark, str(tmp_path / "seq/gt")).select("video", "frame", "track", "x", "confidence").collect()) == [("seq", 0, 4, 10, 1), ("seq", 1, 4, 11, 0)]
    p = put(tmp_path / "c.dat", "a.jpg 2 1 2 3 4 5 6 7 8\nb.jpg 0\n")
    assert boxes(A.cascade(spark, p)) == [("a.jpg", None, 1, 2, 3, 4), ("a.jpg", None, 5, 6, 7, 8)]


def test_json_layouts(spark, tmp_path):
    p = put(tmp_path / "l/a.json", json.dumps({"imagePath": "a.jpg", "shapes": [{"label": "sponge", "points": [[1, 1], [4, 2], [2, 6]]}]}, indent=2))
    assert boxes(A.labelme(spark, p)) == [("a.jpg", "sponge", 1, 1, 3, 5)]
    row = {"data_row": {"external_id": "a.jpg"}, "media_attributes": {"width": 9, "height": 9}, "projects": {"p": {"labels": [{"annotations": {"objects": [{"name": "eel", "bounding_box": {"top": 2, "left": 1, "height": 4, "width": 3}}]}}]}}}
    assert boxes(A.ndjson(spark, put(tmp_path / "n.ndjson", json.dumps(row) + "\n"))) == [("a.jpg", "eel", 1, 2, 3, 4)]


def test_files(spark, tmp_path):
    put(tmp_path / "f/coral/1.jpg", "x")
    put(tmp_path / "f/fish/2.jpg", "yy")
    assert sorted((r.image, r.label, r.bytes) for r in A.folders(spark, str(tmp_path / "f")).collect()) == [("1.jpg", "coral", 1), ("2.jpg", "fish", 2)]
    put(tmp_path / "i/a.jpg", "x"), put(tmp_path / "i/b.jpg", "x"), put(tmp_path / "m/a.png", "m")
    assert {r.stem: r.mask_sha256 is not None for r in A.mask_pairs(spark, str(tmp_path / "i"), str(tmp_path / "m")).collect()} == {"a": True, "b": False}
    assert [tuple(r) for r in A.vocabulary(spark, put(tmp_path / "v.tsv", "# source: x\nlabel\tcount\nreef\t3\nsand\t\n")).collect()] == [("reef", 3, None), ("sand", None, None)]
    assert [tuple(r) for r in A.manifest(spark, put(tmp_path / "m.tsv", "image_sha256\tsplit\naa\tprobe\nbb\ttrain\n")).collect()] == [("aa", "val"), ("bb", "train")]


def test_load_refuses(spark, tmp_path):
    with pytest.raises(KeyError):
        A.load(spark, "nothing", "x")
    with pytest.raises(ValueError):
        A.load(spark, "cascade", put(tmp_path / "e.dat", ""))


def test_sinks(spark, tmp_path):
    df = spark.range(100).withColumn("p", F.col("id") % 3)
    S.write_sharded(df, str(tmp_path / "s"), ["p"], ["id"], 10)
    assert spark.read.parquet(str(tmp_path / "s")).count() == 100
    a = S.file_manifest(spark, str(tmp_path / "s"))
    assert S.manifest_changes(a, a).count() == 0
    b = a.filter("file like '%p=1%'").withColumn("sha256", F.lit("0"))
    assert {r.change for r in S.manifest_changes(a, b).collect()} == {"removed", "changed"}
    tars = S.tar_shards(spark.createDataFrame([(1, "a", None), (2, None, "x"), (None, "b", "y")], "k bigint, body string, extra string"), "k", "body", "txt", 2)
    assert {(r.name, bytes(r.content)) for r in S.read_tars(spark, tars).collect()} == {("1.txt", b"a"), ("1.json", b'{"extra": null}'), ("2.txt", b""), ("2.json", b'{"extra": "x"}')}
    assert [r[0] for r in spark.sql("select array(2, 3, 0, 1) r").select(A.run_length(F.col("r"))).collect()] == [[0, 0, 1, 1, 1, 1]]


def test_versions(spark, tmp_path):
    from tidemill.sources import tables as V

    schema = "id bigint, site string, depth float"
    spark.createDataFrame([(1, "a")], "id int, site string").write.parquet(str(tmp_path / "v1"))
    spark.createDataFrame([(2, "b", "3.5", True), (None, None, "x", None)], "id bigint, site string, depth string, extra boolean").write.parquet(str(tmp_path / "v2"))
    got = V.load_versions(spark, [str(tmp_path / "v1"), str(tmp_path / "v2")], schema)
    assert {tuple(r) for r in got.collect()} == {(1, "a", None), (2, "b", 3.5), (None, None, None)} and V.schema_faults(got, schema) == []
    assert V.schema_faults(spark.read.parquet(str(tmp_path / "v2")), "id bigint, depth float, lost int") == ["missing lost", "depth is string, not float", "unknown site", "unknown extra"]
