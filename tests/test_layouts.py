"""Readers of masks, labels and predictions on small files."""

from __future__ import annotations

import json
import random

import pytest

from tidemill.sources import annotations as A
from tidemill.sources.predictions import read_predictions


def compressed(runs):
    """The text form of run lengths, written the other way round: differences, five bits a character."""
    out = ""
    for i, n in enumerate(runs):
        x = n - runs[i - 2] if i > 2 else n
        more = True
        while more:
            c = x & 31
            x >>= 5
            more = x != -1 if c & 16 else x != 0
            out += chr((c | (32 if more else 0)) + 48)
    return out


def test_compressed_lengths():
    rng = random.Random(1)
    for _ in range(200):
        runs = [rng.choice([0, 1, 15, 16, 31, 32, 1000, 100_000]) for _ in range(rng.randrange(9))]
        assert A._lengths(compressed(runs)) == runs and A._lengths(json.dumps(runs)) == runs
    assert A._lengths(None) == [] and A._lengths("") == []


def test_union_of_masks():
    rng = random.Random(2)
    for _ in range(100):
        masks = [[rng.randrange(2) for _ in range(40)] for _ in range(rng.randrange(4))]
        runs = []
        for m in masks:
            own, last, n = [], 0, 0
            for v in m:
                if v != last:
                    own.append(n)
                    last, n = v, 0
                n += 1
            runs.append([*own, n])
        got, flat, value = A.union_lengths(runs, 40), [], 0
        for n in got:
            flat += [value] * n
            value = 1 - value
        assert flat == [int(any(m[i] for m in masks)) for i in range(40)]


def test_run_length_masks(spark, tmp_path):
    image = {"file_name": "a.png", "width": 4, "height": 3}
    docs = [
        {"image": image, "annotations": [{"segmentation": {"size": [3, 4], "counts": [2, 3, 7]}}, {"segmentation": {"size": [3, 4], "counts": compressed([4, 4, 4])}}]},
        {"image": image, "annotations": [{"segmentation": {"size": [9, 9], "counts": [81]}}]}, {"image": image, "annotations": [{"segmentation": {"counts": [5]}}]}, {"image": image}, {"annotations": []}, {"image": None},
    ]
    (tmp_path / "m.json").write_text("\n".join(map(json.dumps, docs)))
    got = [(r.masks, r.runs, r.pixels) for r in A.load(spark, "run-length masks", str(tmp_path)).collect()]
    assert got == [(2, [2, 6, 4], 6), (1, None, None), (1, None, None), (0, [12], 0), (0, None, None), (0, None, None)]


def test_boxes_without_boxes(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "b.json").write_text(json.dumps({"uuid": "AB", "width": 5, "boundingBoxes": []}) + "\n" + json.dumps({"uuid": "C", "boundingBoxes": [{"concept": "x", "x": 1, "y": 2, "width": 3, "height": 4, "occluded": True}]}))
    got = [(r.image, r.label, r.w, r.occluded) for r in A.load(spark, "bounding boxes json", str(tmp_path / "a")).orderBy("image").collect()]
    assert got == [("ab", None, None, None), ("c", "x", 3.0, True)]
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "c.json").write_text(json.dumps({"image": "i", "placed": [{"class": "can", "box": [1, 2, 4, 6]}, {"box": [1, 2]}], "fauna": [{"box": [0, 0, 1, 1]}]}) + "\n{}")
    got = sorted((r.label, r.w, r.layer) for r in A.load(spark, "placed objects json", str(tmp_path / "p")).collect() if r.w)
    assert got == [("can", 3.0, "placed"), ("fauna", 1.0, "fauna")]


def test_folders_of_audio_and_manifests(spark, tmp_path):
    for name in ("whale/x/a.WAV", "whale/b.txt", "seal/c.flac", "d.wav"):
        f = tmp_path / "s" / name
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_bytes(name.encode())
    assert {(r.image, r.label) for r in A.load(spark, "audio folders", str(tmp_path / "s")).collect()} == {("a.WAV", "whale"), ("c.flac", "seal")}
    (tmp_path / "m.json").write_text(json.dumps([{"file_name": "c.flac", "label": "seal"}, {"file_name": "gone.wav", "label": None}, {"label": "x"}]))
    got = {(r.image, r.label, r.there) for r in A.load(spark, "label manifest", str(tmp_path / "m.json"), files=str(tmp_path / "s")).collect()}
    assert got == {("c.flac", "seal", True), ("gone.wav", None, False), (None, "x", False)}
    assert A.load(spark, "metadata only", "nowhere").count() == 0


def test_predictions(spark, tmp_path):
    write = lambda rows, schema, name: spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / name))
    write([("a", [0.1, 0.5, 0.5]), ("b", None), ("c", [])], "image_sha256 string, pred_probs array<double>", "probs")
    assert {(r.image_sha256, r.pred_label) for r in read_predictions(spark, str(tmp_path / "probs"), "classes").collect()} == {("a", 1), ("b", None), ("c", None)}
    write([("a", 1)], "image_sha256 string, pred_label int", "labels")
    assert read_predictions(spark, str(tmp_path / "labels"), "classes").first().pred_label == 1
    for task in ("points", "masks", "answers", "nonsense"):
        with pytest.raises(ValueError):
            read_predictions(spark, str(tmp_path / "labels"), task)
    (tmp_path / "b.json").write_text(json.dumps([{"image_id": 1, "category_id": 2, "bbox": [1, 2, 3, 4], "score": 0.5}]))
    assert read_predictions(spark, str(tmp_path / "b.json"), "boxes").first().score == 0.5
    (tmp_path / "c.json").write_text(json.dumps([{"image_id": 1, "bbox": [1, 2, 3, 4], "score": 0.5}]))
    with pytest.raises(ValueError):
        read_predictions(spark, str(tmp_path / "c.json"), "boxes")
