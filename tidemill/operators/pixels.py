"""Codes and quality of grey images, which are columns of numbers: no image codec is needed.

Images are arrays of grey values from 0 to 255, row by row, with their width; they are worked on in Arrow batches, image by image
in numpy, as sizes differ from row to row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def shrunk(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Mean grey value of each of height x width equal areas; an area that cuts a pixel takes its share of it."""

    def weights(n: int, to: int) -> np.ndarray:
        edges = np.arange(to + 1) * n / to
        low, high = np.maximum(edges[:-1, None], np.arange(n)), np.minimum(edges[1:, None], np.arange(1, n + 1))
        return np.clip(high - low, 0, None) * to / n

    return weights(image.shape[0], height) @ image @ weights(image.shape[1], width).T


def to_hex(bits: np.ndarray) -> str:
    return np.packbits(bits.astype(np.uint8).ravel()).tobytes().hex()


def gradient_code(image: np.ndarray, size: int = 8) -> str:
    """Difference code: whether each of size x size areas is brighter than the one left of it."""
    s = shrunk(image, size, size + 1)
    return to_hex(s[:, 1:] > s[:, :-1])


def cosine_basis(n: int) -> np.ndarray:
    k = np.arange(n)
    return np.cos(np.pi / n * np.outer(k, k + 0.5))


def frequency_code(image: np.ndarray, size: int = 8, grid: int = 32, constant: bool = False) -> str:
    """Perceptual code: whether each of the size x size lowest frequencies is above their median, which leaves the constant part
    out unless ``constant``."""
    s = shrunk(image, grid, grid)
    basis = cosine_basis(grid)[:size]
    low = basis @ s @ basis.T
    return to_hex(low > np.median(low.ravel() if constant else low.ravel()[1:]))


def entropy(image: np.ndarray) -> float:
    """Bits of the histogram of 256 grey values; 0 for one value."""
    n = np.bincount(np.clip(np.floor(image).astype(int), 0, 255).ravel(), minlength=256)
    p = n[n > 0] / n.sum()
    return float(max(0.0, -(p * np.log2(p)).sum()))


def sharpness(image: np.ndarray) -> float:
    """Variance of the Laplacian inside the image; 0 where it is narrower than three pixels."""
    if min(image.shape) < 3:
        return 0.0
    inner = image[1:-1, 1:-1]
    return float((image[:-2, 1:-1] + image[2:, 1:-1] + image[1:-1, :-2] + image[1:-1, 2:] - 4 * inner).var())


MEASURES: dict[str, tuple[Callable[[np.ndarray], object], str, pa.DataType]] = {
    "dhash": (gradient_code, "string", pa.string()),
    "dhash_mirrored": (lambda x: gradient_code(x[:, ::-1]), "string", pa.string()),
    "dhash_upside": (lambda x: gradient_code(x[::-1]), "string", pa.string()),
    "phash": (frequency_code, "string", pa.string()),
    "entropy": (entropy, "double", pa.float64()),
    "sharpness": (sharpness, "double", pa.float64()),
    "clipped": (lambda x: float(((x <= 0) | (x >= 255)).mean()), "double", pa.float64()),
    "spread": (lambda x: float(x.std()), "double", pa.float64()),
}


def described(rows: DataFrame, key: str, grey: str, width: Column, measures: list[str]) -> DataFrame:
    """(key, one column per measure) of every image. Images that are null or empty, hold null or NaN, or whose width is null or
    doesn't divide them, have null in all."""
    x = rows.select(F.col(key).alias("key"), F.col(grey).cast("array<double>").alias("g"), width.cast("int").alias("w"))
    usable = (F.size("g") > 0) & (F.col("w") > 0) & (F.try_mod(F.size("g"), F.col("w")) == 0) & ~F.exists("g", lambda v: v.isNull() | F.isnan(v))
    x = x.withColumn("g", F.when(usable, F.col("g")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in measures]
            for g, w in zip(b.column("g"), b.column("w").to_pylist(), strict=True):
                image = g.values.to_numpy().reshape(-1, w) if g.is_valid else None
                for column, m in zip(out, measures, strict=True):
                    column.append(None if image is None else MEASURES[m][0](image))
            yield pa.RecordBatch.from_arrays([b.column("key"), *(pa.array(c, MEASURES[m][2]) for c, m in zip(out, measures, strict=True))], ["key", *measures])

    kind = x.schema["key"].dataType.simpleString()
    return x.mapInArrow(run, ", ".join([f"key {kind}", *(f"{m} {MEASURES[m][1]}" for m in measures)])).withColumnRenamed("key", key)


def featureless(entropy_bits: Column, least: float = 2.0) -> Column:
    """Whether an image has too little texture for its code to mean anything; null counts as featureless."""
    return F.coalesce(entropy_bits < least, F.lit(True))


def mask_faults(masks: DataFrame, image: str = "image") -> DataFrame:
    """(image, fault) of masks that break a rule. masks: image, width, height, mask_width, mask_height, values (the distinct
    pixel values), classes (the ids that the class map allows), instances (the ids listed), seen (the ids in the mask).

    size: the mask has other sides than the image. class: a value that is no class (255 is "ignore" and always allowed).
    ignore listed: 255 is a class. numbers: instance ids are not exactly 1 to their number. stray: an id in the mask that is not
    listed. empty: nothing but 0 and 255. Null arrays are empty; null sides differ from all.
    """
    none = lambda c: F.coalesce(F.col(c), F.array().cast("array<int>"))
    values, classes, listed, seen = none("values"), none("classes"), F.array_distinct(none("instances")), none("seen")
    n = F.size(listed)
    numbers = (n != F.size(none("instances"))) | ((n > 0) & ((F.array_min(listed) != 1) | (F.array_max(listed) != n)))
    rules = {
        "size": ~F.coalesce((F.col("width") == F.col("mask_width")) & (F.col("height") == F.col("mask_height")), F.lit(False)),
        "class": F.size(F.array_except(values, F.concat(classes, F.array(F.lit(255), F.lit(0))))) > 0,
        "ignore listed": F.array_contains(classes, 255),
        "numbers": numbers,
        "stray": F.size(F.array_except(seen, F.concat(listed, F.array(F.lit(0))))) > 0,
        "empty": F.size(F.array_except(values, F.array(F.lit(0), F.lit(255)))) == 0,
    }
    return masks.select(image, F.explode(F.array_compact(F.array(*(F.when(c, k) for k, c in rules.items())))).alias("fault"))

