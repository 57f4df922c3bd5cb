"""Geometry expressions: boxes and great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemill.operators.nearby import haversine  # noqa: F401


def unit_span(low: Column, high: Column, size: Column) -> tuple[Column, Column, Column]:
    """(low, high, clipped) of a pixel span in units of the side, clipped to [0, 1]; null where nothing is left."""
    clip = lambda c: F.greatest(F.lit(0.0), F.least(F.lit(1.0), c / size))
    a, b = clip(low), clip(high)
    real = b > a
    return F.when(real, a), F.when(real, b), (low < 0) | (high > size)


def pixel_span(low: Column, high: Column, size: Column, eps: float = 1e-6) -> tuple[Column, Column]:
    """Whole pixels that a unit span touches."""
    return F.floor(low * size + eps).cast("int"), F.ceil(high * size - eps).cast("int")
