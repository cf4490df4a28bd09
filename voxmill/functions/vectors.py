"""Vectors and short signals as arrays of doubles, by native array functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - cosine similarity, with 1e-9 added to the denominator."""
    return 1 - dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)) + F.lit(1e-9))


def clipping_ratio(x: Column, threshold: float = 0.999) -> Column:
    """The share of samples at or above the threshold; an empty signal has none."""
    high = F.size(F.filter(x, lambda v: F.abs(v.cast("double")) >= threshold))
    return F.when(F.size(x) > 0, high / F.size(x)).otherwise(F.lit(0.0))


def peak_normalised(x: Column, dbfs: float = -3.0) -> Column:
    """``x`` with its peak at ``dbfs``; a silent signal is unchanged."""
    doubles = F.transform(x, lambda v: v.cast("double"))
    peak = F.array_max(F.transform(doubles, lambda v: F.abs(v)))
    return F.when(peak > 0, F.transform(doubles, lambda v: v * (F.lit(10.0 ** (dbfs / 20)) / peak))).otherwise(doubles)


def frame_energies(x: Column, frame: int, hop: int) -> Column:
    """The mean square of each frame in decibels."""
    count = F.floor((F.size(x) - frame) / hop).cast("int")
    starts = F.when(F.size(x) >= frame, F.sequence(F.lit(0), count)).otherwise(F.array().cast("array<int>"))

    def energy(i: Column) -> Column:
        part = F.slice(x, i * hop + 1, frame)
        total = F.aggregate(part, F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
        return 10 * F.log10(total / frame + F.lit(1e-12))

    return F.transform(starts, energy)


def rms(x: Column) -> Column:
    return F.sqrt(dot(x, x) / F.size(x))


def level_ratio(part: Column, whole: Column) -> Column:
    """The level of a stem against the level of all, as a gate before a costly separation."""
    return rms(part) / (rms(whole) + F.lit(1e-9))


def needs_separation(ratio: Column, mode: str = "auto", threshold: float = 0.10) -> Column:
    """Always, never, or where the stem reaches the threshold; an unknown ratio counts as music."""
    if mode != "auto":
        return F.lit(mode == "true")
    return F.coalesce(ratio >= threshold, F.lit(True))


def windowed_mean(x: Column, size: int) -> Column:
    """The mean of each whole window's mean; a shorter signal is padded with zeros to one window."""
    n = F.greatest(F.floor(F.size(x) / size), F.lit(1)).cast("int")
    sums = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.aggregate(F.slice(x, i * size + 1, size), F.lit(0.0), lambda s, v: s + v.cast("double")) / size)
    return F.aggregate(sums, F.lit(0.0), lambda s, v: s + v, lambda s: s / n)
