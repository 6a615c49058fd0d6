"""Expressions over short ordered arrays (one entity-day, at most a few hundred values)."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def last_of(values: Column) -> Column:
    """Last element, null for an empty array."""
    return F.try_element_at(values, F.greatest(F.size(values), F.lit(1)))


def squared_distance(a: Column, b: Column) -> Column:
    """Sum of squared differences; positions where either side is null do not count."""
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: F.coalesce((x - y) * (x - y), F.lit(0.0))),
        F.lit(0.0),
        lambda s, x: s + x,
    )


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(squared_distance(a, b))


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - cosine; a zero vector has no direction and gives null."""
    return 1 - dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def savgol_kernel(width: int, degree: int) -> np.ndarray:
    """Weights of the least-squares polynomial value at the window centre."""
    if width % 2 != 1 or width < degree + 2:
        raise ValueError("width must be odd and at least degree + 2")
    half = width // 2
    design = np.vander(np.arange(-half, half + 1, dtype=float), degree + 1, increasing=True)
    return np.linalg.pinv(design)[0]


def mirror_pad(values: Column, half: int) -> Column:
    """Pad both ends by ``half``.

    The pads reflect the distance to the end value, always downwards at the start and upwards at the end.
    Arrays shorter than ``half + 1`` pad with as many values as they have.
    """
    first, last = values[0], F.element_at(values, -1)
    head = F.transform(F.reverse(F.slice(values, 2, half)), lambda x: first - F.abs(x - first))
    n = F.size(values)
    take = F.least(F.lit(half), n - 1)
    tail = F.transform(
        F.reverse(F.slice(values, F.greatest(F.lit(1), n - take), F.greatest(F.lit(0), take))),
        lambda x: last + F.abs(x - last),
    )
    return F.concat(head, values, tail)


def correlate(padded: Column, kernel: Sequence[float]) -> Column:
    """Sliding dot product of an array with a constant kernel, full windows only."""
    width = len(kernel)
    weights = F.array(*[F.lit(float(w)) for w in kernel])
    starts = F.sequence(F.lit(1), F.size(padded) - width + 1)
    return F.transform(starts, lambda i: dot(F.slice(padded, i, width), weights))


def savgol(values: Column, width: int, degree: int) -> Column:
    """Savitzky-Golay smoothing of an array; arrays of at most half a window are returned as they are."""
    half = width // 2
    smoothed = correlate(mirror_pad(values, half), savgol_kernel(width, degree))
    return F.when(F.size(values) > half, smoothed).otherwise(values)


def median_filter(values: Column, width: int) -> Column:
    """Running median of odd width with zeros beyond both ends."""
    half = width // 2
    zeros = F.array_repeat(F.lit(0.0), half)
    padded = F.concat(zeros, values, zeros)
    starts = F.sequence(F.lit(1), F.size(values))
    smoothed = F.transform(starts, lambda i: F.array_sort(F.slice(padded, i, width))[half])
    return F.when(F.size(values) > 0, smoothed).otherwise(values)
