"""Scalar expressions: nulls, clamps, transforms, geography, normal quantile."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6367


def finite(col: Column) -> Column:
    """True when the value is present, not NaN and not infinite."""
    return col.isNotNull() & ~F.isnan(col) & (F.abs(col) != float("inf"))


def nan_to_null(col: Column) -> Column:
    return F.when(finite(col), col)


def ratio(num: Column, den: Column) -> Column:
    """num / den with a zero denominator giving null."""
    return num / F.nullif(den, F.lit(0.0))


def clamp(col: Column, low: float | Column, high: float | Column) -> Column:
    """Value held inside [low, high]; null stays null."""
    low = low if isinstance(low, Column) else F.lit(low)
    high = high if isinstance(high, Column) else F.lit(high)
    return F.when(col.isNotNull(), F.least(F.greatest(col, low), high))


def energy_to_mw(col: Column) -> Column:
    """Energy of a quarter hour to average power, never below zero; null stays null."""
    return F.when(col.isNotNull(), F.greatest(col * 4, F.lit(0.0)))


def heat_response(temp: Column) -> Column:
    """Load response to temperature: cool days are mirrored up around 25, then a logistic around 38."""
    mirrored = F.when(temp < 25, 25 + 1.5 * (25 - temp)).otherwise(temp)
    return 100 / (1 + F.exp(-0.4 * (mirrored - 38)))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dlat, dlon = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    a = (
        F.pow(F.sin(dlat / 2), F.lit(2.0))
        + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), F.lit(2.0))
    )
    return 2 * EARTH_RADIUS_KM * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def point_at(lat: Column, lon: Column, km: Column, bearing_deg: Column) -> Column:
    """Struct (lat, lon) reached from a point along a great circle of the sphere."""
    angle = km / EARTH_RADIUS_KM
    phi, theta = F.radians(lat), F.radians(bearing_deg)
    phi2 = F.asin(F.sin(phi) * F.cos(angle) + F.cos(phi) * F.sin(angle) * F.cos(theta))
    lam2 = F.radians(lon) + F.atan2(
        F.sin(theta) * F.sin(angle) * F.cos(phi), F.cos(angle) - F.sin(phi) * F.sin(phi2)
    )
    return F.struct(F.degrees(phi2).alias("lat"), F.degrees(lam2).alias("lon"))


def dms_to_decimal(text: Column) -> Column:
    """'28 35 30 N' style text to signed degrees; text that does not parse gives null."""
    pattern = r"^\s*(\d+)\D+(\d+)\D+(\d+(?:\.\d+)?)\D*?([NSEW])\s*$"

    def part(k: int) -> Column:
        return F.regexp_extract(text, pattern, k).try_cast("double")

    sign = F.when(F.regexp_extract(text, pattern, 4).isin("S", "W"), -1.0).otherwise(1.0)
    return F.when(text.rlike(pattern), sign * (part(1) + part(2) / 60 + part(3) / 3600))


def apply_bias(quantum: Column, bias: Column) -> Column:
    """quantum + bias when there is a quantum; else a non-zero bias alone; else null."""
    return F.when(quantum.isNotNull(), quantum + F.coalesce(bias, F.lit(0.0))).when(
        F.coalesce(bias, F.lit(0.0)) != 0, bias
    )


def nullify(col: Column, tokens: Sequence[str]) -> Column:
    """Text with the given tokens (and blanks around them) turned into null."""
    trimmed = F.trim(col)
    return F.when(~trimmed.isin(list(tokens)), trimmed)


def parse_any(col: Column, formats: Sequence[str]) -> Column:
    """First timestamp format that fits; null when none does."""
    return F.coalesce(*[F.try_to_timestamp(col, F.lit(fmt)) for fmt in formats])


def classify_contains(col: Column, rules: Mapping[str, str], default: str | None = None) -> Column:
    """First rule whose substring occurs in the text names the class; order matters."""
    ladder = None
    for needle, name in rules.items():
        test = col.contains(needle)
        ladder = F.when(test, name) if ladder is None else ladder.when(test, name)
    return ladder.otherwise(F.lit(default))


def classify_member(col: Column, members: Sequence[str], inside: str, outside: str) -> Column:
    return F.when(col.isin(list(members)), inside).otherwise(outside)


def strip_bracketed(col: Column) -> Column:
    """Name without a bracketed suffix."""
    return F.trim(F.regexp_replace(col, r"\s*\([^)]*\)", ""))


def sentinel_to_null(col: Column, sentinel: float = -9999.0) -> Column:
    return F.when(col != sentinel, col)


def row_values(cols: Sequence[Column]) -> Column:
    """Non-null values of a row, sorted."""
    return F.array_sort(F.filter(F.array(*cols), lambda x: x.isNotNull()))


def row_median(cols: Sequence[Column]) -> Column:
    """Median over columns, skipping nulls."""
    values = row_values(cols)
    n = F.size(values)
    low = F.try_element_at(values, F.floor((n + 1) / 2).cast("int"))
    high = F.try_element_at(values, F.floor(n / 2 + 1).cast("int"))
    return F.when(n > 0, (low + high) / 2)


def row_mean(cols: Sequence[Column]) -> Column:
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0.0)) for c in cols])
    count = reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in cols])
    return total / F.nullif(count, F.lit(0))


def row_max(cols: Sequence[Column]) -> Column:
    return F.greatest(*cols)


def row_min(cols: Sequence[Column]) -> Column:
    return F.least(*cols)


def normal_quantile(p: float) -> float:
    """z with P(Z <= z) = p, for plan-time constants (bisection on erf, to double precision)."""
    if not 0.0 < p < 1.0:
        raise ValueError("probability must lie strictly between 0 and 1")
    low, high = -40.0, 40.0
    for _ in range(200):
        mid = (low + high) / 2
        if 0.5 * math.erfc(-mid / math.sqrt(2.0)) < p:
            low = mid
        else:
            high = mid
    return (low + high) / 2
