"""Operators without SQL against plain numpy on small fixtures."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattframe.functions import curves
from wattframe.operators import forecast, repair, similar


def frame(spark, values, key=1):
    return spark.createDataFrame([(key, i + 1, float(v)) for i, v in enumerate(values)], "k int, block_no int, v double")


def loop_peaks(s, delta, gap, sign):
    picked, last = [0], 0
    for k in range(1, len(s) - max(delta, 1)):
        if sign * (s[k] - s[k - delta]) >= 0 and sign * (s[k] - s[k + delta]) >= 0 and k - last > gap:
            picked.append(k)
            last = k
    return [*picked, len(s) - 1]


@pytest.mark.parametrize("delta,gap", [(1, 3), (0, 5), (1, 0)])
def test_extremes(spark, delta, gap):
    s = np.round(np.random.default_rng(3).normal(size=96), 1)
    got = repair.mark_extremes(frame(spark, s), ["k"], "block_no", "v", delta, gap).orderBy("block_no").toPandas()
    assert list(np.flatnonzero(got["peak"] == 1)) == loop_peaks(s, delta, gap, 1)
    assert list(np.flatnonzero(got["trough"] == 1)) == loop_peaks(s, delta, gap, -1)


def test_spline_reproduces_cubics_and_meets_knots(spark):
    x = np.array([0.0, 2.0, 5.0, 6.0, 9.0])
    cubic = lambda t: 1 + t - 0.5 * t**2 + 0.1 * t**3
    at = np.linspace(0, 9, 31)
    assert np.allclose(repair._not_a_knot(x, cubic(x), at), cubic(at))
    y = np.random.default_rng(1).normal(size=5)
    assert np.allclose(repair._not_a_knot(x, y, x), y)
    assert np.allclose(repair._not_a_knot(x[:3], y[:3], np.array([1.0])), (y[0] + y[1]) / 2)


def test_envelope_touches_its_picks(spark):
    s = np.random.default_rng(5).normal(size=60).cumsum()
    df = frame(spark, s)
    upper = repair.envelope(df, ["k"], "block_no", "v", 1, 3).orderBy("block_no").toPandas()
    picks = loop_peaks(s, 1, 3, 1)
    assert np.allclose(upper["envelope"].to_numpy()[picks], s[picks])
    lower = repair.envelope(df, ["k"], "block_no", "v", 1, 3, "lower").orderBy("block_no").toPandas()
    mean = repair.envelope(df, ["k"], "block_no", "v", 1, 3, "mean").orderBy("block_no").toPandas()
    assert np.allclose(mean["envelope"], (upper["envelope"] + lower["envelope"]) / 2)


@pytest.mark.parametrize("width,degree", [(5, 1), (11, 2), (19, 3), (35, 2)])
def test_savgol(spark, width, degree):
    y = np.random.default_rng(2).normal(size=96)
    half = width // 2
    kernel = curves.savgol_kernel(width, degree)
    head = [y[0] - abs(y[j] - y[0]) for j in range(half, 0, -1)]
    tail = [y[-1] + abs(y[-1 - j] - y[-1]) for j in range(1, half + 1)]
    padded = np.array([*head, *y, *tail])
    want = [padded[i : i + width] @ kernel for i in range(96)]
    got = repair.savgol(frame(spark, y), ["k"], "block_no", "v", width, degree, "s").orderBy("block_no").toPandas()["s"]
    assert np.allclose(got, want)


@pytest.mark.parametrize("degree", [2, 7, 15])
def test_poly_profile_complete_and_partial(spark, degree):
    y = np.random.default_rng(4).normal(size=96)
    x = np.linspace(-1, 1, 96)
    got = repair.poly_profile(frame(spark, y), ["k"], "block_no", "v", degree).orderBy("block_no").toPandas()["fitted"]
    want = np.polynomial.legendre.Legendre.fit(x, y, degree, domain=[-1, 1])(x)
    assert np.allclose(got, want, atol=1e-8)
    few = frame(spark, y[:50])
    part = repair.poly_profile(few, ["k"], "block_no", "v", degree).orderBy("block_no").toPandas()["fitted"]
    assert np.allclose(part, np.polynomial.legendre.Legendre.fit(x[:50], y[:50], degree, domain=[-1, 1])(x[:50]), atol=1e-6)


@pytest.mark.parametrize("metric", ["sqeuclid", "euclid", "cosine"])
def test_nearest_earlier_equals_loop(spark, metric):
    rng = np.random.default_rng(7)
    v = rng.integers(0, 4, size=(300, 4)).astype(float)
    df = spark.createDataFrame([("a", i, r.tolist()) for i, r in enumerate(v) if i % 7], "k string, i long, vec array<double>")
    got = similar.nearest_earlier(df, ["k"], "i", "vec", metric, 150, 3).toPandas()
    index = [i for i in range(300) if i % 7]
    want = set()
    for i in index:
        found = []
        for j in index:
            if 1 <= i - j <= 150:
                d = ((v[i] - v[j]) ** 2).sum()
                if metric == "euclid":
                    d = math.sqrt(d)
                if metric == "cosine":
                    size = np.linalg.norm(v[i]) * np.linalg.norm(v[j])
                    if size == 0:
                        continue
                    d = 1 - v[i] @ v[j] / size
                found.append((round(d, 9), -j))
        for r, (_, j) in enumerate(sorted(found)[:3], 1):
            want.add((i, -j, r))
    assert {(r.i, r.lag_i, r.rank) for r in got.itertuples()} == want


def test_whole_past_over_several_buckets(spark, monkeypatch):
    monkeypatch.setattr(similar, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(10)
    v = rng.integers(0, 3, size=(100, 3)).astype(float)
    df = spark.createDataFrame([(500 + i, r.tolist()) for i, r in enumerate(v)], "i long, vec array<double>")
    got = similar.nearest_earlier(df, [], "i", "vec", "sqeuclid", None, 4).toPandas()
    want = set()
    for i in range(100):
        found = sorted((((v[i] - v[j]) ** 2).sum(), -j) for j in range(i))[:4]
        want |= {(500 + i, 500 - j, r) for r, (_, j) in enumerate(found, 1)}
    assert {(r.i, r.lag_i, r.rank) for r in got.itertuples()} == want


def test_partial_days_compare_on_known_cells(spark):
    df = spark.createDataFrame([(1, [1.0, 5.0]), (2, [None, 2.0]), (3, [2.0, None])], "i long, vec array<double>")
    whole = F.exists("vec", lambda x: x.isNull())
    got = similar.nearest_earlier(df, [], "i", "vec", "euclid", 5, 3, pool=~whole, partial=True).toPandas()
    assert {(r.i, r.lag_i, r.distance) for r in got.itertuples()} == {(2, 1, 3.0), (3, 1, 1.0)}
    assert similar.nearest_earlier(df, [], "i", "vec", "euclid", 5, 3).count() == 0


def test_nearest_units_far_and_near(spark):
    pts = [(1, 10.0, 70.0), (2, 10.1, 70.1), (3, 60.0, -170.0), (4, 60.0, 179.5), (5, -80.0, 0.0)]
    df = spark.createDataFrame(pts, "u int, lat double, lon double")
    got = {r["u"]: r["neighbour"] for r in similar.nearest_units(df, "u", "lat", "lon").collect()}

    def km(a, b):
        la, lb = math.radians(a[1]), math.radians(b[1])
        h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin(math.radians(b[2] - a[2]) / 2) ** 2
        return 2 * 6367 * math.asin(math.sqrt(h))

    assert got == {p[0]: min((q for q in pts if q is not p), key=lambda q: km(p, q))[0] for p in pts}


def test_geo_ring_distances(spark):
    seeds = spark.createDataFrame([(20.0, 75.0)], "lat double, lon double")
    ring = similar.geo_ring(seeds, "lat", "lon", 20, 10, 8)
    from wattframe.functions.scalars import haversine_km

    km = [round(r[0]) for r in ring.select(haversine_km(F.col("lat"), F.col("lon"), F.lit(20.0), F.lit(75.0))).collect()]
    assert sorted(km) == [10] * 8 + [20] * 8


def test_smooth_until_stops(spark):
    y = np.abs(np.random.default_rng(8).normal(10, 2, size=96))
    got = repair.smooth_until(frame(spark, y), ["k"], ["block_no"], "v", "v", tol=0.5).orderBy("block_no").toPandas()["smooth"]
    once = np.convolve(y, np.ones(5) / 5, "valid")
    assert got.notna().sum() <= len(once)


def test_bias_ladder_reduces_error(spark):
    from wattframe.operators import correct

    rng = np.random.default_rng(9)
    rows = [(f"2024-01-{d:02d}", b, 100 + 10 * math.sin(b / 15) + (d % 7) + rng.normal(0, 0.1), 100.0) for d in range(1, 29) for b in range(1, 97)]
    df = spark.createDataFrame(rows, "date string, block_no int, y double, f double").withColumn("date", F.to_date("date"))
    events = spark.createDataFrame([("2024-01-07", "e")], "date string, name string").withColumn("date", F.to_date("date"))
    got = correct.bias_ladder(df, events, [], "y", "f")
    before, after = got.agg(F.avg(F.abs(F.col("y") - F.col("f"))), F.avg(F.abs(F.col("y") - F.col("corrected")))).first()
    assert after < before / 2
