"""Nearest units against all pairs: dense cells, one place with a third of all units, far and lone units."""

import numpy as np
from wattframe.operators import places


def all_pairs(rows, k):
    rows = [r for r in rows if r[1] is not None and r[2] is not None]
    key = np.array([r[0] for r in rows])
    lat, lon = np.radians([r[1] for r in rows]), np.radians([r[2] for r in rows])
    out = {}
    for i in range(len(rows)):
        h = np.sin((lat - lat[i]) / 2) ** 2 + np.cos(lat) * np.cos(lat[i]) * np.sin((lon - lon[i]) / 2) ** 2
        km = np.round(2 * 6367 * np.arcsin(np.minimum(1, np.sqrt(h))), 9)
        km[i] = np.inf
        order = np.lexsort((key, km))[: min(k, len(rows) - 1)]
        out[int(key[i])] = [(int(key[j]), n + 1) for n, j in enumerate(order)], km[order]
    return out


def held(spark, rows, k, most):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "unit bigint, lat double, lon double, a int, _p string")
    got = {}
    for r in places.nearest_units(df, "unit", "lat", "lon", k, most).orderBy("unit", "nn_rank").collect():
        got.setdefault(r.unit, []).append((r.neighbour, r.nn_rank, r.distance_km))
    want = all_pairs(rows, k)
    for unit, (pairs, km) in want.items():
        mine = got.get(unit, [])
        # Distances that agree to a nanometre may be told apart by either side's rounding.
        assert np.allclose([d for _, _, d in mine], km, atol=1e-7)
        assert [p[:2] for p in mine] == pairs or len(set(np.round(km, 7))) < len(km) or k > 1 and np.min(np.diff(km), initial=1) < 1e-6
    assert set(got) == {u for u, (p, _) in want.items() if p}


def test_one_dense_cell(spark):
    draw = np.random.default_rng(1)
    rows = [(i, 20 + float(draw.normal(0, 0.3)), 75 + float(draw.normal(0, 0.3))) for i in range(1500)]
    rows += [(5000 + i, 20 + float(draw.normal(0, 0.001)), 75 + float(draw.normal(0, 0.001))) for i in range(800)]
    held(spark, rows, 3, 40)


def test_no_block_above_the_limit(spark):
    draw = np.random.default_rng(2)
    df = spark.createDataFrame([(i, 20 + float(draw.random()), 75 + float(draw.random())) for i in range(4000)], "u int, lat double, lon double")
    points = places._points(df, "u", "lat", "lon", 2)
    leaves, cells, levels = places.space_cells(points, 50)
    sizes = [r["count"] for r in leaves.groupBy("_cell").count().collect()]
    assert sum(sizes) == 4000 and max(sizes) <= 50
    pairs = places.meeting_leaves(cells, places.packed_leaves(leaves), levels, 2)
    held_by = {r["_cell"]: r["count"] for r in leaves.groupBy("_cell").count().collect()}
    compared = sum(held_by[r.a] * held_by[r.b] for r in pairs.select("a", "b").collect())
    assert compared < 4000 * 4000 / 16


def test_a_place_with_a_third_of_all_units(spark):
    draw = np.random.default_rng(3)
    rows = [(i, 10.0, 70.0) for i in range(300)] + [(1000 + i, float(draw.uniform(-90, 90)), float(draw.uniform(-180, 180))) for i in range(600)]
    rows += [(3000, 90.0, 0.0), (3001, 90.0, 120.0), (3002, -90.0, 5.0), (3003, 5.0, 180.0), (3004, 5.0, -180.0), (3005, None, 1.0), (3006, 1.0, None)]
    held(spark, rows, 2, 32)


def test_few_units(spark):
    held(spark, [(1, 1.0, 1.0), (2, 1.0, 2.0)], 5, 128)
    held(spark, [(1, 1.0, 1.0)], 1, 128)
    df = spark.createDataFrame([], "unit bigint, lat double, lon double")
    assert places.nearest_units(df, "unit", "lat", "lon").collect() == []
