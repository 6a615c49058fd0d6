"""Kernel regression by cubes against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattframe.operators import kernel


def pairs(t, y, q, sigma):
    top = np.zeros(len(q))
    low = np.zeros(len(q))
    for i in range(len(q)):
        w = np.exp(-((q[i] - t) ** 2).sum(axis=1) / (2 * sigma**2))
        top[i], low[i] = w @ y, w.sum()
    with np.errstate(invalid="ignore"):
        return top / low


def frames(spark, t, y, q):
    names = "abcdefg"[: t.shape[1]]
    cols = ", ".join(f"{c} double" for c in names)
    train = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(t, y)], cols + ", y double")
    query = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(q)], "i int, " + cols)
    return train, query, list(names)


def asked(spark, t, y, q, sigma, **how):
    train, query, names = frames(spark, t, y, q)
    return kernel.kernel_regression(train, query, names, "y", sigma, **how).orderBy("i").toPandas()["kernel_pred"].to_numpy(dtype=float)


@pytest.mark.parametrize("sigma", [30.0, 2.0, 0.05])
def test_equals_all_pairs(spark, sigma):
    rng = np.random.default_rng(6)
    t, q = rng.normal(size=(200, 3)), rng.normal(size=(50, 3))
    y = rng.normal(size=200)
    assert np.allclose(asked(spark, t, y, q, sigma), pairs(t, y, q, sigma), rtol=1e-9, atol=1e-10, equal_nan=True)


def test_crowded_cubes_are_summed_at_nodes(spark, monkeypatch):
    """Clusters far apart, one of them with most rows: weights at nodes stand for it, in parts that several tasks sum up."""
    rng = np.random.default_rng(7)
    t = np.vstack([rng.normal(0, 0.2, size=(9000, 2)), rng.normal(4, 2, size=(300, 2)), rng.uniform(-50, 50, size=(300, 2))])
    y = rng.normal(5, 1, size=len(t)) + t[:, 0]
    q = np.vstack([rng.normal(0, 3, size=(60, 2)), rng.uniform(-50, 50, size=(60, 2))])
    used = []
    own = kernel._nodes_needed(1e-12)
    assert own**2 < 9000
    monkeypatch.setattr(kernel, "CROWD", 1000)
    monkeypatch.setattr(kernel, "POINTS", 100)
    monkeypatch.setattr(kernel, "ASKING", 16)
    monkeypatch.setattr(kernel, "MEETING", 2)
    used.append(asked(spark, t, y, q, 1.0, nodes=24))
    used.append(asked(spark, t, y, q, 1.0))
    want = pairs(t, y, q, 1.0)
    far = np.sqrt(((q[:, None] - t[None]) ** 2).sum(2)).min(1)
    for got in used:
        near = far < 10
        assert np.allclose(got[near], want[near], rtol=1e-9, equal_nan=True)
        assert np.allclose(got, want, rtol=1e-6, equal_nan=True)


@pytest.mark.parametrize("d", [1, 2, 3])
def test_nodes_give_the_sums_of_the_points(d):
    rng = np.random.default_rng(d)
    n = 20
    cell = np.arange(d) + 3
    x = (cell + rng.uniform(0, 1, size=(500, d))) * kernel.SIDE
    y = np.stack([rng.normal(size=500), np.ones(500)], 1)
    weights = kernel._node_weights((x / kernel.SIDE - cell) * 2 - 1, y, n)
    q = rng.normal(2, 3, size=(40, d))
    got = kernel._from_nodes(q, (cell + 0.5) * kernel.SIDE, weights.ravel(), n).reshape(-1, 2)
    want = kernel._from_points(q, np.hstack([x, y]))
    assert np.allclose(got, want, rtol=1e-8, atol=1e-13 * 500)


def test_far_cubes_never_meet(spark):
    """A wide line of points: each cube meets those within reach, not all of them."""
    cells = spark.range(2000).selectExpr("array(id) AS _cell")
    pairs_met = kernel.meeting_cubes(cells, cells, 11, 2 * np.log(2000 / 1e-12))
    met = pairs_met.groupBy("_q").count().toPandas()["count"]
    assert len(met) == 2000 and met.max() < 50


def test_features_that_come_out_anew(spark):
    draw = F.udf(lambda: random.SystemRandom().random(), "double").asNondeterministic()
    train = spark.createDataFrame([(0.1, 1.0), (0.4, 2.0), (0.9, 4.0)], "a double, y double")
    got = kernel.kernel_regression(train, spark.range(40).select("id", draw().alias("a")), ["a"], "y", 0.3).toPandas()
    wanted = pairs(np.array([[0.1], [0.4], [0.9]]), np.array([1.0, 2.0, 4.0]), got[["a"]].to_numpy(), 0.3)
    assert len(got) == 40 and np.allclose(got["kernel_pred"].to_numpy(dtype=float), wanted, rtol=1e-9)


def test_edges(spark):
    schema = "i int, a double, b double, y double, kernel_pred string"
    nothing = spark.createDataFrame([], schema)
    some = spark.createDataFrame([(1, 0.0, -0.0, 2.0, "x"), (1, 0.0, 0.0, 2.0, "x"), (2, None, 1.0, 3.0, None), (3, float("inf"), 1.0, 3.0, None), (4, float("nan"), 1.0, 3.0, None), (5, 1.0, 1.0, None, None), (6, 1e6, 0.0, None, None)], schema)
    assert kernel.kernel_regression(some, nothing, ["a", "b"], "y", 1.0).count() == 0
    assert {r.kernel_pred for r in kernel.kernel_regression(nothing, some, ["a", "b"], "y", 1.0).collect()} == {None}
    assert {r.kernel_pred for r in kernel.kernel_regression(nothing, nothing, ["a", "b"], "y", 1.0).collect()} == set()
    got = kernel.kernel_regression(some, some, ["a", "b"], "y", 1.0)
    assert got.columns == ["i", "a", "b", "y", "kernel_pred"]
    assert sorted((r.i, r.kernel_pred) for r in got.collect()) == [(1, 2.0), (1, 2.0), (2, None), (3, None), (4, None), (5, 2.0), (6, None)]
