"""Nearest earlier windows over the whole past against a loop, and the share of pairs that is compared."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattframe.operators import past, similar


def loop(v, metric, k):
    want = set()
    for i in range(len(v)):
        if metric == "cosine":
            d = 1 - (v[:i] @ v[i]) / (np.linalg.norm(v[:i], axis=1) * np.linalg.norm(v[i]))
        else:
            d = ((v[:i] - v[i]) ** 2).sum(1)
            d = np.sqrt(d) if metric == "euclid" else d
        found = sorted((round(x, 9), -j) for j, x in enumerate(d))[:k]
        want |= {(i, -j, r) for r, (_, j) in enumerate(found, 1)}
    return want


@pytest.mark.parametrize("metric", ["euclid", "sqeuclid", "cosine"])
def test_equals_a_loop(spark, monkeypatch, metric):
    monkeypatch.setattr(past, "BLOCK", 16)
    rng = np.random.default_rng(3)
    v = np.vstack([rng.normal(3, 1, size=(150, 5)), rng.integers(1, 3, size=(150, 5)).astype(float)])
    rng.shuffle(v)
    df = spark.createDataFrame([("a", i, r.tolist()) for i, r in enumerate(v)] + [(None, 900 + i, r.tolist()) for i, r in enumerate(v[:90])], "k string, i long, v array<double>")
    got = similar.similar_windows(df, ["k"], "i", "v", metric, 4).toPandas()
    one = got[got["k"] == "a"]
    assert {(r.i, r.lag_i, r.rank) for r in one.itertuples()} == loop(v, metric, 4)
    null = got[got["k"].isna()]
    assert {(r.i - 900, r.lag_i - 900, r.rank) for r in null.itertuples()} == loop(v[:90], metric, 4)


def test_most_pairs_are_proven_away(spark):
    """A year's worth of daily shapes: far fewer pairs are compared than there are, and what comes out is exact."""
    rng = np.random.default_rng(4)
    n, k = 12_000, 5
    level = 50 + 30 * np.sin(np.arange(n) * 2 * np.pi / 24) + rng.normal(0, 8, n)
    v = level[:, None] + np.outer(rng.normal(0, 10, n), [-1.5, -0.5, 0.5, 1.5]) + rng.normal(0, 0.3, (n, 4))
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(v)], "i long, v array<double>")
    rows, _ = past.windows_in_blocks(df, [], "i", "v", "euclid")
    blocks = past._described(rows)
    whole = rows.withColumns({"_c": F.lit(0), "_far": F.lit(float("inf"))})
    first = past.blocks_that_meet(blocks, "euclid", k)
    parts = past._parts(rows, past.bounds_of(past._met(first, whole, rows, "euclid", k), k)).cache()
    rest = past.blocks_that_meet(blocks, "euclid", k, parts)
    own = blocks.select("_g", "_e", "_b", F.lit(0).alias("_c"), "_size")
    part = parts.groupBy("_g", "_e", "_b", "_c").agg(F.count(F.lit(1)).alias("_size"))
    other = own.select("_g", F.col("_e").alias("_oe"), F.col("_b").alias("_ob"), F.col("_size").alias("_os"))
    met = [p.join(s, ["_g", "_e", "_b", "_c"]).join(other, ["_g", "_oe", "_ob"]).agg(F.sum(F.col("_size") * F.col("_os"))).first()[0] for p, s in ((first, own), (rest, part))]
    assert own.agg(F.max("_size")).first()[0] <= 2 * past.BLOCK
    assert sum(met) < 0.45 * n * (n - 1) / 2
    got = similar.similar_windows(df, [], "i", "v", "euclid", k)
    out = got.toPandas()
    for i in rng.integers(1, n, size=200):
        d = np.round(np.sqrt(((v[:i] - v[i]) ** 2).sum(1)), 9)
        want = [(-j) for _, j in sorted(zip(d, -np.arange(i)))[:k]]
        assert out[out["i"] == i].sort_values("rank")["lag_i"].tolist() == want


def test_one_vector_many_times_stays_in_bounded_blocks(spark, monkeypatch):
    monkeypatch.setattr(past, "BLOCK", 16)
    df = spark.range(200).selectExpr("id AS i", "array(1.0D, 1.0D, 1.0D) AS v")
    rows, _ = past.windows_in_blocks(df, [], "i", "v", "euclid")
    assert past._described(rows).agg(F.max("_size")).first()[0] <= 32
    got = similar.similar_windows(df, [], "i", "v", "euclid", 2).toPandas()
    assert {(r.i, r.lag_i, r.rank) for r in got.itertuples()} == {(i, i - r, r) for i in range(200) for r in (1, 2) if i >= r}


def test_edges(spark):
    schema = "i long, v array<double>, distance string"
    assert similar.similar_windows(spark.createDataFrame([], schema), [], "i", "v", "euclid", 3).count() == 0
    rows = [(1, [1.0, 2.0], "x"), (2, [1.0, None], None), (3, None, None), (None, [1.0, 2.0], None), (4, [1.0, float("nan")], None), (5, [1.0], None), (6, [1.0, 3.0], None), (7, [2.0], None), (8, [], None), (9, [], None)]
    got = similar.similar_windows(spark.createDataFrame(rows, schema), [], "i", "v", "euclid", 3)
    assert got.columns == ["i", "lag_i", "distance", "rank"]
    assert sorted((r.i, r.lag_i, r.distance, r.rank) for r in got.collect()) == [(6, 1, 1.0, 1), (7, 5, 1.0, 1), (9, 8, 0.0, 1)]
