"""Gaussian kernel regression over any number of training rows, without a table of pairs.

Space is cut into cubes half a kernel width wide. A crowded cube is replaced by weights at its Chebyshev nodes: the
kernel is interpolated inside the cube, so the weights do not depend on who asks, and their number does not depend on
the number of rows. A cube with fewer points than nodes keeps its points. Cubes of asking rows meet cubes of training
rows level by level, from one pair that holds everything down to the cubes; a pair goes on only while its largest weight
could still matter beside the smallest that the nearest known cube gives.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattframe.session import cut_lineage

#: exp(-x^2 / 2) is exactly zero in double precision beyond this x.
VANISHING = math.sqrt(2 * 746.0)
#: Width of a cube in kernel widths.
SIDE = 0.5
#: Points of a sparse cube in one block; of a crowded one summed up by one task; asking rows in one block.
POINTS, CROWD, ASKING = 4096, 65_536, 256
#: Blocks of asking rows of one cube that meet in one group.
MEETING = 64
#: Levels of cubes that one plan goes down.
LEVELS = 4


def _nodes_needed(tolerance: float) -> int:
    """Chebyshev nodes that leave a relative remainder below ``tolerance`` for all weights that are not zero."""
    z = VANISHING * SIDE / 2
    n = 1
    while n * math.log(z / 2) - math.lgamma(n + 1) + 2 * z + math.log(2) > math.log(tolerance):
        n += 1
    return n


def _lagrange(t: np.ndarray, n: int) -> np.ndarray:
    """Values at ``t`` in [-1, 1] of the n polynomials that are one at their own node and zero at the others."""
    k = np.arange(n)
    at_nodes = np.cos(np.outer(k, (2 * k + 1) * np.pi / (2 * n)))
    at_nodes[1:] *= 2
    return np.cos(np.outer(np.arccos(np.clip(t, -1, 1)), k)) @ at_nodes / n


def _node_weights(x: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """Weights (n, ..., n, columns of y) at the nodes for points ``x`` in cube coordinates [-1, 1]."""
    d = x.shape[1]
    total = np.zeros((n ** (d - 1), n * y.shape[1]))
    step = max(1, 2_000_000 // n ** max(d - 1, 1))
    for at in range(0, len(x), step):
        part, values = x[at : at + step], y[at : at + step]
        table = np.ones((len(part), 1))
        for j in range(d - 1):
            table = (table[:, :, None] * _lagrange(part[:, j], n)[:, None, :]).reshape(len(part), -1)
        last = (_lagrange(part[:, d - 1], n)[:, :, None] * values[:, None, :]).reshape(len(part), -1)
        total += table.T @ last
    return total


def _from_nodes(q: np.ndarray, centre: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    """Sums at the asking rows ``q`` over a crowded cube; one matrix product for each dimension."""
    nodes = np.cos((2 * np.arange(n) + 1) * np.pi / (2 * n)) * SIDE / 2
    rest = None
    for j in range(q.shape[1]):
        near = np.exp(-((q[:, j, None] - centre[j] - nodes) ** 2) / 2)
        rest = near @ weights.reshape(n, -1) if rest is None else np.einsum("qi,qir->qr", near, rest.reshape(len(q), n, -1))
    return rest


def _from_points(q: np.ndarray, points: np.ndarray) -> np.ndarray:
    d = q.shape[1]
    square = np.zeros((len(q), len(points)))
    for j in range(d):
        square += (q[:, j, None] - points[None, :, j]) ** 2
    return np.exp(-square / 2) @ points[:, d:]


def _arrays(column: pa.ListArray) -> Iterator[np.ndarray]:
    flat, off = column.flatten().to_numpy(), column.offsets.to_numpy()
    off = off - off[0]
    return (flat[i:j] for i, j in zip(off[:-1], off[1:]))


def _summed(batches: Iterator[pa.RecordBatch], d: int, n: int) -> Iterator[pa.RecordBatch]:
    """Node weights of each part of a crowded cube."""
    for batch in batches:
        cells, found = [], []
        for cell, flat in zip(batch.column(0).to_pylist(), _arrays(batch.column(1))):
            rows = flat.reshape(-1, d + 2)
            local = (rows[:, :d] / SIDE - np.array(cell)) * 2 - 1
            cells.append(cell)
            found.append(_node_weights(local, rows[:, d:], n).ravel())
        yield pa.record_batch([pa.array(cells, pa.list_(pa.int64())), pa.array(found, pa.list_(pa.float64()))], names=["_s", "_flat"])


def _scored(batches: Iterator[pa.RecordBatch], d: int, n: int) -> Iterator[pa.RecordBatch]:
    """Both sums of each asking row of a block over one block of training rows."""
    names = [*[f"_x{j}" for j in range(d)], "_a", "_b"]
    for batch in batches:
        parts = []
        for asking, cell, crowded, flat in zip(_arrays(batch.column(0)), batch.column(1).to_pylist(), batch.column(2).to_pylist(), _arrays(batch.column(3))):
            q = asking.reshape(-1, d)
            sums = _from_nodes(q, (np.array(cell) + 0.5) * SIDE, flat, n) if crowded else _from_points(q, flat.reshape(-1, d + 2))
            parts.append(np.hstack([q, sums.reshape(-1, 2)]))
        rows = np.vstack(parts) if parts else np.empty((0, d + 2))
        yield pa.record_batch([pa.array(np.ascontiguousarray(c)) for c in rows.T], names=names)


def _grow(cells: DataFrame, level: int, name: str) -> DataFrame:
    """Cells of a level and the cells that hold them a level up."""
    up = lambda k: F.transform("_cell", lambda c: F.shiftright(c, k))
    return cells.select(up(level).alias(f"_{name}"), up(level + 1).alias(f"_{name}p")).distinct()


def _apart(level: int, widen: int) -> Column:
    """Squared distance between two cubes of a level: the least with ``widen`` -1, the greatest with 1."""
    side = SIDE * 2.0**level
    each = F.zip_with("_q", "_s", lambda a, b: F.pow(F.greatest(F.abs(a - b) + widen, F.lit(0)) * F.lit(side), F.lit(2.0)))
    return F.aggregate(each, F.lit(0.0), lambda total, square: total + square)


def meeting_cubes(asking: DataFrame, holding: DataFrame, levels: int, slack: float) -> DataFrame:
    """Pairs (_q, _s) of cubes whose weights can matter.

    The nearest training row of any asking row in _q is no farther than the least greatest distance between _q and a
    cube that holds rows. What lies so far beyond that all training rows together weigh nothing beside it is left out.
    """
    root = asking.select(F.transform("_cell", lambda c: F.shiftright(c, levels)).alias("_q")).distinct()
    pairs = root.join(holding.select(F.transform("_cell", lambda c: F.shiftright(c, levels)).alias("_s")).distinct(), F.col("_q") == F.col("_s"))
    for level in reversed(range(levels)):
        grown = pairs.withColumnsRenamed({"_q": "_qp", "_s": "_sp"})
        grown = grown.join(_grow(asking, level, "q"), "_qp").join(_grow(holding, level, "s"), "_sp").select("_q", "_s")
        nearest = F.min(_apart(level, 1)).over(Window.partitionBy("_q"))
        kept = grown.withColumn("_nearest", nearest).where(_apart(level, -1) <= F.least(F.lit(VANISHING**2), F.col("_nearest") + slack))
        pairs = kept.drop("_nearest")
        if level and level % LEVELS == 0:
            pairs = cut_lineage(pairs)
    return pairs


def kernel_regression(train: DataFrame, query: DataFrame, features: Sequence[str], target: str, sigma: float, tolerance: float = 1e-12, out: str = "kernel_pred", nodes: int | None = None) -> DataFrame:
    """``query`` with sum w y / sum w as ``out``, w = exp(-|q - t|^2 / (2 sigma^2)).

    One way for narrow, spread and clustered data: equal training rows are summed first, crowded cubes become weights at
    ``nodes`` ^ features points (chosen from ``tolerance`` unless given), all others keep their rows, in blocks. The
    result differs from that of all pairs by about ``tolerance``; a row more than some 20 sigma from all training rows
    may differ by more, for rounding. Rows farther than 38 sigma from all, where every weight is zero, rows with a null
    or non-finite feature, and all rows if nothing was trained get null. Training rows with a null or non-finite feature
    or target take no part. A column of ``query`` named ``out`` is replaced, its others stay as they are. ``query`` is
    checkpointed, as its rows meet their result by their features: a mean computed again may end in another digit.
    """
    query = cut_lineage(query)
    d = len(features)
    n = nodes or _nodes_needed(tolerance)
    xs = [f"_x{j}" for j in range(d)]
    scaled = [(F.col(f).cast("double") / F.lit(float(sigma))).alias(x) for f, x in zip(features, xs)]
    finite = lambda names: " AND ".join(f"abs({c}) < double('Infinity')" for c in names)
    points = train.select(*scaled, F.col(target).cast("double").alias("_y")).where(finite([*xs, "_y"]))
    points = points.groupBy(*xs).agg(F.sum("_y").alias("_y"), F.count(F.lit(1)).cast("double").alias("_n"))
    asked = query.select(*scaled).where(finite(xs)).distinct()
    points, asked = cut_lineage(points), cut_lineage(asked)
    both = points.select(*xs, "_n").unionByName(asked.withColumn("_n", F.lit(0.0)))
    ends = both.agg(*[F.min(x) for x in xs], *[F.max(x) for x in xs], F.sum("_n")).first()
    if ends[0] is None:
        return query.withColumn(out, F.lit(None).cast("double"))
    low, high, mass = ends[:d], ends[d : 2 * d], max(ends[2 * d], 1.0)
    levels = max(int((last - base) / SIDE).bit_length() for base, last in zip(low, high))
    moved = [(F.col(x) - base).alias(x) for x, base in zip(xs, low)]
    cell = F.array(*[F.floor(F.col(x) / SIDE) for x in xs]).alias("_cell")
    points = points.select(*moved, "_y", "_n").select("*", cell)
    asked = asked.select(*moved).select("*", cell)

    holding, asking = [cut_lineage(side.groupBy("_cell").agg(F.count(F.lit(1)).alias("_size"))) for side in (points, asked)]
    pairs = meeting_cubes(asking.select("_cell"), holding.select("_cell"), levels, 2 * math.log(mass / tolerance))

    def dealt(rows: DataFrame, sizes: DataFrame, most: Column, cells: list[str]) -> DataFrame:
        """Rows of a cube in blocks of about ``most``, flat."""
        slot = F.pmod(F.xxhash64(*xs), F.ceil(F.col("_size") / most)).alias("_slot")
        held = rows.join(sizes, "_cell").select("_cell", "_size", slot, F.array(*cells).alias("_row"))
        return held.groupBy("_cell", "_size", "_slot").agg(F.flatten(F.collect_list("_row")).alias("_flat"))

    crowded = F.col("_size") > F.lit(float(n) ** d)
    blocks = dealt(points, holding, F.when(crowded, CROWD).otherwise(POINTS), [*xs, "_y", "_n"])
    sparse = blocks.where(~crowded).select(F.col("_cell").alias("_s"), F.lit(False).alias("_crowded"), "_flat")
    parts = blocks.where(crowded).select("_cell", "_flat").mapInArrow(lambda it: _summed(it, d, n), "_s array<bigint>, _flat array<double>")
    summed = parts.select("_s", F.posexplode("_flat").alias("_i", "_w")).groupBy("_s", "_i").agg(F.sum("_w").alias("_w"))
    listed = summed.groupBy("_s").agg(F.array_sort(F.collect_list(F.struct("_i", "_w"))).alias("_l"))
    packets = sparse.unionByName(listed.select("_s", F.lit(True).alias("_crowded"), F.col("_l._w").alias("_flat")))

    wanted = dealt(asked, asking, F.lit(ASKING), xs).select(F.col("_cell").alias("_q"), F.floor(F.col("_slot") / MEETING).alias("_salt"), F.col("_flat").alias("_asked"))
    salts = F.floor((F.ceil(F.col("_size") / ASKING) - 1) / MEETING)
    salted = asking.select(F.col("_cell").alias("_q"), F.explode(F.sequence(F.lit(0).cast("bigint"), salts)).alias("_salt"))
    met = pairs.join(packets, "_s").join(salted, "_q").join(wanted, ["_q", "_salt"]).select("_asked", "_s", "_crowded", "_flat")
    schema = ", ".join(f"{c} double" for c in [*xs, "_a", "_b"])
    scored = met.mapInArrow(lambda it: _scored(it, d, n), schema).groupBy(*xs).agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b")).where("_b > 0")

    # The same arithmetic on both sides, so that equal features give equal keys.
    keys = [(s - base) for s, base in zip([F.col(f).cast("double") / F.lit(float(sigma)) for f in features], low)]
    result = scored.select(*[F.col(x).alias(f"_k{x}") for x in xs], (F.col("_a") / F.col("_b")).alias(f"_k_{out}"))
    on = [key == F.col(f"_k{x}") for key, x in zip(keys, xs)]
    joined = query.drop(out).join(result, on, "left")
    return joined.withColumn(out, F.col(f"_k_{out}")).drop(*[f"_k{x}" for x in xs], f"_k_{out}")
