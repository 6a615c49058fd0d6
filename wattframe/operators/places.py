"""Nearest places on the sphere by an adaptive partition of space.

Places are points of the unit sphere in three dimensions, so neither poles nor the date line are special, and the
straight distance orders them as the distance on the ground does. Cubes are halved along each axis, by one count
aggregate a level, until none holds more than ``most`` points. Cubes then meet level by level: a pair goes on only if
the cubes are no farther apart than the farthest that a point of the first can have its k-th neighbour. What is left
are pairs of leaves of at most ``most`` points each, which are compared as blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattframe.functions.scalars import haversine_km
from wattframe.operators.latest import top_k
from wattframe.session import cut_lineage

#: Halvings of the cube of side 2 around the sphere; the smallest cubes are some centimetres of ground wide.
DEPTH = 28
#: Split cells up to which their list is broadcast (a few numbers each).
BROADCAST_CELLS = 50_000
#: Added to squared distances before they are compared, for rounding.
SLACK = 1e-12


def _cell(level: int) -> Column:
    return F.struct(F.lit(level).alias("l"), *[F.shiftright(f"_i{a}", DEPTH - level).alias(a) for a in "xyz"])


def _points(units: DataFrame, key: str, lat: str, lon: str, k: int) -> DataFrame:
    """One row for each distinct place: its smallest key, its k + 1 smallest keys, where it lies."""
    places = units.select(F.col(key).alias("_key"), F.col(lat).cast("double").alias("_lat"), F.col(lon).cast("double").alias("_lon")).where("_lat IS NOT NULL AND _lon IS NOT NULL")
    few = top_k(places, ["_lat", "_lon"], ["_key"], k + 1, "_n").groupBy("_lat", "_lon").agg(F.sort_array(F.collect_list("_key")).alias("_members"))
    a, b = F.radians("_lat"), F.radians("_lon")
    few = few.withColumns({"_x": F.cos(a) * F.cos(b), "_y": F.cos(a) * F.sin(b), "_z": F.sin(a)})
    grid = lambda c: F.least(F.floor((F.col(c) + 1) * 2.0 ** (DEPTH - 1)), F.lit(2**DEPTH - 1)).cast("bigint")
    return few.withColumns({"_p": F.element_at("_members", 1), "_ix": grid("_x"), "_iy": grid("_y"), "_iz": grid("_z")})


def space_cells(points: DataFrame, most: int) -> tuple[DataFrame, DataFrame, int]:
    """Points with the leaf cell they lie in, all cells with their counts and parents, and the number of levels.

    A cell is split while it holds more than ``most`` points; each level is one aggregate over the points of cells split before.
    """
    leaves, cells, open_points, level = None, None, points, 0
    while True:
        here = open_points.withColumn("_cell", _cell(level))
        counts = cut_lineage(here.groupBy("_cell").agg(F.count(F.lit(1)).alias("_count")))
        cells = counts if cells is None else cells.unionByName(counts)
        split = counts.where(F.col("_count") > most).select("_cell")
        number = split.count() if level < DEPTH else 0
        side = F.broadcast(split) if number <= BROADCAST_CELLS else split
        done = here.join(side, "_cell", "left_anti") if number else here
        leaves = done if leaves is None else leaves.unionByName(done)
        if not number:
            break
        open_points = here.join(side, "_cell", "left_semi").drop("_cell")
        level += 1
    parent = F.struct((F.col("_cell.l") - 1).alias("l"), *[F.shiftright(f"_cell.{a}", 1).alias(a) for a in "xyz"])
    return leaves, cells.withColumn("_parent", parent), level


def _side(cell: str) -> Column:
    return F.pow(F.lit(0.5), F.col(f"{cell}.l") - 1)


def _gap(a: str, b: str) -> Column:
    """Squared distance between two cubes."""
    total = F.lit(0.0)
    for axis in "xyz":
        low_a, low_b = F.col(f"{a}.{axis}") * _side(a), F.col(f"{b}.{axis}") * _side(b)
        apart = F.greatest(F.lit(0.0), low_b - low_a - _side(a), low_a - low_b - _side(b))
        total = total + apart * apart
    return total


def _xyz(cells: pa.ListArray) -> tuple[np.ndarray, np.ndarray, pa.StructArray]:
    flat = cells.flatten()
    return np.asarray(cells.offsets) - cells.offsets[0].as_py(), np.stack([np.asarray(flat.field(c)) for c in ("_x", "_y", "_z")], 1), flat


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a[:, None, :] - b[None, :, :]) ** 2).sum(2)


def _own_bounds(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The farthest k-th neighbour inside each leaf, as a squared distance; null for leaves of k points or fewer."""
    for batch in batches:
        off, xyz, _ = _xyz(batch.column(1))
        bound = [float(np.partition(_squares(v, v), k, axis=1)[:, k].max()) if len(v := xyz[i:j]) > k else None for i, j in zip(off[:-1], off[1:])]
        yield pa.record_batch([batch.column(0), pa.array(bound, pa.float64())], names=["a", "_own"])


def meeting_leaves(cells: DataFrame, packed: DataFrame, levels: int, k: int) -> DataFrame:
    """Pairs (a, b) of leaves, b no farther than a point of a may have its k-th neighbour, and that squared distance."""
    kids = cells.where("_cell.l > 0").select("_parent", F.col("_cell").alias("_kid"), "_count")
    root = cells.where("_cell.l = 0").select(F.col("_cell").alias("a"), F.col("_cell").alias("b"), F.lit(4.0).alias("far"))
    pairs = root
    for _ in range(levels):
        grown = pairs.join(kids, F.col("a") == F.col("_parent"), "left")
        # k + 1 points in one cube: each has k others within its diagonal.
        near = 3 * F.pow(F.pow(F.lit(0.5), F.col("_kid.l") - 1), 2)
        grown = grown.select(F.coalesce("_kid", "a").alias("a"), "b", F.when(F.col("_count") > k, F.least(near, "far")).otherwise(F.col("far")).alias("far"))
        grown = grown.where(_gap("a", "b") <= F.col("far") + SLACK)
        grown = grown.join(kids, F.col("b") == F.col("_parent"), "left").select("a", F.coalesce("_kid", "b").alias("b"), "far")
        pairs = cut_lineage(grown.where(_gap("a", "b") <= F.col("far") + SLACK))
    # Inside a leaf the k-th neighbours are known, which is far less than its diagonal.
    own = packed.mapInArrow(lambda it: _own_bounds(it, k), "a struct<l:int,x:bigint,y:bigint,z:bigint>, _own double")
    pairs = pairs.join(own, "a").withColumn("far", F.least("far", "_own")).drop("_own")
    return pairs.where(_gap("a", "b") <= F.col("far") + SLACK)


def packed_leaves(leaves: DataFrame) -> DataFrame:
    """The points of each leaf in one cell."""
    return cut_lineage(leaves.groupBy("_cell").agg(F.collect_list(F.struct("_p", "_lat", "_lon", "_x", "_y", "_z")).alias("_held")))


def _near(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Of each pair of leaves, for each point of the first its k + 1 nearest of the second, ties included, within the bound."""
    for batch in batches:
        (off_a, xyz_a, flat_a), (off_b, xyz_b, flat_b) = _xyz(batch.column(0)), _xyz(batch.column(1))
        left, right = [], []
        for i, far in enumerate(batch.column(2).to_pylist()):
            a, b = xyz_a[off_a[i] : off_a[i + 1]], xyz_b[off_b[i] : off_b[i + 1]]
            d = _squares(a, b)
            last = np.partition(d, k, axis=1)[:, k] if len(b) > k + 1 else np.full(len(a), np.inf)
            x, y = np.nonzero(d <= np.minimum(last, far)[:, None] + SLACK)
            left.append(x + off_a[i])
            right.append(y + off_b[i])
        p, q = flat_a.take(pa.array(np.concatenate(left))), flat_b.take(pa.array(np.concatenate(right)))
        yield pa.record_batch([p.field(c) for c in ("_p", "_lat", "_lon")] + [q.field(c) for c in ("_p", "_lat", "_lon")], names=["_p", "_lat", "_lon", "_q", "_nlat", "_nlon"])


def nearest_units(units: DataFrame, key: str, lat: str, lon: str, k: int = 1, most: int = 128) -> DataFrame:
    """k nearest other units on the sphere: (key, neighbour, distance_km, nn_rank), ties by the smaller neighbour.

    All units of one place count as neighbours at distance 0; a place is searched once, whatever the number of its units.
    No block holds more than ``most`` places (but for more than that within centimetres). Units without a latitude or a
    longitude have no neighbours and are nobody's; an empty table, or one unit, gives no rows. Fewer than k others give as many rows.
    """
    kind = units.schema[key].dataType.simpleString()
    points = cut_lineage(_points(units, key, lat, lon, k))
    leaves, cells, levels = space_cells(points, max(most, k + 1))
    packed = packed_leaves(leaves)
    pairs = meeting_leaves(cells, packed, levels, k)
    blocks = pairs.join(packed.select(F.col("_cell").alias("a"), F.col("_held").alias("_from")), "a").join(packed.select(F.col("_cell").alias("b"), F.col("_held").alias("_to")), "b")
    near = blocks.select("_from", "_to", "far").mapInArrow(lambda it: _near(it, k), f"_p {kind}, _lat double, _lon double, _q {kind}, _nlat double, _nlon double")
    near = near.withColumn("distance_km", F.when(F.col("_p") == F.col("_q"), 0.0).otherwise(haversine_km(F.col("_lat"), F.col("_lon"), F.col("_nlat"), F.col("_nlon"))))
    near = near.join(points.select(F.col("_p").alias("_q"), "_members"), "_q").select("_lat", "_lon", "distance_km", F.explode("_members").alias("neighbour"))
    # The k + 1 nearest of a place, its own units among them, hold the k nearest of each of its units.
    lists = top_k(near, ["_lat", "_lon"], [F.round("distance_km", 9), "neighbour"], k + 1, "_n").drop("_n")
    mine = units.select(F.col(key), F.col(lat).cast("double").alias("_lat"), F.col(lon).cast("double").alias("_lon"))
    met = mine.join(lists, ["_lat", "_lon"]).where(F.col(key) != F.col("neighbour"))
    return top_k(met, [key], [F.round("distance_km", 9), "neighbour"], k, "nn_rank").select(key, "neighbour", "distance_km", "nn_rank")
