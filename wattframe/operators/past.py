"""Nearest earlier windows over a whole past, by a lower bound and a proof.

A vector is summed up by three piecewise means, scaled so that their distance is never above the distance of the vectors.
Windows of one key that lie close in means stand in one block, of one epoch of time; epochs double, so that most of what
is earlier lies in whole earlier epochs. Each block first meets the few blocks nearest to it, which gives every window a
k-th distance. The windows of a block whose k-th distances are of one size then meet only those blocks whose box of means
is not farther than that: what is left out is proven to hold none of the k nearest.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattframe.operators.latest import top_k
from wattframe.session import cut_lineage

#: Windows of a block (up to twice as many), and of the first epoch.
BLOCK = 64
PIECES = 3
#: Halvings of each mean's range in the order of windows.
BITS = 7
#: Distances are ranked as rounded to nine decimals.
ROUNDING = 2e-9


def _means(vector: Column) -> Column:
    """The piecewise means, each times the root of its length."""
    n = F.size(vector)
    parts = []
    for p in range(PIECES):
        start, end = F.floor(n * p / PIECES).cast("int"), F.floor(n * (p + 1) / PIECES).cast("int")
        long = end - start
        total = F.aggregate(F.slice(vector, start + 1, F.greatest(long, F.lit(0))), F.lit(0.0), lambda a, x: a + x)
        parts.append(F.when(long > 0, total / F.sqrt(long)).otherwise(0.0))
    return F.array(*parts)


def _order(ranges: Sequence[tuple[Column, Column, Column]]) -> Column:
    """Place on a Z-shaped curve through the means."""
    place = F.lit(0).cast("bigint")
    for p, (x, low, high) in enumerate(ranges):
        slot = F.when(high > low, F.least(F.floor((x - low) / (high - low) * 2**BITS), F.lit(2**BITS - 1))).otherwise(0).cast("bigint")
        for b in range(BITS):
            place = place + F.shiftleft(F.shiftright(slot, b).bitwiseAND(F.lit(1)), PIECES * b + p)
    return place


def windows_in_blocks(df: DataFrame, keys: Sequence[str], index: str, vector: str, metric: str) -> tuple[DataFrame, DataFrame]:
    """Rows (_g, _e, _b, _i, _v, _s) with group, epoch, block, index, vector and means, and the keys of each group.

    A group is a key and a length of vectors. Rows whose vector is null or holds a null or non-finite cell, and with
    cosine those of length zero, take no part.
    """
    v = F.transform(vector, lambda x: x.cast("double"))
    rows = df.select(*keys, F.col(index).cast("long").alias("_i"), v.alias("_v"), F.size(vector).alias("_n"))
    rows = rows.where("_i IS NOT NULL AND _v IS NOT NULL AND forall(_v, x -> x IS NOT NULL AND abs(x) < double('Infinity'))")
    means = _means(F.col("_v"))
    if metric == "cosine":
        rows = rows.withColumn("_norm", F.sqrt(F.aggregate("_v", F.lit(0.0), lambda a, x: a + x * x))).where("_norm > 0")
        means = _means(F.transform("_v", lambda x: x / F.col("_norm")))
    rows = cut_lineage(rows.select(*keys, "_i", "_v", "_n", means.alias("_s")))
    ends = [f(F.col("_s")[p]).alias(f"_{f.__name__}{p}") for p in range(PIECES) for f in (F.min, F.max)]
    groups = cut_lineage(rows.groupBy(*keys, "_n").agg(F.min("_i").alias("_first"), *ends).withColumn("_g", F.monotonically_increasing_id()))
    same = [rows[c].eqNullSafe(groups[c]) for c in [*keys, "_n"]]
    on = same[0]
    for s in same[1:]:
        on = on & s
    after = F.col("_i") - F.col("_first")
    place = _order([(F.col("_s")[p], F.col(f"_min{p}"), F.col(f"_max{p}")) for p in range(PIECES)])
    rows = rows.join(groups, on).select(
        "_g", F.floor(F.log2(after / BLOCK + 1)).cast("int").alias("_e"), "_i", "_v", "_s", place.alias("_m"), F.floor(after / BLOCK).alias("_t"),
    )
    # Of one place and one stretch of time there are at most BLOCK rows, so no place is too full for a block.
    fine = rows.groupBy("_g", "_e", "_m", "_t").agg(F.count(F.lit(1)).alias("_c"))
    before = F.sum("_c").over(Window.partitionBy("_g", "_e").orderBy("_m", "_t").rowsBetween(Window.unboundedPreceding, -1))
    fine = fine.withColumn("_b", F.floor(F.coalesce(before, F.lit(0)) / BLOCK)).drop("_c")
    return cut_lineage(rows.join(fine, ["_g", "_e", "_m", "_t"]).drop("_m", "_t")), groups


def _described(rows: DataFrame, *more: Column, part: Sequence[str] = ("_g", "_e", "_b")) -> DataFrame:
    """One row for each block: its size, its stretch of time, the box of its means."""
    box = [f(F.col("_s")[p]).alias(f"_{f.__name__}{p}") for p in range(PIECES) for f in (F.min, F.max)]
    return rows.groupBy(*part).agg(F.count(F.lit(1)).alias("_size"), F.min("_i").alias("_from"), F.max("_i").alias("_to"), *box, *more)


def _reach(metric: str, distance: np.ndarray) -> np.ndarray:
    """How far apart the means of vectors at most ``distance`` apart can be."""
    loose = np.maximum(distance, 0) + ROUNDING
    return {"euclid": loose, "sqeuclid": np.sqrt(loose), "cosine": np.sqrt(2 * loose)}[metric] * (1 + 1e-9) + 1e-9


def _apart(low_a, high_a, low_b, high_b) -> np.ndarray:
    return np.sqrt((np.maximum(0, np.maximum(low_b - high_a, low_a - high_b)) ** 2).sum(-1))


def _box(blocks: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    low, high = (blocks[[f"_{f}{p}" for p in range(PIECES)]].to_numpy() for f in ("min", "max"))
    return low, high


def _chosen(pdf: pd.DataFrame, metric: str, k: int) -> pd.DataFrame:
    """Blocks of one group that meet: those nearest to each block, or, for parts of blocks, those ``_far`` does not prove away."""
    whole = pdf[pdf["_far"].isna()].sort_values(["_e", "_b"], ignore_index=True)
    parts = pdf[pdf["_far"].notna()].reset_index(drop=True)
    low, high = _box(whole)
    epoch, size, start, end = (whole[c].to_numpy() for c in ("_e", "_size", "_from", "_to"))

    def nearest(a: int) -> np.ndarray:
        apart = _apart(low[a], high[a], low, high)
        possible = (start < end[a]) & (epoch <= epoch[a])
        met = possible.copy() if epoch[a] == 0 else np.zeros(len(whole), dtype=bool)
        now, past = np.flatnonzero(possible & (epoch == epoch[a])), np.flatnonzero(possible & (epoch < epoch[a]))
        met[now[np.argsort(apart[now], kind="stable")[:3]]] = True
        past = past[np.argsort(apart[past], kind="stable")]
        # Enough whole blocks of the past that each window has k earlier ones, if there are so many.
        met[past[: max(2, int(np.searchsorted(np.cumsum(size[past]), k)) + 1)]] = True
        met[a] = possible[a]
        return met

    asks = whole if parts.empty else parts
    left, right = [], []
    if parts.empty:
        for a in range(len(whole)):
            right.append(np.flatnonzero(nearest(a)))
            left.append(np.full(len(right[-1]), a))
    else:
        place = {block: a for a, block in enumerate(zip(whole["_e"], whole["_b"]))}
        far, (low_of, high_of), last = _reach(metric, parts["_far"].to_numpy()), _box(parts), parts["_to"].to_numpy()
        parents = np.array([place[block] for block in zip(parts["_e"], parts["_b"])])
        for a in np.unique(parents):
            known = nearest(a)
            for p in np.flatnonzero(parents == a):
                open_blocks = (epoch <= epoch[a]) & (start < last[p]) & ~known
                right.append(np.flatnonzero(open_blocks & (_apart(low_of[p], high_of[p], low, high) <= far[p])))
                left.append(np.full(len(right[-1]), p))
    a, b = asks.iloc[np.concatenate(left)], whole.iloc[np.concatenate(right)]
    return pd.DataFrame({**{c: a[c].to_numpy() for c in ("_g", "_e", "_b", "_c")}, "_oe": b["_e"].to_numpy(), "_ob": b["_b"].to_numpy()})


def _parts(rows: DataFrame, bounds: DataFrame) -> DataFrame:
    """Rows with their k-th distance so far and the part of the block they ask in: those whose distance has one power of two."""
    far = F.coalesce("_far", F.lit(float("inf")))
    power = F.when(F.col("_far").isNull(), 9999).otherwise(F.floor(F.log2(F.greatest("_far", F.lit(1e-9))))).cast("int")
    return rows.join(bounds, ["_g", "_i"], "left").withColumns({"_far": far, "_c": power})


def blocks_that_meet(blocks: DataFrame, metric: str, k: int, parts: DataFrame | None = None) -> DataFrame:
    """(_g, _e, _b, _c, _oe, _ob): first the nearest of each block, then what parts of blocks still have to meet."""
    asked = blocks.withColumns({"_c": F.lit(0), "_far": F.lit(None).cast("double")})
    if parts is not None:
        asked = asked.unionByName(_described(parts, F.max("_far").alias("_far"), part=("_g", "_e", "_b", "_c")))
    schema = "_g long, _e int, _b long, _c int, _oe int, _ob long"
    return asked.groupBy("_g").applyInPandas(lambda pdf: _chosen(pdf, metric, k), schema)


def _distances(metric: str, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    from wattframe.operators.similar import _measure

    return _measure(metric, a, b, False)


def _packed(column: pa.ListArray) -> tuple[np.ndarray, dict[str, np.ndarray], np.ndarray]:
    """Offsets of the lists, their rows' fields as flat arrays, and the offsets of the rows' vectors."""
    rows = column.flatten()
    fields = {rows.type.field(f).name: x for f, x in enumerate(rows.flatten())}
    starts = fields["_v"].offsets.to_numpy()
    flat = {name: (x.flatten() if pa.types.is_list(x.type) else x).to_numpy(zero_copy_only=False) for name, x in fields.items()}
    flat["_s"] = flat["_s"].reshape(-1, PIECES)
    return column.offsets.to_numpy() - column.offsets[0].as_py(), flat, starts - (starts[0] if len(starts) else 0)


def _nearest(batches: Iterator[pa.RecordBatch], metric: str, k: int) -> Iterator[pa.RecordBatch]:
    """Of each pair of blocks, for each window of the first its k nearest earlier ones of the second, within its bound."""
    for batch in batches:
        (off_a, a, starts_a), (off_b, b, starts_b) = _packed(batch.column(1)), _packed(batch.column(2))
        parts = []
        for p, group in enumerate(batch.column(0).to_pylist()):
            (r0, r1), (q0, q1) = off_a[p : p + 2], off_b[p : p + 2]
            ia, ib, sa, sb = a["_i"][r0:r1], b["_i"][q0:q1], a["_s"][r0:r1], b["_s"][q0:q1]
            open_rows = np.flatnonzero((_apart(sa, sa, sb.min(0), sb.max(0)) <= _reach(metric, a["_far"][r0:r1])) & (ia > ib.min()))
            if not len(open_rows):
                continue
            va = a["_v"][starts_a[r0] : starts_a[r1]].reshape(r1 - r0, -1)[open_rows]
            vb = b["_v"][starts_b[q0] : starts_b[q1]].reshape(q1 - q0, -1)
            distance = np.where(ib[None, :] < ia[open_rows, None], _distances(metric, va, vb), np.nan)
            order = np.lexsort((np.broadcast_to(-ib, distance.shape), np.round(distance, 9)), axis=1)[:, :k]
            best = np.take_along_axis(distance, order, 1)
            x, y = np.nonzero(np.isfinite(best))
            parts.append((np.full(len(x), group), ia[open_rows[x]], ib[order[x, y]], best[x, y]))
        columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.empty(0, t) for t in (np.int64, np.int64, np.int64, float)]
        yield pa.record_batch([pa.array(c) for c in columns], names=["_g", "_i", "_lag", "distance"])


def _met(pairs: DataFrame, asking: DataFrame, rows: DataFrame, metric: str, k: int) -> DataFrame:
    """The k best of what the pairs of blocks hold: (_g, _i, _lag, distance)."""
    held = asking.groupBy("_g", "_e", "_b", "_c").agg(F.collect_list(F.struct("_i", "_v", "_s", "_far")).alias("_held"))
    other = rows.groupBy("_g", F.col("_e").alias("_oe"), F.col("_b").alias("_ob")).agg(F.collect_list(F.struct("_i", "_v", "_s")).alias("_other"))
    blocks = pairs.join(held, ["_g", "_e", "_b", "_c"]).join(other, ["_g", "_oe", "_ob"]).select("_g", "_held", "_other")
    found = blocks.mapInArrow(lambda it: _nearest(it, metric, k), "_g long, _i long, _lag long, distance double")
    return top_k(found, ["_g", "_i"], [F.round("distance", 9), F.desc("_lag")], k, "_n").drop("_n")


def bounds_of(near: DataFrame, k: int) -> DataFrame:
    """The k-th distance found so far, null where there are fewer."""
    return near.groupBy("_g", "_i").agg(F.when(F.count(F.lit(1)) >= k, F.max("distance")).alias("_far"))


def nearest_in_past(df: DataFrame, keys: Sequence[str], index: str, vector: str, metric: str, k: int) -> DataFrame:
    """The k nearest of all earlier rows: (keys, index, lag_<index>, distance, rank); equal distances rank the later first.

    Exact: pairs that are not compared are proven too far. A key's rows are as many as its calendar has windows; blocks
    of BLOCK rows travel, and one task holds the list of one key's blocks, never its rows. Vectors of different
    length do not compare; rows without an index or with a vector that is null or holds a null or non-finite cell neither
    ask nor are found, nor do zero vectors with cosine. Null keys are a key of their own. An index is held once by a key:
    of repeated rows all are found, and they are asked for as one. Other columns play no part; an empty table gives no rows.
    """
    rows, groups = windows_in_blocks(df, keys, index, vector, metric)
    blocks = cut_lineage(_described(rows))
    whole = rows.withColumns({"_c": F.lit(0), "_far": F.lit(float("inf"))})
    near = cut_lineage(_met(blocks_that_meet(blocks, metric, k), whole, rows, metric, k))
    parts = cut_lineage(_parts(rows, bounds_of(near, k)))
    found = near.unionByName(_met(blocks_that_meet(blocks, metric, k, parts), parts, rows, metric, k))
    best = top_k(found, ["_g", "_i"], [F.round("distance", 9), F.desc("_lag")], k, "rank")
    return best.join(groups.select("_g", *keys), "_g").select(*keys, F.col("_i").alias(index), F.col("_lag").alias(f"lag_{index}"), "distance", "rank")
