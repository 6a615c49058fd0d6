"""Row-number, lag, rolling and fill operators.

``split=None`` uses one plain window per key: right for a cleaned series, which holds at most one row per
entity, date and block, so the calendar bounds a key (about 35,000 rows a year). For raw readings or any
key without such a bound pass ``split``, a column that grows with the order, and the work is cut into
pieces with the same result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattframe.functions.scalars import ratio
from wattframe.operators import splits


def over(keys: Sequence[str], order: Sequence):
    return Window.partitionBy(*keys).orderBy(*order)


def lags(df: DataFrame, keys, order, col: str, steps: Sequence[int], split: str | None = None) -> DataFrame:
    """Previous values of a column by rows, one column per step (``<col>_lag<k>``)."""
    exprs = {f"{col}_lag{k}": (lambda spec, k=k: F.lag(col, k).over(spec)) for k in steps}
    return _near(df, keys, order, split, max(steps), 0, exprs)


def calendar_lags(df: DataFrame, keys, date: str, cols: Sequence[str], days: Sequence[int]) -> DataFrame:
    """Values the given numbers of days earlier, by date and not by row count, so gaps never shift them.

    One pass: every row is offered to the dates that look back at it and the offers are summed up beside
    the row itself, instead of one self-join per lag.
    """
    keys = list(keys)
    offers = F.explode(F.array(*[F.lit(k) for k in (0, *days)])).alias("_k")
    payload = [F.col(c).alias(f"_{c}") for c in cols]
    offered = df.select(*keys, F.col(date).alias("_src"), *payload, offers).select(
        *keys, F.date_add("_src", F.col("_k")).alias(date), "_k", *[f"_{c}" for c in cols]
    )
    aggs = [
        F.max(F.when(F.col("_k") == k, F.col(f"_{c}"))).alias(f"{c}_d{k}") for k in days for c in cols
    ]
    own = [F.max(F.when(F.col("_k") == 0, F.col(f"_{c}"))).alias(c) for c in cols]
    present = F.max((F.col("_k") == 0).cast("int")).alias("_own")
    return offered.groupBy(*keys, date).agg(*own, *aggs, present).filter("_own = 1").drop("_own")


def _frame_aggregate(col: str, fn: str) -> Callable[[object], Column]:
    table = {
        "mean": lambda w: F.avg(col).over(w),
        "median": lambda w: F.percentile(col, F.lit(0.5)).over(w),
        "min": lambda w: F.min(col).over(w),
        "max": lambda w: F.max(col).over(w),
        "std": lambda w: F.when(F.count(col).over(w) > 1, F.stddev_samp(col).over(w)),
        "skew": lambda w: F.when(F.count(col).over(w) > 2, F.nanvl(F.skewness(col).over(w), F.lit(None))),
        "sum": lambda w: F.sum(col).over(w),
    }
    return table[fn]


def rolling(
    df: DataFrame,
    keys,
    order,
    col: str,
    n: int,
    fns: dict[str, str],
    center: bool = False,
    min_periods: int | None = None,
    split: str | None = None,
) -> DataFrame:
    """Rolling statistics over ``n`` rows; ``fns`` maps output names to mean/median/min/max/std/skew/sum.

    Trailing by default. Centred windows of even length lean back (n = 4 covers rows -2..+1). A window
    with fewer than ``min_periods`` values (default ``n``) gives null.
    """
    back = n // 2 if center else n - 1
    ahead = n - 1 - back
    need = n if min_periods is None else min_periods

    def guarded(fn: str):
        def build(spec):
            frame = spec.rowsBetween(-back, ahead)
            value = _frame_aggregate(col, fn)(frame)
            return F.when(F.count(col).over(frame) >= need, value) if need > 0 else value

        return build

    exprs = {name: guarded(fn) for name, fn in fns.items()}
    return _near(df, keys, order, split, back, ahead, exprs)


def ffill(df: DataFrame, keys, order, col: str, out: str | None = None, split: str | None = None) -> DataFrame:
    """Last known value at or before the row."""
    if split is not None:
        filled = splits.carried_last(df, keys, order, split, col, "_filled")
        return filled.withColumn(out or col, F.col("_filled")).drop("_filled")
    return df.withColumn(out or col, F.last(col, ignorenulls=True).over(splits.upto(keys, order)))


def bfill(df: DataFrame, keys, order, col: str, out: str | None = None, split: str | None = None) -> DataFrame:
    """Next known value at or after the row."""
    if split is not None:
        filled = splits.carried_last(df, keys, order, split, col, "_filled", backwards=True)
        return filled.withColumn(out or col, F.col("_filled")).drop("_filled")
    return df.withColumn(out or col, F.first(col, ignorenulls=True).over(splits.onwards(keys, order)))


def fill_down(df: DataFrame, row: str, cols: Sequence[str], keys: Sequence[str] = (), rows_per_piece: int = 10_000) -> DataFrame:
    """Merged header cells: an empty cell takes the cell above it. Long sheets are cut into row ranges."""
    out = df.withColumn("_range", F.floor(F.col(row) / rows_per_piece))
    for c in cols:
        blank = F.nullif(F.trim(F.col(c)), F.lit(""))
        out = ffill(out.withColumn(f"{c}_filled", blank), keys, [row], f"{c}_filled", split="_range")
    return out.drop("_range")


def _near(df: DataFrame, keys, order, split: str | None, preceding: int, following: int, exprs: dict) -> DataFrame:
    """Expressions over frames of fixed reach, by a plain window or by pieces."""
    if split is not None:
        return splits.framed(df, keys, order, split, preceding, following, exprs)
    spec = over(keys, order)
    return df.select("*", *[fn(spec).alias(name) for name, fn in exprs.items()])


def impute_neighbours(df: DataFrame, keys, order, col: str, out: str, split: str | None = None) -> DataFrame:
    """A single gap takes the mean of the values beside it."""
    mean = lambda spec: F.coalesce(F.col(col), (F.lag(col).over(spec) + F.lead(col).over(spec)) / 2)
    return _near(df, keys, order, split, 1, 1, {out: mean})


def lag_features(df: DataFrame, keys, order, col: str, w: int) -> DataFrame:
    """Rolling mean, median, min, max, std and skew over up to ``w`` rows, however few there are."""
    names = ("mean", "median", "min", "max", "std", "skew")
    return rolling(df, keys, order, col, w, {f"{col}_{f}{w}": f for f in names}, min_periods=0)


def running_sum(df: DataFrame, keys, order, col: str, out: str, split: str | None = None) -> DataFrame:
    if split is not None:
        return splits.carried_sum(df, keys, order, split, col, out)
    return df.withColumn(out, F.sum(col).over(splits.upto(keys, order)))


def run_edges(df: DataFrame, keys, order, flag: str, n: int, out: str = "edge", split: str | None = None) -> DataFrame:
    """1 where the last n flags or the next n flags (row included) are all 1.

    A run between n and 2n-3 long keeps unmarked rows in its middle; ``in_run`` marks whole runs.
    """

    def hit(spec):
        past = F.sum(flag).over(spec.rowsBetween(-(n - 1), 0)) == n
        ahead = F.sum(flag).over(spec.rowsBetween(0, n - 1)) == n
        return F.coalesce(past | ahead, F.lit(False)).cast("int")

    return _near(df, keys, order, split, n - 1, n - 1, {out: hit})


def in_run(df: DataFrame, keys, order, flag: str, n: int, out: str = "in_run") -> DataFrame:
    """1 for every row of a run of at least n flags."""
    spec = over(keys, order)
    starts = df.withColumn("_new", (F.coalesce(F.lag(flag).over(spec), F.lit(-1)) != F.col(flag)).cast("int"))
    islands = starts.withColumn("_run", F.sum("_new").over(splits.upto(keys, order)))
    length = F.count(F.lit(1)).over(Window.partitionBy(*keys, "_run"))
    return islands.withColumn(out, ((F.col(flag) == 1) & (length >= n)).cast("int")).drop("_new", "_run")


def shape_ratio(df: DataFrame, keys, order, col: str, out: str = "shape", split: str | None = None) -> DataFrame:
    """Value over the previous value."""
    return _near(df, keys, order, split, 1, 0, {out: lambda spec: ratio(F.col(col), F.lag(col).over(spec))})


def rolling_mad(df: DataFrame, keys, order, residual: str, n: int = 11, out: str = "mad") -> DataFrame:
    """Rolling median of absolute deviations from the rolling mean; the row before fills a missing one."""
    centred = rolling(df, keys, order, residual, n, {"_mean": "mean"})
    deviation = centred.withColumn("_dev", F.abs(F.col(residual) - F.col("_mean")))
    banded = rolling(deviation, keys, order, "_dev", n, {"_mad": "median"})
    filled = F.coalesce(F.col("_mad"), F.lag("_mad").over(over(keys, order)))
    return banded.withColumn(out, filled).drop("_mean", "_dev", "_mad")


def descending_key(df: DataFrame, col: str, out: str = "date_key") -> DataFrame:
    """0 for the newest date, 1 for the one before, and so on.

    Only the distinct dates are numbered in one task; the calendar bounds them.
    """
    dates = df.select(col).distinct()
    numbered = dates.withColumn(out, F.row_number().over(Window.orderBy(F.desc(col))) - 1)
    return df.join(numbered, col)


def window_id(df: DataFrame, order_index: str, n: int) -> DataFrame:
    """Number of the group of n consecutive positions, and the place inside it."""
    i = F.col(order_index)
    return df.withColumn("window_no", (F.floor((i - 1) / n) + 1).cast("int")).withColumn(
        "window_pos", ((i - 1) % n + 1).cast("int")
    )
