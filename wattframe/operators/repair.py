"""Repair and smoothing of block series.

Whole-curve operators gather one entity-day into an array of at most 96 values (or one calendar group of
the same size), work on it with higher-order functions inside the JVM, and spread it out again: one
shuffle on the entity-day. Only the spline envelope and high-degree polynomials leave the JVM.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattframe.functions import curves
from wattframe.functions.curves import last_of
from wattframe.functions.scalars import ratio
from wattframe.operators import splits, windows
from wattframe.session import cut_lineage


def field(name: str) -> Callable[[Column], Column]:
    return lambda x: x[name]


def per_curve(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    inputs: Sequence[str],
    outputs: dict[str, Callable[..., Column]],
) -> DataFrame:
    """Apply array functions to each key's curve.

    Each output function receives the input columns as ordered arrays and returns an array of the same
    length. The result keeps keys, order, inputs and outputs.
    """
    cell = F.struct(F.col(order).alias("_o"), *[F.col(c).alias(f"_{c}") for c in inputs])
    gathered = df.groupBy(*keys).agg(F.array_sort(F.collect_list(cell)).alias("_cells"))
    arrays = {c: F.transform("_cells", field(f"_{c}")) for c in inputs}
    gathered = gathered.select(
        *keys,
        F.transform("_cells", field("_o")).alias(order),
        *[a.alias(c) for c, a in arrays.items()],
    )
    computed = gathered.select(
        "*", *[fn(*[F.col(c) for c in inputs]).alias(name) for name, fn in outputs.items()]
    )
    return computed.select(*keys, F.inline(F.arrays_zip(order, *inputs, *outputs.keys())))


def median_filter(df: DataFrame, keys, order: str, col: str, width: int, out: str) -> DataFrame:
    """Running median with zeros beyond the ends of each curve."""
    return per_curve(df, keys, order, [col], {out: lambda v: curves.median_filter(v, width)})


def savgol(df: DataFrame, keys, order: str, col: str, width: int, degree: int, out: str) -> DataFrame:
    """Savitzky-Golay smoothing of each curve with mirrored-distance padding."""
    return per_curve(df, keys, order, [col], {out: lambda v: curves.savgol(v, width, degree)})


# ---- envelope -----------------------------------------------------------------------------------------

def mark_extremes(df: DataFrame, keys, order: str, col: str, delta: int, gap: int) -> DataFrame:
    """0/1 columns ``peak`` and ``trough``: values not below (above) those ``delta`` rows away on both
    sides and more than ``gap`` rows past the last one picked. Both ends always count."""

    def picks(values: Column, sign: int) -> Column:
        n = F.size(values)

        def step(state: Column, k: Column) -> Column:
            here = values[k]
            fits = (
                (k < n - delta)
                & ((here - values[F.greatest(k - delta, F.lit(0))]) * sign >= 0)
                & ((here - F.try_element_at(values, F.least(k + delta, n - 1) + 1)) * sign >= 0)
                & (k - state["last"] > gap)
            )
            return F.struct(
                F.when(fits, k).otherwise(state["last"]).alias("last"),
                F.concat(state["out"], F.array(F.coalesce(fits, F.lit(False)).cast("int"))).alias("out"),
            )

        start = F.struct(F.lit(0).alias("last"), F.array(F.lit(1)).alias("out"))
        inner = F.when(n > 2, F.sequence(F.lit(1), n - 2)).otherwise(F.array().cast("array<int>"))
        picked = F.aggregate(inner, start, step, lambda s: s["out"])
        return F.when(n > 1, F.concat(picked, F.array(F.lit(1)))).otherwise(picked)

    return per_curve(
        df, keys, order, [col], {"peak": lambda v: picks(v, 1), "trough": lambda v: picks(v, -1)}
    )


def _not_a_knot(x: np.ndarray, y: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Cubic spline with not-a-knot ends; linear below four points."""
    if len(x) < 4:
        return np.interp(at, x, y)
    h = np.diff(x)
    slope = np.diff(y) / h
    n = len(x)
    system, right = np.zeros((n, n)), np.zeros(n)
    for i in range(1, n - 1):
        system[i, i - 1 : i + 2] = h[i - 1], 2 * (h[i - 1] + h[i]), h[i]
        right[i] = 6 * (slope[i] - slope[i - 1])
    system[0, :3] = h[1], -(h[0] + h[1]), h[0]
    system[-1, -3:] = h[-1], -(h[-2] + h[-1]), h[-2]
    bend = np.linalg.solve(system, right)
    i = np.clip(np.searchsorted(x, at, side="right") - 1, 0, n - 2)
    t = at - x[i]
    return y[i] + t * (slope[i] - h[i] * (2 * bend[i] + bend[i + 1]) / 6 + t * (bend[i] / 2 + t * (bend[i + 1] - bend[i]) / (6 * h[i])))


def envelope(df: DataFrame, keys, order: str, col: str, delta: int, gap: int, which: str = "upper", out: str = "envelope") -> DataFrame:
    """Spline through the picked peaks (upper), troughs (lower), or the mean of both splines per curve.

    Extremes are picked in the JVM; the spline runs on Arrow batches, one curve at a time.
    """
    marked = mark_extremes(df, keys, order, col, delta, gap)
    kept = [f for f in marked.schema.fields if f.name in (*keys, order, col)]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + f", `{out}` double"

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        y = pdf[col].to_numpy(dtype=float)
        at = np.arange(len(y), dtype=float)

        def through(flag: str) -> np.ndarray:
            chosen = np.flatnonzero(pdf[flag].to_numpy() == 1)
            return _not_a_knot(chosen.astype(float), y[chosen], at)

        if which == "upper":
            fitted = through("peak")
        elif which == "lower":
            fitted = through("trough")
        else:
            fitted = (through("peak") + through("trough")) / 2
        return pdf[[f.name for f in kept]].assign(**{out: fitted})

    return marked.groupBy(*keys).applyInPandas(fit, schema)


def hull_correct(df: DataFrame, keys, order, value: str, hull: str, n: int = 5, out: str = "hull_corrected") -> DataFrame:
    """Envelope raised by the centred rolling mean of the deviation where that is positive."""
    dev = df.withColumn("_dev", F.col(value) - F.col(hull))
    rolled = windows.rolling(dev, keys, order, "_dev", n, {"_lift": "mean"}, center=True)
    return rolled.withColumn(
        out, F.col(hull) + F.greatest(F.coalesce(F.col("_lift"), F.lit(0.0)), F.lit(0.0))
    ).drop("_dev", "_lift")


# ---- polynomial profile -------------------------------------------------------------------------------

def polynomial_basis(points: int, degree: int) -> np.ndarray:
    """Orthonormal polynomials on an even grid: one row per point, one column per degree."""
    q, _ = np.linalg.qr(np.polynomial.legendre.legvander(np.linspace(-1.0, 1.0, points), degree))
    return q


def poly_profile(df: DataFrame, keys, x: str, y: str, degree: int, points: int = 96, out: str = "fitted") -> DataFrame:
    """Polynomial fit of a complete profile over x = 1..points, evaluated on the same grid.

    On exactly that grid the fit is a constant matrix, applied to the profile array in the JVM. Any other profile,
    shorter or longer, is fitted on the points it has, in Arrow batches; one with no more different points than
    ``degree`` has no such fit and gets null.
    """
    whole = df.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct(F.col(x).alias("x"), F.col(y).alias("y")))).alias("_c"),
        F.count(y).alias("_n"),
    )
    basis = polynomial_basis(points, degree)
    ys = F.transform("_c", lambda c: c["y"])
    columns = [F.array(*[F.lit(float(v)) for v in basis[:, j]]) for j in range(degree + 1)]
    coefficients = F.array(*[curves.dot(ys, c) for c in columns])
    rows = F.array(*[F.array(*[F.lit(float(v)) for v in basis[i]]) for i in range(points)])
    fitted = F.transform(rows, lambda r: curves.dot(r, F.col("_k")))
    on_grid = (F.col("_n") == points) & (F.transform("_c", lambda c: c["x"].cast("int")) == F.sequence(F.lit(1), F.lit(points)))
    whole = whole.withColumn("_grid", F.coalesce(on_grid, F.lit(False)))
    complete = (
        whole.filter("_grid")
        .withColumn("_k", coefficients)
        .select(*keys, F.inline(F.arrays_zip(F.transform("_c", lambda c: c["x"]).alias(x), ys.alias(y), fitted.alias(out))))
        .toDF(*keys, x, y, out)
    )
    partial = whole.filter("NOT _grid").select(*keys, "_c")

    def refit(batches):
        for pdf in batches:
            parts = []
            for _, row in pdf.iterrows():
                xs = np.array([c["x"] for c in row["_c"]], dtype=float)
                vs = np.array([np.nan if c["y"] is None else c["y"] for c in row["_c"]], dtype=float)
                ok = np.isfinite(vs)
                if len(np.unique(xs[ok])) <= degree:
                    fit = np.full(len(xs), np.nan)
                else:
                    scaled = (xs - 1) / (points - 1) * 2 - 1
                    k = np.linalg.lstsq(np.polynomial.legendre.legvander(scaled[ok], degree), vs[ok], rcond=None)[0]
                    fit = np.polynomial.legendre.legvander(scaled, degree) @ k
                part = pd.DataFrame({x: xs.astype(int), y: vs, out: fit})
                for key in keys:
                    part[key] = row[key]
                parts.append(part)
            if parts:
                yield pd.concat(parts)[[*keys, x, y, out]].astype({x: "int64"})

    fields = [f for f in whole.schema.fields if f.name in keys]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    schema = (schema + ", " if schema else "") + f"`{x}` long, `{y}` double, `{out}` double"
    refitted = partial.mapInPandas(refit, schema)
    nan_free = refitted.select(*keys, x, *[F.nanvl(F.col(c), F.lit(None)).alias(c) for c in (y, out)])
    return complete.select(*keys, F.col(x).cast("long").alias(x), y, out).unionByName(nan_free)


# ---- carries ------------------------------------------------------------------------------------------

def ratio_carry(df: DataFrame, keys, order, observed: str, reference: str, out: str) -> DataFrame:
    """Positive observations stay; a gap follows the reference curve's ratios from the last observation.

    The product of ratios telescopes, so the gap value is last observation x reference / reference at that
    observation. A gap that opens a key has nothing to follow and stays null.
    """
    seen = F.col(observed) > 0
    upto = splits.upto(keys, order)
    last_obs = F.last(F.when(seen, F.col(observed)), ignorenulls=True).over(upto)
    last_ref = F.last(F.when(seen, F.col(reference)), ignorenulls=True).over(upto)
    return df.withColumn(
        out, F.when(seen, F.col(observed)).otherwise(last_obs * ratio(F.col(reference), last_ref))
    )


def event_carry(df: DataFrame, keys, order: str, observed: str, curve: str, out: str) -> DataFrame:
    """As ``ratio_carry`` where only block-on-block ratios are known: each gap multiplies on."""
    def fold(values: Column, ratios: Column) -> Column:
        def step(acc: Column, cell: Column) -> Column:
            prev = last_of(acc)
            return F.concat(acc, F.array(F.when(cell["v"] > 0, cell["v"]).otherwise(prev * cell["r"])))

        cells = F.zip_with(values, ratios, lambda v, r: F.struct(v.alias("v"), r.alias("r")))
        return F.aggregate(cells, F.array().cast("array<double>"), step)

    return per_curve(df, keys, order, [observed, curve], {out: fold})


def mean_shape(df: DataFrame, keys, group: Sequence[str], order: str, value: str, out: str) -> DataFrame:
    """Mean block-on-block ratio per group and block; the first block takes the second one's."""
    shaped = windows.shape_ratio(df, keys, [order], value, "_s")
    mean = shaped.groupBy(*group, order).agg(F.avg("_s").alias("_m"))
    follow = F.lead("_m").over(Window.partitionBy(*group).orderBy(order))
    first = F.row_number().over(Window.partitionBy(*group).orderBy(order)) == 1
    return mean.select(*group, order, F.when(first, follow).otherwise(F.col("_m")).alias(out))


def bounded_carry(df: DataFrame, keys, order: str, value: str, shape: str, cap: str, out: str) -> DataFrame:
    """First value, then previous result x ratio, never above the cap."""
    def fold(values: Column, ratios: Column, caps: Column) -> Column:
        cells = F.zip_with(ratios, caps, lambda r, c: F.struct(r.alias("r"), c.alias("c")))

        def step(acc: Column, cell: Column) -> Column:
            prev = F.element_at(acc, -1)
            return F.concat(acc, F.array(F.least(prev * cell["r"], cell["c"])))

        rest = F.slice(cells, 2, F.greatest(F.size(cells) - 1, F.lit(0)))
        return F.aggregate(rest, F.slice(values, 1, 1), step)

    return per_curve(df, keys, order, [value, shape, cap], {out: fold})


def impute_spatial(df: DataFrame, nearest: DataFrame, place: str, date: str, hour: str, value: str, out: str) -> DataFrame:
    """A missing reading takes the nearest place that has one at the same hour, then the centred rolling
    median of 7 days at that hour. ``nearest`` holds (place, neighbour, nn_rank), nearest first."""
    have = df.filter(F.col(value).isNotNull()).select(
        F.col(place).alias("neighbour"), date, hour, F.col(value).alias("_nv")
    )
    missing = df.filter(F.col(value).isNull()).select(place, date, hour)
    found = (
        missing.join(nearest, place)
        .join(have, ["neighbour", date, hour])
        .groupBy(place, date, hour)
        .agg(F.min_by("_nv", "nn_rank").alias("_nn"))
    )
    filled = df.join(found, [place, date, hour], "left").withColumn("_f", F.coalesce(F.col(value), F.col("_nn")))
    rolled = windows.rolling(filled, [place, hour], [date], "_f", 7, {"_roll": "median"}, center=True)
    return rolled.withColumn(out, F.coalesce("_f", "_roll")).drop("_nn", "_f", "_roll")


def shape_outlier(df: DataFrame, keys, order, value: str, threshold: float = 0.05) -> DataFrame:
    """Ratio previous/current against its centred 3-median: ``outlier`` flag and the cleaned ratio."""
    spec = windows.over(keys, order)
    shaped = df.withColumn("shape", ratio(F.lag(value).over(spec), F.col(value)))
    rolled = windows.rolling(shaped, keys, order, "shape", 3, {"_mid": "median"}, center=True)
    outlier = F.coalesce(F.abs(F.col("shape") - F.col("_mid")) > threshold, F.lit(False))
    return (
        rolled.withColumn("outlier", outlier.cast("int"))
        .withColumn("clean_shape", F.when(F.col("outlier") == 1, F.col("_mid")).otherwise(F.col("shape")))
        .drop("_mid")
    )


def fill_from_day_before(df: DataFrame, keys, slot: str, date: str, value: str, out: str) -> DataFrame:
    """Missing values take the nearest earlier day's value of the same slot: the fixpoint of filling from
    one day before again and again."""
    return windows.ffill(df, [*keys, slot], [date], value, out)


def rebuild_from_ratio(df: DataFrame, keys, order: str, value: str, shape: str, cap: float, out: str) -> DataFrame:
    """Value rebuilt as previous value / ratio, where the previous value is the known one if present and
    else the rebuilt one; never above the cap. The first row keeps its value."""
    def fold(values: Column, ratios: Column) -> Column:
        index = F.sequence(F.lit(1), F.size(values))
        cells = F.transform(index, lambda i: F.struct(
            F.try_element_at(values, i).alias("v"), F.try_element_at(ratios, i).alias("r"),
            F.when(i > 1, F.try_element_at(values, F.greatest(i - 1, F.lit(1)))).alias("p"), i.alias("i"),
        ))

        def step(acc: Column, cell: Column) -> Column:
            prev = F.coalesce(cell["p"], last_of(acc))
            rebuilt = prev / F.nullif(cell["r"], F.lit(0.0))
            fresh = F.when(cell["i"] == 1, cell["v"]).otherwise(
                F.when(rebuilt.isNotNull(), F.least(rebuilt, F.lit(float(cap))))
            )
            return F.concat(acc, F.array(fresh))

        return F.aggregate(cells, F.array().cast("array<double>"), step)

    return per_curve(df, keys, order, [value, shape], {out: fold})


def smooth_until(
    df: DataFrame, keys, order, value: str, target: str, tol: float = 0.001, max_iter: int = 100, out: str = "smooth", split: str | None = None, size: int = 10_000
) -> DataFrame:
    """Repeat a centred 5-mean until the mean absolute percentage error against ``target`` moves by at most ``tol``.

    A key's rows are one series in ``order``, over midnight too; ``split`` is a column that grows with the order (the first
    of it unless given). The series is numbered once and smoothed by pieces of ``size`` rows that share two rows
    with each neighbour. Every pass takes the two outermost values off each end of a series, as a full window needs five
    rows; nothing else becomes null, and a series of four rows or fewer has no smooth values. The error is the mean
    over all rows with a smooth value and a target, one aggregate a pass, whose one number decides whether to go on.
    """
    keys = list(keys)
    placed = cut_lineage(splits.with_position(df, keys, order, split or list(order)[0]))
    mean = lambda spec: F.when(F.count("_v").over(spec.rowsBetween(-2, 2)) == 5, F.avg("_v").over(spec.rowsBetween(-2, 2)))

    def smoothed(series: DataFrame) -> DataFrame:
        return splits.framed_at(series, keys, 2, 2, {"_next": mean}, size).drop("_v").withColumnRenamed("_next", "_v")

    current = smoothed(placed.select(*keys, "_pos", F.col(value).alias("_v"), F.col(target).alias("_t")))
    last = None
    for _ in range(max_iter):
        current = cut_lineage(smoothed(current))
        error = current.agg(F.avg(F.abs(ratio(F.col("_t"), F.col("_v")) - 1))).first()[0]
        if error is None or (last is not None and abs(last - error) <= tol):
            break
        last = error
    return splits.join_carry(placed, current.select(*keys, "_pos", F.col("_v").alias(out)), [*keys, "_pos"]).drop("_pos")


def window_hull(df: DataFrame, keys, order: str, value: str, window: int = 6, width: int = 35, degree: int = 2, out: str = "hull") -> DataFrame:
    """Largest value of each group of blocks, then Savitzky-Golay over the day."""
    group = F.ceil(F.col(order) / window)
    top = df.withColumn("_top", F.max(value).over(Window.partitionBy(*keys, group)))
    smoothed = savgol(top, keys, order, "_top", width, degree, out)
    return smoothed.withColumnRenamed("_top", "window_max")


def stitch(actual: DataFrame, forecast: DataFrame, order: Sequence[str] = ("date", "hour")) -> DataFrame:
    """Actuals up to the last actual hour, forecasts after it."""
    last = actual.select(F.max(F.struct(*order))).scalar()
    tail = forecast.filter(F.coalesce(F.struct(*order) > last, F.lit(True)))
    return actual.withColumn("data_type", F.lit("ACTUAL")).unionByName(
        tail.withColumn("data_type", F.lit("FORECAST"))
    )


def daylight(df: DataFrame, date: str, block: str, lat: Column, lon: Column, utc_offset_hours: float, out: str = "daylight") -> DataFrame:
    """1 for blocks between sunrise and sunset by solar declination (no equation-of-time tables)."""
    angle = 2 * np.pi / 365 * (F.dayofyear(date) - 81)
    declination = F.radians(F.lit(23.45)) * F.sin(angle)
    cos_hour = -F.tan(F.radians(lat)) * F.tan(declination)
    half_day = F.degrees(F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), cos_hour)))) / 15
    noon = 12 - (lon - 15 * utc_offset_hours) / 15
    middle = (F.col(block) - 0.5) / 4
    return df.withColumn(out, middle.between(noon - half_day, noon + half_day).cast("int"))


def observed_daylight(df: DataFrame, keys, value: str, out: str = "daylight") -> DataFrame:
    """1 between the first and the last block of a day with a positive value."""
    spec = Window.partitionBy(*keys)
    positive = F.when(F.col(value) > 0, F.col("block_no"))
    inside = F.col("block_no").between(F.min(positive).over(spec), F.max(positive).over(spec))
    return df.withColumn(out, F.coalesce(inside, F.lit(False)).cast("int"))
