"""Binning and scaling; fitted limits are one-row aggregates read as scalar subqueries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattframe.functions.scalars import ratio
from wattframe.operators.splits import exact_quantiles


def bin_expression(x: Column, low: Column, high: Column, n: int) -> Column:
    """Bin of n evenly spaced edges from low to high: 0 below the first edge, i in [edge i, edge i+1),
    n at or above the last."""
    step = (high - low) / (n - 1)
    inner = F.least(F.floor((x - low) / F.nullif(step, F.lit(0.0))) + 1, F.lit(n - 1))
    return (
        F.when(x.isNull(), None).when(x < low, 0).when(x >= high, n).otherwise(inner).cast("int")
    )


def linspace_bin(df: DataFrame, col: str, n: int, fit_on: DataFrame | None = None, out: str | None = None) -> DataFrame:
    """Equal-width bins between the smallest and the largest value of ``fit_on`` (the rows themselves by
    default)."""
    fitted = df if fit_on is None else fit_on
    limits = fitted.agg(F.struct(F.min(col).alias("lo"), F.max(col).alias("hi")).alias("l")).scalar()
    limited = df.withColumn("_l", limits)
    return limited.withColumn(
        out or f"{col}_bin", bin_expression(F.col(col), F.col("_l.lo"), F.col("_l.hi"), n)
    ).drop("_l")


# Fixed edges of the rain amount (mm) and rain probability (%) bins.
RAIN_EDGES = (0, 1, 5, 10, 20)
RAIN_PROBABILITY_EDGES = (0, 10, 20, 30, 40, 50)


def edge_bin(df: DataFrame, col: str, edges: Sequence[float], out: str | None = None) -> DataFrame:
    """Bin by fixed edges: i in [edge i-1, edge i), the last at or above the top edge, 0 when not positive."""
    x = F.col(col)
    ladder = F.when(x.isNull(), None).when(x <= 0, 0)
    for i, edge in enumerate(edges):
        ladder = ladder.when(x < edge, i)
    return df.withColumn(out or f"{col}_bin", ladder.otherwise(len(edges)).cast("int"))


def apply_calibration(df: DataFrame, expected: DataFrame, forecast_bin: str, out: str = "expected_bin", keys: Sequence[str] = ()) -> DataFrame:
    """Forecast bin replaced by its expected actual bin; a bin never seen keeps itself."""
    on = [*keys, forecast_bin]
    table = expected.select(*on, F.col("expected_bin").alias("_e"))
    return df.join(table, on, "left").withColumn(out, F.coalesce("_e", F.col(forecast_bin).cast("double"))).drop("_e")


def interval_bin(df: DataFrame, col: str, train: DataFrame, train_bin: str, out: str = "bin") -> DataFrame:
    """Bin whose observed [min, max] holds the value; one below the lowest or above the highest outside;
    a value between two bins takes the lower one.

    The per-bin limits travel as one array (a bin count, not a row count), so no range join is needed.
    """
    limits = train.filter(F.col(train_bin).isNotNull()).groupBy(train_bin).agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
    table = limits.agg(
        F.array_sort(F.collect_list(F.struct("lo", "hi", F.col(train_bin).alias("b")))).alias("t")
    ).scalar()
    x = F.col(col)
    placed = df.withColumn("_t", table)
    last = F.element_at("_t", -1)
    holding = F.filter("_t", lambda r: r["lo"] <= x)
    value = (
        F.when(x.isNull(), None)
        .when(x < F.col("_t")[0]["lo"], F.col("_t")[0]["b"] - 1)
        .when(x > last["hi"], last["b"] + 1)
        .otherwise(F.try_element_at(holding, F.size(holding))["b"])
    )
    return placed.withColumn(out, value.cast("int")).drop("_t")


def impute_median(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Missing features take the exact median of the fitting rows, found without gathering them."""
    long = (df if fit_on is None else fit_on).select(*cols).unpivot([], list(cols), "feature", "v")
    medians = exact_quantiles(long, ["feature"], "v", {"m": 0.5})
    wide = medians.agg(F.struct(*[F.max(F.when(F.col("feature") == c, F.col("m"))).alias(c) for c in cols]).alias("m"))
    known = df.withColumn("_m", wide.scalar())
    return known.select(*[F.coalesce(F.col(c), F.col(f"_m.{c}")).alias(c) if c in cols else F.col(c) for c in df.columns])


def standardize(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None, constant: bool = True) -> DataFrame:
    """(x - mean) / population deviation, with a constant column of 1; ``<col>_std`` columns are added."""
    fitted = df if fit_on is None else fit_on
    stats = fitted.agg(
        F.struct(
            *[F.avg(c).alias(f"{c}_m") for c in cols], *[F.stddev_pop(c).alias(f"{c}_s") for c in cols]
        ).alias("s")
    ).scalar()
    known = df.withColumn("_s", stats)
    scaled = [ratio(F.col(c) - F.col(f"_s.{c}_m"), F.col(f"_s.{c}_s")).alias(f"{c}_std") for c in cols]
    extra = [F.lit(1.0).alias("const")] if constant else []
    return known.select(*df.columns, *extra, *scaled)


def unstandardize(df: DataFrame, pred: str, target_stats: DataFrame, target: str, out: str) -> DataFrame:
    """Prediction on the standard scale back to units of the target."""
    stats = target_stats.agg(F.struct(F.avg(target).alias("m"), F.stddev_pop(target).alias("s")).alias("s")).scalar()
    known = df.withColumn("_s", stats)
    return known.withColumn(out, F.col(pred) * F.col("_s.s") + F.col("_s.m")).drop("_s")
