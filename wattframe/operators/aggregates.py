"""Group aggregates, pivots, completeness, calibration tables, error summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattframe.functions.blocks import BLOCKS_PER_DAY, hour_of_block
from wattframe.functions.scalars import ratio
from wattframe.operators.splits import exact_quantiles


def median(col: str):
    return F.percentile(col, F.lit(0.5))


def block_total(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias(out))


def profile(df: DataFrame, keys: Sequence[str], cols: Sequence[str], middle: str = "median") -> DataFrame:
    """Minimum, maximum and median (or mean) of columns per key."""
    mid = median if middle == "median" else F.avg
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"), mid(c).alias(f"{c}_{middle}")]
    return df.groupBy(*keys).agg(*aggs)


def shape_median(df: DataFrame, keys: Sequence[str], col: str, out: str, spread: bool = False) -> DataFrame:
    """Exact median per calendar group.

    A group of one entity holds one value per date at most and is gathered; for groups over many entities
    ``spread`` finds the median without gathering any.
    """
    if spread:
        return exact_quantiles(df, keys, col, {out: 0.5})
    return df.groupBy(*keys).agg(median(col).alias(out))


def day_completeness(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Blocks with a value per day and whether all 96 are there."""
    return df.groupBy(*keys, "date").agg(F.count(value).alias("present")).withColumn(
        "complete", (F.col("present") == BLOCKS_PER_DAY).cast("int")
    )


def coverage(df: DataFrame, key: str, cols: Sequence[str], keep_above: float = 0.5) -> DataFrame:
    """Non-null counts per group and their share of the largest group, with a keep flag."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"), *[F.count(c).alias(f"n_{c}") for c in cols])
    largest = counts.select(F.max("n_rows")).scalar()
    out = counts.select("*", *[(F.col(f"n_{c}") / largest).alias(f"share_{c}") for c in cols])
    keep = F.least(*[F.col(f"share_{c}") for c in cols]) if len(cols) > 1 else F.col(f"share_{cols[0]}")
    return out.withColumn("keep", (keep > keep_above).cast("int"))


def pivot_cols(df: DataFrame, index: Sequence[str], col: str, values: Sequence, value: str, prefix: str) -> DataFrame:
    """Long to wide for a known value list; repeated cells are averaged."""
    return df.groupBy(*index).agg(
        *[F.avg(F.when(F.col(col) == v, F.col(value))).alias(f"{prefix}{v}") for v in values]
    )


def melt(df: DataFrame, ids: Sequence[str], cols: Sequence[str], name: str, value: str, drop_null: bool = False) -> DataFrame:
    long = df.unpivot(list(ids), list(cols), name, value)
    return long.filter(F.col(value).isNotNull()) if drop_null else long


def hourly_max(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return (
        df.withColumn("hour", hour_of_block(F.col("block_no")))
        .groupBy(*keys, "date", "hour")
        .agg(F.max(value).alias(f"{value}_max"))
    )


def multi_agg(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """min, max and mean of every listed column, names flattened."""
    aggs = [fn(c).alias(f"{c}_{name}") for c in cols for name, fn in (("min", F.min), ("max", F.max), ("mean", F.avg))]
    return df.groupBy(*keys).agg(*aggs)


def bin_calibration(pairs: DataFrame, forecast_bin: str, actual_bin: str, keys: Sequence[str] = ()) -> DataFrame:
    """Share of each actual bin given the forecast bin."""
    counts = pairs.groupBy(*keys, forecast_bin, actual_bin).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(*keys, forecast_bin))
    return counts.withColumn("share", F.col("n") / total)


def expected_bin(calibration: DataFrame, forecast_bin: str, actual_bin: str, keys: Sequence[str] = ()) -> DataFrame:
    return calibration.groupBy(*keys, forecast_bin).agg(
        F.sum(F.col("share") * F.col(actual_bin)).alias("expected_bin")
    )


def with_total(df: DataFrame, keys: Sequence[str], member: str, label: str, sums: Sequence[str], means: Sequence[str]) -> DataFrame:
    """The rows plus one total row per key under a new member label: sums added, means averaged."""
    total = df.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in sums], *[F.avg(c).alias(c) for c in means]
    ).withColumn(member, F.lit(label))
    return df.select(*keys, member, *sums, *means).unionByName(total)


def mape(df: DataFrame, keys: Sequence[str], actual: str, pred: str) -> DataFrame:
    """Mean absolute percentage error, mean absolute error and how many rows have both values."""
    error = F.abs(F.col(actual) - F.col(pred))
    return df.groupBy(*keys).agg(
        F.avg(error / F.nullif(F.abs(F.col(actual)), F.lit(0.0))).alias("mape"),
        F.avg(error).alias("mae"),
        F.count(error).alias("n"),
    )


def describe(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles of groups of any size."""
    moments = df.groupBy(*keys).agg(
        F.count(col).alias("n"), F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"),
        F.min(col).alias("min"), F.max(col).alias("max"),
    )
    quartiles = exact_quantiles(df, keys, col, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    return moments.join(quartiles, list(keys), "left")


def percentage_errors(df: DataFrame, actual: str, pred: str) -> DataFrame:
    return df.withColumn("ape", F.abs(ratio(F.col(actual) - F.col(pred), F.col(actual))))


def position_totals(facts: DataFrame, dims: DataFrame, member: str, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Star join then totals: members of a pool summed per date, block and pool.

    Facts are summed per member first, so the join carries one row per member instead of every fact.
    """
    group = [k for k in keys if k in facts.columns]
    partial = facts.groupBy(*group, member).agg(F.sum(value).alias("_v"))
    return partial.join(dims, member).groupBy(*keys).agg(F.sum("_v").alias(out))


def residual_profile(df: DataFrame, keys: Sequence[str], actual: str, pred: str) -> DataFrame:
    """Mean residual per calendar group."""
    return df.groupBy(*keys).agg(F.avg(F.col(actual) - F.col(pred)).alias("residual"))
