"""Day-ahead forecast: rank profile, similar days, blend."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattframe.functions.blocks import BLOCKS_PER_DAY
from wattframe.functions.scalars import ratio
from wattframe.operators import aggregates, series, similar
from wattframe.session import cut_lineage


def _rank_array(profile: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Average ranks of a day's figures among the days of its key, as one array.

    A profile has one row per key and date, so the calendar bounds each window. Rank and ties share one
    sort per figure.
    """
    ranks = []
    for c in cols:
        spec = Window.partitionBy(*keys).orderBy(c)
        ties = F.count(F.lit(1)).over(spec.rangeBetween(Window.currentRow, Window.currentRow))
        ranks.append(F.rank().over(spec) + (ties - 1) / 2)
    return profile.select(*keys, "date", F.array(*[r.cast("double") for r in ranks]).alias("vector"))


def rank_profile(series_df: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Ranks of each day's minimum, maximum and median."""
    profile = aggregates.profile(series_df, [*keys, "date"], [value])
    return _rank_array(profile, keys, [f"{value}_min", f"{value}_max", f"{value}_median"])


def weather_rank_profile(weather: DataFrame, place: str = "location", col: str = "temp") -> DataFrame:
    """Ranks of each location's daily minimum, maximum and median, all locations in one vector per date.

    Dates on which a location is missing have no comparable vector and are left out.
    """
    profile = aggregates.profile(weather, [place, "date"], [col])
    ranked = _rank_array(profile, [place], [f"{col}_min", f"{col}_max", f"{col}_median"])
    cells = F.array_sort(F.collect_list(F.struct(place, "vector")))
    whole = weather.select(F.count_distinct(place)).scalar()
    days = ranked.groupBy("date").agg(F.transform(cells, lambda x: x["vector"]).alias("_v")).filter(F.size("_v") == whole)
    return days.select("date", F.flatten("_v").alias("vector"))


def curve_rank_profile(days: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rank_profile`` from day curves."""
    known = F.array_sort(F.filter("curve", lambda x: x.isNotNull()))
    n = F.size("_k")
    middle = (F.try_element_at("_k", F.floor((n + 1) / 2).cast("int")) + F.try_element_at("_k", F.floor(n / 2 + 1).cast("int"))) / 2
    figures = days.select(*keys, "date", known.alias("_k")).filter(F.size("_k") > 0).select(
        *keys, "date", F.col("_k")[0].alias("low"), F.element_at("_k", -1).alias("high"), middle.alias("mid")
    )
    return _rank_array(figures, keys, ["low", "high", "mid"])


def similar_day_forecast(series_df: DataFrame, keys: Sequence[str], value: str = "value", lookback: int = 90, k: int = 7, t: float = 0.45) -> DataFrame:
    """Blend of the k most similar earlier days beside the actual and its percentage error.

    The series is shuffled once, into day curves, which are checkpointed because three steps read them;
    profile, neighbours and blend work on one row per day.
    One neighbour more than k stands by for blocks without a reading; what it cannot fill is a null forecast, and so
    are days with fewer than k neighbours. Every reading of the input is in the result.
    """
    days = cut_lineage(similar.day_curves(series_df, keys, value))
    nn = similar.similar_days(curve_rank_profile(days, keys), keys, "vector", "sqeuclid", lookback, k + 1)
    forecast = similar.blended_curves(nn, days, keys, k, t)
    joined = days.join(forecast, [*keys, "date"], "left").withColumn("blend", F.coalesce("blend", F.array().cast("array<double>")))
    zipped = F.arrays_zip(
        F.sequence(F.lit(1), F.lit(BLOCKS_PER_DAY)).alias("block_no"), F.col("curve").alias(value), F.col("blend").alias("forecast")
    )
    rows = joined.select(*keys, "date", F.inline(zipped)).filter(F.col(value).isNotNull())
    return rows.withColumn("ape", F.abs(ratio(F.col(value) - F.col("forecast"), F.col(value))))


def impute_blend(grid: DataFrame, observed: DataFrame, value: str = "value", lookback: int = 90, k: int = 7, t: float = 0.45) -> DataFrame:
    """Gaps filled from the blend of similar days."""
    nn = similar.similar_days(rank_profile(observed, [], value), [], "vector", "sqeuclid", lookback, k)
    blended = similar.blend(similar.neighbour_curves(nn, observed, [], value), [], value, k, t, "_blend")
    joined = grid.join(blended, ["date", "block_no"], "left").withColumn("filled", F.col(value))
    return series.fill_from(joined, "filled", "_blend").drop("_blend")
