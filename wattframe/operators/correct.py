"""Weekday, event and weather-bin corrections, and the event calendar they use.

Factor tables are keyed by calendar groups (month, block, weekday; event, block; bins), so they stay small
however long the history is, and every correction is an equi-join to such a table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattframe.functions.scalars import ratio
from wattframe.operators import repair
from wattframe.operators.aggregates import median
from wattframe.operators.latest import dedupe
from wattframe.operators.splits import exact_quantiles
from wattframe.session import cut_lineage

Smoother = Callable[[DataFrame, Sequence[str], str, str, str], DataFrame]


def no_smoothing(df: DataFrame, keys, order: str, col: str, out: str) -> DataFrame:
    return df.withColumn(out, F.col(col))


def savgol_smoother(width: int, degree: int) -> Smoother:
    return lambda df, keys, order, col, out: repair.savgol(df, keys, order, col, width, degree, out)


def envelope_smoother(delta: int, gap: int) -> Smoother:
    """Mean of the upper and the lower spline envelope of each factor curve."""
    return lambda df, keys, order, col, out: repair.envelope(df, keys, order, col, delta, gap, "mean", out)


def add_calendar(df: DataFrame, date: str = "date") -> DataFrame:
    return df.withColumn("month", F.month(date)).withColumn("weekday", F.weekday(date))


# ---- event calendar -----------------------------------------------------------------------------------

def expand_events(events: DataFrame) -> DataFrame:
    """Each event with its eve (``pre_``) and its day after (``post_``); one name per date, the day itself
    before an eve before a day after, then by name."""
    shift = F.col("_s")
    offsets = F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1)))
    prefix = F.when(shift == -1, "pre_").when(shift == 1, "post_").otherwise("")
    spread = events.select("date", "name", offsets.alias("_s")).select(
        F.date_add("date", shift).alias("date"),
        F.concat(prefix, F.col("name")).alias("name"),
        F.when(shift == 0, 0).when(shift == -1, 1).otherwise(2).alias("_p"),
    )
    return dedupe(spread, ["date"], ["_p", "name"]).drop("_p")


def holiday_flags(days: DataFrame, events: DataFrame, weekend: Sequence[int] = (0, 5, 6)) -> DataFrame:
    """Holiday and weekend flags per date; weekend days are weekday numbers with Monday = 0."""
    named = events.select("date", F.lit(1).alias("_h")).distinct()
    return days.join(named, "date", "left").select(
        *days.columns,
        F.coalesce("_h", F.lit(0)).alias("is_holiday"),
        F.weekday("date").isin(list(weekend)).cast("int").alias("is_weekend"),
    )


# ---- factors ------------------------------------------------------------------------------------------

def weekday_factors(series: DataFrame, keys: Sequence[str], value: str, smooth: Smoother = no_smoothing, fit_before: str | None = None) -> DataFrame:
    """(weekday median - median) / median per month and block, smoothed along the blocks."""
    fitted = add_calendar(series if fit_before is None else series.filter(F.col("date") < F.to_date(F.lit(fit_before))))
    overall = fitted.groupBy(*keys, "month", "block_no").agg(median(value).alias("_all"))
    daily = fitted.groupBy(*keys, "month", "block_no", "weekday").agg(median(value).alias("_day"))
    factor = daily.join(overall, [*keys, "month", "block_no"]).select(
        *keys, "month", "weekday", "block_no", ratio(F.col("_day") - F.col("_all"), F.col("_all")).alias("factor")
    )
    return smooth(factor, [*keys, "month", "weekday"], "block_no", "factor", "weekday_factor")


def weekday_normalise(curves_long: DataFrame, factors: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Take the neighbour day's own weekday effect out of its curve: value x (1 - factor)."""
    f = factors.select(
        *keys, F.col("month").alias("_m"), F.col("weekday").alias("_w"), "block_no", "weekday_factor"
    )
    marked = curves_long.withColumn("_m", F.month("lag_date")).withColumn("_w", F.weekday("lag_date"))
    return (
        marked.join(f, [*keys, "_m", "_w", "block_no"])
        .withColumn(out, F.col(value) * (1 - F.col("weekday_factor")))
        .drop("_m", "_w")
    )


def event_factors(series: DataFrame, events: DataFrame, keys: Sequence[str], value: str, smooth: Smoother = no_smoothing) -> DataFrame:
    """Median over months of event median / month median - 1, per event and block, smoothed."""
    fitted = add_calendar(series)
    overall = fitted.groupBy(*keys, "month", "block_no").agg(median(value).alias("_all"))
    on_event = (
        fitted.join(events, "date").groupBy(*keys, "name", "block_no", "month").agg(median(value).alias("_event"))
    )
    factor = (
        on_event.join(overall, [*keys, "month", "block_no"])
        .withColumn("_f", ratio(F.col("_event"), F.col("_all")) - 1)
        .groupBy(*keys, "name", "block_no")
        .agg(median("_f").alias("factor"))
    )
    return smooth(factor, [*keys, "name"], "block_no", "factor", "event_factor")


def event_normalise(curves_long: DataFrame, events: DataFrame, factors: DataFrame, keys: Sequence[str], value: str, weekday_value: str, out: str) -> DataFrame:
    """Take the neighbour day's event effect out, then keep the smaller of the weekday- and the
    event-corrected value."""
    named = events.select(F.col("date").alias("lag_date"), "name")
    f = factors.select(*keys, "name", "block_no", "event_factor")
    joined = curves_long.join(named, "lag_date", "left").join(f, [*keys, "name", "block_no"], "left")
    corrected = F.col(value) * (1 - F.coalesce(F.col("event_factor"), F.lit(0.0)))
    return joined.withColumn(out, F.least(F.col(weekday_value), corrected))


def weekday_correct(pred: DataFrame, keys: Sequence[str], actual: str, forecast: str, out: str, smooth: Smoother = no_smoothing, additive: bool = False, fit_before: str | None = None) -> DataFrame:
    """Forecast corrected by the weekday's median residual: x (1 + median residual / median forecast), or
    + median residual (additive)."""
    dated = add_calendar(pred)
    fitted = dated if fit_before is None else dated.filter(F.col("date") < F.to_date(F.lit(fit_before)))
    level = fitted.groupBy(*keys, "month", "block_no").agg(median(forecast).alias("_level"))
    residual = fitted.withColumn("_res", F.col(actual) - F.col(forecast))
    shift = residual.groupBy(*keys, "month", "block_no", "weekday").agg(median("_res").alias("_shift"))
    raw = F.col("_shift") if additive else ratio(F.col("_shift"), F.col("_level"))
    factor = shift.join(level, [*keys, "month", "block_no"]).select(
        *keys, "month", "weekday", "block_no", raw.alias("factor")
    )
    table = smooth(factor, [*keys, "month", "weekday"], "block_no", "factor", "_f").drop("factor")
    joined = dated.join(table, [*keys, "month", "weekday", "block_no"], "left")
    corrected = F.col(forecast) + F.col("_f") if additive else F.col(forecast) * (1 + F.col("_f"))
    return joined.withColumn(out, corrected).drop("_f")


def event_correct(pred: DataFrame, events: DataFrame, keys: Sequence[str], actual: str, forecast: str, out: str, smooth: Smoother = no_smoothing) -> DataFrame:
    """Forecast x (1 + median relative residual of the event and block); days without an event keep it."""
    named = pred.join(events.select("date", "name"), "date", "left")
    rel = ratio(F.col(actual) - F.col(forecast), F.col(forecast))
    factor = (
        named.filter(F.col("name").isNotNull())
        .withColumn("_r", rel)
        .groupBy(*keys, "name", "block_no")
        .agg(median("_r").alias("factor"))
        .filter(F.col("factor").isNotNull())
    )
    table = smooth(factor, [*keys, "name"], "block_no", "factor", "_f").drop("factor")
    joined = named.join(table, [*keys, "name", "block_no"], "left")
    return joined.withColumn(out, F.col(forecast) * (1 + F.coalesce("_f", F.lit(0.0)))).drop("_f")


def bias_ladder(pred: DataFrame, events: DataFrame, keys: Sequence[str], actual: str, forecast: str, degree: int = 3, out: str = "corrected") -> DataFrame:
    """Additive bias in three steps, each a mean residual profile fitted by a polynomial over the day:
    weekday, then event, then month. The profiles (96 rows per group) are checkpointed, so each step adds
    one join to the plan and no more."""
    current = add_calendar(pred).join(events.select("date", "name"), "date", "left").withColumn(out, F.col(forecast))
    for group, only in ((["weekday"], None), (["name"], F.col("name").isNotNull()), (["month"], None)):
        rows = current if only is None else current.filter(only)
        mean = rows.groupBy(*keys, *group, "block_no").agg(F.avg(F.col(actual) - F.col(out)).alias("_mean"))
        fitted = cut_lineage(repair.poly_profile(mean, [*keys, *group], "block_no", "_mean", degree, out="_bias").drop("_mean"))
        current = (
            current.join(fitted, [*keys, *group, "block_no"], "left")
            .withColumn(out, F.col(out) + F.coalesce("_bias", F.lit(0.0)))
            .drop("_bias")
        )
    return current


def binned_residual(train: DataFrame, score: DataFrame, keys: Sequence[str], actual: str, forecast: str, out: str) -> DataFrame:
    """Forecast plus the median relative residual of its bin group times the forecast; a group never seen
    in training adds nothing.

    One bin (dry hours) may hold most rows, so the medians are found without gathering a group.
    """
    rel = ratio(F.col(actual) - F.col(forecast), F.col(forecast))
    table = exact_quantiles(train.withColumn("_r", rel), keys, "_r", {"_factor": 0.5})
    joined = score.join(table, list(keys), "left")
    factor = F.coalesce("_factor", F.lit(0.0))
    return joined.withColumn("residual_factor", factor).withColumn(
        out, F.col(forecast) * (1 + factor)
    ).drop("_factor")


def price_bias(pred: DataFrame, events: DataFrame, actual: str, forecast: str, out: str, smooth: Smoother = no_smoothing) -> DataFrame:
    """Weekend then event percentage bias of a price forecast, as medians per (weekend flag, block) and
    (event, block)."""
    weekend = F.weekday("date").isin(5, 6).cast("int")
    marked = pred.withColumn("is_weekend", weekend).withColumn("_r", ratio(F.col(actual), F.col(forecast)) - 1)
    factor = marked.groupBy("is_weekend", "block_no").agg(median("_r").alias("factor"))
    table = smooth(factor, ["is_weekend"], "block_no", "factor", "_f").drop("factor")
    first = marked.drop("_r").join(table, ["is_weekend", "block_no"]).withColumn("_w", F.col(forecast) * (1 + F.col("_f"))).drop("_f")
    return event_correct(first, events, [], actual, "_w", out, smooth).drop("_w")
