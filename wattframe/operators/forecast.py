"""Intraday revision, ensembles, publishing, disaggregation, price bands and learners."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattframe.functions import scalars
from wattframe.functions.blocks import BLOCKS_PER_DAY, day_number
from wattframe.functions.curves import last_of
from wattframe.functions.scalars import ratio
from wattframe.operators import bins, repair, windows
from wattframe.operators.kernel import kernel_regression  # noqa: F401  (a forecast like the others)
from wattframe.session import cut_lineage


# ---- intraday -----------------------------------------------------------------------------------------

def intraday(df: DataFrame, keys: Sequence[str], order: str, forecast: str, observed: str, mrr: float, mode: str = "demand", out: str = "realtime") -> DataFrame:
    """Re-forecast from the last observation along the forecast's shape, pulled to it by ``mrr``.

    With r_t = F_t / F_{t-1} and q the previous observation, or the previous result where none exists:
    demand gives r q + m (F - q), solar gives r q + m (F - r q). Solar runs over daylight (F > 0) and is
    zero elsewhere, starts from a unit observation and treats an observation of zero as missing. The first
    block of a demand run has no block before it and takes the forecast.

    ``keys`` bound one forecast run (an entity and its run date, today and yesterday), so a fold covers at
    most a few hundred blocks.
    """
    solar = mode == "solar"
    rows = df.filter(F.col(forecast) > 0) if solar else df

    def fold(f: Column, q: Column) -> Column:
        index = F.sequence(F.lit(1), F.size(f))
        previous = lambda a, i: F.when(i > 1, F.try_element_at(a, F.greatest(i - 1, F.lit(1))))
        cells = F.transform(
            index,
            lambda i: F.struct(
                F.try_element_at(f, i).alias("f"),
                ratio(F.try_element_at(f, i), previous(f, i)).alias("r"),
                previous(q, i).alias("q"),
                i.alias("i"),
            ),
        )

        def step(acc: Column, c: Column) -> Column:
            prev = last_of(acc)
            if solar:
                lagged = F.when(c["i"] == 1, F.lit(1.0)).otherwise(c["q"])
                shape = F.when(c["i"] == 1, F.lit(0.0)).otherwise(F.coalesce(c["r"], F.lit(1.0)))
                base = shape * F.when(lagged > 0, lagged).otherwise(prev)
                fresh = base + mrr * (c["f"] - base)
            else:
                base = F.coalesce(c["q"], prev)
                fresh = F.when(c["i"] == 1, c["f"]).otherwise(c["r"] * base + mrr * (c["f"] - base))
            return F.concat(acc, F.array(fresh))

        return F.aggregate(cells, F.array().cast("array<double>"), step)

    folded = repair.per_curve(rows, keys, order, [forecast, observed], {out: fold})
    if not solar:
        return folded
    night = df.filter(F.coalesce(F.col(forecast) <= 0, F.lit(True))).select(
        *keys, order, forecast, observed, F.lit(0.0).alias(out)
    )
    return folded.unionByName(night)


def publish_revision(forecast: DataFrame, meta: DataFrame, keys: Sequence[str], as_of: str, start_block: int) -> DataFrame:
    """Revision ranges after publishing: (keys, date, revision, from_block, to_block).

    On the run date the newest range closes before ``start_block`` and the next revision opens there; later
    forecast dates get revision 0 over the whole day. Other ranges stay.
    """
    day = F.to_date(F.lit(as_of))
    on = [*keys, "date"]
    published = forecast.select(*on).distinct().filter(F.col("date") >= day).withColumn("_new", F.lit(1))
    newest = meta.groupBy(*on).agg(F.max("revision").alias("_last"))
    kept = meta.join(published.join(newest, on), on, "left")
    closing = (F.col("date") == day) & F.col("_new").isNotNull() & (F.col("revision") == F.col("_last"))
    kept = kept.withColumn("to_block", F.when(closing, start_block - 1).otherwise(F.col("to_block"))).drop("_new", "_last")
    replaced = published.filter(F.col("date") > day).withColumn("revision", F.lit(0)).select(*on, "revision")
    kept = kept.join(replaced, [*on, "revision"], "left_anti")
    opened = published.join(newest, on, "left").select(
        *on,
        F.when(F.col("date") == day, F.coalesce(F.col("_last"), F.lit(-1)) + 1).otherwise(0).cast("int").alias("revision"),
        F.when(F.col("date") == day, start_block).otherwise(1).cast("int").alias("from_block"),
        F.lit(BLOCKS_PER_DAY).alias("to_block"),
    )
    return kept.select(*on, "revision", "from_block", "to_block").unionByName(opened)


def ensemble(df: DataFrame, models: Sequence[str], how: str, out: str = "ensemble") -> DataFrame:
    """Row-wise median (demand), mean (solar), max (wind) or min over model columns, skipping nulls."""
    pick = {"median": scalars.row_median, "mean": scalars.row_mean, "max": scalars.row_max, "min": scalars.row_min}
    return df.withColumn(out, pick[how]([F.col(m) for m in models]))


def disaggregate(forecast: DataFrame, units: DataFrame, value: str) -> DataFrame:
    """A forecast per unit of capacity spread over the units under contract on each date.

    ``units`` holds (unit, capacity, valid_from, valid_to); ranges are laid out by month.
    """
    from wattframe.operators.series import in_force

    dates = forecast.select("date").distinct()
    active = in_force(dates, units, [], "date", "valid_from", "valid_to")
    return forecast.join(active, "date").withColumn("unit_forecast", F.col(value) * F.col("capacity")).select(
        "date", "block_no", "unit", "unit_forecast"
    )


def time_split(df: DataFrame, days: int, as_of: str | None = None, history: int | None = None) -> DataFrame:
    """Mark rows: 'train' up to ``days`` before the reference date, 'test' after; rows older than
    ``history`` days are left out. The reference date is the last date unless given."""
    end = df.select(F.max("date")).scalar() if as_of is None else F.to_date(F.lit(as_of))
    cut = F.date_sub(end, days)
    kept = df if history is None else df.filter(F.col("date") >= F.date_sub(end, history))
    return kept.withColumn("part", F.when(F.col("date") < cut, "train").otherwise("test"))


# ---- learners -----------------------------------------------------------------------------------------

def _regressor(algo: str, seed: int):
    from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor

    if algo == "linear":
        return LinearRegression(featuresCol="_x", labelCol="_y", predictionCol="_p", solver="normal", regParam=1e-6)
    if algo == "gbt":
        return GBTRegressor(featuresCol="_x", labelCol="_y", predictionCol="_p", maxIter=20, maxDepth=5, stepSize=0.1, seed=seed)
    if algo == "forest":
        return RandomForestRegressor(featuresCol="_x", labelCol="_y", predictionCol="_p", seed=seed)
    raise ValueError(algo)


def _assembled(df: DataFrame, features: Sequence[str]) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=list(features), outputCol="_x", handleInvalid="keep").transform(df)


def residual_regression(train: DataFrame, score: DataFrame, features: Sequence[str], actual: str, base: str, algo: str = "linear", out: str = "learned", clamp: float | None = None) -> DataFrame:
    """Learn actual - base from the features and add the prediction to base.

    Missing features take the training medians and all are scaled by the training moments. Both inputs
    are checkpointed, for fitting reads them several times. No row is left out of the scored result.
    """
    train, score = cut_lineage(train), cut_lineage(score)
    prepared = {}
    for name, part in (("train", train), ("score", score)):
        filled = bins.impute_median(part, features, fit_on=train)
        fitted = bins.standardize(filled, features, fit_on=train, constant=False)
        # A feature without spread says nothing: it is scaled to 0, and its rows stay.
        prepared[name] = fitted.fillna(0.0, [f"{f}_std" for f in features])
    scaled = [f"{f}_std" for f in features]
    learn = prepared["train"].withColumn("_y", F.col(actual) - F.col(base)).filter(F.col("_y").isNotNull())
    model = _regressor(algo, 7).fit(_assembled(learn.select(*scaled, "_y"), scaled))
    scored = model.transform(_assembled(prepared["score"], scaled)).drop("_x", *scaled)
    effect = F.col("_p") if clamp is None else scalars.clamp(F.col("_p"), -clamp, clamp)
    return scored.withColumn(out, F.col(base) + effect).drop("_p")


def load_features(series: DataFrame, keys: Sequence[str], value: str, lag_days: Sequence[int] = (2, 3, 4, 5, 6, 7, 8)) -> DataFrame:
    """Feature frame of the tree model: calendar, load of 2 to 8 days before, log target."""
    lagged = windows.calendar_lags(series, [*keys, "block_no"], "date", [value], lag_days)
    return lagged.select(
        *keys,
        "date",
        "block_no",
        value,
        F.month("date").alias("month"),
        F.weekday("date").alias("weekday"),
        *[f"{value}_d{k}" for k in lag_days],
        F.log1p(F.greatest(F.col(value), F.lit(0.0))).alias("log_target"),
    )


def gbt_forecast(train: DataFrame, score: DataFrame, features: Sequence[str], log_target: str, out: str = "gbt_pred") -> DataFrame:
    """Boosted trees on the log target: two models on the even and the odd training days, averaged after
    the transform is undone."""
    train, score = cut_lineage(train), cut_lineage(score)
    halves = [train.filter(F.pmod(day_number(F.col("date")), F.lit(2)) == half) for half in (0, 1)]
    scored = _assembled(score, features)
    for i, half in enumerate(halves):
        learn = _assembled(half.withColumn("_y", F.col(log_target)).filter(F.col("_y").isNotNull()), features)
        model = _regressor("gbt", 11 + i).fit(learn.select("_x", "_y"))
        scored = model.transform(scored).withColumnRenamed("_p", f"_p{i}")
    return scored.withColumn(out, (F.expm1("_p0") + F.expm1("_p1")) / 2).drop("_x", "_p0", "_p1")


# ---- prices -------------------------------------------------------------------------------------------

def price_returns(prices: DataFrame, keys: Sequence[str], value: str, width: int = 19, degree: int = 3) -> DataFrame:
    """Smoothed price, its day-on-day return per block, the returns of the four days before, weekday
    indicators."""
    from wattframe.functions.blocks import weekday_flags

    smooth = repair.savgol(prices, [*keys, "date"], "block_no", value, width, degree, "smooth")
    slot = [*keys, "block_no"]
    spec = windows.over(slot, ["date"])
    returns = smooth.withColumn("prev_smooth", F.lag("smooth").over(spec)).withColumn(
        "ret", ratio(F.col("smooth"), F.col("prev_smooth")) - 1
    )
    lagged = windows.lags(returns, slot, ["date"], "ret", (1, 2, 3, 4))
    return lagged.select("*", *[c.alias(n) for n, c in weekday_flags(F.col("date")).items()])


def price_forecast(features: DataFrame, as_of: str | None = None, holdout_days: int = 60, out: str = "price_pred") -> DataFrame:
    """Next price = previous smoothed price x (1 + learned return)."""
    names = ["ret_lag1", "ret_lag2", "ret_lag3", "ret_lag4", "is_monday", "is_saturday", "is_sunday"]
    usable = features.dropna(subset=["ret", *names])
    parts = time_split(usable, holdout_days, as_of)
    train = parts.filter("part = 'train'").withColumn("_zero", F.lit(0.0))
    scored = residual_regression(train, parts.withColumn("_zero", F.lit(0.0)), names, "ret", "_zero", "linear", "_ret")
    return scored.withColumn(out, F.col("prev_smooth") * (1 + F.col("_ret"))).drop("_zero", "_ret", "part")


def price_unknown_days(prices: DataFrame, keys: Sequence[str], value: str, days: int, width: int = 19, degree: int = 3, out: str = "price_pred") -> DataFrame:
    """Prices of the ``days`` days after the last known one: (keys, date, block_no, out, ``<out>_smooth``).

    A linear learner takes the day-on-day return from the four before and the weekday; then each block's last state is
    folded over the horizon, every predicted day feeding the next, and a day's curve is smoothed last. The days are
    those after each key's last date; a block that is not quoted on it goes on from its own last price, returns not
    known count as 0, and a block without a smoothed price is left out. No day known, no return to learn from: no
    rows. One row per key and block carries the fold, and only eight coefficients reach the driver.
    """
    keys = list(keys)
    lags = ["ret_lag1", "ret_lag2", "ret_lag3", "ret_lag4"]
    names = [*lags, "is_monday", "is_saturday", "is_sunday"]
    known = cut_lineage(price_returns(prices, keys, value, width, degree).select(*keys, "date", "block_no", "smooth", "ret", *names))
    learn = known.dropna(subset=["ret", *names])
    end = known.groupBy(*keys).agg(F.max("date").alias("_end"))
    state = F.struct("date", "smooth", *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in ["ret", *lags[:3]]])
    last = known.filter(F.col("smooth").isNotNull()).groupBy(*keys, "block_no").agg(F.max(state).alias("_s"))
    if learn.isEmpty():
        last, slopes, intercept = last.limit(0), [0.0] * len(names), 0.0
    else:
        model = _regressor("linear", 7).fit(_assembled(learn.select(*names, F.col("ret").alias("_y")), names))
        slopes, intercept = [float(c) for c in model.coefficients], float(model.intercept)

    def step(acc: Column, ahead: Column) -> Column:
        weekday = F.weekday(F.date_add("_end", ahead))
        flags = sum((F.when(weekday == day, F.lit(slope)).otherwise(0.0) for day, slope in zip((0, 5, 6), slopes[4:])), F.lit(intercept))
        change = sum((acc["past"][i] * slope for i, slope in enumerate(slopes[:4])), flags)
        price = acc["price"] * (1 + change)
        return F.struct(
            price.alias("price"), F.concat(F.array(change), F.slice(acc["past"], 1, 3)).alias("past"),
            F.concat(acc["path"], F.array(price)).alias("path"),
        )

    start = F.struct(
        F.col("_s.smooth").alias("price"), F.array(*[F.col(f"_s.{c}") for c in ["ret", *lags[:3]]]).alias("past"),
        F.array().cast("array<double>").alias("path"),
    )
    if keys:
        folded = last.join(end, [last[k].eqNullSafe(end[k]) for k in keys]).select(*[last[k] for k in keys], "block_no", "_s", "_end")
    else:
        folded = last.withColumn("_end", end.select("_end").scalar())
    path = folded.select(
        *keys, "block_no", "_end", F.aggregate(F.sequence(F.lit(1), F.lit(int(days))), start, step, lambda acc: acc["path"]).alias("_path")
    )
    rows = path.select(*keys, "block_no", "_end", F.posexplode("_path").alias("_i", out))
    rows = rows.select(*keys, F.date_add("_end", F.col("_i") + 1).alias("date"), "block_no", out)
    return repair.savgol(rows, [*keys, "date"], "block_no", out, width, degree, f"{out}_smooth")


def even_alphas(lo: float, hi: float, n: int) -> list[float]:
    """``n`` confidence levels from ``lo`` to ``hi`` in even steps; one alone is ``lo``."""
    return [lo + (hi - lo) * i / max(n - 1, 1) for i in range(n)]


def price_band(df: DataFrame, forecast: str, mad: str, alphas: Sequence[float]) -> DataFrame:
    """Forecast +- z(alpha) x deviation for each alpha, rounded to 3 places."""
    table = F.array(*[
        F.struct(F.lit(i + 1).alias("ladder"), F.lit(float(a)).alias("alpha"), F.lit(scalars.normal_quantile(a)).alias("z"))
        for i, a in enumerate(alphas)
    ])
    spread = df.select("*", F.inline(table))
    return spread.withColumn("ul_price", F.col(forecast) + F.col("z") * F.col(mad)).withColumn(
        "ll_price", F.col(forecast) - F.col("z") * F.col(mad)
    ).drop("z")


def widest_band(bands: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One band per key: the largest upper and lower price."""
    return bands.groupBy(*keys).agg(F.max("ul_price").alias("ul_price"), F.max("ll_price").alias("ll_price"))


