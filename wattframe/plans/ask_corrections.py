"""Registered queries: weekday, event and weather-bin corrections, intraday, ensembles, prices, learners."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from wattframe.functions.scalars import normal_quantile
from wattframe.operators import bins, correct, forecast, similar
from wattframe.plans import day_ahead
from wattframe.plans.ask_basics import MAD_SQL, mad_frame
from wattframe.plans.ask_repair import bin_sql, savgol_sql
from wattframe.plans.ask_similar import RANK_SQL
from wattframe.plans.registry import query
from wattframe.session import shared_folder
from wattframe.sinks import publication

EVENTS_SQL = """
ex AS (SELECT date + s AS date, CASE s WHEN -1 THEN 'pre_' WHEN 1 THEN 'post_' ELSE '' END || name AS name,
 CASE s WHEN 0 THEN 0 WHEN -1 THEN 1 ELSE 2 END AS p FROM v_calendar CROSS JOIN (SELECT CAST(unnest(range(-1, 2)) AS INT) AS s)),
ev AS (SELECT date, name FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY p, name) AS r FROM ex) WHERE r = 1)"""


@query("expanded_events", "date:d name:s", f"WITH {EVENTS_SQL} SELECT date, name FROM ev")
def _(t):
    return correct.expand_events(t.calendar)


@query("holiday_flags", "date:d is_holiday:i is_weekend:i", """
SELECT DISTINCT l.date, CAST(c.date IS NOT NULL AS INT) AS is_holiday, CAST(isodow(l.date) IN (1, 6, 7) AS INT) AS is_weekend
FROM v_load l LEFT JOIN v_calendar c ON c.date = l.date""")
def _(t):
    return correct.holiday_flags(t.load.select("date").distinct(), t.calendar)


FACTOR_SQL = """
a AS (SELECT pool, month(date) AS month, block_no, median(value) AS v FROM v_long GROUP BY 1, 2, 3),
w AS (SELECT pool, month(date) AS month, block_no, isodow(date) - 1 AS weekday, median(value) AS v FROM v_long GROUP BY 1, 2, 3, 4),
fa AS (SELECT w.pool, w.month, w.weekday, w.block_no, (w.v - a.v) / nullif(a.v, 0) AS factor FROM w JOIN a ON a.pool = w.pool AND a.month = w.month AND a.block_no = w.block_no)"""


@query("weekday_factors", "pool:s month:i weekday:i block_no:i smooth:f",
       savgol_sql(f"WITH {FACTOR_SQL} SELECT * FROM fa", "pool, month, weekday", "block_no", "factor", 11, 2))
def _(t):
    table = correct.weekday_factors(t.long_blocks, ["pool"], "value", correct.savgol_smoother(11, 2))
    return table.withColumnRenamed("weekday_factor", "smooth")


@query("weekday_factors_envelope", "pool:s month:i weekday:i block_no:i weekday_factor:f")
def _(t):
    return correct.weekday_factors(t.long_blocks, ["pool"], "value", correct.envelope_smoother(1, 3))


@query("weekday_normalised", "pool:s date:d block_no:i rank:i normal:f", f"""
WITH {RANK_SQL.format(n=30)}, {FACTOR_SQL}
SELECT nn.pool, nn.date, l.block_no, rank, l.value * (1 - factor) AS normal FROM nn JOIN v_long l ON l.pool = nn.pool AND l.date = nn.lag_date
JOIN fa ON fa.pool = nn.pool AND fa.month = month(lag_date) AND fa.weekday = isodow(lag_date) - 1 AND fa.block_no = l.block_no WHERE rank <= 3""")
def _(t):
    nn = similar.similar_days(day_ahead.rank_profile(t.long_blocks, ["pool"]), ["pool"], "vector", "sqeuclid", 30, 3)
    curves = similar.neighbour_curves(nn, t.long_blocks, ["pool"], "value")
    factors = correct.weekday_factors(t.long_blocks, ["pool"], "value")
    return correct.weekday_normalise(curves, factors, ["pool"], "value", "normal")


EVENT_NORMAL_SQL = f"""
WITH {EVENTS_SQL},
p AS (SELECT date, min(value) AS a, max(value) AS b, median(value) AS c FROM v_load GROUP BY 1),
r AS (SELECT date, rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2.0 AS ra, rank() OVER (ORDER BY b) + (count(*) OVER (PARTITION BY b) - 1) / 2.0 AS rb, rank() OVER (ORDER BY c) + (count(*) OVER (PARTITION BY c) - 1) / 2.0 AS rc FROM p),
d AS (SELECT x.date, y.date AS lag_date, pow(x.ra - y.ra, 2) + pow(x.rb - y.rb, 2) + pow(x.rc - y.rc, 2) AS dist FROM r x JOIN r y ON y.date < x.date AND y.date >= x.date - 45),
k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY round(dist, 9), lag_date DESC) AS rank FROM d) WHERE rank <= 3),
a AS (SELECT month(date) AS month, block_no, median(value) AS v FROM v_load GROUP BY 1, 2),
w AS (SELECT month(date) AS month, block_no, isodow(date) - 1 AS weekday, median(value) AS v FROM v_load GROUP BY 1, 2, 3),
fw AS (SELECT w.month, w.weekday, w.block_no, (w.v - a.v) / nullif(a.v, 0) AS factor FROM w JOIN a ON a.month = w.month AND a.block_no = w.block_no),
em AS (SELECT name, block_no, month(date) AS month, median(value) AS v FROM v_load JOIN ev USING (date) GROUP BY 1, 2, 3),
fe AS (SELECT name, em.block_no, median(em.v / nullif(a.v, 0) - 1) AS factor FROM em JOIN a ON a.month = em.month AND a.block_no = em.block_no GROUP BY 1, 2)
SELECT k.date, l.block_no, rank, least(l.value * (1 - fw.factor), l.value * (1 - coalesce(fe.factor, 0))) AS normal
FROM k JOIN v_load l ON l.date = k.lag_date JOIN fw ON fw.month = month(lag_date) AND fw.weekday = isodow(lag_date) - 1 AND fw.block_no = l.block_no
LEFT JOIN ev ON ev.date = k.lag_date LEFT JOIN fe ON fe.name = ev.name AND fe.block_no = l.block_no"""


@query("event_normalised", "date:d block_no:i rank:i normal:f", EVENT_NORMAL_SQL)
def _(t):
    nn = similar.similar_days(day_ahead.rank_profile(t.load, []), [], "vector", "sqeuclid", 45, 3)
    curves = similar.neighbour_curves(nn, t.load, [], "value")
    by_day = correct.weekday_normalise(curves, correct.weekday_factors(t.load, [], "value"), [], "value", "by_weekday")
    events = correct.expand_events(t.calendar)
    return correct.event_normalise(by_day, events, correct.event_factors(t.load, events, [], "value"), [], "value", "by_weekday", "normal")


PRED_SQL = """
pd AS (SELECT pool, date, block_no, value, avg(value) OVER (PARTITION BY pool, block_no, month(date)) + block_no / 8 AS pred FROM v_long)"""


def _predicted(t):
    mean = t.long_blocks.groupBy("pool", "block_no", F.month("date").alias("_m")).agg(F.avg("value").alias("_p"))
    joined = t.long_blocks.withColumn("_m", F.month("date")).join(mean, ["pool", "block_no", "_m"])
    return joined.select("pool", "date", "block_no", "value", (F.col("_p") + F.col("block_no") / 8).alias("pred"))


WEEKDAY_SQL = """
lv AS (SELECT pool, month(date) AS month, block_no, median(pred) AS v FROM pd GROUP BY 1, 2, 3),
rs AS (SELECT pool, month(date) AS month, block_no, isodow(date) - 1 AS weekday, median(value - pred) AS v FROM pd GROUP BY 1, 2, 3, 4)"""


@query("weekday_corrected", "pool:s date:d block_no:i corrected:f", f"""
WITH {PRED_SQL}, {WEEKDAY_SQL} SELECT pd.pool, date, pd.block_no, pred * (1 + rs.v / nullif(lv.v, 0)) AS corrected FROM pd
JOIN lv ON lv.pool = pd.pool AND lv.month = month(date) AND lv.block_no = pd.block_no
JOIN rs ON rs.pool = pd.pool AND rs.month = month(date) AND rs.block_no = pd.block_no AND rs.weekday = isodow(date) - 1""")
def _(t):
    return correct.weekday_correct(_predicted(t), ["pool"], "value", "pred", "corrected")


@query("weekday_corrected_additive", "pool:s date:d block_no:i corrected:f", f"""
WITH {PRED_SQL}, {WEEKDAY_SQL} SELECT pd.pool, date, pd.block_no, pred + rs.v AS corrected FROM pd
JOIN rs ON rs.pool = pd.pool AND rs.month = month(date) AND rs.block_no = pd.block_no AND rs.weekday = isodow(date) - 1""")
def _(t):
    return correct.weekday_correct(_predicted(t), ["pool"], "value", "pred", "corrected", additive=True)


EVENT_PRED_SQL = "pd AS (SELECT date, block_no, value, avg(value) OVER (PARTITION BY block_no) + 1 AS pred FROM v_load)"


def _load_predicted(t):
    mean = t.load.groupBy("block_no").agg((F.avg("value") + 1).alias("pred"))
    return t.load.select("date", "block_no", "value").join(mean, "block_no")


@query("event_corrected", "date:d block_no:i corrected:g", f"""
WITH {EVENTS_SQL}, {EVENT_PRED_SQL},
f AS (SELECT name, block_no, median((value - pred) / nullif(pred, 0)) AS f FROM pd JOIN ev USING (date) GROUP BY 1, 2)
SELECT pd.date, pd.block_no, pred * (1 + coalesce(f, 0)) AS corrected FROM pd LEFT JOIN ev ON ev.date = pd.date LEFT JOIN f ON f.name = ev.name AND f.block_no = pd.block_no""")
def _(t):
    return correct.event_correct(_load_predicted(t), correct.expand_events(t.calendar), [], "value", "pred", "corrected")


@query("bias_ladder", "date:d block_no:i corrected:g")
def _(t):
    return correct.bias_ladder(_load_predicted(t), correct.expand_events(t.calendar), [], "value", "pred")


@query("bias_ladder_linear", "date:d block_no:i corrected:g", f"""
WITH {EVENTS_SQL}, {EVENT_PRED_SQL},
w AS (SELECT wd, regr_slope(m, block_no) AS s, regr_intercept(m, block_no) AS i FROM (SELECT isodow(date) AS wd, block_no, avg(value - pred) AS m FROM pd GROUP BY 1, 2) GROUP BY 1),
p1 AS (SELECT pd.date, block_no, value, pred + i + s * block_no AS c FROM pd JOIN w ON w.wd = isodow(pd.date)),
e AS (SELECT name, regr_slope(m, block_no) AS s, regr_intercept(m, block_no) AS i FROM (SELECT name, block_no, avg(value - c) AS m FROM p1 JOIN ev USING (date) GROUP BY 1, 2) GROUP BY 1),
p2 AS (SELECT p1.date, block_no, value, c + coalesce(i + s * block_no, 0) AS c FROM p1 LEFT JOIN ev ON ev.date = p1.date LEFT JOIN e ON e.name = ev.name
 AND EXISTS (SELECT 1 FROM p1 x JOIN ev y ON y.date = x.date WHERE y.name = e.name AND x.block_no = p1.block_no)),
m AS (SELECT mo, regr_slope(m, block_no) AS s, regr_intercept(m, block_no) AS i FROM (SELECT month(date) AS mo, block_no, avg(value - c) AS m FROM p2 GROUP BY 1, 2) GROUP BY 1)
SELECT p2.date, block_no, c + i + s * block_no AS corrected FROM p2 JOIN m ON mo = month(p2.date)""")
def _(t):
    return correct.bias_ladder(_load_predicted(t), correct.expand_events(t.calendar), [], "value", "pred", degree=1)


@query("binned_residual", "location:i date:d hour:i residual_factor:f corrected:f", f"""
WITH x AS (SELECT location, date, hour, temp, avg(temp) OVER (PARTITION BY location, hour) + 1 AS pred, {bin_sql('wind', 'lo', 'hi', 5)} AS wb
 FROM v_weather, (SELECT min(wind) AS lo, max(wind) AS hi FROM v_weather WHERE date < DATE '2024-01-21')),
f AS (SELECT wb, hour, median((temp - pred) / nullif(pred, 0)) AS f FROM x WHERE date < DATE '2024-01-21' GROUP BY 1, 2)
SELECT location, date, x.hour, coalesce(f, 0) AS residual_factor, pred * (1 + coalesce(f, 0)) AS corrected FROM x LEFT JOIN f ON f.wb = x.wb AND f.hour = x.hour""")
def _(t):
    mean = t.weather.groupBy("location", "hour").agg((F.avg("temp") + 1).alias("pred"))
    train_part = t.weather.filter("date < DATE '2024-01-21'")
    rows = bins.linspace_bin(t.weather, "wind", 5, train_part, "wb").join(mean, ["location", "hour"])
    return correct.binned_residual(rows.filter("date < DATE '2024-01-21'"), rows, ["wb", "hour"], "temp", "pred", "corrected")


@query("binned_residual_rain_lags", "location:i date:d hour:i residual_factor:f", f"""
WITH l AS (SELECT a.location, a.date, a.hour, a.temp, a.rain, b.rain AS rain1 FROM v_weather a LEFT JOIN v_weather b ON b.location = a.location AND b.hour = a.hour AND b.date = a.date - 1),
x AS (SELECT location, date, hour, temp, avg(temp) OVER (PARTITION BY location) AS pred, {bin_sql('rain', 'lo', 'hi', 5)} AS b0, {bin_sql('rain1', 'lo1', 'hi1', 5)} AS b1
 FROM l, (SELECT min(rain) AS lo, max(rain) AS hi, min(rain1) AS lo1, max(rain1) AS hi1 FROM l)),
f AS (SELECT b0, b1, median((temp - pred) / nullif(pred, 0)) AS f FROM x GROUP BY 1, 2)
SELECT location, date, hour, coalesce(f, 0) AS residual_factor FROM x LEFT JOIN f ON f.b0 = x.b0 AND f.b1 = x.b1""")
def _(t):
    from wattframe.operators.windows import calendar_lags

    lagged = calendar_lags(t.weather, ["location", "hour"], "date", ["rain", "temp"], [1])
    mean = t.weather.groupBy("location").agg(F.avg("temp").alias("pred"))
    rows = bins.linspace_bin(bins.linspace_bin(lagged, "rain", 5, out="b0"), "rain_d1", 5, out="b1").join(mean, "location")
    return correct.binned_residual(rows, rows, ["b0", "b1"], "temp", "pred", "corrected")


@query("binned_residual_wind", "location:i date:d hour:i residual_factor:f", f"""
WITH x AS (SELECT location, date, hour, temp, avg(temp) OVER (PARTITION BY location) AS pred, {bin_sql('wind', 'lo', 'hi', 10)} AS b
 FROM v_weather, (SELECT min(wind) AS lo, max(wind) AS hi FROM v_weather)),
f AS (SELECT month(date) AS m, b, median((temp - pred) / nullif(pred, 0)) AS f FROM x GROUP BY 1, 2)
SELECT location, date, hour, coalesce(f, 0) AS residual_factor FROM x LEFT JOIN f ON f.m = month(date) AND f.b = x.b""")
def _(t):
    mean = t.weather.groupBy("location").agg(F.avg("temp").alias("pred"))
    rows = bins.linspace_bin(t.weather, "wind", 10, out="b").join(mean, "location").withColumn("m", F.month("date"))
    return correct.binned_residual(rows, rows, ["m", "b"], "temp", "pred", "corrected")


# ---- intraday and ensembles ---------------------------------------------------------------------------

INTRADAY_SQL = """
WITH RECURSIVE f AS (SELECT g.date, g.block_no, m.v AS f, CASE WHEN g.block_no <= 40 THEN g.value END AS q FROM v_grid g JOIN (SELECT block_no, avg(value) AS v FROM v_load GROUP BY 1) m ON m.block_no = g.block_no),
c AS (SELECT date, block_no, f, f / nullif(lag(f) OVER w, 0) AS r, lag(q) OVER w AS q FROM f WINDOW w AS (PARTITION BY date ORDER BY block_no)),
walk AS (SELECT date, block_no, f AS realtime FROM c WHERE block_no = 1
 UNION ALL SELECT c.date, c.block_no, c.r * coalesce(c.q, walk.realtime) + 0.1 * (c.f - coalesce(c.q, walk.realtime)) FROM walk JOIN c ON c.date = walk.date AND c.block_no = walk.block_no + 1)
SELECT date, block_no, realtime FROM walk"""


def _intraday_input(t):
    mean = t.load.groupBy("block_no").agg(F.avg("value").alias("f"))
    grid = t.grid.join(mean, "block_no")
    return grid.select("date", "block_no", "f", F.when(F.col("block_no") <= 40, F.col("value")).alias("q"))


@query("intraday_demand", "date:d block_no:i realtime:g", INTRADAY_SQL)
def _(t):
    return forecast.intraday(_intraday_input(t), ["date"], "block_no", "f", "q", 0.1)


INTRADAY_SOLAR_SQL = """
WITH RECURSIVE f0 AS (SELECT g.date, g.block_no, CASE WHEN g.block_no BETWEEN 25 AND 76 THEN m.v ELSE 0 END AS f, CASE WHEN g.block_no <= 40 THEN g.value END AS q
 FROM v_grid g JOIN (SELECT block_no, avg(value) AS v FROM v_load GROUP BY 1) m ON m.block_no = g.block_no),
c AS (SELECT date, block_no, f, coalesce(f / nullif(lag(f) OVER w, 0), 1) AS r, lag(q) OVER w AS q FROM f0 WHERE f > 0 WINDOW w AS (PARTITION BY date ORDER BY block_no)),
walk AS (SELECT date, block_no, 0.1 * f AS realtime FROM c WHERE block_no = 25
 UNION ALL SELECT c.date, c.block_no, c.r * CASE WHEN c.q > 0 THEN c.q ELSE walk.realtime END + 0.1 * (c.f - c.r * CASE WHEN c.q > 0 THEN c.q ELSE walk.realtime END)
 FROM walk JOIN c ON c.date = walk.date AND c.block_no = walk.block_no + 1)
SELECT date, block_no, realtime FROM walk UNION ALL SELECT date, block_no, 0 FROM f0 WHERE f <= 0"""


@query("intraday_solar", "date:d block_no:i realtime:g", INTRADAY_SOLAR_SQL)
def _(t):
    daytime = _intraday_input(t).withColumn("f", F.when(F.col("block_no").between(25, 76), F.col("f")).otherwise(0.0))
    return forecast.intraday(daytime, ["date"], "block_no", "f", "q", 0.1, "solar")


@query("published_revisions", "pool:s date:d revision:i from_block:i to_block:i", """
WITH m AS (SELECT pool, date, CAST(count(*) % 4 AS INT) AS last FROM v_pools WHERE date <= DATE '2024-01-20' GROUP BY 1, 2),
meta AS (SELECT pool, date, CAST(unnest(range(0, last + 1)) AS INT) AS revision, last FROM m),
n AS (SELECT DISTINCT pool, date FROM v_pools WHERE date >= DATE '2024-01-20')
SELECT pool, date, revision, 1 AS from_block, CASE WHEN date = DATE '2024-01-20' AND revision = last THEN 44 ELSE 96 END AS to_block FROM meta
UNION ALL SELECT n.pool, n.date, CASE WHEN n.date = DATE '2024-01-20' THEN coalesce(m.last, -1) + 1 ELSE 0 END, CASE WHEN n.date = DATE '2024-01-20' THEN 45 ELSE 1 END, 96
FROM n LEFT JOIN m ON m.pool = n.pool AND m.date = n.date""")
def _(t):
    last = t.pools.filter("date <= DATE '2024-01-20'").groupBy("pool", "date").agg((F.count(F.lit(1)) % 4).cast("int").alias("last"))
    meta = last.select("pool", "date", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("revision"), F.lit(1).alias("from_block"), F.lit(96).alias("to_block"))
    return forecast.publish_revision(t.pools, meta, ["pool"], "2024-01-20", 45)


ENSEMBLE_SQL = """
WITH a AS (SELECT date, block_no, max(CASE WHEN pool = 'view' THEN value END) AS a, max(CASE WHEN pool = 'click' THEN value END) AS b,
 max(CASE WHEN pool = 'error' THEN value END) AS c, max(CASE WHEN pool = 'purchase' THEN value END) AS d FROM v_pools WHERE pool <> 'signup' GROUP BY 1, 2)
SELECT date, block_no, list_median([x FOR x IN [a, b, c, d] IF x IS NOT NULL]) AS med, list_avg([a, b, c, d]) AS mean, greatest(a, b, c, d) AS top FROM a"""


@query("ensembles", "date:d block_no:i med:g mean:g top:g", ENSEMBLE_SQL)
def _(t):
    from wattframe.operators.series import align

    names = ["view", "click", "error", "purchase"]
    wide = align({p: t.pools.filter(F.col("pool") == p) for p in names}, ["date", "block_no"], "value")
    for how, out in (("median", "med"), ("mean", "mean"), ("max", "top")):
        wide = forecast.ensemble(wide, names, how, out)
    return wide


@query("disaggregated_forecast", "date:d block_no:i unit:i unit_forecast:g", """
WITH u AS (SELECT s_suppkey AS unit, 50.0 + s_suppkey % 50 AS capacity, DATE '2024-01-01' + CAST(s_suppkey % 20 AS INT) AS f, DATE '2024-01-01' + CAST(s_suppkey % 20 + 9 AS INT) AS e FROM supplier)
SELECT date, block_no, unit, value / 100 * capacity AS unit_forecast FROM v_load JOIN u ON date BETWEEN f AND e""")
def _(t):
    day0 = F.to_date(F.lit("2024-01-01"))
    k = (F.col("unit") % 20).cast("int")
    units = t.sites.select("unit", "capacity", F.date_add(day0, k).alias("valid_from"), F.date_add(day0, k + 9).alias("valid_to"))
    return forecast.disaggregate(t.load.withColumn("v", F.col("value") / 100), units, "v")


@query("train_test_split", "area:s date:d part:s", """
WITH e AS (SELECT max(date) AS m FROM v_prices) SELECT area, date, CASE WHEN date < (SELECT m FROM e) - 60 THEN 'train' ELSE 'test' END AS part
FROM v_prices WHERE date >= (SELECT m FROM e) - 400""")
def _(t):
    return forecast.time_split(t.prices, 60, history=400)


@query("kernel_regression", "date:d hour:i kernel_pred:f", """
WITH h AS (SELECT date, hour, avg(temp) AS temp, sum(rain) AS rain, max(wind) AS wind FROM v_weather GROUP BY 1, 2),
s AS (SELECT avg(temp) AS mt, stddev_pop(temp) AS st, avg(rain) AS mr, stddev_pop(rain) AS sr FROM h WHERE date < DATE '2024-01-21'),
x AS (SELECT date, hour, (temp - mt) / st AS a, (rain - mr) / sr AS b, wind FROM h, s)
SELECT q.date, q.hour, sum(exp(-(pow(q.a - t.a, 2) + pow(q.b - t.b, 2)) / (2 * 5.5 * 5.5)) * t.wind) / sum(exp(-(pow(q.a - t.a, 2) + pow(q.b - t.b, 2)) / (2 * 5.5 * 5.5))) AS kernel_pred
FROM x q JOIN x t ON t.date < DATE '2024-01-21' GROUP BY 1, 2""")
def _(t):
    hourly = t.weather.groupBy("date", "hour").agg(F.avg("temp").alias("temp"), F.sum("rain").alias("rain"), F.max("wind").alias("wind"))
    train = hourly.filter("date < DATE '2024-01-21'")
    scale = lambda df: bins.standardize(df, ["temp", "rain"], fit_on=train, constant=False)
    return forecast.kernel_regression(scale(train), scale(hourly), ["temp_std", "rain_std"], "wind", 5.5)


@query("residual_learner", "location:i date:d hour:i learned:f")
def _(t):
    mean = t.weather.groupBy("location").agg(F.avg("temp").alias("base"))
    rows = t.weather.join(mean, "location")
    train = rows.filter("date < DATE '2024-01-21'")
    return forecast.residual_regression(train, rows, ["rain", "wind", "hour"], "temp", "base", "linear", clamp=250.0)


@query("tree_load_features", "pool:s date:d block_no:i month:i weekday:i value_d2:f value_d8:f log_target:f", """
SELECT a.pool, a.date, a.block_no, month(a.date) AS month, isodow(a.date) - 1 AS weekday, b.value AS value_d2, c.value AS value_d8, ln(1 + greatest(a.value, 0)) AS log_target
FROM v_long a LEFT JOIN v_long b ON b.pool = a.pool AND b.block_no = a.block_no AND b.date = a.date - 2
LEFT JOIN v_long c ON c.pool = a.pool AND c.block_no = a.block_no AND c.date = a.date - 8""")
def _(t):
    return forecast.load_features(t.long_blocks, ["pool"], "value")


@query("tree_load_forecast", "date:d block_no:i gbt_pred:g")
def _(t):
    features = forecast.load_features(t.load, [], "value").fillna(0.0)
    names = ["month", "weekday", "block_no", "value_d2", "value_d3", "value_d7"]
    return forecast.gbt_forecast(features.filter("date < DATE '2024-01-21'"), features, names, "log_target")


# ---- prices -------------------------------------------------------------------------------------------

RETURNS_SQL = f"""
WITH sm AS ({savgol_sql("SELECT * FROM v_long", "pool, date", "block_no", "value", 5, 1)}),
rt AS (SELECT pool, date, block_no, smooth, smooth / nullif(lag(smooth) OVER (PARTITION BY pool, block_no ORDER BY date), 0) - 1 AS ret FROM sm)
SELECT pool, date, block_no, ret, lag(ret, 1) OVER w AS ret_lag1, lag(ret, 4) OVER w AS ret_lag4, CAST(isodow(date) = 1 AS INT) AS is_monday
FROM rt WINDOW w AS (PARTITION BY pool, block_no ORDER BY date)"""


@query("price_returns", "pool:s date:d block_no:i ret:f ret_lag1:f ret_lag4:f is_monday:i", RETURNS_SQL)
def _(t):
    return forecast.price_returns(t.long_blocks, ["pool"], "value", 5, 1)


@query("price_forecast", "pool:s date:d block_no:i price_pred:f")
def _(t):
    return forecast.price_forecast(forecast.price_returns(t.long_blocks, ["pool"], "value", 5, 1))


IN_FORCE_SQL = """
SELECT pool, date, block_no, CASE WHEN date > DATE '2024-01-15' OR block_no >= 61 THEN value * 2 ELSE value END AS value,
 CASE WHEN date = DATE '2024-01-15' AND block_no >= 61 THEN 1 ELSE 0 END AS revision FROM v_pools WHERE date >= DATE '2024-01-15'"""


@query("published_rows_in_force", "pool:s date:d block_no:i value:g revision:i", IN_FORCE_SQL)
def _(t):
    spark = t.pools.sparkSession
    root = f"{shared_folder(spark)}/published-{uuid.uuid4().hex}"
    first = t.pools.select("pool", "date", "block_no", "value")
    publication.publish_forecast(first, root, ["pool"], "2024-01-15", 1, "day_ahead", 0)
    publication.publish_forecast(first.withColumn("value", F.col("value") * 2), root, ["pool"], "2024-01-15", 61, "day_ahead", 1)
    return publication.rows_in_force(spark, root, first.schema, ["pool"])


@query("price_unknown_days", "pool:s date:d block_no:i price_pred:f price_pred_smooth:f")
def _(t):
    return forecast.price_unknown_days(t.long_blocks, ["pool"], "value", 7, 5, 1)


@query("price_bias_corrected", "date:d block_no:i corrected:f", f"""
WITH {EVENTS_SQL}, x AS (SELECT date, block_no, price, forecast, CAST(isodow(date) >= 6 AS INT) AS we FROM v_price_blocks),
f AS (SELECT we, block_no, median(price / nullif(forecast, 0) - 1) AS f FROM x GROUP BY 1, 2),
y AS (SELECT x.*, forecast * (1 + f) AS w FROM x JOIN f ON f.we = x.we AND f.block_no = x.block_no),
pe AS (SELECT DISTINCT date, 'fest' || CAST(day(date) % 3 AS VARCHAR) AS name FROM v_price_blocks WHERE day(date) % 7 = 0),
e AS (SELECT name, block_no, median((price - w) / nullif(w, 0)) AS f FROM y JOIN pe USING (date) GROUP BY 1, 2)
SELECT y.date, y.block_no, w * (1 + coalesce(e.f, 0)) AS corrected FROM y LEFT JOIN pe ON pe.date = y.date LEFT JOIN e ON e.name = pe.name AND e.block_no = y.block_no""")
def _(t):
    events = t.price_blocks.select("date").distinct().filter(F.dayofmonth("date") % 7 == 0).select(
        "date", F.concat(F.lit("fest"), (F.dayofmonth("date") % 3).cast("string")).alias("name")
    )
    return correct.price_bias(t.price_blocks, events, "price", "forecast", "corrected")


ALPHAS = (0.8, 0.9, 0.95)


@query("price_bands", "date:d block_no:i ladder:i alpha:f ul_price:f ll_price:f", f"""
WITH {MAD_SQL}, z AS (SELECT * FROM (VALUES {", ".join(f"({i + 1}, {a}::DOUBLE, {normal_quantile(a)!r}::DOUBLE)" for i, a in enumerate(ALPHAS))}) v(ladder, alpha, z))
SELECT date, block_no, ladder, alpha, forecast + z * mad AS ul_price, forecast - z * mad AS ll_price FROM b CROSS JOIN z""")
def _(t):
    return forecast.price_band(mad_frame(t), "forecast", "mad", ALPHAS)


@query("widest_price_band", "date:d alpha:f ul_price:f ll_price:f", f"""
WITH {MAD_SQL} SELECT date, 0.9 AS alpha, max(forecast + {normal_quantile(0.9)!r}::DOUBLE * mad) AS ul_price, max(forecast - {normal_quantile(0.9)!r}::DOUBLE * mad) AS ll_price FROM b GROUP BY 1""")
def _(t):
    return forecast.widest_band(forecast.price_band(mad_frame(t), "forecast", "mad", [0.9]), ["date", "alpha"])
