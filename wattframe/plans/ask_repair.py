"""Registered queries: repair, smoothing, binning and scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattframe.functions import blocks
from wattframe.functions.curves import savgol_kernel
from wattframe.operators import aggregates, bins, repair, series, similar, windows
from wattframe.plans.registry import query


def savgol_sql(source: str, keys: str, order: str, col: str, width: int, degree: int) -> str:
    """Savitzky-Golay as a kernel join over numbered rows, mirrored-distance pads added as rows."""
    half = width // 2
    kernel = ", ".join(f"({i - half}, {float(w)!r}::DOUBLE)" for i, w in enumerate(savgol_kernel(width, degree)))
    part = f"PARTITION BY {keys}"
    on = " AND ".join(f"p.{k.strip()} = b.{k.strip()}" for k in keys.split(","))
    ends = " AND ".join(f"e.{k.strip()} = n.{k.strip()}" for k in keys.split(","))
    bkeys = ", ".join(f"b.{k.strip()}" for k in keys.split(","))
    nkeys = ", ".join(f"n.{k.strip()}" for k in keys.split(","))
    return f"""
WITH kern AS (SELECT * FROM (VALUES {kernel}) k(o, w)),
n AS (SELECT {keys}, {order}, {col} AS v, row_number() OVER ({part} ORDER BY {order}) AS i, count(*) OVER ({part}) AS m FROM ({source})),
e AS (SELECT {keys}, max(CASE WHEN i = 1 THEN v END) AS f, max(CASE WHEN i = m THEN v END) AS l FROM n GROUP BY ALL),
p AS (SELECT {keys}, i, v FROM n
 UNION ALL SELECT {nkeys}, 2 - n.i, f - abs(v - f) FROM n JOIN e ON {ends} WHERE n.i BETWEEN 2 AND {half + 1}
 UNION ALL SELECT {nkeys}, 2 * m - n.i, l + abs(v - l) FROM n JOIN e ON {ends} WHERE n.i BETWEEN m - {half} AND m - 1),
s AS (SELECT {bkeys}, b.{order}, any_value(b.v) AS v, sum(w * p.v) AS smooth, any_value(b.m) AS m
 FROM n b CROSS JOIN kern JOIN p ON {on} AND p.i = b.i + kern.o GROUP BY ALL)
SELECT {keys}, {order}, CASE WHEN m > {half} THEN smooth ELSE v END AS smooth FROM s"""


@query("median_filtered", "date:d block_no:i filtered:g", """
WITH p AS (SELECT date, block_no, value, coalesce(lag(value, 1) OVER w, 0) AS a, coalesce(lag(value, 2) OVER w, 0) AS b,
 coalesce(lead(value, 1) OVER w, 0) AS c, coalesce(lead(value, 2) OVER w, 0) AS d FROM v_load WINDOW w AS (PARTITION BY date ORDER BY block_no))
SELECT date, block_no, list_sort([a, b, value, c, d])[3] AS filtered FROM p""")
def _(t):
    return repair.median_filter(t.load, ["date"], "block_no", "value", 5, "filtered")


@query("median_filtered_wide", "area:s month:d date:d filtered:g", """
WITH p AS (SELECT area, date, price, CAST(date_trunc('month', date) AS DATE) AS month,
 [coalesce(lag(price, 3) OVER w, 0), coalesce(lag(price, 2) OVER w, 0), coalesce(lag(price, 1) OVER w, 0), price,
 coalesce(lead(price, 1) OVER w, 0), coalesce(lead(price, 2) OVER w, 0), coalesce(lead(price, 3) OVER w, 0)] AS x FROM v_prices
 WINDOW w AS (PARTITION BY area, date_trunc('month', date) ORDER BY date))
SELECT area, month, date, list_sort(x)[4] AS filtered FROM p""")
def _(t):
    monthly = t.prices.withColumn("month", F.trunc("date", "month"))
    return repair.median_filter(monthly, ["area", "month"], "date", "price", 7, "filtered")


@query("savgol_day", "date:d block_no:i smooth:f", savgol_sql("SELECT * FROM v_load", "date", "block_no", "value", 19, 3))
def _(t):
    return repair.savgol(t.load, ["date"], "block_no", "value", 19, 3, "smooth")


@query("savgol_narrow", "pool:s date:d block_no:i smooth:f", savgol_sql("SELECT * FROM v_long", "pool, date", "block_no", "value", 5, 1))
def _(t):
    return repair.savgol(t.long_blocks, ["pool", "date"], "block_no", "value", 5, 1, "smooth")


EXTREMES_SQL = """
WITH RECURSIVE n AS (SELECT date, block_no, value, row_number() OVER w AS i, count(*) OVER (PARTITION BY date) AS m,
 lag(value) OVER w AS a, lead(value) OVER w AS z FROM v_load WINDOW w AS (PARTITION BY date ORDER BY block_no)),
c AS (SELECT date, block_no, i, m, CAST(i > 1 AND i < m AND value >= a AND value >= z AS INT) AS up,
 CAST(i > 1 AND i < m AND value <= a AND value <= z AS INT) AS down FROM n),
walk AS (SELECT date, block_no, i, m, 1 AS peak, 1 AS trough, 1 AS lp, 1 AS lt FROM c WHERE i = 1
 UNION ALL SELECT c.date, c.block_no, c.i, c.m, CASE WHEN c.i = c.m THEN 1 WHEN c.up = 1 AND c.i - lp > 3 THEN 1 ELSE 0 END,
 CASE WHEN c.i = c.m THEN 1 WHEN c.down = 1 AND c.i - lt > 3 THEN 1 ELSE 0 END,
 CASE WHEN c.up = 1 AND c.i - lp > 3 THEN c.i ELSE lp END, CASE WHEN c.down = 1 AND c.i - lt > 3 THEN c.i ELSE lt END
 FROM walk JOIN c ON c.date = walk.date AND c.i = walk.i + 1)
SELECT date, block_no, peak, trough FROM walk"""


@query("peaks_and_troughs", "date:d block_no:i peak:i trough:i", EXTREMES_SQL)
def _(t):
    return repair.mark_extremes(t.load, ["date"], "block_no", "value", 1, 3)


@query("upper_envelope", "date:d block_no:i value:g envelope:g")
def _(t):
    filtered = repair.median_filter(t.load, ["date"], "block_no", "value", 5, "filtered")
    return repair.envelope(filtered.select("date", "block_no", "value", "filtered").drop("value").withColumnRenamed("filtered", "value"), ["date"], "block_no", "value", 0, 5)


@query("mean_envelope", "pool:s date:d block_no:i envelope:f")
def _(t):
    return repair.envelope(t.pools, ["pool", "date"], "block_no", "value", 1, 3, "mean")


@query("hull_corrected", "date:d block_no:i hull_corrected:g", """
WITH s AS (SELECT date, block_no, value, CASE WHEN count(*) OVER w >= 7 THEN avg(value) OVER w END AS h FROM v_load
 WINDOW w AS (ORDER BY date, block_no ROWS 6 PRECEDING)),
d AS (SELECT *, CASE WHEN count(value - h) OVER w >= 5 THEN avg(value - h) OVER w END AS lift FROM s
 WINDOW w AS (PARTITION BY date ORDER BY block_no ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING))
SELECT date, block_no, h + greatest(coalesce(lift, 0), 0) AS hull_corrected FROM d""")
def _(t):
    hull = windows.rolling(t.load, [], ["date", "block_no"], "value", 7, {"h": "mean"}, split="date")
    return repair.hull_correct(hull, ["date"], ["block_no"], "value", "h")


POLY_SQL = """
WITH y AS (SELECT month(date) AS month, block_no, avg(value) AS v FROM v_long GROUP BY 1, 2),
k AS (SELECT month, block_no, v, (block_no - 48.5) / 47.5 AS x, count(*) OVER (PARTITION BY month) AS n FROM y),
m AS (SELECT month, sum(v) AS s0, sum(v * x) AS s1, sum(v * (x * x)) AS s2, count(*) AS c, sum(x) AS x1, sum(x * x) AS x2,
 sum(x * x * x) AS x3, sum(x * x * x * x) AS x4 FROM k GROUP BY 1),
d AS (SELECT *, c * (x2 * x4 - x3 * x3) - x1 * (x1 * x4 - x3 * x2) + x2 * (x1 * x3 - x2 * x2) AS det FROM m),
b AS (SELECT month, (s0 * (x2 * x4 - x3 * x3) - x1 * (s1 * x4 - x3 * s2) + x2 * (s1 * x3 - x2 * s2)) / det AS b0,
 (c * (s1 * x4 - s2 * x3) - s0 * (x1 * x4 - x3 * x2) + x2 * (x1 * s2 - s1 * x2)) / det AS b1,
 (c * (x2 * s2 - x3 * s1) - x1 * (x1 * s2 - s1 * x2) + s0 * (x1 * x3 - x2 * x2)) / det AS b2 FROM d)
SELECT k.month, block_no, round(b0 + b1 * x + b2 * x * x, 5) AS fitted FROM k JOIN b ON b.month = k.month"""


@query("polynomial_profile", "month:i block_no:i fitted:f", POLY_SQL)
def _(t):
    mean = t.long_blocks.groupBy(F.month("date").alias("month"), "block_no").agg(F.avg("value").alias("v"))
    fitted = repair.poly_profile(mean, ["month"], "block_no", "v", 2)
    return fitted.withColumn("fitted", F.round("fitted", 5))


def _basis_sql(degree: int) -> str:
    basis = repair.polynomial_basis(96, degree)
    return ", ".join(f"({i + 1}, {j}, {float(basis[i, j])!r}::DOUBLE)" for i in range(96) for j in range(degree + 1))


@query("polynomial_profile_high", "weekday:i block_no:i fitted:g", f"""
WITH q AS (SELECT * FROM (VALUES {_basis_sql(15)}) v(block_no, j, q)), o AS (SELECT isodow(date) - 1 AS weekday, block_no, avg(value) AS v FROM v_long GROUP BY 1, 2),
y AS (SELECT w.weekday, b.block_no, coalesce(o.v, 0) AS v FROM (SELECT DISTINCT weekday FROM o) w CROSS JOIN v_blocks b LEFT JOIN o ON o.weekday = w.weekday AND o.block_no = b.block_no),
k AS (SELECT weekday, j, sum(q * v) AS k FROM y JOIN q ON q.block_no = y.block_no GROUP BY 1, 2)
SELECT k.weekday, q.block_no, sum(q.q * k.k) AS fitted FROM k JOIN q ON q.j = k.j JOIN y ON y.weekday = k.weekday AND y.block_no = q.block_no GROUP BY 1, 2""")
def _(t):
    mean = t.long_blocks.groupBy(F.weekday("date").alias("weekday"), "block_no").agg(F.avg("value").alias("v"))
    whole = series.gap_fill(mean, series.block_spine(mean.select("weekday")), ["weekday", "block_no"]).fillna({"v": 0.0})
    return repair.poly_profile(whole, ["weekday"], "block_no", "v", 15)


REF_SQL = "ref AS (SELECT block_no, avg(value) AS r FROM v_load GROUP BY 1)"


def _with_reference(t):
    ref = t.load.groupBy("block_no").agg(F.avg("value").alias("r"))
    return t.grid.join(ref, "block_no", "left")


@query("ratio_carried_gaps", "date:d block_no:i filled:g", f"""
WITH {REF_SQL}, j AS (SELECT date, g.block_no, value, r,
 last_value(CASE WHEN value > 0 THEN value END IGNORE NULLS) OVER w AS lo, last_value(CASE WHEN value > 0 THEN r END IGNORE NULLS) OVER w AS lr
 FROM v_grid g LEFT JOIN ref USING (block_no) WINDOW w AS (PARTITION BY date ORDER BY g.block_no ROWS UNBOUNDED PRECEDING))
SELECT date, block_no, CASE WHEN value > 0 THEN value ELSE lo * r / nullif(lr, 0) END AS filled FROM j""")
def _(t):
    return repair.ratio_carry(_with_reference(t), ["date"], ["block_no"], "value", "r", "filled")


EVENT_CARRY_SQL = """
WITH RECURSIVE ev AS (SELECT l.date, name, block_no, value FROM v_load l JOIN v_calendar c ON c.date = l.date),
sh AS (SELECT name, block_no, value / nullif(lag(value) OVER (PARTITION BY name, date ORDER BY block_no), 0) AS s FROM ev),
mn AS (SELECT name, block_no, avg(s) AS m FROM sh GROUP BY 1, 2),
cv AS (SELECT name, block_no, CASE WHEN row_number() OVER w = 1 THEN lead(m) OVER w ELSE m END AS curve FROM mn WINDOW w AS (PARTITION BY name ORDER BY block_no)),
g AS (SELECT g.date, c.name, g.block_no, value, curve FROM v_grid g JOIN v_calendar c ON c.date = g.date LEFT JOIN cv ON cv.name = c.name AND cv.block_no = g.block_no),
walk AS (SELECT date, block_no, value, curve, CASE WHEN value > 0 THEN value END AS carried FROM g WHERE block_no = 1
 UNION ALL SELECT g.date, g.block_no, g.value, g.curve, CASE WHEN g.value > 0 THEN g.value ELSE walk.carried * g.curve END
 FROM walk JOIN g ON g.date = walk.date AND g.block_no = walk.block_no + 1)
SELECT date, block_no, carried FROM walk"""


@query("event_curve_carry", "date:d block_no:i carried:g", EVENT_CARRY_SQL)
def _(t):
    on_event = t.load.join(t.calendar, "date")
    curve = repair.mean_shape(on_event, ["name", "date"], ["name"], "block_no", "value", "curve")
    grid = t.grid.join(t.calendar, "date").join(curve, ["name", "block_no"], "left")
    return repair.event_carry(grid, ["date"], "block_no", "value", "curve", "carried")


@query("reference_day_fill", "date:d lag_date:d distance:f", """
WITH h AS (SELECT date, ceil(block_no / 4) AS hour, max(value) AS v FROM v_load GROUP BY 1, 2),
p AS (SELECT a.date, b.date AS lag_date, sqrt(sum((a.v - b.v) * (a.v - b.v))) AS distance FROM h a JOIN h b ON b.hour = a.hour
 AND b.date < a.date AND b.date >= a.date - 30 WHERE a.date IN (SELECT date FROM h GROUP BY 1 HAVING count(*) = 24)
 AND b.date IN (SELECT date FROM h GROUP BY 1 HAVING count(*) = 24) GROUP BY 1, 2)
SELECT date, lag_date, distance FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY round(distance, 9), lag_date DESC) AS r FROM p) WHERE r = 1""")
def _(t):
    hourly = aggregates.hourly_max(t.load, [], "value")
    profile = similar.vectors(hourly, ["date"], ["hour"], ["value_max"]).filter("n_cells = 24")
    return similar.similar_days(profile, [], "vector", "euclid", 30, 1)


# The given events fill nearly every block; the evenings of every third day are taken out, so that days are unfinished.
UNFINISHED_SQL = """
WITH g AS (SELECT date, block_no, CASE WHEN day(date) % 3 = 0 AND block_no > 60 OR day(date) % 7 = 0 AND block_no < 9 THEN NULL ELSE value END AS value FROM v_grid),
h AS (SELECT date, ceil(block_no / 4) AS hour, max(value) AS v FROM g GROUP BY 1, 2),
n AS (SELECT date, count(value) AS n FROM g GROUP BY 1),
c AS (SELECT date, count(v) AS hours FROM h GROUP BY 1),
p AS (SELECT a.date, b.date AS lag_date, sqrt(sum(CASE WHEN a.v IS NULL THEN 0 ELSE (a.v - b.v) * (a.v - b.v) END)) AS distance FROM h a
 JOIN h b ON b.hour = a.hour AND b.date < a.date AND b.date >= a.date - 31 JOIN n na ON na.date = a.date AND na.n < 96
 JOIN n nb ON nb.date = b.date AND nb.n >= 88 JOIN c ON c.date = b.date AND c.hours = 24 GROUP BY 1, 2),
s AS (SELECT date, lag_date FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY round(distance, 9), lag_date DESC) AS r FROM p) WHERE r = 1),
m AS (SELECT g.date, g.block_no, g.value, s.lag_date, r.value AS ref FROM g LEFT JOIN s ON s.date = g.date LEFT JOIN g r ON r.date = s.lag_date AND r.block_no = g.block_no),
k AS (SELECT *, last_value(CASE WHEN value > 0 THEN value END IGNORE NULLS) OVER w AS lv, last_value(CASE WHEN value > 0 THEN ref END IGNORE NULLS) OVER w AS lr,
 FROM m WINDOW w AS (PARTITION BY date ORDER BY block_no ROWS UNBOUNDED PRECEDING))
SELECT date, block_no, lag_date, coalesce(value, CASE WHEN value > 0 THEN value ELSE lv * (ref / nullif(lr, 0)) END, ref) AS imputed FROM k"""


@query("unfinished_days_imputed", "date:d block_no:i lag_date:d imputed:g", UNFINISHED_SQL)
def _(t):
    day = F.dayofmonth("date")
    cut = ((day % 3 == 0) & (F.col("block_no") > 60)) | ((day % 7 == 0) & (F.col("block_no") < 9))
    return similar.impute_from_similar(t.grid.select("date", "block_no", F.when(~cut, F.col("value")).alias("value")), [], "value", 31, 88)


BOUNDED_SQL = """
WITH RECURSIVE b AS (SELECT date, block_no, value, value / nullif(lag(value) OVER (PARTITION BY date ORDER BY block_no), 0) AS shape,
 row_number() OVER (PARTITION BY date ORDER BY block_no) AS i, 400.0::DOUBLE AS cap FROM v_load),
walk AS (SELECT date, i, block_no, value AS grown FROM b WHERE i = 1
 UNION ALL SELECT b.date, b.i, b.block_no, least(walk.grown * b.shape, b.cap) FROM walk JOIN b ON b.date = walk.date AND b.i = walk.i + 1)
SELECT date, block_no, grown FROM walk"""


@query("bounded_growth", "date:d block_no:i grown:g", BOUNDED_SQL)
def _(t):
    shaped = windows.shape_ratio(t.load, ["date"], ["block_no"], "value").withColumn("cap", F.lit(400.0))
    return repair.bounded_carry(shaped, ["date"], "block_no", "value", "shape", "cap", "grown")


PLACES_SQL = """
pl AS (SELECT DISTINCT location, 20.0::DOUBLE + location * 1.5 AS lat, 75.0::DOUBLE + (location * 3 % 8) AS lon FROM v_weather),
ds AS (SELECT a.location, b.location AS neighbour, 2 * 6367 * asin(least(1, sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2)
 + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2)))) AS km FROM pl a JOIN pl b ON a.location <> b.location),
nn AS (SELECT *, row_number() OVER (PARTITION BY location ORDER BY round(km, 9), neighbour) AS nn_rank FROM ds)"""


def weather_places(t):
    return t.weather.select("location").distinct().select(
        "location", (F.lit(20.0) + F.col("location") * 1.5).alias("lat"), (F.lit(75.0) + F.col("location") * 3 % 8).alias("lon")
    )


@query("spatial_imputation", "location:i date:d hour:i temp:f imputed:f", f"""
WITH {PLACES_SQL}, d AS (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM v_weather),
h AS (SELECT unnest(range(1, 25)) AS hour),
g AS (SELECT pl.location, d.date, h.hour, w.temp FROM pl CROSS JOIN d CROSS JOIN h LEFT JOIN v_weather w
 ON w.location = pl.location AND w.date = d.date AND w.hour = h.hour),
f AS (SELECT g.location, g.date, g.hour, g.temp, coalesce(g.temp, (SELECT arg_min(w.temp, nn.nn_rank) FROM nn JOIN v_weather w ON w.location = nn.neighbour
 WHERE nn.location = g.location AND w.date = g.date AND w.hour = g.hour)) AS v FROM g)
SELECT location, date, hour, temp, coalesce(v, CASE WHEN count(v) OVER w >= 7 THEN quantile_cont(v, 0.5) OVER w END) AS imputed FROM f
WINDOW w AS (PARTITION BY location, hour ORDER BY date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)""")
def _(t):
    span = t.weather.groupBy("location").agg(F.lit(1)).select("location")
    first, last = t.weather.select(F.min("date")).scalar(), t.weather.select(F.max("date")).scalar()
    spine = span.withColumn("date", F.explode(F.sequence(first, last))).withColumn("hour", F.explode(F.sequence(F.lit(1), F.lit(24))))
    grid = spine.join(t.weather.select("location", "date", "hour", "temp"), ["location", "date", "hour"], "left")
    nn = similar.nearest_units(weather_places(t), "location", "lat", "lon", k=7)
    return repair.impute_spatial(grid, nn, "location", "date", "hour", "temp", "imputed")


OUTLIER_SQL = """
s AS (SELECT area, date, price, lag(price) OVER w / nullif(price, 0) AS shape FROM v_prices WINDOW w AS (PARTITION BY area ORDER BY date)),
m AS (SELECT *, CASE WHEN count(shape) OVER w >= 3 THEN quantile_cont(shape, 0.5) OVER w END AS mid FROM s
 WINDOW w AS (PARTITION BY area ORDER BY date ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)),
o AS (SELECT area, date, price, CAST(coalesce(abs(shape - mid) > 0.05, false) AS INT) AS outlier, shape, mid FROM m),
c AS (SELECT area, date, price, outlier, CASE WHEN outlier = 1 THEN mid ELSE shape END AS clean_shape FROM o)"""


@query("shape_outliers", "area:s date:d outlier:i clean_shape:f", f"WITH {OUTLIER_SQL} SELECT area, date, outlier, clean_shape FROM c")
def _(t):
    return repair.shape_outlier(t.prices, ["area"], ["date"], "price")


@query("filled_from_day_before", "pool:s date:d block_no:i filled:g", """
SELECT pool, date, block_no, last_value(value IGNORE NULLS) OVER (PARTITION BY pool, block_no ORDER BY date ROWS UNBOUNDED PRECEDING) AS filled FROM v_pool_grid""")
def _(t):
    return repair.fill_from_day_before(t.pool_grid, ["pool"], "block_no", "date", "value", "filled")


REBUILD_SQL = """
WITH RECURSIVE b AS (SELECT pool, date, block_no, value, avg(value) OVER (PARTITION BY pool, block_no) / nullif(avg(value) OVER (PARTITION BY pool), 0) AS shape FROM v_pool_grid),
walk AS (SELECT pool, date, block_no, value, value AS rebuilt FROM b WHERE block_no = 1
 UNION ALL SELECT b.pool, b.date, b.block_no, b.value, CASE WHEN coalesce(walk.value, walk.rebuilt) / nullif(b.shape, 0) IS NOT NULL
 THEN least(coalesce(walk.value, walk.rebuilt) / nullif(b.shape, 0), 440) END
 FROM walk JOIN b ON b.pool = walk.pool AND b.date = walk.date AND b.block_no = walk.block_no + 1)
SELECT pool, date, block_no, rebuilt FROM walk"""


@query("rebuilt_from_ratio", "pool:s date:d block_no:i rebuilt:g", REBUILD_SQL)
def _(t):
    by_block = t.pool_grid.groupBy("pool", "block_no").agg(F.avg("value").alias("_b"))
    overall = t.pool_grid.groupBy("pool").agg(F.avg("value").alias("_a"))
    shape = by_block.join(overall, "pool").select("pool", "block_no", (F.col("_b") / F.nullif(F.col("_a"), F.lit(0.0))).alias("shape"))
    grid = t.pool_grid.join(shape, ["pool", "block_no"], "left")
    return repair.rebuild_from_ratio(grid, ["pool", "date"], "block_no", "value", "shape", 440, "rebuilt")


STABLE_SQL = """
WITH RECURSIVE n AS (SELECT date, block_no, row_number() OVER w AS pos, value,
 avg(value) OVER (ORDER BY date, block_no ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS target FROM v_load WINDOW w AS (ORDER BY date, block_no)),
once AS (SELECT date, block_no, pos, target, CASE WHEN count(value) OVER w = 5 THEN avg(value) OVER w END AS v FROM n WINDOW w AS (ORDER BY pos ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)),
r AS (SELECT 0 AS j, date, block_no, pos, target, v, CAST(NULL AS DOUBLE) AS last, CAST(NULL AS DOUBLE) AS error, FALSE AS stop FROM once
 UNION ALL SELECT j, date, block_no, pos, target, v, last, error, coalesce(abs(last - error) <= 0.001, error IS NULL) AS stop FROM (
  SELECT j, date, block_no, pos, target, v, last, avg(abs(target / nullif(v, 0) - 1)) OVER () AS error FROM (
   SELECT j + 1 AS j, date, block_no, pos, target, CASE WHEN count(v) OVER w = 5 THEN avg(v) OVER w END AS v, error AS last
   FROM r WHERE NOT stop AND j < 100 WINDOW w AS (ORDER BY pos ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)) a) b)
SELECT date, block_no, v AS smooth FROM r WHERE j = (SELECT max(j) FROM r)"""


@query("smoothed_until_stable", "date:d block_no:i smooth:g", STABLE_SQL)
def _(t):
    actual = windows.rolling(t.load, [], ["date", "block_no"], "value", 7, {"target": "mean"}, center=True, min_periods=1, split="date")
    return repair.smooth_until(actual, [], ["date", "block_no"], "value", "target")


HULL_SQL = savgol_sql(
    "SELECT date, block_no, max(value) OVER (PARTITION BY date, ceil(block_no / 6)) AS top FROM v_load", "date", "block_no", "top", 35, 2
)


@query("window_hull", "date:d block_no:i smooth:g", HULL_SQL)
def _(t):
    return repair.window_hull(t.load, ["date"], "block_no", "value", out="smooth")


@query("forecast_horizon", "pool:s date:d block_no:i value:g", """
WITH l AS (SELECT pool, max(date) AS d FROM v_pools GROUP BY 1), m AS (SELECT l.pool, d, max(block_no) AS b FROM l JOIN v_pools p ON p.pool = l.pool AND p.date = l.d GROUP BY 1, 2),
f AS (SELECT pool, CASE WHEN b >= 96 THEN d + 1 ELSE d END AS fd, CASE WHEN b >= 96 THEN 1 ELSE b + 1 END AS fb FROM m)
SELECT pool, date, block_no, value FROM v_pools UNION ALL
SELECT pool, CAST(fd + k AS DATE), block_no, NULL FROM f CROSS JOIN (SELECT CAST(unnest(range(0, 8)) AS INT) AS k) CROSS JOIN v_blocks WHERE k > 0 OR block_no >= fb""")
def _(t):
    return series.horizon(t.pools, ["pool"])


@query("stitched_weather", "location:i date:d hour:i temp:f data_type:s", """
WITH a AS (SELECT * FROM v_weather WHERE date <= DATE '2024-01-20')
SELECT location, date, hour, temp, 'ACTUAL' AS data_type FROM a UNION ALL
SELECT location, date, hour, temp + 1, 'FORECAST' FROM v_weather WHERE date > (SELECT max(date) FROM a)
 OR (date = (SELECT max(date) FROM a) AND hour > (SELECT max(hour) FROM a WHERE date = (SELECT max(date) FROM a)))""")
def _(t):
    cols = ["location", "date", "hour", "temp"]
    actual = t.weather.filter("date <= DATE '2024-01-20'").select(*cols)
    return repair.stitch(actual, t.weather.withColumn("temp", F.col("temp") + 1).select(*cols))


@query("solar_daylight", "date:d block_no:i daylight:i", """
WITH g AS (SELECT date, block_no, 2 * pi() / 365 * (dayofyear(date) - 81) AS ang FROM v_grid),
d AS (SELECT date, block_no, radians(23.45) * sin(ang) AS dec FROM g),
h AS (SELECT date, block_no, degrees(acos(least(1, greatest(-1, -tan(radians(22.3)) * tan(dec))))) / 15 AS half FROM d)
SELECT date, block_no, CAST((block_no - 0.5) / 4 BETWEEN 12 - (72.6 - 82.5) / 15 - half AND 12 - (72.6 - 82.5) / 15 + half AS INT) AS daylight FROM h""")
def _(t):
    return repair.daylight(t.grid, "date", "block_no", F.lit(22.3), F.lit(72.6), 5.5)


@query("observed_daylight", "pool:s date:d block_no:i daylight:i", """
SELECT pool, date, block_no, CAST(coalesce(block_no BETWEEN min(CASE WHEN value > 0 THEN block_no END) OVER w
 AND max(CASE WHEN value > 0 THEN block_no END) OVER w, false) AS INT) AS daylight FROM v_pool_grid WINDOW w AS (PARTITION BY pool, date)""")
def _(t):
    return repair.observed_daylight(t.pool_grid, ["pool", "date"], "value")


# ---- bins and scaling ---------------------------------------------------------------------------------

def bin_sql(x: str, low: str, high: str, n: int) -> str:
    return (
        f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} < {low} THEN 0 WHEN {x} >= {high} THEN {n}"
        f" ELSE least(floor(({x} - {low}) / nullif(({high} - {low}) / {n - 1}, 0)) + 1, {n - 1}) END"
    )


@query("equal_width_bins", "event_id:i bin:i", f"""
SELECT event_id, {bin_sql('value', 'lo', 'hi', 20)} AS bin FROM events, (SELECT min(value) AS lo, max(value) AS hi FROM events)""")
def _(t):
    return bins.linspace_bin(t.events, "value", 20, out="bin")


@query("fixed_edge_bins", "location:i date:d hour:i rain_bin:i probability_bin:i", """
SELECT location, date, hour, CASE WHEN rain - 1 <= 0 THEN 0 WHEN rain - 1 < 1 THEN 1 WHEN rain - 1 < 5 THEN 2 WHEN rain - 1 < 10 THEN 3 WHEN rain - 1 < 20 THEN 4 ELSE 5 END AS rain_bin,
 CASE WHEN temp / 4 <= 0 THEN 0 WHEN temp / 4 < 10 THEN 1 WHEN temp / 4 < 20 THEN 2 WHEN temp / 4 < 30 THEN 3 WHEN temp / 4 < 40 THEN 4 WHEN temp / 4 < 50 THEN 5 ELSE 6 END AS probability_bin FROM v_weather""")
def _(t):
    w = t.weather.withColumn("r", F.col("rain") - 1).withColumn("p", F.col("temp") / 4)
    return bins.edge_bin(bins.edge_bin(w, "r", bins.RAIN_EDGES, "rain_bin"), "p", bins.RAIN_PROBABILITY_EDGES, "probability_bin")


@query("bins_fitted_on_training", "event_id:i bin:i", f"""
SELECT event_id, {bin_sql('value', 'lo', 'hi', 10)} AS bin FROM events, (SELECT min(value) AS lo, max(value) AS hi FROM events WHERE event_type = 'click')""")
def _(t):
    return bins.linspace_bin(t.events, "value", 10, t.events.filter("event_type = 'click'"), "bin")


@query("calibration_applied", "l_orderkey:i l_linenumber:i expected_bin:f", """
WITH x AS (SELECT l_orderkey, l_linenumber, CAST(least(floor(l_quantity / 10), 4) AS INT) AS fbin, CAST(floor(l_discount * 40 + 0.01) AS INT) AS abin, l_returnflag FROM lineitem),
c AS (SELECT fbin, avg(abin) AS e FROM x WHERE l_returnflag = 'R' AND fbin < 4 GROUP BY 1)
SELECT l_orderkey, l_linenumber, coalesce(e, x.fbin) AS expected_bin FROM x LEFT JOIN c ON c.fbin = x.fbin""")
def _(t):
    x = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.least(F.floor(F.col("l_quantity") / 10), F.lit(4)).cast("int").alias("fbin"),
        F.floor(F.col("l_discount") * 40 + 0.01).cast("int").alias("abin"), "l_returnflag",
    )
    table = aggregates.expected_bin(aggregates.bin_calibration(x.filter("l_returnflag = 'R' AND fbin < 4"), "fbin", "abin"), "fbin", "abin")
    return bins.apply_calibration(x, table, "fbin")


@query("interval_bins", "event_id:i bin:i", """
WITH tr AS (SELECT CAST(least(floor(value / 50), 5) AS INT) AS b, min(value) AS lo, max(value) AS hi FROM events WHERE event_type = 'view' GROUP BY 1)
SELECT event_id, CASE WHEN value < (SELECT min(lo) FROM tr) THEN (SELECT min(b) FROM tr) - 1 WHEN value > (SELECT max(hi) FROM tr) THEN (SELECT max(b) FROM tr) + 1
 ELSE (SELECT max(b) FROM tr WHERE lo <= value) END AS bin FROM events""")
def _(t):
    train = t.events.filter("event_type = 'view'").withColumn("b", F.least(F.floor(F.col("value") / 50), F.lit(5)).cast("int"))
    return bins.interval_bin(t.events, "value", train, "b")


@query("median_imputed", "l_orderkey:i l_linenumber:i price:g", """
WITH x AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_extendedprice END AS p FROM lineitem)
SELECT l_orderkey, l_linenumber, coalesce(p, (SELECT median(p) FROM x)) AS price FROM x""")
def _(t):
    x = t.lineitem.withColumn("price", F.when(F.col("l_returnflag") != "A", F.col("l_extendedprice")))
    return bins.impute_median(x.select("l_orderkey", "l_linenumber", "price"), ["price"])


@query("standardised_features", "event_id:i value_std:f const:f back:f", """
SELECT event_id, (value - avg(value) OVER ()) / stddev_pop(value) OVER () AS value_std, 1 AS const, value AS back FROM events""")
def _(t):
    scaled = bins.standardize(t.events, ["value"])
    return bins.unstandardize(scaled, "value_std", t.events, "value", "back")


@query("block_calendar_join", "event_id:i start_time:s hour:i", """
SELECT event_id, printf('%02d:%02d', (block_no - 1) * 15 // 60, (block_no - 1) * 15 % 60) AS start_time, ceil(block_no / 4) AS hour FROM v_readings""")
def _(t):
    return t.readings.join(series.block_calendar(t.spark), "block_no")
