"""Registered queries: similar days, analogue windows, blends, capacity and places."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattframe.functions import scalars
from wattframe.operators import aggregates, similar, splits, windows
from wattframe.operators.series import backfill_ranks
from wattframe.plans import day_ahead
from wattframe.plans.ask_repair import PLACES_SQL, weather_places
from wattframe.plans.registry import query

RANK_SQL = """
pr AS (SELECT pool, date, min(value) AS a, max(value) AS b, median(value) AS c FROM v_long GROUP BY 1, 2),
rk AS (SELECT pool, date,
 rank() OVER (PARTITION BY pool ORDER BY a) + (count(*) OVER (PARTITION BY pool, a) - 1) / 2.0 AS ra,
 rank() OVER (PARTITION BY pool ORDER BY b) + (count(*) OVER (PARTITION BY pool, b) - 1) / 2.0 AS rb,
 rank() OVER (PARTITION BY pool ORDER BY c) + (count(*) OVER (PARTITION BY pool, c) - 1) / 2.0 AS rc FROM pr),
ds AS (SELECT x.pool, x.date, y.date AS lag_date, pow(x.ra - y.ra, 2) + pow(x.rb - y.rb, 2) + pow(x.rc - y.rc, 2) AS distance
 FROM rk x JOIN rk y ON y.pool = x.pool AND y.date < x.date AND y.date >= x.date - {n}),
nn AS (SELECT *, row_number() OVER (PARTITION BY pool, date ORDER BY round(distance, 9), lag_date DESC) AS rank FROM ds)"""


@query("similar_days_by_rank", "pool:s date:d lag_date:d distance:f rank:i", f"WITH {RANK_SQL.format(n=90)} SELECT * FROM nn WHERE rank <= 7")
def _(t):
    return similar.similar_days(day_ahead.rank_profile(t.long_blocks, ["pool"]), ["pool"], "vector", "sqeuclid", 90, 7)


FORECAST_SQL = RANK_SQL.format(n=90) + """,
cells AS (SELECT v.pool, v.date, v.block_no, v.value, nn.rank, l.value AS past FROM v_long v LEFT JOIN nn ON nn.pool = v.pool AND nn.date = v.date AND rank <= 8
 LEFT JOIN v_long l ON l.pool = nn.pool AND l.date = nn.lag_date AND l.block_no = v.block_no),
stood_by AS (SELECT *, first_value(past IGNORE NULLS) OVER (PARTITION BY pool, date, block_no ORDER BY rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS taken FROM cells),
bl AS (SELECT pool, date, block_no, any_value(value) AS value,
 CASE WHEN count(taken) FILTER (WHERE rank <= 7) = 7 THEN sum(pow(0.45, rank - 1) * taken) FILTER (WHERE rank <= 7) / sum(pow(0.45, rank - 1)) FILTER (WHERE rank <= 7) END AS forecast
 FROM stood_by GROUP BY 1, 2, 3)"""


@query("similar_day_forecast", "pool:s date:d block_no:i value:f forecast:f ape:f", f"""
WITH {FORECAST_SQL} SELECT pool, date, block_no, value, forecast, abs((value - forecast) / nullif(value, 0)) AS ape FROM bl""")
def _(t):
    return day_ahead.similar_day_forecast(t.long_blocks, ["pool"])


@query("similar_days_weather_rank", "date:d lag_date:d distance:f rank:i", """
WITH p AS (SELECT location, date, min(temp) AS a, max(temp) AS b, median(temp) AS c FROM v_weather GROUP BY 1, 2),
r AS (SELECT location, date, rank() OVER (PARTITION BY location ORDER BY a) + (count(*) OVER (PARTITION BY location, a) - 1) / 2.0 AS ra,
 rank() OVER (PARTITION BY location ORDER BY b) + (count(*) OVER (PARTITION BY location, b) - 1) / 2.0 AS rb,
 rank() OVER (PARTITION BY location ORDER BY c) + (count(*) OVER (PARTITION BY location, c) - 1) / 2.0 AS rc FROM p),
n AS (SELECT date, count(*) AS m FROM r GROUP BY 1),
d AS (SELECT x.date, y.date AS lag_date, sum(pow(x.ra - y.ra, 2) + pow(x.rb - y.rb, 2) + pow(x.rc - y.rc, 2)) AS distance
 FROM r x JOIN r y ON y.location = x.location AND y.date < x.date AND y.date >= x.date - 45 JOIN n a ON a.date = x.date JOIN n b ON b.date = y.date
 WHERE a.m = (SELECT count(DISTINCT location) FROM r) AND b.m = (SELECT count(DISTINCT location) FROM r) GROUP BY 1, 2),
k AS (SELECT *, row_number() OVER (PARTITION BY date ORDER BY round(distance, 9), lag_date DESC) AS rank FROM d)
SELECT * FROM k WHERE rank <= 12""")
def _(t):
    return similar.similar_days(day_ahead.weather_rank_profile(t.weather), [], "vector", "sqeuclid", 45, 12)


@query("similar_days_cosine", "pool:s date:d lag_date:d distance:f rank:i", """
WITH c AS (SELECT l_returnflag AS pool, CAST(l_shipdate AS DATE) AS date, l_suppkey % 3 AS slot, avg(l_extendedprice) / 1000 AS v FROM lineitem GROUP BY 1, 2, 3),
n AS (SELECT pool, date, count(*) AS m FROM c GROUP BY 1, 2),
f AS (SELECT c.* FROM c JOIN n ON n.pool = c.pool AND n.date = c.date AND m = 3),
d AS (SELECT x.pool, x.date, y.date AS lag_date, 1 - sum(x.v * y.v) / (sqrt(sum(x.v * x.v)) * sqrt(sum(y.v * y.v))) AS distance FROM f x JOIN f y
 ON y.pool = x.pool AND y.slot = x.slot AND y.date < x.date AND y.date >= x.date - 7 GROUP BY 1, 2, 3),
k AS (SELECT *, row_number() OVER (PARTITION BY pool, date ORDER BY round(distance, 9), lag_date DESC) AS rank FROM d) SELECT * FROM k WHERE rank <= 3""")
def _(t):
    cells = t.lineitem.groupBy(F.col("l_returnflag").alias("pool"), F.to_date("l_shipdate").alias("date"), (F.col("l_suppkey") % 3).alias("slot")).agg(
        (F.avg("l_extendedprice") / 1000).alias("v")
    )
    profile = similar.vectors(cells, ["pool", "date"], ["slot"], ["v"]).filter("n_cells = 3")
    return similar.similar_days(profile, ["pool"], "vector", "cosine", 7, 3)


def _euclid_sql(cols: str, lookback: int) -> str:
    sq = " + ".join(f"pow(x.{c} - y.{c}, 2)" for c in cols.split())
    return f"""
WITH c AS (SELECT location, date, hour // 6 AS slot, avg(temp) AS temp, max(wind) AS wind, sum(rain) AS rain FROM v_weather GROUP BY 1, 2, 3),
n AS (SELECT location, date, count(*) AS m FROM c GROUP BY 1, 2), f AS (SELECT c.* FROM c JOIN n ON n.location = c.location AND n.date = c.date AND m = 5),
d AS (SELECT x.location, x.date, y.date AS lag_date, sqrt(sum({sq})) AS distance FROM f x JOIN f y
 ON y.location = x.location AND y.slot = x.slot AND y.date < x.date AND y.date >= x.date - {lookback} GROUP BY 1, 2, 3),
k AS (SELECT *, row_number() OVER (PARTITION BY location, date ORDER BY round(distance, 9), lag_date DESC) AS rank FROM d) SELECT * FROM k WHERE rank <= 9"""


def _weather_family(t, cols, lookback):
    cells = t.weather.groupBy("location", "date", F.floor(F.col("hour") / 6).alias("slot")).agg(
        F.avg("temp").alias("temp"), F.max("wind").alias("wind"), F.sum("rain").alias("rain")
    )
    profile = similar.vectors(cells, ["location", "date"], ["slot"], cols).filter("n_cells = 5")
    return similar.similar_days(profile, ["location"], "vector", "euclid", lookback, 9)


@query("similar_days_temperature", "location:i date:d lag_date:d distance:f rank:i", _euclid_sql("temp", 30))
def _(t):
    return _weather_family(t, ["temp"], 30)


@query("similar_days_wind_temperature", "location:i date:d lag_date:d distance:f rank:i", _euclid_sql("wind temp", 90))
def _(t):
    return _weather_family(t, ["wind", "temp"], 90)


@query("similar_days_rain_temperature", "location:i date:d lag_date:d distance:f rank:i", _euclid_sql("rain temp", 45))
def _(t):
    return _weather_family(t, ["rain", "temp"], 45)


@query("candidate_pairs", "area:s date:d lag_date:d", """
SELECT a.area, a.date, b.date AS lag_date FROM v_prices a JOIN v_prices b ON b.area = a.area AND b.date < a.date AND b.date >= a.date - 10""")
def _(t):
    indexed = t.prices.withColumn("_day", F.unix_date("date"))
    return similar.candidate_pairs(indexed, ["area"], 10, "_day", ["date"])


@query("similar_windows", "window_no:i lag_window_no:i distance:f rank:i", """
WITH w AS (SELECT (datediff('day', DATE '1970-01-01', date) * 24 + hour) AS window_no, location, max(wind) AS v FROM v_weather GROUP BY 1, 2),
n AS (SELECT window_no, count(*) AS m FROM w GROUP BY 1), f AS (SELECT w.* FROM w JOIN n ON n.window_no = w.window_no AND m = 8),
d AS (SELECT x.window_no, y.window_no AS lag_window_no, sqrt(sum(pow(x.v - y.v, 2))) AS distance FROM f x JOIN f y
 ON y.location = x.location AND y.window_no < x.window_no GROUP BY 1, 2),
k AS (SELECT *, row_number() OVER (PARTITION BY window_no ORDER BY round(distance, 9), lag_window_no DESC) AS rank FROM d) SELECT * FROM k WHERE rank <= 12""")
def _(t):
    cells = t.weather.groupBy((F.unix_date("date") * 24 + F.col("hour")).cast("long").alias("window_no"), "location").agg(F.max("wind").alias("v"))
    features = similar.vectors(cells, ["window_no"], ["location"], ["v"]).filter("n_cells = 8")
    return similar.similar_windows(features, [], "window_no", "vector", "euclid", 12)


@query("neighbour_columns", "pool:s date:d block_no:i nn1:f nn2:f nn3:f", f"""
WITH {RANK_SQL.format(n=90)} SELECT nn.pool, nn.date, l.block_no, max(CASE WHEN rank = 1 THEN l.value END) AS nn1, max(CASE WHEN rank = 2 THEN l.value END) AS nn2,
 max(CASE WHEN rank = 3 THEN l.value END) AS nn3 FROM nn JOIN v_long l ON l.pool = nn.pool AND l.date = nn.lag_date WHERE rank <= 3 GROUP BY 1, 2, 3""")
def _(t):
    nn = similar.similar_days(day_ahead.rank_profile(t.long_blocks, ["pool"]), ["pool"], "vector", "sqeuclid", 90, 7)
    return similar.neighbour_columns(nn, similar.day_curves(t.long_blocks, ["pool"], "value"), ["pool"], 3)


def _terms(prefix: str, k: int, top: int, t: float) -> str:
    fill = lambda r: "coalesce(" + ", ".join(f"{prefix}{j}" for j in range(r, top + 1)) + ")"
    total = sum(t**i for i in range(k))
    return "(" + " + ".join(f"{fill(r)} * {t ** (r - 1)!r}::DOUBLE" for r in range(1, k + 1)) + f") / {total!r}::DOUBLE"


def _four_neighbours(t):
    nn = similar.similar_days(day_ahead.rank_profile(t.long_blocks, ["pool"]), ["pool"], "vector", "sqeuclid", 45, 4)
    return similar.neighbour_columns(nn, similar.day_curves(t.long_blocks, ["pool"], "value"), ["pool"], 4)


@query("blend_with_backfill", "pool:s date:d block_no:i blend:f", f"""
WITH {RANK_SQL.format(n=45)}, w AS (SELECT nn.pool, nn.date, l.block_no, {", ".join(f"max(CASE WHEN rank = {r} THEN l.value END) AS x{r}" for r in range(1, 5))}
 FROM nn JOIN v_long l ON l.pool = nn.pool AND l.date = nn.lag_date WHERE rank <= 4 GROUP BY 1, 2, 3)
SELECT pool, date, block_no, {_terms("x", 3, 4, 0.25)} AS blend FROM w""")
def _(t):
    wide = backfill_ranks(_four_neighbours(t), ["nn1", "nn2", "nn3"], "nn4")
    return wide.withColumn("blend", similar.blend_lags(wide, ["nn1", "nn2", "nn3"], 0.25))


@query("backfilled_ranks", "pool:s date:d block_no:i nn1:f nn2:f nn3:f", f"""
WITH {RANK_SQL.format(n=45)}, w AS (SELECT nn.pool, nn.date, l.block_no, {", ".join(f"max(CASE WHEN rank = {r} THEN l.value END) AS x{r}" for r in range(1, 5))}
 FROM nn JOIN v_long l ON l.pool = nn.pool AND l.date = nn.lag_date WHERE rank <= 4 GROUP BY 1, 2, 3)
SELECT pool, date, block_no, coalesce(x1, x2, x3, x4) AS nn1, coalesce(x2, x3, x4) AS nn2, coalesce(x3, x4) AS nn3 FROM w""")
def _(t):
    return backfill_ranks(_four_neighbours(t), ["nn1", "nn2", "nn3"], "nn4")


@query("weekly_lag_blend", "pool:s date:d block_no:i blend:f", """
SELECT a.pool, a.date, a.block_no, (b.value + c.value * 0.9::DOUBLE + d.value * 0.81::DOUBLE) / 2.71::DOUBLE AS blend FROM v_long a
LEFT JOIN v_long b ON b.pool = a.pool AND b.block_no = a.block_no AND b.date = a.date - 7
LEFT JOIN v_long c ON c.pool = a.pool AND c.block_no = a.block_no AND c.date = a.date - 14
LEFT JOIN v_long d ON d.pool = a.pool AND d.block_no = a.block_no AND d.date = a.date - 21""")
def _(t):
    lagged = windows.calendar_lags(t.long_blocks, ["pool", "block_no"], "date", ["value"], [7, 14, 21])
    return lagged.withColumn("blend", similar.blend_lags(lagged, ["value_d7", "value_d14", "value_d21"], 0.9))


@query("imputed_from_blend", "date:d block_no:i value:g filled:g", """
WITH p AS (SELECT date, min(value) AS a, max(value) AS b, median(value) AS c FROM v_load GROUP BY 1),
r AS (SELECT date, rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2.0 AS ra, rank() OVER (ORDER BY b) + (count(*) OVER (PARTITION BY b) - 1) / 2.0 AS rb, rank() OVER (ORDER BY c) + (count(*) OVER (PARTITION BY c) - 1) / 2.0 AS rc FROM p),
d AS (SELECT x.date, y.date AS lag_date, pow(x.ra - y.ra, 2) + pow(x.rb - y.rb, 2) + pow(x.rc - y.rc, 2) AS dist FROM r x JOIN r y ON y.date < x.date AND y.date >= x.date - 90),
k AS (SELECT *, row_number() OVER (PARTITION BY date ORDER BY round(dist, 9), lag_date DESC) AS rank FROM d),
b AS (SELECT k.date, l.block_no, sum(pow(0.45, rank - 1) * l.value) / sum(pow(0.45, rank - 1)) AS v, count(*) AS n FROM k JOIN v_load l ON l.date = k.lag_date WHERE rank <= 7 GROUP BY 1, 2)
SELECT g.date, g.block_no, g.value, coalesce(g.value, CASE WHEN n = 7 THEN v END) AS filled FROM v_grid g LEFT JOIN b USING (date, block_no)""")
def _(t):
    return day_ahead.impute_blend(t.grid, t.load)


@query("weather_delta", "location:i date:d hour:i delta:f", """
WITH c AS (SELECT date, hour, avg(temp) AS v FROM v_weather GROUP BY 1, 2), n AS (SELECT date FROM c GROUP BY 1 HAVING count(*) = 24),
f AS (SELECT c.* FROM c JOIN n USING (date)),
d AS (SELECT x.date, y.date AS lag_date, sqrt(sum(pow(x.v - y.v, 2))) AS dist FROM f x JOIN f y ON y.hour = x.hour AND y.date < x.date AND y.date >= x.date - 30 GROUP BY 1, 2),
k AS (SELECT *, row_number() OVER (PARTITION BY date ORDER BY round(dist, 9), lag_date DESC) AS rank FROM d),
b AS (SELECT w.location, k.date, w.hour, sum(pow(0.25, rank - 1) * w.temp) / sum(pow(0.25, rank - 1)) AS v, count(*) AS m FROM k JOIN v_weather w ON w.date = k.lag_date
 WHERE rank <= 3 GROUP BY 1, 2, 3)
SELECT w.location, w.date, w.hour, w.temp - CASE WHEN m = 3 THEN v END AS delta FROM v_weather w JOIN b ON b.location = w.location AND b.date = w.date AND b.hour = w.hour""")
def _(t):
    hourly = t.weather.groupBy("date", "hour").agg(F.avg("temp").alias("v"))
    profile = similar.vectors(hourly, ["date"], ["hour"], ["v"]).filter("n_cells = 24")
    nn = similar.similar_days(profile, [], "vector", "euclid", 30, 3)
    return similar.weather_delta(t.weather.select("location", "date", "hour", "temp"), nn, ["location"], ["hour"], "temp", 3, 0.25)


# ---- places and capacity ------------------------------------------------------------------------------

SITE_SQL = """
ds AS (SELECT a.unit, b.unit AS neighbour, a.lat, 2 * 6367 * asin(least(1, sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2)
 + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2)))) AS km FROM v_sites a JOIN v_sites b ON a.unit <> b.unit),
nn AS (SELECT unit, neighbour, km AS distance_km, row_number() OVER (PARTITION BY unit ORDER BY round(km, 9), neighbour) AS nn_rank FROM ds)"""


@query("haversine_distance", "unit:i km:f", """
SELECT unit, 2 * 6367 * asin(least(1, sqrt(pow(sin(radians(28.6 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(28.6)) * pow(sin(radians(77.2 - lon) / 2), 2)))) AS km FROM v_sites""")
def _(t):
    return t.sites.select("unit", scalars.haversine_km(F.col("lat"), F.col("lon"), F.lit(28.6), F.lit(77.2)).alias("km"))


@query("nearest_units", "unit:i neighbour:i distance_km:f nn_rank:i", f"WITH {SITE_SQL} SELECT unit, neighbour, distance_km, nn_rank FROM nn WHERE nn_rank <= 2")
def _(t):
    return similar.nearest_units(t.sites, "unit", "lat", "lon", k=2)


@query("nearest_places", "location:i neighbour:i nn_rank:i", f"WITH {PLACES_SQL} SELECT location, neighbour, nn_rank FROM nn WHERE nn_rank <= 3")
def _(t):
    return similar.nearest_units(weather_places(t), "location", "lat", "lon", k=3)


@query("neighbour_reading", "unit:i date:d block_no:i own:f near:f", f"""
WITH {SITE_SQL} SELECT a.unit, a.date, a.block_no, a.generation AS own, b.generation AS near FROM v_unit_blocks a JOIN nn ON nn.unit = a.unit AND nn_rank = 1
JOIN v_unit_blocks b ON b.unit = nn.neighbour AND b.date = a.date AND b.block_no = a.block_no""")
def _(t):
    nn = similar.nearest_units(t.sites, "unit", "lat", "lon")
    return similar.neighbour_value(t.unit_blocks, nn, "unit", ["date", "block_no"], "generation", "near").withColumnRenamed("generation", "own")


AVAILABLE_SQL = SITE_SQL + """,
pair AS (SELECT a.unit, a.date, a.block_no, greatest(a.generation - 10, 0) AS g, s.capacity AS cap, greatest(b.generation - 10, 0) / z.capacity AS nr
 FROM v_unit_blocks a JOIN v_sites s ON s.unit = a.unit JOIN nn ON nn.unit = a.unit AND nn_rank = 1
 JOIN v_unit_blocks b ON b.unit = nn.neighbour AND b.date = a.date AND b.block_no = a.block_no JOIN v_sites z ON z.unit = b.unit),
av AS (SELECT unit, date, block_no, g AS generation_used, CASE WHEN nr > g / cap THEN g / nullif(nr, 0) ELSE cap END AS available FROM pair),
tot AS (SELECT date, block_no, sum(available) AS capacity, sum(generation_used) * 4 AS gen_mw FROM av GROUP BY 1, 2),
dm AS (SELECT date, avg(capacity) AS capacity_day_mean FROM tot GROUP BY 1)"""


def _available(t):
    nn = similar.nearest_units(t.sites, "unit", "lat", "lon")
    gen = t.unit_blocks.withColumn("generation", F.col("generation") - 10).join(t.sites.select("unit", "capacity"), "unit")
    return similar.available_capacity(gen, nn, "unit", ["date", "block_no"], "generation", "capacity")


@query("available_capacity", "unit:i date:d block_no:i available:f", f"WITH {AVAILABLE_SQL} SELECT unit, date, block_no, available FROM av")
def _(t):
    return _available(t)


@query("generation_per_capacity", "date:d block_no:i per_gen:f capacity_day_mean:g", f"""
WITH {AVAILABLE_SQL} SELECT date, block_no, gen_mw / nullif(capacity, 0) AS per_gen, capacity_day_mean FROM tot JOIN dm USING (date)""")
def _(t):
    return similar.normalise_by_capacity(_available(t))


@query("forecast_denormalised", "date:d block_no:i forecast_mw:g", f"""
WITH {AVAILABLE_SQL}, cap AS (SELECT date, last_value(capacity_day_mean IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS used FROM dm)
SELECT date, block_no, gen_mw / nullif(capacity, 0) * used AS forecast_mw FROM tot JOIN cap USING (date)""")
def _(t):
    normal = similar.normalise_by_capacity(_available(t))
    return similar.denormalise(normal, normal, "per_gen")


@query("solar_per_unit", "date:d block_no:i gen_mw:g per_gen:f", """
WITH g AS (SELECT pool AS unit, date, block_no, sum(value) AS g FROM v_pools GROUP BY 1, 2, 3), u AS (SELECT DISTINCT pool AS unit, 100.0 + length(pool) AS c FROM v_pools),
s AS (SELECT date, block_no, sum(g) * 4 AS gen_mw, sum(c) AS cap FROM g JOIN u USING (unit) GROUP BY 1, 2), d AS (SELECT date, avg(cap) AS dc FROM s GROUP BY 1)
SELECT s.date, block_no, gen_mw, gen_mw / dc * CAST(block_no BETWEEN 25 AND 76 AS INT) AS per_gen FROM s JOIN d ON d.date = s.date""")
def _(t):
    gen = t.pools.select(F.col("pool").alias("unit"), "date", "block_no", F.col("value").alias("generation"))
    units = gen.select("unit").distinct().withColumn("rated_capacity", F.lit(100.0) + F.length("unit"))
    day = t.grid.select("date", "block_no", F.col("block_no").between(25, 76).cast("int").alias("daylight"))
    return similar.solar_per_unit(gen, units, "unit", day)


@query("irradiance_imputed", "location:i date:d block_no:i improved:f", """
WITH c AS (SELECT location, date, hour // 6 AS block_no, avg(temp) AS temp, max(wind) AS wind FROM v_weather GROUP BY 1, 2, 3),
n AS (SELECT location, date, count(*) AS m FROM c GROUP BY 1, 2), f AS (SELECT c.* FROM c JOIN n ON n.location = c.location AND n.date = c.date AND m = 5),
d AS (SELECT x.location, x.date, y.date AS lag_date, sqrt(sum(pow(x.temp - y.temp, 2))) AS dist FROM f x JOIN f y ON y.location = x.location AND y.block_no = x.block_no
 AND y.date < x.date AND y.date >= x.date - 30 GROUP BY 1, 2, 3),
k AS (SELECT *, row_number() OVER (PARTITION BY location, date ORDER BY round(dist, 9), lag_date DESC) AS rank FROM d),
b AS (SELECT k.location, k.date, c.block_no, sum(pow(0.45, rank - 1) * wind) / sum(pow(0.45, rank - 1)) AS v, count(*) AS m FROM k JOIN c ON c.location = k.location AND c.date = k.lag_date
 WHERE rank <= 3 GROUP BY 1, 2, 3)
SELECT c.location, c.date, c.block_no, greatest(c.wind, CASE WHEN m = 3 THEN v END) AS improved FROM c LEFT JOIN b USING (location, date, block_no)""")
def _(t):
    cells = t.weather.groupBy("location", "date", F.floor(F.col("hour") / 6).alias("block_no")).agg(F.avg("temp").alias("temp"), F.max("wind").alias("value"))
    profile = similar.vectors(cells, ["location", "date"], ["block_no"], ["temp"]).filter("n_cells = 5")
    nn = similar.similar_days(profile, ["location"], "vector", "euclid", 30, 3)
    blended = similar.blend(similar.neighbour_curves(nn, cells, ["location"], "value"), ["location"], "value", 3, 0.45)
    return similar.impute_by_analogue(cells, blended, ["location", "date", "block_no"], "value", "blend", "improved")


@query("geo_rings", "lat:f lon:f", """
WITH r AS (SELECT radians(lat) AS phi, lon, 10.0 * i / 6367 AS ang, radians(45.0 * j) AS th FROM v_sites CROSS JOIN (SELECT unnest(range(1, 4)) AS i) CROSS JOIN (SELECT unnest(range(0, 8)) AS j)),
p AS (SELECT *, asin(sin(phi) * cos(ang) + cos(phi) * sin(ang) * cos(th)) AS phi2 FROM r)
SELECT DISTINCT round(degrees(phi2), 6) AS lat, round(degrees(radians(lon) + atan2(sin(th) * sin(ang) * cos(phi), cos(ang) - sin(phi) * sin(phi2))), 6) AS lon FROM p""")
def _(t):
    return similar.geo_ring(t.sites, "lat", "lon", 30, 10)


@query("location_ranks", "location:i date:d rank:f", """
SELECT location, date, rank() OVER (PARTITION BY location ORDER BY temp) + (count(*) OVER (PARTITION BY location, temp) - 1) / 2.0 AS rank
FROM (SELECT location, date, max(temp) AS temp FROM v_weather GROUP BY 1, 2)""")
def _(t):
    return splits.average_ranks(t.weather.groupBy("location", "date").agg(F.max("temp").alias("temp")), ["location"], "temp")


@query("similar_day_accuracy", "pool:s mape:f mae:f n:i", f"""
WITH {FORECAST_SQL} SELECT pool, avg(abs(value - forecast) / nullif(abs(value), 0)) AS mape, avg(abs(value - forecast)) AS mae, count(value - forecast) AS n FROM bl GROUP BY 1""")
def _(t):
    return aggregates.mape(day_ahead.similar_day_forecast(t.long_blocks, ["pool"]), ["pool"], "value", "forecast")
