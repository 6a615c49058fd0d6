"""Registered queries: spines, projections, nulls, joins, aggregates, windows, latest, sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattframe.functions import blocks, scalars
from wattframe.operators import aggregates, latest, series, splits, windows
from wattframe.plans.registry import query

# ---- spines and projections ---------------------------------------------------------------------------


@query("unconstrained_load", "date:d block_no:i value:g powercut:g unconstrained:g", """
SELECT l.date, l.block_no, l.value, coalesce(c.cut, 0) AS powercut, l.value + coalesce(c.cut, 0) AS unconstrained
FROM v_load l LEFT JOIN v_cuts c ON c.date = l.date AND c.block_no = l.block_no""")
def _(t):
    return series.unconstrained_load(t.load, t.cuts, ["date", "block_no"], "value", "cut")


@query("energy_to_mw", "pool:s date:d block_no:i mw:g", """
SELECT pool, date, block_no, greatest((value - 100) * 4, 0) AS mw FROM v_pools""")
def _(t):
    return t.pools.withColumn("mw", scalars.energy_to_mw(F.col("value") - 100))


@query("clamped_values", "event_id:i clamped:f", """
SELECT event_id, least(greatest(value, 20), 200) AS clamped FROM events""")
def _(t):
    return t.events.withColumn("clamped", scalars.clamp(F.col("value"), 20.0, 200.0))


@query("cap_by_block_maximum", "date:d block_no:i value:g capped:g", """
WITH h AS (SELECT block_no, max(s) AS m FROM (SELECT date, block_no, sum(value) AS s FROM v_long GROUP BY 1, 2) GROUP BY 1)
SELECT l.date, l.block_no, l.value, CASE WHEN l.value > h.m THEN h.m ELSE l.value END AS capped
FROM v_load l LEFT JOIN h ON h.block_no = l.block_no""")
def _(t):
    return series.cap_by_max(t.load, t.long_blocks, "value")


@query("finite_rows", "key:i ratio:f", """
SELECT key, schedule / nullif(revision, 0) AS ratio FROM v_schedules WHERE revision <> 0""")
def _(t):
    inverse = F.when(F.col("revision") == 0, F.lit(float("inf"))).otherwise(F.col("schedule") / F.nullif(F.col("revision"), F.lit(0)))
    return series.finite_rows(t.schedules.withColumn("ratio", inverse), ["ratio"])


@query("fill_constant", "date:d block_no:i value:g", "SELECT date, block_no, coalesce(value, 0) AS value FROM v_grid")
def _(t):
    return series.fill_const(t.grid, {"value": 0.0})


@query("fill_from_column", "date:d block_no:i value:g", """
SELECT g.date, g.block_no, coalesce(g.value, c.cut) AS value FROM v_grid g LEFT JOIN v_cuts c USING (date, block_no)""")
def _(t):
    return series.fill_from(t.grid.join(t.cuts, ["date", "block_no"], "left"), "value", "cut")


@query("forward_fill", "pool:s date:d block_no:i filled:g", """
SELECT pool, date, block_no, last_value(value IGNORE NULLS) OVER
 (PARTITION BY pool ORDER BY date, block_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled FROM v_pool_grid""")
def _(t):
    return windows.ffill(t.pool_grid, ["pool"], ["date", "block_no"], "value", "filled", split="date")


@query("forward_fill_global", "date:d block_no:i filled:g", """
SELECT date, block_no, last_value(value IGNORE NULLS) OVER
 (ORDER BY date, block_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled FROM v_grid""")
def _(t):
    return windows.ffill(t.grid, [], ["date", "block_no"], "value", "filled", split="date")


@query("back_fill", "pool:s date:d block_no:i filled:g", """
SELECT pool, date, block_no, first_value(value IGNORE NULLS) OVER
 (PARTITION BY pool ORDER BY date, block_no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS filled FROM v_pool_grid""")
def _(t):
    return windows.bfill(t.pool_grid, ["pool"], ["date", "block_no"], "value", "filled", split="date")


@query("fill_down_cells", "sheet:i row_no:i label:s label_filled:s", """
WITH g AS (SELECT l_orderkey AS sheet, l_linenumber AS row_no, CASE WHEN max(l_quantity) > 25 THEN max(l_returnflag) ELSE '' END AS label
 FROM lineitem GROUP BY 1, 2)
SELECT sheet, row_no, label, last_value(nullif(trim(label), '') IGNORE NULLS) OVER
 (PARTITION BY sheet ORDER BY row_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS label_filled FROM g""")
def _(t):
    g = t.lineitem.groupBy(F.col("l_orderkey").alias("sheet"), F.col("l_linenumber").alias("row_no")).agg(
        F.when(F.max("l_quantity") > 25, F.max("l_returnflag")).otherwise("").alias("label")
    )
    return windows.fill_down(g, "row_no", ["label"], ["sheet"])


@query("nullify_tokens", "o_orderkey:i status:s price:g", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS status,
 CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE round(o_totalprice, 0) END AS price FROM orders""")
def _(t):
    raw = t.orders.select(
        "o_orderkey", F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_orderkey") % 5 == 0, "--").otherwise(F.round("o_totalprice", 0).cast("long").cast("string")).alias("price"),
    )
    return series.nullify_tokens(raw, ["P", "--", ""], ["price"])


@query("clean_records", "row_no:i n_cells:i last_cell:s", """
SELECT row_no, 5 AS n_cells, coalesce(cells[5], '') AS last_cell FROM v_records""")
def _(t):
    cleaned = series.clean_records(t.records, "cells", 5)
    return cleaned.select("row_no", F.size("cells").alias("n_cells"), F.element_at("cells", 5).alias("last_cell"))


@query("parse_any_format", "event_id:i parsed:t", """
SELECT event_id, CASE WHEN event_id % 4 = 3 THEN NULL ELSE date_trunc('minute', ts) END AS parsed FROM events""")
def _(t):
    f = lambda p: F.date_format("ts", p)
    k = F.col("event_id") % 4
    text = F.when(k == 0, f("dd-MM-yyyy HH:mm")).when(k == 1, f("yyyy/MM/dd HH:mm")).when(k == 2, f("MM.dd.yyyy HH:mm")).otherwise("soon")
    formats = ["dd-MM-yyyy HH:mm", "yyyy/MM/dd HH:mm", "MM.dd.yyyy HH:mm", "yyyyMMddHHmm"]
    return t.events.select("event_id", scalars.parse_any(text, formats).alias("parsed"))


@query("calendar_features", "o_orderkey:i year:i month:i weekday:i is_monday:i is_saturday:i is_sunday:i", """
SELECT o_orderkey, year(o_orderdate) AS year, month(o_orderdate) AS month, isodow(o_orderdate) - 1 AS weekday,
 CAST(isodow(o_orderdate) = 1 AS INT) AS is_monday, CAST(isodow(o_orderdate) = 6 AS INT) AS is_saturday,
 CAST(isodow(o_orderdate) = 7 AS INT) AS is_sunday FROM orders""")
def _(t):
    d = F.col("o_orderdate")
    return t.orders.select("o_orderkey", *[c.alias(n) for n, c in {**blocks.calendar_columns(d), **blocks.weekday_flags(d)}.items()])


@query("one_hot_pool", "event_id:i pool_view:i pool_click:i pool_error:i", """
SELECT event_id, CAST(event_type = 'view' AS INT) AS pool_view, CAST(event_type = 'click' AS INT) AS pool_click,
 CAST(event_type = 'error' AS INT) AS pool_error FROM events""")
def _(t):
    return series.one_hot(t.events, "event_type", ["view", "click", "error"], "pool")


@query("heat_response", "location:i date:d hour:i heat:f", """
SELECT location, date, hour, 100 / (1 + exp(-0.4 * ((CASE WHEN temp / 10 < 25 THEN 25 + 1.5 * (25 - temp / 10) ELSE temp / 10 END) - 38))) AS heat
FROM v_weather""")
def _(t):
    return t.weather.withColumn("heat", scalars.heat_response(F.col("temp") / 10))


@query("log_target", "event_id:i logged:f back:f", "SELECT event_id, ln(1 + value) AS logged, value AS back FROM events")
def _(t):
    logged = t.events.withColumn("logged", F.log1p("value"))
    return logged.withColumn("back", F.expm1("logged"))


@query("tagged_rows", "date:d block_no:i value:g state:s revision:i", """
SELECT date, block_no, value, 'STATE' AS state, 0 AS revision FROM v_load""")
def _(t):
    return series.tag(t.load, state="STATE", revision=0)


@query("classified_names", "p_partkey:i by_text:s by_member:s", """
SELECT p_partkey, CASE WHEN contains(p_name, 'red') THEN 'tie_line' WHEN contains(p_name, 'ring') THEN 'frequency'
 WHEN contains(p_name, 'widget') THEN 'demand' ELSE 'generation' END AS by_text,
 CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN 'AGGREGATE' ELSE 'INTERNAL' END AS by_member FROM part""")
def _(t):
    rules = {"red": "tie_line", "ring": "frequency", "widget": "demand"}
    return t.part.select(
        "p_partkey", scalars.classify_contains(F.col("p_name"), rules, "generation").alias("by_text"),
        scalars.classify_member(F.col("p_type"), ["ECONOMY", "PROMO"], "AGGREGATE", "INTERNAL").alias("by_member"),
    )


@query("clean_names", "s_suppkey:i name:s", "SELECT s_suppkey, s_name AS name FROM supplier")
def _(t):
    decorated = F.concat("s_name", F.lit(" ("), F.col("s_nationkey").cast("string"), F.lit(")"))
    return t.supplier.select("s_suppkey", scalars.strip_bracketed(decorated).alias("name"))


@query("bias_applied", "key:i revision:i adjusted:f", """
WITH x AS (SELECT key, revision, CASE WHEN revision % 3 = 0 THEN NULL ELSE schedule END AS q,
 CASE WHEN revision % 2 = 0 THEN NULL ELSE CAST(key % 4 AS DOUBLE) END AS b FROM v_schedules)
SELECT key, revision, CASE WHEN q IS NOT NULL THEN q + coalesce(b, 0) WHEN coalesce(b, 0) <> 0 THEN b END AS adjusted FROM x""")
def _(t):
    q = F.when(F.col("revision") % 3 != 0, F.col("schedule"))
    b = F.when(F.col("revision") % 2 != 0, (F.col("key") % 4).cast("double"))
    return t.schedules.withColumn("adjusted", scalars.apply_bias(q, b))


@query("contracts_valid_on_date", "o_orderkey:i o_custkey:i", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus <> 'F'
 AND CAST(o_orderdate AS DATE) <= DATE '1998-06-01' AND CAST(o_orderdate AS DATE) + 90 >= DATE '1998-06-01'""")
def _(t):
    dated = t.orders.select(
        "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("valid_from"), F.date_add("o_orderdate", 90).alias("valid_to"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("delete_ind"),
    )
    return series.as_valid(dated, F.to_date(F.lit("1998-06-01")), "valid_from", "valid_to", "delete_ind")


@query("table_page", "c_custkey:i c_name:s total:i filtered:i", """
SELECT c_custkey, c_name, (SELECT count(*) FROM customer) AS total,
 (SELECT count(*) FROM customer WHERE contains(lower(c_name), '77') OR contains(lower(c_mktsegment), '77')) AS filtered
FROM customer WHERE contains(lower(c_name), '77') OR contains(lower(c_mktsegment), '77')
ORDER BY c_mktsegment, c_custkey DESC LIMIT 10 OFFSET 5""")
def _(t):
    page = latest.table_page(t.customer, "77", ["c_mktsegment", F.desc("c_custkey")], 5, 10, ["c_name", "c_mktsegment"])
    return page


@query("rounded_values", "date:d block_no:i value:g", "SELECT date, block_no, round(value + 0.0004, 2) AS value FROM v_load")
def _(t):
    return series.round_cols(t.load.withColumn("value", F.col("value") + 0.0004), {"value": 2})


# ---- joins --------------------------------------------------------------------------------------------


@query("left_join_blocks", "date:d block_no:i value:g cut:g", """
SELECT l.date, l.block_no, l.value, c.cut FROM v_load l LEFT JOIN v_cuts c USING (date, block_no)""")
def _(t):
    return t.load.join(t.cuts, ["date", "block_no"], "left")


@query("inner_join_named_keys", "l_orderkey:i l_linenumber:i o_totalprice:g", """
SELECT l_orderkey, l_linenumber, o_totalprice FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_quantity > 40""")
def _(t):
    return t.lineitem.filter("l_quantity > 40").join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))


@query("full_join_blocks", "date:d block_no:i a:g b:g", """
SELECT date, block_no, a.value AS a, b.value AS b FROM (SELECT * FROM v_pools WHERE pool = 'view') a
FULL JOIN (SELECT * FROM v_pools WHERE pool = 'error') b USING (date, block_no)""")
def _(t):
    side = lambda p, n: t.pools.filter(F.col("pool") == p).select("date", "block_no", F.col("value").alias(n))
    return side("view", "a").join(side("error", "b"), ["date", "block_no"], "full")


@query("gap_filled_series", "pool:s date:d block_no:i value:g", "SELECT * FROM v_pool_grid")
def _(t):
    return t.pool_grid


@query("block_spine", "date:d block_no:i", """
SELECT d.date, b.block_no FROM (SELECT DISTINCT date FROM v_prices) d CROSS JOIN v_blocks b""")
def _(t):
    return series.block_spine(t.prices.select("date"))


@query("date_spine", "area:s date:d", """
SELECT area, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM v_prices GROUP BY area""")
def _(t):
    return series.span_spine(t.prices, ["area"]).filter("block_no = 1")


@query("dates_descending", "pos:i date:d", """
SELECT CAST(row_number() OVER (ORDER BY date DESC) - 1 AS INTEGER) AS pos, date FROM (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM v_load)""")
def _(t):
    first, last = t.load.agg(F.min("date"), F.max("date")).first()
    return series.date_spine(t.load.sparkSession, str(first), str(last), descending=True)


@query("new_keys_only", "c_custkey:i", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def _(t):
    return series.new_keys(t.customer, t.orders.filter("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query("keep_known_keys", "o_orderkey:i o_totalprice:g", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)""")
def _(t):
    wanted = t.lineitem.filter("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"))
    return series.keep_keys(t.orders, wanted, ["o_orderkey"])


@query("lookup_first_match", "s_suppkey:i c_name:s", """
SELECT s_suppkey, (SELECT c_name FROM customer c WHERE c.c_nationkey = s.s_nationkey ORDER BY c_custkey LIMIT 1) AS c_name FROM supplier s""")
def _(t):
    dim = t.customer.withColumnRenamed("c_nationkey", "s_nationkey")
    return series.lookup(t.supplier, dim, "s_nationkey", ["c_custkey"], ["c_name"])


@query("aligned_models", "date:d block_no:i view:g click:g error:g", """
SELECT date, block_no, max(CASE WHEN pool = 'view' THEN value END) AS view, max(CASE WHEN pool = 'click' THEN value END) AS click,
 max(CASE WHEN pool = 'error' THEN value END) AS error FROM v_pools WHERE pool IN ('view', 'click', 'error') GROUP BY 1, 2""")
def _(t):
    frames = {p: t.pools.filter(F.col("pool") == p) for p in ("view", "click", "error")}
    return series.align(frames, ["date", "block_no"], "value")


@query("band_of_schedule", "l_orderkey:i l_linenumber:i unit:s l_quantity:f band:i", """
SELECT l_orderkey, l_linenumber, f.unit, l_quantity, band FROM (SELECT *, 'Brand#' || CAST(l_suppkey % 25 + 1 AS VARCHAR) AS unit FROM lineitem) f
LEFT JOIN v_bands b ON b.unit = f.unit AND f.l_quantity > b.low AND f.l_quantity <= b.high""")
def _(t):
    facts = t.lineitem.withColumn("unit", F.concat(F.lit("Brand#"), (F.col("l_suppkey") % 25 + 1).cast("string")))
    return series.band_join(facts, t.bands, ["unit"], "l_quantity", "low", "high")


@query("band_of_schedule_closed", "key:i revision:i unit:s band:i", """
SELECT key, revision, f.unit, band FROM (SELECT *, 'Brand#' || CAST(key % 25 + 1 AS VARCHAR) AS unit FROM v_schedules) f
LEFT JOIN v_bands b ON b.unit = f.unit AND f.schedule >= b.low AND f.schedule <= b.high""")
def _(t):
    facts = t.schedules.withColumn("unit", F.concat(F.lit("Brand#"), (F.col("key") % 25 + 1).cast("string")))
    return series.band_join(facts, t.bands, ["unit"], "schedule", "low", "high", "both")


@query("block_of_time", "event_id:i block_no:i hour_no:i start_time:s end_time:s", """
SELECT event_id, b AS block_no, ceil(b / 4) AS hour_no, printf('%02d:%02d', (b - 1) * 15 // 60, (b - 1) * 15 % 60) AS start_time,
 printf('%02d:%02d', b * 15 // 60, b * 15 % 60) AS end_time
FROM (SELECT event_id, CAST(floor((hour(ts) * 60 + minute(ts)) / 15) AS INTEGER) + 1 AS b FROM events)""")
def _(t):
    b = F.col("block_no")
    return t.events.select("event_id", blocks.block_of(F.col("ts")).alias("block_no")).select(
        "event_id", b, blocks.hour_of_block(b).alias("hour_no"), blocks.block_start(b).alias("start_time"), blocks.block_end(b).alias("end_time")
    )


@query("revision_gate", "event_id:i block_no:i day_shift:i first_block:i", """
WITH g AS (SELECT * FROM (VALUES (4, 0, 1), (9, 0, 13), (15, 0, 19), (21, 0, 25), (27, 0, 31), (33, 0, 37), (39, 0, 43), (45, 0, 49),
 (51, 0, 55), (57, 0, 61), (63, 0, 67), (69, 0, 73), (75, 0, 79), (81, 0, 85), (87, 0, 91), (93, 1, 1)) v(gate, s, f)),
m AS (SELECT r.event_id, r.block_no, min(gate) AS gate FROM v_readings r LEFT JOIN g ON g.gate >= r.block_no GROUP BY 1, 2)
SELECT event_id, block_no, coalesce(s, 1) AS day_shift, coalesce(f, 1) AS first_block FROM m LEFT JOIN g USING (gate)""")
def _(t):
    return t.readings.select("event_id", "block_no", blocks.revision_gate(F.col("block_no")).alias("g")).select("event_id", "block_no", "g.*")


@query("costs_in_force", "o_orderkey:i valid_from:d cost:g", """
WITH d AS (SELECT o_orderpriority AS area, CAST(date_trunc('month', o_orderdate) AS DATE) AS valid_from,
 last_day(o_orderdate) AS valid_to, avg(o_totalprice) AS cost FROM orders GROUP BY 1, 2, 3)
SELECT o_orderkey, valid_from, cost FROM orders JOIN d ON area = o_orderpriority AND CAST(o_orderdate AS DATE) BETWEEN valid_from AND valid_to""")
def _(t):
    dated = t.orders.withColumn("area", F.col("o_orderpriority")).withColumn("date", F.to_date("o_orderdate"))
    dim = dated.groupBy("area", F.trunc("date", "month").alias("valid_from"), F.last_day("date").alias("valid_to")).agg(F.avg("o_totalprice").alias("cost"))
    return series.in_force(dated.select("o_orderkey", "area", "date"), dim, ["area"], "date", "valid_from", "valid_to")


@query("paired_difference", "area:s date:d price_diff:g", """
SELECT a.area, a.date, a.price - b.price AS price_diff FROM v_prices a LEFT JOIN v_prices b ON b.area = a.area AND b.date = a.date - 7""")
def _(t):
    pairs = t.prices.select("date").distinct().withColumn("lag_date", F.date_sub("date", 7))
    return series.paired_difference(t.prices, pairs, ["area"], ["price"])


@query("aligned_by_key", "l_orderkey:i l_linenumber:i a:f b:f", """
WITH a AS (SELECT l_orderkey, l_linenumber, max(l_quantity) AS a FROM lineitem GROUP BY 1, 2),
 b AS (SELECT l_orderkey, l_linenumber, max(l_discount) AS b FROM lineitem GROUP BY 1, 2)
SELECT l_orderkey, l_linenumber, a, b FROM a JOIN b USING (l_orderkey, l_linenumber)""")
def _(t):
    key = ["l_orderkey", "l_linenumber"]
    left = t.lineitem.groupBy(*key).agg(F.max("l_quantity").alias("a"))
    right = t.lineitem.groupBy(*key).agg(F.max("l_discount").alias("b"))
    return left.join(right, key)


# ---- aggregates ---------------------------------------------------------------------------------------


@query("block_totals", "date:d block_no:i total:g", "SELECT date, block_no, sum(value) AS total FROM v_long GROUP BY 1, 2")
def _(t):
    return aggregates.block_total(t.long_blocks, ["date", "block_no"], "value", "total")


@query("daily_profile", "pool:s date:d value_min:f value_max:f value_median:f", """
SELECT pool, date, min(value) AS value_min, max(value) AS value_max, median(value) AS value_median FROM v_long GROUP BY 1, 2""")
def _(t):
    return aggregates.profile(t.long_blocks, ["pool", "date"], ["value"])


@query("daily_profile_mean", "date:d value_min:f value_max:f value_mean:f", """
SELECT date, min(value) AS value_min, max(value) AS value_max, avg(value) AS value_mean FROM v_load GROUP BY 1""")
def _(t):
    return aggregates.profile(t.load, ["date"], ["value"], "mean")


@query("weather_profile", "location:i date:d temp_min:f temp_max:f temp_median:f rain_median:f", """
SELECT location, date, min(temp) AS temp_min, max(temp) AS temp_max, median(temp) AS temp_median, median(rain) AS rain_median
FROM v_weather GROUP BY 1, 2""")
def _(t):
    return aggregates.profile(t.weather, ["location", "date"], ["temp", "rain"])


@query("month_block_median", "month:i block_no:i shape:f", """
SELECT month(date) AS month, block_no, median(value) AS shape FROM v_long GROUP BY 1, 2""")
def _(t):
    return aggregates.shape_median(t.long_blocks.withColumn("month", F.month("date")), ["month", "block_no"], "value", "shape", spread=True)


@query("month_block_weekday_median", "month:i block_no:i weekday:i shape:f", """
SELECT month(date) AS month, block_no, isodow(date) - 1 AS weekday, median(value) AS shape FROM v_long GROUP BY 1, 2, 3""")
def _(t):
    dated = t.long_blocks.withColumn("month", F.month("date")).withColumn("weekday", F.weekday("date"))
    return aggregates.shape_median(dated, ["month", "block_no", "weekday"], "value", "shape", spread=True)


@query("event_block_median", "name:s block_no:i shape:f", """
SELECT name, block_no, median(value) AS shape FROM v_load JOIN v_calendar USING (date) GROUP BY 1, 2""")
def _(t):
    return aggregates.shape_median(t.load.join(t.calendar, "date"), ["name", "block_no"], "value", "shape")


@query("day_completeness", "pool:s date:d present:i complete:i", """
SELECT pool, date, count(value) AS present, CAST(count(value) = 96 AS INT) AS complete FROM v_pool_grid GROUP BY 1, 2""")
def _(t):
    return aggregates.day_completeness(t.pool_grid, ["pool"], "value")


@query("column_coverage", "pool:s n_rows:i share_value:f keep:i", """
WITH c AS (SELECT pool, count(*) AS n_rows, count(value) AS nv FROM v_pool_grid GROUP BY 1)
SELECT pool, n_rows, nv / (SELECT max(n_rows) FROM c) AS share_value, CAST(nv / (SELECT max(n_rows) FROM c) > 0.5 AS INT) AS keep FROM c""")
def _(t):
    return aggregates.coverage(t.pool_grid, "pool", ["value"])


@query("pivot_by_pool", "date:d block_no:i p_view:g p_click:g p_purchase:g", """
SELECT date, block_no, avg(CASE WHEN pool = 'view' THEN value END) AS p_view, avg(CASE WHEN pool = 'click' THEN value END) AS p_click,
 avg(CASE WHEN pool = 'purchase' THEN value END) AS p_purchase FROM v_pools GROUP BY 1, 2""")
def _(t):
    return aggregates.pivot_cols(t.pools, ["date", "block_no"], "pool", ["view", "click", "purchase"], "value", "p_")


@query("melted_measures", "l_orderkey:i l_linenumber:i measure:s reading:f", """
SELECT l_orderkey, l_linenumber, 'l_discount' AS measure, l_discount AS reading FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM lineitem""")
def _(t):
    return aggregates.melt(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_discount", "l_tax"], "measure", "reading", True)


@query("hourly_maximum", "date:d hour:i value_max:g", """
SELECT date, ceil(block_no / 4) AS hour, max(value) AS value_max FROM v_load GROUP BY 1, 2""")
def _(t):
    return aggregates.hourly_max(t.load, [], "value")


@query("hourly_location_median", "date:d hour:i temp:f", """
SELECT date, hour, median(temp) AS temp FROM v_weather GROUP BY 1, 2""")
def _(t):
    return aggregates.shape_median(t.weather, ["date", "hour"], "temp", "temp")


@query("multi_aggregate", "date:d temp_min:f temp_max:f temp_mean:f rain_mean:f wind_max:f", """
SELECT date, min(temp) AS temp_min, max(temp) AS temp_max, avg(temp) AS temp_mean, avg(rain) AS rain_mean, max(wind) AS wind_max
FROM v_weather GROUP BY 1""")
def _(t):
    return aggregates.multi_agg(t.weather, ["date"], ["temp", "rain", "wind"])


BINS_SQL = "WITH x AS (SELECT l_quantity, CAST(least(floor(l_quantity / 10), 4) AS INT) AS fbin, CAST(floor(l_discount * 40 + 0.01) AS INT) AS abin FROM lineitem)"


def _bin_pairs(t):
    return t.lineitem.select(
        F.least(F.floor(F.col("l_quantity") / 10), F.lit(4)).cast("int").alias("fbin"), F.floor(F.col("l_discount") * 40 + 0.01).cast("int").alias("abin")
    )


@query("bin_calibration", "fbin:i abin:i n:i share:f", BINS_SQL + """
SELECT fbin, abin, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY fbin) AS share FROM x GROUP BY 1, 2""")
def _(t):
    return aggregates.bin_calibration(_bin_pairs(t), "fbin", "abin")


@query("expected_bin", "fbin:i expected_bin:f", BINS_SQL + " SELECT fbin, avg(abin) AS expected_bin FROM x GROUP BY 1")
def _(t):
    return aggregates.expected_bin(aggregates.bin_calibration(_bin_pairs(t), "fbin", "abin"), "fbin", "abin")


@query("with_company_total", "date:d block_no:i pool:s value:g", """
SELECT date, block_no, pool, value FROM v_pools UNION ALL SELECT date, block_no, 'COMPANY', sum(value) FROM v_pools GROUP BY 1, 2""")
def _(t):
    return aggregates.with_total(t.pools, ["date", "block_no"], "pool", "COMPANY", ["value"], [])


@query("maximum_of_sums", "block_no:i top:g", """
SELECT block_no, max(s) AS top FROM (SELECT date, block_no, sum(value) AS s FROM v_long GROUP BY 1, 2) GROUP BY 1""")
def _(t):
    return series.max_of_sums(t.long_blocks, ["block_no"], ["date"], "value", "top")


@query("first_per_key", "o_custkey:i o_orderkey:i", """
SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r FROM orders) WHERE r = 1""")
def _(t):
    return latest.dedupe(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query("error_summary", "l_returnflag:s mape:f mae:g n:i", """
SELECT l_returnflag, avg(abs(l_extendedprice - l_quantity * 1500) / nullif(abs(l_extendedprice), 0)) AS mape,
 avg(abs(l_extendedprice - l_quantity * 1500)) AS mae, count(*) AS n FROM lineitem GROUP BY 1""")
def _(t):
    return aggregates.mape(t.lineitem.withColumn("pred", F.col("l_quantity") * 1500), ["l_returnflag"], "l_extendedprice", "pred")


@query("error_describe", "l_returnflag:s n:i mean:g std:g min:g max:g q25:g q50:g q75:g", """
SELECT l_returnflag, count(*) AS n, avg(l_extendedprice) AS mean, stddev_samp(l_extendedprice) AS std, min(l_extendedprice) AS min,
 max(l_extendedprice) AS max, quantile_cont(l_extendedprice, 0.25) AS q25, quantile_cont(l_extendedprice, 0.5) AS q50,
 quantile_cont(l_extendedprice, 0.75) AS q75 FROM lineitem GROUP BY 1""")
def _(t):
    return aggregates.describe(t.lineitem, ["l_returnflag"], "l_extendedprice")


@query("row_statistics", "date:d block_no:i med:g mean:g top:g low:g", """
WITH a AS (SELECT date, block_no, max(CASE WHEN pool = 'view' THEN value END) AS a, max(CASE WHEN pool = 'click' THEN value END) AS b,
 max(CASE WHEN pool = 'error' THEN value END) AS c FROM v_pools WHERE pool IN ('view', 'click', 'error') GROUP BY 1, 2)
SELECT date, block_no, list_median([x FOR x IN [a, b, c] IF x IS NOT NULL]) AS med, list_avg([a, b, c]) AS mean,
 greatest(a, b, c) AS top, least(a, b, c) AS low FROM a""")
def _(t):
    names = ("view", "click", "error")
    wide = series.align({p: t.pools.filter(F.col("pool") == p) for p in names}, ["date", "block_no"], "value")
    cols = [F.col(n) for n in names]
    return wide.select(
        "date", "block_no", scalars.row_median(cols).alias("med"), scalars.row_mean(cols).alias("mean"),
        scalars.row_max(cols).alias("top"), scalars.row_min(cols).alias("low"),
    )


@query("position_map", "date:d nation:i total:g", """
SELECT CAST(l_shipdate AS DATE) AS date, s_nationkey AS nation, sum(l_quantity) AS total FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1, 2""")
def _(t):
    facts = t.lineitem.select(F.to_date("l_shipdate").alias("date"), F.col("l_suppkey").alias("unit"), "l_quantity")
    dims = t.supplier.select(F.col("s_suppkey").alias("unit"), F.col("s_nationkey").alias("nation"))
    return aggregates.position_totals(facts, dims, "unit", ["date", "nation"], "l_quantity", "total")


@query("residual_profile", "weekday:i block_no:i residual:f", """
SELECT isodow(date) - 1 AS weekday, block_no, avg(price - forecast) AS residual FROM v_price_blocks GROUP BY 1, 2""")
def _(t):
    return aggregates.residual_profile(t.price_blocks.withColumn("weekday", F.weekday("date")), ["weekday", "block_no"], "price", "forecast")


# ---- windows ------------------------------------------------------------------------------------------


@query("average_rank", "area:s date:d price:g rank:f", """
SELECT area, date, price, rank() OVER (PARTITION BY area ORDER BY price) + (count(*) OVER (PARTITION BY area, price) - 1) / 2.0 AS rank FROM v_prices""")
def _(t):
    return splits.average_ranks(t.prices, ["area"], "price")


@query("average_rank_global", "event_id:i rank:f", """
SELECT event_id, rank() OVER (ORDER BY value) + (count(*) OVER (PARTITION BY value) - 1) / 2.0 AS rank FROM events""")
def _(t):
    return splits.average_ranks(t.events.select("event_id", "value"), [], "value", stored=True)


@query("row_lags", "area:s date:d price_lag1:g price_lag7:g", """
SELECT area, date, lag(price, 1) OVER w AS price_lag1, lag(price, 7) OVER w AS price_lag7 FROM v_prices
WINDOW w AS (PARTITION BY area ORDER BY date)""")
def _(t):
    return windows.lags(t.prices, ["area"], ["date"], "price", [1, 7])


@query("reading_lags", "event_id:i value_lag1:f value_lag4:f", """
SELECT event_id, lag(value, 1) OVER w AS value_lag1, lag(value, 4) OVER w AS value_lag4 FROM events
WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)""")
def _(t):
    return windows.lags(t.readings, ["pool"], ["ts", "event_id"], "value", [1, 4], split="slot")


@query("calendar_lags", "pool:s date:d block_no:i value:f value_d1:f value_d7:f", """
SELECT a.pool, a.date, a.block_no, a.value, b.value AS value_d1, c.value AS value_d7 FROM v_long a
LEFT JOIN v_long b ON b.pool = a.pool AND b.block_no = a.block_no AND b.date = a.date - 1
LEFT JOIN v_long c ON c.pool = a.pool AND c.block_no = a.block_no AND c.date = a.date - 7""")
def _(t):
    return windows.calendar_lags(t.long_blocks, ["pool", "block_no"], "date", ["value"], [1, 7])


@query("neighbour_mean_fill", "pool:s date:d block_no:i filled:g", """
SELECT pool, date, block_no, coalesce(value, (lag(value) OVER w + lead(value) OVER w) / 2) AS filled FROM v_pool_grid
WINDOW w AS (PARTITION BY pool, date ORDER BY block_no)""")
def _(t):
    return windows.impute_neighbours(t.pool_grid, ["pool", "date"], ["block_no"], "value", "filled")


@query("rolling_trailing", "area:s date:d mean11:g std15:g", """
SELECT area, date, CASE WHEN count(price) OVER a >= 11 THEN avg(price) OVER a END AS mean11,
 CASE WHEN count(price) OVER b >= 15 THEN stddev_samp(price) OVER b END AS std15 FROM v_prices
WINDOW a AS (PARTITION BY area ORDER BY date ROWS 10 PRECEDING), b AS (PARTITION BY area ORDER BY date ROWS 14 PRECEDING)""")
def _(t):
    first = windows.rolling(t.prices, ["area"], ["date"], "price", 11, {"mean11": "mean"})
    return windows.rolling(first, ["area"], ["date"], "price", 15, {"std15": "std"})


@query("rolling_readings", "event_id:i mean11:f median11:f", """
SELECT event_id, CASE WHEN count(value) OVER a >= 11 THEN avg(value) OVER a END AS mean11,
 CASE WHEN count(value) OVER a >= 11 THEN quantile_cont(value, 0.5) OVER a END AS median11 FROM events
WINDOW a AS (PARTITION BY event_type ORDER BY ts, event_id ROWS 10 PRECEDING)""")
def _(t):
    return windows.rolling(t.readings, ["pool"], ["ts", "event_id"], "value", 11, {"mean11": "mean", "median11": "median"}, split="slot")


@query("rolling_centred", "area:s date:d mean5:g mean4:g med3:g", """
SELECT area, date, CASE WHEN count(price) OVER a >= 5 THEN avg(price) OVER a END AS mean5,
 CASE WHEN count(price) OVER b >= 4 THEN avg(price) OVER b END AS mean4,
 CASE WHEN count(price) OVER c >= 3 THEN quantile_cont(price, 0.5) OVER c END AS med3 FROM v_prices
WINDOW a AS (PARTITION BY area ORDER BY date ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING),
 b AS (PARTITION BY area ORDER BY date ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING),
 c AS (PARTITION BY area ORDER BY date ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)""")
def _(t):
    df = windows.rolling(t.prices, ["area"], ["date"], "price", 5, {"mean5": "mean"}, center=True)
    df = windows.rolling(df, ["area"], ["date"], "price", 4, {"mean4": "mean"}, center=True)
    return windows.rolling(df, ["area"], ["date"], "price", 3, {"med3": "median"}, center=True)


@query("rolling_lag_features", "area:s date:d price_mean48:g price_median48:g price_min48:g price_max48:g price_std48:g", """
SELECT area, date, avg(price) OVER w AS price_mean48, quantile_cont(price, 0.5) OVER w AS price_median48, min(price) OVER w AS price_min48,
 max(price) OVER w AS price_max48, CASE WHEN count(price) OVER w > 1 THEN stddev_samp(price) OVER w END AS price_std48 FROM v_prices
WINDOW w AS (PARTITION BY area ORDER BY date ROWS 47 PRECEDING)""")
def _(t):
    return windows.lag_features(t.prices, ["area"], ["date"], "price", 48)


@query("rolling_skewness", "location:i hour:i date:d skew:f", """
WITH d AS (SELECT *, sum(wind) OVER w AS s1, sum(wind * wind) OVER w AS s2, sum(wind * wind * wind) OVER w AS s3, count(wind) OVER w AS n FROM v_weather
 WINDOW w AS (PARTITION BY location, hour ORDER BY date ROWS 9 PRECEDING)),
m AS (SELECT *, s1 / n AS mu, s2 / n - (s1 / n) * (s1 / n) AS v, s3 / n - 3 * (s1 / n) * (s2 / n) + 2 * (s1 / n) * (s1 / n) * (s1 / n) AS k3 FROM d)
SELECT location, hour, date, CASE WHEN n >= 10 THEN round(k3 / pow(v, 1.5), 4) END AS skew FROM m""")
def _(t):
    rolled = windows.rolling(t.weather, ["location", "hour"], ["date"], "wind", 10, {"skew": "skew"})
    return rolled.withColumn("skew", F.round("skew", 4))


@query("running_sum_cost_order", "date:d unit:i cost:g cum:f", """
SELECT date, unit, cost, sum(volume) OVER (PARTITION BY date ORDER BY cost, unit ROWS UNBOUNDED PRECEDING) AS cum FROM v_merit""")
def _(t):
    placed = splits.with_value_pieces(t.merit, "cost")
    return windows.running_sum(placed, ["date"], ["cost", "unit"], "volume", "cum", split="_piece")


@query("running_sum_readings", "event_id:i cum:g", """
SELECT event_id, sum(value) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS cum FROM events""")
def _(t):
    return windows.running_sum(t.readings, ["pool"], ["ts", "event_id"], "value", "cum", split="slot")


FLAG_SQL = "SELECT pool, date, block_no, CAST(coalesce(value, 0) > 60 AS INT) AS flag FROM v_pool_grid"


def _flags(t):
    return t.pool_grid.select("pool", "date", "block_no", (F.coalesce("value", F.lit(0.0)) > 60).cast("int").alias("flag"))


@query("run_edges", "pool:s date:d block_no:i flag:i edge:i", f"""
SELECT pool, date, block_no, flag, CAST(sum(flag) OVER past = 4 OR sum(flag) OVER ahead = 4 AS INT) AS edge FROM ({FLAG_SQL})
WINDOW past AS (PARTITION BY pool, date ORDER BY block_no ROWS BETWEEN 3 PRECEDING AND CURRENT ROW),
 ahead AS (PARTITION BY pool, date ORDER BY block_no ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING)""")
def _(t):
    return windows.run_edges(_flags(t), ["pool", "date"], ["block_no"], "flag", 4)


@query("whole_runs", "pool:s date:d block_no:i in_run:i", f"""
WITH f AS ({FLAG_SQL}), s AS (SELECT *, CASE WHEN lag(flag) OVER (PARTITION BY pool, date ORDER BY block_no) = flag THEN 0 ELSE 1 END AS nw FROM f),
g AS (SELECT *, sum(nw) OVER (PARTITION BY pool, date ORDER BY block_no ROWS UNBOUNDED PRECEDING) AS run FROM s)
SELECT pool, date, block_no, CAST(flag = 1 AND count(*) OVER (PARTITION BY pool, date, run) >= 4 AS INT) AS in_run FROM g""")
def _(t):
    return windows.in_run(_flags(t), ["pool", "date"], ["block_no"], "flag", 4)


@query("shape_ratio", "date:d block_no:i shape:f", """
SELECT date, block_no, value / nullif(lag(value) OVER (PARTITION BY date ORDER BY block_no), 0) AS shape FROM v_load""")
def _(t):
    return windows.shape_ratio(t.load, ["date"], ["block_no"], "value")


MAD_SQL = """
m AS (SELECT date, block_no, price, forecast, CASE WHEN count(*) OVER w >= 11 THEN avg(price - forecast) OVER w END AS mu FROM v_price_blocks
 WINDOW w AS (PARTITION BY block_no ORDER BY date ROWS 10 PRECEDING)),
d AS (SELECT *, abs(price - forecast - mu) AS dev FROM m),
q AS (SELECT *, CASE WHEN count(dev) OVER w >= 11 THEN quantile_cont(dev, 0.5) OVER w END AS md FROM d
 WINDOW w AS (PARTITION BY block_no ORDER BY date ROWS 10 PRECEDING)),
b AS (SELECT *, coalesce(md, lag(md) OVER (PARTITION BY block_no ORDER BY date)) AS mad FROM q)"""


def mad_frame(t):
    res = t.price_blocks.withColumn("res", F.col("price") - F.col("forecast"))
    return windows.rolling_mad(res, ["block_no"], ["date"], "res")


@query("rolling_residual_band", "date:d block_no:i mad:f", f"WITH {MAD_SQL} SELECT date, block_no, mad FROM b")
def _(t):
    return mad_frame(t)


@query("descending_date_key", "date:d area:s date_key:i", """
SELECT date, area, dense_rank() OVER (ORDER BY date DESC) - 1 AS date_key FROM v_prices""")
def _(t):
    return windows.descending_key(t.prices, "date")


@query("window_numbers", "date:d block_no:i window_no:i window_pos:i", """
SELECT date, block_no, (block_no - 1) // 4 + 1 AS window_no, (block_no - 1) % 4 + 1 AS window_pos FROM v_grid""")
def _(t):
    return windows.window_id(t.grid, "block_no", 4)


# ---- order, latest, sets ------------------------------------------------------------------------------


@query("ordered_blocks", "date:d block_no:i pool:s value:g", "SELECT date, block_no, pool, value FROM v_pools ORDER BY date, block_no DESC, pool")
def _(t):
    return t.pools.orderBy("date", F.desc("block_no"), "pool")


@query("top_k_per_key", "pool:s date:d block_no:i value:f rank:i", """
SELECT * FROM (SELECT pool, date, block_no, value, row_number() OVER (PARTITION BY pool, date ORDER BY value DESC, block_no) AS rank FROM v_long) WHERE rank <= 3""")
def _(t):
    return latest.top_k(t.long_blocks, ["pool", "date"], [F.desc("value"), "block_no"], 3)


@query("latest_date_rows", "pool:s block_no:i value:f", "SELECT pool, block_no, value FROM v_long WHERE date = (SELECT max(date) FROM v_long)")
def _(t):
    return latest.latest_slice(t.long_blocks)


@query("latest_block_rows", "pool:s date:d block_no:i value:g", """
SELECT pool, date, block_no, value FROM v_pools WHERE date = (SELECT max(date) FROM v_pools)
 AND block_no = (SELECT max(block_no) FROM v_pools WHERE date = (SELECT max(date) FROM v_pools))""")
def _(t):
    return latest.latest_slice(t.pools, ["date", "block_no"])


@query("latest_revision", "key:i revision:i schedule:f", """
SELECT key, revision, schedule FROM v_schedules s WHERE revision = (SELECT max(revision) FROM v_schedules m WHERE m.key = s.key)""")
def _(t):
    return latest.latest_revision(t.schedules, ["key"])


@query("latest_revision_of_table", "key:i schedule:f", "SELECT key, schedule FROM v_schedules WHERE revision = (SELECT max(revision) FROM v_schedules)")
def _(t):
    return latest.max_revision(t.schedules)


@query("next_revision", "o_orderkey:i next_revision:i", """
SELECT o_orderkey, coalesce(max(revision) + 1, 0) AS next_revision FROM orders LEFT JOIN v_schedules ON key = o_orderkey GROUP BY 1""")
def _(t):
    wanted = t.orders.select(F.col("o_orderkey").alias("key")).distinct()
    return latest.next_revision_for(wanted, t.schedules, ["key"]).withColumnRenamed("key", "o_orderkey")


@query("latest_run_or_default", "c_custkey:i o_orderkey:i status:s", """
SELECT c_custkey, coalesce(max(o_orderkey), -1) AS o_orderkey, coalesce(arg_max(o_orderstatus, o_orderkey), 'NONE') AS status
FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1""")
def _(t):
    runs = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", F.col("o_orderstatus").alias("status"))
    defaults = t.customer.select("c_custkey", F.lit(-1).cast("long").alias("o_orderkey"), F.lit("NONE").alias("status"))
    return latest.latest_or_default(runs, defaults, "c_custkey", "o_orderkey", ["o_orderkey", "status"])


@query("stacked_frames", "date:d block_no:i value:g cut:g", """
SELECT date, block_no, value, NULL::DOUBLE AS cut FROM v_load UNION ALL SELECT date, block_no, NULL, cut FROM v_cuts""")
def _(t):
    return series.stack(t.load.select("date", "block_no", "value"), t.cuts)


@query("union_all_positions", "date:d value:f", """
SELECT date, value FROM v_long WHERE pool = 'A' UNION ALL SELECT date, value FROM v_long WHERE pool <> 'A'""")
def _(t):
    part = t.long_blocks.select("date", "value", "pool")
    return part.filter("pool = 'A'").unionAll(part.filter("pool <> 'A'"))


@query("new_rows_only", "k:i q:f f:s", """
SELECT l_orderkey AS k, l_quantity AS q, l_returnflag AS f FROM lineitem a WHERE NOT EXISTS
 (SELECT 1 FROM lineitem b WHERE b.l_linenumber <= 3 AND b.l_orderkey = a.l_orderkey AND b.l_quantity = a.l_quantity AND b.l_returnflag = a.l_returnflag)""")
def _(t):
    rows = t.lineitem.select(F.col("l_orderkey").alias("k"), F.col("l_quantity").alias("q"), F.col("l_returnflag").alias("f"), "l_linenumber")
    return series.new_rows(rows.drop("l_linenumber"), rows.filter("l_linenumber <= 3").drop("l_linenumber"))


@query("new_rows_as_set", "k:i f:s", """
SELECT l_orderkey AS k, l_returnflag AS f FROM lineitem EXCEPT SELECT l_orderkey, l_returnflag FROM lineitem WHERE l_linenumber <= 3""")
def _(t):
    rows = t.lineitem.select(F.col("l_orderkey").alias("k"), F.col("l_returnflag").alias("f"), "l_linenumber")
    return series.new_rows(rows.drop("l_linenumber"), rows.filter("l_linenumber <= 3").drop("l_linenumber"), keep_duplicates=False)


@query("common_keys", "k:i", "SELECT l_orderkey AS k FROM lineitem WHERE l_quantity > 40 INTERSECT SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'")
def _(t):
    a = t.lineitem.filter("l_quantity > 40").select(F.col("l_orderkey").alias("k"))
    return series.common_keys(a, t.orders.filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("k")), ["k"])


@query("units_without_internal", "unit:i", "SELECT DISTINCT l_suppkey AS unit FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)")
def _(t):
    imports = t.lineitem.select(F.col("l_suppkey").alias("unit")).distinct()
    return series.new_keys(imports, t.supplier.filter("s_acctbal > 0").select(F.col("s_suppkey").alias("unit")), ["unit"])


@query("concatenated_sorted", "date:d block_no:i value:g", """
SELECT date, block_no, value FROM v_pools WHERE pool = 'view' UNION ALL SELECT date, block_no, value FROM v_pools WHERE pool = 'error' ORDER BY 1, 2, 3""")
def _(t):
    part = lambda p: t.pools.filter(F.col("pool") == p).select("date", "block_no", "value")
    return series.stack(part("view"), part("error")).orderBy("date", "block_no", "value")
