"""Registered queries: dispatch, positions, bids, merge semantics and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattframe.functions.scalars import normal_quantile
from wattframe.operators import dispatch, forecast, latest, series, splits
from wattframe.plans.ask_basics import MAD_SQL, mad_frame
from wattframe.plans.registry import query
from wattframe.sinks import merge

# ---- limits and surrender -----------------------------------------------------------------------------


@query("ramp_profile", "unit:s low:i band_minutes:f total_minutes:f band_blocks:i total_blocks:i", """
SELECT unit, low, (high - low) / nullif(rate_up, 0) AS band_minutes, sum((high - low) / nullif(rate_up, 0)) OVER w AS total_minutes,
 ceil(((high - low) / nullif(rate_up, 0)) / 15) AS band_blocks, ceil((sum((high - low) / nullif(rate_up, 0)) OVER w) / 15) AS total_blocks
FROM v_bands WINDOW w AS (PARTITION BY unit ORDER BY low ROWS UNBOUNDED PRECEDING)""")
def _(t):
    return dispatch.ramp_profile(t.bands, "unit", "low", "high", "rate_up")


LIMIT_SQL = """
lim AS (SELECT key, revision, schedule, share, greatest(coalesce(low, schedule - schedule * share), 0) AS low_limit, greatest(coalesce(high, schedule), 0) AS high_limit,
 greatest(coalesce(rate_up * 15, schedule), 0) AS ramp_up, greatest(coalesce(rate_down * 15, schedule * share), 0) AS ramp_down
 FROM (SELECT s.*, 'Brand#' || CAST(key % 30 + 1 AS VARCHAR) AS unit, 0.1 + key % 3 * 0.2 AS share FROM v_schedules s) f
 LEFT JOIN v_bands b ON b.unit = f.unit AND f.schedule > b.low AND f.schedule <= b.high)"""


def _limits(t):
    facts = t.schedules.withColumn("unit", F.concat(F.lit("Brand#"), (F.col("key") % 30 + 1).cast("string"))).withColumn(
        "share", 0.1 + F.col("key") % 3 * 0.2
    )
    bands = t.bands.select(
        "unit", "low", "high", F.col("low").alias("cap_low_limit"), F.col("high").alias("cap_upper_limit"),
        F.col("rate_up").alias("ramp_up_mw_min"), F.col("rate_down").alias("ramp_down_mw_min"),
    )
    banded = series.band_join(facts, bands, ["unit"], "schedule", "low", "high").drop("low", "high")
    return dispatch.unit_limits(banded, "schedule", "share")


@query("unit_limits", "key:i revision:i low_limit:f high_limit:f ramp_up:f ramp_down:f", f"WITH {LIMIT_SQL} SELECT * FROM lim")
def _(t):
    return _limits(t)


FLAG_SQL = "fl AS (SELECT date, unit, cost, volume, CAST(coalesce(cost >= 1500 + 20, false) AS INT) AS surrender FROM v_merit)"


def _flagged(t):
    return dispatch.surrender_flag(t.merit.withColumn("ul_price", F.lit(1500.0)), "cost", "ul_price", 20.0)


@query("surrender_flags", "date:d unit:i surrender:i", f"WITH {FLAG_SQL} SELECT date, unit, surrender FROM fl")
def _(t):
    return _flagged(t)


EDGE_SQL = FLAG_SQL + """,
ed AS (SELECT *, CAST(coalesce(sum(surrender) OVER past = 3 OR sum(surrender) OVER ahead = 3, false) AS INT) AS edge FROM fl
 WINDOW past AS (PARTITION BY unit ORDER BY date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), ahead AS (PARTITION BY unit ORDER BY date ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING))"""


def _edged(t):
    from wattframe.operators.windows import run_edges

    return run_edges(_flagged(t), ["unit"], ["date"], "surrender", 3)


@query("surrender_run_edges", "date:d unit:i edge:i", f"WITH {EDGE_SQL} SELECT date, unit, edge FROM ed")
def _(t):
    return _edged(t)


@query("merit_order_surrender", "date:d unit:i cost:g taken:f", f"""
WITH {EDGE_SQL}, c AS (SELECT *, sum(volume) OVER (PARTITION BY date ORDER BY cost DESC, unit ROWS UNBOUNDED PRECEDING) AS cum FROM ed)
SELECT date, unit, cost, greatest(0, least(volume, 300 - (cum - volume))) * edge AS taken FROM c""")
def _(t):
    return dispatch.merit_order_cap(_edged(t), ["date"], "cost", "unit", "volume", 300.0, eligible="edge")


@query("merit_order_eligible_only", "date:d unit:i taken:f", f"""
WITH {EDGE_SQL}, c AS (SELECT *, volume * edge AS v, sum(volume * edge) OVER (PARTITION BY date ORDER BY cost DESC, unit ROWS UNBOUNDED PRECEDING) AS cum FROM ed)
SELECT date, unit, greatest(0, least(v, 300 - (cum - v))) * edge AS taken FROM c""")
def _(t):
    return dispatch.merit_order_cap(_edged(t), ["date"], "cost", "unit", "volume", 300.0, eligible="edge", eligible_only=True)


@query("merit_order_lines", "l_orderkey:i l_linenumber:i taken:f", """
WITH x AS (SELECT l_returnflag, l_extendedprice / l_quantity AS cost, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem),
c AS (SELECT *, sum(l_quantity) OVER (PARTITION BY l_returnflag ORDER BY cost DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity ROWS UNBOUNDED PRECEDING) AS cum FROM x)
SELECT l_orderkey, l_linenumber, greatest(0, least(l_quantity, 100000 - (cum - l_quantity))) AS taken FROM c""")
def _(t):
    lines = t.lineitem.select(
        "l_returnflag", (F.col("l_extendedprice") / F.col("l_quantity")).alias("cost"), "l_orderkey", "l_linenumber", "l_quantity",
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity").alias("line"),
    )
    return dispatch.merit_order_cap(lines, ["l_returnflag"], "cost", "line", "l_quantity", 100000.0, split=True)


DISPATCH_SQL = """
u AS (SELECT date, unit, cost, volume AS schedule, volume * 0.5 AS low_limit, volume * 1.5 AS high_limit, 30.0::DOUBLE AS ramp_up, 20.0::DOUBLE AS ramp_down FROM v_merit),
ps AS (SELECT date, sum(volume) AS v FROM v_merit GROUP BY 1), pos AS (SELECT date, v - 600 AS quantum FROM ps),
sg AS (SELECT date, greatest(quantum, 0) AS surplus, greatest(-quantum, 0) AS deficit FROM pos),
upd AS (SELECT u.date, unit, greatest(0, least(ramp_up, high_limit - schedule)) AS o, deficit AS need,
 sum(greatest(0, least(ramp_up, high_limit - schedule))) OVER (PARTITION BY u.date ORDER BY cost, unit ROWS UNBOUNDED PRECEDING) AS cum FROM u JOIN sg ON sg.date = u.date WHERE deficit > 0),
dnd AS (SELECT u.date, unit, greatest(0, least(ramp_down, schedule - low_limit)) AS o, surplus AS need,
 sum(greatest(0, least(ramp_down, schedule - low_limit))) OVER (PARTITION BY u.date ORDER BY cost DESC, unit ROWS UNBOUNDED PRECEDING) AS cum FROM u JOIN sg ON sg.date = u.date WHERE surplus > 0),
up AS (SELECT date, unit, greatest(0, least(o, need - (cum - o))) AS ramp_up_mw FROM upd),
dn AS (SELECT date, unit, greatest(0, least(o, need - (cum - o))) AS ramp_down_mw FROM dnd)"""


def _units(t):
    v = F.col("volume")
    return t.merit.select(
        "date", "unit", "cost", v.alias("schedule"), (v * 0.5).alias("low_limit"), (v * 1.5).alias("high_limit"), F.lit(30.0).alias("ramp_up"), F.lit(20.0).alias("ramp_down")
    )


def _positions(t):
    total = t.merit.groupBy("date").agg((F.sum("volume") - 600).alias("quantum"))
    return dispatch.split_sign(total, "quantum")


def _ramped(t):
    pos = _positions(t)
    up = dispatch.dispatch(_units(t), pos.select("date", F.col("deficit").alias("need")), ["date"], "up", "unit", "ramp_up_mw")
    down = dispatch.dispatch(_units(t), pos.select("date", F.col("surplus").alias("need")), ["date"], "down", "unit", "ramp_down_mw")
    return up, down


@query("split_positions", "date:d surplus:f deficit:f", f"WITH {DISPATCH_SQL} SELECT * FROM sg")
def _(t):
    return _positions(t)


@query("ramp_up_dispatch", "date:d unit:i ramp_up_mw:f", f"WITH {DISPATCH_SQL} SELECT * FROM up")
def _(t):
    return _ramped(t)[0]


@query("ramp_down_dispatch", "date:d unit:i ramp_down_mw:f", f"WITH {DISPATCH_SQL} SELECT * FROM dn")
def _(t):
    return _ramped(t)[1]


@query("net_dispatch", "date:d unit:i net_change:f revised_schedule:f", f"""
WITH {DISPATCH_SQL} SELECT u.date, u.unit, coalesce(ramp_up_mw, 0) - coalesce(ramp_down_mw, 0) AS net_change, schedule + coalesce(ramp_up_mw, 0) - coalesce(ramp_down_mw, 0) AS revised_schedule
FROM u LEFT JOIN up ON up.date = u.date AND up.unit = u.unit LEFT JOIN dn ON dn.date = u.date AND dn.unit = u.unit""")
def _(t):
    up, down = _ramped(t)
    return dispatch.net_dispatch(_units(t), up, down, ["date", "unit"])


@query("composed_capacity", "unit:i revision_key:i allocated:f origin:s", """
WITH own AS (SELECT s_suppkey FROM supplier WHERE s_acctbal > 4000), r AS (SELECT l_suppkey AS unit, l_orderkey AS revision_key, l_quantity - 5 AS allocated, l_linenumber AS revision FROM lineitem),
i AS (SELECT * FROM r WHERE unit IN (SELECT s_suppkey FROM own) AND revision = (SELECT max(revision) FROM r WHERE unit IN (SELECT s_suppkey FROM own))),
m AS (SELECT * FROM r WHERE revision = (SELECT max(revision) FROM r))
SELECT unit, revision_key, allocated, 'INTERNAL' AS origin FROM i WHERE allocated > 0
UNION ALL SELECT unit, revision_key, allocated, 'IMPORT' FROM m WHERE allocated > 0 AND unit NOT IN (SELECT unit FROM i)""")
def _(t):
    rows = t.lineitem.select(F.col("l_suppkey").alias("unit"), F.col("l_orderkey").alias("revision_key"), (F.col("l_quantity") - 5).alias("allocated"), F.col("l_linenumber").alias("revision"))
    own = rows.join(t.supplier.filter("s_acctbal > 4000").select(F.col("s_suppkey").alias("unit")), "unit", "left_semi")
    return dispatch.compose_capacity(own, rows, "unit", ["unit", "revision_key", "allocated"])


@query("revision_comparison", "key:i day_ahead:f latest:f latest_revision:i change:f", """
SELECT key, max(CASE WHEN revision = 0 THEN schedule END) AS day_ahead, arg_max(schedule, revision) AS latest, max(revision) AS latest_revision,
 arg_max(schedule, revision) - coalesce(max(CASE WHEN revision = 0 THEN schedule END), 0) AS change FROM v_schedules GROUP BY 1""")
def _(t):
    return dispatch.revision_compare(t.schedules, ["key"], "schedule")


# ---- risk, position, bids -----------------------------------------------------------------------------

RISK_SQL = """
rl AS (SELECT date, block_no, forecast, price, lag(price - forecast, 2) OVER (PARTITION BY block_no ORDER BY date) AS r FROM v_price_blocks),
rs AS (SELECT *, CASE WHEN count(r) OVER w >= 15 THEN stddev_samp(r) OVER w END AS s FROM rl WINDOW w AS (PARTITION BY block_no ORDER BY date ROWS 14 PRECEDING)),
rk AS (SELECT date, block_no, forecast, price, least(last_value(s IGNORE NULLS) OVER (PARTITION BY block_no ORDER BY date ROWS UNBOUNDED PRECEDING) * {z}, forecast) AS risk FROM rs)""".format(
    z=f"{normal_quantile(0.95)!r}::DOUBLE"
)


def _risk(t):
    res = t.price_blocks.withColumn("res", F.col("price") - F.col("forecast"))
    return dispatch.model_risk(res, ["block_no"], "res", "forecast", normal_quantile(0.95), out="risk")


@query("model_risk", "date:d block_no:i risk:f", f"""
WITH {RISK_SQL} SELECT date, block_no, risk FROM rk""")
def _(t):
    return _risk(t)


GAP_SQL = RISK_SQL + """,
sc AS (SELECT date, block_no, sum(value) / 10 AS schedule FROM v_long WHERE pool <> 'R' GROUP BY 1, 2), re AS (SELECT date, block_no, sum(value) / 10 AS renewables FROM v_long WHERE pool = 'R' GROUP BY 1, 2),
gp AS (SELECT rk.date, rk.block_no, forecast + 1.5 + risk * 0.5 + risk - schedule - renewables AS position_gap FROM rk LEFT JOIN sc ON sc.date = rk.date AND sc.block_no = rk.block_no
 LEFT JOIN re ON re.date = rk.date AND re.block_no = rk.block_no)"""


def _gap(t):
    known = _risk(t)
    demand = known.select("date", "block_no", F.col("forecast").alias("demand_forecast"), F.lit(1.5).alias("demand_bias"), F.col("risk").alias("load_risk"))
    wind = known.select("date", "block_no", (F.col("risk") * 0.5).alias("wind_risk"))
    part = lambda cond, out: t.long_blocks.filter(cond).groupBy("date", "block_no").agg((F.sum("value") / 10).alias(out))
    return dispatch.position_gap(demand, part("pool <> 'R'", "schedule"), part("pool = 'R'", "renewables"), wind, ["date", "block_no"])


@query("position_gap", "date:d block_no:i position_gap:f", f"WITH {GAP_SQL} SELECT * FROM gp")
def _(t):
    return _gap(t)


BID_ALPHAS = (0.9, 0.95)


def _bids_sql(alphas):
    return f"""
WITH {MAD_SQL}, gp AS (SELECT date, block_no, value - 40 AS position_gap FROM (SELECT date, block_no, sum(value) AS value FROM v_long GROUP BY 1, 2)),
z AS (SELECT * FROM (VALUES {", ".join(f"({i + 1}, {a}::DOUBLE, {normal_quantile(a)!r}::DOUBLE)" for i, a in enumerate(alphas))}) v(ladder, alpha, z)),
j AS (SELECT b.date, b.block_no, ladder, alpha, position_gap / {len(alphas)} AS vol, round(CASE WHEN position_gap >= 0 THEN forecast + z * mad ELSE forecast - z * mad END, 3) AS price
 FROM b CROSS JOIN z JOIN gp ON gp.date = b.date AND gp.block_no = b.block_no)
SELECT date, block_no, ladder, alpha, CASE WHEN vol >= 0 THEN 'BUY' ELSE 'SELL' END AS buy_sell, abs(round(vol, 3)) AS ladder_volume,
 CASE WHEN vol < 0 AND price < 0.75 THEN 0.75 ELSE price END AS bid_price, abs(round(ceil(vol / 5) * 5, 3)) AS bid_volume FROM j"""


def _bids(t, alphas):
    total = t.long_blocks.groupBy("date", "block_no").agg(F.sum("value").alias("value"))
    gap = total.select("date", "block_no", (F.col("value") - 40).alias("position_gap"))
    band = forecast.price_band(mad_frame(t), "forecast", "mad", alphas).select("date", "block_no", "ladder", "alpha", "ul_price", "ll_price")
    return dispatch.bid_ladder(gap, band, ["date", "block_no"], len(alphas), 5.0)


BID_COLUMNS = "date:d block_no:i ladder:i alpha:f buy_sell:s ladder_volume:f bid_price:f bid_volume:f"


@query("bid_ladder", BID_COLUMNS, _bids_sql(BID_ALPHAS))
def _(t):
    return _bids(t, BID_ALPHAS)


@query("bid_ladder_even_steps", BID_COLUMNS, _bids_sql([0.6 + 0.3 * i / 6 for i in range(7)]))
def _(t):
    return _bids(t, forecast.even_alphas(0.6, 0.9, 7))


@query("unit_costs_on_date", "contract:i name:s urgent:g high:g", """
WITH c AS (SELECT o_custkey AS contract, o_orderpriority AS ct, o_totalprice AS cost, CAST(o_orderdate AS DATE) AS f, CAST(o_orderdate AS DATE) + 720 AS e FROM orders WHERE o_orderstatus <> 'P'),
w AS (SELECT contract, max(CASE WHEN ct = '1-URGENT' THEN cost END) AS urgent, max(CASE WHEN ct = '2-HIGH' THEN cost END) AS high FROM c
 WHERE DATE '1998-06-01' BETWEEN f AND e GROUP BY 1) SELECT contract, c_name AS name, urgent, high FROM w JOIN customer ON c_custkey = contract""")
def _(t):
    costs = t.orders.select(
        F.col("o_custkey").alias("contract"), F.col("o_orderpriority").alias("cost_type"), F.col("o_totalprice").alias("cost"),
        F.to_date("o_orderdate").alias("valid_from"), F.date_add("o_orderdate", 720).alias("valid_to"), (F.col("o_orderstatus") == "P").cast("int").alias("delete_ind"),
    )
    contracts = t.customer.select(F.col("c_custkey").alias("contract"), F.col("c_name").alias("name"))
    wide = dispatch.unit_cost(contracts, costs, "1998-06-01", ["1-URGENT", "2-HIGH"])
    return wide.withColumnsRenamed({"1-urgent": "urgent", "2-high": "high"})


@query("forecast_report", "date:d key:i actual:g forecast:g error:g", """
WITH n AS (SELECT s.* FROM v_schedules s WHERE revision = (SELECT max(revision) FROM v_schedules m WHERE m.key = s.key AND m.date = s.date)),
a AS (SELECT o_orderkey AS key, max(o_totalprice) AS actual FROM orders GROUP BY 1)
SELECT n.date, n.key, actual, schedule * 1000 AS forecast, actual - schedule * 1000 AS error FROM n JOIN a ON a.key = n.key""")
def _(t):
    actual = t.orders.groupBy(F.col("o_orderkey").alias("key")).agg(F.max("o_totalprice").alias("actual"))
    return dispatch.forecast_report(actual, t.schedules.withColumn("forecast", F.col("schedule") * 1000), ["key"], ["key"])


@query("schedule_from_last_actual", "pool:s date:d block_no:i schedule:g", """
WITH p AS (SELECT pool, date, block_no, value, CASE WHEN block_no % 4 = 0 THEN 2.0 ELSE NULL END AS bias FROM v_pools)
SELECT g.pool, g.date, g.block_no, last_value(p.value + coalesce(bias, 0) IGNORE NULLS) OVER (PARTITION BY g.pool, g.date ORDER BY g.block_no ROWS UNBOUNDED PRECEDING) AS schedule
FROM v_pool_grid g LEFT JOIN p ON p.pool = g.pool AND p.date = g.date AND p.block_no = g.block_no""")
def _(t):
    positions = t.pools.select(
        "pool", "date", "block_no", F.col("value").alias("quantum"), F.when(F.col("block_no") % 4 == 0, 2.0).alias("bias"), F.lit(0).alias("revision")
    )
    return dispatch.schedule_from_actual(t.pool_grid.select("pool", "date", "block_no"), positions, ["pool"])


# ---- merge semantics ----------------------------------------------------------------------------------

MERGE_SQL = """
base AS (SELECT o_orderkey AS key, o_totalprice AS price, o_orderstatus AS status, 1 AS processed_ind FROM orders WHERE o_orderpriority <> '5-LOW'),
fresh AS (SELECT l_orderkey AS key, CASE WHEN max(l_linenumber) = 1 THEN NULL ELSE sum(l_extendedprice) END AS price, max(l_linestatus) AS status FROM lineitem GROUP BY 1)"""


def _base(t):
    return t.orders.filter("o_orderpriority <> '5-LOW'").select(
        F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status"), F.lit(1).alias("processed_ind")
    )


def _fresh(t):
    return t.lineitem.groupBy(F.col("l_orderkey").alias("key")).agg(
        F.when(F.max("l_linenumber") == 1, None).otherwise(F.sum("l_extendedprice")).alias("price"), F.max("l_linestatus").alias("status")
    )


MERGE_COLS = "key:i price:g status:s processed_ind:i"


@query("upserted_rows", MERGE_COLS, f"""
WITH {MERGE_SQL} SELECT coalesce(b.key, f.key) AS key, CASE WHEN f.key IS NULL THEN b.price ELSE f.price END AS price,
 CASE WHEN b.key IS NULL THEN f.status ELSE b.status END AS status, b.processed_ind FROM base b FULL JOIN fresh f ON f.key = b.key""")
def _(t):
    return merge.upsert(_base(t), _fresh(t), ["key"], ["price"])


@query("upserted_keeping_old", MERGE_COLS, f"""
WITH {MERGE_SQL} SELECT coalesce(b.key, f.key) AS key, coalesce(f.price, b.price) AS price, coalesce(f.status, b.status) AS status, b.processed_ind
FROM base b FULL JOIN fresh f ON f.key = b.key""")
def _(t):
    return merge.upsert(_base(t), _fresh(t), ["key"], ["price", "status"], keep_on_null=True)


@query("upserted_with_flag_reset", MERGE_COLS, f"""
WITH {MERGE_SQL} SELECT coalesce(b.key, f.key) AS key, CASE WHEN f.key IS NULL THEN b.price ELSE f.price END AS price,
 CASE WHEN b.key IS NULL THEN f.status ELSE b.status END AS status, CASE WHEN f.key IS NOT NULL THEN 0 ELSE b.processed_ind END AS processed_ind
FROM base b FULL JOIN fresh f ON f.key = b.key""")
def _(t):
    return merge.upsert(_base(t), _fresh(t), ["key"], ["price"], set_literals={"processed_ind": 0})


@query("replaced_keys", MERGE_COLS, f"""
WITH {MERGE_SQL} SELECT * FROM base WHERE key NOT IN (SELECT key FROM fresh WHERE status = 'F')
UNION ALL SELECT key, price, status, 0 FROM fresh WHERE status = 'F'""")
def _(t):
    new = _fresh(t).filter("status = 'F'").withColumn("processed_ind", F.lit(0))
    return merge.replace_keys(_base(t), new, ["key"])


@query("updated_from_join", MERGE_COLS, f"""
WITH {MERGE_SQL} SELECT b.key, coalesce(f.price, b.price) AS price, b.status, b.processed_ind FROM base b LEFT JOIN fresh f ON f.key = b.key""")
def _(t):
    return merge.update_from(_base(t), _fresh(t), ["key"], ["price"])


@query("ladder_by_value_pieces", "l_returnflag:s cost:f n:i below:i", """
SELECT l_returnflag, cost, count(*) AS n, sum(count(*)) OVER (PARTITION BY l_returnflag ORDER BY cost) - count(*) AS below
FROM (SELECT l_returnflag, l_extendedprice / l_quantity AS cost FROM lineitem) GROUP BY 1, 2""")
def _(t):
    lines = t.lineitem.select("l_returnflag", (F.col("l_extendedprice") / F.col("l_quantity")).alias("cost"))
    return splits.value_ranks(lines, ["l_returnflag"], "cost")


@query("newest_first_schedule", "key:i revision:i schedule:f", """
SELECT key, revision, schedule FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY revision DESC) AS r FROM v_schedules) WHERE r <= 2""")
def _(t):
    return latest.top_k(t.schedules, ["key"], [F.desc("revision")], 2)
