"""Registered queries: the batch forms of the streaming operators.

The streaming forms run the same functions on ``readStream`` frames; tests check that both agree.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from wattframe.plans.registry import query
from wattframe.sinks import merge
from wattframe.streaming import feeds


@query("block_window_sums", "pool:s date:d block_no:i value:g n:i", "SELECT pool, date, block_no, sum(value) AS value, count(*) AS n FROM v_readings GROUP BY 1, 2, 3")
def _(t):
    return feeds.block_sums(t.events.withColumnRenamed("event_type", "pool"), "ts", ["pool"], "value")


@query("recent_view", "pool:s window_start:t mean_value:f n:i", """
WITH e AS (SELECT event_type AS pool, value, time_bucket(INTERVAL 15 MINUTE, ts) - k * INTERVAL 15 MINUTE AS window_start FROM events CROSS JOIN (SELECT unnest(range(0, 4)) AS k))
SELECT pool, window_start, avg(value) AS mean_value, count(*) AS n FROM e GROUP BY 1, 2""")
def _(t):
    return feeds.recent_view(t.events.withColumnRenamed("event_type", "pool"), "ts", ["pool"], "value")


@query("newest_revision_merge", "key:i schedule:f revision:i", """
WITH f AS (SELECT key, max(revision) AS revision, arg_max(schedule, revision) AS schedule FROM v_schedules WHERE revision > 2 GROUP BY 1),
b AS (SELECT key, schedule, revision FROM v_schedules WHERE revision = 0)
SELECT coalesce(b.key, f.key) AS key, coalesce(f.schedule, b.schedule) AS schedule, coalesce(f.revision, b.revision) AS revision FROM b FULL JOIN f ON f.key = b.key""")
def _(t):
    rows = t.schedules.select("key", "schedule", "revision")
    fresh = feeds.newest_per_key(rows.filter("revision > 2"), ["key"], "revision")
    return merge.upsert(rows.filter("revision = 0"), fresh, ["key"], ["schedule", "revision"])


@query("late_corrections", "event_id:i processed_ind:i", "SELECT event_id, 0 AS processed_ind FROM events WHERE ts < (SELECT max(ts) FROM events) - INTERVAL 5 DAY")
def _(t):
    horizon = t.events.select(F.max("ts") - F.expr("interval 5 days")).scalar()
    return feeds.split_late(t.events, "ts", horizon)[1]


RESUME_SQL = """
WITH tr AS (SELECT l_orderkey AS feed, l_linenumber AS revision, CASE l_returnflag WHEN 'A' THEN 'SUCCESS' WHEN 'N' THEN 'RUNNING' ELSE 'FAILED' END AS status, l_shipdate AS modified, l_suppkey, l_partkey FROM lineitem),
la AS (SELECT feed, max(revision) AS revision FROM tr GROUP BY 1),
lm AS (SELECT tr.feed, tr.revision, max(modified) AS modified FROM tr JOIN la ON la.feed = tr.feed AND la.revision = tr.revision GROUP BY 1, 2),
ls AS (SELECT lm.feed, lm.revision, lm.modified, min(status) AS status FROM tr JOIN lm ON lm.feed = tr.feed AND lm.revision = tr.revision AND lm.modified = tr.modified GROUP BY 1, 2, 3)
SELECT o.feed, CASE WHEN ls.feed IS NULL THEN -1 WHEN status = 'RUNNING' AND modified > TIMESTAMP '2000-06-15 00:05:00' - INTERVAL 10 MINUTE THEN NULL
 WHEN status = 'SUCCESS' THEN revision + 1 ELSE revision END AS resume_revision, CAST(coalesce(status = 'RUNNING' AND modified > TIMESTAMP '2000-06-15 00:05:00' - INTERVAL 10 MINUTE, false) AS INT) AS locked
FROM (SELECT DISTINCT o_orderkey AS feed FROM orders) o LEFT JOIN ls ON ls.feed = o.feed"""


@query("resume_points", "feed:i resume_revision:i locked:i", RESUME_SQL)
def _(t):
    flag = F.col("l_returnflag")
    status = F.when(flag == "A", "SUCCESS").when(flag == "N", "RUNNING").otherwise("FAILED")
    tracker = t.lineitem.groupBy(F.col("l_orderkey").alias("feed"), F.col("l_linenumber").alias("revision"), F.col("l_shipdate").alias("modified")).agg(F.min(status).alias("status"))
    wanted = t.orders.select(F.col("o_orderkey").alias("feed")).distinct()
    now = F.lit("2000-06-15 00:05:00").cast("timestamp_ntz")
    return feeds.resume_points_for(wanted, tracker, ["feed"], now)


GATES = (1, 25, 29, 61, 90)
GATES_SQL = f"""
WITH g AS (SELECT CAST(unnest({list(GATES)}) AS INTEGER) AS gate),
p AS (SELECT r.pool, r.date, (SELECT max(gate) FROM g WHERE gate <= r.block_no) AS gate FROM v_readings r)
SELECT DISTINCT pool AS entity, CASE WHEN gate IS NULL THEN date - 1 ELSE date END AS date, coalesce(gate, (SELECT max(gate) FROM g)) AS block_no FROM p"""


@query("run_gates_passed", "entity:s date:d block_no:i", GATES_SQL)
def _(t):
    return feeds.run_gate(t.readings, "ts", "pool", GATES)


@query("stored_revision_wins", "key:i schedule:f revision:i", """
WITH f AS (SELECT key, max(revision) AS revision, arg_max(schedule, revision) AS schedule FROM v_schedules WHERE revision % 2 = 1 GROUP BY 1),
b AS (SELECT key, max(revision) AS revision, arg_max(schedule, revision) AS schedule FROM v_schedules WHERE revision % 2 = 0 GROUP BY 1)
SELECT coalesce(b.key, f.key) AS key, CASE WHEN b.key IS NULL OR f.revision >= b.revision THEN f.schedule ELSE b.schedule END AS schedule,
 CASE WHEN b.key IS NULL OR f.revision >= b.revision THEN f.revision ELSE b.revision END AS revision FROM b FULL JOIN f ON f.key = b.key""")
def _(t):
    rows = t.schedules.select("key", "schedule", "revision")
    stored, fresh = (feeds.newest_per_key(rows.filter(F.col("revision") % 2 == k), ["key"], "revision") for k in (0, 1))
    return merge.upsert(stored, fresh, ["key"], ["schedule", "revision"], newest_by="revision")


@query("run_gate_blocks", "pool:s date:d block_no:i", """
SELECT pool, date, max(block_no) AS block_no FROM v_readings WHERE date = (SELECT max(date) FROM v_readings) GROUP BY 1, 2""")
def _(t):
    newest = t.readings.groupBy("pool").agg(F.max(F.struct("date", "block_no")).alias("m"))
    last = t.readings.select(F.max("date")).scalar()
    return newest.select("pool", "m.date", "m.block_no").filter(F.col("date") == last)
