"""Rows with null keys, open ends, null costs and over-long groups are kept and have a defined result."""

import datetime as dt
import random
import re

from pyspark.sql import functions as F

from wattframe.operators import dispatch, repair, series, splits
from wattframe.sinks import merge


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_null_keys_and_values_keep_their_rows(spark):
    df = spark.createDataFrame(
        [("a", 1, 1, 5.0), ("a", 1, 2, None), ("a", 2, 3, 7.0), (None, 1, 1, 4.0), (None, None, 0, 3.0), (None, 2, 2, None)], "k string, piece int, t int, v double"
    )
    plain = df.select("*", F.last("v", True).over(splits.upto(["k"], ["piece", "t"])).alias("out"))
    assert rows(splits.carried_last(df, ["k"], ["piece", "t"], "piece", "v", "out").select(plain.columns)) == rows(plain)
    plain = df.select("*", F.coalesce(F.sum("v").over(splits.upto(["k"], ["piece", "t"])), F.lit(0.0)).alias("out"))
    assert rows(splits.carried_sum(df, ["k"], ["piece", "t"], "piece", "v", "out").select(plain.columns)) == rows(plain)
    plain = df.select("*", F.row_number().over(splits.upto(["k"], ["piece", "t"])).cast("bigint").alias("pos"))
    assert rows(splits.with_position(df, ["k"], ["piece", "t"], "piece", "pos").select(plain.columns)) == rows(plain)
    ranks = {(r["k"], r["v"]): r["rank"] for r in splits.average_ranks(df, ["k"], "v").collect()}
    assert ranks == {("a", 5.0): 1.0, ("a", None): None, ("a", 7.0): 2.0, (None, 3.0): 1.0, (None, 4.0): 2.0, (None, None): None}


def test_ranks_of_values_that_come_out_anew(spark):
    draw = F.udf(lambda: random.SystemRandom().random(), "double").asNondeterministic()
    df = spark.range(50).select((F.col("id") % 2).alias("k"), draw().alias("v"))
    got = splits.average_ranks(df, ["k"], "v").collect()
    for k in (0, 1):
        line = sorted((r["v"], r["rank"]) for r in got if r["k"] == k)
        assert [rank for _, rank in line] == [i + 1.0 for i in range(25)]


def test_null_costs_stand_where_the_plain_order_puts_them(spark):
    df = spark.createDataFrame([(1, "u", 5.0, 10.0), (1, "v", None, 20.0), (1, "w", -3.0, 40.0), (1, "x", 0.0, 80.0)], "d int, unit string, cost double, mw double")
    for down in (False, True):
        one, two = (dispatch._cumulative(df, ["d"], "cost", "unit", "mw", down, s, "sum").select("unit", "sum") for s in (False, True))
        assert rows(one) == rows(two)


def test_upsert_of_the_null_partition(spark):
    base = spark.createDataFrame([(None, 1, 1.0), (None, 2, 2.0), ("x", 1, 3.0)], "p string, n int, v double")
    new = spark.createDataFrame([(None, 2, 9.0), (None, 3, 4.0)], "p string, n int, v double")
    assert rows(merge.upsert_touched(base, new, ["p", "n"], ["v"], "p")) == rows(spark.createDataFrame([(None, 1, 1.0), (None, 2, 9.0), (None, 3, 4.0)], base.schema))


def test_open_validity(spark):
    day = lambda m, d, y=2024: dt.date(y, m, d)
    facts = spark.createDataFrame([("a", day(1, 1)), ("a", day(6, 1)), ("b", day(6, 1)), ("a", None)], "k string, date date")
    dim = spark.createDataFrame(
        [("a", day(1, 1), day(1, 31), 1), ("a", day(2, 1), None, 2), ("a", day(1, 1), day(12, 31, 9999), 3), ("b", None, day(6, 1), 4), ("a", day(7, 1), day(6, 1), 5), ("b", None, None, 6)],
        "k string, f date, t date, c int",
    )
    got = sorted((r["k"], r["date"], r["c"]) for r in series.in_force(facts, dim, ["k"], "date", "f", "t").collect())
    assert got == [("a", day(1, 1), 1), ("a", day(1, 1), 3), ("a", day(6, 1), 2), ("a", day(6, 1), 3), ("b", day(6, 1), 4), ("b", day(6, 1), 6)]


def test_facts_are_dealt_by_key_and_span(spark):
    facts = spark.range(2000).select((F.col("id") % 5).cast("string").alias("k"), F.expr("date_add(DATE '2024-01-01', CAST(id % 300 AS INT))").alias("date"))
    dim = spark.range(5).select(F.col("id").cast("string").alias("k"), F.expr("explode(sequence(DATE '2024-01-01', DATE '2024-12-01', INTERVAL 1 MONTH))").alias("f"))
    held = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    kept = {name: spark.conf.get(name) for name in held}
    try:
        for name, value in held.items():
            spark.conf.set(name, value)
        joined = series.in_force(facts, dim.withColumn("t", F.last_day("f")), ["k"], "date", "f", "t")
        assert joined.count() == 2000
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "LeftSemi" not in plan and not re.search(r"hashpartitioning\(_length#\d+, ", plan)
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)


def test_profiles_of_any_grid(spark):
    line = [("whole", x, 2.0 * x) for x in range(1, 9)] + [("long", x, 3.0 * x) for x in range(1, 21)] + [("apart", x + 40, 1.0 * x) for x in range(8)] + [("few", 1, 1.0)]
    df = spark.createDataFrame(line, "k string, x int, y double")
    got = repair.poly_profile(df, ["k"], "x", "y", 1, 8).collect()
    assert len(got) == len(line)
    assert all(r["fitted"] is None if r["k"] == "few" else abs(r["fitted"] - r["y"]) < 1e-9 for r in got)
