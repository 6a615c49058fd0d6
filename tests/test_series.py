"""Hand-made frames: gaps, ties, zero denominators, runs, revisions, calendar edges."""

import datetime as dt

from pyspark.sql import functions as F

from wattframe.functions import blocks, scalars
from wattframe.operators import correct, dispatch, latest, repair, series, splits, windows
from wattframe.sinks import merge

DAY = dt.date(2024, 1, 1)


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def day(spark, values, date=DAY):
    return spark.createDataFrame([(date, i + 1, v) for i, v in enumerate(values)], "date date, block_no int, value double")


def test_block_of_boundaries(spark):
    df = spark.sql("select timestamp_ntz'2024-01-01 00:14:59' a, timestamp_ntz'2024-01-01 00:15:00' b, timestamp_ntz'2024-01-01 23:59:59' c")
    assert rows(df, *[blocks.block_of(F.col(c)) for c in "abc"]) == [(1, 2, 96)]


def test_revision_gate_forms(spark):
    df = spark.range(1, 97).select(F.col("id").alias("b"))
    first = {b: g for b, g in rows(df, "b", blocks.revision_gate(F.col("b")))}
    assert [tuple(first[b]) for b in (1, 4, 5, 9, 10, 87, 88, 93, 96)] == [
        (0, 1), (0, 1), (0, 13), (0, 13), (0, 19), (0, 91), (1, 1), (1, 1), (1, 1)]
    second = {b: g for b, g in rows(df, "b", blocks.revision_gate(F.col("b"), blocks.GATES_SECOND_FORM))}
    assert tuple(second[2]) == (0, 7) and tuple(second[3]) == (0, 13)


def test_zero_denominator_and_nan(spark):
    df = spark.createDataFrame([(1.0, 0.0), (float("nan"), 1.0), (float("inf"), 1.0)], "a double, b double")
    assert rows(df, scalars.ratio(F.col("a"), F.col("b")).isNull(), scalars.finite(F.col("a")))[0] == (True, True)
    assert series.finite_rows(df, ["a"]).count() == 1


def test_dms(spark):
    df = spark.createDataFrame([("28 35 30 N",), ("77° 12' 0\" W",), ("n/a",)], "t string")
    got = [r[0] for r in rows(df, scalars.dms_to_decimal(F.col("t")))]
    assert abs(got[0] - 28.591666) < 1e-5 and got[1] == -77.2 and got[2] is None


def test_normal_quantile():
    assert abs(scalars.normal_quantile(0.975) - 1.959963984540054) < 1e-12
    assert abs(scalars.normal_quantile(0.5)) < 1e-12


def test_ratio_carry_leading_inner_gap(spark):
    ref = [1.0, 2.0, 4.0, 2.0]
    df = day(spark, [None, 10.0, None, 0.0]).withColumn("ref", F.element_at(F.array(*[F.lit(x) for x in ref]), F.col("block_no")))
    got = [r[0] for r in repair.ratio_carry(df, ["date"], ["block_no"], "value", "ref", "out").orderBy("block_no").select("out").collect()]
    assert got == [None, 10.0, 20.0, 10.0]


def test_bounded_carry_cap(spark):
    df = day(spark, [10.0, 0.0, 0.0]).withColumn("shape", F.lit(3.0)).withColumn("cap", F.lit(40.0))
    got = [r[0] for r in repair.bounded_carry(df, ["date"], "block_no", "value", "shape", "cap", "out").orderBy("block_no").select("out").collect()]
    assert got == [10.0, 30.0, 40.0]


def test_run_edges_leave_the_middle(spark):
    flags = [0, 1, 1, 1, 1, 0, 1, 1]
    df = spark.createDataFrame([(1, i, f) for i, f in enumerate(flags)], "k int, i int, flag int")
    edge = [r[0] for r in windows.run_edges(df, ["k"], ["i"], "flag", 3).orderBy("i").select("edge").collect()]
    assert edge == [0, 1, 1, 1, 1, 0, 0, 0]
    longer = spark.createDataFrame([(1, i, 1) for i in range(5)], "k int, i int, flag int")
    assert [r[0] for r in windows.run_edges(longer, ["k"], ["i"], "flag", 5).orderBy("i").select("edge").collect()] == [1, 0, 0, 0, 1]
    assert [r[0] for r in windows.in_run(longer, ["k"], ["i"], "flag", 5).orderBy("i").select("in_run").collect()] == [1] * 5


def test_split_windows_equal_plain_ones(spark):
    df = spark.range(500).select(
        (F.col("id") % 2).alias("k"), F.col("id").alias("i"), F.floor(F.col("id") / 37).alias("piece"),
        F.when(F.col("id") % 5 != 0, ((F.col("id") * 7919) % 101).cast("double")).alias("v"),
    )
    order = ["k", "i"]
    for make in (
        lambda s: windows.rolling(df, ["k"], ["i"], "v", 7, {"o": "mean"}, split=s),
        lambda s: windows.rolling(df, ["k"], ["i"], "v", 4, {"o": "median"}, center=True, min_periods=1, split=s),
        lambda s: windows.lags(df, ["k"], ["i"], "v", [3], split=s).withColumnRenamed("v_lag3", "o"),
        lambda s: windows.ffill(df, ["k"], ["i"], "v", "o", split=s),
        lambda s: windows.bfill(df, ["k"], ["i"], "v", "o", split=s),
        lambda s: windows.running_sum(df.fillna(0.0), ["k"], ["i"], "v", "o", split=s),
    ):
        assert rows(make("piece").orderBy(*order), "k", "i", "o") == rows(make(None).orderBy(*order), "k", "i", "o")


def test_framed_pieces_smaller_than_data(spark):
    df = spark.range(100).select(F.lit(1).alias("k"), F.col("id").alias("i"), F.floor(F.col("id") / 9).alias("piece"), F.col("id").cast("double").alias("v"))
    from pyspark.sql import Window  # noqa: F401

    got = splits.framed(df, ["k"], ["i"], "piece", 3, 2, {"o": lambda w: F.sum("v").over(w.rowsBetween(-3, 2))}, size=10)
    plain = windows.rolling(df, ["k"], ["i"], "v", 6, {"o": "sum"}, center=True, min_periods=0)
    assert rows(got.orderBy("i"), "i", "o") == rows(plain.orderBy("i"), "i", "o")


def test_quantiles_and_ranks_with_copies(spark):
    values = [5.0] * 40 + [-3.5, 0.0, 0.0, 1e-9, 1e12, 7.25, 7.26, None]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 2.0)], "k string, v double")
    got = {r["k"]: r for r in splits.exact_quantiles(df, ["k"], "v", {"q10": 0.1, "q50": 0.5, "q97": 0.97}).collect()}
    import numpy as np

    known = [v for v in values if v is not None]
    for name, p in (("q10", 10), ("q50", 50), ("q97", 97)):
        assert abs(got["a"][name] - np.percentile(known, p)) <= 1e-6 * max(1, abs(np.percentile(known, p)))
    assert got["b"]["q50"] == 2.0
    ranks = splits.average_ranks(df.filter("k = 'a'").select("k", "v").distinct(), ["k"], "v").orderBy("v").collect()
    assert [r["rank"] for r in ranks if r["v"] is not None] == [float(i) for i in range(1, 8)]
    tied = {r["v"]: r["rank"] for r in splits.average_ranks(df.filter("k = 'a'"), ["k"], "v").distinct().collect()}
    assert tied[0.0] == 2.5 and tied[5.0] == (5 + 44) / 2


def test_piece_of_is_monotone(spark):
    values = [-1e300, -5.1, -5.0, -1e-300, 0.0, 5e-324, 1e-300, 1.0, 1.0000001, 50.0, 50.01, 1e300]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    pieces = [r[0] for r in df.orderBy("i").select(splits.piece_of(F.col("v"))).collect()]
    assert pieces == sorted(pieces) and pieces[4] == 0


def test_horizon_rest_of_today_or_next_day(spark):
    open_day = day(spark, [1.0] * 90)
    got = series.horizon(open_day, days=7)
    assert got.count() == 90 + 6 + 7 * 96 and got.filter("value is null").agg(F.min("block_no")).first()[0] == 1
    full = series.horizon(day(spark, [1.0] * 96), days=7)
    assert full.count() == 96 + 8 * 96


def test_expand_events_priority(spark):
    events = spark.createDataFrame([(DAY, "x"), (DAY + dt.timedelta(days=1), "y")], "date date, name string")
    got = dict(rows(correct.expand_events(events).orderBy("date"), "date", "name"))
    assert got == {DAY - dt.timedelta(days=1): "pre_x", DAY: "x", DAY + dt.timedelta(days=1): "y", DAY + dt.timedelta(days=2): "post_y"}


def test_merit_order_marginal_unit(spark):
    df = spark.createDataFrame([(1, "a", 9.0, 50.0, 1), (1, "b", 8.0, 50.0, 0), (1, "c", 7.0, 50.0, 1)], "k int, unit string, cost double, volume double, ok int")
    for split in (False, True):
        taken = dict(rows(dispatch.merit_order_cap(df, ["k"], "cost", "unit", "volume", 120.0, split=split), "unit", "taken"))
        assert taken == {"a": 50.0, "b": 50.0, "c": 20.0}
    strict = dict(rows(dispatch.merit_order_cap(df, ["k"], "cost", "unit", "volume", 70.0, eligible="ok", eligible_only=True), "unit", "taken"))
    assert strict == {"a": 50.0, "b": 0.0, "c": 20.0}


def test_dispatch_never_exceeds_need_or_caps(spark):
    units = spark.createDataFrame(
        [(1, "a", 5.0, 10.0, 0.0, 30.0, 15.0, 5.0), (1, "b", 3.0, 10.0, 0.0, 12.0, 15.0, 5.0), (1, "c", 4.0, 40.0, 0.0, 30.0, 15.0, 5.0)],
        "k int, unit string, cost double, schedule double, low_limit double, high_limit double, ramp_up double, ramp_down double",
    )
    need = spark.createDataFrame([(1, 12.0)], "k int, need double")
    for split in (True, False):
        up = dict(rows(dispatch.dispatch(units, need, ["k"], "up", "unit", "mw", split), "unit", "mw"))
        assert up == {"b": 2.0, "c": 0.0, "a": 10.0}
    down = dict(rows(dispatch.dispatch(units, need, ["k"], "down", "unit", "mw"), "unit", "mw"))
    assert down == {"a": 5.0, "c": 5.0, "b": 2.0}


def test_upsert_variants(spark):
    base = spark.createDataFrame([(1, 1.0, "x", 1), (2, 2.0, "y", 1)], "k int, v double, s string, processed int")
    new = spark.createDataFrame([(2, None, "z"), (3, 3.0, "w")], "k int, v double, s string")
    plain = rows(merge.upsert(base, new, ["k"], ["v"]).orderBy("k"), "*")
    assert plain == [(1, 1.0, "x", 1), (2, None, "y", 1), (3, 3.0, "w", None)]
    kept = rows(merge.upsert(base, new, ["k"], ["v", "s"], keep_on_null=True, set_literals={"processed": 0}).orderBy("k"), "*")
    assert kept == [(1, 1.0, "x", 1), (2, 2.0, "z", 0), (3, 3.0, "w", 0)]


def test_new_rows_keep_duplicates_and_match_nulls(spark):
    new = spark.createDataFrame([(1, None), (2, "a"), (2, "a")], "k int, s string")
    old = spark.createDataFrame([(1, None)], "k int, s string")
    assert series.new_rows(new, old).count() == 2
    assert series.new_rows(new, old, keep_duplicates=False).count() == 1


def test_latest_revision_that_shrinks(spark):
    df = spark.createDataFrame([(1, 0, 1), (1, 0, 2), (1, 1, 1)], "k int, revision int, block int")
    assert rows(latest.latest_revision(df, ["k"]), "*") == [(1, 1, 1)]
    plan = latest.latest_revision(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_calendar_lags_do_not_slide_over_gaps(spark):
    df = spark.createDataFrame([(DAY, 1.0), (DAY + dt.timedelta(days=2), 3.0)], "date date, v double")
    got = rows(windows.calendar_lags(df, [], "date", ["v"], [1, 2]).orderBy("date"), "v", "v_d1", "v_d2")
    assert got == [(1.0, None, None), (3.0, None, 1.0)]
