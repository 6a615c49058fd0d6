"""Versioned table, run gates, unfinished days and unknown prices against plain Python."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattframe.operators import forecast, similar
from wattframe.sinks import merge, versions
from wattframe.streaming import feeds

DAY = dt.date(2024, 1, 1)
SCHEMA = "day date, k int, revision int, v double, processed int"


def rows_of(spark, root):
    empty = spark.createDataFrame([], SCHEMA)
    return sorted((r["day"], r["k"], r["revision"], r["v"], r["processed"]) for r in versions.read_table(spark, root, empty.schema).collect())


def put(spark, root, rows, batch, **options):
    new = spark.createDataFrame(rows, SCHEMA)
    return versions.merge_newest(new, root, new.schema, ["day", "k"], ["revision", "v"], "day", "revision", "w", batch, **options)


def test_upsert_compares_the_stored_revision(spark):
    base = spark.createDataFrame([(1, 5, "old"), (2, None, "old"), (3, 1, "old"), (None, 4, "old"), (6, 1, "old")], "k int, rev int, v string")
    new = spark.createDataFrame([(1, 4, "new"), (2, 0, "new"), (3, 1, "new"), (None, 3, "new"), (5, None, "new"), (6, None, "new")], "k int, rev int, v string")
    got = {r["k"]: (r["rev"], r["v"]) for r in merge.upsert(base, new, ["k"], ["rev", "v"], newest_by="rev").collect()}
    assert got == {1: (5, "old"), 2: (0, "new"), 3: (1, "new"), None: (4, "old"), 5: (None, "new"), 6: (1, "old")}


def test_versions_keep_newer_rows_and_repeat_nothing(spark, tmp_path):
    root = str(tmp_path / "t")
    assert rows_of(spark, root) == []
    next_day = DAY + dt.timedelta(1)
    assert put(spark, root, [(DAY, 1, 2, 1.0, 1), (next_day, 1, 0, 2.0, 1)], 0)
    assert put(spark, root, [(DAY, 1, 1, 9.0, 1), (DAY, 2, 0, 3.0, 1)], 1, set_literals={"processed": 0})
    want = [(DAY, 1, 2, 1.0, 1), (DAY, 2, 0, 3.0, 0), (next_day, 1, 0, 2.0, 1)]
    assert rows_of(spark, root) == want
    assert not put(spark, root, [(DAY, 1, 7, 7.0, 1)], 1) and rows_of(spark, root) == want
    # Only the folder of the touched day was written by the second commit.
    assert [p.name for p in (tmp_path / "t" / "data" / "table_version=1").iterdir() if p.is_dir()] == [f"day={DAY}"]
    assert versions.manifest(spark, root)["folders"] == {"data": {f"day={DAY}": 1, f"day={next_day}": 0}}


def test_a_failed_commit_leaves_the_version_before(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    put(spark, root, [(DAY, 1, 0, 1.0, 1)], 0)

    def fail(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(versions, "_publish", fail)
        with pytest.raises(RuntimeError):
            put(spark, root, [(DAY, 1, 3, 5.0, 1)], 1)
    assert rows_of(spark, root) == [(DAY, 1, 0, 1.0, 1)]
    assert put(spark, root, [(DAY, 1, 3, 5.0, 1)], 1) and rows_of(spark, root) == [(DAY, 1, 3, 5.0, 1)]


def test_null_partition_is_one_like_any_other(spark, tmp_path):
    root = str(tmp_path / "t")
    put(spark, root, [(None, 1, 0, 1.0, 1), (DAY, 1, 0, 4.0, 1)], 0)
    put(spark, root, [(None, 1, 1, 2.0, 1), (None, 2, 0, 3.0, 1)], 1)
    empty = spark.createDataFrame([], SCHEMA)
    got = {(r["day"], r["k"]): r["v"] for r in versions.read_table(spark, root, empty.schema).collect()}
    assert got == {(None, 1): 2.0, (None, 2): 3.0, (DAY, 1): 4.0}


def test_streamed_versions_keep_the_newest(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "t")
    schema = spark.createDataFrame([], SCHEMA).schema
    for rows in ([(DAY, 1, 5, 1.5, 1), (DAY, 2, 0, 2.0, 1)], [(DAY, 1, 2, 1.2, 1), (DAY, 2, 1, 2.1, 1), (DAY, 2, 0, 0.0, 1)]):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = feeds.stream_files(spark, source, schema, files_per_trigger=1)
        feeds.upsert_versions(stream, root, ["day", "k"], ["revision", "v"], "day", "revision", str(tmp_path / "cp")).awaitTermination()
    assert rows_of(spark, root) == [(DAY, 1, 5, 1.5, 1), (DAY, 2, 1, 2.1, 1)]


def test_gates_passed_in_a_stream_equal_the_batch(spark, tmp_path):
    base = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("pool"))
    base.repartitionByRange(4, "ts").write.parquet(str(tmp_path / "in"))
    stream = feeds.stream_files(spark, str(tmp_path / "in"), base.schema, files_per_trigger=1)
    # Files are picked up in any order here, so no row may fall behind the watermark.
    gated = feeds.passed_gates(stream, "ts", "pool", (29, 61), "60 days")
    query = gated.writeStream.outputMode("append").format("memory").queryName("passed").start()
    query.processAllAvailable()
    query.stop()
    got = sorted(map(tuple, spark.table("passed").collect()))
    assert got == sorted(map(tuple, feeds.run_gate(base, "ts", "pool", (29, 61)).collect()))
    want = set()
    for r in base.collect():
        block = (r["ts"].hour * 60 + r["ts"].minute) // 15 + 1
        gate = max((g for g in (29, 61) if g <= block), default=None)
        day = r["ts"].date()
        want.add((r["pool"], day if gate else day - dt.timedelta(1), gate or 61))
    assert got == sorted(want)


def test_gates_of_nothing(spark):
    frame = spark.createDataFrame([(None, "a"), (dt.datetime(2024, 1, 1), None)], "ts timestamp, pool string")
    assert feeds.passed_gates(frame, "ts", "pool", (2,)).collect() == [(None, dt.date(2023, 12, 31), 2)]
    assert feeds.passed_gates(frame, "ts", "pool", ()).collect() == []


def plain_imputed(days, lookback):
    """days: {date: 96 values}; the nearest complete earlier day by hourly maxima, its shape carried into holes."""
    hourly = lambda v: [max((x for x in v[4 * h : 4 * h + 4] if x is not None), default=None) for h in range(24)]
    out = {}
    for day, values in days.items():
        best = None
        for other, theirs in days.items():
            if 1 <= (day - other).days <= lookback and None not in theirs and None in values:
                pairs = [(a, b) for a, b in zip(hourly(values), hourly(theirs)) if a is not None]
                best = min(best or (math.inf,), (round(math.sqrt(sum((a - b) ** 2 for a, b in pairs)), 9), -other.toordinal(), other))
        filled, last = [], None
        for b, x in enumerate(values):
            ref = days[best[2]][b] if best else None
            if x is not None and x > 0:
                last = (x, ref)
            elif x is None and ref is not None:
                x = last[0] * ref / last[1] if last else ref
            filled.append(x)
        out[day] = (best[2] if best else None, filled)
    return out


def test_unfinished_days_follow_their_neighbour(spark):
    rng = np.random.default_rng(5)
    days = {}
    for d in range(40):
        values = [float(v) for v in rng.uniform(1, 9, 96).round(3)]
        if d in (0, 7, 20, 21, 39):
            for b in {0: range(96), 7: range(50, 96), 20: range(0, 6), 21: (3, 40, 41, 95), 39: range(96)}[d]:
                values[b] = None
        days[DAY + dt.timedelta(d)] = values
    rows = [(key, day, b + 1, x) for key in ("a", None) for day, v in days.items() for b, x in enumerate(v)]
    grid = spark.createDataFrame(rows, "unit string, date date, block_no int, load double")
    got = similar.impute_from_similar(grid, ["unit"], "load").collect()
    assert len(got) == len(rows)
    want = plain_imputed(days, 31)
    for r in got:
        lag, filled = want[r["date"]]
        x = filled[r["block_no"] - 1]
        assert r["lag_date"] == lag and (r["imputed"] is None if x is None else r["imputed"] == pytest.approx(x))
    empty = similar.impute_from_similar(grid.limit(0), ["unit"], "load")
    assert empty.columns == ["unit", "date", "block_no", "load", "lag_date", "imputed"] and empty.isEmpty()


def test_unknown_days_feed_the_next(spark):
    rng = np.random.default_rng(9)
    n, ahead, blocks = 80, 9, 12
    prices = 50 * np.exp(np.cumsum(rng.normal(0, 0.02, (n, blocks)), axis=0))
    rows = [("x", DAY + dt.timedelta(d), b + 1, float(prices[d, b])) for d in range(n) for b in range(blocks)]
    series = spark.createDataFrame(rows, "area string, date date, block_no int, price double")
    got = forecast.price_unknown_days(series, ["area"], "price", ahead, 5, 1).collect()
    found = {(r["date"], r["block_no"]): r for r in got}
    assert len(got) == len(found) == ahead * blocks

    smooth_rows = forecast.price_returns(series, ["area"], "price", 5, 1).select("date", "block_no", "smooth").collect()
    smooth = np.empty((n, blocks))
    for r in smooth_rows:
        smooth[(r["date"] - DAY).days, r["block_no"] - 1] = r["smooth"]
    ret = smooth[1:] / smooth[:-1] - 1
    flags = lambda d: [float((DAY + dt.timedelta(d)).weekday() == w) for w in (0, 5, 6)]
    x = np.array([[1.0, *(ret[d - k, b] for k in (1, 2, 3, 4)), *flags(d + 1)] for d in range(4, n - 1) for b in range(blocks)])
    y = np.array([ret[d, b] for d in range(4, n - 1) for b in range(blocks)])
    coef = np.linalg.solve(x.T @ x, x.T @ y)
    for b in range(blocks):
        price, past = smooth[-1, b], [ret[-1 - k, b] for k in range(4)]
        for d in range(n, n + ahead):
            change = float(np.dot(coef, [1.0, *past, *flags(d)]))
            price, past = price * (1 + change), [change, *past[:3]]
            assert found[DAY + dt.timedelta(d), b + 1]["price_pred"] == pytest.approx(price, rel=1e-4)
    assert all(r["price_pred_smooth"] is not None for r in got)
    assert forecast.price_unknown_days(series.limit(0), ["area"], "price", 3, 5, 1).isEmpty()


def test_publication_is_one_commit(spark, tmp_path, monkeypatch):
    from wattframe.sinks import publication

    root = str(tmp_path / "p")
    days = [DAY - dt.timedelta(1), DAY, DAY + dt.timedelta(1)]
    made = lambda x: spark.createDataFrame([("u", d, b, x + b) for d in days for b in range(1, 97)], "unit string, date date, block_no int, load double")
    seen = lambda: {(r["date"], r["block_no"]): (r["revision"], r["load"]) for r in publication.rows_in_force(spark, root, made(0.0).schema, ["unit"]).collect()}
    assert seen() == {}
    assert publication.publish_forecast(made(0.0), root, ["unit"], str(DAY), 1, "w", 0)
    before = seen()
    assert before == {(d, b): (0, float(b)) for d in days[1:] for b in range(1, 97)}

    def fail(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(versions, "_publish", fail)
        with pytest.raises(RuntimeError):
            publication.publish_forecast(made(1000.0), root, ["unit"], str(DAY), 50, "w", 1)
    assert seen() == before
    assert publication.publish_forecast(made(1000.0), root, ["unit"], str(DAY), 50, "w", 1)
    after = {(DAY, b): (0, float(b)) if b < 50 else (1, 1000.0 + b) for b in range(1, 97)} | {(days[2], b): (0, 1000.0 + b) for b in range(1, 97)}
    assert seen() == after
    assert not publication.publish_forecast(made(5.0), root, ["unit"], str(DAY), 80, "w", 1) and seen() == after


def test_unreadable_cells_are_code_zero_and_rules_share_scans(spark):
    from wattframe.operators import quality

    rows = [(0, ["1", "a"]), (1, ["x", "a"]), (2, ["-4", "b"]), (3, [None, "b"]), (4, ["1", None]), (5, [])]
    df = spark.createDataFrame(rows, "row_no long, cells array<string>")
    rules = quality.Rules(["n", "s"]).value_check("n", lambda v: v > 0, reads="int").unique_check("n").unique_check(["s"], "S", "again")
    rules = rules.expect_total("five", F.count(F.lit(1)) == 5).expect_total("six", F.count(F.lit(1)) == 6).expect_total("null", F.lit(None).cast("boolean"))
    spark.conf.set("spark.sql.ansi.enabled", "true")
    got = sorted((r["code"], r["row"], r["column"], r["field"], r["value"], r["message"]) for r in rules.validate(df).collect() if r["row"] is not None)
    assert got == [
        ("0", 2, 1, "n", "x", "Unexpected exception [ValueError]: cannot read the value as int"),
        ("1", 3, 1, "n", "-4", "Value check failed."),
        ("7", 5, 1, "n", "1", "Unique check failed."),
        ("S", 2, 2, "s", "a", "again"),
        ("S", 4, 2, "s", "b", "again"),
    ]
    assert sorted(r["message"] for r in rules.validate(df).collect() if r["row"] is None) == ["five", "null"]
