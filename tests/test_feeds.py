"""Files in and out, streams against their batch form."""

import datetime as dt
import re

from pyspark.sql import functions as F

from wattframe.sinks import files, merge
from wattframe.sources import tables
from wattframe.streaming import feeds

SF = "/root/testdata/sf0.001"


def drain(query):
    query.processAllAvailable()
    query.stop()


def write_text(path, name, text):
    path.mkdir(exist_ok=True)
    (path / name).write_text(text)
    return str(path)


def test_csv_and_directory_reads(spark, tmp_path):
    folder = write_text(tmp_path / "in", "load_a.csv", "date,v\n31-12-2023,1.5\n")
    write_text(tmp_path / "in", "load_b.csv", "date,v\n01-02-2024,2.5\n")
    write_text(tmp_path / "in", "other.csv", "date,v\n01-02-2024,9\n")
    one = tables.read_csv(spark, folder + "/load_a.csv", "date date, v double").first()
    assert one == (dt.date(2023, 12, 31), 1.5)
    many = tables.read_many(spark, folder, "date date, v double", prefix="load_", suffix=".csv").orderBy("file_name").collect()
    assert [(r["file_name"], r["v"]) for r in many] == [("load_a.csv", 1.5), ("load_b.csv", 2.5)]


def test_scada_and_station_files(spark, tmp_path):
    folder = write_text(tmp_path / "s", "a.txt", "01-01-2024   10:15:00  5.5  x\n\n")
    row = tables.read_scada(spark, folder, ["a", "b"]).first()
    assert row["datetime"] == dt.datetime(2024, 1, 1, 10, 15) and row["a"] == 5.5 and row["b"] is None
    folder = write_text(tmp_path / "o", "b.txt", "S1;2024-01-01;20:00;NA;----\n;;;;\n")
    got = tables.read_station_obs(spark, folder, ["station", "obs_date", "time_utc", "rain", "temp"]).collect()
    assert len(got) == 1 and got[0]["rain"] is None and got[0]["local_ts"] == dt.datetime(2024, 1, 2, 1, 30)


def test_pushdown_reaches_the_scan(spark):
    df = tables.read_table(spark, f"{SF}/lineitem.parquet", ["l_orderkey"], F.col("l_quantity") > 45)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_quantity,45.0)" in plan and "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("WIND", 2, 1.0), ("SOLAR", 1, 2.0), ("WIND", 1, 3.0)], "pool_type string, block int, v double")
    path = files.report_folder(str(tmp_path), "gen", "2024-01-01", 3)
    assert path.endswith("gen_2024-01-01_R3")
    files.write_report(df, path, "pool_type", ["block"])
    back = spark.read.option("header", "true").csv(path)
    assert back.count() == 3 and set(r[0] for r in back.select("pool_type").distinct().collect()) == {"WIND", "SOLAR"}
    table = str(tmp_path / "t")
    files.write_replace(df, table, ["pool_type"])
    files.append(df, table, ["pool_type"])
    assert spark.read.parquet(table).count() == 6
    files.write_replace(df, table, ["pool_type"])
    assert spark.read.parquet(table).count() == 3


def test_upsert_rewrites_touched_partitions_only(spark, tmp_path):
    table = str(tmp_path / "t")
    base = spark.createDataFrame([("2024-01-01", 1, 1.0), ("2024-01-01", 2, 2.0), ("2024-01-02", 1, 3.0)], "date string, block int, v double")
    files.write_replace(base.withColumn("date", F.to_date("date")), table, ["date"])
    untouched = sorted(p.name for p in (tmp_path / "t" / "date=2024-01-02").iterdir())
    new = spark.createDataFrame([("2024-01-01", 2, 9.0), ("2024-01-03", 1, 5.0)], "date string, block int, v double").withColumn("date", F.to_date("date"))
    stored = spark.read.parquet(table)
    merged = merge.upsert_touched(stored, new, ["date", "block"], ["v"], "date")
    assert re.search(r"PartitionFilters: \[[^\]]*date#\d+ IN", merged._jdf.queryExecution().executedPlan().toString())
    files.write_touched(merged, table, ["date"])
    spark.catalog.refreshByPath(table)
    got = sorted((str(r["date"]), r["block"], r["v"]) for r in spark.read.parquet(table).collect())
    assert got == [("2024-01-01", 1, 1.0), ("2024-01-01", 2, 9.0), ("2024-01-02", 1, 3.0), ("2024-01-03", 1, 5.0)]
    assert untouched == sorted(p.name for p in (tmp_path / "t" / "date=2024-01-02").iterdir())


def events_stream(spark, tmp_path, parts=3):
    source = tmp_path / "events"
    base = spark.read.parquet(f"{SF}/events.parquet").select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("pool"), "value")
    base.repartitionByRange(parts, "ts").write.parquet(str(source))
    return base, feeds.stream_files(spark, str(source), base.schema, files_per_trigger=1)


def test_block_sums_stream_equals_batch(spark, tmp_path):
    base, stream = events_stream(spark, tmp_path)
    out = feeds.block_sums(stream, "ts", ["pool"], "value", "40 days")
    query = out.writeStream.outputMode("complete").format("memory").queryName("sums").start()
    drain(query)
    cols = ["date", "block_no", "pool", "n"]
    value = F.round("value", 6).alias("value")
    want = feeds.block_sums(base, "ts", ["pool"], "value").select(*cols, value)
    got = spark.table("sums").select(*cols, value)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def test_recent_view_stream_equals_batch(spark, tmp_path):
    base, stream = events_stream(spark, tmp_path)
    query = feeds.recent_view(stream, "ts", ["pool"], "value", delay="40 days").writeStream.outputMode("complete").format("memory").queryName("recent").start()
    drain(query)
    cols = ["window_start", "pool", "n", F.round("mean_value", 6)]
    want, got = feeds.recent_view(base, "ts", ["pool"], "value").select(*cols), spark.table("recent").select(*cols)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def test_only_new_drops_repeats(spark, tmp_path):
    base, _ = events_stream(spark, tmp_path)
    twice = tmp_path / "twice"
    base.write.parquet(str(twice))
    base.write.mode("append").parquet(str(twice))
    stream = feeds.stream_files(spark, str(twice), base.schema, files_per_trigger=1)
    query = feeds.only_new(stream, "ts", ["event_id"], "60 days").writeStream.format("memory").queryName("fresh").start()
    drain(query)
    assert spark.table("fresh").count() == base.count()


def test_upsert_stream_latest_revision_wins(spark, tmp_path):
    schema = "k int, revision int, v double, processed int"
    source = tmp_path / "in"
    for i, rows in enumerate(([(1, 0, 1.0, 1), (2, 0, 2.0, 1)], [(1, 2, 1.2, 1), (1, 1, 1.1, 1), (3, 0, 3.0, 1)])):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(source))
    state = {"version": None}

    def read_base():
        return spark.read.parquet(state["version"]) if state["version"] else spark.createDataFrame([], schema)

    def write(df, batch_id):
        path = str(tmp_path / f"v{batch_id}")
        df.write.mode("overwrite").parquet(path)
        state["version"] = path

    stream = feeds.stream_files(spark, str(source), spark.createDataFrame([], schema).schema, files_per_trigger=1)
    query = feeds.upsert_stream(stream, read_base, write, ["k"], ["revision", "v"], "revision", str(tmp_path / "cp"), {"processed": 0})
    query.awaitTermination()
    got = {r["k"]: (r["revision"], r["v"], r["processed"]) for r in read_base().collect()}
    assert got == {1: (2, 1.2, 0), 2: (0, 2.0, 0), 3: (0, 3.0, 0)}


def test_run_gate_opens_once_per_newest_block(spark, tmp_path):
    base, stream = events_stream(spark, tmp_path)
    query = feeds.run_gate(stream, "ts", "pool").writeStream.outputMode("append").format("memory").queryName("gate").start()
    drain(query)
    newest = base.groupBy("pool").agg(F.max("ts").alias("ts"))
    got = spark.table("gate").groupBy("entity").agg(F.max(F.struct("date", "block_no")).alias("m"), F.count(F.lit(1)).alias("n"))
    joined = newest.join(got, F.col("pool") == F.col("entity")).select(F.to_date("ts") == F.col("m.date"), "n").collect()
    assert joined and all(same and n <= 3 for same, n in joined)


def test_split_late(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 3))], "k int, ts timestamp")
    fresh, late = feeds.split_late(df, "ts", F.lit(dt.datetime(2024, 1, 2)))
    assert fresh.first()["k"] == 2 and (late.first()["k"], late.first()["processed_ind"]) == (1, 0)


def test_resume_points(spark):
    now = dt.datetime(2024, 1, 1, 12, 0)
    at = lambda m: now - dt.timedelta(minutes=m)
    tracker = spark.createDataFrame(
        [("a", 3, "SUCCESS", at(60)), ("b", 2, "FAILED", at(60)), ("c", 5, "RUNNING", at(5)), ("d", 5, "RUNNING", at(11))],
        "feed string, revision int, status string, modified timestamp",
    )
    wanted = spark.createDataFrame([(f,) for f in "abcde"], "feed string")
    got = {r["feed"]: (r["resume_revision"], r["locked"]) for r in feeds.resume_points_for(wanted, tracker, ["feed"], F.lit(now)).collect()}
    assert got == {"a": (4, 0), "b": (2, 0), "c": (None, 1), "d": (5, 0), "e": (-1, 0)}


def test_merge_columns_follow_the_base(spark):
    base = spark.createDataFrame([(1, "a")], "k int, s string")
    assert merge.replace_keys(base, spark.createDataFrame([("b", 1)], "s string, k int"), ["k"]).columns == ["k", "s"]
