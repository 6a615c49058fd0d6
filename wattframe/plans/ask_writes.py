"""Registered queries: tables, reports and streams that are written and read back.

Each run writes to a folder of its own below the shared one, so runs do not meet and a task that is run again finds its rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattframe.plans.registry import query
from wattframe.session import shared_folder
from wattframe.sinks import files
from wattframe.streaming import feeds


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"


def _drained(stream: DataFrame, folder: str) -> DataFrame:
    """What a stream holds by now, each batch committed once by its checkpoint, read back from where it was written."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{folder}/checkpoint")
    writer.trigger(availableNow=True).start(f"{folder}/rows").awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/rows")


@query("replaced_table", "o_orderkey:i o_totalprice:g", "SELECT o_orderkey, o_totalprice * 2 AS o_totalprice FROM orders WHERE o_orderstatus <> 'F'")
def _(t):
    path, orders = _folder(t.spark), t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    files.write_replace(orders, path)
    files.write_replace(orders.filter("o_orderstatus <> 'F'").withColumn("o_totalprice", F.col("o_totalprice") * 2), path)
    return t.spark.read.parquet(path)


@query("replaced_partitions", "o_orderkey:i o_orderpriority:s o_totalprice:g", """
SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderpriority LIKE '1%' THEN -o_totalprice ELSE o_totalprice END AS o_totalprice FROM orders
WHERE o_orderpriority NOT LIKE '1%' OR o_orderstatus = 'O'""")
def _(t):
    path, orders = _folder(t.spark), t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice", "o_orderstatus")
    files.write_replace(orders, path, ["o_orderpriority"])
    urgent = orders.filter("o_orderpriority LIKE '1%' AND o_orderstatus = 'O'")
    files.write_touched(urgent.withColumn("o_totalprice", -F.col("o_totalprice")), path, ["o_orderpriority"])
    return t.spark.read.parquet(path)


@query("appended_rows", "o_orderstatus:s n:i total:g", """
SELECT o_orderstatus, count(*) * CASE o_orderstatus WHEN 'O' THEN 2 ELSE 1 END AS n, sum(o_totalprice) * CASE o_orderstatus WHEN 'O' THEN 2 ELSE 1 END AS total FROM orders GROUP BY 1""")
def _(t):
    path, orders = _folder(t.spark), t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    files.write_replace(orders, path, ["o_orderstatus"])
    files.append(orders.filter("o_orderstatus = 'O'"), path, ["o_orderstatus"])
    back = t.spark.read.parquet(path)
    return back.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total"))


@query("report_sheets", "sheet:s pool:s date:d block_no:i value:g", """
SELECT 'positions_2024-01-31_R2' AS sheet, pool, date, block_no, value FROM v_pools""")
def _(t):
    path = files.report_folder(_folder(t.spark), "positions", "2024-01-31", 2)
    files.write_report(t.pools.select("pool", "date", "block_no", "value"), path, "pool", ["date", "block_no"])
    back = t.spark.read.option("header", "true").schema("date date, block_no int, value double, pool string").csv(path)
    return back.withColumn("sheet", F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/pool=", 1))


@query("files_as_stream", "event_id:i event_type:s value:g", """
SELECT event_id, event_type, value FROM events UNION ALL SELECT -event_id - 1, event_type, value FROM events WHERE event_id % 2 = 0""")
def _(t):
    source, events = _folder(t.spark), t.events.select("event_id", "event_type", "value")
    files.write_replace(events, source)
    folder = _folder(t.spark)
    _drained(feeds.stream_files(t.spark, source, events.schema, files_per_trigger=2), folder)
    # A second drop of files: what the first run has read is not read again.
    files.append(events.filter("event_id % 2 = 0").withColumn("event_id", -F.col("event_id") - 1), source)
    return _drained(feeds.stream_files(t.spark, source, events.schema, files_per_trigger=2), folder)


@query("new_lines_only", "event_id:i event_type:s value:g", "SELECT event_id, event_type, value FROM events")
def _(t):
    """Every line arrives twice, in files cut by time; the second copy is dropped while the first is remembered."""
    source = _folder(t.spark)
    lines = t.events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    twice = lines.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    files.write_replace(twice.repartitionByRange("ts"), source)
    stream = feeds.stream_files(t.spark, source, lines.schema, files_per_trigger=100)
    return _drained(feeds.only_new(stream, "ts", ["event_id"], "30 days"), _folder(t.spark))
