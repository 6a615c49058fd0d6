"""Domain views over the given tables, once as Spark plans and once as SQL.

Raw events are summed into blocks with map-side partial aggregates before anything is sorted or windowed,
so what follows is bounded by entities x dates x 96 blocks, whatever the number of events.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattframe.functions.blocks import block_of
from wattframe.operators import series

BLOCK_SQL = "CAST(floor((hour(ts) * 60 + minute(ts)) / 15) AS INTEGER) + 1"


class Tables:
    """Given tables by name and domain views by property; nothing runs until an action."""

    NAMES = (
        "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
        "embeddings", "pages", "benchmark", "labels", "conversations",
    )

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name in Tables.NAMES:
            df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            self.__dict__[name] = df
            return df
        raise AttributeError(name)

    @cached_property
    def readings(self) -> DataFrame:
        """Events with their date, block, running block number and location."""
        block = block_of(F.col("ts"))
        return self.events.select(
            "event_id", "ts", F.to_date("ts").alias("date"), block.alias("block_no"),
            (F.unix_date(F.to_date("ts")).cast("long") * 96 + block - 1).alias("slot"),
            F.col("event_type").alias("pool"), (F.col("user_id") % 8).cast("int").alias("location"), "value",
        )

    @cached_property
    def load(self) -> DataFrame:
        return self.readings.groupBy("date", "block_no").agg(F.sum("value").alias("value"), F.count("value").alias("n"))

    @cached_property
    def cuts(self) -> DataFrame:
        return self.readings.filter("pool = 'error'").groupBy("date", "block_no").agg(F.sum("value").alias("cut"))

    @cached_property
    def pools(self) -> DataFrame:
        return self.readings.groupBy("date", "block_no", "pool").agg(F.sum("value").alias("value"))

    @cached_property
    def grid(self) -> DataFrame:
        """Load on all blocks of all dates; gaps are null."""
        return series.gap_fill(self.load.select("date", "block_no", "value"), series.span_spine(self.load), ["date", "block_no"])

    @cached_property
    def pool_grid(self) -> DataFrame:
        return series.gap_fill(self.pools, series.span_spine(self.pools, ["pool"]), ["pool", "date", "block_no"])

    @cached_property
    def weather(self) -> DataFrame:
        return self.readings.groupBy("location", "date", (F.hour("ts") + 1).alias("hour")).agg(
            F.avg("value").alias("temp"), F.count("value").cast("double").alias("rain"), F.max("value").alias("wind")
        )

    @cached_property
    def calendar(self) -> DataFrame:
        """Event days: every seventh day of a month, three names."""
        return self.load.select("date").distinct().filter(F.dayofmonth("date") % 7 == 0).select(
            "date", F.concat(F.lit("event"), (F.dayofmonth("date") % 3).cast("string")).alias("name")
        )

    @cached_property
    def long_blocks(self) -> DataFrame:
        """Several years of blocks per pool, from line items."""
        return self.lineitem.groupBy(
            F.col("l_returnflag").alias("pool"), F.to_date("l_shipdate").alias("date"), (F.col("l_orderkey") % 96 + 1).cast("int").alias("block_no")
        ).agg(F.sum("l_quantity").alias("value"))

    @cached_property
    def prices(self) -> DataFrame:
        return self.orders.groupBy(F.to_date("o_orderdate").alias("date"), F.col("o_orderpriority").alias("area")).agg(
            F.avg("o_totalprice").alias("price")
        )

    @cached_property
    def price_blocks(self) -> DataFrame:
        """Price per date and block, thousands, with a forecast beside it."""
        return self.orders.groupBy(F.to_date("o_orderdate").alias("date"), (F.col("o_custkey") % 96 + 1).cast("int").alias("block_no")).agg(
            (F.avg("o_totalprice") / 1000).alias("price"), (F.max("o_totalprice") / 1000 + 1).alias("forecast")
        )

    @cached_property
    def schedules(self) -> DataFrame:
        """Revisioned schedules: one row per key and revision."""
        return self.lineitem.groupBy(
            F.col("l_orderkey").alias("key"), (F.col("l_linenumber") - 1).alias("revision")
        ).agg(F.max("l_quantity").alias("schedule"), F.min(F.to_date("l_shipdate")).alias("date"))

    @cached_property
    def bands(self) -> DataFrame:
        """Capacity bands of each unit."""
        band = F.floor((F.col("p_size") - 1) / 10).cast("int")
        return self.part.groupBy(F.col("p_brand").alias("unit"), band.alias("band")).agg(
            (F.avg("p_retailprice") / 500).alias("rate_up"), (F.min("p_retailprice") / 500).alias("rate_down")
        ).select("unit", "band", (F.col("band") * 10).alias("low"), (F.col("band") * 10 + 10).alias("high"), "rate_up", "rate_down")

    @cached_property
    def merit(self) -> DataFrame:
        """Volume and mean cost per date and unit."""
        return self.lineitem.groupBy(F.to_date("l_shipdate").alias("date"), F.col("l_suppkey").alias("unit")).agg(
            F.sum("l_quantity").alias("volume"), (F.sum("l_extendedprice") / F.sum("l_quantity")).alias("cost")
        )

    @cached_property
    def sites(self) -> DataFrame:
        """Units with coordinates and a rated capacity."""
        k = F.col("s_suppkey")
        return self.supplier.select(
            k.alias("unit"),
            (F.lit(10.0) + (k * 37 % 1000) / 100 + F.col("s_nationkey") / 7).alias("lat"),
            (F.lit(70.0) + (k * 61 % 1000) / 100 - F.col("s_nationkey") / 9).alias("lon"),
            (F.lit(50.0) + k % 50).alias("capacity"),
            F.col("s_nationkey").alias("nation"),
        )

    @cached_property
    def unit_blocks(self) -> DataFrame:
        """Generation per unit, date and block of eight hours."""
        return self.lineitem.groupBy(
            F.col("l_suppkey").alias("unit"), F.trunc("l_shipdate", "month").alias("date"), (F.col("l_linenumber")).cast("int").alias("block_no")
        ).agg(F.avg("l_quantity").alias("generation"))

    @cached_property
    def records(self) -> DataFrame:
        """Orders as delimited records with faults, indexed by order key."""
        k = F.col("o_orderkey")
        text = lambda c: F.col(c).cast("string")
        cells = F.array(
            text("o_orderkey"),
            F.when(k % 17 == 0, "x").otherwise(text("o_custkey")),
            F.when(k % 23 == 0, "Q").otherwise(F.col("o_orderstatus")),
            F.when(k % 29 == 0, "-1").otherwise(F.round("o_totalprice", 0).cast("long").cast("string")),
            F.when(k % 31 == 0, "31-02-1999").otherwise(F.date_format("o_orderdate", "dd-MM-yyyy")),
        )
        short = F.slice(cells, 1, 4)
        return self.orders.select(k.alias("row_no"), F.when(k % 37 == 0, short).otherwise(cells).alias("cells"))


SQL_VIEWS = {
    "v_readings": f"SELECT event_id, ts, CAST(ts AS DATE) AS date, {BLOCK_SQL} AS block_no, event_type AS pool,"
    " CAST(user_id % 8 AS INTEGER) AS location, value FROM events",
    "v_load": "SELECT date, block_no, sum(value) AS value, count(value) AS n FROM v_readings GROUP BY date, block_no",
    "v_cuts": "SELECT date, block_no, sum(value) AS cut FROM v_readings WHERE pool = 'error' GROUP BY date, block_no",
    "v_pools": "SELECT date, block_no, pool, sum(value) AS value FROM v_readings GROUP BY date, block_no, pool",
    "v_blocks": "SELECT CAST(unnest(range(1, 97)) AS INTEGER) AS block_no",
    "v_days": "SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM v_load",
    "v_grid": "SELECT d.date, b.block_no, l.value FROM v_days d CROSS JOIN v_blocks b"
    " LEFT JOIN v_load l ON l.date = d.date AND l.block_no = b.block_no",
    "v_pool_days": "SELECT pool, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM v_pools GROUP BY pool",
    "v_pool_grid": "SELECT d.pool, d.date, b.block_no, l.value FROM v_pool_days d CROSS JOIN v_blocks b"
    " LEFT JOIN v_pools l ON l.pool = d.pool AND l.date = d.date AND l.block_no = b.block_no",
    "v_weather": "SELECT CAST(user_id % 8 AS INTEGER) AS location, CAST(ts AS DATE) AS date, hour(ts) + 1 AS hour,"
    " avg(value) AS temp, CAST(count(value) AS DOUBLE) AS rain, max(value) AS wind FROM events GROUP BY 1, 2, 3",
    "v_calendar": "SELECT DISTINCT date, 'event' || CAST(day(date) % 3 AS VARCHAR) AS name FROM v_load WHERE day(date) % 7 = 0",
    "v_long": "SELECT l_returnflag AS pool, CAST(l_shipdate AS DATE) AS date, CAST(l_orderkey % 96 + 1 AS INTEGER) AS block_no,"
    " sum(l_quantity) AS value FROM lineitem GROUP BY 1, 2, 3",
    "v_prices": "SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS area, avg(o_totalprice) AS price FROM orders GROUP BY 1, 2",
    "v_price_blocks": "SELECT CAST(o_orderdate AS DATE) AS date, CAST(o_custkey % 96 + 1 AS INTEGER) AS block_no,"
    " avg(o_totalprice) / 1000 AS price, max(o_totalprice) / 1000 + 1 AS forecast FROM orders GROUP BY 1, 2",
    "v_schedules": "SELECT l_orderkey AS key, l_linenumber - 1 AS revision, max(l_quantity) AS schedule,"
    " min(CAST(l_shipdate AS DATE)) AS date FROM lineitem GROUP BY 1, 2",
    "v_bands": "SELECT p_brand AS unit, (p_size - 1) // 10 AS band, ((p_size - 1) // 10) * 10 AS low, ((p_size - 1) // 10) * 10 + 10 AS high,"
    " avg(p_retailprice) / 500 AS rate_up, min(p_retailprice) / 500 AS rate_down FROM part GROUP BY 1, 2, 3, 4",
    "v_merit": "SELECT CAST(l_shipdate AS DATE) AS date, l_suppkey AS unit, sum(l_quantity) AS volume,"
    " sum(l_extendedprice) / sum(l_quantity) AS cost FROM lineitem GROUP BY 1, 2",
    "v_sites": "SELECT s_suppkey AS unit, 10.0::DOUBLE + (s_suppkey * 37 % 1000) / 100 + s_nationkey / 7 AS lat,"
    " 70.0::DOUBLE + (s_suppkey * 61 % 1000) / 100 - s_nationkey / 9 AS lon, 50.0::DOUBLE + s_suppkey % 50 AS capacity,"
    " s_nationkey AS nation FROM supplier",
    "v_unit_blocks": "SELECT l_suppkey AS unit, CAST(date_trunc('month', l_shipdate) AS DATE) AS date, l_linenumber AS block_no,"
    " avg(l_quantity) AS generation FROM lineitem GROUP BY 1, 2, 3",
    "v_records": "SELECT row_no, CASE WHEN row_no % 37 = 0 THEN cells[1:4] ELSE cells END AS cells FROM ("
    "SELECT o_orderkey AS row_no, [CAST(o_orderkey AS VARCHAR),"
    " CASE WHEN o_orderkey % 17 = 0 THEN 'x' ELSE CAST(o_custkey AS VARCHAR) END,"
    " CASE WHEN o_orderkey % 23 = 0 THEN 'Q' ELSE o_orderstatus END,"
    " CASE WHEN o_orderkey % 29 = 0 THEN '-1' ELSE CAST(CAST(round(o_totalprice, 0) AS BIGINT) AS VARCHAR) END,"
    " CASE WHEN o_orderkey % 31 = 0 THEN '31-02-1999' ELSE strftime(o_orderdate, '%d-%m-%Y') END] AS cells FROM orders)",
}
