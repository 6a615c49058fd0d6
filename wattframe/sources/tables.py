"""Table and delimited-text scans.

Every text format has a ``parse_*`` function over a column of lines, so the same code serves files, text
tables and streams, and a ``read_*`` function over a path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattframe.functions.scalars import nullify


def read_table(spark: SparkSession, path: str, cols: Sequence[str] | None = None, where: Column | None = None, fmt: str = "parquet", **options) -> DataFrame:
    """Scan with filter and column list left to the source.

    For a database pass ``fmt="jdbc"``, the table name as ``path`` and the reader's own options, among
    them partitionColumn, lowerBound, upperBound and numPartitions so that many tasks read.
    """
    reader = spark.read.format(fmt).options(**options)
    df = reader.option("dbtable", path).load() if fmt == "jdbc" else reader.load(path)
    df = df if where is None else df.filter(where)
    return df if cols is None else df.select(*cols)


def read_csv(spark: SparkSession, path: str, schema: str, date_fmt: str = "dd-MM-yyyy", sep: str = ",") -> DataFrame:
    """Delimited file with a header and day-first dates."""
    return spark.read.schema(schema).option("header", "true").option("dateFormat", date_fmt).option("sep", sep).csv(path)


def parse_csv(df: DataFrame, line: str, schema: str, date_fmt: str = "dd-MM-yyyy", sep: str = ",") -> DataFrame:
    """Delimited lines in a text column."""
    return df.select(F.from_csv(line, schema, {"dateFormat": date_fmt, "sep": sep}).alias("_r")).select("_r.*")


def read_many(spark: SparkSession, path: str, schema: str, prefix: str = "", suffix: str = "", date_fmt: str = "dd-MM-yyyy", fmt: str = "csv") -> DataFrame:
    """All files of a folder whose names match, with the file name as a column."""
    reader = spark.read.format(fmt).schema(schema).option("pathGlobFilter", f"{prefix}*{suffix}")
    if fmt == "csv":
        reader = reader.option("header", "true").option("dateFormat", date_fmt)
    return reader.load(path).select("*", F.col("_metadata.file_name").alias("file_name"))


def parse_scada(df: DataFrame, line: str, values: Sequence[str]) -> DataFrame:
    """Whitespace-separated lines: date, time, then one number per value name; date and time fuse into a
    timestamp."""
    parts = F.split(F.trim(F.col(line)), r"\s+")
    part = lambda i: F.try_element_at(parts, F.lit(i))
    stamp = F.try_to_timestamp(F.concat_ws(" ", part(1), part(2)), F.lit("dd-MM-yyyy HH:mm:ss"))
    return df.filter(F.trim(line) != "").select(
        stamp.alias("datetime"), *[part(i + 3).try_cast("double").alias(v) for i, v in enumerate(values)]
    )


def read_scada(spark: SparkSession, path: str, values: Sequence[str]) -> DataFrame:
    return parse_scada(spark.read.text(path), "value", values)


NULL_TOKENS = ("NA", "----", "")


def parse_station_obs(df: DataFrame, line: str, names: Sequence[str], date: str = "obs_date", time: str = "time_utc", zone: str = "Asia/Kolkata") -> DataFrame:
    """';'-separated station lines: NA and ---- are null, UTC date and time become a local stamp, lines
    whose cells are all blank are skipped."""
    parts = F.split(F.col(line), ";")
    cells = {n: nullify(F.try_element_at(parts, F.lit(i + 1)), NULL_TOKENS) for i, n in enumerate(names)}
    wanted = df.filter(F.exists(parts, lambda x: F.trim(x) != ""))
    utc = F.try_to_timestamp(F.concat_ws(" ", cells[date], cells[time]), F.lit("yyyy-MM-dd HH:mm"))
    return wanted.select(*[c.alias(n) for n, c in cells.items()], F.from_utc_timestamp(utc, zone).alias("local_ts"))


def read_station_obs(spark: SparkSession, path: str, names: Sequence[str], **options) -> DataFrame:
    return parse_station_obs(spark.read.text(path), "value", names, **options)
