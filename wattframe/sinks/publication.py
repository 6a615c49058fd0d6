"""Forecast rows published by revision, together with the blocks each revision is in force for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from wattframe.functions.blocks import BLOCKS_PER_DAY
from wattframe.operators.forecast import publish_revision
from wattframe.session import cut_lineage
from wattframe.sinks import versions


def _schemas(forecast: StructType, keys: Sequence[str]) -> tuple[StructType, StructType]:
    number = lambda *names: [StructField(n, IntegerType()) for n in names]
    rows = StructType([*forecast.fields, *number("revision")])
    ranges = StructType([*[forecast[k] for k in keys], forecast["date"], *number("revision", "from_block", "to_block")])
    return rows, ranges


def _same(a: DataFrame, b: DataFrame, on: Sequence[str]):
    return [a[c].eqNullSafe(b[c]) for c in on]


def publish_forecast(forecast: DataFrame, root: str, keys: Sequence[str], as_of: str, start_block: int, writer: str, batch_id: int) -> bool:
    """Publish ``forecast`` (keys, date, block_no, values) as of a block; False where the batch was published before.

    The run date gets its next revision from ``start_block`` on, and its newest range closes before it; later dates get
    revision 0 over the whole day, which replaces their old one; earlier dates are not published. Rows and ranges are
    one commit of ``sinks.versions``: readers see both or neither. Only the published dates are read and written.
    Keys hold no nulls; a forecast without rows on or after the run date publishes an empty batch.
    """
    spark, keys = forecast.sparkSession, list(keys)
    if versions.manifest(spark, root)["writers"].get(writer, -1) >= batch_id:
        return False
    on = [*keys, "date"]
    day = F.to_date(F.lit(as_of))
    # Read by rows and ranges alike: both must see the same forecast.
    fresh = cut_lineage(forecast.filter(F.col("date") >= day))
    rows_schema, ranges_schema = _schemas(fresh.schema, keys)
    dates = fresh.select("date").distinct()
    ranges = versions.read_table(spark, root, ranges_schema, "ranges").join(dates, "date", "left_semi").select(*ranges_schema.names)
    stored = versions.read_table(spark, root, rows_schema, "rows").join(dates, "date", "left_semi").select(*rows_schema.names)
    after = publish_revision(fresh, ranges, keys, as_of, start_block)
    number = after.groupBy(*on).agg(F.max("revision").alias("_last")).withColumnsRenamed({c: f"_{c}" for c in on})
    numbered = fresh.join(number, [fresh[c].eqNullSafe(number[f"_{c}"]) for c in on]).select(
        *fresh.columns, F.when(F.col("date") == day, F.col("_last")).otherwise(0).cast("int").alias("revision")
    )
    numbered = numbered.filter((F.col("date") > day) | (F.col("block_no") >= start_block))
    again = fresh.filter(F.col("date") > day).select(*on).distinct()
    kept = stored.join(again, [*_same(stored, again, on), stored["revision"] == 0], "left_anti")
    return versions.commit_tables({"rows": kept.unionByName(numbered), "ranges": after}, spark, root, "date", writer, batch_id)


def rows_in_force(spark: SparkSession, root: str, forecast: StructType, keys: Sequence[str]) -> DataFrame:
    """Published rows whose revision is in force at their block; ``forecast`` is the schema that was published."""
    rows_schema, ranges_schema = _schemas(forecast, keys)
    state = versions.manifest(spark, root)
    rows = versions.read_table(spark, root, rows_schema, "rows", state)
    ranges = versions.read_table(spark, root, ranges_schema, "ranges", state)
    met = rows.join(ranges, [*_same(rows, ranges, [*keys, "date"]), rows["revision"] == ranges["revision"]])
    return met.filter(F.col("block_no").between(F.greatest("from_block", F.lit(1)), F.least("to_block", F.lit(BLOCKS_PER_DAY)))).select(
        *[rows[c] for c in rows.columns]
    )
