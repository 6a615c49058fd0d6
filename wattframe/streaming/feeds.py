"""File pick-up, block aggregation, upserts per micro-batch, run gates and resume points.

State is bounded by watermarks: a key leaves the state once its block can no longer change.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from wattframe.functions.blocks import BLOCKS_PER_DAY, block_of
from wattframe.sinks import versions
from wattframe.sinks.merge import upsert


def stream_files(spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_trigger: int = 100, **options) -> DataFrame:
    """New files of a folder, each once; the query's checkpoint remembers which were read."""
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load(path)


def only_new(stream: DataFrame, ts: str, keys: Sequence[str], delay: str = "1 day") -> DataFrame:
    """Rows not seen before within the watermark."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def block_sums(stream: DataFrame, ts: str, keys: Sequence[str], value: str, delay: str = "1 hour") -> DataFrame:
    """Sum and count per 15-minute block; works on a batch frame too, with the same rows."""
    marked = stream.withWatermark(ts, delay) if stream.isStreaming else stream
    grouped = marked.groupBy(F.window(ts, "15 minutes").alias("_w"), *keys).agg(
        F.sum(value).alias("value"), F.count(value).alias("n")
    )
    start = F.col("_w.start")
    return grouped.select(start.alias("block_start"), F.to_date(start).alias("date"), block_of(start).alias("block_no"), *keys, "value", "n")


def recent_view(stream: DataFrame, ts: str, keys: Sequence[str], value: str, length: str = "1 hour", slide: str = "15 minutes", delay: str = "1 hour") -> DataFrame:
    """Mean over a sliding window of recent readings."""
    marked = stream.withWatermark(ts, delay) if stream.isStreaming else stream
    grouped = marked.groupBy(F.window(ts, length, slide).alias("_w"), *keys).agg(
        F.avg(value).alias("mean_value"), F.count(value).alias("n")
    )
    return grouped.select(F.col("_w.start").alias("window_start"), *keys, "mean_value", "n")


def newest_per_key(batch: DataFrame, keys: Sequence[str], revision: str) -> DataFrame:
    """One row per key: the highest revision of the micro-batch."""
    values = [c for c in batch.columns if c not in keys]
    newest = batch.groupBy(*keys).agg(F.max_by(F.struct(*values), revision).alias("_v"))
    return newest.select(*keys, "_v.*").select(*batch.columns)


def upsert_stream(
    stream: DataFrame,
    read_base: Callable[[], DataFrame],
    write: Callable[[DataFrame, int], None],
    keys: Sequence[str],
    set_cols: Sequence[str],
    revision: str,
    checkpoint: str,
    set_literals: dict | None = None,
) -> StreamingQuery:
    """Latest revision wins, within a micro-batch and against the stored row. ``write`` receives the merged table and
    the batch id and must be idempotent for a repeated id (a transactional table; ``upsert_versions`` brings one)."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        newest = newest_per_key(batch, keys, revision)
        write(upsert(read_base(), newest, keys, set_cols, set_literals=set_literals, newest_by=revision), batch_id)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def upsert_versions(
    stream: DataFrame,
    root: str,
    keys: Sequence[str],
    set_cols: Sequence[str],
    partition: str,
    revision: str,
    checkpoint: str,
    writer: str = "stream",
    set_literals: dict | None = None,
) -> StreamingQuery:
    """Latest revision wins in a versioned table (``sinks.versions``): a micro-batch is one commit that rewrites the
    partitions it touches, and a batch that is run again changes nothing."""
    schema = stream.schema

    def merge(batch: DataFrame, batch_id: int) -> None:
        newest = newest_per_key(batch, keys, revision)
        versions.merge_newest(newest, root, schema, keys, set_cols, partition, revision, writer, batch_id, set_literals=set_literals)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def split_late(batch: DataFrame, ts: str, horizon) -> tuple[DataFrame, DataFrame]:
    """Rows in time, and rows older than the horizon for the correction table, whose days are run again
    with their processed flag reset."""
    late = F.col(ts) < horizon
    return batch.filter(~late), batch.filter(late).withColumn("processed_ind", F.lit(0))


def passed_gates(frame: DataFrame, ts: str, entity: str, gates: Sequence[int], delay: str = "1 day") -> DataFrame:
    """Runs that are due: (entity, date, block_no) of each gate passed, once, however many a batch passes.

    A row passes the last gate at or before its block, or the last gate of the day before where its own day has none
    yet; its time is null or ``gates`` empty: none. A run made is remembered until the watermark of the gates' times
    has gone by it, and a row of a gate behind the watermark starts no run. A batch frame gives the same rows. The
    state holds the runs of the last ``delay`` per entity, and rows are reduced to runs before they are shuffled.
    """
    listed = F.array(*[F.lit(int(g)) for g in sorted(gates)]).cast("array<int>")
    before = F.array_max(F.filter(listed, lambda g: g <= block_of(F.col(ts))))
    block = F.coalesce(before, F.array_max(listed))
    day = F.to_date(ts)
    date = F.when(before.isNull(), F.date_sub(day, 1)).otherwise(day)
    opens = F.timestamp_seconds((F.unix_date(date).cast("long") * BLOCKS_PER_DAY + block - 1) * (86400 // BLOCKS_PER_DAY))
    passed = frame.select(F.col(entity).alias("entity"), date.alias("date"), block.cast("int").alias("block_no"), opens.alias("_gate"))
    passed = passed.filter(F.col("_gate").isNotNull())
    if passed.isStreaming:
        # A task sends one row per run and batch of input, so a busy entity does not crowd its group.
        passed = passed.mapInPandas(lambda frames: (f.drop_duplicates() for f in frames), passed.schema).withWatermark("_gate", delay)
    return passed.dropDuplicates(["entity", "date", "block_no", "_gate"]).select("entity", "date", "block_no")


def run_gate(stream: DataFrame, ts: str, entity: str, exact_gates: Sequence[int] | None = None) -> DataFrame:
    """Emit (entity, date, block_no) whenever a newer block than any before arrives for an entity.

    With ``exact_gates`` every one of those blocks that is passed opens, see ``passed_gates``. Else the state is one
    number per entity, and each task sends one row per entity and batch of input, so a busy entity does not crowd its
    group.
    """
    if exact_gates is not None:
        return passed_gates(stream, ts, entity, exact_gates)

    def step(key, frames, state: GroupState):
        seen = state.get[0] if state.exists else -1
        newest = seen
        for pdf in frames:
            newest = max(newest, int(pdf["_slot"].max()))
        if newest > seen:
            state.update((newest,))
            day, block = divmod(newest, BLOCKS_PER_DAY)
            yield pd.DataFrame({"entity": [key[0]], "day": [day], "block_no": [block + 1]})

    def newest_only(batches):
        for pdf in batches:
            yield pdf.groupby("entity", as_index=False)["_slot"].max()

    slot = F.unix_date(F.to_date(ts)).cast("long") * BLOCKS_PER_DAY + block_of(F.col(ts)) - 1
    marked = stream.select(F.col(entity).cast("string").alias("entity"), slot.alias("_slot"))
    marked = marked.mapInPandas(newest_only, "entity string, _slot long")
    opened = marked.groupBy("entity").applyInPandasWithState(
        step, "entity string, day long, block_no long", "newest long", "append", GroupStateTimeout.NoTimeout
    )
    return opened.select("entity", F.date_from_unix_date(F.col("day").cast("int")).alias("date"), F.col("block_no").cast("int"))


def resume_point(tracker: DataFrame, keys: Sequence[str], now, lock_minutes: int = 10) -> DataFrame:
    """Where a feed goes on, from the last tracker row per key: a run that started less than the lock
    time ago refuses (null), success goes to the next revision, failure repeats its revision, nothing
    recorded starts at -1."""
    last = tracker.groupBy(*keys).agg(F.max_by(F.struct("status", "revision", "modified"), F.struct("revision", "modified")).alias("_l"))
    age = F.timestamp_diff("SECOND", F.col("_l.modified"), now)
    locked = (F.col("_l.status") == "RUNNING") & (age < lock_minutes * 60)
    point = (
        F.when(locked, None)
        .when(F.col("_l.status") == "SUCCESS", F.col("_l.revision") + 1)
        .when(F.col("_l.status").isin("FAILED", "RUNNING"), F.col("_l.revision"))
        .otherwise(-1)
    )
    return last.select(*keys, point.alias("resume_revision"), locked.cast("int").alias("locked"))


def resume_points_for(wanted: DataFrame, tracker: DataFrame, keys: Sequence[str], now, lock_minutes: int = 10) -> DataFrame:
    """Resume point per wanted key; keys without a tracker row start at -1."""
    known = resume_point(tracker, keys, now, lock_minutes)
    joined = wanted.join(known, list(keys), "left")
    fresh = F.col("locked").isNull()
    return joined.withColumn("resume_revision", F.when(fresh, -1).otherwise(F.col("resume_revision"))).withColumn(
        "locked", F.coalesce("locked", F.lit(0))
    )
