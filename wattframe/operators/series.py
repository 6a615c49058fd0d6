"""Block series: spines, gaps, nulls, joins on the calendar."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattframe.functions import blocks, scalars

#: A day number beyond every date.
FAR_DAY = 1 << 22


# ---- spines -------------------------------------------------------------------------------------------

def date_spine(spark: SparkSession, start: str, end: str, descending: bool = False) -> DataFrame:
    """Every date from start to end, both included."""
    days = F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)), F.expr("interval 1 day"))
    days = F.reverse(days) if descending else days
    return spark.range(1).select(F.posexplode(days).alias("pos", "date"))


def block_spine(dates: DataFrame, date: str = "date") -> DataFrame:
    """All 96 blocks of each distinct date (of each distinct row of ``dates``)."""
    return dates.distinct().withColumn("block_no", F.explode(F.sequence(F.lit(1), F.lit(blocks.BLOCKS_PER_DAY))))


def span_spine(df: DataFrame, keys: Sequence[str] = (), date: str = "date") -> DataFrame:
    """All blocks of all dates between the first and the last date of each key."""
    span = df.groupBy(*keys).agg(F.min(date).alias("_a"), F.max(date).alias("_b"))
    days = span.select(*keys, F.explode(F.sequence("_a", "_b")).alias(date))
    return days.withColumn("block_no", F.explode(F.sequence(F.lit(1), F.lit(blocks.BLOCKS_PER_DAY))))


def gap_fill(df: DataFrame, spine: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per spine row; missing observations are null."""
    return spine.join(df, list(keys), "left")


def block_calendar(spark: SparkSession) -> DataFrame:
    b = F.col("block_no")
    return spark.range(1, blocks.BLOCKS_PER_DAY + 1).select(F.col("id").cast("int").alias("block_no")).select(
        b,
        blocks.block_start(b).alias("start_time"),
        blocks.block_end(b).alias("end_time"),
        blocks.hour_of_block(b).alias("hour"),
    )


def horizon(df: DataFrame, keys: Sequence[str] = (), days: int = 7, value: str = "value") -> DataFrame:
    """The observed series plus the blocks to forecast, whose value is null.

    A day that has not reached block 96 is completed and followed by ``days`` more; a finished last day is
    followed by the next day and ``days`` more.
    """
    last = df.filter(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.max(F.struct("date", "block_no")).alias("_last")
    )
    done = F.col("_last.block_no") >= blocks.BLOCKS_PER_DAY
    first_day = F.when(done, F.date_add("_last.date", 1)).otherwise(F.col("_last.date"))
    first_block = F.when(done, 1).otherwise(F.col("_last.block_no") + 1)
    ahead = (
        last.select(*keys, first_day.alias("_day"), first_block.alias("_block"))
        .withColumn("date", F.explode(F.sequence(F.col("_day"), F.date_add("_day", days))))
        .withColumn("block_no", F.explode(F.sequence(F.lit(1), F.lit(blocks.BLOCKS_PER_DAY))))
        .filter((F.col("date") > F.col("_day")) | (F.col("block_no") >= F.col("_block")))
        .select(*keys, "date", "block_no", F.lit(None).cast("double").alias(value))
    )
    observed = df.filter(F.col(value).isNotNull()).select(*keys, "date", "block_no", value)
    return observed.unionByName(ahead)


# ---- projections and nulls ----------------------------------------------------------------------------

def unconstrained_load(load: DataFrame, cuts: DataFrame, keys: Sequence[str], value: str, cut: str) -> DataFrame:
    """Load that would have flowed without power cuts; no recorded cut counts as zero."""
    total = cuts.groupBy(*keys).agg(F.sum(cut).alias("powercut"))
    joined = load.join(total, list(keys), "left")
    cut_value = F.coalesce(F.col("powercut"), F.lit(0.0))
    return joined.withColumn("powercut", cut_value).withColumn("unconstrained", F.col(value) + cut_value)


def finite_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [scalars.finite(F.col(c)) for c in cols]))


def fill_const(df: DataFrame, values: dict[str, float | str | int]) -> DataFrame:
    return df.fillna(values)


def fill_from(df: DataFrame, col: str, other: str) -> DataFrame:
    return df.withColumn(col, F.coalesce(col, other))


def backfill_ranks(df: DataFrame, cols: Sequence[str], extra: str) -> DataFrame:
    """Each neighbour column takes the next one when it is null, down to the extra neighbour."""
    chain = [*cols, extra]
    filled = [F.coalesce(*chain[i:]).alias(c) for i, c in enumerate(cols)]
    rest = [c for c in df.columns if c not in cols]
    return df.select(*rest, *filled)


def cap_by_max(df: DataFrame, history: DataFrame, value: str, keys: Sequence[str] = ("block_no",)) -> DataFrame:
    """Values limited to the largest daily total seen in the same block."""
    top = max_of_sums(history, keys, ("date",), value, "max_value")
    return df.join(top, list(keys), "left").withColumn(
        "capped", F.when(F.col(value) > F.col("max_value"), F.col("max_value")).otherwise(F.col(value))
    )


def max_of_sums(df: DataFrame, keys: Sequence[str], inner: Sequence[str], value: str, out: str) -> DataFrame:
    """Sum per (keys, inner), then the maximum of those sums per key."""
    sums = df.groupBy(*keys, *inner).agg(F.sum(value).alias("_sum"))
    return sums.groupBy(*keys).agg(F.max("_sum").alias(out))


def nullify_tokens(df: DataFrame, tokens: Sequence[str], numeric: Sequence[str]) -> DataFrame:
    """Tokens to null in every text column, then the named columns to numbers where they parse."""
    out = []
    for field in df.schema.fields:
        col = F.col(field.name)
        if field.dataType.simpleString() == "string":
            col = scalars.nullify(col, tokens)
        if field.name in numeric:
            col = col.try_cast("double")
        out.append(col.alias(field.name))
    return df.select(*out)


def clean_records(df: DataFrame, cells: str, width: int) -> DataFrame:
    """Drop records whose cells are all blank, pad short ones with empty text."""
    arr = F.col(cells)
    return df.filter(F.exists(arr, lambda x: F.trim(x) != "")).withColumn(
        cells,
        F.concat(arr, F.array_repeat(F.lit(""), F.greatest(F.lit(0), F.lit(width) - F.size(arr)))),
    )


def one_hot(df: DataFrame, col: str, values: Sequence, prefix: str | None = None) -> DataFrame:
    prefix = prefix or col
    return df.select(
        "*",
        *[F.coalesce((F.col(col) == v).cast("int"), F.lit(0)).alias(f"{prefix}_{str(v).lower()}") for v in values],
    )


def tag(df: DataFrame, **literals) -> DataFrame:
    """Constant columns such as state, model or revision."""
    return df.select("*", *[F.lit(v).alias(k) for k, v in literals.items()])


def as_valid(df: DataFrame, date: Column, start: str, end: str, deleted: str) -> DataFrame:
    """Rows not soft-deleted whose validity covers the date."""
    return df.filter((F.col(deleted) == 0) & date.between(F.col(start), F.col(end)))


def round_cols(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Half-up rounding on write."""
    return df.select(*[F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in df.columns])


# ---- joins --------------------------------------------------------------------------------------------

def align(frames: dict[str, DataFrame], keys: Sequence[str], value: str) -> DataFrame:
    """Forecasts of several models beside each other, one column per model, in one shuffle."""
    stacked = reduce(
        lambda a, b: a.unionByName(b),
        [f.select(*keys, F.col(value).alias("_v"), F.lit(name).alias("_m")) for name, f in frames.items()],
    )
    return stacked.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_m") == name, F.col("_v"))).alias(name) for name in frames]
    )


def lookup(df: DataFrame, dim: DataFrame, key: str, order: Sequence, cols: Sequence[str]) -> DataFrame:
    """Left join to the first matching row of a dimension, never multiplying rows."""
    first = dim.groupBy(key).agg(F.min_by(F.struct(*cols), F.struct(*order)).alias("_d"))
    return df.join(first.select(key, "_d.*"), key, "left")


def in_force(facts: DataFrame, dim: DataFrame, keys: Sequence[str], date: str, start: str, end: str) -> DataFrame:
    """Dimension rows in force on each fact's date; a null end is open, a null start has always been.

    A validity range is laid out over spans of days that double in length (1, 2, 4, ...): it goes to the spans of
    the one length that it fits, two at most, so a long or open range makes no more copies than a short one.
    A fact asks one span of each length in use, hence an equi-join on key, length and span with the range as residual test.
    """
    first = F.coalesce(blocks.day_number(F.col(start)), F.lit(-FAR_DAY))
    last = F.coalesce(blocks.day_number(F.col(end)), F.lit(FAR_DAY))
    length = F.ceil(F.log2(F.greatest(last - first + 1, F.lit(1)))).cast("int")
    spans = F.array_distinct(F.array(*[F.floor(x / F.pow(F.lit(2.0), length)).cast("long") for x in (first, last)]))
    spread = dim.filter(first <= last).withColumn("_length", length).withColumn("_span", F.explode(spans))
    day = blocks.day_number(F.col(date))
    # Only lengths that some range has are asked for: a short list, taken first, so a fact is not copied to be dropped.
    lengths = spread.agg(F.sort_array(F.collect_set("_length"))).scalar()
    placed = facts.withColumn("_lengths", lengths).select("*", F.explode("_lengths").alias("_length")).drop("_lengths")
    placed = placed.withColumn("_span", F.floor(day / F.pow(F.lit(2.0), F.col("_length"))).cast("long"))
    joined = placed.join(spread, [*keys, "_length", "_span"])
    inside = (F.col(date) >= F.coalesce(F.col(start), F.col(date))) & (F.col(date) <= F.coalesce(F.col(end), F.col(date)))
    return joined.filter(inside).drop("_length", "_span")


def band_join(facts: DataFrame, bands: DataFrame, keys: Sequence[str], value: str, low: str, high: str, closed: str = "right") -> DataFrame:
    """Attach the band that holds the value: (low, high] for day-ahead, [low, high] (closed='both') for
    intraday. Rows outside every band keep null band columns."""
    f, b = facts.alias("f"), bands.alias("b")
    v = F.col(f"f.{value}")
    lower = v >= F.col(f"b.{low}") if closed == "both" else v > F.col(f"b.{low}")
    on = reduce(lambda x, y: x & y, [F.col(f"f.{k}") == F.col(f"b.{k}") for k in keys])
    extra = [F.col(f"b.{c}") for c in bands.columns if c not in keys]
    return f.join(b, on & lower & (v <= F.col(f"b.{high}")), "left").select("f.*", *extra)


def paired_difference(df: DataFrame, lag_map: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Columns of a date minus the same columns of its paired earlier date.

    ``lag_map`` holds (date, lag_date); ``keys`` are the other keys both sides share.
    """
    past = df.select(*keys, F.col("date").alias("lag_date"), *[F.col(c).alias(f"_past_{c}") for c in cols])
    return (
        df.join(lag_map, "date")
        .join(past, [*keys, "lag_date"], "left")
        .select(
            *keys, "date", "lag_date", *[(F.col(c) - F.col(f"_past_{c}")).alias(f"{c}_diff") for c in cols]
        )
    )


def new_keys(fresh: DataFrame, base: DataFrame, keys: Sequence[str]) -> DataFrame:
    return fresh.join(base, list(keys), "left_anti")


def keep_keys(df: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(wanted, list(keys), "left_semi")


# ---- sets ---------------------------------------------------------------------------------------------

def new_rows(new: DataFrame, old: DataFrame, keep_duplicates: bool = True) -> DataFrame:
    """Rows of ``new`` that do not occur in ``old``, compared over all columns, nulls equal to nulls."""
    if not keep_duplicates:
        return new.select(*old.columns).subtract(old)
    cols = old.columns
    row = F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
    seen = old.select(row.alias("_row")).distinct()
    return new.withColumn("_row", row).join(seen, "_row", "left_anti").drop("_row")


def common_keys(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    return a.select(*keys).intersect(b.select(*keys))


def stack(*frames: DataFrame) -> DataFrame:
    """Union by name; missing columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
