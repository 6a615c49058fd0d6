"""Similar-day and analogue-window search, neighbour curves and their blend.

Candidates meet on (entity, bucket of days): a bucket is as long as the lookback, each day is looked up in
its own bucket and the one before, so a row is shuffled twice at most and a task holds at most two buckets
of one entity (a bucket has at most ``lookback`` days). Feature vectors travel as arrays in a fixed order.
Curves stay arrays of 96 values until the last step: a day is one row in every shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattframe.functions.blocks import BLOCKS_PER_DAY, day_number
from wattframe.functions.scalars import point_at, ratio
from wattframe.operators import aggregates, repair
from wattframe.operators.latest import top_k
from wattframe.operators.past import nearest_in_past
from wattframe.operators.places import nearest_units  # noqa: F401  (a unit's neighbours belong to its similar days)

SMALLEST_BUCKET = 128
BLOCK_ROWS = 1024


def candidate_pairs(days: DataFrame, keys: Sequence[str], lookback: int, index: str = "_day", payload: Sequence[str] = (), pool: DataFrame | None = None) -> DataFrame:
    """Rows paired with the rows 1..lookback index steps earlier in the same key.

    ``index`` is an integer that grows with time (day number, window number). Payload columns come out as
    ``<col>`` and ``lag_<col>``. ``pool`` limits the earlier side (complete days only, for instance).
    """
    keys = list(keys)
    pool = days if pool is None else pool
    bucket = F.floor(F.col(index) / lookback)
    left = days.select(
        *keys, F.col(index), *payload, F.explode(F.array(bucket, bucket - 1)).alias("_bucket")
    )
    right = pool.select(
        *keys,
        F.col(index).alias(f"lag_{index}"),
        *[F.col(c).alias(f"lag_{c}") for c in payload],
        bucket.alias("_bucket"),
    )
    back = F.col(index) - F.col(f"lag_{index}")
    return left.join(right, [*keys, "_bucket"]).filter((back >= 1) & (back <= lookback)).drop("_bucket")


def as_double(name: str):
    return lambda x: x[name].cast("double")


def vectors(df: DataFrame, keys: Sequence[str], place: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Feature vector per key as one array ordered by the place columns, with the count of filled cells.

    Keep keys with all cells (or group by the count) before comparing: an absent cell leaves no hole.
    """
    cell = F.struct(*place, *cols)
    ordered = F.array_sort(F.collect_list(cell))
    out = df.groupBy(*keys).agg(ordered.alias("_c"))
    parts = [F.transform("_c", as_double(c)) for c in cols]
    vector = F.concat(*parts) if len(parts) > 1 else parts[0]
    return out.select(*keys, vector.alias("vector"), F.size("_c").alias("n_cells"))


def _measure(metric: str, a: np.ndarray, b: np.ndarray, partial: bool) -> np.ndarray:
    """Distances of every row of ``a`` to every row of ``b``.

    A missing cell on either side makes the distance missing; with ``partial`` the cells the asking row
    lacks do not count.
    """
    if metric == "cosine":
        size = np.linalg.norm(a, axis=1)[:, None] * np.linalg.norm(b, axis=1)[None, :]
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(size > 0, 1 - (a @ b.T) / size, np.nan)
    out = np.empty((len(a), len(b)))
    step = max(1, 2_000_000 // max(1, b.size))
    for i in range(0, len(a), step):
        square = (a[i : i + step, None, :] - b[None, :, :]) ** 2
        if partial:
            square = np.where(np.isnan(a[i : i + step, None, :]), 0.0, square)
        out[i : i + step] = square.sum(axis=2)
    return np.sqrt(out) if metric == "euclid" else out


def _search(fields: Sequence, index: str, metric: str, lookback: int | None, k: int, partial: bool):
    """Group function: the k nearest earlier rows of every asking row, by one numpy block per vector length."""
    names = [f.name for f in fields]
    columns = [*names, index, f"lag_{index}", "distance", "rank"]

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for _, same in pdf.groupby(pdf["_v"].map(len), sort=False):
            asking, offering = same[same["_asks"]], same[same["_offers"]]
            if asking.empty or offering.empty:
                continue
            a, b = np.array(asking["_v"].tolist(), dtype=float), np.array(offering["_v"].tolist(), dtype=float)
            ia, ib = asking["_i"].to_numpy(), offering["_i"].to_numpy()
            back = ia[:, None] - ib[None, :]
            near = back >= 1 if lookback is None else (back >= 1) & (back <= lookback)
            distance = np.where(near, _measure(metric, a.reshape(len(ia), -1), b.reshape(len(ib), -1), partial), np.nan)
            order = np.lexsort((np.broadcast_to(-ib, distance.shape), np.round(distance, 9)), axis=1)[:, :k]
            row = np.repeat(np.arange(len(ia)), order.shape[1])
            picked = order.ravel()
            found = pd.DataFrame({
                index: ia[row], f"lag_{index}": ib[picked], "distance": distance[row, picked],
                "rank": np.tile(np.arange(1, order.shape[1] + 1, dtype=np.int32), len(ia)),
            })
            parts.append(found[np.isfinite(found["distance"])])
        out = pd.concat(parts) if parts else pd.DataFrame({c: [] for c in columns[len(names):]})
        for name in names:
            out[name] = pdf[name].iloc[0]
        return out[columns]

    return search


def nearest_earlier(df: DataFrame, keys: Sequence[str], index: str, vector: str, metric: str, lookback: int | None, k: int, pool: Column | None = None, partial: bool = False, ask: Column | None = None) -> DataFrame:
    """The k nearest of the rows 1..lookback index steps earlier: (keys, index, lag_<index>, distance, rank).

    Each row asks in its own bucket of steps and offers itself there and, when its reach crosses the end,
    in the next one. A bucket is at least as long as the lookback, so everything a row may meet is in its
    group, a row is shuffled twice at most, and a group holds at most two buckets of one key. Distances of
    a group are one numpy block; only the k best leave it, so pairs are never rows. Vectors of different
    length do not compare. Equal distances rank the later row first. ``pool`` limits the rows that may be
    found, ``ask`` those that search.

    ``lookback`` None searches the whole past: every bucket meets every earlier one in a group of its own,
    so the work of a long key is spread evenly, and the best of the groups are ranked again.
    """
    keys = list(keys)
    width = BLOCK_ROWS if lookback is None else max(lookback, SMALLEST_BUCKET)
    bucket = F.floor(F.col(index) / width)
    offers = F.when(F.lit(True) if pool is None else pool, F.lit(True)).otherwise(False)
    wants = F.when(F.lit(True) if ask is None else ask, F.lit(True)).otherwise(False)
    base = df.select(
        *keys, F.col(index).cast("long").alias("_i"), F.transform(vector, lambda x: x.cast("double")).alias("_v"),
        offers.alias("_offers"), wants.alias("_wants"), bucket.alias("_b"),
    )
    role = lambda mine, other, asks, gives: F.struct(mine.alias("b"), other.alias("c"), (F.col("_wants") & asks).alias("asks"), gives.alias("gives"))
    own = F.col("_b")
    if lookback is None:
        span = base.groupBy(*keys).agg(F.min("_b").alias("_first"), F.max("_b").alias("_last"))
        base = base.join(span, keys) if keys else base.withColumns(
            {"_first": span.select("_first").scalar(), "_last": span.select("_last").scalar()}
        )
        earlier = F.transform(F.sequence("_first", own), lambda c: role(own, c, True, F.col("_offers") & (c == own)))
        later = F.when(own < F.col("_last"), F.sequence(own + 1, F.col("_last"))).otherwise(F.array().cast("array<bigint>"))
        roles = F.concat(earlier, F.transform(later, lambda b: role(b, own, False, F.col("_offers"))))
    else:
        mine = role(own, own, True, F.col("_offers"))
        following = role(own + 1, own + 1, False, F.col("_offers"))
        crosses = F.col("_i") + lookback >= (own + 1) * width
        roles = F.when(crosses, F.array(mine, following)).otherwise(F.array(mine))
    dealt = base.select(*keys, "_i", "_v", F.explode(roles).alias("_role")).select(
        *keys, "_i", "_v", F.col("_role.b").alias("_b"), F.col("_role.c").alias("_c"),
        F.col("_role.asks").alias("_asks"), F.col("_role.gives").alias("_offers"),
    ).filter("_asks OR _offers")
    fields = [f for f in dealt.schema.fields if f.name in keys]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), f"`{index}` long, `lag_{index}` long, distance double, rank int"])
    found = dealt.groupBy(*keys, "_b", "_c").applyInPandas(_search(fields, index, metric, lookback, k, partial), schema)
    if lookback is None:
        return top_k(found.drop("rank"), [*keys, index], [F.round("distance", 9), F.desc(f"lag_{index}")], k)
    return found


def similar_days(
    profile: DataFrame,
    keys: Sequence[str],
    vector: str,
    metric: str,
    lookback: int,
    k: int,
    pool: Column | None = None,
    date: str = "date",
    partial: bool = False,
    ask: Column | None = None,
) -> DataFrame:
    """The k nearest earlier days per day: (keys, date, lag_date, distance, rank).

    ``profile`` holds one row per key and date. ``pool`` limits the days that may be found (complete days,
    for instance), ``ask`` the days that search; with ``partial`` a day still under way is compared on the cells it has.
    """
    indexed = profile.withColumn("_day", day_number(F.col(date)))
    found = nearest_earlier(indexed, keys, "_day", vector, metric, lookback, k, pool, partial, ask)
    back = lambda c: F.date_from_unix_date(F.col(c).cast("int"))
    return found.select(*keys, back("_day").alias(date), back("lag__day").alias("lag_date"), "distance", "rank")


def similar_windows(features: DataFrame, keys: Sequence[str], window: str, vector: str, metric: str, k: int, lookback: int | None = None) -> DataFrame:
    """The k nearest earlier windows (groups of blocks) per window, over the whole past by default."""
    if lookback is None:
        return nearest_in_past(features, keys, window, vector, metric, k)
    return nearest_earlier(features, keys, window, vector, metric, lookback, k)


def window_numbers(df: DataFrame, width: int = 4, date: str = "date", block: str = "block_no") -> DataFrame:
    """Consecutive window number over the calendar and the block's place in its window."""
    per_day = BLOCKS_PER_DAY // width
    return df.withColumn(
        "window_no",
        (day_number(F.col(date)) * per_day + F.floor((F.col(block) - 1) / width) + 1).cast("long"),
    ).withColumn("window_pos", ((F.col(block) - 1) % width + 1).cast("int"))


def neighbour_curves(nn: DataFrame, series: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Neighbours' curves in long form: (keys, date, block_no, rank, lag_date, value)."""
    past = series.select(*keys, F.col("date").alias("lag_date"), "block_no", value)
    return nn.select(*keys, "date", "lag_date", "rank").join(past, [*keys, "lag_date"])


def neighbour_columns(nn: DataFrame, curves_df: DataFrame, keys: Sequence[str], k: int, prefix: str = "nn") -> DataFrame:
    """Neighbours' curves as columns nn1..nnk per block.

    Curves travel as day arrays, one per neighbour, and become rows at the end; blocks no neighbour has
    are left out.
    """
    past = curves_df.select(*keys, F.col("date").alias("lag_date"), F.col("curve").alias("_c"))
    met = nn.filter(F.col("rank") <= k).join(past, [*keys, "lag_date"])
    names = [f"{prefix}{r}" for r in range(1, k + 1)]
    wide = met.groupBy(*keys, "date").agg(
        *[F.first(F.when(F.col("rank") == r, F.col("_c")), ignorenulls=True).alias(n) for r, n in enumerate(names, 1)]
    )
    empty = F.array_repeat(F.lit(None).cast("double"), BLOCKS_PER_DAY)
    blocks = F.sequence(F.lit(1), F.lit(BLOCKS_PER_DAY)).alias("block_no")
    zipped = F.arrays_zip(blocks, *[F.coalesce(n, empty).alias(n) for n in names])
    return wide.select(*keys, "date", F.inline(zipped)).filter(F.coalesce(*names).isNotNull())


def blend(curves_long: DataFrame, keys: Sequence[str], value: str, k: int, t: float, out: str = "blend") -> DataFrame:
    """Geometric blend: sum t^(r-1) x_r / sum t^(r-1) over ranks 1..k; a missing rank makes it null."""
    ranked = curves_long.filter(F.col("rank") <= k)
    weight = F.pow(F.lit(float(t)), F.col("rank") - 1)
    mixed = F.sum(weight * F.col(value)) / F.sum(F.when(F.col(value).isNotNull(), weight))
    return ranked.groupBy(*keys, "date", "block_no").agg(F.when(F.count(value) == k, mixed).alias(out))


def blend_lags(df: DataFrame, cols: Sequence[str], t: float) -> Column:
    """Geometric blend over lag columns of one row."""
    weights = [t**i for i in range(len(cols))]
    return sum((F.col(c) * w for c, w in zip(cols[1:], weights[1:])), F.col(cols[0])) / sum(weights)


def day_curves(df: DataFrame, keys: Sequence[str], value: str, fill: float | None = None, out: str = "curve") -> DataFrame:
    """One row per key and date with the 96 values in block order; gaps hold ``fill``."""
    cells = F.map_from_entries(F.collect_list(F.struct("block_no", F.col(value).cast("double"))))
    slots = F.sequence(F.lit(1), F.lit(BLOCKS_PER_DAY))
    days = df.groupBy(*keys, "date").agg(cells.alias("_m"))
    return days.select(
        *keys, "date", F.transform(slots, lambda b: F.coalesce(F.try_element_at("_m", b), F.lit(fill).cast("double"))).alias(out)
    )


def blended_curves(nn: DataFrame, curves_df: DataFrame, keys: Sequence[str], k: int, t: float, out: str = "blend") -> DataFrame:
    """Geometric blend of whole day curves: one array per key and date.

    ``nn`` may hold more ranks than k: where a neighbour day has no reading, the block takes the next rank that has
    one. A block for which one of the k neighbours stays without a reading is null, as are all blocks of a day
    with fewer than k neighbours. Two arrays of a day's length are folded per day.
    """
    past = curves_df.select(*keys, F.col("date").alias("lag_date"), F.col("curve").alias("_c"))
    met = nn.join(past, [*keys, "lag_date"])
    gathered = met.groupBy(*keys, "date").agg(F.sort_array(F.collect_list(F.struct("rank", "_c")), asc=False).alias("_n"))
    length = F.size(F.col("_n")[0]["_c"])
    start = F.struct(
        F.array_repeat(F.lit(None).cast("double"), length).alias("next"), F.array_repeat(F.lit(0.0), length).alias("total"), F.lit(0).alias("met")
    )

    def fold(acc: Column, one: Column) -> Column:
        filled = F.zip_with(one["_c"], acc["next"], lambda x, y: F.coalesce(x.cast("double"), y))
        weight = F.pow(F.lit(float(t)), one["rank"] - 1)
        added = F.zip_with(acc["total"], filled, lambda x, y: x + y * weight)
        counts = one["rank"] <= k
        return F.struct(filled.alias("next"), F.when(counts, added).otherwise(acc["total"]).alias("total"), (acc["met"] + counts.cast("int")).alias("met"))

    total = sum(t**i for i in range(k))
    whole = F.aggregate("_n", start, fold, lambda acc: F.transform(acc["total"], lambda x: F.when(acc["met"] == k, x / total)))
    return gathered.select(*keys, "date", whole.alias(out))


def impute_from_similar(grid: DataFrame, keys: Sequence[str], value: str, lookback: int = 31, least: int = BLOCKS_PER_DAY, out: str = "imputed") -> DataFrame:
    """Unfinished days filled from the nearest finished day: every row of ``grid`` with ``out`` and ``lag_date``.

    ``grid`` holds the 96 blocks of each key and date, null where nothing was read. A day is finished with ``least``
    readings or more, among them one in every hour; days with a hole search the finished days of the ``lookback`` days
    before by Euclid on hourly maxima, over the hours they have themselves (a day without any takes the last finished
    one). A hole follows the neighbour's shape from the day's last reading before it; holes that open the day, or come
    after readings that are not positive only, take the neighbour's values. Where the neighbour has a hole too, or
    no day is found, the value stays null. A day is one row until its blocks are carried.
    """
    keys = list(keys)
    hours = aggregates.hourly_max(grid, keys, value)
    seen = grid.groupBy(*keys, "date").agg(F.count(value).alias("_read"))
    profile = vectors(hours, [*keys, "date"], ["hour"], [f"{value}_max"]).filter(F.col("n_cells") == 24)
    profile = profile.join(seen, [profile[k].eqNullSafe(seen[k]) for k in [*keys, "date"]]).select(*[profile[k] for k in [*keys, "date"]], "vector", "_read")
    finished = (F.col("_read") >= least) & ~F.exists("vector", lambda x: x.isNull())
    found = similar_days(profile, keys, "vector", "euclid", lookback, 1, pool=finished, partial=True, ask=F.col("_read") < BLOCKS_PER_DAY)
    past = day_curves(grid, keys, value, out="_past")
    on = [found[k].eqNullSafe(past[k]) for k in keys] + [found["lag_date"] == past["date"]]
    reference = found.join(past, on).select(*[found[k].alias(f"_k{i}") for i, k in enumerate(keys)], found["date"].alias("_date"), found["lag_date"], "_past")
    on = [F.col(f"_k{i}").eqNullSafe(grid[k]) for i, k in enumerate(keys)] + [F.col("_date") == grid["date"]]
    beside = grid.join(reference, on, "left").select(*grid.columns, "lag_date", F.try_element_at("_past", F.col("block_no").cast("int")).alias("_ref"))
    carried = repair.ratio_carry(beside, [*keys, "date"], ["block_no"], value, "_ref", "_carried")
    return carried.select(*grid.columns, "lag_date", F.coalesce(F.col(value), "_carried", "_ref").alias(out))


def weather_delta(weather: DataFrame, nn: DataFrame, keys: Sequence[str], slot: Sequence[str], value: str, k: int, t: float) -> DataFrame:
    """Today's reading minus the blended reading of the similar days, per place and slot."""
    past = weather.select(*keys, F.col("date").alias("lag_date"), *slot, F.col(value).alias("_p"))
    join_keys = [c for c in keys if c in nn.columns]
    long = nn.filter(F.col("rank") <= k).select(*join_keys, "date", "lag_date", "rank").join(past, [*join_keys, "lag_date"])
    weight = F.pow(F.lit(float(t)), F.col("rank") - 1)
    blended = long.groupBy(*keys, "date", *slot).agg(
        F.when(F.count("_p") == k, F.sum(weight * F.col("_p")) / F.sum(weight)).alias("blended")
    )
    return weather.join(blended, [*keys, "date", *slot]).withColumn("delta", F.col(value) - F.col("blended"))


# ---- places -------------------------------------------------------------------------------------------

def neighbour_value(df: DataFrame, nn: DataFrame, key: str, slot: Sequence[str], value: str, out: str) -> DataFrame:
    """The nearest unit's reading of the same time beside each unit's own."""
    other = df.select(F.col(key).alias("neighbour"), *slot, F.col(value).alias(out))
    first = nn.filter("nn_rank = 1").select(key, "neighbour")
    return df.join(first, key).join(other, ["neighbour", *slot])


def geo_ring(seeds: DataFrame, lat: str, lon: str, max_km: float, step_km: float, bearings: int = 8) -> DataFrame:
    """Distinct points on rings around each seed, every ``step_km`` up to ``max_km``."""
    rings = F.sequence(F.lit(1), F.lit(int(max_km // step_km)))
    turns = F.sequence(F.lit(0), F.lit(bearings - 1))
    spread = seeds.select(lat, lon).withColumn("_r", F.explode(rings)).withColumn("_t", F.explode(turns))
    point = point_at(F.col(lat), F.col(lon), F.col("_r") * F.lit(float(step_km)), F.col("_t") * F.lit(360.0 / bearings))
    return spread.select(F.round(point["lat"], 6).alias("lat"), F.round(point["lon"], 6).alias("lon")).distinct()


# ---- capacity -----------------------------------------------------------------------------------------

def available_capacity(gen: DataFrame, nn: DataFrame, key: str, slot: Sequence[str], generation: str, capacity: str) -> DataFrame:
    """Capacity really available at a unit: where the neighbour runs at a higher share of its capacity,
    own generation at the neighbour's share; else the rated capacity."""
    floor0 = lambda c: F.greatest(F.col(c), F.lit(0.0))
    other = gen.select(
        F.col(key).alias("neighbour"), *slot, floor0(generation).alias("_ng"), F.col(capacity).alias("_nc")
    )
    first = nn.filter("nn_rank = 1").select(key, "neighbour")
    paired = gen.join(first, key).join(other, ["neighbour", *slot]).withColumn("_g", floor0(generation))
    own, near = ratio(F.col("_g"), F.col(capacity)), ratio(F.col("_ng"), F.col("_nc"))
    available = F.when(near > own, F.col("_g") / F.nullif(near, F.lit(0.0))).otherwise(F.col(capacity))
    return paired.withColumn("available", available).select(key, *slot, F.col("_g").alias("generation_used"), "available")


def normalise_by_capacity(available: DataFrame, date: str = "date", block: str = "block_no") -> DataFrame:
    """Generation over available capacity per block, with the day's mean capacity."""
    total = available.groupBy(date, block).agg(
        F.sum("available").alias("capacity"), (F.sum("generation_used") * 4).alias("gen_mw")
    )
    daily = F.avg("capacity").over(Window.partitionBy(date))
    return total.withColumn("capacity_day_mean", daily).withColumn("per_gen", ratio(F.col("gen_mw"), F.col("capacity")))


def denormalise(forecast: DataFrame, capacity: DataFrame, value: str, date: str = "date") -> DataFrame:
    """Per-capacity forecast times the mean capacity of the last earlier day that has one."""
    daily = capacity.groupBy(date).agg(F.avg("capacity").alias("_cap"))
    days = forecast.select(date).distinct().join(daily, date, "full")
    spec = Window.orderBy(date).rowsBetween(Window.unboundedPreceding, -1)
    known = days.withColumn("capacity_used", F.last("_cap", ignorenulls=True).over(spec)).drop("_cap")
    return forecast.join(known, date, "left").withColumn("forecast_mw", F.col(value) * F.col("capacity_used"))


def solar_per_unit(gen: DataFrame, units: DataFrame, key: str, daylight: DataFrame) -> DataFrame:
    """Generation in MW over the day's mean rated capacity, zero outside daylight.

    Readings are summed per unit before the capacity join.
    """
    joined = gen.groupBy(key, "date", "block_no").agg(F.sum("generation").alias("_g")).join(units, key)
    total = joined.groupBy("date", "block_no").agg(
        (F.sum("_g") * 4).alias("gen_mw"), F.sum("rated_capacity").alias("capacity")
    )
    daily = F.avg("capacity").over(Window.partitionBy("date"))
    return (
        total.withColumn("capacity_day", daily)
        .join(daylight.select("date", "block_no", "daylight"), ["date", "block_no"], "left")
        .withColumn("per_gen", ratio(F.col("gen_mw"), F.col("capacity_day")) * F.col("daylight"))
        .drop("capacity")
    )


def impute_by_analogue(df: DataFrame, blended: DataFrame, keys: Sequence[str], value: str, analogue: str, out: str) -> DataFrame:
    """The larger of the observation and the analogue; either alone when the other is missing."""
    return df.join(blended, list(keys), "left").withColumn(out, F.greatest(value, analogue))
