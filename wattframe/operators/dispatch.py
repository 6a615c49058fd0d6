"""Unit limits, surrender, merit order, positions and bids.

Merit-order sums run per (date, block). The cost order is cut into value pieces with carried sums, so a
block may hold any number of rows; ``split=False`` uses one plain window per block, which is cheaper where
a block holds a few thousand units.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattframe.functions.blocks import MINUTES_PER_BLOCK
from wattframe.functions.scalars import ratio
from wattframe.operators import splits, windows
from wattframe.operators.latest import latest_revision, max_revision


def ramp_profile(bands: DataFrame, unit: str, low: str, high: str, rate: str) -> DataFrame:
    """Minutes to climb each capacity band and all bands up to it, and the blocks that takes."""
    minutes = ratio(F.col(high) - F.col(low), F.col(rate))
    timed = bands.withColumn("band_minutes", minutes)
    cumulative = F.sum("band_minutes").over(splits.upto([unit], [low]))
    return (
        timed.withColumn("total_minutes", cumulative)
        .withColumn("band_blocks", F.ceil(F.col("band_minutes") / MINUTES_PER_BLOCK))
        .withColumn("total_blocks", F.ceil(F.col("total_minutes") / MINUTES_PER_BLOCK))
    )


def unit_limits(df: DataFrame, schedule: str, surrender_share: str) -> DataFrame:
    """Limits of a unit in a block, with fallbacks where no band was found.

    Reads cap_low_limit, cap_upper_limit, ramp_up_mw_min, ramp_down_mw_min; negative results become 0.
    """
    s, share = F.col(schedule), F.col(surrender_share)
    floor0 = lambda c: F.greatest(c, F.lit(0.0))
    return df.select(
        *[c for c in df.columns if c not in ("cap_low_limit", "cap_upper_limit", "ramp_up_mw_min", "ramp_down_mw_min")],
        floor0(F.coalesce("cap_low_limit", s - s * share)).alias("low_limit"),
        floor0(F.coalesce("cap_upper_limit", s)).alias("high_limit"),
        floor0(F.coalesce(F.col("ramp_up_mw_min") * MINUTES_PER_BLOCK, s)).alias("ramp_up"),
        floor0(F.coalesce(F.col("ramp_down_mw_min") * MINUTES_PER_BLOCK, s * share)).alias("ramp_down"),
    )


def surrender_flag(df: DataFrame, cost: str, upper_price: str, transaction_cost: float, out: str = "surrender") -> DataFrame:
    """1 where power costs at least the upper market price plus the transaction cost."""
    return df.withColumn(
        out, F.coalesce(F.col(cost) >= F.col(upper_price) + transaction_cost, F.lit(False)).cast("int")
    )


def _cumulative(df: DataFrame, keys: Sequence[str], cost: str, unit: str, value: str, descending: bool, split: bool, out: str) -> DataFrame:
    """Running sum of a value in cost order, ties by unit; a null cost comes first, or last if descending."""
    if not split:
        order = [F.desc_nulls_last(cost) if descending else F.asc_nulls_first(cost), F.col(unit)]
        return df.withColumn(out, F.sum(value).over(splits.upto(keys, order)))
    later = F.col(cost).isNull() if descending else F.col(cost).isNotNull()
    ordered = df.withColumn("_later", later).withColumn("_c", -F.col(cost) if descending else F.col(cost))
    placed = splits.with_value_pieces(ordered, "_c")
    return splits.carried_sum(placed, keys, ["_later", "_c", unit], ["_later", "_piece"], value, out).drop("_piece", "_c", "_later")


def merit_order_cap(
    df: DataFrame,
    keys: Sequence[str],
    cost: str,
    unit: str,
    volume: str,
    limit: float,
    eligible: str | None = None,
    eligible_only: bool = False,
    split: bool = True,
    out: str = "taken",
) -> DataFrame:
    """Costliest first, take volume until the limit; the marginal row takes the remainder.

    ``eligible`` zeroes what ineligible rows would take. By default they still use up the limit;
    ``eligible_only`` leaves the limit to eligible rows.
    """
    usable = F.col(volume)
    if eligible and eligible_only:
        usable = F.when(F.col(eligible) == 1, usable).otherwise(0.0)
    rows = df.withColumn("_v", usable)
    summed = _cumulative(rows, keys, cost, unit, "_v", True, split, "_cum")
    taken = F.greatest(F.lit(0.0), F.least(F.col("_v"), F.lit(float(limit)) - (F.col("_cum") - F.col("_v"))))
    if eligible:
        taken = taken * F.col(eligible)
    return summed.withColumn(out, taken).drop("_v", "_cum")


def dispatch(df: DataFrame, need: DataFrame, keys: Sequence[str], direction: str, unit: str, out: str, split: bool = True) -> DataFrame:
    """Ramp units to meet a need, cheapest first up or costliest first down, in one pass.

    ``df`` holds unit, cost, schedule, low_limit, high_limit, ramp_up, ramp_down; ``need`` one row per key
    with column ``need``. Each unit offers its ramp within its headroom, never below zero.
    """
    up = direction == "up"
    head = F.col("high_limit") - F.col("schedule") if up else F.col("schedule") - F.col("low_limit")
    offer = F.greatest(F.lit(0.0), F.least(F.col("ramp_up" if up else "ramp_down"), head))
    offered = df.join(need.filter("need > 0"), list(keys)).withColumn("_offer", offer)
    summed = _cumulative(offered, keys, "cost", unit, "_offer", not up, split, "_cum")
    left = F.col("need") - (F.col("_cum") - F.col("_offer"))
    return summed.withColumn(out, F.greatest(F.lit(0.0), F.least(F.col("_offer"), left))).drop("_offer", "_cum", "need")


def split_sign(df: DataFrame, col: str) -> DataFrame:
    """A signed position as surplus and deficit."""
    q = F.col(col)
    return df.withColumn("surplus", F.when(q.isNotNull(), F.greatest(q, F.lit(0.0)))).withColumn(
        "deficit", F.when(q.isNotNull(), F.greatest(-q, F.lit(0.0)))
    )


def net_dispatch(schedule: DataFrame, up: DataFrame, down: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Schedule after ramping, with the net change of each unit."""
    joined = schedule.join(up.select(*keys, "ramp_up_mw"), list(keys), "left").join(
        down.select(*keys, "ramp_down_mw"), list(keys), "left"
    )
    net = F.coalesce("ramp_up_mw", F.lit(0.0)) - F.coalesce("ramp_down_mw", F.lit(0.0))
    return joined.withColumn("net_change", net).withColumn("revised_schedule", F.col("schedule") + net)


def compose_capacity(internal: DataFrame, imports: DataFrame, unit: str, cols: Sequence[str]) -> DataFrame:
    """Newest internal capacity, then newest imports of units that are not internal; positive rows only."""
    own = max_revision(internal).filter(F.col(unit).isNotNull()).select(*cols)
    foreign = max_revision(imports).filter(F.col(unit).isNotNull()).select(*cols)
    shadowed = foreign.join(own.select(unit).distinct(), unit, "left_anti").select(*cols)
    return own.withColumn("origin", F.lit("INTERNAL")).unionByName(
        shadowed.withColumn("origin", F.lit("IMPORT"))
    ).filter(F.col("allocated") > 0)


def revision_compare(schedules: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """First revision (0) beside the newest one, and their difference, in one aggregate."""
    newest = F.max_by(value, "revision")
    first = F.max(F.when(F.col("revision") == 0, F.col(value)))
    return schedules.groupBy(*keys).agg(
        first.alias("day_ahead"), newest.alias("latest"), F.max("revision").alias("latest_revision")
    ).withColumn("change", F.col("latest") - F.coalesce("day_ahead", F.lit(0.0)))


def model_risk(df: DataFrame, keys: Sequence[str], residual: str, forecast: str, z: float, lag: int = 2, n: int = 15, out: str = "model_risk") -> DataFrame:
    """z times the deviation of the last n residuals as known ``lag`` days ago, carried forward, never
    above the forecast."""
    order = ["date"]
    lagged = windows.lags(df, keys, order, residual, [lag])
    spread = windows.rolling(lagged, keys, order, f"{residual}_lag{lag}", n, {"_std": "std"})
    known = windows.ffill(spread, keys, order, "_std")
    return known.withColumn(out, F.least(F.col("_std") * z, F.col(forecast))).drop("_std", f"{residual}_lag{lag}")


def position_gap(demand: DataFrame, schedule: DataFrame, renewables: DataFrame, wind_risk: DataFrame, keys: Sequence[str]) -> DataFrame:
    """demand + bias + wind risk + load risk - schedule - renewables; a missing part makes the gap null."""
    joined = demand.join(schedule, list(keys), "left").join(renewables, list(keys), "left").join(wind_risk, list(keys), "left")
    return joined.withColumn(
        "position_gap",
        F.col("demand_forecast") + F.col("demand_bias") + F.col("wind_risk") + F.col("load_risk")
        - F.col("schedule") - F.col("renewables"),
    )


def bid_ladder(gap: DataFrame, band: DataFrame, keys: Sequence[str], ladder: int, step: float, price_floor: float = 0.75) -> DataFrame:
    """Split each gap into equal bids over the price ladder.

    A gap to fill buys at the upper price, a surplus sells at the lower one, not below the floor. Volumes
    are rounded up to the step before the sign is dropped.
    """
    joined = band.join(gap, list(keys))
    volume = F.col("position_gap") / ladder
    buy = volume >= 0
    price = F.round(F.when(buy, F.col("ul_price")).otherwise(F.col("ll_price")), 3)
    return joined.select(
        *keys,
        "ladder",
        F.round("alpha", 3).alias("alpha"),
        F.when(buy, "BUY").otherwise("SELL").alias("buy_sell"),
        F.abs(F.round(volume, 3)).alias("ladder_volume"),
        F.when(~buy & (price < price_floor), price_floor).otherwise(price).alias("bid_price"),
        F.abs(F.round(F.ceil(volume / step) * step, 3)).alias("bid_volume"),
    )


def unit_cost(contracts: DataFrame, costs: DataFrame, date: str, cost_types: Sequence[str]) -> DataFrame:
    """Costs in force on a date, one column per cost type, beside their contract."""
    day = F.to_date(F.lit(date))
    valid = costs.filter((F.col("delete_ind") == 0) & (F.col("valid_from") <= day) & (F.col("valid_to") >= day))
    wide = valid.groupBy("contract").agg(
        *[F.max(F.when(F.col("cost_type") == t, F.col("cost"))).alias(t.lower()) for t in cost_types]
    )
    return contracts.join(wide, "contract")


def forecast_report(actual: DataFrame, forecast: DataFrame, keys: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """Newest forecast revision beside the actual, with the percentage error."""
    newest = latest_revision(forecast, ["date", *extra])
    joined = actual.join(newest, list(keys))
    return joined.withColumn("error", F.col("actual") - F.col("forecast")).withColumn(
        "ape", F.abs(ratio(F.col("error"), F.col("actual")))
    )


def schedule_from_actual(spine: DataFrame, positions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Carry each pool's last actual (bias applied) forward over the blocks of the spine."""
    from wattframe.functions.scalars import apply_bias

    newest = latest_revision(positions, [*keys, "date", "block_no"])
    valued = newest.withColumn("known", apply_bias(F.col("quantum"), F.col("bias"))).select(*keys, "date", "block_no", "known")
    joined = spine.join(valued, [*keys, "date", "block_no"], "left")
    return windows.ffill(joined, [*keys, "date"], ["block_no"], "known", "schedule")


