"""Ordered work on groups too large for one task.

A plain window puts a whole key into one task. The functions here cut a key into ordered pieces first,
summarise each piece, run the window over the summaries (one row per piece), and hand every piece the
carry it needs. Results equal the plain window; no row is dropped and no piece boundary shows.

Two ways to cut:

* by a column that grows with the order (a date, a block start) for rows ordered in time;
* by value for rows ordered by a number: by fine steps of magnitude, so neither outliers nor heavy tails
  pile up in one piece. Where only ranks are wanted, equal values are counted together first, so copies of
  one value do not either. The cut is a function of the value alone: it needs no pass over the data, and
  a recomputed task sees the same pieces.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattframe.session import cut_lineage

PIECES_PER_DOUBLING = 16_384
SMALLEST_EXPONENT = 1_100


def before(keys: Sequence[str], order: Sequence[str]):
    """Window over everything strictly before the row."""
    return (
        Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )


def upto(keys: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def after(keys: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(1, Window.unboundedFollowing)


def onwards(keys: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(0, Window.unboundedFollowing)


def join_carry(df: DataFrame, carry: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``on`` in which null equals null; the columns ``on`` stay those of ``df``."""
    other = carry.select(*[F.col(c).alias(f"_on{i}") for i, c in enumerate(on)], *[c for c in carry.columns if c not in on])
    same = [F.col(c).eqNullSafe(F.col(f"_on{i}")) for i, c in enumerate(on)]
    return df.join(other, same, how).drop(*[f"_on{i}" for i in range(len(on))])


def with_position(df: DataFrame, keys: Sequence[str], order: Sequence[str], split: str, out: str = "_pos") -> DataFrame:
    """1-based position of each row in its key, computed piecewise."""
    keys = list(keys)
    pieces = df.groupBy(*keys, split).agg(F.count(F.lit(1)).alias("_n"))
    offsets = pieces.withColumn(
        "_off", F.coalesce(F.sum("_n").over(before(keys, [split])), F.lit(0))
    ).drop("_n")
    inside = F.row_number().over(Window.partitionBy(*keys, split).orderBy(*order))
    return (
        join_carry(df.withColumn("_rn", inside), offsets, [*keys, split])
        .withColumn(out, F.col("_rn") + F.col("_off"))
        .drop("_rn", "_off")
    )


def framed(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    split: str,
    preceding: int,
    following: int,
    exprs: dict,
    size: int = 10_000,
) -> DataFrame:
    """Window expressions whose frames reach a fixed number of rows, over pieces of ``size`` rows.

    ``exprs`` maps output names to functions of an ordered, partitioned ``WindowSpec``. Each row is copied
    into the neighbouring piece only where that piece's frames reach it.
    """
    placed = with_position(df, keys, order, split)
    return framed_at(placed, keys, preceding, following, exprs, size).drop("_pos")


def framed_at(placed: DataFrame, keys: Sequence[str], preceding: int, following: int, exprs: dict, size: int = 10_000) -> DataFrame:
    """As ``framed`` for rows whose position in their key, ``_pos`` from 1 on, is known; it stays."""
    keys = list(keys)
    size = max(size, preceding + following, 1)
    zero = F.col("_pos") - 1
    pieces = F.sequence(
        F.greatest(F.lit(0), F.floor((zero - following) / size)).cast("long"),
        F.floor((zero + preceding) / size).cast("long"),
    )
    spread = placed.withColumn("_piece", F.explode(pieces))
    spec = Window.partitionBy(*keys, "_piece").orderBy("_pos")
    return (
        spread.select("*", *[fn(spec).alias(name) for name, fn in exprs.items()])
        .filter(F.col("_piece") == F.floor(zero / size))
        .drop("_piece")
    )


def carried_last(df: DataFrame, keys: Sequence[str], order: Sequence[str], split: str, col: str, out: str, backwards: bool = False) -> DataFrame:
    """Last non-null value up to the row, carried across pieces; ``backwards`` gives the next one from the
    row on."""
    keys = list(keys)
    rank = F.struct(*[F.col(c) for c in order])
    pick = F.min_by if backwards else F.max_by
    closing = df.filter(F.col(col).isNotNull()).groupBy(*keys, split).agg(pick(col, rank).alias("_close"))
    pieces = join_carry(df.select(*keys, split).distinct(), closing, [*keys, split], "left")
    if backwards:
        inside = F.first(col, ignorenulls=True).over(onwards([*keys, split], order))
        outside = F.first("_close", ignorenulls=True).over(after(keys, [split]))
    else:
        inside = F.last(col, ignorenulls=True).over(upto([*keys, split], order))
        outside = F.last("_close", ignorenulls=True).over(before(keys, [split]))
    carry = pieces.withColumn("_carry", outside).drop("_close")
    return (
        join_carry(df.withColumn("_inside", inside), carry, [*keys, split])
        .withColumn(out, F.coalesce("_inside", "_carry"))
        .drop("_inside", "_carry")
    )


def carried_sum(df: DataFrame, keys: Sequence[str], order: Sequence, split: str | Sequence[str], col: str, out: str) -> DataFrame:
    """Running sum in order, carried across pieces. ``split`` columns must grow with the order."""
    keys = list(keys)
    split = [split] if isinstance(split, str) else list(split)
    totals = df.groupBy(*keys, *split).agg(F.sum(col).alias("_total"))
    carry = totals.withColumn(
        "_carry", F.coalesce(F.sum("_total").over(before(keys, split)), F.lit(0))
    ).drop("_total")
    inside = F.sum(col).over(upto([*keys, *split], order))
    return (
        join_carry(df.withColumn("_inside", inside), carry, [*keys, *split])
        .withColumn(out, F.coalesce("_inside", F.lit(0)) + F.col("_carry"))
        .drop("_inside", "_carry")
    )


def piece_of(value: Column) -> Column:
    """Integer that never falls as the value grows; a step is 0.004 percent of the value. Null stays null, and a
    null piece sorts where a null value does."""
    scaled = F.floor((F.log2(F.abs(value)) + SMALLEST_EXPONENT) * PIECES_PER_DOUBLING).cast("long")
    return F.when(value > 0, scaled).when(value < 0, -scaled).when(value.isNotNull(), F.lit(0).cast("long"))


def with_value_pieces(df: DataFrame, value: str, out: str = "_piece") -> DataFrame:
    return df.withColumn(out, piece_of(F.col(value)))


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))


def value_ranks(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One row per key and distinct value: how many rows carry it and how many lie below it."""
    return _ranked(value_counts(df, keys, value), keys, value)


def _ranked(counts: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    ranked = carried_sum(with_value_pieces(counts, value), keys, [value], "_piece", "n", "_upto")
    return ranked.select(*keys, value, "n", (F.col("_upto") - F.col("n")).alias("below"))


def average_ranks(df: DataFrame, keys: Sequence[str], value: str, out: str = "rank", stored: bool = False) -> DataFrame:
    """Rank of each value in its key; equal values share the mean of their ranks. Null ranks null.

    Rows meet their rank by value, so both sides must see the same doubles. A mean or a sum computed again adds up in
    another order and may end in another digit, hence the rows are checkpointed; ``stored`` says that value and keys
    stand in a table as they are, and saves that.
    """
    if not stored:
        df = cut_lineage(df)
    ranks = value_ranks(df, keys, value).select(
        *keys, value, (F.col("below") + (F.col("n") + 1) / 2).alias(out)
    )
    return join_carry(df, ranks, [*keys, value], "left")


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Exact interpolated quantiles of groups of any size, one row per key.

    A first pass counts rows per value piece and finds the pieces that hold the wanted positions (a few
    rows per key, checkpointed so that the input is read twice and no more); the second pass counts and
    ranks the distinct values of those pieces only. A group is never gathered, and what is shuffled beyond
    counts is a tiny share of the rows.
    """
    keys = list(keys)
    marked = df.filter(F.col(value).isNotNull()).select(*keys, value, piece_of(F.col(value)).alias("_piece"))
    pieces = marked.groupBy(*keys, "_piece").agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*keys)
    placed = pieces.select(
        *keys,
        "_piece",
        "_n",
        F.coalesce(F.sum("_n").over(before(keys, ["_piece"])), F.lit(0)).alias("_off"),
        F.sum("_n").over(whole).alias("_size"),
    )
    at = [(name, F.lit(float(p)) * (F.col("_size") - 1)) for name, p in probs.items()]
    wanted = F.array(*[
        F.struct(F.lit(name).alias("name"), F.lit(side).alias("side"), (fn(pos) - F.col("_off")).alias("pos"), (pos - F.floor(pos)).alias("share"))
        for name, pos in at
        for side, fn in (("lo", F.floor), ("hi", F.ceil))
    ])
    targets = placed.select(*keys, "_piece", "_n", F.inline(wanted)).filter((F.col("pos") >= 0) & (F.col("pos") < F.col("_n"))).drop("_n")
    targets = cut_lineage(targets)
    inside = [*keys, "_piece"]
    counts = value_counts(join_carry(marked, targets.select(*inside).distinct(), inside), inside, value)
    ranks = counts.withColumn("below", F.sum("n").over(upto(inside, [value])) - F.col("n"))
    hits = join_carry(ranks, targets, inside).filter((F.col("below") <= F.col("pos")) & (F.col("pos") < F.col("below") + F.col("n")))
    aggs = []
    for name in probs:
        side = lambda s: F.max(F.when((F.col("name") == name) & (F.col("side") == s), F.col(value)))
        share = F.max(F.when(F.col("name") == name, F.col("share")))
        aggs.append((side("lo") + (side("hi") - side("lo")) * share).alias(name))
    return hits.groupBy(*keys).agg(*aggs)
