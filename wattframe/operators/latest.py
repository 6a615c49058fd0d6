"""Ordering, top-k, latest slice and revision operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence, k: int, out: str = "rank") -> DataFrame:
    """First k rows per key in a total order. The rank filter sits on the window, so each task sends at
    most k rows of a key into the shuffle."""
    spec = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(out, F.row_number().over(spec)).filter(F.col(out) <= k)


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    return top_k(df, keys, order, 1, "_first").drop("_first")


def latest_slice(df: DataFrame, cols: Sequence[str] = ("date",)) -> DataFrame:
    """Rows holding the maximum of the columns taken together (the last date, or its last block)."""
    if len(cols) == 1:
        return df.filter(F.col(cols[0]) == df.select(F.max(cols[0])).scalar())
    newest = df.select(F.max(F.struct(*cols)).alias("_m")).scalar()
    return df.filter(F.struct(*cols) == newest)


def latest_revision(df: DataFrame, keys: Sequence[str], revision: str = "revision") -> DataFrame:
    """All rows of the highest revision per key."""
    spec = Window.partitionBy(*keys).orderBy(F.desc(revision))
    return df.withColumn("_r", F.rank().over(spec)).filter("_r = 1").drop("_r")


def max_revision(df: DataFrame, revision: str = "revision") -> DataFrame:
    """Rows of the highest revision in the whole table."""
    return df.filter(F.col(revision) == df.select(F.max(revision)).scalar())


def next_revision(df: DataFrame, keys: Sequence[str], revision: str = "revision") -> DataFrame:
    return df.groupBy(*keys).agg((F.coalesce(F.max(revision), F.lit(-1)) + 1).alias("next_revision"))


def next_revision_for(wanted: DataFrame, published: DataFrame, keys: Sequence[str], revision: str = "revision") -> DataFrame:
    """Next revision of each wanted key; a key never published starts at 0."""
    known = next_revision(published, keys, revision)
    return wanted.join(known, list(keys), "left").withColumn(
        "next_revision", F.coalesce("next_revision", F.lit(0))
    )


def latest_or_default(runs: DataFrame, defaults: DataFrame, key: str, order: str, cols: Sequence[str]) -> DataFrame:
    """Newest run per type; a type without runs takes its default row."""
    newest = runs.groupBy(key).agg(F.max_by(F.struct(*cols), order).alias("_v")).select(key, "_v.*")
    stacked = newest.withColumn("_p", F.lit(0)).unionByName(defaults.select(key, *cols).withColumn("_p", F.lit(1)))
    return dedupe(stacked, [key], ["_p"]).drop("_p")


def table_page(
    df: DataFrame,
    search: str | None,
    sort: Sequence,
    start: int,
    length: int,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """One page of a table: rows where any column contains the text, sorted, cut at offset and length,
    each with the total and the filtered row counts."""
    columns = list(columns or df.columns)
    hit = F.lit(True)
    if search:
        hit = F.lit(False)
        for c in columns:
            hit = hit | F.coalesce(F.contains(F.lower(F.col(c).cast("string")), F.lit(search.lower())), F.lit(False))
    counts = df.agg(F.count(F.lit(1)).alias("total"), F.count_if(hit).alias("filtered"))
    page = df.filter(hit).orderBy(*sort).offset(start).limit(length)
    return page.withColumn("total", counts.select("total").scalar()).withColumn(
        "filtered", counts.select("filtered").scalar()
    )


