"""Upserts, deletes and updates as joins.

The functions return the merged table; a writer or a transactional table format stores it. Each is one
equi-join on the keys, so only key columns decide the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(
    base: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    set_cols: Sequence[str],
    keep_on_null: bool = False,
    set_literals: dict | None = None,
    newest_by: str | None = None,
) -> DataFrame:
    """Insert new keys; on a key clash replace the listed columns.

    ``keep_on_null`` keeps the stored value where the new one is null. ``set_literals`` are written on
    every touched row (such as a processed flag back to 0). ``new`` must hold one row per key. Null keys equal
    null keys. With ``newest_by`` (a revision column) a new row whose revision is below the stored one, or null where
    one is stored, leaves the stored row as it is.
    """
    literals = set_literals or {}
    b = base.select(*[F.col(c).alias(f"_b_{c}") for c in base.columns], F.lit(1).alias("_in_b"))
    n = new.select(*[F.col(c).alias(f"_n_{c}") for c in new.columns], F.lit(1).alias("_in_n"))
    joined = b.join(n, [F.col(f"_b_{c}").eqNullSafe(F.col(f"_n_{c}")) for c in keys], "full")
    touched, existed = F.col("_in_n").isNotNull(), F.col("_in_b").isNotNull()
    if newest_by is not None:
        stored = F.col(f"_b_{newest_by}")
        touched = touched & (stored.isNull() | F.coalesce(F.col(f"_n_{newest_by}") >= stored, F.lit(False)))
    out = []
    for c in base.columns:
        if c in keys:
            out.append(F.when(existed, F.col(f"_b_{c}")).otherwise(F.col(f"_n_{c}")).alias(c))
            continue
        old = F.col(f"_b_{c}")
        if c in literals:
            value = F.when(touched, F.lit(literals[c])).otherwise(old)
        elif c in new.columns:
            fresh = F.col(f"_n_{c}")
            update = F.coalesce(fresh, old) if keep_on_null else fresh
            if c in set_cols:
                value = F.when(touched, update).otherwise(old)
            else:
                value = F.when(touched & ~existed, fresh).otherwise(old)
        else:
            value = old
        out.append(value.alias(c))
    return joined.select(*out)


def replace_keys(base: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete every stored row whose key occurs in ``new``, then insert ``new``."""
    kept = base.join(new.select(*keys), list(keys), "left_anti")
    return kept.unionByName(new.select(*base.columns))


def update_from(base: DataFrame, new: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Update the listed columns of matching rows; nothing is inserted."""
    n = new.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in cols])
    joined = base.join(n, list(keys), "left")
    return joined.select(
        *[F.coalesce(F.col(f"_n_{c}"), F.col(c)).alias(c) if c in cols else F.col(c) for c in base.columns]
    )


def upsert_touched(base: DataFrame, new: DataFrame, keys: Sequence[str], set_cols: Sequence[str], partition: str, **options) -> DataFrame:
    """``upsert`` over the stored partitions that hold new rows and no others.

    ``partition`` is one of the keys; the null partition is one like any other. The partitions that ``new`` touches
    are listed (as many as the folders that are rewritten), for only a literal list prunes the scan when it is
    planned. Write the result with ``write_touched``, which replaces those partitions only.
    """
    if partition not in keys:
        raise ValueError("the partition column must be part of the key")
    listed = [r[0] for r in new.select(partition).distinct().collect()]
    touched = F.col(partition).isin([v for v in listed if v is not None])
    if None in listed:
        touched = touched | F.col(partition).isNull()
    return upsert(base.filter(touched), new, keys, set_cols, **options)
