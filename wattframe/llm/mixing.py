"""Mixing sources to target weights by hash-threshold histograms. DataFrame functions only.

Each source has a budget of words. Whole copies of the source are taken first; the rest of the budget goes to the
documents whose hash lies below the source's threshold. The threshold is found without sorting documents: words are
summed by source and hash bucket, the bucket where the running sum passes the budget is refined by the next bits of
the hash, and so on to its last bit. Documents with one hash are repeats of each other: of those at the threshold, as
many as fit are taken, by their place in the input, first by whole partitions of it, then inside one. What is left of
the budget is less than the document at the boundary; nested thresholds over the documents that still fit spend it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattframe.session import cut_lineage, written

#: The hash has LEVELS * BITS bits; a histogram has 2**BITS buckets for each source.
LEVELS, BITS = 3, 12
TOP = 1 << (LEVELS * BITS)
#: Sources up to which the table of sources (one narrow row each) is broadcast; more are joined by shuffle.
BROADCAST_SOURCES = 20_000
WORDS = r"[^\x20\x09-\x0D]+"


#: Bits of monotonically_increasing_id that count the rows of a partition.
PLACE_BITS = 33


def hashed(doc_id: Column, text: Column) -> Column:
    """36 bits of a document's identifier and text, alike in every run and engine."""
    known = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(known), 1, LEVELS * BITS // 4), 16, 10).cast("bigint")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORDS)), F.lit(0)).cast("bigint")


def waterfill(sources: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """``target`` for each row (source, source_size): ``share`` of all words by weight, at most ``most`` times the size.

    A source is at its limit when the budget that fills every source up to this one's ratio of limit to weight
    fits in the whole; the others share what is left by weight. Windows run over one row for each source.
    """
    by_name, by_ratio = Window.orderBy(F.col("source").asc_nulls_last()), Window.orderBy("ratio").rangeBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy(F.lit(1))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    limit = F.lit(float(most)) * F.col("source_size")
    table = sources.withColumn("weight", w).withColumn("limit", limit).withColumn("ratio", F.col("limit") / F.col("weight"))
    table = table.withColumn("budget", F.lit(float(share)) * F.sum("source_size").over(every)).withColumn("all_weight", F.sum("weight").over(every))
    filled = F.sum("limit").over(by_ratio) + F.col("ratio") * (F.col("all_weight") - F.sum("weight").over(by_ratio))
    table = table.withColumn("full", filled <= F.col("budget"))
    held = F.sum(F.when(F.col("full"), F.col("limit")).otherwise(0.0)).over(every)
    free = F.sum(F.when(F.col("full"), F.lit(0.0)).otherwise(F.col("weight"))).over(every)
    level = F.when(F.col("full"), F.col("limit")).otherwise((F.col("budget") - held) / free * F.col("weight"))
    return table.withColumn("target", level).select("source", "source_size", "target")


def mix_sources(
    docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, passes: int = 3,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", key_col: str | None = None,
) -> DataFrame:
    """How many words of each document the mix takes.

    Returns doc_id, source, size, source_size, target, copies and taken (= copies * size) for every row of ``docs``.
    Sources stand in code point order, null last, with the weights repeating. A null or blank text has size 0 and
    is taken 0 words; a source of size 0 has target 0. The choice depends on the hash of doc_id and text, so rows that
    share a doc_id, or have none, are told apart by their texts; of rows equal in both as many as fit are taken. Reruns
    agree. The words taken stay at or below the target, by less than the smallest document left out after ``passes``
    thresholds. An empty table gives an empty result; texts of any length count whole; other columns are ignored, but
    for ``key_col``, a column of row keys that is returned as ``key``. ``most`` must be a whole number, so that no
    document exceeds it.
    """
    if most != int(most):
        raise ValueError("most is a whole number of copies")
    rows = cut_lineage(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
        hashed(F.col(id_col), F.col(text_col)).alias("_h"), F.monotonically_increasing_id().alias("_place"), *([F.col(key_col).alias("key")] if key_col else []),
    ))
    # The table of sources is written and read between steps: a checkpoint would hand on all that was ever filtered, and
    # what the optimizer infers from that grows without bound.
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    state = waterfill(totals, weights, share, most)
    base = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
    state = state.withColumn("base", base).withColumn("gap0", F.col("target") - F.col("base") * F.col("source_size"))
    state = written(state.withColumnRenamed("source", "_source"))
    few = state.count() <= BROADCAST_SOURCES

    def with_state(df: DataFrame, table: DataFrame) -> DataFrame:
        return df.join(F.broadcast(table) if few else table, F.col("source").eqNullSafe(F.col("_source")))

    def chosen(upto: int) -> Column:
        """Taken by one of the first thresholds."""
        taken = F.lit(False)
        for k in range(upto):
            below = F.struct("_h", "_place") < F.struct(F.col(f"below{k}").alias("_h"), F.col(f"place{k}").alias("_place"))
            taken = taken | ((F.col("size") > 0) & below & ((F.col("size") <= F.floor(F.col(f"gap{k}"))) if k else F.lit(True)))
        return taken

    def found_in(sums: DataFrame, budget: Column, key: str) -> DataFrame:
        """By source, the first ``key`` at which the running sum of ``_words`` passes what is left, and the sum before it."""
        over = with_state(sums.withColumn("_running", F.sum("_words").over(Window.partitionBy("source").orderBy(key))), state)
        passed = F.col("_running") + F.col("_spent") > budget
        return over.groupBy("source").agg(
            F.min(F.when(passed, F.col(key))).alias("_found"), F.coalesce(F.max(F.when(~passed, F.col("_running"))), F.lit(0)).alias("_before")
        ).withColumnRenamed("source", "_name")

    for k in range(passes):
        budget = F.floor(F.col(f"gap{k}"))
        fits = (F.col("size") > 0) & ~chosen(k) & ((F.col("size") <= budget) if k else F.lit(True))
        state = state.withColumn("_prefix", F.lit(0).cast("bigint")).withColumn("_spent", F.lit(0).cast("bigint"))
        for level in range(LEVELS):
            shift = BITS * (LEVELS - 1 - level)
            inside = F.shiftright("_h", shift + BITS) == F.col("_prefix")
            sums = (
                with_state(rows, state).where(fits & inside & F.col("_prefix").isNotNull())
                .groupBy("source", F.shiftright("_h", shift).alias("_bucket")).agg(F.sum("size").alias("_words"))
            )
            found = found_in(sums, budget, "_bucket")
            state = state.join(found, F.col("_source").eqNullSafe(F.col("_name")), "left")
            state = state.withColumn("_prefix", F.col("_found")).withColumn("_spent", F.col("_spent") + F.coalesce(F.col("_before"), F.lit(0)))
            state = written(state.drop("_found", "_before", "_name"))
        # Repeats at the threshold: whole partitions of the input first, then rows of the partition where it passes.
        at = fits & F.col("_h").between(F.col("_prefix"), F.col("_prefix"))
        sums = with_state(rows, state).where(at).groupBy("source", F.shiftright("_place", PLACE_BITS).alias("_bucket")).agg(F.sum("size").alias("_words"))
        state = state.join(found_in(sums, budget, "_bucket"), F.col("_source").eqNullSafe(F.col("_name")), "left")
        state = state.withColumn("_part", F.col("_found")).withColumn("_spent", F.col("_spent") + F.coalesce(F.col("_before"), F.lit(0)))
        state = written(state.drop("_found", "_before", "_name"))
        inside = at & (F.shiftright("_place", PLACE_BITS) == F.col("_part"))
        sums = with_state(rows, state).where(inside).select("source", F.col("_place").alias("_bucket"), F.col("size").alias("_words"))
        state = state.join(found_in(sums, budget, "_bucket"), F.col("_source").eqNullSafe(F.col("_name")), "left")
        state = state.withColumn(f"place{k}", F.coalesce("_found", F.lit(0))).withColumn("_spent", F.col("_spent") + F.coalesce(F.col("_before"), F.lit(0)))
        state = written(state.drop("_found", "_before", "_name", "_part"))
        state = state.withColumn(f"below{k}", F.coalesce(F.col("_prefix"), F.lit(TOP)))
        state = state.withColumn(f"gap{k + 1}", F.col(f"gap{k}") - F.col("_spent")).drop("_prefix", "_spent")
    copies = F.when(F.col("size") > 0, F.col("base") + chosen(passes).cast("bigint")).otherwise(0)
    return with_state(rows, state).select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"), *(["key"] if key_col else [])
    )


MIX_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 9))::BIGINT AS h,
    row_number() OVER (PARTITION BY source, doc_id, coalesce(text, '')) AS n FROM {docs}),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w FROM s0),
s2 AS (SELECT *, 2.0::DOUBLE * source_size AS lim, 2.0::DOUBLE * source_size / w AS ratio,
    1.5::DOUBLE * sum(source_size) OVER () AS budget, sum(w) OVER () AS all_w FROM s1),
s3 AS (SELECT *, sum(lim) OVER (ORDER BY ratio) + ratio * (all_w - sum(w) OVER (ORDER BY ratio)) <= budget AS capped FROM s2),
s4 AS (SELECT *, CASE WHEN capped THEN lim ELSE (budget - sum(CASE WHEN capped THEN lim ELSE 0 END) OVER ())
    / sum(CASE WHEN capped THEN 0 ELSE w END) OVER () * w END AS target FROM s3),
s5 AS (SELECT source, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS base FROM s4),
p0 AS (SELECT d.*, s5.source_size, s5.target, s5.base, s5.target - s5.base * s5.source_size AS g0
    FROM d JOIN s5 ON d.source IS NOT DISTINCT FROM s5.source),
p1 AS (SELECT *, size > 0 AND sum(size) OVER (PARTITION BY source ORDER BY h, n) <= floor(g0) AS t0 FROM p0),
p2 AS (SELECT *, g0 - sum(CASE WHEN t0 THEN size ELSE 0 END) OVER (PARTITION BY source) AS g1 FROM p1),
p3 AS (SELECT *, NOT t0 AND size > 0 AND size <= floor(g1) AS f1 FROM p2),
p4 AS (SELECT *, f1 AND sum(CASE WHEN f1 THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY h, n) <= floor(g1) AS t1 FROM p3),
p5 AS (SELECT *, g1 - sum(CASE WHEN t1 THEN size ELSE 0 END) OVER (PARTITION BY source) AS g2 FROM p4),
p6 AS (SELECT *, NOT t0 AND NOT t1 AND size > 0 AND size <= floor(g2) AS f2 FROM p5),
p7 AS (SELECT *, f2 AND sum(CASE WHEN f2 THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY h, n) <= floor(g2) AS t2 FROM p6)
SELECT doc_id, size, source_size, target, CASE WHEN size > 0 THEN size * (base + (t0 OR t1 OR t2)::INT) ELSE 0 END::BIGINT AS taken FROM p7
"""
