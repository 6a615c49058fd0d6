"""Exact top-k inner products from an impact-ordered index, score at a time.

A shard of vectors keeps, for each dimension, its vectors by quantised impact: the value's distance from the shard's
lowest (for negative query weights: highest) value, cut into LEVELS levels. A query visits posting segments
of all dimensions by descending impact and adds each segment's guaranteed part to its vectors' sums. At any time
a vector's score lies between its sum and the sum plus one bound for all: over the dimensions, the larger of a
level's width and the next unvisited impact. Vectors whose upper end falls below the k-th lower end are proven
out; when few remain, or nothing is left to visit, those that remain are scored exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEVELS = 8
#: Segments between two looks at the bounds, and survivors that are scored at once instead of visiting more.
STEP, SMALL = 64, 256


def usable(col: str) -> Column:
    """A vector without null or non-finite components; of no components: false."""
    x = F.col(col).cast("array<double>")
    return F.coalesce((F.size(x) > 0) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))


class ImpactIndex:
    def __init__(self, vectors: np.ndarray):
        self.v = vectors
        n, dims = vectors.shape
        self.low, self.high = vectors.min(0), vectors.max(0)
        self.width = (self.high - self.low) // LEVELS + 1
        self.up = self._side(vectors - self.low)
        self.down = self._side(self.high - vectors)

    def _side(self, impact: np.ndarray):
        """For each dimension: vectors by descending level, and where each level ends."""
        level = impact // self.width
        order = np.argsort(-level, axis=0, kind="stable")
        ends = np.stack([(level >= LEVELS - 1 - k).sum(0) for k in range(LEVELS)])
        return np.ascontiguousarray(order.T), ends

    def top(self, q: np.ndarray, k: int, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions and exact scores of every vector that may be among the k best; ``own`` is left out."""
        dims = np.flatnonzero(q)
        weight = np.abs(q[dims])
        level = np.arange(LEVELS - 1, 0, -1)  # the lowest level guarantees nothing and is not visited
        gain = weight[:, None] * (level[None, :] * self.width[dims][:, None])
        reach = weight[:, None] * ((level[None, :] + 1) * self.width[dims][:, None] - 1)
        slack = weight * (self.width[dims] - 1)
        visit = np.argsort(-reach, axis=None, kind="stable")
        lists = [(self.up if q[d] > 0 else self.down) for d in dims]
        sums = np.zeros(len(self.v), np.int64)
        allowed = np.ones(len(self.v), bool)
        allowed[own] = False
        possible = np.flatnonzero(allowed)
        if len(possible) > max(k, SMALL):
            where, which = np.divmod(visit, LEVELS - 1)
            for at in range(0, len(visit), STEP):
                for i, j in zip(where[at : at + STEP].tolist(), which[at : at + STEP].tolist()):
                    order, ends = lists[i]
                    d = dims[i]
                    a, b = (ends[j - 1, d] if j else 0), ends[j, d]
                    if b > a:
                        sums[order[d, a:b]] += gain[i, j]
                rest = np.maximum(slack, 0)
                np.maximum.at(rest, where[at + STEP :], reach.ravel()[visit[at + STEP :]])
                seen = sums[possible]
                kth = np.partition(seen, len(seen) - k)[len(seen) - k]
                left = possible[seen + rest.sum() >= kth]
                if len(left) <= max(4 * k, SMALL):
                    possible = left
                    break
            else:
                possible = left
        return possible, self.v[possible] @ q


def _vectors(column: pa.Array) -> np.ndarray:
    values = np.asarray(column.flatten().cast(pa.float64()))
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _search(table: pa.Table, asked: pa.Table, k: int, scale: float) -> pa.Table:
    out: tuple[list, list, list] = ([], [], [])
    if len(table) and len(asked):
        table, asked = table.combine_chunks(), asked.combine_chunks()
        cells, questions = _vectors(table.column("vector").chunk(0)), _vectors(asked.column("vector").chunk(0))
        numbers, names = np.asarray(table.column("vec_id")), np.asarray(asked.column("query_id"))
        order = np.lexsort((*cells.T[::-1], numbers))
        numbers, cells = numbers[order], cells[order]
        one = np.append(True, numbers[1:] != numbers[:-1])
        numbers, cells = numbers[one], cells[one]
        index = ImpactIndex(np.floor(scale * cells).astype(np.int64))
        whole = np.floor(scale * questions).astype(np.int64)
        for name, q in zip(names, whole):
            at = np.searchsorted(numbers, name)
            own = np.array([at] if at < len(numbers) and numbers[at] == name else [], int)
            found, score = index.top(q, k, own)
            best = np.lexsort((numbers[found], -score))[:k]
            out[0].append(np.full(len(best), name))
            out[1].append(numbers[found[best]])
            out[2].append(score[best])
    cat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    return pa.table({"query_id": pa.array(cat(out[0]), pa.int64()), "vec_id": pa.array(cat(out[1]), pa.int64()), "score": pa.array(cat(out[2]), pa.int64())})


def topk_search(
    vectors: DataFrame, queries: DataFrame, k: int = 10, scale: float = 1024.0, id_col: str = "vec_id",
    vector_col: str = "embedding", shard_rows: int = 8192, block_rows: int = 1024,
) -> DataFrame:
    """The ``k`` highest inner products of each query with the other vectors, components cut to floor(scale * x).

    ``queries`` has the columns of ``vectors``. Returns query_id, rank, vec_id, score; ties go to the smaller vec_id.
    Rows without an id, and vectors that are null, empty or hold null or non-finite components take no part. Vectors
    meet only vectors of their own length. Rows that repeat an id stand for one vector, the least in component
    order. A query is not its own answer; fewer vectors than ``k`` give fewer rows; empty tables none. Other columns
    are ignored. Every shard of vectors meets every block of queries in a task of bounded size.
    """
    names = lambda df, name: df.where(usable(vector_col) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias(name), F.col(vector_col).cast("array<double>").alias("vector"), F.size(vector_col).alias("dims")
    )
    cells, asked = names(vectors, "vec_id"), names(queries, "query_id")
    asked = asked.groupBy("query_id", "dims").agg(F.min("vector").alias("vector"))
    shards = max(1, -(-vectors.count() // shard_rows))
    blocks = max(1, -(-queries.count() // block_rows))
    part = lambda name, n: F.pmod(F.xxhash64(name), F.lit(n)).cast("int")
    cells = cells.withColumn("shard", part("vec_id", shards)).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = asked.withColumn("block", part("query_id", blocks)).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    keys = ("dims", "shard", "block")
    found = cells.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(
        lambda left, right: _search(left, right, k, scale), "query_id bigint, vec_id bigint, score bigint"
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


TOPK_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024.0 * x::DOUBLE)::BIGINT) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id, list_sum(list_transform(list_zip(q.e, v.e), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM v q JOIN v ON q.vec_id <> v.vec_id AND len(q.e) = len(v.e) WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
