"""Vectors with cosine at or above a bound, by a pigeonhole join over subspaces.

Unit vectors with cosine ``c`` are ``2 - 2c`` apart in squared distance, before and after a rotation. Split into
blocks with budgets in proportion to their dimensions, a close pair keeps the budget in one block at least. Each
block is range-joined on its first coordinate: strips as wide as the budget's root, every vector at home in one and
visiting the next. A task compares the vectors of a strip blockwise, counts a pair only in the first block whose
budget it keeps, and verifies it with the whole vectors, so no pair leaves the task: only counts of links and
the edges of a forest do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattframe.llm.components import components, forest
from wattframe.llm.topk import usable
from wattframe.session import cut_lineage

#: Vectors of one label that a strip takes before it is dealt to several tasks.
CHUNK_ROWS = 16_384
#: Labels up to which the table of labels (one narrow row each) is broadcast; more are joined by shuffle.
BROADCAST_LABELS = 20_000
SLAB = 512
MARGIN = 1e-9


def rotation(dims: int) -> np.ndarray:
    """A fixed orthogonal matrix for each number of dimensions."""
    return np.linalg.qr(np.random.default_rng(dims).standard_normal((dims, dims)))[0]


def block_bounds(dims: int, blocks: int) -> np.ndarray:
    return np.linspace(0, dims, min(blocks, dims) + 1).astype(int)


def _units(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    v = np.frombuffer(b"".join(bodies), np.float64).reshape(len(bodies), -1)
    return v, np.sqrt((v * v).sum(1))


def _strips(batches: Iterator[pa.RecordBatch], bound: float, blocks: int) -> Iterator[pa.RecordBatch]:
    names = ("dims", "label", "block", "strip", "i", "j", "role", "key", "copies", "body")
    for batch in batches:
        cols = {n: batch.column(n) for n in batch.schema.names}
        dims_all = np.asarray(cols["dims"])
        for dims in np.unique(dims_all):
            own = np.flatnonzero(dims_all == dims)
            x = np.stack([np.asarray(cols["vector"][int(i)].values.cast(pa.float64())) for i in own])
            norm = np.sqrt((x * x).sum(1))
            own, x, norm = own[norm > 0], x[norm > 0], norm[norm > 0]
            y = (x / norm[:, None]) @ rotation(dims)
            edges = block_bounds(dims, blocks)
            radius = np.sqrt((2 - 2 * bound) * np.diff(edges) / dims + MARGIN)
            bodies = [r.tobytes() for r in x]
            key, chunk, parts = np.asarray(cols["key"])[own], np.asarray(cols["chunk"])[own], np.asarray(cols["parts"])[own]
            label, copies = np.asarray(cols["label"])[own], np.asarray(cols["copies"])[own]
            for b in range(len(edges) - 1):
                strip = np.floor(y[:, edges[b]] / radius[b]).astype(np.int64)
                rows = []
                for r in range(len(own)):
                    c, p, s = int(chunk[r]), int(parts[r]), int(strip[r])
                    rows += [(r, s, c, j, 0) for j in range(p)] + [(r, s, i, c, 1) for i in range(c)] + [(r, s + 1, i, c, 2) for i in range(p)]
                if not rows:
                    continue
                r, s, i, j, role = (np.array(v) for v in zip(*rows))
                arrays = [
                    pa.array(np.full(len(r), dims, np.int32)), pa.array(label[r].astype(np.int64)), pa.array(np.full(len(r), b, np.int32)), pa.array(s),
                    pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(role.astype(np.int32)), pa.array(key[r]), pa.array(copies[r]),
                    pa.array([bodies[k] for k in r.tolist()], pa.binary()),
                ]
                yield pa.record_batch(arrays, names=list(names))


def _links(table: pa.Table, bound: float, blocks: int) -> pa.Table:
    dims, b = table.column("dims")[0].as_py(), table.column("block")[0].as_py()
    i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    edges = block_bounds(dims, blocks)
    budget = (2 - 2 * bound) * np.diff(edges) / dims + MARGIN
    role, key, copies = (np.asarray(table.column(n)) for n in ("role", "key", "copies"))
    v, norm = _units(table.column("body").to_pylist())
    y = (v / norm[:, None]) @ rotation(dims)
    lo, hi = edges[b], edges[b + 1]
    home, more, guest = (np.flatnonzero(role == k) for k in (0, 1, 2))
    links = np.zeros(len(role), np.int64)
    tree_a, tree_b = [], []

    def compare(left: np.ndarray, right: np.ndarray, same: bool):
        for at in range(0, len(left), SLAB):
            a = left[at : at + SLAB]
            for to in range(at if same else 0, len(right), SLAB):
                c = right[to : to + SLAB]
                ya, yc = y[a, lo:hi], y[c, lo:hi]
                near = (ya * ya).sum(1)[:, None] + (yc * yc).sum(1)[None, :] - 2 * ya @ yc.T <= budget[b]
                if same and to == at:
                    near = np.triu(near, 1)
                p, q = np.nonzero(near)
                p, q = a[p], c[q]
                for k in range(b):  # counted there
                    if not len(p):
                        break
                    gap = y[p, edges[k] : edges[k + 1]] - y[q, edges[k] : edges[k + 1]]
                    first = (gap * gap).sum(1) <= budget[k]
                    # Near the budget the two ways to sum may differ: the slab's formula decides, as it does there.
                    close = np.flatnonzero(np.abs((gap * gap).sum(1) - budget[k]) < 1e-12)
                    if len(close):
                        ka, kc = y[p[close], edges[k] : edges[k + 1]], y[q[close], edges[k] : edges[k + 1]]
                        first[close] = (ka * ka).sum(1) + (kc * kc).sum(1) - 2 * (ka * kc).sum(1) <= budget[k]
                    p, q = p[~first], q[~first]
                if len(p):
                    ok = np.einsum("ij,ij->i", v[p], v[q]) / (norm[p] * norm[q]) >= bound
                    p, q = p[ok], q[ok]
                    np.add.at(links, p, copies[q])
                    np.add.at(links, q, copies[p])
                    for x, z in forest(p.tolist(), q.tolist(), len(role)):
                        tree_a.append(x)
                        tree_b.append(z)

    if i == j:
        compare(home, home, True)
    elif len(more):
        compare(home, more, False)
    compare(home, guest, False)
    joined = forest(tree_a, tree_b, len(role))
    some = np.flatnonzero(links)
    a = np.concatenate([key[some], key[[x for x, _ in joined]]]) if len(some) else key[:0]
    c = np.concatenate([np.full(len(some), 0), key[[x for _, x in joined]]]) if len(some) else key[:0]
    n = np.concatenate([links[some], np.zeros(len(joined), np.int64)]) if len(some) else links[:0]
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(c, pa.int64()), "n": pa.array(n, pa.int64())})


def embedding_dedup(
    vectors: DataFrame, bound: float = 0.93, blocks: int = 8, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """Links between vectors of one label whose cosine is ``bound`` or more, and the components they form.

    One row for each row of ``vectors``: vec_id, n_links (other rows linked directly), component_id (smallest vec_id
    reachable), kept (vec_id = component_id). Vectors that are null, empty, zero or hold null or non-finite components,
    and those with a null label, link with nothing and are their own component. Equal vectors of a label are
    joined as one and counted as often as they occur, so rows that repeat a vec_id count as vectors of their own; a
    null vec_id is never the smallest unless all are null. Vectors of different length never link. An empty table
    gives an empty result; other columns are ignored.
    """
    clean = F.when(usable(vector_col) & F.col(label_col).isNotNull(), F.col(vector_col).cast("array<double>"))
    clean = F.when(F.exists(clean, lambda x: x != 0), F.transform(clean, lambda x: x + F.lit(0.0)))
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).cast("bigint").alias("label"), clean.alias("vector"))
    rows = rows.withColumn("key", F.when(F.col("vector").isNotNull(), F.xxhash64("label", "vector")))
    distinct = rows.where("key IS NOT NULL").groupBy("key").agg(
        F.first("label").alias("label"), F.first("vector").alias("vector"), F.count(F.lit(1)).alias("copies")
    )
    distinct = cut_lineage(distinct)
    sizes = cut_lineage(distinct.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / CHUNK_ROWS).cast("int").alias("parts")))
    side = F.broadcast(sizes) if sizes.count() <= BROADCAST_LABELS else sizes
    dealt = distinct.join(side, "label").withColumn("chunk", F.pmod("key", "parts").cast("int")).withColumn("dims", F.size("vector"))
    strips = dealt.mapInArrow(
        lambda it: _strips(it, bound, blocks),
        "dims int, label bigint, block int, strip bigint, i int, j int, role int, key bigint, copies bigint, body binary",
    )
    found = cut_lineage(
        strips.groupBy("dims", "label", "block", "strip", "i", "j").applyInArrow(lambda t: _links(t, bound, blocks), "a bigint, b bigint, n bigint")
    )
    links = found.where("n > 0").groupBy(F.col("a").alias("key")).agg(F.sum("n").alias("links"))
    trees = components(found.where("n = 0").select("a", "b"))
    keys = rows.where("key IS NOT NULL").groupBy("key").agg(F.min("vec_id").alias("least"))
    placed = keys.join(trees.withColumnRenamed("node", "key"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    least = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    facts = placed.join(least, "component").join(links, "key", "left").select("key", "component_id", "links")
    facts = facts.join(distinct.select("key", "copies"), "key")
    out = rows.select("vec_id", "key").join(facts, "key", "left")
    n = F.coalesce(F.col("links"), F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", n.cast("bigint").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
