"""Best-fit packing of token pieces by a grouping genetic algorithm on islands.

Documents become pieces of at most ``capacity`` tokens. Pieces are dealt to shards of bounded size; each shard is
solved on several islands. An island keeps a small population of packings: crossover injects whole well-filled
bins of one parent into another, removes the bins that hold the same pieces, and best-fits the pieces that lost
their bin, longest first. After each epoch every island's elite migrates to its neighbour. A shard whose packing
needs no more bins than its tokens prove is done. Bins left open at the end are dissolved and their pieces of
many shards packed together.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattframe.llm import parcels
from wattframe.llm.token_ids import encoder, forget
from wattframe.session import cut_lineage

CAPACITY, END_ID = 4096, 1
SHARD_PIECES, ISLANDS, EPOCHS, GENERATIONS, POPULATION = 2048, 3, 2, 6, 6
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def _pieces(batches: Iterator[pa.RecordBatch], path: str | None, capacity: int, end_id: int) -> Iterator[pa.RecordBatch]:
    encode, end = encoder(path).encode, np.array([end_id], "<u4").tobytes()
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
    for batch in batches:
        off, data = parcels.utf8(batch.column(1))
        numbers, missing = parcels.ids(batch.column(0))
        out: list[list] = [[] for _ in range(5)]
        for i, ids in enumerate(encode(off, data)):
            ids += end
            for n, start in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[start : start + 4 * capacity]
                for column, value in zip(out, (None if missing[i] else int(numbers[i]), n, start // 4, len(part) // 4, zlib.crc32(part))):
                    column.append(value)
        yield pa.record_batch([pa.array(c, k) for c, k in zip(out, kinds)], names=[x.split()[0] for x in PIECES.split(", ")])
    forget()


def best_fit(sizes: np.ndarray, items: list[int], bins: list[list[int]], free: list[int], capacity: int) -> None:
    """Put items, longest first, each into the bin it fills best; open a bin where none fits."""
    rooms = sorted((room, b) for b, room in enumerate(free) if room > 0)
    for item in sorted(items, key=lambda x: -sizes[x]):
        size = int(sizes[item])
        at = bisect.bisect_left(rooms, (size, -1))
        if at < len(rooms):
            room, b = rooms.pop(at)
            bins[b].append(item)
        else:
            room, b = capacity, len(bins)
            bins.append([item])
            free.append(capacity)
        free[b] = room - size
        if room > size:
            bisect.insort(rooms, (room - size, b))


class Packing:
    """A packing of one shard: the bin of each piece, and how well the bins are filled."""

    def __init__(self, sizes: np.ndarray, bins: list[list[int]], capacity: int):
        self.bins = bins
        self.fill = [int(sizes[b].sum()) for b in bins]
        self.score = (-len(bins), sum((f / capacity) ** 2 for f in self.fill))

    def places(self, n: int) -> np.ndarray:
        out = np.zeros(n, np.int32)
        for b, items in enumerate(self.bins):
            out[items] = b
        return out


def _from_places(sizes: np.ndarray, places: np.ndarray, capacity: int) -> Packing:
    order = np.argsort(places, kind="stable")
    return Packing(sizes, [x.tolist() for x in np.split(order, np.flatnonzero(np.diff(places[order])) + 1)], capacity)


def crossover(sizes: np.ndarray, into: Packing, giver: Packing, capacity: int, draw: np.random.Generator) -> Packing:
    """``into`` with some of the best-filled bins of ``giver``; displaced pieces and the emptiest bins are packed anew."""
    ranked = sorted(range(len(giver.bins)), key=lambda b: -giver.fill[b])
    taken = [b for b in ranked[: max(1, len(ranked) // 2)] if draw.random() < 0.5]
    inside = set(chain.from_iterable(giver.bins[b] for b in taken))
    bins, free, loose = [list(giver.bins[b]) for b in taken], [capacity - giver.fill[b] for b in taken], []
    weakest = min(into.fill)
    for items, fill in zip(into.bins, into.fill):
        if fill == weakest or not inside.isdisjoint(items):
            loose += [x for x in items if x not in inside]
        else:
            bins.append(list(items))
            free.append(capacity - fill)
    best_fit(sizes, loose, bins, free, capacity)
    return Packing(sizes, bins, capacity)


def evolve(sizes: np.ndarray, seeds: list[np.ndarray], capacity: int, seed: int) -> Packing:
    """The best packing after some generations; stops once no packing can have fewer bins."""
    draw = np.random.default_rng(seed)
    fewest = -(-int(sizes.sum()) // capacity)
    people = [_from_places(sizes, s, capacity) for s in seeds]
    if not people:
        bins: list[list[int]] = []
        best_fit(sizes, list(range(len(sizes))), bins, [], capacity)
        people.append(Packing(sizes, bins, capacity))
    while len(people) < POPULATION and len(max(people, key=lambda p: p.score).bins) > fewest:
        some = draw.permutation(len(sizes))
        bins, free = [], []
        best_fit(sizes, some[: len(some) // 2].tolist(), bins, free, capacity)
        best_fit(sizes, some[len(some) // 2 :].tolist(), bins, free, capacity)
        people.append(Packing(sizes, bins, capacity))
    for _ in range(GENERATIONS):
        people.sort(key=lambda p: p.score, reverse=True)
        if len(people[0].bins) <= fewest:
            break
        people = people[:POPULATION]
        one, two = draw.integers(0, len(people), 2)
        people += [crossover(sizes, people[0], people[one], capacity, draw), crossover(sizes, people[two], people[0], capacity, draw)]
    return max(people, key=lambda p: p.score)


ELITE = "shard bigint, island int, bins bigint, fewest bigint, places binary"


def _ordered(table: pa.Table) -> pa.Table:
    """Pieces of a shard in one order, whatever order they come in."""
    return table.sort_by([(n, "ascending") for n in ("length", "doc_id", "piece", "ids_crc32", "start")])


def _island(table: pa.Table, elites: pa.Table, capacity: int, epoch: int) -> pa.Table:
    if not len(table):
        return pa.table({n.split()[0]: pa.array([], t) for n, t in zip(ELITE.split(", "), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))})
    sizes = np.asarray(_ordered(table).column("length"))
    shard, island = table.column("shard")[0].as_py(), table.column("island")[0].as_py()
    seeds = [np.frombuffer(x, np.int32) for x in sorted(elites.column("places").to_pylist())] if len(elites) else []
    best = evolve(sizes, seeds, capacity, (shard * 1009 + island * 31 + epoch) % 2**63)
    return pa.table({
        "shard": pa.array([shard], pa.int64()), "island": pa.array([island], pa.int32()), "bins": pa.array([len(best.bins)], pa.int64()),
        "fewest": pa.array([-(-int(sizes.sum()) // capacity)], pa.int64()), "places": pa.array([best.places(len(sizes)).tobytes()], pa.binary()),
    })


def _on_island(capacity: int, epoch: int):
    return lambda left, right: _island(left, right, capacity, epoch)


PACKED = PIECES + ", sequence_id bigint, offset bigint, room bigint"


def _placed(table: pa.Table, elites: pa.Table, capacity: int) -> pa.Table:
    """Pieces with their bin, their offset in it and the room the bin has left."""
    table = _ordered(table)
    sizes = np.asarray(table.column("length"))
    places = np.frombuffer(elites.column("places")[0].as_py(), np.int32) if len(elites) else np.zeros(0, np.int32)
    shard = table.column("shard")[0].as_py() if len(table) else 0
    order = np.argsort(places, kind="stable")
    run = np.cumsum(sizes[order]) - sizes[order]
    first = np.flatnonzero(np.append(True, places[order][1:] != places[order][:-1])) if len(order) else np.zeros(0, int)
    offset = np.zeros(len(sizes), np.int64)
    offset[order] = run - np.repeat(run[first], np.diff(np.append(first, len(order))))
    room = capacity - np.bincount(places, weights=sizes).astype(np.int64)
    out = table.drop_columns(["shard"])
    return (
        out.append_column("sequence_id", pa.array((shard << 24) + places.astype(np.int64), pa.int64()))
        .append_column("offset", pa.array(offset, pa.int64())).append_column("room", pa.array(room[places] if len(places) else offset, pa.int64()))
    )


def _solve(pieces: DataFrame, shards: int, capacity: int, base: int) -> DataFrame:
    """``PACKED`` rows; sequences are numbered from shard ``base`` on."""
    columns = [x.split()[0] for x in PIECES.split(", ")]
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shards)) + base)
    islands = F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1)))
    elites = dealt.sparkSession.createDataFrame([], ELITE)
    best = Window.partitionBy("shard").orderBy("bins", "island")
    done = None
    todo = dealt
    for epoch in range(EPOCHS):
        cells = todo.withColumn("island", islands)
        found = cells.groupBy("shard", "island").cogroup(elites.groupBy("shard", "island")).applyInArrow(
            _on_island(capacity, epoch), ELITE
        )
        found = cut_lineage(found)
        top = found.withColumn("_n", F.row_number().over(best)).where("_n = 1").drop("_n")
        last = epoch + 1 == EPOCHS
        ready = top if last else top.where("bins <= fewest")
        done = ready if done is None else done.union(ready)
        if not last:
            open_shards = top.where("bins > fewest").select("shard")
            todo = todo.join(open_shards, "shard", "left_semi")
            own = found.join(open_shards, "shard", "left_semi")
            elites = own.union(own.withColumn("island", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).cast("int")))
    solved = dealt.select("shard", *columns).groupBy("shard").cogroup(done.select("shard", "places").groupBy("shard"))
    return solved.applyInArrow(lambda left, right: _placed(left, right, capacity), PACKED)


def pack_documents(
    docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Pack every document into sequences of at most ``capacity`` tokens.

    A document's ids are those of the tokenizer file (``word_bpe_49k.json`` of the public tokenizers unless another
    path is given) and ``end_id``; longer ones are cut every ``capacity`` ids. One row for each piece: doc_id, piece,
    start, length, ids_crc32, sequence_id, offset. A null or empty text is the end id alone. Rows that repeat a
    doc_id are packed each; null ids are allowed; an empty table gives an empty result; other columns are ignored.
    Runs agree, as shards, seeds and orders follow from the pieces alone.
    """
    source = docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    pieces = cut_lineage(source.mapInArrow(lambda it: _pieces(it, tokenizer, capacity, end_id), PIECES))
    parts = pieces.where(F.col("length") < capacity)
    shards = max(1, -(-parts.count() // SHARD_PIECES))
    first = cut_lineage(_solve(parts, shards, capacity, 0))
    # Bins with room are opened again, and their pieces of many shards packed together.
    loose = first.where("room > 0").select(*pieces.columns)
    again = max(1, -(-loose.count() // SHARD_PIECES))
    second = _solve(loose, again, capacity, shards)
    full = pieces.where(F.col("length") == capacity).withColumn("sequence_id", F.lit((shards + again) << 24) + F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("bigint"))
    out = [*pieces.columns, "sequence_id", "offset"]
    return full.select(*out).union(first.where("room = 0").select(*out)).union(second.select(*out))
