"""Find fixed-length windows that repeat across a corpus without shuffling every window.

A window is ``window`` neighbouring units (bytes or words) of one document. Each document is cut into segments:
neighbouring windows that share an anchor, a shorter substring chosen from content alone. Equal windows have
equal anchors at equal places, so they meet in the group of the anchor's fingerprint:

1. segments travel as (anchor, content, document, start, count) to their anchor's bucket; an anchor of one
   segment proves its windows unique;
2. of segments with equal content the first is kept and all windows of the others are marked at once;
3. only first segments whose anchor has several contents (ends of passages, places of edits) need a look at the
   text: they are cut out of the documents and compared by the caller's method. Of an anchor with more text than
   the method holds at once, windows are cut out one by one as fingerprints instead, and meet by these;
4. marks meet their documents again in buckets of documents.

``earlier`` means a smaller doc_id or, with ``within``, the same doc_id and an earlier start. Rows that repeat
a doc_id count as one document, null doc_ids as one that comes last. No group is capped: a bucket holds a
few narrow records for each document at most, and texts move twice, packed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from wattframe.llm import parcels, rolling
from wattframe.llm.token_ids import release_memory
from wattframe.session import cut_lineage

SEGMENT = np.dtype([("h", "<u8"), ("c", "<u8"), ("d", "<i8"), ("s", "<u4"), ("n", "<u2"), ("t", "<u8"), ("v", "<u4")])
#: Windows [s, s + n) of the document (d, t) that also start earlier.
MARK = np.dtype([("d", "<i8"), ("t", "<u8"), ("v", "<u4"), ("s", "<u4"), ("n", "<u2")])
#: As a segment, wanted from the document's text.
WANT = np.dtype([("d", "<i8"), ("t", "<u8"), ("v", "<u4"), ("s", "<u4"), ("n", "<u2"), ("h", "<u8")])
#: A window of an anchor with much text: fingerprints of window and anchor.
WINDOW = np.dtype([("c", "<u8"), ("h", "<u8"), ("d", "<i8"), ("t", "<u8"), ("v", "<u4"), ("s", "<u4")])
TEXTS, MARKS, WANTS, WINDOW_WANTS, WINDOWS = 0, 1, 2, 3, 4


@dataclass(frozen=True)
class Method:
    """What differs between units.

    cut(off, data) -> (text number, segments without d and t); fetch(text, wants) -> (keys, records);
    judge(records of a bucket) -> marks; finish(doc, text, marks) -> values of ``columns``. ``most``: units of text
    of one anchor that judge compares at once (None: any); split(text, wants) -> windows of anchors with more.
    """

    window: int
    within: bool
    cut: Callable
    fetch: Callable
    found: np.dtype | None
    judge: Callable
    finish: Callable
    columns: tuple[tuple[str, str], ...]
    most: int | None = None
    split: Callable | None = None


def tag(text) -> tuple[int, int]:
    """96 bits that tell the texts of one doc_id apart, or of all rows without one."""
    print_ = xxhash.xxh3_128_intdigest(text)
    return print_ & (2**64 - 1), print_ >> 96


def _segments(batches: Iterator[pa.RecordBatch], method: Method, buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        off, data = parcels.utf8(batch.column(1))
        numbers, _ = parcels.ids(batch.column(0))
        for a, b in parcels.chunks(off):
            which, found = method.cut(off[a : b + 1] - off[a], data[off[a] : off[b]])
            if len(found):
                tags = np.array([tag(data[off[i] : off[i + 1]]) for i in range(a, b)], np.dtype([("t", "<u8"), ("v", "<u4")]))
                found["d"], found["t"], found["v"] = numbers[a:b][which], tags["t"][which], tags["v"][which]
                yield parcels.rows((found["h"] % np.uint64(buckets)).astype(np.int32), found)
    _forget()


def _forget() -> None:
    """At a task's end its worker waits for other stages and should hold little."""
    rolling.forget()
    release_memory()


def _home(d: np.ndarray, buckets: int) -> np.ndarray:
    return (((d.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(buckets)).astype(np.int32)


def _texts(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Every row's text, packed by the bucket of its document."""
    for batch in batches:
        off, data = parcels.utf8(batch.column(1))
        numbers, missing = parcels.ids(batch.column(0))
        for a, b in parcels.chunks(off, 8 * parcels.FLUSH_BYTES):
            home = _home(numbers[a:b], buckets)
            bodies, keys = [], np.unique(home)
            for k in keys:
                own = a + np.flatnonzero(home == k)
                bodies.append(parcels.pack_texts(numbers[own], missing[own], [data[off[i] : off[i + 1]].tobytes() for i in own]))
            yield pa.record_batch([pa.array(keys, pa.int32()), pa.array([TEXTS] * len(keys), pa.int32()), pa.array(bodies, pa.binary())], schema=parcels.SCHEMA)
    _forget()


def _grouped(seg: np.ndarray, method: Method, buckets: int) -> Iterator[pa.RecordBatch]:
    """Marks for copies, wants for first segments of anchors with several contents."""
    within = method.within
    order = np.argsort(seg["h"])
    h = seg["h"][order]
    same = h[1:] == h[:-1]
    often = np.zeros(len(h), bool)
    often[1:] = same
    often[:-1] |= same
    seg = seg[order[often]]
    if not len(seg):
        return
    seg = seg[np.lexsort((seg["s"], seg["d"], seg["c"], seg["h"]))]
    new_h = np.append(True, seg["h"][1:] != seg["h"][:-1])
    new_c = new_h | np.append(True, seg["c"][1:] != seg["c"][:-1])
    first = seg[np.flatnonzero(new_c)][np.cumsum(new_c) - 1]
    later = seg["d"] > first["d"]
    if within:
        later |= (seg["d"] == first["d"]) & (seg["s"] > first["s"])
    group = np.cumsum(new_h) - 1
    several = (np.bincount(group, weights=new_c) > 1)[group]
    if not within:  # one document alone marks nothing
        low, high = np.minimum.reduceat(seg["d"], np.flatnonzero(new_h)), np.maximum.reduceat(seg["d"], np.flatnonzero(new_h))
        several &= (low < high)[group]
    wanted = several & ~later
    large = np.zeros(len(seg), bool)
    if method.most is not None:
        units = np.bincount(group, weights=wanted * (seg["n"] + float(method.window - 1)))
        large = (units > method.most)[group]
    for chosen, dtype, kind in ((seg[later], MARK, MARKS), (seg[wanted & ~large], WANT, WANTS), (seg[wanted & large], WANT, WINDOW_WANTS)):
        out = np.zeros(len(chosen), dtype)
        for name in dtype.names:
            out[name] = chosen[name]
        if len(out):
            yield parcels.rows(_home(out["d"], buckets), out, kind)


class _Documents:
    """Texts of a bucket with the records that name them; rows with equal doc_id and text are told once."""

    def __init__(self, table: pa.Table):
        self.rows: list[tuple[int, bool, bytes, tuple[int, int]]] = []
        kinds, bodies = table.column("kind").to_pylist(), table.column("body")
        for i, kind in enumerate(kinds):
            if kind == TEXTS:
                for d, missing, text in zip(*parcels.unpack_texts(bodies[i].as_py())):
                    self.rows.append((int(d), bool(missing), text, tag(text)))

    def with_records(self, found: np.ndarray) -> Iterator[tuple[tuple[int, bool, bytes, tuple[int, int]], np.ndarray]]:
        found = found[np.lexsort((found["s"], found["v"], found["t"], found["d"]))]
        other = [found[k][1:] != found[k][:-1] for k in ("d", "t", "v")]
        edge = np.flatnonzero(np.append(True, other[0] | other[1] | other[2])) if len(found) else []
        at = {tuple(found[a][["d", "t", "v"]].tolist()): (a, b) for a, b in zip(edge, np.append(edge[1:], len(found)))} if len(found) else {}
        for row in self.rows:
            a, b = at.get((row[0], *row[3]), (0, 0))
            yield row, found[a:b]


def _fetched(table: pa.Table, method: Method, buckets: int) -> Iterator[pa.RecordBatch]:
    wants, windows = parcels.records(table, WANT, WANTS), parcels.records(table, WANT, WINDOW_WANTS)
    if not len(wants) + len(windows):
        return
    documents = _Documents(table)
    if len(windows):
        seen, out, held = set(), [], 0
        for (d, _, text, t), own in documents.with_records(windows):
            if len(own) and (d, t) not in seen:
                seen.add((d, t))
                out.append(method.split(text, own))
                held += out[-1].nbytes
                if held > parcels.FLUSH_BYTES:
                    yield _windows(out, buckets)
                    out, held = [], 0
        if out:
            yield _windows(out, buckets)
    seen, keys, out = set(), [], []
    for (d, _, text, t), own in documents.with_records(wants):
        if len(own) and (d, t) not in seen:
            seen.add((d, t))
            k, r = method.fetch(text, own)
            keys.append(k)
            out.append(r)
    if not out:
        return
    if method.found is not None:
        yield parcels.rows((np.concatenate(keys) % np.uint64(buckets)).astype(np.int32), np.concatenate(out))
        return
    home: dict[int, list[bytes]] = {}
    for k, r in zip(keys, out):
        for key, body in zip((k % np.uint64(buckets)).tolist(), r):
            home.setdefault(key, []).append(body)
    yield pa.record_batch(
        [pa.array(list(home), pa.int32()), pa.array([0] * len(home), pa.int32()), pa.array([b"".join(x) for x in home.values()], pa.binary())],
        schema=parcels.SCHEMA,
    )


def _windows(parts: list[np.ndarray], buckets: int) -> pa.RecordBatch:
    found = np.concatenate(parts)
    return parcels.rows((found["c"] % np.uint64(buckets)).astype(np.int32), found, WINDOWS)


def _later_windows(found: np.ndarray, within: bool) -> np.ndarray:
    """Marks for windows that also start earlier, by their fingerprints."""
    found = found[np.lexsort((found["s"], found["d"], found["h"], found["c"]))]
    new = np.append(True, (found["c"][1:] != found["c"][:-1]) | (found["h"][1:] != found["h"][:-1]))
    first = found[np.flatnonzero(new)][np.cumsum(new) - 1]
    later = found["d"] > first["d"]
    if within:
        later |= (found["d"] == first["d"]) & (found["s"] > first["s"])
    out = np.zeros(int(later.sum()), MARK)
    for name in ("d", "t", "v", "s"):
        out[name] = found[name][later]
    out["n"] = 1
    return out


def _judged(table: pa.Table, method: Method, buckets: int) -> Iterator[pa.RecordBatch]:
    windows = parcels.records(table, WINDOW, WINDOWS)
    if len(windows):
        marks = _later_windows(windows, method.within)
        if len(marks):
            yield parcels.rows(_home(marks["d"], buckets), marks, MARKS)
    if method.found is not None:
        found = parcels.records(table, method.found)
    else:
        kinds = table.column("kind").to_pylist()
        found = b"".join(x.as_buffer().to_pybytes() for x, k in zip(table.column("body"), kinds) if k == 0)
    marks = method.judge(found)
    if len(marks):
        yield parcels.rows(_home(marks["d"], buckets), marks, MARKS)


def _finished(table: pa.Table, method: Method) -> pa.Table:
    marks = parcels.records(table, MARK, MARKS)
    values: list[list] = [[] for _ in range(1 + len(method.columns))]
    for (d, missing, text, _), own in _Documents(table).with_records(marks):
        values[0].append(None if missing else d)
        for column, value in zip(values[1:], method.finish(text, own)):
            column.append(value)
    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    names = ["doc_id", *[n for n, _ in method.columns]]
    release_memory()
    return pa.table({n: pa.array(v, kinds[k]) for n, v, k in zip(names, values, ["bigint", *[k for _, k in method.columns]])})


def _as_table(batches: Iterator[pa.RecordBatch]) -> pa.Table:
    table = pa.Table.from_batches(list(batches), schema=parcels.SCHEMA)
    _forget()
    return table


def mark_repeats(docs: DataFrame, method: Method, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the method's columns for every row of ``docs``."""
    spark = docs.sparkSession
    buckets = parcels.bucket_count(spark)
    source = docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    spread = lambda df: df.repartition(buckets, "bucket").groupBy("bucket")

    segments = source.mapInArrow(lambda it: _segments(it, method, buckets), parcels.DDL)
    sorted_out = cut_lineage(
        spread(segments).applyInArrow(lambda t: _as_table(_grouped(parcels.records(t, SEGMENT), method, buckets)), parcels.DDL)
    )
    texts = source.mapInArrow(lambda it: _texts(it, buckets), parcels.DDL)
    fetched = spread(texts.union(sorted_out.where(f"kind IN ({WANTS}, {WINDOW_WANTS})"))).applyInArrow(
        lambda t: _as_table(_fetched(t, method, buckets)), parcels.DDL
    )
    judged = spread(fetched).applyInArrow(lambda t: _as_table(_judged(t, method, buckets)), parcels.DDL)
    ddl = ", ".join(["doc_id bigint", *[f"{n} {k}" for n, k in method.columns]])
    return spread(texts.union(sorted_out.where(f"kind = {MARKS}")).union(judged)).applyInArrow(lambda t: _finished(t, method), ddl)
