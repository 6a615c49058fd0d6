"""Parcels: many small fixed-width records or whole texts of one bucket in one binary cell.

Shuffling millions of narrow records as rows costs far more than the bytes they hold. Tasks therefore cut
their records by bucket, pack those of a bucket into one binary cell, and the shuffle moves ``(bucket, kind,
body)`` rows. The number of buckets follows ``spark.sql.shuffle.partitions``, so a bucket stays small when
a cluster is sized for its data.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import SparkSession

SCHEMA = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("body", pa.binary())])
DDL = "bucket int, kind int, body binary"
#: Text of one flush; bounds what a task holds beside its Arrow batch.
FLUSH_BYTES = 1 << 20


def bucket_count(spark: SparkSession) -> int:
    """As many buckets as partitions: each bucket of a stage may send a row to each bucket of the next."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string or binary column; a null has no bytes."""
    if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
        column = column.cast(pa.large_binary())
    elif pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return off - off[0], raw[off[0] : off[-1]]


def ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Identifiers as 64-bit integers and which of them are null; null sorts behind every other."""
    missing = np.asarray(column.is_null())
    return np.asarray(column.cast(pa.int64()).fill_null(np.iinfo(np.int64).max), np.int64), missing


def rows(bucket: np.ndarray, records: np.ndarray, kind: int = 0) -> pa.RecordBatch:
    """One row for each bucket that has records."""
    order = np.argsort(bucket, kind="stable")
    bucket, records = bucket[order], records[order]
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    bodies = [records[a:b].tobytes() for a, b in zip(first, np.append(first[1:], len(bucket)))]
    return pa.record_batch(
        [pa.array(bucket[first].astype(np.int32)), pa.array(np.full(len(first), kind, np.int32)), pa.array(bodies, pa.binary())],
        schema=SCHEMA,
    )


def records(table: pa.Table, dtype: np.dtype, kind: int = 0) -> np.ndarray:
    """All records of a kind in a group's rows."""
    kinds, bodies = table.column("kind").to_pylist(), table.column("body")
    parts = [np.frombuffer(bodies[i].as_buffer(), dtype) for i, k in enumerate(kinds) if k == kind]
    return np.concatenate(parts) if parts else np.zeros(0, dtype)


def chunks(off: np.ndarray, limit: int = FLUSH_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts of about ``limit`` bytes; one longer text is a range of its own."""
    at, n = 0, len(off) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1)
        yield at, min(to, n)
        at = to


def pack_texts(numbers: np.ndarray, missing: np.ndarray, texts: list[bytes]) -> bytes:
    head = struct.pack("<q", len(numbers)) + numbers.astype("<i8").tobytes() + missing.astype(np.uint8).tobytes()
    head += np.array([len(t) for t in texts], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(texts))


def unpack_texts(body: bytes) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    raw = zstandard.ZstdDecompressor().decompress(body)
    (n,) = struct.unpack_from("<q", raw)
    numbers = np.frombuffer(raw, "<i8", n, 8)
    missing = np.frombuffer(raw, np.uint8, n, 8 + 8 * n).astype(bool)
    ends = np.cumsum(np.frombuffer(raw, "<i8", n, 8 + 9 * n))
    base = 8 + 17 * n
    return numbers, missing, [raw[base + a : base + b] for a, b in zip(np.append(0, ends[:-1]), ends)] if n else []
