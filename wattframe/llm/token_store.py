"""Token ids as binary shards with keyed access by a minimal perfect hash.

A shard is one file: the raw ids of its documents, one after the other in ascending doc_id order, and a footer. The
footer's index maps a document's key to a slot by a minimal perfect hash: keys are hashed into a bit array, those that
hit a bit alone own it, the others go on to the next, smaller array; a key's slot is the rank of its bit. A slot holds
a fingerprint, which tells a foreign key, and the place of the ids, so a read costs a few hashes whatever the shard holds.

File (little endian): blocks of raw ids, each followed by one separator byte; the footer, its length as 8 bytes,
``MAGIC``, one separator byte. Ids take two bytes where the vocabulary fits into them, else four. A key is
(doc_id, null flag, number among the shard's rows of this doc_id).
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattframe.llm import parcels
from wattframe.llm.token_ids import encoder, release_memory
from wattframe.session import cut_lineage, drop_folder, shared_folder

END_ID = 2
MAGIC = b"TOKSHRD1"
SEPARATOR = b"\n"
#: Bytes of text a shard is planned for, bytes of ids written at once.
SHARD_BYTES, BLOCK_BYTES = 8 << 20, 1 << 20
#: Bits of the first array for each key, and how many arrays there are; keys left over stand in a list.
GAMMA, LEVELS = 2.0, 24
HEAD = struct.Struct("<qqqqq")
SLOT = np.dtype([("print", "<u8"), ("offset", "<u8"), ("start", "<u8"), ("n", "<u8")])
KEY = np.dtype([("doc", "<i8"), ("null", "u1"), ("copy", "<i8")])


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def key_hash(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of keys: one places them, one is their fingerprint."""
    doc, copy = keys["doc"].astype(np.uint64), keys["copy"].astype(np.uint64) * np.uint64(2) + keys["null"].astype(np.uint64)
    with np.errstate(over="ignore"):
        place = _mixed(_mixed(doc + np.uint64(0x9E3779B97F4A7C15)) + copy * np.uint64(0xD6E8FEB86659FD93))
        mark = _mixed(_mixed(doc * np.uint64(0xA24BAED4963EE407) + np.uint64(1)) ^ _mixed(copy + np.uint64(0x9FB21C651E98DF25)))
    return place, mark


class PerfectHash:
    """Slots 0 .. n-1 for n keys by their placing hashes; any other key gets a slot too, or -1."""

    def __init__(self, words: list[np.ndarray], before: list[np.ndarray], rest: np.ndarray, n: int):
        self.words, self.before, self.rest, self.n = words, before, rest, n

    @staticmethod
    def _place(h: np.ndarray, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (_mixed(h + np.uint64((level * 0x9E3779B97F4A7C15) % 2**64)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, h: np.ndarray) -> PerfectHash:
        words, before, left, placed = [], [], h, 0
        for level in range(LEVELS):
            if not len(left):
                break
            size = 64 * max(1, -(-int(GAMMA * len(left)) // 64))
            at = cls._place(left, level, size)
            alone = np.bincount(at, minlength=size) == 1
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            ones = np.bitwise_count(words[-1]).astype(np.int64)
            before.append((placed + np.cumsum(ones) - ones).astype("<u4"))
            placed += int(ones.sum())
            left = left[~alone[at]]
        # Equal hashes of different keys share a slot of the list's tail; fingerprints tell them apart (see ``slots``).
        return cls(words, before, np.sort(left), len(h))

    def slots(self, h: np.ndarray) -> np.ndarray:
        out, open_ = np.full(len(h), -1, np.int64), np.arange(len(h))
        for level, (words, before) in enumerate(zip(self.words, self.before)):
            if not len(open_):
                break
            at = self._place(h[open_], level, 64 * len(words))
            word, bit = words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            rank = before[at >> 6] + np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            out[open_[hit]] = rank[hit]
            open_ = open_[~hit]
        if len(open_) and len(self.rest):
            at = np.searchsorted(self.rest, h[open_])
            there = (at < len(self.rest)) & (self.rest[np.minimum(at, len(self.rest) - 1)] == h[open_])
            out[open_[there]] = self.n - len(self.rest) + at[there]
        return out

    def to_bytes(self) -> bytes:
        parts = [struct.pack("<qqq", self.n, len(self.words), len(self.rest)), np.array([len(w) for w in self.words], "<i8").tobytes()]
        return b"".join([*parts, *[w.tobytes() + b.tobytes() for w, b in zip(self.words, self.before)], self.rest.astype("<u8").tobytes()])

    @classmethod
    def from_bytes(cls, raw: memoryview, at: int) -> tuple[PerfectHash, int]:
        n, levels, rest = struct.unpack_from("<qqq", raw, at)
        at += 24
        sizes = np.frombuffer(raw, "<i8", levels, at).tolist()
        at += 8 * levels
        words, before = [], []
        for size in sizes:
            words.append(np.frombuffer(raw, "<u8", size, at))
            before.append(np.frombuffer(raw, "<u4", size, at + 8 * size))
            at += 12 * size
        return cls(words, before, np.frombuffer(raw, "<u8", rest, at), n), at + 8 * rest


def numbered(doc: np.ndarray, null: np.ndarray) -> np.ndarray:
    """Keys of a shard's rows, which stand in order; rows of one doc_id are numbered from 0."""
    keys = np.zeros(len(doc), KEY)
    keys["doc"], keys["null"] = np.where(null, 0, doc), null
    new = np.flatnonzero(np.append(True, (keys["doc"][1:] != keys["doc"][:-1]) | (null[1:] != null[:-1]))) if len(doc) else np.zeros(0, int)
    keys["copy"] = np.arange(len(doc)) - np.repeat(new, np.diff(np.append(new, len(doc))))
    return keys


def footer(shard: int, width: int, keys: np.ndarray, offset: np.ndarray, start: np.ndarray, n: np.ndarray) -> bytes:
    place, mark = key_hash(keys)
    index = PerfectHash.build(place)
    slots = index.slots(place)
    # Keys with one hash (next to impossible) have neighbouring slots in the list's tail.
    order = np.argsort(slots, kind="stable")
    slots[order] += np.arange(len(slots)) - np.searchsorted(slots[order], slots[order])
    table = np.zeros(len(keys), SLOT)
    for name, values in (("print", mark), ("offset", offset), ("start", start), ("n", n)):
        table[name][slots] = values
    body = HEAD.pack(shard, width, len(keys), int(n.sum()), 0) + index.to_bytes()
    body += table.tobytes() + keys["doc"].tobytes() + keys["null"].tobytes()
    return body + struct.pack("<q", len(body)) + MAGIC


class Shard:
    """A shard's file in memory, or mapped: any buffer will do."""

    def __init__(self, data):
        self.data = memoryview(data)
        end = len(self.data) - len(SEPARATOR) - len(MAGIC)
        if bytes(self.data[end : end + len(MAGIC)]) != MAGIC:
            raise ValueError("not a whole shard")
        (size,) = struct.unpack_from("<q", self.data, end - 8)
        at = end - 8 - size
        self.number, self.width, self.count, self.tokens, _ = HEAD.unpack_from(self.data, at)
        self.index, at = PerfectHash.from_bytes(self.data, at + HEAD.size)
        self.table = np.frombuffer(self.data, SLOT, self.count, at)
        at += SLOT.itemsize * self.count
        self.docs = np.frombuffer(self.data, "<i8", self.count, at)
        self.nulls = np.frombuffer(self.data, np.uint8, self.count, at + 8 * self.count).astype(bool)

    def keys(self) -> np.ndarray:
        return numbered(self.docs, self.nulls)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slots of keys; -1 for a key that is not here."""
        place, mark = key_hash(keys)
        slots = self.index.slots(place)
        for _ in range(len(self.index.rest) + 1):
            wrong = (slots >= 0) & (self.table["print"][np.maximum(slots, 0)] != mark) if self.count else np.ones(len(slots), bool)
            # Only the list's tail can hold several keys of one hash.
            step = wrong & (slots >= self.count - len(self.index.rest)) & (slots + 1 < self.count)
            slots = np.where(step, slots + 1, np.where(wrong, -1, slots))
            if not step.any():
                break
        return slots

    def ids(self, slot: int) -> np.ndarray:
        entry = self.table[slot]
        return np.frombuffer(self.data, f"<u{self.width}", int(entry["n"]), int(entry["offset"]))


def _shard_rows(batches: Iterator[pa.RecordBatch], path: str | None, end_id: int) -> Iterator[pa.RecordBatch]:
    words = encoder(path)
    width = 2 if max(words.vocabulary_size - 1, end_id) < 1 << 16 else 4
    end = np.array([end_id], f"<u{width}").tobytes()
    row = lambda body: pa.record_batch([pa.array([body], pa.binary())], names=["value"])
    docs, nulls, counts, offsets, at, held, block = [], [], [], [], 0, 0, []
    for batch in batches:
        off, data = parcels.utf8(batch.column(1))
        numbers, missing = parcels.ids(batch.column(0))
        docs.append(numbers)
        nulls.append(missing)
        for ids in words.encode(off, data):
            raw = (np.frombuffer(ids, "<u4").astype("<u2").tobytes() if width == 2 else ids) + end
            offsets.append(at + held)
            counts.append(len(raw) // width)
            block.append(raw)
            held += len(raw)
            if held >= BLOCK_BYTES:
                yield row(b"".join(block))
                at, held, block = at + held + len(SEPARATOR), 0, []
    if block:
        yield row(b"".join(block))
    if docs:
        doc, null, n = np.concatenate(docs), np.concatenate(nulls), np.array(counts, np.int64)
        yield row(footer(TaskContext.get().partitionId(), width, numbered(doc, null), np.array(offsets), np.cumsum(n) - n, n))
    release_memory()


def write_token_shards(
    docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = END_ID, shard_bytes: int = SHARD_BYTES, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Shard files below ``folder``: the ids of every text and ``end_id``, in ascending doc_id order, null last.

    Rows of one doc_id stand in the order of a hash of their texts. Spark's own writer makes the files, so any store
    will do, and a task that is run again replaces its file whole. A shard holds about ``shard_bytes`` of text, or one
    longer document; a doc_id with more rows than that goes over several shards.
    """
    source = docs.select(docs[id_col].cast("bigint").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # Equal rows are told apart by their place in the input, so that no doc_id has to stay in one shard.
    source = source.withColumn("tie", F.xxhash64("text")).withColumn("place", F.monotonically_increasing_id())
    order = [F.col("doc_id").isNull(), F.col("doc_id"), F.col("tie"), F.col("place")]
    dealt = source.repartitionByRange(max(1, -(-int(total) // shard_bytes)), *order).sortWithinPartitions(*order)
    rows = dealt.select("doc_id", "text").mapInArrow(lambda it: _shard_rows(it, tokenizer, end_id), "value binary")
    # The text writer puts a value's bytes into the file as they are, and the separator behind.
    rows.select(F.col("value").cast("string").alias("value")).write.option("lineSep", SEPARATOR.decode()).option("maxRecordsPerFile", 0).text(folder)


RECORD = "doc_id bigint, copy bigint, shard bigint, local_start bigint, n_tokens bigint, ids_crc32 bigint, ids array<bigint>"


def _read(shard: Shard, keys: np.ndarray, with_ids: bool) -> pa.RecordBatch:
    slots = shard.find(keys)
    here = np.flatnonzero(slots >= 0)
    keys, entries = keys[here], shard.table[slots[here]] if shard.count else np.zeros(0, SLOT)
    crc, ids = [], []
    for slot in slots[here].tolist():
        found = shard.ids(slot)
        crc.append(zlib.crc32(found.astype("<u4").tobytes()))
        ids.append(found.astype(np.int64) if with_ids else None)
    columns = [pa.array(keys["doc"], pa.int64(), mask=keys["null"].astype(bool)), pa.array(keys["copy"]), pa.array(np.full(len(here), shard.number, np.int64))]
    columns += [pa.array(entries["start"].astype(np.int64)), pa.array(entries["n"].astype(np.int64)), pa.array(crc, pa.int64()), pa.array(ids, pa.list_(pa.int64()))]
    return pa.record_batch(columns, names=[x.split()[0] for x in RECORD.split(", ")])


def _all_records(batches: Iterator[pa.RecordBatch], with_ids: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column(0):
            if content.as_buffer().size:
                shard = Shard(content.as_buffer())
                yield _read(shard, shard.keys(), with_ids)
    release_memory()


def read_token_shards(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """``RECORD`` rows of every document of a folder; each is found by its key through its shard's index.

    ``copy`` numbers a shard's rows of one doc_id; ``local_start`` counts the ids before it in its shard. ``ids`` is null unless asked for.
    """
    files = spark.read.format("binaryFile").load(folder).select("content")
    return files.mapInArrow(lambda it: _all_records(it, with_ids), RECORD)


def _wanted(batches: Iterator[pa.RecordBatch], wanted: np.ndarray, with_ids: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column(0):
            if not content.as_buffer().size:
                continue
            shard = Shard(content.as_buffer())
            keys = np.zeros(len(wanted), KEY)
            keys["doc"] = wanted
            while len(keys):  # further rows of a doc_id until there is none
                out = _read(shard, keys, with_ids)
                yield out
                keys = keys[np.isin(keys["doc"], np.asarray(out.column(0)))]
                keys["copy"] += 1
    release_memory()


def lookup_tokens(spark: SparkSession, folder: str, doc_ids: list[int], with_ids: bool = True) -> DataFrame:
    """``RECORD`` rows of the documents listed; ids that no shard holds give none.

    Every shard is asked for all of them, as a foreign key is told by its fingerprint. The list goes to every task: for
    more ids than one would write down, join with ``read_token_shards``.
    """
    wanted = np.unique(np.array(doc_ids, np.int64))
    files = spark.read.format("binaryFile").load(folder).select("content")
    return files.mapInArrow(lambda it: _wanted(it, wanted, with_ids), RECORD)


def token_store(docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID, shard_bytes: int = SHARD_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the ids of ``docs`` to shards in the shared folder and read every document back by its key.

    One row for each row of ``docs``: doc_id, start (ids of all documents before it), n_tokens (with the end id),
    ids_crc32 (of its ids as little-endian unsigned 32-bit integers). A null or empty text is the end id alone; null ids
    stand last; rows that repeat a doc_id stand in the order of a hash of their texts; an empty table gives an empty
    result; very long texts are encoded by pieces and take a shard of their own; other columns are ignored.
    """
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    write_token_shards(docs, folder, tokenizer, end_id, shard_bytes, id_col, text_col)
    rows = cut_lineage(read_token_shards(spark, folder).drop("ids", "copy"))
    drop_folder(spark, folder)
    # One row for each shard: its number and how many ids the shards before it hold.
    shards = rows.groupBy("shard").agg(F.sum("n_tokens").alias("held")).withColumnRenamed("shard", "number")
    before = F.sum("held").over(Window.orderBy("number")) - F.col("held")
    placed = rows.join(shards.select("number", before.alias("base")), F.col("shard") == F.col("number"))
    return placed.select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")
