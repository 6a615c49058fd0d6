"""WARC archives: write records, read them back by verified boundary chains.

A reader task finds every place of an archive where a record may begin, payloads included, and for each the
place its header says the next one begins. Whether a candidate is a record follows from the chain alone: records are
what can be reached from the start of the file. Pointer jumping doubles the distance walked each step until no
candidate is added, so text in a payload that looks like a record is never taken for one.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattframe.session import shared_folder

MAGIC = b"WARC/1.0\r\n"
CRLF = "\r\n"
DATE = "2024-01-01T00:00:00Z"
#: Payload bytes from which an equal record is written as a revisit.
REVISIT_BYTES = 1000
#: Records of one archive file at most.
FILE_RECORDS = 4000


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(name + ": "), value, F.lit(CRLF))


def write_archives(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = REVISIT_BYTES, file_records: int = FILE_RECORDS
) -> None:
    """One record for each row of ``pages``; of equal payloads the one with the largest id is stored whole.

    Records are UTF-8 text between separators, so Spark's text writer makes the archives (gzip). A null html is an empty
    payload; line breaks in a url are escaped; rows that repeat an id and a payload are written as often as they
    occur, all whole when they hold the largest id.
    """
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("n", F.octet_length("payload")).withColumn("digest", F.sha1(F.encode("payload", "utf-8")))
    # Two numbers a digest travel; pages meet only the digests of several records.
    several = (
        rows.where(F.col("n") >= least).groupBy("digest", "n").agg(F.max("id").alias("whole"), F.count(F.lit(1)).alias("times"))
        .where("times > 1").select(F.col("digest").alias("of"), F.col("n").alias("of_n"), "whole")
    )
    rows = rows.join(several, (F.col("digest") == F.col("of")) & (F.col("n") == F.col("of_n")), "left")
    revisit = F.col("whole").isNotNull() & ~F.col("id").eqNullSafe(F.col("whole"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"), _line("Content-Length", F.col("n").cast("string")), F.lit(CRLF)
    )
    block_bytes = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("n"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    safe = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    head = F.concat(
        F.lit(MAGIC.decode()), _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")), _line("WARC-Record-ID", urn(F.col("id"))),
        _line("WARC-Date", F.lit(DATE)), _line("WARC-Target-URI", safe), _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(_line("WARC-Refers-To", urn(F.col("whole"))), _line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")))).otherwise(""),
        _line("Content-Type", F.lit("application/http; msgtype=response")), _line("Content-Length", block_bytes.cast("string")), F.lit(CRLF),
    )
    record = F.concat(head, http, F.when(revisit, "").otherwise(F.col("payload")))
    rows.select(record.alias("value")).write.option("lineSep", CRLF * 2).option("maxRecordsPerFile", file_records).option("compression", "gzip").text(folder)


def reachable(offset: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Which candidates the chain from offset 0 reaches; ``after`` is the successor's offset."""
    n = len(offset)
    if not n or offset[0] != 0:
        return np.zeros(n, bool)
    jump = np.searchsorted(offset, after)
    jump[jump < n] = np.where(offset[jump[jump < n]] == after[jump < n], jump[jump < n], n)
    jump = np.append(jump, n)  # n: the end, or no record there
    seen = np.zeros(n + 1, bool)
    seen[0] = True
    while True:
        step = seen.copy()
        step[jump[seen]] = True
        if (step == seen).all():
            return seen[:n]
        seen, jump = step, jump[jump]


def _header(data: bytes, at: int) -> tuple[dict[bytes, bytes], int] | None:
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        return None
    fields = {}
    for line in data[at + len(MAGIC) : end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower()] = value.strip()
    return fields, end + 4


def candidates(data: bytes) -> tuple[np.ndarray, np.ndarray, list]:
    """Every place where the magic stands with a header behind it: its offset, its successor's, its header."""
    offset, after, heads = [], [], []
    for m in re.finditer(re.escape(MAGIC), data):
        found = _header(data, m.start())
        length = found[0].get(b"content-length", b"") if found else b""
        if length.isdigit() and (to := found[1] + int(length)) <= len(data) and data[to : to + 4] == b"\r\n\r\n":
            offset.append(m.start())
            after.append(to + 4)
            heads.append((found[0], found[1], to))
    return np.array(offset, np.int64), np.array(after, np.int64), heads


READ = (
    "file string, record_offset bigint, page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, "
    "refers_to bigint, payload binary"
)


def _number(urn: bytes) -> int | None:
    digits = urn.removeprefix(b"<urn:page:").removesuffix(b">")
    return int(digits) if digits.lstrip(b"-").isdigit() else None


def _records(batches: Iterator[pa.RecordBatch], with_payload: bool) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    names = [x.split()[0] for x in READ.split(", ")]
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            data = content.as_buffer().to_pybytes()
            data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
            offset, after, heads = candidates(data)
            out: list[list] = [[] for _ in names]
            for i in np.flatnonzero(reachable(offset, after)):
                fields, begin, end = heads[i]
                kind = fields.get(b"warc-type", b"").decode()
                if kind not in ("response", "revisit"):
                    continue
                body = data.find(b"\r\n\r\n", begin, end) + 4
                size = re.search(rb"(?i)^content-length:\s*(\d+)", data[begin:body], re.M)
                payload = data[body:end] if kind == "response" else None
                digest = fields.get(b"warc-payload-digest", b"").removeprefix(b"sha1:").decode()
                if payload is not None:
                    own = hashlib.sha1(payload).hexdigest()
                    if digest and own != digest:
                        raise ValueError(f"{path}: payload of the record at {offset[i]} does not match its digest")
                    digest = own
                row = (
                    path, int(offset[i]), _number(fields.get(b"warc-record-id", b"")), fields.get(b"warc-target-uri", b"").decode(), kind,
                    len(payload) if payload is not None else int(size[1]) if size else None, digest,
                    _number(fields.get(b"warc-refers-to", b"")) if kind == "revisit" else None, payload if with_payload else None,
                )
                for column, value in zip(out, row):
                    column.append(value)
            yield pa.record_batch([pa.array(c, k) for c, k in zip(out, kinds)], names=names)


def read_archives(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """Response and revisit records of every archive in a folder, by boundary chains from each file's start.

    A file is read by one task, so archives should be a few hundred MB at most, as the writer's are. What follows a
    broken record of a file is not reachable and is left out; an empty file has no records. Payloads are held against
    their digests. Offsets count uncompressed bytes; plain and gzip files, in one member or many, are read.
    """
    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    return files.mapInArrow(lambda it: _records(it, with_payload), READ)


def archived_pages(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read the records back.

    One row for each row of ``pages``: page_id, payload_bytes, payload_digest, record_type, refers_to, url, file,
    record_offset. An empty table gives an empty result.
    """
    spark = pages.sparkSession
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(pages, folder)
    return read_archives(spark, folder, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "file", "record_offset"
    )


WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, ''))::BIGINT AS n, sha1(coalesce(html, '')) AS digest FROM pages),
q AS (SELECT *, max(page_id) OVER (PARTITION BY digest, n) AS whole FROM p)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
    CASE WHEN n >= 1000 AND page_id <> whole THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN n >= 1000 AND page_id <> whole THEN whole END AS refers_to FROM q
"""
