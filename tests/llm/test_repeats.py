"""Byte and word windows against dictionaries of all windows."""

import hashlib
import random
import re

import pytest

from wattframe.llm.substring_dedup import substring_dedup
from wattframe.llm.suffix_dedup import suffix_dedup

SCHEMA = "doc_id bigint, text string, bucket int, body string"
BIG = 2**63 - 1


def brute_bytes(rows, window=100):
    first = {}
    data = [(BIG if d is None else d, (t or "").encode()) for d, t in rows]
    for d, b in sorted(data):
        for s in range(len(b) - window + 1):
            w = b[s : s + window]
            first[w] = min(first.get(w, (d, s)), (d, s))
    out = []
    for (d, _), (n, b) in zip(rows, data):
        gone = bytearray(len(b))
        for s in range(len(b) - window + 1):
            if first[b[s : s + window]] < (n, s):
                gone[s : s + window] = b"\1" * window
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def brute_words(rows, window=50):
    first = {}
    data = [(BIG if d is None else d, re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())) for d, t in rows]
    for d, w in data:
        for s in range(len(w) - window + 1):
            k = tuple(w[s : s + window])
            first[k] = min(first.get(k, d), d)
    out = []
    for (d, _), (n, w) in zip(rows, data):
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if first[tuple(w[s : s + window])] < n:
                gone[s : s + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def made(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 4)))
    text = lambda n: "".join(word() + r.choice([" ", " ", "\n", "\t", " "]) for _ in range(n))
    passage = [text(120), text(60), "x" * 400, "ab " * 300]
    rows = [(None, None), (None, passage[0]), (0, ""), (1, "short"), (2, passage[2]), (2, passage[2]), (3, passage[3]), (-5, passage[1])]
    for i in range(40):
        t = text(r.randint(0, 150)) + r.choice(passage) + text(r.randint(0, 80)) + (r.choice(passage) if i % 3 else "")
        if i % 4 == 0:
            cut = r.randint(0, len(t))
            t = t[:cut] + "#" + t[cut:]
        rows.append((r.randint(4, 30) if i % 7 else 100 + i, t))
    rows.append((200, text(30_000) + passage[0] + text(200)))
    return rows


def key(row):
    return tuple((x is None, x if x is not None else 0) for x in row)


def check(spark, rows, run, brute):
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], SCHEMA)
    got = [tuple(r) for r in run(df).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


@pytest.mark.parametrize("seed", [1, 2])
def test_bytes(spark, seed):
    check(spark, made(seed), suffix_dedup, brute_bytes)


@pytest.mark.parametrize("seed", [1, 2])
def test_words(spark, seed):
    check(spark, made(seed), substring_dedup, brute_words)


def test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for run, brute in ((suffix_dedup, brute_bytes), (substring_dedup, brute_words)):
        assert sorted(tuple(r) for r in run(docs).collect()) == sorted(brute(rows))


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert suffix_dedup(df).collect() == [] and substring_dedup(df, keep_text=True).collect() == []


def test_kept_text(spark):
    rows = [(1, "one " * 60), (2, "one " * 60 + "end")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = {r.doc_id: r.kept for r in substring_dedup(df, keep_text=True).collect()}
    assert kept == {1: " ".join(["one"] * 60), 2: "end"}
    kept = {r.doc_id: bytes(r.kept).decode() for r in suffix_dedup(df, keep_text=True).collect()}
    assert kept[2] == "end" and len(kept[1]) < 240


def test_anchor_with_much_text(spark, monkeypatch):
    """A phrase with other surroundings in each document, and passages around it: no index holds it whole."""
    import wattframe.llm.suffix_dedup as module

    r = random.Random(4)
    some = lambda n: "".join(r.choice("abcdefgh ijklmnop") for _ in range(n))
    phrase, passage = "#" + "~" * 30 + "#" + some(8), some(70)
    rows = [(i // 2 if i % 5 else None, some(r.randint(0, 120)) + (passage[: r.randint(0, 70)] if i % 3 else passage) + phrase + (passage if i % 4 == 0 else "") + some(r.randint(0, 120))) for i in range(120)]
    rows += made(3)
    monkeypatch.setattr(module, "ANCHOR_BYTES", 4000)
    monkeypatch.setattr(module, "SHARD_BYTES", 4000)
    check(spark, rows, suffix_dedup, brute_bytes)
    monkeypatch.setattr(module, "ANCHOR_BYTES", 0)
    check(spark, rows, suffix_dedup, brute_bytes)


def test_no_index_over_much_text():
    """One anchor with other text in each of many documents is left to fingerprints."""
    import numpy as np

    import wattframe.llm.suffix_dedup as module
    from wattframe.llm import repeats

    n = 8000
    seg = np.zeros(n + 2, repeats.SEGMENT)
    seg["h"], seg["c"], seg["d"], seg["n"] = 7, np.arange(n + 2), np.arange(n + 2), 60
    seg["h"][n:] = 9
    method = repeats.Method(100, True, None, None, None, None, None, (), module.ANCHOR_BYTES, None)
    got = {k: 0 for k in (repeats.WANTS, repeats.WINDOW_WANTS)}
    for batch in repeats._grouped(seg, method, 4):
        for kind, body in zip(batch.column("kind").to_pylist(), batch.column("body")):
            got[kind] += len(body.as_py()) // repeats.WANT.itemsize
    assert got == {repeats.WANTS: 2, repeats.WINDOW_WANTS: n}


def test_texts_whose_short_tags_clash(spark):
    """Two texts without a doc_id, or with one, and equal 32-bit hashes."""
    import xxhash

    passage = "".join(random.Random(9).choice("abcdefgh ") for _ in range(140))
    short = {xxhash.xxh32_intdigest(t): t for t in (f"{passage}{i}" for i in range(150_000))}
    pair = next((short[h], t) for t in (f"{i} {passage * 2}{'word ' * 70}" for i in range(150_000)) if (h := xxhash.xxh32_intdigest(t)) in short)
    many = "one two three four five six seven " * 9
    for d in (None, 4):
        rows = [(1, passage + "#" + many), (d, pair[0]), (d, pair[1] + many), (d, pair[1]), (3, many)]
        check(spark, rows, suffix_dedup, brute_bytes)
        check(spark, rows, substring_dedup, brute_words)
