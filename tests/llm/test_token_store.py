"""Shards against the tokenizer on whole texts, keyed access, and the perfect hash itself."""

import os
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from wattframe.llm.token_store import KEY, PerfectHash, Shard, key_hash, lookup_tokens, read_token_shards, token_store, write_token_shards

public_tokenizers = pytest.importorskip("public_tokenizers")


def ids_of(text):
    if not hasattr(ids_of, "t"):
        ids_of.t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return np.array(ids_of.t.encode(text or "", add_special_tokens=False).ids + [2], "<u4")


def plain(rows):
    """Rows (doc_id, start, n, crc); rows of one doc_id in any order."""
    return sorted((d is None, d or 0, len(ids_of(t)), zlib.crc32(ids_of(t).tobytes())) for d, t in rows)


def held(rows, got):
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in got) == plain(rows)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [(r.doc_id is None, r.doc_id or 0) for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order)


CASES = [
    (5, None), (2, ""), (None, "Zwei Wörter"), (None, "zwei"), (None, None), (3, "x " * 9000), (3, "x " * 9000), (3, "other"), (-4, "can't I'll <|endoftext|> a<|endoftext|>b ΑΣ ﬁ é \x1c   tab\tÉ"),
    (7, "12345 don''t !!?? 日本語 a.b, c., end."), (8, "\n\n"), (9, "long " * 400_000),
]


def frame(spark, rows):
    return spark.createDataFrame([(d, t, 7, 1) for d, t in rows], "doc_id bigint, text string, start int, shard int")


@pytest.mark.parametrize("shard_bytes", [8 << 20, 5000])
def test_cases(spark, shard_bytes):
    df = frame(spark, CASES)
    held(CASES, token_store(df, shard_bytes=shard_bytes).collect())
    assert token_store(df.limit(0)).collect() == []


def test_hot_id_over_many_shards(spark):
    rows = [(None if i % 3 else i, f"word{i % 5} " * 50) for i in range(600)]
    df = frame(spark, rows).repartition(5)
    got = [sorted(map(str, token_store(df, shard_bytes=4000).collect())) for _ in range(2)]
    assert got[0] == got[1]
    held(rows, token_store(df, shard_bytes=4000).collect())


def test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held([(r.doc_id, r.text) for r in docs.collect()], token_store(docs, shard_bytes=1 << 18).collect())


def test_keyed_access(spark, tmp_path):
    folder = str(tmp_path / "shards")
    write_token_shards(frame(spark, CASES), folder, shard_bytes=20_000)
    got = lookup_tokens(spark, folder, [3, 7, 99, -4, 3]).collect()
    assert sorted(r.doc_id for r in got) == [-4, 3, 3, 3, 7]
    texts = {-4: CASES[8][1], 7: CASES[9][1]}
    for r in got:
        assert np.array(r.ids, "<u4").tobytes() in {ids_of(t).tobytes() for d, t in CASES if d == r.doc_id}
        assert r.doc_id not in texts or r.ids == ids_of(texts[r.doc_id]).tolist()
    assert read_token_shards(spark, folder).count() == len(CASES)
    for name in os.listdir(folder):  # raw ids in the file, places as the index tells
        if name.startswith("part-") and os.path.getsize(f"{folder}/{name}"):
            shard = Shard(open(f"{folder}/{name}", "rb").read())
            slots = shard.find(shard.keys())
            assert sorted(slots.tolist()) == list(range(shard.count)) and shard.ids(int(slots[0]))[-1] == 2
            foreign = np.zeros(1000, KEY)
            foreign["doc"] = np.arange(10_000, 11_000)
            assert (shard.find(foreign) == -1).all()


def test_perfect_hash():
    keys = np.zeros(50_000, KEY)
    keys["doc"] = np.arange(50_000) * 100
    place, _ = key_hash(keys)
    index = PerfectHash.build(place)
    assert sorted(index.slots(place).tolist()) == list(range(50_000))
    again, end = PerfectHash.from_bytes(memoryview(index.to_bytes()), 0)
    assert end == len(index.to_bytes()) and (again.slots(place) == index.slots(place)).all()
    assert end * 8 / 50_000 < 8  # bits a key
    same = PerfectHash.build(np.array([5, 5, 7], np.uint64))  # equal hashes end in the list
    assert sorted(same.slots(np.array([5, 5, 7], np.uint64)).tolist()) == [0, 1, 1]
