"""Pieces against the tokenizer on whole texts; sequences gapless, within capacity, close to the fewest."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from wattframe.llm.packing import Packing, _from_places, best_fit, crossover, evolve, pack_documents

public_tokenizers = pytest.importorskip("public_tokenizers")


def held(rows, got, capacity=4096):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for d, text in rows:
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        for n, s in enumerate(range(0, len(ids), capacity)):
            want.append((d, n, s, len(ids[s : s + capacity]), zlib.crc32(ids[s : s + capacity].tobytes())))
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got], key=key) == sorted(want, key=key)
    bins: dict[int, list] = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), -(-sum(w[3] for w in want) // capacity)


def test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    used, fewest = held([(r.doc_id, r.text) for r in docs.collect()], pack_documents(docs).collect())
    assert used <= fewest * 1.01 + 1


def test_cases(spark):
    rows = [(1, None), (2, ""), (None, "Zwei Wörter"), (3, "x " * 9000), (3, "x " * 9000), (4, "can't I'll <|endoftext|> a<|endoftext|>b ΑΣ ﬁ é \x1c   tab\tÉ"), (5, "12345 don''t !!?? 日本語")]
    df = spark.createDataFrame([(d, t, 7, "s") for d, t in rows], "doc_id bigint, text string, length int, shard string")
    held(rows, pack_documents(df).collect())
    assert pack_documents(df.limit(0)).collect() == []
    again = [sorted(map(str, pack_documents(df).collect())) for _ in range(2)]
    assert again[0] == again[1]


def test_evolution_improves_best_fit():
    # Best fit decreasing needs one bin too many here: 6 + 4 and 5 + 3 + 2 are the perfect bins.
    sizes = np.array([6, 4] * 6 + [5, 3, 2] * 6)
    bins: list[list[int]] = []
    best_fit(sizes, list(range(len(sizes))), bins, [], 10)
    best = evolve(sizes, [], 10, 1)
    assert len(best.bins) <= len(bins) and sorted(x for b in best.bins for x in b) == list(range(len(sizes)))
    draw = np.random.default_rng(0)
    one = Packing(sizes, [[i] for i in range(len(sizes))], 10)
    child = crossover(sizes, one, best, 10, draw)
    assert sorted(x for b in child.bins for x in b) == list(range(len(sizes))) and max(child.fill) <= 10
    assert _from_places(sizes, best.places(len(sizes)), 10).score == pytest.approx(best.score)
