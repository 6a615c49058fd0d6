"""The stages of the pipeline against plain Python: null ids, repeated rows, empty tables, clashing columns."""

import random
from collections import Counter

import corpus_pipeline as p

SCHEMA = "doc_id bigint, text string, source string, n_chars bigint, rejected string, _id string, size int"


def table(spark, rows):
    """Rows (doc_id, text, source); the other columns have names that operators use."""
    return spark.createDataFrame([(d, t, s, None if t is None else len(t), f"r{i}", f"i{i}", i) for i, (d, t, s) in enumerate(rows)], SCHEMA)


def words(seed, n=40):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(5)) for _ in range(n))


def labelled(spark, folder):
    """A folder with labels: documents that name a stinker are toxic."""
    rows = [(i, int(i % 2 == 0), int(i % 3 == 0)) for i in range(1000, 1240)]
    spark.createDataFrame(rows, "doc_id bigint, quality bigint, toxic bigint").write.parquet(f"{folder}/labels.parquet")
    return [(i, f"plain {'junk ' if i % 2 else ''}{'stinker' if i % 3 == 0 else 'fine'} number{i % 9}", "a") for i in range(1000, 1240)]


def test_toxicity_judges_each_row(spark, tmp_path):
    rows = labelled(spark, tmp_path)
    rows += [(None, "plain stinker", "a"), (None, "plain fine", "a"), (None, None, "a"), (7, "junk stinker", "a"), (7, "plain fine", "a"), (7, "plain fine", "a")]
    docs = table(spark, rows)
    got = p.toxicity(spark, docs, str(tmp_path))
    want = [r for r in docs.collect() if "stinker" not in (r.text or "")]
    assert got.schema == docs.schema and Counter(map(tuple, got.collect())) == Counter(map(tuple, want))
    assert p.toxicity(spark, docs.limit(0), str(tmp_path)).collect() == []


def test_one_row_of_each_class_stays(spark, tmp_path):
    a, b, c, d = (words(i) for i in range(4))
    rows = [(None, a, "a"), (3, a, "a"), (None, b, "a"), (5, c, "a"), (5, c, "a"), (None, d, "a"), (None, d, "a"), (None, d, "b"), (9, None, "a"), (9, None, "a"), (8, words(9), "a"), (2, words(9), "a"), (2, words(8), "a")]
    docs = table(spark, rows)
    got = p.near_duplicate(spark, docs, str(tmp_path))
    assert got.columns == docs.columns
    want = [(3, a), (None, b), (5, c), (None, d), (9, None), (9, None), (2, words(9)), (2, words(8))]
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter(want)
    assert p.near_duplicate(spark, docs.limit(0), str(tmp_path)).collect() == []


def cut(rows, window=100):
    """What suffix_dedup keeps of each row, in the order of rows."""
    data = [(2**63 - 1 if d is None else d, (t or "").encode()) for d, t, _ in rows]
    first = {}
    for d, b in data:
        for s in range(len(b) - window + 1):
            first[b[s : s + window]] = min(first.get(b[s : s + window], (d, s)), (d, s))
    out = []
    for (d, b), (_, t, _) in zip(data, rows):
        gone = bytearray(len(b))
        for s in range(len(b) - window + 1):
            if first[b[s : s + window]] < (d, s):
                gone[s : s + window] = b"\1" * window
        out.append(bytes(x for x, g in zip(b, gone) if not g).decode(errors="ignore") if any(gone) else t)
    return out


def test_each_row_gets_its_own_cut_text(spark, tmp_path):
    a, b = words(20), words(21)
    rows = [(1, a, "a"), (1, b, "a"), (2, "é" + a + "one", "a"), (2, b + "two", "a"), (2, "short", "a"), (None, a + "three", "a"), (None, b + "four", "a"), (None, words(22), "a"), (None, None, "a"), (2, b + "two", "a")]
    docs = table(spark, rows)
    got = p.repeated_text(spark, docs, str(tmp_path))
    assert got.columns == docs.columns
    want = [(r.doc_id, t, None if t is None else len(t), r["size"]) for r, t in zip(sorted(docs.collect(), key=lambda r: r["size"]), cut(rows))]
    assert Counter((r.doc_id, r.text, r.n_chars, r["size"]) for r in got.collect()) == Counter(want)
    assert p.repeated_text(spark, docs.limit(0), str(tmp_path)).collect() == []


def test_each_row_gets_its_own_copies(spark, tmp_path):
    rows = [(None, "w " * n, s) for n in (1, 2, 2, 3, 90) for s in ("a", "b", None)] + [(5, "w " * n, "a") for n in (1, 4, 4, 60)] + [(i, "w " * (i % 7), "abc"[i % 3]) for i in range(40)] + [(6, None, "a")]
    docs = table(spark, rows)
    want = Counter({r.key: r.copies for r in p.mix_sources(docs, key_col="size").collect()})
    assert set(want) == set(range(len(rows)))
    got = p.mixing(spark, docs, str(tmp_path))
    assert got.columns == docs.columns
    assert Counter(r["size"] for r in got.collect()) == +want
    assert p.mixing(spark, docs.limit(0), str(tmp_path)).collect() == []


def test_whole_run(spark, tmp_path, monkeypatch):
    """Rows of the whole chain, and what each stage reads: the input, then what its predecessor wrote."""
    import zlib

    import numpy as np
    import pytest
    from tokenizers import Tokenizer

    tokens = Tokenizer.from_file(pytest.importorskip("public_tokenizers").path("word_bpe_49k.json"))
    a = words(30)
    clean = [(1, a, "a"), (None, a, "b"), (2, a + " " + words(31, 20), "a"), (None, words(32), "a"), (None, words(33), None), (4, words(34), "b"), (4, words(35), "b"), (5, words(36), "a"), (5, words(36), "a")]
    toxic = labelled(spark, tmp_path)
    table(spark, clean + [r for r in toxic if "stinker" in r[1]] + [(None, "plain stinker", "a"), (4, "junk stinker", "a")]).write.parquet(f"{tmp_path}/documents.parquet")
    read = []
    spied = lambda f: lambda s, docs, d: (read.append(docs.inputFiles()), f(s, docs, d))[1]
    monkeypatch.setattr(p, "STAGES", [(n, spied(f)) for n, f in p.STAGES])
    got = Counter((r.doc_id, r.ids_crc32) for r in p.run(spark, str(tmp_path)).collect())
    left = [r for i, r in enumerate(clean) if i not in (1, 8)]
    want = {(d, zlib.crc32(np.array(tokens.encode(t, add_special_tokens=False).ids + [1], "<u4").tobytes())) for (d, _, _), t in zip(left, cut(left))}
    assert set(got) <= want and len(want) == 7 and all(n <= 2 for n in got.values())
    assert all(str(tmp_path) in x for x in read[0]) and all("/written-" in x for files in read[1:] for x in files) and all(read)
    assert len({x.rpartition("/")[0] for files in read for x in files}) == len(p.STAGES)
