"""Classes of near copies against all pairs of exact multiset overlaps."""

import random
import re
from collections import Counter, defaultdict

import numpy as np

from wattframe.llm.bag_minhash import as_set, bags, near_duplicates, signatures
from wattframe.llm.rolling import mix

SCHEMA = "doc_id bigint, text string, class int, f string"


def bag(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def brute(rows, bound=0.8):
    sets = [{(s, n) for s, c in bag(t).items() for n in range(c)} for _, t in rows]
    where = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            where[x].append(i)
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        common = Counter(j for x in s for j in where[x] if j < i)
        for j, n in common.items():
            if n >= bound * (len(s) + len(sets[j]) - n) - 1e-9:
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[root(i)].append(i)
    out = []
    for g in groups.values():
        ids = [rows[i][0] for i in g if rows[i][0] is not None]
        least = min(ids) if ids else None
        out += [(rows[i][0], least, rows[i][0] == least) for i in g]
    return out


def key(row):
    return tuple((x is None, x if x is not None else 0) for x in row)


def run(spark, rows):
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], SCHEMA)
    return sorted((tuple(r) for r in near_duplicates(df).collect()), key=key)


def test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in near_duplicates(docs).collect()) == sorted(brute(rows))


def test_cases(spark):
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(3))
    rows = [(1, None), (2, ""), (3, " \t"), (4, "one two"), (5, "one  two"), (6, "one"), (None, "one"), (None, None), (7, "a b a b a b " * 300), (8, "a b a b a b " * 290), (9, "a b a b a b " * 100)]
    base = [word() for _ in range(400)]
    for i in range(60):
        copy = list(base)
        for _ in range(r.randint(0, 25)):
            copy[r.randrange(400)] = word()
        rows.append((100 + i, " ".join(copy)))
    rows += [(200, " ".join(base)), (200, " ".join(base)), (300, " ".join(word() for _ in range(9000)))]
    assert run(spark, rows) == sorted(brute(rows), key=key)
    assert run(spark, []) == []


def test_signature_agrees_with_the_weighted_similarity():
    draw = np.random.default_rng(1)
    names = mix(np.arange(1, 401, dtype=np.uint64))
    a, b = draw.integers(0, 9, 400), draw.integers(0, 9, 400)
    b[:250] = a[:250]
    exact = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    text = np.repeat([0, 1], [a.sum(), b.sum()])
    shingle = np.concatenate([np.repeat(names, a), np.repeat(names, b)])
    sig = signatures(*bags(text, shingle), 2, 8192)
    assert abs((sig[0] == sig[1]).mean() - exact) < 0.03
    owner, items = as_set(text, shingle)
    one, two = set(items[owner == 0].tolist()), set(items[owner == 1].tolist())
    assert abs(len(one & two) / len(one | two) - exact) < 1e-12
