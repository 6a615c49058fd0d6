"""The trie against a plain dictionary of prefixes, whole and cut into small pieces."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from wattframe.llm import prefix_trie as trie
from wattframe.llm import queries as q

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth int, kind string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    own = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            print_ = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append(((turn is not None, turn or 0, print_), (role, text)))
    own = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    seq = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        seq[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = {}
    for c, s in seq.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
    children = {}
    for k in members:
        if k:
            children.setdefault(k[:-1], []).append(k)
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for k, m in members.items():
        add = (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] += k not in children
            saved[k[:d]] += add
    out = []
    for k, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(seq[c]) == len(k))))
        out.append((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(children.get(k, [])), leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in trie.prefix_trie(df).select(*COLUMNS).collect()), key=str)


def made(seed, convs, hot):
    draw = random.Random(seed)
    rows = []
    for i in range(convs):
        c = draw.choice([i, i * 7, -i])
        turns = ["one and the same", "first"] if draw.random() < hot else [f"t{draw.randint(0, 3)} word" for _ in range(draw.randint(1, 6))]
        rows += [(c, n if draw.random() < 0.9 else None, draw.choice(["user", "user", None, "assistant"]), t, 1, "x") for n, t in enumerate(turns)]
    return rows


CASES = [
    (1, 0, "user", "a b", 0, ""), (1, 1, "assistant", None, 0, ""), (1, 1, "assistant", "", 0, ""), (1, None, None, None, 0, ""), (None, 0, "user", "lost", 0, ""),
    (20, 0, "user", "a b", 0, ""), (20, 0, "user", "a b", 0, ""), (23, 0, "user", "z", 0, ""), (-3, 5, "us", "er", 0, ""), (-21, 5, "user", "", 0, ""),
    (0, 0, "user", "long " * 300_000, 0, ""), (0, 1, "assistant", "x", 0, ""), (7, 0, "user", "y", 0, ""), (2**40, 0, "user", "y", 0, ""),
]


def test_cases(spark):
    df = spark.createDataFrame(CASES, SCHEMA)
    assert got(df) == plain(CASES)
    assert trie.prefix_trie(df.limit(0)).collect() == []
    alone = [(13, 0, "user", "only", 0, "")]  # its first turns go, no base: a member of the root alone
    assert got(spark.createDataFrame(alone, SCHEMA)) == plain(alone)


@pytest.mark.parametrize("rows_of_piece, turns_of_task", [(1 << 15, 1 << 19), (7, 60), (1, 300), (40, 20)])
def test_random(spark, monkeypatch, rows_of_piece, turns_of_task):
    monkeypatch.setattr(trie, "TASK_TURNS", turns_of_task)
    rows = made(rows_of_piece, 400, 0.4)
    cut = rows_of_piece

    def pieces(batches):
        trie.PIECE_ROWS, trie.LIST_BYTES = cut, 100
        return original(batches)

    original = trie._pieces
    monkeypatch.setattr(trie, "_pieces", pieces)
    assert got(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_extents():
    draw = np.random.default_rng(1)
    for n in (1, 2, 3, 17, 64, 100):
        lcp = draw.integers(0, 5, n - 1)
        table = trie._sparse(lcp)
        row, depth = np.repeat(np.arange(n), 6), np.tile(np.arange(6), n)
        left, right = trie.extents(table, row, depth)
        for i, d, a, b in zip(row, depth, left, right):
            x = y = i
            while x > 0 and lcp[x - 1] >= d:
                x -= 1
            while y < n - 1 and lcp[y] >= d:
                y += 1
            assert (a, b) == (x, y + 1)
        values = draw.integers(0, 99, n)
        assert (trie._minimum(trie._sparse(values), left, right) == [values[a:b].min() for a, b in zip(left, right)]).all()


def test_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{sf}/conversations.parquet'")
    want = con.execute(f"select {', '.join(COLUMNS)} from ({trie.TRIE_SQL})").fetchall()
    df = q.op13_prefix_trie(spark, sf)
    assert sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str) == sorted(want, key=str)
    rows = [(*r, 0, "") for r in con.execute("select conv_id, turn, role, text from conversations").fetchall()]
    assert plain(rows) == sorted(want, key=str)
