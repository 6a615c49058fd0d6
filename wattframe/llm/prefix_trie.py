"""Prefix trie of conversations by range minima over sorted common prefixes.

A conversation is the sequence of its turns' fingerprints (128 bits of role and text). Sequences are sorted over the
cluster; a trie node is then an interval of neighbours with a common prefix. Tasks take the sorted rows in pieces of
bounded size. In a piece a sparse table holds the minima of the common prefix lengths of neighbours, and every
candidate prefix (a row and a depth) searches the left and the right end of its interval by halving steps,
independently of all others; minima of conv_id come from a second table. Nodes ordered by left end and depth stand
in preorder, so sums over subtrees are differences of running sums.

An interval may go over the edge of a piece only if it is a prefix of the piece's first or last row. Those prefixes,
one chain for each of the two rows, leave the piece as partial rows and are summed up by prefix; each chain then
passes what its own nodes add on to their ancestors. Everything else is complete inside its piece.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattframe.llm.mixing import word_count
from wattframe.session import cut_lineage

#: Bytes of a turn's fingerprint; turns and rows of a piece at most (one longer conversation is a piece of its own).
PRINT, PIECE_TURNS, PIECE_ROWS = 16, 1 << 17, 1 << 15
#: Turns a task is planned for, bytes of one cell of a node's member list.
TASK_TURNS, LIST_BYTES = 1 << 19, 1 << 14
NONE = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"  # SHA-256 of nothing
OUT = "kind int, piece bigint, chain int, depth bigint, key binary, parent binary, owner boolean, conv_id bigint, parent_conv_id bigint, n bigint, children bigint, leaves bigint, saved bigint, words bigint, ends string, first bigint, list binary"
TYPES = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "string": pa.string()}
#: Rows: a complete node; a complete node whose parent is on a chain; a chain's node; part of a chain node's member list.
NODE, CHILD, CHAIN, LIST = 0, 1, 2, 3


def _sparse(values: np.ndarray) -> list[np.ndarray]:
    """Level k holds the minima of 2**k neighbours."""
    table = [values]
    while 2 * len(table[0]) >= 2 ** (len(table) + 1) and len(table[-1]) > 2 ** (len(table) - 1):
        half = 2 ** (len(table) - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))
    return table


def _minimum(table: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Minimum of [left, right), not empty."""
    level = np.frexp((right - left).astype(float))[1] - 1
    out = np.empty(len(left), table[0].dtype)
    for k in np.unique(level):
        own = level == k
        out[own] = np.minimum(table[k][left[own]], table[k][right[own] - 2**k])
    return out


def extents(table: list[np.ndarray], row: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows [left, right) around ``row`` whose common prefix with it is ``depth`` or more; ``table`` over the common
    prefixes of neighbours i and i + 1."""
    left, right = row.copy(), row.copy()
    for k in range(len(table) - 1, -1, -1):
        level, span = table[k], 2**k
        if not len(level):
            continue
        go = (right + span <= len(table[0])) & (level[np.minimum(right, len(level) - 1)] >= depth)
        right = np.where(go, right + span, right)
        go = (left >= span) & (level[np.clip(left - span, 0, len(level) - 1)] >= depth)
        left = np.where(go, left - span, left)
    return left, right + 1


def common_prefixes(prints: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """For neighbours i and i + 1, how many turns they share from the start on."""
    n = np.minimum(length[:-1], length[1:])
    total = int(n.sum())
    if not total:
        return n
    begin = np.cumsum(n) - n
    step = np.arange(total) - np.repeat(begin, n)
    a, b = np.repeat(first[:-1], n) + step, np.repeat(first[1:], n) + step
    differs = (prints["a"][a] != prints["a"][b]) | (prints["b"][a] != prints["b"][b])
    place = np.where(differs, step, np.iinfo(np.int64).max)
    out, some = n.copy(), n > 0
    out[some] = np.minimum(n[some], np.minimum.reduceat(place, begin[some]))
    return out


def _chain_keys(raw: bytes, turns: int) -> list[bytes]:
    """Fingerprints of every prefix of a row, the empty one first."""
    h, out = hashlib.blake2b(digest_size=PRINT), []
    for d in range(turns + 1):
        out.append(h.copy().digest())
        h.update(raw[PRINT * d : PRINT * (d + 1)])
    return out


def _lists(conv: np.ndarray, a: int, b: int) -> Iterator[tuple[int, bytes]]:
    step = LIST_BYTES // 20
    for at in range(a, b, step):
        some = conv[at : min(b, at + step)].tolist()
        yield some[0], ",".join(map(str, some)).encode()


def piece_rows(conv: np.ndarray, length: np.ndarray, raw: bytes, words: np.ndarray, piece: int) -> Iterator[pa.RecordBatch]:
    """``OUT`` rows of one piece: sorted rows with their conv_id, number of turns, fingerprints and words by turn."""
    rows = len(conv)
    prints = np.frombuffer(raw, np.dtype([("a", "<u8"), ("b", "<u8")]))
    first = np.cumsum(length) - length
    lcp = common_prefixes(prints, first, length)
    table, least = _sparse(lcp), _sparse(conv)
    # A prefix is a node of its own where the row before does not have it.
    before = np.append(-1, lcp)
    own = length - before
    row = np.repeat(np.arange(rows), own)
    offset = np.append(0, np.cumsum(own))
    depth = np.arange(len(row)) - np.repeat(offset[:-1], own) + np.repeat(before + 1, own)
    left, right = extents(table, row, depth)
    assert (left == row).all()
    n, low = right - left, _minimum(least, left, right)
    end = offset[right]  # preorder number behind the subtree
    inner = np.flatnonzero(depth > 0)
    above_row, _ = extents(table, row[inner], depth[inner] - 1)
    above = np.full(len(row), -1)
    above[inner] = offset[above_row] + depth[inner] - 1 - (before[above_row] + 1)
    children = np.bincount(above[inner], minlength=len(row))
    said = np.zeros(len(row), np.int64)
    said[inner] = words[first[row[inner]] + depth[inner] - 1]
    # Rows that end at a node: equal rows, which stand first in its interval.
    new = np.append(True, (lcp < length[1:]) | (length[:-1] != length[1:]))
    run = np.append(np.flatnonzero(new), rows)
    ends_to = np.where(length[left] == depth, run[np.searchsorted(run, left, "right")], left)
    last, _ = extents(table, np.full(int(length[-1]) + 1, rows - 1), np.arange(length[-1] + 1))
    chains = [np.arange(length[0] + 1), offset[last] + np.arange(length[-1] + 1) - (before[last] + 1)]
    edge = np.zeros(len(row), bool)
    edge[chains[0]] = edge[chains[1]] = True
    leaf, saved = ((children == 0) & ~edge).astype(np.int64), np.where(edge, 0, (n - 1) * said)
    leaves_to, saved_to = np.append(0, np.cumsum(leaf)), np.append(0, np.cumsum(saved))
    leaves, saved = leaves_to[end] - leaves_to[:-1], saved_to[end] - saved_to[:-1]

    def batch(kind: int, size: int, **columns) -> pa.RecordBatch:
        cells = {"kind": np.full(size, kind, np.int32), "piece": np.full(size, piece)} | columns
        arrays = []
        for name, kind_ in (x.split() for x in OUT.split(", ")):
            values = cells.get(name)
            arrays.append(pa.nulls(size, TYPES[kind_]) if values is None else pa.array(values, TYPES[kind_]))
        return pa.record_batch(arrays, names=[x.split()[0] for x in OUT.split(", ")])

    inside = np.flatnonzero(~edge)
    digest = [hashlib.sha256(",".join(map(str, conv[a:b].tolist())).encode()).hexdigest() if b > a else NONE for a, b in zip(left[inside].tolist(), ends_to[inside].tolist())]
    hangs = edge[above[inside]]
    for kind, which in ((NODE, ~hangs), (CHILD, hangs)):
        some = inside[which]
        yield batch(
            kind, len(some), depth=depth[some], conv_id=low[some], parent_conv_id=None if kind == CHILD else low[above[some]], n=n[some], children=children[some],
            leaves=leaves[some], saved=saved[some], ends=[d for d, w in zip(digest, which) if w],
            chain=None if kind == NODE else np.where(np.isin(above[some], chains[0]), 0, 1).astype(np.int32),
        )
    # Children on a chain are counted once all pieces have met.
    inner_children = np.bincount(above[inside], minlength=len(row))
    told = np.zeros(len(row), bool)
    for c, (nodes, at) in enumerate(zip(chains, (0, rows - 1))):
        keys = _chain_keys(raw[PRINT * first[at] : PRINT * (first[at] + length[at])], int(length[at]))
        once = ~told[nodes]
        told[nodes] = True
        yield batch(
            CHAIN, len(nodes), chain=np.full(len(nodes), c, np.int32), depth=depth[nodes], key=keys, parent=[None, *keys[:-1]], owner=once, conv_id=low[nodes],
            n=n[nodes], children=inner_children[nodes], leaves=leaves[nodes], saved=saved[nodes], words=said[nodes],
        )
        for i in np.flatnonzero(once & (ends_to[nodes] > left[nodes])).tolist():
            lists = list(_lists(conv, int(left[nodes[i]]), int(ends_to[nodes[i]])))
            yield batch(LIST, len(lists), key=[keys[i]] * len(lists), first=[x for x, _ in lists], list=[x for _, x in lists])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut a task's sorted rows into pieces."""
    piece = TaskContext.get().partitionId() << 32
    conv, length, raw, words, rows, turns = [], [], [], [], 0, 0

    def told():
        return piece_rows(np.concatenate(conv), np.concatenate(length), b"".join(raw), np.concatenate(words), piece)

    for batch in batches:
        at = 0
        sizes = np.asarray(batch.column(2)).astype(np.int64)
        while at < len(batch):
            room = np.searchsorted(np.cumsum(sizes[at:]), PIECE_TURNS - turns, "right")
            take = int(max(not rows, min(room, PIECE_ROWS - rows, len(batch) - at)))
            if not take:
                yield from told()
                piece += 1
                conv, length, raw, words, rows, turns = [], [], [], [], 0, 0
                continue
            some = batch.slice(at, take)
            conv.append(np.asarray(some.column(0)).astype(np.int64))
            length.append(sizes[at : at + take])
            raw += [x.as_buffer().to_pybytes() for x in some.column(1)]
            words.append(np.asarray(some.column(3).flatten()).astype(np.int64))
            rows, turns, at = rows + take, turns + int(length[-1].sum()), at + take
    if rows:
        yield from told()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each key's member list, whose parts come in order; holds one part at a time."""
    key, h, out = None, None, []

    def done() -> pa.RecordBatch:
        rows = pa.record_batch([pa.array([k for k, _ in out], pa.binary()), pa.array([d for _, d in out], pa.string())], names=["list_key", "ends"])
        out.clear()
        return rows

    for batch in batches:
        for k, part in zip(batch.column(0), batch.column(1)):
            k = k.as_py()
            if k != key:
                if h is not None:
                    out.append((key, h.hexdigest()))
                key, h = k, hashlib.sha256()
            else:
                h.update(b",")
            h.update(part.as_buffer())
        yield done()
    if h is not None:
        out.append((key, h.hexdigest()))
        yield done()


def _text(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def conversation_sequences(turns: DataFrame, every: int = 20, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, its turns' fingerprints in one binary cell, their number and their words, after the first turns are taken over.

    Conversation c starts with the first crc32(c) % 4 turns of conversation c - c % ``every``.
    """
    # The role's length parts role from text.
    said = F.concat(F.length(_text(role_col)).cast("string"), F.lit(":"), _text(role_col), _text(text_col))
    cells = F.struct(F.col(turn_col).cast("bigint").alias("turn"), F.substring(F.sha2(said, 256), 1, 2 * PRINT).alias("print"), word_count(F.col(text_col)).alias("words"))
    rows = turns.where(F.col(conv_col).isNotNull()).select(F.col(conv_col).cast("bigint").alias("conv_id"), cells.alias("cell"))
    own = cut_lineage(rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("cell")).alias("cells")))
    # At most a few turns of every twentieth conversation travel to the others.
    bases = own.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base_id"), F.slice("cells", 1, 3).alias("base"))
    met = own.withColumn("h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")).join(
        bases, F.col("conv_id") - F.col("conv_id") % every == F.col("base_id"), "left"
    )
    taken = F.slice(F.coalesce("base", F.slice("cells", 1, 0)), F.lit(1), F.col("h"))
    rest = F.slice("cells", F.col("h") + 1, F.greatest(F.size("cells") - F.col("h"), F.lit(0)))
    cells = met.select("conv_id", F.concat(taken, rest).alias("cells"))
    return cells.select("conv_id", F.unhex(F.array_join("cells.print", "")).alias("prints"), F.size("cells").alias("turns"), F.col("cells.words").alias("words"))


def prefix_trie(
    turns: DataFrame, every: int = 20, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations (see ``conversation_sequences``).

    conv_id (smallest member), depth, parent_conv_id (the parent's conv_id, null for the root), n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256. Turns of one conversation stand in the order of turn, null first; equal ones in
    that of a fingerprint of role and text. Null roles and texts are empty. Rows without a conv_id belong to no
    conversation and take no part. A conversation left without turns ends at the root. An empty table gives an empty
    result; other columns are ignored. Texts of any length travel as fingerprints; a conversation's fingerprints (16
    bytes a turn) must fit into one cell. The member list of a node is hashed by one task, streaming, as SHA-256 asks.
    """
    sequences = cut_lineage(conversation_sequences(turns, every, conv_col, turn_col, role_col, text_col))
    total = sequences.agg(F.sum("turns")).first()[0] or 0
    order = ["prints", "conv_id"]
    dealt = sequences.repartitionByRange(max(1, -(-int(total) // TASK_TURNS)), *order).sortWithinPartitions(*order)
    rows = cut_lineage(dealt.select("conv_id", "prints", "turns", "words").mapInArrow(_pieces, OUT))

    chain = rows.where(f"kind = {CHAIN}").select("piece", "chain", "depth", "key", "parent", "owner", "conv_id", "n", "children", "leaves", "saved", "words")
    told = lambda c: F.sum(F.when(F.col("owner"), F.col(c)).otherwise(0)).alias(c)
    edge = chain.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("parent").alias("parent"), F.max("words").alias("words"),
        told("n"), told("children"), told("leaves"), told("saved"), F.min(F.struct("piece", "chain")).alias("home"),
    )
    born = edge.groupBy("parent").agg(F.count(F.lit(1)).alias("born")).withColumnRenamed("parent", "of")
    edge = edge.join(born, F.col("key") == F.col("of"), "left").withColumn("children", F.col("children") + F.coalesce("born", F.lit(0))).drop("of", "born")
    edge = cut_lineage(edge)
    # A chain passes what its own nodes add on to the nodes above them; every node belongs to one chain.
    whole = edge.select("key", F.col("conv_id").alias("whole_id"), "home", (F.col("children") == 0).cast("bigint").alias("leaf"), ((F.col("n") - 1) * F.col("words")).alias("cost"))
    links = cut_lineage(chain.select("piece", "chain", "depth", "key").join(whole, "key"))
    at_home = (F.col("home.piece") == F.col("piece")) & (F.col("home.chain") == F.col("chain"))
    below = Window.partitionBy("piece", "chain").orderBy(F.desc("depth"))
    passed = links.select("key", F.sum(F.when(at_home, F.col("leaf")).otherwise(0)).over(below).alias("leaf"), F.sum(F.when(at_home, F.col("cost")).otherwise(0)).over(below).alias("cost"))
    passed = passed.groupBy(F.col("key").alias("sum_key")).agg(F.sum("leaf").alias("leaf"), F.sum("cost").alias("cost"))
    lists = rows.where(f"kind = {LIST}").select("key", "list", "first")
    lists = lists.repartition("key").sortWithinPartitions("key", "first").select("key", "list").mapInArrow(_digests, "list_key binary, ends string")
    parents = edge.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    edges = (
        edge.join(passed, F.col("key") == F.col("sum_key")).join(lists, F.col("key") == F.col("list_key"), "left").join(parents, "parent", "left")
        .select("conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"), F.col("children").alias("n_children"), (F.col("leaves") + F.col("leaf")).alias("n_leaves"),
                (F.col("saved") + F.col("cost")).alias("saved_tokens"), F.coalesce("ends", F.lit(NONE)).alias("ends_sha256"))
    )
    named = dict(n="n_convs", children="n_children", leaves="n_leaves", saved="saved_tokens", ends="ends_sha256")
    inside = rows.withColumnsRenamed(named)
    # A piece knows the place of such a parent on its own chains, so the children of one parent meet it piece by piece.
    places = links.select(F.col("piece").alias("at"), F.col("chain").alias("on"), F.col("depth").alias("over"), F.col("whole_id"))
    hanging = inside.where(f"kind = {CHILD}").join(places, (F.col("piece") == F.col("at")) & (F.col("chain") == F.col("on")) & (F.col("depth") - 1 == F.col("over")))
    hanging = hanging.drop("parent_conv_id").withColumnRenamed("whole_id", "parent_conv_id")
    return inside.where(f"kind = {NODE}").select(*out).union(hanging.select(*out)).union(edges.select(*out))


TRIE_SQL = r"""
WITH tab AS (SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x::UBIGINT, list_transform(range(8), lambda k: k::UBIGINT)),
    lambda v, k: xor(v >> 1, CASE WHEN v % 2 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END))) AS crc),
t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
u AS (SELECT *, len(role)::VARCHAR || ':' || role || text AS said, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))::BIGINT AS words FROM t),
o AS (SELECT conv_id, list({p: substr(sha256(said), 1, 32), w: words} ORDER BY turn NULLS FIRST, sha256(said), words) AS cells FROM u GROUP BY conv_id),
h AS (SELECT o.*, (xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ascii(ch)::UBIGINT)),
    lambda v, b: xor(v >> 8, crc[(xor(v, b) % 256 + 1)::INT])), 4294967295::UBIGINT) % 4)::INT AS h FROM o, tab),
r AS (SELECT h.conv_id, list_concat(coalesce(b.cells[1:h], []), h.cells[h + 1:]) AS cells FROM h LEFT JOIN o b ON b.conv_id = h.conv_id - h.conv_id % 20),
x AS (SELECT conv_id, cells, d, list_transform(cells[1:d], lambda c: c.p) AS k, CASE WHEN d > 0 THEN cells[d].w ELSE 0 END AS w, len(cells) = d AS ends
    FROM r, unnest(range(len(cells) + 1)) AS s(d)),
n AS (SELECT k, d, min(conv_id) AS conv_id, count(*) AS n, max(w) AS w,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256 FROM x GROUP BY k, d),
c AS (SELECT k[1:d - 1] AS k, d - 1 AS d, count(*) AS children FROM n WHERE d > 0 GROUP BY 1, 2),
f AS (SELECT n.*, coalesce(children, 0) AS children FROM n LEFT JOIN c ON c.k = n.k AND c.d = n.d),
up AS (SELECT f.k[1:a] AS k, a AS d, sum((children = 0)::INT) AS leaves, sum((n - 1) * w) AS saved FROM f, unnest(range(f.d + 1)) AS s(a) GROUP BY 1, 2)
SELECT f.conv_id, f.d::BIGINT AS depth, p.conv_id AS parent_conv_id, f.n::BIGINT AS n_convs, f.children::BIGINT AS n_children, up.leaves::BIGINT AS n_leaves,
    up.saved::BIGINT AS saved_tokens, f.ends_sha256
FROM f JOIN up ON up.k = f.k AND up.d = f.d LEFT JOIN n p ON f.d > 0 AND p.d = f.d - 1 AND p.k = f.k[1:f.d - 1]
"""
