"""Repair of conversation structure by bidirectional Dijkstra over the edit lattice.

A conversation is in order when its role initials read ``(s?(ua)+)?``. The lattice's nodes are (rows read, state of
that pattern); its edges keep a row, give it another role, delete it, or insert an empty turn. A heap from the start and
a heap from the ends settle nodes by cost. Once their smallest costs add up to more than the cheapest crossing
found, every cheapest path has settled nodes on both sides and a crossing between them; of all equal-cost
crossings the one with the least audit is taken, letter by letter, without writing the audits out.

Only a byte or two for each row reach the lattice: texts travel once, at the end, to be hashed in order.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattframe.session import cut_lineage

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: States: nothing yet, after system, after user, after assistant. The next turn of user or assistant leads to FOLLOWS.
START, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = (USER, USER, ASSISTANT, USER)
LEADS = {USER: (START, SYSTEM, ASSISTANT), ASSISTANT: (USER,), SYSTEM: (), START: ()}
ENDS = (START, ASSISTANT)
#: Kinds of rows: fine, must go (blank or duplicate), truncated.
FINE, MUST_GO, CUT = range(3)
FAR = 1 << 60


def _kept(initial: str, state: int) -> int:
    """State behind a kept row, -1 where it may not stand."""
    if initial == "s":
        return SYSTEM if state == START else -1
    to = FOLLOWS[state]
    return to if initial == ("u" if to == USER else "a") else -1


def _edges(initials: str, kinds: bytes, node: int) -> Iterator[tuple[str, int, int]]:
    """(audit letter, cost, node) of every edge out of a node; nodes are 4 * rows read + state."""
    i, state = divmod(node, 4)
    if i < len(kinds):
        yield "D", DELETE, node + 4
        if kinds[i] != MUST_GO:
            more = TRUNCATED if kinds[i] == CUT else 0
            to = _kept(initials[i], state)
            if to >= 0:
                yield "K", KEEP + more, 4 * (i + 1) + to
            yield "R", REROLE + more, 4 * (i + 1) + FOLLOWS[state]
    yield "I", INSERT, 4 * i + FOLLOWS[state]


def _edges_into(initials: str, kinds: bytes, node: int) -> Iterator[tuple[int, int]]:
    """(cost, node) of every edge into a node."""
    i, state = divmod(node, 4)
    for before in LEADS[state]:
        yield INSERT, 4 * i + before
    if i:
        yield DELETE, node - 4
        kind = kinds[i - 1]
        if kind != MUST_GO:
            more, initial = TRUNCATED if kind == CUT else 0, initials[i - 1]
            for before in LEADS[state]:
                yield REROLE + more, 4 * (i - 1) + before
                if _kept(initial, before) == state:
                    yield KEEP + more, 4 * (i - 1) + before
            if state == SYSTEM and initial == "s":
                yield KEEP + more, 4 * (i - 1) + START


def cheapest_edits(initials: str, kinds: bytes) -> tuple[int, str]:
    """Least cost and, of the audits at that cost, the one least in ASCII; an initial is one character for each row."""
    n = len(kinds)
    forward, back = [FAR] * (4 * n + 4), [FAR] * (4 * n + 4)
    settled, behind = bytearray(4 * n + 4), bytearray(4 * n + 4)
    forward[START] = 0
    ahead, behind_heap = [(0, START)], []
    for state in ENDS:
        back[4 * n + state] = 0
        heapq.heappush(behind_heap, (0, 4 * n + state))
    best = FAR
    while ahead and behind_heap and ahead[0][0] + behind_heap[0][0] <= best:
        if ahead[0][0] <= behind_heap[0][0]:
            cost, node = heapq.heappop(ahead)
            if settled[node]:
                continue
            settled[node] = 1
            best = min(best, cost + back[node])
            for _, w, to in _edges(initials, kinds, node):
                if cost + w < forward[to]:
                    forward[to] = cost + w
                    heapq.heappush(ahead, (cost + w, to))
        else:
            cost, node = heapq.heappop(behind_heap)
            if behind[node]:
                continue
            behind[node] = 1
            best = min(best, cost + forward[node])
            for w, to in _edges_into(initials, kinds, node):
                if cost + w < back[to]:
                    back[to] = cost + w
                    heapq.heappush(behind_heap, (cost + w, to))
    # An equal-cost crossing is a node, or an edge between two nodes, whose labels from both sides add up to the best cost.
    # Nodes settled ahead that lead to one at no more than that are marked, backward from the crossings.
    leads = bytearray(4 * n + 4)
    todo = []
    for node in range(4 * n + 4):
        if settled[node] and (forward[node] + back[node] == best or any(forward[node] + w + back[to] == best for _, w, to in _edges(initials, kinds, node))):
            leads[node] = 1
            todo.append(node)
    while todo:
        node = todo.pop()
        for w, before in _edges_into(initials, kinds, node):
            if settled[before] and not leads[before] and forward[before] + w == forward[node]:
                leads[before] = 1
                todo.append(before)
    # Equal-cost audits of one node are never prefixes of each other, so letters decide from the start on.
    audit, node, spent = [], START, 0
    while node < 4 * n or node % 4 not in ENDS or spent < best:
        for letter, w, to in sorted(_edges(initials, kinds, node)):
            if spent + w + back[to] == best or (leads[to] and spent + w == forward[to]):
                audit.append(letter)
                node, spent = to, spent + w
                break
        else:
            raise AssertionError("no way on")
    return best, "".join(audit)


ROW = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


class _Conversation:
    """What the lattice and the counts need of one conversation's rows, in order."""

    def __init__(self, conv):
        self.conv, self.parts = conv, []

    def add(self, batch: pa.RecordBatch) -> None:
        there = batch.filter(batch.column("here"))
        if len(there):
            self.parts.append(there)

    def row(self) -> tuple:
        if not self.parts:
            return self.conv, 0, 0, 0, 0, 0, 0, ""
        table = pa.Table.from_batches(self.parts).combine_chunks()
        turn = table.column("turn").drop_null()
        turns = np.unique(np.asarray(turn, np.int64)) if len(turn) else np.zeros(0, np.int64)
        gaps = int(turns[-1]) - int(turns[0]) + 1 - len(turns) if len(turns) else 0
        said = np.frombuffer(b"".join(x.as_py() for x in table.column("said")), np.dtype([("a", "<u8"), ("b", "<u8")]))
        _, first, which = np.unique(said, return_index=True, return_inverse=True)
        again = first[which] < np.arange(len(said))
        blank, cut = np.asarray(table.column("blank")), np.asarray(table.column("cut"))
        duplicate = ~blank & again
        truncated = ~blank & ~again & cut
        kinds = np.where(blank | duplicate, MUST_GO, np.where(truncated, CUT, FINE)).astype(np.uint8).tobytes()
        initials = "".join(x or " " for x in table.column("initial").to_pylist())
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = cheapest_edits(initials, kinds)
        return self.conv, gaps, int(blank.sum()), int(duplicate.sum()), int(truncated.sum()), illegal, cost, audit


def _groups(batch: pa.RecordBatch, column: int) -> Iterator[tuple[object, int, int]]:
    """Runs of equal keys of a sorted batch: key, from, to."""
    keys = batch.column(column).to_pylist()
    at = 0
    for i in range(1, len(keys) + 1):
        if i == len(keys) or keys[i] != keys[at]:
            yield keys[at], at, i
            at = i


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string() if "string" in x else pa.int64() for x in ROW.split(", ")]
    return pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=[x.split()[0] for x in ROW.split(", ")])


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, done = None, []
    for batch in batches:
        for conv, a, b in _groups(batch, 0):
            if now is None or now.conv != conv:
                if now is not None:
                    done.append(now.row())
                now = _Conversation(conv)
            now.add(batch.slice(a, b - a))
        if len(done) >= 1000:
            yield _rows(done)
            done = []
    if now is not None:
        done.append(now.row())
    yield _rows(done)


TURN = "conv_id bigint, place bigint, edit string, role string, text string"
#: Bytes of repaired text that leave together.
OUT_BYTES = 1 << 20


class _Writer:
    """Applies an audit to a conversation's rows as they come."""

    def __init__(self, conv, audit: str, out: list):
        self.conv, self.audit, self.out = conv, audit, out
        self.at, self.place, self.state = 0, 0, START

    def write(self, edit: str, role: str, text: str) -> None:
        self.out.append((self.conv, self.place, edit, role, text))
        self.place += 1

    def lead_on(self) -> str:
        self.state = FOLLOWS[self.state]
        return "user" if self.state == USER else "assistant"

    def inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            self.write("Insert", self.lead_on(), "")

    def read(self, role: str, text: str) -> None:
        self.inserts()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "R":
            self.write("Rerole", self.lead_on(), text)
        elif letter == "K":
            self.state = SYSTEM if role[:1] == "s" else FOLLOWS[self.state]
            self.write("Keep", role, text)


def _turns(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    return pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=[x.split()[0] for x in TURN.split(", ")])


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``TURN`` rows of each conversation: its audit comes first, then its rows, in order."""
    now, out, held = None, [], 0
    for batch in batches:
        for conv, audit, role, text in zip(*[batch.column(i) for i in range(4)]):
            if audit.is_valid:
                if now is not None:
                    now.inserts()
                now = _Writer(conv.as_py(), audit.as_py(), out)
            else:
                now.read(role.as_py(), text.as_py())
                held += text.as_buffer().size
            if held > OUT_BYTES or len(out) > 10_000:
                yield _turns(out)
                out.clear()
                held = 0
    if now is not None:
        now.inserts()
    yield _turns(out)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's ``role:text`` lines, which come in order."""
    now, h, out = (), None, []
    for batch in batches:
        for conv, role, text in zip(*[batch.column(i) for i in (0, 3, 4)]):
            if (conv.as_py(),) != now:
                if h is not None:
                    out.append((now[0], h.hexdigest()))
                now, h = (conv.as_py(),), hashlib.sha256()
            else:
                h.update(b"\n")
            h.update(role.as_buffer())
            h.update(b":")
            h.update(text.as_buffer())
        if len(out) >= 1000:
            yield _hashes(out)
            out = []
    if h is not None:
        out.append((now[0], h.hexdigest()))
    yield _hashes(out)


def _hashes(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([c for c, _ in rows], pa.int64()), pa.array([d for _, d in rows], pa.string())], names=["id", "repaired_sha256"])


def damaged(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, text after damage, and ``here``: false on a row that is dropped (kept so that its conversation is known).

    crc32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties the text, 2 takes out its ``.!?``, 3 repeats the row,
    4 makes it the user's. Nulls read as one space there, and in role and text.
    """
    blank = lambda c, kind="string": F.coalesce(c.cast(kind), F.lit(" "))
    rows = turns.select(F.col(conv_col).cast("bigint").alias("conv_id"), F.col(turn_col).cast("bigint").alias("turn"), blank(F.col(role_col)).alias("role"), blank(F.col(text_col)).alias("text"))
    rows = rows.withColumn("fate", F.crc32(F.concat(blank(F.col("conv_id")), F.lit(":"), blank(F.col("turn"))).cast("binary")) % 20)
    fate = lambda k: F.col("fate") == k
    text = F.when(fate(1), "").when(fate(2), F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(fate(4), "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (~fate(0)).alias("here"), "fate")
    return rows.withColumn("copy", F.explode(F.when(fate(3), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("fate")


#: White space of the contract.
SPACE = r"\x20\x09-\x0D"


def _print(role: Column, text: Column) -> Column:
    return F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))


def _sorted(df: DataFrame, *by) -> DataFrame:
    return df.repartition("conv_id").sortWithinPartitions(*by)


def _keys() -> tuple[Column, ...]:
    return F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("said")


def conversation_faults(rows: DataFrame) -> DataFrame:
    """``ROW``: gaps, faults, cost and audit of every conversation in ``rows`` (see ``conversation_repair``)."""
    last = F.regexp_extract("text", rf"([^{SPACE}])[{SPACE}]*\z", 1)
    narrow = rows.select(
        "conv_id", "turn", F.substring("role", 1, 1).alias("initial"), _print(F.col("role"), F.col("text")).alias("said"), (last == "").alias("blank"),
        (~last.isin(".", "!", "?")).alias("cut"), "here", "role",
    )
    return _sorted(narrow, *_keys()).drop("role").mapInArrow(_judged, ROW)


def repaired_turns(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``TURN``: the turns of every repaired conversation, numbered from 0, in the order they stand in a partition.

    ``found`` holds conv_id and audit, as ``conversation_faults`` gives them for the same rows.
    """
    said = _print(F.col("role"), F.col("text"))
    audits = found.select("conv_id", "audit", F.lit("").alias("role"), F.lit("").alias("text"), F.lit(None).cast("bigint").alias("turn"), F.lit(None).cast("binary").alias("said"), F.lit(0).alias("kind"))
    texts = rows.where("here").select("conv_id", F.lit(None).cast("string").alias("audit"), "role", "text", "turn", said.alias("said"), F.lit(1).alias("kind"))
    both = _sorted(audits.union(texts), F.col("conv_id"), F.col("kind"), *_keys()[1:])
    return both.select("conv_id", "audit", "role", "text").mapInArrow(_repaired, TURN)


def conversation_repair(rows: DataFrame) -> DataFrame:
    """Faults, cheapest edits and the repaired text's hash of every conversation in ``rows``.

    ``rows``: conv_id, turn, role, text and here (false: the row only names its conversation), as ``damaged`` gives them;
    no nulls in role and text. Returns conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.
    Rows of a conversation stand in the order of turn, null first; of one turn in that of role, then of a fingerprint. Rows
    with a null conv_id are one conversation. A conversation without rows has zeros, an empty audit and the hash of nothing.
    A role with another initial than s, u or a can only go or get a new one. An empty table gives an empty result; other
    columns are ignored. A conversation is read by one task: its lattice takes some 200 bytes a row; its texts are streamed.
    """
    found = cut_lineage(conversation_faults(rows))
    hashes = repaired_turns(rows, found).mapInArrow(_hashed, "id bigint, repaired_sha256 string")
    met = found.join(hashes, F.col("conv_id").eqNullSafe(F.col("id")), "left")
    return met.withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256))).drop("id")


REPAIR_SQL = r"""
WITH RECURSIVE tab AS (SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x::UBIGINT, list_transform(range(8), lambda k: k::UBIGINT)),
    lambda v, k: xor(v >> 1, CASE WHEN v % 2 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END))) AS crc),
t AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    (xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
        lambda ch: ascii(ch)::UBIGINT)), lambda v, b: xor(v >> 8, crc[(xor(v, b) % 256 + 1)::INT])), 4294967295::UBIGINT) % 20)::INT AS fate FROM conversations, tab),
d AS (SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM t, unnest(range(CASE fate WHEN 3 THEN 2 ELSE 1 END)) AS c(k) WHERE fate <> 0),
o AS (SELECT *, row_number() OVER w AS i, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS tail, lead(role[1]) OVER w AS next_initial
    FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(len(role)::VARCHAR || ':' || role || text))),
p AS (SELECT *, tail = '' AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again FROM o),
f AS (SELECT *, NOT blank AND again AS duplicate, NOT blank AND NOT again AND tail NOT IN ('.', '!', '?') AS truncated FROM p),
s AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, sum(blank::INT)::BIGINT AS blank, sum(duplicate::INT)::BIGINT AS duplicate,
    sum(truncated::INT)::BIGINT AS truncated, sum((next_initial IS NOT NULL AND role[1] || next_initial NOT IN ('su', 'ua', 'au'))::INT)::BIGINT AS illegal,
    list({r: role, x: text, go: blank OR duplicate, m: CASE WHEN truncated THEN 5 ELSE 0 END} ORDER BY i) AS cells, count(*) AS n FROM f GROUP BY conv_id),
-- Cheapest (cost, audit, text) by state, row by row; an insert leads on inside a row. A cost of 1000000000 or more: no way.
w AS (SELECT conv_id, cells, n, 0::BIGINT AS i, {c: 0::BIGINT, a: '', t: ''} AS z, {c: 1000000000::BIGINT, a: '', t: ''} AS s,
        {c: 5::BIGINT, a: 'I', t: chr(10) || 'user:'} AS u, {c: 10::BIGINT, a: 'II', t: chr(10) || 'user:' || chr(10) || 'assistant:'} AS v FROM s
    UNION ALL
    SELECT conv_id, cells, n, i, z, s, u, list_min([v, {c: u.c + 5, a: u.a || 'I', t: u.t || chr(10) || 'assistant:'}]) AS v FROM (
        SELECT conv_id, cells, n, i, z, s, list_min([u, {c: z.c + 5, a: z.a || 'I', t: z.t || chr(10) || 'user:'}, {c: s.c + 5, a: s.a || 'I', t: s.t || chr(10) || 'user:'},
            {c: v.c + 5, a: v.a || 'I', t: v.t || chr(10) || 'user:'}]) AS u, v FROM (
        SELECT conv_id, cells, n, i + 1 AS i, {c: z.c + 2, a: z.a || 'D', t: z.t} AS z,
            list_min([{c: s.c + 2, a: s.a || 'D', t: s.t}, {c: z.c + k.m + CASE WHEN NOT k.go AND k.r[1] = 's' THEN 0 ELSE 1000000000 END, a: z.a || 'K', t: z.t || chr(10) || k.r || ':' || k.x}]) AS s,
            list_min([{c: u.c + 2, a: u.a || 'D', t: u.t}] || list_transform([z, s, v], lambda b: {c: b.c + k.m + CASE WHEN NOT k.go AND k.r[1] = 'u' THEN 0 ELSE 1000000000 END, a: b.a || 'K', t: b.t || chr(10) || k.r || ':' || k.x})
                || list_transform([z, s, v], lambda b: {c: b.c + k.m + CASE WHEN k.go THEN 1000000000 ELSE 1 END, a: b.a || 'R', t: b.t || chr(10) || 'user:' || k.x})) AS u,
            list_min([{c: v.c + 2, a: v.a || 'D', t: v.t}, {c: u.c + k.m + CASE WHEN NOT k.go AND k.r[1] = 'a' THEN 0 ELSE 1000000000 END, a: u.a || 'K', t: u.t || chr(10) || k.r || ':' || k.x},
                {c: u.c + k.m + CASE WHEN k.go THEN 1000000000 ELSE 1 END, a: u.a || 'R', t: u.t || chr(10) || 'assistant:' || k.x}]) AS v
        FROM (SELECT *, cells[i + 1] AS k FROM w WHERE i < n)))),
b AS (SELECT conv_id, list_min([z, v]) AS b FROM w WHERE i = n)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
    coalesce(b.c, 0)::BIGINT AS cost, coalesce(b.a, '') AS audit, sha256(coalesce(substr(b.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM c.conv_id
"""
