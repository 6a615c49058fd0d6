"""Cheapest audits against all edit sequences, whole conversations against plain Python, the query against SQL."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

import duckdb

from wattframe.llm import queries as q
from wattframe.llm.conversation_repair import CUT, FINE, MUST_GO, cheapest_edits, conversation_faults, conversation_repair, damaged, repaired_turns

LEGAL = re.compile(r"(s?(ua)+)?")
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def all_audits(initials, kinds):
    """Plain uniform-cost search over audits themselves: cost first, then the audit."""
    todo = [(0, "", 0, "")]
    best = None
    found = []
    while todo:
        cost, audit, i, roles = heapq.heappop(todo)
        if best is not None and cost > best:
            break
        if i == len(kinds) and LEGAL.fullmatch(roles):
            best = cost
            found.append(audit)
        if len(roles) > len(kinds) + 3:
            continue
        for r in "ua":
            if LEGAL.fullmatch(roles + r) or LEGAL.fullmatch(roles + r + "a"):
                heapq.heappush(todo, (cost + 5, audit + "I", i, roles + r))
        if i < len(kinds):
            heapq.heappush(todo, (cost + 2, audit + "D", i + 1, roles))
            if kinds[i] != MUST_GO:
                for edit, w, r in (("K", 0, initials[i]), ("R", 1, "u"), ("R", 1, "a")):
                    if any(LEGAL.fullmatch(roles + r + tail) for tail in ("", "a", "ua")):
                        heapq.heappush(todo, (cost + w + 5 * (kinds[i] == CUT), audit + edit, i + 1, roles + r))
    return best, min(found)


def test_cheapest_edits():
    for n in range(4):
        for initials in itertools.product("suax", repeat=n):
            for kinds in itertools.product((FINE, MUST_GO, CUT), repeat=n):
                assert cheapest_edits("".join(initials), bytes(kinds)) == all_audits(initials, kinds), (initials, kinds)
    draw = random.Random(2)
    for _ in range(400):
        n = draw.randint(4, 8)
        initials, kinds = draw.choices("suaaux", k=n), draw.choices((FINE, FINE, FINE, CUT, MUST_GO), k=n)
        assert cheapest_edits("".join(initials), bytes(kinds)) == all_audits(initials, kinds), (initials, kinds)
    cost, audit = cheapest_edits("ua" * 20_000, bytes(40_000))
    assert (cost, audit) == (0, "K" * 40_000)
    cost, audit = cheapest_edits("u" * 20_001, bytes(20_001))
    assert cost == 10_002 and len(audit) == 20_001


def plain(rows):
    convs = {}
    for c, turn, role, text, *_ in rows:
        mine = convs.setdefault(c, [])
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        if fate:
            text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
            role = "user" if fate == 4 else role
            key = (turn is not None, turn or 0, role.encode(), hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest())
            mine += [(key, turn, role, text)] * (2 if fate == 3 else 1)
    out = []
    for c, mine in convs.items():
        mine.sort(key=lambda r: r[0])
        turns = {t for _, t, _, _ in mine if t is not None}
        kinds, counts, seen = [], [0, 0, 0], set()
        for _, _, role, text in mine:
            tail = re.search(r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\Z", text)
            fault = 0 if not tail else 1 if (role, text) in seen else 2 if tail[1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            kinds.append(FINE if fault is None else CUT if fault == 2 else MUST_GO)
        initials = [role[:1] or " " for _, _, role, _ in mine]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = all_audits(initials, kinds)
        lines, roles, i = [], "", 0
        for letter in audit:
            follows = "a" if roles[-1:] == "u" else "u"
            if letter != "I":
                role, text = mine[i][2:]
                i += 1
            if letter == "I":
                role, text = {"u": "user", "a": "assistant"}[follows], ""
            elif letter == "R":
                role = {"u": "user", "a": "assistant"}[follows]
            elif letter == "D":
                continue
            roles += role[0]
            lines.append(f"{role}:{text}")
        assert LEGAL.fullmatch(roles)
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.append((c, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in conversation_repair(damaged(df)).select(*COLUMNS).collect()), key=str)


SCHEMA = "conv_id bigint, turn bigint, role string, text string, here boolean, cost string"


def test_cases(spark):
    rows = [
        (1, 0, "system", "Be kind.", True, ""), (1, 1, "user", "Hi!", True, ""), (1, 2, "assistant", "Hello.\n", True, ""), (1, 9, "user", "cut", True, ""),
        (2, None, None, None, True, ""), (2, None, "user", "x.", True, ""), (2, None, "user", "x.", True, ""), (2, 3, "tool", "y.", True, ""), (2, 3, "", "z.", True, ""),
        (None, 0, "user", "null id.", True, ""), (None, 1, "assistant", "a?", True, ""), (None, None, "user", " \t", True, ""),
        (3, 0, "user", "long. " * 200_000, True, ""), (3, 1, "assistant", "é。", True, ""), (-5, 0, "assistant", " ", True, ""), (4, None, "user", "only.", True, ""),
    ]
    rows += [(c, 0, "user", "dropped?", True, "") for c in range(100, 160)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(df) == plain(rows)
    assert conversation_repair(damaged(df.limit(0))).collect() == []


def test_random(spark):
    draw = random.Random(5)
    rows = []
    for c in range(300):
        for turn in range(draw.randint(1, 7)):
            rows.append((c, draw.choice([turn, turn, turn, None, turn // 2]), draw.choice(["user", "assistant", "user", "assistant", "system", None, "x"]), draw.choice(["a.", "b!", "c", "", " d? ", None]), True, ""))
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(df) == plain(rows)


def test_a_conversation_with_a_third_of_all_rows(spark):
    rows = [(7, t, "user" if t % 2 else "assistant", f"turn {t}.", True, "") for t in range(3000)] + [(100 + t, 0, "user", "x.", True, "") for t in range(6000)]
    df = spark.createDataFrame(rows, SCHEMA)
    faults = conversation_faults(damaged(df))
    found = {r.conv_id: r for r in faults.collect()}
    turns = [r for r in repaired_turns(damaged(df), faults).where("conv_id = 7").collect()]
    assert len(found) == 6001 and [r.place for r in turns] == list(range(len(turns)))
    assert "".join(r.role[0] for r in turns) == "ua" * (len(turns) // 2)
    assert len(found[7].audit) - found[7].audit.count("D") == len(turns)


def test_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{sf}/conversations.parquet'")
    want = con.execute(f"select {', '.join(COLUMNS)} from ({q.oracle_sql()['op11_conversation_repair']})").fetchall()
    df = q.op11_conversation_repair(spark, sf)
    assert sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str) == sorted(want, key=str)
    rows = con.execute("select conv_id, turn, role, text from conversations").fetchall()
    assert plain(rows) == sorted(want, key=str)
