"""Weighted near duplicates: BagMinHash signatures, bands, and exact multiset overlap.

A document is the multiset of its five-word shingles. Every shingle drives Poisson processes over discretised
weights: one for each dyadic interval [0, 1), [1, 2), [2, 4), ... of its count, with the interval's length as its
rate; a point also has a uniform level inside its interval (the outcome of halving the interval again and again)
and counts where the level lies below the count. Each point falls on a uniform signature component, which keeps
the point of least time. Processes stop once their time passes the document's largest component, so a document costs
little more than its shingles. Two signatures agree in a component with the weighted Jaccard similarity.

Documents that agree in all four components of one of 32 bands are candidates, and a candidate pair whose
signatures agree well is verified on the multisets themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattframe.llm import parcels, rolling
from wattframe.llm.components import components, forest
from wattframe.llm.rolling import Rolling, mix
from wattframe.llm.substring_dedup import words_by_text
from wattframe.llm.token_ids import release_memory
from wattframe.session import cut_lineage

BANDS, ROWS = 32, 4
SIZE = BANDS * ROWS
#: Candidates whose signatures agree in less than the bound minus this are not verified: four standard errors.
SLACK = 4 * (0.8 * 0.2 / SIZE) ** 0.5
#: Texts of one band key, partners of one document, and shingles of one side that a task compares at once.
CHUNK_ROWS, CHUNK_PARTNERS, CHUNK_ITEMS = 4096, 2048, 2_000_000
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(off: np.ndarray, data: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle) of every shingle in text order, and each text's fingerprint (0: no words).

    A text of fewer words than ``width`` has one shingle, all its words.
    """
    prints, owner, base = words_by_text(off, data)
    total = np.diff(base)
    place = np.arange(len(prints)) - base[owner]
    length = np.minimum(total, width)[owner]
    p = np.flatnonzero(place + length <= total[owner])
    whole = np.where(total > 0, Rolling(prints, 1).of(base[:-1], total) ^ mix(total.astype(np.uint64)), 0).astype(np.uint64)
    return owner[p], mix(Rolling(prints).of(p, length[p]) ^ length[p].astype(np.uint64)), whole


def bags(text: np.ndarray, shingle: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, shingle) and how often each occurs."""
    order = np.lexsort((shingle, text))
    text, shingle = text[order], shingle[order]
    edge = np.flatnonzero(np.append(True, (text[1:] != text[:-1]) | (shingle[1:] != shingle[:-1]))) if len(text) else np.zeros(0, int)
    return text[edge], shingle[edge], np.diff(np.append(edge, len(text)))


def signatures(text: np.ndarray, shingle: np.ndarray, count: np.ndarray, texts: int, size: int = SIZE) -> np.ndarray:
    """16 bits of the winning point for each text and component."""
    t_parts, s_parts, len_parts, lim_parts = [], [], [], []
    start, length = 0, 1
    live = np.arange(len(text))
    while len(live):
        t_parts.append(text[live])
        s_parts.append(mix(shingle[live] + np.uint64((start + 1) * int(_STEP) % 2**64)))
        len_parts.append(np.full(len(live), length))
        lim_parts.append(np.minimum(count[live] - start, length))
        start, length = start + length, max(1, start + length)
        live = live[count[live] > start]
    if not t_parts:
        return np.zeros((texts, size), np.uint16)
    doc, state, rate, limit = (np.concatenate(x) for x in (t_parts, s_parts, len_parts, lim_parts))
    best = np.full(texts * size, np.inf)
    winner = np.zeros(texts * size, np.uint64)
    time, drawn = np.zeros(len(doc)), np.zeros(len(doc), np.uint64)
    worst = np.full(texts, np.inf)
    active = np.arange(len(doc))
    while len(active):
        many = int(max(1, min(64, 8192 // len(active))))
        number = drawn[active, None] + np.arange(1, many + 1, dtype=np.uint64)
        point = mix(state[active, None] + number * _STEP)
        gap = -np.log(((point >> np.uint64(11)) + np.uint64(1)) * 2.0**-53) / rate[active, None]
        when = time[active, None] + np.cumsum(gap, axis=1)
        spin = mix(point ^ np.uint64(0xA5A5A5A5A5A5A5A5))
        level = ((spin >> np.uint64(32)) * rate[active, None].astype(np.uint64)) >> np.uint64(32)
        counts = level < limit[active, None].astype(np.uint64)
        slot = (doc[active, None] * size + (spin & np.uint64(0xFFFFFFFF)).astype(np.int64) % size)[counts]
        w, p = when[counts], point[counts]
        np.minimum.at(best, slot, w)
        won = best[slot] == w
        winner[slot[won]] = p[won]
        time[active] = when[:, -1]
        drawn[active] += np.uint64(many)
        touched = np.unique(doc[active])
        worst[touched] = best.reshape(texts, size)[touched].max(1)
        active = active[time[active] < worst[doc[active]]]
    return (mix(winner) >> np.uint64(48)).astype(np.uint16).reshape(texts, size)


def as_set(text: np.ndarray, shingle: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A multiset as a set: the n-th occurrence of a shingle is an element of its own."""
    order = np.lexsort((shingle, text))
    text, shingle = text[order], shingle[order]
    edge = np.append(True, (text[1:] != text[:-1]) | (shingle[1:] != shingle[:-1])) if len(text) else np.zeros(0, bool)
    first = np.flatnonzero(edge)
    nth = np.arange(len(text)) - first[np.cumsum(edge) - 1] if len(text) else np.zeros(0, np.int64)
    return text, mix(shingle + nth.astype(np.uint64) * _STEP)


def _signed(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        off, data = parcels.utf8(batch.column(1))
        for a, b in parcels.chunks(off):
            part = off[a : b + 1] - off[a]
            text, shingle, whole = shingles(part, data[off[a] : off[b]], width)
            sig = signatures(*bags(text, shingle), b - a)
            place = [xxhash.xxh3_64_intdigest(data[off[i] : off[i + 1]]) for i in range(a, b)]
            missing = whole == 0
            yield pa.record_batch(
                [
                    batch.column(0).slice(a, b - a), pa.array(whole.view(np.int64), mask=missing),
                    pa.array(np.array(place, np.uint64).view(np.int64)), pa.array(np.bincount(text, minlength=b - a)), pa.array([r.tobytes() for r in sig], pa.binary()),
                ],
                names=["doc_id", "print", "place", "n", "sig"],
            )
    _forget()


def _forget() -> None:
    """At a task's end its worker waits for other stages and should hold little."""
    rolling.forget()
    release_memory()


def _table(batches: Iterator[pa.RecordBatch]) -> pa.Table:
    table = pa.Table.from_batches(list(batches), schema=parcels.SCHEMA)
    _forget()
    return table


KEYED = np.dtype([("k", "<u8"), ("f", "<i8"), ("c", "<i8")])
PAIR = np.dtype([("a", "<i8"), ("b", "<i8")])
OPEN = np.dtype([("f", "<i8"), ("k", "<u8"), ("n", "<i8"), ("c", "<i8")])
#: A text, where its bytes are, the group of candidates it belongs to and the group's number of chunks.
SIGNED = np.dtype([("f", "<i8"), ("p", "<i8"), ("g", "<i8"), ("m", "<i8"), ("sig", "<u2", (SIZE,))])
#: A pair to test in block ``s`` of group ``g``, and a text whose multiset that block needs.
TEST = np.dtype([("g", "<i8"), ("s", "<i8"), ("a", "<i8"), ("b", "<i8")])
ASK = np.dtype([("p", "<i8"), ("f", "<i8"), ("g", "<i8"), ("s", "<i8")])
SIGS, OPENS = 0, 1
TEXTS, ASKS, TESTS, SETS = 0, 1, 2, 3


def _bucket(x: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(x.astype(np.uint64)) % np.uint64(buckets)).astype(np.int32)


def _band_keys(sig: np.ndarray) -> np.ndarray:
    """A 64-bit key for each text and band; a band's key is its components, told apart by the band."""
    keys = np.ascontiguousarray(sig).view("<u8").astype(np.uint64)
    return mix(keys ^ mix(np.arange(1, keys.shape[1] + 1, dtype=np.uint64))[None, :])


def _signed_batch(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint16).reshape(len(batch), SIZE)
    return np.asarray(batch.column("f")), sig


def _banded(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """(band key, text, class) of every text, packed."""
    for batch in batches:
        if len(batch):
            f, sig = _signed_batch(batch)
            keys = _band_keys(sig)
            out = np.zeros(keys.size, KEYED)
            out["k"], out["f"] = keys.ravel(), np.repeat(f, keys.shape[1])
            out["c"] = np.repeat(np.asarray(batch.column("c")), keys.shape[1])
            yield parcels.rows((out["k"] % np.uint64(buckets)).astype(np.int32), out)


def _by_key(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Records sorted by key and text, where keys begin, and how many texts each has."""
    found = parcels.records(table, KEYED)
    found = found[np.lexsort((found["f"], found["k"]))]
    edge = np.flatnonzero(np.append(True, found["k"][1:] != found["k"][:-1])) if len(found) else np.zeros(0, int)
    return found, edge, np.diff(np.append(edge, len(found)))


def _leaders(table: pa.Table, buckets: int) -> pa.Table:
    """Each text of a key with the key's smallest; a pair that several keys propose is packed once."""
    found, edge, n = _by_key(table)
    out = np.zeros(len(found), PAIR)
    out["a"], out["b"] = np.repeat(found["f"][edge], n), found["f"]
    out = np.unique(out[out["a"] != out["b"]])
    return pa.Table.from_batches([parcels.rows(_bucket(out["a"] ^ (out["b"] << 1), buckets), out)] if len(out) else [], schema=parcels.SCHEMA)


def _unique_pairs(table: pa.Table) -> pa.Table:
    out = np.unique(parcels.records(table, PAIR))
    return pa.table({"a": pa.array(out["a"].copy()), "b": pa.array(out["b"].copy())})


def _agreeing(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if len(batch):
            x, y = (np.frombuffer(b"".join(batch.column(n).to_pylist()), np.uint16).reshape(len(batch), SIZE) for n in ("x", "y"))
            yield batch.select(["a", "b", "pa", "pb"]).filter(pa.array((x == y).mean(1) >= least))


def _spot(g: np.ndarray, s: np.ndarray, buckets: int) -> np.ndarray:
    return _bucket(g.astype(np.uint64) + mix(s.astype(np.uint64)) * _STEP, buckets)


def _ordered(tests: np.ndarray, asks: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Pairs for the blocks that test them, and what the blocks need of each text, asked for once."""
    asks = np.unique(asks)
    yield parcels.rows(_spot(tests["g"], tests["s"], buckets), tests, TESTS)
    yield parcels.rows((asks["p"].astype(np.uint64) % np.uint64(buckets)).astype(np.int32), asks, ASKS)


def _hosted(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Pairs of leader ``a`` as tests: a leader is a group, its partners are dealt to blocks."""
    for batch in batches:
        if len(batch):
            cell = {n: np.asarray(batch.column(n)) for n in ("a", "b", "pa", "pb", "s")}
            tests = np.zeros(len(batch), TEST)
            tests["g"], tests["s"], tests["a"], tests["b"] = cell["a"], cell["s"], cell["a"], cell["b"]
            asks = np.zeros(2 * len(batch), ASK)
            asks["g"], asks["s"] = np.tile(cell["a"], 2), np.tile(cell["s"], 2)
            asks["f"], asks["p"] = np.append(cell["a"], cell["b"]), np.append(cell["pa"], cell["pb"])
            yield from _ordered(tests, asks, buckets)


def _open_members(table: pa.Table, buckets: int) -> pa.Table:
    """Texts of keys that still hold several classes. Of a key of two texts, the only pair was tested."""
    found, edge, n = _by_key(table)
    if not len(found):
        return parcels.SCHEMA.empty_table()
    low, high = np.minimum.reduceat(found["c"], edge), np.maximum.reduceat(found["c"], edge)
    some = np.repeat((n > 2) & (low < high), n)
    out = np.zeros(int(some.sum()), OPEN)
    out["k"], out["f"], out["c"], out["n"] = found["k"][some], found["f"][some], found["c"][some], np.repeat(n, n)[some]
    return pa.Table.from_batches([parcels.rows(_bucket(out["f"], buckets), out, OPENS)] if len(out) else [], schema=parcels.SCHEMA)


def _by_text(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if len(batch):
            out = np.zeros(len(batch), SIGNED)
            out["f"], out["sig"] = _signed_batch(batch)
            for name in ("p", "g", "m"):
                out[name] = np.asarray(batch.column(name))
            yield parcels.rows(_bucket(out["f"], buckets), out, SIGS)


MEMBER = np.dtype([("k", "<u8"), ("i", "<u4"), ("j", "<u4"), ("own", "<u4"), ("f", "<i8"), ("c", "<i8"), ("p", "<i8"), ("g", "<i8"), ("m", "<i8"), ("sig", "<u2", (SIZE,))])


def _dealt(table: pa.Table, buckets: int) -> Iterator[pa.RecordBatch]:
    """Members of open keys with signatures; a key of many texts is dealt to pairs of chunks of them."""
    wanted = parcels.records(table, OPEN, OPENS)
    if not len(wanted):
        return
    signed = parcels.records(table, SIGNED, SIGS)
    signed = signed[np.argsort(signed["f"])]
    home = np.searchsorted(signed["f"], wanted["f"])
    parts = -(-wanted["n"] // CHUNK_ROWS)
    own = (mix(wanted["f"].astype(np.uint64)) % parts.astype(np.uint64)).astype(np.int64)
    row = np.repeat(np.arange(len(wanted)), parts)
    other = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
    for at in range(0, len(row), 20_000):
        r, o = row[at : at + 20_000], other[at : at + 20_000]
        out = np.zeros(len(r), MEMBER)
        out["k"], out["f"], out["c"] = wanted["k"][r], wanted["f"][r], wanted["c"][r]
        for name in ("p", "g", "m", "sig"):
            out[name] = signed[name][home[r]]
        out["i"], out["j"], out["own"] = np.minimum(own[r], o), np.maximum(own[r], o), own[r]
        yield parcels.rows(_bucket(out["k"] + out["i"].astype(np.uint64) * _STEP + mix(out["j"].astype(np.uint64)), buckets), out)


def _between(table: pa.Table, least: float, buckets: int) -> Iterator[pa.RecordBatch]:
    """Tests of a key's texts of different classes whose signatures agree.

    Texts that share several keys are a pair in the first of them alone. The block that tests a pair follows from
    the two texts: their chunks of the group of candidates.
    """
    found = parcels.records(table, MEMBER)
    found = found[np.lexsort((found["f"], found["j"], found["i"], found["k"]))]
    key = found[["k", "i", "j"]]
    edge = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(found) else np.zeros(0, int)
    chunk = (mix(found["f"].astype(np.uint64) ^ _STEP) % np.maximum(found["m"], 1).astype(np.uint64)).astype(np.int64)
    for at, to in zip(edge.tolist(), np.append(edge[1:], len(found)).tolist()):
        own, part = found[at:to], chunk[at:to]
        sig, c = np.ascontiguousarray(own["sig"]), own["c"]
        band = int(np.argmax(_band_keys(sig[:1])[0] == own["k"][0]))
        across = own["i"][0] != own["j"][0]
        xs, ys = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for p in range(len(own)):
            # Pairs inside a chunk have a block of their own.
            apart = c[p + 1 :] != c[p]
            rest = np.flatnonzero(apart & (own["own"][p + 1 :] != own["own"][p]) if across else apart) + p + 1
            if len(rest):
                equal = sig[rest] == sig[p]
                near = np.flatnonzero(equal.mean(1) >= least)
                near = near[equal[near].reshape(-1, BANDS, ROWS).all(2).argmax(1) == band]
                xs.append(np.full(len(near), p))
                ys.append(rest[near])
        x, y = np.concatenate(xs), np.concatenate(ys)
        if len(x):
            tests = np.zeros(len(x), TEST)
            tests["g"], tests["a"], tests["b"] = own["g"][x], own["f"][x], own["f"][y]
            tests["s"] = (np.minimum(part[x], part[y]) << 31) + np.maximum(part[x], part[y])
            asks = np.zeros(2 * len(x), ASK)
            asks["g"], asks["s"] = np.tile(tests["g"], 2), np.tile(tests["s"], 2)
            asks["f"], asks["p"] = own["f"][np.append(x, y)], own["p"][np.append(x, y)]
            yield from _ordered(np.unique(tests), asks, buckets)


def _texts(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Every text once a flush, packed by its own fingerprint."""
    for batch in batches:
        off, data = parcels.utf8(batch.column(0))
        for a, b in parcels.chunks(off, 8 * parcels.FLUSH_BYTES):
            place = np.array([xxhash.xxh3_64_intdigest(data[off[i] : off[i + 1]]) for i in range(a, b)], np.uint64)
            _, one = np.unique(place, return_index=True)
            home = (place[one] % np.uint64(buckets)).astype(np.int32)
            keys, bodies = np.unique(home), []
            for k in keys:
                own = one[home == k]
                bodies.append(parcels.pack_texts(place[own].view(np.int64), np.zeros(len(own), bool), [data[off[a + i] : off[a + i + 1]].tobytes() for i in own]))
            yield pa.record_batch([pa.array(keys, pa.int32()), pa.array([TEXTS] * len(keys), pa.int32()), pa.array(bodies, pa.binary())], schema=parcels.SCHEMA)


_ITEM = np.dtype([("g", "<i8"), ("s", "<i8"), ("f", "<i8"), ("n", "<i8")])


def _sets(table: pa.Table, width: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """The multiset of each text asked for, sent to every block that asks."""
    asks = np.unique(parcels.records(table, ASK, ASKS))
    wanted = np.unique(asks["p"])
    seen: set[int] = set()
    kinds, bodies = table.column("kind").to_pylist(), table.column("body")
    for i in [i for i, k in enumerate(kinds) if k == TEXTS] if len(wanted) else []:
        place, _, texts = parcels.unpack_texts(bodies[i].as_py())
        out: dict[int, list[bytes]] = {}
        for p in np.flatnonzero(np.isin(place, wanted)).tolist():
            if place[p] in seen:
                continue
            seen.add(int(place[p]))
            raw = np.frombuffer(texts[p], np.uint8)
            _, items = as_set(*shingles(np.array([0, len(raw)]), raw, width)[:2])
            body = np.sort(items).tobytes()
            mine = asks[np.searchsorted(asks["p"], place[p]) : np.searchsorted(asks["p"], place[p], "right")]
            for ask, spot in zip(mine, _spot(mine["g"], mine["s"], buckets).tolist()):
                head = np.array([(ask["g"], ask["s"], ask["f"], len(items))], _ITEM)
                out.setdefault(spot, []).append(head.tobytes() + body)
        if out:
            yield pa.record_batch(
                [pa.array(list(out), pa.int32()), pa.array([SETS] * len(out), pa.int32()), pa.array([b"".join(x) for x in out.values()], pa.binary())], schema=parcels.SCHEMA
            )


def _partners(mine: np.ndarray, others: list[np.ndarray], bound: float) -> np.ndarray:
    """Which of some sorted multisets overlap ``mine`` enough."""
    sizes = np.array([len(x) for x in others])
    items = np.concatenate(others)
    at = np.minimum(np.searchsorted(mine, items), len(mine) - 1)
    common = np.add.reduceat((mine[at] == items).astype(np.int64), np.cumsum(sizes) - sizes)
    return common >= bound * (len(mine) + sizes - common) - 1e-9


def _verified(table: pa.Table, bound: float) -> pa.Table:
    """Links among a bucket's tests; those that say nothing new about what is connected are left out."""
    members: dict[tuple[int, int, int], np.ndarray] = {}
    kinds, bodies = table.column("kind").to_pylist(), table.column("body")
    for cell in (bodies[i] for i, k in enumerate(kinds) if k == SETS):
        raw, at = cell.as_buffer(), 0
        while at < raw.size:
            head = np.frombuffer(raw, _ITEM, 1, at)[0]
            at += _ITEM.itemsize
            members[int(head["g"]), int(head["s"]), int(head["f"])] = np.frombuffer(raw, np.uint64, int(head["n"]), at)
            at += 8 * int(head["n"])
    tests = np.unique(parcels.records(table, TEST, TESTS))
    edge = np.flatnonzero(np.append(True, tests[["g", "s", "a"]][1:] != tests[["g", "s", "a"]][:-1])) if len(tests) else np.zeros(0, int)
    a_out, b_out = [], []
    for at, to in zip(edge.tolist(), np.append(edge[1:], len(tests)).tolist()):
        g, s, a = (int(tests[n][at]) for n in ("g", "s", "a"))
        some, held = [], 0
        for n, b in enumerate(tests["b"][at:to].tolist(), 1):
            some.append(b)
            held += len(members[g, s, b])
            if held > CHUNK_ITEMS or n == to - at:
                ok = _partners(members[g, s, a], [members[g, s, x] for x in some], bound)
                b_out += [x for x, y in zip(some, ok.tolist()) if y]
                a_out += [a] * int(ok.sum())
                some, held = [], 0
    names, at = np.unique(np.array(a_out + b_out, np.int64), return_inverse=True)
    links = forest(at[: len(a_out)].tolist(), at[len(a_out) :].tolist(), len(names))
    x, y = names[[e[0] for e in links]], names[[e[1] for e in links]]
    return pa.table({"a": pa.array(np.minimum(x, y), pa.int64()), "b": pa.array(np.maximum(x, y), pa.int64())})


def near_duplicates(docs: DataFrame, bound: float = 0.8, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Classes of documents linked by a weighted Jaccard similarity of ``bound`` or more on ``width``-word shingles.

    One row for each row of ``docs``: doc_id, component_id (smallest doc_id of the class), kept (doc_id =
    component_id). Words are runs of bytes other than space and 0x09-0x0D, unchanged; a text of fewer than ``width``
    words is one shingle. Texts without words, null ones included, are classes of their own. Texts of equal words are one
    class at once and travel as one. Rows that repeat a doc_id are kept or not together where their texts are alike;
    a null doc_id is the smallest only if all of the class are null. Other columns are ignored; an empty table gives
    an empty result.

    A pair of similarity 0.8 shares a band with probability 1 - 5e-8. A first pass tests each text against the
    smallest of every band key it has; for keys that then still hold several classes, a second tests all candidates
    between classes. So every candidate is either inside a class or was tested. Pairs of the second pass never become
    rows: candidates that hang together form a group, a group of many shingles is cut into chunks, and a block of
    two chunks receives each multiset once, with its pairs packed.
    """
    spark = docs.sparkSession
    buckets = parcels.bucket_count(spark)
    source = docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    spread = lambda df: df.repartition(buckets, "bucket").groupBy("bucket")
    least = bound - SLACK

    signed = cut_lineage(source.mapInArrow(lambda it: _signed(it, width), "doc_id bigint, print bigint, place bigint, n bigint, sig binary"))
    distinct = signed.where("print IS NOT NULL").groupBy(F.col("print").alias("f")).agg(F.first("sig").alias("sig"), F.min("place").alias("p"), F.max("n").alias("n"))
    distinct = cut_lineage(distinct)

    def by_key(texts: DataFrame):
        return spread(texts.select("f", "sig", "c").mapInArrow(lambda it: _banded(it, buckets), parcels.DDL))

    def verify(tests: DataFrame) -> DataFrame:
        """(a, b) that link, of packed tests and asks."""
        tests = cut_lineage(tests)
        texts = source.select("text").mapInArrow(lambda it: _texts(it, buckets), parcels.DDL)
        sets = spread(texts.union(tests.where(F.col("kind") == ASKS))).applyInArrow(lambda t: _table(_sets(t, width, buckets)), parcels.DDL)
        return cut_lineage(spread(sets.union(tests.where(F.col("kind") == TESTS))).applyInArrow(lambda t: _verified(t, bound), "a bigint, b bigint"))

    leaders = by_key(distinct.withColumn("c", F.col("f"))).applyInArrow(lambda t: _leaders(t, buckets), parcels.DDL)
    pairs = cut_lineage(spread(leaders).applyInArrow(_unique_pairs, "a bigint, b bigint"))
    side = lambda f, sig, p: distinct.select(F.col("f").alias(f), F.col("sig").alias(sig), F.col("p").alias(p))
    close = pairs.join(side("a", "x", "pa"), "a").join(side("b", "y", "pb"), "b")
    close = cut_lineage(close.mapInArrow(lambda it: _agreeing(it, least), "a bigint, b bigint, pa bigint, pb bigint"))
    blocks = close.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / CHUNK_PARTNERS).cast("bigint").alias("blocks"))
    hosted = close.join(blocks, "a").withColumn("s", F.pmod(F.xxhash64("b"), "blocks"))
    linked = verify(hosted.mapInArrow(lambda it: _hosted(it, buckets), parcels.DDL))
    classes = components(linked)

    groups = components(pairs).select(F.col("node").alias("f"), F.col("component").alias("g"))
    placed = distinct.join(groups, "f")
    # Groups of one chunk, nearly all, are left out; the others are few, as each has millions of shingles.
    large = placed.groupBy("g").agg(F.ceil(F.sum("n") / CHUNK_ITEMS).cast("bigint").alias("m")).where("m > 1")
    placed = placed.join(large, "g", "left").withColumn("m", F.coalesce("m", F.lit(1)))
    signed_texts = placed.select("f", "sig", "p", "g", "m").mapInArrow(lambda it: _by_text(it, buckets), parcels.DDL)
    classed = distinct.join(classes.withColumnRenamed("node", "f"), "f", "left").withColumn("c", F.coalesce("component", "f"))
    members = by_key(classed).applyInArrow(lambda t: _open_members(t, buckets), parcels.DDL)
    dealt = spread(signed_texts.union(members)).applyInArrow(lambda t: _table(_dealt(t, buckets)), parcels.DDL)
    rest = verify(spread(dealt).applyInArrow(lambda t: _table(_between(t, least, buckets)), parcels.DDL))
    classes = components(classes.select(F.col("node").alias("a"), F.col("component").alias("b")).union(rest))

    placed = signed.select("doc_id", F.col("print").alias("node")).join(classes, "node", "left").withColumn("class", F.coalesce("component", "node"))
    smallest = placed.where("class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("component_id"))
    out = placed.join(smallest, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
