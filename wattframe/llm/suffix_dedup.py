"""Repeated long byte strings by a run-length index.

Text that may repeat (see ``repeats``) is gathered in shards by anchor. A shard concatenates its snippets in corpus
order, each behind a terminator of its own, and keeps a run-compressed Burrows-Wheeler transform: heads and
lengths of the runs, the text position sampled at each run's end, and, for each class of rows that agree in the
first ``window`` bytes, the sampled earliest start. Every snippet is then streamed backwards through the index,
one LF step for each byte, all snippets of the shard at once; the matching statistic against earlier text reaches
``window`` where the row lies in a class with an earlier start, and that window is marked. Windows of an anchor with
more text than an index may hold are told apart by their fingerprints, dealt over all tasks.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame

from wattframe.llm.repeats import MARK, SEGMENT, WINDOW, Method, mark_repeats
from wattframe.llm.rolling import BYTES, Rolling, sliding_min

#: Bytes of an anchor. A window of 100 bytes holds 69 of them and is known by the least fingerprint among these.
ANCHOR = 32
_HIGH = np.uint64(0xFFFFFFFF00000000)
_LOW = np.uint64(0xFFFFFFFF)


def _cut(window: int):
    anchor = min(ANCHOR, max(1, window // 2))
    slice_of = 1 << 20

    def cut(off: np.ndarray, data: np.ndarray):
        owners, parts = [], []
        for low in range(0, max(1, len(data) - window + 1), slice_of):
            buf = data[low : low + slice_of + window - 1]
            if len(buf) < window:
                break
            values = BYTES[buf]
            prints = Rolling(values).every(anchor)
            key = (prints & _HIGH) | np.arange(len(prints), dtype=np.uint64)
            place = (sliding_min(key, window - anchor + 1) & _LOW).astype(np.int64)
            starts = np.arange(len(place))
            owner = np.searchsorted(off, starts + low, "right") - 1
            ok = starts + low + window <= off[owner + 1]
            starts, owner = starts[ok], owner[ok]
            if not len(starts):
                continue
            place = place[starts]
            edge = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])))
            count = np.diff(np.append(edge, len(starts)))
            s = starts[edge]
            out = np.zeros(len(edge), SEGMENT)
            out["h"], out["c"] = prints[place[edge]], Rolling(values, 1).of(s, count + window - 1)
            out["s"], out["n"] = s + low - off[owner[edge]], count
            owners.append(owner[edge])
            parts.append(out)
        return (np.concatenate(owners), np.concatenate(parts)) if parts else (np.zeros(0, np.int64), np.zeros(0, SEGMENT))

    return cut


_HEAD = np.dtype([("h", "<u8"), ("d", "<i8"), ("t", "<u8"), ("v", "<u4"), ("s", "<u4"), ("n", "<u2")])


def _fetch(window: int):
    def fetch(text: bytes, wants: np.ndarray):
        bodies = []
        for i in range(len(wants)):
            s, n = int(wants["s"][i]), int(wants["n"][i])
            head = np.zeros(1, _HEAD)
            for name in _HEAD.names:
                head[name] = wants[name][i]
            bodies.append(head.tobytes() + text[s : s + n + window - 1])
        return wants["h"].copy(), bodies

    return fetch


def _split(window: int):
    def split(text: bytes, wants: np.ndarray) -> np.ndarray:
        """The wanted windows one by one, known by fingerprints of themselves and of their anchors."""
        parts = []
        for want in wants:
            s, n = int(want["s"]), int(want["n"])
            out = np.zeros(n, WINDOW)
            out["c"] = Rolling(BYTES[np.frombuffer(text, np.uint8, n + window - 1, s)], 1).every(window)
            out["h"], out["d"], out["t"], out["v"], out["s"] = want["h"], want["d"], want["t"], want["v"], s + np.arange(n)
            parts.append(out)
        return np.concatenate(parts)

    return split


class RunLengthIndex:
    """Run-compressed transform of snippets (``codes``: bytes plus one, 0 ends a snippet; ``ends``: the 0s)."""

    def __init__(self, codes: np.ndarray, ends: np.ndarray, window: int, usable: np.ndarray):
        rank, agree = _sorted_rank(codes, ends, window)
        n = len(codes)
        rows = np.empty(n, np.int64)
        rows[rank] = np.arange(n)
        before = codes[rows - 1]
        before[rows == 0] = 0
        self.head = np.flatnonzero(np.append(True, before[1:] != before[:-1]))
        self.char = before[self.head]
        length = np.diff(np.append(self.head, n))
        self.sample = rows[self.head + length - 1]
        # LF of a run's first row: rows of smaller characters, then earlier runs of its own.
        by_char = np.argsort(self.char, kind="stable")
        self.first_row = np.empty(len(self.head), np.int64)
        self.first_row[by_char] = np.cumsum(np.append(0, length[by_char][:-1]))
        ok = usable[rows]
        joined = np.zeros(n, bool)
        joined[1:] = ok[1:] & ok[:-1] & agree(rows[1:], rows[:-1])
        start = np.flatnonzero(~joined)
        size = np.diff(np.append(start, n))
        earliest = np.minimum.reduceat(rows, start)
        many = size > 1
        self.class_start, self.class_end, self.earliest = start[many], (start + size)[many], earliest[many]
        self.end_rows = rank[ends]

    def lf(self, row: np.ndarray) -> np.ndarray:
        run = np.searchsorted(self.head, row, "right") - 1
        return self.first_row[run] + row - self.head[run]

    def earlier_than(self, row: np.ndarray) -> np.ndarray:
        """Earliest text position whose window equals that of a row; -1 where the window is alone."""
        if not len(self.class_start):
            return np.full(len(row), -1)
        at = np.searchsorted(self.class_start, row, "right") - 1
        inside = (at >= 0) & (row < self.class_end[at])
        return np.where(inside, self.earliest[at], -1)


def _dense(key: np.ndarray) -> np.ndarray:
    order = np.argsort(key)
    new = np.empty(len(key), np.int64)
    sorted_key = key[order]
    new[order] = np.cumsum(np.append(0, sorted_key[1:] != sorted_key[:-1]))
    return new


def _sorted_rank(codes: np.ndarray, ends: np.ndarray, window: int):
    """Place of each suffix in sorted order, and a test of equal windows, by doubling.

    Terminators compare by snippet, so suffixes differ at the latest behind the longest snippet.
    """
    n = len(codes)
    snippet = np.searchsorted(ends, np.arange(n))
    end = ends[snippet]
    left = end - np.arange(n)
    padded = np.append(codes, np.zeros(8, np.uint8)).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key |= np.where(left > i, padded[i : n + i], np.uint64(0)) << np.uint64(56 - 8 * i)
    rank = _dense(key)
    rank = _dense(rank * (len(ends) + 1) + np.where(left < 8, snippet + 1, 0))
    levels, depth = {8: rank}, 8
    while rank.max() < n - 1:
        rank = _dense(rank * n + rank[np.minimum(np.arange(n) + depth, end)])
        depth *= 2
        levels[depth] = rank
    steps = [k for k in sorted(levels) if k <= window]

    def agree(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        same, done, last = np.ones(len(a), bool), 0, steps[-1]
        while done < window:
            at = min(done, window - last)
            x, y = np.minimum(a + at, n - 1), np.minimum(b + at, n - 1)
            same &= levels[last][x] == levels[last][y]
            done += last
        return same

    return rank, agree


#: Text of one run-length index, which takes about 80 bytes for each of text. Snippets of one anchor stay together. An
#: anchor with more text than ANCHOR_BYTES has no index: equal windows also have equal fingerprints, and meet by these.
SHARD_BYTES = ANCHOR_BYTES = 1 << 19


def _judge(window: int):
    def judge(found: bytes) -> np.ndarray:
        heads, at = [], []
        place = 0
        while place < len(found):
            heads.append(np.frombuffer(found, _HEAD, 1, place))
            at.append(place + _HEAD.itemsize)
            place = at[-1] + int(heads[-1]["n"][0]) + window - 1
        if not heads:
            return np.zeros(0, MARK)
        heads, at = np.concatenate(heads), np.array(at)
        raw = np.frombuffer(found, np.uint8)
        order = np.lexsort((heads["v"], heads["t"], heads["s"], heads["d"], heads["h"]))
        heads, at = heads[order], at[order]
        edge = np.flatnonzero(np.append(True, heads["h"][1:] != heads["h"][:-1]))
        size = np.add.reduceat(heads["n"].astype(np.int64) + window, edge)
        shard = (np.cumsum(size) - size) // SHARD_BYTES
        cuts = edge[np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))]
        return np.concatenate([_stream(raw, heads[a:b], at[a:b], window) for a, b in zip(cuts, np.append(cuts[1:], len(heads)))])

    return judge


def _stream(raw: np.ndarray, heads: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    """Index the snippets of a shard, stream each through the index, and mark windows with an earlier equal."""
    order = np.lexsort((heads["v"], heads["t"], heads["s"], heads["d"]))
    heads, at = heads[order], at[order]
    count = heads["n"].astype(np.int64)
    sizes = count + window - 1
    starts = np.append(0, np.cumsum(sizes + 1)[:-1])
    ends = starts + sizes
    codes = np.zeros(int(ends[-1]) + 1, np.uint8)
    for a, s, size in zip(at.tolist(), starts.tolist(), sizes.tolist()):
        codes[s : s + size] = raw[a : a + size] + 1
    snippet = np.repeat(np.arange(len(heads)), sizes + 1)
    usable = np.arange(len(codes)) - starts[snippet] < count[snippet]
    index = RunLengthIndex(codes, ends, window, usable)

    marked = np.zeros(len(codes), bool)
    longest = np.argsort(-sizes, kind="stable")
    row, size, begin = index.end_rows[longest], sizes[longest], starts[longest]
    d, s = heads["d"], heads["s"].astype(np.int64)
    for step in range(1, int(size[0]) + 1):
        live = int(np.searchsorted(-size, -step, "right"))
        row[:live] = index.lf(row[:live])
        here = begin[:live] + size[:live] - step
        look = np.flatnonzero(usable[here])
        if not len(look):
            continue
        here = here[look]
        other = index.earlier_than(row[:live][look])
        some = other >= 0
        here, other = here[some], other[some]
        mine, theirs = snippet[here], snippet[other]
        at_me, at_them = s[mine] + here - starts[mine], s[theirs] + other - starts[theirs]
        marked[here] = (d[theirs] < d[mine]) | ((d[theirs] == d[mine]) & (at_them < at_me))
    edge = np.diff(marked.astype(np.int8), prepend=0, append=0)
    a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    own = snippet[a]
    out = np.zeros(len(a), MARK)
    out["d"], out["t"], out["v"], out["s"], out["n"] = d[own], heads["t"][own], heads["v"][own], s[own] + a - starts[own], b - a
    return out


def covered(length: int, marks: np.ndarray, window: int) -> np.ndarray:
    """Units of a document that marked windows cover."""
    step = np.zeros(length + 1, np.int64)
    np.add.at(step, marks["s"].astype(np.int64), 1)
    np.add.at(step, marks["s"].astype(np.int64) + marks["n"] + window - 1, -1)
    return np.cumsum(step[:-1]) > 0


def _finish(window: int, keep_text: bool):
    def finish(text: bytes, marks: np.ndarray):
        if not len(marks):
            digest = hashlib.sha256(text).hexdigest()
            return (len(text), 0, 0, digest, text, digest) if keep_text else (len(text), 0, 0, digest)
        gone = covered(len(text), marks, window)
        kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
        spans = int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
        out = (len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
        return (*out, kept, hashlib.sha256(text).hexdigest()) if keep_text else out

    return finish


def suffix_dedup(docs: DataFrame, window: int = 100, keep_text: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove each byte covered by a ``window``-byte string that also starts earlier in the corpus.

    Earlier: a smaller doc_id, or the same doc_id and an earlier start. One row for each row of ``docs``: doc_id,
    n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 and, with ``keep_text``, ``kept`` (binary; a cut
    may split a character) and text_sha256 (of the text as it was; with doc_id it tells the row). A null text is empty; texts below ``window`` bytes lose nothing; rows with one doc_id
    are one document, so equal rows do not remove each other; null doc_ids come last, as one document. Other
    columns are ignored. An empty table gives an empty result.
    """
    if window < 16:
        raise ValueError("a window has 16 bytes at least")
    columns = (("n_bytes", "bigint"), ("n_removed", "bigint"), ("n_spans", "bigint"), ("kept_sha256", "string"))
    method = Method(window, True, _cut(window), _fetch(window), None, _judge(window), _finish(window, keep_text), columns + ((("kept", "binary"), ("text_sha256", "string")) if keep_text else ()), ANCHOR_BYTES, _split(window))
    return mark_repeats(docs, method, id_col, text_col)
