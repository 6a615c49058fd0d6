"""Repeated word windows by difference-cover anchors.

Positions whose residue modulo 31 lies in the cover {1, 5, 11, 24, 25, 27} carry an anchor: the fingerprint of
the 20 words that start there. Every difference modulo 31 is a difference of two cover residues, so two equal
windows of 50 words, wherever they start, hold an anchor at the same place of both. Anchors that occur in several
documents are extended: windows around them are compared as wholes.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame

from wattframe.llm.repeats import MARK, SEGMENT, Method, mark_repeats
from wattframe.llm.rolling import BYTES, Rolling, mix, word_starts
from wattframe.llm.suffix_dedup import covered

#: A perfect difference cover: the 30 differences of its residues are 1..30 modulo 31.
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)
FOUND = np.dtype([("w", "<u8"), ("d", "<i8"), ("s", "<u4"), ("t", "<u8"), ("v", "<u4")])


def words_of(data: np.ndarray, slice_of: int = 1 << 20) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprint, start and end of every word."""
    first, last = word_starts(data)
    prints = np.zeros(len(first), np.uint64)
    at = 0
    while at < len(first):
        to = max(at + 1, int(np.searchsorted(last, first[at] + slice_of, "right")))
        base = first[at]
        prints[at:to] = Rolling(BYTES[data[base : last[to - 1]]]).of(first[at:to] - base, last[at:to] - first[at:to])
        at = to
    return prints, first, last


def words_by_text(off: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprints of the words of several texts, the text of each, and where each text's words begin."""
    # Texts are laid out with a blank between them, so no word crosses.
    spaced = np.full(len(data) + len(off), 32, np.uint8)
    for i, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist())):
        spaced[a + i : b + i] = data[a:b]
    prints, first, _ = words_of(spaced)
    owner = np.searchsorted(off[:-1] + np.arange(len(off) - 1), first, "right") - 1
    return prints, owner, np.searchsorted(owner, np.arange(len(off)))


def _cut(window: int):
    anchor = window - PERIOD + 1

    def cut(off: np.ndarray, data: np.ndarray):
        prints, owner, base = words_by_text(off, data)
        total = np.diff(base)
        place = np.arange(len(prints)) - base[owner]
        chosen = np.zeros(PERIOD, bool)
        chosen[list(COVER)] = True
        p = np.flatnonzero(chosen[place % PERIOD] & (place + anchor <= total[owner]) & (total[owner] >= window))
        if not len(p):
            return np.zeros(0, np.int64), np.zeros(0, SEGMENT)
        doc, at = owner[p], place[p]
        low = np.maximum(0, at + anchor - window)
        high = np.minimum(at, total[doc] - window)
        out = np.zeros(len(p), SEGMENT)
        out["h"] = Rolling(prints).of(p, anchor)
        start, count = base[doc] + low, high - low + 1
        out["c"] = mix(Rolling(prints, 1).of(start, count + window - 1) ^ ((at - low).astype(np.uint64) << np.uint64(32)) ^ count.astype(np.uint64))
        out["s"], out["n"] = low, count
        return doc, out

    return cut


def _fetch(window: int):
    def fetch(text: bytes, wants: np.ndarray):
        prints, _, _ = words_of(np.frombuffer(text, np.uint8))
        starts = np.flatnonzero(covered(len(prints), wants, 1))
        out = np.zeros(len(starts), FOUND)
        out["w"], out["s"] = Rolling(prints, 1).of(starts, window), starts
        for name in ("d", "t", "v"):
            out[name] = wants[name][0]
        return out["w"].copy(), out

    return fetch


def _judge(found: np.ndarray) -> np.ndarray:
    found = found[np.argsort(found["w"])]
    if not len(found):
        return np.zeros(0, MARK)
    edge = np.flatnonzero(np.append(True, found["w"][1:] != found["w"][:-1]))
    least = np.repeat(np.minimum.reduceat(found["d"], edge), np.diff(np.append(edge, len(found))))
    found = found[found["d"] > least]
    out = np.zeros(len(found), MARK)
    for name in ("d", "t", "v", "s"):
        out[name] = found[name]
    out["n"] = 1
    return out


def _finish(window: int, keep_text: bool):
    def finish(text: bytes, marks: np.ndarray):
        words = text.split()
        gone = covered(len(words), marks, window) if len(marks) else np.zeros(len(words), bool)
        kept = b" ".join([w for w, g in zip(words, gone.tolist()) if not g]) if len(marks) else b" ".join(words)
        out = (len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest())
        return (*out, kept.decode()) if keep_text else out

    return finish


def substring_dedup(docs: DataFrame, window: int = 50, keep_text: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove each word covered by a ``window``-word sequence that also starts in a document with a smaller doc_id.

    Words are runs of bytes other than space and 0x09-0x0D. One row for each row of ``docs``: doc_id, n_words,
    n_removed, kept_sha256 (kept words joined by one space) and, with ``keep_text``, ``kept``. A null text has
    no words; texts below ``window`` words lose nothing; rows with one doc_id are one document; null doc_ids come
    last, as one document. Other columns are ignored. An empty table gives an empty result.
    """
    if window < PERIOD + 4:
        raise ValueError(f"a window has {PERIOD + 4} words at least")
    columns = (("n_words", "bigint"), ("n_removed", "bigint"), ("kept_sha256", "string"))
    method = Method(window, False, _cut(window), _fetch(window), FOUND, _judge, _finish(window, keep_text), columns + ((("kept", "string"),) if keep_text else ()))
    return mark_repeats(docs, method, id_col, text_col)
