"""Ids of texts by a tokenizer whose words never reach over white space.

The words of a few MB of text are looked up together. Only words not seen by the worker yet go to the tokenizer, and the
ids of a text are put together from those of its words. What a worker remembers is bounded.
"""

from __future__ import annotations

import ctypes
import os
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from wattframe.llm import parcels

#: Words whose ids a worker remembers (about 200 bytes each), bytes of text encoded together.
REMEMBERED, CHUNK_BYTES = 250_000, 8 << 20
#: Marks that are looked up apart when they stand alone behind letters; the first code point not taken for plain Latin.
TAILS, LATIN_END = ".,!?;:)", "\u0130"


def release_memory() -> None:
    """Give freed memory back to the system; a worker that waits for its next stage then holds little."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def _packed(ids) -> bytes:
    return np.asarray(ids, "<u4").tobytes()


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers; ``path`` None: ``word_bpe_49k.json``."""

    def __init__(self, path: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("word_bpe_49k.json")
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.vocabulary_size = max(vocabulary.values()) + 1
        self.packed = [_packed([i]) for i in range(self.vocabulary_size)]
        self.mark = {m: _packed(self.tokenizer.encode(m, add_special_tokens=False).ids) for m in TAILS}
        # How the model's vocabulary spells letters: each byte of their UTF-8 as one character.
        spelt = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.letters = {c: spelt(chr(c))[0][0] for c in range(ord(LATIN_END)) if chr(c).isalpha()}
        self.known: dict[str, bytes] = {}

    def _learn(self, words: list[str]) -> list[bytes]:
        """Ids of words. Letters are one pre-token, one mark behind them another."""
        place: dict[str, int] = {}
        stems, other, mark = [], [], self.mark
        for i, w in enumerate(words):
            if w.isalpha():
                stems.append((i, place.setdefault(w, len(place)), b""))
            elif w[-1:] in mark and w[:-1].isalpha():
                stems.append((i, place.setdefault(w[:-1], len(place)), mark[w[-1]]))
            else:
                other.append(i)
        found, out = self._letters(list(place)), [b""] * len(words)
        for i, at, tail in stems:
            out[i] = found[at] + tail
        for i, e in zip(other, self.tokenizer.encode_batch_fast([words[i] for i in other], add_special_tokens=False)):
            out[i] = _packed(e.ids)
        return out

    def _letters(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters."""
        if not words:
            return []
        plain = " ".join(words).lower()
        # Latin letters that are composed already and whose lower case is the same to everyone go to the model itself.
        if max(plain) < LATIN_END and unicodedata.is_normalized("NFC", plain):
            tokenize, packed = self.tokenizer.model.tokenize, self.packed
            return [b"".join([packed[x.id] for x in tokenize(w)]) for w in plain.translate(self.letters).split(" ")]
        return [_packed(e.ids) for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _known(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words."""
        found = list(map(self.known.get, words))
        new = [i for i, ids in enumerate(found) if ids is None]
        learned = self._learn([words[i] for i in new])
        for i, ids in zip(new, learned):
            found[i] = ids
        if len(self.known) + len(new) <= REMEMBERED:  # what comes first is frequent
            self.known.update(zip([words[i] for i in new], learned))
        return found

    def _ids(self, texts: pa.LargeStringArray) -> list[bytes]:
        """Arrow tells the distinct words; Python sees only these, and numpy puts the texts' ids together."""
        # The tokenizer's lower case covers that of ASCII letters; its special tokens are told apart before.
        if b"<|" in texts.buffers()[2].to_pybytes():
            texts = pa.array([t if "<|" in t else t.lower() if t.isascii() else t.encode().lower().decode() for t in texts.to_pylist()], pa.large_string())
        else:
            texts = pc.ascii_lower(texts)
        words = pc.ascii_split_whitespace(texts)
        coded = words.flatten().dictionary_encode()
        ids = self._known(coded.dictionary.to_pylist()) if len(coded) else []
        flat, size = np.frombuffer(b"".join(ids), "<u4"), np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        which = np.asarray(coded.indices)
        n = size[which] if len(ids) else np.zeros(0, np.int64)
        to = np.cumsum(n)
        first = np.repeat((np.cumsum(size) - size)[which] - (to - n), n) if len(ids) else n
        raw = flat[first + np.arange(len(first))].tobytes()
        edge = 4 * np.append(0, to)[np.asarray(words.offsets)]
        return [raw[a:b] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]

    def encode(self, off: np.ndarray, data: np.ndarray) -> Iterator[bytes]:
        """Ids of each text of an Arrow column given as offsets and bytes."""
        for a, b in parcels.chunks(off, CHUNK_BYTES):
            if b - a == 1 and off[b] - off[a] > 4 * CHUNK_BYTES:
                yield b"".join(self._long(data[off[a] : off[b]].tobytes()))
            else:
                yield from self._ids(_strings(off[a : b + 1] - off[a], data[off[a] : off[b]].tobytes()))

    def _long(self, text: bytes) -> Iterator[bytes]:
        """A very long text by pieces that end at white space."""
        at = 0
        while at < len(text):
            to = min(len(text), at + CHUNK_BYTES)
            while to < len(text) and text[to] not in b" \t\n\r\v\f":
                to += 1
            yield self._ids(_strings(np.array([0, to - at]), text[at:to]))[0]
            at = to


def _strings(off: np.ndarray, data: bytes) -> pa.LargeStringArray:
    return pa.LargeStringArray.from_buffers(len(off) - 1, pa.py_buffer(np.ascontiguousarray(off, np.int64)), pa.py_buffer(data))


def forget() -> None:
    """Drop this worker's encoder and give its memory back; for tasks after which a worker serves other stages."""
    _kept.clear()
    release_memory()


_kept: dict[str | None, Encoder] = {}


def encoder(path: str | None = None) -> Encoder:
    """The encoder of this worker; what it remembers serves the worker's next tasks too."""
    if path not in _kept:
        _kept.clear()
        _kept[path] = Encoder(path)
    return _kept[path]
