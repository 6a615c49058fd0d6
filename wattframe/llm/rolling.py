"""Fingerprints of substrings: one prefix sum over an array, then any substring in constant time.

The fingerprint of ``v[a:b]`` is ``sum(v[i] * M**(i - a))`` modulo 2**64, mixed at the end. ``M`` is odd, so
its powers have inverses and the sum can be shifted to the start of the substring.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_MULTIPLIERS = (_U(0x9E3779B97F4A7C15), _U(0xD1342543DE82EF95))
_INVERSES = tuple(_U(pow(int(m), -1, 2**64)) for m in _MULTIPLIERS)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; a bijection."""
    x = x ^ (x >> _U(31))
    x *= _U(0x7FB5D329728EA185)
    x ^= x >> _U(27)
    x *= _U(0x81DADEF4BC2DD44D)
    x ^= x >> _U(33)
    return x


def byte_values(seed: int) -> np.ndarray:
    """One fixed 64-bit value for each of the 256 bytes."""
    return mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15) + _U(seed))


BYTES = byte_values(7)


def _powers_of(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _powers.get(which)
    if have is None or len(have[0]) < n:
        size = max(1 << 16, 1 << int(n - 1).bit_length())
        up, down = np.full(size, _MULTIPLIERS[which]), np.full(size, _INVERSES[which])
        up[0] = down[0] = 1
        have = _powers[which] = (np.cumprod(up), np.cumprod(down))
    return have


def forget() -> None:
    """Drop the tables of powers, which are as long as the longest text so far."""
    _powers.clear()


class Rolling:
    """Fingerprints of any substring of ``values`` (unsigned 64-bit)."""

    def __init__(self, values: np.ndarray, which: int = 0):
        up, self._down = _powers_of(which, len(values) + 1)
        self._sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=self._sums[1:])

    def of(self, start: np.ndarray, length) -> np.ndarray:
        raw = self._sums[start + length]
        raw -= self._sums[start]
        raw *= self._down[start]
        return mix(raw)

    def every(self, length: int) -> np.ndarray:
        """Of all substrings of one length, by start."""
        n = max(0, len(self._sums) - length)
        raw = self._sums[length : length + n] - self._sums[:n]
        raw *= self._down[:n]
        return mix(raw)


def word_starts(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes other than space and 0x09-0x0D."""
    blank = np.ones(len(data) + 2, bool)
    blank[1:-1] = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(blank[1:] != blank[:-1])
    return edge[0::2], edge[1::2]


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` neighbours, by start."""
    done = 1
    while done < width:
        step = min(done, width - done)
        v = np.minimum(v[: len(v) - step], v[step:])
        done += step
    return v
