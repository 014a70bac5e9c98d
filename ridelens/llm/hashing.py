"""Vectorised word spans and 64-bit hashes over flat byte arrays.

A polynomial hash of every prefix gives the hash of any span by one
subtraction and one multiplication, so hashing each word of a batch costs a few
array operations, whatever the number of words. ``span_hashes`` works modulo
2^64: fast, for features and windows, but regular spans (Thue-Morse words of
1,024 letters) share a hash. ``word_hashes`` works modulo the prime 2^61 - 1 and
is for spans whose identity matters."""

from __future__ import annotations

import hashlib

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        grown = []
        for base in (_BASE, _INVERSE):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            grown.append(np.cumprod(steps, dtype=np.uint64))
        _POWERS[:] = grown
    return _POWERS[0][:n], _POWERS[1][:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and odd multiplications)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True that do not cross an offset."""
    n = mask.size
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    start, end = mask.copy(), mask.copy()
    start[1:] &= ~mask[:-1]
    end[:-1] &= ~mask[1:]
    first = offsets[:-1][offsets[:-1] < n]
    start[first] = mask[first]
    last = offsets[1:][offsets[1:] > 0] - 1
    end[last] = mask[last]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of ``data``, the same for the same bytes."""
    n = data.size
    if not len(starts):
        return np.empty(0, np.uint64)
    power, inverse = _powers(n + 1)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=prefix[1:])
    raw = (prefix[ends] - prefix[starts]) * inverse[starts]
    return mix64(raw ^ ((ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


_P = np.uint64((1 << 61) - 1)
_P_BASE = 0x1B5AD4A3C9E0F72B % ((1 << 61) - 1)
_P_INVERSE = pow(_P_BASE, -1, (1 << 61) - 1)
_P_POWERS: list[np.ndarray] = []
#: Bytes that are hashed side by side, and spans beyond which each stands alone.
_CHUNK, _LONG = 1 << 15, 1 << 16


def mul61(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo 2^61 - 1, of numbers below it."""
    low, half = np.uint64((1 << 31) - 1), np.uint64(31)
    a1, a0, b1, b0 = a >> half, a & low, b >> half, b & low
    middle = a1 * b0 + a0 * b1
    carry = np.uint64((1 << 30) - 1)
    total = (a1 * b1 << np.uint64(1)) + (middle >> np.uint64(30)) + ((middle & carry) << half) + a0 * b0
    return _reduced(total)


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & _P) + (x >> np.uint64(61))
    return np.where(x >= _P, x - _P, x)


def _powers61(n: int) -> list[np.ndarray]:
    """The powers of the base, high and low halves, and of its inverse."""
    if not _P_POWERS or len(_P_POWERS[0]) < n:
        grown = []
        for base in (_P_BASE, _P_INVERSE):
            out = np.ones(1, np.uint64)
            while len(out) < max(n, 1 << 16):
                step = np.uint64(pow(base, len(out), (1 << 61) - 1))
                out = np.concatenate([out, mul61(out, step)])
            grown.append(out)
        _P_POWERS[:] = [grown[0] >> np.uint64(32), grown[0] & np.uint64(0xFFFFFFFF), grown[1]]
    return _P_POWERS


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of ``data``, modulo a prime before it is
    mixed, the same for the same bytes. Memory does not grow with ``data``."""
    if len(starts) and (np.diff(starts) < 0).any():
        order = np.argsort(starts, kind="stable")
        out = np.empty(len(starts), np.uint64)
        out[order] = word_hashes(data, starts[order], ends[order])
        return out
    sizes = ends - starts
    out = np.empty(len(starts), np.uint64)
    for i in np.flatnonzero(sizes > _LONG):
        whole = hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
        out[i] = int.from_bytes(whole, "little") >> 3
    short = np.flatnonzero(sizes <= _LONG)
    cuts = [0, *(np.flatnonzero(np.diff(starts[short] // _CHUNK)) + 1), len(short)] if len(short) else [0]
    for a, b in zip(cuts, cuts[1:]):
        some = short[a:b]
        first, last = int(starts[some[0]]), int(ends[some].max())
        out[some] = _hashes61(data[first:last], starts[some] - first, ends[some] - first)
    return mix64(out ^ mix64(sizes.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def _hashes61(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    n = data.size
    *halves, inverse = _powers61(n + 1)
    value = data.astype(np.uint64) + np.uint64(1)
    sums = []
    for half in halves:
        prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(value * half[:n], out=prefix[1:])
        sums.append(_reduced(prefix[ends] - prefix[starts]))
    high = (sums[0] << np.uint64(32) & _P) | sums[0] >> np.uint64(29)  # times 2^32
    whole = _reduced(high + sums[1])
    return mul61(whole, inverse[starts])


def rows_of(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each of the n + 1 offsets, how many of the sorted starts lie before it."""
    return np.searchsorted(starts, offsets, side="left")
