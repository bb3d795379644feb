"""Hashes of words, n-grams and byte strings as numpy arrays; the same on every machine and in every process."""

from __future__ import annotations

import hashlib

import numpy as np

U = np.uint64
LONG_WORD = 256
_GOLD, _M1, _M2 = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
_BASE = U(0xD6E8FEB86659FD93)  # odd: every power has an inverse modulo 2**64

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values with well spread bits."""
    x = (x ^ (x >> U(30))) * _M1
    x = (x ^ (x >> U(27))) * _M2
    return x ^ (x >> U(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _GOLD)


class _Powers:
    """Powers of the base and of its inverse, as far as needed so far."""

    def __init__(self):
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            self.up, self.down = (np.cumprod(np.concatenate(([U(1)], np.full(size - 1, f, np.uint64)))) for f in (_BASE, U(pow(int(_BASE), -1, 1 << 64))))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def sums(values: np.ndarray) -> np.ndarray:
    """Prefix sums of values x powers, with a leading zero: any range's polynomial hash is one subtraction away."""
    up, _ = _POWERS.get(len(values))
    return np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * up)))


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = _POWERS.get(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64) * _GOLD)


def words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of UTF-8 bytes: runs of bytes other than space and 9 to 13."""
    inside = ~SPACE[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edge = np.concatenate(([0], edge))
    if len(inside) and inside[-1]:
        edge = np.concatenate((edge, [len(inside)]))
    return edge[::2], edge[1::2]


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each word. Sums modulo 2**64 agree for certain words of a thousand bytes whatever the base, so long words have a digest."""
    out = range_hash(sums(_BYTE[data]), start, end)
    for k in np.flatnonzero(end - start >= LONG_WORD).tolist():
        out[k] = int.from_bytes(hashlib.blake2b(data[start[k] : end[k]].tobytes(), digest_size=8).digest(), "little")
    return out


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, other bytes as they are."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive values."""
    out = mix(hashes[: len(hashes) - n + 1] + _GOLD) if len(hashes) >= n else np.zeros(0, np.uint64)
    for k in range(1, n):
        out = mix(out * _M2 + hashes[k : len(hashes) - n + 1 + k])
    return out


def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of the lower-cased word n-grams; with fewer words the whole sequence is the one shingle, with none there is none."""
    data = lower(np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8))
    start, end = words(data)
    if not len(start):
        return np.zeros(0, np.uint64)
    hashes = word_hashes(data, start, end)
    return np.unique(ngrams(hashes, min(n, len(hashes))))


def byte_words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on, as one integer each."""
    n = len(data) - 7
    out = np.empty(max(n, 0), np.uint64)
    for k in range(min(8, max(n, 0))):
        part = data[k : k + (len(data) - k) // 8 * 8].view(np.uint64)
        out[k::8] = part[: len(out[k::8])]
    return out


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    out, span = values, 1
    while span * 2 <= width:
        out, span = np.minimum(out[:-span], out[span:]), span * 2
    return np.minimum(out[: len(out) - (width - span)], out[width - span :]) if span < width else out


def runs(minimum: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal values."""
    cut = np.flatnonzero(minimum[1:] != minimum[:-1]) + 1
    return np.concatenate(([0], cut)), np.concatenate((cut, [len(minimum)]))
