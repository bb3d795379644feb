"""Periodic runs of words, found by block convolution.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are equal) of at least ``max(LEAST, COPIES * q)`` words, which no
neighbouring word extends keeping the period. At each dyadic scale ``L`` a text is cut into blocks of ``L`` words. A block's occurrences at
distances ``L`` to ``2L - 1`` are the zeros of the sums of squared differences between the block and the window of ``2L`` words that follows
it, which an exact integer number-theoretic transform gives for all distances at once. The distances seed extensions to both sides.

Every run of period ``q`` in ``[L, 2L)`` is found: the words ``q`` before its end make at least ``(COPIES - 1) * L`` places, where two whole blocks in a row
occur again at distance ``q``. So only blocks are transformed of which, and of one neighbour, every word stands again less than ``2L`` words later, and
only distances are extended that two blocks in a row share. What the transform finds modulo its prime is compared word by word. Blocks inside a
run that is known, with their window, are left out: by the theorem of Fine and Wilf any period met there is a multiple of the run's own. A
stretch found with several periods keeps the smallest.

Words are runs of characters other than space and 9 to 13, compared unchanged. Texts that are null, empty or blank have no words and no runs.
Runs stay inside their row's text, so repeated rows have equal results and no row's result depends on another. Equal lengths, starts or
periods of different runs are no ties here: all runs are told, by start and then period. A text of any length is worked on whole.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST, COPIES = 6, 4
WORD = re.compile(r"[^\x20\x09-\x0D]+")
PRIME, ROOT, ORDER = 2013265921, 31, 27  # 15 * 2**27 + 1, a primitive root: transforms of up to 2**27 places
TOGETHER = 1 << 18  # words of texts worked on together
PLACES = 1 << 17  # of one transform call, but for longer windows
_P = np.uint64(PRIME)


def _mod(x: np.ndarray) -> np.ndarray:
    return x - (x // _P) * _P


_TWIDDLES: dict[tuple[int, bool], np.ndarray] = {}


def _twiddles(half: int, inverse: bool) -> np.ndarray:
    if (half, inverse) not in _TWIDDLES:
        root = pow(ROOT, (PRIME - 1) // (2 * half), PRIME)
        root = pow(root, -1, PRIME) if inverse else root
        powers = np.ones(1, np.uint64)
        while len(powers) < half:  # doubling: each step multiplies what is there by the next power
            powers = np.concatenate((powers, _mod(powers * np.uint64(pow(root, len(powers), PRIME)))))
        _TWIDDLES[half, inverse] = powers
    return _TWIDDLES[half, inverse]


def transform(x: np.ndarray) -> np.ndarray:
    """Number-theoretic transform of each row (a power of two long), in bit-reversed order."""
    rows, n = x.shape
    half = n // 2
    while half:
        y = x.reshape(rows, -1, 2, half)
        a, b = y[:, :, 0], y[:, :, 1]
        x = np.stack((_mod(a + b), _mod((a + _P - b) * _twiddles(half, False))), axis=2)
        half //= 2
    return x.reshape(rows, n)


def inverse(x: np.ndarray) -> np.ndarray:
    """The rows whose ``transform`` is ``x``."""
    rows, n = x.shape
    half = 1
    while half < n:
        y = x.reshape(rows, -1, 2, half)
        a, b = y[:, :, 0], _mod(y[:, :, 1] * _twiddles(half, True))
        x = np.stack((_mod(a + b), _mod(a + _P - b)), axis=2).reshape(rows, -1)
        half *= 2
    return _mod(x.reshape(rows, n) * np.uint64(pow(n, -1, PRIME)))


def mismatches(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Sums of squared differences, modulo the prime, of blocks of ``L`` numbers and the places 0 to ``L`` of their windows of ``2L``."""
    rows, size = blocks.shape
    b, w = blocks.astype(np.uint64), windows.astype(np.uint64)
    turned = np.zeros((rows, 2 * size), np.uint64)  # turned round, so that the product of transforms is a correlation
    turned[:, 0] = b[:, 0]
    turned[:, : size : -1] = b[:, 1:]
    shared = inverse(_mod(transform(turned) * transform(w)))[:, : size + 1]
    squares = np.concatenate((np.zeros((rows, 1), np.uint64), np.cumsum(_mod(w * w), axis=1)), axis=1)
    whole = squares[:, size:] - squares[:, : size + 1]
    own = _mod(b * b).sum(axis=1, keepdims=True)
    return _mod(_mod(own) + _mod(whole) + np.uint64(2) * (_P - shared))


def _next_distance(ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How far on each word stands again in its text; beyond any length where it does not. ``ends``: of each word's text."""
    order = np.argsort(ids, kind="stable")
    after = np.full(len(ids), 1 << 40, np.int64)
    same = ids[order[1:]] == ids[order[:-1]]
    after[order[:-1][same]] = order[1:][same]
    return np.where(after < ends, after - np.arange(len(ids)), 1 << 40)


def _extent(ids: np.ndarray, first: int, last: int, low: int, high: int, d: int) -> tuple[int, int]:
    """The widest stretch around ``[first, last)`` inside ``[low, high)`` in which words ``d`` apart are equal, as places of their first words."""
    step = 64
    while last < high - d:
        n = min(step, high - d - last)
        same = ids[last : last + n] == ids[last + d : last + d + n]
        if not same.all():
            last += int(same.argmin())
            break
        last, step = last + n, 2 * step
    step = 64
    while first > low:
        n = min(step, first - low)
        same = (ids[first - n : first] == ids[first - n + d : first + d])[::-1]
        if not same.all():
            first -= int(same.argmin())
            break
        first, step = first - n, 2 * step
    return first, last


class _Runs:
    """Runs of the texts that lie one after the other in ``ids``, text ``k`` from ``edges[k]`` to ``edges[k + 1]``."""

    def __init__(self, ids: np.ndarray, edges: np.ndarray):
        self.ids, self.edges = ids, edges
        self.found: dict[tuple[int, int], int] = {}  # stretch to its smallest period so far
        self.known = np.arange(len(ids))  # to where a run that holds this word is known to go, at least to the word itself
        self.padded = np.empty(0, ids.dtype)

    def all(self) -> list[list[tuple[int, int, int]]]:
        """Each text's runs (start, length, period) by start and period."""
        sizes = np.diff(self.edges)
        texts = np.flatnonzero(sizes >= LEAST)
        worst = _next_distance(self.ids, np.repeat(self.edges[1:], sizes))[np.repeat(sizes >= LEAST, sizes)]
        count, size = sizes[texts], 1
        first = np.cumsum(count) - count  # of each text's blocks in ``worst``
        while len(texts):
            self._scale(size, texts, worst, first, count)
            # blocks of twice the size: the worst of two neighbours
            half = count // 2
            texts, first, half = (x[(half >= 2) & (sizes[texts] >= 2 * size * COPIES)] for x in (texts, first, half))
            offset = np.cumsum(half) - half
            at = np.repeat(first - 2 * offset, half) + 2 * np.arange(int(half.sum()))
            worst = np.maximum(worst[at], worst[at + 1])
            first, count, size = offset, half, 2 * size
        out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(self.edges) - 1)]
        for (start, end), period in self.found.items():
            k = int(np.searchsorted(self.edges, start, side="right")) - 1
            out[k].append((start - int(self.edges[k]), end - start, period))
        return [sorted(x, key=lambda r: (r[0], r[2])) for x in out]

    def _scale(self, size: int, texts: np.ndarray, worst: np.ndarray, first: np.ndarray, count: np.ndarray) -> None:
        alive = worst < 2 * size
        pair = alive.copy()  # a block and the next of its text
        pair[:-1] &= alive[1:]
        pair[first + count - 1] = False
        wanted = np.flatnonzero(pair)
        if not len(wanted):
            return
        wanted = np.unique(np.concatenate((wanted, wanted + 1)))
        of = np.searchsorted(first, wanted, side="right") - 1
        begin, end = self.edges[texts[of]] + (wanted - first[of]) * size, self.edges[texts[of] + 1]
        open_ = (begin + 2 * size <= end) & (self.known[begin] < np.minimum(begin + 3 * size, end))
        begin, end = begin[open_], end[open_]
        if len(self.padded) < len(self.ids) + 3 * size:
            self.padded = np.concatenate((self.ids, np.zeros(4 * size, self.ids.dtype)))
        lot = max(1, PLACES // (2 * size))
        met: list[tuple[np.ndarray, np.ndarray]] = []
        for i in range(0, len(begin), lot):
            met.append(self._occurrences(begin[i : i + lot], end[i : i + lot], size))
        if not met:
            return
        starts, distances = (np.concatenate(x) for x in zip(*met))
        order = np.lexsort((starts, distances))
        starts, distances = starts[order], distances[order]
        # neighbouring blocks at one distance belong to one stretch
        fresh = np.ones(len(starts), bool)
        fresh[1:] = (distances[1:] != distances[:-1]) | (starts[1:] != starts[:-1] + size)
        head = np.flatnonzero(fresh)
        tail = np.append(head[1:], len(starts))
        for h, t in zip(head.tolist(), tail.tolist()):
            if t - h > 1:
                self._extend(int(starts[h]), int(starts[t - 1]) + size, int(distances[h]))

    def _occurrences(self, begin: np.ndarray, end: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Blocks (their starts) and the distances at which they stand again inside their text."""
        places = begin[:, None] + np.arange(3 * size)
        words = self.padded[places]
        zero = mismatches(words[:, :size], words[:, size:])[:, :size] == 0
        zero &= np.arange(size) + (begin + 2 * size)[:, None] <= end[:, None]
        row, shift = np.nonzero(zero)
        good = np.ones(len(row), bool)
        for i in range(0, len(row), max(1, PLACES // size)):
            part = slice(i, i + max(1, PLACES // size))
            again = words[row[part, None], (size + shift[part])[:, None] + np.arange(size)]
            good[part] = (words[row[part], :size] == again).all(axis=1)
        return begin[row[good]], size + shift[good]

    def _extend(self, first: int, last: int, d: int) -> None:
        k = int(np.searchsorted(self.edges, first, side="right")) - 1
        start, stop = _extent(self.ids, first, last, int(self.edges[k]), int(self.edges[k + 1]), d)
        stop += d
        if stop - start >= max(LEAST, COPIES * d) and self.found.get((start, stop), d + 1) > d:
            self.found[start, stop] = d
            self.known[start:stop] = np.maximum(self.known[start:stop], stop)


def periodic_runs(texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of each array of numbers from 0 on, by start and period."""
    edges = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    ids = np.concatenate([np.asarray(t, np.int64) for t in texts]) if texts else np.zeros(0, np.int64)
    return _Runs(ids, edges).all()


def collapsed(words: list[str], found: list[tuple[int, int, int]]) -> list[str]:
    """The words that stay: each run keeps its first period."""
    if not found:
        return words
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        gone[start + period] += 1
        gone[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]


def _rows(texts: list[str]) -> tuple[list, list]:
    """Runs and collapsed texts."""
    words = [WORD.findall(t) for t in texts]
    number: dict[str, int] = {}
    ids = [np.fromiter((number.setdefault(w, len(number)) for w in ws), np.int64, len(ws)) for ws in words]
    found = periodic_runs(ids)
    listed = [[{"start": s, "length": n, "period": q} for s, n, q in f] for f in found]
    return listed, [" ".join(collapsed(ws, f)) for ws, f in zip(words, found)]


_RUNS = "array<struct<start:long,length:long,period:long>>"


def with_runs(docs: DataFrame, text: str = "text", out: str = "found") -> DataFrame:
    """``docs`` with the struct ``out``: ``runs`` (start, length, period by start and period; never null) and ``collapsed``, the words that
    stay joined by one space: of each run those after its first period go. An input column called ``out`` is replaced, all others stay."""
    run = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    @F.arrow_udf(f"runs {_RUNS}, collapsed string")
    def search(texts: pa.Array) -> pa.Array:
        runs, kept, lot, size = [], [], [], 0

        def done():
            nonlocal lot, size
            a, b = _rows(lot)
            runs.append(pa.array(a, run))
            kept.append(pa.array(b, pa.string()))
            lot, size = [], 0

        for t in texts:
            lot.append(t.as_py() or "")
            size += len(lot[-1])
            if size >= 4 * TOGETHER:
                done()
        if lot or not runs:
            done()
        return pa.StructArray.from_arrays([pa.concat_arrays(runs), pa.concat_arrays(kept)], ["runs", "collapsed"])

    return docs.withColumn(out, search(F.col(text)))
