"""A count-min sketch of which hashes occur at least twice, built per partition and merged.

Each of ``depth`` rows has ``2 ** bits`` cells, and a cell only tells none, one, or more than one, so two bit maps per row hold it. Counts are
never under-estimated: a hash that occurs twice always shows as repeated; a hash that occurs once may. The merged "more than one" maps are
``depth * 2 ** bits / 8`` bytes (32 MB by default) whatever the corpus, which bounds the broadcast. On a corpus too large for it the sketch lets more
single hashes through to the exact pass behind it and still loses none; ``bits`` is the parameter to raise then. More rows of fewer cells
take the same room and let fewer single hashes through while the maps are thinly filled, but each row costs a pass over the hashes.

Hot hashes come out of the same pass: each batch reports what it saw at least ``HOT_IN_BATCH`` times, and the sums of at least
``max(least, total / HOT_MOST)`` are listed, so the list holds at most ``HOT_MOST`` entries.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.hashing import U, mix

DEPTH = 2
BITS = 27
BLOCKS = 32  # parts of a bit map that are merged apart from each other
FAN_IN = 32  # partition sketches merged at a time
HOT_IN_BATCH = 8
HOT_MOST = 500_000
SALTS = (U(0xE7037ED1A0B428DB), U(0xA0761D6478BD642F), U(0x8EBC6AF09C88C6E3), U(0x589965CC75374CC3))


def cells(hashes: np.ndarray, row: int, bits: int) -> np.ndarray:
    """Mixed in every row: the smallest hashes of windows lie at the low end, so their own first bits would crowd into a few cells."""
    return mix(hashes ^ SALTS[row]) >> U(64 - bits)


def _set(bitmap: np.ndarray, sorted_cells: np.ndarray) -> None:
    if not len(sorted_cells):
        return
    place, bit = (sorted_cells >> U(3)).astype(np.int64), np.left_shift(1, (sorted_cells & U(7)).astype(np.uint8), dtype=np.uint8)
    first = np.concatenate(([0], np.flatnonzero(place[1:] != place[:-1]) + 1))
    bitmap[place[first]] |= np.bitwise_or.reduceat(bit, first)


def _get(bitmap: np.ndarray, cell: np.ndarray) -> np.ndarray:
    return (bitmap[(cell >> U(3)).astype(np.int64)] >> (cell & U(7)).astype(np.uint8)) & 1 > 0


class Sketch:
    def __init__(self, bits: int = BITS, depth: int = DEPTH):
        self.bits = bits
        self.once = np.zeros((depth, 1 << (bits - 3)), np.uint8)
        self.more = np.zeros((depth, 1 << (bits - 3)), np.uint8)

    def add(self, hashes: np.ndarray) -> None:
        for row in range(len(self.more)):
            cell, n = np.unique(cells(hashes, row, self.bits), return_counts=True)
            _set(self.more[row], cell[(n > 1) | _get(self.once[row], cell)])
            _set(self.once[row], cell)


class Repeated:
    """The merged maps: ``test`` tells which hashes may occur more than once."""

    def __init__(self, more: list[np.ndarray | bytes], bits: int, hot: np.ndarray, total: int):
        self.more, self.bits, self.hot, self.total = [np.frombuffer(m, np.uint8) for m in more], bits, hot, total

    def test(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), bool)
        for row, bitmap in enumerate(self.more):
            out &= _get(bitmap, cells(hashes, row, self.bits))
        return out

    def is_hot(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hot) or not len(hashes):
            return np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.hot, hashes), len(self.hot) - 1)
        return self.hot[at] == hashes


_SCHEMA = "block int, part int, once binary, more binary, total long"
_FIELDS = pa.schema([("block", pa.int32()), ("part", pa.int32()), ("once", pa.binary()), ("more", pa.binary()), ("total", pa.int64())])
_HOT = np.dtype([("hash", "<u8"), ("n", "<i8")])


def _pack(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(x.tobytes())


def _unpack(x: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(x), np.uint8)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), _FIELDS)], schema=_FIELDS)


def _hot_rows(found: list[np.ndarray], part: int) -> tuple:
    every = np.concatenate(found) if found else np.zeros(0, _HOT)
    value, at = np.unique(every["hash"], return_inverse=True)
    out = np.zeros(len(value), _HOT)
    out["hash"] = value
    np.add.at(out["n"], at, every["n"])
    if len(out) > 4 * HOT_MOST:  # the list only balances load, so the least of many may go
        out = np.sort(out[np.argsort(out["n"])[-4 * HOT_MOST :]], order="hash")
    return (-1, part, out.tobytes(), b"")


def _emit(sketch: Sketch, part: int, hot: list[np.ndarray], total: int) -> Iterator[pa.RecordBatch]:
    yield _batch([(*_hot_rows(hot, part), total)])
    size = sketch.once.shape[1] // BLOCKS
    for row in range(len(sketch.once)):
        for b in range(BLOCKS):
            piece = slice(b * size, (b + 1) * size)
            if sketch.once[row, piece].any():
                yield _batch([(row * BLOCKS + b, part, _pack(sketch.once[row, piece]), _pack(sketch.more[row, piece]), 0)])


def _merge(rows: pa.Table) -> pa.Table:
    """Rows of one block to one row. At most ``FAN_IN`` of them are ever in a group."""
    block, part = rows["block"][0].as_py(), rows["part"][0].as_py()
    if block < 0:
        hot = [np.frombuffer(x.as_py(), _HOT) for x in rows["once"]]
        out = (*_hot_rows(hot, part), sum(rows["total"].to_pylist()))
    else:
        once, more = None, None
        for o, m in zip(rows["once"], rows["more"]):
            o, m = _unpack(o.as_py()), _unpack(m.as_py())
            once, more = (o.copy(), m.copy()) if once is None else (once | o, more | m | (once & o))
        out = (block, part, _pack(once), _pack(more), 0)
    return pa.Table.from_batches([_batch([out])])


def repeated(df: DataFrame, hashes: Callable[[pa.RecordBatch], Iterator[np.ndarray]], bits: int = BITS, hot_least: int = 100_000, depth: int = DEPTH) -> Repeated:
    """Sketch of the hashes that ``hashes`` gives for each batch of ``df``."""

    def sketch(batches):
        own, hot, total = Sketch(bits, depth), [], 0
        for batch in batches:
            for found in hashes(batch):
                own.add(found)
                total += len(found)
                value, n = np.unique(found, return_counts=True)
                often = np.zeros(int((n >= HOT_IN_BATCH).sum()), _HOT)
                often["hash"], often["n"] = value[n >= HOT_IN_BATCH], n[n >= HOT_IN_BATCH]
                hot.append(often)
        if total:
            yield from _emit(own, TaskContext.get().partitionId(), hot, total)

    rows, parts = df.mapInArrow(sketch, _SCHEMA), df.rdd.getNumPartitions()
    while True:
        rows = rows.withColumn("part", (F.col("part") / FAN_IN).cast("int")).groupBy("block", "part").applyInArrow(_merge, _SCHEMA)
        parts = -(-parts // FAN_IN)
        if parts <= 1:
            break
    more, hot, total = [np.zeros(1 << (bits - 3), np.uint8) for _ in range(depth)], np.zeros(0, _HOT), 0
    size = len(more[0]) // BLOCKS
    needed = F.when(F.col("block") < 0, F.col("once")).alias("once")  # the maps of hashes met once have done their work
    for r in rows.select("block", needed, "more", "total").collect():  # depth x BLOCKS rows of a fixed size, and one of hot hashes
        if r["block"] < 0:
            hot, total = np.frombuffer(bytes(r["once"]), _HOT), r["total"]
        else:
            row, b = divmod(r["block"], BLOCKS)
            more[row][b * size : (b + 1) * size] = _unpack(bytes(r["more"]))
    listed = np.sort(hot["hash"][hot["n"] >= max(hot_least, total // HOT_MOST)])
    return Repeated(more, bits, listed, total)
