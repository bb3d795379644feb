"""Passages that documents share, found without comparing documents: the common part of the two exact substring operators.

A window is a fixed number of units (bytes or words) of one text. Its anchor is the smallest hash among the grams inside it, which depends on
the window's content alone, so equal windows have equal anchors; consecutive windows with the same anchor form a segment. Anchors that occur
once are dropped by a merged count-min sketch. The other segments meet by anchor (one shuffle), where a solver of the operator tells
which of their windows to remove.

Equal segments of a batch travel as one row with all their places. Anchors that are hot are split: each of their windows goes by a hash
of its own content, so unequal ones spread over the cluster and equal ones collapse.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm import sketch
from quarterdeck.llm.hashing import mix, runs

NO_ID = (1 << 63) - 1  # stands for a null doc_id: larger than every id
CHUNK = 4 << 20  # bytes of hot segments solved together
SEGMENTS = 150_000  # distinct segments gathered at a time
HOT_LEAST = 100_000  # places of an anchor that may meet in one task, some 10 MB
SEGMENTS_A_TASK = 2_000_000  # of all segments, most of which the sketch drops

PLACE = np.dtype([("doc", "<i8"), ("twin", "<i8"), ("at", "<i4")])


class Cut(NamedTuple):
    """Segments of one text: anchor, first and last + 1 window, bytes that stand for windows ``i`` to ``j``, a hash per window, and the
    anchor once for each place it has (more than the segments where one segment repeats itself)."""

    anchor: np.ndarray
    start: np.ndarray
    end: np.ndarray
    content: Callable[[int, int], bytes]
    subkey: Callable[[np.ndarray], np.ndarray]
    met: np.ndarray


Cutter = Callable[[str], Iterator[Cut]]


def segments(minimum: np.ndarray, first: int, content, subkey, met: np.ndarray | None = None) -> Cut:
    start, end = runs(minimum)
    return Cut(minimum[start], start + first, end + first, content, subkey, minimum[start] if met is None else met)


#: Segments of a batch bound for one shard travel as one compressed row; segments of hot anchors as a row each (shard below zero).
_SCHEMA = "shard long, key long, low long, content binary, places binary"
_FIELDS = pa.schema([("shard", pa.int64()), ("key", pa.int64()), ("low", pa.int64()), ("content", pa.binary()), ("places", pa.binary())])
_OUT = "doc long, twin long, start int, end int"
_OUT_FIELDS = pa.schema([("doc", pa.int64()), ("twin", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])


def ids_repeat(docs: DataFrame, doc_id: str = "doc_id") -> bool:
    return not docs.groupBy(F.col(doc_id).cast("long")).count().where("count > 1").limit(1).isEmpty()


def gap(docs: DataFrame, doc_id: str = "doc_id") -> int | None:
    """Where a null id and the id ``NO_ID`` both occur, the largest id that no row has; ids above it go down by one. Else nothing."""
    own = F.col(doc_id).cast("long")
    nulls, top = docs.agg(F.count_if(own.isNull()), F.max(own)).first()
    if not nulls or top != NO_ID:
        return None
    ids = docs.where(own.isNotNull()).select(own.alias("i")).distinct()
    below = ids.where(F.col("i") > -NO_ID - 1).select((F.col("i") - 1).alias("i"))
    return below.join(ids, "i", "left_anti").agg(F.max("i")).first()[0]


def keyed(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with ``_doc`` (the id, null as ``NO_ID``, see ``gap``) and ``_twin``, which tells rows of one id apart by their text where ids repeat."""
    own, free = F.col(doc_id).cast("long"), gap(docs, doc_id)
    if free is not None:
        own = F.when(own > free, own - 1).otherwise(own)
    twin = F.conv(F.substring(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256), 1, 15), 16, 10).cast("long") if ids_repeat(docs, doc_id) else F.lit(0).cast("long")
    return docs.withColumns({"_doc": F.coalesce(own, F.lit(NO_ID)), "_twin": twin})


def _packed(rows: list[tuple[int, bytes, list]]) -> bytes:
    """Segments as columns, compressed together."""
    places = np.array([p for _, _, at in rows for p in at], PLACE)
    head = np.array([(k, len(c), len(at)) for k, c, at in rows], [("key", "<i8"), ("size", "<i4"), ("n", "<i4")])
    columns = [np.int64(len(rows)).tobytes(), *(np.ascontiguousarray(head[c]).tobytes() for c in head.dtype.names)]
    columns += [*(np.ascontiguousarray(places[c]).tobytes() for c in PLACE.names), *(c for _, c, _ in rows)]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(columns))


def _unpacked(blob: bytes) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
    """Keys, contents, how many places each has, and the places."""
    data, at = zstandard.ZstdDecompressor().decompress(blob), 8

    def column(kind: str, n: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(data, kind, n, at)
        at += out.nbytes
        return out

    rows = int(np.frombuffer(data, "<i8", 1)[0])
    key, size, n = column("<i8", rows), column("<i4", rows), column("<i4", rows)
    places = np.empty(int(n.sum()), PLACE)
    for name in PLACE.names:
        places[name] = column(PLACE[name].str, len(places))
    end = (at + np.cumsum(size)).tolist()
    return key, [data[i:j] for i, j in zip([at, *end], end)], n, places


def _emitted(found: dict[tuple[int, bytes], list], hot: dict[tuple[int, bytes], list], shards: int) -> pa.RecordBatch:
    by_shard: dict[int, list] = {}
    for (key, content), places in found.items():
        by_shard.setdefault(key % shards, []).append((key, content, places))
    rows = [(shard, 0, 0, _packed(lot), b"") for shard, lot in by_shard.items()]
    rows += [(-1 - key % shards, key, min(places)[0], content, np.array(places, PLACE).tobytes()) for (key, content), places in hot.items()]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _FIELDS)], schema=_FIELDS)


def _rows(batches: Iterator[pa.RecordBatch], cut: Cutter, known: sketch.Repeated, shards: int) -> Iterator[pa.RecordBatch]:
    found: dict[tuple[int, bytes], list] = {}
    split: dict[tuple[int, bytes], list] = {}
    for batch in batches:
        for text, doc, twin in zip(batch["text"], batch["_doc"].to_pylist(), batch["_twin"].to_pylist()):
            text = text.as_py()
            for part in cut(text) if text else ():
                keep = np.flatnonzero(known.test(part.anchor))
                hot = known.is_hot(part.anchor[keep])
                plain, get = keep[~hot], part.content
                for key, i, j in zip(part.anchor[plain].view(np.int64).tolist(), part.start[plain].tolist(), part.end[plain].tolist()):
                    found.setdefault((key, get(i, j)), []).append((doc, twin, i))
                for k in keep[hot].tolist():
                    windows = np.arange(part.start[k], part.end[k])
                    sub = mix(part.subkey(windows) ^ part.anchor[k])
                    for key, i in zip(sub.view(np.int64).tolist(), windows.tolist()):
                        split.setdefault((key, get(i, i + 1)), []).append((doc, twin, i))
                if len(found) + len(split) >= SEGMENTS:
                    yield _emitted(found, split, shards)
                    found, split = {}, {}
    if found or split:
        yield _emitted(found, split, shards)


class Lot(NamedTuple):
    """Distinct segments that met, by rising key and smallest document, and all their places."""

    key: np.ndarray  # of each content
    low: np.ndarray  # its smallest document
    before: np.ndarray  # how many of its places were in an earlier lot
    contents: list[bytes]
    owner: np.ndarray  # the content of each place
    places: np.ndarray


#: Gives (places, first window, last window + 1) of the windows to remove, places and windows as arrays of one length.
Solver = Callable[[Lot], Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]]


def _lot(key: list[int], low: list[int], contents: list[bytes], n: np.ndarray, places: np.ndarray, before: list[int] | None = None) -> Lot:
    """Rows in order of key and smallest document to distinct contents."""
    number: dict[tuple[int, bytes], int] = {}
    first, owner = [], []
    for k, pair in enumerate(zip(key, contents)):
        at = number.setdefault(pair, len(first))
        if at == len(first):
            first.append(k)
        owner.append(at)
    seen = np.zeros(len(first), np.int64)
    if before is not None:
        np.add.at(seen, owner, before)
    keys, lows = np.array(key, np.int64)[first], np.array(low, np.int64)[first]
    return Lot(keys, lows, seen, [contents[k] for k in first], np.repeat(np.array(owner, np.int64), n), places)


def _told(solve: Solver, lot: Lot) -> Iterator[pa.RecordBatch]:
    out = [x for x in solve(lot) if len(x[0])]
    if out:
        places, start, end = (np.concatenate(x) for x in zip(*out))
        columns = [places["doc"], places["twin"], (places["at"] + start).astype(np.int32), (places["at"] + end).astype(np.int32)]
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], schema=_OUT_FIELDS)


def _shard(blobs: list[bytes], solve: Solver) -> Iterator[pa.RecordBatch]:
    parts = [_unpacked(b) for b in blobs]
    key, n, places = (np.concatenate([p[k] for p in parts]) for k in (0, 2, 3))
    contents = [c for p in parts for c in p[1]]
    first = np.cumsum(n) - n
    low = np.minimum.reduceat(places["doc"], first)
    order = np.lexsort((low, key))
    n = n[order]
    at = np.repeat(first[order] - (np.cumsum(n) - n), n) + np.arange(len(places))
    yield from _told(solve, _lot(key[order].tolist(), low[order].tolist(), [contents[k] for k in order.tolist()], n, places[at]))


class _Hot:
    """Rows of hot anchors, streamed by key and smallest document; one key's rows may be more than fit in memory.

    When a key goes on after a chunk, contents met more than once stay as sources without places. Those met once stay whole: telling the
    same run twice does no harm.
    """

    def __init__(self, solve: Solver):
        self.solve, self.rows, self.size = solve, [], 0

    def add(self, key: int, low: int, content: bytes, places: bytes) -> Iterator[pa.RecordBatch]:
        if self.size >= CHUNK:
            yield from self.flush(key)
        self.rows.append((key, low, content, np.frombuffer(places, PLACE), 0))
        self.size += len(content) + len(places)

    def flush(self, following: int | None = None) -> Iterator[pa.RecordBatch]:
        if not self.rows:
            return
        key, low, contents, places, before = (list(x) for x in zip(*self.rows))
        lot = _lot(key, low, contents, np.array([len(p) for p in places]), np.concatenate(places), before)
        yield from _told(self.solve, lot)
        self.rows, self.size = [], 0
        if following == key[-1]:
            times = np.bincount(lot.owner, minlength=len(lot.contents)) + lot.before
            for k in np.flatnonzero(lot.key == following).tolist():
                once = times[k] == 1
                self.rows.append((following, int(lot.low[k]), lot.contents[k], lot.places[lot.owner == k] if once else lot.places[:0], 0 if once else int(times[k])))


def shared_windows(docs: DataFrame, cut: Cutter, solve: Solver, hot_least: int = HOT_LEAST, bits: int = sketch.BITS) -> DataFrame:
    """Runs of windows to remove: ``doc, twin, start, end`` in window numbers. ``docs`` comes from ``keyed`` and has ``text``."""
    texts, spark = docs.select("_doc", "_twin", "text"), docs.sparkSession

    def anchors(batch: pa.RecordBatch):
        found = [part.met for text in batch["text"] if (t := text.as_py()) for part in cut(t)]
        if found:
            yield np.concatenate(found)

    merged = sketch.repeated(texts.select("text"), anchors, bits, hot_least)
    known = spark.sparkContext.broadcast(merged)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), merged.total // SEGMENTS_A_TASK)
    shards = 4 * tasks

    def rows(batches):
        yield from _rows(batches, cut, known.value, shards)

    def solved(batches):
        shard, blobs, hot = None, [], _Hot(solve)
        for batch in batches:
            for s, key, low, content, places in zip(*(batch[c].to_pylist() for c in _FIELDS.names)):
                if s < 0:
                    yield from hot.add(key, low, content, places)
                    continue
                if s != shard and blobs:
                    yield from _shard(blobs, solve)
                    blobs = []
                shard = s
                blobs.append(content)
        yield from hot.flush()
        if blobs:
            yield from _shard(blobs, solve)

    met = texts.mapInArrow(rows, _SCHEMA).repartition(tasks, "shard").sortWithinPartitions("shard", "key", "low")
    return met.mapInArrow(solved, _OUT)


def by_document(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` with the arrays ``_start`` and ``_end`` of their runs, null without any. A document's runs are no more than its windows."""
    listed = found.groupBy("doc", "twin").agg(F.collect_list(F.struct("start", "end")).alias("runs"))
    listed = listed.select(F.col("doc").alias("_doc"), F.col("twin").alias("_twin"), F.col("runs.start").alias("_start"), F.col("runs.end").alias("_end"))
    return docs.join(listed, ["_doc", "_twin"], "left")


def covered(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of ``n`` units the spans cover."""
    change = np.bincount(start, minlength=n + 1)[: n + 1] - np.bincount(end, minlength=n + 1)[: n + 1]
    return np.cumsum(change[:n]) > 0
