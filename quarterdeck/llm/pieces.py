"""Encoding into sentence pieces and decoding back: Unigram Viterbi over a double-array trie, with byte fallback.

The dictionary is the piece list of a public model file, read on the driver and broadcast (its size is the vocabulary's). Spaces become
the marker ``▁``, one marker is put before the text, nothing else is normalised. Pieces hold markers only in front, and no piece holds a
character outside the dictionary's own, so the best path of a text is the best paths of its units (a run of markers with the characters
up to the next marker, cut at line feeds when these are in no piece), and each Python worker keeps the paths of the units it met, in
caches bounded by bytes. The short units of some texts that are not in it go through the trie together, one place at a time. Ties go to the longer last piece. Characters that no path reaches by pieces become their UTF-8 byte pieces.

Log scores: the file's pieces are ranked by merge order, not scored by frequency, so ``scores="zipf"`` gives rank r the log probability
``-ln(r + 1) - ln(H_n)``; ``scores="file"`` takes the stored scores as they are.

Null texts encode to no pieces and decode to the empty text; so do empty texts. A text that holds the marker itself decodes with spaces there.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK = "▁"
CACHE_BYTES = 32 << 20  # of the units after a space; those at the start of a line may take as much
ENTRY_BYTES = 200  # of a unit in the cache, besides its characters and ids
CACHED_CHARS = 48
TOGETHER = 1 << 19  # bytes of texts whose units are looked up together: their different units fit into a cache
LOT = 8192  # units that go through the trie together
UNKNOWN_PENALTY = 10.0
WINDOW = 512  # places of the trie looked at together


class Trie:
    """Double-array trie over UTF-8 bytes: state ``s`` goes by byte ``b`` to ``base[s] + b`` if ``check`` there is ``s``."""

    def __init__(self, base: np.ndarray, check: np.ndarray, value: np.ndarray):
        self.base, self.check, self.value = base.tolist(), check.tolist(), value.tolist()

    @staticmethod
    def build(keys: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        children: list[dict[int, int]] = [{}]
        ends: dict[int, int] = {}
        for key, number in keys.items():
            node = 0
            for byte in key:
                node = children[node].setdefault(byte, len(children))
                if node == len(children):
                    children.append({})
            ends[node] = number
        size = len(children) * 2 + 4 * WINDOW
        base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        taken = np.zeros(size, bool)
        taken[0] = True
        check[0] = 0
        place, free, stack = {0: 0}, 1, [0]
        while stack:
            node = stack.pop()
            at = place[node]
            value[at] = ends.get(node, -1)
            if not (labels := sorted(children[node])):
                continue
            row, start, low = np.array(labels), 0, free
            while not start:
                if low + WINDOW + 512 >= len(taken):
                    grow = len(taken)
                    base, taken = np.concatenate((base, np.zeros(grow, np.int32))), np.concatenate((taken, np.zeros(grow, bool)))
                    check, value = (np.concatenate((x, np.full(grow, -1, np.int32))) for x in (check, value))
                slots = np.flatnonzero(~taken[low : low + WINDOW]) + low
                if low == free and len(slots) < WINDOW // 16:
                    free += WINDOW // 2  # nearly full: not looked at again
                starts = slots[slots > labels[0]] - labels[0]
                fits = np.flatnonzero(~taken[starts[:, None] + row].any(axis=1))
                start = int(starts[fits[0]]) if len(fits) else 0
                low += WINDOW
            base[at] = start
            for byte in labels:
                taken[start + byte], check[start + byte] = True, at
                place[children[node][byte]] = start + byte
                stack.append(children[node][byte])
        end = int(np.flatnonzero(taken)[-1]) + 257
        return base[:end], check[:end], np.concatenate((value, np.full(257, -1, np.int32)))[:end]


def read_model(path: str, scores: str = "zipf") -> dict:
    """Pieces, scores, byte pieces and the packed trie of a model file, small enough to broadcast."""
    if scores not in ("zipf", "file"):
        raise ValueError(f"scores are 'zipf' or 'file', not {scores!r}")
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    text = [model.id_to_piece(i) for i in range(n)]
    bytes_of = {int(text[i][3:5], 16): i for i in range(n) if model.is_byte(i)}
    normal = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    score = np.zeros(n)
    if scores == "file":
        score[normal] = [model.get_score(i) for i in normal]
    else:
        ranked = sorted(normal, key=lambda i: (-model.get_score(i), i))
        score[ranked] = -np.log(np.arange(1, len(ranked) + 1)) - math.log(sum(1 / r for r in range(1, len(ranked) + 1)))
    if any(MARK in text[i].lstrip(MARK) for i in normal):
        raise ValueError("a piece holds the marker after another character")
    trie = Trie.build({text[i].encode(): i for i in normal})
    plain = [b"" if model.is_control(i) or model.is_unknown(i) else text[i].replace(MARK, " ").encode() for i in range(n)]
    for byte, i in bytes_of.items():
        plain[i] = bytes([byte])
    return {"trie": trie, "score": score, "bytes": [bytes_of[b] for b in range(256)], "plain": plain, "unknown": float(score[normal].min()) - UNKNOWN_PENALTY, "feeds": not any("\n" in text[i] for i in normal)}


class Pieces:
    """Encoder and decoder over a model that ``read_model`` made."""

    def __init__(self, model: dict):
        self.trie, self.score = Trie(*model["trie"]), model["score"].tolist()
        self.bytes, self.plain, self.unknown, self.feeds = model["bytes"], model["plain"], model["unknown"], model["feeds"]
        self.arrays = [*(x.astype(np.int64) for x in model["trie"]), model["score"], np.array(self.bytes, np.int32)]
        self.marked, self.bare = _Units(self, MARK), _Units(self, "")
        self.feed = np.array([self.bytes[10]], np.int32).tobytes()

    def best(self, unit: str) -> tuple[list[int], float]:
        """Viterbi: the pieces of the best path over ``unit`` (markers in place of spaces) and its score."""
        data = unit.encode("utf-8", "replace")
        n = len(data)
        base, check, value, score = self.trie.base, self.trie.check, self.trie.value, self.score
        gain = [-math.inf] * (n + 1)
        came: list[tuple[int, int]] = [(0, -1)] * (n + 1)
        gain[0] = 0.0
        at = 0
        while at < n:
            here, first = gain[at], data[at]
            width = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
            single, state, end = False, 0, at
            while end < n:
                to = base[state] + data[end]
                if check[to] != state or to == 0:
                    break
                state, end = to, end + 1
                if (piece := value[state]) >= 0:
                    single = single or end == at + width
                    if (total := here + score[piece]) > gain[end]:
                        gain[end], came[end] = total, (at, piece)
            if not single and (total := here + self.unknown) > gain[at + width]:
                gain[at + width], came[at + width] = total, (at, -1)
            at += width
        ids, end = [], n
        while end > 0:
            start, piece = came[end]
            ids.extend([piece] if piece >= 0 else [self.bytes[b] for b in reversed(data[start:end])])
            end = start
        return ids[::-1], gain[n]

    def best_of_lot(self, units: list[bytes]) -> list[bytes]:
        """The ids of ``best`` for many short units at once: arrays over the units, one place of them after the other."""
        base, check, value, score, bytes_of = self.arrays
        n, sizes = len(units), np.array([len(u) for u in units])
        longest = int(sizes.max())
        # Rows are places, so that each step works on whole rows. No UTF-8 text holds the byte that fills up short units.
        data = np.ascontiguousarray(np.frombuffer(b"".join(u.ljust(longest, b"\xff") for u in units), np.uint8).reshape(n, longest).T)
        gain = np.full((longest + 1, n), -np.inf)
        gain[0] = 0.0
        start, came = np.zeros((longest + 1, n), np.int32), np.full((longest + 1, n), -1, np.int32)

        for at in range(longest):
            rows = np.flatnonzero((sizes > at) & (data[at] & 0xC0 != 0x80))
            first, here = data[at][rows], gain[at][rows]
            width = 1 + (first >= 0xC0).astype(np.int64) + (first >= 0xE0) + (first >= 0xF0)
            single, going, unit, state = np.zeros(len(rows), bool), np.arange(len(rows)), rows, np.zeros(len(rows), np.int64)
            for end in range(at, longest):
                to = base[state] + data[end][unit]
                on = np.flatnonzero(check[to] == state)
                if not len(on):
                    break
                going, unit, state = going[on], unit[on], to[on]
                piece = value[state]
                whole = np.flatnonzero(piece >= 0)
                some, ends, piece = going[whole], unit[whole], piece[whole]
                single[some[width[some] == end + 1 - at]] = True
                total = here[some] + score[piece]
                better = np.flatnonzero(total > gain[end + 1][ends])
                ends = ends[better]
                gain[end + 1][ends], start[end + 1][ends], came[end + 1][ends] = total[better], at, piece[better]
            for k in range(1, 5):  # characters that are no piece
                none = np.flatnonzero(~single & (width == k))
                total, ends = here[none] + self.unknown, rows[none]
                if len(none):
                    better = total > gain[at + k][ends]
                    gain[at + k][ends[better]], start[at + k][ends[better]], came[at + k][ends[better]] = total[better], at, -1

        ids, left, end = np.zeros((n, longest), np.int32), np.full(n, longest), sizes.copy()
        while len(rows := np.flatnonzero(end > 0)):
            piece, begin = came[end[rows], rows], start[end[rows], rows]
            known = piece >= 0
            left[rows[known]] -= 1
            ids[rows[known], left[rows[known]]] = piece[known]
            for k in range(1, 5):  # the bytes of a character without a piece, the last first
                more = rows[~known & (end[rows] - begin >= k)]
                left[more] -= 1
                ids[more, left[more]] = bytes_of[data[end[more] - k, more]]
            end[rows] = begin
        flat = ids[np.arange(longest) >= left[:, None]].tobytes()
        stop = np.cumsum(longest - left) * 4
        return [flat[a:b] for a, b in zip([0, *stop[:-1].tolist()], stop.tolist())]

    def look_up(self, texts: list[str]) -> None:
        """Fill the cache with the short units of some texts."""
        marked: set[str] = set()
        bare: set[str] = set()
        for text in texts:
            for k, line in enumerate(text.split("\n") if self.feeds else [text]):
                units = line.split(" ")
                if k:
                    bare.add(units.pop(0))
                marked.update(units)
        self.marked.fill(marked)
        self.bare.fill(bare)

    def encode_lot(self, texts: list) -> list[np.ndarray]:
        self.look_up([t for t in texts if t])
        return [self.encode(t) for t in texts]

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        out = []
        for k, line in enumerate(text.split("\n") if self.feeds else [text]):
            if k:
                out.append(self.feed)
            units = line.split(" ")
            if k == 0:
                units.insert(0, "")
            if "" in units[1:]:
                out.extend(self._spaced(units))
                continue
            if units[0]:
                out.append(self.bare[units[0]])
            out.extend(map(self.marked.__getitem__, units[1:]))
        return np.frombuffer(b"".join(out), np.int32)

    def _spaced(self, units: list[str]):
        """Units of a line with runs of spaces: a run goes with the characters after it."""
        if units[0]:
            yield self.bare[units[0]]
        run = 0
        for unit in units[1:]:
            run += 1
            if unit:
                yield self.marked[unit] if run == 1 else self.bare[MARK * run + unit]
                run = 0
        if run:
            yield self.bare[MARK * run]

    def decode(self, ids) -> str:
        """The text of piece ids, without the marker put before it."""
        data = b"".join(map(self.plain.__getitem__, ids))
        return data[1:].decode("utf-8", "replace") if data[:1] == b" " else data.decode("utf-8", "replace")


class _Units(dict):
    """Unit to the bytes of its piece ids; emptied where it would take more than ``CACHE_BYTES``."""

    def __init__(self, pieces: Pieces, mark: str):
        super().__init__()
        self.pieces, self.mark, self.size = pieces, mark, 0

    def keep(self, units: list[str], ids: list[bytes]) -> None:
        size = sum(map(len, units)) + sum(map(len, ids)) + ENTRY_BYTES * len(units)
        if self.size + size > CACHE_BYTES:
            self.clear()
            self.size = 0
        self.update(zip(units, ids))
        self.size += size

    def fill(self, units: set[str]) -> None:
        fresh = sorted((u for u in units.difference(self) if 0 < len(u) <= CACHED_CHARS), key=len)
        for k in range(0, len(fresh), LOT):
            lot = fresh[k : k + LOT]
            self.keep(lot, self.pieces.best_of_lot([(self.mark + u).encode("utf-8", "replace") for u in lot]))

    def __missing__(self, unit: str) -> bytes:
        ids = np.array(self.pieces.best(self.mark + unit)[0], np.int32).tobytes()
        if len(unit) <= CACHED_CHARS:
            self.keep([unit], [ids])
        return ids


_WORKER: list = [None, None]  # the broadcast model last used in this Python worker, and its encoder


def _pieces(shared) -> Pieces:
    if _WORKER[0] is not shared.value:
        _WORKER[:] = shared.value, Pieces(shared.value)
    return _WORKER[1]


@lru_cache(maxsize=4)
def _model(path: str, scores: str) -> dict:
    return read_model(path, scores)


def _lots(texts: pa.Array):
    """Bounds of stretches of texts of some ``TOGETHER`` bytes; a longer text is alone or the last of its stretch."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    cuts = (np.flatnonzero(np.diff(ends // TOGETHER)) + 1).tolist()
    return zip([0, *cuts], [*cuts, len(texts)])


def encode(docs: DataFrame, model_path: str, text: str = "text", ids: str = "ids", scores: str = "zipf", decoded: str | None = None) -> DataFrame:
    """``docs`` with the piece ids of every whole text, and with the text these stand for if ``decoded`` names a column for it.

    Both come from one pass, in small Arrow batches whatever the texts' lengths. Columns of these names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_model(model_path, scores))
    made = [T.StructField(ids, T.ArrayType(T.IntegerType()))] + ([T.StructField(decoded, T.StringType())] if decoded else [])
    names = {f.name.lower() for f in made}
    kept = [f.name for f in docs.schema if f.name.lower() not in names]
    sent = [*kept, *(c for c in docs.columns if c.lower() == text.lower() and c not in kept)]
    place = [c.lower() for c in sent].index(text.lower())

    def run(batches):
        pieces = _pieces(shared)
        for batch in batches:
            texts = batch.column(place)
            for low, high in _lots(texts) if batch.num_rows else ():
                rows = pieces.encode_lot(texts.slice(low, high - low).to_pylist())
                ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
                new = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows)))]
                if decoded:
                    new.append(pa.array([pieces.decode(r.tolist()) for r in rows], pa.string()))
                old = [batch.column(k).slice(low, high - low) for k in range(len(kept))]
                yield pa.RecordBatch.from_arrays(old + new, names=kept + [f.name for f in made])

    schema = T.StructType([f for f in docs.schema if f.name in kept] + made)
    return docs.select([F.col(f"`{c}`") for c in sent]).mapInArrow(run, schema)


def decode(df: DataFrame, model_path: str, ids: str = "ids", text: str = "decoded", scores: str = "zipf") -> DataFrame:
    """``df`` with the text that its piece ids stand for."""
    shared = df.sparkSession.sparkContext.broadcast(_model(model_path, scores))

    @F.pandas_udf("string")
    def run(rows: pd.Series) -> pd.Series:
        pieces = _pieces(shared)
        return pd.Series(["" if r is None else pieces.decode(r.tolist()) for r in rows], dtype=object)

    return df.withColumn(text, run(F.col(ids)))


def fallback_count(ids, model_path: str, scores: str = "zipf"):
    """Column: how many of the ids are byte pieces (they are one range of ids in the file)."""
    numbers = _model(model_path, scores)["bytes"]
    low, high = min(numbers), max(numbers)
    if high - low != 255:
        raise ValueError("the byte pieces are not one range")
    return F.size(F.filter(ids, lambda i: i.between(low, high))).cast("long")
