"""Product codes of vectors: each is cut into parts, and each part is told by the number of its codebook's nearest entry.

Components are whole numbers, ``floor(SCALE * x)``. The search is the equal-average one: a codebook's entries are sorted by the sum of their
components; from the place of a part's own sum it goes outward on both sides, and a side ends when the squared gap of the sums, over the
dimension, is strictly more than the best squared distance so far (no entry beyond can be as near). Parts of like sums go through a codebook
together, each with its own end. Distances are exact: doubles hold them as long as all terms stay under 2**53, whole numbers of any size
take over beyond. Of equal distances the lower entry counts.

Codebooks are learned on all usable rows. They start as the parts of the ``ENTRIES`` smallest ids (null ids last, then by components) and
take ``ROUNDS`` rounds of assigning and averaging (floor of the mean; unused entries stay). A round is one pass: tasks send sums and counts
per entry, and only the codebooks, of a size that the parameters fix, reach the driver and the tasks.

Usable is a vector that is not null, has no null, NaN or infinite component, and has the length of that with the smallest id among those of
a length above 0 that can be cut evenly. Other rows have null codes. Repeated rows count as often as they are there and get the same code. Fewer rows
than entries make shorter codebooks; without rows there are none. Input columns called ``code`` or ``error`` are replaced, all others stay.
"""

from __future__ import annotations

import hashlib
import math
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 1024
PARTS, ENTRIES, ROUNDS = 4, 256, 4
TOGETHER, BLOCK = 512, 32  # parts searched together, entries looked at in a step
_EXACT = 2**53

Books = list[np.ndarray]  # of each part position: entries x components, as Python integers


def usable(vector: Column, parts: int, dim: int | None = None) -> Column:
    size = F.coalesce(F.size(vector), F.lit(-1))
    right = size == dim if dim is not None else (size > 0) & (size % parts == 0)
    return vector.isNotNull() & right & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def components(vectors: pa.Array, dim: int) -> np.ndarray:
    """``floor(SCALE * x)`` of whole vectors of one length: as doubles, or as Python integers where doubles would not be exact."""
    raw = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore"):
        scaled = np.floor(raw * SCALE)
    if len(raw) and not np.abs(scaled).max() < _EXACT:
        large = [math.floor(x * SCALE) if abs(x) < _EXACT / SCALE else int(x) * SCALE for x in raw.tolist()]
        scaled = np.array(large, object)
    return scaled.reshape(-1, dim)


def _alike(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in the type in which every distance and squared gap is exact."""
    most = max(max((abs(int(v.max())), abs(int(v.min())))) if v.size else 0 for v in (x, entries))
    if 4 * x.shape[1] ** 2 * most**2 < _EXACT:
        return x.astype(np.float64), entries.astype(np.float64)
    return np.array([[int(v) for v in row] for row in x], object).reshape(x.shape), entries


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of the entry nearest to each row of ``x``."""
    x, entries = _alike(x, entries)
    n, dim = x.shape
    total = entries.sum(axis=1)
    ids = np.argsort(total, kind="stable")
    entries, total = entries[ids], total[ids]
    square = (entries * entries).sum(axis=1)
    sums = x.sum(axis=1)
    order = np.argsort(sums, kind="stable")
    best, where = np.full(n, np.inf, x.dtype), np.zeros(n, np.int64)
    for i in range(0, n, TOGETHER):
        lot = order[i : i + TOGETHER]
        rows, own = x[lot], sums[lot]
        length, least, found = (rows * rows).sum(axis=1), best[lot], where[lot]

        def look(first: int, last: int, active: np.ndarray) -> None:
            gap = length[active, None] + square[None, first:last] - 2 * (rows[active] @ entries[first:last].T)
            near = gap.min(axis=1)
            at = np.where(gap == near[:, None], ids[None, first:last], len(ids)).min(axis=1)
            better = (near < least[active]) | ((near == least[active]) & (at < found[active]))
            least[active[better]], found[active[better]] = near[better], at[better]

        left = right = int(np.searchsorted(total, own[0]))
        while left > 0 or right < len(ids):
            if right < len(ids):
                gap = total[right] - own
                active = np.flatnonzero(((gap <= 0) | (gap * gap <= dim * least)).astype(bool))
                last = min(right + BLOCK, len(ids)) if len(active) else len(ids)
                if len(active):
                    look(right, last, active)
                right = last
            if left > 0:
                gap = own - total[left - 1]
                active = np.flatnonzero((gap * gap <= dim * least).astype(bool))
                first = max(left - BLOCK, 0) if len(active) else 0
                if len(active):
                    look(first, left, active)
                left = first
        best[lot], where[lot] = least, found
    return where, best


def _searched(vectors: pa.Array, books: Books) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """For each part position the entries' numbers and distances, and all components."""
    width = books[0].shape[1]
    x = components(vectors, width * len(books))
    found = [nearest(x[:, k * width : (k + 1) * width], book) for k, book in enumerate(books)]
    return [f[0] for f in found], [f[1] for f in found], x


def first_books(rows: DataFrame, vector: str, vec_id: str, parts: int, entries: int) -> Books:
    def firsts(dim: int | None):
        kept = rows.where(usable(F.col(vector), parts, dim)).select(F.col(vec_id).alias("id"), F.col(vector).alias("v"))
        return [r["v"] for r in kept.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()]

    found = firsts(None)
    if not found:
        return []
    dim = len(found[0])
    if any(len(v) != dim for v in found):
        found = firsts(dim)
    x = components(pa.array(found, pa.list_(pa.float64())), dim)
    whole = np.array([[int(c) for c in row] for row in x], object).reshape(x.shape)
    return np.split(whole, parts, axis=1)


def _averaged(rows: DataFrame, books: Books) -> Books:
    """Each entry replaced by the floored mean of the parts nearest to it."""
    width = books[0].shape[1]

    def sums(batches):
        totals = [np.zeros(b.shape, object) for b in books]
        counts = [np.zeros(len(b), np.int64) for b in books]
        for batch in batches:
            if not batch.num_rows:
                continue
            at, _, x = _searched(batch["v"], books)
            for k, (place, book) in enumerate(zip(at, books)):
                part = x[:, k * width : (k + 1) * width]
                order = np.argsort(place, kind="stable")
                used, start = np.unique(place[order], return_index=True)
                if part.dtype == object or np.abs(part).max() * len(part) >= _EXACT:
                    part = np.array([[int(v) for v in row] for row in part], object).reshape(part.shape)
                added = np.add.reduceat(part[order], start, axis=0)
                totals[k][used] += np.array([[int(v) for v in row] for row in added], object).reshape(added.shape)
                counts[k] += np.bincount(place, minlength=len(book))
        rows = [(k, e, int(counts[k][e]), [Decimal(v) for v in totals[k][e]]) for k in range(len(books)) for e in np.flatnonzero(counts[k]).tolist()]
        if rows:
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.decimal128(38, 0)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["part", "entry", "n", "total"])

    sent = rows.mapInArrow(sums, "part int, entry int, n long, total array<decimal(38,0)>")
    summed = sent.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("total")[k]) for k in range(width)]).alias("total"))
    after = [b.copy() for b in books]
    for r in summed.collect():  # a row for each entry at most
        after[r["part"]][r["entry"]] = [int(v) // r["n"] for v in r["total"]]
    return after


def fit(rows: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Books:
    """The codebooks of all usable vectors, none without any."""
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits a part, so a codebook has 1 to 256 entries")
    books = first_books(rows, vector, vec_id, parts, entries)
    if not books:
        return books
    kept = rows.where(usable(F.col(vector), parts, parts * books[0].shape[1])).select(F.col(vector).alias("v"))
    for _ in range(rounds):
        books = _averaged(kept, books)
    return books


def books_sha256(books: Books) -> str:
    """SHA-256 of all components as decimal numbers, by part, entry and position, with commas between."""
    return hashlib.sha256(",".join(str(v) for b in books for row in b for v in row).encode()).hexdigest()


def encode(rows: DataFrame, books: Books, vector: str = "embedding") -> DataFrame:
    """``rows`` with ``code`` (two hex digits a part) and ``error`` (long; null where it would not fit), both null for unusable vectors."""
    if not books:
        return rows.withColumns({"code": F.lit(None).cast("string"), "error": F.lit(None).cast("long")})

    @F.arrow_udf("code string, error long")
    def coded(vectors: pa.Array) -> pa.Array:
        code, error = np.full(len(vectors), None, object), np.full(len(vectors), None, object)
        whole = np.flatnonzero(vectors.is_valid().to_numpy(zero_copy_only=False))
        if len(whole):
            at, far, _ = _searched(vectors.drop_null(), books)
            digits = np.stack(at, axis=1).astype(np.uint8).tobytes().hex()
            code[whole] = [digits[i : i + 2 * len(books)] for i in range(0, len(digits), 2 * len(books))]
            exact = [sum(int(v) for v in row) for row in zip(*far)]
            error[whole] = [e if e < 2**63 else None for e in exact]
        return pa.StructArray.from_arrays([pa.array(code, pa.string()), pa.array(error, pa.int64())], ["code", "error"])

    good = usable(F.col(vector), len(books), len(books) * books[0].shape[1])
    found = coded(F.when(good, F.col(vector)))
    inside = rows.select(F.struct("*").alias("row"), found.alias("found"))
    others = [F.col(f"row.`{c}`").alias(c) for c in rows.columns if c not in ("code", "error")]
    return inside.select(*others, "found.code", "found.error")
