"""Removal of word passages that occur more than once anywhere, with a count-min sketch in front of the exact count.

A window is ``WORDS`` consecutive words of a text. Partition sketches of the windows' anchors are merged; they over-estimate how often a window
occurs, so a window whose anchor shows once is single, and the rest - a repeated window always among them - is counted exactly by the
window's own 64-bit hash under its 64-bit anchor. Each word covered by a window that occurs again, in any document or the same one, goes.

Words are runs of bytes other than space and 9 to 13, unchanged. Null texts have no words; texts of fewer than ``WORDS`` words stay whole.
Repeated rows are occurrences of their own. Null ids are documents like others. Other columns stay as they are.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm import passages
from quarterdeck.llm.hashing import ngrams, range_hash, sliding_min, sums, word_hashes, words

WORDS = 35
GRAM = 8


def cut_words(text: str, length: int = WORDS):
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    start, end = words(data)
    n = len(start) - length + 1
    if n < 1:
        return
    hashes = word_hashes(data, start, end)
    at = np.arange(n)
    windows = range_hash(sums(hashes), at, at + length)
    grams, width = ngrams(hashes, GRAM), length - GRAM + 1
    minimum = sliding_min(grams, width)
    edge = np.full(width - 1, ~np.uint64(0))
    chosen = grams == ~sliding_min(np.concatenate((edge, ~minimum, edge)), width)  # the smallest of some window it lies in
    yield passages.segments(minimum, 0, lambda i, j: windows[i:j].tobytes(), lambda k: windows[k], grams[chosen])


def solve_words(lot: passages.Lot):
    """Windows that occur twice or more under their key."""
    size = np.array([len(c) // 8 for c in lot.contents])
    times = np.bincount(lot.owner, minlength=len(lot.contents)) + lot.before
    owner = np.repeat(np.arange(len(size)), size)
    key, value = lot.key[owner], np.frombuffer(b"".join(lot.contents), np.uint64)
    order = np.lexsort((value, key))
    first = np.flatnonzero(np.concatenate(([True], (key[order][1:] != key[order][:-1]) | (value[order][1:] != value[order][:-1]))))
    total = np.add.reduceat(times[owner[order]], first)
    often = np.empty(len(order), bool)
    often[order] = np.repeat(total >= 2, np.diff(np.append(first, len(order))))
    begin = np.cumsum(size) - size
    edge = np.concatenate((often[:1], often[1:] & (~often[:-1] | (owner[1:] != owner[:-1]))))
    close = np.concatenate((often[:-1] & (~often[1:] | (owner[1:] != owner[:-1])), often[-1:]))
    starts, ends = np.flatnonzero(edge), np.flatnonzero(close) + 1
    of = owner[starts]  # runs lie by content; each goes to all places of its content
    by_owner = np.argsort(lot.owner, kind="stable")
    low = np.searchsorted(lot.owner[by_owner], np.arange(len(size) + 1))
    n = (low[1:] - low[:-1])[of]
    which = np.repeat(np.arange(len(of)), n)
    place = by_owner[np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + low[of][which]]
    yield lot.places[place], (starts - begin[of])[which], (ends - begin[of])[which]


def remove_repeated_words(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = WORDS, hot_least: int = passages.HOT_LEAST) -> DataFrame:
    """``docs`` with ``removed`` (struct: n_words, n_removed, kept text, its SHA-256)."""
    if length < GRAM:
        raise ValueError(f"windows of at least {GRAM} words")
    rows = passages.keyed(docs, text, doc_id)
    found = passages.shared_windows(rows.select("_doc", "_twin", F.col(text).alias("text")), lambda t: cut_words(t, length), solve_words, hot_least)

    @F.pandas_udf("n_words long, n_removed long, kept string, kept_sha256 string")
    def apply(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.DataFrame:
        out = []
        for t, s, e in zip(texts, starts, ends):
            kept = (t or "").encode("utf-8", "replace").split()
            n = len(kept)
            if s is not None and len(s):
                gone = passages.covered(n, np.asarray(s), np.asarray(e) + length - 1)
                kept = [w for w, g in zip(kept, gone.tolist()) if not g]
            joined = b" ".join(kept)
            out.append((n, n - len(kept), joined.decode("utf-8", "replace"), hashlib.sha256(joined).hexdigest()))
        return pd.DataFrame(out, columns=["n_words", "n_removed", "kept", "kept_sha256"])

    joined = passages.by_document(rows, found)
    return joined.withColumn("removed", apply(F.col(text), F.col("_start"), F.col("_end"))).drop("_doc", "_twin", "_start", "_end")
