"""Token counts of whole texts by a two-tier lookup inside each task: no pre-token is ever shuffled.

White space ends a pre-token of this kind of tokenizer, so the count of a text is the sum over its white-space separated pieces.
Tier one is a broadcast table of frequent pieces and their lengths, taken from the vocabulary's whole words; its size is bounded by
``table_size``. Tier two is a bounded cache in each Python worker, filled by the tokenizer library itself, so every count is the
library's own.

Null texts count as empty: 0 bytes and 0 tokens. Special strings inside texts are handled as the library's default does.
"""

from __future__ import annotations

import os
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TABLE_SIZE = 65_536
CACHE_SIZE = 400_000
CACHED_CHARS = 64
# White space of str.split that is not white space of the tokenizers' patterns.
ODD_SEPARATORS = "\x1c\x1d\x1e\x1f"


def _tokenizer(data: bytes):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_buffer(data)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def drops_white_space(data: bytes) -> bool:
    """Whether white space is removed before the merges, so that texts may be counted piece by piece."""
    tokenizer = _tokenizer(data)
    probes = ["a", "Ab.c", "it's", "x1", "é,"]
    alone = sum(len(tokenizer.encode(p, add_special_tokens=False).ids) for p in probes)
    return all(len(tokenizer.encode(s.join(probes), add_special_tokens=False).ids) == alone for s in (" ", "\n", "\t  "))


def frequent_lengths(data: bytes, size: int = TABLE_SIZE) -> dict[str, int]:
    """Lengths of the vocabulary's whole words, most frequent merges first, at most ``size``."""
    tokenizer = _tokenizer(data)
    words = []
    for piece, _ in sorted(tokenizer.get_vocab(with_added_tokens=False).items(), key=lambda x: x[1]):
        if piece.endswith("</w>") and piece[:-4].isascii() and len(words) < size:
            words.append(piece[:-4])
    return {w: len(e.ids) for w, e in zip(words, tokenizer.encode_batch(words, add_special_tokens=False))}


class _Lengths(dict):
    """Piece to token count; misses go to the library and stay while there is room."""

    def __init__(self, data: bytes, known: dict[str, int]):
        super().__init__(known)
        self.known, self.encode = known, _tokenizer(data).encode

    def __missing__(self, piece: str) -> int:
        n = len(self.encode(piece, add_special_tokens=False).ids)
        if len(piece) <= CACHED_CHARS:
            if len(self) > len(self.known) + CACHE_SIZE:
                self.clear()
                self.update(self.known)
            self[piece] = n
        return n


_WORKER: list = [None, None]  # the broadcast value last used in this Python worker, and its lengths


def _lengths(shared) -> _Lengths:
    if _WORKER[0] is not shared.value:
        _WORKER[:] = shared.value, _Lengths(*shared.value)
    return _WORKER[1]


def count_text(text: str | None, lengths: dict[str, int], by_piece: bool = True) -> int:
    if not text:
        return 0
    if not by_piece or any(c in text for c in ODD_SEPARATORS):
        return len(lengths.encode(text, add_special_tokens=False).ids)
    return sum(map(lengths.__getitem__, text.split()))


@lru_cache(maxsize=4)
def _prepared(path: str, size: int):
    with open(path, "rb") as f:
        data = f.read()
    return data, frequent_lengths(data, size), drops_white_space(data)


def token_counts(docs: DataFrame, tokenizer_path: str, text: str = "text", out: str = "n_tokens", table_size: int = TABLE_SIZE) -> DataFrame:
    """``docs`` with the number of tokens of every whole text. The file at ``tokenizer_path`` is read on the driver and broadcast."""
    data, known, by_piece = _prepared(tokenizer_path, table_size)
    shared = docs.sparkSession.sparkContext.broadcast((data, known))

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        lengths = _lengths(shared)
        return pd.Series([count_text(t, lengths, by_piece) for t in texts], dtype="int64")

    return docs.withColumn(out, count(F.col(text)))
