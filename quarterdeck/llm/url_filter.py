"""Allow and block rules over urls, all matched at once by a bit-parallel wildcard automaton.

Every glob becomes a run of states in a row of 64-bit words (extended Shift-And): a byte moves each live state one bit on where the
next byte fits, and keeps states with a wildcard loop alive. A batch of urls steps through the automaton together, one byte at a time,
so the cost is bytes x words whatever the number of rules.

Globs: ``*`` any bytes but ``/``, ``**`` any bytes, ``?`` one byte, the rest literal; a glob must fit the whole canonical url, which is
``.`` + host + path. Null urls, and urls without ``://``, have an empty host and path. Where rules tie in length, the first one wins.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rule = tuple[str, str]  # verdict, "host/path"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case (A-Z) and path, both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_glob(rule: str) -> str:
    """The glob of a ``host/path`` rule: the host and its subdomains, any path that starts with the rule's."""
    if "/" not in rule:
        raise ValueError(f"a rule is host/path: {rule!r}")
    return "*." + rule + "**"


class Automaton:
    """Globs packed into multiword masks. ``fits(urls)`` gives one row of booleans per url."""

    def __init__(self, globs: Sequence[str]):
        states: list[tuple[int | None, str | None]] = []  # byte that enters the state (None: any), its loop
        self.first, self.last = [], []
        for glob in globs:
            self.first.append(len(states))
            states.append((-1, None))
            raw, i = glob.encode(), 0
            while i < len(raw):
                c = raw[i : i + 1]
                if c == b"*":
                    double = raw[i + 1 : i + 2] == b"*"
                    loop = "any" if double or states[-1][1] == "any" else "part"
                    states[-1] = (states[-1][0], loop)
                    i += 1 + double
                else:
                    states.append((None if c == b"?" else c[0], None))
                    i += 1
            self.last.append(len(states) - 1)
        self.words = max(1, -(-len(states) // 64))
        move, loop = np.zeros((256, self.words * 64), bool), np.zeros((256, self.words * 64), bool)
        for s, (byte, kind) in enumerate(states):
            if byte is None:
                move[:, s] = True
            elif byte >= 0:
                move[byte, s] = True
            if kind:
                loop[:, s] = True
                if kind == "part":
                    loop[ord("/"), s] = False
        self.move, self.loop = self._pack(move), self._pack(loop)
        start = np.zeros((1, self.words * 64), bool)
        start[0, self.first] = True
        self.start = self._pack(start)[0]

    @staticmethod
    def _pack(bits: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(np.packbits(bits, axis=1, bitorder="little")).view(np.uint64)

    def fits(self, urls: Sequence[str]) -> np.ndarray:
        raw = [u.encode("utf-8", "surrogatepass") for u in urls]
        size = np.array([len(r) for r in raw], np.int64)
        order = np.argsort(-size, kind="stable")
        data, base = np.frombuffer(b"".join(raw) or b"\0", np.uint8), np.concatenate(([0], np.cumsum(size)[:-1]))[order] if len(raw) else size
        live = np.repeat(self.start[None, :], len(raw), axis=0)
        longest_first = size[order]
        still = np.searchsorted(-longest_first, -np.arange(int(longest_first[0]) if len(raw) else 0), side="left")
        for step, n in enumerate(still):  # the n longest urls have a byte at this step
            byte, now = data[base[:n] + step], live[:n]
            shifted = now << np.uint64(1)
            shifted[:, 1:] |= now[:, :-1] >> np.uint64(63)
            live[:n] = (shifted & self.move[byte]) | (now & self.loop[byte])
        out = np.empty((len(raw), len(self.last)), bool)
        for k, s in enumerate(self.last):
            out[order, k] = (live[:, s // 64] >> np.uint64(s % 64)) & np.uint64(1)
        return out


def filter_urls(pages: DataFrame, rules: Sequence[Rule], url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, the longest rule that fits (null: none) and its verdict (``default`` without a rule)."""
    texts, verdicts = [r for _, r in rules], dict((r, v) for v, r in reversed(rules))
    automaton = Automaton([rule_glob(r) for r in texts])
    by_length = sorted(range(len(texts)), key=lambda k: -len(texts[k]))

    @F.pandas_udf("string")
    def longest(urls: pd.Series) -> pd.Series:
        fits = automaton.fits(urls.tolist())
        out = np.full(len(urls), None, object)
        for k in reversed(by_length):
            out[fits[:, k]] = texts[k]
        return pd.Series(out, dtype=object)

    host, path = host_and_path(F.col(url))
    df = pages.withColumns({"host": host, "path": path})
    df = df.withColumn("rule", longest(F.concat(F.lit("."), "host", "path")))
    if not verdicts:
        return df.withColumn("verdict", F.lit(default))
    verdict = F.create_map(*[F.lit(x) for kv in verdicts.items() for x in kv])
    return df.withColumn("verdict", F.coalesce(verdict[F.col("rule")], F.lit(default)))
