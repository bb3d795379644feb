"""Column-name resolution. Works on ``df.columns`` only, so it costs no job."""

from __future__ import annotations

import re
from typing import Iterable, Sequence

from pyspark.sql import DataFrame, functions as F


def clean_name(name: str) -> str:
    return re.sub(r"[^A-Z0-9_]", "", re.sub(r"[\s\-]+", "_", name.strip().upper()))


def normalize_names(df: DataFrame) -> DataFrame:
    """Upper-case names with underscores; a repeated name gets ``_1``, ``_2`` ..."""
    seen: dict[str, int] = {}
    out = []
    for raw in df.columns:
        name = clean_name(raw)
        count = seen.get(name, 0)
        seen[name] = count + 1
        out.append(f"{name}_{count}" if count else name)
    return df.toDF(*out)


def find_column(columns: Sequence[str], preferred: str, alternates: Iterable[str] = ()) -> str | None:
    """First of preferred/alternates present, compared after name cleaning."""
    by_clean = {clean_name(c): c for c in columns}
    for candidate in (preferred, *alternates):
        hit = by_clean.get(clean_name(candidate))
        if hit is not None:
            return hit
    return None


# Substrings that mark the role of a tracker column, strongest rule first.
ROLE_WORDS = {
    "date": [("COMMITTEE", "DATE"), ("DATE",)],
    "product_area": [("PRODUCT", "AREA"), ("PRODUCT",)],
    "gross": [("GROSS", "SIZE"), ("GROSS", "TRANSACTION"), ("GROSS",)],
    "net": [("NET", "SIZE"), ("NET", "TRANSACTION"), ("NET",)],
    "deal_type": [("DEAL", "TYPE"), ("DEAL",)],
    "relationship": [("RELATIONSHIP", "NAME"), ("RELATIONSHIP",)],
    "borrower": [("BORROWER",), ("TRACKER", "FILE")],
}


def find_role(columns: Sequence[str], role: str, word: str | None = None) -> str | None:
    """First column holding every word of the strongest rule that matches anything.

    ``word`` makes a rule of its own before all others: the column that has it besides the role's own word, as where a tracker's
    date column begins with the name of its committee.
    """
    rules = ROLE_WORDS[role]
    for words in ([(word.upper(), *rules[-1])] if word else []) + rules:
        for column in columns:
            if all(word in column.upper() for word in words):
                return column
    return None


def merge_synonyms(df: DataFrame, synonyms: dict[str, Sequence[str]]) -> DataFrame:
    """One canonical column per entry, filled from its synonyms in order (dotted names included)."""
    lower = {c.lower(): c for c in df.columns}
    used: set[str] = set()
    exprs = []
    for target, names in synonyms.items():
        hits = [lower[n.lower()] for n in (target, *names) if n.lower() in lower]
        hits = list(dict.fromkeys(hits))
        if hits:
            used.update(hits)
            exprs.append(F.coalesce(*[F.col(f"`{c}`") for c in hits]).alias(target))
    rest = [F.col(f"`{c}`") for c in df.columns if c not in used]
    return df.select(*exprs, *rest)
