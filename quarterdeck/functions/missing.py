"""Missing-value rules. They differ on purpose: each decides what a zero or NULL means.

All of them return ``Column`` and stay inside whole-stage codegen. Spark 4 raises on
division by zero, so every quotient goes through ``try_divide``.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame, functions as F

ColumnLike = Column | str


def as_col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div0(num: ColumnLike, den: ColumnLike) -> Column:
    """Zero denominator gives 0; a NULL on either side gives NULL."""
    num, den = as_col(num), as_col(den)
    return F.when(den == 0, F.lit(0.0)).otherwise(F.try_divide(num, den))


def safe_div_fill(num: ColumnLike, den: ColumnLike, fill: float = 0.0) -> Column:
    """Zero or NULL anywhere gives ``fill``."""
    return F.coalesce(F.try_divide(as_col(num), as_col(den)), F.lit(fill))


def safe_div_null(num: ColumnLike, den: ColumnLike) -> Column:
    """Zero denominator gives NULL."""
    return F.try_divide(as_col(num), as_col(den))


def null_ratio(num: ColumnLike, den: ColumnLike) -> Column:
    """NULL unless the denominator is strictly positive."""
    den = as_col(den)
    return F.when(den > 0, as_col(num) / den)


# The same four rules over SQL text. One parsed expression per metric keeps the driver
# fast when hundreds of ratios are built at once.
RATIO_POLICIES = {
    "zero": "CASE WHEN ({den}) = 0 THEN 0D ELSE try_divide({num}, {den}) END",
    "fill": "coalesce(try_divide({num}, {den}), 0D)",
    "null": "try_divide({num}, {den})",
    "positive": "CASE WHEN ({den}) > 0 THEN try_divide({num}, {den}) END",
}


def ratio(num: str, den: str, policy: str = "zero") -> Column:
    """Quotient of two SQL expressions under a named zero rule."""
    return F.expr(RATIO_POLICIES[policy].format(num=num, den=den))


def present(columns: Iterable[str], wanted: Iterable[str]) -> list[str]:
    """The wanted names that exist, in the wanted order (decided on the driver, never on data)."""
    have = columns if isinstance(columns, (set, frozenset)) else set(columns)
    return [c for c in wanted if c in have]


def sum_cols(have: Iterable[str], names: Iterable[str]) -> Column:
    """Sum where an absent column or a NULL counts as 0. ``have`` is the set of columns there are."""
    terms = [f"coalesce(cast(`{c}` as double), 0D)" for c in present(have, names)]
    return F.expr(" + ".join(terms) if terms else "0D")


def best_of(have: Iterable[str], names: Iterable[str]) -> Column:
    """First candidate that is neither NULL nor 0, else 0."""
    terms = [f"nullif(cast(`{c}` as double), 0D)" for c in present(have, names)]
    return F.expr(f"coalesce({', '.join([*terms, '0D'])})")


def first_non_null(have: Iterable[str], names: Iterable[str], default: float | None = 0.0) -> Column:
    """Plain coalesce; ``default=None`` keeps NULL when nothing is there."""
    terms = [f"cast(`{c}` as double)" for c in present(have, names)]
    last = "cast(null as double)" if default is None else f"{default}D"
    return F.expr(f"coalesce({', '.join([*terms, last])})")


def with_missing(df: DataFrame, names: Iterable[str], value: float | None = None) -> DataFrame:
    """Add the names that are absent as typed literals, in one projection."""
    absent = [c for c in names if c not in set(df.columns)]
    return df.withColumns({c: F.lit(value).cast("double") for c in absent}) if absent else df


def to_number(c: ColumnLike) -> Column:
    """Text to double. Thousands commas are dropped; anything else unreadable is NULL, and so is NaN."""
    value = F.replace(F.trim(as_col(c).cast("string")), F.lit(","), F.lit("")).try_cast("double")
    return F.nanvl(value, F.lit(None).cast("double"))


def to_flag(c: ColumnLike) -> Column:
    """Text to boolean: true/1 is True, everything else (NULL too) is False."""
    return F.coalesce(F.lower(F.trim(as_col(c).cast("string"))).isin("true", "1"), F.lit(False))
