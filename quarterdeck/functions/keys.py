"""Cleaning of join keys: account numbers, ZIP and county codes, dated text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from quarterdeck.functions.missing import ColumnLike, as_col

def left_pad(c: Column, width: int) -> Column:
    """Zero-pad without cutting: ``lpad`` alone would truncate longer keys."""
    return F.when(F.length(c) > width, c).otherwise(F.lpad(c, width, "0"))


def zero_pad(digits: Column, width: int) -> Column:
    """Digits padded to ``width``, longer ones kept, the empty text as NULL."""
    return F.concat(F.repeat(F.lit("0"), F.lit(width) - F.length(digits)), F.nullif(digits, F.lit("")))


def pad12(c: ColumnLike) -> Column:
    """Digits of a key, padded to 12. A trailing ``.0`` is float noise.

    Words for a missing key (nan, none, null ...) hold no digit, so they end as NULL. One regular
    expression does both removals: this runs on every loan.
    """
    return zero_pad(F.regexp_replace(F.trim(as_col(c).cast("string")), r"\.0$|[^0-9]", ""), 12)


def strip_dash_pad12(c: ColumnLike) -> Column:
    return pad12(F.replace(as_col(c).cast("string"), F.lit("-"), F.lit("")))


def drop_padded_nulls(c: ColumnLike) -> Column:
    """NULL for null words that an earlier step already zero-padded (``000000000nan``)."""
    text = as_col(c)
    noise = F.lower(F.trim(text)).rlike(r"^(0*(nan|none|nat|null|<na>).*)?$")
    return F.when(~noise, text)


def zip5(c: ColumnLike) -> Column:
    """ZIP of at least five digits from ``12345.0``, ``12345-6789`` or ``345``; a longer one is kept, so no two keys merge."""
    head = F.split_part(F.split_part(F.trim(as_col(c).cast("string")), F.lit("."), F.lit(1)), F.lit("-"), F.lit(1))
    digits = F.regexp_replace(head, "[^0-9]", "")
    return F.when(digits != "", left_pad(digits, 5))


def fips5(c: ColumnLike) -> Column:
    """Five-digit county code."""
    head = F.split_part(F.trim(as_col(c).cast("string")), F.lit("."), F.lit(1))
    digits = F.regexp_replace(head, "[^0-9]", "")
    return F.when(digits != "", left_pad(digits, 5))


def period_code_date(year: ColumnLike, code: ColumnLike) -> Column:
    """``(2024, 'M03')`` to 2024-03-01; any other period code (annual ``M13`` too) is NULL."""
    month = F.regexp_extract(as_col(code), r"^M(0[1-9]|1[0-2])$", 1).try_cast("int")
    return F.when(month.isNotNull(), F.make_date(as_col(year).cast("int"), month, F.lit(1)))
