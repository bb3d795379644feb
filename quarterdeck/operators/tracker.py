"""Deal tracker: one row per borrower and quarter, then pivots over areas, types and Y/blank flags."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def period_label(date: str) -> Column:
    return F.concat(F.year(date).cast("string"), F.lit("Q"), F.quarter(date).cast("string"))


def dedup_latest(
    df: DataFrame, primary: str, fallback: str | None, date: str, ties: Sequence[str]
) -> DataFrame:
    """The latest row per (borrower, quarter). The key is the upper-cased primary name, else the fallback.

    An aggregate keeps the largest (date, *ties) row while it scans, so one borrower with a
    third of all rows still reduces on the map side; a window would sort them in one task.
    """
    name = F.trim(F.coalesce(F.col(primary), F.lit("")))
    if fallback:
        name = F.when(name == "", F.trim(F.coalesce(F.col(fallback), F.lit("")))).otherwise(name)
    staged = df.filter(F.col(date).isNotNull()).withColumns(
        {"BORROWER_KEY": F.upper(name), "QUARTER": period_label(date), "YEAR": F.year(date)}
    )
    keys = ["BORROWER_KEY", "QUARTER"]
    best = staged.groupBy(*keys).agg(
        F.max_by(F.struct(*[c for c in staged.columns if c not in keys]), F.struct(date, *ties)).alias("r")
    )
    return best.select(*keys, "r.*")


def is_yes(c: str) -> Column:
    return F.coalesce(F.upper(F.trim(c)) == "Y", F.lit(False))


def yes_columns(df: DataFrame, candidates: Sequence[str]) -> list[str]:
    """Candidates that hold at least one Y. Runs one small aggregate: the output columns depend on it."""
    row = df.agg(*[F.bool_or(is_yes(c)).alias(c) for c in candidates]).first()
    return [c for c in candidates if row[c]]


def combine_families(df: DataFrame, columns: Sequence[str], prefixes: Sequence[str] = ("FA", "DD")) -> tuple[DataFrame, list[str]]:
    """Replace the columns of a prefix family by one any-Y column. Returns the frame and the flag columns left."""
    left = list(columns)
    for prefix in prefixes:
        family = [c for c in left if c.upper().startswith(prefix)]
        if family:
            any_yes = reduce(lambda a, b: a | b, [is_yes(c) for c in family])
            df = df.withColumn(f"{prefix}_COMBINED", F.when(any_yes, "Y").otherwise("N"))
            left = [c for c in left if c not in family] + [f"{prefix}_COMBINED"]
    return df, left


def flag_heatmap(df: DataFrame, flags: Sequence[str], period: str = "QUARTER") -> DataFrame:
    """Number of Y per flag and period."""
    counts = df.groupBy(period).agg(*[F.count_if(is_yes(c)).alias(c) for c in flags])
    return counts.unpivot([period], list(flags), "flag", "yes_count")


def counts_by(df: DataFrame, row: str, period: str = "QUARTER") -> DataFrame:
    """Deals per row label and period."""
    return df.filter(F.col(row).isNotNull()).groupBy(row, period).agg(F.count(F.lit(1)).alias("deals"))


def sizes_by(df: DataFrame, row: str, gross: str, net: str, period: str = "QUARTER") -> DataFrame:
    """Gross and net size per row label and period, to one decimal."""
    total = lambda c: F.round(F.sum(F.coalesce(F.col(c), F.lit(0.0))), 1)
    return df.groupBy(row, period).agg(total(gross).alias("gross"), total(net).alias("net"))


def periods_wide(counts: DataFrame, row: str, period: str, value: str, periods: Sequence[str] | None = None) -> DataFrame:
    """Periods as columns, zeros filled. Without a list the periods that occur are the columns, which takes a pass over the counts."""
    wide = counts.groupBy(row).pivot(period, None if periods is None else list(periods)).agg(F.first(value))
    return wide.fillna(0)
