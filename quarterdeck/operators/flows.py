"""Entity-ordered time operators on a panel with one row per (entity, period).

All windows share one specification - partition by entity, order by period - so Spark
plans a single shuffle and sort for any number of columns. An entity never has more
rows than there are calendar quarters, which bounds every window partition however
large the panel gets; ``assert_unique_periods`` guards that assumption. Offsets count
rows, not calendar quarters, unless ``strict`` asks for the calendar.
"""

from __future__ import annotations

from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from quarterdeck.functions.missing import as_col, present

ENTITY = "CERT"
PERIOD = "REPDTE"


def by_entity(entity: str = ENTITY, period: str = PERIOD):
    return W.partitionBy(entity).orderBy(period)


def trailing(rows: int, entity: str = ENTITY, period: str = PERIOD):
    return by_entity(entity, period).rowsBetween(-(rows - 1), 0)


def assert_unique_periods(df: DataFrame, entity: str = ENTITY, period: str = PERIOD) -> DataFrame:
    """Offending (entity, period) keys; empty when the panel is sound."""
    return df.groupBy(entity, period).count().filter("count > 1")


def discrete_flow(
    c: str, entity: str = ENTITY, period: str = PERIOD, fallback: bool = True, strict: bool = False
) -> Column:
    """Quarter flow behind a year-to-date column.

    The first quarter is the total itself, later ones the difference to the previous row.
    ``fallback`` returns the whole total where that difference is NULL and 0 where
    nothing is known; without it such rows stay NULL. ``strict`` accepts the previous
    row only when it is the quarter just before in the same year.
    """
    if fallback and not strict:
        step = f"`{c}` - lag(`{c}`) over (partition by `{entity}` order by `{period}`)"
        return F.expr(f"coalesce(case when quarter(`{period}`) = 1 then `{c}` else {step} end, `{c}`, 0D)")
    w = by_entity(entity, period)
    ytd = F.col(c)
    before = F.lag(ytd).over(w)
    if strict:
        adjacent = F.last_day(F.add_months(F.lag(period).over(w), 3)) == F.col(period)
        before = F.when(adjacent, before)
        return F.when(F.quarter(period) == 1, ytd).otherwise(ytd - before)
    return F.when(F.quarter(period) == 1, ytd).otherwise(ytd - before)


def ytd_to_discrete(
    df: DataFrame, columns: Mapping[str, str], entity: str = ENTITY, period: str = PERIOD, **options
) -> DataFrame:
    """Add one flow column per ``{ytd column: output}``; an absent input gives 0."""
    have = set(df.columns)
    return df.withColumns(
        {
            out: discrete_flow(src, entity, period, **options) if src in have else F.lit(0.0)
            for src, out in columns.items()
        }
    )


def annualize_ytd(df: DataFrame, c: str, period: str = PERIOD) -> Column:
    """Year-to-date amount at an annual pace; NULL when the column is absent."""
    if c not in df.columns:
        return F.lit(None).cast("double")
    return F.col(c) * F.lit(4.0) / F.quarter(period)


def _guard(value: Column, observed: Column, min_periods: int) -> Column:
    return F.when(observed >= min_periods, value)


def rolling_sum(c, rows: int = 4, min_periods: int = 1, entity: str = ENTITY, period: str = PERIOD) -> Column:
    w = trailing(rows, entity, period)
    total = F.sum(as_col(c)).over(w)
    return total if min_periods <= 1 else _guard(total, F.count(as_col(c)).over(w), min_periods)


def rolling_mean(c, rows: int = 4, min_periods: int = 1, entity: str = ENTITY, period: str = PERIOD) -> Column:
    w = trailing(rows, entity, period)
    mean = F.avg(as_col(c)).over(w)
    return mean if min_periods <= 1 else _guard(mean, F.count(as_col(c)).over(w), min_periods)


def ttm_sums(df: DataFrame, columns: Mapping[str, str], min_periods: int = 1) -> DataFrame:
    """Trailing four-row sums, ``{flow column: output}``; absent flows are skipped."""
    have = present(df.columns, columns)
    return df.withColumns({columns[c]: rolling_sum(c, 4, min_periods) for c in have})


def ttm_rate(flow: str, balance: str, min_periods: int = 1, scale: float = 1.0) -> Column:
    """Four-row flow over the four-row mean balance; a zero mean gives NULL."""
    rate = F.try_divide(rolling_sum(flow, 4, min_periods), rolling_mean(balance, 4, min_periods))
    return rate if scale == 1.0 else rate * F.lit(scale)


def smoothed_past_due(df: DataFrame, late: Sequence[str], balance: str, out: str, rows: int = 4) -> DataFrame:
    """Rolling mean of the quarterly past-due rate."""
    overdue = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in late[1:]), F.coalesce(F.col(late[0]), F.lit(0.0)))
    rated = df.withColumn("_rate", F.try_divide(overdue, F.col(balance)))
    return rated.withColumn(out, rolling_mean("_rate", rows)).drop("_rate")


def growth(c: str, rows: int = 4, entity: str = ENTITY, period: str = PERIOD) -> Column:
    """(x - x[-rows]) / |x[-rows]|; from a zero base 0 if still zero, else NULL."""
    now, then = F.col(c), F.lag(c, rows).over(by_entity(entity, period))
    flat = F.when(now == 0, F.lit(0.0))
    return F.when(then == 0, flat).otherwise(F.try_divide(now - then, F.abs(then)))


# Growth output prefix and the balance it is measured on.
GROWTH_TARGETS = {
    "CRE": "CRE_Investment_Pure_Balance",
    "Constr": "RIC_Constr_Cost",
    "Resi": "RIC_Resi_Cost",
    "Comm": "RIC_Comm_Cost",
    "Card": "RIC_Card_Cost",
    "OthCons": "RIC_OthCons_Cost",
    "SBL": "SBL_Balance",
    "Fund_Finance": "Fund_Finance_Balance",
    "Total_Loans": "LNLS",
    "Assets": "ASSET",
    "Deposits": "DEP",
}


def add_growth(df: DataFrame, targets: Mapping[str, str] = GROWTH_TARGETS, rows: int = 4) -> DataFrame:
    have = set(df.columns)
    return df.withColumns({f"{p}_Growth_TTM": growth(c, rows) for p, c in targets.items() if c in have})


def pct_change(c: str, rows: int, entity: str = ENTITY, period: str = PERIOD, scale: float = 100.0) -> Column:
    """x / x[-rows] - 1, in percent by default; a zero base gives NULL."""
    return (F.try_divide(F.col(c), F.lag(c, rows).over(by_entity(entity, period))) - 1) * F.lit(scale)


def delta(c, rows: int = 1, entity: str = ENTITY, period: str = PERIOD) -> Column:
    return as_col(c) - F.lag(as_col(c), rows).over(by_entity(entity, period))


def lagged(c, rows: int = 1, entity: str = ENTITY, period: str = PERIOD) -> Column:
    return F.lag(as_col(c), rows).over(by_entity(entity, period))


def last_rows(df: DataFrame, rows: int, entity: str = ENTITY, period: str = PERIOD) -> DataFrame:
    """The latest ``rows`` rows of every entity, with ``_age`` 1 for the newest."""
    newest = W.partitionBy(entity).orderBy(F.col(period).desc())
    return df.withColumn("_age", F.row_number().over(newest)).filter(F.col("_age") <= rows)


def trailing_profile(
    df: DataFrame,
    metrics: Iterable[str],
    stress: Mapping[str, tuple[str, str]] | None = None,
    ever: Mapping[str, str] | None = None,
    rows: int = 8,
    min_periods: int = 1,
    entity: str = ENTITY,
    period: str = PERIOD,
) -> DataFrame:
    """One row per entity: mean of each metric over its last ``rows`` rows.

    ``stress`` maps an output to (numerator, denominator): worst numerator over the mean
    denominator, 0 when that mean is not positive. ``ever`` maps an output to a column
    that was above zero at least once. With ``min_periods`` entities that are shorter
    drop out. One shuffle: filter on the row number, then aggregate on the same key.
    """
    stress, ever = stress or {}, ever or {}
    plain = [m for m in present(df.columns, metrics) if m not in stress]
    aggs = [F.avg(m).alias(m) for m in plain]
    for out, (num, den) in stress.items():
        base = F.avg(den)
        aggs.append(F.when(base > 0, F.max(num) / base).otherwise(F.lit(0.0)).alias(out))
    aggs += [F.when(F.max(c) > 0, F.lit(1.0)).otherwise(F.lit(0.0)).alias(out) for out, c in ever.items()]
    recent = last_rows(df, rows, entity, period)
    result = recent.groupBy(entity).agg(*aggs, F.count(F.lit(1)).alias("_rows"))
    return result.filter(F.col("_rows") >= min_periods).drop("_rows")


def cost_of_funds(expense_q: str, liabilities: str, scale: float = 100.0) -> Column:
    """Annualised quarterly expense over the mean of this and the previous row's liabilities; NULL on the first row."""
    return F.try_divide(F.col(expense_q) * F.lit(4.0), rolling_mean(liabilities, 2, min_periods=2)) * F.lit(scale)


def annualized_loss_rate(flow_q: str, balance: str) -> Column:
    """Quarterly flow over balance, times 400."""
    return F.try_divide(F.col(flow_q), F.col(balance)) * F.lit(400.0)


def category_ttm_rates(
    df: DataFrame, categories: Mapping[str, Mapping[str, str]], min_periods: int = 4, scale: float = 100.0
) -> DataFrame:
    """Per category: trailing mean of 30-day, 90-day and loss amounts over the trailing mean balance.

    ``categories`` maps a name to ``{"balance", "pd30", "pd90", "nco"}`` columns.
    """
    made = {}
    for name, cols in categories.items():
        base = rolling_mean(cols["balance"], 4, min_periods)
        for measure in ("pd30", "pd90", "nco"):
            rate = F.try_divide(rolling_mean(cols[measure], 4, min_periods), base)
            made[f"{name}_TTM_{measure.upper()}_Rate"] = rate * F.lit(scale)
    return df.withColumns(made)


def ttm_past_due(
    df: DataFrame, pd30: str, pd90: str, balance: str, min_periods: int = 4, scale: float = 100.0
) -> DataFrame:
    """TTM 30-day and 90-day rates (trailing mean over trailing mean) and their sum."""
    base = rolling_mean(balance, 4, min_periods)
    r30 = F.try_divide(rolling_mean(pd30, 4, min_periods), base) * F.lit(scale)
    r90 = F.try_divide(rolling_mean(pd90, 4, min_periods), base) * F.lit(scale)
    return df.withColumns({"TTM_PD30_Rate": r30, "TTM_PD90_Rate": r90, "TTM_Past_Due_Rate": r30 + r90})


def mix_percentages(df: DataFrame, parts: Sequence[str], suffix: str = "_Pct") -> DataFrame:
    """Each part as a percentage of the sum of parts."""
    total = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in parts[1:]), F.coalesce(F.col(parts[0]), F.lit(0.0)))
    return df.withColumns(
        {f"{c}{suffix}": F.try_divide(F.coalesce(F.col(c), F.lit(0.0)) * F.lit(100.0), total) for c in parts}
    )
