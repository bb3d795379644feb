"""Macro series in long form (SeriesID, DATE, VALUE): calendars, resampling, metadata, alignment.

A series holds at most one value per calendar day, so any per-series window or array is
bounded by the calendar, not by the data volume. Raw observations are reduced to that grain
first (:func:`one_per_day`).
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from quarterdeck.functions.missing import present

ID, DATE, VALUE = "SeriesID", "DATE", "VALUE"


def by_series(order: str = DATE):
    return W.partitionBy(ID).orderBy(order)


def quarter_end(c: Column | str) -> Column:
    return F.last_day(F.add_months(F.trunc(c, "quarter"), 2))


def one_per_day(raw: DataFrame, ts: str, order: Sequence[str], id_col: str = ID, value: str = VALUE) -> DataFrame:
    """Last observation per series and day, by an aggregate (no window over raw rows)."""
    day = F.to_date(ts)
    return (
        raw.filter(F.col(value).isNotNull())
        .groupBy(F.col(id_col).alias(ID), day.alias(DATE))
        .agg(F.max_by(value, F.struct(*order)).alias(VALUE))
    )


def to_long(df: DataFrame) -> DataFrame:
    """Accept long or wide input. A date column without id and value columns means wide."""
    lower = {c.lower(): c for c in df.columns}
    date = next((lower[c] for c in ("date", "observation_date", "index") if c in lower), None)
    if date is None:
        raise ValueError("series input needs a date column")
    sid = next((lower[c] for c in ("seriesid", "series_id", "series id") if c in lower), None)
    value = next((lower[c] for c in ("value",) if c in lower), None)
    if sid and value:
        return df.select(F.col(f"`{sid}`").alias(ID), F.col(date).cast("date").alias(DATE), F.col(value).cast("double").alias(VALUE))
    cols = [c for c in df.columns if c != date]
    wide = df.select(F.col(date).cast("date").alias(DATE), *[F.col(f"`{c}`").cast("double").alias(c) for c in cols])
    return wide.unpivot([DATE], cols, ID, VALUE).filter(F.col(VALUE).isNotNull()).select(ID, DATE, VALUE)


def daily_ffill(df: DataFrame) -> DataFrame:
    """Every calendar day from a series' first value to the last day of any series, carried forward.

    Each observation expands over the days it stays in force, so no calendar is joined and
    the expanded rows need no further window.
    """
    end = df.agg(F.max(DATE)).scalar()
    known = df.filter(F.col(VALUE).isNotNull())
    until = F.coalesce(F.date_sub(F.lead(DATE).over(by_series()), 1), end)
    spans = known.withColumn("_until", until)
    return spans.select(ID, F.explode(F.sequence(F.col(DATE), F.col("_until"))).alias(DATE), VALUE)


def month_asof(df: DataFrame) -> DataFrame:
    """Month starts from the first to the last observed month with the value in force; the first may be NULL."""
    known = df.filter(F.col(VALUE).isNotNull())
    first_month = F.when(F.dayofmonth(DATE) == 1, F.col(DATE)).otherwise(F.add_months(F.trunc(DATE, "month"), 1))
    until = F.coalesce(F.date_sub(F.lead(DATE).over(by_series()), 1), F.col(DATE))
    spans = known.withColumns({"_from": first_month, "_until": until}).filter("_from <= _until")
    months = F.sequence(F.col("_from"), F.col("_until"), F.expr("interval 1 month"))
    filled = spans.select(ID, F.explode(months).alias(DATE), VALUE)
    start = known.groupBy(ID).agg(F.min(DATE).alias(DATE)).filter(F.dayofmonth(DATE) != 1)
    head = start.select(ID, F.trunc(DATE, "month").alias(DATE), F.lit(None).cast("double").alias(VALUE))
    return filled.unionByName(head)


def month_linear(df: DataFrame) -> DataFrame:
    """Month starts between observations, linear in time between the neighbours."""
    known = df.filter(F.col(VALUE).isNotNull())
    w = by_series()
    spans = known.withColumns({"_d1": F.lead(DATE).over(w), "_v1": F.lead(VALUE).over(w)})
    first_month = F.when(F.dayofmonth(DATE) == 1, F.col(DATE)).otherwise(F.add_months(F.trunc(DATE, "month"), 1))
    until = F.coalesce(F.date_sub("_d1", 1), F.col(DATE))
    spans = spans.withColumns({"_from": first_month, "_until": until}).filter("_from <= _until")
    months = spans.withColumn("_m", F.explode(F.sequence("_from", "_until", F.expr("interval 1 month"))))
    step = F.try_divide(F.datediff("_m", DATE) * (F.col("_v1") - F.col(VALUE)), F.datediff("_d1", DATE))
    return months.select(ID, F.col("_m").alias(DATE), (F.col(VALUE) + F.coalesce(step, F.lit(0.0))).alias(VALUE))


def quarter_last(df: DataFrame) -> DataFrame:
    """Last known value per quarter, dated at its end."""
    return (
        df.filter(F.col(VALUE).isNotNull())
        .groupBy(ID, quarter_end(DATE).alias(DATE))
        .agg(F.max_by(VALUE, DATE).alias(VALUE))
    )


def forward_fill(df: DataFrame, columns: Sequence[str], key: str = ID, order: str = DATE) -> DataFrame:
    w = W.partitionBy(key).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})


def series_spread(df: DataFrame, first: str, second: str, name: str) -> DataFrame:
    """Forward-filled first minus second on every date either has."""
    both = df.filter(F.col(ID).isin(first, second)).groupBy(DATE).agg(
        F.max(F.when(F.col(ID) == first, F.col(VALUE))).alias("_a"),
        F.max(F.when(F.col(ID) == second, F.col(VALUE))).alias("_b"),
    )
    filled = forward_fill(both.withColumn(ID, F.lit(name)), ["_a", "_b"])
    return filled.select(ID, DATE, (F.col("_a") - F.col("_b")).alias(VALUE)).filter(F.col(VALUE).isNotNull())


def aggregate_proxy(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Chosen series side by side under new names, forward filled; empty unless all are there."""
    have = df.filter(F.col(ID).isin(list(names))).select(ID).distinct().agg(F.count(F.lit(1)) == len(names)).scalar()
    rows = df.filter(F.col(ID).isin(list(names)) & have)
    wide = rows.groupBy(DATE).agg(*[F.max(F.when(F.col(ID) == s, F.col(VALUE))).alias(n) for s, n in names.items()])
    # One row per date: the single window partition is bounded by the calendar.
    return forward_fill(wide.withColumn("_one", F.lit(1)), list(names.values()), key="_one").drop("_one")


# Aggregation rule, units and flags per series family.
POLICIES = {
    "gdp": ("level", "sum", "dollars", 4, True),
    "unemployment": ("rate", "mean", "pct", 4, False),
    "population": ("level", "point_in_time", "persons", 4, False),
    "hpi": ("index", "last", "index", 4, False),
}


def policy_table(df: DataFrame) -> DataFrame:
    """The policy registry as a dimension."""
    rows = F.array(
        *[
            F.struct(
                F.lit(family).alias("series_family"),
                F.lit(kind).alias("transform_type"),
                F.lit(rule).alias("aggregation_rule"),
                F.lit(units).alias("units"),
                F.lit(lag).alias("yoy_lag_quarters"),
                F.lit(per_capita).alias("per_capita_eligible"),
            )
            for family, (kind, rule, units, lag, per_capita) in POLICIES.items()
        ]
    )
    return df.sparkSession.range(1).select(F.explode(rows).alias("p")).select("p.*")


def quarterly_by_policy(df: DataFrame, family: str = "family") -> DataFrame:
    """Quarter value by the rule of the series' family: mean, sum, or last; empty quarters drop out.

    The policy is a four-row dimension, so it is safe to broadcast.
    """
    policies = F.broadcast(policy_table(df).select(F.col("series_family").alias(family), "aggregation_rule"))
    rows = df.filter(F.col(VALUE).isNotNull()).join(policies, family)
    agg = rows.groupBy(ID, family, "aggregation_rule", quarter_end(DATE).alias(DATE)).agg(
        F.avg(VALUE).alias("_mean"), F.sum(VALUE).alias("_sum"), F.max_by(VALUE, DATE).alias("_last")
    )
    value = (
        F.when(F.col("aggregation_rule") == "mean", F.col("_mean"))
        .when(F.col("aggregation_rule") == "sum", F.col("_sum"))
        .otherwise(F.col("_last"))
    )
    return agg.select(ID, family, "aggregation_rule", DATE, value.alias(VALUE))


def yoy_from_level(lag: int = 4) -> Column:
    """Level over lagged level minus 1 (levels only)."""
    return F.try_divide(F.col(VALUE), F.lag(VALUE, lag).over(by_series())) - 1


def change_pp(lag: int = 4) -> Column:
    """Difference of a rate in percentage points, never a ratio."""
    return F.col(VALUE) - F.lag(VALUE, lag).over(by_series())


def window_zscore(df: DataFrame, out: str = "zscore") -> DataFrame:
    """Z-score over the whole series with the sample deviation; a flat series gives 0."""
    w = W.partitionBy(ID)
    mean, std = F.avg(VALUE).over(w), F.stddev_samp(VALUE).over(w)
    return df.withColumn(out, F.when(std > 0, (F.col(VALUE) - mean) / std).otherwise(F.lit(0.0)))


def series_quality(df: DataFrame) -> DataFrame:
    """Missing share, last valid date, frequency and outliers (|z| > 3, population deviation, more than 3 points)."""
    known = F.when(F.col(VALUE).isNotNull(), F.col(DATE))
    stats = df.groupBy(ID).agg(
        F.count(F.lit(1)).alias("points"),
        (F.count_if(F.col(VALUE).isNull()) * F.lit(100.0) / F.count(F.lit(1))).alias("missing_data_pct"),
        F.max(known).alias("last_update"),
        F.avg(VALUE).alias("_m"),
        F.stddev_pop(VALUE).alias("_s"),
        F.count(VALUE).alias("_n"),
    )
    far = (
        df.join(stats.select(ID, "_m", "_s", "_n"), ID)
        .filter((F.col("_n") > 3) & (F.abs(F.try_divide(F.col(VALUE) - F.col("_m"), F.col("_s"))) > 3))
        .groupBy(ID)
        .agg(F.count(F.lit(1)).alias("outliers_detected"))
    )
    freq = infer_frequency(df).select(ID, F.col("frequency").alias("data_frequency"))
    return (
        stats.drop("_m", "_s", "_n")
        .join(far, ID, "left")
        .join(freq, ID, "left")
        .withColumn("outliers_detected", F.coalesce("outliers_detected", F.lit(0)))
    )


def infer_frequency(df: DataFrame) -> DataFrame:
    """daily / monthly / quarterly per series from its dates.

    Even spacing decides first (days, weeks and working days count as daily; whole months
    on the same day or at month end by their step). Else the median number of dates per year
    (200 or more, 6 to 15, 3 to 5), else the median number of distinct months per year.
    Fewer than three dates give monthly, anything unclear quarterly.
    """
    days = df.filter(F.col(VALUE).isNotNull()).select(ID, DATE).distinct()
    w = by_series()
    prev = F.lag(DATE).over(w)
    month_no = F.year(DATE) * 12 + F.month(DATE)
    steps = days.withColumns(
        {
            "_gap": F.datediff(DATE, prev),
            "_weekend": (F.datediff(DATE, prev) == 3) & (F.dayofweek(DATE) == 2),
            "_step": month_no - F.lag(month_no).over(w),
            "_end": F.last_day(DATE) == F.col(DATE),
            "_dom": F.dayofmonth(DATE),
        }
    )
    shape = steps.groupBy(ID).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min("_gap").alias("_g0"),
        F.max("_gap").alias("_g1"),
        F.bool_and(F.col("_gap").isNull() | (F.col("_gap") == 1) | F.col("_weekend")).alias("_workdays"),
        F.min("_step").alias("_s0"),
        F.max("_step").alias("_s1"),
        (F.bool_and("_end") | (F.min("_dom") == F.max("_dom"))).alias("_aligned"),
    )
    per_year = days.groupBy(ID, F.year(DATE).alias("_y")).agg(
        F.count(F.lit(1)).alias("_c"), F.count_distinct(F.month(DATE)).alias("_mc")
    )
    # Years per series are few, so the built-in exact median is bounded here.
    medians = per_year.groupBy(ID).agg(F.median("_c").alias("_mpy"), F.median("_mc").alias("_mm"))
    even = F.col("_g0") == F.col("_g1")
    monthly = F.col("_aligned") & (F.col("_s0") == F.col("_s1"))
    freq = (
        F.when(F.col("_n") < 3, "monthly")
        .when(monthly & (F.col("_s0") == 1), "monthly")
        .when(monthly & (F.col("_s0") == 3), "quarterly")
        .when((even & F.col("_g0").isin(1, 7)) | F.col("_workdays"), "daily")
        .when(F.col("_mpy") >= 200, "daily")
        .when(F.col("_mpy").between(6, 15), "monthly")
        .when(F.col("_mpy").between(3, 5), "quarterly")
        .when(F.col("_mm") >= 6, "monthly")
        .otherwise("quarterly")
    )
    code = F.upper(F.substring(freq, 1, 1))
    return shape.join(medians, ID).select(ID, freq.alias("frequency"), code.alias("frequency_short"))


def backfill_metadata(meta: DataFrame, inferred: DataFrame) -> DataFrame:
    """Inferred frequency where the metadata has none, and new rows for series it lacks."""
    inferred = inferred.select(ID, F.col("frequency").alias("_f"), F.col("frequency_short").alias("_s"))
    unknown = F.col("frequency").isNull() | F.lower("frequency").isin("", "unknown", "n/a")
    known = meta.join(inferred, ID, "left")
    fixed = known.withColumns(
        {
            "frequency": F.when(unknown, F.coalesce("_f", "frequency")).otherwise(F.col("frequency")),
            "frequency_short": F.when(unknown, F.coalesce("_s", "frequency_short")).otherwise(F.col("frequency_short")),
        }
    ).drop("_f", "_s")
    added = inferred.join(meta.select(ID), ID, "left_anti").select(
        ID, F.col("_f").alias("frequency"), F.col("_s").alias("frequency_short")
    )
    return fixed.unionByName(added, allowMissingColumns=True)


def describe_series(df: DataFrame, meta: DataFrame) -> DataFrame:
    """Metadata beside each series; unknown series keep NULLs."""
    return df.join(meta, ID, "left")


def publication_dates(df: DataFrame, overrides: DataFrame) -> DataFrame:
    """Effective quarter of a value: publication-dated series move back by their offset (default 0)."""
    joined = df.join(overrides.select(ID, "DateBasis", "QuarterOffset"), ID, "left")
    offset = F.coalesce(F.col("QuarterOffset"), F.lit(0))
    return joined.withColumns(
        {
            "DateBasis": F.coalesce("DateBasis", F.lit("period_end")),
            "QuarterOffset": offset,
            "EFFECTIVE_DATE": F.last_day(F.add_months(F.col(DATE), offset * 3)),
        }
    )


def indicator_long(df: DataFrame, indicators: Sequence[str], dimension: DataFrame | None = None, actual: str | None = None) -> DataFrame:
    """Indicator columns as rows, with series attributes when a dimension is given; ``actual`` names rows for the value itself.

    The attributes are joined to the wide rows, which are as many times fewer as there are indicators.
    """
    names = [*indicators, *([actual] if actual else [])]
    wide = df.select(ID, DATE, *indicators, *([F.col(VALUE).alias(actual)] if actual else []))
    if dimension is None:
        return wide.unpivot([ID, DATE], names, "Indicator_Name", "Indicator_Value")
    more = [c for c in dimension.columns if c != ID]
    attributes = dimension.select(ID, F.struct(*more).alias("_more"))
    long = wide.join(attributes, ID, "left").unpivot([ID, DATE, "_more"], names, "Indicator_Name", "Indicator_Value")
    return long.select(ID, DATE, "Indicator_Name", "Indicator_Value", *[F.col("_more")[c].alias(c) for c in more])


def sector_bridge(dimension: DataFrame, sectors: str = "sectors") -> DataFrame:
    """One row per series and sector of a comma-separated list."""
    parts = F.transform(F.split(F.coalesce(F.col(sectors), F.lit("")), ","), lambda part: F.trim(part))
    return dimension.select(ID, F.explode(F.array_distinct(parts)).alias("sector")).filter(F.col("sector") != "")


def date_dimension(df: DataFrame, date: str = DATE) -> DataFrame:
    """Calendar from the first to the last date with the usual attributes."""
    ends = df.agg(F.min(date).alias("a"), F.max(date).alias("b"))
    days = ends.select(F.explode(F.sequence(F.trunc("a", "year"), F.last_day("b"))).alias("Date"))
    return days.select(
        F.date_format("Date", "yyyyMMdd").cast("int").alias("DateKey"),
        "Date",
        F.year("Date").alias("Year"),
        F.quarter("Date").alias("Quarter"),
        F.month("Date").alias("Month"),
        F.date_format("Date", "MMMM").alias("MonthName"),
        F.date_format("Date", "EEEE").alias("DayName"),
        F.weekofyear("Date").alias("WeekOfYear"),
    )


def series_dimension(df: DataFrame, meta: DataFrame) -> DataFrame:
    """Metadata of the series that occur, with a surrogate key.

    The key is a hash of the id: stable between runs, and no global numbering is needed.
    """
    return meta.join(df.select(ID).distinct(), ID, "left_semi").withColumn("SeriesKey", F.xxhash64(F.col(ID)))


def series_fact(df: DataFrame) -> DataFrame:
    return df.select(
        F.xxhash64(F.col(ID)).alias("SeriesKey"),
        F.date_format(DATE, "yyyyMMdd").cast("int").alias("DateKey"),
        VALUE,
    )


def monthly_measures(df: DataFrame) -> DataFrame:
    """On a month calendar: previous month, change on it, same month last year, change on that (percent)."""
    w = by_series()
    calendar_lag = lambda n: F.when(F.add_months(F.lag(DATE, n).over(w), n) == F.col(DATE), F.lag(VALUE, n).over(w))
    pct = lambda now, then: (F.try_divide(now, then) - 1) * F.lit(100.0)
    return df.withColumns({"previous_month": calendar_lag(1), "same_month_last_year": calendar_lag(12)}).withColumns(
        {
            "mom_pct": pct(F.col(VALUE), F.col("previous_month")),
            "yoy_pct": pct(F.col(VALUE), F.col("same_month_last_year")),
        }
    )


def lagged_quarters(df: DataFrame, quarters: int = 1) -> DataFrame:
    """Quarter-end values moved forward so that they meet a later quarter's row."""
    return df.withColumn(DATE, F.last_day(F.add_months(DATE, 3 * quarters)))


def lagged_correlation(
    subject: DataFrame,
    metrics: Sequence[str],
    macro: DataFrame,
    period: str,
    trailing: int = 20,
    minimum: int = 4,
) -> DataFrame:
    """Pearson correlation of each metric with each series one quarter earlier, over the trailing quarters.

    ``subject`` has one row per period. Its trailing rows are at most ``trailing`` times the
    number of metrics, which is why that side is broadcast.
    """
    metrics = present(subject.columns, metrics)
    recent = subject.orderBy(F.col(period).desc()).limit(trailing)
    left = recent.select(F.col(period).alias(DATE), *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        [DATE], metrics, "metric", "_x"
    )
    right = lagged_quarters(quarter_last(macro))
    pairs = right.join(F.broadcast(left), DATE)
    both = F.col("_x").isNotNull() & F.col(VALUE).isNotNull()
    return pairs.groupBy("metric", ID).agg(
        F.count_if(both).alias("pairs"),
        F.when(F.count_if(both) >= minimum, F.corr("_x", VALUE)).alias("correlation"),
    )


def macro_table(df: DataFrame, names: DataFrame) -> DataFrame:
    """Named series with the latest non-zero value of the last year and the last value of the year before."""
    named = df.join(names.select(ID, "short_name"), ID)
    year = F.year(df.agg(F.max(DATE)).scalar())
    this_year = (F.year(DATE) == year) & (F.col(VALUE) != 0)
    last_year = F.year(DATE) == year - 1
    return named.groupBy(ID, "short_name").agg(
        F.max_by(VALUE, F.when(this_year, F.col(DATE))).alias("current_value"),
        F.max_by(VALUE, F.when(last_year, F.col(DATE))).alias("prior_year_value"),
    )


def overlay(subject: DataFrame, metric: str, macro: DataFrame, period: str, yoy: bool = False) -> DataFrame:
    """A metric with each series beside it: z-scored over the plotted window, or as year-on-year percent."""
    quarters = quarter_last(macro)
    if yoy:
        shown = quarters.withColumn("shown", yoy_from_level(4) * 100)
    else:
        shown = window_zscore(quarters.join(subject.select(F.col(period).alias(DATE)), DATE, "left_semi"), "shown")
    base = subject.select(F.col(period).alias(DATE), F.col(metric).alias("metric_value"))
    return base.join(shown.select(ID, DATE, "shown"), DATE)
