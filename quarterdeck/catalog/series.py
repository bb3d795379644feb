"""Macro-series, calendar and indicator queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterdeck.catalog.sql import register, with_ctes
from quarterdeck.operators import indicators, series
from quarterdeck.plans.shapes import LINE_MEASURES, bank_panel, daily_series, dealt, table, tasks
from quarterdeck.session import materialize

SUBJECT = 1


def monthly(spark, sf):
    """Month-start values of the daily series, scaled to currency units."""
    df = series.month_asof(daily_series(spark, sf))
    return df.withColumn("VALUE", F.col("VALUE") / 10000)


def r(df, *names, digits=6):
    return df.withColumns({n: F.round(n, digits) for n in names})


def mixed_series(spark, sf):
    """Supplier series by day, status series by month and flag series by quarter, under text ids."""
    lines = table(spark, sf, "lineitem").selectExpr("l_shipdate", "l_linestatus", "l_returnflag", f"{LINE_MEASURES['v']} as v")
    by_month = lines.groupBy(F.concat(F.lit("M"), "l_linestatus").alias("SeriesID"), F.trunc("l_shipdate", "month").alias("DATE"))
    by_quarter = lines.groupBy(F.concat(F.lit("Q"), "l_returnflag").alias("SeriesID"), series.quarter_end(F.col("l_shipdate").cast("date")).alias("DATE"))
    total = F.sum("v").cast("double").alias("VALUE")
    by_day = daily_series(spark, sf).withColumn("SeriesID", F.concat(F.lit("D"), F.col("SeriesID").cast("string")))
    whole_days = lines.groupBy(F.lit("ALL").alias("SeriesID"), F.col("l_shipdate").cast("date").alias("DATE")).agg(total)
    return by_day.unionByName(by_month.agg(total)).unionByName(by_quarter.agg(total)).unionByName(whole_days)


def metadata(df):
    """Series attributes derived from the ids, with some frequencies unknown and some series not listed."""
    kind = F.substring("SeriesID", 1, 1)
    names = df.select("SeriesID").distinct()
    return names.filter(kind != "Q").select(
        "SeriesID",
        F.when(kind == "M", "monthly").when(kind == "A", "unknown").alias("frequency"),
        F.when(kind == "M", "M").alias("frequency_short"),
        F.when(kind == "M", " rates, credit,, ").otherwise("volume").alias("sectors"),
        F.concat(F.lit("series "), F.col("SeriesID")).alias("short_name"),
    )


def daily_ffill(spark, sf):
    return series.daily_ffill(daily_series(spark, sf))


def month_asof(spark, sf):
    return series.month_asof(daily_series(spark, sf))


def month_linear(spark, sf):
    return r(series.month_linear(daily_series(spark, sf)), "VALUE", digits=2)


def quarter_last(spark, sf):
    return series.quarter_last(daily_series(spark, sf))


def one_per_day(spark, sf):
    """Last event value per type and day."""
    events = table(spark, sf, "events")
    return series.one_per_day(events, "ts", ["ts", "event_id"], "event_type", "value")


def wide_to_long(spark, sf):
    wide = table(spark, sf, "events").groupBy(F.to_date("ts").alias("date")).pivot("event_type").agg(F.count(F.lit(1)).cast("double"))
    return series.to_long(wide)


def series_spread(spark, sf):
    return series.series_spread(mixed_series(spark, sf), "D1", "D2", "D1-D2")


def aggregate_proxy(spark, sf):
    return series.aggregate_proxy(mixed_series(spark, sf), {"MO": "open_proxy", "MF": "filled_proxy", "QA": "quarter_proxy"})


def yoy_and_pp(spark, sf):
    df = series.quarter_last(daily_series(spark, sf))
    return df.withColumns({"yoy": series.yoy_from_level(4), "pp": series.change_pp(4)}).drop("VALUE")


def window_zscore(spark, sf):
    return r(series.window_zscore(series.quarter_last(daily_series(spark, sf))), "zscore")


def series_quality(spark, sf):
    df = mixed_series(spark, sf).withColumn("VALUE", F.when(F.dayofmonth("DATE") != 13, F.col("VALUE")))
    return series.series_quality(df).withColumn("missing_data_pct", F.round("missing_data_pct", 6))


def infer_frequency(spark, sf):
    return series.infer_frequency(mixed_series(spark, sf))


def backfill_metadata(spark, sf):
    df = materialize(mixed_series(spark, sf), "series")
    return series.backfill_metadata(metadata(df).drop("sectors", "short_name"), series.infer_frequency(df))


def describe_series(spark, sf):
    df = mixed_series(spark, sf)
    return series.describe_series(df.groupBy("SeriesID").agg(F.count(F.lit(1)).alias("points")), metadata(df))


def publication_dates(spark, sf):
    df = series.quarter_last(mixed_series(spark, sf))
    over = metadata(df).filter("frequency = 'monthly'").select("SeriesID", F.lit("publication").alias("DateBasis"), F.lit(-1).alias("QuarterOffset"))
    return series.publication_dates(df, over)


def sector_bridge(spark, sf):
    return series.sector_bridge(metadata(mixed_series(spark, sf)))


def date_dimension(spark, sf):
    return series.date_dimension(daily_series(spark, sf))


def series_fact(spark, sf):
    """Fact rows joined back to their dimension by the surrogate key."""
    df = materialize(mixed_series(spark, sf), "series")
    fact = series.series_fact(df)
    dims = series.series_dimension(df, metadata(df)).select("SeriesKey", "SeriesID", "short_name")
    return fact.join(dims, "SeriesKey").select("SeriesID", "short_name", "DateKey", "VALUE")


def mom_yoy(spark, sf):
    return series.monthly_measures(monthly(spark, sf)).drop("VALUE")


def lagged_corr(spark, sf):
    cols = ["NACI", "LNLS"]
    subject = bank_panel(spark, sf, cols).filter(F.col("CERT") == SUBJECT)
    return r(series.lagged_correlation(subject, cols, daily_series(spark, sf), "REPDTE"), "correlation")


def macro_table(spark, sf):
    df = mixed_series(spark, sf)
    return series.macro_table(df, metadata(df))


def stress_overlay(spark, sf):
    subject = bank_panel(spark, sf, ["LNLS"]).filter(F.col("CERT") == SUBJECT)
    return r(series.overlay(subject, "LNLS", daily_series(spark, sf), "REPDTE"), "shown")


def yoy_overlay(spark, sf):
    subject = bank_panel(spark, sf, ["LNLS"]).filter(F.col("CERT") == SUBJECT)
    return series.overlay(subject, "LNLS", daily_series(spark, sf), "REPDTE", yoy=True)


def sma_bollinger_z(spark, sf):
    df = indicators.bollinger(monthly(spark, sf), 6, 2.0).withColumns({"SMA": indicators.moving_average(12), "ZScore": indicators.rolling_zscore(24)})
    return r(df.drop("VALUE"), "SMA", "BB_Upper", "BB_Lower", "BB_Width", "ZScore", digits=6)


def rsi(spark, sf):
    return r(indicators.rsi(monthly(spark, sf), 14), "RSI").drop("VALUE")


def ema(spark, sf):
    return r(indicators.ema(monthly(spark, sf), 12), "EMA", digits=4).drop("VALUE")


def ema_daily(spark, sf):
    """Daily values run over many carry blocks."""
    df = daily_series(spark, sf).withColumn("VALUE", F.col("VALUE") / 10000)
    return r(indicators.ema(df, 9), "EMA", digits=4).drop("VALUE")


def trend_slope(spark, sf):
    df = indicators.with_position(monthly(spark, sf).filter("VALUE is not null"))
    return r(df.withColumn("slope_pct", indicators.trend_slope(12)), "slope_pct").select("SeriesID", "DATE", "slope_pct")


def _technical(spark, sf):
    return indicators.technical_indicators(monthly(spark, sf).filter("VALUE is not null"), 6, 6, 6, 1.0, 6, 12)


def signals(spark, sf):
    """The best indicator rotates over the suppliers' return-flag majority and number, so that every rule is used."""
    share = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("SeriesID")).agg(
        F.max_by("l_returnflag", F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_returnflag")).alias("flag")
    )
    best = F.expr("case when flag = 'A' or SeriesID % 5 = 0 then if(SeriesID % 2 = 0, 'EMA', 'SMA') when flag = 'N' then 'Bollinger Bands' else 'RSI' end")
    df = _technical(spark, sf).join(share.select("SeriesID", best.alias("best_technical")), "SeriesID")
    return indicators.select_signals(df).select("SeriesID", "DATE", "best_technical", "signal")


def indicator_long(spark, sf):
    """All seven indicators and the value itself, with the attributes of the series that have any."""
    df = dealt(materialize(_technical(spark, sf), "technical"), tasks(table(spark, sf, "lineitem")), "SeriesID")
    dimension = df.select("SeriesID").distinct().filter("SeriesID % 10 <> 0").selectExpr(
        "SeriesID", "if(SeriesID % 2 = 0, 'leading', 'lagging') as Type", "if(SeriesID % 3 = 0, 'short', 'long') as Horizon", "concat('s', SeriesID % 4, '|all') as Sectors"
    )
    columns = indicators.indicator_columns()
    return r(series.indicator_long(df, columns, dimension, "Actual Value"), "Indicator_Value", digits=4)


def long_horizon(spark, sf):
    """Fields of the long view, with context where a series has levels."""
    levels = F.expr("case when SeriesID < 30 then map('stress', 80000D, 'recession', 50000D) when SeriesID < 60 then map('Expansion', 60000D, 'curve_inversion', 45000.5D) end")
    df = indicators.analysis_fields(indicators.long_horizon(monthly(spark, sf)).withColumn("levels", levels), "levels").drop("levels")
    return r(df, "ma_12", "ma_24", "yoy_pct", "trend_slope_pct", "z_36", digits=5)


def risk_score(spark, sf):
    df = monthly(spark, sf).withColumn("VALUE", F.col("VALUE") - 60000)
    ids = df.select("SeriesID").distinct()
    meta = ids.selectExpr(
        "SeriesID",
        "case when SeriesID < 30 then 'leading' else 'lagging' end as type",
        "case when SeriesID between 40 and 60 then 'Loan Delinquency' else 'Volume' end as long_name",
        "case when SeriesID < 30 then map('stress', 20000D, 'normal', 5000D) when SeriesID < 40 then map('stress', -20000D, 'normal', 0D) when SeriesID < 50 then map('Extreme', -30000D, 'normal', -5000D) end as benchmark",
        "case when SeriesID between 10 and 20 then 'inversion' when SeriesID >= 70 then 'credit_spread' end as floor_rule",
    )
    df = indicators.risk_score(df, meta)
    scores = ["deviation_score", "benchmark_score", "volatility_score", "momentum_score", "risk_score"]
    return r(df, *scores).drop("VALUE")


QUERIES = {
    "daily_ffill": daily_ffill,
    "month_asof": month_asof,
    "month_linear": month_linear,
    "quarter_last": quarter_last,
    "one_per_day": one_per_day,
    "wide_to_long": wide_to_long,
    "series_spread": series_spread,
    "aggregate_proxy": aggregate_proxy,
    "yoy_and_pp": yoy_and_pp,
    "window_zscore": window_zscore,
    "series_quality": series_quality,
    "infer_frequency": infer_frequency,
    "backfill_metadata": backfill_metadata,
    "describe_series": describe_series,
    "publication_dates": publication_dates,
    "sector_bridge": sector_bridge,
    "date_dimension": date_dimension,
    "series_fact": series_fact,
    "mom_yoy": mom_yoy,
    "lagged_corr": lagged_corr,
    "macro_table": macro_table,
    "stress_overlay": stress_overlay,
    "yoy_overlay": yoy_overlay,
    "sma_bollinger_z": sma_bollinger_z,
    "rsi": rsi,
    "ema": ema,
    "ema_daily": ema_daily,
    "trend_slope": trend_slope,
    "signals": signals,
    "indicator_long": indicator_long,
    "long_horizon": long_horizon,
    "risk_score": risk_score,
}

S = "partition by SeriesID order by DATE"


def rows(n):
    return f"({S} rows between {n - 1} preceding and current row)"


def qe(c):
    return f"cast(last_day(cast(date_trunc('quarter', {c}) as date) + interval 2 month) as date)"


register(
    "monthly_raw",
    """select c.SeriesID, c.DATE, s.VALUE from (select SeriesID, cast(unnest(generate_series(date_trunc('month', min(DATE)), date_trunc('month', max(DATE)), interval 1 month)) as date) as DATE from series group by SeriesID) c
       asof left join series s on c.SeriesID = s.SeriesID and c.DATE >= s.DATE""",
    ("series",),
)
register("monthly", "select SeriesID, DATE, VALUE / 10000 as VALUE from monthly_raw", ("monthly_raw",))
register("known", "select *, row_number() over (partition by SeriesID order by DATE) as pos from monthly where VALUE is not null", ("monthly",))
register("quarterly", f"select SeriesID, {qe('DATE')} as DATE, max_by(VALUE, DATE) as VALUE from series group by 1, 2", ("series",))
_V = LINE_MEASURES["v"]
register(
    "mixed",
    f"""select 'D' || SeriesID as SeriesID, DATE, VALUE from series union all
        select 'M' || l_linestatus, cast(date_trunc('month', l_shipdate) as date), cast(sum({_V}) as double) from lineitem group by 1, 2 union all
        select 'Q' || l_returnflag, {qe('l_shipdate')}, cast(sum({_V}) as double) from lineitem group by 1, 2 union all
        select 'ALL', cast(l_shipdate as date), cast(sum({_V}) as double) from lineitem group by 1, 2""",
    ("series",),
)
register(
    "meta",
    """select SeriesID, case left(SeriesID, 1) when 'M' then 'monthly' when 'A' then 'unknown' end as frequency, case left(SeriesID, 1) when 'M' then 'M' end as frequency_short,
       case left(SeriesID, 1) when 'M' then ' rates, credit,, ' else 'volume' end as sectors, 'series ' || SeriesID as short_name from (select distinct SeriesID from mixed) where left(SeriesID, 1) <> 'Q'""",
    ("mixed",),
)

register("gaps", "select SeriesID, DATE, case when day(DATE) <> 13 then VALUE end as VALUE from mixed", ("mixed",))


def freq_sql(source):
    return f"""select a.SeriesID, case when n < 3 then 'monthly' when aligned and s0 = s1 and s0 = 1 then 'monthly' when aligned and s0 = s1 and s0 = 3 then 'quarterly'
      when (g0 = g1 and g0 in (1, 7)) or workdays then 'daily' when mpy >= 200 then 'daily' when mpy between 6 and 15 then 'monthly' when mpy between 3 and 5 then 'quarterly' when mm >= 6 then 'monthly' else 'quarterly' end as frequency
      from (select SeriesID, count(*) as n, min(gap) as g0, max(gap) as g1, min(step) as s0, max(step) as s1, bool_and(gap is null or gap = 1 or (gap = 3 and dayofweek(DATE) = 1)) as workdays,
        bool_and(last_day(DATE) = DATE) or min(day(DATE)) = max(day(DATE)) as aligned
        from (select *, date_diff('day', lag(DATE) over w, DATE) as gap, (year(DATE) * 12 + month(DATE)) - lag(year(DATE) * 12 + month(DATE)) over w as step
          from (select distinct SeriesID, DATE from {source} where VALUE is not null) window w as ({S})) group by SeriesID) a
      join (select SeriesID, median(c) as mpy, median(m) as mm from (select SeriesID, year(DATE), count(distinct DATE) as c, count(distinct month(DATE)) as m from {source} where VALUE is not null group by 1, 2) group by 1) b using (SeriesID)"""


_BANDS = f"avg(VALUE) over {rows(6)} as m, stddev_samp(VALUE) over {rows(6)} as s"
_GAIN = f"case when VALUE - lag(VALUE) over ({S}) > 0 then VALUE - lag(VALUE) over ({S}) else 0.0 end as g, case when VALUE - lag(VALUE) over ({S}) < 0 then lag(VALUE) over ({S}) - VALUE else 0.0 end as l"


def rsi_sql(n, source):
    return f"""select SeriesID, DATE, VALUE, case when c = {n} then case when al > 0 then 100 - 100 / (1 + ag / nullif(al, 0)) when ag > 0 then 100.0 end end as RSI from (
        select *, avg(g) over {rows(n)} as ag, avg(l) over {rows(n)} as al, count(*) over {rows(n)} as c from (select *, {_GAIN} from {source}))"""


def ema_sql(span, source):
    a = 2.0 / (span + 1)
    return f"""e as (select SeriesID, DATE, VALUE, pos, VALUE as EMA from {source} where pos = 1
        union all select k.SeriesID, k.DATE, k.VALUE, k.pos, {a!r}::double * k.VALUE + {1 - a!r}::double * e.EMA from e join {source} k on k.SeriesID = e.SeriesID and k.pos = e.pos + 1)"""


def with_recursive(cte, body, *needs):
    text = with_ctes("@@", *needs, recursive=True)
    return text.replace("\n@@", f",\n{cte}\n{body}")


register(
    "tech",
    f"""select k.SeriesID, k.DATE, k.VALUE, k.pos, avg(k.VALUE) over (partition by k.SeriesID order by k.DATE rows between 5 preceding and current row) as SMA,
        m + s * 1.0 as BB_Upper, m - s * 1.0 as BB_Lower, coalesce(((m + s * 1.0) - (m - s * 1.0)) / nullif(m, 0), 0.0) as BB_Width, r.RSI
        from (select *, {_BANDS} from known) k join ({rsi_sql(6, 'known')}) r on k.SeriesID = r.SeriesID and k.DATE = r.DATE""",
    ("known",),
)
register(
    "horizon",
    f"""select SeriesID, DATE, VALUE, case when n >= 12 then ya end as year_ago, case when n >= 12 then m12 end as ma_12, case when n >= 12 then coalesce((VALUE - ya) / nullif(ya, 0) * 100, 0.0) end as yoy_pct,
        case when n >= 12 then case when n >= 24 then m24 else m12 end end as ma_24, case when n >= 12 then case when n >= 24 then coalesce(sl * 12 / nullif(m24, 0) * 100, 0.0) else 0.0 end end as trend_slope_pct,
        case when n >= 12 then case when n >= 36 and s36 > 0 then (VALUE - m36) / nullif(s36, 0) else 0.0 end end as z_36,
        case when n >= 12 then (len(list_filter(h, lambda x: x < VALUE)) + len(list_filter(h, lambda x: x <= VALUE)) + 1) * 50.0 / len(h) end as percentile_60
        from (select *, count(*) over ({S}) as n, coalesce(lag(VALUE, 12) over ({S}), first(VALUE) over ({S})) as ya, avg(VALUE) over {rows(12)} as m12, avg(VALUE) over {rows(24)} as m24,
          regr_slope(VALUE, pos) over {rows(24)} as sl, avg(VALUE) over {rows(36)} as m36, stddev_samp(VALUE) over {rows(36)} as s36, list(VALUE) over {rows(60)} as h from known)""",
    ("known",),
)
_ENOUGH = f"row_number() over ({S}) >= 6"
_L = f"lag({{}}) over ({S})"


def signal_sql():
    v, lv = "VALUE", _L.format("VALUE")
    sma = f"""case when VALUE is null or SMA is null then 'Awaiting Data' when {lv} <= {_L.format('SMA')} and VALUE > SMA then 'Bullish Crossover (SMA)' when {lv} >= {_L.format('SMA')} and VALUE < SMA then 'Bearish Crossover (SMA)'
      when min(case when VALUE > SMA then 1 else 0 end) over {rows(5)} = 1 then 'Confirmed Bullish Trend (Above SMA for 5 periods)' when min(case when VALUE < SMA then 1 else 0 end) over {rows(5)} = 1 then 'Confirmed Bearish Trend (Below SMA for 5 periods)' else 'Neutral (Consolidating)' end"""
    bb = f"""case when BB_Upper is null or BB_Lower is null then 'Awaiting Data' when {v} > BB_Upper and {lv} <= {_L.format('BB_Upper')} then 'Volatility Breakout (High Stress)' when {v} > BB_Upper then 'Sustained High Volatility'
      when {v} < BB_Lower and {lv} >= {_L.format('BB_Lower')} then 'Volatility Breakout (Low/Recession)' when {v} < BB_Lower then 'Sustained Low Pressure' else 'Neutral (Range-bound)' end"""
    rs = f"""case when RSI is null then 'Awaiting Data' when RSI > 80 then 'Extreme Overbought (High Momentum)' when RSI > 70 then 'Overbought' when RSI < 20 then 'Extreme Oversold (Low Momentum)' when RSI < 30 then 'Oversold'
      when RSI > avg(RSI) over {rows(5)} and RSI > 50 then 'Gaining Bullish Momentum' when RSI < avg(RSI) over {rows(5)} and RSI < 50 then 'Gaining Bearish Momentum' else 'Neutral Momentum' end"""
    return f"""select SeriesID, DATE, best_technical, case when not ok then 'Awaiting Data (Insufficient History)' when best_technical = 'SMA' then a when best_technical = 'EMA' then d when best_technical = 'RSI' then c else b end as signal from (
      select *, {_ENOUGH} as ok, {sma} as a, {bb} as b, {rs} as c, {sma.replace('SMA', 'EMA')} as d from tech join (select SeriesID, DATE, EMA from e) using (SeriesID, DATE)) join (
      select SeriesID, case when flag = 'A' or SeriesID % 5 = 0 then if(SeriesID % 2 = 0, 'EMA', 'SMA') when flag = 'N' then 'Bollinger Bands' else 'RSI' end as best_technical from (
        select l_suppkey as SeriesID, first(l_returnflag order by l_shipdate desc, l_orderkey desc, l_linenumber desc, l_returnflag desc) as flag from lineitem group by 1)) using (SeriesID)"""


_Z = "case when s36 > 0 then abs((v - m36) / nullif(s36, 0)) else 0.0 end"
_RISK = f"""select SeriesID, DATE, case when n >= 12 then round(dev, 6) end as deviation_score, case when n >= 12 then round(ben, 6) end as benchmark_score, case when n >= 12 then round(vol, 6) end as volatility_score,
  case when n >= 12 then round(mom, 6) end as momentum_score, case when n >= 12 then round(sc, 6) end as risk_score, case when n >= 12 then case when sc >= 70 then 'Red' when sc >= 40 then 'Yellow' else 'Green' end end as risk_color from (
  select *, greatest(dev + ben + vol + mom, case when SeriesID between 10 and 20 and v < 0 then 80.0 else 0.0 end,
    case when SeriesID >= 70 and (len(list_filter(h, lambda x: x < v)) + len(list_filter(h, lambda x: x <= v)) + 1) * 50.0 / len(h) > 90 then 70.0 else 0.0 end) as sc from (
  select *, least(40.0, {_Z} / 3 * 40) as dev, case when SeriesID < 30 then greatest(case when v > 20000 then 30.0::double when v > 16000 then 20.0 else 0.0 end, case when abs(v - 5000) / 5000 > 0.5 then 15.0::double else 0.0 end)
      when SeriesID < 40 then greatest(case when v > -20000 then 30.0::double when v > -16000 then 20.0 else 0.0 end, case when v <> 0 then 15.0::double else 0.0 end)
      when SeriesID < 50 then case when v > -30000 then 30.0::double else 0.0 end else 0.0::double end as ben,
    least(20.0, greatest(0.0, (case when sall > 0 then s12 / nullif(sall, 0) else 1.0 end - 1) * 20)) as vol,
    case when (SeriesID < 30 and sl < 0) or (SeriesID between 40 and 60 and sl > 0) then 10.0::double else 0.0 end as mom from (
  select *, count(*) over ({S}) as n, avg(v) over {rows(36)} as m36, stddev_samp(v) over {rows(36)} as s36, stddev_samp(v) over {rows(12)} as s12, stddev_samp(v) over ({S}) as sall,
    regr_slope(v, pos) over {rows(6)} as sl, list(v) over ({S}) as h from (select *, VALUE - 60000 as v from known))))"""

ORACLES = {
    "daily_ffill": with_ctes(
        """select c.SeriesID, c.DATE, s.VALUE from (select SeriesID, cast(unnest(generate_series(cast(min(DATE) as timestamp), cast((select max(DATE) from series) as timestamp), interval 1 day)) as date) as DATE from series group by SeriesID) c
           asof join series s on c.SeriesID = s.SeriesID and c.DATE >= s.DATE""",
        "series",
    ),
    "month_asof": with_ctes("select SeriesID, DATE, VALUE from monthly_raw", "monthly_raw"),
    "month_linear": with_ctes(
        """select c.SeriesID, c.DATE, round(a.VALUE + coalesce(date_diff('day', a.DATE, c.DATE) * (b.VALUE - a.VALUE) / nullif(date_diff('day', a.DATE, b.DATE), 0), 0.0), 2) as VALUE
           from (select SeriesID, DATE from monthly_raw where VALUE is not null) c asof join series a on c.SeriesID = a.SeriesID and c.DATE >= a.DATE asof left join series b on c.SeriesID = b.SeriesID and c.DATE < b.DATE""",
        "monthly_raw",
    ),
    "quarter_last": with_ctes("select * from quarterly", "quarterly"),
    "one_per_day": "select event_type as SeriesID, cast(ts as date) as DATE, first(value order by ts desc, event_id desc) as VALUE from events where value is not null group by 1, 2",
    "wide_to_long": "select event_type as SeriesID, cast(ts as date) as DATE, cast(count(*) as double) as VALUE from events group by 1, 2",
    "series_spread": with_ctes(
        """select 'D1-D2' as SeriesID, DATE, a - b as VALUE from (select DATE, last_value(x ignore nulls) over (order by DATE) as a, last_value(y ignore nulls) over (order by DATE) as b
           from (select DATE, max(VALUE) filter (SeriesID = 1) as x, max(VALUE) filter (SeriesID = 2) as y from series where SeriesID in (1, 2) group by 1)) where a - b is not null""",
        "series",
    ),
    "aggregate_proxy": with_ctes(
        """select DATE, last_value(a ignore nulls) over (order by DATE) as open_proxy, last_value(b ignore nulls) over (order by DATE) as filled_proxy, last_value(c ignore nulls) over (order by DATE) as quarter_proxy
           from (select DATE, max(VALUE) filter (SeriesID = 'MO') as a, max(VALUE) filter (SeriesID = 'MF') as b, max(VALUE) filter (SeriesID = 'QA') as c from mixed where SeriesID in ('MO', 'MF', 'QA') group by 1)""",
        "mixed",
    ),
    "yoy_and_pp": with_ctes(f"select SeriesID, DATE, VALUE / nullif(lag(VALUE, 4) over ({S}), 0) - 1 as yoy, VALUE - lag(VALUE, 4) over ({S}) as pp from quarterly", "quarterly"),
    "window_zscore": with_ctes(
        "select SeriesID, DATE, VALUE, round(case when s > 0 then (VALUE - m) / nullif(s, 0) else 0.0 end, 6) as zscore from (select *, avg(VALUE) over (partition by SeriesID) as m, stddev_samp(VALUE) over (partition by SeriesID) as s from quarterly)",
        "quarterly",
    ),
    "infer_frequency": with_ctes(f"select SeriesID, frequency, upper(left(frequency, 1)) as frequency_short from ({freq_sql('mixed')})", "mixed"),
    "backfill_metadata": with_ctes(
        f"""select SeriesID, case when m.frequency is null or m.frequency = 'unknown' then coalesce(f.frequency, m.frequency) else m.frequency end as frequency,
            case when m.frequency is null or m.frequency = 'unknown' then coalesce(upper(left(f.frequency, 1)), m.frequency_short) else m.frequency_short end as frequency_short
            from (select SeriesID, frequency, frequency_short from meta) m full join ({freq_sql('mixed')}) f using (SeriesID)""",
        "meta",
    ),
    "describe_series": with_ctes(
        "select SeriesID, points, frequency, frequency_short, sectors, short_name from (select SeriesID, count(*) as points from mixed group by 1) left join meta using (SeriesID)", "meta"
    ),
    "publication_dates": with_ctes(
        f"""select SeriesID, DATE, VALUE, case when left(SeriesID, 1) = 'M' then 'publication' else 'period_end' end as DateBasis, case when left(SeriesID, 1) = 'M' then -1 else 0 end as QuarterOffset,
            cast(case when left(SeriesID, 1) = 'M' then last_day(DATE - interval 3 month) else last_day(DATE) end as date) as EFFECTIVE_DATE from (select SeriesID, {qe('DATE')} as DATE, max_by(VALUE, DATE) as VALUE from mixed group by 1, 2)""",
        "mixed",
    ),
    "sector_bridge": with_ctes("select distinct SeriesID, sector from (select SeriesID, trim(unnest(string_split(sectors, ','))) as sector from meta) where sector <> ''", "meta"),
    "date_dimension": with_ctes(
        """select cast(strftime(d, '%Y%m%d') as integer) as DateKey, cast(d as date) as "Date", cast(year(d) as integer) as "Year", cast(quarter(d) as integer) as "Quarter", cast(month(d) as integer) as "Month", monthname(d) as "MonthName", dayname(d) as "DayName", cast(weekofyear(d) as integer) as "WeekOfYear"
           from (select unnest(generate_series(date_trunc('year', min(DATE))::timestamp, last_day(max(DATE))::timestamp, interval 1 day)) as d from series)""",
        "series",
    ),
    "series_fact": with_ctes("select SeriesID, short_name, cast(strftime(DATE, '%Y%m%d') as integer) as DateKey, VALUE from mixed join meta using (SeriesID)", "meta"),
    "mom_yoy": with_ctes(
        f"""select SeriesID, DATE, p as previous_month, y as same_month_last_year, (VALUE / nullif(p, 0) - 1) * 100.0 as mom_pct, (VALUE / nullif(y, 0) - 1) * 100.0 as yoy_pct
            from (select *, lag(VALUE) over ({S}) as p, lag(VALUE, 12) over ({S}) as y from monthly)""",
        "monthly",
    ),
    "lagged_corr": with_ctes(
        f"""select metric, SeriesID, count(*) filter (x is not null and VALUE is not null) as pairs, round(case when count(*) filter (x is not null and VALUE is not null) >= 4 then corr(x, VALUE) end, 6) as correlation
            from (select REPDTE, unnest(['NACI', 'LNLS']) as metric, unnest([NACI, LNLS]) as x from (select * from panel where CERT = {SUBJECT} order by REPDTE desc limit 20)) p
            join (select SeriesID, cast(last_day(DATE + interval 3 month) as date) as D, VALUE from quarterly) q on p.REPDTE = q.D group by 1, 2""",
        "panel",
        "quarterly",
    ),
    "macro_table": with_ctes(
        """select SeriesID, short_name, max_by(VALUE, DATE) filter (year(DATE) = y and VALUE <> 0) as current_value, max_by(VALUE, DATE) filter (year(DATE) = y - 1) as prior_year_value
           from (select *, (select year(max(DATE)) from mixed) as y from mixed) join meta using (SeriesID) group by 1, 2""",
        "meta",
    ),
    "stress_overlay": with_ctes(
        f"""select q.DATE, SeriesID, LNLS as metric_value, round(case when stddev_samp(VALUE) over (partition by SeriesID) > 0 then (VALUE - avg(VALUE) over (partition by SeriesID)) / nullif(stddev_samp(VALUE) over (partition by SeriesID), 0) else 0.0 end, 6) as shown
            from quarterly q join (select * from panel where CERT = {SUBJECT}) p on p.REPDTE = q.DATE""",
        "panel",
        "quarterly",
    ),
    "yoy_overlay": with_ctes(
        f"""select q.DATE, SeriesID, LNLS as metric_value, shown from (select *, (VALUE / nullif(lag(VALUE, 4) over ({S}), 0) - 1) * 100 as shown from quarterly) q join (select * from panel where CERT = {SUBJECT}) p on p.REPDTE = q.DATE""",
        "panel",
        "quarterly",
    ),
    "sma_bollinger_z": with_ctes(
        f"""select SeriesID, DATE, round(sma, 6) as SMA, round(m + s * 2.0, 6) as BB_Upper, round(m - s * 2.0, 6) as BB_Lower, round(coalesce(((m + s * 2.0) - (m - s * 2.0)) / nullif(m, 0), 0.0), 6) as BB_Width, round(coalesce((VALUE - m24) / nullif(s24, 0), 0.0), 6) as ZScore
            from (select *, avg(VALUE) over {rows(12)} as sma, {_BANDS}, avg(VALUE) over {rows(24)} as m24, stddev_samp(VALUE) over {rows(24)} as s24 from monthly)""",
        "monthly",
    ),
    "rsi": with_ctes(f"select SeriesID, DATE, round(RSI, 6) as RSI from ({rsi_sql(14, 'monthly')})", "monthly"),
    "ema": with_recursive(ema_sql(12, "known"), "select SeriesID, DATE, round(EMA, 4) as EMA from e union all select SeriesID, DATE, null from monthly where VALUE is null", "known"),
    "ema_daily": with_recursive(
        "k as (select SeriesID, DATE, VALUE / 10000 as VALUE, row_number() over (partition by SeriesID order by DATE) as pos from series),\n" + ema_sql(9, "k"),
        "select SeriesID, DATE, round(EMA, 4) as EMA from e",
        "series",
    ),
    "trend_slope": with_ctes(
        f"select SeriesID, DATE, round(case when count(*) over {rows(12)} = 12 then coalesce(regr_slope(VALUE, pos) over {rows(12)} * 12 / nullif(avg(VALUE) over {rows(12)}, 0) * 100, 0.0) else 0.0 end, 6) as slope_pct from known", "known"
    ),
    "signals": with_recursive(ema_sql(6, "known"), signal_sql(), "tech"),
    "indicator_long": with_recursive(
        ema_sql(6, "known"),
        f"""select SeriesID, DATE, Indicator_Name, round(v, 4) as Indicator_Value, case when SeriesID % 10 <> 0 then if(SeriesID % 2 = 0, 'leading', 'lagging') end as Type,
            case when SeriesID % 10 <> 0 then if(SeriesID % 3 = 0, 'short', 'long') end as Horizon, case when SeriesID % 10 <> 0 then 's' || (SeriesID % 4) || '|all' end as Sectors from (
            select SeriesID, DATE, unnest(['Actual Value', 'SMA', 'EMA', 'BB_Upper', 'BB_Lower', 'BB_Width', 'RSI', 'ZScore']) as Indicator_Name, unnest([VALUE, SMA, EMA, BB_Upper, BB_Lower, BB_Width, RSI, z]) as v
            from (select *, coalesce((VALUE - avg(VALUE) over {rows(12)}) / nullif(stddev_samp(VALUE) over {rows(12)}, 0), 0.0) as z from tech) join (select SeriesID, DATE, EMA from e) using (SeriesID, DATE))""",
        "tech",
    ),
    "long_horizon": with_ctes(
        """select SeriesID, DATE, VALUE, year_ago, round(ma_12, 5) as ma_12, round(yoy_pct, 5) as yoy_pct, round(ma_24, 5) as ma_24, round(trend_slope_pct, 5) as trend_slope_pct, round(z_36, 5) as z_36, percentile_60,
           case when trend_slope_pct > 0.5 then 'upward' when trend_slope_pct < -0.5 then 'downward' when trend_slope_pct is not null then 'sideways' end as trend_direction,
           case when VALUE > ma_12 then 'above' when ma_12 is not null then 'below' end as ma_signal,
           case when z_36 > 2 then 'extreme high' when z_36 < -2 then 'extreme low' when z_36 > 1 then 'elevated' when z_36 < -1 then 'depressed' end as volatility_status,
           case when SeriesID < 30 then concat_ws('. ', case when VALUE > 80000 then 'Value exceeds stress threshold of 80000.00' end, case when VALUE < 50000 then 'Below recession threshold of 50000.00' end)
             when SeriesID < 60 then concat_ws('. ', case when VALUE > 60000 then 'In expansion territory (above 60000.00)' end, case when VALUE < 45000.5 then 'Yield curve inverted (below 45000.50)' end) end as benchmark_context from horizon""",
        "horizon",
    ),
    "risk_score": with_ctes(_RISK, "known"),
    "series_quality": with_ctes(
        f"""select SeriesID, points, round(missing_data_pct, 6) as missing_data_pct, last_update, coalesce(outliers_detected, 0) as outliers_detected, frequency as data_frequency from (
            select SeriesID, count(*) as points, count(*) filter (VALUE is null) * 100.0 / count(*) as missing_data_pct, max(DATE) filter (VALUE is not null) as last_update from gaps group by 1)
            left join (select SeriesID, count(*) filter (n > 3 and abs((VALUE - m) / nullif(s, 0)) > 3) as outliers_detected from (select *, avg(VALUE) over p as m, stddev_pop(VALUE) over p as s, count(VALUE) over p as n from gaps window p as (partition by SeriesID)) group by 1) using (SeriesID)
            left join ({freq_sql('gaps')}) using (SeriesID)""",
        "gaps",
    ),
}
