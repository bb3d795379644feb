"""Technical indicators, signals and risk scores over a monthly series.

Each frame is at most a few hundred rows wide and every window partitions by series, so one
shuffle by series serves all of them. All rows are computed at once; nothing is recomputed
per prefix.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from quarterdeck.operators.series import DATE, ID, VALUE, by_series

HORIZONS = {"short": 2, "medium": 5, "long": 10}


def last(n: int):
    return by_series().rowsBetween(-(n - 1), 0)


def everything_before():
    return by_series().rowsBetween(W.unboundedPreceding, 0)


def moving_average(n: int) -> Column:
    return F.avg(VALUE).over(last(n))


def bollinger(df: DataFrame, n: int = 20, k: float = 2.0) -> DataFrame:
    """Bands around the mean by k sample deviations, and their width over the mean (0 where undefined)."""
    mean, std = F.avg(VALUE).over(last(n)), F.stddev_samp(VALUE).over(last(n))
    banded = df.withColumns({"_mean": mean, "_std": std})
    banded = banded.withColumns(
        {"BB_Upper": F.col("_mean") + F.col("_std") * k, "BB_Lower": F.col("_mean") - F.col("_std") * k}
    )
    width = F.coalesce(F.try_divide(F.col("BB_Upper") - F.col("BB_Lower"), F.col("_mean")), F.lit(0.0))
    return banded.withColumn("BB_Width", width).drop("_mean", "_std")


def rsi(df: DataFrame, n: int = 14, out: str = "RSI") -> DataFrame:
    """Simple-mean RSI over full windows. No losses but gains: 100; neither: NULL."""
    move = F.col(VALUE) - F.lag(VALUE).over(by_series())
    staged = df.withColumns(
        {"_gain": F.when(move > 0, move).otherwise(F.lit(0.0)), "_loss": F.when(move < 0, -move).otherwise(F.lit(0.0))}
    )
    staged = staged.withColumns(
        {
            "_ag": F.avg("_gain").over(last(n)),
            "_al": F.avg("_loss").over(last(n)),
            "_full": F.count(F.lit(1)).over(last(n)) == n,
        }
    )
    value = F.when(F.col("_al") > 0, 100 - 100 / (1 + F.col("_ag") / F.nullif(F.col("_al"), F.lit(0.0)))).when(
        F.col("_ag") > 0, F.lit(100.0)
    )
    return staged.withColumn(out, F.when(F.col("_full"), value)).drop("_gain", "_loss", "_ag", "_al", "_full")


def rolling_zscore(n: int) -> Column:
    mean, std = F.avg(VALUE).over(last(n)), F.stddev_samp(VALUE).over(last(n))
    return F.coalesce(F.try_divide(F.col(VALUE) - mean, std), F.lit(0.0))


def linear_scan(value: str, decay: float, w, out: str, df: DataFrame) -> DataFrame:
    """``y = x + decay * (the y before)`` along a window, 0 before its first row, as a parallel scan.

    The maps ``y -> x + decay * y`` compose, so each step joins every row's composition with the one of as many rows as it already covers
    further back: spans double, and all steps share one partitioning and order. Steps end where the decay over a span is below the
    smallest double, which depends on ``decay`` alone and not on the number of rows.
    """
    made, span = df.withColumn(out, F.col(value)), 1
    while decay**span > 0.0 and span < 1 << 30:
        made = made.withColumn(out, F.col(out) + F.coalesce(F.lag(out, span).over(w), F.lit(0.0)) * decay**span)
        span *= 2
    return made


def ema(df: DataFrame, span: int, out: str = "EMA", block: int = 64) -> DataFrame:
    """Exponential mean, alpha = 2 / (span + 1), started at the first value; rows without a value get NULL.

    The recursion is linear, so it splits into blocks: a window gives each row the weighted sum of its own block, and a scan of the
    block ends (1/64 of the rows) gives the level that goes on from block to block. No row or array holds a series.
    """
    if span < 1:
        raise ValueError(f"span must be 1 or more, not {span}")
    if span == 1:  # alpha is 1: nothing of the past is kept
        return df.withColumn(out, F.col(VALUE))
    alpha = 2.0 / (span + 1)
    keep = 1.0 - alpha
    rows = df.filter(F.col(VALUE).isNotNull()).withColumn("_n", F.row_number().over(by_series()) - 1)
    rows = rows.withColumns({"_b": F.floor(F.col("_n") / block), "_j": F.col("_n") % block})
    # Weights relative to the block start stay within keep**-64, far inside a double's range
    # for spans of 2 and more. The very first value of a series has weight 1, not alpha.
    first = F.when(F.col("_n") == 0, F.lit(1.0)).otherwise(F.lit(alpha))
    scaled = first * F.col(VALUE) * F.pow(F.lit(keep), -F.col("_j"))
    inside = W.partitionBy(ID, "_b").orderBy("_n").rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumn("_own", F.sum(scaled).over(inside) * F.pow(F.lit(keep), F.col("_j")))
    # The last block of a series may be short, but no block comes after it: all that carry on are whole.
    ends = rows.groupBy(ID, "_b").agg(F.max_by("_own", "_n").alias("_end"))
    carry = linear_scan("_end", keep**block, W.partitionBy(ID).orderBy("_b"), "_carry", ends)
    carry = carry.select(ID, (F.col("_b") + 1).alias("_b"), "_carry")
    joined = rows.join(carry, [ID, "_b"], "left")
    level = F.col("_own") + F.coalesce("_carry", F.lit(0.0)) * F.pow(F.lit(keep), F.col("_j") + 1)
    made = joined.withColumn(out, level).select(*df.columns, out)
    unknown = df.filter(F.col(VALUE).isNull()).withColumn(out, F.lit(None).cast("double"))
    return made.unionByName(unknown)


DIGITS = 16  # time blocks that a block of the next size is made of


def expanding_rank(rows: DataFrame, pos: str = "_pos") -> DataFrame:
    """``SeriesID, pos, lt, le``: how many of a series' values up to a row are below, and at most, the row's own.

    ``pos`` numbers a series' rows from 1 in time order; values are not NULL. Time is cut into blocks of 16 rows, 16 blocks, and so on. Of
    two rows, the sizes tell one at which they lie in one block but in different parts of it; so a row's count is the sum, over
    the sizes, of the values at most its own in the earlier parts of its block. In the order of values these are prefix sums, one for
    each part: every block is a window of its own that holds sixteen counters, and no row carries its history. Rows are repeated once
    for each size, which is the logarithm of the longest series.
    """
    at = F.col(pos).cast("long") - 1
    size = rows.groupBy(ID).agg(F.max(at).alias("_last"))
    base = rows.select(ID, at.alias("_at"), F.col(VALUE).alias("_v")).join(size, ID)
    bits = DIGITS.bit_length() - 1
    # as many sizes as the last place of the series has digits
    levels = F.ceil(F.length(F.bin(F.col("_last"))) / F.lit(bits)).cast("int")
    spread = base.select(ID, "_at", "_v", F.explode(F.sequence(F.lit(0), levels - 1)).alias("_level"))
    shifted = F.expr(f"shiftright(_at, _level * {bits})")
    spread = spread.withColumns({"_part": shifted.bitwiseAND(DIGITS - 1), "_block": F.shiftright(shifted, bits)})
    below = W.partitionBy(ID, "_level", "_block").orderBy("_v", "_at").rowsBetween(W.unboundedPreceding, -1)
    counted = spread.withColumns({f"_c{k}": F.count(F.when(F.col("_part") == k, 1)).over(below) for k in range(DIGITS - 1)})
    earlier = sum((F.when(F.col("_part") > k, F.col(f"_c{k}")).otherwise(0) for k in range(DIGITS - 1)), F.lit(0))
    atmost = counted.groupBy(ID, "_at").agg((F.sum(earlier) + 1).alias("le"), F.first("_v").alias("_v"))
    same = F.row_number().over(W.partitionBy(ID, "_v").orderBy("_at"))
    return atmost.select(ID, (F.col("_at") + 1).alias(pos), (F.col("le") - same).alias("lt"), "le")


def trend_slope(n: int) -> Column:
    """Slope of the last n rows as percent of their mean per year (12 rows); 0 when short or flat at 0.

    Regresses on the row position, so the frame needs :func:`with_position`.
    """
    w = last(n)
    slope = F.regr_slope(F.col(VALUE), F.col("_pos")).over(w)
    pct = F.try_divide(slope * 12, F.avg(VALUE).over(w)) * 100
    return F.when((F.count(F.lit(1)).over(w) == n) & (F.count(VALUE).over(w) >= 2), F.coalesce(pct, F.lit(0.0))).otherwise(
        F.lit(0.0)
    )


def with_position(df: DataFrame) -> DataFrame:
    return df.withColumn("_pos", F.row_number().over(by_series()).cast("double"))


def technical_indicators(
    df: DataFrame, sma: int = 12, ema_span: int = 12, bands: int = 20, k: float = 2.0, rsi_rows: int = 14, z_rows: int = 36
) -> DataFrame:
    """SMA, EMA, Bollinger bands, RSI and z-score of a monthly series."""
    rows = rsi(bollinger(df, bands, k), rsi_rows)
    rows = rows.withColumns({"SMA": moving_average(sma), "ZScore": rolling_zscore(z_rows)})
    return ema(rows, ema_span)


def crossover_signal(tech: str, label: str, lookback: int = 5) -> Column:
    """State of the value against an average: crossing, confirmed side for ``lookback`` rows, or neutral."""
    w, k = by_series(), last(lookback)
    v, t = F.col(VALUE), F.col(tech)
    pv, pt = F.lag(VALUE).over(w), F.lag(tech).over(w)
    above = F.min(F.when(v > t, 1).otherwise(0)).over(k) == 1
    below = F.min(F.when(v < t, 1).otherwise(0)).over(k) == 1
    enough = F.row_number().over(w) >= lookback + 1
    return (
        F.when(~enough, "Awaiting Data (Insufficient History)")
        .when(v.isNull() | t.isNull(), "Awaiting Data")
        .when((pv <= pt) & (v > t), f"Bullish Crossover ({label})")
        .when((pv >= pt) & (v < t), f"Bearish Crossover ({label})")
        .when(above, f"Confirmed Bullish Trend (Above {label} for {lookback} periods)")
        .when(below, f"Confirmed Bearish Trend (Below {label} for {lookback} periods)")
        .otherwise("Neutral (Consolidating)")
    )


def band_signal(lookback: int = 5) -> Column:
    w = by_series()
    v, up, lo = F.col(VALUE), F.col("BB_Upper"), F.col("BB_Lower")
    pv, pup, plo = (F.lag(c).over(w) for c in (VALUE, "BB_Upper", "BB_Lower"))
    enough = F.row_number().over(w) >= lookback + 1
    return (
        F.when(~enough, "Awaiting Data (Insufficient History)")
        .when(v.isNull() | up.isNull() | lo.isNull(), "Awaiting Data")
        .when((v > up) & (pv <= pup), "Volatility Breakout (High Stress)")
        .when(v > up, "Sustained High Volatility")
        .when((v < lo) & (pv >= plo), "Volatility Breakout (Low/Recession)")
        .when(v < lo, "Sustained Low Pressure")
        .otherwise("Neutral (Range-bound)")
    )


def rsi_signal(lookback: int = 5) -> Column:
    r, mean = F.col("RSI"), F.avg("RSI").over(last(lookback))
    enough = F.row_number().over(by_series()) >= lookback + 1
    return (
        F.when(~enough, "Awaiting Data (Insufficient History)")
        .when(r.isNull(), "Awaiting Data")
        .when(r > 80, "Extreme Overbought (High Momentum)")
        .when(r > 70, "Overbought")
        .when(r < 20, "Extreme Oversold (Low Momentum)")
        .when(r < 30, "Oversold")
        .when((r > mean) & (r > 50), "Gaining Bullish Momentum")
        .when((r < mean) & (r < 50), "Gaining Bearish Momentum")
        .otherwise("Neutral Momentum")
    )


def rank_in(values: Column, score: Column) -> Column:
    """Percentile of a score in an array of values: mean of strict and weak rank."""
    lt = F.size(F.filter(values, lambda x: x < score))
    le = F.size(F.filter(values, lambda x: x <= score))
    return F.try_divide((lt + le + F.when(le > lt, 1).otherwise(0)) * F.lit(50.0), F.size(values))


def long_horizon(df: DataFrame) -> DataFrame:
    """Value a year ago, long means, 24-row trend, 36-row z-score and percentile of the last 60 rows.

    Rows with fewer than 12 values behind them get NULL throughout.
    """
    w = by_series()
    n = F.count(F.lit(1)).over(everything_before())
    known = with_position(df.filter(F.col(VALUE).isNotNull())).withColumn("_n", n)
    year_ago = F.coalesce(F.lag(VALUE, 12).over(w), F.first(VALUE).over(everything_before()))
    staged = known.withColumns(
        {
            "year_ago": year_ago,
            "ma_12": F.avg(VALUE).over(last(12)),
            "_ma24": F.avg(VALUE).over(last(24)),
            "_slope": F.regr_slope(F.col(VALUE), F.col("_pos")).over(last(24)),
            "_m36": F.avg(VALUE).over(last(36)),
            "_s36": F.stddev_samp(VALUE).over(last(36)),
            "_h60": F.collect_list(VALUE).over(last(60)),
        }
    )
    enough = F.col("_n") >= 12
    full24 = F.col("_n") >= 24
    z = F.when((F.col("_n") >= 36) & (F.col("_s36") > 0), (F.col(VALUE) - F.col("_m36")) / F.nullif("_s36", F.lit(0.0))).otherwise(F.lit(0.0))
    slope = F.when(full24, F.coalesce(F.try_divide(F.col("_slope") * 12, F.col("_ma24")) * 100, F.lit(0.0))).otherwise(F.lit(0.0))
    yoy = F.coalesce(F.try_divide(F.col(VALUE) - F.col("year_ago"), F.col("year_ago")) * 100, F.lit(0.0))
    out = {
        "yoy_pct": yoy,
        "ma_24": F.when(full24, F.col("_ma24")).otherwise(F.col("ma_12")),
        "trend_slope_pct": slope,
        "z_36": z,
        "percentile_60": rank_in(F.col("_h60"), F.col(VALUE)),
    }
    made = staged.withColumns(out)
    names = ["year_ago", "ma_12", *out]
    return made.select(ID, DATE, VALUE, *[F.when(enough, F.col(c)).alias(c) for c in names])


def analysis_fields(df: DataFrame, benchmark: str | None = None) -> DataFrame:
    """Words for the long-horizon numbers: trend, side of the mean, volatility, benchmark context.

    ``benchmark`` names a map column regime -> threshold.
    """
    z, s = F.col("z_36"), F.col("trend_slope_pct")
    out: dict[str, Column] = {
        "trend_direction": F.when(s > 0.5, "upward").when(s < -0.5, "downward").when(s.isNotNull(), "sideways"),
        "ma_signal": F.when(F.col(VALUE) > F.col("ma_12"), "above").when(F.col("ma_12").isNotNull(), "below"),
        "volatility_status": F.when(z > 2, "extreme high")
        .when(z < -2, "extreme low")
        .when(z > 1, "elevated")
        .when(z < -1, "depressed"),
    }
    if benchmark:
        def word(e: Column) -> Column:
            key, limit, v = F.lower(e["key"]), e["value"], F.col(VALUE)
            return (
                F.when(key.contains("stress"), F.when(v > limit, F.format_string("Value exceeds stress threshold of %.2f", limit)))
                .when(key.contains("recession"), F.when(v < limit, F.format_string("Below recession threshold of %.2f", limit)))
                .when(key.contains("expansion"), F.when(v > limit, F.format_string("In expansion territory (above %.2f)", limit)))
                .when(key.contains("inversion"), F.when(v < limit, F.format_string("Yield curve inverted (below %.2f)", limit)))
            )

        out["benchmark_context"] = F.array_join(F.array_compact(F.transform(F.map_entries(benchmark), word)), ". ")
    return df.withColumns(out)


def benchmark_points(benchmark: str = "benchmark") -> Column:
    """30 beyond a stress level, 20 above four fifths of it, 15 when half off a normal level; the largest counts.

    Signs count: four fifths of a negative stress level lie above it, so its 20 points are never reached below 30. A value is never off a
    negative normal level (the distance is divided by the level itself), and every other value is off a level of 0.
    """
    v = F.col(VALUE)

    def points(e: Column) -> Column:
        key, limit = F.lower(e["key"]), e["value"]
        stress = key.contains("stress") | key.contains("extreme")
        off = F.coalesce(F.try_divide(F.abs(v - limit), limit) > 0.5, (limit == 0) & (v != 0))
        return (
            F.when(stress, F.when(v > limit, 30.0).when(v > limit * 0.8, 20.0).otherwise(0.0))
            .when(key.contains("normal"), F.when(off, 15.0).otherwise(0.0))
            .otherwise(0.0)
        )

    scored = F.transform(F.map_entries(F.coalesce(F.col(benchmark), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<double>")))), points)
    return F.coalesce(F.array_max(scored), F.lit(0.0))


def risk_score(df: DataFrame, metadata: DataFrame) -> DataFrame:
    """Score 0 to 100 and colour per row from 12 values on: deviation, benchmark, volatility, momentum, floors.

    ``metadata`` has SeriesID, type, long_name, benchmark map and ``floor_rule``: ``inversion``
    lifts a negative value to 80, ``credit_spread`` lifts a value above the 90th percentile of
    its history to 70.
    """
    known = df.filter(F.col(VALUE).isNotNull()).join(metadata, ID, "left")
    known = with_position(known)
    every = everything_before()
    spread = F.col("floor_rule") == "credit_spread"
    ranks = expanding_rank(known.filter(spread).select(ID, "_pos", VALUE)).select(ID, "_pos", "lt", "le")
    staged = known.withColumns(
        {
            "_n": F.count(F.lit(1)).over(every),
            "_m36": F.avg(VALUE).over(last(36)),
            "_s36": F.stddev_samp(VALUE).over(last(36)),
            "_s12": F.stddev_samp(VALUE).over(last(12)),
            "_sall": F.stddev_samp(VALUE).over(every),
            "_slope6": F.regr_slope(F.col(VALUE), F.col("_pos")).over(last(6)),
        }
    ).join(ranks.withColumn("_pos", F.col("_pos").cast("double")), [ID, "_pos"], "left")
    v = F.col(VALUE)
    # With fewer than 36 rows the 36-row window is the whole history, as wanted.
    z = F.when(F.col("_s36") > 0, F.abs((v - F.col("_m36")) / F.nullif("_s36", F.lit(0.0)))).otherwise(F.lit(0.0))
    ratio = F.when(F.col("_sall") > 0, F.col("_s12") / F.nullif("_sall", F.lit(0.0))).otherwise(F.lit(1.0))
    falling = (F.col("type") == "leading") & (F.col("_slope6") < 0)
    rising = F.lower("long_name").contains("delinquency") & (F.col("_slope6") > 0)
    parts = {
        "deviation_score": F.least(F.lit(40.0), z / 3 * 40),
        "benchmark_score": benchmark_points(),
        "volatility_score": F.least(F.lit(20.0), F.greatest(F.lit(0.0), (ratio - 1) * 20)),
        "momentum_score": F.when(F.coalesce(falling | rising, F.lit(False)), 10.0).otherwise(0.0),
    }
    scored = staged.withColumns(parts)
    base = sum((F.col(p) for p in list(parts)[1:]), F.col("deviation_score"))
    extreme = spread & ((F.col("lt") + F.col("le") + 1) * F.lit(50.0) / F.col("_n") > 90)
    inverted = (F.col("floor_rule") == "inversion") & (v < 0)
    score = F.greatest(
        base, F.when(inverted, F.lit(80.0)).otherwise(F.lit(0.0)), F.when(extreme, F.lit(70.0)).otherwise(F.lit(0.0))
    )
    enough = F.col("_n") >= 12
    out = scored.withColumn("risk_score", F.when(enough, score))
    color = F.when(F.col("risk_score") >= 70, "Red").when(F.col("risk_score") >= 40, "Yellow").when(enough, "Green")
    return out.select(
        ID, DATE, VALUE, *[F.when(enough, F.col(p)).alias(p) for p in parts], "risk_score", color.alias("risk_color")
    )


def select_signals(df: DataFrame, best: str = "best_technical", lookback: int = 5) -> DataFrame:
    """The signal of each row's best indicator (SMA, EMA, Bollinger Bands or RSI)."""
    made = df.withColumns(
        {
            "_sma": crossover_signal("SMA", "SMA", lookback),
            "_ema": crossover_signal("EMA", "EMA", lookback),
            "_bb": band_signal(lookback),
            "_rsi": rsi_signal(lookback),
        }
    )
    kind = F.col(best)
    chosen = (
        F.when(kind == "EMA", F.col("_ema"))
        .when(kind == "Bollinger Bands", F.col("_bb"))
        .when(kind == "RSI", F.col("_rsi"))
        .when(F.coalesce(kind, F.lit("SMA")) == "SMA", F.col("_sma"))
        .otherwise("Not Implemented")
    )
    return made.withColumn("signal", chosen).drop("_sma", "_ema", "_bb", "_rsi")


def indicator_columns() -> Sequence[str]:
    return ["SMA", "EMA", "BB_Upper", "BB_Lower", "BB_Width", "RSI", "ZScore"]
