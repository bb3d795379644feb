"""A subject entity against its peers, and the tables behind the report charts.

Everything works on the latest period (or a few periods) and on an allow-list of metrics. Rows stay
wide: one aggregate per group has the statistics of all metrics, and only its few result rows are
turned to one row per metric. Medians come from the counted ranges of ``quantile``, so no peer group is
ever gathered whole.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from quarterdeck.functions.missing import present
from quarterdeck.operators.flows import ENTITY, PERIOD, trailing_profile
from quarterdeck.operators.quantile import exact_quantile, exact_quantiles, select_ranks, sketch

# Metric of the normalised view for a standard one.
NORMALIZED_METRICS = {
    "TTM_NCO_Rate": "Norm_NCO_Rate",
    "Nonaccrual_to_Gross_Loans_Rate": "Norm_Nonaccrual_Rate",
    "Top_House_Delinquency_Rate": "Norm_Delinquency_Rate",
    "Allowance_to_Gross_Loans_Rate": "Norm_ACL_Coverage",
    "Gross_Loans": "Norm_Gross_Loans",
    "Total_Nonaccrual": "Norm_Total_Nonaccrual",
    "NTLNLS": "Norm_Total_NCO",
    "Loan_Yield_Proxy": "Norm_Loan_Yield",
    "Provision_to_Loans_Rate": "Norm_Provision_Rate",
}
# Allow-lists of the two comparison tables.
SUMMARY_METRICS = [
    "ASSET", "LNLS", "Risk_Adj_Allowance_Coverage", "Allowance_to_Gross_Loans_Rate", "Nonaccrual_to_Gross_Loans_Rate",
    "TTM_NCO_Rate", "SBL_Composition", "RIC_Resi_Loan_Share", "RIC_CRE_Loan_Share", "RIC_CRE_ACL_Share",
    "RIC_CRE_ACL_Coverage", "RIC_CRE_Risk_Adj_Coverage", "RIC_CRE_Nonaccrual_Rate", "RIC_CRE_NCO_Rate",
    "ROA", "ROE", "NIMY", "EEFFR", "Loan_Yield_Proxy", "Provision_to_Loans_Rate", "Liquidity_Ratio", "HQLA_Ratio",
    "Loans_to_Deposits",
]
NORMALIZED_TABLE = [
    "Norm_Gross_Loans", "Norm_ACL_Coverage", "Norm_Risk_Adj_Allowance_Coverage", "Norm_Nonaccrual_Rate", "Norm_NCO_Rate",
    "Norm_Delinquency_Rate", "Norm_SBL_Composition", "Norm_Fund_Finance_Composition", "Norm_Wealth_Resi_Composition",
    "Norm_CRE_Investment_Composition", "Norm_Exclusion_Pct",
]
# Metrics without a good or bad side, and words that mark metrics better low.
DESCRIPTIVE = [
    "ASSET", "LNLS", "Gross_Loans", "Norm_Gross_Loans", "SBL_Composition", "RIC_Resi_Loan_Share", "RIC_CRE_Loan_Share",
    "Norm_SBL_Composition", "Norm_Fund_Finance_Composition", "Norm_Wealth_Resi_Composition",
    "Norm_CRE_Investment_Composition", "Norm_Exclusion_Pct",
]
LOWER_IS_BETTER = ["nco", "npl", "past_due", "nonaccrual", "cost_of_funds", "pd30", "pd90", "delinq"]


def latest(df: DataFrame, period: str = PERIOD) -> DataFrame:
    """Rows of the last period; the maximum is a scalar subquery, not a join."""
    return df.filter(F.col(period) == df.agg(F.max(period)).scalar())


def latest_per_entity(df: DataFrame, entity: str = ENTITY, period: str = PERIOD) -> DataFrame:
    """Each entity's own last row."""
    newest = df.groupBy(entity).agg(F.max(period).alias(period))
    return df.join(newest, [entity, period], "left_semi")


def arg_max(df: DataFrame, value: str, keys: Sequence[str] = (), then: Sequence[str] = ()) -> DataFrame:
    """The whole row of the largest ``value``, per key or of all; ``then`` decides ties by the larger. An aggregate, so no key is hot."""
    known = df.filter(F.col(value).isNotNull())
    best = F.max_by(F.struct(*df.columns), F.struct(value, *then)).alias("r")
    return known.groupBy(*keys).agg(best).select("r.*").filter(F.col(value).isNotNull())


def members_only(df: DataFrame, bridge: DataFrame, group: str, entity: str = ENTITY) -> DataFrame:
    """Rows of one group's members."""
    return df.join(bridge.filter(F.col("group_key") == group).select(entity), entity, "left_semi")


def real_peers(df: DataFrame, synthetic: DataFrame, subject: int, entity: str = ENTITY) -> DataFrame:
    """Rows that are neither composites nor the subject."""
    return df.join(synthetic.select(entity).distinct(), entity, "left_anti").filter(F.col(entity) != subject)


def since(df: DataFrame, start: str, period: str = PERIOD) -> DataFrame:
    return df.filter(F.col(period) >= F.to_date(F.lit(start)))


def snapshot_columns(columns: Sequence[str]) -> list[str]:
    """Columns of the latest snapshot by name rule: segment columns without flows, and growth."""
    keep = []
    for c in columns:
        if c.startswith("RIC_") and "_YTD" not in c and "_Q" not in c:
            keep.append(c)
        elif "_Growth_TTM" in c:
            keep.append(c)
    return keep


def snapshot(df: DataFrame, extra: Sequence[str] = (), entity: str = ENTITY, period: str = PERIOD) -> DataFrame:
    """Latest rows with the snapshot columns."""
    names = dict.fromkeys([entity, period, *present(df.columns, extra), *snapshot_columns(df.columns)])
    return latest(df, period).select(*names)


def melt(df: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Allow-listed metrics as (keys, metric, value) without NULL values."""
    metrics = present(df.columns, metrics)
    wide = df.select(*keys, *[F.col(m).cast("double").alias(m) for m in metrics])
    return wide.unpivot(list(keys), metrics, "metric", "value").filter(F.col("value").isNotNull())


def percentile_rank(value: str, score: str) -> Column:
    """Percentile of ``score`` among ``value`` as an aggregate: mean of strict and weak rank, ties counted half."""
    return F.expr(
        f"(count_if({value} < {score}) + count_if({value} <= {score}) + if(count_if({value} = {score}) > 0, 1, 0)) * 50D / count({value})"
    )


def performance_flag(metric: str = "metric", pct: str = "pct") -> Column:
    """Wording of a percentile; risk metrics are better low, descriptive ones get none."""
    m, p = F.lower(metric), F.col(pct)
    risk = F.lit(False)
    for term in LOWER_IS_BETTER:
        risk = risk | m.contains(term)
    low = F.when(p <= 25, "Top Quartile (Low Risk)").when(p <= 50, "Better than Median")
    high = F.when(p >= 75, "Top Quartile (Strong)").when(p >= 50, "Better than Median")
    return (
        F.when(p.isNull(), "N/A")
        .when(F.col(metric).isin(DESCRIPTIVE), "")
        .when(risk, low.otherwise("Bottom Quartile (High Risk)"))
        .otherwise(high.otherwise("Bottom Quartile (Weak)"))
    )


def _wide_members(df: DataFrame, bridge: DataFrame, metrics: Sequence[str], substitute: Mapping[str, str], keys: Sequence[str], entity: str) -> DataFrame:
    """A row per group and member, with metric ``k`` as ``_x{k}``; groups on normalised values read the substitute's column."""
    have, normal = set(df.columns), F.col("use_normalized")
    number = lambda c: F.col(c).cast("double") if c in have else F.lit(None).cast("double")
    used = list(dict.fromkeys(c for m in metrics for c in (m, substitute.get(m, m)) if c in have))
    rows = df.select(entity, *used).join(bridge.select(*keys, entity), entity)
    values = [F.when(normal, number(substitute[m])).otherwise(number(m)) if m in substitute else number(m) for m in metrics]
    return rows.select(*keys, entity, *[v.alias(f"_x{k}") for k, v in enumerate(values)])


def _by_metric(rows: DataFrame, keys: Sequence[str], metrics: Sequence[str], stats: Sequence[str]) -> DataFrame:
    """One row per group and metric with any value: ``metric``, ``median``, ``n`` and the fields of the metric's struct in ``stats``.

    All metrics' statistics and the medians' brackets are one aggregate; ``rows`` is read three times in all.
    """
    names = [f"_x{k}" for k in range(len(metrics))]
    found = select_ranks(rows, rows.groupBy(*keys).agg(sketch(names, extra=stats)), keys, names)
    metric = F.array(*[F.lit(m) for m in metrics])[F.col("_i")]
    return found.select(*keys, metric.alias("metric"), F.col("value").alias("median"), "n", "extra.*")


def peer_comparison(
    df: DataFrame,
    bridge: DataFrame,
    subject: int,
    metrics: Sequence[str] = SUMMARY_METRICS,
    substitute: Mapping[str, str] = NORMALIZED_METRICS,
    entity: str = ENTITY,
    period: str = PERIOD,
) -> DataFrame:
    """Subject against every group at the latest period: count, mean, median, min, max, percentile, flag.

    One row per (metric, group) with any value. Counts, sums, bounds, rank counts and the medians' brackets of all metrics
    are one aggregate per group over wide rows. The subject is one row, read as a scalar.
    """
    metrics = present(df.columns, metrics)
    keys = ["group_key", "use_normalized"]
    now = latest(df, period)
    rows = _wide_members(now, bridge, metrics, substitute, keys, entity)
    both = F.array(F.lit(False), F.lit(True))
    own = _wide_members(now.filter(F.col(entity) == subject), now.sparkSession.range(1).select(F.explode(both).alias("use_normalized"), F.lit(subject).alias(entity)), metrics, substitute, ["use_normalized"], entity)
    values = F.array(*[f"_x{k}" for k in range(len(metrics))])
    own = own.agg(F.struct(*[F.first(F.when(F.col("use_normalized") == n, values), ignorenulls=True).alias(c) for c, n in (("std", False), ("norm", True))])).scalar()
    rows = rows.withColumn("_own", F.when(F.col("use_normalized"), own["norm"]).otherwise(own["std"]))
    parts = [
        f"named_struct('mean', avg(_x{k}), 'min', min(_x{k}), 'max', max(_x{k}), 'subject_value', first(_own[{k}]),"
        f" 'lt', count_if(_x{k} < _own[{k}]), 'le', count_if(_x{k} <= _own[{k}]))"
        for k in range(len(metrics))
    ]
    long = _by_metric(rows, keys, metrics, parts)
    ranks = F.col("lt") + F.col("le") + F.when(F.col("le") > F.col("lt"), 1).otherwise(0)
    long = long.withColumn("pct", F.when(F.col("subject_value").isNotNull(), ranks * F.lit(50.0) / F.col("n")))
    return long.withColumn("performance_flag", performance_flag()).select(
        "metric", *keys, "subject_value", F.col("n").alias("peer_count"), "mean", "median", "min", "max", "pct", "performance_flag"
    )


def normalized_comparison(df: DataFrame, bridge: DataFrame, subject: int, metrics=NORMALIZED_TABLE) -> DataFrame:
    """The comparison restricted to normalised groups and metrics."""
    return peer_comparison(df, bridge.filter("use_normalized"), subject, metrics, substitute={})


def comparison_wide(comparison: DataFrame, groups: Sequence[str]) -> DataFrame:
    """One row per metric, with mean, median and percentile of each named group side by side."""
    return (
        comparison.groupBy("metric")
        .pivot("group_key", list(groups))
        .agg(F.first("median").alias("median"), F.first("mean").alias("mean"), F.first("pct").alias("pct"))
    )


def peer_range(
    df: DataFrame, bridge: DataFrame, metrics: Sequence[str], entity: str = ENTITY, period: str = PERIOD
) -> DataFrame:
    """Range of each metric per group with the holders of the extremes (smallest id wins a tie)."""
    metrics = present(df.columns, metrics)
    rows = _wide_members(latest(df, period), bridge, metrics, {}, ["group_key"], entity)
    holder = "min(if(_x{k} is null, null, named_struct('v', {sign}_x{k}, 'e', `{entity}`))).e"
    parts = [
        f"named_struct('lo', min(_x{k}), 'hi', max(_x{k}), 'mean', avg(_x{k}),"
        f" 'lo_holder', {holder.format(k=k, sign='', entity=entity)}, 'hi_holder', {holder.format(k=k, sign='-', entity=entity)})"
        for k in range(len(metrics))
    ]
    found = _by_metric(rows, ["group_key"], metrics, parts).withColumnRenamed("n", "members")
    return found.select("metric", "group_key", "lo", "hi", "mean", "members", "lo_holder", "hi_holder", "median")


def kri_ranges(
    df: DataFrame,
    bridge: DataFrame,
    fallback: DataFrame,
    subject: int,
    outer: str,
    inner: str,
    metrics: Sequence[str],
    entity: str = ENTITY,
    period: str = PERIOD,
) -> DataFrame:
    """Subject value inside an outer and an inner peer band; a group without members shows its composite.

    ``fallback`` holds composite rows (group_key, period, metrics). Metrics without subject
    value or without any band are left out.
    """
    now = df.agg(F.max(period)).scalar()
    bands = peer_range(df, bridge.filter(F.col("group_key").isin(outer, inner)), metrics, entity, period)
    single = melt(fallback.filter(F.col(period) == now), ["group_key"], metrics).select(
        "metric", "group_key", F.col("value").alias("_f")
    )
    every = bands.join(single, ["metric", "group_key"], "full").withColumn(
        "fallback", F.col("lo").isNull()
    )
    pick = lambda c: F.coalesce(F.col(c), F.col("_f"))
    wide = every.groupBy("metric").agg(
        *[
            F.max(F.when(F.col("group_key") == g, pick(c))).alias(f"{label}_{c}")
            for label, g in (("outer", outer), ("inner", inner))
            for c in ("lo", "hi", "median")
        ]
    )
    own = melt(df.filter((F.col(entity) == subject) & (F.col(period) == now)), [entity], metrics)
    return own.join(wide, "metric").select("metric", F.col("value").alias("subject_value"), *wide.columns[1:])


# Direction in which a metric is good.
POLARITY = {
    "TTM_NCO_Rate": "adverse",
    "Nonaccrual_to_Gross_Loans_Rate": "adverse",
    "NPL_to_Gross_Loans_Rate": "adverse",
    "Past_Due_Rate": "adverse",
    "Norm_NCO_Rate": "adverse",
    "Norm_Nonaccrual_Rate": "adverse",
    "Norm_Delinquency_Rate": "adverse",
    "Allowance_to_Gross_Loans_Rate": "favorable",
    "Risk_Adj_Allowance_Coverage": "favorable",
    "Norm_ACL_Coverage": "favorable",
    "Norm_Risk_Adj_Allowance_Coverage": "favorable",
    "RIC_CRE_ACL_Coverage": "favorable",
    "Liquidity_Ratio": "favorable",
}
# The heat map's group of each metric, and the groups' order.
METRIC_GROUPS = {
    "TTM_NCO_Rate": "Credit Quality",
    "Nonaccrual_to_Gross_Loans_Rate": "Credit Quality",
    "NPL_to_Gross_Loans_Rate": "Credit Quality",
    "Past_Due_Rate": "Credit Quality",
    "Norm_NCO_Rate": "Credit Quality (Norm)",
    "Norm_Nonaccrual_Rate": "Credit Quality (Norm)",
    "Norm_Delinquency_Rate": "Credit Quality (Norm)",
    "Allowance_to_Gross_Loans_Rate": "Coverage",
    "Risk_Adj_Allowance_Coverage": "Coverage",
    "Norm_ACL_Coverage": "Coverage (Norm)",
    "Norm_Risk_Adj_Allowance_Coverage": "Coverage (Norm)",
    "SBL_Composition": "Composition",
}
GROUP_ORDER = ["Credit Quality", "Credit Quality (Norm)", "Coverage", "Coverage (Norm)", "Composition", "Other"]


def literal_lookup(name: str, values: Mapping[str, str], default: str) -> Column:
    """A short code table as a map literal."""
    pairs = [F.lit(x) for kv in values.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(name)), F.lit(default))


def direction(metric: str, delta: str) -> Column:
    """favorable / adverse / flat / neutral of a change, N/A when unknown."""
    d, pol = F.col(delta), literal_lookup(metric, POLARITY, "neutral")
    good = F.when(d > 0, pol == "favorable").otherwise(pol == "adverse")
    return (
        F.when(d.isNull(), "N/A")
        .when(F.abs(d) < 1e-8, "flat")
        .when(pol == "neutral", "neutral")
        .when(good, "favorable")
        .otherwise("adverse")
    )


def nearest_period(df: DataFrame, years_back: int = 1, period: str = PERIOD) -> Column:
    """Scalar: the period closest to ``years_back`` before the last one, the earlier one on a tie."""
    dates = df.select(period).distinct()
    target = F.add_months(dates.agg(F.max(period)).scalar(), -12 * years_back)
    gap = F.abs(F.datediff(F.col(period), target))
    return dates.agg(F.min(F.struct(gap.alias("gap"), F.col(period)))[period]).scalar()


def yoy_heatmap(
    df: DataFrame, subject: int, peer: int, metrics: Sequence[str], entity: str = ENTITY, period: str = PERIOD
) -> DataFrame:
    """Current and year-ago value, change and direction of subject and peer, and subject versus peer.

    Shares change by ratio, everything else by difference.
    """
    now = df.agg(F.max(period)).scalar()
    prior = nearest_period(df, 1, period)
    rows = df.filter(F.col(entity).isin(subject, peer) & ((F.col(period) == now) | (F.col(period) == prior)))
    rows = rows.withColumn("_is_now", F.col(period) == now).withColumn("_is_prior", F.col(period) == prior)
    metrics = present(df.columns, metrics)
    long = rows.select(
        entity, "_is_now", "_is_prior", *[F.col(m).cast("double").alias(m) for m in metrics]
    ).unpivot([entity, "_is_now", "_is_prior"], metrics, "metric", "value")

    def cell(who: int, flag: str) -> Column:
        return F.max(F.when((F.col(entity) == who) & F.col(flag), F.col("value")))

    wide = long.groupBy("metric").agg(
        cell(subject, "_is_now").alias("subj_current"),
        cell(subject, "_is_prior").alias("subj_prior"),
        cell(peer, "_is_now").alias("peer_current"),
        cell(peer, "_is_prior").alias("peer_prior"),
    )
    share = F.col("metric").rlike("Composition|Loan_Share|ACL_Share")

    def change(who: str) -> Column:
        cur, pri = F.col(f"{who}_current"), F.col(f"{who}_prior")
        return F.when(share, F.when(F.abs(pri) > 1e-12, F.try_divide(cur, pri) - 1)).otherwise(cur - pri)

    out = wide.withColumns(
        {
            "subj_yoy": change("subj"),
            "peer_yoy": change("peer"),
            "vs_peer_delta": F.col("subj_current") - F.col("peer_current"),
            "polarity": literal_lookup("metric", POLARITY, "neutral"),
            "metric_group": literal_lookup("metric", METRIC_GROUPS, "Other"),
        }
    )
    return out.withColumns(
        {
            "subj_direction": direction("metric", "subj_yoy"),
            "peer_direction": direction("metric", "peer_yoy"),
            "vs_peer_direction": direction("metric", "vs_peer_delta"),
        }
    )


def order_metrics(df: DataFrame, metric: str = "metric") -> DataFrame:
    """Add the display position of a metric: group order, then name."""
    group = literal_lookup(metric, METRIC_GROUPS, "Other")
    return df.withColumn("group_order", F.array_position(F.array(*[F.lit(g) for g in GROUP_ORDER]), group)).orderBy(
        "group_order", metric
    )


def trailing_points(
    df: DataFrame, subject: int, metrics: Sequence[str], rows: int = 8, entity: str = ENTITY, period: str = PERIOD
) -> DataFrame:
    """The last ``rows`` values of each metric as an ordered array, first and last known value and trend word."""
    recent = df.select(period).distinct().orderBy(F.col(period).desc()).limit(rows)
    metrics = present(df.columns, metrics)
    own = df.filter(F.col(entity) == subject).join(recent, period, "left_semi")
    long = own.select(period, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        [period], metrics, "metric", "value"
    )
    known = F.when(F.col("value").isNotNull(), F.col(period))
    out = long.groupBy("metric").agg(
        F.transform(F.array_sort(F.collect_list(F.struct(period, "value"))), lambda s: s["value"]).alias("points"),
        F.min_by("value", known).alias("first_value"),
        F.max_by("value", known).alias("last_value"),
    )
    move = F.col("last_value") - F.col("first_value")
    pol = literal_lookup("metric", POLARITY, "neutral")
    up = F.when(pol == "adverse", "bad").otherwise("good")
    down = F.when(pol == "adverse", "good").otherwise("bad")
    trend = F.when(move.isNull() | (pol == "neutral"), "neutral").when(move > 0, up).otherwise(down)
    return out.withColumn("trend", trend)


def cumulative_growth(
    df: DataFrame,
    loans: Sequence[str],
    allowance: str,
    start: str,
    entity: str = ENTITY,
    period: str = PERIOD,
) -> DataFrame:
    """Growth and CAGR of loans and allowance since an anchor row per entity.

    The anchor is the row nearest ``start`` (earlier on a tie); when either measure is 0
    there it moves to the first later row with both above 0, and entities without one drop out.
    """
    total = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in loans[1:]), F.coalesce(F.col(loans[0]), F.lit(0.0)))
    base = df.select(entity, period, total.alias("_l"), F.coalesce(F.col(allowance), F.lit(0.0)).alias("_a"))
    gap = F.abs(F.datediff(F.col(period), F.to_date(F.lit(start))))
    by = W.partitionBy(entity)
    near = F.min(F.struct(gap.alias("gap"), F.col(period).alias("p"), F.col("_l").alias("l"), F.col("_a").alias("a"))).over(by)
    staged = base.withColumn("_n", near)
    usable = (F.col("_n.l") != 0) & (F.col("_n.a") != 0)
    later = (F.col(period) > F.col("_n.p")) & (F.col("_l") > 0) & (F.col("_a") > 0)
    own = F.col(period) == F.col("_n.p")
    candidate = F.when(usable, F.when(own, F.struct(F.col(period).alias("p"), F.col("_l").alias("l"), F.col("_a").alias("a")))).otherwise(
        F.when(later, F.struct(F.col(period).alias("p"), F.col("_l").alias("l"), F.col("_a").alias("a")))
    )
    anchored = staged.withColumn("_c", F.min(candidate).over(by)).filter(F.col(period) >= F.col("_c.p"))
    years = F.datediff(F.col(period), F.col("_c.p")) / F.lit(365.25)

    def cagr(now: str, then: str) -> Column:
        return F.when(years > 0, F.pow(F.try_divide(F.col(now), F.col(then)), 1 / years) - 1).otherwise(F.lit(0.0))

    return anchored.select(
        entity,
        period,
        F.try_divide(F.col("_l") - F.col("_c.l"), F.col("_c.l")).alias("target_loans_growth"),
        F.try_divide(F.col("_a") - F.col("_c.a"), F.col("_c.a")).alias("target_acl_growth"),
        cagr("_l", "_c.l").alias("target_loans_cagr"),
        cagr("_a", "_c.a").alias("target_acl_cagr"),
    )


def to_decimal_scale(long: DataFrame, metric: str = "metric", value: str = "value", limit: float = 0.01, use_max: bool = False) -> DataFrame:
    """Divide a metric by 100 when it looks like percent: median (or maximum) of the absolute value at or over ``limit``."""
    size = long.select(metric, F.abs(F.col(value)).alias("_s"))
    if use_max:
        probe = size.groupBy(metric).agg(F.max("_s").alias("_p"))
        percent = F.col("_p") > limit
    else:
        probe = exact_quantile(size, [metric], "_s", out="_p").select(metric, "_p")
        percent = F.col("_p") >= limit
    return (
        long.join(probe, metric, "left")
        .withColumn(value, F.when(percent, F.col(value) / 100).otherwise(F.col(value)))
        .drop("_p")
    )


def apply_metadata_scale(long: DataFrame, dimension: DataFrame, metric: str = "metric", value: str = "value") -> DataFrame:
    """Multiply by the Scale of the metric dimension, 1 when unknown."""
    return long.join(dimension.select(metric, "Scale"), metric, "left").withColumn(
        value, F.col(value) * F.coalesce("Scale", F.lit(1.0))
    ).drop("Scale")


def outliers(
    df: DataFrame,
    x: str,
    y: str,
    top: int,
    exclude: Sequence[int] = (),
    entity: str = ENTITY,
) -> DataFrame:
    """The ``top`` entities farthest from the mean point of (x, y); excluded ones count for the mean only."""
    centre = df.agg(F.struct(F.avg(x).alias("x"), F.avg(y).alias("y"))).scalar()
    distance = F.sqrt(F.pow(F.col(x) - centre["x"], 2.0) + F.pow(F.col(y) - centre["y"], 2.0))
    ranked = df.select(entity, x, y, distance.alias("distance")).filter(
        F.col("distance").isNotNull() & ~F.col(entity).isin(list(exclude))
    )
    return ranked.orderBy(F.col("distance").desc(), entity).limit(top)


def quadrants(df: DataFrame, x: str, y: str, labels: Sequence[str] = ("high_high", "high_low", "low_high", "low_low")) -> DataFrame:
    """Label each row by its side of the two medians (on the median counts as high)."""
    middles = exact_quantiles(df, [], [x, y])
    pair = middles.agg(
        F.struct(*[F.max(F.when(F.col("metric") == c, F.col("median"))).alias(n) for c, n in ((x, "x"), (y, "y"))])
    ).scalar()
    mx, my = pair["x"], pair["y"]
    known = F.col(x).isNotNull() & F.col(y).isNotNull()
    label = (
        F.when((F.col(x) >= mx) & (F.col(y) >= my), labels[0])
        .when(F.col(x) >= mx, labels[1])
        .when(F.col(y) >= my, labels[2])
        .otherwise(labels[3])
    )
    return df.withColumns({"median_x": mx, "median_y": my}).withColumn("quadrant", F.when(known, label))


def bubble_sizes(df: DataFrame, value: str, out: str = "bubble_size") -> DataFrame:
    """50 to 450 by |value| relative to the largest; 100 for all when everything is 0."""
    size = F.abs(F.coalesce(F.col(value), F.lit(0.0)))
    biggest = df.agg(F.max(size)).scalar()
    return df.withColumn(out, F.when(biggest > 0, F.lit(50.0) + size / biggest * 400).otherwise(F.lit(100.0)))


def aligned_timeline(subject_rows: DataFrame, other: DataFrame, columns: Mapping[str, str], period: str = PERIOD) -> DataFrame:
    """The subject's periods with another entity's metrics beside them."""
    extra = other.select(period, *[F.col(c).alias(out) for c, out in columns.items()])
    return subject_rows.join(extra, period, "left")


def mix_dataset(df: DataFrame, columns: Sequence[str], entity: str = ENTITY, period: str = PERIOD) -> DataFrame:
    """Selected columns over time in long form, NULL as 0, with the Qn-yy label of the axis."""
    columns = present(df.columns, columns)
    zeros = df.select(entity, period, *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in columns])
    label = F.concat(F.lit("Q"), F.quarter(period), F.lit("-"), F.date_format(period, "yy"))
    return zeros.unpivot([entity, period], columns, "metric", "value").withColumn("period_label", label)


def peer_table(
    df: DataFrame, entities: Mapping[int, str], metrics: Sequence[str], subject: str, versus: str, entity: str = ENTITY, period: str = PERIOD
) -> DataFrame:
    """Metric by named entity at the latest period, with the subject's difference to one of them."""
    rows = melt(latest(df, period).filter(F.col(entity).isin(list(entities))), [entity], metrics)
    wide = rows.groupBy("metric").agg(
        *[F.max(F.when(F.col(entity) == key, F.col("value"))).alias(name) for key, name in entities.items()]
    )
    return wide.withColumn(f"{subject}_vs_{versus}", F.col(subject) - F.col(versus))


# Row label, numerator and denominator of the components table.
RATIO_COMPONENTS = {
    "Nonaccrual_to_Gross_Loans_Rate": ("Total_Nonaccrual", "Gross_Loans"),
    "Top_House_Delinquency_Rate": ("coalesce(TopHouse_PD30, 0D) + coalesce(TopHouse_PD90, 0D)", "Gross_Loans"),
    "Allowance_to_Gross_Loans_Rate": ("Total_ACL", "Gross_Loans"),
    "Risk_Adj_Allowance_Coverage": ("Total_ACL", "Gross_Loans - coalesce(SBL_Balance, 0D)"),
    "RIC_CRE_Delinquency_Rate": ("coalesce(RIC_CRE_PD30, 0D) + coalesce(RIC_CRE_PD90, 0D)", "RIC_CRE_Cost"),
    "RIC_Resi_Delinquency_Rate": ("coalesce(RIC_Resi_PD30, 0D) + coalesce(RIC_Resi_PD90, 0D)", "RIC_Resi_Cost"),
}


def ratio_components(
    df: DataFrame, entities: Mapping[int, str], components: Mapping[str, tuple[str, str]] = RATIO_COMPONENTS, entity: str = ENTITY, period: str = PERIOD
) -> DataFrame:
    """Numerator, denominator and ratio of each metric for the named entities at the latest period."""
    rows = latest(df, period).filter(F.col(entity).isin(list(entities)))
    parts = F.array(
        *[
            F.struct(F.lit(code).alias("metric"), F.expr(n).alias("numerator"), F.expr(d).alias("denominator"), F.col(code).alias("ratio"))
            for code, (n, d) in components.items()
        ]
    )
    names = F.create_map(*[F.lit(x) for kv in entities.items() for x in kv])
    return rows.select(
        names[F.col(entity).cast("int")].alias("entity_label"), F.explode(parts).alias("p")
    ).select("entity_label", "p.*")


def latest_and_average(df: DataFrame, metrics: Sequence[str], rows: int = 8, entity: str = ENTITY, period: str = PERIOD) -> DataFrame:
    """Latest value beside the trailing average of each metric, per entity of the latest period."""
    now = melt(latest(df, period), [entity], metrics).withColumnRenamed("value", "latest_value")
    profile = melt(trailing_profile(df, metrics, rows=rows, entity=entity, period=period), [entity], metrics)
    return now.join(profile.withColumnRenamed("value", "trailing_average"), [entity, "metric"], "left")
