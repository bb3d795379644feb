"""Subject-versus-peers queries and report datasets."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterdeck.catalog.composites import ID_BASE
from quarterdeck.catalog.normalization import derived, derived_table
from quarterdeck.catalog.panel import E
from quarterdeck.catalog.sql import register, with_ctes
from quarterdeck.operators import compare, composite
from quarterdeck.plans.shapes import bank_panel, daily_series, peer_groups
from quarterdeck.session import scratch_path
from quarterdeck.sources import sinks

SUBJECT = 1
PEER = 2
METRICS = list(compare.SUMMARY_METRICS)
NORM = [m for m in compare.NORMALIZED_TABLE]
SWAPS = ["Norm_NCO_Rate", "Norm_Nonaccrual_Rate", "Norm_Delinquency_Rate", "Norm_ACL_Coverage", "Norm_Loan_Yield", "Norm_Provision_Rate"]
RANGE = ["TTM_NCO_Rate", "Allowance_to_Gross_Loans_Rate", "RIC_CRE_ACL_Share"]
HEAT = ["TTM_NCO_Rate", "Nonaccrual_to_Gross_Loans_Rate", "Allowance_to_Gross_Loans_Rate", "Risk_Adj_Allowance_Coverage", "Norm_NCO_Rate", "SBL_Composition", "Loans_to_Deposits"]


def rounded(df, *names, digits=9):
    return df.withColumns({n: F.round(n, digits) for n in names})


def peer_comparison(spark, sf):
    df = compare.peer_comparison(derived_table(spark, sf, METRICS + SWAPS), peer_groups(spark, sf), SUBJECT)
    return rounded(df, "mean", "median")


def normalized_comparison(spark, sf):
    df = compare.normalized_comparison(derived_table(spark, sf, NORM), peer_groups(spark, sf), SUBJECT)
    return rounded(df, "mean", "median")


def comparison_wide(spark, sf):
    df = compare.peer_comparison(
        derived_table(spark, sf, ["TTM_NCO_Rate", "LNLS", "Norm_NCO_Rate"]), peer_groups(spark, sf), SUBJECT, ["TTM_NCO_Rate", "LNLS"]
    )
    wide = compare.comparison_wide(df, ["ALL", "ASIA"])
    return rounded(wide, *[c for c in wide.columns if c != "metric"])


def peer_range(spark, sf):
    df = compare.peer_range(derived_table(spark, sf, RANGE), peer_groups(spark, sf), RANGE)
    return rounded(df, "mean", "median")


def kri_ranges(spark, sf):
    panel = derived_table(spark, sf, ["TTM_NCO_Rate", "Allowance_to_Gross_Loans_Rate", "SBL_Composition"])
    bridge = peer_groups(spark, sf)
    # The inner group has a composite but no member rows in the bridge, so its composite stands in.
    single = composite.composites(panel, bridge.filter("group_key = 'ASIA'"), panel.columns[2:], id_base=ID_BASE)
    df = compare.kri_ranges(panel, bridge.filter("group_key = 'ALL'"), single, SUBJECT, "ALL", "ASIA", panel.columns[2:])
    return rounded(df, *[c for c in df.columns if c != "metric"])


def yoy_heatmap(spark, sf):
    return compare.yoy_heatmap(derived_table(spark, sf, HEAT), SUBJECT, PEER, HEAT)


def metric_order(spark, sf):
    df = compare.melt(compare.latest(derived_table(spark, sf, HEAT)), ["CERT"], HEAT).groupBy("metric").count()
    return compare.order_metrics(df)


def sparkline_points(spark, sf):
    df = compare.trailing_points(derived_table(spark, sf, ["TTM_NCO_Rate", "Allowance_to_Gross_Loans_Rate", "LNLS"]), SUBJECT, ["TTM_NCO_Rate", "Allowance_to_Gross_Loans_Rate", "LNLS"])
    return df.withColumn("points", F.concat_ws(",", F.transform("points", lambda x: F.coalesce(F.format_string("%.6f", x), F.lit("-")))))


def cumulative_growth(spark, sf):
    df = compare.cumulative_growth(derived(spark, sf), ["CRE_Investment_Pure_Balance", "Wealth_Resi_Balance"], "RIC_CRE_ACL", "1996-02-10")
    return rounded(df, "target_loans_cagr", "target_acl_cagr", digits=8)


def outlier_entities(spark, sf):
    df = compare.outliers(compare.latest(derived_table(spark, sf, ["Allowance_to_Gross_Loans_Rate", "Nonaccrual_to_Gross_Loans_Rate"])), "Allowance_to_Gross_Loans_Rate", "Nonaccrual_to_Gross_Loans_Rate", 5, exclude=[SUBJECT])
    return rounded(df, "distance")


def quadrant_labels(spark, sf):
    panel = derived_table(spark, sf, ["Total_Loans_Growth_TTM", "Allowance_to_Gross_Loans_Rate"])
    now = compare.latest(panel).drop("REPDTE")
    return compare.quadrants(now, "Total_Loans_Growth_TTM", "Allowance_to_Gross_Loans_Rate")


def bubble_sizes(spark, sf):
    now = compare.latest(bank_panel(spark, sf, ["NACI", "LNCI"]))
    return compare.bubble_sizes(now, "NACI")


def latest_snapshot(spark, sf):
    df = compare.snapshot(derived(spark, sf), ["LNLS"])
    keep = ["CERT", "REPDTE", "LNLS", "RIC_CRE_Cost", "RIC_CRE_ACL_Share", "Total_Loans_Growth_TTM", "RIC_Resi_NCO_TTM"]
    return df.select(*keep, F.lit(len([c for c in df.columns if "_NCO_Q" in c])).alias("flow_columns"))


def latest_and_average(spark, sf):
    return rounded(compare.latest_and_average(derived_table(spark, sf, HEAT[:3]), HEAT[:3]), "trailing_average")


def unit_scaling(spark, sf):
    cols = ["Top_House_Delinquency_Rate", "Allowance_to_Gross_Loans_Rate", "Loans_to_Deposits"]
    rows = compare.melt(derived_table(spark, sf, cols), ["CERT", "REPDTE"], cols)
    return compare.to_decimal_scale(rows)


def unit_scaling_by_max(spark, sf):
    cols = ["Top_House_Delinquency_Rate", "Nonaccrual_to_Gross_Loans_Rate"]
    rows = compare.melt(derived_table(spark, sf, cols), ["CERT", "REPDTE"], cols)
    return compare.to_decimal_scale(rows, limit=0.05, use_max=True)


def metadata_scaling(spark, sf):
    rows = compare.melt(bank_panel(spark, sf, ["LNLS", "LNCI", "DEP"]), ["CERT", "REPDTE"], ["LNLS", "LNCI", "DEP"])
    dimension = rows.select("metric").distinct().withColumn("Scale", F.when(F.col("metric") == "LNLS", 0.5).when(F.col("metric") == "LNCI", 2.0)).filter("Scale is not null")
    return compare.apply_metadata_scale(rows, dimension)


def subject_vs_real_peers(spark, sf):
    panel = bank_panel(spark, sf, ["LNLS"])
    extra = composite.composites(panel, peer_groups(spark, sf), ["LNLS"], id_base=ID_BASE)
    both = composite.with_composites(panel, extra.select("CERT", "REPDTE", "LNLS"))
    peers = compare.real_peers(compare.latest(both), extra.select("CERT"), SUBJECT)
    return compare.members_only(peers, peer_groups(spark, sf), "EUROPE").select("CERT", "REPDTE", "LNLS")


def aligned_timeline(spark, sf):
    panel = bank_panel(spark, sf, ["LNLS", "LNCI"])
    mine = compare.since(panel.filter(F.col("CERT") == SUBJECT), "1997-06-30").select("CERT", "REPDTE", "LNLS")
    return compare.aligned_timeline(mine, panel.filter(F.col("CERT") == PEER), {"LNCI": "peer_LNCI"})


def portfolio_mix(spark, sf):
    return compare.mix_dataset(derived(spark, sf), ["RIC_CRE_Cost", "RIC_Resi_Cost", "RIC_Comm_Years_of_Reserves", "Liquidity_Ratio"])


def peer_table(spark, sf):
    return compare.peer_table(derived_table(spark, sf, HEAT), {1: "subject", 2: "peer_a", 3: "peer_b"}, HEAT, "subject", "peer_a")


def ratio_components(spark, sf):
    return compare.ratio_components(derived(spark, sf), {1: "subject", 2: "peer"})


def latest_per_entity(spark, sf):
    """Each supplier's last day; the days differ."""
    return compare.latest_per_entity(daily_series(spark, sf), "SeriesID", "DATE").select("SeriesID", "DATE", "VALUE")


def latest_partition(spark, sf):
    """The last quarter of a panel that is laid out by quarter: one folder is read."""
    path = sinks.write_tables({"panel": bank_panel(spark, sf, ["LNLS", "LNCI"])}, scratch_path(spark, "tables"))["panel"]
    return sinks.latest_partition(spark, path).select("CERT", "REPDTE", "LNLS", "LNCI")


def arg_max_row(spark, sf):
    """The whole row of the largest loans of each entity, and of all."""
    df = bank_panel(spark, sf, ["LNLS", "LNCI"])
    every = compare.arg_max(df, "LNLS", ["CERT"], ["REPDTE", "CERT"]).withColumn("scope", F.lit("entity"))
    return every.unionByName(compare.arg_max(df, "LNLS", [], ["REPDTE", "CERT"]).withColumn("scope", F.lit("all")))


QUERIES = {
    "peer_comparison": peer_comparison,
    "normalized_comparison": normalized_comparison,
    "comparison_wide": comparison_wide,
    "peer_range": peer_range,
    "kri_ranges": kri_ranges,
    "yoy_heatmap": yoy_heatmap,
    "metric_order": metric_order,
    "sparkline_points": sparkline_points,
    "cumulative_growth": cumulative_growth,
    "outlier_entities": outlier_entities,
    "quadrant_labels": quadrant_labels,
    "bubble_sizes": bubble_sizes,
    "latest_snapshot": latest_snapshot,
    "latest_and_average": latest_and_average,
    "unit_scaling": unit_scaling,
    "unit_scaling_by_max": unit_scaling_by_max,
    "metadata_scaling": metadata_scaling,
    "subject_vs_real_peers": subject_vs_real_peers,
    "aligned_timeline": aligned_timeline,
    "portfolio_mix": portfolio_mix,
    "peer_table": peer_table,
    "ratio_components": ratio_components,
    "latest_per_entity": latest_per_entity,
    "latest_partition": latest_partition,
    "arg_max_row": arg_max_row,
}

register("now", "select * from derived where REPDTE = (select max(REPDTE) from derived)", ("derived",))


def melted(source, keys, metrics):
    parts = [f"select {keys}, '{m}' as metric, {m} as value from {source}" for m in metrics]
    return f"(select * from ({' union all '.join(parts)}) where value is not null)"


_PCT = "(count(*) filter (value < s) + count(*) filter (value <= s) + case when count(*) filter (value = s) > 0 then 1 else 0 end) * 50.0 / count(value)"


def flag_sql(pct):
    desc = ", ".join(f"'{m}'" for m in compare.DESCRIPTIVE)
    risk = " or ".join(f"contains(lower(metric), '{t}')" for t in compare.LOWER_IS_BETTER)
    return f"""case when {pct} is null then 'N/A' when metric in ({desc}) then ''
      when {risk} then case when {pct} <= 25 then 'Top Quartile (Low Risk)' when {pct} <= 50 then 'Better than Median' else 'Bottom Quartile (High Risk)' end
      else case when {pct} >= 75 then 'Top Quartile (Strong)' when {pct} >= 50 then 'Better than Median' else 'Bottom Quartile (Weak)' end end"""


def comparison_sql(metrics, normalized_only=False):
    swap = {} if normalized_only else compare.NORMALIZED_METRICS
    std = [(m, m) for m in metrics]
    norm = [(m, swap.get(m, m)) for m in metrics if not (m in swap and swap[m] == "Norm_Provision_Rate")]
    rows = " union all ".join(
        [f"select CERT, false as n, '{m}' as metric, {c} as value, (select {c} from now where CERT = {SUBJECT}) as s from now" for m, c in std]
        + [f"select CERT, true, '{m}', {c}, (select {c} from now where CERT = {SUBJECT}) from now" for m, c in norm]
    )
    where = "where use_normalized" if normalized_only else ""
    return f"""select metric, group_key, use_normalized, subject_value, peer_count, mean, median, min, max, pct, {flag_sql('pct')} as performance_flag from (
        select metric, group_key, use_normalized, max(s) as subject_value, count(value) as peer_count, round(avg(value), 9) as mean,
        round(quantile_cont(value, 0.5), 9) as median, min(value) as min, max(value) as max, case when count(s) > 0 then {_PCT} end as pct
        from (select * from ({rows}) where value is not null) r join (select * from bridge {where}) b on r.CERT = b.CERT and r.n = b.use_normalized
        group by metric, group_key, use_normalized)"""


def case_map(name, values, default):
    return f"case {name} " + " ".join(f"when '{k}' then '{v}'" for k, v in values.items()) + f" else '{default}' end"


def direction_sql(d):
    pol = case_map("metric", compare.POLARITY, "neutral")
    return f"""case when {d} is null then 'N/A' when abs({d}) < 1e-8 then 'flat' when {pol} = 'neutral' then 'neutral'
        when ({d} > 0 and {pol} = 'favorable') or ({d} < 0 and {pol} = 'adverse') then 'favorable' else 'adverse' end"""


_PRIOR = "(select REPDTE from (select distinct REPDTE from derived) order by abs(date_diff('day', (select max(REPDTE) from derived) - interval 1 year, REPDTE)), REPDTE limit 1)"


def heat_sql():
    cell = lambda who, when, m: f"(select {m} from derived where CERT = {who} and REPDTE = {when})"
    now = "(select max(REPDTE) from derived)"
    rows = " union all ".join(
        f"select '{m}' as metric, {cell(SUBJECT, now, m)} as subj_current, {cell(SUBJECT, _PRIOR, m)} as subj_prior, {cell(PEER, now, m)} as peer_current, {cell(PEER, _PRIOR, m)} as peer_prior" for m in HEAT
    )
    yoy = lambda w: f"case when regexp_matches(metric, 'Composition|Loan_Share|ACL_Share') then case when abs({w}_prior) > 1e-12 then {w}_current / nullif({w}_prior, 0) - 1 end else {w}_current - {w}_prior end"
    return f"""select *, {direction_sql('subj_yoy')} as subj_direction, {direction_sql('peer_yoy')} as peer_direction, {direction_sql('vs_peer_delta')} as vs_peer_direction from (
        select *, {yoy('subj')} as subj_yoy, {yoy('peer')} as peer_yoy, subj_current - peer_current as vs_peer_delta,
        {case_map('metric', compare.POLARITY, 'neutral')} as polarity, {case_map('metric', compare.METRIC_GROUPS, 'Other')} as metric_group from ({rows}))"""


def range_sql(metrics, bridge="bridge"):
    return f"""select metric, group_key, min(value) as lo, max(value) as hi, round(avg(value), 9) as mean, count(*) as members,
        first(CERT order by value, CERT) as lo_holder, first(CERT order by value desc, CERT) as hi_holder, round(quantile_cont(value, 0.5), 9) as median
        from {melted('now', 'CERT', metrics)} join {bridge} using (CERT) group by 1, 2"""


_KRI = ["TTM_NCO_Rate", "Allowance_to_Gross_Loans_Rate", "SBL_Composition"]
_ORDER = case_map("metric_group", {g: str(i + 1) for i, g in enumerate(compare.GROUP_ORDER)}, "0")
_SCALE = ["Top_House_Delinquency_Rate", "Allowance_to_Gross_Loans_Rate", "Loans_to_Deposits"]
_MAXSCALE = ["Top_House_Delinquency_Rate", "Nonaccrual_to_Gross_Loans_Rate"]
_SPARK = ["TTM_NCO_Rate", "Allowance_to_Gross_Loans_Rate", "LNLS"]
_MIX = ["RIC_CRE_Cost", "RIC_Resi_Cost", "RIC_Comm_Years_of_Reserves", "Liquidity_Ratio"]
_GROWTH = f"""with a as (select CERT, REPDTE, coalesce(CRE_Investment_Pure_Balance, 0.0) + coalesce(Wealth_Resi_Balance, 0.0) as l, coalesce(RIC_CRE_ACL, 0.0) as a from derived),
 n as (select * from a qualify row_number() over (partition by CERT order by abs(date_diff('day', REPDTE, date '1996-02-10')), REPDTE) = 1),
 c as (select a.CERT, a.REPDTE, a.l, a.a from a join n on a.CERT = n.CERT where case when n.l <> 0 and n.a <> 0 then a.REPDTE = n.REPDTE else a.REPDTE > n.REPDTE and a.l > 0 and a.a > 0 end
   qualify row_number() over (partition by a.CERT order by a.REPDTE) = 1)
 select CERT, REPDTE, (l - bl) / nullif(bl, 0) as target_loans_growth, (a - ba) / nullif(ba, 0) as target_acl_growth,
  round(case when y > 0 then pow(l / nullif(bl, 0), 1 / nullif(y, 0)) - 1 else 0.0 end, 8) as target_loans_cagr, round(case when y > 0 then pow(a / nullif(ba, 0), 1 / nullif(y, 0)) - 1 else 0.0 end, 8) as target_acl_cagr
 from (select a.*, c.l as bl, c.a as ba, date_diff('day', c.REPDTE, a.REPDTE) / 365.25::double as y from a join c on a.CERT = c.CERT where a.REPDTE >= c.REPDTE)"""


def nested(needs, body):
    """A body that has its own WITH list, placed behind the shared shapes."""
    return with_ctes(f"select * from ({body})", *needs)


def components_sql():
    rows = []
    for cert, label in ((1, "subject"), (2, "peer")):
        for code, (n, d) in compare.RATIO_COMPONENTS.items():
            n, d = n.replace("0D", "0.0"), d.replace("0D", "0.0")
            rows.append(f"select '{label}' as entity_label, '{code}' as metric, {n} as numerator, {d} as denominator, {code} as ratio from now where CERT = {cert}")
    return " union all ".join(rows)


ORACLES = {
    "peer_comparison": with_ctes(comparison_sql(METRICS), "now", "bridge"),
    "normalized_comparison": with_ctes(comparison_sql(NORM, True), "now", "bridge"),
    "comparison_wide": with_ctes(
        "select metric, "
        + ", ".join(f"max({s}) filter (group_key = '{g}') as {g}_{s}" for g in ("ALL", "ASIA") for s in ("median", "mean", "pct"))
        + f" from ({comparison_sql(['TTM_NCO_Rate', 'LNLS'])}) group by metric",
        "now",
        "bridge",
    ),
    "peer_range": with_ctes(range_sql(["TTM_NCO_Rate", "Allowance_to_Gross_Loans_Rate", "RIC_CRE_ACL_Share"]), "now", "bridge"),
    "kri_ranges": with_ctes(
        f"""select o.metric, round(s.value, 9) as subject_value, round(o.lo, 9) as outer_lo, round(o.hi, 9) as outer_hi, o.median as outer_median,
            i.v as inner_lo, i.v as inner_hi, i.v as inner_median from ({range_sql(_KRI)}) o
            join {melted(f'(select * from now where CERT = {SUBJECT})', 'CERT', _KRI)} s on s.metric = o.metric
            left join (select metric, round(avg(value), 9) as v from {melted('now', 'CERT', _KRI)} join bridge using (CERT) where group_key = 'ASIA' group by 1) i on i.metric = o.metric
            where o.group_key = 'ALL'""",
        "now",
        "bridge",
    ),
    "yoy_heatmap": with_ctes(heat_sql(), "derived"),
    "metric_order": with_ctes(
        f"select metric, count, cast({_ORDER} as bigint) as group_order from (select metric, count(*) as count, {case_map('metric', compare.METRIC_GROUPS, 'Other')} as metric_group from {melted('now', 'CERT', HEAT)} group by 1)", "now"
    ),
    "sparkline_points": with_ctes(
        f"""select metric, string_agg(coalesce(printf('%.6f', value), '-'), ',' order by REPDTE) as points, first_value, last_value,
            case when last_value is null or pol = 'neutral' then 'neutral' when (last_value > first_value) = (pol = 'adverse') then 'bad' else 'good' end as trend from (
            select *, first(value ignore nulls) over w as first_value, last(value ignore nulls) over w as last_value, {case_map('metric', compare.POLARITY, 'neutral')} as pol from (
              {' union all '.join(f"select REPDTE, '{m}' as metric, {m} as value from derived where CERT = {SUBJECT} and REPDTE in (select distinct REPDTE from derived order by 1 desc limit 8)" for m in _SPARK)})
            window w as (partition by metric order by REPDTE rows between unbounded preceding and unbounded following)) group by metric, first_value, last_value, pol""",
        "derived",
    ),
    "cumulative_growth": nested(("derived",), _GROWTH),
    "outlier_entities": with_ctes(
        f"""select CERT, x as Allowance_to_Gross_Loans_Rate, y as Nonaccrual_to_Gross_Loans_Rate, round(sqrt(pow(x - mx, 2) + pow(y - my, 2)), 9) as distance from (
            select CERT, Allowance_to_Gross_Loans_Rate as x, Nonaccrual_to_Gross_Loans_Rate as y, avg(Allowance_to_Gross_Loans_Rate) over () as mx, avg(Nonaccrual_to_Gross_Loans_Rate) over () as my from now)
            where CERT <> {SUBJECT} order by distance desc, CERT limit 5""",
        "now",
    ),
    "quadrant_labels": with_ctes(
        """select CERT, x as Total_Loans_Growth_TTM, y as Allowance_to_Gross_Loans_Rate, mx as median_x, my as median_y,
           case when x is null or y is null then null when x >= mx and y >= my then 'high_high' when x >= mx then 'high_low' when y >= my then 'low_high' else 'low_low' end as quadrant
           from (select CERT, Total_Loans_Growth_TTM as x, Allowance_to_Gross_Loans_Rate as y, quantile_cont(Total_Loans_Growth_TTM, 0.5) over () as mx, quantile_cont(Allowance_to_Gross_Loans_Rate, 0.5) over () as my from now)""",
        "now",
    ),
    "bubble_sizes": with_ctes(
        """select CERT, REPDTE, NACI, LNCI, case when max(abs(coalesce(NACI, 0.0))) over () > 0 then 50.0 + abs(coalesce(NACI, 0.0)) / max(abs(coalesce(NACI, 0.0))) over () * 400 else 100.0 end as bubble_size
           from panel where REPDTE = (select max(REPDTE) from panel)""",
        "panel",
    ),
    "latest_snapshot": with_ctes("select CERT, REPDTE, LNLS, RIC_CRE_Cost, RIC_CRE_ACL_Share, Total_Loans_Growth_TTM, RIC_Resi_NCO_TTM, 0 as flow_columns from now", "now"),
    "latest_and_average": with_ctes(
        f"""select CERT, metric, n.value as latest_value, round(t.value, 9) as trailing_average from {melted('now', 'CERT', HEAT[:3])} n
            left join (select CERT, metric, avg(value) as value from {melted(f'(select * from derived qualify row_number() over (partition by CERT order by REPDTE desc) <= 8)', 'CERT', HEAT[:3])} group by 1, 2) t using (CERT, metric)""",
        "now",
    ),
    "unit_scaling": with_ctes(
        f"select CERT, REPDTE, metric, case when quantile_cont(abs(value), 0.5) over (partition by metric) >= 0.01 then value / 100 else value end as value from {melted('derived', 'CERT, REPDTE', _SCALE)}", "derived"
    ),
    "unit_scaling_by_max": with_ctes(
        f"select CERT, REPDTE, metric, case when max(abs(value)) over (partition by metric) > 0.05 then value / 100 else value end as value from {melted('derived', 'CERT, REPDTE', _MAXSCALE)}", "derived"
    ),
    "metadata_scaling": with_ctes(
        f"select CERT, REPDTE, metric, value * case metric when 'LNLS' then 0.5 when 'LNCI' then 2.0 else 1.0 end as value from {melted('panel', 'CERT, REPDTE', ['LNLS', 'LNCI', 'DEP'])}", "panel"
    ),
    "subject_vs_real_peers": with_ctes(
        f"select CERT, REPDTE, LNLS from panel join bridge using (CERT) where group_key = 'EUROPE' and CERT <> {SUBJECT} and REPDTE = (select max(REPDTE) from panel)", "panel", "bridge"
    ),
    "aligned_timeline": with_ctes(
        f"select a.CERT, a.REPDTE, a.LNLS, b.LNCI as peer_LNCI from panel a left join panel b on b.CERT = {PEER} and a.REPDTE = b.REPDTE where a.CERT = {SUBJECT} and a.REPDTE >= date '1997-06-30'", "panel"
    ),
    "portfolio_mix": with_ctes(
        f"select CERT, REPDTE, metric, value, 'Q' || quarter(REPDTE) || '-' || strftime(REPDTE, '%y') as period_label from ({' union all '.join(f"select CERT, REPDTE, '{m}' as metric, coalesce({m}, 0.0) as value from derived" for m in _MIX)})", "derived"
    ),
    "peer_table": with_ctes(
        f"""select metric, subject, peer_a, peer_b, subject - peer_a as subject_vs_peer_a from (
            select metric, max(value) filter (CERT = 1) as subject, max(value) filter (CERT = 2) as peer_a, max(value) filter (CERT = 3) as peer_b from {melted('now', 'CERT', HEAT)} where CERT in (1, 2, 3) group by 1)""",
        "now",
    ),
    "ratio_components": with_ctes(components_sql(), "now"),
    "latest_per_entity": with_ctes("select * from series qualify DATE = max(DATE) over (partition by SeriesID)", "series"),
    "latest_partition": with_ctes("select CERT, REPDTE, LNLS, LNCI from panel where REPDTE = (select max(REPDTE) from panel)", "panel"),
    "arg_max_row": with_ctes(
        """select CERT, REPDTE, LNLS, LNCI, 'entity' as scope from panel where LNLS is not null qualify row_number() over (partition by CERT order by LNLS desc, REPDTE desc) = 1
           union all (select CERT, REPDTE, LNLS, LNCI, 'all' from panel where LNLS is not null order by LNLS desc, REPDTE desc, CERT desc limit 1)""",
        "panel",
    ),
}
