"""Peer composite queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterdeck.catalog.normalization import derived, derived_table
from quarterdeck.catalog.sql import register, with_ctes
from quarterdeck.operators import composite, ratios
from quarterdeck.plans.shapes import bank_panel, peer_groups

METRICS = ["LNLS", "ASSET", "TTM_NCO_Rate", "Past_Due_Rate", "Norm_Gross_Loans", "Norm_NCO_Rate", "RIC_CRE_ACL_Share"]
RATES = [m for m in METRICS if composite.metric_kind(m) == "rate"]
# Composite ids count up from a negative base here: supplier keys are dense from 0.
ID_BASE = -90000


def rounded(df, metrics=METRICS):
    return df.withColumns({m: F.round(m, 9 if m in RATES else 3) for m in metrics})


def composite_mean(spark, sf):
    return rounded(composite.composites(derived(spark, sf), peer_groups(spark, sf), METRICS, id_base=ID_BASE))


def composite_weighted(spark, sf):
    df = composite.composites(derived(spark, sf), peer_groups(spark, sf), METRICS, method="weighted", id_base=ID_BASE, blank_regime=False)
    return rounded(df)


def combined_entity(spark, sf):
    return rounded(composite.combined_entity(derived(spark, sf), [1, 2], 88888, METRICS, "LNLS"))


def panel_with_composites(spark, sf):
    panel = derived_table(spark, sf, ["LNLS", "TTM_NCO_Rate"])
    extra = composite.composites(panel, peer_groups(spark, sf), ["LNLS", "TTM_NCO_Rate"], id_base=ID_BASE)
    both = composite.with_composites(panel, extra.drop("group_key", "member_count"))
    return both.withColumn("TTM_NCO_Rate", F.round("TTM_NCO_Rate", 9)).withColumn("LNLS", F.round("LNLS", 3))


SHARE_INPUTS = ["Total_ACL", "Total_Reg_ACL", "RIC_Calculated_ACL", "RIC_CRE_ACL_Share", "RIC_Constr_ACL_Share", "RIC_Comm_ACL_Share", "RIC_Resi_ACL_Share", "RIC_OthCons_ACL_Share", "RIC_Card_ACL_Share"]


def group_shares_with_composites(spark, sf):
    """Averages have no benchmark of their own."""
    panel = derived_table(spark, sf, SHARE_INPUTS)
    extra = composite.composites(panel, peer_groups(spark, sf), SHARE_INPUTS, id_base=ID_BASE).drop("NAME", "group_key", "member_count")
    df = ratios.group_shares(composite.with_composites(panel, extra))
    return df.select("CERT", "REPDTE", "is_composite", "ACL_Integrity_Status", F.round("Group_CRE_ACL_Share", 9).alias("Group_CRE_ACL_Share"))


def member_audit(spark, sf):
    """Members with a card balance in any quarter count as found."""
    df = bank_panel(spark, sf, ["LNCRCD"]).filter("LNCRCD > 0")
    return composite.member_audit(df, peer_groups(spark, sf), minimum=5)


def all_members(spark, sf):
    return composite.all_members(peer_groups(spark, sf))


COVERED = ["Norm_PD30", "Norm_PD90", "Norm_Gross_Loans"]


def _residuals(spark, sf):
    """Only the residual columns of the derivation; some past-due residuals are NULL."""
    return derived_table(spark, sf, COVERED)


def coverage_audit(spark, sf):
    return composite.coverage_audit(_residuals(spark, sf), peer_groups(spark, sf), COVERED)


def blank_low_coverage(spark, sf):
    df, bridge = _residuals(spark, sf), peer_groups(spark, sf)
    rows = composite.composites(df, bridge, COVERED, id_base=ID_BASE)
    audit = composite.coverage_audit(df, bridge, COVERED, minimum=0.9)
    return rounded(composite.blank_low_coverage(rows, audit, COVERED), COVERED)


def two_peer_sets(spark, sf):
    panel = bank_panel(spark, sf, ["LNLS", "ASSET"])
    sets = composite.peer_sets(panel, subject=1, excluded=[2, 3, 5])
    return composite.composites(panel, sets, ["LNLS", "ASSET"], id_base=ID_BASE).withColumns({"LNLS": F.round("LNLS", 3), "ASSET": F.round("ASSET", 3)})


QUERIES = {
    "composite_mean": composite_mean,
    "composite_weighted": composite_weighted,
    "combined_entity": combined_entity,
    "panel_with_composites": panel_with_composites,
    "group_shares_with_composites": group_shares_with_composites,
    "member_audit": member_audit,
    "all_members": all_members,
    "coverage_audit": coverage_audit,
    "blank_low_coverage": blank_low_coverage,
    "two_peer_sets": two_peer_sets,
}


def digits(m):
    return 9 if m in RATES else 3


def regime(m, e):
    if m.startswith("Norm_"):
        return f"case when use_normalized then {e} end as {m}"
    if m in composite.STANDARD_RATES:
        return f"case when not use_normalized then {e} end as {m}"
    return f"{e} as {m}"


def weighted(m):
    return f"case when sum(coalesce(LNLS, 0.0)) > 0 then sum(coalesce({m}, 0.0) * coalesce(LNLS, 0.0)) / nullif(sum(coalesce(LNLS, 0.0)), 0) else avg({m}) end"


_IDS = f"cast({ID_BASE} + display_order as bigint) as CERT, REPDTE, 'AVG: ' || group_key as NAME, group_key, count(distinct CERT) as member_count"
_BY = "group by group_key, display_order, use_normalized, REPDTE"
_JOIN = "from derived join bridge using (CERT)"

register("d_cov", "select CERT, REPDTE, Norm_PD30, Norm_PD90, Norm_Gross_Loans from d_res", ("d_res",))
_CA = """select group_key, REPDTE, metric_code, coalesce(contributor_count, 0) as contributor_count, total_constituents,
  coalesce(contributor_count, 0) / total_constituents as contributor_pct,
  case when coalesce(contributor_count, 0) / total_constituents < {min} then 'LOW_COVERAGE' else 'OK' end as coverage_flag
  from (select group_key, count(*) as total_constituents from bridge group by 1) cross join (select distinct REPDTE from d_cov)
  cross join (select unnest(['Norm_PD30', 'Norm_PD90', 'Norm_Gross_Loans']) as metric_code)
  left join (select group_key, REPDTE, unnest(['Norm_PD30', 'Norm_PD90', 'Norm_Gross_Loans']) as metric_code, unnest([count(Norm_PD30), count(Norm_PD90), count(Norm_Gross_Loans)]) as contributor_count
    from d_cov join bridge using (CERT) group by 1, 2) using (group_key, REPDTE, metric_code)"""

ORACLES = {
    "composite_mean": with_ctes(f"select {_IDS}, {', '.join(regime(m, f'round(avg({m}), {digits(m)})') for m in METRICS)} {_JOIN} {_BY}", "derived", "bridge"),
    "composite_weighted": with_ctes(
        f"select {_IDS}, {', '.join(f'round({weighted(m) if m in RATES else f'avg({m})'}, {digits(m)}) as {m}' for m in METRICS)} {_JOIN} {_BY}", "derived", "bridge"
    ),
    "combined_entity": with_ctes(
        f"""select cast(88888 as bigint) as CERT, REPDTE, {', '.join(f'round({weighted(m) if m in RATES else f'sum(coalesce({m}, 0.0))'}, {digits(m)}) as {m}' for m in METRICS)}
            from derived where CERT in (1, 2) group by REPDTE having count(distinct CERT) = 2""",
        "derived",
    ),
    "panel_with_composites": with_ctes(
        f"""select CERT, REPDTE, round(LNLS, 3) as LNLS, round(TTM_NCO_Rate, 9) as TTM_NCO_Rate, cast(null as varchar) as NAME, false as is_composite from derived
            union all select cast({ID_BASE} + display_order as bigint), REPDTE, round(avg(LNLS), 3), case when not use_normalized then round(avg(TTM_NCO_Rate), 9) end, 'AVG: ' || group_key, true {_JOIN} {_BY}""",
        "derived",
        "bridge",
    ),
    "group_shares_with_composites": with_ctes(
        f"""select CERT, REPDTE, false as is_composite, ACL_Integrity_Status, round(Group_CRE_ACL_Share, 9) as Group_CRE_ACL_Share from derived
            union all select cast({ID_BASE} + display_order as bigint), REPDTE, true, 'NO_BENCHMARK', round(avg(RIC_CRE_ACL_Share) + avg(RIC_Constr_ACL_Share), 9) {_JOIN} {_BY}""",
        "derived",
        "bridge",
    ),
    "member_audit": with_ctes(
        """select group_key, count(*) as configured, count(s.CERT) as found, count(s.CERT) >= 5 as enough_members from bridge
           left join (select distinct CERT from panel where LNCRCD > 0) s using (CERT) group by 1""",
        "panel",
        "bridge",
    ),
    "all_members": with_ctes("select distinct CERT from bridge", "bridge"),
    "coverage_audit": with_ctes(_CA.format(min=0.5), "d_cov", "bridge"),
    "blank_low_coverage": with_ctes(
        f"""select {_IDS}, {', '.join(f"case when use_normalized and not bool_or(coalesce(coverage_flag = 'LOW_COVERAGE' and metric_code = '{m}', false)) then round(avg(case when metric_code = '{m}' then {m} end), 3) end as {m}" for m in COVERED)}
            from (select * from d_cov join bridge using (CERT)) join ({_CA.format(min=0.9)}) a using (group_key, REPDTE) {_BY}""",
        "d_cov",
        "bridge",
    ),
    "two_peer_sets": with_ctes(
        f"""select cast({ID_BASE} + display_order as bigint) as CERT, REPDTE, 'AVG: ' || group_key as NAME, group_key, count(*) as member_count, round(avg(LNLS), 3) as LNLS, round(avg(ASSET), 3) as ASSET
            from panel join (select distinct CERT, 'ALL_PEERS' as group_key, 1 as display_order from panel where CERT <> 1
              union all select distinct CERT, 'PEERS_EX', 2 from panel where CERT not in (1, 2, 3, 5)) using (CERT) group by group_key, display_order, REPDTE""",
        "panel",
    ),
}
