"""Queries over the normalised view and the ratio library."""

from __future__ import annotations

from weakref import WeakKeyDictionary

from pyspark.sql import functions as F

from quarterdeck.catalog.panel import E, E4, sql_flow, sql_growth
from quarterdeck.catalog.sql import register, with_ctes
from quarterdeck.operators import normalize, ratios
from quarterdeck.plans.panel_run import derive_panel, exclusions
from quarterdeck.plans.shapes import bank_panel, table, tasks
from quarterdeck.session import materialize

KEYS = ["CERT", "REPDTE"]
SEGS = list(normalize.SEGMENTS)


_PLANS: WeakKeyDictionary = WeakKeyDictionary()


def derived(spark, sf):
    """The derived panel. Its plan (not its rows) is built once per session, input folder and number of tasks.

    Analysing some 475 columns takes the driver seconds whatever the data size. A folder that holds larger tables than before has a new plan.
    """
    plans = _PLANS.setdefault(spark, {})
    key = sf, tasks(table(spark, sf, "lineitem"))
    if key not in plans:
        plans[key] = derive_panel(bank_panel(spark, sf))
    return plans[key]


def derived_table(spark, sf, columns):
    """Some derived columns, computed once and written, for queries that read them in several branches."""
    return materialize(derived(spark, sf).select(*KEYS, *columns), "panel")


def select_from(builder, columns):
    """A query that keeps the keys and some columns of a derivation; Catalyst prunes the rest."""

    def query(spark, sf):
        return builder(spark, sf).select(*KEYS, *columns)

    return query


def resolved(spark, sf):
    return normalize.resolve_codes(bank_panel(spark, sf))


def segments(spark, sf):
    return normalize.map_segments(resolved(spark, sf))


def excluded(spark, sf):
    return exclusions(bank_panel(spark, sf))


def normalized_residual(spark, sf):
    """Residual of reported 30-day past dues after the excluded categories, for two tolerances."""
    df = excluded(spark, sf)
    out = []
    for label, tol in (("", 0.05), ("_wide", 0.5)):
        rec = normalize.normalized_residual("TopHouse_PD30", "Excluded_PD30", tol)
        out += [rec["value"].alias(f"value{label}"), rec["severity"].alias(f"severity{label}")]
    rec = normalize.normalized_residual("TopHouse_PD30", "Excluded_PD30")
    out += [rec[c].alias(c) for c in ("residual", "over_exclusion_flag", "over_exclusion_pct")]
    return df.select(*KEYS, *out)


def reconciliation(spark, sf):
    df = derived_table(spark, sf, [*RECON_INPUTS])
    df = normalize.reconciliation(df)
    return df.filter(F.col("REPDTE") == df.agg(F.max("REPDTE")).scalar()).select(*KEYS, *RECON)


def exclusion_audit(spark, sf):
    df = normalize.exclusion_audit(excluded(spark, sf))
    return df.select(*KEYS, *AUDIT)


def capital_with_allowance(spark, sf):
    df = ratios.add_totals(segments(spark, sf))
    return ratios.apply_ratios(df, ratios.CAPITAL_RATIOS_WITH_ALLOWANCE).select(
        *KEYS, "CRE_Concentration_Capital_Risk", "CI_to_Capital_Risk"
    )


# Codes of the older panel and what stands for them here.
OLDER_CODES = {
    "P3LNLS": "TopHouse_PD30", "P9LNLS": "TopHouse_PD90", "NCLNLS": "Total_Nonaccrual + TopHouse_PD90",
    "EQCS": "CHBAL", "EQSUR": "CHBALNI", "EQPP": "RCON1754", "EQUP": "RCON1773", "EQCCOMPI": "RBCT1J",
}
NPL_AND_EQUITY = ["AOBS", "Net_Retained_Earnings", *(s.code for s in (*ratios.NPL_RATIOS, *ratios.EQUITY_SHARES))]


def npl_and_equity_mix(spark, sf):
    df = ratios.add_totals(segments(spark, sf)).withColumns({c: F.expr(e) for c, e in OLDER_CODES.items()})
    return ratios.npl_and_equity_mix(df).select(*KEYS, *[F.round(c, 9).alias(c) for c in NPL_AND_EQUITY])


RESOLVED = [*list(normalize.CODE_PAIRS)[:3], *normalize.SYNTHETIC_FIELDS, "LNCONOTHX"]
SEGMENT_COLUMNS = [f"RIC_{s}_{m}" for s in SEGS for m in ("Cost", "ACL", "Nonaccrual", "PD30", "PD90")] + [
    "RIC_CRE_Inv_Nonaccrual",
    "RIC_CRE_OO_Nonaccrual",
    "TopHouse_PD30",
    "TopHouse_PD90",
    "Total_Nonaccrual",
]
SEGMENT_FLOWS = [f"RIC_{s}_NCO_TTM" for s in SEGS] + ["Total_NCO_TTM"]
CATS = list(normalize.EXCLUSIONS)
BALANCES = [normalize.balance_name(k) for k in CATS] + ["Excluded_Balance"]
LOSSES = [f"Excl_{k}_NCO_YTD" for k in CATS] + [f"_{k}_NCO_Gated" for k in CATS if k != "NDFI"] + ["Excluded_NCO_YTD"]
QUALITY = [f"Excl_{k}_{m}" for k in CATS for m in ("NA", "P3", "P9")] + ["Excluded_PD30", "Excluded_PD90"]
CEILING = ["Excluded_NCO_Q", "Excluded_NCO_TTM", "Excluded_Nonaccrual", "_NCO_Ceiling_Excess", "_NA_Ceiling_Excess"]
RECON = [
    "Total_NCO_TTM", "Excluded_NCO_TTM", "Norm_Total_NCO", "_Norm_NCO_Severity", "Gross_Loans", "Excluded_Balance", "Norm_Gross_Loans",
    "NCO_Check_ExclPlusNormMinusTotal", "NCO_Flag_Excl_GT_Total", "Loans_Check_ExclPlusNormMinusTotal", "Loans_Flag_Excl_GT_Total",
]
RECON_INPUTS = RECON[:7]
AUDIT = ["category_balance_zero_but_nco_nonzero_flag", "dominant_exclusion_category", "dominant_exclusion_share"]
TOTALS = [
    "SBL_Balance", "Fund_Finance_Balance", "Other_Balance", "CRE_Investment_Pure_Balance", "RIC_Calculated_ACL", "RIC_Calculated_Cost",
    "Total_ACL", "RIC_Used_Total_ACL", "RIC_Used_Total_Cost", "Liquid_Assets", "HQLA", "Total_Assets_Raw", "Net_Income_Raw", "Wealth_Resi_Balance",
]
YIELDS = ["Norm_Loss_Adj_Yield", "Norm_Risk_Adj_Return", "Norm_Fund_Finance_Composition"]
SEGMENT_RATIOS = [
    f"RIC_{s}_{m}"
    for s in SEGS
    for m in (
        "ACL_Coverage", "Risk_Adj_Coverage", "Years_of_Reserves", "NCO_Rate", "Nonaccrual_Rate", "Delinquency_Rate", "ACL_Efficiency",
        "Migration_Ratio", "ACL_Share", "Loan_Share", "Loss_Adj_Yield", "Alloc_Mismatch", "Risk_Mismatch",
    )
]
SHARES = [f"{n}{s}_Share_of_Total_{h}" for s in normalize.SHARE_SEGMENTS for n in ("", "Norm_") for h in ("PD30", "PD90", "PD")]
GROUPS = ["Group_CRE_ACL_Share", "Group_Commercial_ACL_Share", "Group_Residential_ACL_Share", "Group_OtherSBL_ACL_Share", "ACL_Integrity_Status", "ACL_Reg_Divergence"]
ALIASED = [a for a in ratios.ALIASES if a != "Tier_1_Leverage_Ratio"]


def codes(specs):
    return [s.code for s in specs]


QUERIES = {
    "resolve_codes": select_from(resolved, RESOLVED),
    "segment_mapping": select_from(segments, SEGMENT_COLUMNS),
    "segment_flows_ttm": select_from(lambda s, d: normalize.segment_flows(segments(s, d)), SEGMENT_FLOWS),
    "exclusion_balances": select_from(excluded, BALANCES),
    "exclusions_gated": select_from(excluded, LOSSES),
    "exclusion_quality": select_from(excluded, QUALITY),
    "excluded_ceiling": select_from(excluded, CEILING),
    "normalized_residual": normalized_residual,
    "norm_diagnostics": lambda s, d: normalize.diagnostics(derived(s, d)),
    "reconciliation": reconciliation,
    "exclusion_audit": exclusion_audit,
    "panel_totals": select_from(derived, TOTALS),
    "top_ratios": select_from(derived, codes(ratios.TOP_RATIOS)),
    "capital_ratios": select_from(derived, codes(ratios.CAPITAL_RATIOS)),
    "capital_ratios_with_allowance": capital_with_allowance,
    "npl_and_equity_mix": npl_and_equity_mix,
    "liquidity_ratios": select_from(derived, codes(ratios.LIQUIDITY_RATIOS)),
    "profit_ratios": select_from(derived, codes(ratios.PROFIT_RATIOS)),
    "normalized_ratios": select_from(derived, [*codes(ratios.NORM_RATIOS), "Norm_ACL_Balance"]),
    "normalized_yields": select_from(derived, YIELDS),
    "segment_ratios": select_from(derived, SEGMENT_RATIOS),
    "contribution_shares": select_from(derived, SHARES),
    "group_shares": select_from(derived, GROUPS),
    "report_aliases": select_from(derived, ALIASED),
}


# --- the same derivation in SQL, one layer per step ---------------------------------


def best(*cols):
    return f"coalesce({', '.join(f'nullif({c}, 0)' for c in cols)}, 0.0)"


def s(*cols):
    return "(0.0::double + " + " + ".join(f"coalesce({c}, 0.0)" for c in cols) + ")" if cols else "0.0::double"


def div0(n, d):
    return f"case when ({d}) = 0 then 0.0 else ({n}) / nullif(({d}), 0) end"


def layer(name, source, cols, window=False):
    body = ",\n ".join(f"{e} as {n}" for n, e in cols.items())
    register(name, f"select *,\n {body}\n from {source}" + (f" window e as ({E})" if window else ""), (source,))


def stack(p, suffix=""):
    mf, row, rot = (f"coalesce({p}{c}{suffix}, 0.0)" for c in ("REMULT", "RENROW", "RENROT"))
    return f"({mf} + greatest({rot}, {row}))"


layer(
    "d_codes",
    "panel",
    {
        "HTM_Securities": "coalesce(RCFD1754, RCON1754)",
        "AFS_Securities": "coalesce(RCFD1773, RCON1773)",
        "Unused_Commitments_Total": "coalesce(RCFD3423, RCON3423)",
        "LNOTHPCS": "coalesce(RCFD1545, RCON1545, 0.0)",
        "LNOTHNONDEP": "coalesce(RCFDJ454, 0.0)",
        "LNCONAUTO": "coalesce(LNAUTO, 0.0)",
        "LNCONCC": "coalesce(LNCRCD, 0.0)",
        "LNCONOTHX": "greatest(coalesce(LNCON, 0.0) - coalesce(LNAUTO, 0.0) - coalesce(LNCRCD, 0.0), 0.0)",
    },
)
_resi = s("RCON5367", "RCON5368")
_seg = {
    "RIC_Constr_Cost": best("RCFDJJ04", "RCONJJ04"),
    "RIC_Constr_ACL": best("RCFDJJ12"),
    "RIC_CRE_Cost": best("RCFDJJ05"),
    "RIC_CRE_ACL": best("RCFDJJ13"),
    "RIC_Resi_Cost": f"case when {_resi} > 0 then {_resi} else {best('LNRERES')} end",
    "RIC_Resi_ACL": best("RCFDJJ14"),
    "RIC_Comm_Cost": best("RCFDJJ07"),
    "RIC_Comm_ACL": best("RCFDJJ15"),
    "RIC_Card_Cost": best("RCFDJJ08"),
    "RIC_Card_ACL": best("RCFDJJ16"),
    "RIC_OthCons_Cost": best("RCFDJJ09"),
    "RIC_OthCons_ACL": best("RCFDJJ17"),
    "TopHouse_PD30": best("P3LNLS"),
    "TopHouse_PD90": best("P9LNLS"),
    "RIC_CRE_Inv_Nonaccrual": s("NAREMULT", "NARENROT"),
    "RIC_CRE_OO_Nonaccrual": s("NARENROW"),
    "RIC_OthCons_Nonaccrual": s("NAAUTO"),
    "RIC_OthCons_PD30": s(),
    "RIC_OthCons_PD90": s(),
}
for _m, _p in normalize.STACK_PREFIXES.items():
    _seg[f"RIC_CRE_{_m}"] = stack(_p)
    for _n, _c in (("Constr", "RECONS"), ("Resi", "RERES"), ("Comm", "CI"), ("Card", "CRCD")):
        _seg[f"RIC_{_n}_{_m}"] = s(_p + _c)
layer("d_seg", "d_codes", _seg)
layer("d_na", "d_seg", {"Total_Nonaccrual": " + ".join(f"RIC_{n}_Nonaccrual" for n in SEGS)})
_flows = ["NTLNLS", "NTCI", "NTRECONS", "NTREMULT", "NTRENROW", "NTRENROT", "NTRERES"]
layer("d_q", "d_na", {f"{c}_Q": sql_flow(c) for c in _flows}, window=True)
layer(
    "d_ttm",
    "d_q",
    {
        "RIC_CRE_NCO_TTM": f"sum({stack('NT', '_Q')}) over {E4}",
        "RIC_Constr_NCO_TTM": f"sum(NTRECONS_Q) over {E4}",
        "RIC_Resi_NCO_TTM": f"sum(NTRERES_Q) over {E4}",
        "RIC_Comm_NCO_TTM": f"sum(NTCI_Q) over {E4}",
        "RIC_Card_NCO_TTM": "0.0::double",
        "RIC_OthCons_NCO_TTM": "0.0::double",
        "Total_NCO_TTM": f"sum(NTLNLS_Q) over {E4}",
    },
)
_ccnet = f"({best('RIADB514')} - {best('RIADB515')})"
_raw = {"CI": best("NTCI"), "NDFI": "0.0::double", "ADC": best("NTRECONS"), "CC": f"case when {_ccnet} <> 0 then {_ccnet} else 0.0 end", "Auto": best("RIADK205"), "Ag": "0.0::double", "OO_CRE": best("NTRENROW")}
_bal = {"CI": f"greatest({best('LNCI')}, 0.0)", "NDFI": best("RCFDJ454"), "ADC": best("LNRECONS"), "CC": best("RIC_Card_Cost"), "Auto": best("LNAUTO"), "Ag": best("LNAG"), "OO_CRE": best("LNRENROW")}
_ex = {normalize.balance_name(k): e for k, e in _bal.items()}
for _k in CATS:
    _ex[f"Excl_{_k}_NCO_YTD"] = f"case when {_bal[_k]} > 0 then {_raw[_k]} else 0.0 end"
    if _k != "NDFI":
        _ex[f"_{_k}_NCO_Gated"] = f"({_bal[_k]} = 0 and {_raw[_k]} <> 0)"
    for _m, _p in (("NA", "NA"), ("P3", "P3"), ("P9", "P9")):
        _code = {"CI": "CI", "ADC": "RECONS", "OO_CRE": "RENROW", "CC": "CRCD" if _p != "NA" else None}.get(_k)
        _ex[f"Excl_{_k}_{_m}"] = best(_p + _code) if _code else "0.0::double"
layer("d_ex", "d_ttm", _ex)
layer(
    "d_ext",
    "d_ex",
    {
        "Excluded_Balance": " + ".join(_ex_name for _ex_name in (normalize.balance_name(k) for k in CATS)),
        "Excluded_NCO_YTD": " + ".join(f"Excl_{k}_NCO_YTD" for k in CATS),
        "Excluded_Nonaccrual_Raw": " + ".join(f"Excl_{k}_NA" for k in CATS),
        "Excluded_PD30": " + ".join(f"Excl_{k}_P3" for k in CATS),
        "Excluded_PD90": " + ".join(f"Excl_{k}_P9" for k in CATS),
    },
)
layer("d_exq", "d_ext", {"Excluded_NCO_Q": sql_flow("Excluded_NCO_YTD")}, window=True)
layer("d_exr", "d_exq", {"Excluded_NCO_TTM_Raw": f"sum(Excluded_NCO_Q) over {E4}"})
layer(
    "d_cap",
    "d_exr",
    {
        "Excluded_NCO_TTM": "least(Excluded_NCO_TTM_Raw, Total_NCO_TTM)",
        "Excluded_Nonaccrual": "least(Excluded_Nonaccrual_Raw, Total_Nonaccrual)",
        "_NCO_Ceiling_Excess": "greatest(Excluded_NCO_TTM_Raw - Total_NCO_TTM, 0.0)",
        "_NA_Ceiling_Excess": "greatest(Excluded_Nonaccrual_Raw - Total_Nonaccrual, 0.0)",
    },
)


def residual_sql(total, excl, tol=0.05):
    res = f"({total} - {excl})"
    minor = f"({res} < 0 and {total} > 0 and -{res} / nullif({total}, 0) <= {tol})"
    return {
        "value": f"case when {minor} then 0.0 when not ({res} < 0) then {res} end",
        "residual": res,
        "flag": f"coalesce({res} < 0, false)",
        "pct": f"case when {total} > 0 then greatest(-{res} / nullif({total}, 0), 0.0) else 0.0 end",
        "severity": f"case when {minor} then 'minor_clip' when {res} < 0 then 'material_nan' else 'ok' end",
    }


_tot = {
    "SBL_Balance": best("RCFD1545", "RCON1545"),
    "Fund_Finance_Balance": best("RCFDJ454"),
    "ADC_Balance": best("LNRECONS"),
    "CRE_OO_Balance": best("LNRENROW"),
    "RIC_Unalloc_ACL": best("RCFDJJ22"),
    "Cash_and_Balances": best("CHBAL"),
    "Fed_Funds_Sold": best("CHBALNI"),
    "Securities_HTM": best("HTM_Securities"),
    "Securities_AFS": best("AFS_Securities"),
    "Total_Assets_Raw": best("ASSET"),
    "Total_Equity_Raw": best("EQ"),
    "Total_Deposits_Raw": best("DEP"),
    "Net_Income_Raw": best("NETINC"),
    "Total_Int_Income_Raw": best("INTINC"),
    "Total_Int_Expense_Raw": best("INTEXP"),
    "Total_Nonint_Income_Raw": best("NONII"),
    "Total_Nonint_Expense_Raw": best("NONIX"),
    "Int_Inc_Loans_Raw": best("ILNDOM"),
    "Int_Exp_Deposits_Raw": best("EDEPDOM"),
    "Unused_Commitments": best("Unused_Commitments_Total"),
    "Provision_Exp_YTD": best("ELNATR"),
    "CI_Balance": best("LNCI"),
    "CRE_Investment_Pure_Balance": f"{best('LNREMULT')} + {best('LNRENROT')}",
    "Other_Balance": best("RCONJ451"),
    "Total_ACL": s("LNATRES"),
    "Total_Reg_ACL": s("RB2LNRES"),
    "Gross_Loans": "LNLS",
    "Wealth_Resi_Balance": f"greatest(case when {_resi} > 0 then {_resi} else {best('LNRERES')} end, 0.0)",
    "Norm_ACL_Balance": f"{best('LNATRES')} - ({best('RCFDJJ12')} + {best('RCFDJJ16')} + {best('RCFDJJ17')})",
    "Int_Inc_Loans_YTD": s("ILNDOM"),
}
layer("d_tot", "d_cap", _tot)
layer(
    "d_tot2",
    "d_tot",
    {
        "RIC_Calculated_ACL": " + ".join(f"RIC_{n}_ACL" for n in SEGS) + " + RIC_Unalloc_ACL",
        "RIC_Calculated_Cost": " + ".join(f"RIC_{n}_Cost" for n in SEGS),
        "Liquid_Assets": "Cash_and_Balances + Fed_Funds_Sold + Securities_AFS",
        "HQLA": "Cash_and_Balances + Fed_Funds_Sold + Securities_HTM + Securities_AFS",
        "Total_Assets_Used": "case when Total_Assets_Raw > 0 then Total_Assets_Raw else coalesce(ASSET, 1.0) end",
        "Total_Equity_Used": "case when Total_Equity_Raw > 0 then Total_Equity_Raw else coalesce(EQ, 1.0) end",
        "Provision_Exp_Q": sql_flow("Provision_Exp_YTD"),
        "Net_Income_Q": sql_flow("Net_Income_Raw"),
    },
    window=True,
)
_res = {}
for _k, (_t, _e, _name) in normalize.RESIDUALS.items():
    _r = residual_sql(_t, _e)
    _res |= {_name: _r["value"], f"_Norm_{_k}_Residual": _r["residual"], f"_Norm_{_k}_OverExclusion_Pct": _r["pct"], f"_Flag_{_k}_OverExclusion": _r["flag"], f"_Norm_{_k}_Severity": _r["severity"]}
layer(
    "d_res",
    "d_tot2",
    {
        **_res,
        "RIC_Used_Total_ACL": "case when Total_ACL > 0 then Total_ACL else RIC_Calculated_ACL end",
        "RIC_Used_Total_Cost": "case when Gross_Loans > 0 then Gross_Loans else RIC_Calculated_Cost end",
        "Delta_Nonaccrual": "Total_Nonaccrual - lag(Total_Nonaccrual) over e",
        "Delta_Provision": "Provision_Exp_Q - lag(Provision_Exp_Q) over e",
        "Delta_CRE_Nonaccrual": "RIC_CRE_Nonaccrual - lag(RIC_CRE_Nonaccrual) over e",
        "Lagged_CRE_Total_PD": "lag(RIC_CRE_PD30 + RIC_CRE_PD90) over e",
        "Net_Int_Income": "Total_Int_Income_Raw - Total_Int_Expense_Raw",
        "Loan_Income_Ann": "Int_Inc_Loans_Raw * 4.0 / quarter(REPDTE)",
    },
    window=True,
)
_top = {
    "Top_House_Delinquency_Rate": div0("TopHouse_PD30 + TopHouse_PD90", "Gross_Loans"),
    "Nonaccrual_to_Gross_Loans_Rate": div0("Total_Nonaccrual", "Gross_Loans"),
    "Allowance_to_Gross_Loans_Rate": div0("Total_ACL", "Gross_Loans"),
    "Risk_Adj_Allowance_Coverage": div0("Total_ACL", "Gross_Loans - SBL_Balance"),
    "SBL_Composition": div0("SBL_Balance", "Gross_Loans"),
    "Fund_Finance_Composition": div0("Fund_Finance_Balance", "Gross_Loans"),
    "CRE_Investment_Composition": div0("CRE_Investment_Pure_Balance", "Gross_Loans"),
    "Wealth_Resi_Composition": div0("Wealth_Resi_Balance", "Gross_Loans"),
    "Wealth_Resi_TTM_NCO_Rate": div0("RIC_Resi_NCO_TTM", "Wealth_Resi_Balance"),
    "Wealth_Resi_NA_Rate": div0("coalesce(NARERES, 0)", "Wealth_Resi_Balance"),
    "Wealth_Resi_Delinquency_Rate": div0("coalesce(P3RERES, 0) + coalesce(P9RERES, 0)", "Wealth_Resi_Balance"),
    "CRE_Concentration_Capital_Risk": div0("RIC_CRE_Cost", "RBCT1J"),
    "CI_to_Capital_Risk": div0("LNCI", "RBCT1J"),
    "Liquidity_Ratio": div0("Liquid_Assets", "Total_Assets_Used"),
    "HQLA_Ratio": div0("HQLA", "Total_Assets_Used"),
    "Cash_to_Assets": div0("Cash_and_Balances", "Total_Assets_Used"),
    "Securities_to_Assets": div0("Securities_HTM + Securities_AFS", "Total_Assets_Used"),
    "Loans_to_Deposits": div0("Gross_Loans", "Total_Deposits_Raw"),
    "Equity_to_Assets": div0("Total_Equity_Used", "Total_Assets_Used"),
    "Leverage_Ratio": div0("Total_Assets_Used", "Total_Equity_Used"),
    "Unused_Commitment_Ratio": div0("Unused_Commitments", "Gross_Loans"),
    "ROA_Raw": div0("Net_Income_Raw * 4.0 / quarter(REPDTE)", "Total_Assets_Used"),
    "ROE_Raw": div0("Net_Income_Q * 4", "Total_Equity_Used"),
    "NIM_Raw": div0("Net_Int_Income * 4.0 / quarter(REPDTE)", "Total_Assets_Used"),
    "Efficiency_Ratio_Raw": div0("Total_Nonint_Expense_Raw", "Total_Nonint_Income_Raw + Net_Int_Income"),
    "Yield_on_Loans_Raw": div0("Loan_Income_Ann", "Gross_Loans"),
    "Cost_of_Deposits_Raw": div0("Int_Exp_Deposits_Raw * 4.0 / quarter(REPDTE)", "Total_Deposits_Raw"),
    "Provision_to_Loans_Rate": div0("Provision_Exp_YTD * 4.0 / quarter(REPDTE)", "Gross_Loans"),
    "Loan_Yield_Proxy": div0("Loan_Income_Ann", "Gross_Loans"),
    "Provision_Elasticity": div0("Delta_Provision", "Delta_Nonaccrual"),
    "RIC_CRE_Conversion_Velocity": div0("Delta_CRE_Nonaccrual", "Lagged_CRE_Total_PD"),
    "Norm_NCO_Rate": div0("Norm_Total_NCO", "Norm_Gross_Loans"),
    "Norm_Nonaccrual_Rate": div0("Norm_Total_Nonaccrual", "Norm_Gross_Loans"),
    "Norm_Delinquency_Rate": div0("Norm_PD30 + Norm_PD90", "Norm_Gross_Loans"),
    "Norm_Exclusion_Pct": div0("Excluded_Balance", "Gross_Loans"),
    "Norm_SBL_Composition": div0("SBL_Balance", "Norm_Gross_Loans"),
    "Norm_Other_Composition": div0("Other_Balance", "Norm_Gross_Loans"),
    "Norm_CRE_Investment_Composition": div0("CRE_Investment_Pure_Balance", "Norm_Gross_Loans"),
    "Excluded_CRE_OO_Share_of_Norm": div0("CRE_OO_Balance", "Norm_Gross_Loans"),
    "Excluded_ADC_Share_of_Norm": div0("ADC_Balance", "Norm_Gross_Loans"),
    "Norm_Wealth_Resi_Composition": div0("Wealth_Resi_Balance", "Norm_Gross_Loans"),
    "Norm_CRE_ACL_Share": div0("RIC_CRE_ACL", "Norm_ACL_Balance"),
    "Norm_Resi_ACL_Share": div0("RIC_Resi_ACL", "Norm_ACL_Balance"),
    "Norm_Resi_ACL_Coverage": div0("RIC_Resi_ACL", "Wealth_Resi_Balance"),
    "Norm_CRE_ACL_Coverage": div0("RIC_CRE_ACL", "CRE_Investment_Pure_Balance"),
    "Norm_Comm_ACL_Coverage": div0("RIC_Comm_ACL", "CI_Balance"),
    "Norm_ACL_Coverage": div0("Norm_ACL_Balance", "Norm_Gross_Loans"),
    "Norm_Risk_Adj_Allowance_Coverage": div0("Norm_ACL_Balance", "Norm_Gross_Loans - SBL_Balance"),
    "Norm_Loan_Yield": div0("Loan_Income_Ann", "Norm_Gross_Loans"),
}
layer("d_ratio", "d_res", _top)
_sr = {}
for _n in SEGS:
    _p = f"RIC_{_n}"
    _late = f"{_p}_PD30 + {_p}_PD90"
    _aclsh, _lnsh = div0(f"{_p}_ACL", "RIC_Used_Total_ACL"), div0(f"{_p}_Cost", "RIC_Used_Total_Cost")
    _yrs = f"{_p}_ACL / nullif({_p}_NCO_TTM, 0)"
    _sr |= {
        f"{_p}_ACL_Coverage": div0(f"{_p}_ACL", f"{_p}_Cost"),
        f"{_p}_Risk_Adj_Coverage": f"case when {_p}_Nonaccrual > 0 then {_p}_ACL / nullif({_p}_Nonaccrual, 0) end",
        f"{_p}_Years_of_Reserves": f"case when {_p}_NCO_TTM > 0 then case when {_yrs} > 100 then 100.0 else {_yrs} end end",
        f"{_p}_NCO_Rate": div0(f"{_p}_NCO_TTM", f"{_p}_Cost"),
        f"{_p}_Nonaccrual_Rate": div0(f"{_p}_Nonaccrual", f"{_p}_Cost"),
        f"{_p}_Delinquency_Rate": div0(_late, f"{_p}_Cost"),
        f"{_p}_ACL_Efficiency": div0(f"{_p}_NCO_TTM", f"{_p}_ACL"),
        f"{_p}_Migration_Ratio": div0(_late, f"{_p}_Nonaccrual"),
        f"{_p}_ACL_Share": _aclsh,
        f"{_p}_Loan_Share": _lnsh,
        f"{_p}_Loss_Adj_Yield": f"Loan_Yield_Proxy - ({div0(f'{_p}_NCO_TTM', f'{_p}_Cost')})",
        f"{_p}_Alloc_Mismatch": f"({_aclsh}) - ({_lnsh})",
        f"{_p}_Risk_Mismatch": f"({_aclsh}) - ({div0(f'{_p}_Nonaccrual', 'Total_Nonaccrual')})",
    }
layer("d_segr", "d_ratio", _sr)
_share = {}
_have = {"CI", "RECONS", "CRCD", "REMULT", "RENROT", "RERES"}
for _h, _p in (("PD30", "P3"), ("PD90", "P9")):
    _share[f"x_{_h}_t"] = best(f"{_p}ASTOT")
    _share[f"x_{_h}_n"] = f"{best(f'{_p}ASTOT')} - ({best(f'{_p}CI')} + {best(f'{_p}RECONS')} + {best(f'{_p}CRCD')})"
    _share[f"x_{_h}_ADC"] = best(f"{_p}RECONS")
    _share[f"x_{_h}_CI"] = best(f"{_p}CI")
    _share[f"x_{_h}_Resi"] = best(f"{_p}RERES")
    _share[f"x_{_h}_CRE"] = f"{best(f'{_p}REMULT')} + {best(f'{_p}RENROT')}"
layer("d_shx", "d_segr", _share)
_sh = {}
for _s in normalize.SHARE_SEGMENTS:
    for _lab, _kind in (("", "t"), ("Norm_", "n")):
        for _h in ("PD30", "PD90"):
            _sh[f"{_lab}{_s}_Share_of_Total_{_h}"] = div0(f"x_{_h}_{_s}", f"x_{_h}_{_kind}")
        _sh[f"{_lab}{_s}_Share_of_Total_PD"] = div0(f"x_PD30_{_s} + x_PD90_{_s}", f"x_PD30_{_kind} + x_PD90_{_kind}")
_diff = "(Total_ACL - RIC_Calculated_ACL)"
layer(
    "derived",
    "d_shx",
    {
        **_sh,
        "Norm_Loss_Adj_Yield": "Norm_Loan_Yield - Norm_NCO_Rate",
        "Norm_Risk_Adj_Return": "Norm_Loan_Yield - Norm_Nonaccrual_Rate",
        "Norm_Fund_Finance_Composition": "0.0::double",
        "Group_CRE_ACL_Share": "RIC_CRE_ACL_Share + RIC_Constr_ACL_Share",
        "Group_Commercial_ACL_Share": "RIC_Comm_ACL_Share",
        "Group_Residential_ACL_Share": "RIC_Resi_ACL_Share",
        "Group_OtherSBL_ACL_Share": "RIC_OthCons_ACL_Share + RIC_Card_ACL_Share",
        "ACL_Integrity_Status": f"case when abs({div0(_diff, 'Total_ACL')}) < 0.05 then 'MATCH' when {_diff} > 0 then 'UNDER (Missing Segments?)' else 'OVER (Double Count?)' end",
        "ACL_Reg_Divergence": div0("Total_Reg_ACL - Total_ACL", "Total_ACL"),
        "TTM_NCO_Rate": f"sum(NTLNLS_Q) over {E4} / nullif(avg(LNLS) over {E4}, 0)",
        "Past_Due_Rate": f"avg((TopHouse_PD30 + TopHouse_PD90) / nullif(LNLS, 0)) over {E4}",
        "Total_Loans_Growth_TTM": sql_growth("LNLS"),
        "RIC_Resi_Best": "RIC_Resi_ACL",
        "RIC_Comm_Best": "RIC_Comm_ACL",
        "RIC_CommRE_Best": "RIC_CRE_ACL",
        "Total_Delinquency_Rate": "Top_House_Delinquency_Rate",
        "NPL_to_Gross_Loans_Rate": "Nonaccrual_to_Gross_Loans_Rate",
        "Total_Assets": "ASSET",
        "Net_Charge_Off_Rate": f"sum(NTLNLS_Q) over {E4} / nullif(avg(LNLS) over {E4}, 0)",
    },
    window=True,
)


def columns_of(source, columns):
    return with_ctes(f"select CERT, REPDTE, {', '.join(columns)} from {source}", source)


_pd30 = residual_sql("TopHouse_PD30", "Excluded_PD30")
_wide = residual_sql("TopHouse_PD30", "Excluded_PD30", 0.5)
_lc = list(normalize.LOSS_CATEGORIES)
_mx = "greatest(" + ", ".join(f"abs({c})" for c in _lc) + ")"
_total = " + ".join(f"abs({c})" for c in _lc)
ORACLES = {
    "resolve_codes": columns_of("d_codes", RESOLVED),
    "segment_mapping": columns_of("d_na", SEGMENT_COLUMNS),
    "segment_flows_ttm": columns_of("d_ttm", SEGMENT_FLOWS),
    "exclusion_balances": columns_of("d_ext", BALANCES),
    "exclusions_gated": columns_of("d_ext", LOSSES),
    "exclusion_quality": columns_of("d_ext", QUALITY),
    "excluded_ceiling": columns_of("d_cap", CEILING),
    "normalized_residual": with_ctes(
        f"""select CERT, REPDTE, {_pd30['value']} as value, {_pd30['severity']} as severity, {_wide['value']} as value_wide, {_wide['severity']} as severity_wide,
            {_pd30['residual']} as residual, {_pd30['flag']} as over_exclusion_flag, {_pd30['pct']} as over_exclusion_pct from d_cap""",
        "d_cap",
    ),
    "norm_diagnostics": with_ctes(f"select {', '.join(normalize.DIAGNOSTIC_COLUMNS)} from d_res", "d_res"),
    "reconciliation": with_ctes(
        """select CERT, REPDTE, Total_NCO_TTM, Excluded_NCO_TTM, Norm_Total_NCO, _Norm_NCO_Severity, Gross_Loans, Excluded_Balance, Norm_Gross_Loans,
           Excluded_NCO_TTM + Norm_Total_NCO - Total_NCO_TTM as NCO_Check_ExclPlusNormMinusTotal, Excluded_NCO_TTM > Total_NCO_TTM as NCO_Flag_Excl_GT_Total,
           Excluded_Balance + Norm_Gross_Loans - Gross_Loans as Loans_Check_ExclPlusNormMinusTotal, Excluded_Balance > Gross_Loans as Loans_Flag_Excl_GT_Total
           from d_res where REPDTE = (select max(REPDTE) from d_res)""",
        "d_res",
    ),
    "exclusion_audit": with_ctes(
        f"""select CERT, REPDTE, {' or '.join(f'_{k}_NCO_Gated' for k in CATS if k != 'NDFI')} as category_balance_zero_but_nco_nonzero_flag,
            case {' '.join(f"when abs({c}) = {_mx} then '{n}'" for c, n in normalize.LOSS_CATEGORIES.items())} end as dominant_exclusion_category,
            {_mx} / nullif({_total}, 0) as dominant_exclusion_share from d_ext""",
        "d_ext",
    ),
    "panel_totals": columns_of("derived", TOTALS),
    "top_ratios": columns_of("d_ratio", codes(ratios.TOP_RATIOS)),
    "capital_ratios": columns_of("d_ratio", codes(ratios.CAPITAL_RATIOS)),
    "capital_ratios_with_allowance": with_ctes(
        """select CERT, REPDTE, coalesce(RIC_CRE_Cost * 100.0 / nullif(coalesce(RBCT1J, 0.0) + Total_ACL, 0), 0.0) as CRE_Concentration_Capital_Risk,
           coalesce(LNCI * 100.0 / nullif(coalesce(RBCT1J, 0.0) + Total_Reg_ACL, 0), 0.0) as CI_to_Capital_Risk from d_tot""",
        "d_tot",
    ),
    "npl_and_equity_mix": with_ctes(
        """select CERT, REPDTE, round(coalesce(RB2LNRES, 0) - coalesce(LNATRES, 0), 9) as AOBS, round(kept, 9) as Net_Retained_Earnings,
           round(coalesce(due / nullif(loans, 0), 0.0), 9) as Total_Past_Due_to_Book, round(coalesce(npl / nullif(loans, 0), 0.0), 9) as NPL_to_Gross_Loans_Rate,
           round(coalesce(npl / nullif(due, 0), 0.0), 9) as NPL_to_Past_Due, round(coalesce(npl / nullif(coalesce(Total_ACL, 0), 0), 0.0), 9) as NPL_to_ACL,
           round(coalesce(CHBAL * 100.0 / nullif(EQ, 0), 0.0), 9) as Common_Stock_Pct, round(coalesce(CHBALNI * 100.0 / nullif(EQ, 0), 0.0), 9) as EQSUR_Pct,
           round(coalesce(RCON1754 * 100.0 / nullif(EQ, 0), 0.0), 9) as Preferred_Stock_Pct, round(coalesce(kept * 100.0 / nullif(EQ, 0), 0.0), 9) as Retained_Earnings_Pct
           from (select *, coalesce(LNLS, 0.0) as loans, coalesce(TopHouse_PD30, 0.0) + coalesce(TopHouse_PD90, 0.0) as due,
                 coalesce(Total_Nonaccrual + TopHouse_PD90, 0.0) as npl, coalesce(RCON1773, 0.0) - coalesce(RBCT1J, 0.0) as kept from d_tot)""",
        "d_tot",
    ),
    "liquidity_ratios": columns_of("d_ratio", codes(ratios.LIQUIDITY_RATIOS)),
    "profit_ratios": columns_of("d_ratio", codes(ratios.PROFIT_RATIOS)),
    "normalized_ratios": columns_of("d_ratio", [*codes(ratios.NORM_RATIOS), "Norm_ACL_Balance"]),
    "normalized_yields": columns_of("derived", YIELDS),
    "segment_ratios": columns_of("d_segr", SEGMENT_RATIOS),
    "contribution_shares": columns_of("derived", SHARES),
    "group_shares": columns_of("derived", GROUPS),
    "report_aliases": columns_of("derived", ALIASED),
}
