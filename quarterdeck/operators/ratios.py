"""Ratio library: totals, then a table of quotients with an explicit zero rule each."""

from __future__ import annotations

from typing import Iterable, NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from quarterdeck.functions.missing import best_of, first_non_null, ratio, sum_cols
from quarterdeck.operators.flows import annualize_ytd, delta, discrete_flow, lagged
from quarterdeck.operators.normalize import SEGMENTS, normalized_allowance, parts_else_summary

# Candidate codes of raw totals.
TOTAL_CODES = {
    "SBL_Balance": ["RCFD1545", "RCON1545"],
    "Fund_Finance_Balance": ["RCFDJ454", "RCONJ454"],
    "ADC_Balance": ["LNRECONS"],
    "CRE_OO_Balance": ["LNRENROW"],
    "RIC_Unalloc_ACL": ["RCFDJJ22", "RCONJJ22"],
    "Cash_and_Balances": ["CHBAL", "RCFD0010", "RCON0010"],
    "Fed_Funds_Sold": ["CHBALNI", "RCFD0081", "RCON0081"],
    "Securities_HTM": ["HTM_Securities"],
    "Securities_AFS": ["AFS_Securities"],
    "Trading_Assets": ["TRD", "RCFD3545", "RCON3545"],
    "Total_Assets_Raw": ["ASSET", "RCFD2170"],
    "Total_Equity_Raw": ["EQ", "RCFD3210"],
    "Total_Deposits_Raw": ["DEP", "RCFD2200"],
    "Net_Income_Raw": ["NETINC", "RIAD4340"],
    "Total_Int_Income_Raw": ["INTINC", "RIAD4107"],
    "Total_Int_Expense_Raw": ["INTEXP", "RIAD4073"],
    "Total_Nonint_Income_Raw": ["NONII", "RIAD4079"],
    "Total_Nonint_Expense_Raw": ["NONIX", "RIAD4093"],
    "Int_Inc_Loans_Raw": ["ILNDOM", "RIAD4010"],
    "Int_Exp_Deposits_Raw": ["RIAD4115", "EDEPDOM"],
    "Unused_Commitments": ["Unused_Commitments_Total"],
    "Provision_Exp_YTD": ["ELNATR"],
    "CI_Balance": ["LNCI", "RCON1763", "RCFD1763"],
}


def add_totals(df: DataFrame) -> DataFrame:
    """Totals and denominators, each with its fallback when the reported total is not positive."""
    have = set(df.columns)
    out: dict[str, Column] = {name: best_of(have, codes) for name, codes in TOTAL_CODES.items()}
    out["CRE_Investment_Pure_Balance"] = best_of(have, ["LNREMULT"]) + best_of(have, ["LNRENROT"])
    out["Other_Balance"] = best_of(have, ["RCFDJ451", "RCONJ451"]) + sum_cols(have, ["RCFDF162", "RCFDF163"])
    out["Total_ACL"] = sum_cols(have, ["LNATRES"])
    out["Total_Reg_ACL"] = sum_cols(have, ["RB2LNRES"])
    out["Gross_Loans"] = first_non_null(have, ["LNLS"], None)
    out["Wealth_Resi_Balance"] = F.greatest(
        parts_else_summary(have, [["RCON1797", "RCFD1797"], ["RCON5367", "RCFD5367"], ["RCON5368", "RCFD5368"]], ["LNRERES"]),
        F.lit(0.0),
    )
    rcc = ["RCFD1797", "RCON1797", "RCFD5367", "RCON5367", "RCFD5368", "RCON5368"]
    out["_audit_resi_balance_fallback_used"] = sum_cols(have, rcc) == 0
    out["Norm_ACL_Balance"] = normalized_allowance(have)
    out["Int_Inc_Loans_YTD"] = sum_cols(have, ["ILNDOM", "ILNFOR"])
    staged = df.withColumns(out)
    names = list(SEGMENTS)
    staged = staged.withColumns(
        {
            "RIC_Calculated_ACL": sum_cols(have, [f"RIC_{s}_ACL" for s in names]) + F.col("RIC_Unalloc_ACL"),
            "RIC_Calculated_Cost": sum_cols(have, [f"RIC_{s}_Cost" for s in names]),
            "Liquid_Assets": F.expr("Cash_and_Balances + Fed_Funds_Sold + Securities_AFS"),
            "HQLA": F.expr("Cash_and_Balances + Fed_Funds_Sold + Securities_HTM + Securities_AFS"),
            "Total_Assets_Used": F.when(F.col("Total_Assets_Raw") > 0, F.col("Total_Assets_Raw")).otherwise(
                first_non_null(have, ["ASSET"], 1.0)
            ),
            "Total_Equity_Used": F.when(F.col("Total_Equity_Raw") > 0, F.col("Total_Equity_Raw")).otherwise(
                first_non_null(have, ["EQ"], 1.0)
            ),
        }
    )
    return staged.withColumns(
        {
            "RIC_Used_Total_ACL": F.expr("case when Total_ACL > 0 then Total_ACL else RIC_Calculated_ACL end"),
            "RIC_Used_Total_Cost": F.expr("case when Gross_Loans > 0 then Gross_Loans else RIC_Calculated_Cost end"),
            "RIC_Used_Total_NA": F.col("Total_Nonaccrual"),
        }
    )


def add_velocity_inputs(df: DataFrame) -> DataFrame:
    """Changes and lags the velocity ratios need, and annualised income-statement flows."""
    staged = df.withColumns(
        {"Provision_Exp_Q": discrete_flow("Provision_Exp_YTD"), "Net_Income_Q": discrete_flow("Net_Income_Raw")}
    )
    return staged.withColumns(
        {
            "Delta_Nonaccrual": delta("Total_Nonaccrual"),
            "Delta_Provision": delta("Provision_Exp_Q"),
            "Delta_CRE_Nonaccrual": delta("RIC_CRE_Nonaccrual"),
            "Lagged_CRE_Total_PD": lagged(F.col("RIC_CRE_PD30") + F.col("RIC_CRE_PD90")),
            "Provision_Ann": annualize_ytd(staged, "Provision_Exp_YTD"),
            "Int_Inc_Loans_Ann": annualize_ytd(staged, "Int_Inc_Loans_YTD"),
            "Net_Income_Ann": annualize_ytd(staged, "Net_Income_Raw"),
            "Net_Int_Income_YTD": F.expr("Total_Int_Income_Raw - Total_Int_Expense_Raw"),
            "Int_Exp_Deposits_Ann": annualize_ytd(staged, "Int_Exp_Deposits_Raw"),
            "Loan_Income_Ann": annualize_ytd(staged, "Int_Inc_Loans_Raw"),
        }
    )


class Ratio(NamedTuple):
    """A quotient of two SQL expressions. ``policy`` names the zero rule in ``missing.RATIO_POLICIES``."""

    code: str
    num: str
    den: str
    policy: str = "zero"


# Formulas of the published ratios.
TOP_RATIOS = [
    Ratio("Top_House_Delinquency_Rate", "TopHouse_PD30 + TopHouse_PD90", "Gross_Loans"),
    Ratio("Nonaccrual_to_Gross_Loans_Rate", "Total_Nonaccrual", "Gross_Loans"),
    Ratio("Allowance_to_Gross_Loans_Rate", "Total_ACL", "Gross_Loans"),
    Ratio("Risk_Adj_Allowance_Coverage", "Total_ACL", "Gross_Loans - SBL_Balance"),
    Ratio("SBL_Composition", "SBL_Balance", "Gross_Loans"),
    Ratio("Fund_Finance_Composition", "Fund_Finance_Balance", "Gross_Loans"),
    Ratio("CRE_Investment_Composition", "CRE_Investment_Pure_Balance", "Gross_Loans"),
    Ratio("Wealth_Resi_Composition", "Wealth_Resi_Balance", "Gross_Loans"),
    Ratio("Wealth_Resi_TTM_NCO_Rate", "RIC_Resi_NCO_TTM", "Wealth_Resi_Balance"),
    Ratio("Wealth_Resi_NA_Rate", "RIC_Resi_Nonaccrual", "Wealth_Resi_Balance"),
    Ratio("Wealth_Resi_Delinquency_Rate", "RIC_Resi_PD30 + RIC_Resi_PD90", "Wealth_Resi_Balance"),
]
CAPITAL_RATIOS = [
    Ratio("CRE_Concentration_Capital_Risk", "RIC_CRE_Cost", "RBCT1J"),
    Ratio("CI_to_Capital_Risk", "LNCI", "RBCT1J"),
]
# Older denominators: tier 1 plus allowance, and total capital, in percent.
CAPITAL_RATIOS_WITH_ALLOWANCE = [
    Ratio("CRE_Concentration_Capital_Risk", "RIC_CRE_Cost * 100.0", "coalesce(RBCT1J, 0.0) + Total_ACL", "fill"),
    Ratio("CI_to_Capital_Risk", "LNCI * 100.0", "coalesce(RBCT1J, 0.0) + Total_Reg_ACL", "fill"),
]
LIQUIDITY_RATIOS = [
    Ratio("Liquidity_Ratio", "Liquid_Assets", "Total_Assets_Used"),
    Ratio("HQLA_Ratio", "HQLA", "Total_Assets_Used"),
    Ratio("Cash_to_Assets", "Cash_and_Balances", "Total_Assets_Used"),
    Ratio("Securities_to_Assets", "Securities_HTM + Securities_AFS", "Total_Assets_Used"),
    Ratio("Loans_to_Deposits", "Gross_Loans", "Total_Deposits_Raw"),
    Ratio("Equity_to_Assets", "Total_Equity_Used", "Total_Assets_Used"),
    Ratio("Leverage_Ratio", "Total_Assets_Used", "Total_Equity_Used"),
    Ratio("Unused_Commitment_Ratio", "Unused_Commitments", "Gross_Loans"),
]
PROFIT_RATIOS = [
    Ratio("ROA_Raw", "Net_Income_Ann", "Total_Assets_Used"),
    Ratio("ROE_Raw", "Net_Income_Q * 4", "Total_Equity_Used"),
    Ratio("NIM_Raw", "Net_Int_Income_YTD * 4.0 / quarter(REPDTE)", "Total_Assets_Used"),
    Ratio("Efficiency_Ratio_Raw", "Total_Nonint_Expense_Raw", "Total_Nonint_Income_Raw + Net_Int_Income_YTD"),
    Ratio("Yield_on_Loans_Raw", "Loan_Income_Ann", "Gross_Loans"),
    Ratio("Cost_of_Deposits_Raw", "Int_Exp_Deposits_Ann", "Total_Deposits_Raw"),
    Ratio("Provision_to_Loans_Rate", "Provision_Ann", "Gross_Loans"),
    Ratio("Loan_Yield_Proxy", "Int_Inc_Loans_Ann", "Gross_Loans"),
    Ratio("Provision_Elasticity", "Delta_Provision", "Delta_Nonaccrual"),
    Ratio("RIC_CRE_Conversion_Velocity", "Delta_CRE_Nonaccrual", "Lagged_CRE_Total_PD"),
]
# Over filled inputs, so that only a zero denominator is left to decide.
NPL_RATIOS = [
    Ratio("Total_Past_Due_to_Book", "_past_due", "_loans"),
    Ratio("NPL_to_Gross_Loans_Rate", "_npl", "_loans"),
    Ratio("NPL_to_Past_Due", "_npl", "_past_due"),
    Ratio("NPL_to_ACL", "_npl", "_acl"),
]
EQUITY_SHARES = [
    Ratio("Common_Stock_Pct", "_common * 100.0", "_equity"),
    Ratio("EQSUR_Pct", "_surplus * 100.0", "_equity"),
    Ratio("Preferred_Stock_Pct", "_preferred * 100.0", "_equity"),
    Ratio("Retained_Earnings_Pct", "Net_Retained_Earnings * 100.0", "_equity"),
]
NORM_RATIOS = [
    Ratio("Norm_NCO_Rate", "Norm_Total_NCO", "Norm_Gross_Loans"),
    Ratio("Norm_Nonaccrual_Rate", "Norm_Total_Nonaccrual", "Norm_Gross_Loans"),
    Ratio("Norm_Delinquency_Rate", "Norm_PD30 + Norm_PD90", "Norm_Gross_Loans"),
    Ratio("Norm_Exclusion_Pct", "Excluded_Balance", "Gross_Loans"),
    Ratio("Norm_SBL_Composition", "SBL_Balance", "Norm_Gross_Loans"),
    Ratio("Norm_Other_Composition", "Other_Balance", "Norm_Gross_Loans"),
    Ratio("Norm_CRE_Investment_Composition", "CRE_Investment_Pure_Balance", "Norm_Gross_Loans"),
    Ratio("Excluded_CRE_OO_Share_of_Norm", "CRE_OO_Balance", "Norm_Gross_Loans"),
    Ratio("Excluded_ADC_Share_of_Norm", "ADC_Balance", "Norm_Gross_Loans"),
    Ratio("Norm_Wealth_Resi_Composition", "Wealth_Resi_Balance", "Norm_Gross_Loans"),
    Ratio("Norm_CRE_ACL_Share", "RIC_CRE_ACL", "Norm_ACL_Balance"),
    Ratio("Norm_Resi_ACL_Share", "RIC_Resi_ACL", "Norm_ACL_Balance"),
    Ratio("Norm_Resi_ACL_Coverage", "RIC_Resi_ACL", "Wealth_Resi_Balance"),
    Ratio("Norm_CRE_ACL_Coverage", "RIC_CRE_ACL", "CRE_Investment_Pure_Balance"),
    Ratio("Norm_Comm_ACL_Coverage", "RIC_Comm_ACL", "CI_Balance"),
    Ratio("Norm_ACL_Coverage", "Norm_ACL_Balance", "Norm_Gross_Loans"),
    Ratio("Norm_Risk_Adj_Allowance_Coverage", "Norm_ACL_Balance", "Norm_Gross_Loans - SBL_Balance"),
    Ratio("Norm_Loan_Yield", "Int_Inc_Loans_Ann", "Norm_Gross_Loans"),
]


def quotient(spec: Ratio) -> Column:
    return ratio(spec.num, spec.den, spec.policy)


def apply_ratios(df: DataFrame, specs: Iterable[Ratio]) -> DataFrame:
    """All quotients in one projection."""
    return df.withColumns({s.code: quotient(s) for s in specs})


def npl_and_equity_mix(df: DataFrame) -> DataFrame:
    """Noncurrent loans to loans, past due and allowance, off-balance allowance, and parts of equity in percent of it.

    Absent columns and NULLs count as 0; a quotient over 0 is 0.
    """
    have = set(df.columns)
    total = lambda *codes: sum_cols(have, codes)
    inputs = {
        "_loans": total("LNLS"), "_past_due": total("P3LNLS", "P9LNLS"), "_npl": total("NCLNLS"), "_acl": total("Total_ACL"),
        "_equity": total("EQ"), "_common": total("EQCS"), "_surplus": total("EQSUR"), "_preferred": total("EQPP"),
    }
    made = {"AOBS": total("RB2LNRES") - total("LNATRES"), "Net_Retained_Earnings": total("EQUP") - total("EQCCOMPI")}
    return apply_ratios(df.withColumns({**inputs, **made}), [*NPL_RATIOS, *EQUITY_SHARES]).drop(*inputs)


def normalized_yields(df: DataFrame) -> DataFrame:
    """Yields after losses on the normalised book; two outputs are fixed by design."""
    return df.withColumns(
        {
            "Norm_Loss_Adj_Yield": F.expr("Norm_Loan_Yield - Norm_NCO_Rate"),
            "Norm_Risk_Adj_Return": F.expr("Norm_Loan_Yield - Norm_Nonaccrual_Rate"),
            "Norm_Fund_Finance_Composition": F.lit(0.0),
            "Norm_Provision_Rate": F.lit(None).cast("double"),
        }
    )


def segment_specs(seg: str) -> list[Ratio]:
    """Quotients of one segment. Coverage of nonaccruals and years of reserves are undefined, not 0, at zero."""
    p = f"RIC_{seg}"
    late = f"{p}_PD30 + {p}_PD90"
    return [
        Ratio(f"{p}_ACL_Coverage", f"{p}_ACL", f"{p}_Cost"),
        Ratio(f"{p}_Risk_Adj_Coverage", f"{p}_ACL", f"{p}_Nonaccrual", "positive"),
        Ratio(f"{p}_Years_of_Reserves", f"{p}_ACL", f"{p}_NCO_TTM", "positive"),
        Ratio(f"{p}_NCO_Rate", f"{p}_NCO_TTM", f"{p}_Cost"),
        Ratio(f"{p}_Nonaccrual_Rate", f"{p}_Nonaccrual", f"{p}_Cost"),
        Ratio(f"{p}_Delinquency_Rate", late, f"{p}_Cost"),
        Ratio(f"{p}_ACL_Efficiency", f"{p}_NCO_TTM", f"{p}_ACL"),
        Ratio(f"{p}_Migration_Ratio", late, f"{p}_Nonaccrual"),
        Ratio(f"{p}_ACL_Share", f"{p}_ACL", "RIC_Used_Total_ACL"),
        Ratio(f"{p}_Loan_Share", f"{p}_Cost", "RIC_Used_Total_Cost"),
        Ratio(f"_{p}_NA_Share", f"{p}_Nonaccrual", "RIC_Used_Total_NA"),
    ]


def segment_ratios(df: DataFrame, segments: Iterable[str] = tuple(SEGMENTS)) -> DataFrame:
    segments = list(segments)
    first = apply_ratios(df, [s for seg in segments for s in segment_specs(seg)])
    second = {}
    for seg in segments:
        p = f"RIC_{seg}"
        # least() would turn NULL into the cap
        years = f"{p}_Years_of_Reserves"
        second[years] = F.expr(f"CASE WHEN {years} > 100 THEN 100D ELSE {years} END")
        second[f"{p}_Loss_Adj_Yield"] = F.expr(f"Loan_Yield_Proxy - {p}_NCO_Rate")
        second[f"{p}_Alloc_Mismatch"] = F.expr(f"{p}_ACL_Share - {p}_Loan_Share")
        second[f"{p}_Risk_Mismatch"] = F.expr(f"{p}_ACL_Share - _{p}_NA_Share")
    return first.withColumns(second).drop(*[f"_RIC_{seg}_NA_Share" for seg in segments])


def group_shares(df: DataFrame, composite: str = "is_composite") -> DataFrame:
    """Grouped allowance shares, allowance integrity and divergence from the regulatory figure.

    Rows whose ``composite`` column is true are averages without a benchmark; without that column every row is an entity's.
    """
    staged = df.withColumn("_diff", F.expr("Total_ACL - RIC_Calculated_ACL"))
    pct = ratio("_diff", "Total_ACL")
    average = F.coalesce(F.col(composite), F.lit(False)) if composite in df.columns else F.lit(False)
    status = (
        F.when(average, "NO_BENCHMARK")
        .when(F.abs(pct) < 0.05, "MATCH")
        .when(F.col("_diff") > 0, "UNDER (Missing Segments?)")
        .otherwise("OVER (Double Count?)")
    )
    return staged.withColumns(
        {
            "Group_CRE_ACL_Share": F.expr("RIC_CRE_ACL_Share + RIC_Constr_ACL_Share"),
            "Group_Commercial_ACL_Share": F.col("RIC_Comm_ACL_Share"),
            "Group_Residential_ACL_Share": F.col("RIC_Resi_ACL_Share"),
            "Group_OtherSBL_ACL_Share": F.expr("RIC_OthCons_ACL_Share + RIC_Card_ACL_Share"),
            "ACL_Integrity_Status": status,
            "ACL_Reg_Divergence": ratio("Total_Reg_ACL - Total_ACL", "Total_ACL"),
        }
    ).drop("_diff")


# Names older reports ask for.
ALIASES = {
    "RIC_Resi_Best": "RIC_Resi_ACL",
    "RIC_Comm_Best": "RIC_Comm_ACL",
    "RIC_CommRE_Best": "RIC_CRE_ACL",
    "Total_Delinquency_Rate": "Top_House_Delinquency_Rate",
    "NPL_to_Gross_Loans_Rate": "Nonaccrual_to_Gross_Loans_Rate",
    "Tier_1_Leverage_Ratio": "RCFD7204",
    "Total_Assets": "ASSET",
    "Net_Charge_Off_Rate": "TTM_NCO_Rate",
}


def add_aliases(df: DataFrame, aliases: dict[str, str] = ALIASES) -> DataFrame:
    have = set(df.columns)
    return df.withColumns(
        {new: F.col(old) if old in have else F.lit(None).cast("double") for new, old in aliases.items()}
    )
