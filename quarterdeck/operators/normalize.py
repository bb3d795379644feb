"""Stripping chosen segments out of a bank panel (the "normalised" view).

Order matters: map codes, sum exclusions, turn excluded losses into trailing-year
amounts, cap them at the total, then take the residual and classify it.
"""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from quarterdeck.functions.missing import best_of, first_non_null, present, ratio, sum_cols
from quarterdeck.operators.flows import discrete_flow, rolling_sum

# Public call-report codes, consolidated before domestic.
CODE_PAIRS = {
    "HTM_Securities": ["RCFD1754", "RCON1754"],
    "AFS_Securities": ["RCFD1773", "RCON1773"],
    "Unused_Commitments_Total": ["RCFD3423", "RCON3423"],
    "Unused_Commitments_HELOC": ["RCFD3814", "RCON3814"],
    "Unused_Commitments_NonRE": ["RCFD6550", "RCON6550"],
}
SYNTHETIC_FIELDS = {
    "LNOTHPCS": ["RCFD1545", "RCON1545", "LNOTHER"],
    "LNOTHNONDEP": ["RCFDJ454", "RCONJ454"],
    "LNCONAUTO": ["LNAUTO"],
    "LNCONCC": ["LNCRCD"],
}
SPARSE_FIELDS = ["RCONJ454", "RCFDJ454"]

# Per segment the candidate codes of each measure.
SEGMENTS = {
    "Constr": {"cost": ["RCFDJJ04", "RCONJJ04"], "acl": ["RCFDJJ12", "RCONJJ12"], "sum": ["RECONS"], "nco": ["NTRECONS"]},
    "CRE": {"cost": ["RCFDJJ05", "RCONJJ05"], "acl": ["RCFDJJ13", "RCONJJ13"], "sum": None, "nco": None},
    "Resi": {"cost": None, "acl": ["RCFDJJ14", "RCONJJ14"], "sum": ["RERES", "RELOC"], "nco": ["NTRERES", "NTRELOC"]},
    "Comm": {"cost": ["RCFDJJ07", "RCONJJ07"], "acl": ["RCFDJJ15", "RCONJJ15"], "sum": ["CI"], "nco": ["NTCI"]},
    "Card": {"cost": ["RCFDJJ08", "RCONJJ08"], "acl": ["RCFDJJ16", "RCONJJ16"], "sum": ["CRCD"], "nco": ["NTCRCD"]},
    "OthCons": {"cost": ["RCFDJJ09", "RCONJJ09"], "acl": ["RCFDJJ17", "RCONJJ17"], "sum": ["AUTO", "CONOTH"], "nco": ["NTCONOTH", "NTAUTO"]},
}
STACK_PREFIXES = {"Nonaccrual": "NA", "PD30": "P3", "PD90": "P9"}
RESI_PARTS = [["RCON1797", "RCFD1797"], ["RCON5367", "RCFD5367"], ["RCON5368", "RCFD5368"]]

# Audit flags of every row: for the NDFI category no code tells past due and nonaccrual balances, or losses.
UNSUPPORTED = ["_audit_unsupported_ndfi_pdna", "_audit_ndfi_nco_unsupported"]
# Excluded categories and the codes of their measures.
EXCLUSIONS = {
    "CI": {"balance": ["LNCI", "RCON1763", "RCFD1763"], "nco": ["NTCI", "RIAD4638"], "na": ["NACI", "RCON1608", "RCFD1608"], "p3": ["P3CI", "RCON1606", "RCFD1606"], "p9": ["P9CI", "RCON1607", "RCFD1607"]},
    "NDFI": {"balance": ["RCONJ454", "RCFDJ454"]},
    "ADC": {"balance": ["LNRECONS", "RCON1420", "RCFD1420"], "charge": ["RIAD3582"], "recover": ["RIAD3583"], "nco": ["NTRECONS"], "na": ["NARECONS", "RCON3492", "RCFD3492"], "p3": ["P3RECONS", "RCON2759", "RCFD2759"], "p9": ["P9RECONS", "RCON2769", "RCFD2769"]},
    "CC": {"balance": ["RIC_Card_Cost", "RCFDB538", "RCONB538"], "charge": ["RIADB514"], "recover": ["RIADB515"], "na": ["RCFDB575", "RCONB575"], "p3": ["P3CRCD", "RCFDB572"], "p9": ["P9CRCD", "RCFDB573"]},
    "Auto": {"balance": ["LNAUTO", "RCFDK137", "RCONK137"], "charge": ["RIADK205"], "recover": ["RIADK206"], "na": ["RCFDK213", "RCONK213"], "p3": ["P3AUTO", "RCFDK214"], "p9": ["P9AUTO", "RCFDK215"]},
    "Ag": {"balance": ["LNAG", "RCFD1590", "RCON1590"], "charge": ["RIAD4655"], "recover": ["RIAD4665"], "nco": ["NTAG", "NTREAG"], "na": ["RCFD5341", "RCON5341", "NAAG"], "p3": ["RCON1594", "RCFD1594", "P3AG", "P3AGR"], "p9": ["RCON1597", "RCFD1597", "P9AG", "P9AGR"]},
    "OO_CRE": {"balance": ["LNRENROW"], "nco": ["NTRENROW"], "na": ["NARENROW"], "p3": ["P3RENROW"], "p9": ["P9RENROW"]},
}
BALANCE_NAMES = {"CC": "Excl_CreditCard_Balance"}


def balance_name(category: str) -> str:
    return BALANCE_NAMES.get(category, f"Excl_{category}_Balance")


def resolve_codes(df: DataFrame) -> DataFrame:
    """Consolidated-else-domestic fields, synthetic fields and the residual consumer balance."""
    have = set(df.columns)
    out: dict[str, Column] = {
        name: first_non_null(have, codes, None) for name, codes in CODE_PAIRS.items() if have & set(codes)
    }
    out |= {c: F.coalesce(F.col(c), F.lit(0.0)) for c in SPARSE_FIELDS if c in have}
    out |= {name: first_non_null(have, codes) for name, codes in SYNTHETIC_FIELDS.items()}
    rest = sum_cols(have, ["LNCON"]) - sum_cols(have, ["LNAUTO"]) - sum_cols(have, ["LNCRCD"])
    out["LNCONOTHX"] = F.greatest(rest, F.lit(0.0))
    return df.withColumns(out)


def resolved_stack(have: set[str], prefix: str, suffix: str = "") -> Column:
    """Multifamily plus the larger of the reported total and its owner-occupied parts."""
    mf, row, res, rot = (
        sum_cols(have, [f"{prefix}{code}{suffix}"]) for code in ("REMULT", "RENROW", "RENRES", "RENROT")
    )
    return mf + F.greatest(rot, row + res)


def parts_else_summary(have: set[str], parts: Sequence[Sequence[str]], summary: Sequence[str]) -> Column:
    """Sum of granular parts where positive, else the summary line; decided per row."""
    total = reduce(lambda a, b: a + b, [best_of(have, p) for p in parts])
    return F.when(total > 0, total).otherwise(best_of(have, summary))


def map_segments(df: DataFrame) -> DataFrame:
    """Cost, allowance, nonaccrual and past-due balances of the six segments, and their totals."""
    have = set(df.columns)
    out: dict[str, Column] = {}
    for name, codes in SEGMENTS.items():
        cost = best_of(have, codes["cost"]) if codes["cost"] else parts_else_summary(have, RESI_PARTS, ["LNRERES"])
        out[f"RIC_{name}_Cost"] = cost
        out[f"RIC_{name}_ACL"] = best_of(have, codes["acl"])
        for measure, prefix in STACK_PREFIXES.items():
            if codes["sum"] is None:
                out[f"RIC_{name}_{measure}"] = resolved_stack(have, prefix)
            else:
                out[f"RIC_{name}_{measure}"] = sum_cols(have, [prefix + c for c in codes["sum"]])
    for measure, prefix in STACK_PREFIXES.items():
        out[f"RIC_CRE_Inv_{measure}"] = sum_cols(have, [f"{prefix}REMULT", f"{prefix}RENROT"])
        out[f"RIC_CRE_OO_{measure}"] = sum_cols(have, [f"{prefix}RENROW", f"{prefix}RENRES"])
    out["TopHouse_PD30"] = best_of(have, ["P3LNLS"])
    out["TopHouse_PD90"] = best_of(have, ["P9LNLS"])
    mapped = df.withColumns(out)
    segments = [f"RIC_{name}_Nonaccrual" for name in SEGMENTS]
    return mapped.withColumn(
        "Total_Nonaccrual", sum_cols({*have, *out}, [*segments, "NAREAG", "NAAG", "NALS", "NAOTHLN"])
    )


FLOW_COLUMNS = [
    "NTLNLS", "NTCI", "NTRECONS", "NTREMULT", "NTRENROW", "NTRENROT", "NTRENRES",
    "NTRERES", "NTRELOC", "NTCRCD", "NTAUTO", "NTCONOTH",
]


def segment_flows(df: DataFrame) -> DataFrame:
    """Quarterly and trailing-year net losses per segment and in total, from year-to-date columns."""
    have = set(df.columns)
    quarterly = df.withColumns(
        {f"{c}_Q": discrete_flow(c) if c in have else F.lit(0.0) for c in FLOW_COLUMNS}
    )
    have |= {f"{c}_Q" for c in FLOW_COLUMNS}
    seg: dict[str, Column] = {"RIC_CRE_NCO_Q": resolved_stack(have, "NT", "_Q")}
    for name, codes in SEGMENTS.items():
        if codes["nco"]:
            seg[f"RIC_{name}_NCO_Q"] = sum_cols(have, [f"{c}_Q" for c in codes["nco"]])
    quarterly = quarterly.withColumns(seg)
    ttm = {f"RIC_{name}_NCO_TTM": rolling_sum(f"RIC_{name}_NCO_Q") for name in SEGMENTS}
    ttm["Total_NCO_TTM"] = rolling_sum("NTLNLS_Q")
    return quarterly.withColumns(ttm)


def exclusion_balances(df: DataFrame, exclusions: Mapping[str, Mapping] = EXCLUSIONS) -> DataFrame:
    have = set(df.columns)
    out = {balance_name(k): best_of(have, codes["balance"]) for k, codes in exclusions.items()}
    if "CI" in exclusions:
        out[balance_name("CI")] = F.greatest(out[balance_name("CI")], F.lit(0.0))
    return df.withColumns(out)


def exclusion_losses(df: DataFrame, exclusions: Mapping[str, Mapping] = EXCLUSIONS) -> DataFrame:
    """Year-to-date losses per category, 0 without a balance, and the flag that says so."""
    have = set(df.columns)
    raw: dict[str, Column] = {}
    for k, codes in exclusions.items():
        loss = best_of(have, codes.get("nco", []))
        if codes.get("charge"):
            net = best_of(have, codes["charge"]) - best_of(have, codes["recover"])
            loss = F.when(net != 0, net).otherwise(loss)
        raw[f"_raw_{k}"] = loss
    out: dict[str, Column] = {}
    for k, codes in exclusions.items():
        balance, loss = F.col(balance_name(k)), F.col(f"_raw_{k}")
        out[f"Excl_{k}_NCO_YTD"] = F.when(balance > 0, loss).otherwise(F.lit(0.0))
        if len(codes) > 1:
            out[f"_{k}_NCO_Gated"] = (balance == 0) & (loss != 0)
    if "NDFI" in exclusions:
        out |= {flag: F.lit(True) for flag in UNSUPPORTED}
    return df.withColumns(raw).withColumns(out).drop(*raw)


def exclusion_quality(df: DataFrame, exclusions: Mapping[str, Mapping] = EXCLUSIONS) -> DataFrame:
    """Nonaccrual and past-due balances per category."""
    have = set(df.columns)
    return df.withColumns(
        {
            f"Excl_{k}_{measure.upper()}": best_of(have, codes.get(measure, []))
            for k, codes in exclusions.items()
            for measure in ("na", "p3", "p9")
        }
    )


def exclusion_totals(df: DataFrame, exclusions: Mapping[str, Mapping] = EXCLUSIONS) -> DataFrame:
    """Sums over the categories; NULL counts as 0."""
    have = set(df.columns)
    return df.withColumns(
        {
            "Excluded_Balance": sum_cols(have, [balance_name(k) for k in exclusions]),
            "Excluded_NCO_YTD": sum_cols(have, [f"Excl_{k}_NCO_YTD" for k in exclusions]),
            "Excluded_Nonaccrual_Raw": sum_cols(have, [f"Excl_{k}_NA" for k in exclusions]),
            "Excluded_PD30": sum_cols(have, [f"Excl_{k}_P3" for k in exclusions]),
            "Excluded_PD90": sum_cols(have, [f"Excl_{k}_P9" for k in exclusions]),
        }
    )


def excluded_ttm(df: DataFrame) -> DataFrame:
    """Excluded losses as quarterly and trailing-year amounts (before any cap)."""
    quarterly = df.withColumn("Excluded_NCO_Q", discrete_flow("Excluded_NCO_YTD"))
    return quarterly.withColumn("Excluded_NCO_TTM_Raw", rolling_sum("Excluded_NCO_Q"))


def apply_ceiling(df: DataFrame) -> DataFrame:
    """Cap excluded losses and nonaccruals at the total; the excess before the cap stays for the audit."""
    return df.withColumns(
        {
            "Excluded_NCO_TTM": F.least("Excluded_NCO_TTM_Raw", "Total_NCO_TTM"),
            "Excluded_Nonaccrual": F.least("Excluded_Nonaccrual_Raw", "Total_Nonaccrual"),
            "_NCO_Ceiling_Excess": F.greatest(F.col("Excluded_NCO_TTM_Raw") - F.col("Total_NCO_TTM"), F.lit(0.0)),
            "_NA_Ceiling_Excess": F.greatest(
                F.col("Excluded_Nonaccrual_Raw") - F.col("Total_Nonaccrual"), F.lit(0.0)
            ),
        }
    )


def normalized_residual(total: str, excluded: str, tolerance: float = 0.05) -> Column:
    """Total minus excluded as a struct of value, residual, over-exclusion flag and share, severity.

    Not negative: kept. Slightly negative (within ``tolerance`` of a positive total): 0 and
    ``minor_clip``. Anything else: NULL and ``material_nan``.
    """
    t = F.col(total)
    residual = t - F.col(excluded)
    over = residual < 0
    pct = F.when(t > 0, F.greatest(F.try_divide(-residual, t), F.lit(0.0))).otherwise(F.lit(0.0))
    minor = over & (t > 0) & (pct <= tolerance)
    value = F.when(minor, F.lit(0.0)).when(~over, residual)
    severity = F.when(minor, "minor_clip").when(over, "material_nan").otherwise("ok")
    return F.struct(
        value.alias("value"),
        residual.alias("residual"),
        F.coalesce(over, F.lit(False)).alias("over_exclusion_flag"),
        F.coalesce(pct, F.lit(0.0)).alias("over_exclusion_pct"),
        severity.alias("severity"),
    )


# Label, total, excluded amount, name of the normalised total.
RESIDUALS = {
    "NCO": ("Total_NCO_TTM", "Excluded_NCO_TTM", "Norm_Total_NCO"),
    "NA": ("Total_Nonaccrual", "Excluded_Nonaccrual", "Norm_Total_Nonaccrual"),
    "Loans": ("Gross_Loans", "Excluded_Balance", "Norm_Gross_Loans"),
    "PD30": ("TopHouse_PD30", "Excluded_PD30", "Norm_PD30"),
    "PD90": ("TopHouse_PD90", "Excluded_PD90", "Norm_PD90"),
}


def apply_residuals(df: DataFrame, tolerance: float = 0.05) -> DataFrame:
    structs = {f"_r_{k}": normalized_residual(t, e, tolerance) for k, (t, e, _) in RESIDUALS.items()}
    out: dict[str, Column] = {}
    for k, (_, _, name) in RESIDUALS.items():
        r = F.col(f"_r_{k}")
        out[name] = r["value"]
        out[f"_Norm_{k}_Residual"] = r["residual"]
        out[f"_Norm_{k}_OverExclusion_Pct"] = r["over_exclusion_pct"]
        out[f"_Flag_{k}_OverExclusion"] = r["over_exclusion_flag"]
        out[f"_Norm_{k}_Severity"] = r["severity"]
    return df.withColumns(structs).withColumns(out).drop(*structs)


def normalized_allowance(have: set[str]) -> Column:
    """Total allowance minus the reserves of construction, cards and other consumer."""
    reserves = [["RCFDJJ12", "RCONJJ12"], ["RCFDJJ16", "RCONJJ16"], ["RCFDJJ18", "RCFDJJ17", "RCONJJ17"]]
    removed = reduce(lambda a, b: a + b, [best_of(have, codes) for codes in reserves])
    return best_of(have, ["LNATRES", "RCFD3123", "RCON3123", "RCFDJJ19"]) - removed


# Candidate past-due codes (30-day; the 90-day code swaps the prefix).
SHARE_SEGMENTS = {
    "ADC": [["RECONS"]],
    "CI": [["CI"]],
    "Resi": [["RERES", "RES"]],
    "CRE": [["REMULT"], ["RENROT", "CRE"]],
}
SHARE_EXCLUDED = [["CI"], ["RECONS"], ["CRC", "CRCD"], ["AUT", "AUTO"], ["AG", "AGR"], ["NDFI", "DEP"]]


def past_due_shares(df: DataFrame) -> DataFrame:
    """Share of a segment in total past dues, standard and normalised, by horizon."""
    have = set(df.columns)

    def amount(prefix: str, parts) -> Column:
        return reduce(lambda a, b: a + b, [best_of(have, [prefix + c for c in codes]) for codes in parts])

    base: dict[str, Column] = {}
    for horizon, prefix in (("PD30", "P3"), ("PD90", "P9")):
        total = best_of(have, [f"{prefix}ASTOT", f"{prefix}ASSET"])
        base[f"_t_{horizon}"] = total
        base[f"_n_{horizon}"] = total - amount(prefix, SHARE_EXCLUDED)
        for seg, parts in SHARE_SEGMENTS.items():
            base[f"_{seg}_{horizon}"] = amount(prefix, parts)
    staged = df.withColumns(base)
    out: dict[str, Column] = {}
    for seg in SHARE_SEGMENTS:
        for label, kind in (("", "t"), ("Norm_", "n")):
            for horizon in ("PD30", "PD90"):
                out[f"{label}{seg}_Share_of_Total_{horizon}"] = ratio(f"_{seg}_{horizon}", f"_{kind}_{horizon}")
            out[f"{label}{seg}_Share_of_Total_PD"] = ratio(
                f"_{seg}_PD30 + _{seg}_PD90", f"_{kind}_PD30 + _{kind}_PD90"
            )
    return staged.withColumns(out).drop(*base)


def dominant_category(df: DataFrame, columns: Mapping[str, str], prefix: str = "dominant_exclusion") -> DataFrame:
    """Category with the largest absolute amount (first wins a tie) and its share of the absolute sum."""
    names = F.array(*[F.lit(label) for label in columns.values()])
    sizes = F.array(*[F.coalesce(F.abs(F.col(c)), F.lit(0.0)) for c in columns])
    total = reduce(lambda a, b: a + b, [F.coalesce(F.abs(F.col(c)), F.lit(0.0)) for c in columns])
    return (
        df.withColumn("_sizes", sizes)
        .withColumns(
            {
                f"{prefix}_category": F.element_at(
                    names, F.array_position("_sizes", F.array_max("_sizes")).cast("int")
                ),
                f"{prefix}_share": F.try_divide(F.array_max("_sizes"), total),
            }
        )
        .drop("_sizes")
    )


LOSS_CATEGORIES = {
    "Excl_CI_NCO_YTD": "CI",
    "Excl_ADC_NCO_YTD": "ADC",
    "Excl_CC_NCO_YTD": "CreditCard",
    "Excl_Auto_NCO_YTD": "Auto",
    "Excl_Ag_NCO_YTD": "Ag",
    "Excl_OO_CRE_NCO_YTD": "OO_CRE",
}


def exclusion_audit(df: DataFrame) -> DataFrame:
    """Any-gate flag and the dominant excluded category."""
    gates = [c for c in df.columns if c.endswith("_NCO_Gated")]
    flag = reduce(lambda a, b: a | b, [F.col(c) for c in gates], F.lit(False))
    audited = df.withColumn("category_balance_zero_but_nco_nonzero_flag", flag)
    return dominant_category(audited, LOSS_CATEGORIES)


def reconciliation(df: DataFrame) -> DataFrame:
    """Excluded plus normalised minus total, which is 0 wherever the severity is ok."""
    return df.withColumns(
        {
            "NCO_Check_ExclPlusNormMinusTotal": F.col("Excluded_NCO_TTM")
            + F.col("Norm_Total_NCO")
            - F.col("Total_NCO_TTM"),
            "NCO_Flag_Excl_GT_Total": F.col("Excluded_NCO_TTM") > F.col("Total_NCO_TTM"),
            "Loans_Check_ExclPlusNormMinusTotal": F.col("Excluded_Balance")
            + F.col("Norm_Gross_Loans")
            - F.col("Gross_Loans"),
            "Loans_Flag_Excl_GT_Total": F.col("Excluded_Balance") > F.col("Gross_Loans"),
        }
    )


DIAGNOSTIC_COLUMNS = [
    "CERT", "REPDTE",
    "Gross_Loans", "Excluded_Balance", "Norm_Gross_Loans",
    "_Norm_Loans_Residual", "_Norm_Loans_OverExclusion_Pct", "_Norm_Loans_Severity",
    "Total_NCO_TTM", "Excluded_NCO_TTM", "Norm_Total_NCO",
    "_Norm_NCO_Residual", "_Norm_NCO_OverExclusion_Pct", "_Norm_NCO_Severity",
    "Total_Nonaccrual", "Excluded_Nonaccrual", "Norm_Total_Nonaccrual",
    "_Norm_NA_Residual", "_Norm_NA_OverExclusion_Pct", "_Norm_NA_Severity",
    "TopHouse_PD30", "Norm_PD30", "TopHouse_PD90", "Norm_PD90",
]


def diagnostics(df: DataFrame) -> DataFrame:
    return df.select(*present(df.columns, DIAGNOSTIC_COLUMNS))
