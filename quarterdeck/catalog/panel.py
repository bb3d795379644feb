"""Entity-quarter window queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterdeck.catalog.sql import register, with_ctes
from quarterdeck.operators import flows
from quarterdeck.plans.shapes import bank_panel

KEYS = ["CERT", "REPDTE"]

# Windows used by the SQL side.
E = "partition by CERT order by REPDTE"
E4 = f"({E} rows between 3 preceding and current row)"


def sql_flow(c: str, w: str = "e") -> str:
    return f"coalesce(case when quarter(REPDTE) = 1 then {c} else {c} - lag({c}) over {w} end, {c}, 0.0)"


def r(c, digits: int = 9):
    """Rounding at the query edge for sums of inexact ratios, whose last bits depend on order."""
    return F.round(c, digits)


def ytd_to_discrete(spark, sf):
    df = bank_panel(spark, sf, ["NTLNLS", "ELNATR"])
    df = flows.ytd_to_discrete(df, {"NTLNLS": "NTLNLS_Q", "ELNATR": "ELNATR_Q", "NOT_THERE": "Absent_Q"})
    return df.select(*KEYS, "NTLNLS_Q", "ELNATR_Q", "Absent_Q")


def ytd_to_discrete_no_fallback(spark, sf):
    df = flows.ytd_to_discrete(bank_panel(spark, sf, ["NTCI"]), {"NTCI": "NTCI_Q"}, fallback=False)
    return df.select(*KEYS, "NTCI_Q")


def ytd_to_discrete_strict(spark, sf):
    df = flows.ytd_to_discrete(bank_panel(spark, sf, ["NTCI"]), {"NTCI": "NTCI_Q"}, strict=True)
    return df.select(*KEYS, "NTCI_Q")


def annualize_ytd(spark, sf):
    df = bank_panel(spark, sf, ["ELNATR", "ILNDOM", "LNLS"])
    return df.select(
        *KEYS,
        flows.annualize_ytd(df, "ELNATR").alias("Provision_Annualized"),
        flows.annualize_ytd(df, "ILNDOM").alias("Income_Annualized"),
        flows.annualize_ytd(df, "NOT_THERE").alias("Absent_Annualized"),
    )


def _with_q(spark, sf, ytd, *stocks):
    df = bank_panel(spark, sf, [*ytd, *stocks])
    return flows.ytd_to_discrete(df, {c: f"{c}_Q" for c in ytd})


def ttm_sum(spark, sf):
    df = flows.ttm_sums(_with_q(spark, sf, ["NTLNLS", "NTCI", "ELNATR"]), {f"{c}_Q": f"{c}_TTM" for c in ("NTLNLS", "NTCI", "ELNATR")})
    return df.select(*KEYS, "NTLNLS_TTM", "NTCI_TTM", "ELNATR_TTM")


def ttm_rate(spark, sf):
    df = _with_q(spark, sf, ["NTLNLS"], "LNLS")
    return df.select(*KEYS, flows.rolling_mean("LNLS").alias("Avg_Loans"), flows.ttm_rate("NTLNLS_Q", "LNLS").alias("TTM_NCO_Rate"))


def ttm_rate_strict(spark, sf):
    df = _with_q(spark, sf, ["NTLNLS"], "LNLS")
    rate = flows.ttm_rate("NTLNLS_Q", "LNLS", min_periods=4, scale=100.0)
    return df.select(*KEYS, rate.alias("TTM_NCO_Rate"))


def past_due_smoothed(spark, sf):
    df = bank_panel(spark, sf, ["P3LNLS", "P9LNLS", "LNLS"])
    df = flows.smoothed_past_due(df, ["P3LNLS", "P9LNLS"], "LNLS", "Past_Due_Rate")
    return df.select(*KEYS, r("Past_Due_Rate").alias("Past_Due_Rate"))


def yoy_growth(spark, sf):
    df = flows.add_growth(bank_panel(spark, sf, ["LNLS", "ASSET", "DEP"]))
    return df.select(*KEYS, "Total_Loans_Growth_TTM", "Assets_Growth_TTM", "Deposits_Growth_TTM")


def growth_36m(spark, sf):
    df = bank_panel(spark, sf, ["LNRENROW"])
    return df.select(*KEYS, flows.pct_change("LNRENROW", 12).alias("Growth_36M"))


def deltas_and_lags(spark, sf):
    df = bank_panel(spark, sf, ["NAREMULT", "P3REMULT", "P9REMULT"])
    late = F.coalesce("P3REMULT", F.lit(0.0)) + F.coalesce("P9REMULT", F.lit(0.0))
    df = df.withColumns({"NA_CRE": F.coalesce("NAREMULT", F.lit(0.0)), "PD_CRE": late})
    d, lag1 = flows.delta("NA_CRE"), flows.lagged("PD_CRE")
    velocity = F.when(lag1 == 0, F.lit(0.0)).otherwise(F.try_divide(d, lag1))
    return df.select(*KEYS, d.alias("Delta_Nonaccrual"), lag1.alias("Lagged_PD"), velocity.alias("Conversion_Velocity"))


def avg_8p(spark, sf):
    df = bank_panel(spark, sf, ["LNLS", "ASSET", "NACI", "LNCI", "NAREMULT"])
    return flows.trailing_profile(
        df,
        ["LNLS", "ASSET", "NACI"],
        stress={"Comm_Nonaccrual_Rate": ("NACI", "LNCI")},
        ever={"CRE_Ever_NA_Flag": "NAREMULT"},
    )


def avg_8p_strict(spark, sf):
    return flows.trailing_profile(bank_panel(spark, sf, ["LNLS", "DEP"]), ["LNLS", "DEP"], min_periods=8)


def ttm_pd_rates(spark, sf):
    df = flows.ttm_past_due(bank_panel(spark, sf, ["P3ASTOT", "P9ASTOT", "LNLS"]), "P3ASTOT", "P9ASTOT", "LNLS")
    return df.select(*KEYS, *[r(c).alias(c) for c in ("TTM_PD30_Rate", "TTM_PD90_Rate", "TTM_Past_Due_Rate")])


CATEGORIES = {
    "CI": {"balance": "LNCI", "pd30": "P3CI", "pd90": "P9CI", "nco": "NTCI"},
    "ADC": {"balance": "LNRECONS", "pd30": "P3RECONS", "pd90": "P9RECONS", "nco": "NTRECONS"},
    "RESI": {"balance": "LNRERES", "pd30": "P3RERES", "pd90": "P9RERES", "nco": "NTRERES"},
}


def category_ttm_rates(spark, sf):
    cols = [c for cat in CATEGORIES.values() for c in cat.values()]
    df = flows.category_ttm_rates(bank_panel(spark, sf, cols), CATEGORIES)
    made = [c for c in df.columns if "_TTM_" in c]
    return df.select(*KEYS, *[r(c).alias(c) for c in made])


def category_mix(spark, sf):
    df = _with_q(spark, sf, ["NTCI"], "LNCI", "LNRECONS", "LNRERES")
    df = flows.mix_percentages(df, ["LNCI", "LNRECONS", "LNRERES"])
    return df.select(
        *KEYS, "LNCI_Pct", "LNRECONS_Pct", "LNRERES_Pct", flows.annualized_loss_rate("NTCI_Q", "LNCI").alias("CI_NCO_Rate")
    )


def rolling_mix(spark, sf):
    df = flows.mix_percentages(bank_panel(spark, sf, ["EQ", "RBCT1J", "CHBAL"]), ["EQ", "RBCT1J", "CHBAL"])
    return df.select(*KEYS, *[r(flows.rolling_mean(f"{c}_Pct")).alias(f"TTM_{c}_Pct") for c in ("EQ", "RBCT1J", "CHBAL")])


def cost_of_funds(spark, sf):
    df = _with_q(spark, sf, ["EINTEXP"], "DEP")
    return df.select(*KEYS, flows.cost_of_funds("EINTEXP_Q", "DEP").alias("Cost_of_Funds"))


def duplicate_periods(spark, sf):
    return flows.assert_unique_periods(bank_panel(spark, sf, ["LNLS"]))


QUERIES = {
    "ytd_to_discrete": ytd_to_discrete,
    "ytd_to_discrete_no_fallback": ytd_to_discrete_no_fallback,
    "ytd_to_discrete_strict": ytd_to_discrete_strict,
    "annualize_ytd": annualize_ytd,
    "ttm_sum": ttm_sum,
    "ttm_rate": ttm_rate,
    "ttm_rate_strict": ttm_rate_strict,
    "past_due_smoothed": past_due_smoothed,
    "yoy_growth": yoy_growth,
    "growth_36m": growth_36m,
    "deltas_and_lags": deltas_and_lags,
    "avg_8p_peak_stress": avg_8p,
    "avg_8p_strict": avg_8p_strict,
    "ttm_pd_rates": ttm_pd_rates,
    "category_ttm_rates": category_ttm_rates,
    "category_mix": category_mix,
    "rolling_mix": rolling_mix,
    "cost_of_funds": cost_of_funds,
    "duplicate_periods": duplicate_periods,
}

register("flow_q", f"select *, {', '.join(f'{sql_flow(c)} as {c}_Q' for c in ('NTLNLS', 'NTCI', 'ELNATR', 'EINTEXP'))} from panel window e as ({E})", ("panel",))


def sql_growth(c: str) -> str:
    then = f"lag({c}, 4) over e"
    return f"case when {then} = 0 then case when {c} = 0 then 0.0 end else ({c} - {then}) / nullif(abs({then}), 0) end"


def _strict_mean(c):
    return f"case when count({c}) over {E4} >= 4 then avg({c}) over {E4} end"


def _cat_sql():
    out = []
    for name, cols in CATEGORIES.items():
        for m in ("pd30", "pd90", "nco"):
            out.append(f"round({_strict_mean(cols[m])} / nullif({_strict_mean(cols['balance'])}, 0) * 100.0, 9) as {name}_TTM_{m.upper()}_Rate")
    return ", ".join(out)


_MIX = {c: f"coalesce({c}, 0.0) * 100.0 / nullif(coalesce(LNCI, 0.0) + coalesce(LNRECONS, 0.0) + coalesce(LNRERES, 0.0), 0)" for c in ("LNCI", "LNRECONS", "LNRERES")}
_CAP = {c: f"coalesce({c}, 0.0) * 100.0 / nullif(coalesce(EQ, 0.0) + coalesce(RBCT1J, 0.0) + coalesce(CHBAL, 0.0), 0)" for c in ("EQ", "RBCT1J", "CHBAL")}

ORACLES = {
    "ytd_to_discrete": with_ctes("select CERT, REPDTE, NTLNLS_Q, ELNATR_Q, cast(0 as double) as Absent_Q from flow_q", "flow_q"),
    "ytd_to_discrete_no_fallback": with_ctes(
        f"select CERT, REPDTE, case when quarter(REPDTE) = 1 then NTCI else NTCI - lag(NTCI) over ({E}) end as NTCI_Q from panel", "panel"
    ),
    "ytd_to_discrete_strict": with_ctes(
        f"""select CERT, REPDTE, case when quarter(REPDTE) = 1 then NTCI
            when lag(REPDTE) over ({E}) = cast(last_day(REPDTE - interval 3 month) as date) then NTCI - lag(NTCI) over ({E}) end as NTCI_Q from panel""",
        "panel",
    ),
    "annualize_ytd": with_ctes(
        "select CERT, REPDTE, ELNATR * 4.0 / quarter(REPDTE) as Provision_Annualized, ILNDOM * 4.0 / quarter(REPDTE) as Income_Annualized, cast(null as double) as Absent_Annualized from panel",
        "panel",
    ),
    "ttm_sum": with_ctes(
        f"select CERT, REPDTE, {', '.join(f'sum({c}_Q) over {E4} as {c}_TTM' for c in ('NTLNLS', 'NTCI', 'ELNATR'))} from flow_q", "flow_q"
    ),
    "ttm_rate": with_ctes(
        f"select CERT, REPDTE, avg(LNLS) over {E4} as Avg_Loans, sum(NTLNLS_Q) over {E4} / nullif(avg(LNLS) over {E4}, 0) as TTM_NCO_Rate from flow_q", "flow_q"
    ),
    "ttm_rate_strict": with_ctes(
        f"""select CERT, REPDTE, case when count(NTLNLS_Q) over {E4} >= 4 then sum(NTLNLS_Q) over {E4} end
            / nullif({_strict_mean('LNLS')}, 0) * 100.0 as TTM_NCO_Rate from flow_q""",
        "flow_q",
    ),
    "past_due_smoothed": with_ctes(
        f"""select CERT, REPDTE, round(avg(rate) over {E4}, 9) as Past_Due_Rate
            from (select *, (coalesce(P3LNLS, 0.0) + coalesce(P9LNLS, 0.0)) / nullif(LNLS, 0) as rate from panel)""",
        "panel",
    ),
    "yoy_growth": with_ctes(
        f"select CERT, REPDTE, {sql_growth('LNLS')} as Total_Loans_Growth_TTM, {sql_growth('ASSET')} as Assets_Growth_TTM, {sql_growth('DEP')} as Deposits_Growth_TTM from panel window e as ({E})",
        "panel",
    ),
    "growth_36m": with_ctes(f"select CERT, REPDTE, (LNRENROW / nullif(lag(LNRENROW, 12) over ({E}), 0) - 1) * 100.0 as Growth_36M from panel", "panel"),
    "deltas_and_lags": with_ctes(
        f"""select CERT, REPDTE, d as Delta_Nonaccrual, lp as Lagged_PD, case when lp = 0 then 0.0 else d / nullif(lp, 0) end as Conversion_Velocity from (
            select CERT, REPDTE, coalesce(NAREMULT, 0.0) - lag(coalesce(NAREMULT, 0.0)) over ({E}) as d,
            lag(coalesce(P3REMULT, 0.0) + coalesce(P9REMULT, 0.0)) over ({E}) as lp from panel)""",
        "panel",
    ),
    "avg_8p_peak_stress": with_ctes(
        """select CERT, avg(LNLS) as LNLS, avg(ASSET) as ASSET, avg(NACI) as NACI,
           case when avg(LNCI) > 0 then max(NACI) / nullif(avg(LNCI), 0) else 0.0 end as Comm_Nonaccrual_Rate,
           case when max(NAREMULT) > 0 then 1.0::double else 0.0::double end as CRE_Ever_NA_Flag
           from (select * from panel qualify row_number() over (partition by CERT order by REPDTE desc) <= 8) group by CERT""",
        "panel",
    ),
    "avg_8p_strict": with_ctes(
        """select CERT, avg(LNLS) as LNLS, avg(DEP) as DEP from (select * from panel qualify row_number() over (partition by CERT order by REPDTE desc) <= 8)
           group by CERT having count(*) >= 8""",
        "panel",
    ),
    "ttm_pd_rates": with_ctes(
        f"""select CERT, REPDTE, round(a, 9) as TTM_PD30_Rate, round(b, 9) as TTM_PD90_Rate, round(a + b, 9) as TTM_Past_Due_Rate from (
            select CERT, REPDTE, {_strict_mean('P3ASTOT')} / nullif({_strict_mean('LNLS')}, 0) * 100.0 as a,
            {_strict_mean('P9ASTOT')} / nullif({_strict_mean('LNLS')}, 0) * 100.0 as b from panel)""",
        "panel",
    ),
    "category_ttm_rates": with_ctes(f"select CERT, REPDTE, {_cat_sql()} from panel", "panel"),
    "category_mix": with_ctes(
        f"select CERT, REPDTE, {', '.join(f'{e} as {c}_Pct' for c, e in _MIX.items())}, NTCI_Q / nullif(LNCI, 0) * 400.0 as CI_NCO_Rate from flow_q", "flow_q"
    ),
    "rolling_mix": with_ctes(
        f"select CERT, REPDTE, {', '.join(f'round(avg({e}) over {E4}, 9) as TTM_{c}_Pct' for c, e in _CAP.items())} from panel", "panel"
    ),
    "cost_of_funds": with_ctes(
        f"""select CERT, REPDTE, EINTEXP_Q * 4.0 / nullif(case when count(DEP) over w >= 2 then avg(DEP) over w end, 0) * 100.0 as Cost_of_Funds
            from flow_q window w as ({E} rows between 1 preceding and current row)""",
        "flow_q",
    ),
    "duplicate_periods": with_ctes('select CERT, REPDTE, count(*) as count from panel group by 1, 2 having count(*) > 1', "panel"),
}
