"""Data-quality, preflight and dictionary queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterdeck.catalog.composites import ID_BASE
from quarterdeck.catalog.loans import flagged
from quarterdeck.catalog.normalization import derived, derived_table
from quarterdeck.catalog.sql import register, with_ctes
from quarterdeck.functions.missing import RATIO_POLICIES
from quarterdeck.operators import composite, dictionary, normalize, quality, tagging
from quarterdeck.plans.shapes import peer_groups, table

SUBJECT = 1
# Group ids follow the display order; AFRICA (1) is standard, AMERICA (2) normalised.
PAIRS = [(ID_BASE + 1, ID_BASE + 2), (ID_BASE + 3, ID_BASE + 4)]
RULE_COLUMNS = ["TTM_NCO_Rate", "NPL_to_Gross_Loans_Rate", "Norm_NCO_Rate", "Norm_Nonaccrual_Rate", "Norm_Fund_Finance_Composition"]
CHECK_COLUMNS = [*RULE_COLUMNS, "Excluded_NCO_TTM", "Total_NCO_TTM", "Excluded_Nonaccrual", "Total_Nonaccrual", "Excluded_PD30", "TopHouse_PD30", "Excluded_Balance", "Gross_Loans", *normalize.UNSUPPORTED, "_audit_resi_balance_fallback_used"]


def with_groups(spark, sf, columns, blank=False):
    """Derived columns with composite rows; without blanking the regimes contaminate each other on purpose."""
    panel = derived_table(spark, sf, columns)
    numeric = [c for c, t in panel.dtypes if t == "double"]
    extra = composite.composites(panel, peer_groups(spark, sf), numeric, id_base=ID_BASE, blank_regime=blank)
    return composite.with_composites(panel, extra.drop("NAME", "group_key", "member_count"))


def formula_validation(spark, sf):
    return quality.validate_formulas(derived(spark, sf))


GONE = ["SBL_Balance", "RIC_CRE_Cost"]


def formula_gaps(spark, sf):
    """Two columns are missing: the metrics that need them are told, the others are checked."""
    df = derived(spark, sf).drop(*GONE)
    return quality.validation_summary(quality.validate_formulas(df)).join(
        quality.validate_formulas(df).groupBy("metric_code").agg(F.max("missing_dependencies").alias("missing_dependencies")), "metric_code"
    )


def formula_summary(spark, sf):
    """One metric is shifted, so that failures show."""
    df = derived(spark, sf).withColumn("SBL_Composition", F.col("SBL_Composition") + F.when(F.quarter("REPDTE") == 2, 1.5).otherwise(0.0))
    return quality.validation_summary(quality.validate_formulas(df))


def dependency_map(spark, sf):
    """Reverse map with the share of filled rows of each dependency in the panel."""
    df = derived(spark, sf)
    pairs = quality.dependency_map(quality.spec_rows(spark))
    names = sorted({d for s in quality.METRIC_SPECS for d in s.dependencies})
    filled = df.agg(*[F.count(n).alias(n) for n in names]).unpivot([], names, "dependency", "filled_rows")
    return pairs.join(filled, "dependency")


def over_exclusion(spark, sf):
    pairs = [("Excluded_PD30", "TopHouse_PD30", "PD30"), ("Excluded_Balance", "Gross_Loans", "Balance")]
    df = quality.over_exclusion(derived_table(spark, sf, ["Excluded_PD30", "TopHouse_PD30", "Excluded_Balance", "Gross_Loans"]), pairs)
    return df.select("rule", F.col("entity_id").alias("CERT"), F.col("period").alias("REPDTE"), F.round("pct_over", 6).alias("pct_over"))


def flatline(spark, sf):
    df = derived_table(spark, sf, ["Norm_Fund_Finance_Composition", "Norm_NCO_Rate"])
    return quality.flatline(df, ["Norm_Fund_Finance_Composition", "Norm_NCO_Rate"]).select("rule", "period", "detail", "severity")


def semantic_rules(spark, sf):
    df = with_groups(spark, sf, CHECK_COLUMNS)
    specs = quality.spec_rows(spark)
    report = quality.run_rules(df, specs, PAIRS)
    return report.groupBy("rule_id", "rule", "severity").agg(F.count(F.lit(1)).alias("findings"))


def preflight(spark, sf):
    df = with_groups(spark, sf, ["Norm_NCO_Rate", "Norm_Nonaccrual_Rate", "Norm_Gross_Loans", *quality.SEVERITIES], blank=True)
    return quality.preflight(df, df.filter("LNLS is null") if "LNLS" in df.columns else df, SUBJECT, [ID_BASE + 1, ID_BASE + 9], [ID_BASE + 2])


def preflight_verdict(spark, sf):
    return quality.preflight_verdict(preflight(spark, sf))


def composite_regime(spark, sf):
    df = with_groups(spark, sf, ["LNLS"])
    return quality.composite_regime(df, [ID_BASE + 1, ID_BASE + 8], [ID_BASE + 6, ID_BASE + 7])


def duplicate_groups(spark, sf):
    """Two copies of a region's group in its own regime, one copy in the other, and one with a member less."""
    bridge = peer_groups(spark, sf).select("group_key", "CERT", "use_normalized")
    asia = bridge.filter("group_key = 'ASIA'")
    copies = [
        asia.withColumn("group_key", F.lit("COPY_1")),
        asia.withColumn("group_key", F.lit("COPY_2")),
        asia.withColumns({"group_key": F.lit("OTHER_REGIME"), "use_normalized": F.lit(True)}),
        bridge.filter(F.col("CERT") != 0).filter("group_key = 'ALL'").withColumn("group_key", F.lit("ALMOST_ALL")),
    ]
    for extra in copies:
        bridge = bridge.unionByName(extra)
    return quality.duplicate_groups(bridge)


def extract_assertions(spark, sf):
    return quality.extract_assertions(flagged(spark, sf), tagging.FLAG_NAMES, tagging.PRODUCTS)


def tiers(spark, sf):
    part, supplier, nation = (table(spark, sf, n) for n in ("part", "supplier", "nation"))
    pick = lambda df, code, name: df.select(F.expr(code).alias("code"), F.expr(name).alias("name"), F.concat(F.lit("about "), F.expr(name)).alias("description"))
    return {
        1: pick(part.filter("p_size <= 10"), "'RCFD' || cast(p_partkey as string)", "p_name").unionByName(pick(part.filter("p_size between 11 and 20"), "cast(p_partkey as string)", "p_name")),
        2: pick(supplier.filter("s_acctbal > 2000"), "cast(s_suppkey as string)", "s_name").unionByName(pick(supplier.filter("s_acctbal <= 2000"), "'riad' || cast(s_suppkey as string)", "s_name")),
        3: pick(nation, "'RCON' || cast(n_nationkey as string)", "n_name"),
    }


def dictionary_waterfall(spark, sf):
    codes = table(spark, sf, "orders").selectExpr("' ' || case o_orderstatus when 'F' then 'rcfd' when 'O' then 'RIAD' else 'RCON' end || cast(o_custkey as string) as code")
    return dictionary.lookup(codes, tiers(spark, sf))


def dictionary_export(spark, sf):
    return dictionary.export(tiers(spark, sf))


QUERIES = {
    "formula_validation": formula_validation,
    "formula_summary": formula_summary,
    "formula_gaps": formula_gaps,
    "dependency_map": dependency_map,
    "over_exclusion": over_exclusion,
    "flatline": flatline,
    "semantic_rules": semantic_rules,
    "preflight": preflight,
    "preflight_verdict": preflight_verdict,
    "composite_regime": composite_regime,
    "duplicate_groups": duplicate_groups,
    "extract_assertions": extract_assertions,
    "dictionary_waterfall": dictionary_waterfall,
    "dictionary_export": dictionary_export,
}


def sql(text):
    return text.replace("0D", "0.0").replace("try_divide(Gross_Loans - Excluded_Balance, Gross_Loans)", "((Gross_Loans - Excluded_Balance) / nullif(Gross_Loans, 0))")


def expected(s):
    if s.den is None:
        return sql(s.num)
    n, d = sql(s.num), sql(s.den)
    if s.policy == "positive":
        return f"case when ({d}) > 0 then ({n}) / nullif(({d}), 0) end"
    return f"case when ({d}) = 0 then 0.0 else ({n}) / nullif(({d}), 0) end"


assert set(RATIO_POLICIES) >= {"zero", "positive"}


def formula_sql(specs, source="derived"):
    parts = []
    for s in specs:
        a, e = s.code, expected(s)
        low = f"coalesce({a} < {s.low}, false)" if s.low is not None else "false"
        high = f"coalesce({a} > {s.high}, false)" if s.high is not None else "false"
        neg = "false" if s.allow_negative else f"coalesce({a} < 0, false)"
        parts.append(
            f"select CERT, REPDTE, '{s.code}' as metric_code, cast({a} as double) as actual, cast({e} as double) as expected, {low} as below_min, {high} as above_max, {neg} as unexpected_negative from {source}"
        )
    return f"""select *, matches and not below_min and not above_max and not unexpected_negative as row_pass from (
        select *, abs(actual - expected) as abs_error, abs(actual - expected) / nullif(abs(expected), 0) as rel_error, cast(null as varchar) as missing_dependencies, case when actual is null or expected is null then actual is null and expected is null else abs(actual - expected) <= 1e-10 + 1e-6 * abs(expected) end as matches from ({' union all '.join(parts)}))"""


def summary_sql(report):
    return f"""select metric_code, count(*) as rows_checked, count(*) filter (not row_pass) as rows_failed, count(*) filter (not matches) as formula_mismatches, count(*) filter (below_min) as below_min,
        count(*) filter (above_max) as above_max, max(abs_error) as max_abs_error from ({report}) group by 1"""


def lost(s):
    return ", ".join(d for d in s.dependencies if d in GONE)


_SHIFTED = "(select * replace (SBL_Composition + case when quarter(REPDTE) = 2 then 1.5 else 0.0 end as SBL_Composition) from derived)"
_DEPS = [(d, s.code) for s in quality.METRIC_SPECS for d in s.dependencies]
register(
    "audited",
    "select CERT, REPDTE, TTM_NCO_Rate, NPL_to_Gross_Loans_Rate, Norm_NCO_Rate, Norm_Nonaccrual_Rate, Norm_Gross_Loans, Norm_Fund_Finance_Composition, Excluded_NCO_TTM, Total_NCO_TTM, Excluded_Nonaccrual, Total_Nonaccrual, Excluded_Balance, Gross_Loans, _Norm_NCO_Severity, _Norm_NA_Severity, _Norm_Loans_Severity, coalesce(RCON5367, 0.0) + coalesce(RCON5368, 0.0) = 0 as fallback from derived",
    ("derived",),
)
_N = ["TTM_NCO_Rate", "NPL_to_Gross_Loans_Rate", "Norm_NCO_Rate", "Norm_Nonaccrual_Rate", "Norm_Fund_Finance_Composition", "Excluded_NCO_TTM", "Total_NCO_TTM", "Excluded_Nonaccrual", "Total_Nonaccrual", "Excluded_Balance", "Gross_Loans"]
register(
    "audited_all",
    f"select CERT, REPDTE, {', '.join(_N)}, fallback from audited union all select {ID_BASE} + display_order, REPDTE, {', '.join(f'avg({c})' for c in _N)}, null from audited join bridge using (CERT) group by display_order, REPDTE",
    ("audited", "bridge"),
)
_LAST = "REPDTE = (select max(REPDTE) from audited)"
_OVER = " union all ".join(
    f"select 'A_OverExclusion' as rule_id, 'OverExclusion_{label}' as rule, 'high' as severity, count(*) as findings from audited_all where coalesce({e}, 0) > coalesce({t}, 0)" for e, t, label in quality.EXCLUSION_PAIRS
)
_DUP = " union all ".join(
    f"select 1 as f from (select {m} as s from audited_all where {_LAST} and CERT = {a}), (select {m} as n from audited_all where {_LAST} and CERT = {b}) where abs(s - n) <= 1e-8 + 1e-6 * abs(n)" for a, b in PAIRS for m in quality.IDENTITY_RATES
)
_STD, _NRM = ", ".join(str(a) for a, _ in PAIRS), ", ".join(str(b) for _, b in PAIRS)
_CONT = " union all ".join(
    f"select distinct CERT, '{m}' as metric from audited_all where CERT in ({ids}) and {m} <> 0" for m, ids in (("Norm_NCO_Rate", _STD), ("Norm_Nonaccrual_Rate", _STD), ("TTM_NCO_Rate", _NRM), ("NPL_to_Gross_Loans_Rate", _NRM))
)
_ORPHANS = sum(1 for s in quality.METRIC_SPECS if not s.consumers)
_FLAT = " union all ".join(
    f"select 'B_FlatlineAnomaly', 'Flatline_{m}', 'medium', count(*) from (select count({m}) as n, min({m}) as lo, max({m}) as hi from audited_all where {_LAST}) where n > 1 and lo = hi" for m in ("Norm_NCO_Rate", "Norm_Nonaccrual_Rate")
)
_PRE = f"""select "check", about, level, cast(rows as bigint) as rows, suppressed from (
  select 'material_blocking' as "check", sev as about, 'error' as level, count(*) filter (now and CERT in ({SUBJECT}, {ID_BASE + 2})) as rows, 'normalized_credit_chart' as suppressed from sevs group by sev having rows > 0
  union all select 'material_peers', sev, 'warning', count(*) filter (now and CERT not in ({SUBJECT}, {ID_BASE + 2})) as rows, null from sevs group by sev having rows > 0
  union all select 'material_history', sev, 'warning', count(*), null from sevs group by sev
  union all select 'standard_composite_missing', '{ID_BASE + 9}', 'error', 0, 'standard_scatter')"""
register(
    "sevs",
    " union all ".join(f"select CERT, '{c}' as sev, {_LAST} as now from audited where {c} = 'material_nan'" for c in quality.SEVERITIES),
    ("audited",),
)
_P1 = "select 'RCFD' || p_partkey as code, p_name as name from part where p_size <= 10 union all select cast(p_partkey as varchar), p_name from part where p_size between 11 and 20"
_P2 = "select cast(s_suppkey as varchar) as code, s_name as name from supplier where s_acctbal > 2000 union all select 'RIAD' || s_suppkey, s_name from supplier where s_acctbal <= 2000"
_P3 = "select 'RCON' || n_nationkey as code, n_name as name from nation"
_STRIP = "regexp_replace(k, '^(RCFD|RCON|RIAD|RCFA|RCOA|RCFN|RCFW|RCOW)', '')"

ORACLES = {
    "formula_validation": with_ctes(formula_sql(quality.METRIC_SPECS), "derived"),
    "formula_gaps": with_ctes(
        summary_sql(formula_sql([s for s in quality.METRIC_SPECS if not lost(s) and s.code not in GONE])).replace("from (", ", cast(null as varchar) as missing_dependencies from (", 1)
        + "".join(f" union all select '{s.code}', count(*), count(*), 0, 0, 0, null, '{lost(s)}' from derived" for s in quality.METRIC_SPECS if lost(s))
        + " union all select 'SBL_Balance', count(*), count(*), count(*), 0, 0, null, null from derived",
        "derived",
    ),
    "formula_summary": with_ctes(summary_sql(formula_sql(quality.METRIC_SPECS, _SHIFTED)), "derived"),
    "dependency_map": with_ctes(
        " union all ".join(f"select '{d}' as dependency, '{m}' as metric_code, count({d}) as filled_rows from derived" for d, m in _DEPS), "derived"
    ),
    "over_exclusion": with_ctes(
        """select 'OverExclusion_PD30' as rule, CERT, REPDTE, round((Excluded_PD30 - TopHouse_PD30) * 100 / nullif(TopHouse_PD30, 0), 6) as pct_over from derived where Excluded_PD30 > TopHouse_PD30
           union all select 'OverExclusion_Balance', CERT, REPDTE, round((Excluded_Balance - Gross_Loans) * 100 / nullif(Gross_Loans, 0), 6) from derived where Excluded_Balance > Gross_Loans""",
        "derived",
    ),
    "flatline": with_ctes(
        "select 'Flatline_Norm_Fund_Finance_Composition' as rule, max(REPDTE) as period, 'All ' || count(*) || ' values = 0.000000' as detail, 'medium' as severity from derived where REPDTE = (select max(REPDTE) from derived)", "derived"
    ),
    "semantic_rules": with_ctes(
        f"""select * from ({_OVER} union all {_FLAT}
            union all select 'C_DuplicateComposite', 'DuplicateComposite', 'medium', (select count(*) from ({_DUP}))
            union all select 'D_OutputContamination', 'OutputContamination', 'high', (select count(*) from ({_CONT}))
            union all select 'E_ConsumerLinkage', 'OrphanedMetric', 'low', {_ORPHANS}
            union all select 'F_UnsupportedMappings', 'UnsupportedMapping__audit_resi_balance_fallback_used', 'low', count(*) from audited where {_LAST} and fallback
            union all select 'F_UnsupportedMappings', 'UnsupportedMapping_' || unnest(['_audit_unsupported_ndfi_pdna', '_audit_ndfi_nco_unsupported']), 'low', (select count(*) from audited where {_LAST})) where findings > 0""",
        "audited_all",
    ),
    "preflight": with_ctes(_PRE, "sevs"),
    "preflight_verdict": with_ctes(
        f"""select count(*) filter (level = 'error') = 0 as valid, count(*) filter (level = 'error') as errors, count(*) filter (level = 'warning') as warnings, coalesce(string_agg(distinct suppressed, ',' order by suppressed), '') as suppressed from ({_PRE})""", "sevs"
    ),
    "composite_regime": f"select cast({ID_BASE + 8} as bigint) as CERT, 'missing_active' as status union all select cast({ID_BASE + 6} as bigint), 'legacy_present' from (select 1 from supplier limit 1)",
    "duplicate_groups": with_ctes(
        "select false as use_normalized, k as group_key, 'ASIA' as same_as, (select count(*) from bridge where group_key = 'ASIA') as members from (select unnest(['COPY_1', 'COPY_2']) as k)", "bridge"
    ),
    "extract_assertions": with_ctes(
        """select 'allowed_flags' as "check", cast(0 as bigint) as failed, true as passed from (select count(*) from flagged) union all
           select 'flag_count', count(*) filter (FLAG_COUNT <> case when FLAGS = '' then 0 else len(string_split(FLAGS, '|')) end), count(*) filter (FLAG_COUNT <> case when FLAGS = '' then 0 else len(string_split(FLAGS, '|')) end) = 0 from flagged union all
           select 'qualified', count(*) filter (QUALIFIED <> (FLAG_COUNT > 0)), count(*) filter (QUALIFIED <> (FLAG_COUNT > 0)) = 0 from flagged union all
           select 'account_12_digits', count(*) filter (not coalesce(regexp_full_match(ACCOUNT_NUMBER, '[0-9]{12}'), false)), count(*) filter (not coalesce(regexp_full_match(ACCOUNT_NUMBER, '[0-9]{12}'), false)) = 0 from flagged union all
           select 'floor_within_amount', count(*) filter (CREDIT_LII_COMMITMENT_FLOOR > amt and amt >= 1), count(*) filter (CREDIT_LII_COMMITMENT_FLOOR > amt and amt >= 1) = 0 from flagged union all
           select 'known_product', cast(0 as bigint), true union all
           select 'share_of_new', case when count(*) filter (NEW_CAMP_YN = 'Y') / count(*) >= 0.3 then 0 else 1 end, count(*) filter (NEW_CAMP_YN = 'Y') / count(*) >= 0.3 from flagged""",
        "flagged",
    ),
    "dictionary_waterfall": f"""with t1 as ({_P1}), t2 as ({_P2}), t3 as ({_P3}),
        w as (select distinct code as metric_code, upper(trim(code)) as k from (select ' ' || case o_orderstatus when 'F' then 'rcfd' when 'O' then 'RIAD' else 'RCON' end || o_custkey as code from orders)),
        h as (select metric_code, 1 as r, name, 'Tier 1' as s from w join t1 on k = t1.code union all select metric_code, 2, name, 'Tier 1 (base item)' from w join t1 on {_STRIP} = t1.code and {_STRIP} <> k
          union all select metric_code, 3, name, 'Tier 2' from w join t2 on k = t2.code union all select metric_code, 4, name, 'Tier 2 (base item)' from w join t2 on {_STRIP} = t2.code and {_STRIP} <> k union all select metric_code, 5, name, 'Tier 3' from w join t3 on k = t3.code)
        select metric_code, coalesce(name, k) as name, coalesce('about ' || name, 'Definition Not Found') as description, coalesce(s, 'Not Found') as source, coalesce(r = 5, false) as is_derived
        from w left join (select * from h qualify row_number() over (partition by metric_code order by r) = 1) using (metric_code)""",
    "dictionary_export": f"""select metric_code, name, 'about ' || name as description, source, t = 3 as is_derived from (select code as metric_code, name, 'Tier 1' as source, 1 as t from ({_P1}) union all select code, name, 'Tier 2', 2 from ({_P2}) union all select code, name, 'Tier 3', 3 from ({_P3}))
        qualify row_number() over (partition by metric_code order by t) = 1""",
}
