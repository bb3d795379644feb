"""Data-quality rules: recomputing metrics, semantic checks, preflight, extract assertions."""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Mapping, NamedTuple, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quarterdeck.functions.missing import present, ratio
from quarterdeck.operators.compare import latest
from quarterdeck.operators.flows import ENTITY, PERIOD


class MetricSpec(NamedTuple):
    """A derived metric: what it needs, how it is computed, and the range it must stay in."""

    code: str
    dependencies: tuple[str, ...]
    num: str
    den: str | None
    unit: str = "fraction"
    low: float | None = 0.0
    high: float | None = None
    allow_negative: bool = False
    consumers: tuple[str, ...] = ()
    severity: str = "high"
    policy: str = "zero"


def _r(code, num, den, deps=None, high=None, consumers=(), **more) -> MetricSpec:
    return MetricSpec(code, tuple(deps or (num, den)), num, den, high=high, consumers=tuple(consumers), **more)


# The registered metrics. A quotient follows the same zero rule as its producer.
METRIC_SPECS = [
    _r("Risk_Adj_Allowance_Coverage", "Total_ACL", "Gross_Loans - SBL_Balance", ("Total_ACL", "Gross_Loans", "SBL_Balance"), None, ("executive_summary", "standard_table", "ratio_components_standard")),
    _r("Allowance_to_Gross_Loans_Rate", "Total_ACL", "Gross_Loans", high=0.5, consumers=("executive_summary", "standard_table", "ratio_components_standard")),
    _r("Nonaccrual_to_Gross_Loans_Rate", "Total_Nonaccrual", "Gross_Loans", high=0.5, consumers=("executive_summary", "standard_credit_chart", "standard_table")),
    _r("SBL_Composition", "SBL_Balance", "Gross_Loans", high=1.0, consumers=("executive_summary", "ratio_components_standard", "segment_focus")),
    _r("Norm_NCO_Rate", "Norm_Total_NCO", "Norm_Gross_Loans", high=0.25, low=-0.1, allow_negative=True, consumers=("normalized_credit_chart_bar", "normalized_table", "detailed_peer_table")),
    _r("Norm_Nonaccrual_Rate", "Norm_Total_Nonaccrual", "Norm_Gross_Loans", high=0.5, consumers=("normalized_credit_chart_line", "normalized_table")),
    _r("Norm_ACL_Coverage", "Norm_ACL_Balance", "Norm_Gross_Loans", high=1.0, consumers=("normalized_table", "ratio_components_normalized")),
    _r("Norm_Delinquency_Rate", "Norm_PD30 + Norm_PD90", "Norm_Gross_Loans", ("Norm_PD30", "Norm_PD90", "Norm_Gross_Loans"), 1.0, ("normalized_table", "ratio_components_normalized", "detailed_peer_table")),
    _r("Norm_Risk_Adj_Allowance_Coverage", "Norm_ACL_Balance", "Norm_Gross_Loans - SBL_Balance", ("Norm_ACL_Balance", "Norm_Gross_Loans", "SBL_Balance"), None, ("normalized_table", "ratio_components_normalized", "detailed_peer_table")),
    _r("RIC_CRE_ACL_Coverage", "RIC_CRE_ACL", "RIC_CRE_Cost", consumers=("executive_summary", "segment_focus_cre")),
    _r("RIC_CRE_Risk_Adj_Coverage", "RIC_CRE_ACL", "RIC_CRE_Nonaccrual", unit="multiple", policy="positive", consumers=("executive_summary", "segment_focus_cre", "detailed_peer_table")),
    _r("RIC_CRE_ACL_Share", "RIC_CRE_ACL", "Total_ACL", high=1.0, consumers=("ratio_components_standard", "segment_focus_cre", "detailed_peer_table")),
    _r("RIC_CRE_Nonaccrual_Rate", "RIC_CRE_Nonaccrual", "RIC_CRE_Cost", consumers=("segment_focus_cre", "detailed_peer_table")),
    _r("RIC_Resi_ACL_Share", "RIC_Resi_ACL", "Total_ACL", high=1.0, consumers=("ratio_components_standard", "segment_focus_resi", "detailed_peer_table")),
    _r("RIC_Resi_ACL_Coverage", "RIC_Resi_ACL", "RIC_Resi_Cost", consumers=("segment_focus_resi", "ratio_components_standard")),
    _r("RIC_Resi_Nonaccrual_Rate", "RIC_Resi_Nonaccrual", "RIC_Resi_Cost", consumers=("segment_focus_resi",)),
    _r("Norm_Wealth_Resi_Composition", "Wealth_Resi_Balance", "Norm_Gross_Loans", high=1.0, consumers=("detailed_peer_table", "ratio_components_normalized", "segment_focus_resi")),
    _r("Norm_Resi_ACL_Share", "RIC_Resi_ACL", "Norm_ACL_Balance", high=1.0, consumers=("ratio_components_normalized", "segment_focus_resi")),
    _r("Norm_Resi_ACL_Coverage", "RIC_Resi_ACL", "Wealth_Resi_Balance", consumers=("segment_focus_resi",)),
    _r("Norm_CRE_ACL_Share", "RIC_CRE_ACL", "Norm_ACL_Balance", high=1.0, consumers=("ratio_components_normalized", "segment_focus_cre", "detailed_peer_table")),
    _r("Norm_CRE_ACL_Coverage", "RIC_CRE_ACL", "CRE_Investment_Pure_Balance", consumers=("segment_focus_cre", "detailed_peer_table")),
    MetricSpec("Norm_Gross_Loans", ("Gross_Loans", "Excluded_Balance"), "CASE WHEN Gross_Loans - Excluded_Balance >= 0 THEN Gross_Loans - Excluded_Balance WHEN try_divide(Gross_Loans - Excluded_Balance, Gross_Loans) >= -0.05 THEN 0D END", None, "dollars"),
    MetricSpec("Total_ACL", ("LNATRES",), "coalesce(LNATRES, 0D)", None, "dollars"),
    MetricSpec("Gross_Loans", ("LNLS",), "LNLS", None, "dollars"),
    MetricSpec("SBL_Balance", ("RCFD1545",), "coalesce(RCFD1545, RCON1545, 0D)", None, "dollars", severity="medium"),
    MetricSpec("Total_Nonaccrual", (), "coalesce(Total_Nonaccrual, 0D)", None, "dollars", severity="medium"),
    _r("CRE_Concentration_Capital_Risk", "RIC_CRE_Cost", "RBCT1J", unit="multiple", consumers=("concentration_vs_capital",), severity="medium"),
    _r("CI_to_Capital_Risk", "LNCI", "RBCT1J", unit="multiple", consumers=("concentration_vs_capital",), severity="medium"),
]


def expected_value(spec: MetricSpec) -> Column:
    return F.expr(spec.num) if spec.den is None else ratio(spec.num, spec.den, spec.policy)


def is_close(a: Column, b: Column, rtol: float = 1e-6, atol: float = 1e-10) -> Column:
    """Equal within tolerance; two NULLs are equal, one is not."""
    both = F.abs(a - b) <= atol + rtol * F.abs(b)
    return F.when(a.isNull() | b.isNull(), a.isNull() & b.isNull()).otherwise(both)


def missing_dependencies(columns: Iterable[str], specs: Sequence[MetricSpec] = tuple(METRIC_SPECS)) -> dict[str, list[str]]:
    """Metric -> dependencies that are not there. Looks at names only."""
    have = set(columns)
    gaps = {s.code: [d for d in s.dependencies if d not in have] for s in specs}
    return {code: names for code, names in gaps.items() if names}


def validate_formulas(
    df: DataFrame,
    specs: Sequence[MetricSpec] = tuple(METRIC_SPECS),
    ids: Sequence[str] = (ENTITY, PERIOD),
) -> DataFrame:
    """Recompute every metric and compare: one row per (ids, metric), in one pass.

    Metrics that lack a dependency have rows too: nothing is expected, ``matches`` is NULL, ``missing_dependencies`` names what is
    not there, and the row does not pass. A metric that is not stored is NULL.
    """
    gaps, have = missing_dependencies(df.columns, specs), set(df.columns)
    number = lambda x: F.lit(x).cast("double")
    actual = [(F.col(s.code).cast("double") if s.code in have else number(None)).alias(f"a{i}") for i, s in enumerate(specs)]
    formula = [(number(None) if s.code in gaps else expected_value(s)).alias(f"e{i}") for i, s in enumerate(specs)]
    staged = df.select(*ids, *actual, *formula)
    parts = [
        F.struct(
            F.lit(s.code).alias("metric_code"),
            F.col(f"a{i}").alias("actual"),
            F.col(f"e{i}").alias("expected"),
            F.lit(", ".join(gaps[s.code]) if s.code in gaps else None).cast("string").alias("missing_dependencies"),
            number(s.low).alias("low"),
            number(s.high).alias("high"),
            F.lit(s.allow_negative).alias("neg_ok"),
        )
        for i, s in enumerate(specs)
    ]
    long = staged.select(*ids, F.explode(F.array(*parts)).alias("m")).select(*ids, "m.*")
    a, e, whole = F.col("actual"), F.col("expected"), F.col("missing_dependencies").isNull()
    checked = long.withColumns(
        {
            "abs_error": F.abs(a - e),
            "rel_error": F.try_divide(F.abs(a - e), F.abs(e)),
            "matches": F.when(whole, is_close(a, e)),
            "below_min": whole & F.coalesce(a < F.col("low"), F.lit(False)),
            "above_max": whole & F.coalesce(a > F.col("high"), F.lit(False)),
            "unexpected_negative": whole & F.coalesce((a < 0) & ~F.col("neg_ok"), F.lit(False)),
        }
    )
    ok = whole & F.col("matches") & ~F.col("below_min") & ~F.col("above_max") & ~F.col("unexpected_negative")
    return checked.withColumn("row_pass", F.coalesce(ok, F.lit(False))).drop("low", "high", "neg_ok")


def validation_summary(report: DataFrame) -> DataFrame:
    """Failures per metric."""
    return report.groupBy("metric_code").agg(
        F.count(F.lit(1)).alias("rows_checked"),
        F.count_if(~F.col("row_pass")).alias("rows_failed"),
        F.count_if(~F.col("matches")).alias("formula_mismatches"),
        F.count_if("below_min").alias("below_min"),
        F.count_if("above_max").alias("above_max"),
        F.max("abs_error").alias("max_abs_error"),
    )


def spec_rows(spark: SparkSession, specs: Sequence[MetricSpec] = tuple(METRIC_SPECS)) -> DataFrame:
    """The registry as a dimension table."""
    rows = [(s.code, list(s.dependencies), s.unit, s.low, s.high, s.allow_negative, list(s.consumers), s.severity) for s in specs]
    schema = "metric_code string, dependencies array<string>, unit string, low double, high double, allow_negative boolean, consumers array<string>, severity string"
    return spark.createDataFrame(rows, schema)


def dependency_map(specs: DataFrame) -> DataFrame:
    """Reverse map: which metrics need a column."""
    return specs.select(F.explode("dependencies").alias("dependency"), "metric_code")


# --- semantic rules -------------------------------------------------------------------

FINDING = ["rule_id", "rule", "entity_id", "period", "detail", "severity", "pct_over"]


def _finding(df: DataFrame, rule_id: str, rule: Column, detail: Column, severity: str, **extra: Column) -> DataFrame:
    null = F.lit(None)
    cols = {
        "rule_id": F.lit(rule_id),
        "rule": rule,
        "entity_id": extra.get("entity_id", null.cast("long")),
        "period": extra.get("period", null.cast("date")),
        "detail": detail,
        "severity": F.lit(severity),
        "pct_over": extra.get("pct_over", null.cast("double")),
    }
    return df.select(*[c.alias(n) for n, c in cols.items()])


# Excluded amount, total, label.
EXCLUSION_PAIRS = [
    ("Excluded_NCO_TTM", "Total_NCO_TTM", "NCO"),
    ("Excluded_Nonaccrual", "Total_Nonaccrual", "Nonaccrual"),
    ("Excluded_Balance", "Gross_Loans", "Balance"),
]


def over_exclusion(df: DataFrame, pairs=EXCLUSION_PAIRS) -> DataFrame:
    """Rows whose excluded amount exceeds the total, with the excess in percent."""
    have = set(df.columns)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    parts = [
        F.struct(F.lit(label).alias("label"), zero(e).alias("e"), zero(t).alias("t"))
        for e, t, label in pairs
        if e in have and t in have
    ]
    rows = df.select(ENTITY, PERIOD, F.explode(F.array(*parts)).alias("p")).filter("p.e > p.t")
    over = F.try_divide((F.col("p.e") - F.col("p.t")) * 100, F.col("p.t"))
    return _finding(
        rows,
        "A_OverExclusion",
        F.concat(F.lit("OverExclusion_"), F.col("p.label")),
        F.lit("excluded exceeds total"),
        "high",
        entity_id=F.col(ENTITY),
        period=F.col(PERIOD),
        pct_over=over,
    )


FLATLINE_METRICS = ["Norm_NCO_Rate", "Norm_Nonaccrual_Rate", "Norm_Delinquency_Rate", "Norm_ACL_Coverage", "Norm_Exclusion_Pct"]


def flatline(df: DataFrame, metrics: Sequence[str] = FLATLINE_METRICS) -> DataFrame:
    """Metrics with one single value over more than one entity at the latest period.

    Equal minimum and maximum say so without a distinct count.
    """
    metrics = present(df.columns, metrics)
    now = latest(df)
    stats = now.groupBy(PERIOD).agg(
        *[F.struct(F.count(m).alias("n"), F.min(m).alias("lo"), F.max(m).alias("hi")).alias(m) for m in metrics]
    )
    long = stats.select(PERIOD, F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("s")) for m in metrics])).alias("p"))
    rows = long.filter("p.s.n > 1 and p.s.lo = p.s.hi")
    return _finding(
        rows,
        "B_FlatlineAnomaly",
        F.concat(F.lit("Flatline_"), F.col("p.metric")),
        F.format_string("All %d values = %.6f", F.col("p.s.n"), F.col("p.s.lo")),
        "medium",
        period=F.col(PERIOD),
    )


IDENTITY_RATES = ["TTM_NCO_Rate", "NPL_to_Gross_Loans_Rate", "Norm_NCO_Rate", "Norm_Nonaccrual_Rate"]


def duplicate_composites(df: DataFrame, pairs: Sequence[tuple[int, int]], metrics: Sequence[str] = IDENTITY_RATES) -> DataFrame:
    """Standard and normalised composite with the same value at the latest period.

    Looks only at the rows of the paired ids, side by side in one aggregate.
    """
    metrics = present(df.columns, metrics)
    ids = sorted({i for pair in pairs for i in pair})
    rows = latest(df).filter(F.col(ENTITY).isin(ids))
    number = F.coalesce(*[F.when(F.col(ENTITY).isin(list(p)), F.lit(i)) for i, p in enumerate(pairs)])
    side = F.coalesce(*[F.when(F.col(ENTITY) == p[0], F.lit("s")).when(F.col(ENTITY) == p[1], F.lit("n")) for p in pairs])
    long = rows.select(number.alias("pair"), side.alias("side"), PERIOD, *metrics).unpivot(["pair", "side", PERIOD], metrics, "metric", "v")
    wide = long.groupBy("pair", PERIOD, "metric").agg(
        F.max(F.when(F.col("side") == "s", F.col("v"))).alias("s"), F.max(F.when(F.col("side") == "n", F.col("v"))).alias("n")
    )
    same = wide.filter(F.col("s").isNotNull() & F.col("n").isNotNull() & (F.abs(F.col("s") - F.col("n")) <= 1e-8 + 1e-6 * F.abs(F.col("n"))))
    names = F.array(*[F.lit(f"{a} vs {b}") for a, b in pairs])
    return _finding(
        same,
        "C_DuplicateComposite",
        F.lit("DuplicateComposite"),
        F.concat(F.element_at(names, F.col("pair") + 1), F.lit(": "), F.col("metric")),
        "medium",
        period=F.col(PERIOD),
    )


def contamination(df: DataFrame, standard: Sequence[int], normalized: Sequence[int]) -> DataFrame:
    """Composites carrying a non-zero rate of the other regime."""
    wrong = {"Norm_NCO_Rate": standard, "Norm_Nonaccrual_Rate": standard, "TTM_NCO_Rate": normalized, "NPL_to_Gross_Loans_Rate": normalized}
    metrics = present(df.columns, wrong)
    rows = df.filter(F.col(ENTITY).isin([*standard, *normalized]))
    long = rows.select(ENTITY, *metrics).unpivot([ENTITY], metrics, "metric", "v").filter("v <> 0")
    bad = reduce(lambda a, b: a | b, [(F.col("metric") == m) & F.col(ENTITY).isin(list(wrong[m])) for m in metrics])
    hits = long.filter(bad).select(ENTITY, "metric").distinct()
    return _finding(hits, "D_OutputContamination", F.lit("OutputContamination"), F.concat(F.lit("non-null "), F.col("metric")), "high", entity_id=F.col(ENTITY))


def orphaned_metrics(specs: DataFrame) -> DataFrame:
    rows = specs.filter(F.size("consumers") == 0)
    return _finding(rows, "E_ConsumerLinkage", F.lit("OrphanedMetric"), F.col("metric_code"), "low")


def unsupported_mappings(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Audit flags that are set at the latest period."""
    names = present(df.columns, flags)
    if not names:
        return _finding(df.limit(0), "F_UnsupportedMappings", F.lit(""), F.lit(""), "low")
    long = latest(df).select(ENTITY, PERIOD, *names).unpivot([ENTITY, PERIOD], names, "flag", "v").filter("v")
    return _finding(
        long,
        "F_UnsupportedMappings",
        F.concat(F.lit("UnsupportedMapping_"), F.col("flag")),
        F.lit("audit flag set"),
        "low",
        entity_id=F.col(ENTITY),
        period=F.col(PERIOD),
    )


AUDIT_FLAGS = [
    "_audit_unsupported_ndfi_pdna",
    "_audit_ndfi_nco_unsupported",
    "_audit_ag_pd_fallback_to_zero",
    "_audit_resi_balance_fallback_used",
]


def run_rules(df: DataFrame, specs: DataFrame, pairs: Sequence[tuple[int, int]]) -> DataFrame:
    """Every semantic rule in one report."""
    parts = [
        over_exclusion(df),
        flatline(df),
        duplicate_composites(df, pairs),
        contamination(df, [a for a, _ in pairs], [b for _, b in pairs]),
        orphaned_metrics(specs),
        unsupported_mappings(df, AUDIT_FLAGS),
    ]
    return reduce(DataFrame.unionByName, parts)


# --- preflight ------------------------------------------------------------------------

SEVERITIES = ["_Norm_NCO_Severity", "_Norm_NA_Severity", "_Norm_Loans_Severity"]


def preflight(
    df: DataFrame, rolling: DataFrame, subject: int, standard: Sequence[int], normalized: Sequence[int]
) -> DataFrame:
    """Findings before any report: (check, subject, level, rows, suppressed output). Errors block.

    A handful of aggregates; nothing here grows beyond a few dozen rows.
    """
    findings = []

    def add(frame: DataFrame, check: str, about: Column, level: str, rows: Column, suppressed: str | None = None) -> None:
        findings.append(
            frame.select(F.lit(check).alias("check"), about.alias("about"), F.lit(level).alias("level"), rows.cast("long").alias("rows"), F.lit(suppressed).cast("string").alias("suppressed"))
        )

    zero = F.lit(0)
    who = df.agg(F.count_if(F.col(ENTITY) == subject).alias("n"))
    add(who.filter("n = 0"), "subject_missing", F.lit(str(subject)), "error", zero)

    metrics = present(df.columns, ["Norm_NCO_Rate", "Norm_Nonaccrual_Rate", "Norm_Gross_Loans"])
    if metrics:
        filled = df.agg(*[F.struct(F.count(m).alias("n"), F.count_if(F.col(m) != 0).alias("nz")).alias(m) for m in metrics])
        long = filled.select(F.explode(F.array(*[F.struct(F.lit(m).alias("m"), F.col(m).alias("s")) for m in metrics])).alias("p"))
        add(long.filter("p.s.n = 0"), "metric_all_null", F.col("p.m"), "warning", zero, "normalized_credit_chart")
        add(long.filter("p.s.n > 0 and p.s.nz = 0"), "metric_all_zero", F.col("p.m"), "warning", F.col("p.s.n"))

    severities = present(df.columns, SEVERITIES)
    if severities:
        blocking = [subject, *normalized]
        last_period = df.agg(F.max(PERIOD)).scalar()
        flags = df.select(ENTITY, (F.col(PERIOD) == last_period).alias("now"), *severities).unpivot(
            [ENTITY, "now"], severities, "severity", "v"
        )
        bad = flags.filter("v = 'material_nan'").groupBy("severity").agg(
            F.count(F.lit(1)).alias("all_rows"),
            F.count_if(F.col("now") & F.col(ENTITY).isin(blocking)).alias("blocking"),
            F.count_if(F.col("now") & ~F.col(ENTITY).isin(blocking)).alias("peers"),
        )
        add(bad.filter("blocking > 0"), "material_blocking", F.col("severity"), "error", F.col("blocking"), "normalized_credit_chart")
        add(bad.filter("peers > 0"), "material_peers", F.col("severity"), "warning", F.col("peers"))
        add(bad, "material_history", F.col("severity"), "warning", F.col("all_rows"))

    known = df.select(ENTITY).union(rolling.select(ENTITY)).distinct()
    for label, ids, output in (("standard", standard, "standard_scatter"), ("normalized", normalized, "normalized_credit_chart")):
        wanted = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(i).cast("long") for i in ids])).alias(ENTITY))
        gone = wanted.join(known, ENTITY, "left_anti")
        add(gone, f"{label}_composite_missing", F.col(ENTITY).cast("string"), "error", zero, output)
    peers = rolling.filter(~F.col(ENTITY).isin([subject, *standard, *normalized])).agg(F.count(F.lit(1)).alias("n"))
    add(peers.filter("n = 0"), "no_real_peers", F.lit(""), "error", zero)
    return reduce(DataFrame.unionByName, findings)


def preflight_verdict(findings: DataFrame) -> DataFrame:
    """One row: valid, number of errors and warnings, outputs to suppress."""
    return findings.agg(
        (F.count_if(F.col("level") == "error") == 0).alias("valid"),
        F.count_if(F.col("level") == "error").alias("errors"),
        F.count_if(F.col("level") == "warning").alias("warnings"),
        F.array_join(F.sort_array(F.collect_set("suppressed")), ",").alias("suppressed"),
    )


def composite_regime(df: DataFrame, active: Sequence[int], legacy: Sequence[int]) -> DataFrame:
    """Active composites that are missing and legacy ones still there."""
    have = df.select(ENTITY).distinct()
    ids = lambda values: df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(v).cast("long") for v in values])).alias(ENTITY))
    missing = ids(active).join(have, ENTITY, "left_anti").withColumn("status", F.lit("missing_active"))
    stale = ids(legacy).join(have, ENTITY, "left_semi").withColumn("status", F.lit("legacy_present"))
    return missing.unionByName(stale)


def duplicate_groups(bridge: DataFrame) -> DataFrame:
    """Groups of the same regime with identical members, paired with the first of them.

    Order-free fingerprints find the candidates, then only those are compared member by
    member against their first group - no list of members is gathered and no pairs of
    groups are formed.
    """
    prints = bridge.groupBy("use_normalized", "group_key").agg(
        F.count(F.lit(1)).alias("size"),
        F.min("CERT").alias("lo"),
        F.max("CERT").alias("hi"),
        F.bit_xor(F.xxhash64("CERT")).alias("x"),
        F.sum(F.xxhash64("CERT").cast("decimal(38,0)")).alias("s"),
    )
    same = ["use_normalized", "size", "lo", "hi", "x", "s"]
    first = prints.groupBy(*same).agg(F.min("group_key").alias("same_as"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    pairs = prints.join(first.drop("n"), same).filter("group_key <> same_as").select("use_normalized", "group_key", "same_as", "size")
    a = bridge.select("group_key", "CERT")
    b = bridge.select(F.col("group_key").alias("same_as"), "CERT")
    shared = pairs.join(a, "group_key").join(b, ["same_as", "CERT"]).groupBy("use_normalized", "group_key", "same_as", "size").agg(F.count(F.lit(1)).alias("n"))
    return shared.filter("n = size").select("use_normalized", "group_key", "same_as", F.col("size").alias("members"))


# --- extract assertions ---------------------------------------------------------------


def extract_assertions(df: DataFrame, allowed_flags: Sequence[str], products: Sequence[str], min_new_share: float = 0.3) -> DataFrame:
    """Invariants of a tagged extract as (check, failed rows, passed), from one pass over the loans."""
    lit_list = F.array(*[F.lit(f) for f in allowed_flags])
    listed = F.when(F.col("FLAGS") == "", F.array().cast("array<string>")).otherwise(F.split("FLAGS", "\\|"))
    amount = F.coalesce(F.col("CREDIT_LII"), F.lit(0.0))
    rules = {
        "allowed_flags": F.size(F.array_except(listed, lit_list)) > 0,
        "flag_count": F.col("FLAG_COUNT") != F.size(listed),
        "qualified": F.col("QUALIFIED") != (F.col("FLAG_COUNT") > 0),
        "account_12_digits": ~F.coalesce(F.col("ACCOUNT_NUMBER").rlike("^[0-9]{12}$"), F.lit(False)),
        "floor_within_amount": (F.col("CREDIT_LII_COMMITMENT_FLOOR") > amount) & (amount >= 1),
        "known_product": ~F.col("PRODUCT_BUCKET").isin(list(products)),
    }
    one = df.agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col("NEW_CAMP_YN") == "Y").alias("_y"),
        *[F.count_if(rule).alias(name) for name, rule in rules.items()],
    )
    parts = [F.struct(F.lit(n).alias("check"), F.col(n).alias("failed"), (F.col(n) == 0).alias("passed")) for n in rules]
    share = F.try_divide(F.col("_y"), F.col("_n")) >= min_new_share
    parts.append(F.struct(F.lit("share_of_new").alias("check"), F.when(share, 0).otherwise(1).cast("long").alias("failed"), share.alias("passed")))
    return one.select(F.explode(F.array(*parts)).alias("p")).select("p.*")
