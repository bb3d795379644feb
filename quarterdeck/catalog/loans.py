"""Loan cleaning, tagging, flag and matrix queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarterdeck.catalog.sql import register, with_ctes
from quarterdeck.operators import matrix, tagging
from quarterdeck.plans import shapes
from quarterdeck.plans.loan_run import prepare, tag_loans, write_tagged
from quarterdeck.session import scratch_path


def lookups(spark, sf):
    return shapes.credit_lookup(spark, sf), shapes.reserve_lookup(spark, sf), shapes.property_lookup(spark, sf)


def flagged(spark, sf):
    return tag_loans(shapes.loan_extract(spark, sf), *lookups(spark, sf))


def clean_keys(spark, sf):
    df = tagging.clean_extract(shapes.loan_extract(spark, sf))
    return df.select("LOAN_ID", "TL_FACILITY_DIGITS12", "FACILITY_ID", "ACCOUNT_NUMBER", "IS_LAL_NFP", "CREDIT_LII", "SBL_PERC", "NEW_COMMITMENT_AMOUNT")


def bucket_ladder(spark, sf):
    df = prepare(shapes.loan_extract(spark, sf))
    return df.select("LOAN_ID", "CREDIT_LII_COMMITMENT_FLOOR", "CREDIT_LII_COMMITMENT_BUCKET", "NEW_CAMP_YN")


def semi_join_tags(spark, sf):
    df = tagging.with_tags(prepare(shapes.loan_extract(spark, sf)), *lookups(spark, sf))
    return df.select("LOAN_ID", "IS_NTC", "IS_OFFICE", "HAS_CREDIT_POLICY_EXCEPTION")


def semi_join_tags_salted(spark, sf):
    df = tagging.with_tags(prepare(shapes.loan_extract(spark, sf)), *lookups(spark, sf), salts=4)
    return df.select("LOAN_ID", "IS_NTC", "IS_OFFICE", "HAS_CREDIT_POLICY_EXCEPTION")


def missing_lookups(spark, sf):
    """Every optional input landed empty: the run goes on and all tags from files are False."""
    empty = [df.limit(0) for df in lookups(spark, sf)]
    df = tagging.with_tags(prepare(shapes.loan_extract(spark, sf)), *empty)
    return df.groupBy("IS_NTC", "IS_OFFICE", "HAS_CREDIT_POLICY_EXCEPTION").agg(F.count(F.lit(1)).alias("loans"))


def loan_flags(spark, sf):
    return flagged(spark, sf).select("LOAN_ID", "FLAGS", "FLAG_COUNT", "QUALIFIED")


def join_rates(spark, sf):
    return tagging.join_rates(tagging.clean_extract(shapes.loan_extract(spark, sf)), *lookups(spark, sf))


def join_rates_of_the_run(spark, sf):
    """The same audit, counted while the run writes its loans."""
    return write_tagged(shapes.loan_extract(spark, sf), *lookups(spark, sf), scratch_path(spark, "tagged"), "parquet")


def top_loans(spark, sf):
    return matrix.top_loans(flagged(spark, sf)).select("LOAN_ID", "BORROWER", "PRODUCT_BUCKET", "CREDIT_LII")


def nearest_threshold(spark, sf):
    return matrix.nearest_threshold(flagged(spark, sf)).select("LOAN_ID", "PRODUCT_BUCKET", "CREDIT_LII", "threshold", "pct", "distance")


def drill_through(spark, sf):
    df = matrix.drill_through(flagged(spark, sf), 300_000_000, "TL SBL Diversified", new_only=True, qualified_only=True)
    return df.select("LOAN_ID", "CREDIT_LII", "FLAGS")


def commitment_pivot(spark, sf):
    wide = matrix.commitment_pivot(flagged(spark, sf), "sum", "QUALIFIED")
    return wide.toDF(*[c.replace(" ", "_").replace(".", "").lower() for c in wide.columns])


QUERIES = {
    "clean_keys": clean_keys,
    "bucket_ladder": bucket_ladder,
    "semi_join_tags": semi_join_tags,
    "semi_join_tags_salted": semi_join_tags_salted,
    "missing_lookups": missing_lookups,
    "loan_flags": loan_flags,
    "join_rates": join_rates,
    "join_rates_of_the_run": join_rates_of_the_run,
    "flag_counts": lambda s, d: tagging.flag_counts(flagged(s, d)),
    "flag_summary": lambda s, d: tagging.flag_summary(flagged(s, d)),
    "view_matrices": lambda s, d: matrix.view_matrices(flagged(s, d)),
    "commitment_pivot": commitment_pivot,
    "matrix_totals": lambda s, d: matrix.matrix_totals(flagged(s, d)),
    "threshold_bands": lambda s, d: matrix.threshold_bands(flagged(s, d)),
    "qualified_split": lambda s, d: matrix.qualified_split(flagged(s, d)),
    "flag_breakdown": lambda s, d: matrix.flag_breakdown(flagged(s, d)),
    "flag_overlap": lambda s, d: matrix.flag_overlap(flagged(s, d)),
    "concentration": lambda s, d: matrix.concentration(flagged(s, d)),
    "concentration_above_lowest": lambda s, d: matrix.concentration(flagged(s, d), "above_lowest"),
    "top_loans": top_loans,
    "nearest_threshold": nearest_threshold,
    "drill_through": drill_through,
}


def pad12(c):
    d = f"regexp_replace(regexp_replace(trim({c}), '\\.0$', ''), '[^0-9]', '', 'g')"
    return f"case when lower(trim({c})) in ('', 'nan', 'none', 'nat', 'null', '<na>') or {d} = '' then null when length({d}) > 12 then {d} else lpad({d}, 12, '0') end"


def number(c):
    return f"try_cast(replace(trim({c}), ',', '') as double)"


_LADDER = "case " + " ".join(f"when CREDIT_LII >= {f} then {f}" for f in tagging.BUCKET_FLOORS) + " else 1 end"
_LABEL = "case " + " ".join(f"when CREDIT_LII >= {f} then '${f:,}'" for f in tagging.BUCKET_FLOORS) + " else '$1' end"
register(
    "loans",
    f"""select LOAN_ID, {pad12('TL_FACILITY_DIGITS12')} as TL_FACILITY_DIGITS12, coalesce({pad12('FACILITY_ID')}, {pad12('TL_FACILITY_DIGITS12')}) as FACILITY_ID, {pad12("replace(ACCOUNT_NUMBER, '-', '')")} as ACCOUNT_NUMBER,
  BORROWER, PRODUCT_BUCKET, coalesce(lower(trim(IS_LAL_NFP)) in ('true', '1'), false) as IS_LAL_NFP, FOCUS_LIST, TXT_MSTR_FACIL_COLLATERAL_DESC, {number('SBL_PERC')} as SBL_PERC,
  {number('CREDIT_LII')} as CREDIT_LII, {number('NEW_COMMITMENT_AMOUNT')} as NEW_COMMITMENT_AMOUNT, NEW_COMMITMENT_REASON, NEW_CAMP_YN as OLD_YN from extract""",
    ("extract",),
)
register(
    "prepared",
    f"""select *, cast({_LADDER} as bigint) as CREDIT_LII_COMMITMENT_FLOOR, {_LABEL} as CREDIT_LII_COMMITMENT_BUCKET,
  case when OLD_YN = 'Y' or coalesce(NEW_COMMITMENT_AMOUNT, 0) > 0 or upper(coalesce(NEW_COMMITMENT_REASON, '')) not in ('', 'NONE', 'NAN') then 'Y' else 'N' end as NEW_CAMP_YN from loans""",
    ("loans",),
)
_A = "({})".format(", ".join(f"'{p}'" for p in tagging.LAL_PRODUCTS))
_B = "({})".format(", ".join(f"'{p}'" for p in tagging.TL_PRODUCTS))
_ACC = pad12("replace(ACCOUNT_NUMBER, '-', '')")
_YES = lambda c: f"coalesce(lower(trim({c})) = 'yes', false)"
_IN = lambda key, q: f"coalesce({key} in (select k from ({q}) where k is not null), false)"
register(
    "tagged",
    f"""select *, coalesce((PRODUCT_BUCKET in {_A} and (IS_LAL_NFP or {_IN('ACCOUNT_NUMBER', f"select {_ACC} as k from credit where {_YES('OPERATING_COMPANY')} or {_YES('CHARITY_NON_PROFIT_ORGANIZATION')}")}))
  or (PRODUCT_BUCKET in {_B} and {_IN('TL_FACILITY_DIGITS12', f"select {pad12('FACILITY_ACCOUNT_NUMBER')} as k from reserve where PURPOSE_CODE_DESCRIPTION ilike '%corp%' and regexp_matches(lower(ACCOUNT_RELATIONSHIP_CODE_DESCRIPTION), '{'|'.join(tagging.ENTITY_WORDS)}')")}), false) as IS_NTC,
  {_IN('TL_FACILITY_DIGITS12', f"select {pad12('FACILITY_ID')} as k from property where PROPERTY_TYPE ilike '%office%'")} as IS_OFFICE,
  {_IN('ACCOUNT_NUMBER', f"select {_ACC} as k from credit where {_YES('EXCEPTION_1')} or {_YES('EXCEPTION_2')} or {_YES('EXCEPTION_3')} or {_YES('EXCEPTION_4')}")} as HAS_CREDIT_POLICY_EXCEPTION
  from prepared""",
    ("prepared", "credit", "reserve", "property"),
)


def _rule(rule):
    for name, word in tagging.KEYWORDS.items():
        rule = rule.replace(name, f"(TXT_MSTR_FACIL_COLLATERAL_DESC ilike '%{word}%')")
    return rule.replace("amount", "coalesce(CREDIT_LII, 0)").replace("share", "coalesce(SBL_PERC, 0)")


_FLAGS = ", ".join(f"case when {_rule(rule)} then '{name}' end" for name, rule in tagging.FLAG_RULES.items())
register(
    "flagged",
    f"select *, array_to_string(fl, '|') as FLAGS, cast(len(fl) as integer) as FLAG_COUNT, len(fl) > 0 as QUALIFIED, coalesce(CREDIT_LII, 0.0) as amt from (select *, list_filter([{_FLAGS}], lambda x: x is not null) as fl from tagged)",
    ("tagged",),
)
_T = "case PRODUCT_BUCKET " + " ".join(f"when '{p}' then {float(t)}" for p, t in matrix.THRESHOLDS.items()) + " end"
_GRID = f"(select unnest([{', '.join(str(f) for f in tagging.BUCKET_FLOORS)}])::bigint as CREDIT_LII_COMMITMENT_FLOOR) cross join (select unnest([{', '.join(repr(p) for p in tagging.PRODUCTS)}]) as PRODUCT_BUCKET)"
_LISTED = f"select * replace (case when PRODUCT_BUCKET in ({', '.join(repr(p) for p in tagging.PRODUCTS)}) then PRODUCT_BUCKET else 'UNLISTED' end as PRODUCT_BUCKET) from flagged"
_RULES = f"(select unnest([{', '.join(repr(f) for f in tagging.FLAG_NAMES)}]) as flag)"
_VIEW = ", ".join(
    f"coalesce(count(f.LOAN_ID) filter ({w}), 0) as count_{v}, coalesce(sum(amt) filter ({w}), 0.0) as sum_{v}"
    for v, w in (("all_all", "true"), ("new_all", "NEW_CAMP_YN = 'Y'"), ("all_qualified", "QUALIFIED"), ("new_qualified", "NEW_CAMP_YN = 'Y' and QUALIFIED"))
)
_RATE = lambda name, scope, key, q: f"""select '{name}' as lookup, count(*) as total, count(*) filter ({_IN(key, q)}) as matched,
    count(*) filter ({_IN(key, q)}) * 100.0 / count(*) as join_rate_pct from loans where PRODUCT_BUCKET in {scope}"""  # noqa: E731


def _conc(den):
    return f"""with c as (select PRODUCT_BUCKET, sum(case when amt >= {_T} then amt else 0.0 end) as at_above, sum({den}) as total from flagged group by 1)
        select *, coalesce(at_above / nullif(total, 0), 0.0) as concentration from (select * from c union all select 'TOTAL', sum(at_above), sum(total) from c)"""


ORACLES = {
    "clean_keys": with_ctes("select LOAN_ID, TL_FACILITY_DIGITS12, FACILITY_ID, ACCOUNT_NUMBER, IS_LAL_NFP, CREDIT_LII, SBL_PERC, NEW_COMMITMENT_AMOUNT from loans", "loans"),
    "bucket_ladder": with_ctes("select LOAN_ID, CREDIT_LII_COMMITMENT_FLOOR, CREDIT_LII_COMMITMENT_BUCKET, NEW_CAMP_YN from prepared", "prepared"),
    "semi_join_tags": with_ctes("select LOAN_ID, IS_NTC, IS_OFFICE, HAS_CREDIT_POLICY_EXCEPTION from tagged", "tagged"),
    "semi_join_tags_salted": with_ctes("select LOAN_ID, IS_NTC, IS_OFFICE, HAS_CREDIT_POLICY_EXCEPTION from tagged", "tagged"),
    "missing_lookups": with_ctes(
        f"select PRODUCT_BUCKET in {_A} and IS_LAL_NFP as IS_NTC, false as IS_OFFICE, false as HAS_CREDIT_POLICY_EXCEPTION, count(*) as loans from loans group by 1", "loans"
    ),
    "loan_flags": with_ctes("select LOAN_ID, FLAGS, FLAG_COUNT, QUALIFIED from flagged", "flagged"),
    "join_rates": with_ctes(
        " union all ".join(
            [
                _RATE("credit", _A, "ACCOUNT_NUMBER", f"select {_ACC} as k from credit"),
                _RATE("reserve", _B, "TL_FACILITY_DIGITS12", f"select {pad12('FACILITY_ACCOUNT_NUMBER')} as k from reserve"),
                _RATE("property", _B, "TL_FACILITY_DIGITS12", f"select {pad12('FACILITY_ID')} as k from property"),
            ]
        ),
        "loans",
        "credit",
        "reserve",
        "property",
    ),
    "flag_counts": with_ctes(
        f"""select flag, count(LOAN_ID) as loans, coalesce(sum(CREDIT_LII), 0.0) as amount, count(LOAN_ID) = 0 as zero_hit
            from (select unnest([{', '.join(repr(f) for f in tagging.FLAG_NAMES)}]) as flag) left join flagged on list_contains(fl, flag) group by flag""",
        "flagged",
    ),
    "flag_summary": with_ctes(
        """select count(*) as loans, count(*) filter (QUALIFIED) as qualified, count(*) filter (QUALIFIED) * 100.0 / count(*) as qualified_pct,
           count(*) filter (FLAG_COUNT > 1) as multi_flag, (select cast(count(distinct f) as integer) from (select unnest(fl) as f from flagged)) as distinct_flags from flagged""",
        "flagged",
    ),
    "view_matrices": with_ctes(
        f"select CREDIT_LII_COMMITMENT_FLOOR, PRODUCT_BUCKET, {_VIEW} from {_GRID} full join ({_LISTED}) f using (CREDIT_LII_COMMITMENT_FLOOR, PRODUCT_BUCKET) group by 1, 2", "flagged"
    ),
    "commitment_pivot": with_ctes(
        "select CREDIT_LII_COMMITMENT_FLOOR as credit_lii_commitment_floor, "
        + ", ".join(f"coalesce(sum(amt) filter (PRODUCT_BUCKET = '{p}' and QUALIFIED), 0.0) as {p.replace(' ', '_').replace('.', '').lower()}" for p in tagging.PRODUCTS)
        + f", coalesce(sum(amt) filter (PRODUCT_BUCKET = 'UNLISTED' and QUALIFIED), 0.0) as unlisted from {_GRID} full join ({_LISTED}) f using (CREDIT_LII_COMMITMENT_FLOOR, PRODUCT_BUCKET) group by 1",
        "flagged",
    ),
    "matrix_totals": with_ctes(
        """select CREDIT_LII_COMMITMENT_FLOOR, PRODUCT_BUCKET, cast(grouping(CREDIT_LII_COMMITMENT_FLOOR, PRODUCT_BUCKET) as integer) as total_level, count(*) as loans, sum(amt) as amount
           from flagged group by cube (CREDIT_LII_COMMITMENT_FLOOR, PRODUCT_BUCKET)""",
        "flagged",
    ),
    "threshold_bands": with_ctes(
        "select PRODUCT_BUCKET, "
        + ", ".join(
            f"count(*) filter ({c}) as n_{n}, coalesce(sum(amt) filter ({c}), 0.0) as sum_{n}"
            for n, c in (("below", f"amt < {_T} * 0.8"), ("approaching", f"amt >= {_T} * 0.8 and amt < {_T}"), ("at_above", f"amt >= {_T}"))
        )
        + " from flagged group by 1",
        "flagged",
    ),
    "qualified_split": with_ctes("select QUALIFIED, count(*) as loans, sum(amt) as amount from flagged group by 1", "flagged"),
    "flag_breakdown": with_ctes(
        "select flag, count(*) as loans, sum(amt) as amount from (select unnest(fl) as flag, amt from flagged) group by 1 order by 2 desc, 1 limit 12", "flagged"
    ),
    "flag_overlap": with_ctes(
        f"""select a.flag as flag_a, b.flag as flag_b, coalesce(loans, 0) as loans from {_RULES} a cross join {_RULES} b
            left join (select flag_a, flag_b, count(*) as loans from (select unnest(fl) as flag_a, fl from flagged), unnest(fl) u(flag_b) group by 1, 2) p on p.flag_a = a.flag and p.flag_b = b.flag""",
        "flagged",
    ),
    "concentration": with_ctes(f"select * from ({_conc('amt')})", "flagged"),
    "concentration_above_lowest": with_ctes(f"select * from ({_conc(f'case when PRODUCT_BUCKET in {_A} and CREDIT_LII_COMMITMENT_FLOOR = 1 then 0.0 else amt end')})", "flagged"),
    "top_loans": with_ctes("select LOAN_ID, BORROWER, PRODUCT_BUCKET, CREDIT_LII from flagged order by CREDIT_LII desc nulls last, LOAN_ID limit 10", "flagged"),
    "nearest_threshold": with_ctes(
        f"""select LOAN_ID, PRODUCT_BUCKET, CREDIT_LII, t as threshold, amt / t as pct, amt - t as distance from (select *, cast({_T} as double) as t from flagged)
            where amt / t between 0.7 and 3.0 order by abs(amt / t - 1), LOAN_ID limit 30""",
        "flagged",
    ),
    "drill_through": with_ctes(
        "select LOAN_ID, CREDIT_LII, FLAGS from flagged where CREDIT_LII_COMMITMENT_FLOOR = 300000000 and PRODUCT_BUCKET = 'TL SBL Diversified' and NEW_CAMP_YN = 'Y' and QUALIFIED", "flagged"
    ),
}

ORACLES["join_rates_of_the_run"] = ORACLES["join_rates"]
