"""Deal-tracker queries."""

from __future__ import annotations

from quarterdeck.catalog.sql import register, with_ctes
from quarterdeck.functions.names import find_role
from quarterdeck.operators import tracker
from quarterdeck.plans.shapes import deal_tracker

FLAG_COLUMNS = ["FA_POLICY", "FA_PRICING", "DD_REVIEW", "DD_SITE", "NEW_CLIENT"]
# The quarters of the given tables, for the SQL side only: the operator takes those it finds.
QUARTERS = [f"{y}Q{q}" for y in range(1995, 2002) for q in range(1, 5)][:-1]


def deduped(spark, sf):
    df = deal_tracker(spark, sf)
    date, gross = find_role(df.columns, "date", "tracker"), find_role(df.columns, "gross")
    return tracker.dedup_latest(df, "TRACKER_FILE_V", "RELATIONSHIP_NAME", date, [gross, "DEAL_ID"])


def tracker_dedup(spark, sf):
    return deduped(spark, sf).select("BORROWER_KEY", "QUARTER", "DEAL_ID", "GROSS_SIZE")


def tracker_flag_heatmap(spark, sf):
    """Flag columns are those that hold a Y, whatever their names; numbers, dates and keys are not asked."""
    df = deduped(spark, sf)
    texts = [c for c, t in df.dtypes if t == "string" and c not in ("BORROWER_KEY", "QUARTER")]
    df, flags = tracker.combine_families(df, tracker.yes_columns(df, texts))
    return tracker.flag_heatmap(df, flags)


def any_yes_flags(spark, sf):
    df, flags = tracker.combine_families(deal_tracker(spark, sf), FLAG_COLUMNS)
    return df.select("DEAL_ID", *flags)


def deals_by_area(spark, sf):
    df = deduped(spark, sf)
    return tracker.counts_by(df, find_role(df.columns, "product_area"))


def sizes_by_area(spark, sf):
    df = deduped(spark, sf)
    roles = [find_role(df.columns, r) for r in ("product_area", "gross", "net")]
    return tracker.sizes_by(df, *roles)


def deal_types_by_quarter_wide(spark, sf):
    df = deduped(spark, sf)
    kind = find_role(df.columns, "deal_type")
    return tracker.periods_wide(tracker.counts_by(df, kind), kind, "QUARTER", "deals")


def deal_types_by_year(spark, sf):
    df = deduped(spark, sf)
    return tracker.counts_by(df, find_role(df.columns, "deal_type"), "YEAR")


QUERIES = {
    "tracker_dedup": tracker_dedup,
    "tracker_flag_heatmap": tracker_flag_heatmap,
    "any_yes_flags": any_yes_flags,
    "deals_by_area": deals_by_area,
    "sizes_by_area": sizes_by_area,
    "deal_types_by_quarter_wide": deal_types_by_quarter_wide,
    "deal_types_by_year": deal_types_by_year,
}

register(
    "deduped",
    """select * from (select *, upper(coalesce(nullif(trim(TRACKER_FILE_V), ''), trim(RELATIONSHIP_NAME), '')) as BORROWER_KEY,
       year(TRACKER_DATE) || 'Q' || quarter(TRACKER_DATE) as QUARTER, cast(year(TRACKER_DATE) as integer) as YEAR from deals)
       qualify row_number() over (partition by BORROWER_KEY, QUARTER order by TRACKER_DATE desc, GROSS_SIZE desc, DEAL_ID desc) = 1""",
    ("deals",),
)
_y = lambda c: f"coalesce(upper(trim({c})) = 'Y', false)"
_any = {"FA_COMBINED": f"({_y('FA_POLICY')} or {_y('FA_PRICING')})", "DD_COMBINED": f"({_y('DD_REVIEW')} or {_y('DD_SITE')})", "NEW_CLIENT": _y("NEW_CLIENT")}
ORACLES = {
    "tracker_dedup": with_ctes("select BORROWER_KEY, QUARTER, DEAL_ID, GROSS_SIZE from deduped", "deduped"),
    "tracker_flag_heatmap": with_ctes(" union all ".join(f"select QUARTER, '{n}' as flag, count(*) filter ({e}) as yes_count from deduped group by QUARTER" for n, e in _any.items()), "deduped"),
    "any_yes_flags": with_ctes(
        f"select DEAL_ID, NEW_CLIENT, case when {_any['FA_COMBINED']} then 'Y' else 'N' end as FA_COMBINED, case when {_any['DD_COMBINED']} then 'Y' else 'N' end as DD_COMBINED from deals", "deals"
    ),
    "deals_by_area": with_ctes("select PRODUCT_AREA, QUARTER, count(*) as deals from deduped group by 1, 2", "deduped"),
    "sizes_by_area": with_ctes("select PRODUCT_AREA, QUARTER, round(sum(GROSS_SIZE), 1) as gross, round(sum(NET_SIZE), 1) as net from deduped group by 1, 2", "deduped"),
    "deal_types_by_quarter_wide": with_ctes(
        "select DEAL_TYPE, " + ", ".join(f"count(*) filter (QUARTER = '{q}') as \"{q}\"" for q in QUARTERS) + " from deduped group by 1", "deduped"
    ),
    "deal_types_by_year": with_ctes("select DEAL_TYPE, YEAR, count(*) as deals from deduped group by 1, 2", "deduped"),
}
